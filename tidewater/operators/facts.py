"""Trade and interaction facts: equi, composite, interval and lookup joins over the change log.

Joins carry no broadcast hint: dictionaries go to a broadcast join when Spark measures them under
``spark.sql.autoBroadcastJoinThreshold``; otherwise, and for fact sides, a sort-merge join runs whose hot keys
adaptive execution splits. Each join input is a filter and projection over its own scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater import schemas
from tidewater.functions.time import date_id, et_from_seconds
from tidewater.functions.values import product_text
from tidewater.operators.asof import as_of
from tidewater.operators.changes import changed_to, changed_to_strict, pick, rows_of
from tidewater.operators.skew import hot_join, likely_in


def _shape(df: DataFrame, schema) -> DataFrame:
    return df.select(*schema.names)


def lookup(facts: DataFrame, dictionary: DataFrame, code: str, name: str) -> DataFrame:
    """Inner join on a code; adds the dictionary's nested name as column ``name``."""
    names = dictionary.select(F.col("dic_code").alias(f"{name}__code"), F.col("info.dic_name").alias(name))
    return facts.join(names, F.col(code) == F.col(f"{name}__code")).drop(f"{name}__code")


def lookup_as_of(facts: DataFrame, versions: DataFrame, code: str, name: str, at: str = "ts", how: str = "inner", chunk: int = 86_400) -> DataFrame:
    """Lookup of the name that a code had at the second ``at`` of the row, in ``schemas.DICTIONARY_VERSION`` rows."""
    named = versions.select(F.col("dic_code").alias("code"), "since", "pos", "op", F.col("info.dic_name").alias(name))
    return as_of(facts, named, code, F.col(at), [name], order=("pos",), gone=F.col("op") == "d", how=how, chunk=chunk)


def order_detail_rows(log: DataFrame, database: str) -> DataFrame:
    rows = rows_of(log, "order_detail", "insert", database)
    return rows.select(
        *[
            F.col("data")[c].alias(c)
            for c in (
                "id", "order_id", "sku_id", "sku_name", "create_time", "sku_num",
                "split_total_amount", "split_activity_amount", "split_coupon_amount",
            )
        ],
        product_text(F.col("data")["sku_num"], F.col("data")["order_price"]).alias("split_original_amount"),
        "ts",
    )


def order_rows(log: DataFrame, database: str) -> DataFrame:
    return pick(rows_of(log, "order_info", "insert", database), "user_id", "province_id", oi_id="id").withColumnRenamed(
        "ts", "oi_ts"
    )


def activity_rows(log: DataFrame, database: str) -> DataFrame:
    rows = rows_of(log, "order_detail_activity", "insert", database)
    return pick(rows, "activity_id", "activity_rule_id", act_detail="order_detail_id").withColumnRenamed("ts", "act_ts")


def coupon_rows(log: DataFrame, database: str) -> DataFrame:
    rows = rows_of(log, "order_detail_coupon", "insert", database)
    return pick(rows, "coupon_id", cou_detail="order_detail_id").withColumnRenamed("ts", "cou_ts")


def trade_order_detail(log: DataFrame, database: str) -> DataFrame:
    """Order lines widened by their order, activity and coupon."""
    # The order comes first; both optional sides follow on one shuffle of the lines by their id, by which the result can
    # be stored without another.
    wide = (
        order_detail_rows(log, database)
        .join(order_rows(log, database), F.col("order_id") == F.col("oi_id"))
        .join(activity_rows(log, database), F.col("id") == F.col("act_detail"), "left")
        .join(coupon_rows(log, database), F.col("id") == F.col("cou_detail"), "left")
        .withColumn("date_id", date_id(F.col("create_time")))
    )
    return _shape(wide, schemas.ORDER_DETAIL)


def cancelled_rows(log: DataFrame, database: str) -> DataFrame:
    rows = rows_of(log, "order_info", "update", database).where(changed_to_strict("order_status", "1003"))
    return pick(rows, "operate_time", oc_id="id").withColumnRenamed("ts", "oc_ts")


def cancel_shape(joined: DataFrame) -> DataFrame:
    times = {"create_time": F.col("operate_time"), "date_id": date_id(F.col("operate_time"))}
    return _shape(joined.withColumns(times), schemas.ORDER_DETAIL)


def order_cancel(details: DataFrame, log: DataFrame, database: str) -> DataFrame:
    """Lines of cancelled orders; date and time are those of the cancellation."""
    cancelled, order = cancelled_rows(log, database), {"order_id": "oc_id"}
    return cancel_shape(hot_join(likely_in(details, cancelled, order), cancelled, order))


def payment_rows(log: DataFrame, database: str) -> DataFrame:
    rows = rows_of(log, "payment_info", "update", database).where(changed_to("payment_status", "1602"))
    return pick(rows, "callback_time", payment_type_code="payment_type", pi_order="order_id").withColumnRenamed(
        "ts", "pi_ts"
    )


def pay_success_shape(joined: DataFrame, dictionary: DataFrame) -> DataFrame:
    return _pay_shape(lookup(joined, dictionary, "payment_type_code", "payment_type_name"))


def _pay_shape(named: DataFrame) -> DataFrame:
    return _shape(
        named.withColumnsRenamed({"id": "order_detail_id", "split_total_amount": "split_payment_amount"})
        .drop("ts")
        .withColumnRenamed("pi_ts", "ts"),
        schemas.ORDER_PAY_SUCCESS,
    )


def order_pay_success(
    details: DataFrame,
    log: DataFrame,
    dictionary: DataFrame,
    database: str,
    before: str = "30 MINUTES",
    delay: str = "5 SECONDS",
) -> DataFrame:
    """Lines of paid orders, the line being ``delay`` to ``before`` older than the payment (both inclusive)."""
    paid_at, made_at = et_from_seconds(F.col("pi_ts")), et_from_seconds(F.col("ts"))
    in_time = (made_at >= paid_at - F.expr(f"INTERVAL {before}")) & (made_at <= paid_at - F.expr(f"INTERVAL {delay}"))
    # payments are few beside lines: those without a name for their kind go before they meet any
    payments, order = lookup(payment_rows(log, database), dictionary, "payment_type_code", "payment_type_name"), {"order_id": "pi_order"}
    return _pay_shape(hot_join(likely_in(details, payments, order), payments, order, extra=in_time))


def refund_rows(log: DataFrame, database: str) -> DataFrame:
    return pick(
        rows_of(log, "order_refund_info", "insert", database),
        "id", "user_id", "order_id", "sku_id", "refund_reason_txt", "refund_num", "refund_amount", "create_time",
        refund_type_code="refund_type", refund_reason_type_code="refund_reason_type",
    )


def orders_with_status(log: DataFrame, database: str, status: str) -> DataFrame:
    rows = rows_of(log, "order_info", "update", database).where(changed_to("order_status", status))
    return pick(rows, "province_id", oi_id="id", oi_user="user_id").withColumnRenamed("ts", "oi_ts")


def refund_shape(joined: DataFrame, dictionary: DataFrame) -> DataFrame:
    named = lookup(joined, dictionary, "refund_type_code", "refund_code_name")
    named = lookup(named, dictionary, "refund_reason_type_code", "refund_reason_type_name")
    return _shape(named.withColumn("date_id", date_id(F.col("create_time"))), schemas.ORDER_REFUND)


def order_refund(log: DataFrame, dictionary: DataFrame, database: str) -> DataFrame:
    """Refund requests of orders in refund, with the names of their type and reason."""
    orders = orders_with_status(log, database, "1005")
    joined = refund_rows(log, database).join(orders, F.col("order_id") == F.col("oi_id"))
    return refund_shape(joined, dictionary)


def refund_paid_rows(log: DataFrame, database: str) -> DataFrame:
    return pick(
        rows_of(log, "refund_payment", "update", database).where(changed_to("refund_status", "1602")),
        "id", "order_id", "sku_id", "callback_time", payment_type_code="payment_type", refund_amount="total_amount",
    )


def refund_done_rows(log: DataFrame, database: str) -> DataFrame:
    rows = rows_of(log, "order_refund_info", "update", database).where(changed_to("refund_status", "0705"))
    return pick(rows, "refund_num", ri_order="order_id", ri_sku="sku_id").withColumnRenamed("ts", "ri_ts")


def refund_pay_shape(joined: DataFrame, dictionary: DataFrame) -> DataFrame:
    named = lookup(joined, dictionary, "payment_type_code", "payment_type_name")
    named = named.withColumns({"user_id": F.col("oi_user"), "date_id": date_id(F.col("callback_time"))})
    return _shape(named, schemas.REFUND_PAY_SUCCESS)


def refund_pay_success(log: DataFrame, dictionary: DataFrame, database: str) -> DataFrame:
    """Paid-out refunds, matched to the request by order and article."""
    same_article = (F.col("order_id") == F.col("ri_order")) & (F.col("sku_id") == F.col("ri_sku"))
    joined = (
        refund_paid_rows(log, database)
        .join(refund_done_rows(log, database), same_article)
        .join(orders_with_status(log, database, "1006"), F.col("order_id") == F.col("oi_id"))
    )
    return refund_pay_shape(joined, dictionary)


def comment_info(log: DataFrame, dictionary: DataFrame, database: str) -> DataFrame:
    comments = pick(
        rows_of(log, "comment_info", "insert", database), "id", "user_id", "sku_id", "appraise", "comment_txt"
    )
    return _shape(lookup(comments, dictionary, "appraise", "appraise_name"), schemas.COMMENT_INFO)


def comment_info_as_of(log: DataFrame, versions: DataFrame, database: str) -> DataFrame:
    """Comments with the name that their grade had when the comment was made."""
    comments = pick(rows_of(log, "comment_info", "insert", database), "id", "user_id", "sku_id", "appraise", "comment_txt")
    return _shape(lookup_as_of(comments, versions, "appraise", "appraise_name"), schemas.COMMENT_INFO)


def payments_as_of(log: DataFrame, versions: DataFrame, database: str, how: str = "left") -> DataFrame:
    """Successful payments with the name that their kind had at the time: ``order_id, code, name, ts``."""
    paid = payment_rows(log, database).select(F.col("pi_order").alias("order_id"), F.col("payment_type_code").alias("code"), F.col("pi_ts").alias("ts"))
    return lookup_as_of(paid, versions, "code", "name", how=how, chunk=7 * 86_400)
