"""Joins with few wanted keys: lines that cannot match go before they are shuffled, and no match is lost."""

from pyspark.sql import functions as F

from tests.conftest import plan, rows
from tidewater import fixtures as fx
from tidewater.operators import facts, skew
from tidewater.session import settings


def test_all_wanted_rows_stay_and_few_others(spark):
    some = spark.range(20_000).select(F.when(F.col("id") % 100 > 0, F.concat(F.lit("k"), "id")).alias("key"), F.col("id") % 7 > 2, "id")
    wanted = some.where("id % 50 = 7 or id % 100 = 0").select(F.col("key").alias("other"))
    kept = skew.likely_in(some, wanted, {"key": "other"})
    want = {r.id for r in some.where("id % 50 = 7").collect()}
    got = {r.id for r in kept.where("key is not null").collect()}
    assert want <= got and len(got) < len(want) + 20
    assert skew.likely_in(some, wanted.limit(0), {"key": "other"}).count() == 0
    assert skew.likely_in(some.limit(0), wanted, {"key": "other"}).count() == 0


def test_keys_of_several_columns(spark):
    some = spark.createDataFrame([("a", 1), ("a", 2), (None, 1), ("b", None)], "k string, n int")
    wanted = spark.createDataFrame([("a", 2), ("a", 2), ("b", None)], "ok string, on int")
    kept = skew.likely_in(some, wanted, {"k": "ok", "n": "on"})
    assert rows(kept) == sorted([("a", 2), ("b", None)], key=repr)


def test_lines_are_thinned_before_their_shuffles(spark, sf):
    """The filter lies below the exchanges of the lines, also those of the order detail."""
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false"):
        log = fx.change_log(spark, sf, "order_detail", "order_info", "order_detail_activity", "order_detail_coupon", "payment_info").localCheckpoint()
        details = facts.trade_order_detail(log, fx.DATABASE)
        found = [facts.order_cancel(details, log, fx.DATABASE), facts.order_pay_success(details, log, fx.dictionary(spark, sf), fx.DATABASE)]
        for joined in found:
            text = plan(joined).split("\n")
            tested = [i for i, line in enumerate(text) if "Filter" in line and "subquery" in line.lower()]
            dealt = [i for i, line in enumerate(text) if "Exchange hashpartitioning(id#" in line]
            assert dealt and any(i > dealt[0] for i in tested)
    cancelled = facts.cancelled_rows(log, fx.DATABASE)
    assert rows(found[0]) == rows(facts.cancel_shape(details.join(cancelled, F.col("order_id") == F.col("oc_id"))))


def test_lines_are_dealt_by_order_once(spark, sf):
    """The log's own join of lines and orders leaves the lines where the join of the order detail needs them."""
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false"):
        log = fx.change_log(spark, sf, "order_detail", "order_info", "order_detail_activity", "order_detail_coupon")
        assert "Exchange hashpartitioning(order_id#" not in plan(facts.trade_order_detail(log, fx.DATABASE))
