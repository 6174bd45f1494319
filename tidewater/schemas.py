"""Row shapes of the warehouse: change log, application log, configuration, facts and summaries."""

from pyspark.sql import types as T

STRINGS = T.MapType(T.StringType(), T.StringType())


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


CHANGE_LOG = T.StructType(
    _strings("database", "table", "type")
    + [T.StructField("data", STRINGS), T.StructField("old", STRINGS), T.StructField("ts", T.LongType())]
)

APP_LOG = T.StructType(
    [
        T.StructField("common", T.StructType(_strings("mid", "vc", "ch", "ar", "is_new", "sid"))),
        T.StructField("page", STRINGS),
        T.StructField("displays", T.ArrayType(STRINGS)),
        T.StructField("actions", T.ArrayType(STRINGS)),
        T.StructField("err", STRINGS),
        T.StructField("start", STRINGS),
        T.StructField("ts", T.LongType()),
        T.StructField("seq", T.LongType()),  # position in the log, breaks ties of ts
    ]
)

DIM_CONFIG = T.StructType(_strings("source_table", "sink_table", "sink_columns", "sink_family", "sink_row_key"))
SPLIT_CONFIG = T.StructType(_strings("source_table", "source_type", "sink_table", "sink_columns"))


def config_change(row: T.StructType) -> T.StructType:
    """Envelope of a configuration change: operation, row before, row after, position."""
    return T.StructType(
        [
            T.StructField("op", T.StringType()),
            T.StructField("before", row),
            T.StructField("after", row),
            T.StructField("seq", T.LongType()),
        ]
    )


DICTIONARY = T.StructType(
    [T.StructField("dic_code", T.StringType()), T.StructField("info", T.StructType(_strings("dic_name")))]
)

#: A change of the code table: from the second ``since`` on, until the next one; ``op`` d ends the code.
DICTIONARY_VERSION = T.StructType(
    [*DICTIONARY.fields, T.StructField("op", T.StringType()), T.StructField("since", T.LongType()), T.StructField("pos", T.LongType())]
)

ORDER_DETAIL = T.StructType(
    _strings(
        "id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id", "activity_rule_id",
        "coupon_id", "date_id", "create_time", "sku_num", "split_original_amount", "split_activity_amount",
        "split_coupon_amount", "split_total_amount",
    )
    + [T.StructField("ts", T.LongType())]
)

ORDER_PAY_SUCCESS = T.StructType(
    _strings(
        "order_detail_id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id",
        "activity_rule_id", "coupon_id", "payment_type_code", "payment_type_name", "callback_time", "sku_num",
        "split_original_amount", "split_activity_amount", "split_coupon_amount", "split_payment_amount",
    )
    + [T.StructField("ts", T.LongType())]
)

ORDER_REFUND = T.StructType(
    _strings(
        "id", "user_id", "order_id", "sku_id", "province_id", "date_id", "create_time", "refund_type_code",
        "refund_code_name", "refund_reason_type_code", "refund_reason_type_name", "refund_reason_txt",
        "refund_num", "refund_amount",
    )
    + [T.StructField("ts", T.LongType())]
)

REFUND_PAY_SUCCESS = T.StructType(
    _strings(
        "id", "user_id", "order_id", "sku_id", "province_id", "payment_type_code", "payment_type_name",
        "date_id", "callback_time", "refund_num", "refund_amount",
    )
    + [T.StructField("ts", T.LongType())]
)

COMMENT_INFO = T.StructType(
    _strings("id", "user_id", "sku_id", "appraise", "appraise_name", "comment_txt") + [T.StructField("ts", T.LongType())]
)

CART_ADD = T.StructType(_strings("id", "user_id", "sku_id", "sku_num") + [T.StructField("ts", T.LongType())])

READING = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("sec", T.IntegerType()), T.StructField("val", T.IntegerType())]
)

USER = T.StructType([T.StructField("age", T.LongType()), T.StructField("name", T.StringType())])
