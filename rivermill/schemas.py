"""Record layouts. Wire scalars are read as text and cast with ``try_cast`` later."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT_MAP = T.MapType(T.StringType(), T.StringType())


def _texts(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


COMMON = _texts("mid", "uid", "vc", "ch", "ar", "is_new", "sid")
PAGE = _texts("page_id", "last_page_id", "item", "item_type", "during_time")

# Objects of a log are read as their own JSON text: whatever else they hold is carried on.
LOG = T.StructType(
    [
        *_texts("common", "page", "start", "err").fields,
        T.StructField("displays", T.ArrayType(T.StringType())),
        T.StructField("actions", T.ArrayType(T.StringType())),
        T.StructField("ts", T.StringType()),
    ]
)

CHANGE = T.StructType(
    [
        T.StructField("database", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("data", TEXT_MAP),
        T.StructField("old", TEXT_MAP),
        T.StructField("ts", T.StringType()),
    ]
)

DIM_RULE = _texts("source_table", "sink_table", "sink_columns", "sink_family", "sink_row_key")
FACT_RULE = _texts("source_table", "source_type", "sink_table", "sink_columns")


def envelope(row: T.StructType) -> T.StructType:
    """Change envelope ``{op, ts_ms, before, after}`` around a configuration row."""
    return T.StructType(
        [
            T.StructField("op", T.StringType()),
            T.StructField("ts_ms", T.StringType()),
            T.StructField("before", row),
            T.StructField("after", row),
        ]
    )


DICTIONARY = T.StructType(
    [
        T.StructField("rowkey", T.StringType()),
        T.StructField("info", _texts("dic_name")),
    ]
)

COMMENT_COLUMNS = (
    "id", "user_id", "nick_name", "sku_id", "spu_id", "order_id",
    "appraise", "comment_txt", "create_time", "operate_time",
)
CART_COLUMNS = (
    "id", "user_id", "sku_id", "cart_price", "sku_num", "sku_name", "is_checked",
    "create_time", "operate_time", "is_ordered", "order_time", "source_type", "source_id",
)
ORDER_DETAIL_COLUMNS = (
    "id", "order_id", "sku_id", "sku_name", "order_price", "sku_num", "create_time",
    "split_total_amount", "split_activity_amount", "split_coupon_amount",
)
ORDER_INFO_COLUMNS = ("id", "user_id", "province_id")
PAYMENT_COLUMNS = ("id", "order_id", "user_id", "payment_type", "total_amount", "callback_time")

ORDER_FACT_COLUMNS = (
    "id", "order_id", "sku_id", "user_id", "province_id", "activity_id", "activity_rule_id",
    "coupon_id", "sku_name", "order_price", "sku_num", "create_time",
    "split_total_amount", "split_activity_amount", "split_coupon_amount", "ts",
)
PAYMENT_FACT_COLUMNS = (
    "id", "order_id", "user_id", "payment_type_code", "payment_type_name", "payment_time",
    "sku_id", "province_id", "activity_id", "activity_rule_id", "coupon_id", "sku_name",
    "order_price", "sku_num", "split_total_amount", "split_activity_amount",
    "split_coupon_amount", "ts",
)

ORDER_FACT = T.StructType(
    [T.StructField(c, T.StringType()) for c in ORDER_FACT_COLUMNS[:-1]]
    + [T.StructField("ts", T.StringType())]
)
