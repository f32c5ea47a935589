"""Log fan-out: error, start, page, display and action outputs of a clean log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivermill.schemas import TEXT_MAP

# Fixed names of the output topics.
TOPICS = {
    "start": "dwd_traffic_start",
    "err": "dwd_traffic_err",
    "page": "dwd_traffic_page",
    "display": "dwd_traffic_display",
    "action": "dwd_traffic_action",
}
# Records that no job can use; a name of this library's own.
DIRTY_TOPIC = "dwd_traffic_dirty"


def errors(logs: DataFrame) -> DataFrame:
    """The error object alone, of any record that has one."""
    return logs.filter(F.col("err").isNotNull()).select(F.col("err").alias("value"))


def starts(logs: DataFrame, *keep: str) -> DataFrame:
    """Start records; a record with both start and page counts as a start."""
    return logs.filter(F.col("start").isNotNull()).select("common", "start", "ts", *keep)


def is_page() -> Column:
    return F.col("start").isNull() & F.col("page").isNotNull()


def pages(logs: DataFrame, *keep: str) -> DataFrame:
    """Page records, without error, displays and actions."""
    return logs.filter(is_page()).select("common", "page", "ts", *keep)


def displays(logs: DataFrame, *keep: str) -> DataFrame:
    return _items(logs, "displays", "display", keep)


def actions(logs: DataFrame, *keep: str) -> DataFrame:
    return _items(logs, "actions", "action", keep)


def _items(logs: DataFrame, column: str, item: str, keep: tuple[str, ...]) -> DataFrame:
    """One row per array element, as a map and as its whole text, with the page it was seen on."""
    text = f"{item}_text"
    rows = logs.filter(is_page()).select(F.explode(column).alias(text), "common", "page", "ts", *keep)
    return rows.withColumn(item, F.from_json(text, TEXT_MAP))


def outputs(logs: DataFrame) -> DataFrame:
    """All five outputs in one pass as ``(topic, value)``, one JSON text per output record."""

    def record(topic: str, **parts: Column) -> Column:
        return F.struct(F.lit(TOPICS[topic]).alias("topic"), _object(parts).alias("value"))

    def items(topic: str, column: str) -> Column:
        def one(entry: Column) -> Column:
            return F.struct(F.lit(TOPICS[topic]).alias("topic"), _item_text(entry).alias("value"))

        return F.transform(F.when(is_page(), F.col(column)), one)

    err = F.struct(F.lit(TOPICS["err"]).alias("topic"), F.col("err").alias("value"))
    none = F.array().cast("array<struct<topic:string,value:string>>")
    main = F.when(F.col("start").isNotNull(), F.array(record("start", common=_common(), start=F.col("start"), ts=_ts()))).when(
        is_page(), F.array(record("page", common=_common(), page=F.col("page_text"), ts=_ts()))
    )
    parts = [
        F.when(F.col("err").isNotNull(), F.array(err)),
        main,
        items("display", "displays"),
        items("action", "actions"),
    ]
    return logs.select(F.inline(F.concat(*[F.coalesce(part, none) for part in parts])))


def _common() -> Column:
    """The whole common object; of its text only the repaired flag is replaced."""
    cleared = F.regexp_replace("common_text", r'"is_new":"?1"?(?=[,}])', '"is_new":"0"')
    return F.when(F.col("common.is_new") == "0", cleared).otherwise(F.col("common_text"))


def _ts() -> Column:
    return F.col("ts").cast("string")


def _object(parts: dict[str, Column]) -> Column:
    """JSON object of members that are JSON text already."""
    members = [F.concat(F.lit(f'"{name}":'), text) for name, text in parts.items()]
    return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))


def _item_text(entry: Column) -> Column:
    """JSON text of an array element with common, page and ts added in place of its own."""
    added = F.substring(_object({"common": _common(), "page": F.col("page_text"), "ts": _ts()}), 2, 2**31 - 1)
    own_names = F.arrays_overlap(F.json_object_keys(entry), F.array(*map(F.lit, ("common", "page", "ts"))))
    # Rarely an element has such members of its own: they are left out, at the price of texts for its scalars.
    rest = F.to_json(F.map_filter(F.from_json(entry, TEXT_MAP), lambda key, _: ~key.isin("common", "page", "ts")))
    body = F.when(own_names, rest).otherwise(entry)
    return F.when(
        F.col("page_text").isNotNull(),
        F.concat(F.lit("{"), F.regexp_replace(body, r"^\s*\{|\}\s*$", ""), F.when(body.rlike(r"^\s*\{\s*\}"), F.lit("")).otherwise(F.lit(",")), added),
    )


def dirty(logs: DataFrame) -> DataFrame:
    """Records left out of the outputs, as ``(topic, value)`` with their text; ``logs`` has ``_bad`` and the texts."""
    kept = F.to_json(F.struct("common_text", "page_text", "start", "err", "ts"))
    return logs.select(F.lit(DIRTY_TOPIC).alias("topic"), F.coalesce("_bad", kept).alias("value"))
