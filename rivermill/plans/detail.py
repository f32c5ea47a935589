"""Detail facts: log outputs, routed facts, comments, cart adds, order lines, payments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivermill import schemas
from rivermill.config import JOIN_RETENTION_MS
from rivermill.operators import clean, enrich, joins, project, routing, split, visitors
from rivermill.operators.skew import Arrival


def repaired_logs(logs: DataFrame, arrival: Arrival) -> DataFrame:
    """Clean logs with the new-visitor flag repaired; keeps the arrival columns."""
    cleaned = clean.clean_logs(logs)
    flat = cleaned.withColumns({"mid": F.col("common.mid"), "is_new": F.col("common.is_new")})
    body = ["common", "page", "common_text", "page_text", "start", "err", "displays", "actions"]
    if logs.isStreaming:
        # Keyed state hands rows to Python; nested columns travel as one text.
        kept = flat.schema
        flat = flat.withColumn("body", F.to_json(F.struct(*body))).drop(*body)
        flat = visitors.repair_new_visitors(flat, arrival)
        flat = flat.withColumn("body", F.from_json("body", T.StructType([kept[c] for c in body])))
        flat = flat.select("*", "body.*").drop("body")
    else:
        flat = visitors.repair_new_visitors(flat, arrival)
    repaired = flat.withColumn("common", F.col("common").withField("is_new", F.col("is_new")))
    return repaired.drop("mid", "is_new")


def log_topics(logs: DataFrame, arrival: Arrival) -> DataFrame:
    """The five log outputs as ``(topic, value)``."""
    return split.outputs(repaired_logs(logs, arrival))


def log_records(logs: DataFrame, arrival: Arrival) -> DataFrame:
    """The five log outputs and the dirty records, from ``topics.all_logs``."""
    good, bad = clean.split_dirty(logs)
    return log_topics(good, arrival).unionByName(split.dirty(bad))


def page_rows(pages: DataFrame, *keep: str) -> DataFrame:
    """Page facts with flat columns, as the aggregates read them."""
    return pages.select("common.*", "page.*", "ts", *keep)


def routed_facts(changes: DataFrame, rules: DataFrame, *keep: str, at: Column | None = None) -> DataFrame:
    """Simple facts as ``(topic, value)``, by the rules of table and change type; with ``at``, by their versions of that moment."""
    return routing.topic_records(routing.route_facts(changes, rules, *keep, at=at), *keep)


def comment_facts(changes: DataFrame, dictionary: DataFrame) -> DataFrame:
    return named_comments(project.comments(changes), dictionary)


def named_comments(comments: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Comments with the name of their appraisal; unknown codes are dropped."""
    named = enrich.lookup(comments, dictionary, "appraise", "appraise_name", "inner")
    return named.select(
        "id", "user_id", "nick_name", "sku_id", "spu_id", "order_id",
        F.col("appraise").alias("appraise_code"), "appraise_name",
        "comment_txt", "create_time", "operate_time",
    )


def cart_facts(changes: DataFrame, *keep: str) -> DataFrame:
    return project.cart_adds(changes, *keep)


def order_facts(changes: DataFrame, arrival: Arrival) -> DataFrame:
    """Order lines with order, activity and coupon, one row per line id."""
    return joins.order_facts(
        project.order_details(changes, *arrival.order),
        project.order_infos(changes, *arrival.order),
        project.order_activities(changes, *arrival.order),
        project.order_coupons(changes, *arrival.order),
        arrival,
    )


def order_changelog(
    changes: DataFrame, arrival: Arrival, retention_ms: int | None = JOIN_RETENTION_MS
) -> DataFrame:
    """Every change of the order lines, in batch and on a stream: ``joins.order_changelog``."""
    return joins.order_changelog(
        project.order_details(changes, *[c for c in arrival.order if c != "ts"]),
        project.order_infos(changes, *arrival.order),
        project.order_activities(changes, *arrival.order),
        project.order_coupons(changes, *arrival.order),
        arrival,
        retention_ms,
    )


def order_facts_stream(changes: DataFrame) -> DataFrame:
    """Streaming form of :func:`order_facts`; ``changes`` has a watermarked ``row_time``."""
    return joins.order_facts_stream(
        project.order_details(changes, "row_time"),
        project.order_infos(changes, "row_time"),
        project.order_activities(changes, "row_time"),
        project.order_coupons(changes, "row_time"),
    )


def payment_facts(changes: DataFrame, lines: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Paid order lines; ``lines`` are order facts, and both inputs have ``row_time``."""
    return named_payments(joins.paid_lines(project.payments(changes, "row_time"), lines), dictionary)


def named_payments(paid: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Paid lines with the name of the payment type; unknown types keep a null name."""
    named = enrich.lookup(paid, dictionary, "payment_type", "payment_type_name", "left")
    return named.withColumnRenamed("payment_type", "payment_type_code").select(
        *schemas.PAYMENT_FACT_COLUMNS
    )
