"""Rows sent where the configuration tables say, with the columns they list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivermill.functions import wire

BEGINNING = -(1 << 63)


def _with_rules(changes: DataFrame, rules: DataFrame, keys: dict[str, str], at: Column | None = None) -> DataFrame:
    """Inner join of change records to the rules of their table (and type), as ``columns``.

    With ``at``, a moment of the record, ``rules`` are versions with ``since`` and ``until``, and a record meets those that were
    in force then.

    The listed names are split, untrimmed, once per rule. Spark broadcasts the rules if their size allows it; else a
    table of many changes is cut by adaptive execution.
    """
    renamed = rules.select(
        *[F.col(rule).alias(column) for column, rule in keys.items()],
        *[c for c in rules.columns if c not in keys.values()],
        F.split("sink_columns", ",").alias("columns"),
    )
    if at is None:
        return changes.join(renamed, list(keys), "inner")
    dated = changes.withColumn("_at", at)
    living = renamed.filter(~F.coalesce(F.col("op") == "d", F.lit(False)) & (F.col("until").isNull() | (F.col("since") < F.col("until"))))
    met = dated.join(living.drop("op"), list(keys), "inner")
    # A record without a moment meets the rules that stood from the beginning.
    moment = F.coalesce("_at", F.lit(BEGINNING))
    return met.filter((F.col("since") <= moment) & (F.col("until").isNull() | (moment < F.col("until")))).drop("_at")


def route_dimensions(changes: DataFrame, rules: DataFrame, *keep: str, at: Column | None = None) -> DataFrame:
    """Dimension rows ``(sink_table, row_key, type, data)`` of the tables that have a rule.

    The row key is one of the listed columns; a rule that does not list it names no rows.
    """
    listed = F.array_contains(F.split("sink_columns", ","), F.col("sink_row_key"))
    keyed = rules.withColumn("sink_row_key", F.when(listed, F.col("sink_row_key")))
    routed = _with_rules(changes, keyed, {"table": "source_table"}, at)
    row_key = F.element_at("data", F.col("sink_row_key"))
    data = wire.keep_keys(F.col("data"), F.col("columns"))
    return routed.select("sink_table", row_key.alias("row_key"), "type", data.alias("data"), *keep)


def route_facts(changes: DataFrame, rules: DataFrame, *keep: str, at: Column | None = None) -> DataFrame:
    """Fact rows ``(sink_table, data)`` of the table and type pairs that have a rule."""
    routed = _with_rules(changes, rules, {"table": "source_table", "type": "source_type"}, at)
    data = wire.keep_keys(F.col("data"), F.col("columns"))
    return routed.select("sink_table", data.alias("data"), *keep)


def topic_records(routed: DataFrame, *keep: str) -> DataFrame:
    """Routed rows as ``(topic, value)``: the destination leaves the payload."""
    payload: Column = F.to_json("data")
    return routed.select(F.col("sink_table").alias("topic"), payload.alias("value"), *keep)
