"""Routing rules from the configuration tables: snapshot plus change envelopes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivermill import schemas
from rivermill.functions import wire
from rivermill.operators import routing, upsert
from rivermill.sources import tables

DIM_KEY = ("source_table",)
FACT_KEY = ("source_table", "source_type")
BEGINNING = routing.BEGINNING


def envelopes(raw: DataFrame, row: T.StructType, *keep: str) -> DataFrame:
    """Envelope texts as ``op`` and the configuration row they speak of.

    A deletion carries the row in ``before``, everything else in ``after``.
    """
    parsed = wire.parse(raw, schemas.envelope(row), *keep)
    return parsed.select(*keep, *unwrap(parsed))


def unwrap(parsed: DataFrame) -> list:
    """Columns ``op`` and the fields of the row an envelope speaks of."""
    spoken = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    names = parsed.schema["after"].dataType.names
    return [F.col("op"), *[spoken[name].alias(name) for name in names]]


def rules(changes: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rules in force: the last change of each key, unless it is a deletion."""
    in_force = upsert.latest_live(changes, key, order, F.col("op") == "d")
    return in_force.drop("op", *order)


def with_snapshot(initial: DataFrame, changes: DataFrame, order: Sequence[str]) -> DataFrame:
    """Initial rows and later changes as one changelog; an initial row is older than any change."""
    kinds = changes.schema
    oldest = [F.lit(None).cast(kinds[c].dataType).alias(c) for c in order]
    fields = [c for c in changes.columns if c not in order]
    return initial.select(*oldest, *fields).unionByName(changes.select(*order, *fields))


def dated(raw: DataFrame, row: T.StructType, *keep: str) -> DataFrame:
    """Like :func:`envelopes`, with the moment of the change in ``since`` (epoch milliseconds; null if it tells none)."""
    parsed = wire.parse(raw, schemas.envelope(row), *keep)
    return parsed.select(*keep, *unwrap(parsed), wire.whole(F.col("ts_ms")).alias("since"))


def versions(held: DataFrame | None, changes: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Every version of every rule with the moments ``since`` (inclusive) and ``until`` (exclusive, null: open).

    ``changes`` are :func:`dated`. A version of ``held``, and a change without a moment, is in force from the beginning; of
    changes of one moment the last in ``order`` counts. Deletions are versions too, with ``op`` = ``d``.
    """
    rows = changes.withColumn("since", F.coalesce("since", F.lit(BEGINNING)))
    if held is not None:
        oldest = [F.lit(None).cast(changes.schema[c].dataType).alias(c) for c in order]
        fields = [c for c in rows.columns if c not in (*order, "since")]
        rows = rows.unionByName(held.select(*fields, *oldest, F.lit(BEGINNING).alias("since")))
    in_turn = Window.partitionBy(*key).orderBy("since", *[F.col(c).asc_nulls_first() for c in order])
    return rows.withColumn("until", F.lead("since").over(in_turn)).drop(*order)


class RuleStore:
    """Rules kept as they change: each micro-batch of rule changes makes a new state from the last, so none is read again.

    A state holds the last version of every key, deletions included, so it grows with the keys and not with the changes.
    ``initial`` are the rules that stood before the first change. A micro-batch that is repeated starts from what it started
    from before and overwrites what it wrote.
    """

    def __init__(
        self, spark: SparkSession, path: str, key: Sequence[str], order: Sequence[str], initial: DataFrame | None = None
    ) -> None:
        self.spark, self.path, self.key, self.order, self.initial = spark, path, key, order, initial

    def state(self, before: int | None = None) -> DataFrame | None:
        """Last versions ``(op, fields)`` as of the micro-batches before ``before``; None if there are none."""
        written = tables.stored(self.spark, self.path)
        if written is not None:
            if before is not None:
                written = written.filter(F.col("batch") < before)
            last = written.agg(F.max("batch")).first()[0]
            if last is not None:
                return self.spark.read.parquet(f"{self.path}/batch={last}")
        return None if self.initial is None else self.initial.withColumn("op", F.lit("r"))

    def take(self, changes: DataFrame, batch_id: int) -> DataFrame:
        """Records the :func:`dated` changes of a micro-batch and returns all versions that its records may meet."""
        made = versions(self.state(batch_id), changes, self.key, self.order)
        if not changes.isEmpty():
            last = made.filter(F.col("until").isNull()).drop("since", "until")
            last.hint("coalesce", 1).write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")
        return made


def snapshot(spark: SparkSession, url: str, table: str, options: dict[str, str] | None = None) -> DataFrame:
    """Configuration table over JDBC as initial reads (``op`` = ``r``)."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for name, value in (options or {}).items():
        reader = reader.option(name, value)
    return reader.load().withColumn("op", F.lit("r"))


def dropped_tables(changes: DataFrame, order: Sequence[str]) -> DataFrame:
    """``(sink_table, moment)`` of rule changes that drop a dimension table.

    A deleted rule drops it; an updated rule drops it and makes it anew, empty.
    """
    drops = changes.filter(F.col("op").isin("d", "u"))
    return drops.select("sink_table", F.struct(*[F.col(c) for c in order]).alias("moment"))
