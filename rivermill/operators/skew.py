"""Per-key order and equality operators that do not put one hot key into one task.

A key is *hot* when it holds more than ``rows_per_task`` rows. At most ``MAX_HOT_KEYS`` keys, the
heaviest ones, are treated apart, so what is broadcast has a fixed bound; a key outside that list
holds less than one in ``MAX_HOT_KEYS`` of the rows. The list only decides how the work is cut:
results are the same whatever it holds.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_TASK = 5_000_000
MAX_HOT_KEYS = 1_000
MAX_PIECES = 4_096
BUCKETS = 65_536  # of keys, counted before the keys themselves
BY_TIME = 60_000  # units of record time in a chunk


@dataclass(frozen=True)
class Arrival:
    """Arrival order of rows: ``order`` columns and a coarser, never decreasing ``chunk``.

    ``chunk`` is an SQL expression over the order columns that cuts the rows of a hot key into
    pieces of about ``rows_per_task``. ``finite`` marks a stream replay that stops at its end.
    """

    order: tuple[str, ...]
    chunk: str
    rows_per_task: int = ROWS_PER_TASK
    finite: bool = False

    @staticmethod
    def by_number(column: str, rows_per_task: int = ROWS_PER_TASK, finite: bool = False) -> Arrival:
        """Order by a unique number: a chunk holds at most ``rows_per_task`` rows."""
        return Arrival((column,), f"{column} div {rows_per_task}", rows_per_task, finite)

    @staticmethod
    def by_offset(rows_per_task: int = ROWS_PER_TASK, finite: bool = False) -> Arrival:
        """Order of a partitioned topic: by record time, then partition and offset.

        A key may stand in several partitions, of which a catch-up reads one after the other; only the records' own time
        puts those in order.
        """
        return Arrival(("ts", "partition", "offset"), f"ts div {BY_TIME}", rows_per_task, finite)


def hot_keys(
    df: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK, *extra: Column
) -> DataFrame:
    """The heaviest keys with more than ``rows_per_task`` rows, and ``extra`` aggregates of each.

    Counting combines on the map side, so it is safe on the skewed input itself.
    """
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"), *extra)
        .filter(F.col("_rows") > rows_per_task)
        .orderBy(F.desc("_rows"), *keys)
        .limit(MAX_HOT_KEYS)
    )


def _in_heavy_buckets(counted: DataFrame, keys: Sequence[str], rows_per_task: int, *counts: str) -> DataFrame:
    """The rows of ``counted`` whose key may reach more than ``rows_per_task`` in any of ``counts``.

    Keys are dealt into ``BUCKETS`` by a hash, and a bucket holds at least what each of its keys holds. So a task hands on a row
    per bucket, not per key, and keys are counted only where a bucket is heavy; with none, adaptive execution drops that count.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).alias("_bucket")
    summed = counted.groupBy(bucket).agg(*[F.sum(c).alias(c) for c in counts])
    heavy = summed.filter(F.greatest(*[F.col(c) for c in counts], F.lit(0)) > rows_per_task).select("_bucket")
    return counted.withColumn("_bucket", bucket).join(F.broadcast(heavy), "_bucket", "left_semi").drop("_bucket")


def previous(
    df: DataFrame,
    keys: Sequence[str],
    arrival: Arrival,
    values: Sequence[str],
    out: str,
    hot: DataFrame | None = None,
    few: bool = False,
) -> DataFrame:
    """Adds struct ``out``: ``values`` of the row that arrived before within the key, else null.

    Hot keys are windowed per chunk; the first row of a chunk takes the last row of the key's
    chunk before it, from a summary with one row per hot key and chunk. Without hot keys adaptive
    execution drops the summary and its scan. Null keys form one group, as in any window.
    ``hot`` gives the result of :func:`hot_keys` where a cheaper input than ``df`` can tell it. ``few`` says that a key
    has few rows by its nature, such as the id of an order line: then nothing is counted and one window does it.
    """
    if few:
        order = Window.partitionBy(*keys).orderBy(*arrival.order)
        return df.withColumn(out, F.lag(F.struct(*values)).over(order))
    chunk = F.expr(arrival.chunk)
    if hot is None:
        hot = hot_keys(df, keys, arrival.rows_per_task)
    hot = F.broadcast(hot.select(*keys, F.lit(True).alias("_hot")))
    cut = df.join(hot, list(keys), "left").withColumn("_chunk", F.when(F.col("_hot"), chunk)).drop("_hot")
    by_order = Window.partitionBy(*keys, "_chunk").orderBy(*arrival.order)
    inner = cut.withColumn("_inner", F.lag(F.struct(*values)).over(by_order))

    moment = F.struct(*[F.col(c) for c in arrival.order])
    carried = (
        df.join(hot, list(keys), "inner")
        .groupBy(*keys, chunk.alias("_chunk"))
        .agg(F.max_by(F.struct(*values), moment).alias("_last"))
        .withColumn("_carry", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_chunk")))
        .select(*keys, "_chunk", "_carry")
    )
    return (
        inner.join(carried, [*keys, "_chunk"], "left")
        .withColumn(out, F.coalesce("_inner", "_carry"))
        .drop("_inner", "_carry", "_chunk")
    )


def first(
    df: DataFrame,
    keys: Sequence[str],
    arrival: Arrival,
    value: Column,
    out: str,
) -> DataFrame:
    """Adds ``out``: ``value`` of the first row of the key to arrive.

    Hot keys take it from an aggregate (at most ``MAX_HOT_KEYS`` rows, broadcast); the others from
    a window, with hot rows spread over ``chunk`` so that none of them share one task.
    """
    moment = F.struct(*[F.col(c) for c in arrival.order])
    hot = hot_keys(df, keys, arrival.rows_per_task, F.min_by(value, moment).alias("_first"))
    by_order = (
        Window.partitionBy(*keys, "_chunk")
        .orderBy(*arrival.order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        df.join(F.broadcast(hot), list(keys), "left")
        .withColumn("_chunk", F.when(F.col("_rows").isNotNull(), F.expr(arrival.chunk)))
        .withColumn("_own", F.first(value).over(by_order))
        .withColumn(out, F.when(F.col("_rows").isNotNull(), F.col("_first")).otherwise(F.col("_own")))
        .drop("_rows", "_first", "_own", "_chunk")
    )


def equi_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    *,
    right_unique: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
    left_counted: DataFrame | None = None,
) -> DataFrame:
    """Equality join that cuts the rows of a hot key into pieces of about ``rows_per_task``.

    A row of a hot key gets a piece number from a hash of its columns (keep a unique arrival column
    among them, so that copies spread too); the other side's rows of that key are repeated for each
    piece. With ``right_unique`` no key of the right side can be hot and only the left side is cut.
    A ``left`` join needs ``right_unique``: reduce the right side with ``upsert.latest`` first.
    Keys of the left side are counted on ``left_counted`` where that is cheaper to compute.
    """
    if how not in ("inner", "left") or (how == "left" and not right_unique):
        raise ValueError(f"unsupported join: {how}, right_unique={right_unique}")
    keys = list(keys)
    source = left if left_counted is None else left_counted
    counted = source.select(*keys, F.lit(1).alias("_l"), F.lit(0).alias("_r"))
    if not right_unique:
        counted = counted.unionByName(right.select(*keys, F.lit(0).alias("_l"), F.lit(1).alias("_r")))

    def pieces(side: str) -> Column:
        wanted = F.ceil(F.col(side) / rows_per_task)
        return F.greatest(F.lit(1), F.least(wanted, F.lit(MAX_PIECES))).cast("int").alias(side)

    # The keys of a join are many and mostly light: counting each would shuffle them all.
    hot = F.broadcast(
        _in_heavy_buckets(counted, keys, rows_per_task, "_l", "_r").groupBy(*keys)
        .agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
        .filter((F.col("_l") > rows_per_task) | (F.col("_r") > rows_per_task))
        .orderBy(F.desc(F.greatest("_l", "_r")), *keys)
        .limit(MAX_HOT_KEYS)
        .select(*keys, pieces("_l"), pieces("_r"))
    )

    has_null = F.greatest(*[F.col(key).isNull() for key in keys], F.lit(False))

    def cut(df: DataFrame, own: str, other: str) -> DataFrame:
        hashed = [c for c in df.columns if "map<" not in df.schema[c].dataType.simpleString()]
        # Rows with a null key match nothing: the left side's spread freely.
        alone = F.lit(MAX_PIECES if own == "_l" else 1)
        parts = F.when(has_null, alone).otherwise(F.coalesce(F.col(own), F.lit(1)))
        # Only rows of a key in several pieces are hashed.
        piece = F.when(parts > 1, F.pmod(F.xxhash64(*hashed), parts)).otherwise(F.lit(0))
        copies = F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1)
        return (
            df.join(hot, keys, "left")
            .withColumn(own + "_piece", F.coalesce(piece.cast("int"), F.lit(0)))
            .withColumn(other + "_piece", F.explode(copies))
            .drop("_l", "_r")
        )

    on = [*keys, "_l_piece", "_r_piece"]
    return cut(left, "_l", "_r").join(cut(right, "_r", "_l"), on, how).drop("_l_piece", "_r_piece")
