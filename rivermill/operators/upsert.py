"""Keyed tables from changelogs: latest row per key, and the column-wise dimension fold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row of each key in ``order``.

    Spark keeps only the top row per key and task before the shuffle (WindowGroupLimit), so a hot
    key sends one row per map task.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") == 1).drop("_rank")


def latest_live(df: DataFrame, keys: Sequence[str], order: Sequence[str], deleted: Column) -> DataFrame:
    """Last row of each key, keys whose last row is a deletion left out."""
    return latest(df, keys, order).filter(~F.coalesce(deleted, F.lit(False)))


def fold_dimensions(
    rows: DataFrame,
    order: Sequence[str],
    columns: Sequence[str],
    dropped: DataFrame | None = None,
) -> DataFrame:
    """Current dimension rows ``(sink_table, row_key, *columns)`` of put and delete rows.

    ``rows`` are ``(sink_table, row_key, type, data, *order)``. A put overwrites the columns it
    carries with a value; a null leaves the old value. A delete removes the row. The last non-null
    value of a column survives exactly when it is newer than the row's last delete, so one combining
    aggregate answers it, with no sort of a row's history and one partial row per key and task.
    ``dropped`` gives ``(sink_table, moment)``: rows before ``moment`` (a struct of the order
    columns) were lost when the table was dropped. It is reduced to a row per dimension table and goes to every task:
    a shuffle by table would put a whole dimension into one of them.
    """
    key = ["sink_table", "row_key"]
    moment = F.struct(*[F.col(c) for c in order])
    removes = F.coalesce(F.col("type") == "delete", F.lit(False))
    # Only the values asked for go on, not the whole record.
    values = {c: f"_value{place}" for place, c in enumerate(columns)}
    tagged = rows.filter(F.col("row_key").isNotNull()).select(
        *key, moment.alias("_at"), removes.alias("_removes"), *[F.col("data")[c].alias(v) for c, v in values.items()]
    )
    if dropped is not None:
        barrier = dropped.groupBy("sink_table").agg(F.max("moment").alias("_barrier"))
        lost = F.coalesce(F.col("_at") < F.col("_barrier"), F.lit(False))
        tagged = tagged.join(F.broadcast(barrier), "sink_table", "left").filter(~lost).drop("_barrier")

    def newest(column: str) -> Column:
        value = F.col(values[column])
        put = ~F.col("_removes") & value.isNotNull()
        return F.max(F.when(put, F.struct("_at", value.alias("_value")))).alias(column)

    gone = F.max(F.when(F.col("_removes"), F.col("_at"))).alias("_gone")
    folded = tagged.groupBy(*key).agg(gone, *[newest(c) for c in columns])
    living = [
        F.when(F.col("_gone").isNull() | (F.col(c)["_at"] > F.col("_gone")), F.col(c)["_value"]).alias(c)
        for c in columns
    ]
    present = F.coalesce(*columns).isNotNull() if columns else F.lit(False)
    return folded.select(*key, *living).filter(present)


def merge_dimensions(state: DataFrame | None, rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """The dimension rows ``(sink_table, row_key, data)`` that ``rows`` leave of an earlier ``state`` of the same form.

    What :func:`fold_dimensions` does over a whole history, step by step: every row of ``rows`` is newer than the state, so the state
    needs no moments, and what is read and written follows the keys at hand. ``data`` keeps columns that no rule lists any more.
    """
    key = ["sink_table", "row_key"]
    moment = F.struct(*[F.col(c) for c in order])
    removes = F.coalesce(F.col("type") == "delete", F.lit(False))
    known = rows.filter(F.col("row_key").isNotNull()).select(*key, moment.alias("_at"), removes.alias("_removes"), "data")
    if state is not None:
        at = F.lit(None).cast(known.schema["_at"].dataType)
        known = known.unionByName(state.select(*key, at.alias("_at"), F.lit(False).alias("_removes"), "data"))
    cells = F.map_entries(F.map_filter("data", lambda _, value: value.isNotNull()))
    mark = F.array(F.struct(F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("value")))
    each = known.select(*key, "_at", F.explode(F.when(F.col("_removes"), mark).otherwise(cells)).alias("_cell"))
    newest = each.groupBy(*key, F.col("_cell.key").alias("column")).agg(
        F.max(F.struct(F.col("_at").isNotNull().alias("new"), "_at", F.col("_cell.value").alias("value"))).alias("last")
    )
    gone = F.max(F.when(F.col("column").isNull(), F.struct("last.new", "last._at"))).alias("_gone")
    put = F.when(F.col("column").isNotNull(), F.struct("column", "last"))
    row = newest.groupBy(*key).agg(gone, F.collect_list(put).alias("_puts"))
    living = F.filter(
        "_puts",
        lambda p: F.col("_gone").isNull() | (F.struct(p["last"]["new"], p["last"]["_at"]) > F.col("_gone")),
    )
    data = F.map_from_entries(F.transform(living, lambda p: F.struct(p["column"], p["last"]["value"])))
    return row.select(*key, data.alias("data")).filter(F.size("data") > 0)


def dimension_table(folded: DataFrame, sink_table: str, columns: Sequence[str]) -> DataFrame:
    """All-text table ``(key, *columns)`` of one folded dimension."""
    chosen = folded.filter(F.col("sink_table") == sink_table)
    return chosen.select(F.col("row_key").alias("key"), *columns)
