"""Sinks: fact topics, upsert topics, routed topics, dimension tables, aggregate tables, console.

A topic sink is Kafka or files. The file sink of a stream is exactly-once through its checkpoint;
Kafka is at-least-once, so keyed topics are read back through ``upsert.latest``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from rivermill.functions import wire
from rivermill.operators import upsert

ROUTED = "sink_table"


def start(
    df: DataFrame,
    checkpoint: str,
    fmt: str,
    path: str | None = None,
    *,
    options: dict[str, str] | None = None,
    partition_by: Sequence[str] = (),
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Starts a streaming append of ``df``; ``trigger`` defaults to all that is available."""
    writer = df.writeStream.outputMode("append").format(fmt).option("checkpointLocation", checkpoint)
    return _started(writer, path, options, partition_by, trigger, name)


def _started(
    writer: DataStreamWriter, path, options, partition_by, trigger, name
) -> StreamingQuery:
    for key, value in (options or {}).items():
        writer = writer.option(key, value)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    return writer.start(path) if path else writer.start()


def fact_topic(facts: DataFrame, hidden: Sequence[str] = ()) -> DataFrame:
    """Facts as JSON texts in ``value``."""
    return wire.as_json(facts, hidden)


def keyed_topic(
    facts: DataFrame, keys: Sequence[str], hidden: Sequence[str] = (), retracted: Column | None = None
) -> DataFrame:
    """Facts as JSON texts with the primary key in ``key``; a later text of a key replaces it.

    A row that is ``retracted`` has a null text: the key's tombstone.
    """
    shown = [c for c in facts.columns if c not in set(hidden)]
    value = F.to_json(F.struct(*shown))
    if retracted is not None:
        value = F.when(~F.coalesce(retracted, F.lit(False)), value)
    return facts.select(F.to_json(F.struct(*keys)).alias("key"), value.alias("value"))


def console(df: DataFrame, checkpoint: str | None = None, rows: int = 20) -> StreamingQuery | None:
    """Shows the first ``rows`` rows (of a stream, of every micro-batch), for looking at a job; tables are written by the jobs."""
    if not df.isStreaming:
        df.show(rows, truncate=False)
        return None
    writer = df.writeStream.format("console").option("truncate", "false").option("numRows", rows)
    return (writer.option("checkpointLocation", checkpoint) if checkpoint else writer).start()


def write_routed(records: DataFrame, path: str, mode: str = "append") -> None:
    """Batch files of ``(topic, value)``, one directory per topic.

    Rebalancing groups a topic's rows into few files and splits a topic that is too large for one.
    """
    records.hint("rebalance", "topic").write.mode(mode).partitionBy("topic").text(path)


def write_aggregates(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Aggregate rows in snake case, partitioned by processing day."""
    named = wire.to_snake(rows)
    named.hint("rebalance", "cur_date").write.mode(mode).partitionBy("cur_date").parquet(path)


def write_jdbc(rows: DataFrame, url: str, table: str, options: dict[str, str] | None = None) -> None:
    """Aggregate rows into a database table over JDBC, as appends."""
    writer = wire.to_snake(rows).write.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in (options or {}).items():
        writer = writer.option(key, value)
    writer.mode("append").save()


def upsert_changelog(path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer of an append-only changelog of keyed rows.

    Every micro-batch overwrites its own directory, so a repeated batch leaves the same rows.
    Read the table with :func:`read_upserts`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def read_upserts(
    spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Latest row per key of a changelog, later micro-batches first, then ``order`` within one."""
    return upsert.latest(spark.read.parquet(path), keys, ["batch", *order]).drop("batch")


def foreach_batch(
    df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _started(writer, None, None, (), trigger, None)
