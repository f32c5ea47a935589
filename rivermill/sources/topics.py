"""Topics as DataFrames: raw text, change records, upsert topics, page facts.

A topic is any source Spark can read. ``kafka`` gives one text per record with its partition and
offset as arrival order; file formats stand in for it offline and for replays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivermill import schemas
from rivermill.config import CHANGE_DELAY, LOG_DELAY
from rivermill.functions import times, wire

FILE_FORMATS = ("text", "json", "parquet", "orc", "csv")


def read_topic(
    spark: SparkSession,
    fmt: str,
    path: str | None = None,
    *,
    stream: bool = False,
    schema=None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Topic texts in ``value``, from the earliest record on; null and empty texts dropped.

    Kafka rows keep ``key``, ``partition`` and ``offset``; a file source keeps its own columns.
    Pass ``maxOffsetsPerTrigger`` or ``maxFilesPerTrigger`` in ``options`` to bound a micro-batch.
    """
    reader = spark.readStream if stream else spark.read
    reader = reader.format(fmt)
    if fmt == "kafka":
        reader = reader.option("startingOffsets", "earliest")
    if schema is not None:
        reader = reader.schema(schema)
    for key, option in (options or {}).items():
        reader = reader.option(key, option)
    raw = reader.load(path) if path else reader.load()
    if fmt == "kafka":
        raw = raw.select(
            F.col("value").cast("string").alias("value"),
            F.col("key").cast("string").alias("key"),
            "topic",
            "partition",
            "offset",
        )
    return non_empty(raw)


def spread(raw: DataFrame) -> DataFrame:
    """Deals rows out to all cores when the input comes in fewer pieces than there are cores.

    For a few files or row groups that cannot be split further; larger inputs are left alone. Needed
    columns and filters still reach the scan below.
    """
    cores = raw.sparkSession.sparkContext.defaultParallelism
    if raw.isStreaming or raw.rdd.getNumPartitions() >= cores:
        return raw
    return raw.repartition(cores)


def non_empty(raw: DataFrame) -> DataFrame:
    """Drops tombstones: records with a null or blank value."""
    return raw.filter(F.col("value").isNotNull() & (F.trim("value") != ""))


def logs(raw: DataFrame, *keep: str) -> DataFrame:
    """Readable behaviour logs; ``ts`` is epoch milliseconds."""
    return all_logs(raw, *keep).filter(F.col("_bad").isNull()).drop("_bad")


def all_logs(raw: DataFrame, *keep: str) -> DataFrame:
    """Like :func:`logs`, with unreadable texts in ``_bad``.

    ``common_text`` and ``page_text`` are the whole objects; ``common`` and ``page`` hold the fields that rules read. Those
    come from the short texts, again behind a generator, so that no filter repeats the parse.
    """

    def known(name: str, schema) -> Column:
        return F.when(F.col(name).startswith("{"), F.from_json(name, schema)).alias(name)

    parsed = wire.parse_all(raw, schemas.LOG, *keep)
    record = F.struct(
        known("common", schemas.COMMON), known("page", schemas.PAGE),
        F.col("common").alias("common_text"), F.col("page").alias("page_text"),
        "start", "err", "displays", "actions", wire.whole(F.col("ts")).alias("ts"),
    )
    return parsed.select(*keep, "_bad", F.inline(F.array(record)))


def changes(raw: DataFrame, *keep: str) -> DataFrame:
    """Change records; ``ts`` is epoch seconds, ``row_time`` its event time, ``proc_time`` now."""
    parsed = wire.parse(raw, schemas.CHANGE, *keep).withColumn("proc_time", F.current_timestamp())
    return with_row_time(parsed.withColumn("ts", wire.whole(F.col("ts"))))


def order_fact_rows(raw: DataFrame, *keep: str) -> DataFrame:
    """Order-detail facts read back from their upsert topic, tombstones skipped; rules and windows set their own event time."""
    parsed = wire.parse(non_empty(raw), schemas.ORDER_FACT, *keep)
    return parsed.withColumn("ts", wire.whole(F.col("ts")))


def order_facts(raw: DataFrame, *keep: str) -> DataFrame:
    """The same with event time and watermark, for joins."""
    return with_row_time(order_fact_rows(raw, *keep))


def with_row_time(df: DataFrame, seconds: Column | str = "ts", delay: str = CHANGE_DELAY) -> DataFrame:
    """Adds ``row_time`` from epoch seconds; on a stream also its watermark."""
    return watermarked(df.withColumn("row_time", times.seconds_to_time(seconds)), "row_time", delay)


def with_log_time(df: DataFrame, millis: Column | str = "ts", delay: str = LOG_DELAY) -> DataFrame:
    """Adds ``row_time`` from epoch milliseconds; on a stream also its watermark."""
    return watermarked(df.withColumn("row_time", times.ms_to_time(millis)), "row_time", delay)


def watermarked(df: DataFrame, column: str, delay: str) -> DataFrame:
    return df.withWatermark(column, delay) if df.isStreaming else df
