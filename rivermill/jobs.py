"""The warehouse as streaming jobs: which topics a job reads, what it does, where it writes.

A job is a streaming DataFrame plus a step run on every micro-batch. Lookups of dimensions and rules
belong to that step, so that each micro-batch sees their current state. Every sink overwrites what an
earlier attempt of the same micro-batch wrote, so a repeated batch leaves no duplicates in files.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rivermill import schemas
from rivermill.config import DATABASE, session
from rivermill.functions import wire
from rivermill.operators import enrich, joins, project, split, upsert
from rivermill.operators.skew import Arrival
from rivermill.plans import aggregates, detail, dimensions
from rivermill.sources import config_log, tables, topics
from rivermill.streaming import processors, sinks

LOG_TOPIC = "topic_log"
CHANGE_TOPIC = "topic_db"
REGISTER_TOPIC = "dwd_user_register"
DIM_RULE_TOPIC = "table_process_dim"
FACT_RULE_TOPIC = "table_process_dwd"

# Bounds of a micro-batch, so that the first one is not the whole topic; ``source_options`` may set others.
MAX_RECORDS = "10000000"
MAX_FILES = "1000"

# Fixed columns of the dimension tables the jobs look up.
DIMENSION_COLUMNS = {
    "dim_sku_info": ("category3_id", "tm_id", "spu_id", "sku_name"),
    "dim_spu_info": ("spu_name",),
    "dim_base_trademark": ("tm_name",),
    "dim_base_category3": ("name", "category2_id"),
    "dim_base_category2": ("name", "category1_id"),
    "dim_base_category1": ("name",),
    "dim_base_province": ("name",),
    "dim_base_dic": ("dic_name",),
}

USER = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "create_time")])
CART = T.StructType([T.StructField(c, T.StringType()) for c in (*schemas.CART_COLUMNS, "ts")])


@dataclass(frozen=True)
class Warehouse:
    """Where topics, dimensions and results live.

    Without ``kafka`` options topics are text files under ``root``, one directory per topic. Rows of
    file topics carry no offset: they arrive by event time, then by their ``seq`` field if they have one. ``finite`` runs every job to
    the end of its present input. ``words`` is the dictionary of search words, in a column ``word``.
    ``database`` is the source database whose change records count. ``rule_snapshots`` gives, by rule
    topic, the rules that stood before its first change.
    """

    spark: SparkSession
    root: str
    kafka: dict[str, str] | None = None
    day: str | None = None
    finite: bool = False
    words: DataFrame | None = None
    database: str = DATABASE
    rule_snapshots: dict[str, DataFrame] = field(default_factory=dict)
    source_options: dict[str, str] = field(default_factory=dict)

    @property
    def checkpoints(self) -> str:
        """This warehouse's part of the cluster's shared folder, or of ``root`` if none is named."""
        shared = self.spark.conf.get("spark.checkpoint.dir", None)
        name = re.sub(r"\W+", "_", self.root).strip("_")
        return f"{shared}/streams/{name}" if shared else f"{self.root}/checkpoints"

    @property
    def arrival(self) -> Arrival:
        if self.kafka is not None:
            return Arrival.by_offset(finite=self.finite)
        return Arrival(("ts", "seq"), "ts div 60000", finite=self.finite)

    @property
    def kept(self) -> tuple[str, ...]:
        """Arrival columns that are not fields of the records themselves."""
        return tuple(c for c in self.arrival.order if c != "ts")

    def read(self, topic: str, stream: bool = True, bounded: bool = True) -> DataFrame:
        """A topic's texts; unless ``bounded``, a micro-batch takes all that is there."""
        limits = ("maxoffsetspertrigger", "maxfilespertrigger")
        own = {k: v for k, v in self.source_options.items() if bounded or k.lower() not in limits}
        if self.kafka is not None:
            options = {**({"maxOffsetsPerTrigger": MAX_RECORDS} if bounded else {}), **self.kafka, **own, "subscribe": topic}
            return topics.read_topic(self.spark, "kafka", stream=stream, options=options)
        options = {**({"maxFilesPerTrigger": MAX_FILES} if bounded else {}), **own}
        raw = topics.read_topic(self.spark, "text", self.topic_path(topic), stream=stream, options=options)
        return raw.select("value", F.get_json_object("value", "$.seq").try_cast("bigint").alias("seq"))

    def topic_path(self, topic: str) -> str:
        return f"{self.root}/topics/topic={topic}"

    def write_topics(self, records: DataFrame, job: str, batch_id: int) -> None:
        """Writes ``(topic, value)`` and optionally ``key``."""
        if self.kafka is not None:
            records.write.format("kafka").options(**self.kafka).save()
            return
        placed = records.select("value", "topic", F.lit(job).alias("job"), F.lit(batch_id).alias("batch"))
        writer = placed.hint("rebalance", "topic").write.mode("overwrite")
        writer = writer.option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("topic", "job", "batch").text(f"{self.root}/topics")

    def write_table(self, rows: DataFrame, table: str, batch_id: int) -> None:
        named = wire.to_snake(rows).withColumn("batch", F.lit(batch_id))
        # A micro-batch has few aggregate rows: they go into few files, not one per shuffle partition.
        merged = named.hint("rebalance", "cur_date")
        writer = merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("cur_date", "batch").parquet(self.table_path(table))

    def table_path(self, table: str) -> str:
        return f"{self.root}/tables/{table}"

    @property
    def store(self) -> dimensions.BucketedStore:
        return dimensions.BucketedStore(self.spark, f"{self.root}/dimensions")

    def dimension(self, table: str, keys: DataFrame | None = None) -> DataFrame:
        """Current rows of a dimension; with ``keys``, those in the buckets of the keys of a micro-batch."""
        if keys is None:
            return self.store.table(table, DIMENSION_COLUMNS[table])
        return self.store.read_keys(table, DIMENSION_COLUMNS[table], keys)

    def dictionary(self) -> DataFrame:
        named = self.dimension(tables.DICTIONARY)
        return named.select(F.col("key").alias("rowkey"), F.struct("dic_name").alias("info"))

    def rule_changes(self, topic: str, row: T.StructType) -> DataFrame:
        """Rule changelog; without offsets its rows carry a ``seq`` field of their own."""
        changes = config_log.envelopes(self.read(topic, stream=False), row, *self.rule_order)
        initial = self.rule_snapshots.get(topic)
        if initial is None:
            return changes
        return config_log.with_snapshot(initial.withColumn("op", F.lit("r")), changes, self.rule_order)

    def rules(self, topic: str, key: Sequence[str]) -> config_log.RuleStore:
        return config_log.RuleStore(
            self.spark, f"{self.root}/rules/{topic}", key, self.rule_order, self.rule_snapshots.get(topic)
        )

    @property
    def rule_order(self) -> tuple[str, ...]:
        return ("partition", "offset") if self.kafka is not None else ("seq",)


Step = Callable[[Warehouse, DataFrame, int], None]


@dataclass(frozen=True)
class Job:
    stream: Callable[[Warehouse], DataFrame]
    step: Step


def start(name: str, warehouse: Warehouse, trigger: dict | None = None) -> StreamingQuery:
    """Starts a job; without ``trigger`` a finite warehouse runs it over what is available."""
    job = JOBS[name]
    if trigger is None:
        trigger = {"availableNow": True} if warehouse.finite else {"processingTime": "10 seconds"}

    def step(batch: DataFrame, batch_id: int) -> None:
        job.step(warehouse, batch, batch_id)

    return sinks.foreach_batch(
        job.stream(warehouse), step, f"{warehouse.checkpoints}/{name}", trigger
    )


def _changes(w: Warehouse) -> DataFrame:
    changes = topics.changes(w.read(CHANGE_TOPIC), *w.kept).filter(F.col("database") == w.database)
    return changes.withColumn("database", F.lit(DATABASE))


def _pages(w: Warehouse) -> DataFrame:
    logs = topics.logs(w.read(split.TOPICS["page"]), *w.kept)
    return detail.page_rows(logs, *w.kept)


def _order_facts(w: Warehouse) -> DataFrame:
    return topics.order_facts(w.read("dwd_trade_order_detail"), *w.kept)


def _order_fact_rows(w: Warehouse) -> DataFrame:
    return topics.order_fact_rows(w.read("dwd_trade_order_detail"), *w.kept)


def _as_topic(topic: str, *hidden: str) -> Callable[[Warehouse, DataFrame], DataFrame]:
    def records(_: Warehouse, batch: DataFrame) -> DataFrame:
        return sinks.fact_topic(batch, hidden).withColumn("topic", F.lit(topic))

    return records


def _as_keyed_topic(topic: str, *hidden: str) -> Callable[[Warehouse, DataFrame], DataFrame]:
    def records(_: Warehouse, batch: DataFrame) -> DataFrame:
        return sinks.keyed_topic(batch, ["id"], hidden).withColumn("topic", F.lit(topic))

    return records


def _order_changes(w: Warehouse, batch: DataFrame) -> DataFrame:
    """The changelog of order lines; where the topic numbers no records, a line's versions order its texts."""
    facts = batch.drop(*w.kept)
    if w.kafka is None:
        facts = facts.withColumn("seq", F.col("version"))
    sent = sinks.keyed_topic(facts, ["id"], ("op", "version"), F.col("op") == processors.RETRACT)
    return sent.withColumn("topic", F.lit("dwd_trade_order_detail"))


def _to_topics(name: str, *steps: Callable[[Warehouse, DataFrame], DataFrame]) -> Step:
    def step(w: Warehouse, batch: DataFrame, batch_id: int) -> None:
        for one in steps:
            batch = one(w, batch)
        w.write_topics(batch, name, batch_id)

    return step


def _to_table(table: str, *steps: Callable[[Warehouse, DataFrame], DataFrame]) -> Step:
    def step(w: Warehouse, batch: DataFrame, batch_id: int) -> None:
        # Lookups read the micro-batch's keys before its rows: it is computed, and its state committed, once.
        kept = batch.persist()
        try:
            out = kept
            for one in steps:
                out = one(w, out)
            w.write_table(out, table, batch_id)
        finally:
            kept.unpersist()

    return step


def _with_rules(topic: str, row: T.StructType) -> Callable[[Warehouse], DataFrame]:
    """Change records in ``record`` and rule changes in ``rule``, as one stream: every rule change is read once."""

    def stream(w: Warehouse) -> DataFrame:
        records = _changes(w).select(F.struct("*").alias("record"))
        changed = config_log.dated(w.read(topic, bounded=False), row, *w.rule_order).select(F.struct("*").alias("rule"))
        return records.unionByName(changed, allowMissingColumns=True)

    return stream


def _by_rules(
    topic: str, key: Sequence[str], use: Callable[[Warehouse, DataFrame, DataFrame, DataFrame, int], None]
) -> Step:
    """Splits a micro-batch into records and rule changes, and hands on the rule versions that its records may meet."""

    def step(w: Warehouse, batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            changed = kept.filter("rule is not null").select("rule.*")
            versions = w.rules(topic, key).take(changed, batch_id)
            use(w, kept.filter("record is not null").select("record.*"), changed, versions, batch_id)
        finally:
            kept.unpersist()

    return step


def _keep_dimensions(w: Warehouse, records: DataFrame, changed: DataFrame, versions: DataFrame, batch_id: int) -> None:
    w.store.write_live(records, changed, versions, w.arrival.order, w.rule_order, F.col("ts") * 1000, batch_id)


def _route_facts(w: Warehouse, records: DataFrame, _: DataFrame, versions: DataFrame, batch_id: int) -> None:
    w.write_topics(detail.routed_facts(records, versions, at=F.col("ts") * 1000), "dwd_base_db", batch_id)


def _paid_lines(w: Warehouse) -> DataFrame:
    return joins.paid_lines(project.payments(_changes(w), "row_time"), _order_facts(w))


def _users(w: Warehouse) -> DataFrame:
    return wire.parse(w.read(REGISTER_TOPIC), USER)


def _cart_adds(w: Warehouse) -> DataFrame:
    adds = wire.parse(w.read("dwd_trade_cart_add"), CART, *w.kept)
    return adds.withColumn("ts", wire.whole(F.col("ts")))


def _sku_dims(w: Warehouse, batch: DataFrame) -> dict[str, DataFrame]:
    """The product's dimensions; products themselves, which are many, by the keys of the micro-batch."""
    dims = {table: w.dimension(table) for table in tables.SKU_DIMENSIONS if table != "dim_sku_info"}
    return {"dim_sku_info": w.dimension("dim_sku_info", batch.select("sku_id")), **dims}


JOBS: dict[str, Job] = {
    "dim_app": Job(
        _with_rules(DIM_RULE_TOPIC, schemas.DIM_RULE), _by_rules(DIM_RULE_TOPIC, config_log.DIM_KEY, _keep_dimensions)
    ),
    "dwd_base_log": Job(
        lambda w: detail.log_records(topics.all_logs(w.read(LOG_TOPIC), *w.kept), w.arrival),
        _to_topics("dwd_base_log"),
    ),
    "dwd_base_db": Job(
        _with_rules(FACT_RULE_TOPIC, schemas.FACT_RULE), _by_rules(FACT_RULE_TOPIC, config_log.FACT_KEY, _route_facts)
    ),
    "dwd_interaction_comment_info": Job(
        lambda w: project.comments(_changes(w)),
        _to_topics(
            "comments",
            lambda w, batch: detail.named_comments(batch, w.dictionary()),
            _as_topic("dwd_interaction_comment_info"),
        ),
    ),
    "dwd_trade_cart_add": Job(
        lambda w: detail.cart_facts(_changes(w)), _to_topics("cart", _as_topic("dwd_trade_cart_add"))
    ),
    "dwd_trade_order_detail": Job(
        lambda w: detail.order_changelog(_changes(w), w.arrival), _to_topics("orders", _order_changes)
    ),
    "dwd_trade_order_pay_suc_detail": Job(
        _paid_lines,
        _to_topics(
            "payments",
            # A line that was corrected pays once: its last version in the micro-batch.
            lambda w, batch: upsert.latest(batch, ["id"], w.kept),
            lambda w, batch: detail.named_payments(batch, w.dictionary()),
            _as_keyed_topic("dwd_trade_order_payment_success"),
        ),
    ),
    "dws_traffic_source_keyword_page_view_window": Job(
        lambda w: aggregates.atom_views(_pages(w), w.day),
        _to_table(
            "dws_traffic_source_keyword_page_view_window",
            lambda w, batch: aggregates.word_views(batch, w.words),
        ),
    ),
    "dws_traffic_vc_ch_ar_is_new_page_view_window": Job(
        lambda w: aggregates.traffic(_pages(w), w.arrival, w.day),
        _to_table("dws_traffic_vc_ch_ar_is_new_page_view_window"),
    ),
    "dws_traffic_home_detail_page_view_window": Job(
        lambda w: aggregates.home_detail(_pages(w), w.arrival, w.day),
        _to_table("dws_traffic_home_detail_page_view_window"),
    ),
    "dws_user_user_login_window": Job(
        lambda w: aggregates.logins(_pages(w), w.arrival, w.day),
        _to_table("dws_user_user_login_window"),
    ),
    "dws_user_user_register_window": Job(
        lambda w: aggregates.registrations(_users(w), w.day),
        _to_table("dws_user_user_register_window"),
    ),
    "dws_trade_cart_add_uu_window": Job(
        lambda w: aggregates.cart_adders(_cart_adds(w), w.arrival, w.day),
        _to_table("dws_trade_cart_add_uu_window"),
    ),
    "dws_trade_sku_order_window": Job(
        lambda w: aggregates.sku_amounts(_order_fact_rows(w), w.arrival, w.day),
        _to_table(
            "dws_trade_sku_order_window", lambda w, batch: enrich.sku_snowflake(batch, _sku_dims(w, batch))
        ),
    ),
    "dws_trade_sku_order_window_sync": Job(
        lambda w: aggregates.sku_amounts(_order_fact_rows(w), w.arrival, w.day),
        _to_table(
            "dws_trade_sku_order_window_sync", lambda w, batch: enrich.sku_names(batch, _sku_dims(w, batch))
        ),
    ),
    "dws_trade_province_order_window": Job(
        lambda w: aggregates.province_amounts(_order_fact_rows(w), w.arrival, w.day),
        _to_table(
            "dws_trade_province_order_window",
            lambda w, batch: enrich.province_names(
                batch, w.dimension(tables.PROVINCES, batch.select("province_id"))
            ),
        ),
    ),
}


def main(argv: list[str] | None = None) -> None:
    """``python -m rivermill.jobs <job> <root> [kafka.option=value ...]``"""
    name, root, *options = sys.argv[1:] if argv is None else argv
    kafka = dict(option.split("=", 1) for option in options) or None
    warehouse = Warehouse(session(name), root, kafka=kafka, finite=kafka is None)
    start(name, warehouse).awaitTermination()


if __name__ == "__main__":
    main()
