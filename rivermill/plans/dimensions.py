"""Dimension maintenance: change records and rules in, folded dimension tables out."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivermill.operators import clean, routing, upsert
from rivermill.sources import config_log, tables


def dimension_rows(changes: DataFrame, rules: DataFrame, *keep: str, at: Column | None = None) -> DataFrame:
    """Clean, routed and pruned dimension rows ``(sink_table, row_key, type, data)``; with ``at``, by the versions of that moment."""
    return routing.route_dimensions(clean.clean_dimension_changes(changes), rules, *keep, at=at)


def dimension_state(changes: DataFrame, rules: DataFrame, order: Sequence[str]) -> DataFrame:
    """All dimension tables in one, with the columns any rule lists."""
    listed = rules.select(F.explode(F.split("sink_columns", ",")).alias("column"))
    return upsert.fold_dimensions(dimension_rows(changes, rules, *order), order, _names(listed))


def _names(columns: DataFrame) -> list[str]:
    """Distinct column names, of which there are as many as the rules list."""
    return sorted(row[0] for row in columns.distinct().collect())


class DimensionStore:
    """Dimension tables kept as one changelog of routed rows, folded when read.

    Appending is idempotent per micro-batch and needs no merge; dropping a table is a row too.
    ``compact`` writes the fold as a new store, to bound what readers fold.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.rows_path = f"{path}/rows"
        self.drops_path = f"{path}/drops"

    def write_batch(
        self,
        rule_changes: Callable[[], DataFrame],
        order: Sequence[str],
        rule_order: Sequence[str],
    ) -> Callable[[DataFrame, int], None]:
        """``foreachBatch`` function for a stream of change records with ``order`` columns.

        ``rule_changes`` reads the rule changelog anew for every micro-batch; its changes take
        effect before the batch's rows.
        """

        def write(batch: DataFrame, batch_id: int) -> None:
            # One reading serves drops and rows, so that both see the same rules.
            changes = rule_changes().persist()
            try:
                self.apply_rules(changes, rule_order, batch_id)
                rows = dimension_rows(batch, rules_in_force(changes, rule_order), *order)
                self._append(rows.withColumn("moment", F.struct(*order)), batch_id)
            finally:
                changes.unpersist()

        return write

    def write_live(
        self, batch: DataFrame, rule_changes: DataFrame, versions: DataFrame, order: Sequence[str], rule_order: Sequence[str],
        at: Column, batch_id: int,
    ) -> None:
        """Writes a micro-batch by the rule versions in force ``at`` each record's moment.

        ``rule_changes`` are those of the micro-batch (``config_log.dated``). A rule that drops a table inside it takes the
        table's rows of earlier moments with it, those of the same micro-batch too.
        """
        self.apply_rules(rule_changes, rule_order, batch_id)
        moment = F.coalesce(at, F.lit(routing.BEGINNING))
        rows = dimension_rows(batch.withColumn("_moment", moment), versions, *order, "_moment", at=F.col("_moment"))
        ended = config_log.dropped_tables(rule_changes, ["since"]).groupBy("sink_table").agg(F.max("moment.since").alias("_ended"))
        kept = rows.join(ended, "sink_table", "left").filter(F.col("_ended").isNull() | (F.col("_moment") >= F.col("_ended")))
        self._append(kept.drop("_ended", "_moment").withColumn("moment", F.struct(*order)), batch_id)

    def apply_rules(self, changes: DataFrame, order: Sequence[str], batch_id: int) -> None:
        """Records the tables that rule changes drop or make anew, each change once.

        A drop removes the rows of all batches before ``batch_id``.
        """
        drops = config_log.dropped_tables(changes, order).withColumnRenamed("moment", "change")
        known = self._recorded_drops()
        if known is not None:
            earlier = known.filter(F.col("batch") < batch_id).select("sink_table", "change")
            drops = drops.join(earlier, ["sink_table", "change"], "left_anti")
        drops.write.mode("overwrite").parquet(f"{self.drops_path}/batch={batch_id}")

    def _append(self, rows: DataFrame, batch_id: int) -> None:
        rows = rows.select("sink_table", "row_key", "type", "data", "moment")
        writer = rows.hint("rebalance", "sink_table").write.mode("overwrite")
        writer.partitionBy("sink_table").parquet(f"{self.rows_path}/batch={batch_id}")

    def state(self, columns: Sequence[str], sink_table: str | None = None) -> DataFrame:
        """Folded rows; for one table only its own directories are read. Before the first batch there are none."""
        rows = tables.stored(self.spark, self.rows_path)
        if rows is None:
            texts = ", ".join(f"`{c}` string" for c in ("sink_table", "row_key", *columns))
            return self.spark.createDataFrame([], texts)
        if sink_table:
            rows = rows.filter(F.col("sink_table") == sink_table)
        return upsert.fold_dimensions(rows, ["batch", "moment"], columns, self._drops(rows))

    def _recorded_drops(self) -> DataFrame | None:
        return tables.stored(self.spark, self.drops_path)

    def _drops(self, rows: DataFrame) -> DataFrame | None:
        drops = self._recorded_drops()
        if drops is None:
            return None
        # Nulls sort first: the moment before every row of the batch.
        start = F.lit(None).cast(rows.schema["moment"].dataType).alias("moment")
        return drops.select("sink_table", F.struct("batch", start).alias("moment"))

    def table(self, sink_table: str, columns: Sequence[str]) -> DataFrame:
        return upsert.dimension_table(self.state(columns, sink_table), sink_table, columns)

    def compact(self, path: str) -> DimensionStore:
        """Writes the current state as the first batch of a new store at ``path``."""
        stored = self.spark.read.parquet(self.rows_path)
        moment = stored.schema["moment"].dataType
        columns = _names(stored.select(F.explode(F.map_keys("data"))))
        data = F.create_map(*[part for c in columns for part in (F.lit(c), F.col(c))])
        rows = self.state(columns).select(
            "sink_table", "row_key", F.lit("bootstrap-insert").alias("type"), data.alias("data")
        )
        target = DimensionStore(self.spark, path)
        target._append(rows.withColumn("moment", F.lit(None).cast(moment)), 0)
        # Rule changes that were applied stay known, or the next batch would apply them to the rows written here.
        drops = self._recorded_drops()
        if drops is not None:
            known = drops.select("sink_table", "change").distinct()
            known.write.mode("overwrite").parquet(f"{target.drops_path}/batch=0")
        return target


class BucketedStore(DimensionStore):
    """Dimension tables as current rows in buckets of their keys, one version of a bucket for each micro-batch that touched it.

    A micro-batch reads the last version of its keys' buckets, merges its rows into it and writes those buckets anew, so its cost
    follows its keys and no reader folds history. The index of a version names, for every bucket, the version that holds its
    rows: a read as of an earlier version sees the tables as they were. A micro-batch that is repeated reads what it read before
    and overwrites what it wrote. The index has a row per table and bucket, which is what comes to the driver.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64) -> None:
        super().__init__(spark, path)
        self.state_path, self.index_path, self.buckets = f"{path}/state", f"{path}/index", buckets

    def _bucket(self, key: str) -> Column:
        return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(self.buckets)).cast("int")

    def index(self, version: int | None = None) -> dict[tuple[str, int], int]:
        """The version that holds each bucket's rows, as of ``version`` (the last one if none is named)."""
        written = tables.stored(self.spark, self.index_path)
        if written is None:
            return {}
        asked = written if version is None else written.filter(F.col("version") <= version)
        last = asked.agg(F.max("version")).first()[0]
        rows = asked.filter((F.col("version") == last) & F.col("sink_table").isNotNull()).collect()
        return {(r["sink_table"], r["bucket"]): r["held"] for r in rows}

    def _append(self, rows: DataFrame, batch_id: int) -> None:
        placed = rows.filter(F.col("row_key").isNotNull()).withColumn("bucket", self._bucket("row_key")).persist()
        try:
            touched = {tuple(r) for r in placed.select("sink_table", "bucket").distinct().collect()}
            held = self.index(batch_id - 1)
            for table in self._dropped_at(batch_id):
                held = {place: version for place, version in held.items() if place[0] != table}
            old = self._rows({place: held[place] for place in touched if place in held})
            merged = upsert.merge_dimensions(old, placed, ["moment"]).withColumn("bucket", self._bucket("row_key"))
            out = f"{self.state_path}/version={batch_id}"
            merged.hint("rebalance", "sink_table", "bucket").write.mode("overwrite").partitionBy(
                "sink_table", "bucket"
            ).parquet(out)
        finally:
            placed.unpersist()
        filled = tables.stored(self.spark, out)
        now = set() if filled is None else {tuple(r) for r in filled.select("sink_table", "bucket").distinct().collect()}
        held = {place: version for place, version in held.items() if place not in touched} | dict.fromkeys(now, batch_id)
        # A version without any rows has one row without a table.
        listed = [(*place, version) for place, version in sorted(held.items())] or [(None, None, batch_id)]
        named = self.spark.createDataFrame(listed, "sink_table string, bucket int, held bigint")
        named.coalesce(1).write.mode("overwrite").parquet(f"{self.index_path}/version={batch_id}")

    def _dropped_at(self, batch_id: int) -> list[str]:
        drops = self._recorded_drops()
        if drops is None:
            return []
        return [r[0] for r in drops.filter(F.col("batch") == batch_id).select("sink_table").distinct().collect()]

    def _rows(self, places: dict[tuple[str, int], int]) -> DataFrame | None:
        """Rows of buckets in the versions that hold them; only their directories are read."""
        if not places:
            return None
        paths = [
            f"{self.state_path}/version={version}/sink_table={table}/bucket={bucket}"
            for (table, bucket), version in sorted(places.items())
        ]
        return self.spark.read.schema(STORED).option("basePath", self.state_path).parquet(*paths)

    def state(self, columns: Sequence[str], sink_table: str | None = None, version: int | None = None) -> DataFrame:
        places = self.index(version)
        return self._shown({p: v for p, v in places.items() if sink_table in (None, p[0])}, columns)

    def _shown(self, places: dict[tuple[str, int], int], columns: Sequence[str]) -> DataFrame:
        rows = self._rows(places)
        if rows is None:
            rows = self.spark.createDataFrame([], STORED)
        return rows.select("sink_table", "row_key", *[F.col("data")[c].alias(c) for c in columns])

    def read_keys(
        self, sink_table: str, columns: Sequence[str], keys: DataFrame, version: int | None = None
    ) -> DataFrame:
        """The table's rows ``(key, *columns)`` in the buckets of ``keys`` (its first column), for a join on them."""
        wanted = {r[0] for r in keys.select(self._bucket(keys.columns[0])).distinct().collect()}
        places = {p: v for p, v in self.index(version).items() if p[0] == sink_table and p[1] in wanted}
        return upsert.dimension_table(self._shown(places, columns), sink_table, columns)

    def compact(self, path: str) -> DimensionStore:
        """The last version of all buckets as the first of a new store at ``path``."""
        target = BucketedStore(self.spark, path, self.buckets)
        rows = self._rows(self.index())
        moment = F.struct(F.lit(None).cast("bigint").alias("at"))
        if rows is not None:
            target._append(rows.select("sink_table", "row_key", F.lit("bootstrap-insert").alias("type"), "data", moment.alias("moment")), 0)
        drops = self._recorded_drops()
        if drops is not None:
            drops.select("sink_table", "change").distinct().write.mode("overwrite").parquet(f"{target.drops_path}/batch=0")
        return target


STORED = "row_key string, data map<string, string>, version bigint, sink_table string, bucket int"


def rules_in_force(envelopes: DataFrame, order: Sequence[str]) -> DataFrame:
    return config_log.rules(envelopes, config_log.DIM_KEY, order)
