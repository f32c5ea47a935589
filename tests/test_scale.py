"""How the work of operators is cut: what one task holds, what is handed on."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import functions as F

import frames
from rivermill.operators import skew, upsert
from rivermill.plans import aggregates


@contextmanager
def settings(spark, **values):
    """Session settings for a while; ``__`` stands for ``.``."""
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_fold_with_drops_spreads_one_table(spark):
    """The rows of one dimension go to all tasks, with drops too."""
    data = F.create_map(F.lit("name"), F.col("id").cast("string"))
    key = (F.col("id") % 50).cast("string").alias("row_key")
    table = F.when(F.col("id") >= 0, "dim").alias("sink_table")
    rows = spark.range(200).select(table, key, F.lit("insert").alias("type"), data.alias("data"), "id")
    drops = rows.filter("id = 20").select("sink_table", F.struct("id").alias("moment"))
    with settings(spark, spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1"):
        folded = upsert.fold_dimensions(rows, ["id"], ["name"], drops).withColumn("part", F.spark_partition_id())
        got = folded.collect()
    assert len({r.part for r in got}) == 2
    assert sorted((r.row_key, r.name) for r in got) == sorted((str(k), str(150 + k)) for k in range(50))


def shuffles(df):
    """Exchanges of a plan that do not broadcast."""
    return [line for line in df._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hash" in line]


def test_words_without_dictionary_are_counted_in_one_shuffle(spark):
    texts = [(0, "An 东京 an x1"), (1, "京 东京a"), (2, " , "), (3, None), (12_000, "AN")]
    rows = spark.createDataFrame(texts, "ts long, item string").select(
        "ts", "item", F.lit("search").alias("last_page_id"), F.lit("keyword").alias("item_type")
    )
    views = aggregates.keyword_views(rows, "20240131")
    assert len(shuffles(views)) == 1
    two_steps = aggregates.word_views(aggregates.atom_views(rows, "20240131"))
    assert frames.rows(views) == frames.rows(two_steps, *views.columns)
    assert [r[4] for r in frames.rows(views) if r[3] == "京"] == [3]


def test_keys_are_counted_only_in_heavy_buckets(spark):
    """Counting for a join hands on no row per key, and cuts hot keys as before."""
    left = spark.range(3000).select((F.when(F.col("id") < 900, 7).otherwise(F.col("id"))).alias("k"), "id")
    right = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    counted = left.select("k", F.lit(1).alias("_l"), F.lit(0).alias("_r"))
    kept = skew._in_heavy_buckets(counted, ["k"], 500, "_l", "_r")
    assert kept.count() < 1000 and kept.filter("k = 7").count() == 900
    assert skew._in_heavy_buckets(counted, ["k"], 900, "_l", "_r").count() == 0
    plain = frames.rows(left.join(right, "k"), "k", "id", "v")
    for size in (1, 500, 5000):
        assert frames.rows(skew.equi_join(left, right, ["k"], rows_per_task=size), "k", "id", "v") == plain
