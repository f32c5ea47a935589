"""Hot keys are cut, results are not: small pieces against a plain computation in Python."""

from __future__ import annotations

import random

import pytest
from frames import rows

from rivermill.operators import joins, skew, upsert
from rivermill.operators.skew import Arrival
from pyspark.sql import functions as F


def skewed(n=400, seed=3):
    """A third of the rows in one key; arrival numbers unique, with gaps."""
    rng = random.Random(seed)
    seqs = sorted(rng.sample(range(5 * n), n))
    return [(s, "hot" if rng.random() < 0.34 else f"k{rng.randrange(60)}", rng.randrange(9)) for s in seqs]


@pytest.mark.parametrize("rows_per_task", [1, 7, 50, 10_000])
def test_previous(spark, rows_per_task):
    data = skewed()
    df = spark.createDataFrame(data, "seq bigint, k string, v int").repartition(3)
    arrival = Arrival.by_number("seq", rows_per_task)
    got = skew.previous(df, ["k"], arrival, ["v"], "b").select("seq", F.col("b.v").alias("b"))
    last, want = {}, []
    for seq, k, v in data:
        want.append((seq, last.get(k)))
        last[k] = v
    assert rows(got) == sorted(want, key=repr)


@pytest.mark.parametrize("rows_per_task", [1, 20, 10_000])
def test_first(spark, rows_per_task):
    data = skewed()
    df = spark.createDataFrame(data, "seq bigint, k string, v int").repartition(3)
    got = skew.first(df, ["k"], Arrival.by_number("seq", rows_per_task), F.col("v") * 2, "f")
    first = {}
    for _, k, v in data:
        first.setdefault(k, v * 2)
    assert rows(got, "seq", "f") == sorted(((s, first[k]) for s, k, _ in data), key=repr)


@pytest.mark.parametrize("rows_per_task", [5, 10_000])
def test_inner_join_hot_on_both_sides(spark, rows_per_task):
    left, right = skewed(120, 1), skewed(90, 2)
    l = spark.createDataFrame(left, "seq bigint, k string, v int")
    r = spark.createDataFrame([(s, k) for s, k, _ in right], "other bigint, k string")
    got = skew.equi_join(l, r, ["k"], rows_per_task=rows_per_task)
    want = [(a, b) for a, ka, _ in left for b, kb, _ in right if ka == kb]
    assert rows(got, "seq", "other") == sorted(want, key=repr)


@pytest.mark.parametrize("rows_per_task", [5, 10_000])
def test_left_join_keeps_all_rows(spark, rows_per_task):
    left = [(s, None if s % 11 == 0 else k, v) for s, k, v in skewed(150)]
    l = spark.createDataFrame(left, "seq bigint, k string, v int")
    r = spark.createDataFrame([("hot", 1), ("k1", 2)], "k string, w int")
    got = skew.equi_join(l, r, ["k"], "left", right_unique=True, rows_per_task=rows_per_task)
    want = [(s, {"hot": 1, "k1": 2}.get(k)) for s, k, _ in left]
    assert rows(got, "seq", "w") == sorted(want, key=repr)


def test_left_join_needs_a_unique_right_side(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        skew.equi_join(df, df, ["id"], "left")


def test_latest(spark):
    data = skewed()
    df = spark.createDataFrame(data, "seq bigint, k string, v int").repartition(3)
    last = {k: (s, k, v) for s, k, v in data}
    assert rows(upsert.latest(df, ["k"], ["seq"])) == sorted(last.values(), key=repr)


@pytest.mark.parametrize("rows_per_task", [4, 10_000])
def test_paid_lines_against_all_pairs(spark, rows_per_task):
    rng = random.Random(5)
    pays = [(f"o{rng.choice([0, 0, 1, 2])}", rng.randrange(4000)) for _ in range(60)]
    lines = [(i, f"o{rng.choice([0, 0, 1, 2])}", rng.randrange(4000)) for i in range(60)]
    lines += [(100, "edge", 2000)]
    pays += [("edge", 2005), ("edge", 2006), ("edge", 1100), ("edge", 1099)]
    p = spark.createDataFrame(pays, "order_id string, ts bigint").selectExpr(
        "order_id", "'u' AS user_id", "'x' AS payment_type", "'c' AS callback_time", "ts",
        "timestamp_seconds(ts) AS row_time",
    )
    o = spark.createDataFrame(lines, "id int, order_id string, ts bigint").selectExpr(
        "id", "order_id", "'v' AS user_id", "ts", "timestamp_seconds(ts) AS row_time"
    )
    got = joins.paid_lines(p, o, rows_per_task=rows_per_task)
    want = [(i, ko, tp) for ko, tp in pays for i, kl, tl in lines if ko == kl and tl - 900 <= tp <= tl + 5]
    assert rows(got, "id", "order_id", "ts") == sorted(want, key=repr)
    assert [r for r in rows(got, "id", "ts") if r[0] == 100] == [(100, 1100), (100, 2005)]
