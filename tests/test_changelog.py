"""The order join as a changelog: early rows, retractions, corrected rows; streams give what batch gives, in any cut."""

from __future__ import annotations

import json
import random
import time

import pytest
from frames import rows
from pyspark.sql import functions as F

from rivermill.config import DATABASE
from rivermill.operators import deltas, joins
from rivermill.operators.skew import Arrival
from rivermill.plans import detail
from rivermill.streaming import sinks

SCHEMA = "database string, table string, type string, data map<string,string>, old map<string,string>, ts bigint, seq bigint"
ARRIVAL = Arrival.by_number("seq", finite=True)
SHOWN = ("id", "op", "version", "order_id", "user_id", "activity_id", "coupon_id", "split_total_amount", "seq")


def line(id_, order, amount="10.00"):
    return "order_detail", {"id": id_, "order_id": order, "sku_id": "s1", "split_total_amount": amount}


def order(id_, user="u1"):
    return "order_info", {"id": id_, "user_id": user, "province_id": "p1"}


def activity(line_id, id_="a1"):
    return "order_detail_activity", {"order_detail_id": line_id, "activity_id": id_, "activity_rule_id": "r1"}


def coupon(line_id, id_="c1"):
    return "order_detail_coupon", {"order_detail_id": line_id, "coupon_id": id_}


def records(*made):
    return [(DATABASE, table, "insert", data, None, 1_704_067_200 + n, n) for n, (table, data) in enumerate(made)]


def told(spark, *made):
    changes = detail.order_changelog(spark.createDataFrame(records(*made), SCHEMA), ARRIVAL)
    return [tuple(r) for r in changes.select("op", "activity_id", "coupon_id", "split_total_amount").orderBy("id", "version").collect()]


def test_early_row_retraction_and_corrected_row(spark):
    assert told(spark, line("1", "o"), order("o"), activity("1"), coupon("1")) == [
        ("insert", None, None, "10.00"),
        ("retract", None, None, "10.00"),
        ("reinsert", "a1", None, "10.00"),
        ("retract", "a1", None, "10.00"),
        ("reinsert", "a1", "c1", "10.00"),
    ]


def test_nothing_before_the_order_and_nothing_for_no_change(spark):
    assert told(spark, activity("1"), line("1", "o"), coupon("2")) == []
    assert told(spark, activity("1"), line("1", "o"), order("o"), activity("1")) == [("insert", "a1", None, "10.00")]
    assert told(spark, order("o"), line("1", "o"), line("1", "o", "12.00")) == [
        ("insert", None, None, "10.00"), ("retract", None, None, "10.00"), ("reinsert", None, None, "12.00"),
    ]
    assert told(spark, line(None, "o"), line("1", None), order("o"), order(None)) == []


def test_tombstones(spark):
    changes = detail.order_changelog(
        spark.createDataFrame(records(line("1", "o"), order("o"), coupon("1")), SCHEMA), ARRIVAL
    )
    sent = sinks.keyed_topic(changes, ["id"], ("op", "version", "seq"), F.col("op") == "retract")
    texts = [tuple(r) for r in sent.select("key", "value").collect()]
    assert sorted(key for key, _ in texts) == ['{"id":"1"}'] * 3
    assert [value is None for _, value in texts].count(True) == 1
    assert {json.loads(v).get("coupon_id") for _, v in texts if v} == {None, "c1"}


def shuffled(seed, orders=12):
    """Lines of many orders with re-sent lines and orders, activities and coupons, in random order of arrival."""
    pick = random.Random(seed)
    made = []
    for o in range(orders):
        made += [order(f"o{o}", f"u{n}") for n in range(pick.choice((0, 1, 1, 1, 2)))]
        for n in range(pick.randint(1, 4)):
            name = f"{o}-{n}"
            made += [line(name, f"o{o}", f"{pick.randint(1, 9)}.00") for _ in range(pick.choice((1, 1, 2)))]
            made += [activity(name, f"a{k}") for k in range(pick.choice((0, 1, 2)))]
            made += [coupon(name) for _ in range(pick.choice((0, 1, 1)))]
    pick.shuffle(made)
    return records(*made)


def stream_of(spark, path, batches):
    for n, batch in enumerate(batches):
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").json(f"{path}/part={n:04d}")
    reader = spark.readStream.schema(SCHEMA + ", part string").option("maxFilesPerTrigger", 1)
    return reader.json(path).drop("part")


def run(df, tmp_path, name):
    writer = df.writeStream.outputMode("append").format("memory").queryName(name)
    query = writer.option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    assert query.awaitTermination(200)
    return df.sparkSession.table(name)


@pytest.mark.parametrize("seed", [1, 2])
def test_stream_gives_the_batch_changelog(spark, tmp_path, seed):
    made = shuffled(seed)
    pick = random.Random(seed)
    cuts = sorted(pick.sample(range(1, len(made)), 3))
    batches = [made[a:z] for a, z in zip([0, *cuts], [*cuts, len(made)], strict=True)]
    for batch in batches:
        pick.shuffle(batch)  # within a micro-batch rows come in any order
    whole = spark.createDataFrame(made, SCHEMA)
    want = detail.order_changelog(whole, ARRIVAL)
    got = run(detail.order_changelog(stream_of(spark, str(tmp_path / "in"), batches), ARRIVAL), tmp_path, f"changes{seed}")
    assert rows(got, *SHOWN) == rows(want, *SHOWN)

    # Folded by key it is the joined table; the amounts of all rows sent sum to those of the table.
    facts = detail.order_facts(whole, ARRIVAL)
    assert rows(joins.fold_changelog(got, ARRIVAL), *SHOWN[3:8]) == rows(facts, *SHOWN[3:8])
    sent = got.filter("op <> 'retract'")
    moved = deltas.province_deltas(sent, Arrival.by_number("version"))
    amount = F.sum("order_amount").cast("double")
    total = F.sum(F.col("split_total_amount").cast("decimal(16,2)")).cast("double")
    assert rows(moved.groupBy("id").agg(amount)) == rows(facts.groupBy("id").agg(total))


@pytest.mark.parametrize("kept", [True, False])
def test_idle_state(spark, tmp_path, kept):
    """A coupon meets its line however far apart their times are while the state lives, and not once it expired."""
    retention, path = (600_000, str(tmp_path / "in")) if kept else (1_000, str(tmp_path / "in"))
    first, late = records(line("1", "o"), order("o")), records(coupon("1"))
    late = [(*late[0][:5], 1_804_067_200, 9)]
    live = Arrival.by_number("seq")
    changes = detail.order_changelog(stream_of(spark, path, [first]), live, retention)
    name = f"idle_{kept}".lower()
    writer = changes.writeStream.outputMode("append").format("memory").queryName(name)
    query = writer.option("checkpointLocation", str(tmp_path / name)).trigger(processingTime="200 milliseconds").start()
    try:
        deadline = time.time() + 100
        while not spark.table(name).count() and time.time() < deadline:
            time.sleep(0.5)
        assert [r.op for r in spark.table(name).collect()] == ["insert"]
        time.sleep(0 if kept else 4)
        spark.createDataFrame(late, SCHEMA).coalesce(1).write.mode("append").json(f"{path}/part=0001")
        deadline = time.time() + (100 if kept else 12)
        while spark.table(name).count() < 3 and time.time() < deadline:
            time.sleep(0.5)
        ops = [r.op for r in spark.table(name).orderBy("version").collect()]
        assert ops == (["insert", "retract", "reinsert"] if kept else ["insert"])
    finally:
        query.stop()
