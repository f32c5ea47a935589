"""The per-key state rules alone: what they emit and what they store; expiry and order across micro-batches on streams."""

from __future__ import annotations

import random
import time
from datetime import UTC, datetime
from decimal import Decimal

import pytest
from frames import rows
from pyspark.sql import Row
from pyspark.sql import functions as F

from rivermill.operators import deltas, visitors
from rivermill.operators.skew import Arrival
from rivermill.streaming import state

DAY_MS = 86_400_000


def test_daily_flag_stores_on_a_change_of_day_only():
    row = Row(_day=3)
    assert state._daily("uv", row, None) == ({"uv": 1}, (3,))
    assert state._daily("uv", row, (3,)) == ({"uv": 0}, None)
    assert state._daily("uv", row, (4,)) == ({"uv": 1}, (3,))


def test_first_day_is_stored_once():
    assert state._repair("is_new", Row(is_new=None, _day=5, _before=4), None) == ({}, (4,))
    assert state._repair("is_new", Row(is_new="1", _day=5, _before=4), (4,)) == ({"is_new": "0"}, None)
    assert state._repair("is_new", Row(is_new="1", _day=5, _before=4), (5,)) == ({}, None)


def test_return_after_more_than_seven_days():
    def told(ts):
        return state._login("ts", Row(ts=ts, _day=7, _midnight=7 * DAY_MS), (0, 0))

    assert told(7 * DAY_MS) == ({"back_ct": 0, "uu_ct": 1}, (7, 7 * DAY_MS))
    assert told(7 * DAY_MS + 1)[0]["back_ct"] == 1
    assert state._login("ts", Row(ts=1, _day=0, _midnight=0), (0, 0)) == (None, (0, 0))


def test_deltas_from_stored_amounts():
    assert state._delta(["a"], Row(a=Decimal(80)), (Decimal(100),)) == ({"a": -20}, (80,))
    assert state._delta(["a"], Row(a=Decimal(100)), None) == ({"a": 100}, (100,))


PAGES = "seq bigint, mid string, uid string, is_new string, ts bigint, amount string, part string"


def put(spark, path, n, batch):
    spark.createDataFrame(batch, PAGES.removesuffix(", part string")).coalesce(1).write.mode("append").json(f"{path}/part={n:04d}")


def stream_of(spark, path, files=1):
    return spark.readStream.schema(PAGES).option("maxFilesPerTrigger", files).json(path).drop("part")


def test_expiry(spark, tmp_path):
    """Without access state goes after its time: a device counts again on the same day."""
    path, name = str(tmp_path / "in"), "expiring"
    row = (1, "m", "u", "1", DAY_MS, "1.00")
    put(spark, path, 0, [row])
    dated = state._dated(stream_of(spark, path), "ts")
    seen = state.run_rule(
        dated, ["mid"], Arrival.by_number("seq"), state.partial(state._daily, "uv"), [state._flag("uv")], state._DAY_STATE, 1_500
    )
    writer = seen.writeStream.outputMode("append").format("memory").queryName(name)
    query = writer.option("checkpointLocation", str(tmp_path / "ck")).trigger(processingTime="200 milliseconds").start()
    try:
        for n in (1, 2):
            deadline = time.time() + 100
            while spark.table(name).count() < n and time.time() < deadline:
                time.sleep(0.3)
            time.sleep(4)
            if n == 1:
                put(spark, path, 1, [(2, *row[1:])])
        assert rows(spark.table(name), "seq", "uv") == [(1, 1), (2, 1)]
    finally:
        query.stop()


@pytest.fixture(scope="module")
def disordered(spark, tmp_path_factory):
    """Rows of some devices over several days, dealt to micro-batches out of order, and a last row that moves the watermark."""
    path = str(tmp_path_factory.mktemp("disordered"))
    pick = random.Random(5)
    start = int(datetime(2024, 1, 1, tzinfo=UTC).timestamp() * 1000)
    made = [
        (n, f"m{n % 3}", f"u{n % 2}", str(pick.randint(0, 1)), start + n * 5 * 3_600_000 + (n > 25) * 9 * DAY_MS, f"{pick.randint(1, 9)}.00")
        for n in range(36)
    ]
    moved = sorted(made, key=lambda r: r[0] + pick.uniform(0, 12))
    end = (99, "end", "end", "0", start + 90 * DAY_MS, "0.00")
    for n in range(4):
        put(spark, path, n, moved[n * 9 : n * 9 + 9])
    put(spark, path, 4, [end])
    put(spark, path, 5, [(100, *end[1:])])
    return spark.createDataFrame(made, PAGES.removesuffix(", part string")), path


RULES = {
    "repaired": lambda df, arrival: visitors.repair_new_visitors(df, arrival).select("seq", "is_new"),
    "returning": lambda df, arrival: visitors.unique_and_returning(df, arrival).select("seq", "back_ct", "uu_ct"),
    "times": lambda df, arrival: df.select("seq", "ts", F.unix_millis(F.col("row_time") if "row_time" in df.columns else F.timestamp_millis("ts"))),
    "moved": lambda df, arrival: deltas.amount_deltas(
        df, {"delta": F.col("amount").cast("decimal(38,2)")}, arrival, "mid"
    ).select("seq", "delta"),
}
KEYS = {"repaired": "mid", "returning": "uid", "times": "mid", "moved": "mid"}


@pytest.mark.parametrize("name", sorted(RULES))
def test_rows_out_of_order_across_micro_batches(spark, disordered, tmp_path, name):
    batch, path = disordered
    arrival = Arrival.by_number("seq", finite=True)
    timed = stream_of(spark, path).withColumn("row_time", F.timestamp_millis("ts")).withWatermark("row_time", "30 days")
    held = state.in_order(timed, [KEYS[name]], arrival)
    writer = RULES[name](held, arrival).writeStream.outputMode("append").format("memory").queryName(f"held_{name}")
    query = writer.option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    assert query.awaitTermination(200)
    got = spark.table(f"held_{name}").filter("seq < 99")
    assert rows(got) == rows(RULES[name](batch, arrival))
