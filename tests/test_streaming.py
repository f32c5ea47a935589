"""Streaming forms give what the batch forms give, over several micro-batches."""

from __future__ import annotations

import json

import pytest
from frames import rows
from pyspark.sql import functions as F

from rivermill.config import DATABASE
from rivermill.operators import deltas, visitors
from rivermill.operators.skew import Arrival
from rivermill.plans import aggregates, detail
from rivermill.sources import topics
from rivermill.streaming import sinks

DAY = 86_400_000
START = 1_704_067_200_000  # 2024-01-01 08:00 in the default zone
ARRIVAL = Arrival.by_number("seq", finite=True)


def write_batches(spark, path, schema, batches):
    """One JSON file per micro-batch, named so that the source reads them in order."""
    for n, batch in enumerate(batches):
        frame = spark.createDataFrame(batch, schema).coalesce(1)
        frame.write.mode("append").json(f"{path}/part={n:04d}")


def as_stream(spark, path, schema, files=1):
    reader = spark.readStream.schema(schema + ", part string").option("maxFilesPerTrigger", files)
    return reader.json(path).drop("part")


def run(df, tmp_path, name):
    """Runs a stream to the end of its input into a memory table."""
    query = (
        df.writeStream.outputMode("append").format("memory").queryName(name)
        .option("checkpointLocation", str(tmp_path / f"ck_{name}"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination(100)
    ended = not query.isActive
    query.stop()
    assert ended
    return df.sparkSession.table(name)


PAGES = (
    "seq bigint, mid string, uid string, vc string, ch string, ar string, is_new string, "
    "page_id string, last_page_id string, item string, item_type string, during_time string, ts bigint"
)


def page_batches():
    """Four micro-batches over several days, out of order inside a batch, two devices interleaved."""
    made = []
    for seq in range(40):
        mid = f"m{seq % 3}"
        ts = START + (seq // 7) * DAY + seq * 1000 + (DAY * 9 if seq > 33 else 0)
        page = ("home", "good_detail", "cart")[seq % 3 if seq % 5 else 0]
        made.append(
            (seq, mid, f"u{seq % 4}" if seq % 6 else None, "v1", "web" if seq % 2 else "store", "11", str(seq % 2),
             page, (None, "login", "search")[seq % 3], "red Shoes", "keyword", str(seq), ts)
        )
    return [list(reversed(made[i : i + 10])) for i in range(0, 40, 10)]


@pytest.fixture(scope="module")
def pages(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pages"))
    write_batches(spark, path, PAGES, page_batches())
    batch = spark.read.schema(PAGES).json(path)
    return batch, lambda: as_stream(spark, path, PAGES)


def test_daily_first(pages, tmp_path):
    batch, stream = pages
    want = visitors.daily_first(batch, ["mid"], "uv_ct", ARRIVAL)
    got = run(visitors.daily_first(stream(), ["mid"], "uv_ct", ARRIVAL), tmp_path, "daily_first")
    assert rows(got, "seq", "uv_ct") == rows(want, "seq", "uv_ct")


def test_new_visitor_repair(pages, tmp_path):
    batch, stream = pages
    want = visitors.repair_new_visitors(batch, ARRIVAL)
    got = run(visitors.repair_new_visitors(stream(), ARRIVAL), tmp_path, "repaired")
    assert rows(got, "seq", "is_new") == rows(want, "seq", "is_new")


def test_returning_users(pages, tmp_path):
    batch, stream = pages
    known = F.col("uid").isNotNull()
    want = visitors.unique_and_returning(batch.filter(known), ARRIVAL)
    got = run(visitors.unique_and_returning(stream().filter(known), ARRIVAL), tmp_path, "returning")
    names = ("seq", "back_ct", "uu_ct")
    assert rows(got, *names) == rows(want, *names)
    assert any(r[1] == 1 for r in rows(want, *names))


def _closed(want, got):
    """Streamed windows are the batch windows, less the last two, which the watermark may not pass."""
    want_rows, got_rows = set(rows(want)), set(rows(got))
    assert got_rows <= want_rows
    open_from = sorted({r[0] for r in want_rows})[-2]
    assert {r for r in want_rows if r[0] < open_from} <= got_rows
    assert got_rows


def test_traffic_windows(pages, tmp_path):
    batch, stream = pages
    want = aggregates.traffic(batch, ARRIVAL, "20240101")
    _closed(want, run(aggregates.traffic(stream(), ARRIVAL, "20240101"), tmp_path, "traffic"))


def test_home_detail_windows(pages, tmp_path):
    batch, stream = pages
    want = aggregates.home_detail(batch, ARRIVAL, "20240101")
    _closed(want, run(aggregates.home_detail(stream(), ARRIVAL, "20240101"), tmp_path, "home_detail"))


def test_login_windows(pages, tmp_path):
    batch, stream = pages
    want = aggregates.logins(batch, ARRIVAL, "20240101")
    _closed(want, run(aggregates.logins(stream(), ARRIVAL, "20240101"), tmp_path, "logins"))


def test_keyword_windows(pages, tmp_path):
    batch, stream = pages
    want = aggregates.keyword_views(batch, "20240101")
    closed = run(aggregates.atom_views(stream(), "20240101"), tmp_path, "keywords")
    _closed(want, aggregates.word_views(closed))


FACTS = (
    "seq bigint, id string, order_id string, province_id string, sku_id string, order_price string, "
    "sku_num string, split_total_amount string, split_activity_amount string, "
    "split_coupon_amount string, ts bigint"
)


@pytest.fixture(scope="module")
def facts(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("facts"))
    made = [
        (seq, f"d{seq % 4}", f"o{seq % 2}", "p1", f"s{seq % 2}", f"{seq}.50", "2", f"{seq * 2}.10",
         "1.00" if seq % 3 else None, "0.25", START // 1000 + seq * 4)
        for seq in range(24)
    ]
    write_batches(spark, path, FACTS, [list(reversed(made[i : i + 8])) for i in range(0, 24, 8)])
    return spark.read.schema(FACTS).json(path), lambda: as_stream(spark, path, FACTS)


def test_sku_deltas(facts, tmp_path):
    batch, stream = facts
    names = ("seq", "original_amount", "activity_reduce_amount", "coupon_reduce_amount", "order_amount")
    got = run(deltas.sku_deltas(stream(), ARRIVAL), tmp_path, "sku_deltas")
    assert rows(got, *names) == rows(deltas.sku_deltas(batch, ARRIVAL), *names)


def test_province_windows(spark, facts, tmp_path):
    batch, stream = facts
    names = spark.createDataFrame([("p1", "North")], "key string, name string")
    want = aggregates.province_orders(batch, names, ARRIVAL, "20240101")
    got = run(aggregates.province_orders(stream(), names, ARRIVAL, "20240101"), tmp_path, "provinces")
    _closed(want, got)


def test_orders_of_a_window_are_rows_of_their_own(spark, tmp_path):
    """Many orders, lines of one order in several micro-batches: counted once, and no set of them is kept."""
    path = str(tmp_path / "many")
    made = [
        (n, f"d{n}", f"o{n % 700}", f"p{n % 2}", "s", "1.00", "1", "1.00", None, None, START // 1000 + (n // 1500) * 10)
        for n in range(3000)
    ]
    ends = [(9000 + n, f"e{n}", "oe", "pe", "s", "1.00", "1", "1.00", None, None, START // 1000 + 900 + n * 60) for n in range(3)]
    write_batches(spark, path, FACTS, [made[i : i + 1000] for i in range(0, 3000, 1000)] + [[e] for e in ends])
    names = spark.createDataFrame([("p1", "North")], "key string, name string")
    stream = aggregates.province_orders(as_stream(spark, path, FACTS), names, ARRIVAL, "20240101")
    assert "collect_set" not in stream._jdf.queryExecution().logical().toString()
    want = aggregates.province_orders(spark.read.schema(FACTS).json(path), names, ARRIVAL, "20240101")
    shown = ("stt", "province_id", "order_count", "order_amount")
    got = [r for r in rows(run(stream, tmp_path, "many_orders"), *shown) if r[1] != "pe"]
    assert got == [r for r in rows(want, *shown) if r[1] != "pe"] and {r[2] for r in got} == {350}


def _texts(records):
    return [(json.dumps(r),) for r in records]


def _change(table, kind, ts, old=None, **data):
    return {"database": DATABASE, "table": table, "type": kind, "ts": ts, "data": data, "old": old}


def test_log_outputs_stream(spark, tmp_path):
    logs = [
        {"common": {"mid": "m", "is_new": "1"}, "ts": START, "page": {"page_id": "home"},
         "displays": [{"item": "1"}, {"item": "2"}], "actions": [{"action_id": "a"}], "err": {"code": 1}},
        {"common": {"mid": "m", "is_new": "1"}, "ts": START + DAY, "start": {"entry": "icon"}},
    ]
    path = str(tmp_path / "logs")
    for n, text in enumerate(_texts(logs)):
        frame = spark.createDataFrame([(n, *text)], "seq bigint, value string").coalesce(1)
        frame.write.mode("append").json(f"{path}/part={n}")
    stream = as_stream(spark, path, "seq bigint, value string")
    got = run(detail.log_topics(topics.logs(stream, "seq"), ARRIVAL), tmp_path, "log_topics")
    batch = spark.read.schema("seq bigint, value string").json(path)
    want = detail.log_topics(topics.logs(batch, "seq"), ARRIVAL)
    assert rows(got) == rows(want)
    assert sorted(r[0] for r in rows(got)) == [
        "dwd_traffic_action", "dwd_traffic_display", "dwd_traffic_display",
        "dwd_traffic_err", "dwd_traffic_page", "dwd_traffic_start",
    ]


def test_order_facts_stream(spark, tmp_path):
    t = START // 1000
    first = [
        _change("order_detail", "insert", t, id="1", order_id="o1", sku_id="s"),
        _change("order_detail", "insert", t + 1, id="2", order_id="o1", sku_id="s"),
        _change("order_info", "insert", t, id="o1", user_id="u", province_id="p"),
        _change("order_detail_activity", "insert", t + 2, order_detail_id="1", activity_id="a"),
    ]
    later = [
        _change("order_info", "insert", t + 4000, id="o9", user_id="u", province_id="p"),
        _change("order_detail", "insert", t + 4000, id="9", order_id="o9", sku_id="s"),
        _change("order_detail_activity", "insert", t + 4000, order_detail_id="8", activity_id="a"),
        _change("order_detail_coupon", "insert", t + 4000, order_detail_id="8", coupon_id="c"),
    ]
    path = str(tmp_path / "changes")
    batches = [first, later, [dict(r, ts=r["ts"] + 4000) for r in later]]
    write_batches(spark, path, "value string", [_texts(b) for b in batches])
    changes = topics.changes(as_stream(spark, path, "value string"))
    got = run(detail.order_facts_stream(changes), tmp_path, "order_facts_stream")
    picked = rows(got, "id", "user_id", "activity_id", "coupon_id")
    assert [r for r in picked if r[0] in "12"] == [("1", "u", "a", None), ("2", "u", None, None)]


def test_payment_stream(spark, tmp_path):
    t = START // 1000
    pay = [
        _change("payment_info", "update", t + 5, {"payment_status": "1601"}, id="1", order_id="o1",
                user_id="u", payment_type="x", payment_status="1602"),
        _change("payment_info", "update", t + 6, {"payment_status": "1601"}, id="2", order_id="o1",
                user_id="u", payment_type="1101", payment_status="1602"),
    ]
    path, lines = str(tmp_path / "pay"), str(tmp_path / "lines")
    write_batches(spark, path, "value string", [_texts(pay)])
    write_batches(
        spark, lines, "value string", [_texts([{"id": "d1", "order_id": "o1", "sku_id": "s", "ts": t}])]
    )
    dictionary = spark.sql("SELECT '1101' AS rowkey, named_struct('dic_name', 'card') AS info")
    changes = topics.changes(as_stream(spark, path, "value string"))
    facts = topics.order_facts(as_stream(spark, lines, "value string"))
    got = run(detail.payment_facts(changes, facts, dictionary), tmp_path, "payments")
    assert rows(got, "id", "payment_type_code", "payment_type_name") == [("d1", "x", None)]


def test_upsert_changelog(spark, tmp_path):
    path = str(tmp_path / "in")
    schema = "seq bigint, id string, v string"
    write_batches(spark, path, schema, [[(1, "a", "x"), (2, "b", "y")], [(3, "a", "z")]])
    out = str(tmp_path / "out")
    query = sinks.foreach_batch(
        as_stream(spark, path, schema), sinks.upsert_changelog(out), str(tmp_path / "ck")
    )
    query.awaitTermination(120)
    assert rows(sinks.read_upserts(spark, out, ["id"], ["seq"]), "id", "v") == [("a", "z"), ("b", "y")]


def test_file_sink_is_complete(spark, tmp_path):
    path = str(tmp_path / "in")
    write_batches(spark, path, "seq bigint, topic string, value string", [[(1, "a", "x"), (2, "b", "y")], [(3, "a", "z")]])
    stream = as_stream(spark, path, "seq bigint, topic string, value string")
    out = str(tmp_path / "out")
    query = sinks.start(
        stream.select("topic", "value"), str(tmp_path / "ck"), "parquet", out, partition_by=["topic"]
    )
    query.awaitTermination(120)
    assert rows(spark.read.parquet(out), "topic", "value") == [("a", "x"), ("a", "z"), ("b", "y")]
