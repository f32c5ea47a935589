"""Hand-made cases, one per rule of the jobs."""

from __future__ import annotations

import json
import random
from decimal import Decimal

import pytest
from frames import rows
from pyspark.sql import functions as F

from rivermill import schemas
from rivermill.config import DATABASE
from rivermill.functions import keywords, times, wire
from rivermill.operators import clean, deltas, enrich, project, routing, skew, split, upsert, visitors, windows
from rivermill.operators.skew import Arrival
from rivermill.plans import aggregates, detail, dimensions
from rivermill.sources import config_log, topics
from rivermill.streaming import sinks

BY_SEQ = Arrival.by_number("seq")
HOT = Arrival.by_number("seq", rows_per_task=1)
DAY_MS = 86_400_000
T0 = 1_704_038_400_000  # 2024-01-01 00:00 in the default zone


def texts(spark, records):
    lines = [(i, r if isinstance(r, str) or r is None else json.dumps(r)) for i, r in enumerate(records)]
    return spark.createDataFrame(lines, "seq bigint, value string")


# --- logs --------------------------------------------------------------------------------------

PAGE = {"page_id": "home", "during_time": 5}


@pytest.fixture
def logs(spark):
    return topics.logs(
        texts(
            spark,
            [
                "{not json",
                {"common": {"uid": "u"}, "page": PAGE, "ts": T0},
                {"common": {"mid": "a", "is_new": "1"}, "page": PAGE, "start": {"entry": "icon"}, "ts": T0},
                {"common": {"mid": "b", "is_new": "1"}, "page": PAGE, "err": {"code": 7}, "ts": str(T0),
                 "displays": [{"item": "1"}, {"item": "2"}], "actions": [{"action_id": "x"}]},
                {"common": {"mid": "c"}, "ts": T0},
                {"common": {"mid": "d"}, "page": PAGE},
                None,
                "  ",
                "[]",
            ],
        ),
        "seq",
    )


def test_clean_logs(logs):
    assert rows(clean.clean_logs(logs), "seq") == [(2,), (3,)]


def test_dirty_logs(spark):
    raw = texts(spark, ["{bad", {"common": {"mid": "a"}, "page": PAGE, "ts": 1}, {"ts": 1}])
    good, dirty = clean.split_dirty(topics.all_logs(raw, "seq"))
    assert rows(good, "seq") == [(1,)]
    assert rows(dirty, "seq", F.col("_bad").isNotNull()) == [(0, True), (2, False)]


def test_start_wins_over_page(logs):
    cleaned = clean.clean_logs(logs)
    assert rows(split.starts(cleaned, "seq"), "seq", "start") == [(2, '{"entry":"icon"}')]
    assert rows(split.pages(cleaned, "seq"), "seq") == [(3,)]


def test_fan_out(logs):
    cleaned = clean.clean_logs(logs)
    assert rows(split.errors(cleaned)) == [('{"code":7}',)]
    assert rows(split.displays(cleaned), "display.item", "common.mid", "ts") == [("1", "b", T0), ("2", "b", T0)]
    assert rows(split.actions(cleaned), "action.action_id", "page.page_id") == [("x", "home")]


def test_outputs_are_json(logs):
    got = [(t, json.loads(v)) for t, v in rows(split.outputs(clean.clean_logs(logs)))]
    by_topic = {t: v for t, v in got}
    assert len(got) == 6
    assert by_topic["dwd_traffic_err"] == {"code": 7}
    assert by_topic["dwd_traffic_start"]["start"] == {"entry": "icon"}
    page = by_topic["dwd_traffic_page"]
    assert page["page"]["page_id"] == "home" and "displays" not in page and "err" not in page
    action = by_topic["dwd_traffic_action"]
    assert (action["action_id"], action["common"]["mid"], action["ts"]) == ("x", "b", T0)


def test_outputs_carry_whole_objects(spark):
    common = {"mid": "a", "is_new": "0", "os": "x", "ba": {"n": 1}, "note": 'say "is_new":"1"'}
    item = {"pos_seq": 2, "item": "7", "deep": {"a": [1, 2.5, None]}}
    record = {"common": common, "page": PAGE | {"from_pos_id": 4, "during_time": 12}, "ts": T0}
    raw = texts(spark, [record | {"displays": [item, {}, {"ts": "own", "x": 1}], "actions": [item]}])
    got = [(t, json.loads(v)) for t, v in rows(split.outputs(clean.clean_logs(topics.logs(raw, "seq"))))]
    shown = [v for t, v in got if t == "dwd_traffic_display"]
    assert len(got) == 5 and all(v["common"] == common and v["page"] == record["page"] and v["ts"] == T0 for _, v in got)
    assert [v["deep"] for v in shown if "deep" in v] == [item["deep"]]
    assert [v["pos_seq"] for v in shown if "pos_seq" in v] == [2]
    assert [v["x"] for v in shown if "x" in v] == ["1"]


def test_dirty_records_are_written(spark):
    raw = texts(spark, ["{bad", {"common": {"mid": "a"}, "page": PAGE, "ts": T0}, {"common": {"vc": 3}, "ts": 1}])
    got = rows(detail.log_records(topics.all_logs(raw, "seq"), BY_SEQ), "topic", "value")
    assert [t for t, _ in got] == ["dwd_traffic_dirty", "dwd_traffic_dirty", "dwd_traffic_page"]
    assert "{bad" in [v for _, v in got] and any('\\"vc\\":3' in v for _, v in got)


@pytest.mark.parametrize("arrival", [BY_SEQ, HOT])
def test_new_visitor_repair(spark, arrival):
    data = [
        (0, "a", "1", 1), (1, "a", "1", 1), (2, "a", "1", 2),
        (3, "b", "0", 2), (4, "b", "1", 2), (5, "c", None, 2), (6, "c", "1", 1), (7, "c", "1", 2),
    ]
    df = spark.createDataFrame([(s, m, n, T0 + d * DAY_MS) for s, m, n, d in data], "seq bigint, mid string, is_new string, ts bigint")
    got = visitors.repair_new_visitors(df, arrival)
    assert [r[1] for r in rows(got, "seq", "is_new")] == ["1", "1", "0", "0", "0", None, "1", "0"]


# --- visitors ----------------------------------------------------------------------------------


def pages(spark, *data):
    """(seq, mid, ms after the first midnight) rows."""
    return spark.createDataFrame([(s, m, T0 + ms) for s, m, ms in data], "seq bigint, mid string, ts bigint")


@pytest.mark.parametrize("arrival", [BY_SEQ, HOT])
def test_daily_first(spark, arrival):
    df = pages(spark, (0, "a", 0), (1, "a", 5), (2, "a", DAY_MS), (3, "a", 2 * DAY_MS), (4, "a", DAY_MS))
    got = visitors.daily_first(df, ["mid"], "uv", arrival)
    assert [r[1] for r in rows(got, "seq", "uv")] == [1, 0, 1, 1, 1]


@pytest.mark.parametrize("arrival", [BY_SEQ, HOT])
def test_returning_users(spark, arrival):
    week = 7 * DAY_MS
    df = pages(spark, (0, "a", 1000), (1, "a", week), (2, "b", 1000), (3, "b", week + 1), (4, "b", week + 2))
    got = visitors.unique_and_returning(df, arrival, key="mid")
    assert rows(got, "seq", "back_ct", "uu_ct") == [(0, 0, 1), (1, 0, 1), (2, 0, 1), (3, 1, 1)]


def test_home_and_detail_are_separate(spark):
    df = pages(spark, (0, "a", 0), (1, "a", 1), (2, "a", 2)).withColumn(
        "page_id", F.when(F.col("seq") == 1, "good_detail").otherwise("home")
    )
    got = visitors.home_detail_firsts(clean.clean_home_pages(df), BY_SEQ)
    assert rows(got, "seq", "home_uv_ct", "good_detail_uv_ct") == [(0, 1, 0), (1, 0, 1)]


def test_session_measures(spark):
    df = spark.createDataFrame([(None, "7"), ("home", "x"), ("home", None)], "last_page_id string, during_time string")
    got = visitors.session_measures(df)
    assert rows(got, "sv_ct", "pv_ct", "dur_sum") == [(0, 1, None), (0, 1, None), (1, 1, 7)]


def test_login_filter(spark):
    df = spark.createDataFrame(
        [("u", None, 1), ("u", "login", 1), ("u", "home", 1), (None, None, 1), ("u", None, None)],
        "uid string, last_page_id string, ts bigint",
    )
    assert clean.clean_logins(df).count() == 2


# --- windows -----------------------------------------------------------------------------------


def test_window_edges(spark):
    df = pages(spark, (0, "a", 9_999), (1, "b", 10_000)).withColumn("back_ct", F.lit(0)).withColumn("uu_ct", F.lit(1))
    assert rows(windows.logins(df, "20240101")) == [
        ("2024-01-01 00:00:00", "2024-01-01 00:00:10", "20240101", 0, 1),
        ("2024-01-01 00:00:10", "2024-01-01 00:00:20", "20240101", 0, 1),
    ]


def test_today_is_the_default_day(spark):
    df = pages(spark, (0, "a", 0)).withColumn("back_ct", F.lit(0)).withColumn("uu_ct", F.lit(1))
    got = windows.logins(df).select("cur_date", F.date_format(F.current_date(), "yyyyMMdd"))
    assert all(a == b for a, b in rows(got))


def test_registrations_skip_bad_times(spark):
    df = spark.createDataFrame(
        [("1", "2024-01-01 00:00:01"), ("2", "2024-01-01 00:00:09"), ("3", "soon"), (None, "2024-01-01 00:00:01"), ("4", None)],
        "id string, create_time string",
    )
    assert rows(aggregates.registrations(df, "d")) == [("2024-01-01 00:00:00", "2024-01-01 00:00:10", "d", 2)]


def test_null_group_of_traffic(spark):
    df = spark.createDataFrame(
        [(0, "a", None, "c", "r", "1", None, "3", T0), (1, "b", None, "c", "r", "1", "x", None, T0)],
        "seq bigint, mid string, vc string, ch string, ar string, is_new string, last_page_id string, during_time string, ts bigint",
    )
    got = aggregates.traffic(df, BY_SEQ, "d")
    assert rows(got, "vc", "uv_ct", "sv_ct", "pv_ct", "dur_sum") == [(None, 2, 1, 2, 3)]


# --- amounts -----------------------------------------------------------------------------------


@pytest.mark.parametrize("arrival", [BY_SEQ, HOT])
def test_deltas(spark, arrival):
    df = spark.createDataFrame(
        [(0, "d", "100"), (1, "d", "100"), (2, "d", "80"), (3, "e", None)], "seq bigint, id string, split_total_amount string"
    )
    got = [r[1] for r in rows(deltas.province_deltas(df, arrival), "seq", "order_amount")]
    assert got == [Decimal(100), 0, Decimal(-20), 0]


def test_one_order_counts_once(spark):
    df = spark.createDataFrame(
        [(0, "d1", "o", "p", "5", T0 // 1000), (1, "d2", "o", "p", "6", T0 // 1000), (2, "d2", "o", "p", "7", T0 // 1000)],
        "seq bigint, id string, order_id string, province_id string, split_total_amount string, ts bigint",
    )
    names = spark.createDataFrame([("q", "other")], "key string, name string")
    got = aggregates.province_orders(df, names, BY_SEQ, "d")
    assert rows(got, "province_id", "order_count", "order_amount", "province_name") == [("p", 1, Decimal("12.00"), "")]


# --- change records ----------------------------------------------------------------------------


def change(table, kind, old=None, database=DATABASE, ts=T0 // 1000, **data):
    return {"database": database, "table": table, "type": kind, "data": data, "old": old, "ts": ts}


def test_cart_adds(spark):
    records = [
        change("cart_info", "insert", id="1", sku_num="3"),
        change("cart_info", "update", {"sku_num": "3"}, id="1", sku_num="5"),
        change("cart_info", "update", {"sku_num": "5"}, id="1", sku_num="4"),
        change("cart_info", "update", {"is_checked": "0"}, id="1", sku_num="9"),
        change("cart_info", "delete", id="1", sku_num="9"),
        change("cart_info", "insert", database="other", id="1", sku_num="3"),
        change("cart_info", "update", {"sku_num": "9"}, id="1", sku_num="10"),
    ]
    got = detail.cart_facts(topics.changes(texts(spark, records)))
    assert sorted(r[0] for r in rows(got, "sku_num")) == [1, 2, 3]


def test_paid(spark):
    records = [
        change("payment_info", "update", {"payment_status": "1601"}, id="1", payment_status="1602"),
        change("payment_info", "update", {"callback_time": "x"}, id="2", payment_status="1602"),
        change("payment_info", "update", {"payment_status": "1601"}, id="3", payment_status="1603"),
        change("payment_info", "insert", id="4", payment_status="1602"),
    ]
    assert rows(project.payments(topics.changes(texts(spark, records))), "id") == [("1",)]


def test_lookups(spark):
    dic = spark.sql("SELECT '1' AS rowkey, named_struct('dic_name', 'one') AS info")
    df = spark.createDataFrame([("1",), ("2",)], "code string")
    assert rows(enrich.lookup(df, dic, "code", "name")) == [("1", "one")]
    assert rows(enrich.lookup(df, dic, "code", "name", "left")) == [("1", "one"), ("2", None)]


def test_order_line_amount(spark):
    records = [change("order_detail", "insert", id="1", order_price="2.50", sku_num="3")]
    got = project.order_details(topics.changes(texts(spark, records)))
    assert rows(got, F.col("split_original_amount").cast("double")) == [(7.5,)]


def test_order_facts(spark):
    records = [
        change("order_detail", "insert", id="1", order_id="o", split_total_amount="5"),
        change("order_detail", "insert", id="1", order_id="o", split_total_amount="6"),
        change("order_detail", "insert", id="2", order_id="gone"),
        change("order_info", "insert", id="o", user_id="u", province_id="p"),
        change("order_detail_activity", "insert", order_detail_id="1", activity_id="a", activity_rule_id="r"),
        change("order_detail", "update", id="3", order_id="o"),
    ]
    for arrival in (BY_SEQ, HOT):
        got = detail.order_facts(topics.changes(texts(spark, records), "seq"), arrival)
        names = ("id", "user_id", "activity_id", "activity_rule_id", "coupon_id", "split_total_amount")
        assert rows(got, *names) == [("1", "u", "a", "r", None, "6")]


# --- dimensions and routing --------------------------------------------------------------------

RULES = "source_table string, sink_table string, sink_columns string, sink_family string, sink_row_key string"


def rules(spark, columns="id,a,b"):
    return spark.createDataFrame([("t", "dim_t", columns, "info", "id")], RULES)


def dim_changes(spark, *records):
    return topics.changes(texts(spark, records), "seq")


def folded(spark, *records):
    state = dimensions.dimension_state(dim_changes(spark, *records), rules(spark), ["seq"])
    return rows(upsert.dimension_table(state, "dim_t", ["a", "b"]))


def test_null_keeps_the_old_value(spark):
    got = folded(
        spark,
        change("t", "insert", id="1", a="x", b="y", c="hidden"),
        change("t", "update", id="1", a="z", b=None),
        change("t", "bootstrap-start", id="1", a="no"),
        change("t", "insert", database="other", id="1", a="no"),
        change("u", "insert", id="1", a="no"),
    )
    assert got == [("1", "z", "y")]


def test_delete_forgets_columns(spark):
    put = change("t", "insert", id="1", a="x", b="y")
    gone = change("t", "delete", id="1")
    assert folded(spark, put, gone) == []
    assert folded(spark, put, gone, change("t", "insert", id="1", a="n")) == [("1", "n", None)]


def envelope(op, before=None, after=None):
    return {"op": op, "before": before, "after": after}


def test_config_changes(spark):
    row = {"source_table": "t", "sink_table": "dim_t", "sink_columns": "id,a", "sink_family": "i", "sink_row_key": "id"}
    changed = dict(row, sink_columns="id,b")
    other = dict(row, source_table="s")
    raw = texts(spark, [envelope("r", None, row), envelope("u", row, changed), envelope("r", None, other), envelope("d", other), "bad"])
    changes = config_log.envelopes(raw, schemas.DIM_RULE, "seq")
    in_force = dimensions.rules_in_force(changes, ["seq"])
    assert rows(in_force, "source_table", "sink_columns") == [("t", "id,b")]
    assert rows(config_log.dropped_tables(changes, ["seq"]), "sink_table", "moment.seq") == [("dim_t", 1), ("dim_t", 3)]


def test_changes_win_over_the_snapshot(spark):
    row = {"source_table": "t", "sink_table": "dim_t", "sink_columns": "id", "sink_family": "i", "sink_row_key": "id"}
    gone, kept = dict(row, source_table="gone"), dict(row, source_table="kept")
    initial = spark.createDataFrame([("r", *r.values()) for r in (row, gone, kept)], "op string, " + RULES)
    log = texts(spark, [envelope("u", row, dict(row, sink_columns="id,x")), envelope("d", gone)])
    changes = config_log.envelopes(log, schemas.DIM_RULE, "seq")
    in_force = dimensions.rules_in_force(config_log.with_snapshot(initial, changes, ["seq"]), ["seq"])
    assert rows(in_force, "source_table", "sink_columns") == [("kept", "id"), ("t", "id,x")]


def test_dropped_table_loses_its_rows(spark):
    changes = dim_changes(spark, change("t", "insert", id="1", a="x"), change("t", "insert", id="2", a="y"))
    dropped = spark.sql("SELECT 'dim_t' AS sink_table, named_struct('seq', 1L) AS moment")
    rows_ = dimensions.dimension_rows(changes, rules(spark), "seq")
    got = upsert.fold_dimensions(rows_, ["seq"], ["id", "a"], dropped)
    assert rows(got, "row_key") == [("2",)]


@pytest.mark.parametrize("kind", [dimensions.DimensionStore, dimensions.BucketedStore])
def test_dimension_store(spark, tmp_path, kind):
    store = kind(spark, str(tmp_path / "store"))
    row = {"source_table": "t", "sink_table": "dim_t", "sink_columns": "id,a,b", "sink_family": "i", "sink_row_key": "id"}
    log = [envelope("c", None, row)]

    def rule_changes():
        return config_log.envelopes(texts(spark, log), schemas.DIM_RULE, "seq")

    write = store.write_batch(rule_changes, ["seq"], ["seq"])
    write(dim_changes(spark, change("t", "insert", id="1", a="x", b="y"), change("t", "insert", id="2", a="q")), 0)
    write(dim_changes(spark, change("t", "update", id="1", a="z")), 1)
    write(dim_changes(spark, change("t", "update", id="1", a="z")), 1)
    assert rows(store.table("dim_t", ["a", "b"])) == [("1", "z", "y"), ("2", "q", None)]
    compact = store.compact(str(tmp_path / "compact"))
    assert rows(compact.table("dim_t", ["a", "b"])) == [("1", "z", "y"), ("2", "q", None)]
    assert rows(kind(spark, str(tmp_path / "none")).table("dim_t", ["a"])) == []
    log.append(envelope("u", row, row))
    write(dim_changes(spark, change("t", "insert", id="3", a="new")), 2)
    assert rows(store.table("dim_t", ["a"])) == [("3", "new")]
    write(dim_changes(spark, change("t", "insert", id="4", a="more")), 3)
    assert rows(store.table("dim_t", ["a"])) == [("3", "new"), ("4", "more")]
    # A store written after a drop remembers it: the next batch keeps what is there.
    later = store.compact(str(tmp_path / "later"))
    later.write_batch(rule_changes, ["seq"], ["seq"])(dim_changes(spark, change("t", "insert", id="5", a="last")), 4)
    assert rows(later.table("dim_t", ["a"])) == [("3", "new"), ("4", "more"), ("5", "last")]


def test_merged_state_is_the_fold(spark, tmp_path):
    """Random puts, nulls and deletes in random cuts; reads by key touch their buckets, and earlier versions stay readable."""
    pick = random.Random(3)
    made = []
    for _ in range(80):
        key, kind = str(pick.randint(0, 11)), pick.choice(("insert", "update", "update", "delete"))
        made.append(change("t", kind, id=key, **{c: pick.choice((None, "x", "y", "z")) for c in "ab"}))
    changes = dim_changes(spark, *made)
    store = dimensions.BucketedStore(spark, str(tmp_path / "store"), buckets=8)
    row = {"source_table": "t", "sink_table": "dim_t", "sink_columns": "id,a,b", "sink_family": "i", "sink_row_key": "id"}
    rule_log = config_log.envelopes(texts(spark, [envelope("r", None, row)]), schemas.DIM_RULE, "seq")
    write = store.write_batch(lambda: rule_log, ["seq"], ["seq"])
    seen = []
    for n, (low, high) in enumerate(((0, 9), (9, 50), (50, 51), (51, 80))):
        write(changes.filter((F.col("seq") >= low) & (F.col("seq") < high)), n)
        whole = dimensions.dimension_state(changes.filter(F.col("seq") < high), rules(spark), ["seq"])
        seen.append(rows(upsert.dimension_table(whole, "dim_t", ["a", "b"])))
        assert rows(store.table("dim_t", ["a", "b"])) == seen[-1]
    asked = spark.createDataFrame([("3",), ("nobody",)], "key string")
    for version, want in enumerate(seen):
        got = store.read_keys("dim_t", ["a", "b"], asked, version)
        assert rows(got.filter("key = '3'")) == [r for r in want if r[0] == "3"]
    read, every = (df.inputFiles() for df in (store.read_keys("dim_t", ["a"], asked), store.table("dim_t", ["a"])))
    assert 0 < len({f.rsplit("/", 1)[0] for f in read}) <= 2 < len({f.rsplit("/", 1)[0] for f in every})
    # One row's micro-batch wrote one bucket.
    assert list(store.index(2).values()).count(2) <= 1


def test_fold_without_rules(spark):
    changes = dim_changes(spark, change("t", "insert", id="1", a="x"))
    assert dimensions.dimension_state(changes, rules(spark).filter("false"), ["seq"]).collect() == []


def test_routed_facts(spark, tmp_path):
    config = spark.createDataFrame(
        [("t", "insert", "topic_new", "id, a"), ("t", "update", "topic_old", "id,a")],
        "source_table string, source_type string, sink_table string, sink_columns string",
    )
    changes = dim_changes(spark, change("t", "insert", id="1", a="x"), change("t", "update", id="1", a="y"), change("t", "delete", id="1"))
    records = detail.routed_facts(changes, config)
    # Listed names are not trimmed: " a" names no column.
    assert rows(records) == [("topic_new", '{"id":"1"}'), ("topic_old", '{"id":"1","a":"y"}')]
    sinks.write_routed(records, str(tmp_path / "topics"))
    assert rows(spark.read.text(str(tmp_path / "topics")), "topic", "value") == rows(records)


# --- functions and sinks -----------------------------------------------------------------------


def test_keywords(spark):
    df = spark.createDataFrame([(0, "Red-Shoes 42"), (1, "!!"), (2, None), (3, "红色手机壳")], "i int, t string")
    plain = rows(keywords.explode_words(df, "t"), "i", "keyword")
    assert plain == sorted([(0, "red"), (0, "shoes"), (0, "42"), (1, None), (2, None), *[(3, c) for c in "红色手机壳"]], key=repr)
    dictionary = spark.createDataFrame([("手机",), ("手机壳",), ("色手",)], "word string")
    split_words = rows(keywords.explode_words(df.filter("i = 3"), "t", dictionary), "keyword")
    assert sorted(split_words) == sorted([("红",), ("色手",), ("机",), ("壳",)])


def test_keywords_of_any_script_and_length(spark):
    df = spark.createDataFrame([(0, "Iechä ÉTÉ e\u0301 カナ한글 ＡＢ red红鞋"), (1, "一二三四五六七八九十" * 2)], "i int, t string")
    plain = [w for _, w in sorted(map(tuple, keywords.explode_words(df.filter("i = 0"), "t").select("i", "keyword").collect()))]
    assert plain == sorted(["iechä", "été", "e\u0301", "カナ한글", "ａｂ", "red", "红", "鞋"])
    dictionary = spark.createDataFrame([("一二三四五六七八九十",), ("九十",), ("",)], "word string")
    assert rows(keywords.explode_words(df.filter("i = 1"), "t", dictionary), "keyword") == [("一二三四五六七八九十",)] * 2


def test_a_very_long_run_of_ideographs(spark):
    df = spark.createDataFrame([("红鞋" * 10_000,)], "t string")
    dictionary = spark.createDataFrame([("红鞋",)], "word string")
    assert keywords.explode_words(df, "t", dictionary).groupBy("keyword").count().collect() == [("红鞋", 10_000)]


def test_keyword_sql_function(spark):
    keywords.register_sql(spark)
    df = spark.createDataFrame([(0, "Réd-Shoes 红鞋"), (1, "!!"), (2, None)], "i int, t string")
    df.createOrReplaceTempView("phrases")
    got = spark.sql("SELECT i, keyword FROM phrases LEFT JOIN LATERAL kw_split(t) ON TRUE")
    assert rows(got) == rows(keywords.explode_words(df, "t"), "i", "keyword")


def test_change_records_carry_times(spark):
    parsed = topics.changes(texts(spark, [change("t", "insert", id="1")]), "seq")
    near = F.abs(F.unix_seconds("proc_time") - F.unix_seconds(F.current_timestamp())) < 600
    assert rows(parsed, F.unix_millis("row_time"), near) == [(T0, True)]


def test_keyword_windows(spark):
    df = spark.createDataFrame(
        [("search", "keyword", "a b", T0), ("search", "keyword", "a", T0), ("search", "keyword", "??", T0),
         ("home", "keyword", "a", T0), ("search", "sku_id", "a", T0), ("search", "keyword", None, T0)],
        "last_page_id string, item_type string, item string, ts bigint",
    )
    dictionary = spark.createDataFrame([("x",)], "word string")
    for words in (None, dictionary):
        got = aggregates.keyword_views(df, "d", words)
        assert rows(got, "keyword", "keyword_count") == [("a", 2), ("b", 1), (None, 1)]


def test_times(spark):
    df = spark.createDataFrame([(T0, "2024-01-01 00:00:00", "2024-01-01", "never")], "ms bigint, t string, d string, bad string")
    got = df.select(
        times.text_to_ms("t"), times.date_text_to_ms("d"), times.ms_to_date("ms"), times.ms_to_date_time("ms"),
        times.ms_to_partition("ms"), times.text_to_ms("bad"),
    )
    assert rows(got) == [(T0, T0, "2024-01-01", "2024-01-01 00:00:00", "20240101", None)]


def test_names():
    assert wire.snake_name("activityReduceAmount") == "activity_reduce_amount"
    assert wire.camel_name("a_aaaa_aa") == "aAaaaAa"


def test_quoted_numbers(spark):
    parsed = topics.changes(texts(spark, ['{"ts": "5"}', '{"ts": 6}', '{"ts": "x"}']), "seq")
    assert rows(parsed, "seq", "ts") == [(0, 5), (1, 6), (2, None)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("k", 1, "20240101")], "someKey string, orderCount int, cur_date string")
    assert rows(sinks.keyed_topic(df, ["someKey"], hidden=["cur_date"])) == [('{"someKey":"k"}', '{"someKey":"k","orderCount":1}')]
    assert rows(sinks.fact_topic(df, hidden=["cur_date", "orderCount"])) == [('{"someKey":"k"}',)]
    sinks.write_aggregates(df, str(tmp_path / "agg"))
    got = spark.read.option("spark.sql.sources.partitionColumnTypeInference.enabled", "false").parquet(str(tmp_path / "agg"))
    assert rows(got, "some_key", "order_count", F.col("cur_date").cast("string")) == [("k", 1, "20240101")]


def test_topic_reader(spark, tmp_path):
    spark.createDataFrame([("a",), (" ",), ("b",)], "value string").write.text(str(tmp_path / "t"))
    assert rows(topics.read_topic(spark, "text", str(tmp_path / "t"))) == [("a",), ("b",)]


def _dated(spark, entries):
    log = [dict(envelope(op, row if op == "d" else None, None if op == "d" else row), ts_ms=at) for op, row, at in entries]
    return config_log.dated(texts(spark, log), schemas.FACT_RULE, "seq")


def _fact_rule(table, sink):
    return {"source_table": table, "source_type": "insert", "sink_table": sink, "sink_columns": "id"}


def test_rule_versions_split_a_batch(spark, tmp_path):
    """Records meet the rules of their own moment; every change is taken once; a repeated batch gives what it gave."""
    initial = spark.createDataFrame([tuple(_fact_rule("t", "first").values())], "source_table string, source_type string, sink_table string, sink_columns string")
    store = config_log.RuleStore(spark, str(tmp_path / "rules"), config_log.FACT_KEY, ["seq"], initial)

    def routed(entries, moments, batch_id):
        versions = store.take(_dated(spark, entries), batch_id)
        records = dim_changes(spark, *[dict(change("t", "insert", id=str(m)), ts=m) for m in moments])
        out = routing.route_facts(records, versions, at=F.col("ts") * 1000)
        return [(int(i), t) for i, t in sorted(rows(out.select(F.col("data")["id"].alias("id"), "sink_table")), key=lambda r: int(r[0]))]

    assert routed([], [1, 2], 0) == [(1, "first"), (2, "first")]
    changes = [("u", _fact_rule("t", "second"), 10_000), ("d", _fact_rule("t", "second"), 20_000), ("c", _fact_rule("t", "third"), 30_000)]
    want = [(9, "first"), (10, "second"), (19, "second"), (30, "third")]
    assert routed(changes, [9, 10, 19, 20, 29, 30], 1) == want
    assert routed(changes, [9, 10, 19, 20, 29, 30], 1) == want
    # A late record meets what is in force when it arrives; of changes of one moment the last counts.
    same = [("u", _fact_rule("t", "lost"), 50_000), ("u", _fact_rule("t", "kept"), 50_000), ("c", _fact_rule("s", "x"), None)]
    assert routed(same, [5, 49, 50], 2) == [(5, "third"), (49, "third"), (50, "kept")]
    assert routed([("d", _fact_rule("t", "kept"), None)], [60], 3) == [] and routed([], [61], 4) == []
    assert rows(store.state().filter("op <> 'd'"), "source_table", "sink_table") == [("s", "x")]
    assert rows(store.state(3).filter("op <> 'd'"), "source_table", "sink_table") == [("s", "x"), ("t", "kept")]


@pytest.mark.parametrize("seed", range(3))
def test_rule_versions_equal_a_fold_record_by_record(spark, tmp_path, seed):
    """Random changes and records in random cuts against a dictionary that follows them in order of moments."""
    pick = random.Random(seed)
    store = config_log.RuleStore(spark, str(tmp_path / "rules"), config_log.FACT_KEY, ["seq"])
    force, want, got, moment = {}, [], [], 0
    for batch_id in range(3):
        entries, moments = [], []
        for _ in range(25):
            moment += 1
            if pick.random() < 0.4:
                rule = _fact_rule(pick.choice("ab"), f"out{moment}")
                op = pick.choice("ccud")
                entries.append((op, rule, moment * 1000))
                force.pop(rule["source_table"], None)
                if op != "d":
                    force[rule["source_table"]] = rule["sink_table"]
            else:
                name = pick.choice("abc")
                moments.append((name, moment))
                if name in force:
                    want.append((str(moment), force[name]))
        records = dim_changes(spark, *[dict(change(n, "insert", id=str(m)), ts=m) for n, m in moments])
        versions = store.take(_dated(spark, entries), batch_id)
        out = routing.route_facts(records, versions, at=F.col("ts") * 1000)
        got += rows(out.select(F.col("data")["id"].alias("id"), "sink_table"))
    assert sorted(got) == sorted(want)


def test_live_rules_drop_a_dimension_inside_a_batch(spark, tmp_path):
    store = dimensions.BucketedStore(spark, str(tmp_path / "store"), buckets=4)
    held = config_log.RuleStore(spark, str(tmp_path / "rules"), config_log.DIM_KEY, ["seq"])
    row = {"source_table": "t", "sink_table": "dim_t", "sink_columns": "id,a", "sink_family": "i", "sink_row_key": "id"}

    def write(entries, records, batch_id):
        log = [dict(envelope(op, None, row), ts_ms=at) for op, at in entries]
        changed = config_log.dated(texts(spark, log), schemas.DIM_RULE, "seq")
        made = dim_changes(spark, *[dict(change("t", "insert", id=i, a=a), ts=at) for i, a, at in records])
        store.write_live(made, changed, held.take(changed, batch_id), ["seq"], ["seq"], F.col("ts") * 1000, batch_id)

    write([("r", None)], [("1", "x", 1), ("2", "y", 2)], 0)
    write([], [("2", "z", 3)], 1)
    assert rows(store.table("dim_t", ["a"])) == [("1", "x"), ("2", "z")]
    for _ in range(2):
        write([("u", 10_000)], [("3", "before", 9), ("4", "after", 10)], 2)
        assert rows(store.table("dim_t", ["a"])) == [("4", "after")]
