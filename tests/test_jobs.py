"""The streaming jobs end to end over file topics: each job reads what another wrote."""

from __future__ import annotations

import json
import uuid

import pytest
from frames import rows

from rivermill.config import DATABASE
from rivermill.jobs import JOBS, Warehouse, start

T0 = 1_704_038_400  # 2024-01-01 00:00 in the default zone, seconds


def change(table, kind, ts, old=None, **data):
    return {"database": DATABASE, "table": table, "type": kind, "data": data, "old": old, "ts": ts}


def rule(table, columns):
    return {"source_table": table, "sink_table": f"dim_{table}", "sink_columns": columns,
            "sink_family": "info", "sink_row_key": columns.split(",")[0]}


DIM_ROWS = [
    ("sku_info", "id,category3_id,tm_id,spu_id,sku_name",
     {"id": "s1", "category3_id": "c3", "tm_id": "tm", "spu_id": "sp", "sku_name": "phone"}),
    ("spu_info", "id,spu_name", {"id": "sp", "spu_name": "phones"}),
    ("base_trademark", "id,tm_name", {"id": "tm", "tm_name": "brand"}),
    ("base_category3", "id,name,category2_id", {"id": "c3", "name": "three", "category2_id": "c2"}),
    ("base_category2", "id,name,category1_id", {"id": "c2", "name": "two", "category1_id": "c1"}),
    ("base_category1", "id,name", {"id": "c1", "name": "one"}),
    ("base_province", "id,name", {"id": "p1", "name": "North"}),
    ("base_dic", "dic_code,dic_name", {"dic_code": "1101", "dic_name": "card"}),
]


def put(spark, w, topic, name, records):
    lines = [(json.dumps(r),) for r in records]
    path = f"{w.topic_path(topic)}/job=test/batch={name}"
    spark.createDataFrame(lines, "value string").coalesce(1).write.text(path)


def run(name, w):
    query = start(name, w)
    query.awaitTermination(120)
    ended = not query.isActive
    query.stop()
    assert ended, name


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    w = Warehouse(
        spark, str(tmp_path_factory.mktemp(uuid.uuid4().hex)), day="20240101", finite=True,
        source_options={"maxFilesPerTrigger": "1"},
        words=spark.createDataFrame([("红鞋",)], "word string"),
    )
    put(spark, w, "table_process_dim", 0, [
        {"op": "r", "before": None, "after": rule(t, c), "seq": i} for i, (t, c, _) in enumerate(DIM_ROWS)
    ])
    put(spark, w, "table_process_dwd", 0, [
        {"op": "r", "before": None, "seq": 1, "after": {
            "source_table": "user_info", "source_type": "insert", "sink_table": "dwd_user_register",
            "sink_columns": "id,create_time"}},
    ])
    far = T0 + 100_000
    changes = [
        *[change(t, "insert", T0, **row) for t, _, row in DIM_ROWS],
        change("user_info", "insert", T0, id="u1", create_time="2024-01-01 00:00:03", secret="x"),
        change("cart_info", "insert", T0 + 1, id="1", user_id="u1", sku_num="2"),
        change("comment_info", "insert", T0, id="1", appraise="1101", comment_txt="fine"),
        change("comment_info", "insert", T0, id="2", appraise="none"),
        change("order_detail", "insert", T0 + 2, id="d1", order_id="o1", sku_id="s1", sku_num="2", order_price="3.00",
               split_total_amount="6.00", split_activity_amount="0.00", split_coupon_amount="0.00"),
        change("order_info", "insert", T0 + 2, id="o1", user_id="u1", province_id="p1"),
        change("order_detail_coupon", "insert", T0 + 3, order_detail_id="d1", coupon_id="c"),
        change("payment_info", "update", T0 + 4, {"payment_status": "1601"}, id="1", order_id="o1", user_id="u1",
               payment_type="1101", payment_status="1602"),
    ]
    put(spark, w, "topic_db", 0, changes)
    for n, ts in ((1, far), (2, far + 1000), (3, far + 100_000)):
        put(spark, w, "topic_db", n, [
            change("order_detail", "insert", ts, id=f"x{n}", order_id=f"y{n}", sku_id="s1", sku_num="1", order_price="1.00",
                   split_total_amount="1.00", split_activity_amount="0.00", split_coupon_amount="0.00"),
            change("order_info", "insert", ts, id=f"y{n}", user_id="u2", province_id="p9"),
            change("order_detail_activity", "insert", ts, order_detail_id="zz", activity_id="a"),
            change("order_detail_coupon", "insert", ts, order_detail_id="zz", coupon_id="a"),
            change("cart_info", "insert", ts, id=f"x{n}", user_id="u2", sku_num="1"),
            change("user_info", "insert", ts, id=f"v{n}", create_time="2024-01-02 09:00:00"),
        ])
    common = {"mid": "m1", "uid": "u1", "vc": "v", "ch": "c", "ar": "a", "is_new": "1"}
    page = {"page_id": "home", "last_page_id": "search", "item_type": "keyword", "item": "Red 红鞋", "during_time": 4}
    put(spark, w, "topic_log", 0, [
        {"common": common, "page": page, "ts": T0 * 1000, "displays": [{"item": "1"}]},
        {"common": common, "page": dict(page, last_page_id=None), "ts": T0 * 1000 + 1},
        {"common": common, "start": {"entry": "icon"}, "ts": T0 * 1000 + 2},
        "not a record",
    ])
    put(spark, w, "topic_log", 1, [
        {"common": common, "page": page, "ts": far * 1000},
        {"common": common, "page": dict(page, last_page_id=None), "ts": far * 1000 + 1},
    ])
    return w


def test_all_jobs(spark, warehouse):
    w = warehouse
    for name in JOBS:
        if not name.startswith("dws_"):
            run(name, w)
    assert rows(w.dimension("dim_sku_info"), "key", "sku_name") == [("s1", "phone")]

    def topic(name, field):
        return sorted(json.loads(r[0]).get(field) for r in rows(w.read(name, stream=False)))

    assert topic("dwd_traffic_display", "item") == ["1"]
    assert rows(w.read("dwd_traffic_dirty", stream=False), "value") == [('"not a record"',)]
    assert topic("dwd_user_register", "id") == ["u1", "v1", "v2", "v3"]
    assert topic("dwd_interaction_comment_info", "appraise_name") == ["card"]
    assert topic("dwd_trade_cart_add", "id") == ["1", "x1", "x2", "x3"]
    assert "d1" in topic("dwd_trade_order_detail", "id")
    assert topic("dwd_trade_order_payment_success", "payment_type_name") == ["card"]

    for name in JOBS:
        if name.startswith("dws_"):
            run(name, w)

    def table(name, *columns):
        return rows(spark.read.parquet(w.table_path(name)).filter("stt < '2024-01-02'"), *columns)

    assert table("dws_traffic_source_keyword_page_view_window", "keyword", "keyword_count") == [("red", 1), ("红鞋", 1)]
    traffic = table("dws_traffic_vc_ch_ar_is_new_page_view_window", "vc", "uv_ct", "sv_ct", "pv_ct", "dur_sum")
    assert traffic == [("v", 1, 1, 2, 8)]
    assert table("dws_traffic_home_detail_page_view_window", "home_uv_ct") == [(1,)]
    assert table("dws_user_user_login_window", "uu_ct", "back_ct") == [(1, 0)]
    assert table("dws_user_user_register_window", "register_ct") == [(1,)]
    assert table("dws_trade_cart_add_uu_window", "cart_add_uu_ct") == [(1,)]
    sku = table("dws_trade_sku_order_window", "sku_name", "trademark_name", "category1_name", "order_amount")
    assert [(a, b, c, float(d)) for a, b, c, d in sku] == [("phone", "brand", "one", 6.0)]
    province = table("dws_trade_province_order_window", "province_name", "order_count", "order_amount")
    assert [(a, b, float(c)) for a, b, c in province] == [("North", 1, 6.0)]
