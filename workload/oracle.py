"""The same queries as ANSI SQL over the test tables, for a second engine to check results."""

from __future__ import annotations

from workload.standins import DAY, HAN_DIGITS

ORACLE: dict[str, str] = {}

EV = """
ev AS (
  SELECT event_id, ts, CAST(user_id AS VARCHAR) AS user_id, event_type, value,
         CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k
  FROM events
)"""

PG = EV + """,
pg AS (
  SELECT event_id, ts, event_type, k, user_id AS mid, user_id AS uid,
    CASE WHEN k < 30 THEN 'v1' WHEN k < 70 THEN 'v2' ELSE 'v3' END AS vc,
    CASE WHEN k < 45 THEN 'web' ELSE 'store' END AS ch,
    CASE WHEN k < 25 THEN '110000' WHEN k < 60 THEN '310000' ELSE '440000' END AS ar,
    CASE WHEN k < 50 THEN '1' ELSE '0' END AS is_new,
    CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail'
      WHEN 'purchase' THEN 'payment' WHEN 'signup' THEN 'register' WHEN 'error' THEN 'mine' END AS page_id,
    CASE WHEN k < 20 THEN NULL WHEN k < 35 THEN 'login' WHEN k < 75 THEN 'search' ELSE 'home' END AS last_page_id,
    CASE WHEN k < 60 THEN 'keyword' ELSE 'sku_id' END AS item_type,
    event_type || ' ' || CAST(k AS VARCHAR) AS item,
    CAST(FLOOR(value * 100) AS BIGINT) AS during_time,
    event_type <> 'signup' OR k < 30 AS has_page,
    event_type = 'signup' AS is_start
  FROM ev
)"""

# Clean logs: readable and with a device.
LG = PG + """,
lg AS (SELECT * FROM pg WHERE k < 96),
first_day AS (
  SELECT *, FIRST_VALUE(CASE WHEN is_new = '1' THEN CAST(ts AS DATE) ELSE CAST(ts AS DATE) - 1 END)
    OVER (PARTITION BY mid ORDER BY event_id) AS f
  FROM lg
),
fixed AS (
  SELECT * REPLACE (CASE WHEN is_new = '1' AND CAST(ts AS DATE) <> f THEN '0' ELSE is_new END AS is_new)
  FROM first_day
)"""

LN = """
ln AS (
  SELECT l_shipdate AS arrived, l_partkey AS n1, l_suppkey AS n2, l_extendedprice AS n3,
    CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id,
    CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS sku_id,
    CAST(l_suppkey AS VARCHAR) AS supplier, l_linenumber AS line,
    CAST(l_extendedprice AS DECIMAL(16,2)) AS price, CAST(l_quantity AS INTEGER) AS cnt,
    CAST(l_discount AS DECIMAL(16,2)) AS discount, CAST(l_tax AS DECIMAL(16,2)) AS tax,
    l_returnflag AS flag, l_linestatus AS status,
    strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS create_time
  FROM lineitem
)"""

NEWEST = "ROW_NUMBER() OVER (PARTITION BY id ORDER BY arrived DESC, n1 DESC, n2 DESC, n3 DESC)"
BEFORE = "OVER (PARTITION BY id ORDER BY arrived, n1, n2, n3)"
TIME = "'%Y-%m-%d %H:%M:%S'"


def stamps(column: str) -> str:
    bucket = f"time_bucket(INTERVAL 10 SECOND, {column})"
    return (
        f"strftime({bucket}, {TIME}) AS stt, "
        f"strftime({bucket} + INTERVAL 10 SECOND, {TIME}) AS edt, '{DAY}' AS cur_date"
    )


# The raw text of a log record, written out as it stands in the topic.
RAW = PG + """,
raw AS (
  SELECT event_id, k, ts, '{"common":{' || CASE WHEN k < 97 THEN '"mid":"' || mid || '",' ELSE '' END ||
    '"uid":"' || uid || '","vc":"' || vc || '","ch":"' || ch || '","ar":"' || ar || '","is_new":"' || is_new ||
    '","os":"' || CASE WHEN k % 2 = 0 THEN 'linux' ELSE 'mac' END || '"}' ||
    CASE WHEN has_page THEN ',"page":{"page_id":"' || page_id || '",' ||
      CASE WHEN last_page_id IS NULL THEN '' ELSE '"last_page_id":"' || last_page_id || '",' END ||
      '"item":"' || item || '","item_type":"' || item_type || '","during_time":' || CAST(during_time AS VARCHAR) || '}'
      ELSE '' END ||
    CASE WHEN is_start THEN ',"start":{"entry":"icon","loading_time":' || CAST(k AS VARCHAR) || '}' ELSE '' END ||
    CASE WHEN event_type = 'error' THEN ',"err":{"error_code":' || CAST(k AS VARCHAR) || ',"msg":"broken"}' ELSE '' END ||
    CASE WHEN event_type = 'view' THEN ',"displays":[' ||
      '{"item":"' || CAST(k AS VARCHAR) || '","pos_id":"1","pos_seq":1,"shown":{"at":' || CAST(k AS VARCHAR) || '}},' ||
      '{"item":"' || CAST(k + 1 AS VARCHAR) || '","pos_id":"2","pos_seq":2,"shown":{"at":' || CAST(k AS VARCHAR) || '}}]'
      ELSE '' END ||
    CASE WHEN event_type = 'click' THEN ',"actions":[{"action_id":"favor_add","item":"' || CAST(k AS VARCHAR) || '"}]'
      ELSE '' END ||
    ',"ts":' || CAST(epoch_us(ts) // 1000 AS VARCHAR) || '}' AS value
  FROM pg
)"""

ORACLE["topic_text"] = f"""
WITH {RAW}
SELECT event_id, CAST(length(sent) AS INTEGER) AS chars, sha256(regexp_replace(sent, '"ts":[0-9]+', '"ts"')) AS digest,
  CASE WHEN k <> 96 THEN strftime(ts, {TIME}) END AS time
FROM (SELECT event_id, k, ts, CASE WHEN k = 96 THEN substr(value, 1, 30) ELSE value END AS sent FROM raw) WHERE event_id > 0
"""

CART = LN + """,
cart AS (
  SELECT *, CASE flag WHEN 'A' THEN 'insert' WHEN 'N' THEN 'update' ELSE 'delete' END AS kind,
    CASE WHEN flag = 'N' AND status = 'O' THEN line * 5 END AS old_count
  FROM ln
)"""

ORACLE["change_parse"] = f"""
WITH {CART}
SELECT 'cart_info' AS "table", kind AS type, strftime(arrived, '%Y-%m-%d') AS day,
  CASE WHEN old_count IS NULL THEN 0 ELSE 1 END AS has_old_count, COUNT(*) AS n
FROM cart GROUP BY ALL
"""

ORACLE["config_rules"] = """
WITH r AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders
)
SELECT 't' || CAST(c_custkey AS VARCHAR) AS source_table, 'dim_n' || CAST(c_nationkey AS VARCHAR) AS sink_table,
  'id' AS sink_columns, 'id' AS sink_row_key
FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
UNION ALL
SELECT 't' || CAST(o_custkey AS VARCHAR) AS source_table, 'dim_' || substr(o_orderpriority, 1, 1) AS sink_table,
  'id,name' AS sink_columns, 'id' AS sink_row_key
FROM r WHERE rn = 1 AND o_orderstatus <> 'F'
"""

ORACLE["dated_rule_routes"] = """
WITH day AS (SELECT *, CAST(o_orderdate AS DATE) AS d FROM orders),
v AS (SELECT *, lead(d) OVER (PARTITION BY o_custkey ORDER BY d, o_orderkey) AS until FROM day)
SELECT 'dim_' || substr(v.o_orderpriority, 1, 1) AS sink_table, CAST(r.o_orderkey AS VARCHAR) AS row_key,
  CAST(r.o_orderkey AS VARCHAR) || ',' || r.o_orderpriority AS data
FROM day r JOIN v ON r.o_custkey = v.o_custkey AND v.d <= r.d + 30 AND (v.until IS NULL OR r.d + 30 < v.until)
WHERE v.o_orderstatus <> 'F'
"""

ORACLE["order_topic_read"] = f"""
WITH {LN}
SELECT id, order_id, sku_id, CAST(cnt AS VARCHAR) AS sku_num, CAST(price AS VARCHAR) AS split_total_amount,
  create_time AS time
FROM ln WHERE line NOT IN (4, 5)
"""

ORACLE["upsert_latest"] = f"""
WITH {LN}, r AS (SELECT *, {NEWEST} AS rn FROM ln)
SELECT id, sku_id, CAST(cnt AS VARCHAR) AS sku_num, CAST(price AS VARCHAR) AS split_total_amount
FROM r WHERE rn = 1
"""

DIM = LN + """,
dim AS (
  SELECT *, CASE flag WHEN 'A' THEN 'sku_info' WHEN 'N' THEN 'spu_info' ELSE 'cart_info' END AS tbl,
    CASE WHEN cnt < 10 THEN 'delete' WHEN cnt < 30 THEN 'update' ELSE 'insert' END AS kind,
    CASE WHEN discount <= 0.05 THEN 'n' || supplier END AS name
  FROM ln
)"""

ORACLE["dimension_fold"] = f"""
WITH {DIM}, r AS (
  SELECT *, 'dim_' || tbl AS sink_table,
    ROW_NUMBER() OVER (PARTITION BY tbl, id ORDER BY arrived, n1, n2, n3) AS pos
  FROM dim WHERE tbl <> 'cart_info'
), gone AS (
  SELECT tbl, id, MAX(pos) AS pos FROM r WHERE kind = 'delete' GROUP BY tbl, id
), live AS (
  SELECT r.* FROM r LEFT JOIN gone g ON r.tbl = g.tbl AND r.id = g.id
  WHERE r.kind <> 'delete' AND (g.pos IS NULL OR r.pos > g.pos)
)
SELECT sink_table, id AS row_key, arg_max(name, pos) FILTER (WHERE name IS NOT NULL) AS name,
  CASE WHEN sink_table = 'dim_sku_info' THEN arg_max(CAST(price AS VARCHAR), pos) END AS price
FROM live GROUP BY sink_table, id
"""

ORACLE["dimension_merge"] = ORACLE["dimension_fold"]

ORACLE["dimension_lifecycle"] = f"""
WITH {DIM}, r AS (
  SELECT *, 'dim_' || tbl AS sink_table,
    ROW_NUMBER() OVER (PARTITION BY tbl, id ORDER BY arrived, n1, n2, n3) AS pos
  FROM dim WHERE tbl <> 'cart_info'
    AND arrived >= CASE tbl WHEN 'sku_info' THEN DATE '1997-01-01' ELSE DATE '1996-03-01' END
), gone AS (
  SELECT tbl, id, MAX(pos) AS pos FROM r WHERE kind = 'delete' GROUP BY tbl, id
), live AS (
  SELECT r.* FROM r LEFT JOIN gone g ON r.tbl = g.tbl AND r.id = g.id
  WHERE r.kind <> 'delete' AND (g.pos IS NULL OR r.pos > g.pos)
)
SELECT sink_table, id AS row_key, arg_max(name, pos) FILTER (WHERE name IS NOT NULL) AS name,
  CASE WHEN sink_table = 'dim_sku_info' THEN arg_max(CAST(price AS VARCHAR), pos) END AS price
FROM live GROUP BY sink_table, id
"""

ORACLE["dimension_point_read"] = f"""
WITH {DIM}, r AS (
  SELECT *, 'dim_' || tbl AS sink_table,
    ROW_NUMBER() OVER (PARTITION BY tbl, id ORDER BY arrived, n1, n2, n3) AS pos
  FROM dim WHERE tbl <> 'cart_info'
), gone AS (
  SELECT tbl, id, MAX(pos) AS pos FROM r WHERE kind = 'delete' GROUP BY tbl, id
), live AS (
  SELECT r.* FROM r LEFT JOIN gone g ON r.tbl = g.tbl AND r.id = g.id
  WHERE r.kind <> 'delete' AND (g.pos IS NULL OR r.pos > g.pos)
)
SELECT n.id, d.name, d.price, CASE WHEN d.id IS NULL THEN 0 ELSE 1 END AS found
FROM (SELECT DISTINCT id FROM ln) n LEFT JOIN (
  SELECT id, arg_max(name, pos) FILTER (WHERE name IS NOT NULL) AS name, arg_max(CAST(price AS VARCHAR), pos) AS price
  FROM live WHERE sink_table = 'dim_sku_info' GROUP BY id
) d ON n.id = d.id
"""

START_TEXT = """'{"entry":"icon","loading_time":' || CAST(k AS VARCHAR) || '}'"""

ORACLE["log_clean"] = f"""
WITH {LG}
SELECT event_id, mid, CASE WHEN has_page THEN page_id END AS page_id,
  CASE WHEN is_start THEN {START_TEXT} END AS start, strftime(ts, {TIME}) AS time
FROM lg
"""

ORACLE["log_dirty"] = f"""
WITH {PG} SELECT event_id, CASE WHEN k = 96 THEN 1 ELSE 0 END AS unreadable FROM pg WHERE k >= 96
"""

ORACLE["new_visitor_repair"] = f"""
WITH {PG}, f AS (
  SELECT *, FIRST_VALUE(CASE WHEN is_new = '1' THEN CAST(ts AS DATE) ELSE CAST(ts AS DATE) - 1 END)
    OVER (PARTITION BY mid ORDER BY event_id) AS f
  FROM pg
)
SELECT event_id, mid, CASE WHEN is_new = '1' AND CAST(ts AS DATE) <> f THEN '0' ELSE is_new END AS is_new FROM f
"""

ERR_TEXT = """'{"error_code":' || CAST(k AS VARCHAR) || ',"msg":"broken"}'"""

ORACLE["log_errors"] = f"""
WITH {LG} SELECT {ERR_TEXT} AS value, COUNT(*) AS n FROM lg WHERE event_type = 'error' GROUP BY ALL
"""

ORACLE["log_starts"] = f"""
WITH {LG} SELECT event_id, mid, {START_TEXT} AS start FROM lg WHERE is_start
"""

ORACLE["log_pages"] = f"""
WITH {LG}
SELECT event_id, mid, page_id, last_page_id, item, CAST(during_time AS VARCHAR) AS during_time
FROM lg WHERE NOT is_start
"""

ORACLE["log_displays"] = f"""
WITH {LG}
SELECT event_id, page_id, CAST(k + p - 1 AS VARCHAR) AS item, CAST(p AS VARCHAR) AS pos_id, CAST(k AS VARCHAR) AS shown_at
FROM lg CROSS JOIN (VALUES (1), (2)) AS t(p) WHERE event_type = 'view'
"""

ORACLE["log_actions"] = f"""
WITH {LG}
SELECT event_id, page_id, CAST(k AS VARCHAR) AS item, 'favor_add' AS action_id FROM lg WHERE event_type = 'click'
"""

ORACLE["log_outputs"] = f"""
WITH {LG}, parts AS (
  SELECT 'dwd_traffic_err' AS topic, '' AS mid, '' AS is_new, '' AS page_id, '' AS item, 0 AS systems, 0 AS times, 0 AS places
  FROM fixed WHERE event_type = 'error'
  UNION ALL SELECT 'dwd_traffic_start', mid, is_new, '', '', 1, 0, 0 FROM fixed WHERE is_start
  UNION ALL SELECT 'dwd_traffic_page', mid, is_new, page_id, '', 1, 1, 0 FROM fixed WHERE NOT is_start
  UNION ALL SELECT 'dwd_traffic_display', mid, is_new, page_id, CAST(k AS VARCHAR), 1, 1, 1 FROM fixed WHERE event_type = 'view'
  UNION ALL SELECT 'dwd_traffic_display', mid, is_new, page_id, CAST(k + 1 AS VARCHAR), 1, 1, 1 FROM fixed WHERE event_type = 'view'
  UNION ALL SELECT 'dwd_traffic_action', mid, is_new, page_id, CAST(k AS VARCHAR), 1, 1, 0 FROM fixed WHERE event_type = 'click'
)
SELECT topic, mid, is_new, page_id, item, systems, times, places, COUNT(*) AS n FROM parts GROUP BY ALL
"""

ORACLE["dimension_clean"] = f"""
WITH {DIM}, marked AS (
  SELECT tbl, n1, CASE WHEN n2 < 3 THEN 'bootstrap-start' WHEN n2 > 4 THEN kind ELSE 'none' END AS kind FROM dim
)
SELECT tbl AS "table", kind AS type, COUNT(*) AS n FROM marked
WHERE kind <> 'bootstrap-start' AND n1 <> 7 GROUP BY ALL
"""

ORACLE["dimension_routes"] = f"""
WITH {DIM}
SELECT 'dim_' || tbl AS sink_table, id AS row_key, kind AS type,
  CASE WHEN tbl = 'sku_info' THEN 'id,name,price' ELSE 'id,name' END AS columns,
  CASE WHEN tbl = 'sku_info' THEN CAST(price AS VARCHAR) END AS price
FROM dim WHERE tbl <> 'cart_info'
"""

ORACLE["fact_routes"] = f"""
WITH {DIM}
SELECT 'dwd_sku_new' AS topic, '{{"id":"' || id || '","price":"' || CAST(price AS VARCHAR) || '"}}' AS value
FROM dim WHERE tbl = 'sku_info' AND kind = 'insert'
UNION ALL
SELECT 'dwd_sku_changed', '{{"id":"' || id || '"}}' FROM dim WHERE tbl = 'sku_info' AND kind = 'update'
UNION ALL
SELECT 'dwd_cart', '{{"price":"' || CAST(price AS VARCHAR) || '","secret":"x"}}'
FROM dim WHERE tbl = 'cart_info' AND kind = 'insert'
"""

ORACLE["topic_routes"] = f"""
WITH {DIM}, routed AS (
  SELECT CASE WHEN tbl = 'sku_info' AND kind = 'insert' THEN 'dwd_sku_new'
    WHEN tbl = 'sku_info' AND kind = 'update' THEN 'dwd_sku_changed'
    WHEN tbl = 'cart_info' AND kind = 'insert' THEN 'dwd_cart' END AS topic
  FROM dim
)
SELECT topic, COUNT(*) AS n FROM routed WHERE topic IS NOT NULL GROUP BY topic
"""

DIC = """
dic(code, name) AS (
  VALUES ('1101', 'card'), ('1102', 'wallet'), ('1103', 'bank'),
    ('1201', 'best'), ('1202', 'good'), ('1203', 'fair'), ('1204', 'poor')
)"""

ORACLE["comment_facts"] = f"""
WITH {DIC}
SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id, code AS appraise_code,
  name AS appraise_name, o_orderpriority AS comment_txt, strftime(o_orderdate, {TIME}) AS create_time
FROM orders JOIN dic ON '120' || substr(o_orderpriority, 1, 1) = code
WHERE o_orderstatus <> 'O'
"""

ORACLE["cart_facts"] = f"""
WITH {CART}
SELECT id, supplier AS user_id, sku_id, CAST(price AS VARCHAR) AS cart_price,
  CASE WHEN kind = 'insert' THEN cnt ELSE cnt - old_count END AS sku_num, create_time
FROM cart WHERE kind = 'insert' OR (kind = 'update' AND cnt > old_count)
"""

ORACLE["order_lines"] = f"""
WITH {LN}
SELECT id, order_id, CAST(cnt AS VARCHAR) AS sku_num, CAST(price AS VARCHAR) AS order_price,
  CAST(CAST(cnt AS DECIMAL(16,2)) * price AS DOUBLE) AS split_original_amount
FROM ln
"""

ORACLE["order_facts"] = f"""
WITH {LN}, d AS (SELECT *, {NEWEST} AS rn FROM ln),
a AS (SELECT *, {NEWEST} AS rn FROM ln WHERE flag = 'A'),
c AS (SELECT *, {NEWEST} AS rn FROM ln WHERE status = 'O')
SELECT d.id, d.order_id, d.sku_id, CAST(o_custkey AS VARCHAR) AS user_id,
  CAST(o_custkey % 34 AS VARCHAR) AS province_id, a.supplier AS activity_id,
  CAST(a.line AS VARCHAR) AS activity_rule_id, c.supplier AS coupon_id,
  CAST(d.price AS VARCHAR) AS order_price, CAST(d.cnt AS VARCHAR) AS sku_num, d.create_time
FROM d JOIN orders ON d.order_id = CAST(o_orderkey AS VARCHAR)
LEFT JOIN a ON a.id = d.id AND a.rn = 1
LEFT JOIN c ON c.id = d.id AND c.rn = 1
WHERE d.rn = 1
"""

# Every row of a line, its order, activity and coupon in order of arrival, with the last value of each so far.
SENT = LN + """,
came AS (
  SELECT id, order_id, arrived, n1, n2, n3, 2 AS slot, struct_pack(sku_id, price, cnt, create_time) AS l,
    CAST(NULL AS BIGINT) AS i, NULL AS a, CAST(NULL AS VARCHAR) AS c FROM ln
  UNION ALL SELECT id, order_id, arrived, n1, n2, n3, 3, NULL, NULL, struct_pack(supplier, line), NULL FROM ln WHERE flag = 'A'
  UNION ALL SELECT id, order_id, arrived, n1, n2, n3, 4, NULL, NULL, NULL, supplier FROM ln WHERE status = 'O'
  UNION ALL SELECT id, order_id, o_orderdate, o_orderkey, 0, 0.0, 1, NULL, o_custkey, NULL, NULL
  FROM (SELECT DISTINCT id, order_id FROM ln) JOIN orders ON order_id = CAST(o_orderkey AS VARCHAR)
),
so_far AS (
  SELECT id, order_id, arrived, n1, n2, n3, slot,
    struct_pack(l := last_value(l IGNORE NULLS) OVER w, i := last_value(i IGNORE NULLS) OVER w,
      a := last_value(a IGNORE NULLS) OVER w, c := last_value(c IGNORE NULLS) OVER w) AS fact
  FROM came WINDOW w AS (PARTITION BY id ORDER BY arrived, n1, n2, n3, slot ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
whole AS (
  SELECT *, lag(fact) OVER (PARTITION BY id ORDER BY arrived, n1, n2, n3, slot) AS before
  FROM so_far WHERE fact.l IS NOT NULL AND fact.i IS NOT NULL
),
changed AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY arrived, n1, n2, n3, slot) - 1 AS nth
  FROM whole WHERE before IS NULL OR fact IS DISTINCT FROM before
),
sent AS (
  SELECT id, order_id, 'retract' AS op, 2 * nth - 1 AS version, before AS fact FROM changed WHERE nth > 0
  UNION ALL SELECT id, order_id, CASE WHEN nth = 0 THEN 'insert' ELSE 'reinsert' END, 2 * nth, fact FROM changed
)"""

ORACLE["order_changelog"] = f"""
WITH {SENT}
SELECT id, op, CAST(version AS BIGINT) AS version, order_id, fact.l.sku_id AS sku_id, CAST(fact.i AS VARCHAR) AS user_id,
  CAST(fact.i % 34 AS VARCHAR) AS province_id, fact.a.supplier AS activity_id, CAST(fact.a.line AS VARCHAR) AS activity_rule_id,
  fact.c AS coupon_id, CAST(fact.l.price AS VARCHAR) AS order_price, CAST(fact.l.cnt AS VARCHAR) AS sku_num,
  fact.l.create_time AS create_time, CAST(fact.l.price AS VARCHAR) AS split_total_amount
FROM sent
"""

ORACLE["changelog_sku_deltas"] = f"""
WITH {SENT},
moved AS (
  SELECT fact.l.sku_id AS sku_id,
    fact.l.price - coalesce(lag(fact.l.price) OVER (PARTITION BY id ORDER BY version), 0) AS amount
  FROM sent WHERE op <> 'retract'
)
SELECT sku_id, CAST(sum(amount) AS DOUBLE) AS order_amount FROM moved GROUP BY sku_id
"""

PAY = EV + """,
pay AS (
  SELECT CAST(event_id AS VARCHAR) AS id, user_id AS order_id, date_trunc('second', ts) AS arrived,
    CASE WHEN k < 25 THEN '1101' WHEN k < 50 THEN '1102' WHEN k < 75 THEN '1103' ELSE '1104' END AS payment_type,
    CAST(CAST(value AS DECIMAL(16,2)) AS VARCHAR) AS total_amount,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS callback_time
  FROM ev WHERE event_type = 'purchase' AND k < 80
),
line AS (
  SELECT CAST(event_id AS VARCHAR) AS id, user_id AS order_id, date_trunc('second', ts) AS arrived,
    CAST(k AS VARCHAR) AS sku_id
  FROM ev WHERE event_type = 'click'
)"""

ORACLE["payment_success"] = f"""
WITH {PAY} SELECT id, order_id, payment_type, total_amount, callback_time FROM pay
"""

ORACLE["payment_facts"] = f"""
WITH {PAY}, {DIC}
SELECT line.id, pay.order_id, payment_type AS payment_type_code, name AS payment_type_name,
  callback_time AS payment_time, sku_id
FROM pay JOIN line ON pay.order_id = line.order_id
  AND pay.arrived BETWEEN line.arrived - INTERVAL 15 MINUTE AND line.arrived + INTERVAL 5 SECOND
LEFT JOIN dic ON payment_type = code
"""

ORACLE["interval_join_wide"] = f"""
WITH {PAY}
SELECT line.id, pay.order_id, payment_type, callback_time AS payment_time
FROM pay JOIN line ON pay.order_id = line.order_id
  AND pay.arrived BETWEEN line.arrived - INTERVAL 24 HOUR AND line.arrived + INTERVAL 6 HOUR
"""

ORACLE["daily_visitors"] = f"""
WITH {PG}, f AS (
  SELECT *, LAG(CAST(ts AS DATE)) OVER (PARTITION BY mid ORDER BY event_id) AS b FROM pg
)
SELECT event_id, mid, CAST(CASE WHEN b = CAST(ts AS DATE) THEN 0 ELSE 1 END AS BIGINT) AS uv_ct FROM f
"""

ORACLE["session_measures"] = f"""
WITH {PG}
SELECT event_id, CAST(CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END AS BIGINT) AS sv_ct,
  CAST(1 AS BIGINT) AS pv_ct, during_time AS dur_sum
FROM pg
"""

HOME = PG + """,
home AS (
  SELECT *, LAG(CAST(ts AS DATE)) OVER (PARTITION BY mid, page_id ORDER BY event_id) AS b
  FROM pg WHERE page_id IN ('home', 'good_detail')
),
firsts AS (
  SELECT *, CAST(CASE WHEN page_id = 'home' THEN 1 ELSE 0 END AS BIGINT) AS home_uv_ct,
    CAST(CASE WHEN page_id = 'home' THEN 0 ELSE 1 END AS BIGINT) AS good_detail_uv_ct
  FROM home WHERE b IS NULL OR b <> CAST(ts AS DATE)
)"""

ORACLE["home_detail_firsts"] = f"WITH {HOME} SELECT event_id, mid, home_uv_ct, good_detail_uv_ct FROM firsts"

LOGIN = PG + """,
login AS (
  SELECT *, LAG(CAST(ts AS DATE)) OVER (PARTITION BY uid ORDER BY event_id) AS b
  FROM pg WHERE last_page_id IS NULL OR last_page_id = 'login'
),
users AS (
  SELECT *, CAST(CASE WHEN b IS NOT NULL
      AND epoch_ms(ts) - epoch_ms(CAST(b AS TIMESTAMP)) > 604800000 THEN 1 ELSE 0 END AS BIGINT) AS back_ct,
    CAST(1 AS BIGINT) AS uu_ct
  FROM login WHERE b IS NULL OR b <> CAST(ts AS DATE)
)"""

ORACLE["returning_users"] = f"WITH {LOGIN} SELECT event_id, uid, back_ct, uu_ct FROM users"

ADDS = EV + """,
adds AS (
  SELECT event_id, user_id, ts, LAG(CAST(ts AS DATE)) OVER (PARTITION BY user_id ORDER BY event_id) AS b
  FROM ev WHERE event_type IN ('click', 'purchase')
),
adders AS (SELECT * FROM adds WHERE b IS NULL OR b <> CAST(ts AS DATE))"""

ORACLE["cart_add_firsts"] = f"""
WITH {ADDS} SELECT event_id, user_id, CAST(1 AS BIGINT) AS cart_add_uu_ct FROM adders
"""

DELTA = LN + f""",
delta AS (
  SELECT *, cnt * price - COALESCE(LAG(cnt * price) {BEFORE}, 0) AS original_amount,
    discount - COALESCE(LAG(discount) {BEFORE}, 0) AS activity_reduce_amount,
    tax - COALESCE(LAG(tax) {BEFORE}, 0) AS coupon_reduce_amount,
    price - COALESCE(LAG(price) {BEFORE}, 0) AS order_amount
  FROM ln
)"""

ORACLE["sku_deltas"] = f"""
WITH {DELTA}
SELECT id, sku_id, CAST(original_amount AS DOUBLE) AS original_amount,
  CAST(activity_reduce_amount AS DOUBLE) AS activity_reduce_amount,
  CAST(coupon_reduce_amount AS DOUBLE) AS coupon_reduce_amount, CAST(order_amount AS DOUBLE) AS order_amount
FROM delta
"""

PROVINCE = DELTA + """,
placed AS (
  SELECT delta.*, CAST(c_nationkey AS VARCHAR) AS province_id
  FROM delta JOIN orders ON delta.order_id = CAST(o_orderkey AS VARCHAR)
  JOIN customer ON c_custkey = o_custkey
)"""

ORACLE["province_deltas"] = f"""
WITH {PROVINCE} SELECT id, province_id, CAST(order_amount AS DOUBLE) AS order_amount FROM placed
"""

FLAGGED = """
flagged AS (
  SELECT *, CASE WHEN LAG(CAST(ts AS DATE)) OVER (PARTITION BY mid ORDER BY event_id) = CAST(ts AS DATE)
    THEN 0 ELSE 1 END AS uv
  FROM {source}
)"""

TRAFFIC = f"""
SELECT {stamps("ts")}, vc, ch, ar, is_new, CAST(SUM(uv) AS BIGINT) AS uv_ct,
  CAST(SUM(CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS sv_ct,
  COUNT(*) AS pv_ct, CAST(SUM(during_time) AS BIGINT) AS dur_sum
FROM flagged GROUP BY time_bucket(INTERVAL 10 SECOND, ts), vc, ch, ar, is_new
"""

ORACLE["traffic_window"] = f"WITH {PG}, {FLAGGED.format(source='pg')} {TRAFFIC}"

ORACLE["repaired_traffic_window"] = f"""
WITH {LG}, shown AS (SELECT * FROM fixed WHERE NOT is_start), {FLAGGED.format(source='shown')} {TRAFFIC}
"""

ORACLE["home_detail_window"] = f"""
WITH {HOME}
SELECT {stamps("ts")}, CAST(SUM(home_uv_ct) AS BIGINT) AS home_uv_ct,
  CAST(SUM(good_detail_uv_ct) AS BIGINT) AS good_detail_uv_ct
FROM firsts GROUP BY time_bucket(INTERVAL 10 SECOND, ts)
"""

ATOMS = (
    r"regexp_extract_all(regexp_replace(lower({text}), '(\p{{Han}}+)', ' \1 ', 'g'), '[\p{{L}}\p{{M}}\p{{N}}\p{{Han}}]+')"
)


def words(text: str) -> str:
    """List of words of ``text``, one null when it has none; ideograph runs by character."""
    atoms = ATOMS.format(text=text)
    split = f"flatten([CASE WHEN regexp_full_match(a, '\\p{{Han}}+') THEN string_split(a, '') ELSE [a] END FOR a IN {atoms}])"
    return f"unnest(CASE WHEN len({atoms}) = 0 THEN [NULL] ELSE {split} END)"


ORACLE["keyword_window"] = f"""
WITH {PG}, w AS (
  SELECT ts, {words("item")} AS keyword FROM pg WHERE last_page_id = 'search' AND item_type = 'keyword'
)
SELECT {stamps("ts")}, keyword, COUNT(*) AS keyword_count
FROM w GROUP BY time_bucket(INTERVAL 10 SECOND, ts), keyword
"""

ORACLE["document_keyword_window"] = f"""
WITH w AS (
  SELECT TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id) AS ts, {words("text")} AS keyword FROM documents
)
SELECT {stamps("ts")}, keyword, COUNT(*) AS keyword_count
FROM w GROUP BY time_bucket(INTERVAL 10 SECOND, ts), keyword
"""

ORACLE["login_window"] = f"""
WITH {LOGIN}
SELECT {stamps("ts")}, CAST(SUM(back_ct) AS BIGINT) AS back_ct, CAST(SUM(uu_ct) AS BIGINT) AS uu_ct
FROM users GROUP BY time_bucket(INTERVAL 10 SECOND, ts)
"""

ORACLE["register_window"] = f"""
SELECT {stamps("ts")}, COUNT(*) AS register_ct FROM events WHERE event_type = 'signup'
GROUP BY time_bucket(INTERVAL 10 SECOND, ts)
"""

ORACLE["cart_add_window"] = f"""
WITH {ADDS}
SELECT {stamps("ts")}, COUNT(*) AS cart_add_uu_ct FROM adders GROUP BY time_bucket(INTERVAL 10 SECOND, ts)
"""

SKU = DELTA + f""",
summed AS (
  SELECT {stamps("arrived")}, sku_id, SUM(original_amount) AS original_amount,
    SUM(activity_reduce_amount) AS activity_reduce_amount,
    SUM(coupon_reduce_amount) AS coupon_reduce_amount, SUM(order_amount) AS order_amount
  FROM delta GROUP BY time_bucket(INTERVAL 10 SECOND, arrived), sku_id
)"""

ORACLE["sku_order_window"] = f"""
WITH {SKU}
SELECT stt, edt, cur_date, sku_id, CAST(original_amount AS DOUBLE) AS original_amount,
  CAST(activity_reduce_amount AS DOUBLE) AS activity_reduce_amount,
  CAST(coupon_reduce_amount AS DOUBLE) AS coupon_reduce_amount, CAST(order_amount AS DOUBLE) AS order_amount,
  p_name AS sku_name, CAST(p_size AS VARCHAR) AS spu_id, 'spu ' || CAST(p_size AS VARCHAR) AS spu_name,
  p_brand AS trademark_id, CASE WHEN p_brand <> 'Brand#7' THEN upper(p_brand) END AS trademark_name,
  p_type AS category3_id, lower(p_type) AS category3_name,
  substr(p_type, 1, 2) AS category2_id, 'c2 ' || substr(p_type, 1, 2) AS category2_name,
  substr(p_type, 1, 1) AS category1_id, 'c1 ' || substr(p_type, 1, 1) AS category1_name
FROM summed LEFT JOIN part ON sku_id = CAST(p_partkey AS VARCHAR)
"""

ORACLE["sku_order_first_hop"] = f"""
WITH {SKU}
SELECT stt, sku_id, p_name AS sku_name, CAST(p_size AS VARCHAR) AS spu_id, p_brand AS trademark_id,
  p_type AS category3_id, CAST(order_amount AS DOUBLE) AS order_amount
FROM summed LEFT JOIN part ON sku_id = CAST(p_partkey AS VARCHAR)
"""

ORACLE["province_order_window"] = f"""
WITH {PROVINCE}, summed AS (
  SELECT {stamps("arrived")}, province_id, COUNT(DISTINCT order_id) AS order_count,
    CAST(SUM(order_amount) AS DOUBLE) AS order_amount
  FROM placed GROUP BY time_bucket(INTERVAL 10 SECOND, arrived), province_id
)
SELECT summed.*, CASE WHEN n_regionkey <> 4 THEN n_name ELSE '' END AS province_name
FROM summed JOIN nation ON province_id = CAST(n_nationkey AS VARCHAR)
"""

ORACLE["time_functions"] = f"""
SELECT event_id, strftime(ts, {TIME}) AS time, strftime(ts, '%Y-%m-%d') AS date,
  strftime(ts, '%Y%m%d') AS partition_day,
  CAST(date_diff('second', CAST(CAST(ts AS DATE) AS TIMESTAMP), date_trunc('second', ts)) * 1000 AS BIGINT) AS ms_of_day,
  strftime(ts, {TIME}) AS again
FROM events
"""

ORACLE["wire_scalars"] = f"""
WITH {LN}
SELECT id, CAST(order_id AS BIGINT) AS "orderNumber", CAST(NULL AS BIGINT) AS "notANumber",
  CAST(cnt * price AS DOUBLE) AS "fullPrice"
FROM ln
"""

ORACLE["json_lines"] = f"""
SELECT '{{"id":"' || CAST(event_id AS VARCHAR) || '"' ||
  CASE WHEN event_type = 'signup' THEN ',"create_time":"' || strftime(ts, {TIME}) || '"' ELSE '' END || '}}' AS value
FROM events
"""

ORACLE["document_keywords"] = f"""
WITH w AS (SELECT doc_id, {words("text")} AS keyword FROM documents)
SELECT doc_id, keyword, COUNT(*) AS n FROM w GROUP BY doc_id, keyword
"""

ORACLE["conversation_keywords"] = f"""
WITH w AS (SELECT role, {words("text")} AS keyword FROM conversations)
SELECT role, keyword, COUNT(*) AS n FROM w GROUP BY role, keyword
"""

ORACLE["dictionary_keywords"] = f"""
WITH RECURSIVE dict AS (
  SELECT DISTINCT translate(w, '0123456789', '{HAN_DIGITS}') AS word FROM (
    SELECT CAST(p_size AS VARCHAR) AS w FROM part
    UNION ALL SELECT lpad(CAST(p_partkey AS VARCHAR), CAST(3 + p_partkey % 10 AS INTEGER), '0') FROM part)
), phrase AS (
  SELECT c_custkey, translate(c_name, '0123456789', '{HAN_DIGITS}') AS item FROM customer
), atom AS (
  SELECT c_custkey, row_number() OVER () AS n, a FROM (
    SELECT c_custkey, unnest({ATOMS.format(text="item")}) AS a FROM phrase)
), han AS (
  SELECT *, length(a) AS chars FROM atom WHERE regexp_full_match(a, '\\p{{Han}}+')
), places AS (
  SELECT n, a, unnest(range(1, chars + 1)) AS pos FROM han
), sizes AS (
  SELECT n, pos, max(length(word)) AS size FROM places JOIN dict ON word = substr(a, pos, length(word)) GROUP BY n, pos
), walk AS (
  SELECT c_custkey, n, a, chars, CAST(1 AS BIGINT) AS pos FROM han
  UNION ALL
  SELECT c_custkey, walk.n, a, chars, walk.pos + coalesce(size, 1)
  FROM walk LEFT JOIN sizes ON walk.n = sizes.n AND walk.pos = sizes.pos WHERE walk.pos <= chars
), word AS (
  SELECT c_custkey, substr(a, walk.pos, coalesce(size, 1)) AS keyword
  FROM walk LEFT JOIN sizes ON walk.n = sizes.n AND walk.pos = sizes.pos WHERE walk.pos <= chars
  UNION ALL SELECT c_custkey, a FROM atom WHERE NOT regexp_full_match(a, '\\p{{Han}}+')
)
SELECT c_custkey, keyword, COUNT(*) AS n FROM word GROUP BY c_custkey, keyword
"""
