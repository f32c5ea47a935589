"""Warehouse inputs derived from the test tables: page logs, change records, facts, dimensions.

Every derivation covers its whole table. ``oracle.py`` states the same derivations in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivermill.config import DATABASE
from rivermill.operators.skew import Arrival
from rivermill.sources.topics import spread, with_row_time

DAY = "20240131"
TEXT = "string"
FACTS = ("events", "lineitem", "orders", "documents", "conversations")
LINE_ORDER = ("at", "n1", "n2", "n3")

BY_EVENT = Arrival.by_number("event_id")
# Arrival of order lines: ship date first; a chunk holds a thousand products of one day.
BY_LINE = Arrival(LINE_ORDER, "struct(at, n1 div 1000)")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    read = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(read) if name in FACTS else read


def cents(column: str) -> Column:
    return F.col(column).cast("decimal(16,2)").cast(TEXT)


def _steps(*bounds: tuple[int, str | None], last: str | None) -> Column:
    """Value by ranges of ``k``: the first bound above ``k`` decides."""
    chain = F.when(F.col("k") < bounds[0][0], F.lit(bounds[0][1]))
    for bound, value in bounds[1:]:
        chain = chain.when(F.col("k") < bound, F.lit(value))
    return chain.otherwise(F.lit(last))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "events")
    return raw.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("at"),
        F.col("user_id").cast(TEXT).alias("user_id"),
        "event_type",
        "value",
        F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"),
    )


def page_rows(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """Flat page facts, one per event."""
    page_id = F.create_map(
        *[F.lit(x) for x in (
            "view", "home", "click", "good_detail", "purchase", "payment",
            "signup", "register", "error", "mine",
        )]
    )
    return events(spark, sf_dir).select(
        "event_id",
        F.col("user_id").alias("mid"),
        F.col("user_id").alias("uid"),
        _steps((30, "v1"), (70, "v2"), last="v3").alias("vc"),
        _steps((45, "web"), last="store").alias("ch"),
        _steps((25, "110000"), (60, "310000"), last="440000").alias("ar"),
        _steps((50, "1"), last="0").alias("is_new"),
        page_id[F.col("event_type")].alias("page_id"),
        _steps((20, None), (35, "login"), (75, "search"), last="home").alias("last_page_id"),
        _steps((60, "keyword"), last="sku_id").alias("item_type"),
        F.concat_ws(" ", "event_type", F.col("k").cast(TEXT)).alias("item"),
        F.floor(F.col("value") * 100).cast(TEXT).alias("during_time"),
        F.unix_millis("at").alias("ts"),
        *keep,
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw log texts: starts, pages, errors, displays, actions, and dirty records of two kinds."""
    rows = page_rows(spark, sf_dir, "event_type", "k")
    k = F.col("k").cast(TEXT)
    start = F.struct(F.lit("icon").alias("entry"), F.col("k").alias("loading_time"))
    err = F.struct(F.col("k").alias("error_code"), F.lit("broken").alias("msg"))
    shown = F.array(
        *[
            F.struct(
                (F.col("k") + place).cast(TEXT).alias("item"), F.lit(str(place + 1)).alias("pos_id"),
                F.lit(place + 1).alias("pos_seq"), F.struct(F.col("k").alias("at")).alias("shown"),
            )
            for place in (0, 1)
        ]
    )
    acted = F.array(F.create_map(F.lit("action_id"), F.lit("favor_add"), F.lit("item"), k))
    is_start = F.col("event_type") == "signup"
    common = F.struct(
        F.when(F.col("k") < 97, F.col("mid")).alias("mid"), "uid", "vc", "ch", "ar", "is_new",
        F.when(F.col("k") % 2 == 0, "linux").otherwise("mac").alias("os"),
    )
    page = F.struct(
        "page_id", "last_page_id", "item", "item_type", F.col("during_time").cast("bigint").alias("during_time"),
    )
    has_page = ~is_start | (F.col("k") < 30)
    record = F.to_json(
        F.struct(
            common.alias("common"),
            F.when(has_page, page).alias("page"),
            F.when(is_start, start).alias("start"),
            F.when(F.col("event_type") == "error", err).alias("err"),
            F.when(F.col("event_type") == "view", shown).alias("displays"),
            F.when(F.col("event_type") == "click", acted).alias("actions"),
            F.col("ts"),
        )
    )
    return rows.select(
        "event_id", F.when(F.col("k") == 96, F.substring(record, 1, 30)).otherwise(record).alias("value")
    )


def registered_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sign-ups; other events lack a creation time."""
    made = F.when(F.col("event_type") == "signup", F.date_format("at", "yyyy-MM-dd HH:mm:ss"))
    return events(spark, sf_dir).select(F.col("event_id").cast(TEXT).alias("id"), made.alias("create_time"))


def cart_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cart-add facts; events that are not clicks or purchases have no user."""
    adds = F.col("event_type").isin("click", "purchase")
    return events(spark, sf_dir).select(
        "event_id", F.when(adds, F.col("user_id")).alias("user_id"), F.unix_seconds("at").alias("ts")
    )


def line_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their arrival columns and the wire values of their fields."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("timestamp").alias("at"),
        F.col("l_partkey").alias("n1"),
        F.col("l_suppkey").alias("n2"),
        F.col("l_extendedprice").alias("n3"),
        F.concat_ws("-", F.col("l_orderkey").cast(TEXT), F.col("l_linenumber").cast(TEXT)).alias("id"),
        F.col("l_orderkey").cast(TEXT).alias("order_id"),
        F.col("l_partkey").cast(TEXT).alias("sku_id"),
        F.col("l_suppkey").cast(TEXT).alias("supplier"),
        F.col("l_linenumber").alias("line"),
        cents("l_extendedprice").alias("price"),
        F.col("l_quantity").cast("int").alias("count"),
        cents("l_discount").alias("discount"),
        cents("l_tax").alias("tax"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("status"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("create_time"),
        F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("ts"),
    )


def change(table_name: Column | str, kind: Column | str, data: Column, old: Column | None = None) -> list[Column]:
    """Columns of a change record of the shop database."""
    def text(value: Column | str) -> Column:
        return F.lit(value) if isinstance(value, str) else value

    return [
        F.lit(DATABASE).alias("database"),
        text(table_name).alias("table"),
        text(kind).alias("type"),
        data.alias("data"),
        (F.lit(None).cast("map<string,string>") if old is None else old).alias("old"),
        F.col("ts"),
    ]


def text_map(**fields: Column) -> Column:
    return F.create_map(*[part for key, value in fields.items() for part in (F.lit(key), value.cast(TEXT))])


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inserts of order lines, orders, activities and coupons in one changelog."""
    lines = line_changes(spark, sf_dir)
    detail = text_map(
        id=F.col("id"), order_id=F.col("order_id"), sku_id=F.col("sku_id"),
        sku_name=F.concat(F.lit("sku "), F.col("sku_id")), order_price=F.col("price"),
        sku_num=F.col("count"), create_time=F.col("create_time"),
        split_total_amount=F.col("price"), split_activity_amount=F.col("discount"),
        split_coupon_amount=F.col("tax"),
    )
    activity = text_map(
        order_detail_id=F.col("id"), activity_id=F.col("supplier"), activity_rule_id=F.col("line")
    )
    coupon = text_map(order_detail_id=F.col("id"), coupon_id=F.col("supplier"))
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("timestamp").alias("at"),
        F.col("o_orderkey").alias("n1"),
        F.lit(0).cast("bigint").alias("n2"),
        F.lit(0.0).alias("n3"),
        F.col("o_custkey"),
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("ts"),
    )
    info = text_map(
        id=F.col("n1"), user_id=F.col("o_custkey"), province_id=F.pmod("o_custkey", F.lit(34))
    )
    return (
        lines.select(*LINE_ORDER, *change("order_detail", "insert", detail))
        .unionByName(orders.select(*LINE_ORDER, *change("order_info", "insert", info)))
        .unionByName(
            lines.filter(F.col("flag") == "A").select(
                *LINE_ORDER, *change("order_detail_activity", "insert", activity)
            )
        )
        .unionByName(
            lines.filter(F.col("status") == "O").select(
                *LINE_ORDER, *change("order_detail_coupon", "insert", coupon)
            )
        )
    )


def cart_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw change texts of cart lines: inserts, count changes up and down, other updates, deletes."""
    data = text_map(
        id=F.col("id"), user_id=F.col("supplier"), sku_id=F.col("sku_id"),
        cart_price=F.col("price"), sku_num=F.col("count"), create_time=F.col("create_time"),
    )
    kind = F.when(F.col("flag") == "A", "insert").when(F.col("flag") == "N", "update").otherwise("delete")
    old = F.when(
        F.col("flag") == "N",
        F.when(F.col("status") == "O", text_map(sku_num=F.col("line") * 5)).otherwise(
            text_map(is_checked=F.lit("0"))
        ),
    )
    record = F.to_json(F.struct(*change("cart_info", kind, data, old)))
    return line_changes(spark, sf_dir).select(record.alias("value"))


def comment_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn(
        "ts", F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    )
    data = text_map(
        id=F.col("o_orderkey"), user_id=F.col("o_custkey"), order_id=F.col("o_orderkey"),
        appraise=F.concat(F.lit("120"), F.substring("o_orderpriority", 1, 1)),
        comment_txt=F.col("o_orderpriority"),
        create_time=F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"),
    )
    kind = F.when(F.col("o_orderstatus") == "O", "update").otherwise("insert")
    return orders.select(*change("comment_info", kind, data))


def payment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw change texts of payments: every event is an update of one payment."""
    data = text_map(
        id=F.col("event_id"), order_id=F.col("user_id"), user_id=F.col("user_id"),
        payment_type=_steps((25, "1101"), (50, "1102"), (75, "1103"), last="1104"),
        total_amount=cents("value"),
        callback_time=F.date_format("at", "yyyy-MM-dd HH:mm:ss"),
        payment_status=_steps((80, "1602"), last="1601"),
    )
    old = F.when(F.col("k") < 90, text_map(payment_status=F.lit("1601")))
    kind = F.when(F.col("event_type") == "purchase", "update").otherwise("insert")
    rows = events(spark, sf_dir).withColumn("ts", F.unix_seconds("at"))
    return rows.select(F.to_json(F.struct(*change("payment_info", kind, data, old))).alias("value"))


def clicked_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order facts for the payment join: one line per click, the user standing in for the order."""
    none = F.lit(None).cast(TEXT)
    clicks = events(spark, sf_dir).filter(F.col("event_type") == "click")
    facts = clicks.select(
        F.col("event_id").cast(TEXT).alias("id"), F.col("user_id").alias("order_id"),
        F.col("k").cast(TEXT).alias("sku_id"), F.col("user_id"), none.alias("province_id"),
        none.alias("activity_id"), none.alias("activity_rule_id"), none.alias("coupon_id"),
        none.alias("sku_name"), cents("value").alias("order_price"), F.lit("1").alias("sku_num"),
        none.alias("create_time"), cents("value").alias("split_total_amount"),
        none.alias("split_activity_amount"), none.alias("split_coupon_amount"),
        F.unix_seconds("at").alias("ts"),
    )
    return with_row_time(facts)


def order_fact_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order facts with re-sent lines kept, as the amount jobs read them."""
    lines = line_changes(spark, sf_dir)
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast(TEXT).alias("order_id"), "o_custkey"
    )
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").cast(TEXT).alias("province_id")
    )
    facts = lines.join(orders, "order_id", "left").join(customers, "o_custkey", "left")
    return _amounts(facts, "order_id", "province_id")


def sku_fact_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _amounts(line_changes(spark, sf_dir), "order_id")


def _amounts(lines: DataFrame, *keep: str) -> DataFrame:
    return lines.select(
        *LINE_ORDER, "id", "sku_id", *keep,
        F.col("price").alias("order_price"), F.col("count").cast(TEXT).alias("sku_num"),
        F.col("price").alias("split_total_amount"), F.col("discount").alias("split_activity_amount"),
        F.col("tax").alias("split_coupon_amount"), "ts",
    )


def sku_dimensions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Product snowflake out of the part table; brand 7 has no trademark row of its key."""
    part = table(spark, sf_dir, "part")
    size, kind = F.col("p_size").cast(TEXT), F.col("p_type")
    kinds = part.select(kind.alias("key")).distinct()
    second = F.substring("key", 1, 2)
    firsts = kinds.select(second.alias("key")).distinct()
    return {
        "dim_sku_info": part.select(
            F.col("p_partkey").cast(TEXT).alias("key"), size.alias("spu_id"),
            F.col("p_brand").alias("tm_id"), kind.alias("category3_id"), F.col("p_name").alias("sku_name"),
        ),
        "dim_spu_info": part.select(size.alias("key"), F.concat(F.lit("spu "), size).alias("spu_name")).distinct(),
        "dim_base_trademark": part.select(
            F.regexp_replace("p_brand", "#7$", "#none").alias("key"), F.upper("p_brand").alias("tm_name")
        ).distinct(),
        "dim_base_category3": kinds.select("key", F.lower("key").alias("name"), second.alias("category2_id")),
        "dim_base_category2": firsts.select(
            "key", F.concat(F.lit("c2 "), F.col("key")).alias("name"),
            F.substring("key", 1, 1).alias("category1_id"),
        ),
        "dim_base_category1": firsts.select(
            F.substring("key", 1, 1).alias("key"),
            F.concat(F.lit("c1 "), F.substring("key", 1, 1)).alias("name"),
        ).distinct(),
    }


def provinces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as provinces; the nations of region 4 have keys no order knows."""
    number = F.col("n_nationkey").cast(TEXT)
    key = F.when(F.col("n_regionkey") == 4, F.concat(F.lit("x"), number)).otherwise(number)
    return table(spark, sf_dir, "nation").select(key.alias("key"), F.col("n_name").alias("name"))


def dictionary(spark: SparkSession) -> DataFrame:
    """Codes with names; 1104 and 1205 are unknown."""
    return spark.sql(
        """
        SELECT code AS rowkey, named_struct('dic_name', name) AS info FROM VALUES
          ('1101', 'card'), ('1102', 'wallet'), ('1103', 'bank'),
          ('1201', 'best'), ('1202', 'good'), ('1203', 'fair'), ('1204', 'poor') AS t(code, name)
        """
    )


def dimension_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Puts and deletes of three source tables; names are null on discounted lines."""
    data = text_map(
        id=F.col("id"),
        name=F.when(F.col("discount") <= "0.05", F.concat(F.lit("n"), F.col("supplier"))),
        price=F.col("price"),
        secret=F.lit("x"),
    )
    name = F.when(F.col("flag") == "A", "sku_info").when(F.col("flag") == "N", "spu_info").otherwise("cart_info")
    kind = F.when(F.col("count") < 10, "delete").when(F.col("count") < 30, "update").otherwise("insert")
    return line_changes(spark, sf_dir).select(*LINE_ORDER, *change(name, kind, data))


def dimension_rules(spark: SparkSession) -> DataFrame:
    return spark.sql(
        """
        SELECT * FROM VALUES
          ('sku_info', 'dim_sku_info', 'id,name,price', 'info', 'id'),
          ('spu_info', 'dim_spu_info', 'id,name', 'info', 'id')
          AS t(source_table, sink_table, sink_columns, sink_family, sink_row_key)
        """
    )


def fact_rules(spark: SparkSession) -> DataFrame:
    return spark.sql(
        """
        SELECT * FROM VALUES
          ('sku_info', 'insert', 'dwd_sku_new', 'id,price'),
          ('sku_info', 'update', 'dwd_sku_changed', 'id'),
          ('cart_info', 'insert', 'dwd_cart', 'price,secret')
          AS t(source_table, source_type, sink_table, sink_columns)
        """
    )


def rule_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change envelopes of rules, one per order: a customer's orders change one rule."""
    rule = F.struct(
        F.concat(F.lit("t"), F.col("o_custkey").cast(TEXT)).alias("source_table"),
        F.concat(F.lit("dim_"), F.substring("o_orderpriority", 1, 1)).alias("sink_table"),
        F.lit("id,name").alias("sink_columns"),
        F.lit("info").alias("sink_family"),
        F.lit("id").alias("sink_row_key"),
    )
    op = (
        F.when(F.col("o_orderstatus") == "O", "r").when(F.col("o_orderstatus") == "P", "u").otherwise("d")
    )
    gone = F.col("o_orderstatus") == "F"
    record = F.struct(
        op.alias("op"), F.when(gone, rule).alias("before"), F.when(~gone, rule).alias("after")
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", F.to_json(record).alias("value"))


def dated_rule_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same envelopes with the moment of their order's day."""
    days = table(spark, sf_dir, "orders").select("o_orderkey", _day_seconds(0).alias("at"))
    dated = rule_envelopes(spark, sf_dir).join(days, "o_orderkey")
    stamp = F.concat(F.lit('{"ts_ms":'), (F.col("at") * 1000).cast(TEXT), F.lit(","), F.expr("substring(value, 2)"))
    return dated.select("o_orderkey", stamp.alias("value"))


def dated_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change record for each order, thirty days after it, in the table that the customer's rules speak of."""
    record = F.struct(
        F.lit(DATABASE).alias("database"), F.concat(F.lit("t"), F.col("o_custkey").cast(TEXT)).alias("table"),
        F.lit("insert").alias("type"), _day_seconds(30).alias("ts"),
        F.struct(F.col("o_orderkey").cast(TEXT).alias("id"), F.col("o_orderpriority").alias("name"), F.lit("x").alias("secret")).alias("data"),
    )
    return table(spark, sf_dir, "orders").select(F.to_json(record).alias("value"))


def _day_seconds(later: int) -> Column:
    return (F.unix_date(F.to_date("o_orderdate")) + later).cast("bigint") * 86_400


def dimension_drops(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Moments at which rule changes drop the dimension tables, as arrival columns of ``rows``; one table twice."""
    days = [("dim_sku_info", "1995-06-01"), ("dim_sku_info", "1997-01-01"), ("dim_spu_info", "1996-03-01")]
    drops = spark.createDataFrame(days, "sink_table string, day string")
    kind = rows.select(F.struct(*LINE_ORDER).alias("moment")).schema["moment"].dataType
    moment = F.struct(F.col("day").cast("timestamp"), F.lit(0), F.lit(0), F.lit(0)).cast(kind)
    return drops.select("sink_table", moment.alias("moment"))


def rule_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules as they stood before any change, one per customer."""
    return table(spark, sf_dir, "customer").select(
        F.lit("r").alias("op"),
        F.concat(F.lit("t"), F.col("c_custkey").cast(TEXT)).alias("source_table"),
        F.concat(F.lit("dim_n"), F.col("c_nationkey").cast(TEXT)).alias("sink_table"),
        F.lit("id").alias("sink_columns"),
        F.lit("info").alias("sink_family"),
        F.lit("id").alias("sink_row_key"),
    )


def order_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order facts as texts of a keyed topic; every fifth line has a tombstone or a blank instead of its text."""
    lines = line_changes(spark, sf_dir)
    fact = F.struct(
        "id", "order_id", "sku_id", F.col("count").cast(TEXT).alias("sku_num"), F.col("price").alias("split_total_amount"), "ts",
    )
    gone = F.when(F.col("line") == 4, F.lit(None).cast(TEXT)).when(F.col("line") == 5, F.lit("  "))
    return lines.select(F.when(F.col("line").isin(4, 5), gone).otherwise(F.to_json(fact)).alias("value"))


def document_searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as one search phrase, one per second."""
    at = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, doc_id)")
    return table(spark, sf_dir, "documents").select(
        F.lit("search").alias("last_page_id"),
        F.lit("keyword").alias("item_type"),
        F.col("text").alias("item"),
        F.unix_millis(at.cast("timestamp")).alias("ts"),
    )


HAN_DIGITS = "零一二三四五六七八九"


def han_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer names with their digits written as ideographs."""
    name = F.translate("c_name", "0123456789", HAN_DIGITS)
    return table(spark, sf_dir, "customer").select("c_custkey", name.alias("item"))


def han_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part sizes and padded part keys written as ideographs: words of one to twelve characters."""
    parts = table(spark, sf_dir, "part")
    padded = F.lpad(F.col("p_partkey").cast(TEXT), (3 + F.col("p_partkey") % 10).cast("int"), F.lit("0"))
    words = parts.select(F.col("p_size").cast(TEXT).alias("w")).unionAll(parts.select(padded)).distinct()
    return words.select(F.translate("w", "0123456789", HAN_DIGITS).alias("word"))
