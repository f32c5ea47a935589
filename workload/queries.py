"""One query per operator and job, each over its whole stand-in tables.

Results carry text, numbers and doubles only: window bounds and days as text, money as double
after exact decimal sums.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivermill import schemas
from rivermill.functions import keywords, times, wire
from rivermill.operators import (
    clean,
    deltas,
    enrich,
    joins,
    project,
    routing,
    skew,
    split,
    upsert,
    visitors,
    windows,
)
from rivermill.plans import aggregates, detail, dimensions
from rivermill.sources import config_log, topics
from workload import standins as s

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _doubles(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("double") for name in names})


def _counted(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


# --- sources -----------------------------------------------------------------------------------


@query
def topic_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw log topic with blank records dropped: every text that is left, as a digest with its length."""
    lines = s.log_lines(spark, sf_dir).withColumn(
        "value", F.when(F.col("event_id") > 0, F.col("value")).otherwise(F.lit(" "))
    )
    kept = topics.non_empty(lines)
    # The number of milliseconds depends on the session's zone: it is compared as local time.
    ts = F.regexp_extract("value", '"ts":([0-9]+)', 1).try_cast("bigint")
    rest = F.regexp_replace("value", '"ts":[0-9]+', '"ts"')
    return kept.select(
        "event_id", F.length("value").alias("chars"), F.sha2(rest, 256).alias("digest"), times.ms_to_date_time(ts).alias("time")
    )


@query
def change_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records parsed from text, with event time."""
    parsed = topics.changes(s.cart_lines(spark, sf_dir))
    return _counted(
        parsed.select(
            "table",
            "type",
            F.date_format("row_time", times.DATE).alias("day"),
            F.col("old")["sku_num"].isNotNull().cast("int").alias("has_old_count"),
        ),
        "table",
        "type",
        "day",
        "has_old_count",
    )


@query
def config_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules in force after folding the snapshot and change envelopes."""
    changes = config_log.envelopes(s.rule_envelopes(spark, sf_dir), schemas.DIM_RULE, "o_orderkey")
    changes = config_log.with_snapshot(s.rule_snapshot(spark, sf_dir), changes, ["o_orderkey"])
    in_force = config_log.rules(changes, config_log.DIM_KEY, ["o_orderkey"])
    return in_force.select("source_table", "sink_table", "sink_columns", "sink_row_key")


@query
def dated_rule_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimension rows by the rule that was in force at each record's moment."""
    changes = config_log.dated(s.dated_rule_envelopes(spark, sf_dir), schemas.DIM_RULE, "o_orderkey")
    versions = config_log.versions(None, changes, config_log.DIM_KEY, ["o_orderkey"])
    records = topics.changes(s.dated_records(spark, sf_dir))
    rows = dimensions.dimension_rows(records, versions, at=F.col("ts") * 1000)
    return rows.select("sink_table", "row_key", F.array_join(F.map_values("data"), ",").alias("data"))


@query
def order_topic_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order facts read back from the texts of their keyed topic, tombstones skipped."""
    rows = topics.order_facts(s.order_texts(spark, sf_dir))
    return rows.select(
        "id", "order_id", "sku_id", "sku_num", "split_total_amount",
        times.ms_to_date_time(F.col("ts") * 1000).alias("time"),
    )


@query
def dimension_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both dimension tables after rule changes dropped each at its moment and made it anew."""
    changes, rules = s.dimension_changes(spark, sf_dir), s.dimension_rules(spark)
    rows = dimensions.dimension_rows(changes, rules, *s.LINE_ORDER)
    drops = s.dimension_drops(spark, rows)
    folded = upsert.fold_dimensions(rows, s.LINE_ORDER, ["id", "name", "price"], drops)
    return folded.select("sink_table", "row_key", "name", "price")


@query
def dimension_point_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dimension of the fold looked up by the keys of all order lines; missing rows keep the line."""
    changes, rules = s.dimension_changes(spark, sf_dir), s.dimension_rules(spark)
    folded = dimensions.dimension_state(changes, rules, s.LINE_ORDER)
    names = upsert.dimension_table(folded, "dim_sku_info", ["name", "price"])
    keys = s.line_changes(spark, sf_dir).select("id").distinct()
    read = keys.join(names, F.col("id") == F.col("key"), "left")
    return read.select("id", "name", "price", F.col("key").isNotNull().cast("int").alias("found"))


@query
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest emission of every order line."""
    rows = upsert.latest(s.sku_fact_rows(spark, sf_dir), ["id"], s.LINE_ORDER)
    return rows.select("id", "sku_id", "sku_num", "split_total_amount")


@query
def dimension_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both dimension tables after all puts and deletes."""
    changes, rules = s.dimension_changes(spark, sf_dir), s.dimension_rules(spark)
    folded = dimensions.dimension_state(changes, rules, s.LINE_ORDER)
    return folded.select("sink_table", "row_key", "name", "price")


@query
def dimension_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both dimension tables, with each year's changes merged into the state before them."""
    rows = dimensions.dimension_rows(s.dimension_changes(spark, sf_dir), s.dimension_rules(spark), *s.LINE_ORDER)
    state, year = None, F.year("at")
    for part in (year < 1997, (year >= 1997) & (year < 2000), year >= 2000):
        state = upsert.merge_dimensions(state, rows.filter(part), s.LINE_ORDER)
    return state.select("sink_table", "row_key", F.col("data")["name"].alias("name"), F.col("data")["price"].alias("price"))


# --- log layer ---------------------------------------------------------------------------------


def _logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.logs(s.log_lines(spark, sf_dir), "event_id")


@query
def log_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_logs(_logs(spark, sf_dir)).select(
        "event_id",
        F.col("common.mid").alias("mid"),
        F.col("page.page_id").alias("page_id"),
        F.col("start").alias("start"),
        times.ms_to_date_time("ts").alias("time"),
    )


@query
def log_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = topics.all_logs(s.log_lines(spark, sf_dir), "event_id")
    _, dirty = clean.split_dirty(lines)
    return dirty.select("event_id", F.col("_bad").isNotNull().cast("int").alias("unreadable"))


@query
def new_visitor_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    repaired = visitors.repair_new_visitors(s.page_rows(spark, sf_dir), s.BY_EVENT)
    return repaired.select("event_id", "mid", "is_new")


@query
def log_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counted(split.errors(clean.clean_logs(_logs(spark, sf_dir))), "value")


@query
def log_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = split.starts(clean.clean_logs(_logs(spark, sf_dir)), "event_id")
    return rows.select("event_id", F.col("common.mid").alias("mid"), "start")


@query
def log_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = detail.page_rows(split.pages(clean.clean_logs(_logs(spark, sf_dir)), "event_id"), "event_id")
    return rows.select("event_id", "mid", "page_id", "last_page_id", "item", "during_time")


@query
def log_displays(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = split.displays(clean.clean_logs(_logs(spark, sf_dir)), "event_id")
    shown = F.get_json_object("display_text", "$.shown.at").alias("shown_at")
    return rows.select("event_id", "page.page_id", "display.item", "display.pos_id", shown)


@query
def log_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = split.actions(clean.clean_logs(_logs(spark, sf_dir)), "event_id")
    return rows.select("event_id", "page.page_id", "action.item", "action.action_id")


@query
def log_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five outputs with repaired flags, read back from their texts."""
    records = detail.log_topics(_logs(spark, sf_dir), s.BY_EVENT)
    read = F.get_json_object
    return _counted(
        records.select(
            "topic",
            F.coalesce(read("value", "$.common.mid"), F.lit("")).alias("mid"),
            F.coalesce(read("value", "$.common.is_new"), F.lit("")).alias("is_new"),
            F.coalesce(read("value", "$.page.page_id"), F.lit("")).alias("page_id"),
            F.coalesce(read("value", "$.item"), F.lit("")).alias("item"),
            # Members that no rule knows, and numbers, come through as they are.
            F.regexp_count("value", F.lit('"os":"(linux|mac)"')).alias("systems"),
            F.regexp_count("value", F.lit('"during_time":[0-9]+[,}]')).alias("times"),
            F.regexp_count("value", F.lit('"pos_seq":[12][,}]')).alias("places"),
        ),
        "topic",
        "mid",
        "is_new",
        "page_id",
        "item",
        "systems",
        "times",
        "places",
    )


# --- change layer ------------------------------------------------------------------------------


@query
def dimension_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimension changes after cleaning; supplier rows stand for bootstrap marks and empty data."""
    changes = s.dimension_changes(spark, sf_dir)
    marked = changes.withColumn(
        "type", F.when(F.col("n2") < 3, "bootstrap-start").when(F.col("n2") > 4, F.col("type"))
    ).withColumn("data", F.when(F.col("n1") != 7, F.col("data")))
    cleaned = clean.clean_dimension_changes(marked)
    return _counted(cleaned.select("table", F.coalesce("type", F.lit("none")).alias("type")), "table", "type")


@query
def dimension_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimension rows routed and pruned by the rules."""
    rows = dimensions.dimension_rows(s.dimension_changes(spark, sf_dir), s.dimension_rules(spark))
    return rows.select(
        "sink_table",
        "row_key",
        "type",
        F.array_join(F.map_keys("data"), ",").alias("columns"),
        F.col("data")["price"].alias("price"),
    )


@query
def fact_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts routed by table and type, as topic and JSON text."""
    return detail.routed_facts(s.dimension_changes(spark, sf_dir), s.fact_rules(spark))


@query
def comment_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = detail.comment_facts(s.comment_changes(spark, sf_dir), s.dictionary(spark))
    return rows.select("id", "user_id", "appraise_code", "appraise_name", "comment_txt", "create_time")


@query
def cart_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = detail.cart_facts(topics.changes(s.cart_lines(spark, sf_dir)))
    return rows.select("id", "user_id", "sku_id", "cart_price", "sku_num", "create_time")


@query
def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-line projection with the undiscounted amount."""
    rows = project.order_details(s.order_changes(spark, sf_dir))
    rows = _doubles(rows, "split_original_amount")
    return rows.select("id", "order_id", "sku_num", "order_price", "split_original_amount")


@query
def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = detail.order_facts(s.order_changes(spark, sf_dir), s.BY_LINE)
    return rows.select(
        "id", "order_id", "sku_id", "user_id", "province_id", "activity_id",
        "activity_rule_id", "coupon_id", "order_price", "sku_num", "create_time",
    )


@query
def order_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every change that the order join sends: early rows, retractions, corrected rows."""
    rows = detail.order_changelog(s.order_changes(spark, sf_dir), s.BY_LINE)
    return rows.select(
        "id", "op", "version", "order_id", "sku_id", "user_id", "province_id", "activity_id", "activity_rule_id",
        "coupon_id", "order_price", "sku_num", "create_time", "split_total_amount",
    )


@query
def changelog_sku_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amount changes summed over the whole changelog, as its readers see it: retractions carry no text."""
    changes = detail.order_changelog(s.order_changes(spark, sf_dir), s.BY_LINE)
    sent = clean.clean_sku_orders(changes.filter(F.col("op") != "retract"))
    rows = deltas.sku_deltas(sent, skew.Arrival.by_number("version"))
    summed = rows.groupBy("sku_id").agg(F.sum("order_amount").alias("order_amount"))
    return _doubles(summed, "order_amount")


@query
def payment_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = project.payments(topics.changes(s.payment_lines(spark, sf_dir)))
    return rows.select("id", "order_id", "payment_type", "total_amount", "callback_time")


@query
def payment_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = topics.changes(s.payment_lines(spark, sf_dir))
    rows = detail.payment_facts(changes, s.clicked_lines(spark, sf_dir), s.dictionary(spark))
    return rows.select("id", "order_id", "payment_type_code", "payment_type_name", "payment_time", "sku_id")


@query
def interval_join_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payment interval join with bounds of a day before and six hours after."""
    payments = project.payments(topics.changes(s.payment_lines(spark, sf_dir)), "row_time")
    rows = joins.paid_lines(payments, s.clicked_lines(spark, sf_dir), "24 hours", "6 hours")
    return rows.select("id", "order_id", "payment_type", "payment_time")


# --- visitor rules and deltas ------------------------------------------------------------------


@query
def daily_visitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = clean.clean_pages(s.page_rows(spark, sf_dir))
    flagged = visitors.daily_first(pages, ["mid"], "uv_ct", s.BY_EVENT)
    return flagged.select("event_id", "mid", "uv_ct")


@query
def session_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = visitors.session_measures(s.page_rows(spark, sf_dir))
    return rows.select("event_id", "sv_ct", "pv_ct", "dur_sum")


@query
def home_detail_firsts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = clean.clean_home_pages(s.page_rows(spark, sf_dir))
    rows = visitors.home_detail_firsts(pages, s.BY_EVENT)
    return rows.select("event_id", "mid", "home_uv_ct", "good_detail_uv_ct")


@query
def returning_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = visitors.unique_and_returning(clean.clean_logins(s.page_rows(spark, sf_dir)), s.BY_EVENT)
    return rows.select("event_id", "uid", "back_ct", "uu_ct")


@query
def cart_add_firsts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = visitors.cart_add_firsts(clean.clean_cart_adds(s.cart_rows(spark, sf_dir)), s.BY_EVENT)
    return rows.select("event_id", "user_id", "cart_add_uu_ct")


@query
def sku_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = deltas.sku_deltas(clean.clean_sku_orders(s.sku_fact_rows(spark, sf_dir)), s.BY_LINE)
    names = ("original_amount", "activity_reduce_amount", "coupon_reduce_amount", "order_amount")
    return _doubles(rows, *names).select("id", "sku_id", *names)


@query
def province_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = clean.clean_province_orders(s.order_fact_rows(spark, sf_dir))
    rows = deltas.province_deltas(facts, s.BY_LINE)
    return _doubles(rows, "order_amount").select("id", "province_id", "order_amount")


# --- window aggregates -------------------------------------------------------------------------


@query
def traffic_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.traffic(s.page_rows(spark, sf_dir), s.BY_EVENT, s.DAY)


@query
def repaired_traffic_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw log texts to traffic windows: clean, repair, split, flag and aggregate."""
    logs = _logs(spark, sf_dir)
    hot = skew.hot_keys(logs.select("common.mid"), ["mid"])
    pages = split.pages(detail.repaired_logs(logs, s.BY_EVENT), "event_id")
    return aggregates.traffic(detail.page_rows(pages, "event_id"), s.BY_EVENT, s.DAY, hot)


@query
def home_detail_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.home_detail(s.page_rows(spark, sf_dir), s.BY_EVENT, s.DAY)


@query
def keyword_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.keyword_views(s.page_rows(spark, sf_dir), s.DAY)


@query
def document_keyword_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of whole documents per window."""
    return aggregates.keyword_views(s.document_searches(spark, sf_dir), s.DAY)


@query
def login_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.logins(s.page_rows(spark, sf_dir), s.BY_EVENT, s.DAY)


@query
def register_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.registrations(s.registered_users(spark, sf_dir), s.DAY)


@query
def cart_add_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.cart_adders(s.cart_rows(spark, sf_dir), s.BY_EVENT, s.DAY)


@query
def sku_order_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = aggregates.sku_orders(
        s.sku_fact_rows(spark, sf_dir), s.sku_dimensions(spark, sf_dir), s.BY_LINE, s.DAY
    )
    names = ("original_amount", "activity_reduce_amount", "coupon_reduce_amount", "order_amount")
    return _doubles(rows, *names)


@query
def sku_order_first_hop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The variant that joins the product dimension only."""
    facts = clean.clean_sku_orders(s.sku_fact_rows(spark, sf_dir))
    rows = windows.sku_amounts(deltas.sku_deltas(facts, s.BY_LINE), s.DAY)
    named = enrich.sku_names(rows, s.sku_dimensions(spark, sf_dir))
    return _doubles(named, "order_amount").select(
        "stt", "sku_id", "sku_name", "spu_id", "trademark_id", "category3_id", "order_amount"
    )


@query
def province_order_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = aggregates.province_orders(
        s.order_fact_rows(spark, sf_dir), s.provinces(spark, sf_dir), s.BY_LINE, s.DAY
    )
    return _doubles(rows, "order_amount")


# --- functions ---------------------------------------------------------------------------------


@query
def time_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date and time scalars; milliseconds are shown within the day, so zones do not matter."""
    rows = s.page_rows(spark, sf_dir).withColumn("time", times.ms_to_date_time("ts"))
    rows = rows.withColumn("date", times.ms_to_date("ts"))
    return rows.select(
        "event_id",
        "time",
        "date",
        times.ms_to_partition("ts").alias("partition_day"),
        (times.text_to_ms("time") - times.date_text_to_ms("date")).alias("ms_of_day"),
        F.date_format(times.seconds_to_time(F.floor(F.col("ts") / 1000)), times.DATE_TIME).alias("again"),
    )


@query
def wire_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coerced wire numbers, decimal products and camel-case names."""
    lines = s.line_changes(spark, sf_dir)
    rows = lines.select(
        "id",
        wire.whole(F.col("order_id")).alias("order_number"),
        wire.whole(F.col("flag")).alias("not_a_number"),
        wire.times_price(F.col("count").cast("string"), F.col("price")).cast("double").alias("full_price"),
    )
    return wire.to_camel(rows)


@query
def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aggregate rows as JSON lines without hidden fields."""
    rows = wire.to_snake(s.registered_users(spark, sf_dir).withColumnRenamed("create_time", "createTime"))
    return wire.as_json(rows.withColumn("ts", F.lit(1)), hidden=["ts"])


@query
def document_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document, whole texts, with counts."""
    documents = s.table(spark, sf_dir, "documents").select("doc_id", "text")
    return _counted(keywords.explode_words(documents, "text").select("doc_id", "keyword"), "doc_id", "keyword")


@query
def conversation_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = s.table(spark, sf_dir, "conversations").select("role", "text")
    return _counted(keywords.explode_words(turns, "text").select("role", "keyword"), "role", "keyword")


@query
def dictionary_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ideograph runs split by longest match against a dictionary."""
    phrases = s.han_phrases(spark, sf_dir)
    words = keywords.explode_words(phrases, "item", s.han_dictionary(spark, sf_dir))
    return _counted(words, "c_custkey", "keyword")


@query
def topic_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Destination topics of routed facts with payload counts."""
    routed = routing.route_facts(s.dimension_changes(spark, sf_dir), s.fact_rules(spark))
    return _counted(routing.topic_records(routed).select("topic"), "topic")
