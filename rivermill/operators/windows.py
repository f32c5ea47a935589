"""Ten-second tumbling event-time aggregates, the same on batch and stream.

Grouping by window and keys pre-aggregates per task, so neither a hot key nor a window without keys
gathers its rows in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivermill.config import CHANGE_DELAY, LOG_DELAY, WINDOW
from rivermill.functions import times
from rivermill.functions.wire import MONEY_SUM
from rivermill.sources.topics import with_log_time


def tumble(
    df: DataFrame, keys: Sequence[str], measures: Sequence[Column], day: str | None = None
) -> DataFrame:
    """Aggregates ``row_time`` windows and stamps start, end and processing day as text."""
    today = F.lit(day) if day else F.date_format(F.current_date(), times.PARTITION_DATE)
    grouped = df.groupBy(F.window("row_time", WINDOW).alias("_window"), *keys).agg(*measures)
    return grouped.select(
        F.date_format("_window.start", times.DATE_TIME).alias("stt"),
        F.date_format("_window.end", times.DATE_TIME).alias("edt"),
        today.alias("cur_date"),
        *[c for c in grouped.columns if c != "_window"],
    )


def _sums(*names: str) -> list[Column]:
    return [F.sum(name).alias(name) for name in names]


def _money_sums(*names: str) -> list[Column]:
    return [F.sum(name).cast(MONEY_SUM).alias(name) for name in names]


def traffic(rows: DataFrame, day: str | None = None) -> DataFrame:
    """Visitors, sessions, views and stay time by version, channel, region and new flag."""
    timed = with_log_time(rows, delay=LOG_DELAY)
    return tumble(timed, ["vc", "ch", "ar", "is_new"], _sums("uv_ct", "sv_ct", "pv_ct", "dur_sum"), day)


def home_detail(rows: DataFrame, day: str | None = None) -> DataFrame:
    timed = with_log_time(rows, delay=CHANGE_DELAY)
    return tumble(timed, [], _sums("home_uv_ct", "good_detail_uv_ct"), day)


def logins(rows: DataFrame, day: str | None = None) -> DataFrame:
    return tumble(with_log_time(rows, delay=CHANGE_DELAY), [], _sums("back_ct", "uu_ct"), day)


def registrations(rows: DataFrame, day: str | None = None) -> DataFrame:
    timed = with_log_time(rows, delay=CHANGE_DELAY)
    return tumble(timed, [], [F.count(F.lit(1)).alias("register_ct")], day)


def cart_adders(rows: DataFrame, day: str | None = None) -> DataFrame:
    return tumble(with_log_time(rows, delay=CHANGE_DELAY), [], _sums("cart_add_uu_ct"), day)


def sku_amounts(rows: DataFrame, day: str | None = None) -> DataFrame:
    names = ("original_amount", "activity_reduce_amount", "coupon_reduce_amount", "order_amount")
    return tumble(with_log_time(rows, delay=CHANGE_DELAY), ["sku_id"], _money_sums(*names), day)


def province_orders(rows: DataFrame, day: str | None = None) -> DataFrame:
    """Exact number of orders and amount per province.

    Batch counts distinct orders in two hash stages. A stream does the same with two windows in a row: one row of state per
    order of a window, then, as windows close, a count of them; no row of state grows with its window.
    """
    timed = with_log_time(rows, delay=CHANGE_DELAY)
    amount = _money_sums("order_amount")
    if not rows.isStreaming:
        return tumble(timed, ["province_id"], [F.count_distinct("order_id").alias("order_count"), *amount], day)
    window = F.window("row_time", WINDOW).alias("_orders")
    orders = timed.groupBy(window, "province_id", "order_id").agg(*amount)
    closed = orders.withColumn("row_time", F.window_time("_orders")).drop("_orders")
    return tumble(closed, ["province_id"], [F.count("order_id").alias("order_count"), *amount], day)
