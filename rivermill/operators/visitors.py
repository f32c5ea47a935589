"""Visitor rules that depend on what a key did before, in arrival order.

Batch forms are closed: state set once equals the first row's value, state set on every change of
day equals the day of the row before. State never expires in batch. On a stream the same functions
keep the state per key (``rivermill.streaming.state``), with the expiry given there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivermill.config import DAY_MS, RETURN_AFTER_MS
from rivermill.functions import times
from rivermill.operators import skew
from rivermill.operators.skew import Arrival
from rivermill.streaming import state


def repair_new_visitors(
    df: DataFrame, arrival: Arrival, key: str = "mid", flag: str = "is_new", ts: str = "ts"
) -> DataFrame:
    """Clears the new-visitor flag of devices first seen on another day.

    The first row of a device fixes its first day: its own day if flagged new, else the day before.
    """
    if df.isStreaming:
        return state.repair_new_visitors(df, arrival, key, flag, ts)
    says_new = F.coalesce(F.col(flag) == "1", F.lit(False))
    first_day = F.when(says_new, times.ms_to_day(ts)).otherwise(times.ms_to_day(F.col(ts) - DAY_MS))
    known = skew.first(df, [key], arrival, first_day, "_first_day")
    stale = says_new & (times.ms_to_day(ts) != F.col("_first_day"))
    return known.withColumn(flag, F.when(stale, F.lit("0")).otherwise(F.col(flag))).drop("_first_day")


def daily_first(
    df: DataFrame,
    keys: Sequence[str],
    out: str,
    arrival: Arrival,
    ts: str = "ts",
    hot: DataFrame | None = None,
) -> DataFrame:
    """Adds ``out`` = 1 on a row whose day differs from the key's row before, else 0."""
    if df.isStreaming:
        return state.daily_first(df, arrival, keys, out, ts)
    dated = df.withColumn("_day", times.ms_to_day(ts))
    seen = skew.previous(dated, keys, arrival, ["_day"], "_before", hot)
    again = F.coalesce(F.col("_before._day") == F.col("_day"), F.lit(False))
    return seen.withColumn(out, F.when(again, 0).otherwise(1).cast("bigint")).drop("_day", "_before")


def session_measures(df: DataFrame) -> DataFrame:
    """Session start, page view and stay time of a page row."""
    return (
        df.withColumn("sv_ct", F.when(F.col("last_page_id").isNull(), 1).otherwise(0).cast("bigint"))
        .withColumn("pv_ct", F.lit(1).cast("bigint"))
        .withColumn("dur_sum", F.col("during_time").try_cast("bigint"))
    )


def home_detail_firsts(df: DataFrame, arrival: Arrival) -> DataFrame:
    """First view per device and day of the home page and of a product page, other rows dropped."""
    flagged = daily_first(df, ["mid", "page_id"], "_uv", arrival).filter(F.col("_uv") == 1)
    on_home = F.col("page_id") == "home"
    return (
        flagged.withColumn("home_uv_ct", F.when(on_home, 1).otherwise(0).cast("bigint"))
        .withColumn("good_detail_uv_ct", F.when(on_home, 0).otherwise(1).cast("bigint"))
        .drop("_uv")
    )


def unique_and_returning(
    df: DataFrame, arrival: Arrival, key: str = "uid", ts: str = "ts"
) -> DataFrame:
    """First login of a user per day (``uu_ct``), and whether it follows more than seven days' absence.

    Absence counts from midnight of the last login's day. Further logins of a day are dropped.
    """
    if df.isStreaming:
        return state.unique_and_returning(df, arrival, key, ts)
    dated = df.withColumn("_day", times.ms_to_day(ts))
    seen = skew.previous(dated, [key], arrival, ["_day"], "_before")
    last_day = F.col("_before._day")
    back = F.col(ts) - times.midnight_ms(last_day) > RETURN_AFTER_MS
    return (
        seen.filter(last_day.isNull() | (last_day != F.col("_day")))
        .withColumn("back_ct", F.when(back, 1).otherwise(0).cast("bigint"))
        .withColumn("uu_ct", F.lit(1).cast("bigint"))
        .drop("_day", "_before")
    )


def cart_add_firsts(df: DataFrame, arrival: Arrival) -> DataFrame:
    """First cart-add of each user per day, other rows dropped."""
    flagged = daily_first(df, ["user_id"], "cart_add_uu_ct", arrival)
    return flagged.filter(F.col("cart_add_uu_ct") == 1)
