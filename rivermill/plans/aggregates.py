"""The eight window aggregates. ``day`` stamps the processing day; it defaults to today."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivermill.config import CHANGE_DELAY
from rivermill.functions import keywords
from rivermill.operators import clean, deltas, enrich, visitors, windows
from rivermill.operators.skew import Arrival
from rivermill.sources.topics import with_log_time


def _narrow(df: DataFrame, arrival: Arrival, *names: str) -> DataFrame:
    """The named and the arrival columns: keyed state on a stream is not pruned by the optimizer."""
    return df.select(*dict.fromkeys([*names, *arrival.order]))


def traffic(
    pages: DataFrame, arrival: Arrival, day: str | None = None, hot: DataFrame | None = None
) -> DataFrame:
    """Visitors, sessions, views and stay time by version, channel, region and new flag.

    ``hot`` names the devices with very many rows, if known (``skew.hot_keys`` on ``mid``).
    """
    rows = _narrow(
        clean.clean_pages(pages), arrival,
        "mid", "vc", "ch", "ar", "is_new", "last_page_id", "during_time", "ts",
    )
    flagged = visitors.daily_first(rows, ["mid"], "uv_ct", arrival, hot=hot)
    return windows.traffic(visitors.session_measures(flagged), day)


def home_detail(pages: DataFrame, arrival: Arrival, day: str | None = None) -> DataFrame:
    """Daily unique viewers of the home page and of product pages."""
    rows = _narrow(clean.clean_home_pages(pages), arrival, "mid", "page_id", "ts")
    return windows.home_detail(visitors.home_detail_firsts(rows, arrival), day)


def keyword_views(
    pages: DataFrame, day: str | None = None, dictionary: DataFrame | None = None
) -> DataFrame:
    """Search words per window; a search without words counts once under a null word.

    With a dictionary each distinct run of ideographs is split once, after it was counted. Without one an ideograph is a word, so
    texts are cut into words at once and a single aggregate counts them.
    """
    if dictionary is not None:
        return word_views(atom_views(pages, day), dictionary)
    words = keywords.explode_single_words(_searches(pages), "item", "keyword")
    return windows.tumble(words, ["keyword"], [F.count(F.lit(1)).alias("keyword_count")], day)


def _searches(pages: DataFrame) -> DataFrame:
    return with_log_time(clean.search_keywords(pages), delay=CHANGE_DELAY).select("row_time", "item")


def atom_views(pages: DataFrame, day: str | None = None) -> DataFrame:
    """Views per window of the letter and ideograph runs of search texts."""
    atoms = keywords.explode_atoms(_searches(pages), "item")
    return windows.tumble(atoms, ["atom"], [F.count(F.lit(1)).alias("views")], day)


def word_views(atoms: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """Views per window of words; each distinct run is split once, however often it was searched.

    Of a stream give the closed windows of a micro-batch: all rows of a window close together.
    """
    words = keywords.words_of_atoms(atoms, dictionary)
    return words.groupBy("stt", "edt", "cur_date", "keyword").agg(F.sum("views").alias("keyword_count"))


def logins(pages: DataFrame, arrival: Arrival, day: str | None = None) -> DataFrame:
    """Daily unique and returning users."""
    rows = _narrow(clean.clean_logins(pages), arrival, "uid", "ts")
    return windows.logins(visitors.unique_and_returning(rows, arrival), day)


def registrations(users: DataFrame, day: str | None = None) -> DataFrame:
    return windows.registrations(clean.clean_registrations(users), day)


def cart_adders(adds: DataFrame, arrival: Arrival, day: str | None = None) -> DataFrame:
    """Daily unique users who put something into their cart."""
    rows = _narrow(clean.clean_cart_adds(adds), arrival, "user_id", "ts")
    return windows.cart_adders(visitors.cart_add_firsts(rows, arrival), day)


def sku_orders(
    facts: DataFrame, dims: Mapping[str, DataFrame], arrival: Arrival, day: str | None = None
) -> DataFrame:
    """Order amounts per product, with the product's snowflake joined after aggregation."""
    return enrich.sku_snowflake(sku_amounts(facts, arrival, day), dims)


def sku_amounts(facts: DataFrame, arrival: Arrival, day: str | None = None) -> DataFrame:
    rows = _narrow(
        clean.clean_sku_orders(facts), arrival, "id", "sku_id", "order_price", "sku_num",
        "split_total_amount", "split_activity_amount", "split_coupon_amount", "ts",
    )
    return windows.sku_amounts(deltas.sku_deltas(rows, arrival), day)


def province_orders(
    facts: DataFrame, provinces: DataFrame, arrival: Arrival, day: str | None = None
) -> DataFrame:
    """Orders and amount per province, with the province's name."""
    return enrich.province_names(province_amounts(facts, arrival, day), provinces)


def province_amounts(facts: DataFrame, arrival: Arrival, day: str | None = None) -> DataFrame:
    rows = _narrow(
        clean.clean_province_orders(facts), arrival,
        "id", "order_id", "province_id", "split_total_amount", "ts",
    )
    return windows.province_orders(deltas.province_deltas(rows, arrival), day)
