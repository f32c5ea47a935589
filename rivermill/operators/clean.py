"""Row filters in front of every job. Inputs are parsed records, outputs keep all columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivermill.config import DATABASE
from rivermill.functions import times

# Fixed values of the wire records.
BOOTSTRAP_MARKS = ("bootstrap-start", "bootstrap-complete")
HOME_PAGES = ("home", "good_detail")


def _present(*names: str) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(name).isNotNull()
    return condition


def log_is_clean() -> Column:
    """A page or start record with a device and a time."""
    content = F.col("page").isNotNull() | F.col("start").isNotNull()
    return content & _present("common.mid", "ts")


def clean_logs(logs: DataFrame) -> DataFrame:
    return logs.filter(log_is_clean())


def split_dirty(logs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean records and dirty ones (bad text or missing fields), from ``topics.all_logs``."""
    good = F.coalesce(F.col("_bad").isNull() & log_is_clean(), F.lit(False))
    return logs.filter(good).drop("_bad"), logs.filter(~good)


def clean_dimension_changes(changes: DataFrame) -> DataFrame:
    """Changes of the shop database that carry data, bootstrap marks left out."""
    kind = F.coalesce("type", F.lit(""))
    return changes.filter(
        (F.col("database") == DATABASE) & ~kind.isin(*BOOTSTRAP_MARKS) & (F.size("data") > 0)
    )


def clean_pages(pages: DataFrame) -> DataFrame:
    return pages.filter(_present("mid", "ts"))


def clean_home_pages(pages: DataFrame) -> DataFrame:
    return pages.filter(F.col("page_id").isin(*HOME_PAGES) & _present("mid", "ts"))


def clean_logins(pages: DataFrame) -> DataFrame:
    """Pages that open a session or follow the login page, of a known user."""
    opened = F.col("last_page_id").isNull() | (F.col("last_page_id") == "login")
    return pages.filter(_present("uid", "ts") & opened)


def clean_registrations(users: DataFrame) -> DataFrame:
    """Registered users with ``ts`` in epoch milliseconds from ``create_time``."""
    present = users.filter(_present("id", "create_time"))
    return present.withColumn("ts", times.text_to_ms("create_time"))


def clean_cart_adds(adds: DataFrame) -> DataFrame:
    return seconds_to_millis(adds.filter(_present("user_id", "ts")))


def clean_sku_orders(facts: DataFrame) -> DataFrame:
    return seconds_to_millis(facts.filter(_present("id", "sku_id", "ts")))


def clean_province_orders(facts: DataFrame) -> DataFrame:
    return seconds_to_millis(facts.filter(_present("id", "order_id", "province_id", "ts")))


def search_keywords(pages: DataFrame) -> DataFrame:
    """Pages reached from a search for words."""
    return pages.filter(
        (F.col("last_page_id") == "search") & (F.col("item_type") == "keyword") & _present("item")
    )


def seconds_to_millis(df: DataFrame) -> DataFrame:
    return df.withColumn("ts", F.col("ts") * 1000)
