"""Typed facts out of change records: one projection and filter per source table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivermill import schemas
from rivermill.config import DATABASE
from rivermill.functions import wire

# Fixed value: status code of a successful payment.
PAID = "1602"


def of_table(table: str, kind: str | None = "insert") -> Column:
    chosen = (F.col("database") == DATABASE) & (F.col("table") == table)
    return chosen & (F.col("type") == kind) if kind else chosen


def inserted(changes: DataFrame, table: str, names: tuple[str, ...], *keep: str) -> DataFrame:
    return changes.filter(of_table(table)).select(*wire.fields("data", names), *keep)


def comments(changes: DataFrame, *keep: str) -> DataFrame:
    return inserted(changes, "comment_info", schemas.COMMENT_COLUMNS, *keep)


def order_details(changes: DataFrame, *keep: str) -> DataFrame:
    """Order lines, with the undiscounted amount at scale 2."""
    rows = inserted(changes, "order_detail", schemas.ORDER_DETAIL_COLUMNS, "ts", *keep)
    original = wire.times_price(F.col("sku_num"), F.col("order_price"))
    return rows.withColumn("split_original_amount", original.cast("string"))


def order_infos(changes: DataFrame, *keep: str) -> DataFrame:
    return inserted(changes, "order_info", schemas.ORDER_INFO_COLUMNS, *keep)


def order_activities(changes: DataFrame, *keep: str) -> DataFrame:
    return changes.filter(of_table("order_detail_activity")).select(
        F.col("data")["order_detail_id"].alias("id"),
        *wire.fields("data", ("activity_id", "activity_rule_id")),
        *keep,
    )


def order_coupons(changes: DataFrame, *keep: str) -> DataFrame:
    return changes.filter(of_table("order_detail_coupon")).select(
        F.col("data")["order_detail_id"].alias("id"), *wire.fields("data", ("coupon_id",)), *keep
    )


def cart_adds(changes: DataFrame, *keep: str) -> DataFrame:
    """Items put into a cart: new lines, and the increase of lines whose count grew."""
    now = F.col("data")["sku_num"].try_cast("int")
    before = F.col("old")["sku_num"].try_cast("int")
    new_line = F.col("type") == "insert"
    grown = (F.col("type") == "update") & F.col("old")["sku_num"].isNotNull() & (now > before)
    columns = [
        F.when(new_line, now).otherwise(now - before).alias(name)
        if name == "sku_num"
        else F.col("data")[name].alias(name)
        for name in schemas.CART_COLUMNS
    ]
    chosen = changes.filter(of_table("cart_info", None) & (new_line | grown))
    return chosen.select(*columns, "ts", *keep)


def payments(changes: DataFrame, *keep: str) -> DataFrame:
    """Payments whose status changed to paid."""
    paid = F.col("old")["payment_status"].isNotNull() & (F.col("data")["payment_status"] == PAID)
    chosen = changes.filter(of_table("payment_info", "update") & paid)
    return chosen.select(*wire.fields("data", schemas.PAYMENT_COLUMNS), "ts", *keep)
