"""Change of amounts between emissions of one row id, so that re-sent facts sum correctly."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivermill.functions.wire import MONEY, MONEY_SUM, amount_or_zero
from rivermill.operators import skew
from rivermill.operators.skew import Arrival
from rivermill.streaming import state


def amount_deltas(
    df: DataFrame, amounts: Mapping[str, Column], arrival: Arrival, key: str = "id"
) -> DataFrame:
    """Adds each amount minus its value at the row of the same ``key`` that arrived before.

    ``amounts`` are decimals without nulls. The first emission counts from zero. In batch the last
    amounts never expire; on a stream they do after 30 idle seconds, so a later emission counts in
    full again.
    """
    valued = df.select("*", *[value.alias(name) for name, value in amounts.items()])
    if df.isStreaming:
        return state.amount_deltas(valued, arrival, list(amounts), key)
    seen = skew.previous(valued, [key], arrival, list(amounts), "_before", few=True)
    zero = F.lit(0).cast(MONEY)
    changes = {name: F.col(name) - F.coalesce(F.col("_before")[name], zero) for name in amounts}
    return seen.withColumns(changes).drop("_before")


def sku_deltas(facts: DataFrame, arrival: Arrival) -> DataFrame:
    """Original (price times count), activity, coupon and total amount changes of an order line."""
    original = (amount_or_zero(F.col("order_price")) * amount_or_zero(F.col("sku_num"))).cast(MONEY_SUM)
    amounts = {
        "original_amount": original,
        "activity_reduce_amount": amount_or_zero(F.col("split_activity_amount")),
        "coupon_reduce_amount": amount_or_zero(F.col("split_coupon_amount")),
        "order_amount": amount_or_zero(F.col("split_total_amount")),
    }
    return amount_deltas(facts, amounts, arrival)


def province_deltas(facts: DataFrame, arrival: Arrival) -> DataFrame:
    """Total amount changes of an order line."""
    return amount_deltas(facts, {"order_amount": amount_or_zero(F.col("split_total_amount"))}, arrival)
