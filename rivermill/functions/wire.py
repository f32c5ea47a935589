"""Scalars over wire records: JSON, coerced numbers, map fields, column names."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = "decimal(16,2)"
MONEY_SUM = "decimal(38,2)"


def parse(df: DataFrame, schema: T.StructType, *keep: str, value: str = "value") -> DataFrame:
    """JSON objects of ``value`` as the columns of ``schema``, bad or empty texts dropped.

    ``inline(array(...))`` makes the parse a generator: filters on its output stay above it. A
    plain projection would let Catalyst push them below and parse every text once per filter.
    """
    return parse_all(df, schema, *keep, value=value).filter(F.col("_bad").isNull()).drop("_bad")


def parse_all(df: DataFrame, schema: T.StructType, *keep: str, value: str = "value") -> DataFrame:
    """Like :func:`parse`, but bad texts stay, with the text in ``_bad`` and null columns."""
    text = F.coalesce(F.nullif(F.trim(F.col(value)), F.lit("")), F.lit("!"))
    probe = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    return df.select(*keep, F.inline(F.array(F.from_json(text, probe, options))))


def whole(value: Column) -> Column:
    """Wire number as BIGINT; quoted numbers count, anything else is null."""
    return value.try_cast("bigint")


def money(value: Column) -> Column:
    return value.try_cast(MONEY)


def amount_or_zero(value: Column) -> Column:
    return F.coalesce(money(value), F.lit(0).cast(MONEY))


def times_price(count: Column, price: Column) -> Column:
    """Count times unit price, both at scale 2."""
    return money(count) * money(price)


def fields(source: str, names: Iterable[str]) -> list[Column]:
    """One output column per key of a text map."""
    return [F.col(source)[name].alias(name) for name in names]


def keep_keys(data: Column, wanted: Column) -> Column:
    """Entries of ``data`` whose key is in the array ``wanted``."""
    return F.map_filter(data, lambda key, _: F.array_contains(wanted, key))


def snake_name(name: str) -> str:
    return re.sub(r"(?<=[a-z0-9])([A-Z])", r"_\1", name).lower()


def camel_name(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(part[:1].upper() + part[1:] for part in rest)


def to_snake(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_name(c) for c in df.columns])


def to_camel(df: DataFrame) -> DataFrame:
    return df.toDF(*[camel_name(c) for c in df.columns])


def as_json(df: DataFrame, hidden: Iterable[str] = ()) -> DataFrame:
    """One JSON line per row in ``value``, without the ``hidden`` columns."""
    hidden = set(hidden)
    return df.select(F.to_json(F.struct(*[c for c in df.columns if c not in hidden])).alias("value"))
