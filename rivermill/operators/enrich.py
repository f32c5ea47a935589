"""Dimension columns by key. Missing dimension rows leave nulls; the fact row always stays.

No join is forced to broadcast: Spark does so when the dimension's size is known to be under
``spark.sql.autoBroadcastJoinThreshold``, or turns out so at run time, and shuffles it otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def enrich(
    df: DataFrame,
    dimension: DataFrame,
    key: str,
    columns: Mapping[str, str],
    *,
    dimension_key: str = "key",
    default: Column | None = None,
) -> DataFrame:
    """Adds ``{output: dimension column}`` of the dimension row whose key equals ``df[key]``."""
    looked_up = dimension.select(
        F.col(dimension_key).alias("_key"), *[F.col(c).alias(out) for out, c in columns.items()]
    )
    joined = df.join(looked_up, df[key] == F.col("_key"), "left").drop("_key")
    if default is not None:
        for out in columns:
            joined = joined.withColumn(out, F.coalesce(F.col(out), default))
    return joined


def lookup(
    df: DataFrame, dictionary: DataFrame, code: str, name: str, how: str = "inner"
) -> DataFrame:
    """Adds the dictionary name of ``code``; ``inner`` drops unknown codes, ``left`` keeps them."""
    names = dictionary.select(F.col("rowkey").alias("_code"), F.col("info.dic_name").alias(name))
    return df.join(names, df[code] == F.col("_code"), how).drop("_code")


def sku_snowflake(df: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Product, series, trademark and the three category levels of ``sku_id``."""
    hops = (
        ("dim_sku_info", "sku_id", {
            "category3_id": "category3_id", "trademark_id": "tm_id",
            "spu_id": "spu_id", "sku_name": "sku_name",
        }),
        ("dim_spu_info", "spu_id", {"spu_name": "spu_name"}),
        ("dim_base_trademark", "trademark_id", {"trademark_name": "tm_name"}),
        ("dim_base_category3", "category3_id", {"category3_name": "name", "category2_id": "category2_id"}),
        ("dim_base_category2", "category2_id", {"category2_name": "name", "category1_id": "category1_id"}),
        ("dim_base_category1", "category1_id", {"category1_name": "name"}),
    )
    for table, key, columns in hops:
        df = enrich(df, dims[table], key, columns)
    return df


def sku_names(df: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """First hop only: the ids and the name held by the product dimension."""
    columns = {
        "category3_id": "category3_id", "trademark_id": "tm_id",
        "spu_id": "spu_id", "sku_name": "sku_name",
    }
    return enrich(df, dims["dim_sku_info"], "sku_id", columns)


def province_names(df: DataFrame, provinces: DataFrame) -> DataFrame:
    return enrich(df, provinces, "province_id", {"province_name": "name"}, default=F.lit(""))
