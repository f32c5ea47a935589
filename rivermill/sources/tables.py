"""Dimension tables: files per dimension under one root, all columns text, keyed by ``key``."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# Fixed names of the dimension tables the aggregates read.
SKU_DIMENSIONS = (
    "dim_sku_info",
    "dim_spu_info",
    "dim_base_trademark",
    "dim_base_category3",
    "dim_base_category2",
    "dim_base_category1",
)
PROVINCES = "dim_base_province"
DICTIONARY = "dim_base_dic"


def read_dimension(spark: SparkSession, root: str, table: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(f"{root}/{table}")


def read_dimensions(
    spark: SparkSession, root: str, tables: Iterable[str], fmt: str = "parquet"
) -> dict[str, DataFrame]:
    return {table: read_dimension(spark, root, table, fmt) for table in tables}


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``; None if nothing was written there yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
