"""The corpus pipeline: quality rules, near-duplicates, personal data, source mixing, token ids.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; all but the last give the columns of ``docs``. ``run`` writes
each stage as Parquet in the shared folder and reads it again for the next one, so that no stage is computed twice and a
lost executor repeats one stage at most. Empty tables, nulls, repeated rows and extra columns are treated as the operators
say: rows that the quality rules reject go, one document of each near-duplicate group stays, personal data in texts is
replaced by its kind, and a document is repeated as often as the mix takes it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rivermill.llm import mixing, pii, quality, simhash, transducer
from rivermill.llm.common import kept, ship

VOCABULARY = "byte_bpe_50k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the thresholds of their language."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates by SimHash, with the shingles and bits of its operator."""
    ship(spark)
    return simhash.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced in their texts."""
    ship(spark)
    return pii.redacted(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.take(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row."""
    ship(spark)
    return transducer.round_trip(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mixing", source_mixing),
    ("token_ids", token_ids),
]

#: Trained detection, grouping over several links and rounding by hashes cannot be said in SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
