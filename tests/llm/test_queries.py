from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
import check_oracle
import corpus_pipeline
from rivermill.llm import queries

SF_DIR = "/root/testdata/sf0.001"


def test_registered():
    names = [f"op{n}_" for n in range(1, 14)]
    assert all(sum(q.startswith(n) for q in entry.queries()) == 1 for n in names) and "pipeline" in entry.queries()
    assert set(queries.ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_twin(spark, name):
    df = entry.queries()[name](spark, SF_DIR)
    names, rows = check_oracle.expected(entry.oracle_sql()[name], SF_DIR)
    assert sorted(df.columns) == sorted(names)
    assert check_oracle.rows_of(df.columns, [tuple(r) for r in df.collect()]) == check_oracle.rows_of(names, rows)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE)))
def test_whole_table(spark, name):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert entry.queries()[name](spark, SF_DIR).count() == documents.count()


def test_stages(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    docs, sizes = documents, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == documents.columns
        sizes.append(docs.count())
    assert documents.count() >= sizes[0] >= sizes[1] == sizes[2] and 0 < sizes[3] <= 2 * sizes[2]
    left = docs.select("text").collect()
    assert not any(re.search(r"[A-Za-z0-9]@[A-Za-z0-9-]+\.[A-Za-z]", r.text) for r in left)
    out = corpus_pipeline.run(spark, SF_DIR)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() == sizes[3]


def test_stages_on_odd_rows(spark, odd, nothing):
    for docs in (odd, nothing):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF_DIR)
            assert name == "token_ids" or docs.columns == columns
        docs.count()
