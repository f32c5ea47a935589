"""Every registered query against its SQL twin on the smallest test tables."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
import check_oracle
from workload.oracle import ORACLE
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = entry.queries()[name](spark, SF_DIR)
    got = check_oracle.rows_of(df.columns, [tuple(r) for r in df.collect()])
    names, rows = check_oracle.expected(entry.oracle_sql()[name], SF_DIR)
    assert sorted(df.columns) == sorted(names)
    assert got == check_oracle.rows_of(names, rows)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("gone", [["rivermill/llm", "tests/llm", "corpus_pipeline.py"], ["rivermill/llm", "tests/llm"]])
def test_rest_stands_alone(tmp_path, gone):
    root = Path(__file__).resolve().parents[1]
    skipped = shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", "spark-warehouse")
    copy = shutil.copytree(root, tmp_path / "copy", ignore=skipped)
    for name in gone:
        path = copy / name
        shutil.rmtree(path, ignore_errors=True) if path.suffix == "" else path.unlink(missing_ok=True)
    code = "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.QUERIES) == sorted(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True)
    assert said.stdout.strip() == "True", said.stderr
