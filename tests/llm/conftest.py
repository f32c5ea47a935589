from __future__ import annotations

from contextlib import contextmanager

import public_tokenizers
import pytest

LONG = "a long text of many words. " * 12_000
COPY = "One copied text with some words in it, which is long enough to hold windows of five words; " * 4
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, n_words string, fp string, _doc int, h int, "
    "kept string, size string, copies string"
)


def row(name, text, lang="en", source="s0"):
    return name, text, lang, source, None if text is None else len(text), "x", "y", 1, 2, "z", "u", "v"


@pytest.fixture(scope="session")
def vocabulary():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows, extra columns with clashing names."""
    rows = [
        row(0, COPY), row(1, None), row(2, ""), row(3, LONG), row(4, COPY), row(4, COPY), row(5, COPY + "!", None, None),
        row(None, "a text without a name", "de", "s1"), row(None, None, None, None), row(6, " \n\t "), row(7, "word"),
        row(8, "mail a.b@c.example.org or +1 (743) 555-3824, host 10.0.0.255, card 4111 1111 1111 1111."),
        row(9, "7" * 60_000), row(10, "<|endoftext|>x <|endo" + "日本語 \U0001f600" * 40), row(11, "$$$ ### %% && ** " * 9),
        (12, None, None, None, None, None, None, None, None, None, None, None),
    ]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def shuffled(spark):
    """Gives a context in which plans join by shuffles alone, and a function for the columns of each shuffle of a plan."""
    plain = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}

    def columns(df):
        found, left = [], [df._jdf.queryExecution().executedPlan()]
        while left:
            node = left.pop()
            if node.nodeName() == "Exchange":
                found.append([node.output().apply(i).name() for i in range(node.output().size())])
            left += [node.children().apply(i) for i in range(node.children().size())]
        return found

    @contextmanager
    def joins_by_shuffle():
        before = {k: spark.conf.get(k, None) for k in plain}
        for k, v in plain.items():
            spark.conf.set(k, v)
        try:
            yield columns
        finally:
            for k, v in before.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)

    return joins_by_shuffle
