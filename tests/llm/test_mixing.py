from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest

from rivermill.llm import mixing


def level(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Targets by sharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        stopped = {s for s in open_ if left * weight[s] / total > most * sizes[s]}
        if not stopped:
            return target | {s: left * weight[s] / total for s in open_}
        for s in stopped:
            target[s] = most * sizes[s]
        left -= sum(target[s] for s in stopped)
        open_ -= stopped
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10}, {"a": 1, "b": 1000, None: 5, "z": 0}, {"x": 7}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df, (5, 2, 1), 1.5, 2.0).collect()}
    assert got == pytest.approx(level(sizes))


def test_mix_of_odd_rows(odd, odd_rows):
    got = mixing.mixed(odd).collect()
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r.doc_id, r.size, r.source) for r in got) == Counter((o[0], words(o[1]), o[3]) for o in odd_rows)
    sizes = defaultdict(int)
    for o in odd_rows:
        sizes[o[3]] += words(o[1])
    want = level(sizes)
    taken = defaultdict(int)
    for r in got:
        assert r.taken in (0, r.size, 2 * r.size) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        taken[r.source] += r.taken
    for source, target in want.items():
        largest = max(words(o[1]) for o in odd_rows if o[3] == source)
        assert abs(taken[source] - target) <= largest
    key = lambda r: (str(r.doc_id), r.size, r.taken)
    assert sorted(map(key, mixing.mixed(odd.repartition(5)).collect())) == sorted(map(key, got))


def test_levels_keep_words_and_expectation(spark):
    units = spark.range(4000).selectExpr("id AS doc_id", "if(id < 3000, 'hot', 's') AS source", "1 + id % 37 AS size")
    sizes = units.groupBy("source").agg({"size": "sum"}).toDF("source", "source_size")
    goals = mixing.targets(sizes, (1, 5), 1.0, 2.0)
    shares = []
    for seed in range(3):
        got = mixing.mix(units, goals, seed, fan_in=8).collect()
        assert len(got) == len({r.doc_id for r in got}) == 4000
        for source in ("hot", "s"):
            part = [r for r in got if r.source == source]
            assert abs(sum(r.taken for r in part) - part[0].target) <= 37
        small = [r.copies for r in got if r.source == "hot" and r.size < 10]
        shares.append(sum(small) / len(small))
    due = next(r.target / r.source_size for r in got if r.source == "hot")
    assert sum(shares) / 3 == pytest.approx(due, abs=0.06)  # small and large documents are due alike


def test_take_repeats_rows(odd, odd_rows):
    got = mixing.take(odd)
    assert got.columns == odd.columns
    copies = {}
    for r in mixing.mixed(odd).collect():
        copies.setdefault((r.doc_id, r.size), []).append(r.copies)
    want = sum(sum(c) for c in copies.values())
    assert got.count() == want


def test_take_shuffles_each_row_once(spark, shuffled):
    docs = spark.range(50).selectExpr("id AS doc_id", "repeat('a ', cast(id AS int)) AS text", "'s' AS source")
    with shuffled() as columns:
        shuffles = columns(mixing.take(docs))
    assert sum("_doc" in c for c in shuffles) == 1


def test_take_gives_each_row_the_copies_of_its_name_and_size(spark):
    """Repeated and null names, alone and with equal sizes; a null name is no name 0."""
    texts = ["a b c", "a b d", "a b", None, ""]
    rows = [(i, t, "s") for i in (0, None, 1) for t in texts for _ in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    want, got = Counter(), Counter()
    for r in mixing.mixed(docs).collect():
        want[r.doc_id, r.size] += r.copies
    for r in mixing.take(docs).collect():
        got[r.doc_id, len((r.text or "").split())] += 1
    assert got == +want and sum(got.values()) > 0


def test_empty(nothing):
    assert mixing.mixed(nothing).count() == 0
    assert mixing.take(nothing).count() == 0


def test_no_unit_exceeds_the_limit_at_large_totals(spark):
    """Totals past 2^53 in their product with a size: rounding must not open a document that is due exactly twice."""
    units = spark.range(2000).selectExpr("id AS doc_id", "'a' AS source", "id AS size")
    for total in (10**12 + 7, 10**15 + 3, 3 * 10**13 + 1):
        goals = spark.createDataFrame([("a", total, 2.0 * total)], "source string, source_size long, target double")
        assert mixing.mix(units, goals).filter("taken <> 2 * size").count() == 0
