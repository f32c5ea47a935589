from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from rivermill.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(low)


def expected(docs, items, k):
    counts = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    counts = [(doc_id, c) for doc_id, c in counts if c]
    n, total = len(counts), sum(c.total() for _, c in counts)
    often = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc_id, c in counts:
            m = lexical.length_factor(c.total(), n, total)
            score = sum(lexical.weight(often[t], n) * lexical.impact(c[t], m) for t in set(terms(text)) if t in c)
            if score > 0:
                scored.append((-score, doc_id is not None, doc_id or 0))
        for rank, (score, named, doc_id) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, doc_id if named else None, -score))
    return sorted(out, key=repr)


def found(docs, items, k):
    out = lexical.search(docs, items, k).select("item_id", "rank", "doc_id", "score")
    return sorted((tuple(r) for r in out.collect()), key=repr)


def corpus(seed, size=120):
    pick = random.Random(seed)
    common = [f"w{i}" for i in range(30)]
    docs = []
    for i in range(size):
        said = [pick.choice(common) if pick.random() < 0.7 else f"r{pick.randint(0, 400)}" for _ in range(pick.randint(1, 60))]
        docs.append((pick.choice([i, i, i % 7, None]) if i % 11 == 0 else i, " ".join(said)))
    docs += [(500 + i, docs[3][1]) for i in range(60)] + [docs[5]] * 3
    return docs


def test_brute_force(spark):
    docs = corpus(3)
    items = [(1, "w1 W2 r5 r5"), (2, docs[4][1]), (2, docs[3][1]), (3, docs[3][1]), (4, ""), (5, None), (6, "nowhere"), (None, "w3")]
    got = found(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
        spark.createDataFrame(items, "item_id long, text string"), 10,
    )
    assert got == expected(docs, items, 10)


def test_blocks_and_broadcast_limits(spark, monkeypatch):
    """Queries in several blocks, and shuffles in place of broadcasts, give the same."""
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 10)
    monkeypatch.setattr(lexical, "SENT_ROWS", 0)
    docs = corpus(4, 40)
    items = [(i, docs[i][1]) for i in range(4)]
    got = found(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), 5)
    assert got == expected(docs, items, 5)


def test_odd_rows(spark, odd, odd_rows):
    items = [(1, "text of many words"), (2, "日本語"), (3, "7" * 60_000), (4, "copied TEXT")]
    asked = spark.createDataFrame([(*i, 1, "x") for i in items], "item_id long, text string, rank int, t1 string")
    assert found(odd, asked, 3) == expected([(r[0], r[1]) for r in odd_rows], items, 3)


def test_nothing(spark, nothing):
    items = spark.createDataFrame([(1, "word")], "item_id long, text string")
    assert lexical.search(nothing, items).collect() == []
    assert lexical.search(spark.createDataFrame([(1, "word")], "doc_id long, text string"), items.limit(0)).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_bounds_hold(seed):
    """No bound is below the exact score, with frequent and rare terms and many occurrences."""
    pick = random.Random(seed)
    vocabulary = [f"t{i}".encode() for i in range(60)]
    docs = [Counter(pick.choices(vocabulary, k=pick.choice((1, 5, 40, 5000)))) for _ in range(60)]
    total, often = sum(c.total() for c in docs), Counter(t for c in docs for t in c)
    rows = [(f"q{q}", t, often[t]) for q in range(5) for t in pick.sample(vocabulary, 8) if t in often]
    block = lexical.Block(rows, len(docs), total)
    common = {t: lexical.weight(often[t], len(docs)) for t in pick.sample(vocabulary, 20) if t in often}
    sizes = [c.total() for c in docs]
    made = [
        lexical.sketch(c, lexical.length_factor(n, len(docs), total), common, lexical.weight(1, len(docs)))
        for c, n in zip(docs, sizes, strict=True)
    ]
    size = np.array([len(s) for s in made])
    bounds = block.sums(np.frombuffer(b"".join(made), np.uint8), np.cumsum(size) - size, size, np.array(sizes), False)
    exact = [[block.score(q, c, n) for q in range(len(block.queries))] for c, n in zip(docs, sizes, strict=True)]
    assert (bounds >= np.array(exact)).all()
