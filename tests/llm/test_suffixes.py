from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from rivermill.llm import suffixes


def brute(rows, keep, length=200):
    places = defaultdict(list)
    for i, (name, text) in enumerate(rows):
        data = (text or "").encode()
        for s in range(len(data) - length + 1):
            places[data[s : s + length]].append((name is not None, name or 0, s, i))
    out = []
    for i, (name, text) in enumerate(rows):
        data = (text or "").encode()
        covered = bytearray(len(data))
        for s in range(len(data) - length + 1):
            found = places[data[s : s + length]]
            if len(found) > 1 and (keep == "none" or min(found) != (name is not None, name or 0, s, i)):
                covered[s : s + length] = b"\1" * length
        edges = sum(1 for j in range(len(data)) if covered[j] and (j == 0 or not covered[j - 1]))
        out.append((name, len(data), edges, bytes(b for b, c in zip(data, covered) if not c)))
    return sorted(out, key=str)


def run(df, **setting):
    rows = suffixes.without_repeats(df, **setting).collect()
    return sorted(((r.doc_id, r.n_bytes, len(r.spans), bytes(r.rest)) for r in rows), key=str)


@pytest.fixture(scope="module")
def passages():
    rng = random.Random(2)
    text = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    shared = [text(n) for n in (150, 199, 200, 201, 260, 500, 900)]
    rows = []
    for i in range(50):
        body = text(rng.randint(0, 300))
        for _ in range(rng.randint(0, 4)):
            passage = rng.choice(shared)
            body += passage[rng.randint(0, 30) : len(passage) - rng.randint(0, 30)] + text(rng.choice([0, 1, 5, 300]))
        rows.append((i, body))
    return rows + [(60, "a" * 900), (61, "ab" * 400), (62, "a" * 300), (65, rows[3][1]), (66, rows[3][1] + "x"),
                   (67, "abc" * 80 + text(10) + "abc" * 80)]


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("hot", [suffixes.HOT, 3])
def test_equals_brute_force(spark, monkeypatch, passages, keep, hot):
    monkeypatch.setattr(suffixes, "CHUNK", 256)
    df = spark.createDataFrame(passages, "doc_id long, text string").repartition(4)
    assert run(df, keep=keep, hot=hot) == brute(passages, keep)


def test_odd_rows(odd, odd_rows, nothing):
    rows = [(r[0], r[1] if r[0] not in (3, 9) else None) for r in odd_rows]
    assert run(odd.filter("doc_id not in (3, 9) or doc_id is null")) == brute([r for r in rows if r[0] not in (3, 9)], "none")
    left = {r.doc_id: r for r in suffixes.digests(odd).filter("doc_id in (3, 9)").collect()}
    assert all(r.n_removed == r.n_bytes and r.n_spans == 1 for r in left.values())
    assert suffixes.digests(nothing).count() == 0


def test_anchors_agree_wherever_a_string_stands():
    rng = random.Random(5)
    shared = rng.randbytes(200)
    for _ in range(20):
        head, tail = rng.randbytes(rng.randint(0, 400)), rng.randbytes(rng.randint(0, 400))
        at = suffixes.anchors(head + shared + tail) - len(head)
        own = suffixes.anchors(shared)
        assert len(own) == 1 and own[0] in at


def test_suffix_order_and_previous_factors():
    rng = random.Random(6)
    texts = [bytes(rng.choice(b"\0ab") for _ in range(rng.randint(0, 12))) for _ in range(500)]
    groups = [rng.randrange(4) for _ in texts]
    order, common = suffixes.suffix_order(texts, groups, 10)
    assert order.tolist() == sorted(range(500), key=lambda i: (groups[i], texts[i]))
    for length in range(11):
        classes = suffixes.prefix_classes(order, common, length)
        names = [(g, t.ljust(10, b"\0")[:length]) for g, t in zip(groups, texts, strict=True)]
        first = {}
        assert all(first.setdefault(n, c) == c for n, c in zip(names, classes, strict=True))
        assert len(set(classes.tolist())) == len(set(names))
        earlier = suffixes.earlier_match(classes, np.arange(500))
        assert earlier.tolist() == [n in names[:i] for i, n in enumerate(names)]
