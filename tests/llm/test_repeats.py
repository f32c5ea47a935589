from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from rivermill.llm import repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(rows, length=13):
    said = [(doc_id, WORD.findall(text or "")) for doc_id, text in rows]
    least = {}
    for doc_id, words in said:
        for i in range(len(words) - length + 1):
            if doc_id is not None:
                window = tuple(words[i : i + length])
                least[window] = min(least.get(window, doc_id), doc_id)
    out = []
    for doc_id, words in said:
        gone = set()
        for i in range(len(words) - length + 1):
            if doc_id is not None and least[tuple(words[i : i + length])] < doc_id:
                gone.update(range(i, i + length))
        rest = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(rest.encode()).hexdigest()))
    return sorted(out, key=repr)


def told(df):
    return sorted((tuple(r) for r in repeats.digests(df).collect()), key=repr)


def corpus(seed, few):
    """Documents that share passages of about the length of a window, with changed words at either end, and copies."""
    pick = random.Random(seed)
    words = [f"w{i}" for i in range(6 if few else 4000)] + ["日本", "ab" * 200]
    passages = [[pick.choice(words) for _ in range(pick.randint(10, 30))] for _ in range(6)]
    docs = []
    for i in range(60):
        said = [pick.choice(words) for _ in range(pick.randint(0, 30))]
        for _ in range(pick.randint(0, 3)):
            passage = list(pick.choice(passages))[pick.randint(0, 4) :]
            if pick.random() < 0.3:
                passage[pick.randrange(len(passage))] = "changed"
            said += passage + [pick.choice(words) for _ in range(pick.randint(0, 20))]
        docs.append((pick.choice([i, i, i, i // 2, None]), pick.choice([" ", "\n", "\t "]).join(said)))
    return docs + [(100 + i, docs[7][1]) for i in range(20)] + [docs[9]] * 2


@pytest.mark.parametrize(("few", "hot"), [(False, 20_000), (False, 1), (True, 20_000), (True, 3)])
def test_brute_force(spark, monkeypatch, few, hot):
    """Also with few different words, where anchors have many contexts, and with anchors that are counted, not gathered."""
    rows = corpus(1 if few else 2, few)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    left = repeats.without_repeats(docs, hot=hot)
    removed = sorted((r.doc_id, r.n_words, sum(s.last - s.first for s in r.spans)) for r in left.filter("doc_id is not null").collect())
    assert removed == sorted(e[:3] for e in expected(rows) if e[0] is not None)
    if hot == 20_000:
        assert told(docs) == expected(rows)


def test_odd_rows(spark, odd, odd_rows, nothing):
    assert told(odd) == expected([r[:2] for r in odd_rows])
    assert told(nothing) == []


def test_saturated_filter(spark, monkeypatch):
    """A bitmap too small to tell anchors apart lets more through and loses nothing."""
    monkeypatch.setattr(repeats, "FILTER_BITS", 13)
    rows = corpus(5, False)
    assert told(spark.createDataFrame(rows, "doc_id long, text string")) == expected(rows)


def test_words_and_anchors():
    data = "a  bb\tccccccccc 日本語日本語 \n" + "x" * 700 + " x" + "y" * 8 + " yyyyyyy"
    words = data.encode().split()
    hashes = repeats.word_hashes(data.encode())
    assert len(hashes) == len(words) == len(set(hashes.tolist()))
    assert [repeats.word_hashes(b" " + w)[0] for w in words] == hashes.tolist()
    assert len(repeats.word_hashes(b"")) == len(repeats.word_hashes(b" \n ")) == 0
    grams = np.random.default_rng(1).integers(0, 2**63, 500).astype(np.uint64)
    picked = repeats.anchors(grams, 13, 4)
    masked = grams >> np.uint64(repeats.PLACE)
    assert picked.tolist() == sorted({i + int(masked[i : i + 10].argmin()) for i in range(491)})
