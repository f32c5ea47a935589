from __future__ import annotations

import random
import re

import pytest
import xxhash

from rivermill.llm import simhash


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values):
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 2:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def test_tree_finds_all_within():
    rng = random.Random(1)
    values = list({rng.getrandbits(12) for _ in range(600)})
    tree = simhash.BkTree()
    for v in values:
        tree.add(v)
    for probe in values[:50]:
        assert sorted(tree.within(probe, 2)) == sorted(v for v in values if (v ^ probe).bit_count() <= 2)
    assert len(simhash.links_of(values)) <= len(values) - 1


@pytest.mark.parametrize("hot", [4, 512])
def test_groups_of_chains_and_clusters(spark, hot):
    rng = random.Random(2)
    values = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(40):
            v = base
            for _ in range(rng.randint(0, 4)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    chain = rng.getrandbits(64)
    for i in range(0, 64, 2):
        values.add(chain := chain ^ (3 << i))
    values = sorted(values)
    want = components(values)
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    names = {v: i for i, v in enumerate(random.Random(3).sample(values, len(values)))}
    df = spark.createDataFrame([(names[v], signed(v)) for v in values], "doc_id long, fp long")
    nodes = df.select("fp")
    roots = {r.v: r.root for r in simhash.stars(simhash.links(nodes, hot)).collect()}
    got = {}
    for v in values:
        got.setdefault(roots.get(signed(v), signed(v)), set()).add(v)
    groups = {}
    for v, root in want.items():
        groups.setdefault(root, set()).add(v)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))
    smallest = {r: min(names[v] for v in members) for r, members in groups.items()}
    rows = simhash.grouped(df).collect()
    assert {r.doc_id: r.component_id for r in rows} == {names[v]: smallest[want[v]] for v in values}


def test_odd_rows(odd, odd_rows, nothing):
    prints = [plain_fingerprint(r[1]) for r in odd_rows]
    want = components(sorted(set(prints)))
    smallest = {}
    for r, p in zip(odd_rows, prints, strict=True):
        if r[0] is not None:
            smallest[want[p]] = min(smallest.get(want[p], r[0]), r[0])
    expected = sorted((str(r[0]), format(p, "016x"), str(smallest.get(want[p]))) for r, p in zip(odd_rows, prints, strict=True))
    got = simhash.near_duplicates(odd).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == expected
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns and kept.count() == len(set(want[p] for p in prints))
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.keep_one(nothing).count() == 0
