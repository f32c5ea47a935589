from __future__ import annotations

import hashlib
import zlib

import pytest

from rivermill.llm import merkle

COLUMNS = "doc_id long, source string, lang string, n_chars long, text string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def lowered(row):
    text = row[4]
    if row[0] is None or text is None or zlib.crc32(str(row[0]).encode()) % 3:
        return row
    return (*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in text))


def climbed(nodes, marked):
    """Root of a list of nodes, and of each marked place its siblings and its path."""
    at, proofs = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for place, i in enumerate(at):
            first = i - i % 8
            proofs[place].append((nodes[first:i], nodes[i + 1 : first + 8]))
            at[place] = i // 8
        nodes = [digest("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]
    return nodes[0], proofs


def expected(rows):
    def by_name(lang):
        return (lang is not None, (lang or "").encode())

    trees, out = {}, []
    for row in rows:
        trees.setdefault(row[2], []).append(row)
    names = sorted(trees, key=by_name)
    for lang in names:
        trees[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    inner = {lang: climbed([leaf(r) for r in trees[lang]], True) for lang in names}
    root, outer = climbed([inner[lang][0] for lang in names], True)
    for lang, above in zip(names, outer, strict=True):
        for row, path in zip(trees[lang], inner[lang][1], strict=True):
            steps = [*path, *above]
            proof = digest("".join("".join(before + after) for before, after in steps))
            folded = leaf(lowered(row))
            for before, after in steps:
                folded = digest("".join([*before, folded, *after]))
            out.append((row[0], leaf(row), inner[lang][0], root, proof, folded, folded == root))
    return sorted(out, key=repr)


def told(spark, rows, schema=COLUMNS):
    out = merkle.verified(merkle.manifest(spark.createDataFrame(rows, schema).repartition(3)))
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r) for r in out.select(*names).collect()), key=repr)


def test_odd_rows(spark, odd, odd_rows):
    """Nulls in every column, repeated rows and ids, extra columns with clashing names."""
    want = expected([(r[0], r[3], r[2], r[4], r[1]) for r in odd_rows])
    out = merkle.verified(merkle.manifest(odd))
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    assert sorted((tuple(r) for r in out.select(*names).collect()), key=repr) == want


def test_several_rounds(spark):
    """One language over a block, ids far apart and below zero, ids and rows that repeat, and more languages than a run."""
    rows = [(i * 37 - 900, "s", "en", i, f"Text {i}") for i in range(1100)]
    rows += [(2**62, "s", "en", 1, "Far"), (-(2**63), None, "en", 1, "Low"), (63, "s", "en", 1, "Edge")]
    rows += [(5, "s", "en", k, f"same id {k}") for k in range(40)] + [(7, "s", "en", 0, "Copy")] * 30
    rows += [(k, "s", f"l{k:03d}", 1, "Lone") for k in range(70)] + [(None, "s", None, 1, "NULL")] * 3
    assert told(spark, rows) == expected(rows)


def test_empty(spark, nothing):
    assert merkle.verified(merkle.manifest(nothing)).collect() == []


def test_lone_leaf(spark):
    row = (3, "s", "en", 1, "Lone")
    ((_, own, subroot, root, proof, folded, same),) = told(spark, [row])
    assert own == subroot == root and proof == digest("") and same == (folded == root)


@pytest.mark.parametrize("n", [1, 8, 9, 512])
def test_block_levels(n):
    nodes = [digest(str(i)) for i in range(n)]
    assert merkle.reduced(nodes, n)[-1] == [climbed(nodes, True)[0]]
