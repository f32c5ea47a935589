"""SimHash near-duplicates by BK-trees over shards.

A fingerprint has a bit for each bit set in over half of the hashes of a text's word shingles. Equal fingerprints are one
node. Two nodes link if at most ``RADIUS`` = 2 bits differ, and linked nodes, directly or over others, form a group.

Two of the four 16-bit blocks of linked fingerprints are equal. So each node goes to the six shards that its pairs of blocks
name. A shard is a BK-tree: children hang on their Hamming distance to the parent, and a search follows the edges
within the radius of the distance only. Trees stay in the task of their shard and are not broadcast, as together they grow
with the corpus. A shard of more than ``HOT`` nodes is cut by pairs of the four bytes that are left, where again two are
equal; its shards share 48 bits and so hold 2^16 nodes at most. Within a shard a link is put out only if it joins two
trees of links, so n nodes give at most n - 1 links and not all pairs. Links of all shards are contracted to stars in
rounds (each node moves to the smallest neighbour), with reliable checkpoints.

Defined cases: a null or wordless text has fingerprint 0, which links like any other; fewer words than a shingle are one
shingle; equal texts share a node, so copies cost one row each; a null doc_id takes part and is never the smallest;
rows that repeat a doc_id are rows of their own; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from rivermill.llm.common import cut, map_texts

SEED = 42
SHINGLE = 3
RADIUS = 2
HOT = 512
CHUNK = 1 << 15  # shingles


def fingerprint(text: str, size: int = SHINGLE) -> int:
    """The unsigned 64-bit SimHash of a text; ASCII letters are taken as small, words end at ASCII white space."""
    words = text.encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])
    size = min(size, len(words))
    firsts, lasts = starts[: len(words) - size + 1].tolist(), (ends[size - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    counts, total = np.zeros(64, np.int64), len(firsts)
    for at in range(0, total, CHUNK):
        spans = zip(firsts[at : at + CHUNK], lasts[at : at + CHUNK], strict=True)
        hashes = np.array([digest(line[a:b], SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(2 * counts > total, bitorder="little")
    return int(set_bits.view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key`` and fp (the fingerprint as a signed long) of every text."""

    def make():
        return lambda text: (f - (1 << 64) if (f := fingerprint(text)) >> 63 else f,)

    return map_texts(docs, make, "fp long", key)


class BkTree:
    """Integers by Hamming distance: a node is (value, children by distance)."""

    def __init__(self):
        self.root: tuple[int, dict] | None = None

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = value, {}
            return
        node = self.root
        while True:
            distance = (node[0] ^ value).bit_count()
            child = node[1].get(distance)
            if child is None:
                node[1][distance] = value, {}
                return
            node = child

    def within(self, value: int, radius: int) -> Iterator[int]:
        stack = [self.root] if self.root else []
        while stack:
            held, children = stack.pop()
            distance = (held ^ value).bit_count()
            if distance <= radius:
                yield held
            for edge in range(max(0, distance - radius), distance + radius + 1):
                child = children.get(edge)
                if child is not None:
                    stack.append(child)


def links_of(values: list[int], radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links among distinct ``values`` that connect what the radius connects, at most one per value but one."""
    tree, parent, links = BkTree(), {v: v for v in values}, []

    def find(v: int) -> int:
        while parent[v] != v:
            parent[v] = v = parent[parent[v]]
        return v

    for value in values:
        for near in tree.within(value, radius):
            a, b = find(value), find(near)
            if a != b:
                parent[a] = b
                links.append((value, near))
        tree.add(value)
    return links


def _blocks(value: Column, width: int, first: int = 0) -> list[Column]:
    """Four blocks of ``width`` bits, from bit ``first`` on."""
    mask = F.lit((1 << width) - 1)
    return [F.shiftrightunsigned(value, first + width * i).bitwiseAND(mask) for i in range(4)]


def _pairs(blocks: list[Column], width: int) -> Column:
    """The six pairs of blocks as (pair number, bits of both, bits of the other two)."""
    out = []
    for number, (i, j) in enumerate(combinations(range(4), 2)):
        k, m = (x for x in range(4) if x not in (i, j))
        both = F.shiftleft(blocks[i], width) + blocks[j]
        rest = F.shiftleft(blocks[k], width) + blocks[m]
        out.append(F.struct((F.lit(number).cast("long") * (1 << 2 * width) + both).alias("key"), rest.alias("rest")))
    return F.array(*out)


def _in_shards(sharded: DataFrame, keys: list[str]) -> DataFrame:
    """Links a, b from the BK-trees of all shards; ``sharded``: ``keys`` and fp."""
    schema = StructType.fromDDL("a bigint, b bigint")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, values = None, []

        def links(values):
            found = links_of([v & (1 << 64) - 1 for v in values])
            signed = [[v - (1 << 64) if v >> 63 else v for v in side] for side in zip(*found, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(s, pa.int64()) for s in signed or ([], [])], schema=arrow)

        for batch in batches:
            columns = batch.to_pydict()
            names = zip(*[columns[k] for k in keys], strict=True)
            for name, value in zip(names, columns["fp"], strict=True):
                if name != now:
                    if len(values) > 1:
                        yield links(values)
                    now, values = name, []
                values.append(value)
        if len(values) > 1:
            yield links(values)

    return sharded.repartition(*keys).sortWithinPartitions(*keys, "fp").mapInArrow(run, schema)


def links(nodes: DataFrame, hot: int = HOT) -> DataFrame:
    """Links a, b between the distinct fingerprints ``nodes.fp`` that connect every group."""
    keyed = nodes.select("fp", F.inline(_pairs(_blocks(F.col("fp"), 16), 16)))
    sizes = keyed.groupBy(F.col("key").alias("_key")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = keyed.join(sizes, F.col("key") == F.col("_key"))
    shared = cut(shared.select("fp", "key", "rest", (F.col("n") > hot).alias("hot")))
    plain = _in_shards(shared.filter("not hot").select("key", "fp"), ["key"])
    finer = shared.filter("hot").select("fp", "key", F.inline(_pairs(_blocks(F.col("rest"), 8), 8)).alias("part", "_"))
    return plain.unionByName(_in_shards(finer.select("key", "part", "fp"), ["key", "part"]))


def stars(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Node v and the smallest node ``root`` of its component, for every v that is not the smallest.

    Rounds of large-star and small-star steps. Minima combine before the shuffle; joins on a node of many neighbours are
    cut by adaptive execution.
    """

    def linked_to_smallest(both: DataFrame) -> DataFrame:
        smallest = both.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("m"))
        return both.join(smallest, F.col("u") == F.col("_u"))

    edges = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = linked_to_smallest(both).filter("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        # Here every edge leads from a node to a smaller one: the smallest of a node also takes the others.
        small = linked_to_smallest(large.distinct())
        onward = small.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(onward.unionByName(small.select("u", F.col("m").alias("v"))).distinct())
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("v"), F.col("v").alias("root"))
        before = state
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def grouped(printed: DataFrame, name: str = "doc_id") -> DataFrame:
    """Adds ``group`` (smallest fingerprint of the group, by value) and ``component_id`` (smallest ``name``).

    ``printed``: ``name`` and fp, one row per document.
    """
    nodes = cut(printed.groupBy("fp").agg(F.min(name).alias("first"), F.count(F.lit(1)).alias("n")))
    star = stars(links(nodes))
    members = star.unionByName(star.select(F.col("root").alias("v"), "root").distinct())
    linked = members.join(nodes, F.col("v") == F.col("fp")).select("v", "root", "first")
    smallest = linked.groupBy(F.col("root").alias("_root")).agg(F.min("first").alias("smallest"))
    joined = linked.join(smallest, F.col("root") == F.col("_root")).select("v", "root", "smallest")
    # Only nodes of several documents or with links need more than the row itself.
    known = nodes.join(joined, F.col("fp") == F.col("v"), "left").filter("n > 1 or v is not null")
    known = known.select(
        F.col("fp").alias("_fp"), F.coalesce("root", "fp").alias("_group"),
        F.when(F.col("v").isNull(), F.col("first")).otherwise(F.col("smallest")).alias("_smallest"),
    )
    out = printed.join(known, F.col("fp") == F.col("_fp"), "left")
    component = F.when(F.col("_fp").isNull(), F.col(name)).otherwise(F.col("_smallest"))
    return out.withColumns({"group": F.coalesce("_group", "fp"), "component_id": component}).drop(
        "_fp", "_group", "_smallest"
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every document."""
    found = grouped(cut(fingerprints(docs)))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of every group of near-duplicates: that of the smallest doc_id, then text hash; columns as in ``docs``."""
    columns = docs.columns
    key = F.struct(docs["doc_id"], F.xxhash64(docs["text"]).alias("hash")).alias("_key")
    found = grouped(cut(fingerprints(docs.select(key, docs["text"]), "_key")), "_key")
    first = F.min_by("_key", F.struct(F.col("_key.doc_id").isNull(), F.col("_key")))
    chosen = found.groupBy("group").agg(first.alias("_chosen")).select("_chosen").distinct()
    rows = docs.select(key, F.struct(*[docs[c] for c in columns]).alias("_doc"))
    # Rows that repeat a doc_id and a text are one.
    met = rows.join(chosen, F.col("_key") == F.col("_chosen"), "left_semi")
    return met.groupBy("_key").agg(F.first("_doc").alias("_doc")).select("_doc.*")
