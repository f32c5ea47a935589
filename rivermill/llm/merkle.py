"""Merkle manifest of a document table: leaves are placed by bitmap ranks, and keyed slot arrays reduce the levels.

A document's leaf is a digest of its fields. In each language, leaves ascend by doc_id; runs of ``RUN`` nodes become their
digest until one node, the language's subroot, is left. Subroots by language become the root in the same way.

**Ranks.** The ids of a language are a compressed bitmap: only words of 64 ids that hold any are kept, one row each, and the
words that tasks make of their rows are merged by bitwise or. Directories over the words hold how many rows come before,
level by level of ``FANOUT`` bits of the word's number, so that no window holds more than 2^FANOUT counts however the ids
are spread. A leaf's place is its word's count before plus the bits below its own: leaves are never sorted.

**Levels.** ``BLOCK`` neighbouring places form a slot array, which one task fills by place and reduces by ``LEVELS`` levels at once.
The blocks' nodes are the next round's, so rounds are few (four for 10^10 leaves). Proofs come down the same
blocks: a node's path is its siblings inside the block, then the path of the block.

Defined cases: null fields are digested as ``-``; a null doc_id comes first in its language, a null language before the others.
Documents of one doc_id in a language follow each other by leaf digest, and equal leaves take neighbouring places; rows that
share a doc_id are counted per digest prefix, so none of them meet in one task. An empty table has no root and no rows.
Extra columns of any name are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from rivermill.llm.common import kept

RUN = 8
LEVELS = 3
BLOCK = RUN**LEVELS
WORD_BITS = 6
FANOUT = 15
TIE_ROWS = 4096  # rows of one doc_id that are ordered by digest in one task
COPIES = 65_536  # equal leaves that one row stands for when they are laid out

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _sized(field: Column) -> Column:
    text = field.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: dict[str, Column]) -> Column:
    """Digest of a document's fields, 64 hexadecimal digits."""
    return F.sha2(F.concat(*[_sized(fields[name]) for name in FIELDS]), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """tree (the language), doc_id, leaf and folded of every document.

    ``folded`` is the leaf after tampering, null where nothing is tampered with: A-Z of the text in lower case, where 3 divides
    the checksum of the doc_id.
    """
    fields = {name: docs[name] for name in FIELDS}
    chosen = F.crc32(docs["doc_id"].cast("string")) % 3 == 0
    lowered = leaf(fields | {"text": F.translate(docs["text"], UPPER, LOWER)})
    return docs.select(
        docs["lang"].cast("string").alias("tree"), docs["doc_id"].cast("long").alias("doc_id"),
        F.unhex(leaf(fields)).alias("leaf"), F.when(chosen, F.unhex(lowered)).alias("folded"),
    )


def _same(left: DataFrame, right: DataFrame, **keys: str) -> Column:
    """Null-safe equality of ``left``'s columns with ``right``'s."""
    first, *others = [left[a].eqNullSafe(right[b]) for a, b in keys.items()]
    for other in others:
        first = first & other
    return first


def _before(value: str, keys: list[str], order: str) -> Column:
    """Sum of ``value`` over the rows of ``keys`` that come before in ``order``, null first."""
    rows = Window.partitionBy(*keys).orderBy(F.asc_nulls_first(order)).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(rows), F.lit(0))


def _counted(counts: DataFrame, bits: int) -> DataFrame:
    """Adds ``before``: the ``rows`` in smaller words of the tree, by a directory per ``FANOUT`` bits of the word."""
    if bits <= FANOUT:
        return counts.withColumn("before", _before("rows", ["tree"], "word"))
    inner = counts.withColumn("_up", F.shiftright("word", FANOUT))
    inner = inner.withColumn("_inner", _before("rows", ["tree", "_up"], "word"))
    above = inner.groupBy("tree", F.col("_up").alias("word")).agg(F.sum("rows").alias("rows"))
    above = _counted(above, bits - FANOUT).select(F.col("tree").alias("_tree"), F.col("word").alias("_word"), "before")
    joined = inner.join(above, _same(inner, above, tree="_tree", _up="_word"))
    return joined.withColumn("before", F.col("before") + F.col("_inner")).drop("_tree", "_word", "_up", "_inner")


def bitmaps(rows: DataFrame) -> DataFrame:
    """The compressed bitmap of each tree, with its directory: tree, word, bits, rows, before and n (leaves of the tree).

    ``word`` is the doc_id without its last ``WORD_BITS`` bits; the word of null ids has no bits.
    """
    bit = F.expr(f"shiftleft(1L, cast(doc_id & {(1 << WORD_BITS) - 1} as int))")
    words = kept(
        rows.groupBy("tree", F.shiftright("doc_id", WORD_BITS).alias("word")).agg(
            F.bit_or(bit).alias("bits"), F.count(F.lit(1)).alias("rows")
        ),
        "words",
    )
    sizes = words.groupBy(F.col("tree").alias("_tree")).agg(F.sum("rows").alias("n"))
    placed = _counted(words.select("tree", "word", "rows"), 64 - WORD_BITS).select(
        F.col("tree").alias("_t"), F.col("word").alias("_w"), "before"
    )
    joined = words.join(placed, _same(words, placed, tree="_t", word="_w")).drop("_t", "_w")
    return joined.join(sizes, _same(joined, sizes, tree="_tree")).drop("_tree")


def places(rows: DataFrame) -> DataFrame:
    """tree, i (the leaf's place in its tree, from 0), n, node, doc_id and folded."""
    index = kept(bitmaps(rows), "bitmaps").withColumnsRenamed({"tree": "_tree", "word": "_word"})
    found = rows.withColumn("word", F.shiftright("doc_id", WORD_BITS))
    found = found.join(index, _same(found, index, tree="_tree", word="_word")).drop("_tree", "_word")
    single = F.coalesce(F.bit_count("bits"), F.lit(0)) == F.col("rows")
    below = F.expr(f"~shiftleft(-1L, cast(doc_id & {(1 << WORD_BITS) - 1} as int))")
    alone = found.filter(single).withColumn("i", F.col("before") + F.bit_count(F.col("bits").bitwiseAND(below)))
    named = ["tree", "i", "n", F.col("leaf").alias("node"), "doc_id", "folded"]
    return alone.select(*named).unionByName(_shared(found.filter(~single)).select(*named))


def _shared(found: DataFrame) -> DataFrame:
    """Places of the rows whose words hold some doc_id more than once: by doc_id, then leaf."""
    key = ["tree", "doc_id"]
    copies = found.groupBy(*key, "leaf").agg(
        F.count(F.lit(1)).alias("c"), *[F.first(x).alias(x) for x in ("folded", "word", "before", "n")]
    )
    ids = copies.groupBy(*key, "word").agg(F.sum("c").alias("m"))
    ids = ids.withColumn("_ids", _before("m", ["tree", "word"], "doc_id"))
    # As many digits of the leaf as leave about TIE_ROWS rows together.
    digits = F.ceil(F.log(16.0, F.greatest(F.col("m") / TIE_ROWS, F.lit(1.0)))).cast("int")
    ids = ids.select(F.col("tree").alias("_tree"), F.col("doc_id").alias("_id"), digits.alias("digits"), "_ids")
    tied = copies.join(ids, _same(copies, ids, tree="_tree", doc_id="_id")).drop("_tree", "_id")
    tied = tied.withColumn("prefix", F.substring(F.hex("leaf"), F.lit(1), F.col("digits")))
    prefixes = tied.groupBy(*key, "prefix").agg(F.sum("c").alias("m"))
    prefixes = prefixes.withColumn("_prefixes", _before("m", key, "prefix")).drop("m")
    prefixes = prefixes.withColumnsRenamed({"tree": "_tree", "doc_id": "_id", "prefix": "_prefix"})
    tied = tied.join(prefixes, _same(tied, prefixes, tree="_tree", doc_id="_id", prefix="_prefix"))
    start = F.col("before") + F.col("_ids") + F.col("_prefixes") + _before("c", [*key, "prefix"], "leaf")
    laid = tied.withColumn("start", start).withColumn("piece", F.explode(F.expr(f"sequence(0, (c - 1) div {COPIES})")))
    first = F.col("piece") * COPIES
    last = F.least(F.col("c"), first + COPIES) - 1
    return laid.withColumn("i", F.explode(F.sequence(F.col("start") + first, F.col("start") + last)))


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def reduced(nodes: list[str], n: int) -> list[list[str]]:
    """The levels over a block's nodes, up to ``LEVELS`` more, or to one node if the tree's ``n`` nodes are done before."""
    levels = [nodes]
    for _ in range(LEVELS):
        if n == 1:
            break
        below = levels[-1]
        levels.append([_digest("".join(below[at : at + RUN])) for at in range(0, len(below), RUN)])
        n = -(-n // RUN)
    return levels


def climb(levels: list[list[str]], at: int) -> list[dict[str, str]]:
    """What stands before and after the node in its run, from its level to the block's last."""
    path = []
    for level in levels[:-1]:
        first = at - at % RUN
        path.append({"before": "".join(level[first:at]), "after": "".join(level[at + 1 : first + RUN])})
        at //= RUN
    return path


def _mapped(df: DataFrame, work, ddl: str) -> DataFrame:
    schema = StructType.fromDDL(ddl)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in work(batches):
            if rows:
                columns = zip(zip(*rows, strict=True), arrow, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in columns], schema=arrow)

    return df.mapInArrow(run, schema)


BLOCKS = "tree string, block bigint, n bigint, node binary, nodes binary, ids array<bigint>, folded array<binary>"
PATH = "array<struct<before: string, after: string>>"


def _blocks(nodes: DataFrame) -> DataFrame:
    """Slot arrays of ``BLOCK`` nodes (tree, i, n, node, doc_id, folded), each with the node it reduces to."""

    def array(key, n, rows):
        low = key[1] * BLOCK
        slots = [None] * min(BLOCK, n - low)
        for place, *values in rows:
            slots[place - low] = values
        node, ids, folded = zip(*slots, strict=True)
        top = reduced([x.hex() for x in node], n)[-1][0]
        return *key, n, bytes.fromhex(top), b"".join(node), ids, folded

    def work(batches):
        key, n, rows = None, 0, []
        for batch in batches:
            out = []
            for tree, block, size, *row in zip(*map(pa.Array.to_pylist, batch.columns), strict=True):
                if (tree, block) != key:
                    if rows:
                        out.append(array(key, n, rows))
                    key, n, rows = (tree, block), size, []
                rows.append(row)
            yield out
        if rows:
            yield [array(key, n, rows)]

    block = F.expr(f"i div {BLOCK}").alias("block")
    dealt = nodes.select("tree", block, "n", "i", "node", "doc_id", "folded").repartition("tree", "block")
    return _mapped(dealt.sortWithinPartitions("tree", "block"), work, BLOCKS)


def _paths(blocks: DataFrame) -> DataFrame:
    """tree, i, doc_id, node, folded and path of every node of ``blocks``, which carry their own path as ``upper``."""

    def work(batches):
        for batch in batches:
            for tree, block, n, nodes, ids, folded, upper in zip(*map(pa.Array.to_pylist, batch.columns), strict=True):
                node = [nodes[at : at + 32] for at in range(0, len(nodes), 32)]
                levels = reduced([x.hex() for x in node], n)
                low = block * BLOCK
                yield [
                    (tree, low + at, ids[at], node[at], folded[at], climb(levels, at) + upper) for at in range(len(node))
                ]

    chosen = blocks.select("tree", "block", "n", "nodes", "ids", "folded", "upper")
    return _mapped(chosen, work, f"tree string, i bigint, doc_id bigint, node binary, folded binary, path {PATH}")


@dataclass
class Trees:
    """Slot arrays of every round, in the shared folder, and the last node of each tree."""

    rounds: list[DataFrame]
    tops: DataFrame

    @staticmethod
    def of(nodes: DataFrame, largest: int) -> Trees:
        """Trees over ``nodes``, of which the largest has ``largest``."""
        rounds, tops = [], []
        while True:
            blocks = kept(_blocks(nodes), "merkle-blocks")
            rounds.append(blocks)
            tops.append(blocks.filter(F.col("n") <= BLOCK).select("tree", "node"))
            if largest <= BLOCK:
                break
            largest = -(-largest // BLOCK)
            nodes = blocks.filter(F.col("n") > BLOCK).select(
                "tree", F.col("block").alias("i"), F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"), "node",
                F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("folded"),
            )
        every = tops[0]
        for more in tops[1:]:
            every = every.unionByName(more)
        return Trees(rounds, every)

    def paths(self, above: DataFrame) -> DataFrame:
        """Paths of all leaves; ``above`` has the path of each tree's last node (tree, path)."""
        done = above.select(F.col("tree").alias("_tree"), F.lit(0).cast("long").alias("_i"), F.lit(True).alias("_done"), "path")
        upper = done
        for blocks in reversed(self.rounds):
            named = blocks.withColumn("done", F.col("n") <= BLOCK)
            met = named.join(upper, _same(named, upper, tree="_tree", block="_i", done="_done"))
            below = _paths(met.withColumnRenamed("path", "upper"))
            onward = below.select(F.col("tree").alias("_tree"), F.col("i").alias("_i"), F.lit(False).alias("_done"), "path")
            upper = done.unionByName(onward)
        return below


def _numbered(tops: DataFrame) -> DataFrame:
    """The trees' last nodes as one tree's leaves, in order of their names: numbered per part of a range sort."""
    ordered = tops.orderBy(F.asc_nulls_first("tree")).withColumn("_at", F.monotonically_increasing_id())
    ordered = kept(ordered, "trees").withColumn("_part", F.shiftright("_at", 33))
    sizes = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("rows"), F.lit(0).alias("_one"))
    starts = sizes.select(F.col("_part").alias("_p"), _before("rows", ["_one"], "_part").alias("_start"))
    place = F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1)
    return ordered.join(starts, F.col("_part") == F.col("_p")).select("tree", "node", place.alias("i"))


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, lang, place, leaf, folded, subroot, root and path of every document.

    ``path`` holds, from the leaf up through the subroot to the root, what stands before and after the node in its run.
    """
    rows = kept(leaves(docs), "leaves")
    # One number comes to the driver: the leaves of the largest tree, which sets the number of rounds.
    largest = rows.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    trees = Trees.of(places(rows), largest)
    numbered = kept(_numbered(trees.tops), "numbered")
    count = numbered.count()
    root = Trees.of(
        numbered.select(
            F.lit(None).cast("string").alias("tree"), "i", F.lit(count).cast("long").alias("n"), "node",
            F.col("i").alias("doc_id"), F.lit(None).cast("binary").alias("folded"),
        ),
        count,
    )
    whole = root.tops.select(F.lower(F.hex("node")).alias("root"))
    nothing = root.tops.select("tree", F.array().cast(PATH).alias("path"))
    climbed = root.paths(nothing).select(F.col("i").alias("_i"), "path")
    above = kept(numbered.join(climbed, F.col("i") == F.col("_i")).select("tree", "node", "path"), "above")
    found = trees.paths(above.select("tree", "path"))
    # There is one root, or none for an empty table.
    top = whole.first()
    subroots = above.select(F.col("tree").alias("_tree"), F.lower(F.hex("node")).alias("subroot"))
    return found.join(subroots, _same(found, subroots, tree="_tree")).select(
        "doc_id", F.col("tree").alias("lang"), F.col("i").alias("place"), F.lower(F.hex("node")).alias("leaf"),
        F.lower(F.hex("folded")).alias("folded"), "subroot", F.lit(top[0] if top else None).cast("string").alias("root"), "path",
    )


def verified(rows: DataFrame) -> DataFrame:
    """Proof digest of every document of a manifest, and whether its tampered (else its own) leaf still leads to the root."""
    siblings = F.array_join(F.transform("path", lambda p: F.concat(p["before"], p["after"])), "")
    start = F.coalesce("folded", "leaf")
    folded = F.aggregate("path", start, lambda node, p: F.sha2(F.concat(p["before"], node, p["after"]), 256))
    out = rows.select(
        "doc_id", "lang", "place", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
