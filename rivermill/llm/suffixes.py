"""Removal of long repeated byte strings by longest-previous-factor arrays over suffix order.

A byte is removed if it lies in a string of ``LENGTH`` bytes that also starts elsewhere: anywhere (``keep="none"``), or at an
earlier place by (doc_id, place) (``keep="first"``, which leaves the first copy). In suffix order, the longest earlier
match of a suffix is found at its previous or next smaller position: among suffixes that agree on ``LENGTH`` bytes, that is
any one but the first in text order.

Only places that can repeat need ordering. Each window of ``LENGTH`` bytes picks an anchor, the place in it whose next
``GRAM`` bytes have the least hash; equal windows pick equal anchors. So a window repeats only if the bytes of its anchor do.
Counting anchors leaves those that occur twice or more. An anchor with its whole context (all windows it can serve) equal to
another's is settled by counting too. What is left, mostly the ends of repeated passages, is one context for each
different one, and goes through suffix order, grouped by anchor: what follows the anchor and, backwards, what precedes it
are sorted, and common lengths of neighbours give the strings that agree. A group of more than ``HOT`` contexts is not gathered:
its windows are counted one by one under a 128-bit hash, combined before the shuffle.

Defined cases: a null text is empty; texts shorter than ``LENGTH`` keep all bytes; matches never cross documents, but may lie
in one document and overlap; copies of a document count as places of their own, so with ``keep="none"`` all of
them lose what they share; with ``keep="first"`` rows equal in doc_id and text count as one place; a null doc_id is an id
like any other and comes first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from rivermill.llm.common import kept

LENGTH = 200
GRAM = 48
HOT = 32_768
CHUNK = 1 << 18  # bytes of a text that are hashed at a time; places in it fit PLACE bits
PLACE = 20
BATCH = 1 << 22  # context bytes that are ordered at a time

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _gram_hashes(data: bytes) -> np.ndarray:
    """A hash of the next ``GRAM`` bytes at every place."""
    words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    count = len(data) - GRAM + 1
    mixed = words[:count].copy()
    for at in range(8, GRAM, 8):
        mixed ^= mixed >> np.uint64(29)
        mixed *= _MIX
        mixed += words[at : at + count]
    mixed ^= mixed >> np.uint64(32)
    mixed *= _MIX
    return mixed


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, from minima of blocks from their left and right ends."""
    count = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:count], left[width - 1 : width - 1 + count])


def anchors(data: bytes, length: int = LENGTH) -> np.ndarray:
    """Anchors of all windows, ascending."""
    found, starts = [], len(data) - length + 1
    mask = np.uint64((1 << PLACE) - 1)
    for first in range(0, max(0, starts), CHUNK):
        part = data[first : min(first + CHUNK, starts) + length - 1]
        hashes = _gram_hashes(part)
        hashes |= mask
        hashes ^= mask
        hashes |= np.arange(len(hashes), dtype=np.uint64)  # of equal hashes the leftmost is least
        least = _least(hashes, length - GRAM + 1) & mask
        found.append(first + np.unique(least).astype(np.int64))
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def _reach(p: int, size: int, length: int) -> tuple[int, int]:
    """The bytes of all windows that an anchor can serve."""
    return max(0, p - (length - GRAM)), min(size, p + length)


def _mapped(df: DataFrame, work, ddl: str) -> DataFrame:
    """``df`` in Arrow batches through ``work``, which gives rows of ``ddl`` as lists of columns."""
    schema = StructType.fromDDL(ddl)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in work(batches):
            arrays = [pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, schema)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _named(docs: DataFrame) -> DataFrame:
    """doc_id, h (31 bits of a hash of the text) and text: doc_id and h tell rows apart that repeat a doc_id."""
    h = F.xxhash64(docs["text"]).bitwiseAND((1 << 31) - 1)
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), h.alias("h"), docs["text"])


def _anchor_rows(named: DataFrame, length: int) -> DataFrame:
    """a (hash of the anchor's bytes), c (hash of its context), doc_id, and h and place packed in hp."""
    digest = xxhash.xxh64_intdigest

    def work(batches):
        for batch in batches:
            a, c, owner, hp = [], [], [], []
            for name, h, text in zip(*batch.columns, strict=True):
                data = (text.as_py() or "").encode()
                places = anchors(data, length).tolist() if len(data) >= length else []
                base = h.as_py() << 32
                for p in places:
                    low, high = _reach(p, len(data), length)
                    a.append(digest(data[p : p + GRAM]))
                    c.append(digest(data[low:high], (p - low) << 16 | (high - p)))
                    hp.append(base | p)
                owner += [name.as_py()] * len(places)
            signed = [np.array(x, np.uint64).view(np.int64) for x in (a, c)]
            yield [*signed, owner, np.array(hp, np.int64)]

    return _mapped(named, work, "a bigint, c bigint, doc_id bigint, hp bigint")


def _packed(named: DataFrame) -> DataFrame:
    """The texts compressed, for the shuffles."""

    def work(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            texts = [pack((t.as_py() or "").encode()) for t in batch.column(2)]
            yield [batch.column(0), batch.column(1), texts]

    return _mapped(named, work, "doc_id bigint, h bigint, packed binary")


def _with_lists(named: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """Packed texts with ``rows`` (doc_id, h, item) listed per document; a list is no longer than its text."""
    listed = rows.groupBy(F.col("doc_id").alias("_id"), F.col("h").alias("_h")).agg(F.collect_list("item").alias("items"))
    packed = _packed(named)
    same = packed["doc_id"].eqNullSafe(listed["_id"]) & (packed["h"] == listed["_h"])
    return packed.join(listed, same, how).select("doc_id", "h", "packed", "items")


def _contexts(named: DataFrame, chosen: DataFrame, length: int) -> DataFrame:
    """Context bytes of the ``chosen`` anchors (doc_id, hp, a, n, hot)."""

    def work(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = [[] for _ in range(8)]
            for name, h, packed, items in zip(*batch.columns, strict=True):
                data = unpack(packed.as_py())
                for item in items.as_py():
                    low, high = _reach(item["p"], len(data), length)
                    row = (item["a"], item["hot"], item["n"], name.as_py(), h.as_py(), low, item["p"], data[low:high])
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            yield out

    h, p = F.shiftright("hp", 32), F.col("hp").bitwiseAND((1 << 32) - 1)
    rows = chosen.select("doc_id", h.alias("h"), F.struct(p.alias("p"), "a", "n", "hot").alias("item"))
    fields = "a bigint, hot boolean, n bigint, doc_id bigint, h bigint, low bigint, p bigint, bytes binary"
    return _mapped(_with_lists(named, rows, "inner"), work, fields)


def suffix_order(texts: list[bytes], groups: list[int], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of ``texts`` by group, and how many bytes each has in common with the one before it.

    Common bytes are counted up to ``width``, shorter texts filled with zeros; the first of a group has -1.
    """
    order = np.array(sorted(range(len(texts)), key=lambda i: (groups[i], texts[i])))
    table = np.frombuffer(b"".join(t[:width].ljust(width, b"\0") for t in texts), np.uint8).reshape(-1, width)[order]
    same = table[1:] == table[:-1]
    common = np.where(same.all(axis=1), width, same.argmin(axis=1))
    owner = np.array(groups)[order]
    common[owner[1:] != owner[:-1]] = -1
    return order, np.append(-1, common)


def prefix_classes(order: np.ndarray, common: np.ndarray, length: int) -> np.ndarray:
    """A number per text that texts of a group share exactly if they agree on ``length`` bytes: runs in suffix order."""
    classes = np.empty(len(order), np.int64)
    classes[order] = np.cumsum(common < length)
    return classes


def earlier_match(ranks: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Whether a suffix has a longest previous factor of the ranked length: an equal rank at a smaller ``order``.

    In suffix order, ties by ``order``, the previous smaller position of such a suffix is in its run of equal ranks.
    """
    sorted_places = np.lexsort((order, ranks))
    run = ranks[sorted_places]
    new = np.append(True, run[1:] != run[:-1])
    least = order[sorted_places][np.maximum.accumulate(np.where(new, np.arange(len(run)), 0))]
    out = np.zeros(len(ranks), bool)
    out[sorted_places] = order[sorted_places] > least
    return out


def _starts(p: int, low: int, size: int, length: int) -> range:
    """Starts, within a context of ``size`` bytes from ``low``, of the windows that hold the anchor."""
    return range(max(0, p - (length - GRAM) - low), min(p - low, size - length) + 1)


def _repeats(rows: list[tuple], length: int, keep: str) -> list[tuple]:
    """(doc_id, h, start, end) of what repeats among contexts (group, n, doc_id, h, low, p, bytes).

    Equal windows of a group start equally far before the anchor. So the window ``ahead`` bytes before it is known by
    its class among what precedes the anchor, read backwards, and by its class among what follows it.
    """
    width, count = length - GRAM, len(rows)
    groups = np.unique([r[0] for r in rows], return_inverse=True)[1].tolist()
    befores = [r[6][: r[5] - r[4]][::-1] for r in rows]
    afters = [r[6][r[5] - r[4] + GRAM :] for r in rows]
    left, right = suffix_order(befores, groups, width), suffix_order(afters, groups, width)
    left_size, right_size = np.array(list(map(len, befores))), np.array(list(map(len, afters)))
    anchor = np.array([r[5] for r in rows])
    classes, context, start = [], [], []
    for ahead in range(width + 1):
        a, b = prefix_classes(*left, ahead), prefix_classes(*right, width - ahead)
        # A window that is alone on either side is alone.
        usable = (left_size >= ahead) & (right_size >= width - ahead)
        usable &= (np.bincount(a)[a] > 1) & (np.bincount(b)[b] > 1)
        chosen = np.flatnonzero(usable)
        classes.append((ahead * (count + 1) + a[chosen]) * (count + 1) + b[chosen])
        context.append(chosen)
        start.append(anchor[chosen] - ahead)
    classes, context, start = map(np.concatenate, (classes, context, start))
    if not len(classes):
        return []
    # Text order: null ids come first; h and start order the rest.
    named = np.array([(r[2] is not None, r[2] or 0, r[3]) for r in rows], "i8").view("i8,i8,i8")
    owners = np.unique(named, return_inverse=True)[1].ravel()
    place = owners[context] * (int(start.max()) + 1) + start
    hit = earlier_match(classes, place)
    if keep == "none":
        # The first of a run repeats too if another place follows, or if its context has copies.
        hit |= earlier_match(classes, -place)
        many = np.array([r[1] > 1 for r in rows])[context]
        hit |= np.isin(classes, np.unique(classes[many]))
    chosen = np.flatnonzero(hit)
    if not len(chosen):
        return []
    chosen = chosen[np.lexsort((start[chosen], context[chosen]))]
    # Neighbouring starts of one context make one span.
    breaks = np.flatnonzero((np.diff(context[chosen]) != 0) | (np.diff(start[chosen]) > length)) + 1
    firsts, lasts = np.append(0, breaks), np.append(breaks, len(chosen)) - 1
    spans = zip(context[chosen[firsts]].tolist(), start[chosen[firsts]].tolist(), start[chosen[lasts]].tolist(), strict=True)
    return [(rows[i][2], rows[i][3], first, last + length) for i, first, last in spans]


SPANS = "doc_id bigint, h bigint, first bigint, last bigint"


def _ordered(contexts: DataFrame, length: int, keep: str) -> DataFrame:
    """Repeated spans of contexts that are grouped by anchor."""

    def work(batches):
        held, size = [], 0

        def settled(rows):
            found = _repeats(rows, length, keep)
            return list(zip(*found, strict=True)) if found else [[], [], [], []]

        for batch in batches:
            for row in zip(*map(pa.Array.to_pylist, batch.columns), strict=True):
                if size > BATCH and row[0] != held[-1][0]:
                    yield settled(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[6])
        if held:
            yield settled(held)

    names = ["a", "n", "doc_id", "h", "low", "p", "bytes"]
    return _mapped(contexts.select(*names).repartition("a").sortWithinPartitions("a"), work, SPANS)


def _counted(contexts: DataFrame, length: int, keep: str) -> DataFrame:
    """The same for groups too large to gather: their windows are counted under a hash."""

    def work(batches):
        for batch in batches:
            out = [[] for _ in range(6)]
            for _, n, name, h, low, p, data in zip(*map(pa.Array.to_pylist, batch.columns), strict=True):
                for start in _starts(p, low, len(data), length):
                    value = xxhash.xxh3_128_intdigest(data[start : start + length])
                    row = (_signed(value >> 64), _signed(value & (1 << 64) - 1), name, h, low + start, n)
                    for column, x in zip(out, row, strict=True):
                        column.append(x)
            yield out

    fields = "w1 bigint, w2 bigint, doc_id bigint, h bigint, first bigint, n bigint"
    names = ["a", "n", "doc_id", "h", "low", "p", "bytes"]
    windows = _mapped(contexts.select(*names), work, fields)
    at = F.struct("doc_id", "h", "first")
    seen = windows.groupBy(F.col("w1").alias("_1"), F.col("w2").alias("_2")).agg(
        F.min(at).alias("least"), F.max(at).alias("most"), F.max("n").alias("many")
    )
    repeated = seen.filter((F.col("least") != F.col("most")) | (F.col("many") > 1))
    back = windows.join(repeated, (F.col("w1") == F.col("_1")) & (F.col("w2") == F.col("_2")))
    if keep == "first":
        back = back.filter(at != F.col("least"))
    return back.select("doc_id", "h", "first", (F.col("first") + length).alias("last"))


def repeated_spans(docs: DataFrame, keep: str = "none", length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """doc_id, h, first and last (exclusive) of spans that cover what is to be removed; they may overlap."""
    if keep not in ("none", "first"):
        raise ValueError(f"keep: {keep}")
    if length < GRAM + 8:
        raise ValueError(f"length must be at least {GRAM + 8}")
    named = _named(docs)
    rows = kept(_anchor_rows(named, length), "anchors")
    often = rows.groupBy(F.col("a").alias("_a")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    shared = kept(rows.join(often, F.col("a") == F.col("_a")).select("a", "c", "doc_id", "hp"), "shared")
    first = F.min(F.struct("doc_id", "hp")).alias("first")
    different = kept(shared.groupBy("a", "c").agg(F.count(F.lit(1)).alias("n"), first), "contexts")

    # Contexts with copies repeat as a whole.
    copied = different.filter("n > 1").select(F.col("a").alias("_a"), F.col("c").alias("_c"), "first")
    whole = shared.join(copied, (F.col("a") == F.col("_a")) & (F.col("c") == F.col("_c")))
    if keep == "first":
        whole = whole.filter(F.struct("doc_id", "hp") != F.col("first"))
    h, p = F.shiftright("hp", 32), F.col("hp").bitwiseAND((1 << 32) - 1)
    spans = whole.select(
        "doc_id", h.alias("h"), F.greatest(F.lit(0), p - (length - GRAM)).alias("first"), (p + length).alias("last")
    )

    # Different contexts of one anchor are compared window by window.
    groups = different.groupBy(F.col("a").alias("_a")).agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    chosen = different.join(groups, F.col("a") == F.col("_a")).select(
        "first.doc_id", "first.hp", "a", "n", (F.col("m") > hot).alias("hot")
    )
    contexts = kept(_contexts(named, chosen, length), "context-bytes")
    spans = spans.unionByName(_ordered(contexts.filter("not hot"), length, keep))
    return spans.unionByName(_counted(contexts.filter("hot"), length, keep))


def _merged(items: list[dict], size: int) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted((i["first"], min(i["last"], size)) for i in items):
        if out and first <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], last)
        else:
            out.append((first, last))
    return out


def without_repeats(docs: DataFrame, keep: str = "none", length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, spans (removed, as first and last) and rest (the remaining bytes) of every document."""
    found = repeated_spans(docs, keep, length, hot)
    listed = found.select("doc_id", "h", F.struct("first", "last").alias("item"))

    def work(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = [[] for _ in range(4)]
            for name, _, packed, items in zip(*batch.columns, strict=True):
                data = unpack(packed.as_py())
                spans = _merged(items.as_py() or [], len(data))
                rest, at = [], 0
                for first, last in spans:
                    rest.append(data[at:first])
                    at = last
                rest.append(data[at:])
                row = (name.as_py(), len(data), [{"first": a, "last": b} for a, b in spans], b"".join(rest))
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            yield out

    fields = "doc_id bigint, n_bytes bigint, spans array<struct<first: bigint, last: bigint>>, rest binary"
    return _mapped(_with_lists(_named(docs), listed, "left"), work, fields)


def digests(docs: DataFrame) -> DataFrame:
    """Per document what is left without repeated strings."""
    left = without_repeats(docs)
    return left.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("rest")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("rest", 256).alias("kept_sha256"),
    )
