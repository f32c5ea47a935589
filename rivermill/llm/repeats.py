"""Removal of passages that repeat an earlier document's: seeds from winnowed anchors, extended word by word both ways.

A word is removed if it lies in a window of ``LENGTH`` words that also starts in a document of smaller doc_id, judged on the texts
as they came.

**Seeds.** Every window picks an anchor: of its runs of ``GRAM`` words, the one of least hash, the leftmost of equal ones. Equal windows
pick the same run at the same distance, so a window can repeat only if its anchor occurs in another document. A first pass sends the
hashes of anchors alone, at most two of a value from each batch, to find those that occur in several documents. They set
bits in a bitmap of ``FILTER_BITS`` bits, whatever the corpus's size, which every task of a second pass gets: most anchors that
occur once go no further, and documents are joined on the others.

**Contexts.** What an anchor's windows can cover is its context: the words up to ``LENGTH`` - ``GRAM`` before and after it. Where a
context occurs whole in an earlier document, as in copies, all its windows go; nothing is gathered for that. Of every
different context only its earliest document is left to be settled.

**Extension.** The different contexts of an anchor meet in order of doc_id. Each is extended to the right, then to the left, a word at
a time, as long as some context of an earlier document goes on alike; a window within reach whose two halves were met together
before repeats. Windows that follow each other join into maximal repeats. Tries hold the extensions, so the work grows with the
contexts, not with pairs of them. An anchor of more than ``HOT`` contexts is not gathered: its windows, already extended in full,
are the keys of an aggregate with map-side combining, which gives the earliest document of each.

Defined cases: a null or empty text has no words; documents of fewer than ``LENGTH`` words keep all; rows of one doc_id never
remove each other's words, and rows equal in doc_id and text get equal results; a null doc_id is neither smaller nor larger than
another, so that its rows lose nothing and remove nothing. Extra columns of any name are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from rivermill.llm.common import kept

LENGTH = 13
GRAM = 4
HOT = 20_000
PLACE = 20  # bits of a place in a slice of words that is winnowed at a time
LONG = 256  # bytes from which a word is hashed by itself
FILTER_BITS = 26  # the bitmap is 8 MB; with very many shared anchors it lets more through, and the shuffle grows
PENDING = 1 << 22  # anchors that a task holds

_MIX = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[bytes]:
    """Words of a text: what is between spaces and the five control characters that count as such."""
    return (text or "").encode().split()


_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of every word, eight bytes of all words at a time."""
    blank = np.concatenate([[True], _SPACE[np.frombuffer(data, np.uint8)], [True]])
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    start, size = edges[::2], edges[1::2] - edges[::2]
    eights = np.ndarray((len(data) + 1,), "<u8", data + bytes(8), strides=(1,))
    out = size.astype(np.uint64) * _MIX
    some, at = np.flatnonzero(size < LONG), 0
    while len(some):
        left = size[some] - at
        spare = (np.maximum(8 - left, 0) * 8).astype(np.uint64)
        value = eights[start[some] + at] << spare
        mixed = (out[some] ^ value) * _MIX
        out[some] = mixed ^ mixed >> np.uint64(29)
        some, at = some[left > 8], at + 8
    for i in np.flatnonzero(size >= LONG).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[start[i] : start[i] + size[i]])
    return out


def _joined(values: np.ndarray, first: np.ndarray | None, width: int) -> np.ndarray:
    """A hash of ``width`` neighbours from every place, or from the places ``first``."""
    factors = np.cumprod(np.full(width, _MIX)) + np.arange(width, dtype=np.uint64) * np.uint64(2)
    out = np.uint64(width)
    for at, factor in enumerate(factors):
        part = values[at : len(values) - width + 1 + at] if first is None else values[first + at]
        out = out + part * factor
    out = (out ^ out >> np.uint64(31)) * _MIX
    return out ^ out >> np.uint64(32)


def anchors(grams: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """Places of the anchors of all windows, ascending, from the hashes of all runs of ``gram`` words."""
    span, found = length - gram + 1, []
    mask = np.uint64((1 << PLACE) - 1)
    step = (1 << PLACE) - span
    for first in range(0, max(0, len(grams) - span + 1), step):
        least = grams[first : first + step + span - 1] & ~mask
        least |= np.arange(len(least), dtype=np.uint64)  # of equal hashes the leftmost is least
        count, width = len(least) - span + 1, 1
        while 2 * width <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[:count], least[span - width : span - width + count]) & mask
        found.append(first + least[np.append(True, least[1:] != least[:-1])].astype(np.int64))
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def _mapped(df: DataFrame, work, ddl: str) -> DataFrame:
    """``df`` in Arrow batches through ``work``, which gives rows of ``ddl`` as lists of columns."""
    schema = StructType.fromDDL(ddl)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in work(batches):
            arrays = [pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, schema)


def _named(docs: DataFrame) -> DataFrame:
    """doc_id, h (a hash of the text, which tells rows apart that share a doc_id) and text."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(docs["text"]).alias("h"), docs["text"])


def _shared(named: DataFrame, length: int, gram: int) -> Broadcast:
    """A bitmap, by their first bits, of the hashes of anchors that occur in several rows."""
    spark = named.sparkSession
    # A bucket is one task's work: several for each partition.
    bits = max(10, (4 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    slots = max(0, FILTER_BITS - bits)

    def send(batches):
        def dealt(found):
            value, count = np.unique(np.concatenate(found), return_counts=True)
            value = np.repeat(value, np.minimum(count, 2))
            bucket = (value >> np.uint64(64 - bits)).astype(np.int64)
            rest = (value << np.uint64(bits) >> np.uint64(32)).astype("<u4")
            edges = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            ends = np.append(edges[1:], len(bucket))
            return [bucket[edges], [rest[a:z].tobytes() for a, z in zip(edges, ends, strict=True)]]

        for batch in batches:
            found, held = [], 0
            for doc_id, text in zip(batch.column(0), batch.column(2), strict=True):
                hashed = word_hashes((text.as_py() or "").encode())
                if len(hashed) >= length and doc_id.is_valid:
                    grams = _joined(hashed, None, gram)
                    found.append(np.unique(grams[anchors(grams, length, gram)]))
                    held += len(found[-1])
                if held > PENDING:
                    yield dealt(found)
                    found, held = [], 0
            if found:
                yield dealt(found)

    def meet(batches):
        def slice_of(parts):
            value = np.sort(np.frombuffer(b"".join(parts), "<u4"))
            twice = value[1:][value[1:] == value[:-1]]
            out = np.zeros(1 << slots, np.uint8)
            out[twice >> np.uint32(32 - slots)] = 1
            return np.packbits(out).tobytes()

        bucket, parts = None, []
        for batch in batches:
            out = [[], []]
            for number, part in zip(*map(pa.Array.to_pylist, batch.columns), strict=True):
                if number != bucket and parts:
                    out[0].append(bucket)
                    out[1].append(slice_of(parts))
                    parts = []
                bucket = number
                parts.append(part)
            yield out
        if parts:
            yield [[bucket], [slice_of(parts)]]

    sent = _mapped(named, send, "bucket bigint, part binary")
    met = _mapped(sent.repartition("bucket").sortWithinPartitions("bucket"), meet, "bucket bigint, part binary")
    whole = np.zeros((1 << bits, max(1, (1 << slots) // 8)), np.uint8)
    for bucket, part in met.collect():
        whole[bucket] = np.frombuffer(part, np.uint8)
    return spark.sparkContext.broadcast((bits + slots, whole.ravel()))


def _seeds(named: DataFrame, shared: Broadcast, length: int, gram: int) -> DataFrame:
    """a (hash of the anchor), c (hash of its context), doc_id, h and p (its place) of anchors in the bitmap ``shared``."""
    reach = length - gram

    def work(batches):
        bits, bitmap = shared.value
        for batch in batches:
            out = [[] for _ in range(5)]
            for doc_id, h, text in zip(*batch.columns, strict=True):
                hashed = word_hashes((text.as_py() or "").encode())
                if len(hashed) < length or not doc_id.is_valid:
                    continue
                grams = _joined(hashed, None, gram)
                places = anchors(grams, length, gram)
                bit = (grams[places] >> np.uint64(64 - bits)).astype(np.int64)
                places = places[bitmap[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8) & 1 == 1]
                # Contexts at the ends of a text are shorter, and filled up with a hash of no word.
                padded = np.concatenate([np.zeros(reach, np.uint64), hashed, np.zeros(reach, np.uint64)])
                out[0].append(grams[places].view(np.int64))
                out[1].append(_joined(padded, places, 2 * reach + gram).view(np.int64))
                out[2].append(np.full(len(places), doc_id.as_py()))
                out[3].append(np.full(len(places), h.as_py()))
                out[4].append(places.astype(np.int32))
            yield [np.concatenate(c) if c else [] for c in out]

    return _mapped(named, work, "a bigint, c bigint, doc_id bigint, h bigint, p int")


def _packed(named: DataFrame) -> DataFrame:
    """The texts compressed, for the shuffles."""

    def work(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            yield [batch.column(0), batch.column(1), [pack((t.as_py() or "").encode()) for t in batch.column(2)]]

    return _mapped(named, work, "doc_id bigint, h bigint, packed binary")


def _with_lists(named: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """Packed texts with the items of ``rows`` (doc_id, h, item) listed; a list is no longer than its text."""
    listed = rows.groupBy(F.col("doc_id").alias("_id"), F.col("h").alias("_h")).agg(F.collect_list("item").alias("items"))
    packed = _packed(named)
    same = packed["doc_id"].eqNullSafe(listed["_id"]) & (packed["h"] == listed["_h"])
    return packed.join(listed, same, how).select("doc_id", "h", "packed", "items")


def _contexts(named: DataFrame, chosen: DataFrame, length: int, gram: int) -> DataFrame:
    """Words before and after the ``chosen`` anchors (doc_id, h, p, a, hot), joined by spaces."""
    reach = length - gram

    def work(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = [[] for _ in range(8)]
            for doc_id, h, packed, items in zip(*batch.columns, strict=True):
                found = unpack(packed.as_py()).split()
                for item in items.as_py():
                    p = item["p"]
                    before, after = found[max(0, p - reach) : p], found[p + gram : p + gram + reach]
                    seed = b" ".join(found[p : p + gram])
                    row = (item["a"], item["hot"], doc_id.as_py(), h.as_py(), p, seed, b" ".join(before), b" ".join(after))
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            yield out

    rows = chosen.select("doc_id", "h", F.struct("p", "a", "hot").alias("item"))
    fields = "a bigint, hot boolean, doc_id bigint, h bigint, p int, seed binary, before binary, after binary"
    return _mapped(_with_lists(named, rows, "inner"), work, fields)


class Extensions:
    """What the contexts of earlier documents look like around one seed.

    ``right`` and ``left`` are tries: a node is a match of some more words, a number; ``both`` holds which right and left nodes were
    met in one context, as far as that makes whole windows.
    """

    def __init__(self, reach: int):
        self.reach = reach
        self.right: dict[tuple[int, bytes], int] = {}
        self.left: dict[tuple[int, bytes], int] = {}
        self.both: set[tuple[int, int]] = set()

    def walk(self, trie: dict, found: list[bytes]) -> list[int]:
        """Nodes of the match, longer by a word each, as far as an earlier context goes on alike."""
        nodes = [0]
        for word in found:
            node = trie.get((nodes[-1], word))
            if node is None:
                break
            nodes.append(node)
        return nodes

    def repeated(self, before: list[bytes], after: list[bytes]) -> list[int]:
        """How many words before the seed repeated windows start, descending; ``before`` from the seed outwards."""
        right = self.walk(self.right, after)
        short = self.reach - (len(right) - 1)
        if len(before) < short:
            return []
        left = self.walk(self.left, before)
        ahead = range(len(left) - 1, short - 1, -1)
        return [n for n in ahead if (left[n], right[self.reach - n]) in self.both]

    def add(self, before: list[bytes], after: list[bytes]) -> None:
        nodes = []
        for trie, found in ((self.left, before), (self.right, after)):
            path = [0]
            for word in found:
                path.append(trie.setdefault((path[-1], word), len(trie) + 1))
            nodes.append(path)
        left, right = nodes
        for n in range(max(0, self.reach - len(right) + 1), len(left)):
            self.both.add((left[n], right[self.reach - n]))


SPANS = "doc_id bigint, h bigint, first int, last int"


def _spans(row: tuple, ahead: list[int], length: int) -> Iterator[tuple]:
    """Maximal repeats of neighbouring windows, as (doc_id, h, first, last)."""
    doc_id, h, p = row
    at = 0
    while at < len(ahead):
        end = at
        while end + 1 < len(ahead) and ahead[end] - ahead[end + 1] <= length:
            end += 1
        yield doc_id, h, p - ahead[at], p - ahead[end] + length
        at = end + 1


def _extended(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """Repeats of contexts (a, seed, doc_id, h, p, before, after), each anchor's in order of doc_id."""
    reach = length - gram

    def work(batches):
        key, met, doc_id, waiting = None, Extensions(reach), None, []
        for batch in batches:
            out = [[] for _ in range(4)]
            for a, seed, *row, before, after in zip(*map(pa.Array.to_pylist, batch.columns), strict=True):
                if (a, seed) != key:
                    key, met, waiting = (a, seed), Extensions(reach), []
                elif row[0] != doc_id:
                    for sides in waiting:
                        met.add(*sides)
                    waiting = []
                doc_id = row[0]
                sides = before.split()[::-1], after.split()
                for span in _spans(row, met.repeated(*sides), length):
                    for column, value in zip(out, span, strict=True):
                        column.append(value)
                waiting.append(sides)
            yield out

    names = ["a", "seed", "doc_id", "h", "p", "before", "after"]
    dealt = contexts.select(*names).repartition("a").sortWithinPartitions("a", "seed", "doc_id")
    return _mapped(dealt, work, SPANS)


def _counted(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """The same for anchors of too many contexts: each window's earliest document by an aggregate."""
    reach = length - gram

    def work(batches):
        for batch in batches:
            out = [[] for _ in range(5)]
            for a, seed, doc_id, h, p, before, after in zip(*map(pa.Array.to_pylist, batch.columns), strict=True):
                left, middle, right = before.split(), seed.split(), after.split()
                found = left + middle + right
                for ahead in range(max(0, reach - len(right)), len(left) + 1):
                    at = len(left) - ahead
                    window = xxhash.xxh3_128_digest(b" ".join(found[at : at + length]))
                    for column, value in zip(out, (window, doc_id, h, p - ahead, p - ahead + length), strict=True):
                        column.append(value)
            yield out

    names = ["a", "seed", "doc_id", "h", "p", "before", "after"]
    windows = _mapped(contexts.select(*names), work, "window binary, " + SPANS)
    least = windows.groupBy(F.col("window").alias("_window")).agg(F.min("doc_id").alias("_least"), F.max("doc_id").alias("_most"))
    least = least.filter("_least < _most")
    late = windows.join(least, F.col("window") == F.col("_window")).filter("_least < doc_id")
    return late.select("doc_id", "h", "first", "last")


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """doc_id, h, first and last (exclusive) of words that repeat an earlier document; spans may overlap."""
    if not 0 < gram < length:
        raise ValueError("gram must be shorter than length")
    reach = length - gram
    named = _named(docs)
    seeds = kept(_seeds(named, _shared(named, length, gram), length, gram), "seeds")
    # Of each anchor and context: the earliest document, and whether there are others.
    least = F.min("doc_id").alias("least")
    contexts = kept(seeds.groupBy("a", "c").agg(least, F.max("doc_id").alias("most")), "contexts")
    # Anchors of different contexts that several documents have.
    mixed = contexts.groupBy(F.col("a").alias("_a")).agg(
        F.min("least").alias("_first"), F.max("most").alias("_last"), F.count(F.lit(1)).alias("m")
    ).filter("_first < _last and m > 1")
    joined = contexts.join(mixed, F.col("a") == F.col("_a"), "left")
    told = joined.filter("least < most or m is not null").select(
        F.col("a").alias("_a"), F.col("c").alias("_c"), "least", (F.col("m") > hot).alias("hot")
    )
    # A context that an earlier document has goes whole; of the others the earliest document's is to be settled.
    same = (F.col("a") == F.col("_a")) & (F.col("c") == F.col("_c"))
    met = kept(seeds.join(told, same).select("doc_id", "h", "p", "a", "least", "hot"), "met")
    spans = met.filter("doc_id > least").select(
        "doc_id", "h", F.greatest(F.lit(0), F.col("p") - reach).alias("first"), (F.col("p") + length).alias("last")
    )
    chosen = met.filter("doc_id = least and hot is not null").select("doc_id", "h", "p", "a", "hot")
    around = kept(_contexts(named, chosen, length, gram), "context-words")
    spans = spans.unionByName(_extended(around.filter("not hot"), length, gram))
    return spans.unionByName(_counted(around.filter("hot"), length, gram))


def merged(items: list[dict], size: int) -> list[tuple[int, int]]:
    """Spans that do not overlap or touch."""
    out: list[tuple[int, int]] = []
    for first, last in sorted((i["first"], min(i["last"], size)) for i in items):
        if out and first <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], last)
        else:
            out.append((first, last))
    return out


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """doc_id, n_words, spans (of removed words, as first and last) and rest (the words left, joined by spaces)."""
    found = kept(repeated_spans(docs, length, gram, hot), "spans")
    listed = found.select("doc_id", "h", F.struct("first", "last").alias("item"))

    def work(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = [[] for _ in range(4)]
            for doc_id, _, packed, items in zip(*batch.columns, strict=True):
                said = unpack(packed.as_py()).split()
                spans = merged(items.as_py() or [], len(said))
                left, at = [], 0
                for first, last in spans:
                    left += said[at:first]
                    at = last
                left += said[at:]
                row = (doc_id.as_py(), len(said), [{"first": a, "last": b} for a, b in spans], b" ".join(left))
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            yield out

    fields = "doc_id bigint, n_words bigint, spans array<struct<first: int, last: int>>, rest binary"
    return _mapped(_with_lists(_named(docs), listed, "left"), work, fields)


def digests(docs: DataFrame) -> DataFrame:
    """Per document its words, those removed, and a digest of what is left."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return without_repeats(docs).select(
        "doc_id", "n_words", removed.alias("n_removed"), F.sha2("rest", 256).alias("kept_sha256")
    )
