"""Token-id files of directly addressable codes.

Ids are cut into 8-bit chunks. Level 1 holds the low chunk of every id and a bitmap whose bit says that the id goes on; the
ids that go on have their next chunk in level 2, and so on. The place of an id in the next level is the number of set bits
before it, which a directory of running counts gives with one look and at most ``BLOCK`` bits to count. So any token is
read with one chunk per level, and no block is decoded.

A file is a table of segments, each a payload (magic, number of ids, levels) with the documents it holds and the number of
ids before it. Documents are dealt over partitions by ranges of doc_id, and segments close at ``SEGMENT`` ids, so memory
does not grow with the corpus; a document is never cut. Spark's writer commits the files, so a lost task leaves none.

Defined cases: a null or empty text has only the end id; a null doc_id comes first; documents with equal doc_id are ordered
by text, identical ones are interchangeable; an empty table gives no segment.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from rivermill.llm.common import kept
from rivermill.llm.vocabulary import Remembered, byte_letters, pre_tokens

MAGIC = b"DAC1"
BLOCK = 512  # bits per entry of a rank directory
SEGMENT = 1 << 20  # ids
END = 0
SCHEMA = (
    "part int, before bigint, doc_ids array<bigint>, firsts array<bigint>, lasts array<bigint>, n_ids bigint, payload binary"
)


def pack(ids: np.ndarray) -> bytes:
    """The payload of an array of unsigned ids."""
    values, levels = ids.astype(np.uint64), []
    while True:
        more = values > 0xFF
        chunks = (values & np.uint64(0xFF)).astype(np.uint8).tobytes()
        bits = np.packbits(more, bitorder="little").tobytes()
        per_block = np.add.reduceat(more, np.arange(0, len(more), BLOCK)) if len(more) else np.zeros(0, np.int64)
        ranks = np.concatenate([[0], np.cumsum(per_block)[:-1]]).astype("<u4").tobytes() if len(more) else b""
        levels.append((len(values), chunks, bits, ranks))
        if not more.any():
            break
        values = values[more] >> np.uint64(8)
    head = MAGIC + struct.pack("<QB", len(ids), len(levels))
    sizes = b"".join(struct.pack("<QQQQ", n, len(c), len(b), len(r)) for n, c, b, r in levels)
    return head + sizes + b"".join(c + b + r for _, c, b, r in levels)


class Codes:
    """Reads a payload in place: ``codes[i]`` and ``codes.slice(first, last)``."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a payload of directly addressable codes")
        self.size, count = struct.unpack_from("<QB", payload, 4)
        at, self.levels = 13 + 32 * count, []
        for level in range(count):
            _, c, b, r = struct.unpack_from("<QQQQ", payload, 13 + 32 * level)
            self.levels.append(
                (
                    np.frombuffer(payload, np.uint8, c, at),
                    np.frombuffer(payload, np.uint8, b, at + c),
                    np.frombuffer(payload, "<u4", r // 4, at + c + b),
                )
            )
            at += c + b + r

    def _rank(self, level: int, i: int) -> int:
        """Set bits before place ``i``."""
        _, bits, ranks = self.levels[level]
        if not len(ranks):
            return 0
        block = min(i // BLOCK, len(ranks) - 1)
        start = block * BLOCK
        inside = np.unpackbits(bits[start // 8 : (i + 7) // 8], bitorder="little")[: i - start]
        return int(ranks[block]) + int(inside.sum())

    def _goes_on(self, level: int, i: int) -> bool:
        return bool(self.levels[level][1][i // 8] >> (i % 8) & 1)

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.size:
            raise IndexError(i)
        value, shift = 0, 0
        for level, (chunks, _, _) in enumerate(self.levels):
            value |= int(chunks[i]) << shift
            if not self._goes_on(level, i):
                break
            i, shift = self._rank(level, i), shift + 8
        return value

    def slice(self, first: int, last: int) -> np.ndarray:
        """Ids of places ``first`` to ``last``, exclusive: the same walk for a range of neighbours."""
        out = np.zeros(last - first, np.uint64)
        places = np.arange(last - first)
        for level, (chunks, bits, _) in enumerate(self.levels):
            out[places] |= chunks[first:last].astype(np.uint64) << np.uint64(8 * level)
            low = first // 8 * 8
            more = np.unpackbits(bits[low // 8 : (last + 7) // 8], bitorder="little")[first - low : last - low]
            more = more.astype(bool)
            if not more.any():
                break
            places = places[more]
            first = self._rank(level, first)
            last = first + len(places)
        return out


class LibraryIds:
    """Ids as the tokenizers library gives them; a pre-token goes through the library once and is remembered.

    Special strings are cut out first, as the library does; pre-tokens are then independent of each other.
    """

    def __init__(self, file: str):
        self.library = Tokenizer.from_str(file)
        self.library.no_truncation()
        self.library.no_padding()
        self.words = Remembered(self.of_pre_token, words=400_000)
        self.model, self.letters = self.library.model, dict(enumerate(byte_letters()))
        self.special = {t.content: n for n, t in self.library.get_added_tokens_decoder().items()}

    def of(self, text: str) -> tuple[int, ...]:
        return tuple(self.library.encode(text, add_special_tokens=False).ids)

    def of_pre_token(self, word: str) -> tuple[int, ...]:
        """The library's model on a pre-token, its bytes written as the file's letters."""
        return tuple([t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(self.letters))])

    def __call__(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.array(self.of(text), np.uint32)
        found = list(map(self.words.__getitem__, pre_tokens(text)))
        return np.fromiter(chain.from_iterable(found), np.uint32)


@lru_cache(maxsize=2)
def library_ids(file: str) -> LibraryIds:
    """One encoder per worker process and file: what a task has learnt serves the next."""
    return LibraryIds(file)


def write(docs: DataFrame, vocabulary: str, partitions: int | None = None) -> DataFrame:
    """Encodes, packs and writes ``docs``; gives the written segments as a table."""
    spark = docs.sparkSession
    with open(vocabulary, encoding="utf-8") as file:
        sent = spark.sparkContext.broadcast(file.read())
    schema = StructType.fromDDL(SCHEMA)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, before, encode = TaskContext.get().partitionId(), 0, library_ids(sent.value)
        names, ends, held, total = [], [0], [], 0

        def close():
            row = [[part], [before], [names], [ends[:-1]], [ends[1:]], [total], [pack(np.concatenate(held))]]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, arrow, strict=True)], schema=arrow)

        for batch in batches:
            for name, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.append(encode(text.as_py() or ""), np.uint32(END)).astype(np.uint32)
                if held and total + len(ids) > SEGMENT:
                    yield close()
                    names, ends, held, total, before = [], [0], [], 0, before + total
                names.append(name.as_py())
                held.append(ids)
                total += len(ids)
                ends.append(total)
        if held:
            yield close()

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    order = [F.asc_nulls_first("doc_id"), F.asc_nulls_first("text")]
    dealt = rows.repartitionByRange(partitions, order[0]) if partitions else rows.repartitionByRange(order[0])
    return kept(dealt.sortWithinPartitions(*order).mapInArrow(run, schema), "token-files")


def read(segments: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files.

    A segment knows the ids before it in its partition; those of the partitions before come from one sum per partition,
    which are broadcast (one row per partition of the files).
    """
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    parts = parts.select("part", F.coalesce(F.sum("_n").over(order), F.lit(0)).alias("_start"))
    schema = StructType.fromDDL("doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                codes = Codes(row["payload"])
                spans = list(zip(row["firsts"], row["lasts"], strict=True))
                crc = [zlib.crc32(codes.slice(a, b).astype("<u4").tobytes()) for a, b in spans]
                columns = [row["doc_ids"], [row["before"] + a for a, _ in spans], [b - a for a, b in spans], crc]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, f.type) for v, f in zip(columns, arrow, strict=True)], schema=arrow
                )

    joined = segments.join(F.broadcast(parts), "part").withColumn("before", F.col("before") + F.col("_start"))
    return joined.select("before", "doc_ids", "firsts", "lasts", "payload").mapInArrow(run, schema)
