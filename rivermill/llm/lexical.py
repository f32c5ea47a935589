"""Ranked lexical search by hashed max-sketches: exact, with upper bounds first.

**Statistics.** One pass over the texts counts documents, terms, and in how many documents each term occurs.

**Sketches.** A second pass writes a row per document: number of terms, a 128-bit digest of its text, and a sketch. A term's impact
is its whole share of a score, weight included. Each distinct term falls on ``HASHES`` coordinates of the sketch, which has
``SPREAD`` for each distinct term; a coordinate keeps the maximum over its terms, rounded up to one byte.
Weights are exact for the ``COMMON`` most frequent terms, which every task gets; a rarer term counts with the weight of a term of
one document, which is never too low.

**Search.** Queries come in blocks of about ``BLOCK_TERMS`` terms and ``BLOCK_QUERIES`` texts, with each term's weight. All terms of a
block are looked up in the sketches of a batch. The least of a term's coordinates bounds its impact; occurrences are whole, so it
is the greatest impact of a whole number of them that fits, often none. The sum bounds the score.
First the documents of the highest expected score (bounds, times how likely a hit is no collision) are rescored from their
texts; the k-th best exact score is the query's threshold. Then every other document whose bound reaches it is rescored. Nothing
below can enter the ranking, so the result is exact whatever the hashes are.

Texts that are equal have equal scores. So candidates are distinct texts, and only the texts that reach a ranking are
laid out as documents, of each the ``k`` smallest doc_ids: a group of copies never meets in one task.

Defined cases: null and empty texts have no terms and are found by no query; a query without terms that occur finds nothing;
every row of the query table gets a ranking of its own, rows with equal ids or texts too; document rows that repeat a doc_id
are documents of their own, neighbours in the ranking where their scores are equal; null doc_ids come first among equal
scores. Extra columns of any name are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from heapq import nlargest

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from rivermill.llm.common import kept

K = 50
SPREAD = 16
HASHES = 4
FIRST = 4  # documents rescored first, times k
COLLISION = 1e-3  # about how often a term hits that is not there; a guess, for expected scores only
COMMON = 50_000
BLOCK_TERMS = 20_000
FLUSH = 100_000  # distinct terms that a task counts before it hands them on
LOOKUPS = 1_000_000  # sketch coordinates that are looked up at a time
BLOCK_QUERIES = 1_000
SENT_ROWS = 200_000  # rows of two numbers at most that are broadcast; more of them are joined by a shuffle

#: Bytes that end a term, and A-Z as a-z. Bytes over 0x7F belong to terms.
_SPLIT = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)
#: What a sketch byte stands for: impacts, from 10^5 up in steps of about 5 %, beyond all that occur. 0 stands for no term.
IMPACTS = np.append(0.0, 1e5 * 1.053 ** np.arange(255))


def terms(text: str | None) -> list[bytes]:
    """Terms of a text in order."""
    return (text or "").encode().translate(_SPLIT).split()


def hashes(found: list[bytes]) -> np.ndarray:
    """``HASHES`` 32-bit hashes of every term, a row each."""
    whole = np.array([xxhash.xxh3_64_intdigest(term) for term in found], np.uint64)[:, None]
    low, high = whole & np.uint64(0xFFFFFFFF), whole >> np.uint64(32) | np.uint64(1)
    return (low + np.arange(HASHES, dtype=np.uint64) * high & np.uint64(0xFFFFFFFF)).astype(np.int64)


def shares(weights: np.ndarray, occurrences: np.ndarray, m: np.ndarray | int) -> np.ndarray:
    """Impacts before they are rounded down: never less than the exact ones."""
    return weights * (1e9 * occurrences / (1e3 * occurrences + 20 * m))


def sketch(counts: dict[bytes, int], m: int, common: dict[bytes, int], rare: int) -> bytes:
    """Coordinatewise maxima of the impacts of a document's terms, as bytes of ``IMPACTS``."""
    weights = np.array([common.get(term, rare) for term in counts], np.float64)
    values = np.searchsorted(IMPACTS, shares(weights, np.array(list(counts.values()), np.float64), m)).astype(np.uint8)
    out = np.zeros(SPREAD * len(counts), np.uint8)
    at = hashes(list(counts)) * len(out) >> 32
    order = np.argsort(values, kind="stable")  # of several values for a coordinate the last, the greatest, stays
    for number in range(HASHES):
        mine = np.zeros_like(out)
        mine[at[order, number]] = values[order]
        np.maximum(out, mine, out)
    return out.tobytes()


def impact(occurrences: int, m: int) -> int:
    return (1_000_000_000 * occurrences) // (1_000 * occurrences + 20 * m)


def length_factor(n: int, documents: int, total: int) -> int:
    return 100 - 50 + (50 * n * documents) // total


def weight(frequency: int, documents: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency + 1)))


def _digest(data: bytes) -> tuple[int, int]:
    """128 bits of a text, as two signed numbers."""
    return tuple(int(x) for x in np.frombuffer(xxhash.xxh3_128_digest(data), np.int64))


def _mapped(df: DataFrame, work, ddl: str) -> DataFrame:
    """``df`` in Arrow batches through ``work``, which gives lists of rows of ``ddl``."""
    schema = StructType.fromDDL(ddl)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in work(batches):
            if rows:
                columns = zip(zip(*rows, strict=True), arrow, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in columns], schema=arrow)

    return df.mapInArrow(run, schema)


def statistics(docs: DataFrame) -> DataFrame:
    """Rows of (term, documents, occurrences) counted per task; a null term counts the documents with terms, and all terms."""

    def work(batches):
        seen: Counter[bytes] = Counter()
        documents = occurrences = 0
        for batch in batches:
            for text in batch.column(0):
                found = terms(text.as_py())
                occurrences += len(found)
                documents += bool(found)
                seen.update(set(found))
            if len(seen) > FLUSH:
                yield [(term, number, None) for term, number in seen.items()]
                seen.clear()
        yield [(None, documents, occurrences), *[(term, number, None) for term, number in seen.items()]]

    return _mapped(docs.select(docs["text"]), work, "term binary, documents bigint, occurrences bigint")


def sketches(docs: DataFrame, documents: int, total: int, common: dict[bytes, int]) -> DataFrame:
    """doc_id, t1 and t2 (digest of the text), n and sketch of every document with terms; ``common``: weights."""
    rare = weight(1, documents)

    def work(batches):
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = (text.as_py() or "").encode()
                counts = Counter(data.translate(_SPLIT).split())
                if counts:
                    n = counts.total()
                    m = length_factor(n, documents, total)
                    out.append((doc_id, *_digest(data), n, sketch(counts, m, common, rare)))
                if len(out) >= 1_000:  # sketches are larger than texts: few are held at a time
                    yield out
                    out = []
            yield out

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    return _mapped(rows, work, "doc_id bigint, t1 bigint, t2 bigint, n bigint, sketch binary")


class Block:
    """Terms and weights of some queries, and the means of the corpus they are asked of."""

    def __init__(self, rows: list[tuple[str, bytes, int]], documents: int, total: int):
        self.documents, self.total = documents, total
        self.queries = sorted({text for text, _, _ in rows})
        number = {text: q for q, text in enumerate(self.queries)}
        self.terms: list[dict[bytes, int]] = [{} for _ in self.queries]
        for text, term, frequency in rows:
            self.terms[number[text]][term] = weight(frequency, documents)
        held = [(q, term, w) for q, chosen in enumerate(self.terms) for term, w in sorted(chosen.items())]
        self.owner = np.array([q for q, _, _ in held], np.int64)
        self.weight = np.array([w for _, _, w in held], np.float64)
        self.hash = hashes([term for _, term, _ in held]).T.copy() if held else np.zeros((HASHES, 0), np.int64)
        known = {term: frequency / max(1, documents) for _, term, frequency in rows}
        chance = np.array([known[term] for _, term, _ in held])
        self.trust = chance / (chance + COLLISION)

    def sums(self, data: np.ndarray, first: np.ndarray, size: np.ndarray, n: np.ndarray, expected: bool) -> np.ndarray:
        """Upper bounds, or ``expected`` scores, of documents (rows) under the queries (columns).

        The documents' sketches lie in ``data`` from ``first`` on, ``size`` bytes each.
        """
        met = data[first[:, None] + (self.hash[0] * size[:, None] >> 32)]
        row, term = np.nonzero(met)
        value = met[row, term]
        for place in self.hash[1:]:
            value = np.minimum(value, data[first[row] + (place[term] * size[row] >> 32)])
            held = np.flatnonzero(value)
            row, term, value = row[held], term[held], value[held]
        most, weights = IMPACTS[value], self.weight[term]
        m = np.array([length_factor(x, self.documents, self.total) for x in n.tolist()], np.float64)[row]
        # share = weight * 10^9 * o / (1000 * o + 20 * m) solved for the occurrences o; where no o is too many, ``most`` stands.
        room = 1e9 * weights - 1e3 * most
        often = np.floor(20 * m * most / np.maximum(room, 1e-3) * (1 + 1e-9))
        fits = np.where(room > 0, np.minimum(shares(weights, often, m), most), most) * (1 + 1e-9)
        if expected:
            fits *= self.trust[term]
        cells = len(n) * len(self.queries)
        return np.bincount(row * len(self.queries) + self.owner[term], fits, cells).reshape(len(n), -1)

    def score(self, q: int, counts: dict[bytes, int], n: int) -> int:
        m = length_factor(n, self.documents, self.total)
        return sum(w * impact(counts[t], m) for t, w in self.terms[q].items() if t in counts)


def _summed(batch: pa.RecordBatch, block: Block, expected: bool) -> Iterator[tuple[int, np.ndarray]]:
    """Sums of the rows of a batch (doc_id, t1, t2, n, sketch), some at a time, each with the number of their first row."""
    n = batch.column(3).to_numpy()
    for at in range(0, len(n), step := max(1, LOOKUPS // max(1, len(block.weight)))):
        found = batch.column(4).slice(at, step).to_pylist()
        size = np.array([len(x) for x in found], np.int64)
        data = np.frombuffer(b"".join(found), np.uint8)
        yield at, block.sums(data, np.cumsum(size) - size, size, n[at : at + step], expected)


CANDIDATE = "q int, t1 bigint, t2 bigint, doc_id bigint, value double"


def _best(entries: DataFrame, block: Block, first: int) -> DataFrame:
    """The ``first`` distinct texts of highest expected score for every query."""

    def work(batches):
        held: list[dict] = [{} for _ in block.queries]
        least = np.zeros(len(held))
        for batch in batches:
            ids, t1, t2 = (batch.column(i).to_pylist() for i in range(3))
            for at, sums in _summed(batch, block, True):
                for row, q in np.argwhere(sums > least).tolist():
                    i, known = at + row, held[q]
                    known.setdefault((t1[i], t2[i]), (float(sums[row, q]), ids[i]))
                    if len(known) >= 4 * first:
                        held[q] = dict(nlargest(first, known.items(), key=lambda x: x[1][0]))
                        least[q] = min(held[q].values(), key=lambda x: x[0])[0]
        for q, known in enumerate(held):
            top = nlargest(first, known.items(), key=lambda x: x[1][0])
            yield [(q, *text, doc_id, value) for text, (value, doc_id) in top]

    found = _mapped(entries, work, CANDIDATE)
    texts = found.groupBy("q", "t1", "t2").agg(F.max("value").alias("value"), F.min("doc_id").alias("doc_id"))
    order = Window.partitionBy("q").orderBy(F.desc("value"), "t1", "t2")
    return texts.withColumn("_at", F.row_number().over(order)).filter(F.col("_at") <= first).drop("_at")


def _reaching(entries: DataFrame, block: Block, thresholds: np.ndarray) -> DataFrame:
    """All distinct texts whose bound reaches the query's threshold."""

    def work(batches):
        for batch in batches:
            ids, t1, t2 = (batch.column(i).to_pylist() for i in range(3))
            found = {}
            for at, bounds in _summed(batch, block, False):
                for row, q in np.argwhere(bounds >= thresholds).tolist():
                    i = at + row
                    found[q, t1[i], t2[i]] = ids[i], float(bounds[row, q])
            yield [(*key, *value) for key, value in found.items()]

    found = _mapped(entries, work, CANDIDATE)
    return found.groupBy("q", "t1", "t2").agg(F.max("value").alias("value"), F.min("doc_id").alias("doc_id"))


def _among(rows: DataFrame, few: DataFrame, **keys: str) -> DataFrame:
    """``rows`` whose ``keys`` are in the kept table ``few``, which is broadcast if it has ``SENT_ROWS`` rows at most."""
    small = few.select(*[F.col(b).alias(f"_{b}") for b in keys.values()]).distinct()
    same = None
    for a, b in keys.items():
        one = rows[a].eqNullSafe(small[f"_{b}"])
        same = one if same is None else same & one
    return rows.join(F.broadcast(small) if few.count() <= SENT_ROWS else small, same, "left_semi")


def _rescored(docs: DataFrame, candidates: DataFrame, block: Block) -> DataFrame:
    """q, t1, t2 and exact score of the candidates (a kept table), from the texts of one document each."""
    asked = candidates.groupBy(F.col("doc_id").alias("_id")).agg(F.collect_list(F.struct("q", "t1", "t2")).alias("asked"))
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    chosen = _among(texts, candidates, doc_id="doc_id")
    met = chosen.join(asked, chosen["doc_id"].eqNullSafe(asked["_id"])).select("text", "asked")

    def work(batches):
        for batch in batches:
            out = []
            for text, wanted in zip(*map(pa.Array.to_pylist, batch.columns), strict=True):
                data = (text or "").encode()
                own = _digest(data)
                chosen = [w["q"] for w in wanted if (w["t1"], w["t2"]) == own]
                if chosen:
                    counts = Counter(data.translate(_SPLIT).split())
                    n = counts.total()
                    out += [(q, *own, block.score(q, counts, n)) for q in chosen]
            yield out

    scored = _mapped(met, work, "q int, t1 bigint, t2 bigint, score bigint")
    return scored.filter("score > 0").groupBy("q", "t1", "t2").agg(F.max("score").alias("score"))


def _searched(docs: DataFrame, entries: DataFrame, block: Block, k: int) -> DataFrame:
    """q, rank, doc_id and score for the queries of a block."""
    columns = entries.select("doc_id", "t1", "t2", "n", "sketch")
    first = kept(_best(columns, block, FIRST * k), "first-candidates")
    known = kept(_rescored(docs, first, block), "first-scores")
    # One number a query comes to the driver: the k-th best of the exact scores so far, or 1 while there are fewer.
    order = Window.partitionBy("q").orderBy(F.desc("score"), "t1", "t2")
    kth = known.withColumn("_at", F.row_number().over(order)).filter(F.col("_at") == k)
    thresholds = np.ones(len(block.queries))
    for q, score in kth.select("q", "score").collect():
        thresholds[q] = score
    rest = _reaching(columns, block, thresholds).join(first.select("q", "t1", "t2"), ["q", "t1", "t2"], "left_anti")
    scores = known.unionByName(_rescored(docs, kept(rest, "candidates"), block))
    limits = docs.sparkSession.createDataFrame(list(enumerate(thresholds.tolist())), "_q int, _least double")
    scores = scores.join(limits, (F.col("q") == F.col("_q")) & (F.col("score") >= F.col("_least")))
    scores = kept(scores.select("q", "t1", "t2", "score"), "scores")

    # A text's place is set by its score and its least doc_id: k texts hold the best k documents.
    owners = columns.select("t1", "t2", "doc_id")
    least = F.min(F.struct(F.col("doc_id").isNotNull(), "doc_id")).alias("least")
    leasts = _among(owners, scores, t1="t1", t2="t2").groupBy("t1", "t2").agg(least)
    by_text = Window.partitionBy("q").orderBy(F.desc("score"), "least")
    reached = scores.join(leasts, ["t1", "t2"]).withColumn("_at", F.row_number().over(by_text))
    reached = kept(reached.filter(F.col("_at") <= k).select("q", "t1", "t2", "score"), "reached")
    by_id = Window.partitionBy("t1", "t2").orderBy(F.asc_nulls_first("doc_id"))
    copies = _among(owners, reached, t1="t1", t2="t2").withColumn("_at", F.row_number().over(by_id))
    ranking = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    ranked = reached.join(copies.filter(F.col("_at") <= k), ["t1", "t2"]).withColumn("rank", F.row_number().over(ranking))
    return ranked.filter(F.col("rank") <= k).select("q", "rank", "doc_id", "score")


def search(docs: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank, doc_id and score: the ``k`` best documents for every row of ``queries`` (item_id, text)."""
    spark = docs.sparkSession
    counted = kept(statistics(docs), "term-counts")
    # Two numbers come to the driver: documents with terms, and their terms.
    sums = counted.filter("term is null").agg(F.sum("documents"), F.sum("occurrences")).first()
    count, total = sums[0] or 0, sums[1] or 0
    frequencies = kept(
        counted.filter("term is not null").groupBy("term").agg(F.sum("documents").alias("documents")), "frequencies"
    )
    often = frequencies.orderBy(F.desc("documents"), "term").limit(COMMON).collect()
    common = {bytes(term): weight(number, count) for term, number in often}
    documents = kept(sketches(docs, count, total, common), "sketches")

    asked = queries.select(queries["item_id"].alias("item_id"), queries["text"].alias("text"))

    def work(batches):
        for batch in batches:
            yield [(text, term) for text in batch.column(0).to_pylist() for term in set(terms(text))]

    texts = asked.filter("text is not null").select("text").distinct()
    wanted = _mapped(texts, work, "text string, term binary")
    weighted = kept(wanted.join(frequencies, "term").select("text", "term", "documents"), "query-terms")
    held, asking = weighted.agg(F.count(F.lit(1)), F.countDistinct("text")).first()
    blocks = max(-(-held // BLOCK_TERMS), -(-asking // BLOCK_QUERIES))
    named = weighted.withColumn("block", F.pmod(F.xxhash64("text"), F.lit(max(blocks, 1))))
    out = None
    for number in range(blocks):
        rows = [tuple(r) for r in named.filter(F.col("block") == number).select("text", "term", "documents").collect()]
        if not rows:
            continue
        block = Block([(t, bytes(term), f) for t, term, f in rows], count, total)
        found = _searched(docs, documents, block, k)
        names = spark.createDataFrame(list(enumerate(block.queries)), "_q int, _text string")
        found = found.join(names, F.col("q") == F.col("_q")).select("_text", "rank", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return asked.join(out, F.col("text") == F.col("_text")).select("item_id", "rank", "doc_id", "score")
