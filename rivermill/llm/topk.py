"""Exact top-k search by inner product with M-trees, best first.

Components become floor(scale * x). Inner products order like distances once each vector x gets one more coordinate,
sqrt(M - |x|^2) with M the largest squared norm, and queries get 0 there: then d(q, x)^2 = |q|^2 + M - 2 <q, x>. In that
metric space the corpus is an M-tree whose nodes are rows of a table: the root's entries are cells around pivots with
covering radii, a cell's entries are pages of at most ``PAGE`` vectors, and a page keeps its covering radius, the distance
of its pivot to that of its cell, and each vector's distance to the page's pivot.

Queries are searched in blocks of neighbours, pages in the order of the least distance that they can hold for the
block. Where |d(q, cell) - d(cell, page)| less the page's radius exceeds a query's k-th best distance, the page is left out
for that query without computing a distance; then its own distance decides; then the stored distances of its vectors.
What is left is one matrix product. A query starts with a bound from the cells alone (each holds its number of vectors
within distance-to-pivot plus radius). Scores are exact: distances only decide what is looked at, with room for rounding,
and whole numbers are compared.

A block's pages are dealt over as many lanes as it takes to keep all cores busy, one lane where there are many blocks; a
task streams its pages, keeps the k best of each query of its block, and hands these on. So what is handed on grows
with the queries, and a task holds one block and one page.

Equal vectors are one entry with their k + 1 smallest ids, cut before the shuffle: more of them can never be among
the best k of a query. So a vector that a third of all rows share costs no more than others.

Defined cases: a null vector, or one with a null, NaN or infinite component, takes no part; shorter vectors count as
padded with zeros; ties go to the smaller id; a null id takes no part; repeated rows are candidates each; every row of
``queries`` gets a ranking of its own, which leaves out one row of its id and vector (itself) and no other row of its id;
with fewer than k candidates all are returned; an empty table gives no rows. Components are taken up to 2^31 in size,
where scores of up to 2^20 components stay exact; a larger one raises an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from rivermill.llm.common import cut

PAGE = 512
SHARD = 16_384  # vectors of a cell that one task cuts into pages
BLOCK = 8_192  # queries, at most about; fewer where vectors are long
HELD = 1 << 22  # components of a block's queries, at most about
PIVOTS = 256
CELL = 2_048  # vectors per pivot, until there are PIVOTS
LIMIT = 1 << 31
SLACK = 1e-6  # room for rounding, in norms
EXACT = 1 << 52  # squared norms below it, and products of such vectors, are exact in doubles
LONG = 1 << 62  # below it products fit in 64 bits
NONE = np.iinfo(np.int64).min


def whole(vector: Column, scale: int) -> Column:
    """floor(scale * x) per component as doubles; null for vectors that take no part."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    made = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    small = F.forall(made, lambda x: F.abs(x) <= LIMIT)
    return F.when(
        F.coalesce(usable, F.lit(False)), F.when(small, made).otherwise(F.raise_error(F.lit("component beyond 2^31")).cast("array<double>"))
    )


def _products(queries: np.ndarray, rows: np.ndarray, norm: float) -> np.ndarray:
    """Inner products as whole numbers; ``norm``: the largest sum of two squared norms."""
    if norm < EXACT:
        return (queries @ rows.T).astype(np.int64)
    kind = np.int64 if norm < LONG else object
    return np.asarray(queries.astype(np.int64).astype(kind) @ rows.astype(np.int64).astype(kind).T, dtype=np.int64)


def distances(points: np.ndarray, center: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - center) ** 2).sum(axis=1))


def pages(points: np.ndarray, size: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Members and their distances to the page's pivot, its first member, for every page of ``points``."""
    size = size or PAGE
    todo = [np.arange(len(points))]
    while todo:
        members = todo.pop()
        if len(members) > size:
            chosen = points[members[np.linspace(0, len(members) - 1, 2 * math.ceil(len(members) / size)).astype(int)]]
            chosen = chosen[:size]
            part = points[members]
            nearest = ((chosen**2).sum(axis=1) - 2 * part @ chosen.T).argmin(axis=1)
            groups = [members[nearest == c] for c in np.unique(nearest)]
            if len(groups) == 1:
                groups = np.array_split(members, math.ceil(len(members) / size))
            todo += groups
            continue
        away = distances(points[members], points[members[len(members) // 2]])
        order = np.argsort(away, kind="stable")
        yield members[order], distances(points[members[order]], points[members[order[0]]])


class Block:
    """The best k of a block of queries, while pages go by."""

    def __init__(self, rows: np.ndarray, names: np.ndarray, queries: np.ndarray, reach: np.ndarray, centers: np.ndarray,
                 most: float, k: int):
        width = centers.shape[1] - 1
        self.rows, self.names, self.k = rows, names, k
        self.inside = ~queries[:, width:].any(axis=1)  # a longer query equals no vector
        self.queries = queries[:, :width]
        norms = (self.queries**2).sum(axis=1)
        self.norm, self.highest = norms + most, float(norms.max(initial=0)) + most
        self.slack = SLACK * (1 + np.sqrt(self.norm))
        self.reach = reach + self.slack
        self.to_cell = self._away(centers[:, :-1])
        self.scores = np.full((len(rows), k), NONE)
        self.ids = np.zeros((len(rows), k), np.int64)
        self.computed = 0

    def _away(self, points: np.ndarray, which: slice | np.ndarray = slice(None)) -> np.ndarray:
        squares = self.norm[which][:, None] - 2 * self.queries[which] @ points.T
        return np.sqrt(np.maximum(0.0, squares))

    def look(self, cell: int, to_cell: float, away: np.ndarray, points: np.ndarray, ids: pa.ListArray) -> None:
        """Takes a page: its cell, the distance of its pivot to the cell's, and its entries, the pivot first."""
        radius = away[-1]
        asked = np.flatnonzero(np.abs(self.to_cell[:, cell] - to_cell) - radius <= self.reach + self.slack)
        if not len(asked):
            return
        to_pivot = self._away(points[:1], asked)[:, 0]
        near = to_pivot - radius <= self.reach[asked]
        asked, to_pivot = asked[near], to_pivot[near]
        if not len(asked):
            return
        first = np.searchsorted(away, (to_pivot - self.reach[asked]).min())
        last = np.searchsorted(away, (to_pivot + self.reach[asked]).max(), "right")
        if first >= last:
            return
        self.computed += len(asked) * (last - first)
        scores = _products(self.queries[asked], points[first:last], self.highest)
        least = self.scores[asked, -1]
        if last - first > self.k + 1:
            # One of the page's k + 1 best may be the query itself.
            least = np.maximum(least, np.partition(scores, -(self.k + 1), axis=1)[:, -(self.k + 1)])
        at, entry = np.nonzero(scores >= least[:, None])
        if len(at):
            self._merge(asked, at, entry + first, scores[at, entry], points, ids)

    def _merge(
        self, asked: np.ndarray, at: np.ndarray, entry: np.ndarray, score: np.ndarray, points: np.ndarray, ids: pa.ListArray
    ) -> None:
        offsets, flat = np.asarray(ids.offsets), np.asarray(ids.values)
        counts = offsets[entry + 1] - offsets[entry]
        one = np.repeat(np.arange(len(at)), counts)
        names = flat[offsets[entry][one] + np.arange(len(one)) - np.repeat(np.cumsum(counts) - counts, counts)]
        query, entry, score = asked[at][one], entry[one], score[one]
        # The query's own row: one of its id among those of its vector.
        own = np.flatnonzero((names == self.names[query]) & self.inside[query])
        own = own[(points[entry[own]] == self.queries[query[own]]).all(axis=1)]
        _, once = np.unique(one[own], return_index=True)
        kept = np.ones(len(names), bool)
        kept[own[once]] = False
        touched = np.unique(query[kept])
        held = self.scores[touched] != NONE
        query = np.concatenate([np.repeat(touched, held.sum(axis=1)), query[kept]])
        score = np.concatenate([self.scores[touched][held], score[kept]])
        names = np.concatenate([self.ids[touched][held], names[kept]])
        order = np.lexsort((names, -score, query))
        query, score, names = query[order], score[order], names[order]
        starts = np.flatnonzero(np.diff(query, prepend=-1))
        place = np.arange(len(query)) - np.repeat(starts, np.diff(starts, append=len(query)))
        best = place < self.k
        self.scores[query[best], place[best]], self.ids[query[best], place[best]] = score[best], names[best]
        full = touched[self.scores[touched, -1] != NONE]
        closer = np.sqrt(np.maximum(0.0, self.norm[full] - 2.0 * self.scores[full, -1])) + self.slack[full]
        self.reach[full] = np.minimum(self.reach[full], closer)

    def best(self) -> tuple[np.ndarray, ...]:
        """Row, id, found id and score of all that was found."""
        query, place = np.nonzero(self.scores != NONE)
        return self.rows[query], self.names[query], self.ids[query, place], self.scores[query, place]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of doubles as rows, padded with zeros."""
    out = np.zeros((len(column), width))
    lengths = np.diff(np.asarray(column.offsets))
    flat = np.asarray(column.flatten(), dtype=float)
    rows = np.repeat(np.arange(len(column)), lengths)
    places = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[rows, places] = flat
    return out


def _widest(column: pa.Array) -> int:
    return int(np.diff(np.asarray(column.offsets)).max(initial=0))


def _lifted(rows: np.ndarray, most: float) -> np.ndarray:
    """Rows with the coordinate that gives all of them the same squared norm ``most``."""
    rest = np.sqrt(np.maximum(0.0, most - (rows**2).sum(axis=1)))
    return np.hstack([rows, rest[:, None]])


def _trimmed(vector: str) -> Column:
    """Trailing zeros do not count, so that padded vectors equal shorter ones."""
    nonzero = F.array_position(F.transform(F.reverse(F.col(vector)), lambda x: x != 0), True)
    size = (F.size(vector) - nonzero + 1).cast("int")
    return F.when(nonzero > 0, F.slice(vector, 1, size)).otherwise(F.array().cast("array<double>"))


def _runs(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[pa.Table]:
    """Consecutive rows with equal values of ``names``, put together across batches."""
    waiting: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([np.asarray(batch[n]) for n in names])
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            key = keys[:, a].tolist()
            if waiting and key != last:
                yield pa.Table.from_batches(waiting)
                waiting = []
            waiting.append(batch.slice(a, b - a))
            last = key
    if waiting:
        yield pa.Table.from_batches(waiting)


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 20, scale: int = 64, shard: int = SHARD, pivots: int = PIVOTS
) -> DataFrame:
    """query_id, rank, vec_id and score: the best k of ``vectors`` for each row of ``queries`` but itself.

    Both have vec_id and embedding. Pivots are the vectors of smallest hash, ``pivots`` at most: they shape cells and never
    the result.
    """
    spark = vectors.sparkSession
    usable = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), whole(F.col("embedding"), scale).alias("v"))
    usable = usable.filter("v is not null and vec_id is not null").withColumn("v", _trimmed("v"))
    # k + 1 ids of each distinct vector: cut per task before the shuffle.
    by_id = Window.partitionBy("v").orderBy("vec_id")
    few = usable.withColumn("_n", F.row_number().over(by_id)).filter(F.col("_n") <= k + 1)
    entries = few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    entries = cut(entries.withColumn("norm", norm).withColumn("h", F.xxhash64("v")))
    stats = entries.agg(F.max("norm").alias("m"), F.max(F.size("v")).alias("w"), F.count(F.lit(1)).alias("n")).first()
    if not stats.n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    width, most = max(1, stats.w), stats.m
    sampled = entries.orderBy("h", "v").limit(max(1, min(pivots, stats.n // CELL))).select("v").toArrow().column(0)
    sent = spark.sparkContext.broadcast(_lifted(_matrix(sampled.combine_chunks(), width), most))

    cell_schema = StructType.fromDDL("v array<double>, ids array<bigint>, h bigint, cell int, away double")
    cell_arrow = to_arrow_schema(cell_schema)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _lifted(_matrix(batch.column(0), width), most)
            own = np.zeros(len(points), np.int64)
            away = np.full(len(points), np.inf)
            for cell, center in enumerate(sent.value):
                d = distances(points, center)
                nearer = d < away
                own[nearer], away[nearer] = cell, d[nearer]
            columns = [*batch.columns, pa.array(own.astype(np.int32)), pa.array(away)]
            yield pa.RecordBatch.from_arrays(columns, schema=cell_arrow)

    placed = cut(entries.select("v", "ids", "h").mapInArrow(assign, cell_schema))
    # One row per cell, so at most ``pivots`` rows come to the driver.
    cells = placed.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.size("ids")).alias("ids"), F.max("away").alias("radius")
    ).collect()
    order = np.array(sorted(r.cell for r in cells))
    table = {r.cell: r for r in cells}
    held = np.array([min(table[c].ids, k + 1) for c in order])
    radii = np.array([table[c].radius for c in order])

    asked = queries.select(F.col("vec_id").cast("long").alias("query_id"), whole(F.col("embedding"), scale).alias("q"))
    asked = asked.filter("q is not null and query_id is not null").withColumn("q", _trimmed("q"))
    # Rows are numbered once: the table in the shared folder keeps the numbers.
    asked = asked.withColumn("row", F.monotonically_increasing_id())
    route_schema = StructType.fromDDL("row bigint, query_id bigint, q array<double>, home int, away double, reach double")
    route_arrow = to_arrow_schema(route_schema)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds the nearest cell, its distance, and a bound of the k-th best distance."""
        centers = sent.value[order]
        for batch in batches:
            points = _matrix(batch.column(2), max(width, _widest(batch.column(2))))[:, :width]
            norms = (points**2).sum(axis=1) + most
            d = np.sqrt(np.maximum(0.0, norms[:, None] - 2 * points @ centers[:, :-1].T))
            far = d + radii
            by_far = np.argsort(far, axis=1, kind="stable")
            # The cells nearest in this sense hold k + 1 vectors, so one may be the query itself.
            enough = (np.cumsum(held[by_far], axis=1) <= k).sum(axis=1)
            sorted_far = np.hstack([np.take_along_axis(far, by_far, axis=1), np.full((len(d), 1), np.inf)])
            home = d.argmin(axis=1)
            at = np.arange(len(d))
            made = [order[home].astype(np.int32), d[at, home], sorted_far[at, enough]]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, made)], schema=route_arrow)

    routed = cut(asked.select("row", "query_id", "q").mapInArrow(route, route_schema))
    homes = routed.groupBy("home").agg(
        F.count(F.lit(1)).alias("n"), F.max("away").alias("away"), F.max("reach").alias("reach"), F.max(F.size("q")).alias("w")
    ).orderBy("home").collect()
    if not homes:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    # Cells with few queries share a block, those with many have several.
    most_queries = max(1, min(BLOCK, HELD // max(width, *(r.w for r in homes))))
    blocks, room, spans = 0, 0, {}
    for home in homes:
        if home.n > room:
            parts = math.ceil(home.n / most_queries)
            spans[home.home] = (blocks, parts)
            blocks, room = blocks + parts, most_queries - home.n if parts == 1 else 0
        else:
            spans[home.home] = (blocks - 1, 1)
            room -= home.n
    lanes = math.ceil(2 * spark.sparkContext.defaultParallelism / blocks)

    page_schema = StructType.fromDDL(
        "v array<double>, ids array<bigint>, cell int, page bigint, away double, to_cell double, "
        "wanted array<struct<block: int, low: double>>"
    )
    page_arrow = to_arrow_schema(page_schema)

    def build(shard: pa.Table) -> pa.Table:
        """The pages of a shard, each row with the blocks that may need it and the least distance it can hold there."""
        cell, part = shard["cell"][0].as_py(), shard["part"][0].as_py()
        points = _lifted(_matrix(shard["v"].combine_chunks(), width), most)
        taken, made, wanted = [], [], []
        for number, (members, away) in enumerate(pages(points)):
            pivot, radius = points[members[0]], away[-1]
            lows: dict[int, float] = {}
            for home, (first, parts) in spans.items():
                low = float(distances(sent.value[home : home + 1], pivot)[0]) - radius
                limit = asked_reach[home]
                if low <= limit + 4 * SLACK * (1 + limit + math.sqrt(most)):
                    for block in range(first, first + parts):
                        lows[block] = min(low, lows.get(block, math.inf))
            if not lows:
                continue
            to_cell = float(distances(pivot[None], sent.value[cell])[0])
            taken.append(members)
            made += [(part * (1 << 20) + number, a, to_cell) for a in away.tolist()]
            wanted += [[{"block": b, "low": low} for b, low in lows.items()]] * len(members)
        at = np.concatenate(taken) if taken else np.zeros(0, np.int64)
        columns = [shard[c].combine_chunks().take(pa.array(at)) for c in ("v", "ids", "cell")]
        columns += [pa.array([m[j] for m in made], page_arrow.field(3 + j).type) for j in range(3)]
        return pa.Table.from_arrays([*columns, pa.array(wanted, page_arrow.field(6).type)], schema=page_arrow)

    # A query lies beside its home's pivot in the lifted space by at most ``away``, and looks as far as ``reach``.
    asked_reach = {r.home: r.away + r.reach for r in homes}
    pieces = F.create_map(*[F.lit(x) for r in cells for x in (r.cell, math.ceil(r.n / shard))])
    sharded = placed.withColumn("part", F.pmod("h", F.element_at(pieces, F.col("cell"))).cast("int"))
    paged = sharded.select("v", "ids", "cell", "part").groupBy("cell", "part").applyInArrow(build, page_schema)
    paged = paged.select("*", F.inline("wanted")).drop("wanted")
    lane = F.pmod(F.xxhash64("cell", "page"), F.lit(lanes)).cast("int")
    paged = paged.select(
        (F.col("block") * lanes + lane).alias("slot"), F.lit(1).alias("kind"), "low", "cell", "page", "away", "to_cell", "v", "ids"
    )
    firsts = F.create_map(*[F.lit(x) for h, (first, _) in spans.items() for x in (h, first)])
    counts = F.create_map(*[F.lit(x) for h, (_, parts) in spans.items() for x in (h, parts)])
    block = F.element_at(firsts, F.col("home")) + F.pmod(F.xxhash64("row"), F.element_at(counts, F.col("home"))).cast("int")
    dealt = routed.select(
        F.explode(F.sequence(block * lanes, block * lanes + (lanes - 1))).alias("slot"), F.lit(0).alias("kind"),
        F.lit(0.0).alias("low"), F.lit(0).alias("cell"), F.lit(0).cast("long").alias("page"), F.col("reach").alias("away"),
        F.lit(0.0).alias("to_cell"), F.col("q").alias("v"), F.array("row", "query_id").alias("ids"),
    )
    found_schema = StructType.fromDDL("row bigint, query_id bigint, vec_id bigint, score bigint")
    found_arrow = to_arrow_schema(found_schema)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in block.best()], schema=found_arrow)

        slot, block = None, None
        for run in _runs(batches, ("slot", "kind", "cell", "page")):
            run = run.combine_chunks()
            values, names = (run[c].chunk(0) for c in ("v", "ids"))
            away = np.asarray(run["away"].chunk(0))
            if run["kind"][0].as_py() == 0:
                if block is not None:
                    yield done()
                slot = run["slot"][0].as_py()
                both = np.asarray(names.flatten()).reshape(-1, 2)
                held = _matrix(values, max(width, _widest(values)))
                block = Block(both[:, 0], both[:, 1], held, away, sent.value, most, k)
            elif run["slot"][0].as_py() == slot:  # else no query of its block came
                block.look(run["cell"][0].as_py(), run["to_cell"][0].as_py(), away, _matrix(values, width), names)
        if block is not None:
            yield done()

    # All queries of a slot come first, then its pages, those that can hold the nearest vectors first.
    slots = dealt.unionByName(paged).repartition(blocks * lanes, "slot")
    slots = slots.sortWithinPartitions("slot", "kind", "low", "cell", "page", "away")
    found = slots.mapInArrow(look, found_schema)
    best = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
