"""Gradient-boosted trees for two classes, on bins of features.

``fit`` takes rows in memory, ``fit_table`` a DataFrame of any size: tasks sum gradients by node, feature and bin, Spark adds up
those sums, and the driver chooses cuts from them, so it holds one histogram whatever the number of rows. Gradients are whole
numbers of 1 / ``UNIT``, so that sums depend on no order: the same rows give the same trees, however they are dealt.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivermill.llm.common import cut as cut_lineage
from rivermill.llm.common import kept

BINS = 32
UNIT = 1 << 24
TASK_ROWS = 200_000  # rows of one task, where there are that many

Histogram = Callable[[np.ndarray, np.ndarray, int], tuple[np.ndarray, np.ndarray]]


@dataclass
class Tree:
    """A full binary tree: node i has children 2i + 1 and 2i + 2; a value above ``cut`` goes to the second."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        at = np.zeros(len(rows), int)
        for _ in range(int(np.log2(len(self.leaf)))):
            at = 2 * at + 1 + (rows[np.arange(len(rows)), self.feature[at]] > self.cut[at])
        return self.leaf[at - len(self.feature)]


@dataclass
class Boosted:
    """Sum of trees on the log-odds scale."""

    start: float = 0.0
    trees: list[Tree] = field(default_factory=list)

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.start)
        for tree in self.trees:
            total += tree(rows)
        return 1 / (1 + np.exp(-np.clip(total, -50, 50)))


def _node(binned: np.ndarray, feature: np.ndarray, bins: np.ndarray, levels: int) -> np.ndarray:
    """The node of each row after ``levels`` cuts."""
    at = np.zeros(len(binned), int)
    for _ in range(levels):
        at = 2 * at + 1 + (binned[np.arange(len(binned)), feature[at]] > bins[at])
    return at


def _sums(binned: np.ndarray, local: np.ndarray, nodes: int, score: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Whole gradients and curvatures by (kind of sum, node, feature, bin)."""
    p = 1 / (1 + np.exp(-score))
    weights = np.rint((p - labels) * UNIT), np.rint(np.maximum(p * (1 - p), 1e-6) * UNIT)
    width = binned.shape[1]
    out = np.empty((2, nodes, width, BINS), np.int64)
    for f in range(width):
        key = local * BINS + binned[:, f]
        for kind, weight in enumerate(weights):
            out[kind, :, f] = np.bincount(key, weight, nodes * BINS).reshape(nodes, BINS)
    return out


def _grow(histogram: Histogram, edges: list[np.ndarray], depth: int, ridge: float) -> tuple[Tree, np.ndarray]:
    """A tree, and its cuts as bins. ``histogram(feature, bins, level)`` gives the sums at the nodes of a level."""
    inner = 2**depth - 1
    feature, cut, bins = np.zeros(inner, int), np.full(inner, np.inf), np.full(inner, BINS)
    for level in range(depth):
        first, nodes = 2**level - 1, 2**level
        gs, hs = (part.cumsum(axis=2) / UNIT for part in histogram(feature, bins, level))
        gt, ht = gs[:, 0, -1:], hs[:, 0, -1:]
        best, left = np.zeros(nodes), np.stack([gt[:, 0], ht[:, 0]])
        for f in range(len(edges)):
            if not len(edges[f]):
                continue
            g, h = gs[:, f], hs[:, f]
            gain = g**2 / (h + ridge) + (gt - g) ** 2 / (ht - h + ridge) - gt**2 / (ht + ridge)
            gain = gain[:, : len(edges[f])]
            place = gain.argmax(axis=1)
            top = gain[np.arange(nodes), place]
            for node in np.flatnonzero(top > best + 1e-9):
                best[node], left[:, node] = top[node], (g[node, place[node]], h[node, place[node]])
                feature[first + node], cut[first + node], bins[first + node] = f, edges[f][place[node]], place[node]
    # The leaves' sums are those on either side of the last cuts.
    leaf = np.stack([left, np.stack([gt[:, 0], ht[:, 0]]) - left], axis=2).reshape(2, -1)
    return Tree(feature, cut, -0.3 * leaf[0] / (leaf[1] + ridge)), bins


def _places(values: int) -> np.ndarray:
    """Which of so many distinct values in order are edges of bins."""
    return np.unique(np.linspace(0, values - 1, BINS).astype(int))[:-1]


def _binned(rows: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, c) for e, c in zip(edges, rows.T, strict=True)], axis=1)


def _start(share: float) -> Boosted:
    share = min(max(share, 1e-3), 1 - 1e-3)
    return Boosted(float(np.log(share / (1 - share))))


def fit(rows: np.ndarray, labels: np.ndarray, rounds: int = 40, depth: int = 3, ridge: float = 1.0) -> Boosted:
    """Fits labels 0 and 1 by logistic loss; the same rows give the same trees."""
    edges = [values[_places(len(values))] for values in map(np.unique, rows.T)]
    binned, model = _binned(rows, edges), _start(labels.mean())
    score = np.full(len(rows), model.start)

    def histogram(feature: np.ndarray, bins: np.ndarray, level: int) -> np.ndarray:
        return _sums(binned, _node(binned, feature, bins, level) - (2**level - 1), 2**level, score, labels)

    for _ in range(rounds):
        tree, _ = _grow(histogram, edges, depth, ridge)
        model.trees.append(tree)
        score += tree(rows)
    return model


def matrix(column: pa.Array, width: int, kind: str = "<f8") -> np.ndarray:
    """Rows of numbers written as bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


def _table_edges(rows: DataFrame, width: int) -> list[np.ndarray]:
    """The edges that ``fit`` takes: values at even places among the distinct ones, at most ``BINS`` a feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(c) for c in matrix(batch.column(0), width).T]
            places = np.repeat(np.arange(width, dtype=np.int32), list(map(len, found)))
            yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(np.concatenate(found))], names=["place", "value"])

    distinct = cut_lineage(rows.select("features").mapInArrow(run, "place int, value double").distinct())
    sizes = dict(map(tuple, distinct.groupBy("place").count().collect()))
    wanted = [(place, int(nth)) for place, size in sizes.items() for nth in _places(size)]
    chosen = rows.sparkSession.createDataFrame(wanted, "place int, nth int")
    ordered = distinct.withColumn("nth", F.row_number().over(Window.partitionBy("place").orderBy("value")) - 1)
    edges: list[list[float]] = [[] for _ in range(width)]
    for place, value in sorted(map(tuple, ordered.join(F.broadcast(chosen), ["place", "nth"]).select("place", "value").collect())):
        edges[place].append(value)
    return [np.array(e, float) for e in edges]


def fit_table(rows: DataFrame, width: int, rounds: int = 40, depth: int = 3, ridge: float = 1.0) -> Boosted:
    """The trees that ``fit`` gives for all rows (``features``: ``width`` doubles as bytes, ``label``: 0 or 1)."""
    count, share = rows.agg(F.count("label"), F.avg("label")).first()
    edges = _table_edges(rows, width)

    def to_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = _binned(matrix(batch.column(0), width), edges).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([b.tobytes() for b in bins], pa.binary()), batch.column(1)], names=["bins", "label"])

    made = rows.select("features", F.col("label").cast("int")).mapInArrow(to_bins, "bins binary, label int")
    table = kept(made.coalesce(-(-count // TASK_ROWS)), "bins")
    model, grown = _start(share), []

    def histogram(feature: np.ndarray, bins: np.ndarray, level: int) -> np.ndarray:
        start, trees, nodes = model.start, list(grown), 2**level
        shape = (2, nodes, width, BINS)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape, np.int64)
            for batch in batches:
                binned = matrix(batch.column(0), width, "u1")
                score = np.full(len(binned), start)
                for tree, cuts in trees:
                    score += tree.leaf[_node(binned, tree.feature, cuts, depth) - len(cuts)]
                local = _node(binned, feature, bins, level) - (nodes - 1)
                total += _sums(binned, local, nodes, score, batch.column(1).to_numpy())
            places = np.flatnonzero(total)
            columns = [pa.array(places.astype(np.int32)), pa.array(total.ravel()[places])]
            yield pa.RecordBatch.from_arrays(columns, names=["place", "total"])

        summed = table.mapInArrow(run, "place int, total bigint").groupBy("place").agg(F.sum("total").alias("total"))
        out, found = np.zeros(int(np.prod(shape)), np.int64), summed.toArrow()
        out[found["place"].to_numpy()] = found["total"].to_numpy()
        return out.reshape(shape)

    for _ in range(rounds):
        tree, cuts = _grow(histogram, edges, depth, ridge)
        model.trees.append(tree)
        grown.append((tree, cuts))
    return model
