"""Random forests of regression trees over binned features.

Every feature is cut at up to 31 places, as Spark ML does: between all its values if they are few, else between quantiles, here of summaries of all rows.
Rows are stored as blocks of bytes (``boosting.bin_rows``). Each tree counts a row as often as a Poisson draw of mean 1 says, which follows from the row's
stored hash and the tree's number, so that a task that is computed again draws the same. A cell of sums, weighted labels and weights, belongs to a
(tree, node, feature, bin); the split of a node is the one that lowers the squared error most, then the first feature and the lowest cut.

Tables of at most ``ALONE`` bytes of bins go to every executor, and a task grows whole trees. Others are read level by level: each task sums its rows for as many
nodes as ``SUMS`` bytes hold, one shuffle by (tree, node) adds the sums up, and one row per node reaches the driver.
What is shuffled depends on trees, nodes, features, bins and tasks, of which there are no more than cores, not on rows.

Missing labels are an error, as in Spark ML; missing features count as 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from valora import config
from valora.plans.boosting import bin_rows, descend, mixed
from valora.session import materialize, scratch_tables

BINS = 32
ALONE, SUMS = 32 << 20, 128 << 20
ROWS = 50_000  # of the blocks that are worked on together
POINTS = 512  # of a task's summary of a feature
LEAST_GAIN = 1e-9  # of the variance of the labels
#: The Poisson draw of mean 1 for each value of 16 bits.
DRAWS = np.searchsorted(np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)]), (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)


def weights(hashes: np.ndarray, tree: int) -> np.ndarray:
    """How often each row counts in a tree: four trees share 64 mixed bits."""
    return DRAWS[mixed(hashes, tree // 4).view(np.uint16)[tree % 4::4]]


def summary(values: np.ndarray, counts: np.ndarray, points: int = POINTS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and their counts; of more than ``points``, as many quantiles of equal weight."""
    distinct, at = np.unique(values, return_inverse=True)
    counts = np.bincount(at, counts, len(distinct))
    if len(distinct) <= points:
        return distinct, counts
    total = counts.sum()
    picked = np.searchsorted(counts.cumsum(), (np.arange(points) + 0.5) / points * total)
    distinct, again = np.unique(distinct[picked], return_counts=True)
    return distinct, again * (total / points)


def cuts(values: np.ndarray, counts: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Cuts halfway between neighbours: all of them if the values are few, else those nearest to equal shares of what is left."""
    middle = values[:-1] / 2 + values[1:] / 2
    if len(values) <= bins:
        return middle
    share, found = counts.sum() / bins, []
    target, sums = share, counts.cumsum().tolist()
    for i in range(1, len(sums)):
        if abs(sums[i - 1] - target) < abs(sums[i] - target):
            found.append(i - 1)
            target += share
    return middle[found]


def feature_cuts(df: DataFrame, x: Column, width: int) -> list[np.ndarray]:
    """Cuts per feature, from the summaries that each task makes of all its rows."""
    def summarised(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [(np.zeros(0), np.zeros(0))] * width
        waiting: list[np.ndarray] = []

        def merge() -> None:
            x = np.concatenate(waiting)
            if not np.isfinite(x).all():
                raise ValueError("features must be finite")
            for i, (values, counts) in enumerate(known):
                new = summary(x[:, i], np.ones(len(x)), 4 * POINTS)
                known[i] = summary(np.concatenate([values, new[0]]), np.concatenate([counts, new[1]]), 4 * POINTS)
            waiting.clear()

        for batch in batches:
            if batch.num_rows:
                waiting.append(batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width))
            if sum(map(len, waiting)) >= 4 * ROWS:
                merge()
        if waiting:
            merge()
        for i, (values, counts) in enumerate(known):
            values, counts = summary(values, counts)
            yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([values.tobytes()], pa.binary()), pa.array([counts.tobytes()], pa.binary())], ["feature", "x", "n"])

    parts: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(width)]
    for row in df.select(x.alias("x")).mapInArrow(summarised, "feature BIGINT, x BINARY, n BINARY").collect():
        parts[row.feature].append((np.frombuffer(row.x), np.frombuffer(row.n)))
    return [cuts(*summary(*map(np.concatenate, zip(*p)), points=1 << 20)) for p in parts]


def level_sums(bins: np.ndarray, y: np.ndarray, count: np.ndarray, place: np.ndarray, nodes: int) -> np.ndarray:
    """(feature, 2, node and bin): sums of weighted labels and of weights; ``bins`` has a row per feature, ``place`` is the node of each row."""
    out, start, weighted = np.empty((len(bins), 2, nodes * BINS)), place * BINS, count * y
    for f in range(len(bins)):
        cell = start + bins[f]
        out[f, 0] = np.bincount(cell, weighted, nodes * BINS)
        out[f, 1] = np.bincount(cell, count, nodes * BINS)
    return out


def best_splits(cells: np.ndarray, least: float) -> list[tuple]:
    """(gain, feature, bin, low sum, low weight, sum, weight) of each node of ``cells`` (node, feature, 2, bin); no gain where nothing can be split."""
    s, n = cells[:, :, 0].cumsum(-1), cells[:, :, 1].cumsum(-1)
    all_s, all_n = s[:, :1, -1:], n[:, :1, -1:]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = s * s / n + (all_s - s) ** 2 / (all_n - n) - all_s * all_s / all_n
    gain = np.where((n >= least) & (all_n - n >= least), gain, -math.inf).reshape(len(cells), -1)
    best, rows = gain.argmax(1), np.arange(len(cells))
    found = gain[rows, best], best // BINS, best % BINS, s.reshape(gain.shape)[rows, best], n.reshape(gain.shape)[rows, best], all_s.ravel(), all_n.ravel()
    return list(zip(*(a.tolist() for a in found)))


class Growing:
    """One tree while it grows: node ``i`` has children ``2 i + 1`` and ``2 i + 2``; a node without a split has feature 0 and sends all rows left."""

    def __init__(self, depth: int, least: float, least_gain: float):
        inner = 2 ** depth - 1
        self.depth, self.least, self.least_gain = depth, least, least_gain
        self.feature, self.bin = np.zeros(inner, np.int16), np.full(inner, BINS, np.uint8)
        self.value, self.cover = np.zeros(2 * inner + 1), np.zeros(2 * inner + 1)
        self.open = [0] if depth else []  # numbers, within their level, of the nodes to be split next

    def places(self, level: int) -> np.ndarray:
        """The position of each node of a level among the open ones, or -1."""
        at = np.full(2 ** level, -1)
        at[self.open] = np.arange(len(self.open))
        return at

    def take(self, level: int, splits: Sequence[tuple]) -> None:
        """The best splits of the open nodes, in their order; opens the nodes below."""
        opened = []
        for at, (gain, feature, edge, low_s, low_n, all_s, all_n) in zip(self.open, splits):
            node = 2 ** level - 1 + at
            if not level:
                self.value[0], self.cover[0] = all_s / all_n if all_n else 0.0, all_n
            if not gain > self.least_gain * all_n:
                continue
            self.feature[node], self.bin[node] = feature, edge
            for side, s, n in ((0, low_s, low_n), (1, all_s - low_s, all_n - low_n)):
                self.value[2 * node + 1 + side], self.cover[2 * node + 1 + side] = s / n, n
                if n >= 2 * self.least and level + 1 < self.depth:
                    opened.append(2 * at + side)
        self.open = opened


@dataclass(frozen=True)
class Forest:
    """A fitted model; ``transform`` adds ``prediction`` to rows with a vector column ``features``. Arrays have a row per tree and a column per node."""
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    features: str = "features"

    def transform(self, df: DataFrame) -> DataFrame:
        feature, cut, leaf = self.feature, self.cut, self.value.copy()
        inner, depth = cut.shape[1], (cut.shape[1] + 1).bit_length() - 1
        for node in range(inner):  # rows of a node without a split go left
            leaf[:, 2 * node + 1] = np.where(np.isinf(cut[:, node]), leaf[:, node], leaf[:, 2 * node + 1])
        leaf = leaf[:, inner:]

        @F.pandas_udf("double")
        def predicted(values: pd.Series) -> pd.Series:
            out = np.zeros(len(values))
            if len(values):
                x = np.stack(values.to_numpy())
                for f, c, v in zip(feature, cut, leaf):
                    out += v[descend(f, c, x, depth)]
            return pd.Series(out / len(leaf))

        return df.withColumn("prediction", predicted(vector_to_array(self.features)))

    def nodes(self) -> list[pd.DataFrame]:
        """Node table of every tree, indexed by node id."""
        tables = []
        for feature, cut, value, cover in zip(self.feature, self.cut, self.value, self.cover):
            ids, at = [0], 0
            while at < len(ids):
                node = ids[at]
                at += 1
                if node < len(cut) and np.isfinite(cut[node]):
                    ids += [2 * node + 1, 2 * node + 2]
            rows = [(i, value[i], cover[i], *((2 * i + 1, 2 * i + 2, int(feature[i]), cut[i]) if 2 * i + 1 in ids else (-1, -1, -1, 0.0))) for i in sorted(ids)]
            tables.append(pd.DataFrame(rows, columns=["id", "prediction", "cover", "leftChild", "rightChild", "feature", "threshold"]).set_index("id"))
        return tables


@dataclass(frozen=True)
class RandomForest:
    """Bagged trees of least squared error on all features; parameters are named as in Spark ML."""
    label: str
    features: str = "features"
    numTrees: int = config.FOREST_PARAMS["numTrees"]
    maxDepth: int = config.FOREST_PARAMS["maxDepth"]
    minInstancesPerNode: int = config.FOREST_PARAMS["minInstancesPerNode"]
    bootstrap: bool = True
    seed: int = config.SEED

    def fit(self, df: DataFrame) -> Forest:
        x, y = vector_to_array(self.features), F.col(self.label).cast("double")
        n, missing, base, spread, width = df.agg(F.count("*"), F.count_if(y.isNull() | F.isnan(y)), F.avg(y), F.var_pop(y), F.max(F.size(x))).first()
        if not n or missing or not width or width < 1:
            raise ValueError(f"a forest needs rows with features and labels, got {n} rows, {missing} of them without a label")
        edges = feature_cuts(df, x, width)
        with scratch_tables(df.sparkSession):
            # Numbers of rows, not their content, are hashed: equal rows are drawn each by itself. Stored, they stay as they are.
            stored = materialize(bin_rows(df.select(self.label, self.features, F.monotonically_increasing_id().alias("__row"), F.lit(self.seed).alias("__seed")),
                                          x, self.label, ["__row", "__seed"], edges, 0.0), "forest")
            trees = (self._grown_alone if n * width <= ALONE else self._grown)(stored, width, float(base), LEAST_GAIN * spread)
        cut = np.full((len(trees), 2 ** self.maxDepth - 1), math.inf)
        for c, t in zip(cut, trees):
            for i in np.flatnonzero(t.bin < BINS):
                c[i] = edges[t.feature[i]][t.bin[i]]
        return Forest(np.stack([t.feature for t in trees]), cut, np.stack([t.value for t in trees]) + base, np.stack([t.cover for t in trees]), self.features)

    def _weights(self, hashes: np.ndarray, tree: int) -> np.ndarray:
        return weights(hashes, tree) if self.bootstrap else np.ones(len(hashes), np.uint8)

    def _grown_alone(self, stored: DataFrame, width: int, base: float, least_gain: float) -> list[Growing]:
        """Whole trees per task, each task with all rows."""
        spark, names = stored.sparkSession, ["feature", "bin", "value", "cover"]
        found = stored.select("y", "hash", "bins").collect()
        rows = spark.sparkContext.broadcast((
            np.concatenate([np.frombuffer(r.y) for r in found]) - base, np.concatenate([np.frombuffer(r.hash, np.int64) for r in found]),
            np.concatenate([np.frombuffer(r.bins, np.uint8).reshape(width, -1) for r in found], axis=1)))

        def grown(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            y, hashes, bins = rows.value
            for turn in (int(i) for batch in batches for i in batch.column(0).to_numpy()):
                tree, count = Growing(self.maxDepth, self.minInstancesPerNode, least_gain), self._weights(hashes, turn)
                kept = np.flatnonzero(count)
                inside, labels, count = bins[:, kept], y[kept], count[kept].astype(float)
                node = np.zeros(len(kept), np.int64)
                for level in range(self.maxDepth):
                    if not tree.open:
                        break
                    place = tree.places(level)[node]
                    if (place < 0).any():  # rows of closed nodes are not needed any more
                        kept = np.flatnonzero(place >= 0)
                        inside, labels, count, node, place = inside[:, kept], labels[kept], count[kept], node[kept], place[kept]
                    sums = level_sums(inside, labels, count, place, len(tree.open))
                    tree.take(level, best_splits(sums.reshape(width, 2, -1, BINS).transpose(2, 0, 1, 3), self.minInstancesPerNode))
                    at = 2 ** level - 1 + node
                    node = 2 * node + (inside[tree.feature[at], np.arange(len(at))] > tree.bin[at])
                yield pa.RecordBatch.from_arrays([pa.array([turn]), *(pa.array([getattr(tree, a).tobytes()], pa.binary()) for a in names)], ["tree", *names])

        tasks = min(self.numTrees, 4 * spark.sparkContext.defaultParallelism)
        out = spark.range(0, self.numTrees, 1, tasks).mapInArrow(grown, "tree BIGINT, feature BINARY, bin BINARY, value BINARY, cover BINARY").collect()
        rows.unpersist()
        trees = []
        for row in sorted(out, key=lambda r: r.tree):
            tree = Growing(self.maxDepth, self.minInstancesPerNode, least_gain)
            for a in names:
                setattr(tree, a, np.frombuffer(getattr(row, a), getattr(tree, a).dtype))
            trees.append(tree)
        return trees

    def _grown(self, stored: DataFrame, width: int, base: float, least_gain: float) -> list[Growing]:
        """All trees level by level."""
        trees = [Growing(self.maxDepth, self.minInstancesPerNode, least_gain) for _ in range(self.numTrees)]
        few = stored.coalesce(stored.sparkSession.sparkContext.defaultParallelism)
        most = max(1, SUMS // (width * 2 * BINS * 8))
        for level in range(self.maxDepth):
            asked: list[list[int]] = []  # groups of trees whose open nodes fit; a single tree always is a group
            room = 0
            for i, tree in enumerate(trees):
                if tree.open:
                    if not asked or len(tree.open) > room:
                        asked.append([])
                        room = most
                    asked[-1].append(i)
                    room -= len(tree.open)
            for group in asked:
                found: dict[int, dict[int, tuple]] = {}
                for row in self._level(few, width, base, {i: (trees[i].feature, trees[i].bin, trees[i].places(level), len(trees[i].open)) for i in group}, level).collect():
                    found.setdefault(row[0], {})[row[1]] = tuple(row[2:])
                for i in group:
                    nothing = (-math.inf, 0, 0, 0.0, 0.0, 0.0, 0.0)
                    trees[i].take(level, [found.get(i, {}).get(at, nothing) for at in range(len(trees[i].open))])
        return trees

    def _level(self, stored: DataFrame, width: int, base: float, grown: dict[int, tuple], level: int) -> DataFrame:
        """``tree, node, gain, ...``: the best split of each open node of the trees."""
        least = self.minInstancesPerNode

        def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cells = {i: np.zeros((width, 2, nodes * BINS)) for i, (_, _, _, nodes) in grown.items()}
            for y, hashes, bins in _gathered(batches, width):
                y = y - base
                for i, (feature, limit, places, nodes) in grown.items():
                    count = self._weights(hashes, i)
                    kept = np.flatnonzero(count)
                    inside = bins[:, kept]
                    place = places[descend(feature, limit, inside.T, level)]
                    if (place < 0).any():
                        there = np.flatnonzero(place >= 0)
                        kept, inside, place = kept[there], inside[:, there], place[there]
                    cells[i] += level_sums(inside, y[kept], count[kept].astype(float), place, nodes)
            for i, (_, _, _, nodes) in grown.items():
                by_node = np.ascontiguousarray(cells.pop(i).reshape(width, 2, nodes, BINS).transpose(2, 0, 1, 3))
                yield pa.RecordBatch.from_arrays([pa.array([i] * nodes), pa.array(range(nodes)), pa.array([c.tobytes() for c in by_node], pa.binary())],
                                                 ["tree", "node", "cells"])

        def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[tuple[int, int], np.ndarray] = {}
            for batch in batches:
                for tree, node, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                    part = np.frombuffer(cells.as_buffer()).reshape(width, 2, BINS)
                    if (tree, node) in total:
                        total[tree, node] += part
                    else:
                        total[tree, node] = part.copy()
            for (tree, node), cells in total.items():
                (split,) = best_splits(cells[None], least)
                yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (tree, node, *split)], SPLIT_FIELDS)

        parts = stored.select("y", "hash", "bins").mapInArrow(sums, "tree BIGINT, node BIGINT, cells BINARY")
        return parts.repartition("tree", "node").mapInArrow(search, ", ".join(f"{c} {'BIGINT' if c in ('tree', 'node', 'feature', 'bin') else 'DOUBLE'}" for c in SPLIT_FIELDS))


SPLIT_FIELDS = ["tree", "node", "gain", "feature", "bin", "low_s", "low_n", "all_s", "all_n"]


def _gathered(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(y, hashes, bins by feature) of stored blocks, some ``ROWS`` rows at a time."""
    waiting: list[tuple[np.ndarray, ...]] = []

    def joined() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        y, hashes, bins = zip(*waiting)
        waiting.clear()
        return np.concatenate(y), np.concatenate(hashes), np.concatenate(bins, axis=1)

    for batch in batches:
        for i in range(batch.num_rows):
            y, hashes, bins = (np.frombuffer(c[i].as_buffer(), kind) for c, kind in zip(batch.columns, (float, np.int64, np.uint8)))
            waiting.append((y, hashes, bins.reshape(width, -1)))
            if sum(len(w[0]) for w in waiting) >= ROWS:
                yield joined()
    if waiting:
        yield joined()
