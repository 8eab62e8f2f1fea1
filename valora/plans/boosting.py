"""Second-order boosting of regression trees over binned features.

Every feature is cut at up to 255 quantiles, so a row is one byte per feature; these bytes, the labels and the predictions so far are stored
by blocks of up to ``SLICE`` rows, each one row of a table, and read by every level of every tree: Spark handles few rows, numpy whole columns. A level is one job: each task sums gradients and hessians per (node, feature, bin) for its rows,
one shuffle adds the sums up by (node, feature), running sums over the bins give every split's gain, and only the best split of each node
reaches the driver. A tree therefore costs as many jobs as it has levels, and what is shuffled depends on nodes, features and bins, not on rows.
Leaf weights follow from the sums at the last splits. Tables of at most ``ALONE`` such bytes are not worth a job a level, if there are
more than ``FEW_LEVELS`` of them: one task holds the rows and grows all trees, by the same sums and the same search.

Predictions are brought up to date in the tasks from the trees grown since they were last stored (``ROUNDS_STORED``), so that a level never
walks through more than a few trees; the table they were stored in before goes. Rows are drawn by a
hash of their key and the round, columns by the seed: a task that is computed again draws the same.

Rows without a label do not take part; missing features count as 0; a frame without labelled rows gives a model that predicts null.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from valora import config
from valora.session import drop_stored, materialize, scratch_tables

BINS = 256
ACCURACY = 2_500  # a cut is off by a tenth of a bin at most
ROUNDS_STORED = 5
LEAST_GAIN = 1e-6
SLICE = 20_000
ALONE, FEW_LEVELS = 64 << 20, 100
SPLIT_FIELDS = ["node", "gain", "feature", "bin", "low_g", "low_h", "all_g", "all_h"]


@dataclass(frozen=True)
class Tree:
    """A complete binary tree: node ``i`` has children ``2 i + 1`` and ``2 i + 2``. A node without a split has feature 0 and sends all rows left."""
    feature: np.ndarray
    bin: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    @property
    def depth(self) -> int:
        return len(self.leaf).bit_length() - 1


def descend(feature: np.ndarray, limit: np.ndarray, x: np.ndarray, levels: int) -> np.ndarray:
    """Number, within its level, of the node that each row of ``x`` reaches: left where the value does not exceed the limit."""
    rows, node = np.arange(len(x)), np.zeros(len(x), np.int64)
    for _ in range(levels):
        node = 2 * node + 1 + (x[rows, feature[node]] > limit[node])
    return node - (2 ** levels - 1)


def mixed(hashes: np.ndarray, turn: int) -> np.ndarray:
    """64 bits for each hash and round."""
    bits = hashes.astype(np.uint64) + np.uint64((turn + 1) * 0x9E3779B97F4A7C15 % 2 ** 64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):  # the finalizer of splitmix64
        bits = (bits ^ (bits >> np.uint64(shift))) * np.uint64(factor)
    return bits ^ (bits >> np.uint64(31))


def drawn(hashes: np.ndarray, turn: int, part: float) -> np.ndarray:
    """Rows that take part in a round, from 53 bits of their mixed hash."""
    if part >= 1:
        return np.ones(len(hashes), bool)
    return mixed(hashes, turn) >> np.uint64(11) < np.uint64(int(part * 2 ** 53))


def quantile_edges(df: DataFrame, x: Column, width: int) -> list[np.ndarray]:
    """Increasing cuts per feature: its quantiles, and all values of a feature with few; one row of ``width`` lists reaches the driver."""
    parts = [i / (BINS - 1) for i in range(BINS)]
    found = df.select(x.alias("x")).agg(*[F.percentile_approx(F.get("x", F.lit(i)), parts, ACCURACY) for i in range(width)]).first()
    return [np.unique(np.array(edges or [], float))[:BINS - 1] for edges in found]


def bin_rows(df: DataFrame, x: Column, label: str, key: Sequence[str], edges: Sequence[np.ndarray], base: float) -> DataFrame:
    """``y, margin, hash, bins`` of a block of rows, as arrays of bytes: one byte per feature and row, feature by feature, the number of cuts below its value."""
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, SLICE) for i in range(0, batch.num_rows, SLICE)):
                values = part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, len(edges))
                bins = np.stack([np.searchsorted(e, values[:, i], side="left") for i, e in enumerate(edges)]).astype(np.uint8)
                block = part.column(0).to_numpy(), np.full(part.num_rows, base), part.column(1).to_numpy(), bins
                yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in block], ["y", "margin", "hash", "bins"])

    rows = df.select(F.col(label).cast("double").alias("y"), F.xxhash64(*key).alias("hash"), x.alias("x"))
    return rows.mapInArrow(cut, "y BINARY, margin BINARY, hash BINARY, bins BINARY")


def _blocks(batches: Iterable[pa.RecordBatch], width: int):
    """(y, margin, hashes, bins) of each block; ``bins`` has a row for each row, but lies in memory feature by feature."""
    for batch in batches:
        for i in range(batch.num_rows):
            y, margin, hashes, bins = (np.frombuffer(c[i].as_buffer(), kind) for c, kind in zip(batch.columns, (float, float, np.int64, np.uint8)))
            yield y, margin, hashes, bins.reshape(width, -1).T


def _margin(margin: np.ndarray, bins: np.ndarray, trees: Sequence[Tree]) -> np.ndarray:
    margin = margin.copy()
    for tree in trees:
        margin += tree.leaf[descend(tree.feature, tree.bin, bins, tree.depth)]
    return margin


def _add_sums(g: np.ndarray, h: np.ndarray, gradient: np.ndarray, bins: np.ndarray, grown: Tree, level: int, columns: Sequence[int]) -> None:
    """Add the rows of one block to the cells (feature, node and bin) of a level."""
    start = descend(grown.feature, grown.bin, bins, level) * BINS
    for i, column in enumerate(columns):
        cell = start + bins[:, column]
        g[i] += np.bincount(cell, gradient, g.shape[1])
        h[i] += np.bincount(cell, minlength=h.shape[1])


def _level_sums(rows: DataFrame, width: int, trees: Sequence[Tree], grown: Tree, level: int, columns: Sequence[int], turn: int, part: float) -> DataFrame:
    """``node, feature, bin, g, h``: sums of each task, which keeps one cell per (node, feature, bin)."""
    columns, nodes = np.array(columns), 2 ** level

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, h = (np.zeros((len(columns), nodes * BINS)) for _ in range(2))
        for y, margin, hashes, bins in _blocks(batches, width):
            kept = drawn(hashes, turn, part)
            bins = bins.T[:, kept].T
            _add_sums(g, h, _margin(margin[kept], bins, trees) - y[kept], bins, grown, level, columns)
        i, cell = np.nonzero(h)
        yield pa.RecordBatch.from_arrays([pa.array(a) for a in (cell // BINS, columns[i], cell % BINS, g[i, cell], h[i, cell])],
                                         ["node", "feature", "bin", "g", "h"])

    return rows.mapInArrow(sums, "node BIGINT, feature BIGINT, bin BIGINT, g DOUBLE, h DOUBLE")


def _best(places: Iterable[tuple[tuple[int, int], np.ndarray]], penalty: float, least: float) -> list[tuple]:
    """The split of highest gain per node, then of the first feature and bin, from the bins of each (node, feature), which come in order."""
    def strength(g: np.ndarray, h: np.ndarray) -> np.ndarray:
        return g * g / (h + penalty)

    best: dict[int, tuple] = {}
    for (node, feature), (g, h) in places:
        low_g, low_h, all_g, all_h = g.cumsum(), h.cumsum(), g.sum(), h.sum()
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = strength(low_g, low_h) + strength(all_g - low_g, all_h - low_h) - strength(all_g, all_h)
        gain = np.where((low_h >= least) & (all_h - low_h >= least) & (h > 0), gain, -math.inf)
        at = int(gain.argmax())
        if node not in best or gain[at] > best[node][1]:
            best[node] = (node, float(gain[at]), feature, at, float(low_g[at]), float(low_h[at]), float(all_g), float(all_h))
    return list(best.values())


def best_splits(sums: DataFrame, penalty: float, least: float) -> DataFrame:
    """The split of highest gain per node, then of the first feature and bin, in each partition of the sums by (node, feature); a node
    without one has only its sums ``all_g, all_h``. A task keeps one array of bins per (node, feature)."""
    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            node, feature, at, g, h = (batch.column(i).to_numpy() for i in range(5))
            for pair in set(zip(node.tolist(), feature.tolist())):
                here = (node == pair[0]) & (feature == pair[1])
                total = places.setdefault(pair, np.zeros((2, BINS)))
                total[0] += np.bincount(at[here], g[here], BINS)
                total[1] += np.bincount(at[here], h[here], BINS)
        if best := _best(sorted(places.items(), key=lambda p: p[0]), penalty, least):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*best)], SPLIT_FIELDS)

    return sums.repartition("node", "feature").mapInArrow(
        search, "node BIGINT, gain DOUBLE, feature BIGINT, bin BIGINT, low_g DOUBLE, low_h DOUBLE, all_g DOUBLE, all_h DOUBLE")


@dataclass(frozen=True)
class Boosted:
    """A fitted model; ``transform`` adds ``prediction`` to rows with a vector column ``features``."""
    base: float | None
    trees: tuple[Tree, ...]
    features: str = "features"

    def transform(self, df: DataFrame) -> DataFrame:
        base, trees = self.base, self.trees
        if base is None:
            return df.withColumn("prediction", F.lit(None).cast("double"))

        @F.pandas_udf("double")
        def predicted(values: pd.Series) -> pd.Series:
            out = np.full(len(values), base)
            for at in range(0, len(values), SLICE):
                x = np.stack(values.iloc[at:at + SLICE].to_numpy())
                for tree in trees:
                    out[at:at + SLICE] += tree.leaf[descend(tree.feature, tree.cut, x, tree.depth)]
            return pd.Series(out)

        return df.withColumn("prediction", predicted(vector_to_array(self.features)))


@dataclass(frozen=True)
class SecondOrderBoosting:
    """Squared-error boosting: gradients are residuals, hessians 1; ``rows`` and ``columns`` are the shares drawn for each tree."""
    label: str
    key: Sequence[str]
    features: str = "features"
    rounds: int = config.SECOND_ORDER_PARAMS["rounds"]
    depth: int = config.SECOND_ORDER_PARAMS["depth"]
    rate: float = config.SECOND_ORDER_PARAMS["rate"]
    rows: float = config.SECOND_ORDER_PARAMS["rows"]
    columns: float = config.SECOND_ORDER_PARAMS["columns"]
    penalty: float = config.SECOND_ORDER_PARAMS["penalty"]
    least: float = config.SECOND_ORDER_PARAMS["least"]
    seed: int = config.SEED

    def fit(self, df: DataFrame) -> Boosted:
        df = df.filter(F.col(self.label).isNotNull())
        x = vector_to_array(self.features)
        base, width, n = df.agg(F.avg(self.label), F.max(F.size(x)), F.count("*")).first()
        if base is None or not width:
            return Boosted(base, (), self.features)
        edges = quantile_edges(df, x, width)
        draw = random.Random(self.seed)
        chosen = [sorted(draw.sample(range(width), max(1, int(self.columns * width)))) for _ in range(self.rounds)]
        with scratch_tables(df.sparkSession):
            stored = materialize(bin_rows(df, x, self.label, self.key, edges, float(base)), "boosting")
            alone = n * width <= ALONE and self.rounds * self.depth > FEW_LEVELS
            trees = (self._grown_alone if alone else self._grown)(stored, width, chosen, edges)
        return Boosted(float(base), tuple(trees), self.features)

    def _grown(self, stored: DataFrame, width: int, chosen: Sequence[Sequence[int]], edges: Sequence[np.ndarray]) -> list[Tree]:
        trees: list[Tree] = []
        since = 0  # trees before this one are in the stored predictions
        for turn, columns in enumerate(chosen):
            if turn - since == ROUNDS_STORED:
                before, stored = stored, materialize(self._advanced(stored, width, trees[since:]), "boosting")
                drop_stored(before)
                since = turn

            def found(tree: Tree, level: int) -> list[tuple]:
                sums = _level_sums(stored, width, trees[since:], tree, level, columns, turn, self.rows)
                return best_splits(sums, self.penalty, self.least).collect()  # at most one row per node and shuffle partition
            trees.append(self._grow(found, edges))
        return trees

    def _grown_alone(self, stored: DataFrame, width: int, chosen: Sequence[Sequence[int]], edges: Sequence[np.ndarray]) -> list[Tree]:
        """All trees from one task that holds the rows."""
        def grown(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            blocks = list(zip(*_blocks(batches, width)))
            y, margin, hashes = (np.concatenate(c) for c in blocks[:3])
            bins = np.concatenate([b.T for b in blocks[3]], axis=1)
            for turn, columns in enumerate(chosen):
                kept = drawn(hashes, turn, self.rows)
                inside, gradient = bins[:, kept].T, (margin - y)[kept]

                def found(tree: Tree, level: int) -> list[tuple]:
                    g, h = (np.zeros((len(columns), 2 ** level * BINS)) for _ in range(2))
                    _add_sums(g, h, gradient, inside, tree, level, columns)
                    cells = np.stack([g, h]).reshape(2, len(columns), -1, BINS)
                    places = (((node, column), cells[:, i, node]) for node in range(2 ** level) for i, column in enumerate(columns) if cells[1, i, node].any())
                    return _best(places, self.penalty, self.least)
                tree = self._grow(found, edges)
                margin = _margin(margin, bins.T, [tree])
                yield pa.RecordBatch.from_arrays([pa.array([a.tolist()]) for a in (tree.feature, tree.bin, tree.cut, tree.leaf)], ["feature", "bin", "cut", "leaf"])

        one = stored.repartition(1).mapInArrow(grown, "feature ARRAY<BIGINT>, bin ARRAY<BIGINT>, cut ARRAY<DOUBLE>, leaf ARRAY<DOUBLE>")
        return [Tree(*map(np.array, row)) for row in one.collect()]

    def _advanced(self, stored: DataFrame, width: int, trees: Sequence[Tree]) -> DataFrame:
        def advance(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i, (_, margin, _, bins) in enumerate(_blocks([batch], width)):
                    y, _, *rest = batch.slice(i, 1).columns
                    yield pa.RecordBatch.from_arrays([y, pa.array([_margin(margin, bins, trees).tobytes()], pa.binary()), *rest], batch.schema.names)

        return stored.mapInArrow(advance, stored.schema)

    def _grow(self, found: Callable[[Tree, int], list[tuple]], edges: Sequence[np.ndarray]) -> Tree:
        """One tree; ``found`` gives the best splits of a level, in the order of ``SPLIT_FIELDS``."""
        inner = 2 ** self.depth - 1
        tree = Tree(np.zeros(inner, np.int64), np.full(inner, BINS, np.int64), np.full(inner, math.inf), np.zeros(inner + 1))
        ended: set[int] = set()  # nodes whose weight is set, with all below them
        for level in range(self.depth):
            first, below = 2 ** level - 1, 2 ** (self.depth - level)
            split = False
            splits = sorted(found(tree, level), key=lambda s: (s[0], -s[1], s[2]))
            for at, gain, feature, edge, low_g, low_h, all_g, all_h in {s[0]: s for s in reversed(splits)}.values():
                node = first + at
                if node in ended:
                    ended.add(2 * node + 1)  # its rows went left
                    continue
                if gain <= LEAST_GAIN:
                    tree.leaf[at * below] = self._weight(all_g, all_h)
                    ended.add(2 * node + 1)
                    continue
                split = True
                tree.feature[node], tree.bin[node], tree.cut[node] = feature, edge, edges[feature][edge]
                if level == self.depth - 1:
                    tree.leaf[2 * at] = self._weight(low_g, low_h)
                    tree.leaf[2 * at + 1] = self._weight(all_g - low_g, all_h - low_h)
            if not split:
                break
        return tree

    def _weight(self, g: float, h: float) -> float:
        return -g / (h + self.penalty) * self.rate
