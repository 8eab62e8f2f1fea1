"""Tree SHAP attributions of a forest.

The path-dependent value of a feature subset S at a leaf is
``value * prod_f (o_f if f in S else z_f)``: ``o_f`` says whether the row meets all conditions
the path puts on feature f, ``z_f`` is the share of training rows that followed them. The
Shapley value of feature i in this product game is ``value * (o_i - z_i)`` times the integral over t from 0 to 1 of
``prod_{f != i} (t * o_f + (1 - t) * z_f)``, a polynomial whose degree is below the path's number of features, so that a Gauss-Legendre
rule with half as many nodes gives it exactly. Paths may be of any length.

Only the trees travel to the executors: their size is bounded by number of trees times
``2^(depth + 1)`` nodes, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.sql import DataFrame, functions as F

from valora import config
from valora.operators.relational import columns_with, latest_split
from valora.plans.forest import Forest
from valora.plans.models import LABEL, feature_columns, fit_forest
from valora.session import materialize, scratch_dir


#: All patterns of a tree's conditions are worked out once if a batch has so many times as many rows as there are patterns,
#: and their attributions are no more numbers (8 bytes each) than this; other trees are worked out row by row.
PATTERN_SHARE, PATTERN_CELLS = 4, 4_000_000
#: A part of a tree is the leaves below a node whose attributions follow from the outcomes of so many splits, those on the way to it and those below;
#: a tree is cut into parts if the rows at hand are at least these, and rows of several batches are explained together up to a number.
PART_SPLITS, PART_ROWS, PART_CELLS, GATHERED_ROWS = 9, 2_000, 2_000_000, 100_000


def forest_nodes(model: Model, df: DataFrame) -> list[pd.DataFrame]:
    """Node table of every tree, indexed by node id; that of a Spark ML model is read from the saved model."""
    if isinstance(model, Forest):
        return model.nodes()
    spark = df.sparkSession
    path = scratch_dir(spark, "forest")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.prediction", F.get("nodeData.impurityStats", F.lit(0)).alias("cover"),
        "nodeData.leftChild", "nodeData.rightChild", F.col("nodeData.split.featureIndex").alias("feature"),
        F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold")).toPandas()
    return [t.set_index("id").sort_index() for _, t in nodes.groupby("treeID")]


def _splits(tree: pd.DataFrame) -> dict[str, list]:
    """Splits as (feature, threshold), and parts as (their splits, leaves below); a leaf is, by split feature of its path, the (place in the part's splits, side) of its conditions.
    Leaves come in the order of ``_leaf_paths``."""
    left, right, feature, threshold = (tree[c].to_dict() for c in ("leftChild", "rightChild", "feature", "threshold"))
    below: dict[int, int] = {}
    for node in sorted(tree.index, reverse=True):  # children have larger ids
        below[node] = 0 if left[node] < 0 else 1 + below[left[node]] + below[right[node]]
    numbers = {node: i for i, node in enumerate(n for n in tree.index if left[n] >= 0)}
    parts: list[tuple[list[int], list[dict[int, list[tuple[int, bool]]]]]] = []
    stack: list[tuple] = [(0, (), None)]
    while stack:
        node, path, part = stack.pop()
        if part is None and (left[node] < 0 or len(path) + below[node] <= PART_SPLITS):
            part = ([numbers[n] for n, _ in path], [], {n: i for i, (n, _) in enumerate(path)})
            parts.append(part)
        if left[node] < 0:
            conditions: dict[int, list[tuple[int, bool]]] = {}
            for n, is_left in path:
                conditions.setdefault(int(feature[n]), []).append((part[2][n], is_left))
            part[1].append(conditions)
            continue
        if part is not None:
            part[2][node] = len(part[0])
            part[0].append(numbers[node])
        for child, is_left in ((left[node], True), (right[node], False)):
            stack.append((child, (*path, (node, is_left)), part))
    return {"splits": [(int(feature[n]), float(threshold[n])) for n in numbers], "parts": [p[:2] for p in parts]}


def _leaf_paths(tree: pd.DataFrame) -> list[tuple[float, dict[int, list[float]]]]:
    """Per leaf its value and, per feature on the path, lower bound, upper bound, cover share."""
    left, right = tree["leftChild"].to_dict(), tree["rightChild"].to_dict()
    feature, threshold = tree["feature"].to_dict(), tree["threshold"].to_dict()
    cover, value = tree["cover"].to_dict(), tree["prediction"].to_dict()
    leaves, stack = [], [(0, {})]
    while stack:
        node, path = stack.pop()
        if left[node] < 0:
            leaves.append((value[node], path))
            continue
        for child, is_left in ((left[node], True), (right[node], False)):
            low, high, share = path.get(feature[node], (-np.inf, np.inf, 1.0))
            bound = (low, min(high, threshold[node])) if is_left else (max(low, threshold[node]), high)
            stack.append((child, path | {feature[node]: (*bound, share * cover[child] / cover[node])}))
    return leaves


def compile_tree(tree: pd.DataFrame, n_features: int) -> dict[str, np.ndarray]:
    """Leaf arrays padded to the longest path; padding is a feature that changes nothing. Splits and parts are kept beside them."""
    leaves = _leaf_paths(tree)
    depth = max((len(p) for _, p in leaves), default=0)
    shape = (len(leaves), depth)
    out = {"feature": np.full(shape, n_features), "low": np.full(shape, -np.inf), "high": np.full(shape, np.inf),
           "share": np.ones(shape), "value": np.array([v for v, _ in leaves])}
    for i, (_, path) in enumerate(leaves):
        for j, (f, (low, high, share)) in enumerate(path.items()):
            out["feature"][i, j], out["low"][i, j], out["high"][i, j], out["share"][i, j] = f, low, high, share
    return out | _splits(tree)


def expected_value(tree: dict[str, np.ndarray]) -> float:
    return float((tree["value"] * tree["share"].prod(axis=1)).sum())


def _attributions(tree: dict[str, np.ndarray], met: np.ndarray) -> np.ndarray:
    """Attribution (row, leaf, path feature) where ``met`` says which conditions each row meets."""
    share = tree["share"]
    nodes, weights = np.polynomial.legendre.leggauss(share.shape[1] // 2 + 1)
    total = np.zeros(met.shape)
    for t, weight in zip((nodes + 1) / 2, weights / 2):
        # Inside (0, 1) no factor is zero, so a feature's own one can be divided out.
        factors = t * met + (1 - t) * share
        total += weight * factors.prod(axis=2, keepdims=True) / factors
    return total * (met - share) * tree["value"][:, None]


def _all_attributions(tree: dict[str, np.ndarray], rows: int) -> np.ndarray:
    """Attribution (pattern, leaf, path feature) for every pattern of met conditions: what a leaf gives depends on a row by no more."""
    leaves, depth = tree["share"].shape
    bits = (np.arange(1 << depth)[:, None] >> np.arange(depth) & 1).astype(float)
    return np.concatenate([_attributions(tree, np.broadcast_to(part[:, None], (len(part), leaves, depth)))
                           for part in (bits[at:at + rows] for at in range(0, 1 << depth, rows))])


def _pattern(met: np.ndarray) -> np.ndarray:
    """The conditions met by each (row, leaf) as one number, the first path feature its lowest bit."""
    octets = np.packbits(met, axis=2, bitorder="little").astype(np.int64)
    return sum(octets[..., i] << 8 * i for i in range(octets.shape[2]))


def _add_by_parts(tree: dict[str, np.ndarray], known: np.ndarray, x: np.ndarray, total: np.ndarray, rows: int) -> None:
    """Add attributions to ``total`` (feature, row): of each part one table, by the outcomes of its splits, is looked up for all features of its leaves."""
    leaf, tables = 0, []
    for splits, leaves in tree["parts"]:
        outcome = (np.arange(1 << len(splits))[:, None] >> np.arange(len(splits)) & 1).astype(bool)  # 1: left
        sums: dict[int, np.ndarray] = {}
        for conditions in leaves:
            pattern = np.full(len(outcome), (1 << known.shape[2]) - (1 << len(conditions)))  # padding is always met
            for j, feature in enumerate(tree["feature"][leaf][:len(conditions)].tolist()):
                met = np.ones(len(outcome), bool)
                for at, is_left in conditions[feature]:
                    met &= outcome[:, at] == is_left
                pattern |= met.astype(np.int64) << j
            parts = known[pattern, leaf]
            for j, feature in enumerate(tree["feature"][leaf][:len(conditions)].tolist()):
                sums[feature] = sums[feature] + parts[:, j] if feature in sums else parts[:, j].copy()
            leaf += 1
        tables.append((splits, sums))
    for start in range(0, x.shape[1], rows):
        part = x[:, start:start + rows]
        left = np.empty((len(tree["splits"]), part.shape[1]), np.uint16)
        for i, (feature, threshold) in enumerate(tree["splits"]):
            np.less_equal(part[feature], threshold, out=left[i], casting="unsafe")
        for splits, sums in tables:
            code = np.zeros(part.shape[1], np.uint16)
            for split in reversed(splits):
                code <<= 1
                code |= left[split]
            for feature, table in sums.items():
                total[feature, start:start + rows] += table.take(code)


def shap_values(trees: Sequence[dict[str, np.ndarray]], x: np.ndarray, cells: int = 1_000_000) -> np.ndarray:
    """Attributions (row, feature) of the mean of the trees, in batches of ``cells`` numbers."""
    n, n_features = x.shape
    padded = np.hstack([x, np.zeros((n, 1))])
    total, by_parts, columns = np.zeros((n, n_features + 1)), np.zeros((n_features, n)), np.ascontiguousarray(x.T)
    for tree in trees:
        leaves, depth = tree["share"].shape
        if depth == 0:
            continue
        if n >= PART_ROWS and "parts" in tree and depth <= PART_SPLITS and max(len(p[0]) for p in tree["parts"]) <= 12:
            _add_by_parts(tree, _all_attributions(tree, max(1, cells // (leaves * depth))), columns, by_parts, PART_CELLS // max(1, len(tree["splits"])))
            continue
        # Sums per feature as a product with a 0/1 matrix instead of scattered adds.
        scatter = np.zeros((leaves * depth, n_features + 1))
        scatter[np.arange(leaves * depth), tree["feature"].ravel()] = 1.0
        rows = max(1, cells // (leaves * depth))
        known = _all_attributions(tree, rows) if n >= PATTERN_SHARE << depth and leaves * depth << depth <= PATTERN_CELLS else None
        for start in range(0, n, rows):
            value = padded[start:start + rows][:, tree["feature"]]
            met = (value > tree["low"]) & (value <= tree["high"])
            parts = _attributions(tree, met.astype(float)) if known is None else known[_pattern(met), np.arange(leaves)]
            total[start:start + rows] += parts.reshape(len(value), -1) @ scatter
    return (total[:, :n_features] + by_parts.T) / len(trees)


def _filled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.select(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)).alias(f"f{i}")
                       for i, c in enumerate(features)])


def _gathered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches put together, as tables of parts are worked out once for the rows of a call."""
    waiting: list[pd.DataFrame] = []
    for batch in batches:
        waiting.append(batch)
        if sum(map(len, waiting)) >= GATHERED_ROWS:
            yield pd.concat(waiting, ignore_index=True)
            waiting = []
    if waiting:
        yield pd.concat(waiting, ignore_index=True)


def mean_abs_shap(model: Model, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``feature, mean_abs``: each task sums its rows, so only a row per feature leaves it."""
    trees = [compile_tree(t, len(features)) for t in forest_nodes(model, df)]
    shared = df.sparkSession.sparkContext.broadcast(trees)
    names = list(features)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(len(names)), 0
        for batch in _gathered(batches):
            total += np.abs(shap_values(shared.value, batch.to_numpy(dtype="float64"))).sum(axis=0)
            n += len(batch)
        if n:
            yield pd.DataFrame({"feature": names, "total": total, "n": n})

    parts = _filled(df, features).mapInPandas(partial, "feature STRING, total DOUBLE, n BIGINT")
    return parts.groupBy("feature").agg((F.sum("total") / F.sum("n")).alias("mean_abs"))


def row_attributions(model: Model, df: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """One row per input row: keys, base value and an array of attributions in feature order."""
    trees = [compile_tree(t, len(features)) for t in forest_nodes(model, df)]
    base = float(np.mean([expected_value(t) for t in trees]))
    shared = df.sparkSession.sparkContext.broadcast(trees)
    inputs = df.select(*keys, *[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)).alias(f"f{i}")
                                for i, c in enumerate(features)])
    width = len(keys)

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _gathered(batches):
            out = batch.iloc[:, :width].copy()
            out["base_value"] = base
            out["attributions"] = list(shap_values(shared.value, batch.iloc[:, width:].to_numpy(dtype="float64")))
            yield out

    schema = ", ".join([*[f"`{k}` {dict(df.dtypes)[k]}" for k in keys], "base_value DOUBLE",
                        "attributions ARRAY<DOUBLE>"])
    return inputs.mapInPandas(explain, schema)


def shap_importance(df: DataFrame, position: str = "global", top_n: int = 15, overrides=None) -> DataFrame:
    """Forest on the earlier seasons, mean absolute attribution per feature on the latest one."""
    features = feature_columns(df)
    if position != "global":
        if f"pos_{position}" not in columns_with(df, prefix="pos_"):
            raise ValueError(f"unknown position {position!r}")
        df = df.filter(F.col(f"pos_{position}") == 1.0)
    df = materialize(df.select(*features, *[c for c in (LABEL, "season") if c not in features]), "explain")
    train, test = latest_split(df)
    latest = df.agg(F.max("season")).scalar()
    n_train, n_test = df.agg(F.count_if(F.col("season") < latest), F.count_if(F.col("season") == latest)).first()
    if n_train < config.MIN_EXPLAIN_TRAIN or n_test < config.MIN_EXPLAIN_TEST:
        raise ValueError(f"Not enough data for position={position}")
    model = fit_forest(train.select(*features, LABEL), features, overrides)
    return mean_abs_shap(model, test, features).orderBy(F.desc("mean_abs"), "feature").limit(top_n)
