"""Linear and ridge models of many groups and folds from one scan.

The rows are read once, into one Gram matrix (sums of products of the constant, the features and the label) per group and fold. A task keeps
one small matrix per key it meets and hands over its cells; the cells are added up by an aggregate. Everything else is algebra on the sums: a group's folds add up to
the group, the groups to the total, and all folds but one to the model that predicts this one. So any number of penalties,
groups and out-of-fold models costs no further look at the rows.

Features are standardised by their group's mean and deviation, so a penalty weighs them alike; a constant feature gets weight 0, and where features depend on each other
the shortest weights are taken. Missing features count as 0, rows without a label are left out. A null group or fold is a group or fold of its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from valora import config
from valora.session import materialize, scratch_tables

#: Penalty by model name.
PENALTIES = {"LinearRegression": 0.0, "Ridge": config.RIDGE_ALPHA}
#: Cells of all matrices that a task keeps before it hands them over.
MOST_CELLS = 4_000_000
#: Models, one row each, that are broadcast to the rows they predict.
MOST_MODELS = 100_000
#: Share of a feature's mean square below which its variance counts as rounding.
ROUNDING = 1e-12


def products(keys: list[str]):
    """(keys, x array<double>, y) batches to (keys, i, j, s): cells of the upper triangles."""
    def run(batches):
        held: dict[tuple, np.ndarray] = {}

        def handed():
            columns = [pa.array([k[c] for k in held for _ in upper[0]], kind) for c, kind in enumerate(kinds)]
            cells = np.concatenate([m[upper] for m in held.values()])
            numbers = [pa.array(np.tile(u, len(held)).astype(np.int32)) for u in upper]
            return pa.RecordBatch.from_arrays([*columns, *numbers, pa.array(cells)], names=[*keys, "i", "j", "s"])

        for batch in batches:
            if not batch.num_rows:
                continue
            kinds = [batch.schema.field(k).type for k in keys]
            code = np.zeros(batch.num_rows, np.int64)
            for k in keys:
                coded = batch.column(k).dictionary_encode("encode")
                code = code * (len(coded.dictionary) + 1) + coded.indices.to_numpy(zero_copy_only=False)
            _, first, group = np.unique(code, return_index=True, return_inverse=True)
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            upper = np.triu_indices(x.shape[1] + 2)
            rows = np.column_stack([np.ones(batch.num_rows), x, batch.column("y").to_numpy(zero_copy_only=False)])
            order = np.argsort(group, kind="stable")
            for i, part in zip(first.tolist(), np.split(order, np.flatnonzero(np.diff(group[order])) + 1)):
                key = tuple(batch.column(k)[i].as_py() for k in keys)
                own = rows[part]
                held[key] = held.get(key, 0.0) + own.T @ own
            if len(held) * len(upper[0]) > MOST_CELLS:
                yield handed()
                held = {}
        if held:
            yield handed()

    return run


def as_array(features: Sequence[str] | Column) -> Column:
    """Named features as one array, missing ones as 0; an array of numbers is taken as it is."""
    if isinstance(features, Column):
        return features
    return F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in features])


def gram_sums(df: DataFrame, features: Sequence[str] | Column, label: str, groups: Sequence[str] = (), fold: str | None = None,
              total: str | None = None) -> DataFrame:
    """(groups, ``__fold``, i, j, s): the Gram matrix cells of [1, features, label] per group and fold, stored; one job reads the rows.

    ``total`` adds, for a single group column, a group of that name over all groups.
    """
    if total is not None and len(groups) != 1:
        raise ValueError("a total needs one group column")
    keys = [*groups, "__fold"]
    part = F.lit(0) if fold is None else F.col(fold).cast("int")
    rows = df.select(*groups, part.alias("__fold"), as_array(features).alias("x"), F.col(label).cast("double").alias("y")).filter(F.col("y").isNotNull())
    named = T.StructType([*[rows.schema[k] for k in keys], *T._parse_datatype_string("i int, j int, s double").fields])
    cells = rows.mapInArrow(products(keys), T.StructType([T.StructField(f.name, f.dataType) for f in named]))
    sums = materialize(cells.groupBy(*keys, "i", "j").agg(F.sum("s").alias("s")), "gram")
    if total is None:
        return sums
    whole = sums.withColumn(groups[0], F.lit(total).cast(sums.schema[groups[0]].dataType)).groupBy(*keys, "i", "j").agg(F.sum("s").alias("s"))
    return sums.unionByName(whole)


def solved(matrix: np.ndarray, penalty: float) -> tuple[int, float | None, list[float]]:
    """(rows, intercept, weights) from a Gram matrix of [1, features, label]."""
    n, size = int(matrix[0, 0]), len(matrix) - 2
    if not n:
        return 0, None, [0.0] * size
    mean, level = matrix[0, 1:-1] / n, matrix[0, -1] / n
    covariance = matrix[1:-1, 1:-1] / n - np.outer(mean, mean)
    variance, square = np.diag(covariance), np.diag(matrix)[1:-1] / n
    varies = variance > ROUNDING * square
    scale = np.sqrt(np.where(varies, variance, 1.0))
    alike = np.where(np.outer(varies, varies), covariance / np.outer(scale, scale), 0.0)
    with_label = np.where(varies, (matrix[1:-1, -1] / n - mean * level) / scale, 0.0)
    if penalty > 0:
        standard = np.linalg.solve(alike + penalty / n * np.eye(size), with_label)
    else:
        standard = np.linalg.lstsq(alike, with_label, rcond=1e-10)[0]
    weights = standard / scale
    return n, float(level - weights @ mean), weights.tolist()


def fit(sums: DataFrame, groups: Sequence[str] = (), penalties: Mapping[str, float] = PENALTIES) -> DataFrame:
    """(groups, model, ``held_out``, n, intercept, weights) for every group, penalty and fold that is held out, and for none (null).

    One small solve each; a group's matrices meet in one task, their size is features squared times folds.
    """
    size = (sums.agg(F.max("j")).first()[0] or 1) - 1
    by = list(groups) or ["__one"]
    cells = sums if groups else sums.withColumn("__one", F.lit(0))
    models = sorted(penalties.items())
    kinds = [cells.schema[g].dataType.simpleString() for g in by]
    names = [f"k{i}" for i in range(len(by))]

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        folds = {}
        for held, part in frame.groupby("__fold", dropna=False):
            matrix = np.zeros((size + 2, size + 2))
            matrix[part["i"], part["j"]] = part["s"]
            folds[held] = matrix + np.triu(matrix, 1).T
        key = [frame[n].iloc[0] for n in names]
        rows = []
        for held in [None, *folds] if len(folds) > 1 else [None]:
            rest = sum(m for f, m in folds.items() if held is None or f is not held)
            rows += [(*key, name, held, *solved(rest, penalty)) for name, penalty in models]
        out = pd.DataFrame(rows, columns=[*names, "model", "held_out", "n", "intercept", "weights"])
        return out.assign(held_out=out["held_out"].astype("Int32"))

    renamed = cells.select(*[F.col(g).alias(n) for g, n in zip(by, names)], "__fold", "i", "j", "s")
    schema = ", ".join([*(f"{n} {k}" for n, k in zip(names, kinds)), "model string, held_out int, n bigint, intercept double, weights array<double>"])
    solved_models = renamed.groupBy(*names).applyInPandas(solve, schema)
    return solved_models.select(*[F.col(n).alias(g) for n, g in zip(names, by) if groups], "model", "held_out", "n", "intercept", "weights")


def predicted(features: Sequence[str] | Column) -> Column:
    """The prediction of a row that has its model's ``intercept`` and ``weights``."""
    terms = F.zip_with(as_array(features), F.col("weights"), lambda x, w: x * w)
    return F.aggregate(terms, F.col("intercept"), lambda total, term: total + term)


def predict(df: DataFrame, models: DataFrame, features: Sequence[str] | Column, groups: Sequence[str] = (), fold: str | None = None,
            output: str = "y_pred") -> DataFrame:
    """Each row with the prediction of every model of its group: the one that held out its fold, or without ``fold`` the one of all rows."""
    chosen = models.filter("held_out IS NULL" if fold is None else "held_out IS NOT NULL")
    chosen = chosen.select(*[F.col(g).alias(f"__model_{g}") for g in groups], F.col("held_out").alias("__model_fold"), "model", "intercept", "weights")
    chosen = materialize(chosen, "models")
    condition = [F.col(g).eqNullSafe(F.col(f"__model_{g}")) for g in groups]
    condition += [F.col(fold).cast("int") == F.col("__model_fold")] if fold is not None else []
    if chosen.count() <= MOST_MODELS:
        chosen = F.broadcast(chosen)
    joined = df.join(chosen, reduce(Column.__and__, condition)) if condition else df.join(chosen, F.col("__model_fold").isNull())
    return joined.withColumn(output, predicted(features)).select(*df.columns, "model", output)


def out_of_fold(df: DataFrame, features: Sequence[str] | Column, label: str, groups: Sequence[str], fold: str,
                penalties: Mapping[str, float] = PENALTIES, output: str = "y_pred") -> DataFrame:
    """Every row predicted by the models of its group that did not see its fold: two scans of the rows in all, whatever the number of models."""
    with scratch_tables(df.sparkSession):
        models = materialize(fit(gram_sums(df, features, label, groups, fold), groups, penalties), "solved", kept=True)
    return predict(df, models, features, groups, fold, output)
