"""Regressors on feature tables: temporal split, search, out-of-fold predictions, stacking.

Fits run on the executors, through Spark ML or the plans of this package; the driver only holds models. Fits that do not
depend on each other are submitted from a small thread pool so that the tail of one
overlaps the next. Folds are a hash of the row key: reproducible without sorting the rows.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import product

from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.base import Estimator
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from valora import config
from valora.operators.relational import columns_with, latest_split
from valora.plans import gram
from valora.plans.boosting import SecondOrderBoosting
from valora.plans.forest import RandomForest
from valora.plans.metrics import RESULT_KEYS, regression_metrics
from valora.session import materialize

LABEL = "log_market_value"
KEY = ("api_player_id", "season")
BASE_MODELS = ["LinearRegression", "Ridge", "RandomForest", "GBT"]
STACKED = "Stacked(RF+GBT)"
CONCURRENT_FITS = 3
MAX_COMPLETE_DEPTH = 10

Overrides = Mapping[str, Mapping[str, object]]


def feature_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return columns_with(df, exclude=[*config.ID_COLUMNS, *exclude])


def assemble(df: DataFrame, features: Sequence[str], output: str = "features") -> DataFrame:
    """Feature vector with missing values as 0; all other columns are kept."""
    filled = {f"__f{i}": F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for i, c in enumerate(features)}
    assembler = VectorAssembler(inputCols=list(filled), outputCol=output)
    return assembler.transform(df.withColumns(filled)).drop(*filled)


def fold_of(key: Sequence[str], folds: int, seed: int = config.SEED):
    return F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(folds)).cast("int")


def ridge(train: DataFrame, alpha: float, label: str = LABEL, features: str = "features",
          standardize: bool = True) -> LinearRegression:
    """Ridge with penalty ``alpha`` on the sum of squared errors.

    Spark divides the loss by the row count and, in the normal-equation solver, scales the
    label to unit deviation; the penalty is converted accordingly.
    """
    n, deviation = train.agg(F.count("*"), F.stddev_pop(label)).first()
    strength = alpha / n * (deviation or 0.0) if n else 0.0
    return LinearRegression(labelCol=label, featuresCol=features, solver="normal", elasticNetParam=0.0,
                            regParam=strength, standardization=standardize)


def estimator(name: str, train: DataFrame, label: str = LABEL, overrides: Overrides | None = None) -> Estimator:
    extra = dict((overrides or {}).get(name, {}))
    common = {"labelCol": label, "featuresCol": "features"}
    if name == "LinearRegression":
        return LinearRegression(**common, solver="normal", regParam=0.0, **extra)
    if name == "Ridge":
        return ridge(train, extra.get("alpha", config.RIDGE_ALPHA), label)
    if name == "RandomForest":
        return RandomForestRegressor(**common, seed=config.SEED, **{**config.FOREST_PARAMS, **extra})
    if name == "GBT":
        return GBTRegressor(**common, seed=config.SEED, **{**config.BOOST_PARAMS, **extra})
    if name == "Boosting":
        return SecondOrderBoosting(label, KEY, **extra)
    raise ValueError(f"unknown model {name!r}")


def fit(name: str, train: DataFrame, label: str = LABEL, overrides: Overrides | None = None) -> Model:
    """The model with its parameters as given. Forests on all features, of trees that a complete binary tree holds, come from sums over binned rows."""
    params = {**config.FOREST_PARAMS, **(overrides or {}).get(name, {})}
    if name == "RandomForest" and set(params) == set(config.FOREST_PARAMS) and params.pop("featureSubsetStrategy") == "all" and params["maxDepth"] <= MAX_COMPLETE_DEPTH:
        return RandomForest(label, **params).fit(train)
    return estimator(name, train, label, overrides).fit(train)


def draw_params(name: str, draws: int = config.SEARCH_DRAWS, seed: int = config.SEED,
                spaces: Mapping[str, Mapping[str, Sequence]] = config.SEARCH_SPACES) -> list[dict]:
    """Distinct parameter settings drawn from the search space of a model."""
    space = spaces[name]
    settings = [dict(zip(space, values)) for values in product(*space.values())]
    return random.Random(seed).sample(settings, min(draws, len(settings)))


def tune(name: str, train: DataFrame, label: str = LABEL, draws: int = config.SEARCH_DRAWS,
         folds: int = config.SEARCH_FOLDS, overrides: Overrides | None = None, key: Sequence[str] = KEY,
         parallelism: int = CONCURRENT_FITS) -> Estimator:
    """Estimator with the best drawn parameters by cross-validated R²; a model without a
    search space is returned as it is."""
    base = estimator(name, train, label, overrides)
    if name not in config.SEARCH_SPACES:
        return base
    grid = [{base.getParam(p): v for p, v in setting.items()} for setting in draw_params(name, draws)]
    search = CrossValidator(
        estimator=base, estimatorParamMaps=grid, numFolds=folds, parallelism=parallelism, foldCol="__fold",
        evaluator=RegressionEvaluator(labelCol=label, metricName="r2"))
    scores = search.fit(train.withColumn("__fold", fold_of(key, folds))).avgMetrics
    best = max(range(len(grid)), key=scores.__getitem__)
    return base.copy(grid[best])


def run_fits(spark: SparkSession, tasks: Sequence[Callable[[], DataFrame]],
             parallelism: int = CONCURRENT_FITS) -> list[DataFrame]:
    if parallelism <= 1 or len(tasks) <= 1:
        return [task() for task in tasks]
    with ThreadPoolExecutor(parallelism) as pool:
        return list(pool.map(lambda task: inheritable_thread_target(spark)(task)(), tasks))


def oof_predictions(df: DataFrame, fit: Callable[[DataFrame], Model], folds: int = config.CV_FOLDS,
                    fold: str = "__fold", output: str = "y_pred") -> DataFrame:
    """Every row predicted once, by the model of the other folds."""
    def one(i: int) -> DataFrame:
        model = fit(df.filter(F.col(fold) != i))
        return model.transform(df.filter(F.col(fold) == i)).withColumnRenamed("prediction", output)

    return reduce(DataFrame.unionByName, run_fits(df.sparkSession, [lambda i=i: one(i) for i in range(folds)]))


def _fit(name: str, train: DataFrame, tuned: bool, overrides: Overrides | None, draws: int) -> Model:
    return tune(name, train, draws=draws, overrides=overrides).fit(train) if tuned else fit(name, train, overrides=overrides)


def _stored_vectors(df: DataFrame, name: str) -> DataFrame:
    """Assembled once and stored: every fit and every prediction reads this table."""
    wide = assemble(df, feature_columns(df))
    positions = columns_with(df, prefix="pos_")
    kept = wide.select(*KEY, LABEL, *positions, "features")
    return materialize(kept.withColumn("__fold", fold_of(KEY, config.CV_FOLDS)), name)


def _predictions(data: DataFrame, seasons: int, name: str, stage: str, position: str, tuned: bool,
                 overrides: Overrides | None, draws: int) -> DataFrame:
    if seasons >= 2:
        train, test = latest_split(data)
        scored = _fit(name, train, tuned, overrides, draws).transform(test).withColumnRenamed("prediction", "y_pred")
    else:
        scored = oof_predictions(data, lambda part: fit(name, part, overrides=overrides))
    return scored.select(F.lit(name).alias("model"), F.lit(stage).alias("stage"), F.lit(position).alias("position"),
                         *KEY, F.col(LABEL).alias("y_true"), "y_pred")


def _linear_predictions(data: DataFrame, names: Sequence[str], stage: str, groups: Mapping[str, tuple[Column, int, int]]) -> DataFrame:
    """The linear models of all groups from one scan for the sums and one for the predictions.

    ``groups`` maps a position to its condition, its number of seasons and its latest one, which is predicted by the seasons before;
    a group of one season is predicted fold by fold.
    """
    label, part, asked = F.lit(None).cast("string"), F.lit(None).cast("int"), F.lit(False)
    for name, (member, seasons, latest) in groups.items():
        newest = F.col("season") == latest
        label = F.when(member, F.lit(name)).otherwise(label)
        part = F.when(member, newest.cast("int") if seasons >= 2 else F.col("__fold")).otherwise(part)
        asked = F.when(member, newest if seasons >= 2 else F.lit(True)).otherwise(asked)
    rows = data.withColumns({"position": label, "__part": part, "__asked": asked}).filter("position IS NOT NULL")
    x, penalties = vector_to_array("features"), {n: gram.PENALTIES[n] for n in names}
    solved = gram.fit(gram.gram_sums(rows, x, LABEL, ["position"], "__part"), ["position"], penalties)
    scored = gram.predict(rows.filter("__asked"), solved, x, ["position"], "__part")
    return scored.select("model", F.lit(stage).alias("stage"), "position", *KEY, F.col(LABEL).alias("y_true"), "y_pred")


def _split_models(models: Sequence[str], overrides: Overrides | None) -> tuple[list[str], list[str]]:
    """(models that come from sums of products, models that are fitted)."""
    linear = [m for m in models if m in gram.PENALTIES and not (overrides or {}).get(m)]
    return linear, [m for m in models if m not in linear]


def _groups(data: DataFrame, labels: Sequence[str]) -> tuple[dict[str, tuple[Column, int, int]], dict[str, int]]:
    """Position subsets with enough rows, as (condition, number of seasons, latest season), and the sizes of the others, from one aggregate."""
    member = {label: F.col(f"pos_{label}") == 1.0 for label in labels}
    sizes = data.agg(*[c for label, m in member.items() for c in (
        F.count_if(m).alias(f"n_{label}"), F.countDistinct(F.when(m, F.col("season"))).alias(f"s_{label}"),
        F.max(F.when(m, F.col("season"))).alias(f"l_{label}"))]).first()
    large = {label: (m, sizes[f"s_{label}"], sizes[f"l_{label}"]) for label, m in member.items()
             if sizes[f"n_{label}"] >= config.MIN_GROUP_ROWS}
    return large, {label: sizes[f"n_{label}"] for label in labels if label not in large}


def _with_small(results: DataFrame, small: dict[str, int], models: Sequence[str], stage: str) -> DataFrame:
    """Groups too small for a model are reported by their size, without metrics."""
    if not small:
        return results
    rows = [(m, stage, label, n) for label, n in small.items() for m in models]
    listed = results.sparkSession.createDataFrame(rows, "model string, stage string, position string, n_samples long")
    return results.unionByName(listed, allowMissingColumns=True)


def _evaluate(predictions: Sequence[DataFrame]) -> DataFrame:
    return regression_metrics(reduce(DataFrame.unionByName, predictions), RESULT_KEYS)


def train_global(df: DataFrame, stage: str, tuned: bool = True, models: Sequence[str] = BASE_MODELS,
                 overrides: Overrides | None = None, draws: int = config.SEARCH_DRAWS) -> DataFrame:
    """Results of all models on all positions: latest season as test, or 5-fold
    out-of-fold predictions when there is only one season."""
    data = _stored_vectors(df, f"{stage}-global")
    seasons, latest = data.agg(F.countDistinct("season"), F.max("season")).first()
    linear, fitted = _split_models(models, overrides)
    found = [_linear_predictions(data, linear, stage, {"global": (F.lit(True), seasons, latest)})] if linear else []
    return _evaluate([*found, *run_fits(df.sparkSession, [
        lambda m=m: _predictions(data, seasons, m, stage, "global", tuned, overrides, draws) for m in fitted])])


def train_position_aware(df: DataFrame, stage: str, tuned: bool = True, models: Sequence[str] = BASE_MODELS,
                         overrides: Overrides | None = None, draws: int = config.SEARCH_DRAWS) -> DataFrame:
    """Results of separate models per position group; small groups have their size and no metrics."""
    data = _stored_vectors(df, f"{stage}-positions")
    large, small = _groups(data, ["DEF", "MID", "FWD"])
    if not large:
        raise ValueError(f"no position group has {config.MIN_GROUP_ROWS} rows")
    linear, fitted = _split_models(models, overrides)
    found = [_linear_predictions(data, linear, stage, large)] if linear else []
    tasks = [
        lambda m=m, label=label, part=data.filter(member), seasons=seasons:
            _predictions(part, seasons, m, stage, label, tuned, overrides, draws)
        for label, (member, seasons, _) in large.items() for m in fitted]
    return _with_small(_evaluate([*found, *run_fits(df.sparkSession, tasks)]), small, models, stage)


def stacked_predictions(data: DataFrame, stage: str, position: str, tuned: bool = True,
                        overrides: Overrides | None = None, draws: int = config.SEARCH_DRAWS) -> DataFrame:
    """Forest and boosting blended by a ridge that only saw their out-of-fold predictions."""
    train, test = latest_split(data)
    bases = {"rf": "RandomForest", "gbt": "GBT"}

    def base(column: str) -> tuple[DataFrame, DataFrame]:
        chosen = tune(bases[column], train, draws=draws, overrides=overrides) if tuned \
            else estimator(bases[column], train, overrides=overrides)
        oof = oof_predictions(train, chosen.fit, output=column).select(*KEY, column)
        scored = chosen.fit(train).transform(test).withColumnRenamed("prediction", column).select(*KEY, column)
        return oof, scored

    (rf_oof, rf), (gbt_oof, gbt) = run_fits(data.sparkSession, [lambda c=c: base(c) for c in bases], parallelism=2)
    blend = list(bases)
    meta_train = assemble(train.select(*KEY, LABEL).join(rf_oof, list(KEY)).join(gbt_oof, list(KEY)), blend)
    meta_train = materialize(meta_train.select(LABEL, "features"), f"{stage}-{position}-meta")
    meta = ridge(meta_train, config.META_ALPHA, standardize=False).fit(meta_train)
    meta_test = assemble(test.select(*KEY, LABEL).join(rf, list(KEY)).join(gbt, list(KEY)), blend)
    return meta.transform(meta_test).select(
        F.lit(STACKED).alias("model"), F.lit(stage).alias("stage"), F.lit(position).alias("position"),
        *KEY, F.col(LABEL).alias("y_true"), F.col("prediction").alias("y_pred"))


def train_stacked(df: DataFrame, stage: str, tuned: bool = True, overrides: Overrides | None = None,
                  draws: int = config.SEARCH_DRAWS, positions: bool = True) -> DataFrame:
    """Results of the stacked ensemble, globally and per position; needs two seasons."""
    data = _stored_vectors(df, f"{stage}-stacked")
    n, seasons = data.agg(F.count("*"), F.countDistinct("season")).first()
    if seasons < 2 or n < config.MIN_GROUP_ROWS:
        raise ValueError("stacking needs at least two seasons and "
                         f"{config.MIN_GROUP_ROWS} rows, got {seasons} and {n}")
    subsets, small = {"global": data}, {}
    if positions:
        large, small = _groups(data, ["DEF", "MID", "FWD"])
        subsets |= {label: data.filter(member) for label, (member, s, _) in large.items() if s >= 2}
    results = _evaluate([stacked_predictions(part, stage, label, tuned, overrides, draws)
                         for label, part in subsets.items()])
    return _with_small(results, small, [STACKED], stage)


def score(model: Model, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Predicted log value and euros next to all columns."""
    scored = model.transform(assemble(df, features)).drop("features")
    return scored.withColumnRenamed("prediction", "predicted_log").withColumn("predicted_eur", F.expm1("predicted_log"))


def fit_forest(train: DataFrame, features: Sequence[str], overrides: Overrides | None = None) -> Model:
    vectors = assemble(train, features).select("features", LABEL)
    return fit("RandomForest", vectors, overrides=overrides)
