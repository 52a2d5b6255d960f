"""Random forests on known features: fit up to a cut-off, predict the next day, explain."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.errors import IllegalArgumentException
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hydroflow.config import FOREST_BINS, FOREST_DEPTH, FOREST_MEMORY_MB, FOREST_SEED, FOREST_TASK_ROWS, FOREST_TASKS, FOREST_TREES, TOP_FEATURES
from hydroflow.functions import clip_nonnegative
from hydroflow.functions.numbers import column
from hydroflow.operators.features import columns_except, history_until, rows_after, rows_of_day
from hydroflow.operators.moving import day_trailing_mean

_VECTOR = "_features"


def _assembled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=_VECTOR, handleInvalid="error").transform(df)


def forest(
    label: str,
    vector: str = _VECTOR,
    trees: int = FOREST_TREES,
    seed: int = FOREST_SEED,
    max_depth: int = FOREST_DEPTH,
    subset: str = "all",
    max_bins: int = FOREST_BINS,
    bootstrap: bool = True,
    weight: str | None = None,
) -> RandomForestRegressor:
    """The estimator. 30 is MLlib's largest depth; a feature with no more distinct values than ``max_bins`` is split at
    any of them. Without ``bootstrap`` every tree sees every row once. ``weight``: the column that says how often a row counts."""
    estimator = RandomForestRegressor(
        labelCol=label,
        featuresCol=vector,
        predictionCol="power_pred",
        numTrees=trees,
        seed=seed,
        maxDepth=max_depth,
        featureSubsetStrategy=subset,
        maxBins=max_bins,
        bootstrap=bootstrap,
        maxMemoryInMB=FOREST_MEMORY_MB,
    )
    return estimator if weight is None else estimator.setWeightCol(weight)


def fit_rows(estimator: RandomForestRegressor, rows: DataFrame) -> RandomForestRegressionModel:
    """Fit, with a plain error for an empty input. The trainer finds out itself: no extra pass over the rows."""
    try:
        return estimator.fit(rows)
    except IllegalArgumentException as e:
        if "size of input RDD > 0" in str(e):
            raise ValueError("There are no training rows.") from e
        raise


def tasks_for(n_rows: int, task_rows: int = FOREST_TASK_ROWS) -> int:
    """As many tasks as hold the rows, ``task_rows`` each. Adaptive execution and scans count bytes, of which rows that
    compress well have hardly any."""
    return max(FOREST_TASKS, -(-n_rows // task_rows))


def dealt_by_content(
    rows: DataFrame, content: Sequence[str | Column], task_rows: int = FOREST_TASK_ROWS, n_rows: int | None = None
) -> DataFrame:
    """Rows dealt to tasks by a hash of their content and sorted there; the number of tasks follows the number of rows.

    MLlib draws the rows of a tree partition by partition: a model fitted on these depends neither on the number of
    cores nor on how the table was split. ``n_rows``: their number, where it is known.
    """
    tasks = tasks_for(rows.count() if n_rows is None else n_rows, task_rows)
    return rows.repartition(tasks, F.xxhash64(*content)).sortWithinPartitions(*content)


def fit_forest(
    train: DataFrame, features: Sequence[str], target: str, task_rows: int = FOREST_TASK_ROWS, **params
) -> RandomForestRegressionModel:
    """Fit on all rows of ``train``; only the vector and the label reach the trainer, dealt by their content."""
    label = column(target).cast("double")
    dealt = dealt_by_content(train, [*[column(c) for c in features], label], task_rows)
    rows = _assembled(dealt, features).select(_VECTOR, label.alias("_label"))
    return fit_rows(forest("_label", **params), rows)


def at_once(run: Callable, items: Iterable, most: int = 8) -> list:
    """Run independent fits from a bounded number of driver threads, so that their many short jobs overlap."""
    with ThreadPoolExecutor(most) as pool:
        return list(pool.map(run, items))


def predict_known_features(model: RandomForestRegressionModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """One prediction per row from that row's own feature values, never below zero.

    The features of the predicted day itself are used: this is an explanation of the day, not a forecast from
    history (see :mod:`hydroflow.operators.forecast` for that).
    """
    scored = model.transform(_assembled(df, features)).drop(_VECTOR)
    return scored.withColumn("power_pred", clip_nonnegative("power_pred"))


def feature_importance(
    spark: SparkSession, model: RandomForestRegressionModel, features: Sequence[str], top: int | None = TOP_FEATURES
) -> DataFrame:
    """``(feature, importance)``: the ``top`` strongest, shown in ascending order. One number per feature."""
    pairs = list(zip(features, (float(x) for x in model.featureImportances.toArray()), strict=True))
    return strongest(spark.createDataFrame(pairs, "feature string, importance double"), top)


def strongest(importance: DataFrame, top: int | None = TOP_FEATURES) -> DataFrame:
    """The ``top`` strongest of ``(feature, importance)`` in ascending order; of equal ones the first names stay."""
    falling = importance.orderBy(F.desc("importance"), "feature")
    return (falling if top is None else falling.limit(top)).orderBy("importance", F.desc("feature"))


@dataclass(frozen=True)
class AsOfRun:
    """Frames of one run: the series to look at, the predicted day, and the drivers."""

    frame: DataFrame
    scored: DataFrame
    importance: DataFrame
    features: list[str]

    def peak(self) -> DataFrame:
        """Start of the predicted day and the largest of its actual and predicted values."""
        return self.scored.agg(
            F.min("ts").alias("starts_at"), F.greatest(F.max("actual"), F.max("power_pred")).alias("peak")
        )


def run_actuals(
    df: DataFrame,
    time_col: str,
    target: str,
    cutoff: date,
    tie_break: Sequence[str] = (),
    keys: Sequence[str] = (),
) -> DataFrame:
    """``(keys, ts, series, value)``: the cut-off day, its trend, and the following day as it happened."""
    today = day_trailing_mean(
        rows_of_day(df, time_col, cutoff).select(*keys, time_col, *tie_break, column(target)),
        keys,
        [time_col, *tie_break],
        target,
        "trend",
    )
    following = rows_after(df, time_col, cutoff)
    return series_of(today, keys, time_col, {target: "actual", "trend": "trend"}).unionByName(
        series_of(following, keys, time_col, {target: "next_day_actual"})
    )


def as_of_run(
    df: DataFrame,
    time_col: str,
    target: str,
    cutoff: date,
    tie_break: Sequence[str] = (),
    **params,
) -> AsOfRun:
    """Train on the rows up to the cut-off day, predict the following day, and lay the series side by side.

    The frame adds the series ``prediction`` to :func:`run_actuals`. All columns but time, tie-break and
    target are features. Nothing after the cut-off day reaches the training rows. An absent next day gives
    empty series.
    """
    features = columns_except(df, [time_col, *tie_break, target])
    model = fit_forest(history_until(df, time_col, cutoff), features, target, **params)
    scored = predict_known_features(model, rows_after(df, time_col, cutoff), features).select(
        F.col(time_col).alias("ts"), column(target).alias("actual"), "power_pred"
    )
    frame = run_actuals(df, time_col, target, cutoff, tie_break).unionByName(
        series_of(scored, [], "ts", {"power_pred": "prediction"})
    )
    return AsOfRun(frame, scored, feature_importance(df.sparkSession, model, features), features)


def series_of(df: DataFrame, keys: Sequence[str], time_col: str, names: dict[str, str]) -> DataFrame:
    """Long form ``(keys, ts, series, value)`` of the named columns."""
    pairs = [F.struct(F.lit(series).alias("series"), column(c).alias("value")) for c, series in names.items()]
    return df.select(*keys, F.col(time_col).alias("ts"), F.inline(F.array(*pairs)))


def backtest(
    df: DataFrame, time_col: str, target: str, cutoffs: Iterable[date], tie_break: Sequence[str] = (), **params
) -> DataFrame:
    """Runs for several cut-offs: one model each, all predictions in one frame ``(cutoff, ts, actual, power_pred)``."""
    parts = at_once(
        lambda day: as_of_run(df, time_col, target, day, tie_break, **params).scored.withColumn("cutoff", F.lit(day)),
        cutoffs,
    )
    if not parts:
        raise ValueError("At least one cut-off is required.")
    return reduce(DataFrame.unionByName, parts)
