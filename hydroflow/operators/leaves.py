"""Leaf tables: what a forest's leaves hold beyond the one number that it was fitted on.

A tree sorts rows into leaves. Any value of the training rows can be averaged per leaf afterwards, in one aggregation
over all trees: a whole target vector for a forecast of many steps, or the target of one plant and cut-off only.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hydroflow.config import DAY_TREND_ROWS, FOREST_BINS, FOREST_TASK_ROWS, ForecastConfig
from hydroflow.functions import clip_nonnegative, day_of, forecast_index, null_if_nan
from hydroflow.functions.numbers import column
from hydroflow.operators.features import build_features, check_features, columns_except
from hydroflow.operators.forecast import daily_cutoffs
from hydroflow.operators.forest import dealt_by_content, fit_rows, forest, series_of, tasks_for
from hydroflow.operators.lookback import lookback
from hydroflow.operators.moving import day_trailing_mean
from hydroflow.operators.positions import global_positions, null_safe_join
from hydroflow.session import stored

_VECTOR = "_features"
#: Training rows that a task makes out of the rows dealt to it; they wait in its memory to be sent on.
RUN_TASK_ROWS = 20 * FOREST_TASK_ROWS
#: More training rows than this are counted together where they are alike, if no rows are drawn; fewer fit into a task as they are.
ALIKE_FROM = 50_000


def with_leaves(model: RandomForestRegressionModel, rows: DataFrame, vector: str = _VECTOR) -> DataFrame:
    """A row for every tree that a row passes: its other columns, ``tree`` and ``leaf``."""
    scored = model.copy({model.leafCol: "_leaves", model.predictionCol: "_unused"}).transform(rows)
    others = [c for c in rows.columns if c != vector]
    return scored.select(*[column(c) for c in others], F.posexplode(vector_to_array("_leaves")).alias("tree", "leaf")).withColumn(
        "leaf", F.col("leaf").cast("int")
    )


def _means(values: str, n: int) -> Column:
    """The mean of each place of an array column, NULL where no row has a value."""
    return F.array(*[F.avg(F.get(values, F.lit(i))) for i in range(n)])


# One forest for a whole horizon


@dataclass(frozen=True)
class VectorBundle:
    """A forest, the mean target vector of each of its leaves (tree, leaf, means), and the settings of the fit."""

    model: RandomForestRegressionModel
    table: DataFrame
    config: ForecastConfig
    keys: tuple[str, ...] = ()


def target_vectors(
    lookbacks: DataFrame, features: DataFrame, config: ForecastConfig, keys: Sequence[str], until: datetime | None = None
) -> DataFrame:
    """``(keys, cutoff, lookback, targets)`` of the usable look-backs: the target of every step, NULL where there is none.

    Only keys and times are repeated for the steps, not the look-backs. Several rows of one time count with their mean.
    Look-backs without any target are left out; with ``until`` later targets do not count.
    """
    time_col, n = config.time_col, config.horizon_steps
    usable = lookbacks.filter(F.col("status") == "ok")
    index = forecast_index("cutoff", n, config.steps_per_hour)
    asked = usable.select(*keys, "cutoff", F.posexplode(index).alias("step", "ts"))
    known = features.select(*keys, F.col(time_col).alias("ts"), null_if_nan(config.target_col).alias("label")).filter("label is not null")
    if until is not None:
        known = known.filter(F.col("ts") <= F.lit(until.isoformat(" ")).cast(dict(known.dtypes)["ts"]))
    known = known.groupBy(*keys, "ts").agg(F.avg("label").alias("label"))
    met = null_safe_join(asked, known, [*keys, "ts"]).withColumnRenamed("cutoff", "_cutoff")
    # As many values as the horizon has steps.
    found = F.map_from_entries(F.collect_list(F.struct("step", "label")))
    vectors = met.groupBy(*keys, F.col("_cutoff").alias("cutoff")).agg(found.alias("_found"))
    vectors = vectors.withColumn("targets", F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.try_element_at("_found", i)))
    joined = null_safe_join(usable.select(*keys, "cutoff", "lookback"), vectors.drop("_found"), [*keys, "cutoff"])
    return joined.select(*keys, "cutoff", "lookback", "targets")


def fit_vector(
    lookbacks: DataFrame,
    features: DataFrame,
    config: ForecastConfig,
    keys: Sequence[str],
    until: datetime | None = None,
    **params,
) -> VectorBundle:
    """One forest for all steps: it is fitted on the mean of each target vector, then its leaves get the vectors' means.

    Every look-back is one training row whatever the horizon. The leaf table has at most one row per leaf.
    """
    rows = stored(target_vectors(lookbacks, features, config, keys, until), "target-vectors")
    present = F.filter("targets", lambda x: x.isNotNull())
    mean = F.aggregate(present, F.lit(0.0), lambda a, x: a + x) / F.size(present)
    training = dealt_by_content(rows.select("lookback", mean.alias("label")), ["lookback", "label"])
    model = fit_rows(forest("label", _VECTOR, **params), training.select(array_to_vector("lookback").alias(_VECTOR), "label"))
    leaves = with_leaves(model, rows.select("targets", array_to_vector("lookback").alias(_VECTOR)))
    table = leaves.groupBy("tree", "leaf").agg(_means("targets", config.horizon_steps).alias("means"))
    return VectorBundle(model, stored(table, "leaf-table"), config, tuple(keys))


def train_vector(
    wide: DataFrame,
    config: ForecastConfig,
    keys: Sequence[str],
    cutoffs: DataFrame | None = None,
    tie_break: Sequence[str] = (),
    until: datetime | None = None,
    **params,
) -> VectorBundle:
    """From the wide table to a fitted bundle; by default every day's launch time is a training cut-off."""
    features, names = build_features(wide, config, keys, tie_break)
    features = stored(features, "features")
    asked = daily_cutoffs(features, config, keys) if cutoffs is None else cutoffs
    windows = lookback(features, keys, [config.time_col, *tie_break], names, asked, config.window_steps)
    return fit_vector(windows, features, replace(config, feature_cols=tuple(names)), keys, until, **params)


def vector_forecast(lookbacks: DataFrame, bundle: VectorBundle, keys: Sequence[str]) -> DataFrame:
    """``(keys, cutoff, step, ts, power_pred)``: every usable look-back with the mean of its leaves' vectors.

    A step that a leaf has no target for counts with the other trees; it is NULL where none has one.
    """
    config = bundle.config
    usable = lookbacks.filter(F.col("status") == "ok").select(*keys, "cutoff", array_to_vector("lookback").alias(_VECTOR))
    held = with_leaves(bundle.model, usable).join(bundle.table, ["tree", "leaf"])
    whole = held.groupBy(*keys, "cutoff").agg(_means("means", config.horizon_steps).alias("_values"))
    times = forecast_index("cutoff", config.horizon_steps, config.steps_per_hour)
    steps = whole.select(*keys, "cutoff", F.posexplode(F.arrays_zip(times.alias("ts"), F.col("_values").alias("value"))).alias("at", "own"))
    return steps.select(*keys, "cutoff", (F.col("at") + 1).alias("step"), "own.ts", F.col("own.value").alias("power_pred"))


def vector_forecast_cutoffs(
    wide: DataFrame, bundle: VectorBundle, cutoffs: DataFrame, keys: Sequence[str], tie_break: Sequence[str] = ()
) -> DataFrame:
    """Forecasts of many cut-offs from the wide table, whose feature columns must be those of the fit."""
    config = bundle.config
    features, names = build_features(wide, config, keys, tie_break)
    check_features(names, config.feature_cols)
    windows = lookback(features, keys, [config.time_col, *tie_break], names, cutoffs, config.window_steps)
    return vector_forecast(windows, bundle, keys)


def save_vector(spark: SparkSession, bundle: VectorBundle, path: str) -> None:
    """Write model, leaf table and settings below ``path``, replacing what is there."""
    bundle.model.write().overwrite().save(f"{path}/model")
    bundle.table.write.mode("overwrite").parquet(f"{path}/leaves")
    meta = json.dumps({**asdict(bundle.config), "keys": bundle.keys})
    spark.createDataFrame([(meta,)], "meta string").coalesce(1).write.mode("overwrite").json(f"{path}/meta")


def load_vector(spark: SparkSession, path: str) -> VectorBundle:
    """Read a saved bundle; :class:`FileNotFoundError` if there is none."""
    try:
        row = spark.read.schema("meta string").json(f"{path}/meta").first()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"No saved forecast model at {path}.") from e
        raise
    meta = json.loads(row["meta"])
    keys = tuple(meta.pop("keys"))
    config = ForecastConfig(**{**meta, "feature_cols": tuple(meta["feature_cols"])})
    table = spark.read.schema("tree int, leaf int, means array<double>").parquet(f"{path}/leaves")
    return VectorBundle(RandomForestRegressionModel.load(f"{path}/model"), table, config, keys)


# Runs of many plants and cut-offs in one fit


@dataclass(frozen=True)
class KeyedRuns:
    """Stored results of many runs: each is a plant (``keys``) and the cut-off day ``cutoff``.

    ``scored``: keys, cutoff, ts, actual, power_pred for the day after the cut-off. ``bounds``: keys, cutoff, least, most of
    what the run learned from.
    """

    runs: DataFrame
    scored: DataFrame
    bounds: DataFrame
    model: RandomForestRegressionModel

    def peaks(self, keys: Sequence[str]) -> DataFrame:
        """Start of the predicted day and the largest of its actual and predicted values."""
        top = F.greatest(F.max("actual"), F.max("power_pred"))
        return self.scored.groupBy(*keys, "cutoff").agg(F.min("ts").alias("starts_at"), top.alias("peak"))


def _of_runs(df: DataFrame, runs: DataFrame, keys: Sequence[str], time_col: str, first: int | None, last: int) -> DataFrame:
    """Rows of each run, from ``first`` days after its cut-off (or from the start) to ``last`` days after it, both included."""
    kind = dict(df.dtypes)[time_col]
    within = F.col(time_col) < F.date_add("cutoff", last + 1).cast(kind)
    if first is not None:
        within = within & (F.col(time_col) >= F.date_add("cutoff", first).cast(kind))
    return null_safe_join(df, runs, keys, also=within)


def _by_day(rows: DataFrame, keys: Sequence[str], time_col: str, features: Sequence[str]) -> DataFrame:
    """Number, sum and extremes of ``label`` by key, ``_day`` and features. A missing label stays one: NaN, which no fit takes."""
    total = F.when(F.count("label") == F.count(F.lit(1)), F.sum("label")).otherwise(F.lit(float("nan")))
    return rows.groupBy(*keys, day_of(time_col).alias("_day"), *features).agg(
        F.count(F.lit(1)).alias("n"), total.alias("total"), F.min("label").alias("least"), F.max("label").alias("most")
    )


def keyed_runs(
    df: DataFrame,
    keys: Sequence[str],
    time_col: str,
    target: str,
    cutoffs: DataFrame,
    tie_break: Sequence[str] = (),
    *,
    bootstrap: bool = True,
    **params,
) -> KeyedRuns:
    """Train on every plant's rows up to each of its cut-off days, and predict the day after: all in one fit.

    ``cutoffs`` has the keys and ``day``. The runs are numbered, and the number is a feature whose steps in the label are
    larger than the whole range of the target: trees part the runs first, in as many levels as their number has bits,
    and go on inside each as if it were alone. What a run predicts is the mean target of its own rows in the leaf, so
    that no row of another plant, or after the cut-off, counts. The number of jobs does not depend on the runs; each
    row is trained on once per run that it belongs to, as with a fit of its own. NULL keys are a plant like any other;
    a day without rows has no predictions. MLlib's depth of 30 is shared with the levels that part the runs.

    Without ``bootstrap`` no split parts rows of a run that are equal in all features, and the gain of a split depends on
    their number and mean only: one row that counts as often gives the same tree. Where that at least halves many training
    rows, the rows are added up by day before they meet their runs, and none of them is repeated. ``df`` is read more than once.
    """
    keys = list(keys)
    asked = cutoffs.select(*keys, F.col("day").alias("cutoff")).distinct()
    runs = stored(global_positions(asked, [], [*keys, "cutoff"], "run"), "runs")
    features = columns_except(df, [*keys, time_col, *tie_break, target])
    value = column(target).cast("double")
    taken = {f: f"f{i}" for i, f in enumerate(features)}
    columns = [null_if_nan(f).alias(name) for f, name in taken.items()]
    rows = df.select(*keys, time_col, value.alias("label"), *columns)
    days = stored(_by_day(rows, keys, time_col, [] if bootstrap else [*taken.values()]), "run-sums")
    bounds = _of_runs(days, runs, keys, "_day", None, 0).groupBy("run")
    extremes = [F.min("least").alias("least"), F.max("most").alias("most")]
    bounds = stored(bounds.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("sums"), *extremes), "run-bounds")
    n_rows, n_sums, least, most = bounds.agg(F.sum("n"), F.sum("sums"), F.min("least"), F.max("most")).first()
    if least is None:
        raise ValueError("There are no training rows.")
    if not bootstrap and n_rows > ALIKE_FROM and 2 * n_sums <= n_rows:
        alike = ["run", *taken.values()]
        sums = _of_runs(days, runs, keys, "_day", None, 0).groupBy(*alike).agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        sums = stored(sums, "run-rows")
        # Means of many rows lie close together. Each run's are taken by their range around the run's own mean, which leaves its
        # splits as they are, and a run is known by the bits of its number, a step each: sums then hold a few steps only.
        mean = F.col("total") / F.col("n")
        centres = sums.groupBy("run").agg((F.sum("total") / F.sum("n")).alias("centre"), (F.max(mean) - F.min(mean)).alias("spread"))
        label = F.when(F.col("spread") > 0, (mean - F.col("centre")) / F.col("spread")).otherwise(F.lit(0.0))
        learned = sums.join(centres, "run").withColumn("label", label)
        training = dealt_by_content(learned, [*taken.values(), "run"])
        n_bits = max(1, (runs.count() - 1).bit_length())
        bits = [F.shiftright("run", i).bitwiseAND(F.lit(1)).cast("double") for i in range(n_bits)]
        shifted = sum(((bit - 0.5) * (4 + 4 * i / n_bits) for i, bit in enumerate(bits)), F.col("label"))
        row = array_to_vector(F.array(*bits, *[F.col(c) for c in taken.values()])).alias(_VECTOR)
        estimator = forest("_label", _VECTOR, bootstrap=False, weight="n", **params)
        model = fit_rows(estimator, training.select(row, shifted.alias("_label"), F.col("n").cast("double").alias("n")))
        own = with_leaves(model, sums.select("run", "n", "total", row))
        table = stored(own.groupBy("run", "tree", "leaf").agg((F.sum("total") / F.sum("n")).alias("mean")), "run-leaves")
        # A run's day after has a sum for each of the rows that differ.
        following = _of_runs(days, runs, keys, "_day", 1, 1)
        passed = with_leaves(model, following.select(*alike, row)).join(table, ["run", "tree", "leaf"])
        predicted = stored(passed.groupBy(*alike).agg(F.avg("mean").alias("power_pred")), "run-predictions")
        scored = null_safe_join(_of_runs(rows, runs, keys, time_col, 1, 1), predicted, alike)
    else:
        rows = stored(rows, "run-rows")
        # Two digits, so that a split can part any two runs however many there are.
        digits = [F.floor(F.col("run") / FOREST_BINS).cast("double"), (F.col("run") % FOREST_BINS).cast("double")]
        row = array_to_vector(F.array(*digits, *[F.col(c) for c in taken.values()])).alias(_VECTOR)
        # Centred, so that sums of squares keep as many digits of the target itself as they can.
        step, middle = 2 * (most - least) + 1, (runs.count() - 1) / 2
        shifted = F.col("label") - (most + least) / 2 + (F.col("run") - middle) * step
        # The rows are dealt before they are repeated for their runs, so that a task never holds more than its share of the repeats.
        dealt = rows.repartition(tasks_for(n_rows, RUN_TASK_ROWS), time_col, "label", *taken.values())
        learned = _of_runs(dealt, runs, keys, time_col, None, 0).select("run", "label", *taken.values())
        training = dealt_by_content(learned, [*taken.values(), "label", "run"], n_rows=n_rows)
        model = fit_rows(forest("_label", _VECTOR, bootstrap=bootstrap, **params), training.select(row, shifted.alias("_label")))
        own = with_leaves(model, learned.select("run", "label", row))
        table = stored(own.groupBy("run", "tree", "leaf").agg(F.avg("label").alias("mean")), "run-leaves")
        following = _of_runs(rows, runs, keys, time_col, 1, 1)
        following = stored(following.withColumn("_row", F.monotonically_increasing_id()), "run-days")
        # Dealt by row once: neither the sums nor the join has to move them again, and a task holds a fixed number of them.
        following = following.repartition(tasks_for(following.count(), FOREST_TASK_ROWS), "_row")
        passed = with_leaves(model, following.select("_row", "run", row)).join(table, ["run", "tree", "leaf"])
        predicted = passed.groupBy("_row").agg(F.avg("mean").alias("power_pred"))
        scored = following.join(predicted, "_row")
    scored = scored.select(
        *keys, "cutoff", F.col(time_col).alias("ts"), F.col("label").alias("actual"), clip_nonnegative("power_pred").alias("power_pred")
    )
    bounds = bounds.join(runs, "run").select(*keys, "cutoff", "least", "most")
    return KeyedRuns(runs, stored(scored, "run-scores"), bounds, model)


def keyed_frame(
    df: DataFrame, found: KeyedRuns, keys: Sequence[str], time_col: str, target: str, tie_break: Sequence[str] = ()
) -> DataFrame:
    """``(keys, cutoff, ts, series, value)``: the cut-off day, its trend, the day after as it happened, and as predicted."""
    keys = list(keys)
    rows = df.select(*keys, time_col, *tie_break, column(target).alias("_target"))
    # Only what the trend needs is moved and sorted: keys and cut-off come back with the run. Tasks follow the rows.
    today = _of_runs(rows, found.runs, keys, time_col, 0, 0).drop(*keys, "cutoff")
    today = today.repartition(tasks_for(found.scored.count()), "run")
    today = day_trailing_mean(today, ["run"], [time_col, *tie_break], "_target", "trend", DAY_TREND_ROWS).join(found.runs, "run")
    named = [*keys, "cutoff"]
    return (
        series_of(today, named, time_col, {"_target": "actual", "trend": "trend"})
        .unionByName(series_of(found.scored, named, "ts", {"actual": "next_day_actual"}))
        .unionByName(series_of(found.scored, named, "ts", {"power_pred": "prediction"}))
    )
