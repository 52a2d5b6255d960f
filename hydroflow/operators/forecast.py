"""Multi-step forecasts from history: one look-back per cut-off, one value per future step."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace
from datetime import date, datetime, time, timedelta

from pyspark.errors import AnalysisException
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hydroflow.config import ForecastConfig
from hydroflow.functions import day_of, forecast_index, launch_time, step_interval
from hydroflow.operators.features import build_features, check_features
from hydroflow.operators.forest import dealt_by_content, fit_rows, forest
from hydroflow.operators.lookback import lookback
from hydroflow.operators.positions import null_safe_join
from hydroflow.session import stored
from hydroflow.sources.tables import read_wide

_VECTOR = "_features"


@dataclass(frozen=True)
class ForecastBundle:
    """A fitted model with the settings it was fitted under.

    One model takes the step number as its last feature. With one model per step, ``models`` has
    ``horizon_steps`` entries, in step order.
    """

    models: tuple[RandomForestRegressionModel, ...]
    config: ForecastConfig
    keys: tuple[str, ...] = ()


def daily_cutoffs(features: DataFrame, config: ForecastConfig, keys: Sequence[str]) -> DataFrame:
    """The launch time of every day that has rows, per plant."""
    days = features.select(*keys, day_of(config.time_col).alias("day")).distinct()
    return days.select(*keys, launch_time("day", config.demo_hour).alias("cutoff"))


def _stepped(lookbacks: DataFrame, config: ForecastConfig, keys: Sequence[str], step: int | None = None) -> DataFrame:
    """Usable look-backs with the future times they are asked for: all steps of the horizon, or only one."""
    usable = lookbacks.filter(F.col("status") == "ok")
    if step is not None:
        at = F.col("cutoff") + step_interval(config.steps_per_hour) * F.lit(step)
        return usable.select(*keys, "cutoff", "lookback", F.lit(step).alias("step"), at.alias("ts"))
    index = forecast_index("cutoff", config.horizon_steps, config.steps_per_hour)
    timed = usable.select(*keys, "cutoff", "lookback", F.posexplode(index).alias("_at", "ts"))
    return timed.select(*keys, "cutoff", "lookback", (F.col("_at") + 1).alias("step"), "ts")


def _vector(per_step: bool) -> Column:
    row = F.col("lookback") if per_step else F.concat("lookback", F.array(F.col("step").cast("double")))
    return array_to_vector(row).alias(_VECTOR)


def training_rows(
    lookbacks: DataFrame,
    features: DataFrame,
    config: ForecastConfig,
    keys: Sequence[str],
    until: datetime | None = None,
    step: int | None = None,
) -> DataFrame:
    """Look-backs with the target at each future step (or at one step) that is present in the data.

    With ``until`` only targets up to that time are used, so a model launched then has not seen the future.
    """
    time_col = config.time_col
    targets = features.select(
        *keys, F.col(time_col).alias("ts"), F.col(config.target_col).alias("label")
    ).filter(F.col("label").isNotNull())
    if until is not None:
        targets = targets.filter(F.col("ts") <= F.lit(until.isoformat(" ")).cast(dict(targets.dtypes)["ts"]))
    return null_safe_join(_stepped(lookbacks, config, keys, step), targets, [*keys, "ts"])


def fit_multistep(
    lookbacks: DataFrame,
    features: DataFrame,
    config: ForecastConfig,
    keys: Sequence[str],
    until: datetime | None = None,
    per_step: bool = False,
    **params,
) -> ForecastBundle:
    """One model over all steps, or one model per step.

    The single model repeats each look-back ``horizon_steps`` times; one model per step keeps each training
    set at one row per cut-off and is the choice for long horizons on large histories. Trainers read their
    rows several times: pass look-backs and features as stored tables.
    """
    steps = range(1, config.horizon_steps + 1) if per_step else [None]
    models = []
    for step in steps:
        rows = training_rows(lookbacks, features, config, keys, until, step)
        # Dealt by content, as for every forest: the model does not depend on cores or files.
        dealt = dealt_by_content(rows, ["lookback", "step", "label"])
        models.append(fit_rows(forest("label", _VECTOR, **params), dealt.select(_vector(per_step), "label")))
    return ForecastBundle(tuple(models), config, tuple(keys))


def train_forecast(
    wide: DataFrame,
    config: ForecastConfig,
    keys: Sequence[str],
    cutoffs: DataFrame | None = None,
    tie_break: Sequence[str] = (),
    until: datetime | None = None,
    per_step: bool = False,
    **params,
) -> ForecastBundle:
    """From the wide table to a fitted bundle; by default every day's launch time is a training cut-off."""
    features, names = build_features(wide, config, keys, tie_break)
    features = stored(features, "features")
    config = replace(config, feature_cols=tuple(names))
    asked = daily_cutoffs(features, config, keys) if cutoffs is None else cutoffs
    order = [config.time_col, *tie_break]
    windows = stored(lookback(features, keys, order, names, asked, config.window_steps), "lookbacks")
    return fit_multistep(windows, features, config, keys, until, per_step, **params)


def forecast_from_history(lookbacks: DataFrame, bundle: ForecastBundle, keys: Sequence[str]) -> DataFrame:
    """``(keys, cutoff, step, ts, power_pred)`` for every usable look-back; no value is clipped.

    The first time is one step after the cut-off and each cut-off gives ``horizon_steps`` rows.
    """
    config, out = bundle.config, [*keys, "cutoff", "step", "ts", "power_pred"]
    if len(bundle.models) == 1:
        stepped = _stepped(lookbacks, config, keys)
        return bundle.models[0].transform(stepped.withColumn(_VECTOR, _vector(False))).select(*out)
    # One column per model over one scan of the look-backs, then a row per step.
    scored = lookbacks.filter(F.col("status") == "ok").withColumn(_VECTOR, _vector(True))
    for step, model in enumerate(bundle.models, start=1):
        scored = model.copy({model.predictionCol: f"_step_{step}"}).transform(scored)
    times = forecast_index("cutoff", config.horizon_steps, config.steps_per_hour)
    values = [
        F.struct(F.lit(step).alias("step"), F.get(times, F.lit(step - 1)).alias("ts"), F.col(f"_step_{step}").alias("power_pred"))
        for step in range(1, len(bundle.models) + 1)
    ]
    return scored.select(*keys, "cutoff", F.inline(F.array(*values))).select(*out)


def forecast_cutoffs(
    wide: DataFrame,
    bundle: ForecastBundle,
    cutoffs: DataFrame,
    keys: Sequence[str],
    tie_break: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Forecast many cut-offs in one job: the forecasts, and the status of every cut-off asked for."""
    config = bundle.config
    features, names = build_features(wide, config, keys, tie_break)
    check_features(names, config.feature_cols)
    windows = lookback(features, keys, [config.time_col, *tie_break], names, cutoffs, config.window_steps)
    return forecast_from_history(windows, bundle, keys), windows.select(*keys, "cutoff", "status", "n_rows")


def predict_for_date(
    spark: SparkSession, day: date | datetime | str, path: str, source: str | None = None, **where
) -> DataFrame:
    """Forecast launched at the model's hour of one day: ``(ts, power_pred)``.

    ``source`` overrides the recorded table; ``where`` (``plant="A"``) selects one series of it. Raises where
    more than one series is left, the launch time is absent, the history is short or the feature columns differ.
    """
    bundle = load_bundle(spark, path)
    config = bundle.config
    wide = read_wide(spark, source or config.source)
    for key, value in where.items():
        wide = wide.filter(F.col(key) == value)
    kept = [k for k in bundle.keys if k in wide.columns]
    if kept and wide.select(*kept).distinct().limit(2).count() > 1:
        raise ValueError(f"The table holds several series; select one by {', '.join(kept)}.")
    if isinstance(day, str):
        day = datetime.fromisoformat(day)
    launch = datetime.combine(date(day.year, day.month, day.day), time()) + timedelta(hours=config.demo_hour)
    kind = dict(wide.dtypes)[config.time_col]
    at, now = F.col(config.time_col), F.lit(launch.isoformat(" ")).cast(kind)
    # One cut-off needs its own row and the rows its window and their means look back on: two top-k reads.
    needed = config.window_steps - 1 + max(config.ma_rows - 1, 0)
    past = wide.filter(at < now).orderBy(at.desc()).limit(needed).unionByName(wide.filter(at == now).limit(1))
    past = past.withColumn("_series", F.lit(0))
    cutoffs = spark.range(1).select(F.lit(0).alias("_series"), now.alias("cutoff"))
    forecast, status = forecast_cutoffs(past, bundle, cutoffs, ["_series"])
    state = status.first()
    if state["status"] == "no_cutoff":
        raise ValueError(f"Cut-off {launch} is not in the data.")
    if state["status"] == "short_history":
        raise ValueError(f"The window of {launch} has {state['n_rows']} of {config.window_steps} rows.")
    if state["status"] != "ok":
        raise ValueError(f"The history before {launch} has missing values.")
    return forecast.select("ts", "power_pred").orderBy("ts")


def save_bundle(spark: SparkSession, bundle: ForecastBundle, path: str) -> None:
    """Write the models and one metadata row below ``path``, replacing what is there."""
    for i, model in enumerate(bundle.models):
        model.write().overwrite().save(f"{path}/models/{i}")
    meta = {**asdict(bundle.config), "n_models": len(bundle.models), "keys": bundle.keys}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").json(f"{path}/meta")


def load_bundle(spark: SparkSession, path: str) -> ForecastBundle:
    """Read a saved bundle; :class:`FileNotFoundError` if there is none."""
    try:
        row = spark.read.schema("meta string").json(f"{path}/meta").first()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"No saved forecast model at {path}.") from e
        raise
    meta = json.loads(row["meta"])
    models = tuple(RandomForestRegressionModel.load(f"{path}/models/{i}") for i in range(meta.pop("n_models")))
    keys = tuple(meta.pop("keys"))
    return ForecastBundle(models, ForecastConfig(**{**meta, "feature_cols": tuple(meta["feature_cols"])}), keys)
