"""Feature selection, as-of splits and guards. Column lists are resolved while the plan is built."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from hydroflow.config import PLANT_TARGETS, ForecastConfig
from hydroflow.functions import day_of
from hydroflow.functions.numbers import column
from hydroflow.operators.moving import trailing_mean
from hydroflow.operators.positions import null_safe_join


def prefixed_columns(df: DataFrame, prefix: str) -> list[str]:
    """Columns whose name starts with the prefix, in table order."""
    return [c for c in df.columns if c.startswith(prefix)]


def columns_except(df: DataFrame, excluded: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in set(excluded)]


def check_features(found: Sequence[str], expected: Sequence[str]) -> None:
    """Refuse data whose feature columns, in order, are not those of the fitted model."""
    if list(found) != list(expected):
        raise ValueError(
            f"Feature columns differ from the fitted model. expected: {list(expected)} found: {list(found)}"
        )


def plant_target(plant: str) -> str:
    """Target column of a plant."""
    if plant not in PLANT_TARGETS:
        raise ValueError(f"Plant must be one of: {', '.join(PLANT_TARGETS)}")
    return PLANT_TARGETS[plant]


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows with a NULL or NaN in any column."""
    return df.na.drop("any")


def build_features(
    wide: DataFrame,
    config: ForecastConfig,
    keys: Sequence[str],
    tie_break: Sequence[str] = (),
) -> tuple[DataFrame, list[str]]:
    """Prefix columns as doubles, then the trailing mean of the target as the last feature.

    Returns the frame ``(keys, time, target, features…)`` and the ordered feature list. Frames look back only,
    so a row's features never depend on later rows.
    """
    names = prefixed_columns(wide, config.feature_prefix)
    time_col, target = config.time_col, config.target_col
    base = wide.select(
        *keys,
        time_col,
        *tie_break,
        column(target).cast("double").alias(target),
        *[column(c).cast("double").alias(c) for c in names],
    )
    if config.ma_hours > 0:
        base = trailing_mean(base, keys, [time_col, *tie_break], target, config.ma_rows, config.ma_col)
        names = [*names, config.ma_col]
    return base.select(*keys, time_col, *tie_break, target, *[column(c) for c in names]), names


def _midnight(day: date) -> datetime:
    return datetime.combine(day, time())


def history_until(df: DataFrame, time_col: str, cutoff: date) -> DataFrame:
    """All rows up to the end of the cut-off day; a bound on the time column itself, so scans prune by it."""
    kind = dict(df.dtypes)[time_col]
    return df.filter(F.col(time_col) < F.lit(_midnight(cutoff + timedelta(days=1)).isoformat(" ")).cast(kind))


def rows_of_day(df: DataFrame, time_col: str, day: date) -> DataFrame:
    """Rows of one calendar day; empty when the day has none."""
    kind = dict(df.dtypes)[time_col]
    start, end = (F.lit(_midnight(d).isoformat(" ")).cast(kind) for d in (day, day + timedelta(days=1)))
    return df.filter((F.col(time_col) >= start) & (F.col(time_col) < end))


def rows_after(df: DataFrame, time_col: str, cutoff: date) -> DataFrame:
    """Rows of the calendar day after the cut-off."""
    return rows_of_day(df, time_col, cutoff + timedelta(days=1))


def valid_cutoffs(df: DataFrame, time_col: str, keys: Sequence[str] = ()) -> DataFrame:
    """Dates that may serve as cut-off: all present dates but the last one of each plant.

    The window runs over distinct dates, one row per plant and day.
    """
    days = df.select(*keys, day_of(time_col).alias("day")).distinct()
    later = F.lead("day").over(W.partitionBy(*keys).orderBy("day"))
    return days.withColumn("_later", later).filter(F.col("_later").isNotNull()).drop("_later")


def default_cutoff(df: DataFrame, time_col: str, keys: Sequence[str] = ()) -> DataFrame:
    """The latest valid cut-off of each plant."""
    return valid_cutoffs(df, time_col, keys).groupBy(*keys).agg(F.max("day").alias("day"))


def rows_at(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], cutoffs: DataFrame
) -> DataFrame:
    """The first row at each ``(keys, cutoff)``; cut-offs absent from the data keep NULLs and are flagged. A NULL key is a
    group like any other.

    The rank limit runs before the shuffle, so repeated times do not pile up.
    """
    time_col = order[0]
    at = null_safe_join(df.withColumnRenamed(time_col, "cutoff"), cutoffs, [*keys, "cutoff"])
    rank = F.row_number().over(W.partitionBy(*keys, "cutoff").orderBy(*[F.col(c) for c in order[1:]] or [F.lit(1)]))
    first = at.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank").withColumn("found", F.lit(True))
    return null_safe_join(cutoffs, first, [*keys, "cutoff"], "left").na.fill({"found": False})
