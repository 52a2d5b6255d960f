"""Daily means, the join of daily series, and their correlation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from hydroflow.functions import day_of, null_if_nan, pearson
from hydroflow.functions.numbers import column
from hydroflow.functions.times import clock_in


def daily_mean(df: DataFrame, time_col: str, values: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Mean per calendar day; days without rows between the first and the last day appear with NULLs.

    The gaps are filled from each day's successor in the aggregated table, which has one row per key and
    day: rows are scanned and shuffled once, and only as partial sums.
    """
    means = df.groupBy(*keys, day_of(time_col).alias("day")).agg(
        *[F.avg(null_if_nan(v)).alias(v) for v in values]
    )
    following = F.lead("day").over(W.partitionBy(*keys).orderBy("day"))
    last_of_run = F.coalesce(F.date_sub(F.col("_next"), 1), F.col("day"))
    filled = means.filter(F.col("day").isNotNull()).withColumn("_next", following).select(
        *keys,
        F.col("day").alias("_from"),
        *[column(v) for v in values],
        F.explode(F.sequence(F.col("day"), last_of_run)).alias("day"),
    )
    own = F.col("day") == F.col("_from")
    return filled.select(*keys, "day", *[F.when(own, column(v)).alias(v) for v in values])


def zone_free(df: DataFrame, time_col: str, zone: str | None = None) -> DataFrame:
    """The same rows with a time column without zone, so that days of both sides of a join are days of one clock.

    Instants are read on the clock of ``zone`` and refused where none is given; times without zone stay as they are.
    """
    kind = dict(df.dtypes)[time_col]
    if kind == "timestamp" and zone is None:
        raise ValueError(f"{time_col} holds instants: a zone is required to tell their days.")
    return df.withColumn(time_col, clock_in(time_col, zone)) if kind == "timestamp" else df


def join_daily(left: DataFrame, right: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Inner equi-join of two daily series on the day. Both sides must carry a zone-free date."""
    for side in (left, right):
        kind = dict(side.dtypes)["day"]
        if kind != "date":
            raise ValueError(f"Daily series join on dates, found day of type {kind}.")
    return left.join(right, [*keys, "day"], "inner")


def correlations(
    df: DataFrame, pairs: Sequence[tuple[str, str, str]], keys: Sequence[str] = ()
) -> DataFrame:
    """One aggregation for all ``(left, right, name)`` pairs."""
    return df.groupBy(*keys).agg(*[pearson(x, y).alias(name) for x, y, name in pairs])
