"""Questions over observations: ``(datastream_id, ts, result[, tie-break])``, many series at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from hydroflow.config import EXCEEDANCE_ROWS, SAMPLE_ROWS
from hydroflow.functions import iso_instant

_SERIES = "datastream_id"


def in_range(obs: DataFrame, start: str, end: str, time_col: str = "ts") -> DataFrame:
    """Rows between two ISO times, both included. A bare date means its midnight, also at the end.

    The bounds are constants of the column's own type, so the range reaches the file scan.
    """
    if not start or not end:
        raise ValueError("A window needs both its ends.")
    kind = dict(obs.dtypes)[time_col]
    return obs.filter(F.col(time_col).between(*(iso_instant(F.lit(edge)).cast(kind) for edge in (start, end))))


def with_unit(obs: DataFrame, datastreams: DataFrame) -> DataFrame:
    """Attach name and unit of the datastream to each observation.

    No hint: the catalogue is broadcast when its size is below the session's threshold, otherwise the sorted
    join splits hot series at run time (adaptive skew join).
    """
    names = datastreams.select(
        F.col("iot_id").alias(_SERIES), F.col("name").alias("datastream"), F.coalesce("unit", F.lit("")).alias("unit")
    )
    return obs.join(names, _SERIES)


def _edge_rows(obs: DataFrame, n: int, ascending: bool, tie_break: str) -> DataFrame:
    """First or last ``n`` rows per series. The rank limit runs per task before the shuffle."""
    order = [F.col(c).asc() if ascending else F.col(c).desc() for c in ("ts", tie_break)]
    ranked = obs.withColumn("rank", F.row_number().over(W.partitionBy(_SERIES).orderBy(*order)))
    return ranked.filter(F.col("rank") <= n)


def series_summary(obs: DataFrame) -> DataFrame:
    """Row count and available time range per series."""
    return obs.groupBy(_SERIES).agg(
        F.count(F.lit(1)).alias("n_obs"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )


def inspect_series(obs: DataFrame, datastreams: DataFrame) -> DataFrame:
    """Attributes of every datastream with its row count and time range; series without rows count zero."""
    attributes = datastreams.select(
        F.col("iot_id").alias(_SERIES),
        F.col("name").alias("datastream"),
        *[
            F.coalesce(c, F.lit("")).alias(c)
            for c in ("unit", "type", "parameter", "station_id", "measurement_start")
        ],
        F.coalesce("phenomenon_time", F.lit("unknown")).alias("phenomenon_time"),
    )
    return attributes.join(series_summary(obs), _SERIES, "left").na.fill({"n_obs": 0})


def sample_series(obs: DataFrame, datastreams: DataFrame, n: int = SAMPLE_ROWS, tie_break: str = "obs_id") -> DataFrame:
    """The first and the last ``n`` observations of each series with their unit."""
    first = _edge_rows(obs, n, True, tie_break).withColumn("edge", F.lit("first"))
    last = _edge_rows(obs, n, False, tie_break).withColumn("edge", F.lit("last"))
    return with_unit(first.unionByName(last), datastreams)


def latest(obs: DataFrame, datastreams: DataFrame, tie_break: str | None = None) -> DataFrame:
    """The most recent observation of each series with name and unit.

    Give a tie-break where a series may hold several rows of the same time. Both aggregations are over plain
    numbers and stay hash aggregates: first the newest time, then the largest tie-break among its rows.
    """
    newest = obs.groupBy(_SERIES).agg(F.max("ts").alias("ts"))
    there = obs.join(newest, [_SERIES, "ts"])
    by = "ts" if tie_break is None else tie_break
    picked = there.groupBy(_SERIES, "ts").agg(F.max_by("result", by).alias("result"))
    return with_unit(picked, datastreams)


def exceedances(
    obs: DataFrame,
    datastreams: DataFrame,
    threshold: float,
    above: bool = True,
    sample: int = EXCEEDANCE_ROWS,
    tie_break: str = "obs_id",
) -> DataFrame:
    """Rows strictly above (or below) a threshold: the first ``sample`` per series next to the total count.

    The count and the sample are two passes: both shrink before their shuffle, which a count over the
    whole group next to a rank would not.
    """
    result = F.col("result")
    hits = obs.filter((result > threshold) if above else (result < threshold))
    total = hits.groupBy(_SERIES).agg(F.count(F.lit(1)).alias("total"))
    return with_unit(_edge_rows(hits, sample, True, tie_break).join(total, _SERIES), datastreams)


def load_status(resolved: DataFrame, matched: DataFrame, obs: DataFrame) -> DataFrame:
    """Outcome per requested station text: loaded, or where the chain broke off.

    ``resolved`` maps each requested text to its station or NULL, ``matched`` stations to their datastream,
    ``obs`` holds the rows of the wanted window. Rows are counted before any join, so a hot series is one
    row here.
    """
    rows = obs.groupBy(_SERIES).agg(F.count(F.lit(1)).alias("n_obs"))
    chain = resolved.join(matched.select("thing_id", _SERIES), "thing_id", "left").join(rows, _SERIES, "left")
    status = (
        F.when(F.col("thing_id").isNull(), F.lit("no_station"))
        .when(F.col(_SERIES).isNull(), F.lit("no_datastream"))
        .when(F.col("n_obs").isNull(), F.lit("no_data"))
        .otherwise(F.lit("loaded"))
    )
    return chain.select("text", "thing_id", _SERIES, F.coalesce("n_obs", F.lit(0)).alias("n_obs"), status.alias("status"))


def missing(status: DataFrame) -> DataFrame:
    return status.filter(F.col("status") != "loaded")


def count_status(status: DataFrame) -> DataFrame:
    """How many stations were loaded and how many are missing, per reason."""
    return status.groupBy("status").agg(F.count(F.lit(1)).alias("n"))

