"""Load the wanted series of many stations at once, tolerating the ones that cannot be found."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydroflow.functions import series_name
from hydroflow.operators.catalog import match_datastreams, resolve_stations
from hydroflow.operators.observations import in_range, load_status
from hydroflow.sinks.series import export_csv, write_series


@dataclass(frozen=True)
class BulkLoad:
    """``rows`` are the found series ready to be written, ``status`` the outcome per requested station."""

    rows: DataFrame
    status: DataFrame

    def write(self, path: str, fmt: str = "parquet") -> None:
        write_series(self.rows, path, fmt)


def bulk_load(
    requested: DataFrame,
    things: DataFrame,
    datastreams: DataFrame,
    obs: DataFrame,
    param: str,
    freq: str,
    start: str,
    end: str,
) -> BulkLoad:
    """Requested station texts → stations → datastreams of one parameter and frequency → rows of the window.

    The observations are joined to one row per series. Hot series are split by the adaptive skew join; their
    rows are never gathered per series.
    """
    resolved = resolve_stations(requested, things)
    matched = match_datastreams(datastreams, param, freq)
    window = in_range(obs, start, end)
    series = (
        resolved.filter(F.col("thing_id").isNotNull())
        .select("thing_id", "station")
        .distinct()
        .join(matched, "thing_id")
        .select("datastream_id", F.col("thing_id").alias("station_id"), "station", F.coalesce("unit", F.lit("")).alias("unit"))
    )
    rows = window.join(series, "datastream_id").select(
        F.lit(param).alias("param"), "station_id", "station", F.lit(freq).alias("freq"), "unit", "ts", "result"
    )
    return BulkLoad(rows, load_status(resolved, matched, window))


_REASONS = {
    "no_station": "no station has this text in its name",
    "no_datastream": "the station has no such datastream",
    "no_data": "the datastream has no rows in the window",
}


class LoadError(Exception):
    """A single series could not be loaded; the message says at which step."""


def load_one(
    station: str,
    param: str,
    freq: str,
    start: str,
    end: str,
    out_dir: str,
    things: DataFrame,
    datastreams: DataFrame,
    obs: DataFrame,
) -> str:
    """Load one series as CSV with the header ``phenomenonTime,<param>_<unit>`` and return its path.

    A bulk load of one request: its status says where the chain broke off, and only the found series is read.
    """
    if not station or not start or not end:
        raise ValueError("A load needs a station and both ends of its window.")
    spark = things.sparkSession
    load = bulk_load(spark.createDataFrame([(station,)], "text string"), things, datastreams, obs, param, freq, start, end)
    state = load.status.first()
    if state["status"] != "loaded":
        raise LoadError(f"{station!r}, {param!r}, {freq}: {_REASONS[state['status']]}")
    names = load.rows.select("station", "unit", series_name("param", "station", "freq").alias("name")).first()
    path = f"{out_dir}/{names['name']}.csv"
    export_csv(load.rows, path, param, names["unit"])
    return path
