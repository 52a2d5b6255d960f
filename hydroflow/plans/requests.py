"""Load many unlike requests at once: each names its own station, parameter, frequency and window."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydroflow.config import FREQ_TO_TYPE
from hydroflow.functions import iso_instant
from hydroflow.operators.catalog import resolve_stations
from hydroflow.operators.positions import null_safe_join
from hydroflow.session import stored
from hydroflow.sinks.series import write_series

#: Width of the time bins on which windows and rows meet.
BIN_DAYS = 16
_BIN_SECONDS = BIN_DAYS * 86400


@dataclass(frozen=True)
class RequestLoad:
    """``rows``: request_id, param, station_id, station, freq, unit, ts, result; a row that lies in the windows of several
    requests is there for each. ``status``: request_id, status, thing_id, datastream_id, n_obs."""

    rows: DataFrame
    status: DataFrame

    def write(self, path: str, fmt: str = "parquet") -> None:
        """Write every series once: of requests for one series the last one (largest request_id) replaces the others."""
        series = ["param", "station_id", "freq"]
        last = self.rows.groupBy(*series).agg(F.max("request_id").alias("request_id"))
        write_series(null_safe_join(self.rows, last, [*series, "request_id"], "left_semi").drop("request_id"), path, fmt)


def _types() -> Column:
    return F.create_map(*[F.lit(x) for pair in FREQ_TO_TYPE.items() for x in pair])


def unknown_requests(requests: DataFrame, datastreams: DataFrame) -> DataFrame:
    """``(request_id, status)`` of requests that cannot be met whatever the data: ``incomplete`` where station or window is
    missing, ``bad_frequency`` and ``bad_parameter`` where these are none that the catalogue knows. One status each."""
    spark = requests.sparkSession
    labels = spark.createDataFrame([(label,) for label in FREQ_TO_TYPE], "freq string")
    parameters = datastreams.filter(F.contains("name", F.lit("@"))).select(F.substring_index("name", "@", 1).alias("param")).distinct()
    empty = F.lit(False)
    for c in ("text", "start", "end"):
        empty = empty | (F.coalesce(F.trim(c), F.lit("")) == "")
    found = [
        requests.filter(empty).select("request_id", F.lit(1).alias("at")),
        requests.join(labels, "freq", "left_anti").select("request_id", F.lit(2).alias("at")),
        requests.join(parameters, "param", "left_anti").select("request_id", F.lit(3).alias("at")),
    ]
    names = F.array(*[F.lit(n) for n in ("incomplete", "bad_frequency", "bad_parameter")])
    first = found[0].unionByName(found[1]).unionByName(found[2]).groupBy("request_id").agg(F.min("at").alias("at"))
    return first.select("request_id", F.element_at(names, F.col("at")).alias("status"))


def match_requests(asked: DataFrame, datastreams: DataFrame) -> DataFrame:
    """``(thing_id, param, freq, datastream_id, unit)``: of each station, parameter and frequency the datastream of the
    smallest id. ``asked`` has the station, parameter and frequency of the requests."""
    wanted = asked.filter("thing_id is not null").select("thing_id", "param", "freq").distinct()
    wanted = wanted.withColumn("type", F.element_at(_types(), F.col("freq")))
    named = datastreams.filter(F.contains("name", F.lit("@"))).select(
        "iot_id", "thing_id", "type", F.substring_index("name", "@", 1).alias("param")
    )
    first = named.join(wanted, ["thing_id", "param", "type"]).groupBy("thing_id", "param", "freq").agg(F.min("iot_id").alias("datastream_id"))
    units = datastreams.select(F.col("iot_id").alias("datastream_id"), F.coalesce("unit", F.lit("")).alias("unit"))
    return first.join(units, "datastream_id").select("thing_id", "param", "freq", "datastream_id", "unit")


def rows_in_windows(obs: DataFrame, windows: DataFrame) -> DataFrame:
    """Rows of ``obs`` with every window (request_id, datastream_id, from_ts, to_ts) that holds them, both ends included.

    Windows and rows meet in an equi-join on the datastream and a bin of time, then the ends decide. A window costs one row
    per bin that it touches, and a long series is spread over its bins.
    """

    def bin_of(ts: Column) -> Column:
        return F.floor(F.unix_seconds(ts.cast("timestamp")) / _BIN_SECONDS)

    span = F.sequence(bin_of(F.col("from_ts")), bin_of(F.col("to_ts")))
    binned = windows.filter(F.col("from_ts") <= F.col("to_ts")).withColumn("bin", F.explode(span))
    placed = obs.withColumn("bin", bin_of(F.col("ts")))
    return placed.join(binned, ["datastream_id", "bin"]).filter(F.col("ts").between(F.col("from_ts"), F.col("to_ts"))).drop("bin")


def bulk_requests(requests: DataFrame, things: DataFrame, datastreams: DataFrame, obs: DataFrame) -> RequestLoad:
    """Load every row of ``requests`` (request_id, text, param, freq, start, end): the rows found and each one's status.

    Ends are ISO text, both included; a bare date means its midnight. A window whose end lies before its start holds
    nothing. The status is ``loaded`` or where the chain broke off: ``incomplete``, ``bad_frequency``, ``bad_parameter``,
    ``no_station``, ``no_datastream``, ``no_data``. Request ids are unique. No requests: no rows.
    """
    kind = dict(obs.dtypes)["ts"]
    refused = stored(unknown_requests(requests, datastreams), "refused-requests")
    good = requests.join(refused, "request_id", "left_anti")
    named = stored(good.join(resolve_stations(good.select("text"), things), "text"), "named-requests")
    matched = named.join(match_requests(named, datastreams), ["thing_id", "param", "freq"], "left")
    ends = {"from_ts": "start", "to_ts": "end"}
    matched = stored(matched.withColumns({name: iso_instant(c).try_cast(kind) for name, c in ends.items()}), "matched-requests")
    windows = matched.filter("datastream_id is not null and from_ts is not null and to_ts is not null")
    rows = rows_in_windows(obs, windows.select("request_id", "datastream_id", "from_ts", "to_ts"))
    held = stored(rows.groupBy("request_id").agg(F.count(F.lit(1)).alias("n_obs")), "request-counts")
    status = (
        F.when(F.col("thing_id").isNull(), "no_station")
        .when(F.col("datastream_id").isNull(), "no_datastream")
        .when(F.col("from_ts").isNull() | F.col("to_ts").isNull(), "incomplete")
        .when(F.col("n_obs").isNull(), "no_data")
        .otherwise("loaded")
    )
    outcome = matched.join(held, "request_id", "left").select(
        "request_id", status.alias("status"), "thing_id", "datastream_id", F.coalesce("n_obs", F.lit(0)).alias("n_obs")
    )
    nothing = refused.select("request_id", "status", *[F.lit(None).cast("bigint").alias(c) for c in ("thing_id", "datastream_id")], F.lit(0).cast("bigint").alias("n_obs"))
    series = windows.select("request_id", "param", F.col("thing_id").alias("station_id"), "station", "freq", "unit")
    return RequestLoad(
        rows.join(series, "request_id").select("request_id", "param", "station_id", "station", "freq", "unit", "ts", "result"),
        outcome.unionByName(nothing),
    )
