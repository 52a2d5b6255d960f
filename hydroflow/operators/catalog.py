"""Catalogue questions over stations, datastreams and locations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from hydroflow.config import FREQ_TO_TYPE
from hydroflow.operators.names import resolve_names

THING_DEFAULTS = {"description": "", "station_id": ""}


def _capped(df: DataFrame, limit: int | None) -> DataFrame:
    return df if limit is None else df.limit(limit)


def _station_rows(things: DataFrame) -> DataFrame:
    return things.select("iot_id", "name", "description", "station_id").na.fill(THING_DEFAULTS)


def list_stations(things: DataFrame, limit: int | None = None) -> DataFrame:
    """Stations by name; ``limit`` is the caller's cap and plans a top-k."""
    return _capped(_station_rows(things).orderBy("name", "iot_id"), limit)


def search_stations(things: DataFrame, text: str, ignore_case: bool = False, limit: int | None = None) -> DataFrame:
    """Stations whose name contains ``text``; case matters unless ``ignore_case``."""
    if not text:
        raise ValueError("A station text is required.")
    name, needle = (F.lower("name"), text.lower()) if ignore_case else (F.col("name"), text)
    return _capped(_station_rows(things).filter(name.contains(needle)).orderBy("iot_id"), limit)


def find_station(things: DataFrame, text: str) -> DataFrame:
    """The first station (smallest id) whose name contains ``text`` in any case; no row if there is none."""
    return search_stations(things, text, ignore_case=True, limit=1)


def resolve_stations(requested: DataFrame, things: DataFrame) -> DataFrame:
    """For each distinct text the station :func:`find_station` would pick, NULL where there is none."""
    return resolve_names(requested, things)


def type_of(freq: str) -> str:
    """Stored datastream type of a frequency label."""
    if freq not in FREQ_TO_TYPE:
        raise ValueError(f"Frequency must be one of: {', '.join(FREQ_TO_TYPE)}")
    return FREQ_TO_TYPE[freq]


def list_datastreams(things: DataFrame, datastreams: DataFrame) -> DataFrame:
    """Datastreams with their station; missing attributes show their defaults."""
    named = datastreams.withColumnRenamed("iot_id", "datastream_id").withColumnRenamed("name", "datastream")
    return named.join(
        things.select(F.col("iot_id").alias("thing_id"), F.col("name").alias("station")), "thing_id"
    ).select(
        "thing_id",
        "station",
        "datastream_id",
        "datastream",
        F.coalesce("unit", F.lit("")).alias("unit"),
        F.coalesce("type", F.lit("")).alias("type"),
        F.coalesce("phenomenon_time", F.lit("no data")).alias("phenomenon_time"),
    )


def match_datastreams(datastreams: DataFrame, parameter: str, freq: str) -> DataFrame:
    """Per station the datastream named ``<parameter>@…`` of the wanted frequency; smallest id if several."""
    wanted = datastreams.filter(
        F.startswith("name", F.lit(f"{parameter}@")) & (F.col("type") == type_of(freq))
    )
    # Plain numbers only, so that it stays a hash aggregate; ids are unique.
    picked = wanted.groupBy("thing_id").agg(F.min("iot_id").alias("iot_id"))
    return wanted.join(picked, ["thing_id", "iot_id"]).select(
        "thing_id", F.col("iot_id").alias("datastream_id"), F.col("name").alias("datastream"), "unit", "phenomenon_time"
    )


def _count_by(datastreams: DataFrame, attribute: str) -> DataFrame:
    label: Column = F.coalesce(F.col(attribute), F.lit("unknown")).alias(attribute)
    counts = datastreams.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), attribute)


def count_by_type(datastreams: DataFrame) -> DataFrame:
    """Datastreams per type, most common first."""
    return _count_by(datastreams, "type")


def count_by_parameter(datastreams: DataFrame) -> DataFrame:
    """Datastreams per parameter, most common first."""
    return _count_by(datastreams, "parameter")


def station_frequencies(datastreams: DataFrame) -> DataFrame:
    """Datastreams of each station under their frequency, in order.

    One row per datastream: a station with very many is never gathered into one value.
    """
    return datastreams.select(
        "thing_id",
        F.coalesce("type", F.lit("unknown")).alias("freq_type"),
        F.col("iot_id").alias("datastream_id"),
        F.col("name").alias("datastream"),
        F.coalesce("unit", F.lit("")).alias("unit"),
        F.coalesce("phenomenon_time", F.lit("no data")).alias("phenomenon_time"),
    ).orderBy("thing_id", "freq_type", "datastream_id")


def station_locations(things: DataFrame, locations: DataFrame) -> DataFrame:
    """Coordinates and GeoJSON of each station; coordinates are NULL where the list is empty."""
    placed = locations.select(
        "thing_id",
        F.get("coordinates", F.lit(0)).alias("lon"),
        F.get("coordinates", F.lit(1)).alias("lat"),
        F.to_json(F.struct(F.col("geo_type").alias("type"), "coordinates")).alias("geojson"),
    )
    return placed.join(things.select(F.col("iot_id").alias("thing_id"), "name"), "thing_id")


def stations_in_box(
    things: DataFrame,
    locations: DataFrame,
    lon_min: float,
    lat_min: float,
    lon_max: float,
    lat_max: float,
    limit: int | None = None,
) -> DataFrame:
    """Stations with a location inside the box (edges excluded), each once, by name."""
    lon, lat = F.get("coordinates", F.lit(0)), F.get("coordinates", F.lit(1))
    inside = locations.filter((lon > lon_min) & (lon < lon_max) & (lat > lat_min) & (lat < lat_max))
    ids = inside.select(F.col("thing_id").alias("iot_id")).distinct()
    return list_stations(things.join(ids, "iot_id", "left_semi"), limit)


def last_by_name(things: DataFrame, ingest_order: str, attributes: Sequence[str] | None = None) -> DataFrame:
    """One row per name with its attributes (all other columns unless given, so all properties); the last one loaded wins.

    Each task passes on one row of a name at most. Of rows of one name and order the one of the smallest content hash counts.
    """
    attributes = [c for c in things.columns if c not in ("name", ingest_order)] if attributes is None else attributes
    content = F.xxhash64(*[F.to_json(F.struct(c)) for c in attributes])
    newest = W.partitionBy("name").orderBy(F.desc(ingest_order), content)
    return things.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").select("name", *attributes)
