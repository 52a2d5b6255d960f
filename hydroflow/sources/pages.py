"""Landed response pages: ``{"value": [entity, …], "@iot.count": n, "@iot.nextLink": …}``.

Pages are read as JSON lines (one page per line, so large files split) or, with ``multi_line``, as one
document per file. The parent id of a page is the field or the directory (``datastream_id=7301/``) the
lander wrote it to. All pages below a path are one scan, so following page links is the union of files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydroflow.functions import parse_instant
from hydroflow.schemas import DATASTREAMS_PAGE, LOCATIONS_PAGE, OBSERVATIONS_PAGE, THINGS_PAGE


def read_pages(spark: SparkSession, path: str, schema: str, multi_line: bool = False) -> DataFrame:
    """Page envelopes. A malformed page fails the read instead of vanishing."""
    return spark.read.schema(schema).option("multiLine", multi_line).option("mode", "FAILFAST").json(path)


def things_of(pages: DataFrame) -> DataFrame:
    """Flat stations; ``properties`` holds all of them as text."""
    thing = pages.select(F.inline("value"))
    return thing.select(
        F.col("`@iot.id`").alias("iot_id"), "name", "description", F.col("properties")["station_id"].alias("station_id"), "properties"
    )


def datastreams_of(pages: DataFrame) -> DataFrame:
    """Flat datastreams; the available range is also split into two instants."""
    ds = pages.select("thing_id", F.inline("value"))
    ends = F.split("phenomenonTime", "/")
    return ds.select(
        F.col("`@iot.id`").alias("iot_id"),
        "thing_id",
        "name",
        F.col("unitOfMeasurement.symbol").alias("unit"),
        F.col("properties.type").alias("type"),
        F.col("properties.parameter").alias("parameter"),
        F.col("properties.station_id").alias("station_id"),
        F.col("properties.measurement_start").alias("measurement_start"),
        F.col("phenomenonTime").alias("phenomenon_time"),
        F.get(ends, F.lit(0)).try_cast("timestamp").alias("available_from"),
        F.get(ends, F.lit(1)).try_cast("timestamp").alias("available_to"),
    )


def observations_of(pages: DataFrame) -> DataFrame:
    rows = pages.select("datastream_id", F.inline("value"))
    return rows.select("datastream_id", parse_instant("phenomenonTime").alias("ts"), "result")


def locations_of(pages: DataFrame) -> DataFrame:
    rows = pages.select("thing_id", F.inline("value"))
    return rows.select(
        "thing_id",
        F.col("name").alias("location"),
        F.col("location.type").alias("geo_type"),
        F.col("location.coordinates").alias("coordinates"),
    )


def read_things(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return things_of(read_pages(spark, path, THINGS_PAGE, multi_line))


def read_datastreams(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return datastreams_of(read_pages(spark, path, DATASTREAMS_PAGE, multi_line))


def read_observations(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return observations_of(read_pages(spark, path, OBSERVATIONS_PAGE, multi_line))


def read_locations(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return locations_of(read_pages(spark, path, LOCATIONS_PAGE, multi_line))


def page_completeness(pages: DataFrame) -> DataFrame:
    """Rows landed per series against the count its pages announce (NULL where none does)."""
    return pages.groupBy("datastream_id").agg(
        F.sum(F.size("value")).alias("fetched"),
        F.max("`@iot.count`").alias("announced"),
        F.count(F.lit(1)).alias("n_pages"),
    )
