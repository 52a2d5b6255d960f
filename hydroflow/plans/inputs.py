"""The given tables seen as gauge data.

``supplier`` plays the stations, the distinct (user, event type) pairs of ``events`` their datastreams, and
``events`` the observations; ``orders`` and ``lineitem`` play plant power and river discharge. Power and
hourly features are taken in hundredths: whole numbers add up exactly in any order, so means do not depend on
how rows are split over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_CODES = {"view": 0, "click": 1, "purchase": 2, "signup": 3, "error": 4}
UNITS = {"view": "m³/s", "click": "cm"}
KEYS = ["plant"]
PLANTS = (0, 1)
ORDER = ["ts", "event_id"]
HOURLY = {"discharge_view": "view", "discharge_click": "click", "power": "purchase"}


# Columns of the given tables: no job is spent on inferring them.
TABLES = {
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _coded(mapping: dict[str, int | str]):
    expr = None
    for label, code in mapping.items():
        hit = F.col("event_type") == label
        expr = F.when(hit, F.lit(code)) if expr is None else expr.when(hit, F.lit(code))
    return expr


def hundredths(c: str):
    return F.round(F.col(c) * 100)


def datastream_id():
    return (F.col("user_id") * 10 + _coded(EVENT_CODES)).cast("bigint")


def things(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        key.alias("iot_id"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("nation "), F.col("s_nationkey").cast("string")).alias("description"),
        F.when(key % 7 != 0, key.cast("string")).alias("station_id"),
    )


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    lon = F.lit(9.8) + (key % 30) * F.lit(0.1)
    lat = F.lit(50.2) + (key % 16) * F.lit(0.1)
    return table(spark, sf_dir, "supplier").select(
        key.alias("thing_id"),
        F.col("s_name").alias("location"),
        F.lit("Point").alias("geo_type"),
        F.when(key % 11 == 0, F.array().cast("array<double>")).otherwise(F.array(lon, lat)).alias("coordinates"),
    )


def datastreams(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "events").select("user_id", "event_type").distinct()
    kind = (
        F.when(F.col("user_id") % 3 == 0, "TH_PEGELDATEN_1D").when(F.col("user_id") % 3 == 1, "TH_PEGELDATEN_15MIN")
    )
    return pairs.select(
        datastream_id().alias("iot_id"),
        F.col("user_id").alias("thing_id"),
        F.concat_ws("@", "event_type", F.col("user_id").cast("string")).alias("name"),
        _coded(UNITS).alias("unit"),
        kind.alias("type"),
        F.col("event_type").alias("parameter"),
        F.col("user_id").cast("string").alias("station_id"),
        F.lit(None).cast("string").alias("measurement_start"),
        F.lit(None).cast("string").alias("phenomenon_time"),
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        datastream_id().alias("datastream_id"), "ts", F.col("value").alias("result"), F.col("event_id").alias("obs_id")
    )


def plant_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two plants with an irregular power series each."""
    return table(spark, sf_dir, "events").select(
        (F.col("user_id") % 2).alias("plant"), "ts", "event_id", hundredths("value").alias("power")
    )


def hourly_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide hourly table per plant: two discharge columns and the power; hours without a kind are NULL."""
    events = table(spark, sf_dir, "events")
    means = [F.avg(F.when(F.col("event_type") == kind, hundredths("value"))).alias(c) for c, kind in HOURLY.items()]
    return events.groupBy((F.col("user_id") % 2).alias("plant"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")).agg(
        *means
    )


def power(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = hundredths("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        "o_orderdate",
        "o_orderpriority",
        price.alias("el"),
        F.when(F.col("o_orderstatus") == "F", price).alias("el1"),
    )


def discharge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_shipdate", F.col("l_quantity").alias("Q_m³/s"))


def requested_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station texts to look for: the customer numbers, in capitals and as part of a station name."""
    return table(spark, sf_dir, "customer").select(F.upper(F.substr("c_name", F.lit(7))).alias("text"))
