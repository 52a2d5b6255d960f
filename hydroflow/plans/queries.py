"""The registered queries: every operator over the given tables.

Days and times are rendered as text and float aggregates rounded, so that two engines can be compared value
by value.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hydroflow.config import PLANT_TARGETS, ForecastConfig
from hydroflow.functions import (
    clip_nonnegative,
    day_label,
    forecast_index,
    iso_instant,
    minute_label,
    series_name,
    value_name,
)
from hydroflow.operators import catalog, correlate, features, forecast, forest, leaves, moving, observations, positions, regions, resample
from hydroflow.operators.lookback import lookback
from hydroflow.plans import inputs, requests
from hydroflow.plans.bulk_load import BulkLoad, bulk_load
from hydroflow.plans.relation import daily_relation, relation_strength
from hydroflow.session import scratch_path, stored
from hydroflow.sinks import series as sinks
from hydroflow.sources import chains, pages, tables
from hydroflow.streaming import load_landed_pages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FLOW = "Q_m³/s"
CUTOFF = date(2024, 1, 15)
WINDOW_START, WINDOW_END = "2024-01-05", "2024-01-12"
PAGE_ROWS = 5
ZONE = "Europe/Berlin"
HOURLY = ForecastConfig(
    feature_prefix="discharge",
    target_col="power",
    time_col="ts",
    ma_hours=4,
    steps_per_hour=1,
    demo_hour=10,
    window_steps=24,
    horizon_steps=24,
)


def query(fn: Query) -> Query:
    """Register under the function's name; a trailing underscore avoids a clash with an imported name."""
    QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


def _day(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd").alias(c)


def _time(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)


def _instant(c: str) -> Column:
    """An instant as its UTC reading, whatever the session's zone."""
    utc = F.to_utc_timestamp(c, F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)


def _round(c: str) -> Column:
    return F.round(c, 6).alias(c)


# Time series


@query
def daily_resample(spark: SparkSession, sf: str) -> DataFrame:
    daily = resample.daily_mean(inputs.power(spark, sf), "o_orderdate", ["el", "el1"])
    return daily.select(_day("day"), "el", "el1")


@query
def daily_resample_keyed(spark: SparkSession, sf: str) -> DataFrame:
    daily = resample.daily_mean(inputs.power(spark, sf), "o_orderdate", ["el"], ["o_orderpriority"])
    return daily.select("o_orderpriority", _day("day"), "el")


def _relation(spark: SparkSession, sf: str) -> DataFrame:
    return daily_relation(
        inputs.power(spark, sf), "o_orderdate", ["el", "el1"], inputs.discharge(spark, sf), "l_shipdate", FLOW
    )


@query
def daily_join(spark: SparkSession, sf: str) -> DataFrame:
    return _relation(spark, sf).select(_day("day"), "el", "el1", F.col(f"`{FLOW}`").alias("q"))


@query
def daily_head(spark: SparkSession, sf: str) -> DataFrame:
    """The first ten days of the daily join, in order."""
    return _in_order(_relation(spark, sf).orderBy("day").limit(10)).select(
        "place", _day("day"), "el", "el1", F.col(f"`{FLOW}`").alias("q")
    )


@query
def daily_join_zoned(spark: SparkSession, sf: str) -> DataFrame:
    """Power as instants against discharge on the clock of the plants: both are brought to days of that clock."""
    events = inputs.table(spark, sf, "events")
    power = events.filter("event_type = 'purchase'").select(
        F.concat(F.col("ts").cast("string"), F.lit("Z")).cast("timestamp").alias("at"), inputs.hundredths("value").alias("power")
    )
    flow = events.filter("event_type = 'view'").select("ts", inputs.hundredths("value").alias("q"))
    daily = daily_relation(power, "at", ["power"], flow, "ts", "q", zone=ZONE)
    return daily.select(_day("day"), "power", "q")


@query
def daily_power_discharge_corr(spark: SparkSession, sf: str) -> DataFrame:
    strength = relation_strength(_relation(spark, sf), ["el", "el1"], FLOW)
    return strength.select(_round("corr_el"), _round("corr_el1"))


@query
def trailing_mean(spark: SparkSession, sf: str) -> DataFrame:
    rows = moving.trailing_mean(inputs.plant_rows(spark, sf), inputs.KEYS, inputs.ORDER, "power", 16, "power_ma_4h")
    return rows.select("plant", "event_id", _time("ts"), "power_ma_4h")


@query
def trailing_mean_chunked(spark: SparkSession, sf: str) -> DataFrame:
    rows = moving.trailing_mean(
        inputs.plant_rows(spark, sf), [], inputs.ORDER, "power", 96, "power_ma_24h", chunk_rows=1000
    )
    return rows.select("event_id", _time("ts"), "power_ma_24h")


@query
def day_trailing_mean(spark: SparkSession, sf: str) -> DataFrame:
    rows = moving.day_trailing_mean(inputs.plant_rows(spark, sf), inputs.KEYS, inputs.ORDER, "power", "trend")
    return rows.select("plant", "event_id", _day("day"), "trend")


@query
def trailing_mean_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    rows = moving.trailing_mean(_null_plants(spark, sf), inputs.KEYS, inputs.ORDER, "power", 16, "power_ma_4h", chunk_rows=500)
    return rows.select("plant", "event_id", "power_ma_4h")


def _null_plants(spark: SparkSession, sf: str) -> DataFrame:
    """Plant rows of which those with an event id divisible by five have no plant."""
    plant = F.when(F.col("event_id") % 5 != 0, F.col("plant")).alias("plant")
    return inputs.plant_rows(spark, sf).select(plant, "ts", "event_id", "power")


@query
def row_positions_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    rows = positions.row_index(_null_plants(spark, sf), inputs.KEYS, inputs.ORDER)
    return rows.select("plant", "event_id", "row_index")


@query
def row_positions(spark: SparkSession, sf: str) -> DataFrame:
    rows = positions.row_index(inputs.plant_rows(spark, sf), inputs.KEYS, inputs.ORDER)
    return rows.select("plant", "event_id", "row_index")


# Features and cut-offs


def _complete(spark: SparkSession, sf: str) -> DataFrame:
    return features.drop_incomplete(inputs.hourly_wide(spark, sf))


def _launches(spark: SparkSession, sf: str) -> DataFrame:
    """The launch time of every day the wide table has, per plant."""
    return forecast.daily_cutoffs(inputs.hourly_wide(spark, sf), HOURLY, inputs.KEYS)


@query
def wide_features_dropna(spark: SparkSession, sf: str) -> DataFrame:
    wide = _complete(spark, sf)
    names = features.columns_except(wide, ["plant", "ts", "power"])
    return wide.select("plant", _time("ts"), _round("power"), *[_round(c) for c in names])


@query
def build_features(spark: SparkSession, sf: str) -> DataFrame:
    rows, names = features.build_features(inputs.hourly_wide(spark, sf), HOURLY, inputs.KEYS)
    return rows.select("plant", _time("ts"), *[_round(c) for c in names])


@query
def lookback_flatten(spark: SparkSession, sf: str) -> DataFrame:
    names = ["discharge_view", "discharge_click"]
    windows = lookback(_complete(spark, sf), inputs.KEYS, ["ts"], names, _launches(spark, sf), 24)
    return windows.select("plant", _time("cutoff"), F.posexplode("lookback").alias("slot", "value")).select(
        "plant", "cutoff", F.col("slot").cast("bigint").alias("slot"), _round("value")
    )


@query
def lookback_status(spark: SparkSession, sf: str) -> DataFrame:
    names = ["discharge_view", "discharge_click"]
    windows = lookback(inputs.hourly_wide(spark, sf), inputs.KEYS, ["ts"], names, _launches(spark, sf), 24)
    return windows.select("plant", _time("cutoff"), "status", F.col("n_rows").cast("bigint").alias("n_rows"))


@query
def asof_history(spark: SparkSession, sf: str) -> DataFrame:
    rows = features.history_until(inputs.plant_rows(spark, sf), "ts", CUTOFF)
    return rows.select("plant", "event_id", _time("ts"), "power")


@query
def next_day_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = features.rows_after(inputs.plant_rows(spark, sf), "ts", CUTOFF)
    return rows.select("plant", "event_id", _time("ts"), "power")


@query
def valid_cutoffs(spark: SparkSession, sf: str) -> DataFrame:
    return features.valid_cutoffs(inputs.plant_rows(spark, sf), "ts", inputs.KEYS).select("plant", _day("day"))


@query
def default_cutoff(spark: SparkSession, sf: str) -> DataFrame:
    return features.default_cutoff(inputs.plant_rows(spark, sf), "ts", inputs.KEYS).select("plant", _day("day"))


@query
def cutoff_lookup(spark: SparkSession, sf: str) -> DataFrame:
    found = features.rows_at(_complete(spark, sf), inputs.KEYS, ["ts"], _launches(spark, sf))
    return found.select("plant", _time("cutoff"), F.col("found").cast("string").alias("found"), _round("power"))


def _null_second(df: DataFrame) -> DataFrame:
    """The same rows with the second plant's name missing."""
    return df.withColumn("plant", F.nullif(F.col("plant"), F.lit(1).cast("bigint")))


@query
def cutoff_lookup_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    found = features.rows_at(_null_second(_complete(spark, sf)), inputs.KEYS, ["ts"], _null_second(_launches(spark, sf)))
    return found.select("plant", _time("cutoff"), F.col("found").cast("string").alias("found"), _round("power"))


@query
def forecast_index_(spark: SparkSession, sf: str) -> DataFrame:
    steps = _launches(spark, sf).select("plant", "cutoff", F.posexplode(forecast_index("cutoff", 96, 4)).alias("at", "ts"))
    return steps.select("plant", _time("cutoff"), (F.col("at") + 1).cast("bigint").alias("step"), _time("ts"))


@query
def forecast_training_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows, names = features.build_features(_complete(spark, sf), HOURLY, inputs.KEYS)
    windows = lookback(rows, inputs.KEYS, ["ts"], names, _launches(spark, sf), HOURLY.window_steps)
    training = forecast.training_rows(windows, rows, HOURLY, inputs.KEYS)
    return training.select(
        "plant",
        _time("cutoff"),
        F.col("step").cast("bigint").alias("step"),
        F.size("lookback").cast("bigint").alias("n_values"),
        _round("label"),
    )


# Catalogue


@query
def forecast_training_rows_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    rows, names = features.build_features(_null_second(_complete(spark, sf)), HOURLY, inputs.KEYS)
    windows = lookback(rows, inputs.KEYS, ["ts"], names, _null_second(_launches(spark, sf)), HOURLY.window_steps)
    training = forecast.training_rows(windows, rows, HOURLY, inputs.KEYS)
    return training.select("plant", _time("cutoff"), F.col("step").cast("bigint").alias("step"), _round("label"))


def _in_order(df: DataFrame) -> DataFrame:
    """The rows with their place in the order that the operator returns them in."""
    numbered = df.withColumn("_id", F.monotonically_increasing_id())
    return positions.global_positions(numbered, [], ["_id"], "place").drop("_id")


@query
def station_list(spark: SparkSession, sf: str) -> DataFrame:
    return _in_order(catalog.list_stations(inputs.things(spark, sf)))


@query
def station_caps(spark: SparkSession, sf: str) -> DataFrame:
    """The caller's cap of each call that takes one, with the rows in the order of the call."""
    things = inputs.things(spark, sf)
    calls = {
        "list": catalog.list_stations(things, limit=50),
        "search": catalog.search_stations(things, "Supplier#0000000", limit=20),
        "box": catalog.stations_in_box(things, inputs.locations(spark, sf), 10.0, 50.5, 12.0, 51.5, limit=10),
    }
    return reduce(DataFrame.unionByName, [_in_order(rows).select(F.lit(c).alias("call"), "place", "iot_id", "name") for c, rows in calls.items()])


@query
def station_search_ci(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.find_station(inputs.things(spark, sf), "sUPPLIER#00000001")


@query
def station_search_cs(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.search_stations(inputs.things(spark, sf), "Supplier#00000001")


@query
def resolve_stations(spark: SparkSession, sf: str) -> DataFrame:
    found = catalog.resolve_stations(inputs.requested_stations(spark, sf), inputs.things(spark, sf))
    return found.select("text", "thing_id", "station").na.fill({"thing_id": -1})


@query
def resolve_partial_names(spark: SparkSession, sf: str) -> DataFrame:
    texts = inputs.table(spark, sf, "customer").select(F.substring("c_name", 10, 8).alias("text"))
    return catalog.resolve_stations(texts, inputs.things(spark, sf)).na.fill({"thing_id": -1})


@query
def station_datastreams(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.list_datastreams(inputs.things(spark, sf), inputs.datastreams(spark, sf))


@query
def datastream_match(spark: SparkSession, sf: str) -> DataFrame:
    found = catalog.match_datastreams(inputs.datastreams(spark, sf), "view", "15min")
    return found.select("thing_id", "datastream_id", "datastream", "unit")


@query
def datastreams_by_type(spark: SparkSession, sf: str) -> DataFrame:
    return _in_order(catalog.count_by_type(inputs.datastreams(spark, sf)))


@query
def datastreams_by_parameter(spark: SparkSession, sf: str) -> DataFrame:
    return _in_order(catalog.count_by_parameter(inputs.datastreams(spark, sf)))


@query
def station_frequencies(spark: SparkSession, sf: str) -> DataFrame:
    return _in_order(catalog.station_frequencies(inputs.datastreams(spark, sf)))


@query
def station_location(spark: SparkSession, sf: str) -> DataFrame:
    placed = catalog.station_locations(inputs.things(spark, sf), inputs.locations(spark, sf))
    return placed.select("thing_id", "name", _round("lon"), _round("lat"), F.contains("geojson", F.lit("Point")).cast("string").alias("is_point"))


@query
def stations_in_bbox(spark: SparkSession, sf: str) -> DataFrame:
    inside = catalog.stations_in_box(inputs.things(spark, sf), inputs.locations(spark, sf), 10.25, 50.45, 11.95, 51.35)
    return _in_order(inside)


@query
def dedupe_last_by_name(spark: SparkSession, sf: str) -> DataFrame:
    parts = inputs.table(spark, sf, "part").select(
        F.col("p_partkey").alias("iot_id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("description"),
        F.create_map(
            F.lit("station_id"), F.when(F.col("p_size") > 25, F.col("p_type")), F.lit("size"), F.col("p_size").cast("string")
        ).alias("properties"),
    )
    last = catalog.last_by_name(parts, "iot_id")
    return last.select("name", "description", F.col("properties")["station_id"].alias("station_id"), F.col("properties")["size"].alias("size"))


@query
def stations_in_regions(spark: SparkSession, sf: str) -> DataFrame:
    """A box and a diamond of every nation, laid over the stations."""
    key = F.col("s_nationkey")
    nations = inputs.table(spark, sf, "supplier").select("s_nationkey").distinct()
    lon, lat = F.lit(9.87) + (key % 10) * F.lit(0.21), F.lit(50.27) + (key % 5) * F.lit(0.23)
    corner = [(lon - 0.37, lat), (lon, lat + 0.29), (lon + 0.37, lat), (lon, lat - 0.29)]
    diamond = F.array(*[F.struct(x.alias("lon"), y.alias("lat")) for x, y in corner])
    shapes = [
        nations.select(F.concat(F.lit("box "), key.cast("string")).alias("region_id"), regions.box_ring(lon, lat, lon + 0.55, lat + 0.41).alias("ring")),
        nations.select(F.concat(F.lit("diamond "), key.cast("string")).alias("region_id"), diamond.alias("ring")),
    ]
    return regions.stations_in_regions(inputs.things(spark, sf), inputs.locations(spark, sf), shapes[0].unionByName(shapes[1]))


@query
def correlation_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """Every pair of hourly columns of every plant, with hours where some are missing, and a constant."""
    wide = inputs.hourly_wide(spark, sf).withColumn("constant", F.lit(7.0))
    return correlate.correlation_matrix(wide, [*inputs.HOURLY, "constant"], inputs.KEYS).select("plant", "a", "b", "n", _round("corr"))


@query
def trailing_mean_year(spark: SparkSession, sf: str) -> DataFrame:
    """A frame as long as a year of quarter hours, of series without and with a name."""
    rows = moving.long_trailing_mean(_null_plants(spark, sf), inputs.KEYS, inputs.ORDER, "power", 35_040, "year_mean", chunk_rows=1000)
    return rows.select("plant", "event_id", _round("year_mean"))


@query
def trailing_mean_long(spark: SparkSession, sf: str) -> DataFrame:
    """Frames of 96 rows that reach over several chunks."""
    rows = moving.long_trailing_mean(inputs.plant_rows(spark, sf), inputs.KEYS, inputs.ORDER, "power", 96, "day_mean", chunk_rows=40)
    return rows.select("plant", "event_id", _round("day_mean"))


# Observations


@query
def observation_window(spark: SparkSession, sf: str) -> DataFrame:
    rows = observations.in_range(inputs.observations(spark, sf), WINDOW_START, WINDOW_END)
    return rows.select("datastream_id", "obs_id", _time("ts"), "result")


@query
def observations_with_unit(spark: SparkSession, sf: str) -> DataFrame:
    rows = observations.with_unit(inputs.observations(spark, sf), inputs.datastreams(spark, sf))
    return rows.select("datastream_id", "obs_id", "datastream", "unit", "result")


@query
def series_inspect(spark: SparkSession, sf: str) -> DataFrame:
    table = observations.inspect_series(inputs.observations(spark, sf), inputs.datastreams(spark, sf))
    return table.select(
        "datastream_id", "datastream", "unit", "type", "parameter", "phenomenon_time", "n_obs",
        _time("first_ts"), _time("last_ts"),
    )


@query
def series_samples(spark: SparkSession, sf: str) -> DataFrame:
    rows = observations.sample_series(inputs.observations(spark, sf), inputs.datastreams(spark, sf))
    return rows.select(
        "datastream_id", "edge", F.col("rank").cast("bigint").alias("rank"), _time("ts"), "result", "unit"
    )


@query
def latest_observation(spark: SparkSession, sf: str) -> DataFrame:
    newest = observations.latest(inputs.observations(spark, sf), inputs.datastreams(spark, sf), "obs_id")
    return newest.select("datastream_id", "datastream", "unit", _time("ts"), "result")


def _exceedances(spark: SparkSession, sf: str, threshold: float, above: bool) -> DataFrame:
    hits = observations.exceedances(inputs.observations(spark, sf), inputs.datastreams(spark, sf), threshold, above)
    return hits.select(
        "datastream_id", F.col("rank").cast("bigint").alias("rank"), "total", _time("ts"), "result", "unit"
    )


@query
def threshold_above(spark: SparkSession, sf: str) -> DataFrame:
    return _exceedances(spark, sf, 20.0, True)


@query
def threshold_below(spark: SparkSession, sf: str) -> DataFrame:
    return _exceedances(spark, sf, 5.0, False)


def _load(spark: SparkSession, sf: str) -> BulkLoad:
    return bulk_load(
        inputs.requested_stations(spark, sf),
        inputs.things(spark, sf),
        inputs.datastreams(spark, sf),
        inputs.observations(spark, sf),
        "view",
        "15min",
        WINDOW_START,
        WINDOW_END,
    )


@query
def load_status(spark: SparkSession, sf: str) -> DataFrame:
    return observations.count_status(_load(spark, sf).status)


@query
def missing_stations(spark: SparkSession, sf: str) -> DataFrame:
    return observations.missing(_load(spark, sf).status).select("text", "status")


# Files


@query
def series_store(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "series")
    _load(spark, sf).write(path)
    stored_rows = sinks.read_series(spark, path)
    return stored_rows.select("param", "station_id", "station", "freq", "unit", _time("ts"), "result")


@query
def series_store_counts(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "series")
    _load(spark, sf).write(path)
    counts = sinks.count_series(spark, path)
    # Files follow the rows, not the series.
    return counts.select("n_series", "n_rows", (F.col("n_files") <= F.lit(8)).cast("string").alias("few_files"))


@query
def store_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Count and time range of every stored series without reading its rows."""
    path = scratch_path(spark, "ranges")
    _load(spark, sf).write(path)
    ranges = sinks.series_ranges(spark, path)
    return ranges.select("param", "station_id", "freq", "n_rows", _time("first_ts"), _time("last_ts"))


@query
def store_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Four loads into one store, the second and third of some stations only, compacted and cleaned before the last."""
    path, load = scratch_path(spark, "versions"), _load(spark, sf).rows
    load = stored(load, "loaded")
    sinks.write_series(load, path)
    sinks.write_series(load.filter("station_id % 3 = 0").withColumn("result", F.col("result") + 100), path)
    sinks.write_series(load.filter("station_id % 5 = 0 and result > 10").withColumn("result", F.col("result") * -1), path)
    sinks.compact(spark, path, loads=2)
    sinks.vacuum(spark, path, keep_hours=0)
    sinks.write_series(load.filter("station_id % 7 = 0").withColumn("result", F.lit(0.0)), path)
    return sinks.read_series(spark, path).select("param", "station_id", "freq", _time("ts"), _round("result"))


def _requests(spark: SparkSession, sf: str) -> DataFrame:
    """A request of every customer: station text, parameter, frequency and window follow the customer's number. Windows
    of customers of one station overlap; some parameters, frequencies, texts and ends are wrong or missing."""
    key = F.col("c_custkey")
    start = F.date_add(F.lit("2024-01-01").cast("date"), (key % 25).cast("int"))
    kinds = F.array(*[F.lit(k) for k in ("view", "click", "purchase", "signup", "error", "flow")])
    steps = F.array(*[F.lit(k) for k in ("15min", "1D", "15min", "1D", "15min", "1H")])
    return inputs.table(spark, sf, "customer").select(
        key.alias("request_id"),
        F.when(key % 29 == 0, "").when(key % 31 == 0, "no such place").otherwise(
            F.format_string("SUPPLIER#%09d", (key * 7) % 97)
        ).alias("text"),
        F.get(kinds, (key % 6).cast("int")).alias("param"),
        F.get(steps, (F.floor(key / 6) % 6).cast("int")).alias("freq"),
        F.date_format(start, "yyyy-MM-dd").alias("start"),
        F.when(key % 37 != 0, F.date_format(F.date_add(start, (key % 41 - 1).cast("int")), "yyyy-MM-dd")).alias("end"),
    )


def _request_load(spark: SparkSession, sf: str):
    things, ds = inputs.things(spark, sf), inputs.datastreams(spark, sf)
    return requests.bulk_requests(_requests(spark, sf), things, ds, inputs.observations(spark, sf))


@query
def bulk_requests(spark: SparkSession, sf: str) -> DataFrame:
    return _request_load(spark, sf).rows.select("request_id", "param", "station_id", "station", "freq", "unit", _time("ts"), "result")


@query
def request_status(spark: SparkSession, sf: str) -> DataFrame:
    return _request_load(spark, sf).status.select("request_id", "status", "n_obs")


def _landed_pages(spark: SparkSession, sf: str) -> str:
    """Observations as landed page files: JSON lines of ``PAGE_ROWS`` observations, with count and link to the next."""
    rows = inputs.observations(spark, sf)
    placed = positions.row_index(rows, ["datastream_id"], ["ts", "obs_id"], "pos")
    counts = rows.groupBy("datastream_id").agg(F.count(F.lit(1)).alias("@iot.count"))
    entity = F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("phenomenonTime"), "result")
    page = placed.groupBy("datastream_id", F.floor(F.col("pos") / PAGE_ROWS).alias("page")).agg(
        F.collect_list(entity).alias("value")
    )
    linked = page.join(counts, "datastream_id").withColumn("@iot.selfLink", F.concat(F.lit("page="), F.col("page"))).withColumn(
        "@iot.nextLink",
        F.when((F.col("page") + 1) * PAGE_ROWS < F.col("`@iot.count`"), F.concat(F.lit("page="), F.col("page") + 1)),
    )
    path = scratch_path(spark, "pages")
    envelope = F.struct("datastream_id", "`@iot.count`", "`@iot.selfLink`", "`@iot.nextLink`", "value")
    linked.select(F.to_json(envelope).alias("line")).write.text(path)
    return path


@query
def page_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    rows = pages.read_observations(spark, _landed_pages(spark, sf))
    return rows.select("datastream_id", _instant("ts"), "result")


@query
def page_completeness(spark: SparkSession, sf: str) -> DataFrame:
    landed = pages.read_pages(spark, _landed_pages(spark, sf), pages.OBSERVATIONS_PAGE)
    return pages.page_completeness(landed).select("datastream_id", "fetched", "announced", "n_pages")


@query
def page_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Chains of which every series whose number divides by three has lost its second page, and every one whose number
    divides by seven its first."""
    landed = pages.read_pages(spark, _landed_pages(spark, sf), pages.OBSERVATIONS_PAGE)
    own, key = F.col("`@iot.selfLink`"), F.col("datastream_id")
    lost = ((key % 3 == 0) & (own == "page=1")) | ((key % 7 == 0) & (own == "page=0"))
    return chains.chain_report(
        landed.filter(~lost), ["datastream_id"], "`@iot.selfLink`", "`@iot.nextLink`", own == "page=0", F.size("value")
    )


def _landed_entities(spark: SparkSession, purpose: str, rows: DataFrame, owner: str | None, entity: Column) -> str:
    """Catalogue entities as landed page files: those of one owner on a page, or five by id where there is none."""
    page = F.col(owner) if owner else F.floor(F.col("iot_id") / 5)
    gathered = rows.groupBy(page.alias("page")).agg(F.collect_list(entity).alias("value"))
    fields = ([F.col("page").alias(owner)] if owner else []) + [F.size("value").alias("@iot.count"), F.col("value")]
    path = scratch_path(spark, purpose)
    gathered.select(F.to_json(F.struct(*fields)).alias("line")).write.text(path)
    return path


@query
def thing_pages(spark: SparkSession, sf: str) -> DataFrame:
    entity = F.struct(
        F.col("iot_id").alias("@iot.id"), "name", "description", F.struct("station_id").alias("properties")
    )
    path = _landed_entities(spark, "things", inputs.things(spark, sf), None, entity)
    return pages.read_things(spark, path).select("iot_id", "name", "description", "station_id")


@query
def datastream_pages(spark: SparkSession, sf: str) -> DataFrame:
    entity = F.struct(
        F.col("iot_id").alias("@iot.id"),
        "name",
        F.struct(F.col("unit").alias("symbol")).alias("unitOfMeasurement"),
        F.struct("type", "parameter", "station_id").alias("properties"),
    )
    path = _landed_entities(spark, "datastreams", inputs.datastreams(spark, sf), "thing_id", entity)
    rows = pages.read_datastreams(spark, path)
    return rows.select("iot_id", "thing_id", "name", "unit", "type", "parameter", "station_id", "phenomenon_time")


@query
def location_pages(spark: SparkSession, sf: str) -> DataFrame:
    entity = F.struct(
        F.col("location").alias("name"), F.struct(F.col("geo_type").alias("type"), "coordinates").alias("location")
    )
    path = _landed_entities(spark, "locations", inputs.locations(spark, sf), "thing_id", entity)
    placed = catalog.station_locations(inputs.things(spark, sf), pages.read_locations(spark, path))
    return placed.select("thing_id", "name", _round("lon"), _round("lat"))


@query
def page_stream(spark: SparkSession, sf: str) -> DataFrame:
    out, state = scratch_path(spark, "stream"), scratch_path(spark, "stream-state")
    load_landed_pages(spark, _landed_pages(spark, sf), out, state)
    return spark.read.parquet(out).select("datastream_id", _instant("ts"), "result")


@query
def plant_table_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "plants")
    wide = inputs.hourly_wide(spark, sf).select(
        "plant", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+02:00'").alias("time"), *inputs.HOURLY
    )
    # The columns are landed in another order than they are asked for.
    landed = wide.select("plant", *reversed(inputs.HOURLY), "time")
    landed.write.option("header", True).partitionBy("plant").csv(path)
    rows = tables.read_plant_csv(spark, path, list(inputs.HOURLY), partitions=["plant"])
    return rows.select(F.col("plant").cast("bigint").alias("plant"), _time("time"), *[_round(c) for c in inputs.HOURLY])


@query
def observation_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    sinks.export_csv(inputs.observations(spark, sf).select("ts", "result"), path, "Q", "m³/s")
    rows = tables.read_observation_csv(spark, path, FLOW)
    return rows.select(_time("phenomenonTime"), F.col(f"`{FLOW}`").alias("q"))


@query
def plant_export_clean(spark: SparkSession, sf: str) -> DataFrame:
    german = F.date_format("o_orderdate", "dd.MM.yyyy HH:mm:ss")
    rows = inputs.power(spark, sf).select(
        german.alias("Datum_von"),
        german.alias("Datum_bis"),
        F.col("el").cast("string").alias("el"),
        F.col("el1").cast("string").alias("el1"),
    )
    path = scratch_path(spark, "export")
    rows.write.option("header", True).csv(path)
    # The metadata rows of the export are one more part of it.
    preamble = [("Einheit", "", "kW", "kW"), ("Quelle", "", "", ""), ("", "", "a", "b"), ("Zaehler", "", "1", "2"), ("Status", "", "ok", "ok")]
    notes = spark.createDataFrame(preamble, rows.schema)
    notes.write.mode("append").option("header", True).csv(path)
    clean = tables.clean_plant_export(tables.read_plant_export(spark, path, in_parts=True))
    return clean.select(_time("Datum_von"), _time("Datum_bis"), "el", "el1")


@query
def export_names(spark: SparkSession, sf: str) -> DataFrame:
    named = catalog.list_datastreams(inputs.things(spark, sf), inputs.datastreams(spark, sf))
    slashed = F.concat_ws(" / ", "station", "datastream")
    return named.select(
        "datastream_id",
        series_name(F.lit("Q"), slashed, F.lit("1D")).alias("file_name"),
        value_name(F.lit("Q"), F.col("unit")).alias("value_name"),
        iso_instant(F.lit("2024-01-05")).alias("starts"),
    )


@query
def export_summary(spark: SparkSession, sf: str) -> DataFrame:
    return sinks.export_summary(observations.in_range(inputs.observations(spark, sf), WINDOW_START, WINDOW_END))


@query
def window_files(spark: SparkSession, sf: str) -> DataFrame:
    """Every line of the written windows of all series, with its place in its series: by file, part of the file and line."""
    path = scratch_path(spark, "windows")
    sinks.export_windows(inputs.observations(spark, sf), WINDOW_START, WINDOW_END, path)
    rows = sinks.read_window_lines(spark, path)
    return positions.row_index(rows, ["datastream_id"], ["file", "block", "row"], "place").select("datastream_id", "place", "line")


@query
def date_labels(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.table(spark, sf, "events").select(
        "event_id", day_label("ts").alias("day_label"), minute_label("ts").alias("minute_label")
    )


@query
def clip_nonnegative_(spark: SparkSession, sf: str) -> DataFrame:
    centred = inputs.table(spark, sf, "events").select("event_id", (F.col("value") - 20).alias("raw"))
    return centred.select("event_id", F.round(clip_nonnegative("raw"), 6).alias("clipped"))


# Models


def plant_table(spark: SparkSession, sf: str) -> DataFrame:
    """The complete rows of all plants as a stored table: training reads its input several times."""
    return stored(_complete(spark, sf), "plants")


def one_plant(table: DataFrame, plant: int) -> DataFrame:
    return table.filter(F.col("plant") == plant).drop("plant")


def _per_plant(frames: dict[int, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [df.withColumn("plant", F.lit(plant).cast("bigint")) for plant, df in frames.items()])


@query
def run_actuals(spark: SparkSession, sf: str) -> DataFrame:
    frame = forest.run_actuals(_complete(spark, sf), "ts", "power", CUTOFF, keys=inputs.KEYS)
    return frame.select("plant", _time("ts"), "series", _round("value"))


def _between(value: Column, least: Column | float, most: Column | float) -> Column:
    least, most = (x if isinstance(x, Column) else F.lit(x) for x in (least, most))
    return value.between(least, most).cast("string")


def _bounds(rows: DataFrame) -> tuple[float, float]:
    return tuple(rows.agg(F.min("power"), F.max("power")).first())


def _latest_runs(spark: SparkSession, sf: str) -> tuple[DataFrame, leaves.KeyedRuns]:
    """A run of every plant up to its latest valid cut-off, all in one fit."""
    plants = plant_table(spark, sf)
    return plants, leaves.keyed_runs(plants, inputs.KEYS, "ts", "power", features.default_cutoff(plants, "ts", inputs.KEYS))


@query
def run_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Values of the predictions depend on the trees; that they lie within what was learned does not."""
    plants, found = _latest_runs(spark, sf)
    frame = leaves.keyed_frame(plants, found, inputs.KEYS, "ts", "power").join(found.bounds, [*inputs.KEYS, "cutoff"])
    predicted = F.col("series") == "prediction"
    return frame.select(
        _time("ts"),
        "series",
        F.when(~predicted, F.round("value", 6)).alias("value"),
        F.when(predicted, _between(F.col("value"), F.col("least"), F.col("most"))).alias("learned"),
        "plant",
    )


@query
def run_peak(spark: SparkSession, sf: str) -> DataFrame:
    _, found = _latest_runs(spark, sf)
    run = [*inputs.KEYS, "cutoff"]
    actual = found.scored.groupBy(*run).agg(F.max("actual").alias("actual"))
    peaks = found.peaks(inputs.KEYS).join(actual, run).join(found.bounds, run)
    bounded = F.col("peak").between(F.col("actual"), F.greatest("actual", "most"))
    return peaks.select(_time("starts_at"), _round("actual"), bounded.cast("string").alias("bounded"), "plant")


@query
def feature_importance_top10(spark: SparkSession, sf: str) -> DataFrame:
    plants = plant_table(spark, sf)
    cutoffs = features.default_cutoff(plants, "ts", inputs.KEYS).collect()  # one row per plant

    def importance(row) -> tuple[int, DataFrame]:
        own = one_plant(plants, row["plant"])
        names = features.columns_except(own, ["ts", "power"])
        model = forest.fit_forest(features.history_until(own, "ts", row["day"]), names, "power")
        return row["plant"], forest.feature_importance(spark, model, names)

    frames = {}
    for plant, strongest in sorted(forest.at_once(importance, cutoffs), key=lambda x: x[0]):
        total = strongest.agg(F.round(F.sum("importance"), 6).alias("total"))
        rows = strongest.crossJoin(total)
        frames[plant] = rows.select("feature", "total", _between(F.col("importance"), 0.0, 1.0).alias("share"))
    return _per_plant(frames)


@query
def backtest(spark: SparkSession, sf: str) -> DataFrame:
    """Every valid cut-off of every plant, each learned from its own history, all in one fit."""
    plants = plant_table(spark, sf)
    # One fit has the nodes of all runs, a few hundred thousand with ten trees each.
    days = features.valid_cutoffs(plants, "ts", inputs.KEYS)
    found = leaves.keyed_runs(plants, inputs.KEYS, "ts", "power", days, trees=10)
    rows = found.scored.join(found.bounds, [*inputs.KEYS, "cutoff"])
    learned = _between(F.col("power_pred"), F.col("least"), F.col("most"))
    return rows.select(_day("cutoff"), _time("ts"), _round("actual"), learned.alias("learned"), "plant")


@query
def keyed_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Runs whose result is determined, for every plant and valid cut-off day, one of the plants without a name: the hour
    tells all that trees without drawn rows can learn, so a prediction is the mean of its hour in the run's own history."""
    hour = F.hour(F.col("ts").cast("timestamp_ntz")).cast("double").alias("hour")
    rows = _null_second(inputs.plant_rows(spark, sf)).select("plant", "ts", "event_id", "power", hour, F.lit(1.0).alias("constant"))
    rows = stored(rows, "hours")
    days = features.valid_cutoffs(rows, "ts", inputs.KEYS)
    found = leaves.keyed_runs(rows, inputs.KEYS, "ts", "power", days, ["event_id"], trees=2, bootstrap=False)
    frame = leaves.keyed_frame(rows, found, inputs.KEYS, "ts", "power", ["event_id"])
    return frame.select("plant", _day("cutoff"), _time("ts"), "series", _round("value"))


def _hour_runs(spark: SparkSession, sf: str, constants: tuple[str, ...] = ("constant",)) -> dict[int, forest.AsOfRun]:
    """Runs whose result is determined: one feature, the hour, tells all that trees without drawn rows can learn,
    so a prediction is the mean of its hour."""
    hour = F.hour(F.col("ts").cast("timestamp_ntz")).cast("double").alias("hour")
    rows = inputs.plant_rows(spark, sf).select("plant", "ts", "event_id", "power", hour, *[F.lit(1.0).alias(c) for c in constants])
    rows = stored(rows, "hours")
    return dict(
        forest.at_once(
            lambda plant: (
                plant,
                forest.as_of_run(one_plant(rows, plant), "ts", "power", CUTOFF, ["event_id"], trees=2, bootstrap=False),
            ),
            [r["plant"] for r in rows.select("plant").distinct().orderBy("plant").collect()],
        )
    )


@query
def run_frame_exact(spark: SparkSession, sf: str) -> DataFrame:
    return _per_plant({k: r.frame.select(_time("ts"), "series", _round("value")) for k, r in _hour_runs(spark, sf).items()})


@query
def run_peak_exact(spark: SparkSession, sf: str) -> DataFrame:
    return _per_plant({k: r.peak().select(_time("starts_at"), _round("peak")) for k, r in _hour_runs(spark, sf).items()})


@query
def importance_exact(spark: SparkSession, sf: str) -> DataFrame:
    return _per_plant({k: r.importance.select("feature", _round("importance")) for k, r in _hour_runs(spark, sf).items()})


@query
def importance_order(spark: SparkSession, sf: str) -> DataFrame:
    """The ten strongest of a dozen features in the order they are shown in; all but one tell nothing."""
    runs = _hour_runs(spark, sf, tuple(f"constant_{i:02d}" for i in range(11)))
    return _per_plant({k: _in_order(r.importance).select("place", "feature", _round("importance")) for k, r in runs.items()})


def _until_cutoff(spark: SparkSession, wide: DataFrame) -> str:
    """A bundle that has seen no target after the cut-off, written and read again."""
    until = datetime.combine(CUTOFF, datetime.min.time())
    launches = forecast.daily_cutoffs(wide, HOURLY, inputs.KEYS)
    bundle = forecast.train_forecast(wide, HOURLY, inputs.KEYS, launches, until=until)
    path = scratch_path(spark, "model")
    forecast.save_bundle(spark, bundle, path)
    return path


@query
def multistep_forecast(spark: SparkSession, sf: str) -> DataFrame:
    """Launches after the last target that was learned from."""
    wide = stored(_complete(spark, sf), "wide")
    bundle = forecast.load_bundle(spark, _until_cutoff(spark, wide))
    launches = forecast.daily_cutoffs(wide, HOURLY, inputs.KEYS).filter(F.col("cutoff") >= F.lit(CUTOFF))
    predicted, _ = forecast.forecast_cutoffs(wide, bundle, launches, inputs.KEYS)
    least, most = _bounds(features.history_until(wide, "ts", CUTOFF))
    return sinks.render_forecast(predicted).select(
        "plant",
        _time("cutoff"),
        F.col("step").cast("bigint").alias("step"),
        _time("ts"),
        _between(F.col("power_pred"), least, most).alias("learned"),
        (F.trim("power_text") == F.format_string("%.1f", "power_pred")).cast("string").alias("shown"),
    )


@query
def vector_forecast(spark: SparkSession, sf: str) -> DataFrame:
    """A forecast whose result is determined: look-backs tell the plant and nothing else, so each step is the plant's mean
    over the launches that were learned from. The bundle is written and read again."""
    wide = stored(_complete(spark, sf), "wide")
    own = wide.select("plant", "ts", "power", F.col("plant").cast("double").alias("discharge_class"))
    config = replace(HOURLY, ma_hours=0, window_steps=3)
    launches = forecast.daily_cutoffs(own, config, inputs.KEYS)
    until = datetime.combine(CUTOFF, datetime.min.time())
    bundle = leaves.train_vector(own, config, inputs.KEYS, launches, until=until, trees=3, bootstrap=False)
    path = scratch_path(spark, "vector-model")
    leaves.save_vector(spark, bundle, path)
    later = launches.filter(F.col("cutoff") >= F.lit(CUTOFF))
    rows = leaves.vector_forecast_cutoffs(own, leaves.load_vector(spark, path), later, inputs.KEYS)
    return rows.select("plant", _time("cutoff"), F.col("step").cast("bigint").alias("step"), _time("ts"), _round("power_pred"))


@query
def multistep_training_rows(spark: SparkSession, sf: str) -> DataFrame:
    """What a bundle trained until the cut-off learns from: no target lies after it."""
    wide = _complete(spark, sf)
    rows, names = features.build_features(wide, HOURLY, inputs.KEYS)
    windows = lookback(rows, inputs.KEYS, ["ts"], names, forecast.daily_cutoffs(wide, HOURLY, inputs.KEYS), HOURLY.window_steps)
    training = forecast.training_rows(windows, rows, HOURLY, inputs.KEYS, datetime.combine(CUTOFF, datetime.min.time()))
    return training.select("plant", _time("cutoff"), F.col("step").cast("bigint").alias("step"), _time("ts"), _round("label"))


@query
def predict_for_date(spark: SparkSession, sf: str) -> DataFrame:
    """The serving call on a written wide table: one plant, the first launch that its history allows after the cut-off."""
    wide = stored(_complete(spark, sf), "wide")
    source = scratch_path(spark, "wide-table")
    wide.write.parquet(source)
    names = ["discharge_view", "discharge_click"]
    launches = forecast.daily_cutoffs(wide, HOURLY, inputs.KEYS).filter((F.col("cutoff") > F.lit(CUTOFF)) & (F.col("plant") == 0))
    usable = lookback(wide, inputs.KEYS, ["ts"], names, launches, HOURLY.window_steps).filter("status = 'ok'")
    day = usable.agg(F.min("cutoff")).first()[0]
    least, most = _bounds(features.history_until(wide, "ts", CUTOFF))
    rows = forecast.predict_for_date(spark, day, _until_cutoff(spark, wide), source, plant=0)
    return rows.select(_time("ts"), _between(F.col("power_pred"), least, most).alias("learned"))


@query
def plant_targets(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the plants under the target column that their plant choice maps to."""
    rows = inputs.plant_rows(spark, sf)
    parts = [
        rows.filter(F.col("plant") == i).select("event_id", F.lit(features.plant_target(name)).alias("target"), _round("power"))
        for i, name in enumerate(PLANT_TARGETS)
    ]
    return reduce(DataFrame.unionByName, parts)
