from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hydroflow.operators import observations as ob
from hydroflow.plans.bulk_load import LoadError, bulk_load, load_one

T0 = datetime(2024, 1, 1)
DS_SCHEMA = (
    "iot_id bigint, thing_id bigint, name string, unit string, type string, parameter string, "
    "station_id string, measurement_start string, phenomenon_time string"
)


@pytest.fixture(scope="module")
def datastreams(spark):
    rows = [
        (1, 100, "Q@100", "m³/s", "TH_PEGELDATEN_1D", "Q", None, None, None),
        (2, 200, "Q@200", None, "TH_PEGELDATEN_1D", "Q", None, None, "x/y"),
        (3, 300, "W@300", "cm", "TH_PEGELDATEN_1D", "W", None, None, None),
    ]
    return spark.createDataFrame(rows, DS_SCHEMA)


@pytest.fixture(scope="module")
def things(spark):
    rows = [(100, "Jena / Saale"), (200, "Gera"), (300, "Weimar")]
    return spark.createDataFrame([(i, n, None, None) for i, n in rows], "iot_id bigint, name string, description string, station_id string")


@pytest.fixture(scope="module")
def obs(spark):
    rows = [(1, T0 + timedelta(hours=6 * i), float(i), i) for i in range(40)]
    rows += [(1, T0 + timedelta(hours=6 * 39), 99.0, 40)]
    return spark.createDataFrame(rows, "datastream_id bigint, ts timestamp_ntz, result double, obs_id bigint")


def test_range_includes_both_ends_but_not_the_rest_of_the_end_day(obs):
    got = sorted(r["ts"] for r in ob.in_range(obs, "2024-01-02", "2024-01-03").collect())
    assert got[0] == datetime(2024, 1, 2) and got[-1] == datetime(2024, 1, 3) and len(got) == 5
    late = ob.in_range(obs, "2024-01-02", "2024-01-03T12:00:00Z")
    assert late.count() == 7
    with pytest.raises(ValueError, match="both its ends"):
        ob.in_range(obs, "", "2024-01-03")


def test_range_on_instants(obs):
    instants = obs.withColumn("ts", F.col("ts").cast("timestamp"))
    assert ob.in_range(instants, "2024-01-02", "2024-01-03").count() == 5


def test_exceedances_are_strict_and_count_beyond_the_sample(obs, datastreams):
    above = ob.exceedances(obs, datastreams, 10.0, True).orderBy("rank").collect()
    assert len(above) == 20 and {r["total"] for r in above} == {30}
    assert above[0]["result"] == 11.0 and above[0]["unit"] == "m³/s"
    below = ob.exceedances(obs, datastreams, 2.0, False).collect()
    assert sorted(r["result"] for r in below) == [0.0, 1.0]


@pytest.mark.parametrize("tie_break", ["obs_id", None])
def test_latest(obs, datastreams, tie_break):
    rows = ob.latest(obs.filter("obs_id <> 39"), datastreams, tie_break).collect()
    assert [(r["datastream"], r["result"], r["ts"]) for r in rows] == [("Q@100", 99.0, T0 + timedelta(hours=234))]


def test_latest_breaks_ties(obs, datastreams):
    assert ob.latest(obs, datastreams, "obs_id").first()["result"] == 99.0


def test_inspect_and_samples(obs, datastreams):
    table = {r["datastream_id"]: r for r in ob.inspect_series(obs, datastreams).collect()}
    assert table[1]["n_obs"] == 41 and table[1]["first_ts"] == T0
    assert table[2]["n_obs"] == 0 and table[2]["last_ts"] is None
    assert table[2]["phenomenon_time"] == "x/y" and table[1]["phenomenon_time"] == "unknown"
    rows = ob.sample_series(obs, datastreams, 2).collect()
    assert sorted((r["edge"], r["rank"], r["obs_id"]) for r in rows) == [
        ("first", 1, 0), ("first", 2, 1), ("last", 1, 40), ("last", 2, 39),
    ]


def load(spark, things, datastreams, obs, texts):
    requested = spark.createDataFrame([(t,) for t in texts], "text string")
    return bulk_load(requested, things, datastreams, obs, "Q", "1D", "2024-01-02", "2024-01-03")


def test_bulk_load_reports_each_station(spark, things, datastreams, obs, tmp_path):
    loaded = load(spark, things, datastreams, obs, ["jena", "gera", "weimar", "nowhere"])
    status = {r["text"]: (r["status"], r["n_obs"]) for r in loaded.status.collect()}
    assert status == {
        "jena": ("loaded", 5), "gera": ("no_data", 0), "weimar": ("no_datastream", 0), "nowhere": ("no_station", 0),
    }
    assert ob.missing(loaded.status).count() == 3
    assert {tuple(r) for r in ob.count_status(loaded.status).collect()} >= {("loaded", 1)}
    assert loaded.rows.count() == 5


def test_load_one(spark, things, datastreams, obs, tmp_path):
    out = str(tmp_path)
    path = load_one("jENA", "Q", "1D", "2024-01-02", "2024-01-03", out, things, datastreams, obs)
    assert path.endswith("/Q_Jena_-_Saale_1D.csv")
    text = spark.read.text(path).collect()
    assert text[0]["value"] == "phenomenonTime,Q_m³/s" and len(text) == 6
    for station, message in [("nowhere", "no station"), ("weimar", "no such datastream"), ("gera", "no rows")]:
        with pytest.raises(LoadError, match=message):
            load_one(station, "Q", "1D", "2024-01-02", "2024-01-03", out, things, datastreams, obs)
    with pytest.raises(ValueError, match="needs a station"):
        load_one("", "Q", "1D", "2024-01-02", "2024-01-03", out, things, datastreams, obs)


def test_hot_series_stays_whole(spark, datastreams):
    hot = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 2).otherwise(1).cast("bigint").alias("datastream_id"),
        (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id"))).alias("ts"),
        (F.col("id") % 100).cast("double").alias("result"),
        F.col("id").alias("obs_id"),
    )
    assert ob.with_unit(hot, datastreams).count() == 30_000
    totals = {r["datastream_id"]: r["total"] for r in ob.exceedances(hot, datastreams, 49.0).collect()}
    assert totals == {1: 10_000, 2: 5_000}
