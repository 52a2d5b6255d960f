from __future__ import annotations

import math
from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hydroflow.functions import pearson
from hydroflow.operators import moving, positions, resample

START = datetime(2024, 1, 1)
SCHEMA = "plant string, ts timestamp_ntz, id bigint, power double"


def series(n, plant="A", gap_every=7, nan_every=5, seed=1):
    rng = np.random.default_rng(seed)
    rows, at = [], START
    for i in range(n):
        at += timedelta(minutes=15 * (1 + (i % gap_every == 0)))
        value = math.nan if i % nan_every == 3 else float(rng.integers(0, 1000))
        rows.append((plant, at, i, value))
    return rows


@pytest.fixture(scope="module")
def plants(spark):
    return spark.createDataFrame(series(300) + series(37, "B", seed=2), SCHEMA)


def expected_means(rows, window):
    pdf = pd.DataFrame(rows, columns=["plant", "ts", "id", "power"]).sort_values(["plant", "ts", "id"])
    pdf["mean"] = pdf.groupby("plant")["power"].transform(lambda s: s.rolling(window, min_periods=1).mean())
    return {(r.plant, r.id): r.mean for r in pdf.itertuples()}


def as_map(df, column):
    return {(r["plant"], r["id"]): r[column] for r in df.collect()}


def assert_same(got, want):
    assert got.keys() == want.keys()
    for key, value in want.items():
        if value is None or math.isnan(value):
            assert got[key] is None, key
        else:
            assert got[key] == pytest.approx(value, abs=1e-9), key


@pytest.mark.parametrize("window", [1, 4, 16, 400])
def test_trailing_mean_equals_rolling(plants, window):
    got = moving.trailing_mean(plants, ["plant"], ["ts", "id"], "power", window, "mean")
    assert_same(as_map(got, "mean"), expected_means(series(300) + series(37, "B", seed=2), window))


@pytest.mark.parametrize("chunk", [16, 17, 50])
def test_chunk_size_does_not_matter(plants, chunk):
    got = moving.trailing_mean(plants, ["plant"], ["ts", "id"], "power", 16, "mean", chunk_rows=chunk)
    assert got.count() == 337
    assert_same(as_map(got, "mean"), expected_means(series(300) + series(37, "B", seed=2), 16))


def test_day_trend_restarts_and_whole_series_mean_does_not(spark):
    rows = [("A", datetime(2024, 1, 1, 23), 1, 10.0), ("A", datetime(2024, 1, 2, 0), 2, 20.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    whole = moving.trailing_mean(df, ["plant"], ["ts", "id"], "power", 16, "m")
    daily = moving.day_trailing_mean(df, ["plant"], ["ts", "id"], "power", "m")
    assert as_map(whole, "m") == {("A", 1): 10.0, ("A", 2): 15.0}
    assert as_map(daily, "m") == {("A", 1): 10.0, ("A", 2): 20.0}


def test_row_index(plants):
    got = as_map(positions.row_index(plants, ["plant"], ["ts", "id"]), "row_index")
    assert got == {(p, i): i for p, n in (("A", 300), ("B", 37)) for i in range(n)}


def test_row_index_with_a_hot_key_and_null_keys(spark):
    key = F.when(F.col("id") % 50 == 0, "cold").when(F.col("id") % 10 == 3, F.lit(None)).otherwise("hot")
    df = spark.range(20_000).select(key.alias("plant"), (F.col("id") * 7919 % 20_000).alias("ts")).repartition(5)
    got = positions.row_index(df, ["plant"], ["ts"]).collect()
    assert len(got) == 20_000
    for plant in ("hot", "cold", None):
        own = sorted((r["ts"], r["row_index"]) for r in got if r["plant"] == plant)
        assert [i for _, i in own] == list(range(len(own)))


def test_means_of_null_keys(spark):
    rows = [(p, START + timedelta(hours=h), h, float(h)) for h in range(40) for p in ("A", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = moving.trailing_mean(df, ["plant"], ["ts", "id"], "power", 4, "mean", chunk_rows=8)
    assert as_map(got, "mean") == {(p, h): np.mean(range(max(0, h - 3), h + 1)) for h in range(40) for p in ("A", None)}


def test_global_positions_are_gap_free(spark):
    # One key holds almost all rows; the sort key still spreads them.
    df = spark.range(20_000).select(
        F.when(F.col("id") % 50 == 0, "cold").otherwise("hot").alias("plant"), (F.col("id") * 7919 % 20_000).alias("ts")
    )
    got = positions.global_positions(df, ["plant"], ["ts"])
    checked = got.orderBy("plant", "ts").select("pos").collect()
    assert [r["pos"] for r in checked] == list(range(20_000))


def test_daily_mean_fills_days_and_skips_nan(spark):
    rows = [
        (datetime(2024, 1, 1, 5), 1.0, 1.0),
        (datetime(2024, 1, 1, 6), math.nan, 3.0),
        (datetime(2024, 1, 4, 6), 5.0, math.nan),
    ]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, el double, el1 double")
    got = [tuple(r) for r in resample.daily_mean(df, "ts", ["el", "el1"]).orderBy("day").collect()]
    pdf = pd.DataFrame(rows, columns=["ts", "el", "el1"]).set_index("ts").resample("D").mean()
    want = [(t.date(), *(None if math.isnan(x) else x for x in row)) for t, row in zip(pdf.index, pdf.to_numpy(), strict=True)]
    assert got == want


def test_daily_mean_per_key_has_its_own_span(spark):
    rows = [("A", datetime(2024, 1, 1), 1.0), ("A", datetime(2024, 1, 3), 2.0), ("B", datetime(2024, 1, 2), 3.0)]
    df = spark.createDataFrame(rows, "plant string, ts timestamp_ntz, el double")
    got = resample.daily_mean(df, "ts", ["el"], ["plant"]).orderBy("plant", "day").collect()
    assert [(r["plant"], r["day"].day, r["el"]) for r in got] == [
        ("A", 1, 1.0), ("A", 2, None), ("A", 3, 2.0), ("B", 2, 3.0),
    ]


def test_join_needs_dates(spark):
    days = spark.createDataFrame([(date(2024, 1, 1), 1.0)], "day date, el double")
    times = spark.createDataFrame([(START, 1.0)], "day timestamp, q double")
    with pytest.raises(ValueError, match="dates"):
        resample.join_daily(days, times)


def correlation_of(spark, rows):
    df = spark.createDataFrame(rows, "x double, y double")
    return df.agg(pearson("x", "y").alias("r")).first()["r"]


def test_correlation_is_pairwise_complete(spark):
    rows = [(1.0, 2.0), (2.0, 1.0), (None, 9.0), (5.0, None), (math.nan, 7.0), (4.0, 8.0), (6.0, 7.0)]
    pdf = pd.DataFrame(rows, columns=["x", "y"], dtype=float)
    assert correlation_of(spark, rows) == pytest.approx(pdf["x"].corr(pdf["y"]))


@pytest.mark.parametrize("rows", [[(1.0, 2.0), (1.0, 3.0)], [(1.0, 2.0)], [(None, None)]])
def test_undefined_correlation_is_null(spark, rows):
    assert correlation_of(spark, rows) is None


def test_instants_need_a_zone_to_have_days(spark):
    rows = [("2024-03-31T00:30:00Z", 1.0), ("2024-03-31T22:30:00Z", 2.0), ("2024-10-27T22:59:00Z", 3.0)]
    df = spark.createDataFrame(rows, "at string, power double").withColumn("at", F.col("at").cast("timestamp"))
    with pytest.raises(ValueError, match="zone is required"):
        resample.zone_free(df, "at")
    clock = resample.zone_free(df, "at", "Europe/Berlin")
    assert [r["at"] for r in clock.orderBy("power").collect()] == [
        datetime(2024, 3, 31, 1, 30), datetime(2024, 4, 1, 0, 30), datetime(2024, 10, 27, 23, 59),
    ]
    assert resample.zone_free(clock, "at").collect() == clock.collect()
