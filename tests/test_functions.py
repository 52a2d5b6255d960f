from __future__ import annotations

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hydroflow import functions as fn


def one(spark, value, kind, expression):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression.alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("value", "want"),
    [(-1.0, 0.0), (0.0, 0.0), (2.5, 2.5), (math.nan, 0.0), (None, None)],
)
def test_clip(spark, value, want):
    assert one(spark, value, "double", fn.clip_nonnegative("x")) == want


def test_nan_becomes_null(spark):
    assert one(spark, math.nan, "double", fn.null_if_nan("x")) is None
    assert one(spark, 1.5, "double", fn.null_if_nan("x")) == 1.5


def test_names(spark):
    assert one(spark, "Bad Salzungen / Werra", "string", fn.safe_name("x")) == "Bad_Salzungen_-_Werra"
    named = fn.series_name(F.lit("Q"), "x", F.lit("1D"))
    assert one(spark, "A/B", "string", named) == "Q_A-B_1D"
    assert one(spark, "m³/s", "string", fn.value_name(F.lit("Q"), "x")) == "Q_m³/s"


@pytest.mark.parametrize(
    ("text", "want"),
    [("2024-01-05", "2024-01-05T00:00:00Z"), ("2024-01-05T07:00:00Z", "2024-01-05T07:00:00Z")],
)
def test_iso_instant(spark, text, want):
    assert one(spark, text, "string", fn.iso_instant("x")) == want


def test_wall_clock_keeps_the_reading(spark):
    assert one(spark, "2024-07-01T12:30:00+02:00", "string", fn.wall_clock("x")) == datetime(2024, 7, 1, 12, 30)
    instant = fn.parse_instant("x").cast("string")
    assert one(spark, "2024-07-01T12:30:00+02:00", "string", instant) == "2024-07-01 10:30:00"


def test_german_time(spark):
    assert one(spark, "31.12.2025 23:45:00", "string", fn.parse_german("x")) == datetime(2025, 12, 31, 23, 45)
    assert one(spark, "kWh", "string", fn.parse_german("x", strict=False)) is None
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        one(spark, "kWh", "string", fn.parse_german("x"))


def test_numbers(spark):
    assert one(spark, "1.25", "string", fn.parse_number("x")) == 1.25
    assert one(spark, "x1", "string", fn.parse_number("x", strict=False)) is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, "x1", "string", fn.parse_number("x"))


def test_forecast_index(spark):
    at = datetime(2024, 1, 1, 10)
    index = one(spark, at, "timestamp_ntz", fn.forecast_index("x", 96, 4))
    assert len(index) == 96
    assert index[0] == datetime(2024, 1, 1, 10, 15)
    assert index[-1] == datetime(2024, 1, 2, 10)
    launch = one(spark, datetime(2024, 1, 1, 17, 3), "timestamp_ntz", fn.launch_time("x", 10))
    assert launch == at


def test_labels(spark):
    at = datetime(2024, 1, 1, 10)
    assert one(spark, at, "timestamp_ntz", fn.day_label("x")) == "Monday, 01 Jan 2024"
    assert one(spark, at, "timestamp_ntz", fn.minute_label("x")) == "2024-01-01 10:00"
