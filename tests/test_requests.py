"""Bulk loads of unlike requests."""

from __future__ import annotations

from datetime import datetime

import pytest

from hydroflow.plans import requests
from hydroflow.sinks import read_series

ASKED = "request_id bigint, text string, param string, freq string, start string, end string"


@pytest.fixture(scope="module")
def catalogue(spark):
    things = spark.createDataFrame([(1, "Jena / Saale"), (2, "Gera"), (3, "Jena Nord")], "iot_id bigint, name string")
    ds = [
        (10, 1, "Q@1", "m³/s", "TH_PEGELDATEN_1D"), (11, 1, "Q@1b", "m³/s", "TH_PEGELDATEN_1D"), (12, 1, "W@1", "cm", "TH_PEGELDATEN_15MIN"),
        (20, 2, "Q@2", None, "TH_PEGELDATEN_1D"), (21, 2, "odd", None, "TH_PEGELDATEN_1D"),
    ]
    obs = [(d, datetime(2024, m, 1, 0, 0), float(m)) for d in (10, 11, 12) for m in range(1, 13)] + [(10, datetime(2024, 3, 1, 0, 0, 1), 99.0)]
    return (
        things,
        spark.createDataFrame(ds, "iot_id bigint, thing_id bigint, name string, unit string, type string"),
        spark.createDataFrame(obs, "datastream_id bigint, ts timestamp_ntz, result double"),
    )


def load(spark, catalogue, rows):
    return requests.bulk_requests(spark.createDataFrame(rows, ASKED), *catalogue)


def test_windows_are_inclusive_and_may_overlap(spark, catalogue):
    rows = [
        (1, "JENA", "Q", "1D", "2024-01-01", "2024-03-01"),
        (2, "jena /", "Q", "1D", "2024-03-01", "2024-03-01T00:00:01Z"),
        (3, "saale", "W", "15min", "2024-12-01", "2030-01-01"),
        (4, "Jena", "Q", "1D", "2024-05-01", "2024-04-01"),
    ]
    found = load(spark, catalogue, rows)
    got = sorted((r.request_id, r.station_id, r.unit, r.ts.month, r.result) for r in found.rows.collect())
    q = "m³/s"
    assert got == [(1, 1, q, 1, 1.0), (1, 1, q, 2, 2.0), (1, 1, q, 3, 3.0), (2, 1, q, 3, 3.0), (2, 1, q, 3, 99.0), (3, 1, "cm", 12, 12.0)]
    status = {r.request_id: (r.status, r.n_obs) for r in found.status.collect()}
    assert status == {1: ("loaded", 3), 2: ("loaded", 2), 3: ("loaded", 1), 4: ("no_data", 0)}


def test_every_request_has_one_status(spark, catalogue):
    rows = [
        (1, None, "Q", "1D", "2024-01-01", "2024-03-01"), (2, " ", "X", "1H", "2024-01-01", "2024-03-01"),
        (3, "Jena", "Q", "1D", None, "2024-03-01"), (4, "Jena", "Q", "1H", "2024-01-01", "2024-03-01"),
        (5, "Jena", "X", "1D", "2024-01-01", "2024-03-01"), (6, "Jena", "odd", "1D", "2024-01-01", "2024-03-01"),
        (7, "Erfurt", "Q", "1D", "2024-01-01", "2024-03-01"), (8, "Nord", "Q", "1D", "2024-01-01", "2024-03-01"),
        (9, "Gera", "Q", "1D", "2024-01-01", "2024-03-01"), (10, "Gera", "Q", "15min", "2024-01-01", "2024-03-01"),
        (11, "Jena", "Q", None, "2024-01-01", "2024-03-01"), (12, "Jena", "Q", "1D", "soon", "2024-03-01"),
    ]
    status = {r.request_id: r.status for r in load(spark, catalogue, rows).status.collect()}
    assert status == {
        1: "incomplete", 2: "incomplete", 3: "incomplete", 4: "bad_frequency", 5: "bad_parameter", 6: "bad_parameter", 7: "no_station",
        8: "no_datastream", 9: "no_data", 10: "no_datastream", 11: "bad_frequency", 12: "incomplete",
    }
    none = load(spark, catalogue, [])
    assert none.rows.count() == 0 and none.status.count() == 0


def test_the_last_request_of_a_series_is_written(spark, catalogue, tmp_path):
    rows = [(1, "Jena", "Q", "1D", "2024-01-01", "2024-12-31"), (2, "Saale", "Q", "1D", "2024-06-01", "2024-07-01"), (3, "Jena", "W", "15min", "2024-02-01", "2024-02-01")]
    load(spark, catalogue, rows).write(str(tmp_path / "s"))
    got = sorted((r.param, r.ts.month, r.result) for r in read_series(spark, str(tmp_path / "s")).collect())
    assert got == [("Q", 6, 6.0), ("Q", 7, 7.0), ("W", 2, 2.0)]
