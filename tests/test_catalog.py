from __future__ import annotations

import pytest

from hydroflow.operators import catalog

THINGS = [
    (3, "Jena", "Saale", "570"),
    (1, "Jena-Burgau", None, None),
    (2, "Bad Salzungen / Werra", "Werra", "412"),
    (4, "jena north", None, "9"),
]
DS_SCHEMA = (
    "iot_id bigint, thing_id bigint, name string, unit string, type string, parameter string, "
    "station_id string, measurement_start string, phenomenon_time string"
)
DAILY, QUARTER = "TH_PEGELDATEN_1D", "TH_PEGELDATEN_15MIN"
DATASTREAMS = [
    (12, 3, "Q@570", "m³/s", DAILY, "Q", "570", None, "2010/2026"),
    (11, 3, "Q@570 copy", "m³/s", DAILY, "Q", "570", None, None),
    (10, 3, "W@570", "cm", DAILY, "W", "570", None, None),
    (13, 3, "Q@570 fast", "m³/s", QUARTER, "Q", "570", None, None),
    (20, 2, "Q@412", None, None, None, None, None, None),
    (30, 1, "QQ@1", "m³/s", DAILY, "Q", None, None, None),
]


@pytest.fixture(scope="module")
def things(spark):
    return spark.createDataFrame(THINGS, "iot_id bigint, name string, description string, station_id string")


@pytest.fixture(scope="module")
def datastreams(spark):
    return spark.createDataFrame(DATASTREAMS, DS_SCHEMA)


def ids(df, column="iot_id"):
    return [r[column] for r in df.collect()]


def test_list_is_by_name_with_defaults_and_cap(things):
    rows = catalog.list_stations(things).collect()
    assert [r["iot_id"] for r in rows] == [2, 3, 1, 4]
    assert rows[2]["description"] == "" and rows[2]["station_id"] == ""
    assert ids(catalog.list_stations(things, limit=2)) == [2, 3]


def test_search_minds_case_and_find_does_not(things):
    assert ids(catalog.search_stations(things, "Jena")) == [1, 3]
    assert ids(catalog.search_stations(things, "JENA", ignore_case=True)) == [1, 3, 4]
    assert ids(catalog.find_station(things, "jENA")) == [1]
    assert ids(catalog.find_station(things, "nowhere")) == []
    with pytest.raises(ValueError, match="required"):
        catalog.find_station(things, "")


def test_bulk_resolution_is_find_station_for_each(spark, things):
    texts = ["Jena", "JENA-B", "north", "salzungen / w", "a", "nowhere", " ", "jena", "Jena"]
    requested = spark.createDataFrame([(t,) for t in texts] + [(None,)], "text string")
    got = sorted((r["text"] or "", r["thing_id"]) for r in catalog.resolve_stations(requested, things).collect())
    want = sorted((t, next(iter(ids(catalog.find_station(things, t))), None)) for t in set(texts))
    assert got == [("", None), *want]


def test_match_needs_prefix_with_at_and_type(datastreams):
    rows = catalog.match_datastreams(datastreams, "Q", "1D").collect()
    assert [(r["thing_id"], r["datastream_id"]) for r in rows] == [(3, 11)]
    assert ids(catalog.match_datastreams(datastreams, "Q", "15min"), "datastream_id") == [13]
    assert ids(catalog.match_datastreams(datastreams, "T", "1D")) == []
    with pytest.raises(ValueError, match="1D, 15min"):
        catalog.match_datastreams(datastreams, "Q", "1h")


def test_counts_name_the_unknown_and_sort(datastreams):
    assert [tuple(r) for r in catalog.count_by_type(datastreams).collect()] == [
        (DAILY, 4), (QUARTER, 1), ("unknown", 1),
    ]
    assert [tuple(r) for r in catalog.count_by_parameter(datastreams).collect()] == [("Q", 4), ("W", 1), ("unknown", 1)]


def test_frequencies_in_order(datastreams):
    rows = catalog.station_frequencies(datastreams).collect()
    assert [(r["thing_id"], r["freq_type"], r["datastream_id"]) for r in rows] == [
        (1, DAILY, 30), (2, "unknown", 20), (3, QUARTER, 13), (3, DAILY, 10), (3, DAILY, 11), (3, DAILY, 12),
    ]
    assert rows[1]["unit"] == "" and rows[1]["phenomenon_time"] == "no data"


def test_datastreams_of_stations(things, datastreams):
    rows = catalog.list_datastreams(things, datastreams).filter("thing_id = 2").collect()
    assert [(r["station"], r["datastream"], r["type"], r["phenomenon_time"]) for r in rows] == [
        ("Bad Salzungen / Werra", "Q@412", "", "no data")
    ]


def test_box_excludes_edges_and_repeats(spark, things):
    rows = [
        (3, "a", "Point", [11.5, 50.9]),
        (3, "b", "Point", [11.6, 50.8]),
        (1, "c", "Point", [12.0, 50.9]),
        (2, "d", "Point", []),
        (4, "e", "Point", [11.0, 50.0]),
    ]
    locations = spark.createDataFrame(rows, "thing_id bigint, location string, geo_type string, coordinates array<double>")
    assert ids(catalog.stations_in_box(things, locations, 11.0, 50.0, 12.0, 51.0)) == [3]
    placed = {(r["thing_id"], r["lon"], r["lat"]): r["geojson"] for r in catalog.station_locations(things, locations).collect()}
    assert placed[(2, None, None)] == '{"type":"Point","coordinates":[]}'
    assert placed[(1, 12.0, 50.9)] == '{"type":"Point","coordinates":[12.0,50.9]}'


def test_last_loaded_wins(spark):
    rows = [(1, "A", "old", "1"), (2, "A", None, None), (1, "B", "only", "2")]
    df = spark.createDataFrame(rows, "loaded bigint, name string, description string, station_id string")
    got = {tuple(r) for r in catalog.last_by_name(df, "loaded").collect()}
    assert got == {("A", None, None), ("B", "only", "2")}
