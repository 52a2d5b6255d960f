from __future__ import annotations

import json
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hydroflow.schemas import OBSERVATIONS_PAGE
from hydroflow.sinks import series as sinks
from hydroflow.sources import chains, pages, tables
from hydroflow.streaming import load_landed_pages


def land(folder, name, *documents):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(d) for d in documents), encoding="utf-8")


def obs_page(times, **extra):
    return {"value": [{"phenomenonTime": t, "result": r} for t, r in times], **extra}


def test_things_tolerate_missing_attributes(spark, tmp_path):
    land(tmp_path, "things.json", {"value": [
        {"@iot.id": 1, "name": "A", "description": "d", "properties": {"station_id": "9", "river": "Saale", "km": 3}},
        {"@iot.id": 2, "name": "B", "properties": None},
    ]})
    rows = pages.read_things(spark, str(tmp_path)).orderBy("iot_id").collect()
    assert [tuple(r) for r in rows] == [
        (1, "A", "d", "9", {"station_id": "9", "river": "Saale", "km": "3"}), (2, "B", None, None, None)
    ]


def test_datastreams_split_the_available_range(spark, tmp_path):
    land(tmp_path, "p.json", {"thing_id": 5, "value": [
        {"@iot.id": 1, "name": "Q@5", "unitOfMeasurement": {"symbol": "m³/s"},
         "properties": {"type": "TH_PEGELDATEN_1D", "parameter": "Q"},
         "phenomenonTime": "2010-01-01T00:00:00Z/2026-01-01T00:00:00Z"},
        {"@iot.id": 2, "name": "W@5"},
    ]})
    first, second = pages.read_datastreams(spark, str(tmp_path)).orderBy("iot_id").collect()
    assert (first["thing_id"], first["unit"], first["type"]) == (5, "m³/s", "TH_PEGELDATEN_1D")
    assert first["available_from"].year == 2010 and first["available_to"].year == 2026
    assert second["unit"] is None and second["available_from"] is None


def test_observation_pages_of_a_series_are_one_table(spark, tmp_path):
    root = tmp_path / "obs"
    land(root / "datastream_id=7", "1.json", obs_page([("2024-01-01T00:00:00Z", 1.0), ("2024-01-01T01:00:00+01:00", None)], **{"@iot.count": 3, "@iot.nextLink": "next"}))
    land(root / "datastream_id=7", "2.json", obs_page([("2024-01-02T00:00:00Z", 3.0)], **{"@iot.count": 3}))
    land(root / "datastream_id=8", "1.json", obs_page([], **{"@iot.count": 4}))
    rows = pages.read_observations(spark, str(root)).orderBy("ts", "result").collect()
    assert [(r["datastream_id"], r["result"]) for r in rows] == [(7, None), (7, 1.0), (7, 3.0)]
    landed = pages.read_pages(spark, str(root), OBSERVATIONS_PAGE)
    got = {r["datastream_id"]: (r["fetched"], r["announced"], r["n_pages"]) for r in pages.page_completeness(landed).collect()}
    assert got == {7: (3, 3, 2), 8: (0, 4, 1)}


def test_multi_line_page_and_malformed_page(spark, tmp_path):
    page = {"thing_id": 1, "value": [{"name": "x", "location": {"type": "Point", "coordinates": [11.5, 50.9]}}]}
    (tmp_path / "good").mkdir()
    (tmp_path / "good" / "p.json").write_text(json.dumps(page, indent=2))
    assert pages.read_locations(spark, str(tmp_path / "good"), multi_line=True).first()["coordinates"] == [11.5, 50.9]
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "p.json").write_text('{"thing_id": 1, "value": [')
    with pytest.raises(Exception, match="MALFORMED"):
        pages.read_locations(spark, str(tmp_path / "bad")).collect()


@pytest.fixture
def rows(spark):
    data = [
        ("Q", 1, "Jena / Saale", "1D", "m³/s", datetime(2024, 1, d), float(d)) for d in (3, 1, 2)
    ] + [("W", 2, "Gera", "1D", "cm", datetime(2024, 1, 1), 5.0)]
    schema = "param string, station_id bigint, station string, freq string, unit string, ts timestamp_ntz, result double"
    return spark.createDataFrame(data, schema)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_store_replaces_only_written_series(spark, rows, tmp_path, fmt):
    path = str(tmp_path / "store")
    sinks.write_series(rows, path, fmt)
    sinks.write_series(rows.filter("param = 'Q'").withColumn("result", F.col("result") * 10), path, fmt)
    got = sinks.read_series(spark, path, fmt)
    assert sorted((r["station"], r["result"], r["unit"]) for r in got.collect()) == [
        ("Gera", 5.0, "cm"), ("Jena / Saale", 10.0, "m³/s"), ("Jena / Saale", 20.0, "m³/s"), ("Jena / Saale", 30.0, "m³/s"),
    ]
    counts = sinks.count_series(spark, path, fmt).first()
    assert (counts["n_series"], counts["n_rows"]) == (2, 4) and counts["n_files"] >= 2
    plan = got.filter("param = 'Q'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(param" in plan


def test_store_keeps_stations_of_like_names_apart(spark, tmp_path):
    path, n = str(tmp_path / "store"), 60
    data = [("Q", i, "A/B" if i % 2 else "A-B", "1D", "x", datetime(2024, 1, 1), float(i)) for i in range(n)]
    schema = "param string, station_id bigint, station string, freq string, unit string, ts timestamp_ntz, result double"
    sinks.write_series(spark.createDataFrame(data, schema), path)
    again = spark.createDataFrame([("Q", 3, "A/B", "1D", "x", datetime(2024, 1, 2), -1.0)], schema)
    sinks.write_series(again, path)
    store = sinks.read_series(spark, path)
    got = {(r["station_id"], r["station"], r["result"]) for r in store.collect()}
    assert got == {(i, s, -1.0 if i == 3 else v) for _, i, s, _, _, _, v in data}
    counts = sinks.count_series(spark, path).first()
    assert counts["n_series"] == n and counts["n_files"] <= 4


def size_of(path):
    return sum(f.stat().st_size for f in Path(path).rglob("*") if f.is_file())


def series_rows(spark, ids, value, n=50):
    schema = "param string, station_id bigint, station string, freq string, unit string, ts timestamp_ntz, result double"
    data = [("Q", i, f"S{i}", "1D", "x", datetime(2024, 1, 1, h % 24, h // 24), value) for i in ids for h in range(n)]
    return spark.createDataFrame(data, schema)


def test_a_load_writes_the_same_bytes_whatever_the_store_holds(spark, tmp_path):
    grown = []
    for n in (1, 300):
        path = str(tmp_path / f"store-{n}")
        sinks.write_series(series_rows(spark, range(1000, 1000 + n), 1.5), path)
        before = size_of(path)
        sinks.write_series(series_rows(spark, [7], 2.5), path)
        grown.append(size_of(path) - before)
    assert abs(grown[0] - grown[1]) < 200


def test_compaction_and_vacuum_keep_what_counts(spark, tmp_path):
    path = str(tmp_path / "store")
    for value in (1.0, 2.0, 3.0):
        sinks.write_series(series_rows(spark, range(int(value), 6), value, 2), path)
    sinks.write_series(series_rows(spark, [None], 9.0, 2), path)
    wanted = {1: 1.0, 2: 2.0, 3: 3.0, 4: 3.0, 5: 3.0, None: 9.0}

    def held():
        rows = sinks.read_series(spark, path).collect()
        assert len(rows) == 2 * len({r["station_id"] for r in rows})
        return {r["station_id"]: r["result"] for r in rows}

    assert held() == wanted
    assert not sinks.compact(spark, path, loads=8)
    assert sinks.compact(spark, path, loads=2)
    assert held() == wanted
    assert sinks.vacuum(spark, path) == 0 and held() == wanted
    assert sinks.vacuum(spark, path, keep_hours=-1) == 4 and held() == wanted
    assert sinks.series_versions(spark, path).count() == len(wanted)
    ranges = sinks.series_ranges(spark, path)
    assert {(r.n_rows, r.first_ts, r.last_ts) for r in ranges.collect()} == {(2, datetime(2024, 1, 1, 0), datetime(2024, 1, 1, 1))}
    assert "/rows" not in "".join(ranges.inputFiles())
    sinks.write_series(series_rows(spark, [4], 5.0, 2), path)
    assert held() == wanted | {4: 5.0}


def test_rows_of_a_load_that_failed_are_not_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    sinks.write_series(series_rows(spark, [1, 2], 1.0, 2), path)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(sinks, "_list", fail)
        with pytest.raises(RuntimeError):
            sinks.write_series(series_rows(spark, [2, 3], 5.0, 2), path)
    assert {(r["station_id"], r["result"]) for r in sinks.read_series(spark, path).collect()} == {(1, 1.0), (2, 1.0)}


def test_csv_has_the_value_header_and_reads_back(spark, rows, tmp_path):
    path = str(tmp_path / "q.csv")
    sinks.export_csv(rows.filter("param = 'Q'"), path, "Q", "m³/s")
    assert spark.read.text(path).first()["value"] == "phenomenonTime,Q_m³/s"
    back = tables.read_observation_csv(spark, path, "Q_m³/s").collect()
    assert [tuple(r) for r in back] == [(datetime(2024, 1, d), float(d)) for d in (1, 2, 3)]


def test_export_writes_instants_in_utc(spark, tmp_path):
    obs = spark.sql("SELECT timestamp'2024-07-01 12:00:00+02:00' AS ts, 1.0D AS result")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        sinks.export_csv(obs, str(tmp_path / "u"), "Q", "x")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert spark.read.text(str(tmp_path / "u")).collect()[1]["value"] == "2024-07-01T10:00:00.000000Z,1.0"


def test_window_export_summary(spark, tmp_path):
    data = [(7, datetime(2024, 1, d), float(d)) for d in (1, 2, 3)] + [(8, datetime(2024, 1, 1), 9.0)]
    obs = spark.createDataFrame(data, "datastream_id bigint, ts timestamp_ntz, result double")
    summary = sinks.export_window(obs, 7, "2024-01-02", "2024-01-03", str(tmp_path / "w")).collect()
    assert [tuple(r) for r in summary] == [(
        7, 2, "phenomenonTime,result", "2024-01-02T00:00:00.000000Z,2.0", "2024-01-03T00:00:00.000000Z,3.0",
    )]
    one = sinks.export_window(obs, 8, "2024-01-01", "2024-01-03", str(tmp_path / "o")).first()
    assert one["n_rows"] == 1 and one["last_line"] is None


GOOD = ["31.12.2025 23:45:00,01.01.2026 00:00:00,1.5,2", "01.01.2026 00:00:00,01.01.2026 00:15:00,,3.25"]
PREAMBLE = ["Einheit,,kW,kW", "Quelle,,,", ",,a,b", "Zaehler,,1,2", "Status,,ok,ok"]


def export_file(folder, lines):
    folder.mkdir()
    (folder / "e.csv").write_text("a,b,c,d\n" + "\n".join(lines) + "\n")
    return str(folder)


def test_windows_of_many_series_take_files_by_rows_not_by_series(spark, tmp_path):
    times = [datetime(2024, 1, 1, 0, minute) for minute in range(4)]
    data = [(s, t, (s or 0) + i / 4 if i else None) for s in [None, *range(300)] for i, t in enumerate(times)]
    obs = spark.createDataFrame(data[::-1], "datastream_id bigint, ts timestamp_ntz, result double").repartition(7)
    path = str(tmp_path / "windows")
    sinks.export_windows(obs, "2024-01-01", "2024-01-01T00:02:00", path)
    assert len([f for f in Path(path).rglob("*.csv")]) <= 8
    lines = sinks.read_window_lines(spark, path).orderBy("file", "block", "row").collect()
    found = {}
    for r in lines:
        found.setdefault(r["datastream_id"], []).append(r["line"])
    assert len(found) == 301
    for s in (0, 7, 299):
        own = str(tmp_path / f"own{s}")
        sinks.export_window(obs, s, "2024-01-01", "2024-01-01T00:02:00", own)
        assert ["phenomenonTime,result", *found[s]] == [r["value"] for r in spark.read.text(own).collect()]
    assert found[None][0] == "2024-01-01T00:00:00.000000Z,"


def test_plant_export(spark, tmp_path):
    raw = tables.read_plant_export(spark, export_file(tmp_path / "ok", PREAMBLE + GOOD))
    got = [tuple(r) for r in tables.clean_plant_export(raw).collect()]
    assert got == [
        (datetime(2025, 12, 31, 23, 45), datetime(2026, 1, 1), 1.5, 2.0),
        (datetime(2026, 1, 1), datetime(2026, 1, 1, 0, 15), None, 3.25),
    ]


def test_plant_export_strict_and_permissive(spark, tmp_path):
    bad_time = tables.read_plant_export(spark, export_file(tmp_path / "t", [*PREAMBLE, *GOOD, "2026-01-01,x,1,1"]))
    with pytest.raises(Exception, match="6 rows without a start time"):
        tables.clean_plant_export(bad_time).collect()
    assert tables.clean_plant_export(bad_time, strict=False).count() == 2
    bad_number = tables.read_plant_export(spark, export_file(tmp_path / "n", [*PREAMBLE, *GOOD, "01.01.2026 00:15:00,,x,1"]))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        tables.clean_plant_export(bad_number).collect()
    assert [r["el"] for r in tables.clean_plant_export(bad_number, strict=False).collect()] == [1.5, None, None]


def test_plant_csv(spark, tmp_path):
    for plant, day in (("A", 1), ("B", 2)):
        folder = tmp_path / "m" / f"plant={plant}"
        folder.mkdir(parents=True)
        lines = ["time,flow,power", f"2024-07-0{day}T00:15:00+02:00,1.0,2.0", f"2024-07-0{day} 00:30:00,,3.0", f"2024-07-0{day} 00:45:00,NaN,3.0"]
        (folder / "p.csv").write_text("\n".join(lines))
    df = tables.read_plant_csv(spark, str(tmp_path / "m"), ["flow", "power"], partitions=["plant"])
    assert [tuple(r) for r in df.orderBy("time").collect()] == [
        (datetime(2024, 7, 1, 0, 15), 1.0, 2.0, "A"), (datetime(2024, 7, 2, 0, 15), 1.0, 2.0, "B"),
    ]


def test_plant_csv_is_read_by_its_header(spark, tmp_path):
    (tmp_path / "p.csv").write_text("power,more,time,flow\n2.0,9,2024-07-01 00:15:00,1.0\n")
    assert tables.read_plant_csv(spark, str(tmp_path), ["flow", "power"]).first()[1:] == (1.0, 2.0)
    (tmp_path / "q.csv").write_text("flow,more,time,power\n2.0,9,2024-07-01 00:15:00,1.0\n")
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_plant_csv(spark, str(tmp_path), ["flow", "power"]).collect()
    (tmp_path / "q.csv").write_text("power,more,time,flow\nx,9,2024-07-01 00:15:00,1.0\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        tables.read_plant_csv(spark, str(tmp_path), ["flow", "power"]).collect()


def test_plant_export_in_parts(spark, tmp_path):
    folder = export_file(tmp_path / "parts", PREAMBLE + GOOD[:1])
    (tmp_path / "parts" / "f.csv").write_text("a,b,c,d\n" + GOOD[1] + "\n")
    assert tables.clean_plant_export(tables.read_plant_export(spark, folder, in_parts=True)).count() == 2


def test_rows_of_a_plant_export_stay_where_they_are_read(spark, tmp_path):
    folder = export_file(tmp_path / "parts", PREAMBLE + GOOD)
    least = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for files of any size
    try:
        clean = tables.clean_plant_export(tables.read_plant_export(spark, folder, in_parts=True))
        assert "SortMergeJoin" not in clean._jdf.queryExecution().executedPlan().toString()
        assert clean.count() == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", least)


def test_stream_takes_each_page_once(spark, tmp_path):
    landing, out, state = tmp_path / "landing", str(tmp_path / "out"), str(tmp_path / "state")
    land(landing, "1.json", {"datastream_id": 7, **obs_page([("2024-01-01T00:00:00Z", 1.0)])})
    load_landed_pages(spark, str(landing), out, state)
    land(landing, "2.json", {"datastream_id": 7, **obs_page([("2024-01-02T00:00:00Z", 2.0), ("2024-01-03T00:00:00Z", 3.0)])})
    load_landed_pages(spark, str(landing), out, state, max_files=1)
    load_landed_pages(spark, str(landing), out, state)
    assert sorted(r["result"] for r in spark.read.parquet(out).collect()) == [1.0, 2.0, 3.0]


def report(spark, pages, first=("p0",)):
    df = spark.createDataFrame(pages, "series bigint, own string, next string, n int")
    got = chains.chain_report(df, ["series"], "own", "next", F.col("own").isin(*first), F.col("n")).collect()
    return {r.series: (r.status, r.n_pages, r.n_rows, r.missing, r.n_orphans) for r in got}


def test_page_chains(spark):
    whole = [(1, f"p{i}", f"p{i + 1}" if i < 36 else None, 2) for i in range(37)]
    broken = [(2, "p0", "p1", 1), (2, "p2", "p3", 1), (2, "p3", None, 1)]
    loop = [(3, "p0", "p1", 1), (3, "p1", "p2", 1), (3, "p2", "p1", 1)]
    headless = [(4, "p1", "p2", 1), (4, "p2", None, 1)]
    unnamed = [(None, "p0", None, 4), (None, "p0", None, 4), (None, "x", "y", 1)]
    assert report(spark, whole + broken + loop + headless + unnamed) == {
        1: ("complete", 37, 74, None, 0), 2: ("broken", 1, 1, "p1", 2), 3: ("loop", 3, 3, None, 0), 4: ("no_first", 0, 0, None, 2),
        None: ("complete", 1, 4, None, 1),
    }
    assert report(spark, []) == {}


def test_pages_of_a_chain_are_in_order(spark):
    df = spark.createDataFrame([(1, f"p{i}", f"p{i + 1}") for i in range(20)], "series int, own string, next string")
    order = chains.follow_links(df, ["series"], "own", "next", F.col("own") == "p0").orderBy("at").collect()
    assert [(r.page, r["at"]) for r in order] == [(f"p{i}", i) for i in range(20)]
