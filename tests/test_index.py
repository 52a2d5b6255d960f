"""Name index, regions, correlation of all pairs, and long frames, against plain versions."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hydroflow.operators import correlate, moving, names, regions


def test_names_equal_searching_every_name(spark):
    rng = random.Random(1)
    letters = "abAB /ä😀"
    stations = [(i, "".join(rng.choice(letters) for _ in range(rng.randint(0, 9)))) for i in range(300)] + [(300, None)]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 6))) for _ in range(400)] + [None]
    things = spark.createDataFrame(stations, "iot_id bigint, name string")
    asked = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r.text: (r.thing_id, r.station) for r in names.resolve_names(asked, things).collect()}
    wanted = {}
    for t in set(texts):
        hits = [(i, n) for i, n in stations if t and n is not None and t.lower() in n.lower()]
        wanted[t] = min(hits) if hits else (None, None)
    assert got == wanted
    assert sum(v[0] is not None for v in wanted.values()) > 50


def test_the_name_index_has_a_row_per_letter(spark):
    things = spark.createDataFrame([(1, "Jena / Saale"), (2, "x"), (3, ""), (4, None)], "iot_id bigint, name string")
    assert names.name_index(things).count() == len("Jena / Saale") + 1


def shape(points):
    return [{"lon": float(x), "lat": float(y)} for x, y in points]


def held(x, y, ring):
    """The winding of the ring around a point; the border does not count."""
    turn, n = 0.0, len(ring)
    for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1], strict=True):
        a, b = (x0 - x, y0 - y), (x1 - x, y1 - y)
        cross, dot = a[0] * b[1] - a[1] * b[0], a[0] * b[0] + a[1] * b[1]
        if cross == 0 and dot <= 0:
            return False
        turn += math.atan2(cross, dot)
    return n >= 3 and abs(turn) > 3


@pytest.mark.parametrize("cell", [0.25, 1.0, 7.0])
def test_regions_equal_trying_every_pair(spark, cell):
    rng = random.Random(2)
    points = [(i, rng.randint(0, 16) / 4, rng.randint(0, 16) / 4) for i in range(300)]
    rings = {f"box {i}": [(x, y), (x + w, y), (x + w, y + h), (x, y + h)] for i in range(8) for x, y, w, h in [[rng.randint(-2, 14) / 4 for _ in "xy"] + [rng.randint(1, 9) / 4 for _ in "wh"]]}
    rings |= {f"star {i}": [(2 + r * math.cos(k / 5 * math.pi), 2 + r * math.sin(k / 5 * math.pi)) for k, r in enumerate([2.0, 0.5 + i / 10] * 5)] for i in range(5)}
    rings |= {"line": [(0, 0), (4, 4)], "flat": [(0, 0), (4, 0), (2, 0)], "empty": []}
    things = spark.createDataFrame([(i, f"s{i}") for i, *_ in points] + [(999, "nowhere")], "iot_id bigint, name string")
    places = [(i, [x, y]) for i, x, y in points] + [(0, [9.0, 9.0]), (999, []), (None, [1.0, 1.0])]
    locations = spark.createDataFrame(places, "thing_id bigint, coordinates array<double>")
    asked = spark.createDataFrame([(k, shape(r)) for k, r in rings.items()], "region_id string, ring array<struct<lon: double, lat: double>>")
    got = sorted((r.region_id, r.iot_id) for r in regions.stations_in_regions(things, locations, asked, cell).collect())
    assert got == sorted((k, i) for k, ring in rings.items() for i, x, y in points if held(x, y, [tuple(map(float, p)) for p in ring]))


def test_cells_inside_need_no_polygon(spark):
    big = spark.createDataFrame([("a", shape([(0, 0), (10, 0), (10, 10), (0, 10)]))], "region_id string, ring array<struct<lon: double, lat: double>>")
    cells = regions.region_cells(big, 1.0)
    assert cells.filter("not border").count() == 64
    assert cells.filter("not border and edges is not null").count() == 0


def test_correlations_equal_numpy(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(200, 4)) + 1e6
    base[:, 1] += 3 * base[:, 0]
    rows = [(i % 2 or None, *(None if rng.random() < 0.2 else float("nan") if rng.random() < 0.1 else float(v) for v in r), 5.0) for i, r in enumerate(base)]
    df = spark.createDataFrame(rows, "plant int, a double, b double, c double, d double, e double")
    got = {(r.plant, r.a, r.b): (r.n, r.corr) for r in correlate.correlation_matrix(df, list("abcde"), ["plant"]).collect()}
    assert len(got) == 20
    for (plant, a, b), (n, corr) in got.items():
        own = [(r[1 + "abcde".index(a)], r[1 + "abcde".index(b)]) for r in rows if r[0] == plant]
        own = [(x, y) for x, y in own if x is not None and y is not None and x == x and y == y]
        assert n == len(own)
        assert corr is None if b == "e" else corr == pytest.approx(np.corrcoef(np.array(own).T)[0, 1], abs=1e-8)
    alone = correlate.correlation_matrix(df.select("a", "b").limit(1), ["a", "b"]).collect()
    assert [r.corr for r in alone] == [None]
    assert correlate.correlation_matrix(df.limit(0), ["a", "b"], ["plant"]).count() == 0


@pytest.mark.parametrize("frame, chunk", [(1, 10), (7, 3), (50, 10), (5000, 16)])
def test_long_frames_equal_the_window(spark, frame, chunk):
    rng = random.Random(frame)
    rows = [(rng.choice([1, 2, None]), rng.randint(0, 400), i, None if rng.random() < 0.3 else float("nan") if rng.random() < 0.1 else float(rng.randint(-99, 99))) for i in range(500)]
    df = spark.createDataFrame(rows, "plant int, ts int, id int, power double")
    by_window = moving.trailing_mean(df, ["plant"], ["ts", "id"], "power", frame, "mean")
    by_sums = moving.long_trailing_mean(df, ["plant"], ["ts", "id"], "power", frame, "mean", chunk_rows=chunk)
    assert by_sums.columns == by_window.columns
    a, b = ({r.id: r["mean"] for r in x.collect()} for x in (by_sums, by_window))
    # The window has no limits of its own between series; those of the sums do not reach over them.
    assert {k for k, v in a.items() if v is None} == {k for k, v in b.items() if v is None}
    assert {k: v for k, v in a.items() if v is not None} == pytest.approx({k: v for k, v in b.items() if v is not None})


def test_long_frames_plan_no_row_frame(spark):
    df = spark.range(100).select(F.lit(1).alias("plant"), F.col("id").alias("ts"), F.col("id").cast("double").alias("power"))
    plan = moving.long_trailing_mean(df, ["plant"], ["ts"], "power", 35_040, "mean")._jdf.queryExecution().toString()
    assert "35039" not in plan
