from __future__ import annotations

import math
from dataclasses import replace
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from hydroflow.config import ForecastConfig
from hydroflow.operators import features, forecast, forest, leaves
from hydroflow.operators.lookback import lookback

START = datetime(2024, 1, 1)
KEYS = ["plant"]
NAMES = ["discharge_a", "discharge_b"]
SCHEMA = "plant string, ts timestamp_ntz, discharge_a double, discharge_b double, other double, power double"
CONFIG = ForecastConfig(steps_per_hour=1, window_steps=6, horizon_steps=5, ma_hours=3, demo_hour=10)


def plant_rows(plant="A", hours=24 * 6, seed=3, skip=()):
    rng = np.random.default_rng(seed)
    out = []
    for h in range(hours):
        if h in skip:
            continue
        a, b = float(rng.integers(0, 50)), float(rng.integers(0, 9))
        out.append((plant, START + timedelta(hours=h), a, b, float(h), 2 * a + b))
    return out


@pytest.fixture(scope="module")
def wide(spark):
    # Plant B has no row at 10:00 on the third day.
    return spark.createDataFrame(plant_rows() + plant_rows("B", seed=4, skip={58}), SCHEMA).cache()


def launches(wide):
    return forecast.daily_cutoffs(wide, CONFIG, KEYS)


def test_lookback_is_time_major_and_ends_at_the_cutoff(wide):
    got = lookback(wide, KEYS, ["ts"], NAMES, launches(wide), 6).collect()
    rows = {"A": plant_rows(), "B": plant_rows("B", seed=4, skip={58})}
    assert len(got) == 12
    for r in got:
        times = [x[1] for x in rows[r["plant"]]]
        if r["cutoff"] not in times:
            assert (r["plant"], r["status"], r["lookback"]) == ("B", "no_cutoff", None)
            continue
        at = times.index(r["cutoff"])
        want = [v for x in rows[r["plant"]][at - 5 : at + 1] for v in x[2:4]]
        assert (r["status"], r["n_rows"], r["lookback"]) == ("ok", 6, want)


def test_lookback_guards(spark, wide):
    asked = spark.createDataFrame(
        [("A", START + timedelta(hours=h)) for h in (4, 5, 30)] + [("C", START)], "plant string, cutoff timestamp_ntz"
    )
    holes = wide.withColumn("discharge_a", F.when(F.col("ts") == START + timedelta(hours=28), math.nan).otherwise(F.col("discharge_a")))
    got = lookback(holes, KEYS, ["ts"], NAMES, asked, 6)
    assert {(r["plant"], r["cutoff"].day, r["cutoff"].hour, r["status"], r["n_rows"]) for r in got.collect()} == {
        ("A", 1, 4, "short_history", 5), ("A", 1, 5, "ok", 6), ("A", 2, 6, "missing_values", 6), ("C", 1, 0, "no_cutoff", 0),
    }


def test_lookback_takes_the_first_of_repeated_times(spark):
    rows = [("A", START, 1, 1.0), ("A", START + timedelta(hours=1), 2, 2.0), ("A", START + timedelta(hours=1), 3, 3.0)]
    df = spark.createDataFrame(rows, "plant string, ts timestamp_ntz, id bigint, x double")
    asked = spark.createDataFrame([("A", START + timedelta(hours=1))], "plant string, cutoff timestamp_ntz")
    assert lookback(df, KEYS, ["ts", "id"], ["x"], asked, 2).first()["lookback"] == [1.0, 2.0]
    found = features.rows_at(df, KEYS, ["ts", "id"], asked).first()
    assert found["found"] and found["x"] == 2.0
    none = features.rows_at(df, KEYS, ["ts", "id"], asked.withColumn("cutoff", F.col("cutoff") + F.expr("interval 1 day"))).first()
    assert not none["found"] and none["x"] is None


def test_lookback_of_null_keys_and_repeated_rows(spark):
    rows = [(None, START + timedelta(hours=h), float(h)) for h in (0, 1, 1, 2)]
    df = spark.createDataFrame(rows, "plant string, ts timestamp_ntz, x double")
    asked = spark.createDataFrame([(None, START + timedelta(hours=2))], "plant string, cutoff timestamp_ntz")
    row = lookback(df, KEYS, ["ts"], ["x"], asked, 4).first()
    assert (row["status"], row["lookback"]) == ("ok", [0.0, 1.0, 1.0, 2.0])


def test_features_are_prefix_columns_then_the_trailing_mean(wide):
    frame, names = features.build_features(wide, CONFIG, KEYS)
    assert names == ["discharge_a", "discharge_b", "power_ma_3h"]
    rows = [r for r in frame.orderBy("plant", "ts").collect() if r["plant"] == "A"]
    power = [x[5] for x in plant_rows()]
    assert rows[0]["power_ma_3h"] == power[0]
    assert rows[9]["power_ma_3h"] == pytest.approx(np.mean(power[7:10]))
    plain, names = features.build_features(wide, replace(CONFIG, ma_hours=0), KEYS)
    assert names == NAMES


def test_no_leakage_into_features(wide):
    cut = START + timedelta(days=3)
    changed = wide.withColumn("power", F.when(F.col("ts") > cut, -1.0).otherwise(F.col("power")))
    before, after = (
        features.build_features(df, CONFIG, KEYS)[0].filter(F.col("ts") <= cut).orderBy("plant", "ts").collect()
        for df in (wide, changed)
    )
    assert before == after


def test_guards():
    features.check_features(["a", "b"], ("a", "b"))
    with pytest.raises(ValueError, match="Feature columns"):
        features.check_features(["b", "a"], ("a", "b"))
    assert features.plant_target("Burgau (Jena)") == "power_burgau"
    with pytest.raises(ValueError, match="Plant must be"):
        features.plant_target("elsewhere")


def test_splits_and_cutoffs(spark):
    times = [datetime(2024, 1, 1), datetime(2024, 1, 1, 23, 59), datetime(2024, 1, 2), datetime(2024, 1, 4)]
    df = spark.createDataFrame([("A", t) for t in times] + [("B", times[0])], "plant string, ts timestamp_ntz")
    assert features.history_until(df, "ts", date(2024, 1, 1)).count() == 3
    assert features.rows_after(df, "ts", date(2024, 1, 1)).count() == 1
    assert features.rows_after(df, "ts", date(2024, 1, 2)).count() == 0  # the next calendar day, not the next present one
    got = sorted((r["plant"], r["day"].day) for r in features.valid_cutoffs(df, "ts", KEYS).collect())
    assert got == [("A", 1), ("A", 2)]
    assert [(r["plant"], r["day"].day) for r in features.default_cutoff(df, "ts", KEYS).collect()] == [("A", 2)]


@pytest.fixture(scope="module")
def plant(wide):
    return wide.filter("plant = 'A'").drop("plant")


@pytest.fixture(scope="module")
def run(plant):
    return forest.as_of_run(plant, "ts", "power", date(2024, 1, 4), trees=10, max_depth=5)


def test_run_frame(run, plant):
    assert run.features == ["discharge_a", "discharge_b", "other"]
    rows = run.frame.collect()
    by_series = {}
    for r in rows:
        by_series.setdefault(r["series"], []).append(r)
    assert {s: len(v) for s, v in by_series.items()} == {"actual": 24, "trend": 24, "next_day_actual": 24, "prediction": 24}
    assert {r["ts"].day for r in by_series["actual"]} == {4}
    assert {r["ts"].day for r in by_series["prediction"]} == {5}
    assert all(r["value"] >= 0 for r in by_series["prediction"])
    peak = run.peak().first()
    assert peak["starts_at"] == datetime(2024, 1, 5)
    assert peak["peak"] == max(r["value"] for s in ("next_day_actual", "prediction") for r in by_series[s])


def test_importance(run):
    rows = run.importance.collect()
    values = [r["importance"] for r in rows]
    assert values == sorted(values) and min(values) >= 0 and sum(values) == pytest.approx(1)
    assert rows[-1]["feature"] == "discharge_a"


def test_training_sees_nothing_after_the_cutoff(run, plant):
    late = F.col("ts") >= datetime(2024, 1, 5)
    changed = plant.withColumn("power", F.when(late, 1e6).otherwise(F.col("power")))
    again = forest.as_of_run(changed, "ts", "power", date(2024, 1, 4), trees=10, max_depth=5)
    a, b = (
        [r["power_pred"] for r in x.scored.orderBy("ts").collect()] for x in (run, again)
    )
    assert a == b


def test_forest_does_not_depend_on_how_the_table_is_split(spark, plant):
    names = ["discharge_a", "discharge_b", "other"]
    parts = [plant.repartition(n) for n in (1, 3, 8)]
    first, *others = [
        [r["power_pred"] for r in forest.predict_known_features(forest.fit_forest(p, names, "power", trees=5, max_depth=6), plant, names).orderBy("ts").collect()]
        for p in parts
    ]
    assert all(x == first for x in others)


def test_missing_next_day_and_missing_history(plant):
    last = forest.as_of_run(plant, "ts", "power", date(2024, 1, 6), trees=2, max_depth=2)
    assert last.frame.filter("series = 'prediction'").count() == 0
    with pytest.raises(ValueError, match="no training rows"):
        forest.as_of_run(plant, "ts", "power", date(2023, 1, 1), trees=2, max_depth=2)


def test_backtest_marks_each_cutoff(plant):
    got = forest.backtest(plant, "ts", "power", [date(2024, 1, 3), date(2024, 1, 4)], trees=2, max_depth=3)
    assert {(r["cutoff"].day, r["n"]) for r in got.groupBy("cutoff").agg(F.count("*").alias("n")).collect()} == {(3, 24), (4, 24)}


def fitted(wide, per_step):
    bundle = forecast.train_forecast(wide, CONFIG, KEYS, per_step=per_step, trees=3, max_depth=3)
    frame, names = features.build_features(wide, CONFIG, KEYS)
    return bundle, lookback(frame, KEYS, ["ts"], names, launches(wide), CONFIG.window_steps)


@pytest.mark.parametrize("per_step", [False, True])
def test_multistep_forecast(spark, wide, tmp_path, per_step):
    bundle, windows = fitted(wide, per_step)
    assert len(bundle.models) == (5 if per_step else 1)
    got = forecast.forecast_from_history(windows, bundle, KEYS).collect()
    usable = windows.filter("status = 'ok'").count()
    assert usable == 11 and len(got) == usable * 5
    for r in got:
        assert r["ts"] == r["cutoff"] + timedelta(hours=r["step"])

    path, source = str(tmp_path / "model"), str(tmp_path / "wide")
    wide.write.parquet(source)
    forecast.save_bundle(spark, bundle, path)
    one = forecast.predict_for_date(spark, "2024-01-04", path, source, plant="B").collect()
    want = sorted((r["ts"], r["power_pred"]) for r in got if r["plant"] == "B" and r["cutoff"].day == 4)
    assert [(r["ts"], r["power_pred"]) for r in one] == want

    with pytest.raises(ValueError, match="several series"):
        forecast.predict_for_date(spark, "2024-01-04", path, source)
    with pytest.raises(ValueError, match="not in the data"):
        forecast.predict_for_date(spark, date(2024, 1, 3), path, source, plant="B")
    with pytest.raises(ValueError, match="not in the data"):
        forecast.predict_for_date(spark, date(2025, 1, 3), path, source, plant="B")
    short = str(tmp_path / "short")
    wide.filter(F.col("ts") >= datetime(2024, 1, 4, 8)).write.parquet(short)
    with pytest.raises(ValueError, match="has 3 of 6 rows"):
        forecast.predict_for_date(spark, datetime(2024, 1, 4, 23), path, short, plant="B")
    renamed = str(tmp_path / "renamed")
    wide.withColumnRenamed("other", "discharge_c").write.parquet(renamed)
    with pytest.raises(ValueError, match="Feature columns"):
        forecast.predict_for_date(spark, "2024-01-04", path, renamed, plant="B")


def test_missing_bundle(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="No saved forecast model"):
        forecast.load_bundle(spark, str(tmp_path / "none"))


def test_training_rows_stop_at_the_given_time(wide):
    frame, names = features.build_features(wide, CONFIG, KEYS)
    windows = lookback(frame, KEYS, ["ts"], names, launches(wide), CONFIG.window_steps)
    until = datetime(2024, 1, 3, 12)
    rows = forecast.training_rows(windows, frame, CONFIG, KEYS, until)
    assert rows.agg(F.max("ts")).first()[0] == until


def test_single_step_rows_are_those_of_the_whole_horizon(wide):
    frame, names = features.build_features(wide, CONFIG, KEYS)
    windows = lookback(frame, KEYS, ["ts"], names, launches(wide), CONFIG.window_steps)
    every = forecast.training_rows(windows, frame, CONFIG, KEYS).filter("step = 3")
    only = forecast.training_rows(windows, frame, CONFIG, KEYS, step=3).select(*every.columns)
    assert sorted(every.collect()) == sorted(only.collect())


# Leaf tables


def test_vector_forecast_is_the_mean_of_its_leaf(spark, tmp_path):
    """Look-backs of two classes: each step's forecast is the class's mean over the launches that have a target there."""
    rows = [("A", START + timedelta(hours=h), float(h // 24 % 2), float(h % 7 + 100 * (h // 24 % 2))) for h in range(24 * 8) if h not in (37, 90)]
    rows += [(None, *r[1:3], r[3] + 1000) for r in rows]
    df = spark.createDataFrame(rows, "plant string, ts timestamp_ntz, discharge_class double, power double")
    config = replace(CONFIG, ma_hours=0, window_steps=2)
    bundle = leaves.train_vector(df, config, KEYS, trees=2, bootstrap=False)
    leaves.save_vector(spark, bundle, str(tmp_path / "m"))
    read = leaves.load_vector(spark, str(tmp_path / "m"))
    got = leaves.vector_forecast_cutoffs(df, read, launches_of(df, config), KEYS).collect()
    power = {(p, t): v for p, t, _, v in rows}
    wanted = {}
    for p, t, c, _ in rows:
        if t.hour == config.demo_hour:
            for step in range(1, 6):
                same = [u for q, u, d, _ in rows if u.hour == config.demo_hour and d == c]
                values = [power[q, u + timedelta(hours=step)] for u in same for q in ("A", None) if (q, u + timedelta(hours=step)) in power]
                wanted[p, t, step] = sum(values) / len(values)
    assert {(r.plant, r.cutoff, r.step): r.power_pred for r in got} == pytest.approx(wanted)
    assert all(r.ts == r.cutoff + timedelta(hours=r.step) for r in got)
    assert bundle.table.count() <= 2 * 2
    with pytest.raises(FileNotFoundError):
        leaves.load_vector(spark, str(tmp_path / "none"))


def launches_of(df, config):
    return forecast.daily_cutoffs(df, config, KEYS)


def test_vector_forecast_repeats_no_lookback(spark, wide):
    windows = lookback(wide, KEYS, ["ts"], NAMES, launches(wide), 6)
    vectors = leaves.target_vectors(windows, wide, CONFIG, KEYS)
    assert vectors.count() == windows.filter("status = 'ok'").count()
    assert all(len(r.targets) == CONFIG.horizon_steps for r in vectors.collect())
    until = leaves.target_vectors(windows, wide, CONFIG, KEYS, datetime(2024, 1, 2, 12)).collect()
    assert {tuple(x is None for x in r.targets) for r in until if r.cutoff.day == 2} == {(False, False, True, True, True)}


def keyed(spark, plants, days=3):
    rows = [(p, START + timedelta(hours=h), float(h % 4), 10.0 * p + (h % 4) + h // 24) for p in range(plants) for h in range(24 * 4)]
    df = spark.createDataFrame(rows, "plant int, ts timestamp_ntz, hour double, power double")
    cutoffs = df.select("plant", F.to_date("ts").alias("day")).distinct().filter(F.dayofmonth("day") <= days)
    return rows, df, cutoffs


def test_keyed_runs_equal_runs_of_their_own(spark):
    rows, df, cutoffs = keyed(spark, 3)
    found = leaves.keyed_runs(df, KEYS, "ts", "power", cutoffs, trees=2, bootstrap=False)
    got = {(r.plant, r.cutoff, r.ts): r.power_pred for r in found.scored.collect()}
    wanted = {}
    for p, t, hour, _ in rows:
        for day in (1, 2, 3):
            if t.date() == date(2024, 1, day + 1):
                own = [v for q, u, h, v in rows if q == p and u.date() <= date(2024, 1, day) and h == hour]
                wanted[p, date(2024, 1, day), t] = sum(own) / len(own)
    assert got == pytest.approx(wanted)
    peaks = {(r.plant, r.cutoff): r.peak for r in found.peaks(KEYS).collect()}
    assert peaks == {(p, date(2024, 1, d)): 10.0 * p + 3 + d for p in range(3) for d in (1, 2, 3)}


def test_keyed_runs_take_as_many_jobs_for_any_number_of_plants(spark):
    def jobs(plants):
        _, df, cutoffs = keyed(spark, plants, days=1)
        spark.sparkContext.setJobGroup(f"keyed-{plants}", "")
        leaves.keyed_runs(df, KEYS, "ts", "power", cutoffs, trees=1, bootstrap=False, max_depth=6)
        n = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"keyed-{plants}"))
        spark.sparkContext.setJobGroup("others", "")
        return n

    few, many = jobs(2), jobs(14)
    # Levels that part the runs: a few passes more, whatever the number of plants; a fit each would add hundreds.
    assert many <= few + 8


def test_tasks_of_keyed_runs_hold_a_bounded_number_of_rows(spark, monkeypatch):
    dealt, own = [], leaves.dealt_by_content
    monkeypatch.setattr(leaves, "FOREST_TASK_ROWS", 20, raising=False)
    monkeypatch.setattr(leaves, "RUN_TASK_ROWS", 20, raising=False)
    monkeypatch.setattr(leaves, "dealt_by_content", lambda rows, *args, **named: dealt.append(rows) or own(rows, *args, **named))
    _, df, cutoffs = keyed(spark, 3)
    found = leaves.keyed_runs(df, KEYS, "ts", "power", cutoffs, trees=2, bootstrap=False)
    assert dealt[0].rdd.getNumPartitions() >= dealt[0].count() / 20 > 9
    # More than the shuffle partitions of the session, which adaptive execution merges by their few bytes.
    assert len(found.scored.inputFiles()) > 8


def test_keyed_runs_see_nothing_after_their_cutoff(spark):
    _, df, cutoffs = keyed(spark, 2)
    first = cutoffs.filter(F.dayofmonth("day") == 1)
    changed = df.withColumn("power", F.when(F.dayofmonth("ts") > 2, F.lit(-999.0)).otherwise(F.col("power")))
    runs = [leaves.keyed_runs(d, KEYS, "ts", "power", first, trees=3) for d in (df, changed)]
    a, b = ([tuple(r) for r in found.scored.orderBy("plant", "ts").collect()] for found in runs)
    assert a == b and len(a) == 48


def test_keyed_runs_without_rows(spark):
    _, df, cutoffs = keyed(spark, 1)
    with pytest.raises(ValueError, match="no training rows"):
        leaves.keyed_runs(df.limit(0), KEYS, "ts", "power", cutoffs)


def test_keyed_runs_train_on_what_differs_not_on_every_row(spark, monkeypatch):
    """Rows of a run that are equal in all features count together: as many rows as runs have hours, whatever the table holds."""
    dealt, own = [], leaves.dealt_by_content
    monkeypatch.setattr(leaves, "ALIKE_FROM", 0, raising=False)
    monkeypatch.setattr(leaves, "dealt_by_content", lambda rows, *args, **named: dealt.append(rows) or own(rows, *args, **named))
    rows, df, cutoffs = keyed(spark, 3)
    uneven = df.withColumn("power", F.col("power") + F.hour("ts") ** 2).withColumn("plant", F.when(F.col("plant") > 0, F.col("plant")))
    cutoffs = cutoffs.withColumn("plant", F.when(F.col("plant") > 0, F.col("plant")))
    found = leaves.keyed_runs(uneven, KEYS, "ts", "power", cutoffs, trees=2, bootstrap=False)
    assert dealt[0].count() == 9 * 4
    got = {(r.plant, r.cutoff, r.ts): (r.actual, r.power_pred) for r in found.scored.collect()}
    wanted = {}
    for p, t, hour, v in rows:
        for day in (1, 2, 3):
            if t.date() == date(2024, 1, day + 1):
                learned = [w + u.hour**2 for q, u, h, w in rows if q == p and u.date() <= date(2024, 1, day) and h == hour]
                wanted[p or None, date(2024, 1, day), t] = (v + t.hour**2, sum(learned) / len(learned))
    assert got.keys() == wanted.keys()
    assert all(got[k] == pytest.approx(wanted[k], rel=1e-12) for k in wanted)
    bounds = {(r.plant, r.cutoff): (r.least, r.most) for r in found.bounds.collect()}
    powers = {(p or None, d): [v + t.hour**2 for q, t, _, v in rows if q == p and t.date() <= d] for p in range(3) for d in [date(2024, 1, i) for i in (1, 2, 3)]}
    assert bounds == {k: (min(v), max(v)) for k, v in powers.items()}


def test_keyed_runs_part_means_that_lie_close_together(spark, monkeypatch):
    """Hours whose means differ by a millionth of a hundredth of the range, in runs of plants that are far apart."""
    monkeypatch.setattr(leaves, "ALIKE_FROM", 0, raising=False)
    rows = [
        (p, START + timedelta(days=d, hours=h, minutes=m), float(h), 1e5 * p + 1e4 * (m % 2) + 1e-4 * h)
        for p in range(3) for d in range(4) for h in range(6) for m in range(4)
    ]
    df = spark.createDataFrame(rows, "plant int, ts timestamp_ntz, hour double, power double")
    cutoffs = df.select("plant", F.to_date("ts").alias("day")).distinct().filter(F.dayofmonth("day") <= 3)
    found = leaves.keyed_runs(df, KEYS, "ts", "power", cutoffs, trees=2, bootstrap=False)
    scored = found.scored.collect()
    assert len(scored) == 3 * 3 * 6 * 4
    assert [r.power_pred for r in scored] == pytest.approx([1e5 * r.plant + 5e3 + 1e-4 * r.ts.hour for r in scored], rel=0, abs=1e-7)


@pytest.mark.parametrize("missing", [None, float("nan")])
def test_keyed_runs_take_no_missing_target(spark, monkeypatch, missing):
    monkeypatch.setattr(leaves, "ALIKE_FROM", 0, raising=False)
    _, df, cutoffs = keyed(spark, 1)
    holed = df.withColumn("power", F.when(F.col("ts") == F.lit(START), F.lit(missing).cast("double")).otherwise(F.col("power")))
    with pytest.raises(Exception, match="(?i)labels must not be null or nan"):
        leaves.keyed_runs(holed, KEYS, "ts", "power", cutoffs, trees=1, bootstrap=False)


def test_keyed_runs_of_rows_that_all_differ(spark, monkeypatch):
    """Nothing to count together: rows are trained on as they are, with the same result."""
    monkeypatch.setattr(leaves, "ALIKE_FROM", 0, raising=False)
    dealt, own = [], leaves.dealt_by_content
    monkeypatch.setattr(leaves, "dealt_by_content", lambda rows, *args, **named: dealt.append(rows) or own(rows, *args, **named))
    _, df, cutoffs = keyed(spark, 2, days=1)
    found = leaves.keyed_runs(df.withColumn("hour", F.hour("ts").cast("double")), KEYS, "ts", "power", cutoffs, trees=1, bootstrap=False)
    assert dealt[0].count() == 2 * 24
    assert all(r.power_pred == pytest.approx(10.0 * r.plant + r.ts.hour % 4) for r in found.scored.collect())


def test_trends_of_keyed_runs_move_only_what_they_need(spark, monkeypatch):
    moved, own = [], leaves.day_trailing_mean
    monkeypatch.setattr(leaves, "FOREST_TASK_ROWS", 20)
    monkeypatch.setattr(leaves, "tasks_for", lambda n, task_rows=20: -(-n // task_rows))
    monkeypatch.setattr(leaves, "day_trailing_mean", lambda df, *args: moved.append(df) or own(df, *args))
    rows, df, cutoffs = keyed(spark, 2, days=2)
    df, cutoffs = (x.withColumn("plant", F.when(F.col("plant") > 0, F.col("plant"))) for x in (df, cutoffs))
    found = leaves.keyed_runs(df, KEYS, "ts", "power", cutoffs, trees=1, bootstrap=False)
    got = {(r.plant, r.cutoff, r.ts, r.series): r.value for r in leaves.keyed_frame(df, found, KEYS, "ts", "power").collect()}
    assert sorted(moved[0].columns) == ["_target", "run", "ts"]
    assert moved[0].rdd.getNumPartitions() >= moved[0].count() / 20 > 4
    wanted = {}
    for p in (0, 1):
        for day in (1, 2):
            values = [(t, v) for q, t, _, v in rows if q == p and t.date() == date(2024, 1, day)]
            for i, (t, v) in enumerate(values):
                last = [w for _, w in values[max(0, i - 15) : i + 1]]
                wanted[p or None, date(2024, 1, day), t, "actual"] = v
                wanted[p or None, date(2024, 1, day), t, "trend"] = sum(last) / len(last)
    assert {k: v for k, v in got.items() if k[3] in ("actual", "trend")} == pytest.approx(wanted)
    assert len(got) == 4 * 96


def test_keyed_runs_part_the_means_of_a_small_plant_beside_a_large_one(spark, monkeypatch):
    monkeypatch.setattr(leaves, "ALIKE_FROM", 0, raising=False)
    rows = [
        (p, START + timedelta(days=d, hours=h, minutes=m), float(h), (1e8, 1e-2)[p] * h)
        for p in range(2) for d in range(6) for h in range(6) for m in range(2)
    ]
    df = spark.createDataFrame(rows, "plant int, ts timestamp_ntz, hour double, power double")
    cutoffs = df.select("plant", F.to_date("ts").alias("day")).distinct().filter(F.dayofmonth("day") <= 5)
    scored = leaves.keyed_runs(df, KEYS, "ts", "power", cutoffs, trees=2, bootstrap=False).scored.collect()
    assert len(scored) == 2 * 5 * 6 * 2
    assert [r.power_pred for r in scored] == pytest.approx([r.actual for r in scored], rel=1e-12)
