"""Feature table, monitoring and streams."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from segue.operators import feature_store as fs
from segue.operators import monitor
from segue.streaming import jobs

START = dt.datetime(2024, 1, 1)


def at(hours):
    return START + dt.timedelta(hours=hours)


def test_feature_table(spark, tmp_path):
    path = str(tmp_path / "fs")
    schema = "id string, feature_ts timestamp_ntz, x double, s string"
    fs.ingest(spark.createDataFrame([("a", at(0), 1.0, "p"), ("b", at(1), 2.0, "q")], schema), path)
    fs.ingest(spark.createDataFrame([("a", at(30), None, "r")], schema), path)
    newest = {r.id: (r.x, r.s) for r in fs.read_path(spark, path, "id", ["x", "s"]).collect()}
    assert newest == {"a": (None, "r"), "b": (2.0, "q")}
    then = fs.read_path(spark, path, "id", ["x"], ids=["a"], as_of="2024-01-01 12:00:00").collect()
    assert [(r.id, r.x) for r in then] == [("a", 1.0)]


@pytest.mark.parametrize("bin_by", ["day", "hour", "year"])
def test_point_in_time_matches_a_loop(spark, bin_by):
    rng = random.Random(5)
    values = [(rng.choice("ab"), at(rng.randrange(200)), float(i)) for i in range(60)]
    values = list({(k, ts): (k, ts, x) for k, ts, x in values}.values())
    asked = [(i, rng.choice("abc"), at(rng.randrange(-20, 220))) for i in range(80)]
    v = spark.createDataFrame(values, "id string, ts timestamp_ntz, x double")
    q = spark.createDataFrame(asked, "n int, id string, at timestamp_ntz")
    got = {r.n: r.x for r in fs.point_in_time(q, v, "id", "at", "ts", ["x"], bin_by).collect()}
    for n, k, when in asked:
        before = [(ts, x) for kk, ts, x in values if kk == k and ts <= when]
        assert got[n] == (max(before)[1] if before else None)


def test_schema_report_and_fetch(spark):
    df = spark.createDataFrame([("a", 1.0, ["x"])], "id string, x double, l array<string>")
    assert fs.validate_schema(df, {"id": "STRING", "x": "DOUBLE", "l": "STRING_ARRAY"}).count() == 0
    found = {(r.feature, r.problem) for r in fs.validate_schema(df, {"id": "DOUBLE", "x": "DOUBLE", "y": "STRING"}).collect()}
    assert found == {("id", "type"), ("y", "missing"), ("l", "extra")}
    rows = spark.createDataFrame([("a", 5), ("zz", 6)], "key string, extra int")
    config = [{"name": "extra"}, {"name": "score", "source": "s", "feature": "x"}]
    out = {r.extra: r.score for r in fs.fetch(rows, config, {"s": (df, "id", "key")}).collect()}
    assert out == {5: 1.0, 6: None}


def events(spark, n=400, shift=0.0, seed=2):
    rng = random.Random(seed)
    rows = [(i, at(rng.random() * 48), rng.random() * 100 + shift, rng.choice(["view", "click"])) for i in range(n)]
    return spark.createDataFrame(rows, "id bigint, ts timestamp, value double, kind string")


NUMERIC = {"value": (0.0, 200.0)}


def test_equal_data_has_no_skew_and_shifted_data_raises_alerts(spark):
    base = monitor.histogram(events(spark), NUMERIC, ["kind"])
    same = monitor.skew(base, base).collect()
    assert all(abs(r.distance) < 1e-12 for r in same) and len(same) == 2
    moved = monitor.histogram(events(spark, shift=90.0), NUMERIC, ["kind"])
    assert [r.feature for r in monitor.alerts(monitor.skew(base, moved)).collect()] == ["value"]
    assert monitor.alerts(monitor.skew(base, moved), {"value": 2.0}).count() == 0


def test_injected_skew_is_found(spark):
    rows = events(spark).withColumn("kind", F.lit("view"))
    stats = monitor.mean_std(rows, ["value"])
    hot = monitor.inject_skew(rows, stats, ["value"], 2, 4)
    assert hot.count() == 1200 and hot.select("value").distinct().count() == 3
    std = np.std([r.value for r in rows.collect()])
    assert {r.value for r in hot.select("value").distinct().collect()} == {float(np.round(std * k)) for k in (2, 3, 4)}
    base = monitor.histogram(rows, NUMERIC, [])
    assert monitor.alerts(monitor.skew(base, monitor.histogram(hot, NUMERIC, []))).count() == 1


def test_noise(spark):
    rows = events(spark, 2000)
    stats = monitor.mean_std(rows, ["value"])
    noisy = monitor.inject_noise(rows, stats, ["value"], {"value": (lambda m: 500.0, lambda s: 1.0)})
    out = noisy.agg(F.avg("value"), F.stddev_pop("value")).first()
    assert out[0] == pytest.approx(500, abs=0.2) and out[1] == pytest.approx(1, abs=0.1)
    low = monitor.inject_noise(rows, stats, ["value"], {"value": (lambda m: -5.0, lambda s: 1.0)})
    assert low.agg(F.min("value")).first()[0] == 0.0


def test_sliding_windows_from_panes(spark):
    df = events(spark)
    panes = monitor.windowed_histogram(df, "ts", NUMERIC, ["kind"])
    direct = monitor.feature_cells(df, NUMERIC, ["kind"], ["ts"]).groupBy(F.window("ts", "2 hours", "1 hour").alias("w"), "feature", "kind", "cell").count()
    a = {(r.window_start, r.feature, r.cell): r.n for r in panes.collect()}
    b = {(r.w.start, r.feature, r.cell): r["count"] for r in direct.collect()}
    assert a == b


def test_sessions_match_session_windows(spark):
    df = events(spark, 60).withColumn("kind", F.lit("u"))
    got = sorted((r.session_start, r.n) for r in monitor.sessions(df, "kind", "ts").collect())
    want = df.groupBy(F.session_window("ts", "2 hours").alias("w"), "kind").count()
    assert got == sorted((r.w.start, r["count"]) for r in want.collect())


def write(spark, folder, rows, name):
    df = spark.createDataFrame(rows, "id bigint, ts timestamp, value double, kind string")
    df.coalesce(1).write.mode("append").parquet(str(folder))


def run_monitor(spark, source, base, out, state):
    stream = spark.readStream.schema("id bigint, ts timestamp, value double, kind string").option("maxFilesPerTrigger", 1).parquet(str(source))
    jobs.stream_monitor(stream, base, "ts", NUMERIC, ["kind"], str(out), str(state)).awaitTermination()


def test_stream_monitor_closes_windows_and_drops_late_rows(spark, tmp_path):
    source = tmp_path / "in"
    write(spark, source, [(1, at(0.5), 10.0, "view"), (2, at(1.5), 20.0, "view"), (3, at(9), 30.0, "view")], "a")
    base = monitor.histogram(events(spark), NUMERIC, ["kind"])
    run_monitor(spark, source, base, tmp_path / "out", tmp_path / "state")
    write(spark, source, [(4, at(0.6), 99.0, "click"), (5, at(20), 30.0, "view")], "b")
    run_monitor(spark, source, base, tmp_path / "out", tmp_path / "state")
    out = spark.read.parquet(str(tmp_path / "out"))
    closed = {r.window_start for r in out.select("window_start").distinct().collect()}
    assert {at(-1), at(0), at(1), at(8), at(9)} == {c.replace(tzinfo=None) for c in closed}
    batch = monitor.skew(base, monitor.histogram(spark.createDataFrame([(1, at(0.5), 10.0, "view"), (2, at(1.5), 20.0, "view")], "id bigint, ts timestamp, value double, kind string"), NUMERIC, ["kind"]))
    want = {r.feature: round(r.distance, 9) for r in batch.collect()}
    got = {r.feature: round(r.distance, 9) for r in out.where(F.col("window_start") == F.lit(at(0))).collect()}
    assert got == want


def test_request_log_is_repeatable(spark, tmp_path):
    source = tmp_path / "in"
    write(spark, source, [(i, at(i / 100), 1.0, "view") for i in range(500)], "a")
    stream = spark.readStream.schema("id bigint, ts timestamp, value double, kind string").parquet(str(source))
    jobs.request_log(stream, "id", 0.5, str(tmp_path / "log"), str(tmp_path / "state")).awaitTermination()
    jobs.request_log(stream, "id", 0.5, str(tmp_path / "log"), str(tmp_path / "state")).awaitTermination()
    kept = spark.read.parquet(str(tmp_path / "log"))
    assert 180 < kept.count() < 320 and kept.count() == kept.select("id").distinct().count()


def test_stream_sessions(spark, tmp_path):
    source = tmp_path / "in"
    write(spark, source, [(1, at(0), 1.0, "u"), (2, at(1), 1.0, "u"), (3, at(5), 1.0, "u"), (4, at(50), 1.0, "u")], "a")
    stream = spark.readStream.schema("id bigint, ts timestamp, value double, kind string").parquet(str(source))
    q = jobs.session_counts(stream, "kind", "ts").writeStream.format("memory").queryName("sessions").outputMode("append")
    q.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.n for r in spark.table("sessions").collect()) == [1, 2]
