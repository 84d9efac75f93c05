"""Queries on the feature table and on monitoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from segue.operators import feature_store as fs
from segue.operators import monitor
from segue.plans import tables as t
from segue.plans.basics import md5_sql
from segue.plans.registry import query

HALF = "2024-01-16 00:00:00"
NUMERIC = {"value": (0.0, 500.0), "k": (0.0, 100.0)}
TEXT = ["event_type"]
LIMITS = {"event_type": 0.001, "k": 0.0001}


def requests(spark, sf):
    events = t.table(spark, sf, "events")
    return events.select("event_id", "user_id", "ts", "event_type", "value", F.get_json_object("props", "$.k").cast("double").alias("k"))


def _bucket(x: str, high: float, n: int = 10) -> str:
    return f"CAST(CASE WHEN {x} < 0 THEN 0 WHEN {x} >= {high} THEN {n + 1} ELSE CAST(floor({n} * {x} / {high}::DOUBLE) AS INTEGER) + 1 END AS VARCHAR)"


LOG = f"""log AS (SELECT event_id, user_id, ts, event_type, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events),
cells AS (
  SELECT ts, 'value' AS feature, 'number' AS kind, {_bucket('value', 500)} AS cell FROM log
  UNION ALL SELECT ts, 'k', 'number', {_bucket('k', 100)} FROM log
  UNION ALL SELECT ts, 'event_type', 'text', event_type FROM log)"""

DISTANCE = """CASE WHEN kind = 'number' THEN sum((CASE WHEN a > 0 THEN a * log2(a / ((a + b) / 2)) ELSE 0 END + CASE WHEN b > 0 THEN b * log2(b / ((a + b) / 2)) ELSE 0 END) / 2)
  ELSE max(abs(a - b)) END"""
THRESHOLD = "CASE feature WHEN 'event_type' THEN 0.001 WHEN 'k' THEN 0.0001 ELSE 0.05 END"

SKEW = f"""{LOG},
h AS (SELECT ts < TIMESTAMP '{HALF}' AS old, feature, kind, cell, count(*) AS n FROM cells GROUP BY ALL),
s AS (SELECT *, n / sum(n) OVER (PARTITION BY old, feature)::DOUBLE AS p FROM h),
j AS (SELECT coalesce(x.feature, y.feature) AS feature, coalesce(x.kind, y.kind) AS kind, coalesce(x.p, 0) AS a, coalesce(y.p, 0) AS b
  FROM (SELECT * FROM s WHERE old) x FULL JOIN (SELECT * FROM s WHERE NOT old) y ON x.feature = y.feature AND x.cell = y.cell),
d AS (SELECT feature, kind, {DISTANCE} AS distance FROM j GROUP BY feature, kind)"""


@query("feature_histogram", f"WITH {LOG} SELECT feature, kind, cell, CAST(count(*) AS BIGINT) AS n FROM cells GROUP BY ALL")
def _(spark, sf):
    return monitor.histogram(requests(spark, sf), NUMERIC, TEXT)


def _skew(spark, sf):
    rows = requests(spark, sf)
    base = monitor.histogram(rows.where(F.col("ts") < F.lit(HALF).cast("timestamp_ntz")), NUMERIC, TEXT)
    return monitor.skew(base, monitor.histogram(rows.where(F.col("ts") >= F.lit(HALF).cast("timestamp_ntz")), NUMERIC, TEXT))


def _rounded(df):
    return df.withColumn("distance", F.round("distance", 9))


@query("feature_skew", f"WITH {SKEW} SELECT feature, kind, round(distance, 9) AS distance, CAST({THRESHOLD} AS DOUBLE) AS threshold, distance > {THRESHOLD} AS alert FROM d")
def _(spark, sf):
    return _rounded(monitor.flagged(_skew(spark, sf), LIMITS))


@query("monitor_alerts", f"WITH {SKEW} SELECT feature, kind, round(distance, 9) AS distance, CAST({THRESHOLD} AS DOUBLE) AS threshold FROM d WHERE distance > {THRESHOLD}")
def _(spark, sf):
    return _rounded(monitor.alerts(_skew(spark, sf), LIMITS))


@query("monitor_thresholds", f"WITH {LOG} SELECT feature, CAST(count(*) AS BIGINT) AS n, CAST({THRESHOLD} AS DOUBLE) AS threshold FROM cells GROUP BY feature")
def _(spark, sf):
    counted = monitor.histogram(requests(spark, sf), NUMERIC, TEXT).groupBy("feature").agg(F.sum("n").alias("n"))
    return monitor.thresholds(counted, LIMITS)


WINDOWS = f"""{LOG}, panes AS (SELECT date_trunc('hour', ts) AS pane, feature, kind, cell, count(*) AS n FROM cells GROUP BY ALL),
spread AS (SELECT pane AS window_start, feature, kind, cell, n FROM panes UNION ALL SELECT pane - INTERVAL 1 HOUR, feature, kind, cell, n FROM panes),
w AS (SELECT window_start, feature, kind, cell, sum(n) AS n FROM spread GROUP BY ALL),
s AS (SELECT *, n / sum(n) OVER (PARTITION BY window_start, feature)::DOUBLE AS p FROM w)"""


@query(
    "feature_drift",
    f"""WITH {WINDOWS}, prev AS (SELECT window_start + INTERVAL 2 HOUR AS window_start, feature, kind, cell, p FROM s),
    starts AS (SELECT DISTINCT window_start FROM s INTERSECT SELECT DISTINCT window_start FROM prev),
    j AS (SELECT coalesce(x.window_start, y.window_start) AS window_start, coalesce(x.feature, y.feature) AS feature, coalesce(x.kind, y.kind) AS kind,
      coalesce(y.p, 0) AS a, coalesce(x.p, 0) AS b FROM s x FULL JOIN prev y ON x.window_start = y.window_start AND x.feature = y.feature AND x.cell = y.cell)
    SELECT window_start, feature, kind, round({DISTANCE}, 9) AS distance FROM j WHERE window_start IN (SELECT window_start FROM starts) GROUP BY window_start, feature, kind""",
)
def _(spark, sf):
    windows = monitor.windowed_histogram(requests(spark, sf), "ts", NUMERIC, TEXT)
    return _rounded(monitor.drift(windows, 2))


@query(
    "monitor_window",
    """WITH p AS (SELECT unnest([date_trunc('hour', ts), date_trunc('hour', ts) - INTERVAL 1 HOUR]) AS window_start, event_type, value FROM events)
    SELECT window_start, window_start + INTERVAL 2 HOUR AS window_end, event_type, CAST(count(*) AS BIGINT) AS n, round(sum(value), 4) AS total, min(value) AS low, max(value) AS high
    FROM p GROUP BY ALL""",
)
def _(spark, sf):
    stats = monitor.window_stats(requests(spark, sf), "ts", ["event_type"], "value")
    return stats.withColumn("total", F.round("total", 4))


@query(
    "monitor_window_tumbling",
    """SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type, CAST(count(*) AS BIGINT) AS n,
      round(sum(value), 4) AS total, min(value) AS low, max(value) AS high FROM events GROUP BY ALL""",
)
def _(spark, sf):
    stats = monitor.window_stats(requests(spark, sf), "ts", ["event_type"], "value", "1 hour", "1 hour")
    return stats.withColumn("total", F.round("total", 4))


@query(
    "stream_sessions",
    """WITH g AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts >= lag(ts) OVER w + INTERVAL 2 HOUR THEN 1 ELSE 0 END AS fresh
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM g)
    SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY user_id, s""",
)
def _(spark, sf):
    return monitor.sessions(requests(spark, sf), "user_id", "ts")


@query(
    "skew_inject",
    """WITH s AS (SELECT stddev_pop(l_quantity) AS a, stddev_pop(l_extendedprice) AS b FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(k AS INTEGER) AS multiplier, round_even(a * k, 0) AS l_quantity, round_even(b * k, 0) AS l_extendedprice
    FROM lineitem, s, range(2, 9) r(k)""",
)
def _(spark, sf):
    rows = t.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    features = ["l_quantity", "l_extendedprice"]
    return monitor.inject_skew(rows, monitor.mean_std(rows, features), features)


def _drawn(seed: int, spread: str, centre: str) -> str:
    unit = lambda part: f"(({md5_sql(f"event_id || '-{seed}-{part}'")} + 0.5) / 1152921504606846976.0::DOUBLE)"
    return f"round(greatest(sqrt(-2 * ln({unit(1)})) * cos(2 * pi() * {unit(2)}) * {spread} + {centre}, 0), 4)"


@query(
    "noise_inject",
    f"""WITH log AS (SELECT event_id, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events),
    m AS (SELECT avg(value) AS vm, stddev_pop(value) AS vs, avg(k) AS km, stddev_pop(k) AS ks FROM log)
    SELECT event_id, {_drawn(42, 'vs / 3', 'vm * 3')} AS value, {_drawn(43, 'ks', 'km')} AS k FROM log, m""",
)
def _(spark, sf):
    rows = requests(spark, sf).select("event_id", "value", "k")
    stats = monitor.mean_std(rows, ["value", "k"])
    noisy = monitor.inject_noise(rows, stats, ["value", "k"], {"value": (lambda m: m * 3, lambda s: s / 3)}, key="event_id")
    return noisy.select("event_id", F.round("value", 4).alias("value"), F.round("k", 4).alias("k"))


def _values(spark, sf):
    """Feature values by user and time: each event is one set of values."""
    rows = requests(spark, sf).select("user_id", "event_type", "value", "k", "ts")
    return fs.prepare(rows, "user_id", {"event_type": "kind"}, F.col("ts")).drop("ts")


@query("fs_prepare", "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_retailprice, CAST(p_size % 2 AS VARCHAR) AS track_mode_can, CAST(p_size % 12 AS VARCHAR) AS track_key_can, TIMESTAMP '2024-02-01 00:00:00' AS feature_ts FROM part")
def _(spark, sf):
    rows = t.table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice", (F.col("p_size") % 2).alias("mode"), (F.col("p_size") % 12).alias("key"))
    stamp = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    return fs.prepare(rows, "p_partkey", {"mode": "track_mode_can", "key": "track_key_can"}, stamp)


LATEST = """SELECT CAST(user_id AS VARCHAR) AS user_id, ts AS feature_ts, event_type AS kind, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS r FROM events {where}) WHERE r = 1"""


@query("fs_read", LATEST.format(where="WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"))
def _(spark, sf):
    ids = t.table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").cast("string").alias("user_id"))
    return fs.read(_values(spark, sf), "user_id", ["kind", "value"], ids)


@query("fs_read_as_of", LATEST.format(where=f"WHERE ts <= TIMESTAMP '{HALF}'"))
def _(spark, sf):
    return fs.read(_values(spark, sf), "user_id", ["kind", "value"], as_of=HALF)


@query(
    "fs_point_in_time",
    """SELECT q.event_id, CAST(q.user_id AS VARCHAR) AS user_id, q.ts AS at, e.ts AS feature_ts, e.value, e.event_type AS kind
    FROM (SELECT * FROM events WHERE event_type = 'purchase') q
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type <> 'purchase') e ON q.user_id = e.user_id AND q.ts >= e.ts""",
)
def _(spark, sf):
    # What was known of the user at each purchase: the values of the latest other event.
    rows = requests(spark, sf)
    asked = rows.where("event_type = 'purchase'").select("event_id", F.col("user_id").cast("string").alias("user_id"), F.col("ts").alias("at"))
    return fs.point_in_time(asked, _values(spark, sf).where("kind <> 'purchase'"), "user_id", "at", "feature_ts", ["value", "kind"])


@query(
    "fs_fetch_config",
    """SELECT l_orderkey, l_linenumber, p_name AS track_name_can, p_brand AS album_name_can, s_name AS artist_name_can, s_acctbal AS artist_followers_can
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey""",
)
def _(spark, sf):
    config = [
        {"name": "l_orderkey"}, {"name": "l_linenumber"},
        {"name": "track_name_can", "source": "tracks", "feature": "p_name"}, {"name": "album_name_can", "source": "tracks", "feature": "p_brand"},
        {"name": "artist_name_can", "source": "artists", "feature": "s_name"}, {"name": "artist_followers_can", "source": "artists", "feature": "s_acctbal"},
    ]
    sources = {
        "tracks": (t.table(spark, sf, "part"), "p_partkey", "l_partkey"), "artists": (t.table(spark, sf, "supplier"), "s_suppkey", "l_suppkey"),
    }
    return fs.fetch(t.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), config, sources)
