"""Feature monitoring: histograms, distances to a baseline or to the window before, thresholds and alerts."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from segue.functions.scalars import bucketize, round_half_even, stable_hash

DEFAULT_THRESHOLD = 0.001
THRESHOLD = 0.05


def feature_cells(df: DataFrame, numeric: Mapping[str, tuple[float, float]], text: Sequence[str], keep: Sequence[str | Column] = (), boundaries: int = 11) -> DataFrame:
    """(keep…, feature, kind, cell): the bucket of each number and the value of each text, one row each."""
    cells = [
        F.struct(F.lit(f).alias("feature"), F.lit("number").alias("kind"),
                 bucketize(f, high, low, boundaries).cast("string").alias("cell"))
        for f, (low, high) in numeric.items()
    ]
    cells += [
        F.struct(F.lit(f).alias("feature"), F.lit("text").alias("kind"), F.col(f).cast("string").alias("cell")) for f in text
    ]
    kept = df.select(*keep, F.array(*cells).alias("_cells"))
    names = [c for c in kept.columns if c != "_cells"]
    return kept.select(*names, F.inline("_cells")).where(F.col("cell").isNotNull())


def histogram(df: DataFrame, numeric: Mapping[str, tuple[float, float]], text: Sequence[str], keep: Sequence[str | Column] = (), boundaries: int = 11) -> DataFrame:
    """Rows per cell; counted on the map side, so the shuffle carries cells, not rows."""
    cells = feature_cells(df, numeric, text, keep, boundaries)
    names = [c for c in cells.columns if c not in ("feature", "kind", "cell")]
    return cells.groupBy(*names, "feature", "kind", "cell").agg(F.count(F.lit(1)).alias("n"))


def _shares(hist: DataFrame, by: Sequence[str], out: str) -> DataFrame:
    totals = hist.groupBy(*by, "feature").agg(F.sum("n").alias("_total"))
    shares = hist.join(totals, [*by, "feature"])
    return shares.select(*by, "feature", "kind", "cell", (F.col("n") / F.col("_total")).alias(out))


def _plogp(p: Column, m: Column) -> Column:
    return F.when(p > 0, p * F.log2(p / m)).otherwise(F.lit(0.0))


def distances(pairs: DataFrame, by: Sequence[str], p: str = "p", q: str = "q") -> DataFrame:
    """Jensen-Shannon divergence (base 2) for numbers, largest share difference for text."""
    a, b = F.coalesce(F.col(p), F.lit(0.0)), F.coalesce(F.col(q), F.lit(0.0))
    m = (a + b) / 2.0
    js = F.sum((_plogp(a, m) + _plogp(b, m)) / 2.0)
    largest = F.max(F.abs(a - b))
    return pairs.groupBy(*by, "feature", "kind").agg(F.when(F.col("kind") == "number", js).otherwise(largest).alias("distance"))


def skew(base: DataFrame, target: DataFrame) -> DataFrame:
    """(feature, kind, distance) between two histograms."""
    keys = ["feature", "kind", "cell"]
    pairs = _shares(base, [], "p").join(_shares(target, [], "q"), keys, "full")
    return distances(pairs, [])


def windowed_histogram(df: DataFrame, ts: str, numeric: Mapping, text: Sequence[str], window: int = 2, slide_hours: int = 1, boundaries: int = 11) -> DataFrame:
    """Histogram per sliding window of `window` slides; panes of one slide are counted once, then combined."""
    pane = F.window(ts, f"{slide_hours} hours").getField("start").alias("pane")
    panes = histogram(df, numeric, text, [pane], boundaries)
    shift = F.expr(f"make_interval(0, 0, 0, 0, {slide_hours})")
    starts = F.array(*[F.col("pane") - shift * i for i in range(window)])
    spread = panes.withColumn("window_start", F.explode(starts))
    return spread.groupBy("window_start", "feature", "kind", "cell").agg(F.sum("n").alias("n"))


def drift(windows: DataFrame, step_hours: int) -> DataFrame:
    """Distance of each window to the one `step_hours` before it; windows without one before are left out."""
    keys = ["window_start", "feature", "kind", "cell"]
    now = _shares(windows, ["window_start"], "q")
    shift = F.expr(f"make_interval(0, 0, 0, 0, {step_hours})")
    before = now.select((F.col("window_start") + shift).alias("window_start"), "feature", "kind", "cell", F.col("q").alias("p"))
    pairs = now.join(before, keys, "full")
    known = now.select("window_start").distinct().join(before.select("window_start").distinct(), "window_start", "left_semi")
    return distances(pairs.join(known, "window_start", "left_semi"), ["window_start"])


def thresholds(df: DataFrame, overrides: Mapping[str, float] | None = None, default: float = THRESHOLD, feature: str = "feature") -> DataFrame:
    """The threshold of each feature: the default, or the override for its name."""
    limit = reduce(lambda acc, kv: F.when(F.col(feature) == kv[0], F.lit(kv[1])).otherwise(acc), (overrides or {}).items(), F.lit(default))
    return df.withColumn("threshold", limit)


def flagged(df: DataFrame, overrides: Mapping[str, float] | None = None, default: float = THRESHOLD) -> DataFrame:
    limited = thresholds(df, overrides, default)
    return limited.withColumn("alert", F.col("distance") > F.col("threshold"))


def alerts(df: DataFrame, overrides: Mapping[str, float] | None = None, default: float = THRESHOLD) -> DataFrame:
    return flagged(df, overrides, default).where("alert").drop("alert")


def window_stats(df: DataFrame, ts: str, by: Sequence[str], value: str, window: str = "2 hours", slide: str = "1 hour") -> DataFrame:
    """Count, sum, least and largest value per window; the same expression serves tables and streams."""
    grouped = df.groupBy(F.window(ts, window, slide).alias("w"), *by)
    stats = grouped.agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.min(value).alias("low"), F.max(value).alias("high")
    )
    return stats.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "n", "total", "low", "high")


def mean_std(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row: mean and population standard deviation of each feature."""
    parts = []
    for f in features:
        parts += [F.avg(f).alias(f"{f}_mean"), F.stddev_pop(f).alias(f"{f}_std")]
    return df.agg(*parts)


def inject_skew(df: DataFrame, stats: DataFrame, features: Sequence[str], start: int = 2, end: int = 8) -> DataFrame:
    """Each row once per multiplier k in start..end, with each feature set to round(std * k).

    `stats` is the one row of `mean_std`; it is read as constants.
    """
    std = stats.first()
    out = df.withColumn("multiplier", F.explode(F.sequence(F.lit(start), F.lit(end))))
    return out.withColumns({f: round_half_even(F.lit(std[f"{f}_std"]) * F.col("multiplier")) for f in features})


def inject_noise(
    df: DataFrame, stats: DataFrame, features: Sequence[str],
    perturb: Mapping[str, tuple[Callable[[float], float], Callable[[float], float]]] | None = None, seed: int = 42, key: str | None = None,
) -> DataFrame:
    """Each feature drawn from N(mean, std), not below 0; `perturb` changes the mean and std of named features.

    A row's draw comes from a hash of `key`, or of all its columns, so it is the same however the rows are dealt.
    """
    row = stats.first()
    id_ = F.col(key) if key else F.xxhash64(*df.columns)
    drawn = {}
    for i, f in enumerate(features):
        change_mean, change_std = (perturb or {}).get(f, (float, float))
        centre, spread = change_mean(row[f"{f}_mean"]), change_std(row[f"{f}_std"])
        unit = lambda part: (stable_hash(F.concat_ws("-", id_.cast("string"), F.lit(f"{seed + i}-{part}"))) + 0.5) / F.lit(2.0**60)  # noqa: B023, E731
        normal = F.sqrt(-2 * F.log(unit(1))) * F.cos(2 * math.pi * unit(2))
        drawn[f] = F.greatest(normal * F.lit(spread) + F.lit(centre), F.lit(0.0))
    return df.withColumns(drawn)


def sessions(df: DataFrame, key: str, ts: str, gap_hours: int = 2) -> DataFrame:
    """Runs of activity without a pause longer than the gap: (key, session_start, session_end, n).

    Events of one gap-wide bin always belong to one session, so bins are counted first and only bins, a bounded
    number per key, are put in order.
    """
    bins = df.groupBy(key, F.window(ts, f"{gap_hours} hours").alias("_w")).agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.count(F.lit(1)).alias("_n")
    )
    w = W.partitionBy(key).orderBy("_first")
    gap = F.expr(f"make_interval(0, 0, 0, 0, {gap_hours})")
    starts = (F.lag("_last").over(w) + gap <= F.col("_first")) | F.lag("_last").over(w).isNull()
    marked = bins.withColumn("_new", starts.cast("int"))
    numbered = marked.withColumn("_s", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return numbered.groupBy(key, "_s").agg(
        F.min("_first").alias("session_start"), F.max("_last").alias("session_end"), F.sum("_n").alias("n")
    ).drop("_s")
