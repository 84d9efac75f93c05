"""Streaming jobs: keep a sampled request log, and watch windows of it against a baseline."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from segue.functions.scalars import keep_share
from segue.operators import monitor


def request_log(stream: DataFrame, key: str, rate: float, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append a repeatable share of the requests to a table as they arrive."""
    writer = stream.where(keep_share(key, rate)).writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def _marked(stream: DataFrame, ts: str, late: str) -> DataFrame:
    """Watermarks need a time stamp with a zone; one without is read in the session's zone."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)


def windowed_cells(stream: DataFrame, ts: str, numeric: Mapping, text: Sequence[str], window: str, slide: str, late: str, boundaries: int = 11) -> DataFrame:
    """Histogram of each sliding window; state holds one row per window and cell, dropped after `late`."""
    cells = monitor.feature_cells(_marked(stream, ts, late), numeric, text, [ts], boundaries)
    counted = cells.groupBy(F.window(ts, window, slide).alias("w"), "feature", "kind", "cell").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("w.start").alias("window_start"), "feature", "kind", "cell", "n")


def stream_monitor(
    stream: DataFrame, base: DataFrame, ts: str, numeric: Mapping, text: Sequence[str], path: str, checkpoint: str,
    window: str = "2 hours", slide: str = "1 hour", late: str = "2 hours",
    overrides: Mapping[str, float] | None = None, default: float = monitor.THRESHOLD, once: bool = True,
) -> StreamingQuery:
    """Distance of every closed window to the baseline histogram, with threshold and alert flag.

    The baseline is repeated for each window that closes in a batch, so cells it alone has are compared too.
    Each batch writes its own folder and replaces it if it runs again, so a restarted job writes nothing twice.
    """
    hist = windowed_cells(stream, ts, numeric, text, window, slide, late)

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            # every closed window meets the whole baseline, one small histogram
            closed = batch.select("window_start").distinct().withColumn("_all", F.lit(1))
            expected = base.withColumn("_all", F.lit(1)).join(closed, "_all").drop("_all")
            keys = ["window_start", "feature", "kind", "cell"]
            target = monitor._shares(batch, ["window_start"], "q")
            pairs = monitor._shares(expected, ["window_start"], "p").join(target, keys, "full")
            flagged = monitor.flagged(monitor.distances(pairs, ["window_start"]), overrides, default)
            flagged.write.mode("overwrite").parquet(f"{path}/batch={number}")
        finally:
            batch.unpersist()

    writer = hist.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def session_counts(stream: DataFrame, key: str, ts: str, gap: str = "2 hours", late: str = "2 hours") -> DataFrame:
    """Sessions of activity per key in a stream."""
    grouped = _marked(stream, ts, late).groupBy(F.session_window(ts, gap).alias("w"), key).agg(F.count(F.lit(1)).alias("n"))
    return grouped.select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")
