"""A feature table: values by entity id and time, read latest, by id, or as of a time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# The value types a feature may declare, and the Spark types they stand for.
VALUE_TYPES = {
    "STRING": "string",
    "DOUBLE": "double",
    "STRING_ARRAY": "array<string>",
    "DOUBLE_ARRAY": "array<double>",
}


def prepare(df: DataFrame, id_col: str, to_text: Mapping[str, str], at: Column | None = None, ts: str = "feature_ts") -> DataFrame:
    """Entity rows: id as text, the columns in `to_text` cast to text under their new names, a time stamp.

    `at` defaults to the time of the run.
    """
    kept = [c for c in df.columns if c not in to_text and c != id_col]
    texts = [F.col(c).cast("string").alias(name) for c, name in to_text.items()]
    stamp = (F.current_timestamp() if at is None else at).alias(ts)
    return df.select(F.col(id_col).cast("string").alias(id_col), *kept, *texts, stamp)


def ingest(df: DataFrame, path: str, ts: str = "feature_ts") -> None:
    """Append values; files are partitioned by day so that reads by time touch few of them."""
    df.withColumn("feature_day", F.to_date(ts)).write.mode("append").partitionBy("feature_day").parquet(path)


def latest(df: DataFrame, id_col: str, ts: str, features: Sequence[str]) -> DataFrame:
    """Newest values per entity: an aggregate, so an entity with very many rows is reduced on the map side."""
    newest = df.groupBy(id_col).agg(F.max(F.struct(ts, *features)).alias("_v"))
    return newest.select(id_col, f"_v.{ts}", *[f"_v.{f}" for f in features])


def read(
    source: DataFrame, id_col: str, features: Sequence[str], ids: DataFrame | Sequence | None = None,
    as_of=None, ts: str = "feature_ts",
) -> DataFrame:
    """Chosen features of chosen entities, newest or as of a time; only those columns are scanned."""
    rows = source.select(id_col, ts, *features)
    if as_of is not None:
        if "feature_day" in source.columns:
            rows = source.where(F.col("feature_day") <= F.to_date(F.lit(as_of))).select(id_col, ts, *features)
        rows = rows.where(F.col(ts) <= F.lit(as_of).cast(source.schema[ts].dataType))
    if isinstance(ids, DataFrame):
        rows = rows.join(ids.select(id_col).distinct(), id_col, "left_semi")
    elif ids is not None:
        rows = rows.where(F.col(id_col).isin(list(ids)))
    return latest(rows, id_col, ts, features)


def read_path(spark: SparkSession, path: str, id_col: str, features: Sequence[str], ids=None, as_of=None, ts: str = "feature_ts") -> DataFrame:
    return read(spark.read.parquet(path), id_col, features, ids, as_of, ts)


def point_in_time(
    requests: DataFrame, values: DataFrame, id_col: str, at: str, ts: str, features: Sequence[str], bin_by: str = "day"
) -> DataFrame:
    """For each request the values with the latest time at or before it; NULL where there are none.

    Requests and values are merged by time inside (entity, time bin) instead of joined, so no pairs arise and a
    heavy entity is cut by time. What a bin starts with is the newest value of the earlier bins, found from one
    row per (entity, bin).
    """
    value = F.struct(F.col(ts).alias("_ts"), *features)
    stamped = values.select(id_col, F.col(ts).alias("_at"), F.lit(0).alias("_asked"), value.alias("_value"))
    asked = requests.select(id_col, F.col(at).alias("_at"), F.lit(1).alias("_asked"), F.struct(*requests.columns).alias("_row"))
    merged = stamped.unionByName(asked, allowMissingColumns=True).withColumn("_bin", F.date_trunc(bin_by, "_at"))

    ends = values.groupBy(id_col, F.date_trunc(bin_by, ts).alias("_bin")).agg(F.max(value).alias("_end"))
    bins = ends.unionByName(
        requests.select(id_col, F.date_trunc(bin_by, at).alias("_bin")).distinct(), allowMissingColumns=True
    )
    bins = bins.groupBy(id_col, "_bin").agg(F.max("_end").alias("_end"))
    before = W.partitionBy(id_col).orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)
    bins = bins.select(id_col, "_bin", F.last("_end", ignorenulls=True).over(before).alias("_carry"))

    inside = W.partitionBy(id_col, "_bin").orderBy("_at", "_asked").rowsBetween(W.unboundedPreceding, 0)
    seen = merged.withColumn("_seen", F.last("_value", ignorenulls=True).over(inside)).where(F.col("_asked") == 1)
    found = seen.join(bins, [id_col, "_bin"], "left").withColumn("_hit", F.coalesce("_seen", "_carry"))
    return found.select("_row.*", F.col("_hit._ts").alias(ts), *[F.col(f"_hit.{f}").alias(f) for f in features])


def validate_schema(df: DataFrame, config: Mapping[str, str]) -> DataFrame:
    """One row per feature that is missing, of another type, or not in the config; no rows if all agree."""
    actual = dict(df.dtypes)
    problems = []
    for name, kind in config.items():
        expected = VALUE_TYPES[kind]
        if name not in actual:
            problems.append((name, "missing", expected, None))
        elif actual[name] != expected:
            problems.append((name, "type", expected, actual[name]))
    problems += [(n, "extra", None, t) for n, t in actual.items() if n not in config]
    return df.sparkSession.createDataFrame(problems, "feature string, problem string, expected string, actual string")


def fetch(rows: DataFrame, features: Sequence[Mapping], sources: Mapping[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Model input rows from a config: each feature comes with the request or from an entity.

    `features` holds entries {"name", "source"?, "feature"?}; `sources` maps a source name to (latest table, its
    id column, the request's id column). Each source is joined once.
    """
    wanted: dict[str, list[Mapping]] = {}
    for f in features:
        if f.get("source"):
            wanted.setdefault(f["source"], []).append(f)
    for source, entries in wanted.items():
        table, id_col, row_id = sources[source]
        picked = table.select(
            F.col(id_col).cast("string").alias("_id"), *[F.col(e.get("feature", e["name"])).alias(e["name"]) for e in entries]
        )
        rows = rows.join(picked, F.col(row_id).cast("string") == F.col("_id"), "left").drop("_id")
    return rows.select(*[f["name"] for f in features])


