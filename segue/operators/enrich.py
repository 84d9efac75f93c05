"""Joins that add item features, and look-ups for keys held in arrays."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from segue.functions.scalars import as_double, blank_to, null_to, parse_genres
from segue.operators.sequence import Lists, attach, fan_out


COPY = "_copy"


def distinct_rows(df: DataFrame) -> DataFrame:
    """Feature rows without exact copies; a key may keep several rows."""
    return df.distinct()


def one_per_key(df: DataFrame, key: str, order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first in `order`; cut on the map side, so a heavy key costs one row per task."""
    w = W.partitionBy(key).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).drop("_r")


def enrich_items(items: DataFrame, features: Mapping[str, DataFrame]) -> DataFrame:
    """Inner join of each feature table on its key column; items without features drop out.

    No hints: Spark broadcasts a table below its size limit and otherwise sorts and merges, where adaptive
    execution splits heavy keys. Columns are attached before any window, so each table is joined once.
    """
    for key, table in features.items():
        items = items.join(table, [c for c in (key, key + COPY) if c in items.columns and c in table.columns], "inner")
    return items


def numbered_copies(features: DataFrame, key: str) -> DataFrame:
    """The rows of a feature table with a number among those of their key, in the column that `enrich_items` joins by as well.

    Items that met (key, number) alone get the other columns later, each those of its own row.
    """
    w = W.partitionBy(key).orderBy(*[c for c in features.columns if c != key])
    return features.withColumn(key + COPY, F.row_number().over(w))


def clean_artists(artists: DataFrame) -> DataFrame:
    """Artist features with the genre list parsed: once per artist, not once per item."""
    return artists.withColumn("artist_genres", parse_genres("genres")).drop("genres")


TRACK_TEXTS = ["artist_name", "track_uri", "album_uri", "artist_uri", "track_name", "album_name"]
TRACK_REALS = ["track_pop", "artist_pop", "followers"]


def clean_values(features: DataFrame) -> DataFrame:
    """The columns of a feature table with the values that `clean_track_columns` gives them."""
    texts = {c: blank_to(c) for c in TRACK_TEXTS if c in features.columns}
    return features.withColumns(texts | {c: null_to(as_double(c), 0.0) for c in TRACK_REALS if c in features.columns})


def clean_track_columns(items: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Candidate columns of an enriched track: blank text filled, numbers as doubles; genres as `clean_artists` left them.
    The list and the position go along where there are any."""
    columns: list[Column] = [*[F.col(c) for c in items.columns if c == "pid"], *[F.col("pos").cast("bigint").alias("pos_can") for c in items.columns if c == "pos"]]
    columns += [blank_to(c).alias(f"{c}_can") for c in TRACK_TEXTS]
    columns.append(as_double("duration_ms").alias("duration_ms_can"))
    columns += [null_to(as_double(c), 0.0).alias(f"{c}_can") for c in ("track_pop", "artist_pop")]
    columns.append(F.col("artist_genres").alias("artist_genres_can"))
    columns.append(null_to(as_double("followers"), 0.0).alias("artist_followers_can"))
    return items.select(*columns, *keep)


def lookup_arrays(
    df: DataFrame | Lists, row_id: str, keys: str, table: DataFrame, key: str, columns: Mapping[str, object], n: int = 5, item: str | None = None,
) -> DataFrame:
    """For each element of an array of keys, look up several columns: parallel arrays in the array's order.

    One join for all columns; `columns` maps the table's column to its default for NULL. Elements without a match
    drop out. The arrays have a bounded length, so regrouping by row is bounded as well.

    With cut lists for `df`, the arrays are the histories of `item` over n positions, and `row_id` is made of the list and
    the position. As an item stands in n arrays, it is looked up before they are made, and its values go along.
    """
    if isinstance(df, Lists):
        return lookup_histories(df, row_id, keys, table, key, columns, n, item or key)
    flat = df.select(row_id, F.posexplode(keys).alias("_at", key))
    item = F.struct("_at", *[null_to(c, default).alias(c) for c, default in columns.items()])
    found = flat.join(table.select(key, *columns), key).groupBy(row_id).agg(F.array_sort(F.collect_list(item)).alias("_found"))
    named = found.select(row_id, *[F.col(f"_found.{c}").alias(f"{c}_pl") for c in columns])
    return df.join(named, row_id)


def lookup_histories(
    lists: Lists, row_id: str, keys: str, table: DataFrame, key: str, columns: Mapping[str, object], n: int, item: str
) -> DataFrame:
    """`lookup_arrays` of the histories of cut lists: (row_id, keys, arrays)."""
    values = F.struct(*[null_to(c, default).alias(c) for c, default in columns.items()])
    # a key may have several rows, which stand in the order of their values
    known = table.groupBy(F.col(key).alias("_key")).agg(F.array_sort(F.collect_list(values)).alias("_found"))
    met = attach(lists, lambda rows: rows.join(known, F.col(item) == F.col("_key"), "left").drop("_key"))
    none = F.array().cast(known.schema["_found"].dataType)
    found = fan_out(met, {keys: item, "_all": F.coalesce("_found", none)}, n).withColumn("_all", F.flatten("_all"))
    named = [F.col(f"_all.{c}").alias(f"{c}_pl") for c in columns]
    return found.where(F.size("_all") > 0).select(F.struct(lists.pid, lists.pos).alias(row_id), keys, *named)


def distinct_candidates(
    samples: DataFrame, audio: DataFrame, key: str, columns: Sequence[str], defaults: Mapping[str, object], per_key: bool = False,
) -> DataFrame:
    """The candidate catalogue: distinct rows of the sampled tracks with their audio columns.

    A track whose columns differ from sample to sample keeps several rows; `per_key` keeps the first of them in
    column order. Both sides are made distinct before the join, so the join sees each row once and its rows are distinct.
    """
    tracks = samples.select(*columns).distinct()
    filled = audio.select(key, *[null_to(c, d).alias(c) for c, d in defaults.items()]).distinct()
    found = tracks.join(filled, key)
    return one_per_key(found, key, found.columns) if per_key else found


def missing_keys(wanted: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Keys still to do: distinct wanted keys without those already loaded."""
    return wanted.select(key).distinct().join(done.select(key).distinct(), key, "left_anti")


class Unavailable(Exception):
    """A look-up client raises this for a time-out that is worth one more try."""


def enrich_missing(
    wanted: DataFrame,
    done: DataFrame,
    key: str,
    client_factory: Callable[[], Callable[[list], list[dict]]],
    out_schema: T.StructType,
    batch_size: int = 50,
    pause: float = 0.5,
    retries: int = 1,
) -> DataFrame:
    """Call an outside look-up for each missing key, in batches inside the tasks.

    `client_factory` is called once per task and gives a function from keys to records. A batch that times out is
    tried again `retries` times; any other error skips the batch, whose keys stay missing and come up again on the
    next run. Append the result to `done` to resume.
    """
    names = [f.name for f in out_schema.fields]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = client_factory()

        def call(keys: list) -> list[dict]:
            for attempt in range(retries + 1):
                try:
                    return client(keys)
                except Unavailable:
                    if attempt < retries and pause:
                        time.sleep(pause)
                except Exception as problem:  # noqa: BLE001 - a bad batch must not end the task
                    print(f"look-up skipped {len(keys)} keys: {problem}")
                    return []
            return []

        for frame in frames:
            keys = frame[key].tolist()
            for start in range(0, len(keys), batch_size):
                records = call(keys[start : start + batch_size])
                if records:
                    yield pd.DataFrame(records).reindex(columns=names)
                if pause:
                    time.sleep(pause)

    return missing_keys(wanted, done, key).mapInPandas(run, out_schema)
