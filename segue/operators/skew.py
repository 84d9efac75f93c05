"""Ways to keep one heavy key from becoming one heavy task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from segue.session import stash

DEALT_ROWS, MOST_HOT, DRAWN = 100_000, 10_000, 64
MANY_ROWS = 1 << 62


def fits(df: DataFrame, max_rows: int) -> bool:
    """Whether the frame has at most `max_rows` rows; reads no more than one row beyond that."""
    return df.limit(max_rows + 1).count() <= max_rows


def dealt_groups(
    many: DataFrame, few: DataFrame, keys: Sequence[str], how: str = "inner", per_part: int = DEALT_ROWS, rows: int | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """The join on `keys` of many rows a key with few; keys with more than `per_part` rows of `many` are dealt over tasks.

    The rows of such a key go to parts by their hash, and its rows of `few` are repeated for each part. The keys are found
    in one row of DRAWN, by hash, unless `counts` (keys, n) has them; the MOST_HOT heaviest are broadcast, so a key that is
    not listed has fewer than one row in MOST_HOT of the table. Which keys are listed changes the tasks, never the result.
    `many` is read twice, so it should be a written table or cheap; `rows`, if given, saves counting it, and MANY_ROWS asks
    for the same plan at every size. `how` is inner, left_semi or left_anti.
    """
    keys = list(keys)
    if (many.count() if rows is None else rows) <= per_part:
        return many.join(few, keys, how)
    if counts is None:
        drawn = many.where(F.pmod(F.xxhash64(F.lit(9), *many.columns), F.lit(DRAWN)) == 0)
        counts = drawn.groupBy(*keys).agg((F.count(F.lit(1)) * DRAWN).alias("n"))
    # the heaviest keys are listed whether they are hot or not, so that the plan is the same for every table
    hot = counts.orderBy(F.desc("n"), *keys).limit(MOST_HOT).select(*keys, F.ceil(F.col("n") / F.lit(per_part)).alias("_parts"))
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    left = many.join(F.broadcast(hot), keys, "left").withColumn("_part", F.pmod(F.xxhash64(*many.columns), parts)).drop("_parts")
    right = few.join(F.broadcast(hot), keys, "left").withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1))).drop("_parts")
    return left.join(right, [*keys, "_part"], how).drop("_part")


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank", pieces: int = 1
) -> DataFrame:
    """The first `k` rows of each group.

    Up to k = 1000 Spark cuts each group on the map side before the shuffle, so a heavy group is no problem.
    For larger k, `pieces` cuts each group by a hash of the row first; the best k overall are among the best
    k of the pieces, so the result is the same.
    """
    if pieces > 1:
        piece = F.pmod(F.xxhash64(*df.columns), F.lit(pieces))
        first = W.partitionBy(*group, "_piece").orderBy(*order)
        df = df.withColumn("_piece", piece).withColumn("_r", F.row_number().over(first))
        df = df.where(F.col("_r") <= k).drop("_piece", "_r")
    w = W.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def running_offsets(counts: DataFrame, over: Sequence[str], order: str, value: str, out: str) -> DataFrame:
    """Sum of `value` over the earlier bins; `counts` has one row per bin, so it is small by construction."""
    w = W.partitionBy(*over) if over else W.partitionBy(F.lit(0))
    w = w.orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return counts.withColumn(out, F.coalesce(F.sum(value).over(w), F.lit(0)))


def hash_rank(df: DataFrame, key: str, seed: int = 42, digits: int = 4, rank: str = "rank", total: str = "total") -> DataFrame:
    """Place of each row in a seeded shuffle (1-based), with the row count, without a global sort.

    Rows fall into 16**digits bins by the front of their hash. Bin counts give the offsets (a table of at most
    16**digits rows, so it may be broadcast), and each bin is ordered alone. `key` must be unique.
    """
    hashed = df.withColumn("_h", F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed)))))
    hashed = hashed.withColumn("_bin", F.substring("_h", 1, digits))
    counts = hashed.groupBy("_bin").agg(F.count(F.lit(1)).alias("_n"))
    offsets = running_offsets(counts, [], "_bin", "_n", "_before")
    offsets = offsets.withColumn(total, F.sum("_n").over(W.partitionBy(F.lit(0))))
    inside = F.row_number().over(W.partitionBy("_bin").orderBy("_h", key))
    ranked = hashed.withColumn("_r", inside).join(F.broadcast(offsets), "_bin")
    return ranked.withColumn(rank, F.col("_before") + F.col("_r")).drop("_h", "_bin", "_n", "_before", "_r")


def dense_index(df: DataFrame, col: str, index: str = "idx", start: int = 0) -> DataFrame:
    """Index of each value in sorted order; `df` holds distinct values.

    Values are dealt by range, numbered inside their range and shifted by the sizes of the ranges before it, so the work
    of a task is a range, whose size the shuffle settings bound. The dealt values are written out, as they are used twice.
    """
    placed = stash(df.repartitionByRange(col).withColumn("_piece", F.spark_partition_id()), "values")
    counts = placed.groupBy("_piece").agg(F.count(F.lit(1)).alias("_n"))
    offsets = running_offsets(counts, [], "_piece", "_n", "_before").drop("_n")
    inside = F.row_number().over(W.partitionBy("_piece").orderBy(col))
    numbered = placed.withColumn("_r", inside).join(offsets, "_piece")
    return numbered.withColumn(index, (F.col("_before") + F.col("_r") + F.lit(start - 1)).cast("bigint")).drop("_piece", "_before", "_r")
