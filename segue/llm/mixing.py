"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from segue.session import stash

UNIT = float(2**52)
SOURCES = 100_000
MOST = 700.0  # beyond this rate exp(-rate) is no longer a normal double


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the md5 of the parts: the same on every run and every engine."""
    digest = F.md5(F.concat_ws("-", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(UNIT)


def poisson_count(u: Column, mean: Column) -> Column:
    """The Poisson count at level `u`: how many values of the distribution function are <= u.

    The sum goes up term by term to `mean` + 12 deviations + 30, beyond which no double below 1 is reached.
    """
    last = F.ceil(mean + 12 * F.sqrt(mean) + 30).cast("int")
    start = F.struct(F.exp(-mean).alias("term"), F.exp(-mean).alias("below"), F.lit(0).alias("n"))

    def step(acc: Column, k: Column) -> Column:
        term = acc["term"] * mean / k
        return F.struct(
            term.alias("term"), (acc["below"] + term).alias("below"),
            (acc["n"] + F.when(acc["below"] <= u, 1).otherwise(0)).alias("n"),
        )

    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda acc: acc["n"])


def rates(docs: DataFrame, source: str, weights: Mapping[str, float] | None, power: float, total: float) -> DataFrame:
    """(source, mean): how often a document of each source is wanted.

    A source's weight is that of `weights`; sources that are not named there share weight by their number of documents
    to the given power, scaled so that the largest of them has weight 1. The mix has `total` times as many documents
    as the table.
    """
    counts = docs.groupBy(F.col(source).alias("mix_source")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    every = W.partitionBy(F.lit(0))
    weight = F.pow(F.col("n") / F.max("n").over(every), F.lit(float(power)))
    for name, value in (weights or {}).items():
        if not (math.isfinite(value) and value >= 0):
            raise ValueError(f"weight of {name}: {value}")
        weight = F.when(F.col("mix_source").eqNullSafe(F.lit(name)), F.lit(float(value))).otherwise(weight)
    weighted = counts.withColumn("weight", weight)
    share = F.col("weight") / F.sum("weight").over(every)
    mean = F.coalesce(F.lit(float(total)) * F.sum("n").over(every) * share / F.col("n"), F.lit(0.0))
    too_many = F.raise_error(F.concat(F.lit("over 700 copies of each document are wanted of source "), F.coalesce(F.col("mix_source").cast("string"), F.lit("NULL"))))
    return weighted.select("mix_source", F.when(mean > MOST, too_many.cast("double")).otherwise(mean).alias("mean"))


def mix_sources(
    docs: DataFrame, source: str = "source", key: str = "doc_id", weights: Mapping[str, float] | None = None,
    power: float = 0.5, total: float = 1.0, seed: int = 42, copy: str | None = "copy", text: str = "text",
) -> DataFrame:
    """Each document as often as the mix wants it, all in one seeded order; `copy` numbers a document's copies from 1.

    The count is the Poisson distribution with the source's rate, inverted at a level hashed from `key` and `seed`, so
    it needs no state and no order, and a lost task gives the same rows again. Its expected total is `total` times the
    table. NULL is a source of its own; where the key is NULL, the text is hashed in its place; rows that repeat a key, or
    a text without key, have the same count. All columns are kept. A column that is already called as `copy` is replaced.
    An empty table gives no rows. A rate above 700 copies fails the job.

    The order is that of a hash of (seed, key, copy). As hashes are even, their range is cut in equal parts, one for each
    shuffle partition, without a look at the data; so the texts move once, and a hot source spreads evenly. The table of
    rates has a row for each source; up to SOURCES of them it is broadcast, beyond that adaptive execution splits a hot one.
    """
    wanted = stash(rates(docs, source, weights, power, total), "rates")
    wanted = F.broadcast(wanted) if wanted.count() <= SOURCES else wanted
    nested = docs.select(F.struct("*").alias("doc"))
    joined = nested.join(wanted, F.col(f"doc.`{source}`").eqNullSafe(F.col("mix_source")))
    id_, digest = F.col(f"doc.`{key}`"), F.md5(F.coalesce(F.col(f"doc.`{text}`"), F.lit("")))
    level = F.when(id_.isNull(), uniform(F.lit(seed), F.lit("null"), digest)).otherwise(uniform(F.lit(seed), id_))
    counted = joined.select("doc", poisson_count(level, F.col("mean")).alias("n"))
    copies = counted.where(F.col("n") > 0).select("doc", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
    place = F.xxhash64(F.lit(seed), id_, F.when(id_.isNull(), F.xxhash64(F.col(f"doc.`{text}`"))), F.col("copy"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.floor((F.col("place") / F.lit(2.0**64) + 0.5) * parts)
    dealt = copies.withColumn("place", place).repartitionById(parts, F.least(part, F.lit(parts - 1)).cast("int"))
    ordered = dealt.sortWithinPartitions("place", "copy")
    kept = [F.col(f"doc.`{name}`") for name in docs.columns if name != copy]
    return ordered.select(*kept, *([F.col("copy").alias(copy)] if copy else []))
