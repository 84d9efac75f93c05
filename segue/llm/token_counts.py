"""Token counts: an exact histogram of encoded lengths that answers totals for every context limit."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from segue.llm.text_bytes import release
from segue.llm.words import encoded_lengths, words_of
from segue.session import stash

BIN = 512


def length_histogram(docs: DataFrame, tokenizer_path: str, text: str = "text", by: Sequence[str] = ()) -> DataFrame:
    """(*by, n_tokens, n_docs): how many documents have each encoded length.

    NULL texts and empty texts have length 0, repeated rows count each, NULL is a value of `by` like any other, and an
    empty table gives no rows. Other columns are not read. Lengths are counted where the texts are; only one row for
    each length and task is shuffled, so a hot value of `by` is no problem.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = encoded_lengths(tokenizer_path, batch.column(batch.num_columns - 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(lengths, pa.int64())], names=names)
        release()

    keys = [F.col(name).alias(f"by_{i}") for i, name in enumerate(by)]
    split = docs.select(*keys, words_of(F.col(text)).alias("words"))
    schema = ", ".join([*(f"by_{i} {docs.schema[name].dataType.simpleString()}" for i, name in enumerate(by)), "n_tokens bigint"])
    names = [*(f"by_{i}" for i in range(len(by))), "n_tokens"]
    counted = split.mapInArrow(count, schema).groupBy(*names).agg(F.count(F.lit(1)).alias("n_docs"))
    return counted.select(*(F.col(f"by_{i}").alias(name) for i, name in enumerate(by)), "n_tokens", "n_docs")


def limit_table(histogram: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Suffix sums of a histogram: one row for each length, taken as a context limit.

    docs_over and tokens_over are of the longer documents, docs_upto is the rank that answers quantiles, total_tokens is
    of all documents, and kept_tokens is what is left when each document is cut at n_tokens. A limit between two rows
    keeps kept_tokens of the row below plus docs_over of it for each further token.

    Sums run inside bins of 512 lengths and the sums of later bins are added, so no task holds all lengths.
    """
    by = list(by)
    histogram = stash(histogram, "lengths")  # used twice, and far dearer than its rows
    binned = histogram.withColumns({"bin": F.floor(F.col("n_tokens") / BIN), "tokens": F.col("n_tokens") * F.col("n_docs")})
    after = W.partitionBy(*by).orderBy(F.desc("bin")).rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*by)
    bins = binned.groupBy(*by, "bin").agg(F.sum("n_docs").alias("bin_docs"), F.sum("tokens").alias("bin_tokens"))
    bins = bins.select(
        *(F.col(name).alias(f"same_{i}") for i, name in enumerate(by)), F.col("bin").alias("same_bin"),
        F.coalesce(F.sum("bin_docs").over(after), F.lit(0)).alias("docs_after"),
        F.coalesce(F.sum("bin_tokens").over(after), F.lit(0)).alias("tokens_after"),
        F.sum("bin_docs").over(whole).alias("total_docs"), F.sum("bin_tokens").over(whole).alias("total_tokens"),
    )
    match = F.col("bin") == F.col("same_bin")
    for i, name in enumerate(by):
        match = match & F.col(name).eqNullSafe(F.col(f"same_{i}"))
    longer = W.partitionBy(*by, "bin").orderBy(F.desc("n_tokens")).rowsBetween(W.unboundedPreceding, -1)
    inside = binned.withColumns({
        "docs_over": F.coalesce(F.sum("n_docs").over(longer), F.lit(0)),
        "tokens_over": F.coalesce(F.sum("tokens").over(longer), F.lit(0)),
    })
    docs_over, tokens_over = F.col("docs_over") + F.col("docs_after"), F.col("tokens_over") + F.col("tokens_after")
    return inside.join(bins, match).select(
        *by, "n_tokens", "n_docs", docs_over.alias("docs_over"), tokens_over.alias("tokens_over"),
        (F.col("total_docs") - docs_over).alias("docs_upto"), "total_docs", "total_tokens",
        (F.col("total_tokens") - tokens_over + F.col("n_tokens") * docs_over).alias("kept_tokens"),
    )


def quantiles(limits: DataFrame, shares: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(*by, share, n_tokens): the smallest length that at least this share of the documents does not exceed."""
    asked = limits.withColumn("share", F.explode(F.array(*[F.lit(float(s)) for s in shares])))
    reached = asked.where(F.col("docs_upto") >= F.col("share") * F.col("total_docs"))
    return reached.groupBy(*by, "share").agg(F.min("n_tokens").alias("n_tokens"))
