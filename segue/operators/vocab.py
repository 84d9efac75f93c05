"""Vocabularies: learn them, number them, merge them, and turn text into token ids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segue.functions import text as X
from segue.operators.skew import dense_index, top_per_group
from segue.session import stash

MAX_TOKENS = 20_000
# Id 0 is padding, id 1 an unknown token, the vocabulary starts at 2.
UNKNOWN_ID = 1
FIRST_ID = 2
TASK_TOKENS = 20_000


def count_ngrams(df: DataFrame, features: Sequence[str], n: int = 2) -> DataFrame:
    """(feature, token, n) for all features in one job; an array feature counts the grams of each element.

    Grams are counted on the map side first, so common tokens are no hot spot. Each word meets the n - 1 words after it in
    one row, from which its grams come, so that all of it is generated code.
    """
    kinds = dict(df.dtypes)
    listed = [
        F.struct(
            F.lit(f).alias("feature"),
            (F.col(f).cast("array<string>") if kinds[f].startswith("array") else F.array(F.col(f).cast("string"))).alias("texts"),
        )
        for f in features
    ]
    texts = df.select(F.inline(F.array(*listed))).select("feature", F.explode("texts").alias("text"))
    words = texts.select("feature", X.tokens("text").alias("_words"))
    after = [F.slice("_words", i, F.greatest(F.size("_words") - F.lit(i - 1), F.lit(0))).alias(f"_{i}") for i in range(1, n + 1)]
    placed = words.select("feature", F.inline(F.arrays_zip(*after)))
    # a gram that goes beyond the text's end is NULL, as its last words are
    sizes = [F.concat(*[c for j in range(1, i + 1) for c in (F.lit(" "), F.col(f"_{j}"))][1:]) for i in range(1, n + 1)]
    grams = placed.select("feature", F.explode(F.array(*sizes)).alias("token")).where("token is not null")
    return grams.groupBy("feature", "token").agg(F.count(F.lit(1)).alias("n"))


def fit_vocab(df: DataFrame, features: Sequence[str], max_tokens: int = MAX_TOKENS, n: int = 2, pieces: int = 64) -> DataFrame:
    """(feature, token, n, idx): the commonest grams of each feature, ties by token.

    `max_tokens` counts the two fixed ids as well, so every id is below it.
    """
    counts = count_ngrams(df, features, n)
    best = top_per_group(counts, ["feature"], [F.desc("n"), F.asc("token")], max_tokens - FIRST_ID, "idx", pieces)
    return best.withColumn("idx", F.col("idx") + F.lit(FIRST_ID - 1))


def merge_vocabs(*vocabs: DataFrame) -> DataFrame:
    """Features of all vocabularies; where two hold the same feature the later one wins."""
    tagged = reduce(DataFrame.unionByName, [v.withColumn("_src", F.lit(i)) for i, v in enumerate(vocabs)])
    winner = tagged.groupBy("feature").agg(F.max("_src").alias("_src"))
    return tagged.join(winner, ["feature", "_src"], "left_semi").drop("_src")


def compare_vocabs(a: DataFrame, b: DataFrame) -> DataFrame:
    """Per feature: tokens in a, in b, and in both."""
    both = a.select("feature", "token", F.lit(1).alias("_a")).join(
        b.select("feature", "token", F.lit(1).alias("_b")), ["feature", "token"], "full"
    )
    return both.groupBy("feature").agg(
        F.count("_a").alias("n_a"), F.count("_b").alias("n_b"), F.count(F.col("_a") + F.col("_b")).alias("n_both")
    )


def unique_values(df: DataFrame, col: str, index: str = "idx", start: int = 0) -> DataFrame:
    """Distinct values with a dense index in sorted order."""
    return dense_index(df.select(col).where(F.col(col).isNotNull()).distinct(), col, index, start)


def string_lookup(df: DataFrame, col: str, vocab: DataFrame, value: str, index: str, out: str) -> DataFrame:
    """Index of the value in a vocabulary of any size; 0 where it is unknown."""
    table = vocab.select(F.col(value).alias(col), F.col(index).alias(out))
    return df.join(table, col, "left").withColumn(out, F.coalesce(F.col(out), F.lit(0)))


def looked_up(grams: Column, tokens: Sequence[str], values: Sequence[int], other: int, nested: bool = False) -> Column:
    """The value of each gram of an array, `other` for grams that are no token; with `nested`, of an array of such arrays.
    An Arrow function over whole batches, which takes the tokens along."""

    def find(lists: pa.Array, depth: int) -> pa.Array:
        if depth == 0:
            place = pc.index_in(lists, value_set=pa.array(tokens, pa.string()))
            return pc.fill_null(pa.array(values, pa.int64()).take(place), other)
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        edges = pa.array([0, *sizes.cumsum().tolist()], pa.int32())
        return pa.ListArray.from_arrays(edges, find(lists.flatten(), depth - 1), mask=lists.is_null())

    depth, kind = (2, "array<array<bigint>>") if nested else (1, "array<bigint>")

    @F.arrow_udf(kind)
    def values_of(lists: pa.Array) -> pa.Array:
        return find(lists, depth)

    return values_of(grams)


def split_keys(df: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """(the rows whose key is whole and comes once, the others, or None if there are none). Only the keys are shuffled."""
    whole = reduce(Column.__and__, [F.col(k).isNotNull() for k in key])
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where(~whole | (F.col("_n") > 1))
    again = stash(counts.select(*[F.col(k).alias(f"_again_{i}") for i, k in enumerate(key)]), "repeated-keys")
    if again.isEmpty():
        return df, None
    same = [F.col(k).eqNullSafe(F.col(f"_again_{i}")) for i, k in enumerate(key)]
    return df.join(again, same, "left_anti"), df.join(again, same, "left_semi")


def vectorize_text(df: DataFrame, key: Sequence[str], vocab: DataFrame, columns: Mapping[str, str], n: int = 2) -> DataFrame:
    """(key, outputs): token ids of the 1- to n-grams of text columns; `columns` maps column to output name.

    `key` tells the rows apart. An array column gives one id array per element. NULL texts give NULL, texts without
    words an empty array. The vocabulary may have any size. Up to TASK_TOKENS tokens go to the tasks, and rows do not move;
    with more, and for arrays of rows whose key is not whole or repeats, every distinct text is cut into grams once, its
    grams meet the vocabulary in a join, and the ids go back to the rows that hold the text.
    """
    known = vocab.where(F.col("feature").isin(*columns)).select("feature", "token", "idx").limit(TASK_TOKENS + 1).collect()
    if len(known) > TASK_TOKENS:
        return joined_ids(df, key, vocab, columns, n)
    kinds = dict(df.dtypes)
    listed = any(kinds[col].startswith("array") for col in columns)
    out, others = split_keys(df, key) if listed else (df, None)
    for col, name in columns.items():
        nested, mine = kinds[col].startswith("array"), [r for r in known if r.feature == col]
        cut = lambda text: X.ngrams(X.tokens(text), n)
        grams = F.transform(col, cut) if nested else cut(F.col(col))
        ids = looked_up(grams, [r.token for r in mine], [r.idx for r in mine], UNKNOWN_ID, nested)
        out = out.withColumn(name, ids.cast("array<array<int>>" if nested else "array<int>"))
    return out if others is None else out.unionByName(joined_ids(others, key, vocab, columns, n))


def joined_ids(df: DataFrame, key: Sequence[str], vocab: DataFrame, columns: Mapping[str, str], n: int = 2) -> DataFrame:
    """`vectorize_text` by joins, for a vocabulary of any size."""
    kinds = dict(df.dtypes)
    out = df
    for col, name in columns.items():
        nested = kinds[col].startswith("array")
        table = vocab.where(F.col("feature") == col).select("token", "idx")
        single = df.select(F.explode(col).alias("_text")) if nested else df.select(F.col(col).alias("_text"))
        texts = single.where("_text is not null").distinct()
        grams = texts.select("_text", F.posexplode(X.ngrams(X.tokens("_text"), n)).alias("_place", "token"))
        placed = F.struct("_place", F.coalesce(F.col("idx"), F.lit(UNKNOWN_ID)).cast("int").alias("id"))
        ids = grams.join(table, "token", "left").groupBy("_text").agg(F.array_sort(F.collect_list(placed)).alias("_ids"))
        ids = texts.join(ids.select("_text", F.col("_ids.id").alias("_ids")), "_text", "left")
        ids = ids.select("_text", F.coalesce("_ids", F.array().cast("array<int>")).alias("_ids"))
        if nested:
            parts = df.select(*key, F.posexplode(col).alias("_at", "_text")).join(ids, "_text", "left")
            whole = parts.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("_at", "_ids"))).alias("_all"))
            found = whole.select(*key, F.col("_all._ids").alias(name))
            empty = F.when(F.col(col).isNotNull(), F.array().cast("array<array<int>>"))
            out = out.join(found, list(key), "left").withColumn(name, F.coalesce(F.col(name), empty))
        else:
            out = out.join(ids.withColumnsRenamed({"_text": col, "_ids": name}), col, "left")
    return out
