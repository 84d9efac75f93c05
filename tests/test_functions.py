"""Scalars, text and vectors on the odd cases."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from segue.functions import scalars as C
from segue.functions import text as X
from segue.functions import vectors as V
from segue.operators import vocab


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()], F.lit(0).alias("_")).select(column.alias("r")).first().r


def test_fillers(spark):
    assert one(spark, C.blank_to("x"), x="") == "NONE"
    assert one(spark, C.blank_to("x"), x="a") == "a"
    assert one(spark, C.blank_to(F.lit(None).cast("string"))) is None
    assert one(spark, C.null_to(F.lit(None).cast("double"), 0.0)) == 0.0


@pytest.mark.parametrize(
    ("text", "parsed", "clean"),
    [("[]", ["NONE"], ["NONE"]), (None, ["NONE"], ["NONE"]), ("['pop']", ["'pop'"], ["pop"]), ("['pop', 'new wave']", ["'pop'", " 'new wave'"], ["pop", "new wave"])],
)
def test_genres(spark, text, parsed, clean):
    value = F.lit(text).cast("string")
    assert one(spark, C.parse_genres(value)) == parsed
    assert one(spark, C.clean_genres(value)) == clean


def test_genres_text(spark):
    genres = F.array(F.lit("new wave"), F.lit("pop"), F.lit(None).cast("string"))
    assert one(spark, C.join_genres(genres)) == "new wave,pop,MISSING"
    assert one(spark, C.slug_genres(F.array(F.lit("new wave"), F.lit("pop")))) == "new_wave pop"
    assert one(spark, C.slug_genres(F.array().cast("array<string>"))) == "unknown"


def test_links_and_ids(spark):
    assert one(spark, C.uri_from_link("u"), u="https://x.example/playlist/abc?si=1") == "abc"
    assert one(spark, C.strip_prefix("u", "catalog:track:"), u="catalog:track:77") == "77"
    assert one(spark, C.sample_id(F.lit(12), F.lit(3))) == "12-3"
    assert one(spark, C.lower_bool(F.lit(True))) == "true"
    assert one(spark, C.decode_utf8(F.encode(F.lit("é"), "UTF-8"))) == "é"


@pytest.mark.parametrize("x", [-1.0, 0.0, 0.1, 5.26, 50.0, 99.9, 100.0, 1e9])
def test_buckets_count_boundaries(spark, x):
    bounds = C.linspace(100.0)
    assert len(bounds) == 20 and bounds[0] == 0 and bounds[-1] == 100
    assert one(spark, C.bucketize("x", 100.0), x=x) == sum(b <= x for b in bounds)


def test_masked_hash(spark):
    assert one(spark, C.hash_bin("x", 10, mask=""), x="") == 0
    for portable in (False, True):
        bins = {one(spark, C.hash_bin("x", 10, mask="", portable=portable), x=f"v{i}") for i in range(12)}
        assert bins <= set(range(1, 10))


def test_rounding_and_clipping(spark):
    assert [one(spark, C.round_half_even("x"), x=v) for v in (0.5, 1.5, 2.5)] == [0.0, 2.0, 2.0]
    assert one(spark, C.clip("x"), x=1e15) == 1e12
    assert one(spark, C.clip(F.lit(None).cast("double"))) is None


def test_words_and_grams(spark):
    assert one(spark, X.tokens("x"), x=" Don't  STOP, Été!\n") == ["dont", "stop", "Été"]
    assert one(spark, X.ngrams(X.tokens("x")), x="a b c") == ["a", "b", "c", "a b", "b c"]
    assert one(spark, X.ngrams(X.tokens("x"), 3), x="a b c") == ["a", "b", "c", "a b", "b c", "a b c"]
    assert one(spark, X.ngrams(X.tokens("x")), x="a") == ["a"]
    assert one(spark, X.ngrams(X.tokens("x")), x="!!") == []


@settings(max_examples=15, deadline=None)
@given(values=st.lists(st.floats(-50, 50), min_size=1, max_size=12))
def test_vector_functions_match_numpy(spark, values):
    v = F.array(*[F.lit(x) for x in values])
    row = spark.range(1).select(V.l2_normalize(v).alias("unit"), V.layer_norm(v).alias("ln"), V.mean(v).alias("m"), V.dot(v, v).alias("d")).first()
    a = np.array(values)
    length = math.sqrt((a * a).sum())
    assert np.allclose(row.unit, a / length if length else a)
    assert np.allclose(row.ln, (a - a.mean()) / np.sqrt(a.var() + 1e-3))
    assert np.isclose(row.m, a.mean()) and np.isclose(row.d, (a * a).sum())


def test_nan_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, float("nan")]), (2, [1.0, 2.0])], "id int, v array<double>")
    assert [r.id for r in df.where(~V.has_nan("v")).collect()] == [2]


def test_vocabulary(spark):
    rows = [(1, "a b a", ["x y", "x"]), (2, "a c", ["y"]), (3, None, None), (4, "", [None, "", "q"]), (5, "a b a", [])]
    df = spark.createDataFrame(rows, "k int, t string, l array<string>")
    learnt = vocab.fit_vocab(df, ["t", "l"], max_tokens=5)
    got = {(r.feature, r.token): (r.n, r.idx) for r in learnt.collect()}
    assert got["t", "a"] == (5, 2) and got["t", "a b"] == (2, 3) and got["t", "b"] == (2, 4)
    assert got["l", "x"] == (2, 2) and got["l", "y"] == (2, 3) and got["l", "q"] == (1, 4)
    ids = {r.k: (r.ti, r.li) for r in vocab.vectorize_text(df, ["k"], learnt, {"t": "ti", "l": "li"}).collect()}
    assert ids == {
        1: ([2, 4, 2, 3, 1], [[2, 3, 1], [2]]), 2: ([2, 1, 1], [[3]]), 3: (None, None), 4: ([], [None, [], [4]]), 5: ([2, 4, 2, 3, 1], []),
    }


def test_vectors_of_a_large_vocabulary(spark):
    words = spark.range(25_000).selectExpr("id AS k", "concat('w', id) AS t")
    learnt = words.selectExpr("'t' AS feature", "t AS token", "cast(k + 2 AS int) AS idx")
    found = vocab.vectorize_text(words, ["k"], learnt, {"t": "ids"})
    assert found.where("ids = array(cast(k + 2 AS int))").count() == 25_000
    assert "Python" not in found._jdf.queryExecution().toString()


def test_merge_and_compare(spark):
    schema = "feature string, token string, n bigint, idx int"
    a = spark.createDataFrame([("f", "x", 1, 2), ("g", "y", 1, 2)], schema)
    b = spark.createDataFrame([("f", "z", 9, 2)], schema)
    assert sorted((r.feature, r.token) for r in vocab.merge_vocabs(a, b).collect()) == [("f", "z"), ("g", "y")]
    found = {r.feature: (r.n_a, r.n_b, r.n_both) for r in vocab.compare_vocabs(a, b).collect()}
    assert found == {"f": (1, 1, 0), "g": (1, 0, 0)}
