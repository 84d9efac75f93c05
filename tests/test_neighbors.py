"""Exact search against NumPy in one and in many blocks; approximate search against exact search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from segue.operators import evaluate, neighbors, retrieval


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(300, 16))
    vectors[10] = vectors[20] = vectors[30]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id bigint, embedding array<double>").cache()
    return vectors, df


def brute(vectors, k, skip_self=True):
    scores = np.round(vectors @ vectors.T, 9)
    out = {}
    for q in range(len(vectors)):
        order = sorted((i for i in range(len(vectors)) if not (skip_self and i == q)), key=lambda i: (-scores[q, i], i))
        out[q] = order[:k]
    return out


def as_lists(df):
    found = {}
    for r in sorted(df.collect(), key=lambda r: (r.query, r["rank"])):
        found.setdefault(r.query, []).append(r.id)
    return found


@pytest.mark.parametrize("block", [1000, 64])
def test_exact_search(data, block):
    vectors, df = data
    found = neighbors.knn(df.withColumnRenamed("id", "query"), df, 7, skip_self=True, block=block)
    assert as_lists(found) == brute(vectors, 7)


def test_k_above_the_catalogue(data):
    vectors, df = data
    few = df.where("id < 5")
    assert neighbors.knn(few.withColumnRenamed("id", "query"), few, 50, block=2).count() == 25


def test_all_leaves_give_the_exact_result(data):
    vectors, df = data
    index = neighbors.build_leaves(df, leaf_size=40)
    asked = df.withColumnRenamed("id", "query")
    assert sum(index.leaf_rows.values()) == 300
    found = neighbors.search_leaves(index, asked, 7, leaf_pct=100, skip_self=True, block=16)
    assert as_lists(found) == brute(vectors, 7)


def test_few_leaves_recall_and_containment(data):
    vectors, df = data
    index = neighbors.build_leaves(df, leaf_size=20)
    asked = df.withColumnRenamed("id", "query")
    exact = neighbors.knn(asked, df, 5, skip_self=True)
    low = neighbors.recall(neighbors.search_leaves(index, asked, 5, leaves=2, skip_self=True), exact).first().recall
    high = neighbors.recall(neighbors.search_leaves(index, asked, 5, leaves=8, skip_self=True), exact).first().recall
    assert 0.1 < low <= high <= 1.0
    assert neighbors.recall(exact, exact).first().recall == 1.0


def test_rerank_gives_exact_scores(data):
    vectors, df = data
    index = neighbors.build_leaves(df, leaf_size=20)
    asked = df.withColumnRenamed("id", "query")
    found = neighbors.search_rerank(index, asked, df, 5, reorder=60, leaves=100, skip_self=True)
    exact = neighbors.knn(asked, df, 5, skip_self=True)
    assert neighbors.recall(found, exact).first().recall > 0.97
    for r in found.limit(20).collect():
        assert r.score == pytest.approx(float(vectors[r.query] @ vectors[r.id]), abs=1e-8)


def test_index_on_disk(data, spark, tmp_path):
    vectors, df = data
    index = neighbors.build_leaves(df, leaf_size=40, path=str(tmp_path / "leaves"))
    found = neighbors.search_leaves(index, df.withColumnRenamed("id", "query"), 7, leaf_pct=100, skip_self=True)
    assert as_lists(found) == brute(vectors, 7)


def test_catalogue_metrics(data):
    vectors, df = data
    asked = df.select(F.col("id").alias("query"), "embedding", F.pmod(F.col("id") * 7, F.lit(300)).alias("true_id"))
    scores = np.round(vectors @ vectors.T, 9)
    better = np.array([(scores[q] > scores[q, q * 7 % 300]).sum() for q in range(300)])
    out = evaluate.factorized_top_k(asked, df, "true_id", (10, 50)).first()
    assert (out.n, out.top_10, out.top_50) == (300, pytest.approx((better < 10).mean()), pytest.approx((better < 50).mean()))


def test_ndcg_of_a_perfect_order_is_one(spark):
    df = spark.createDataFrame([("a", i, 10 - i, 10 - i) for i in range(10)] + [("b", i, i, 0) for i in range(3)], "g string, id int, s int, rel int")
    got = {r.g: r.ndcg for r in evaluate.ndcg(df, "g", "s", "rel", "id", 5).collect()}
    assert got == {"a": pytest.approx(1.0), "b": 0.0}


def test_trained_vectors_prefer_own_items(spark):
    rows = [(u, 2 * i + u % 2) for u in range(40) for i in range(12) if (u * 5 + i * 3) % 4]
    pairs = spark.createDataFrame(rows, "pid bigint, item bigint")
    asked, items = retrieval.fit_retrieval(pairs, "pid", "item", rank=4, iterations=6, blocks=2)
    top = neighbors.knn(asked.withColumnRenamed("id", "query"), items, 3)
    right = top.select((F.col("id") % 2 == F.col("query") % 2).cast("double").alias("ok")).agg(F.avg("ok")).first()[0]
    assert right > 0.95


def test_ranker_beats_the_mean(spark):
    rows = [(float(i % 13), float(i % 7), float((i % 13) + 2 * (i % 7))) for i in range(400)]
    df = spark.createDataFrame(rows, "a double, b double, label double")
    model = retrieval.fit_ranker(df, ["a", "b"], iterations=8)
    fitted = evaluate.rmse(retrieval.with_predictions(model, df), "label", "prediction").first().rmse
    spread = df.agg(F.stddev_pop("label")).first()[0]
    assert fitted < spread / 3


def test_spoilt_vectors_neither_ask_nor_are_found(spark):
    rng = np.random.default_rng(7)
    good = rng.normal(size=(40, 4))
    rows = [(i, v.tolist()) for i, v in enumerate(good)] + [(100 + i, [float("nan"), 1.0, 1.0, 1.0]) for i in range(3)]
    rows += [(200, None), (201, [None, 1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "id bigint, embedding array<double>")
    found = neighbors.knn(df.withColumnRenamed("id", "query"), df, 3, skip_self=True)
    assert as_lists(found) == brute(good, 3)
    index = neighbors.build_leaves(df, leaf_size=10)
    every = neighbors.search_leaves(index, df.withColumnRenamed("id", "query"), 3, leaf_pct=100.0, skip_self=True)
    assert as_lists(every) == brute(good, 3)


def test_small_leaves_still_give_k_results(data):
    vectors, df = data
    index = neighbors.build_leaves(df, leaf_size=4)
    found = as_lists(neighbors.search_leaves(index, df.withColumnRenamed("id", "query"), 10, leaves=1, skip_self=True))
    assert len(found) == len(vectors) and all(len(ids) == 10 for ids in found.values())


def test_score_without_rows(spark):
    empty = spark.createDataFrame([], "id bigint, embedding array<double>")
    assert retrieval.score(empty, retrieval.projection(np.eye(4)), "id", "embedding", 4).count() == 0


@pytest.mark.parametrize("leaf_size", [5, 20])
def test_searches_reach_the_recall_aimed_at(data, leaf_size):
    vectors, df = data
    index = neighbors.build_leaves(df, leaf_size=leaf_size)
    asked = df.withColumnRenamed("id", "query")
    exact = neighbors.knn(asked, df, 10, skip_self=True)
    for found in (neighbors.search_leaves(index, asked, 10, skip_self=True), neighbors.search_rerank(index, asked, df, 10, skip_self=True)):
        assert neighbors.recall(found, exact).first().recall >= 0.9
    few = neighbors.leaves_for_recall(index, asked, 10, 0.5, skip_self=True)
    assert 1 <= few < neighbors.leaves_for_recall(index, asked, 10, skip_self=True) <= index.leaves
    low = neighbors.recall(neighbors.search_leaves(index, asked, 10, leaves=few, skip_self=True), exact).first().recall
    assert low >= 0.5


def test_vectors_move_once_for_any_number_of_blocks(spark):
    rng = np.random.default_rng(3)
    vectors = rng.integers(-4, 5, (60, 3)).astype(float)  # many ties
    df = spark.createDataFrame([(i // 2 if i < 10 else i, v.tolist()) for i, v in enumerate(vectors)], "id bigint, embedding array<double>")
    asked = df.withColumnRenamed("id", "query")
    found = neighbors.knn(asked, df, 4, block=7)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "CoGroups" not in plan
    rows = [(r.id, np.array(r.embedding)) for r in df.collect()]
    best = {}
    for q, a in rows:
        best.setdefault(q, []).extend((-float(a @ b), i) for i, b in rows)
    expected = {(q, rank, i, -s) for q, all_ in best.items() for rank, (s, i) in enumerate(sorted(all_)[:4], 1)}
    assert {(r.query, r["rank"], r.id, r.score) for r in found.collect()} == expected
    true = asked.where("query > 20").withColumn("true_score", F.lit(3.0))
    better = {r.query: r.better for r in neighbors.count_better(true, df, block=7).collect()}
    assert better == {q: sum(float(a @ b) > 3 for _, b in rows) for q, a in rows if q > 20}
