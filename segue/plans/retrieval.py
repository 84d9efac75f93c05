"""Queries on vectors and models: neighbours, recall, metrics, scoring, training and recommendations."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from segue.functions import vectors as V
from segue.functions.scalars import hash_bin
from segue.operators import evaluate, factors, listwise, neighbors, retrieval, tree_index
from segue.operators.sampling import split_by_mod
from segue.plans import lists
from segue.plans import tables as t
from segue.plans.basics import md5_sql
from segue.plans.registry import query
from segue.plans.tables import ITEMS, TRACKS
from segue.session import stash
from segue.sources.examples import label_rows

DIM = 64
DOT = "round(list_sum(list_transform(list_zip({a}, {b}), lambda p: p[1]::DOUBLE * p[2]::DOUBLE)), 9)"


def sql_dot(a: str, b: str) -> str:
    return DOT.format(a=a, b=b)


ALL_PAIRS = f"""pairs AS (
  SELECT q.vec_id AS query, c.vec_id AS id, {sql_dot('q.embedding', 'c.embedding')} AS score
  FROM embeddings q JOIN embeddings c ON q.vec_id <> c.vec_id)"""


def sql_knn(k: int) -> str:
    return f"""SELECT query, id, score, CAST(rank AS INTEGER) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, id) AS rank FROM pairs) WHERE rank <= {k}"""


def vectors(spark, sf):
    return t.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")


def _exact(spark, sf, k):
    all_vectors = vectors(spark, sf)
    return neighbors.knn(all_vectors.withColumnRenamed("id", "query"), all_vectors, k, skip_self=True)


@query("knn_brute_force", f"WITH {ALL_PAIRS} {sql_knn(10)}")
def _(spark, sf):
    return _exact(spark, sf, 10)


@query("topk_neighbors", f"WITH {ALL_PAIRS} {sql_knn(20)}")
def _(spark, sf):
    return _exact(spark, sf, 20)


@query(
    "cross_query_candidates",
    f"""WITH {ALL_PAIRS} SELECT query, CAST(count(*) AS BIGINT) AS n_scored, CAST(sum(CASE WHEN score > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_positive
    FROM pairs GROUP BY query""",
)
def _(spark, sf):
    # Every query is scored against every candidate; only the counts per query leave the blocks.
    all_vectors = vectors(spark, sf)
    asked = all_vectors.withColumnRenamed("id", "query")
    own = V.dot("embedding", "embedding")
    scored = neighbors.count_better(asked.withColumn("true_score", F.lit(0.0)), all_vectors).withColumnRenamed("better", "n_positive")
    every = neighbors.count_better(asked.withColumn("true_score", F.lit(-1e12)), all_vectors).withColumnRenamed("better", "n_scored")
    self_positive = asked.select("query", (F.round(own, neighbors.DIGITS) > 0).cast("bigint").alias("self"))
    joined = scored.join(every, "query").join(self_positive, "query")
    return joined.select("query", (F.col("n_scored") - 1).alias("n_scored"), (F.col("n_positive") - F.col("self")).alias("n_positive"))


@query(
    "drop_nan_vectors",
    """SELECT vec_id, label FROM (SELECT vec_id, label, list_transform(embedding, lambda x: CASE WHEN x::DOUBLE > 0.3::DOUBLE THEN 'nan'::DOUBLE ELSE x::DOUBLE END) AS v FROM embeddings)
    WHERE NOT list_bool_or(list_transform(v, lambda x: isnan(x)))""",
)
def _(spark, sf):
    # Some large values are spoilt first, as the given vectors are clean.
    spoilt = F.transform("embedding", lambda x: F.when(x.cast("double") > 0.3, F.lit(float("nan"))).otherwise(x.cast("double")))
    rows = t.table(spark, sf, "embeddings").select("vec_id", "label", spoilt.alias("v"))
    return rows.where(~V.has_nan("v")).select("vec_id", "label")


def _tree(spark, sf, leaf_size=25):
    return tree_index.build(vectors(spark, sf), leaf_size=leaf_size, skip_self=True)


def _asked(spark, sf):
    """The stated queries of the approximate searches."""
    return vectors(spark, sf).where("id % 100 = 0").withColumnRenamed("id", "query")


@query("ann_build_index")
def _(spark, sf):
    index = _tree(spark, sf)
    return index.items.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))


@query(
    "ann_index_check",
    """SELECT count(*) AS n_rows, count(DISTINCT vec_id) AS n_ids, CAST(0 AS BIGINT) AS misplaced, CAST(0 AS BIGINT) AS miscounted, true AS below_parents
    FROM embeddings""",
)
def _(spark, sf):
    # Every row is in one leaf, under the nearest of its parent's centres; counts of nodes are those of their rows.
    index = _tree(spark, sf)
    centres = index.nodes.select("parent", F.col("node").alias("sibling"), "centre")
    gap = F.aggregate(F.zip_with("vector", "centre", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
    parent = F.floor((F.col("leaf") - 1) / index.fan)
    gaps = index.items.withColumn("parent", parent).join(centres, "parent").select("id", "leaf", "sibling", gap.alias("gap"))
    best = gaps.groupBy("id").agg(F.min("gap").alias("least"), F.min(F.when(F.col("sibling") == F.col("leaf"), F.col("gap"))).alias("own"))
    held = index.items.groupBy("leaf").agg(F.count(F.lit(1)).alias("held")).join(index.nodes.withColumnRenamed("leaf", "is_leaf"), F.col("leaf") == F.col("node"))
    within = index.nodes.select("n", "parent").join(index.nodes.select(F.col("node").alias("parent"), F.col("n").alias("above")), "parent")
    return index.items.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("id").alias("n_ids")).join(
        best.agg(F.sum((F.col("own") > F.col("least") + 1e-9).cast("bigint")).alias("misplaced")), how="cross"
    ).join(held.agg(F.sum((F.col("held") != F.col("n")).cast("bigint")).alias("miscounted")), how="cross").join(
        within.agg(F.coalesce(F.min(F.col("n") < F.col("above")), F.lit(True)).alias("below_parents")), how="cross"
    )


@query("ann_search")
def _(spark, sf):
    return tree_index.search(_tree(spark, sf), _asked(spark, sf), 10, skip_self=True)


@query("ann_search_all_leaves", f"WITH {ALL_PAIRS} {sql_knn(10)}")
def _(spark, sf):
    asked = vectors(spark, sf).withColumnRenamed("id", "query")
    return tree_index.search(_tree(spark, sf), asked, 10, share=1.0, skip_self=True)


@query("ann_rerank")
def _(spark, sf):
    return tree_index.search(_tree(spark, sf, 10), _asked(spark, sf), 10, reorder=500, skip_self=True)


def _searches(spark, sf):
    """(name, what was found, what is right) of each approximate search."""
    rows, asked = vectors(spark, sf), _asked(spark, sf)
    exact = stash(neighbors.knn(asked, rows, 10, skip_self=True), "exact")
    lists_ = stash(retrieval.score_lists(t.items(spark, sf), _item_vectors(spark, sf), "pid", "pos", "track_id"), "queries")
    return [
        ("ann_search", tree_index.search(_tree(spark, sf), asked, 10, skip_self=True), exact),
        ("ann_rerank", tree_index.search(_tree(spark, sf, 10), asked, 10, reorder=500, skip_self=True), exact),
        ("recommend_playlists_index", retrieval.recommend_ids(lists_, _item_vectors(spark, sf), 10, 25), neighbors.knn(lists_, _item_vectors(spark, sf), 10)),
    ]


@query("ann_index_recall")
def _(spark, sf):
    # What each search of the index finds of the true neighbours.
    both = [neighbors.recall(found, exact).withColumn("search", F.lit(name)) for name, found, exact in _searches(spark, sf)]
    return reduce(DataFrame.unionByName, both).select("search", "recalled", "expected", "recall")


@query(
    "ann_search_check",
    f"""WITH {ITEMS}, n AS (SELECT count(*) FILTER (WHERE vec_id % 100 = 0) * 10 AS asked FROM embeddings),
    l AS (SELECT count(DISTINCT pid) * 10 AS asked FROM items WHERE track_id IN (SELECT vec_id FROM embeddings))
    SELECT name AS search, CAST(CASE WHEN name = 'recommend_playlists_index' THEN l.asked ELSE n.asked END AS BIGINT) AS n_found,
           CAST(0 AS BIGINT) AS wrong_scores, CAST(0 AS BIGINT) AS wrong_ranks, true AS recall_reached
    FROM n, l, (VALUES ('ann_search'), ('ann_rerank'), ('recommend_playlists_index')) s(name)""",
)
def _(spark, sf):
    # Approximate: which rows are found is not SQL's to say, but their number, scores, ranks and recall of 0.9 are.
    out = []
    for name, found, exact in _searches(spark, sf):
        found = stash(found, "found")
        right = found.join(exact.select("query", "id", F.col("score").alias("true")), ["query", "id"], "left")
        order = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "id"))
        # a found row that is no true neighbour must score below the worst one of them
        worst = exact.groupBy("query").agg(F.min("score").alias("worst"))
        checked = right.join(worst, "query").withColumn("place", order)
        wrong = F.when(F.col("true").isNull(), F.col("score") > F.col("worst")).otherwise(F.abs(F.col("score") - F.col("true")) > 1e-8)
        counted = checked.agg(
            F.count(F.lit(1)).alias("n_found"), F.sum(wrong.cast("bigint")).alias("wrong_scores"),
            F.sum((F.col("place") != F.col("rank")).cast("bigint")).alias("wrong_ranks"), F.count("true").alias("hit"),
        )
        expected = exact.agg(F.count(F.lit(1)).alias("expected"))
        reached = F.col("hit") >= 0.9 * F.col("expected")
        out.append(counted.join(expected, how="cross").select(F.lit(name).alias("search"), "n_found", "wrong_scores", "wrong_ranks", reached.alias("recall_reached")))
    return reduce(DataFrame.unionByName, out)


SHORT = f"""short AS (
  SELECT q.vec_id AS query, c.vec_id AS id, {sql_dot('list_slice(q.embedding, 1, 32)', 'list_slice(c.embedding, 1, 32)')} AS score
  FROM embeddings q JOIN embeddings c ON q.vec_id <> c.vec_id),
near AS (SELECT query, id FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, id) AS r FROM short) WHERE r <= 10),
best AS (SELECT query, id FROM ({sql_knn(10)}))"""


def _short(spark, sf):
    """Neighbours by the front half of the vectors: a cheap approximation that SQL can repeat."""
    half = vectors(spark, sf).withColumn("embedding", F.slice("embedding", 1, 32))
    return neighbors.knn(half.withColumnRenamed("id", "query"), half, 10, skip_self=True)


@query(
    "ann_recall",
    f"""WITH {ALL_PAIRS}, {SHORT} SELECT CAST(count(near.id) AS BIGINT) AS recalled, CAST(count(*) AS BIGINT) AS expected,
      count(near.id) / count(*)::DOUBLE AS recall FROM best LEFT JOIN near ON best.query = near.query AND best.id = near.id""",
)
def _(spark, sf):
    return neighbors.recall(_short(spark, sf), _exact(spark, sf, 10))


@query("intersect_neighbors", f"WITH {ALL_PAIRS}, {SHORT} SELECT best.query, best.id FROM best JOIN near ON best.query = near.query AND best.id = near.id")
def _(spark, sf):
    return _exact(spark, sf, 10).select("query", "id").join(_short(spark, sf).select("query", "id"), ["query", "id"])


@query(
    "ann_compare_latency",
    """WITH s AS (SELECT user_id, avg(value) FILTER (WHERE event_type = 'view') AS b, avg(value) FILTER (WHERE event_type = 'click') AS a FROM events GROUP BY 1)
    SELECT user_id, round((b - a) / b * 100, 6) AS reduction_pct, round((b - a) / a * 100, 6) AS increase_pct, round(b / a, 6) AS times_faster FROM s WHERE a > 0 AND b > 0""",
)
def _(spark, sf):
    # The mean values of two kinds of event stand for the two measured times.
    means = t.table(spark, sf, "events").groupBy("user_id").agg(
        F.avg(F.when(F.col("event_type") == "view", F.col("value"))).alias("exact"),
        F.avg(F.when(F.col("event_type") == "click", F.col("value"))).alias("approx"),
    )
    compared = neighbors.compare_latency(means.where("exact > 0 AND approx > 0"), "exact", "approx")
    return compared.select("user_id", *[F.round(c, 6).alias(c) for c in ("reduction_pct", "increase_pct", "times_faster")])


def _with_true(spark, sf):
    """Each vector as a query whose true candidate is the first vector of its label."""
    rows = vectors(spark, sf)
    firsts = rows.groupBy("label").agg(F.min("id").alias("true_id"))
    return rows.join(firsts, "label").select(F.col("id").alias("query"), "embedding", "true_id")


TRUE = f"""firsts AS (SELECT label, min(vec_id) AS true_id FROM embeddings GROUP BY 1),
asked AS (SELECT e.vec_id AS query, e.embedding, f.true_id, {sql_dot('e.embedding', 'r.embedding')} AS true_score
  FROM embeddings e JOIN firsts f ON e.label = f.label JOIN embeddings r ON r.vec_id = f.true_id)"""


@query(
    "eval_factorized_topk",
    f"""WITH {TRUE}, b AS (
      SELECT a.query, sum(CASE WHEN {sql_dot('a.embedding', 'c.embedding')} > a.true_score THEN 1 ELSE 0 END) AS better FROM asked a, embeddings c GROUP BY 1)
    SELECT CAST(count(*) AS BIGINT) AS n, avg(CASE WHEN better < 10 THEN 1.0::DOUBLE ELSE 0 END) AS top_10, avg(CASE WHEN better < 50 THEN 1.0::DOUBLE ELSE 0 END) AS top_50,
      avg(CASE WHEN better < 100 THEN 1.0::DOUBLE ELSE 0 END) AS top_100 FROM b""",
)
def _(spark, sf):
    return evaluate.factorized_top_k(_with_true(spark, sf), vectors(spark, sf), "true_id")


@query(
    "eval_batch_topk",
    f"""WITH {TRUE}, s AS (SELECT a.query, a.embedding, a.true_id, r.embedding AS item, {md5_sql('a.query')} % CAST(ceil((SELECT count(*) FROM embeddings) / 128.0) AS BIGINT) AS batch, a.true_score FROM asked a JOIN embeddings r ON r.vec_id = a.true_id),
    b AS (SELECT x.query, sum(CASE WHEN {sql_dot('x.embedding', 'y.item')} > x.true_score THEN 1 ELSE 0 END) AS better FROM s x JOIN s y ON x.batch = y.batch GROUP BY 1)
    SELECT CAST(count(*) AS BIGINT) AS n, avg(CASE WHEN better < 10 THEN 1.0::DOUBLE ELSE 0 END) AS top_10, avg(CASE WHEN better < 50 THEN 1.0::DOUBLE ELSE 0 END) AS top_50 FROM b""",
)
def _(spark, sf):
    items = vectors(spark, sf).select(F.col("id").alias("true_id"), F.col("embedding").alias("item_vector"))
    pairs = _with_true(spark, sf).join(items, "true_id").withColumnRenamed("embedding", "query_vector")
    batches = math.ceil(vectors(spark, sf).count() / 128)
    return evaluate.batch_top_k(pairs.withColumn("batch", hash_bin("query", batches, portable=True)), "batch")


@query("eval_rmse", "SELECT round(sqrt(avg(power(l_quantity - l_extendedprice / 1000, 2))), 6) AS rmse, CAST(count(*) AS BIGINT) AS n FROM lineitem")
def _(spark, sf):
    scored = t.table(spark, sf, "lineitem").select("l_quantity", (F.col("l_extendedprice") / 1000).alias("p"))
    return evaluate.rmse(scored, "l_quantity", "p").withColumn("rmse", F.round("rmse", 6))


@query(
    "eval_listwise",
    """WITH d AS (SELECT user_id, event_id, value, CASE event_type WHEN 'purchase' THEN 3 WHEN 'signup' THEN 2 WHEN 'click' THEN 1 ELSE 0 END AS rel FROM events),
    r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS a, row_number() OVER (PARTITION BY user_id ORDER BY rel DESC, event_id) AS b FROM d),
    g AS (SELECT user_id, sum(CASE WHEN a <= 10 THEN rel / log2(a + 1) ELSE 0 END) AS dcg, sum(CASE WHEN b <= 10 THEN rel / log2(b + 1) ELSE 0 END) AS ideal FROM r GROUP BY 1)
    SELECT user_id, round(dcg, 6) AS dcg, round(ideal, 6) AS ideal, round(CASE WHEN ideal > 0 THEN dcg / ideal ELSE 0 END, 6) AS ndcg FROM g""",
)
def _(spark, sf):
    kind = F.col("event_type")
    rel = F.when(kind == "purchase", 3).when(kind == "signup", 2).when(kind == "click", 1).otherwise(0)
    rows = t.table(spark, sf, "events").select("user_id", "event_id", "value", rel.alias("rel"))
    out = evaluate.ndcg(rows, "user_id", "value", "rel", "event_id")
    return out.select("user_id", *[F.round(c, 6).alias(c) for c in ("dcg", "ideal", "ndcg")])


RELEVANCE = "CASE event_type WHEN 'purchase' THEN 3 WHEN 'signup' THEN 2 WHEN 'click' THEN 1 ELSE 0 END"


@query(
    "listwise_loss",
    f"""WITH d AS (SELECT user_id, event_id, value / 100.0::DOUBLE AS s, {RELEVANCE} AS rel FROM events),
    z AS (SELECT user_id, s, sum(exp(s)) OVER (PARTITION BY user_id ORDER BY rel, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS z FROM d)
    SELECT user_id, CAST(count(*) AS BIGINT) AS n, round(sum(ln(z) - s), 6) AS loss FROM z GROUP BY 1""",
)
def _(spark, sf):
    rows = t.table(spark, sf, "events").select("user_id", "event_id", (F.col("value") / 100.0).alias("s"), F.expr(RELEVANCE).alias("rel"))
    out = listwise.listwise_loss(listwise.relevance_lists(rows, "user_id", "rel", "event_id"), F.col("s"))
    return out.select("user_id", "n", F.round("loss", 6).alias("loss"))


@query("train_listwise")
def _(spark, sf):
    # Held-out users: NDCG@10 of the order learnt from whole lists, and of a regression of the relevance.
    rows = t.table(spark, sf, "events").select(
        "user_id", "event_id", F.expr(RELEVANCE).alias("rel"), F.expr(RELEVANCE).cast("double").alias("label"), "value",
        F.hour("ts").cast("double").alias("hour"), F.coalesce(F.get_json_object("props", "$.k").cast("double"), F.lit(0.0)).alias("k"),
    )
    features = ["value", "hour", "k"]
    train, valid = split_by_mod(stash(rows, "events"), "user_id", 10)
    model, _ = listwise.fit_listwise(train, "user_id", "rel", "event_id", features, rounds=6)
    pointwise = retrieval.fit_ranker(train, features, iterations=3, depth=3)
    scored = [("listwise", valid.withColumn("prediction", model.score())), ("pointwise", retrieval.with_predictions(pointwise, valid))]
    out = []
    for name, held in scored:
        found = evaluate.ndcg(held, "user_id", "prediction", "rel", "event_id")
        out.append(found.agg(F.count(F.lit(1)).alias("n"), F.avg("ndcg").alias("ndcg")).withColumn("model", F.lit(name)))
    return out[0].unionByName(out[1]).select("model", "n", "ndcg")


@query(
    "score_candidates",
    f"""WITH d AS (SELECT vec_id AS id, j, round(sum(embedding[i + 1]::DOUBLE * ((i * (j + 1)) % 7 - 3)), 6) AS x FROM embeddings, range(0, {DIM}) r(i), range(0, 16) q(j) GROUP BY 1, 2)
    SELECT id, string_agg(CAST(CAST(round(x * 1e6) AS BIGINT) AS VARCHAR), ',' ORDER BY j) AS embedding FROM d GROUP BY 1""",
)
def _(spark, sf):
    rows, cols = np.arange(DIM)[:, None], np.arange(16)[None, :]
    model = retrieval.projection((rows * (cols + 1)) % 7 - 3.0)
    scored = retrieval.score(vectors(spark, sf), model, "id", "embedding", DIM, double=True)
    return scored.where(~V.has_nan("embedding")).select("id", t.micro_text(F.transform("embedding", lambda x: F.round(x, 6))).alias("embedding"))


def _item_vectors(spark, sf):
    return vectors(spark, sf).select("id", F.col("embedding").cast("array<double>").alias("embedding"))


LAST = f"""{ITEMS}, known AS (SELECT i.* FROM items i JOIN embeddings e ON i.track_id = e.vec_id),
tail AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY pos DESC) AS back FROM known) WHERE back <= 5),
dims AS (SELECT pid, i, avg(embedding[i]::DOUBLE) AS m FROM tail JOIN embeddings ON track_id = vec_id, range(1, {DIM} + 1) r(i) GROUP BY 1, 2),
asked AS (SELECT pid, list(m ORDER BY i) AS v FROM dims GROUP BY 1)"""


@query("score_queries", f"WITH {LAST} SELECT pid AS query, {t.sql_micro('v')} AS embedding FROM asked")
def _(spark, sf):
    scored = retrieval.score_lists(t.items(spark, sf), _item_vectors(spark, sf), "pid", "pos", "track_id")
    return scored.select("query", t.micro_text("embedding").alias("embedding"))


RECOMMENDED = f"""WITH {LAST}, s AS (SELECT pid, vec_id AS id, {sql_dot('v', 'embedding')} AS score FROM asked, embeddings),
    r AS (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY score DESC, id) AS rank FROM s)
    SELECT c_name AS playlist_name, CAST(rank AS INTEGER) AS rank, p_name AS track_name, p_brand AS album_name, id AS track_id, score AS neighbor_distance
    FROM r JOIN part ON id = p_partkey JOIN customer ON pid = c_custkey WHERE rank <= 10"""


def _recommended(spark, sf, **how):
    catalogue = t.table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_partkey").alias("track_id"), F.col("p_name").alias("track_name"), F.col("p_brand").alias("album_name")
    )
    named = t.lists(spark, sf).select(F.col("pid").alias("query"), F.col("name").alias("playlist_name"))
    out = retrieval.recommend(t.items(spark, sf), _item_vectors(spark, sf), catalogue, named, "track_id", **how)
    return out.select("playlist_name", "rank", "track_name", "album_name", "track_id", "neighbor_distance")


@query("recommend_playlists", RECOMMENDED)
def _(spark, sf):
    return _recommended(spark, sf)


@query("recommend_playlists_all_leaves", RECOMMENDED)
def _(spark, sf):
    return _recommended(spark, sf, leaf_size=25, share=1.0)


@query("recommend_playlists_index")
def _(spark, sf):
    return _recommended(spark, sf, leaf_size=25)


@query(
    "train_retrieval",
    """WITH pairs AS (SELECT o_custkey AS pid, l_partkey AS track_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT 'list' AS side, count(DISTINCT pid) AS n, 8 AS dims FROM pairs UNION ALL SELECT 'item', count(DISTINCT track_id), 8 FROM pairs""",
)
def _(spark, sf):
    rows = t.raw_items(spark, sf).select("pid", "track_id")
    asked, items = retrieval.fit_retrieval(rows, "pid", "track_id", rank=8, iterations=3)
    both = asked.withColumn("side", F.lit("list")).unionByName(items.withColumn("side", F.lit("item")))
    return both.groupBy("side").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("dims"))


@query(
    "cooccurrence_pmi",
    f"""WITH {ITEMS}, c AS (SELECT a.track_id AS a, b.track_id AS b, count(*)::DOUBLE AS n FROM items a JOIN items b
      ON a.pid = b.pid AND a.pos <> b.pos AND abs(a.pos - b.pos) <= {lists.N} AND a.track_id <> b.track_id GROUP BY 1, 2),
    m AS (SELECT a, sum(n) AS n FROM c GROUP BY 1), t AS (SELECT sum(n) AS n FROM m),
    x AS (SELECT c.a, c.b, ln(c.n * t.n / (p.n * q.n)) AS x FROM c JOIN m p ON c.a = p.a JOIN m q ON c.b = q.a, t)
    SELECT a, b, round(x, 6) AS x FROM x WHERE x > 0""",
)
def _(spark, sf):
    counts = factors.cooccurrence(t.items(spark, sf), "pid", "pos", "track_id", lists.N)
    return factors.positive_pmi(counts).select("a", "b", F.round("x", 6).alias("x"))


def _held_out(spark, sf):
    """(items of lists to learn from, items of the other lists without their last one, that last one as the truth)."""
    items = stash(t.items(spark, sf), "items")
    ends = items.groupBy("pid").agg(F.max("pos").alias("end")).where("end > 0")
    asked = items.where("pid % 10 = 0").join(ends, "pid")
    truth = asked.where("pos = end").select(F.col("pid").alias("query"), F.col("track_id").alias("true_id"))
    return items.where("pid % 10 <> 0"), asked.where("pos < end").drop("end"), truth


KS = (10, 50, 100)


def _scored(method, items_vectors, kept, truth):
    asked = retrieval.score_lists(kept, items_vectors, "pid", "pos", "track_id").join(truth, "query")
    return evaluate.factorized_top_k(asked, items_vectors, "true_id", KS).withColumn("method", F.lit(method))


@query("train_item_vectors")
def _(spark, sf):
    # Held-out lists: how often their last item is among the best of the catalogue, for two learners and by popularity.
    train, kept, truth = _held_out(spark, sf)
    pmi = stash(factors.item_vectors(train, "pid", "pos", "track_id", rank=16, rounds=2), "pmi-vectors")
    _, als = retrieval.fit_retrieval(train, "pid", "track_id", rank=16, iterations=5)
    als = stash(als.select("id", F.col("embedding").cast("array<double>").alias("embedding")), "als-vectors")
    base = factors.popularity(train, "track_id", truth, "true_id", KS).withColumn("method", F.lit("popularity"))
    out = [_scored("pmi", pmi, kept, truth), _scored("als", als, kept, truth), base]
    return reduce(DataFrame.unionByName, out).select("method", "n", *[f"top_{k}" for k in KS])


def _part_features(spark, sf):
    """(id, features) of every part: size, price and a flag for each brand."""
    brand = F.right("p_brand", F.lit(1)).try_cast("int")
    flags = [F.when(brand == i, 1.0).otherwise(0.0) for i in range(1, 6)]
    return t.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.array(F.col("p_size") / 50.0, F.col("p_retailprice") / 2000.0, *flags).alias("features"))


@query(
    "feature_gram",
    """WITH f AS (SELECT p_partkey, list_concat([p_size / 50.0::DOUBLE, p_retailprice / 2000.0::DOUBLE],
        list_transform(range(1, 6), lambda i: CASE WHEN TRY_CAST(right(p_brand, 1) AS INTEGER) = i THEN 1.0::DOUBLE ELSE 0 END), [1.0::DOUBLE]) AS x FROM part),
    r AS (SELECT x, embedding AS y FROM f JOIN embeddings ON p_partkey = vec_id)
    SELECT 'xx' AS side, i, j, round(sum(x[i + 1] * x[j + 1]), 6) AS total FROM r, range(0, 8) a(i), range(0, 8) b(j) GROUP BY ALL
    UNION ALL SELECT 'xy', i, j, round(sum(x[i + 1] * y[j + 1]::DOUBLE), 6) FROM r, range(0, 8) a(i), range(0, 64) b(j) GROUP BY ALL""",
)
def _(spark, sf):
    rows = _part_features(spark, sf).join(_item_vectors(spark, sf), "id")
    return factors.gram_sums(rows, "features", "embedding").select("side", "i", "j", F.round("total", 6).alias("total"))


@query("unseen_item_vectors")
def _(spark, sf):
    # One item in five is taken out of all lists; its vector comes from its features alone.
    train, kept, truth = _held_out(spark, sf)
    seen = F.col("track_id") % 5 != 0
    learnt = stash(factors.item_vectors(train.where(seen), "pid", "pos", "track_id", rank=16, rounds=2), "pmi-vectors")
    described = _part_features(spark, sf)
    ridge = factors.fit_ridge(described.join(learnt, "id"), "features", "embedding")
    unseen = ridge.vectors(described.where("id % 5 = 0"), "id", "features")
    both = stash(learnt.unionByName(unseen), "both-vectors")
    wanted = truth.where("true_id % 5 = 0")
    asked = retrieval.score_lists(kept.where(seen), learnt, "pid", "pos", "track_id").join(wanted, "query")
    out = evaluate.factorized_top_k(asked, both, "true_id", KS).withColumn("method", F.lit("features"))
    base = factors.popularity(train.where(seen), "track_id", wanted, "true_id", KS).withColumn("method", F.lit("popularity"))
    return out.unionByName(base).select("method", "n", *[f"top_{k}" for k in KS])


def _rank_rows(spark, sf):
    """One row per (sample, history item): numeric features of both and the distance between them."""
    samples = lists.rank_examples(spark, sf)
    pairs = F.arrays_zip("candidate_rank", "track_energy_pl", "track_tempo_pl", "duration_ms_songs_pl")
    rows = samples.select("pid", "pos", "track_energy_can", "track_tempo_can", "duration_ms_can", "num_pl_songs_new", F.inline(pairs))
    return rows.withColumnRenamed("candidate_rank", "label")


RANK_FEATURES = ["track_energy_can", "track_tempo_can", "duration_ms_can", "num_pl_songs_new", "track_energy_pl", "track_tempo_pl", "duration_ms_songs_pl"]


@query(
    "rank_label_rows",
    f"""WITH {TRACKS}, p AS (SELECT a.pid, a.pos, a.pos - b.pos AS label, count(*) OVER (PARTITION BY a.pid, a.pos) AS n
      FROM tracks a JOIN tracks b ON a.pid = b.pid AND b.pos < a.pos AND b.pos >= a.pos - {lists.N})
    SELECT pid, pos, CAST(label AS DOUBLE) AS label FROM p WHERE n = {lists.N}""",
)
def _(spark, sf):
    return label_rows(lists.rank_examples(spark, sf), ["pid", "pos"]).select("pid", "pos", "label")


@query("train_ranker")
def _(spark, sf):
    rows = _rank_rows(spark, sf)
    train, valid = split_by_mod(rows, "pid")
    model = retrieval.fit_ranker(train, RANK_FEATURES, iterations=3, depth=3)
    scored = retrieval.with_predictions(model, valid)
    return evaluate.rmse(scored, "label", "prediction")


@query("cross_features")
def _(spark, sf):
    rows = t.table(spark, sf, "lineitem").select(
        "l_discount", "l_tax", (F.col("l_quantity") / 50).alias("q"), (F.col("l_extendedprice") / 100_000).alias("label")
    )
    model = retrieval.fit_ranker(rows, ["l_discount", "l_tax", "q"], iterations=5, crosses=True)
    return evaluate.rmse(retrieval.with_predictions(model, rows), "label", "prediction")
