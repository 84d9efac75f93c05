"""Features and list columns that come to cut lists must give what a plain loop gives, and wide rows must not be written."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from segue.operators import enrich, neighbors, tree_index
from segue.operators import sequence as S
from segue.plans import lists as plans


@pytest.mark.parametrize("pieces", [1, 11])
def test_attached_features_and_list_columns_match_a_loop(spark, pieces):
    rows = [(pid, at, f"t{at % 7}") for pid in (1, 2, None) for at in range(30)]
    df = spark.createDataFrame(rows, "pid bigint, at bigint, track string")
    # t0 has no features, t1 has two equal rows; list 2 has two names, the NULL list has none
    features = spark.createDataFrame([(f"t{i}", f"a{i % 3}") for i in (1, 1, 2, 3, 4, 5, 6)], "track string, artist string")
    named = spark.createDataFrame([(1, "one"), (2, "two"), (2, "zwei"), (3, "no items"), (None, "nobody")], "pid bigint, name string")
    lists = S.attach(S.cut_lists(df, "pid", ["at"], pieces=pieces), lambda r: r.join(features, "track"))
    out = S.fan_out(lists, {"before": "track"}, 3, sums={"total": "at"}, distincts={"artists": "artist"}, count="n", of_list=named)
    expected = Counter()
    for pid, names in ((1, ["one"]), (2, ["two", "zwei"])):
        held = [(at, f"t{at % 7}") for at in range(30) for _ in range((0, 2, 1, 1, 1, 1, 1)[at % 7])]
        for pos, (at, track) in enumerate(held):
            earlier = held[:pos]
            artists = len({int(x[1:]) % 3 for _, x in earlier})
            for name in names:
                expected[pid, pos, track, tuple(x for _, x in earlier[-3:]), float(sum(a for a, _ in earlier)), float(artists), float(pos), name] += 1
    found = Counter((r.pid, r.pos, r.track, tuple(r.before), r.total, r.artists, r.n, r.name) for r in out.collect())
    assert found == expected


def test_examples_are_cut_with_their_keys_alone(spark, sf):
    lists = plans.example_lists(spark, sf)
    assert set(lists.cut.columns) == {"pid", "track_id", "artist_id", "duration", S.PIECE, S.AT}
    labels = plans.rank_examples(spark, sf).select("pid", "candidate_rank")
    plan = labels._jdf.queryExecution().optimizedPlan().toString()
    assert "track_tempo_pl" not in plan and "_h_track_name_pl" not in plan  # histories that are not used are not made


def test_later_items_are_distinct_before_they_meet_their_features(spark, sf):
    items = plans._later_items(spark, sf)
    assert items.count() == items.distinct().count()
    found = plans.example_candidates(spark, sf)
    assert found.count() == found.distinct().count() > 0


def test_equal_features_come_once_though_written_differently(spark):
    features = spark.createDataFrame([("t", "", None), ("t", "NONE", 0.0)], "track_uri string, track_name string, track_pop double")
    assert enrich.distinct_rows(enrich.clean_values(features)).collect() == [("t", "NONE", 0.0)]
    samples = spark.createDataFrame([("t", "x"), ("t", "x")], "key string, name string")
    audio = spark.createDataFrame([("t", None), ("t", 0.0)], "key string, tempo double")
    assert enrich.distinct_candidates(samples, audio, "key", ["key", "name"], {"tempo": 0.0}).collect() == [("t", "x", 0.0)]


@pytest.mark.parametrize("n", [1, 3])
def test_near_pairs_match_a_loop_over_stretches(spark, n):
    places = [p for p in range(3 * S.STRETCH * n + 2) if p % 7 != 3]
    rows = [(pid, p, f"t{p}") for pid in (1, None) for p in places] + [(1, 0, "twice"), (1, None, "nowhere")]
    df = spark.createDataFrame(rows, "pid bigint, pos bigint, track string")
    found = S.near_pairs(df, "pid", "pos", n, ["track"], {"earlier": "track"})
    plan = found._jdf.queryExecution().executedPlan().toString()  # before it runs
    assert plan.count("Exchange") == 1 and "Join" not in plan
    held = [(p, t) for pid, p, t in rows if pid == 1 and p is not None]
    expected = Counter((1, p, t, q, u) for p, t in held for q, u in held if p - n <= q < p)
    assert found.columns == ["pid", "pos", "track", "pos_pl", "earlier"] and Counter(map(tuple, found.collect())) == expected


def test_what_a_search_of_the_tree_writes_has_no_vectors(spark):
    rng = np.random.default_rng(1)
    rows = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(300)], "id bigint, embedding array<double>")
    index = tree_index.build(rows, leaf_size=10, skip_self=True)
    asked = rows.select(F.col("id").alias("query"), F.col("embedding").alias("vector"))
    levels = tree_index.ordered_nodes(index, asked, 2.0)
    assert all(set(level.columns) >= {"query", "node", "before"} and "vector" not in level.columns for level in levels)
    leaves = index.nodes.where("leaf").count()
    assert levels[-1].count() == 300 * leaves
    found = tree_index.search(index, rows.withColumnRenamed("id", "query"), 5, share=1.0, skip_self=True)
    exact = neighbors.knn(rows.withColumnRenamed("id", "query"), rows, 5, skip_self=True)
    pick = lambda df: sorted(map(tuple, df.select("query", "id", "rank").collect()))
    assert pick(found) == pick(exact)
