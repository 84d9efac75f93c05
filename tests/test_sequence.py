"""List scans: any number of pieces must give what a plain loop gives."""

import random

import pytest
from pyspark.sql import functions as F

from segue.operators import sampling, skew
from segue.operators import sequence as S


def make_items(spark, gaps=True, seed=1):
    rng = random.Random(seed)
    rows = []
    for pid, length in ((1, 1), (2, 5), (3, 6), (4, 40), (5, 200)):
        for pos in range(length):
            if gaps and pid == 4 and pos in (3, 17):
                continue
            artist = None if rng.random() < 0.1 else f"a{rng.randrange(8)}"
            rows.append((pid, pos, f"t{rng.randrange(30)}", artist, f"b{rng.randrange(5)}", float(rng.randrange(100))))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "pid bigint, pos bigint, track string, artist string, album string, ms double"), rows


def rows_of(df, *columns):
    return sorted(tuple(map(repr, r)) for r in df.select(*columns).collect())


@pytest.mark.parametrize("pieces", [1, 7, 40])
def test_history_matches_a_loop(spark, pieces):
    df, rows = make_items(spark)
    out = S.fan_out(S.cut_lists(df, "pid", ["pos"], pieces=pieces), {"track_pl": "track"}, 5, "rank")
    expected = {}
    for pid, pos, *_ in rows:
        before = sorted((q, t) for p, q, t, *_ in rows if p == pid and pos - 5 <= q < pos)
        expected[pid, pos] = ([t for _, t in before], [float(pos - q) for q, _ in before])
    found = {(r.pid, r.pos): (r.track_pl, r.rank) for r in out.collect()}
    assert found == expected and out.columns == [*df.columns, "track_pl", "rank"]


@pytest.mark.parametrize("pieces", [1, 7, 40])
def test_prefix_aggregates_match_a_loop(spark, pieces):
    df, rows = make_items(spark)
    lists = S.cut_lists(df, "pid", ["pos"], pieces=pieces)
    out = S.fan_out(lists, sums={"total": "ms"}, distincts={"artists": "artist", "albums": "album"}, count="n")
    found = {(r.pid, r.pos): (r.total, r.n, r.artists, r.albums) for r in out.collect()}
    assert found == prefixes(rows)


def prefixes(rows):
    expected = {}
    for pid, pos, *_ in rows:
        before = [r for r in rows if r[0] == pid and r[1] < pos]
        artists = {r[3] for r in before if r[3] is not None}
        expected[pid, pos] = (sum(r[5] for r in before), len(before), len(artists), len({r[4] for r in before}))
    return expected


@pytest.mark.parametrize("pieces", [1, 9, 60])
def test_positions_are_dense_and_ordered(spark, pieces):
    df, rows = make_items(spark, gaps=False)
    shuffled = df.withColumnRenamed("pos", "at").withColumn("day", F.floor(F.col("at") / 10))
    out = S.fan_out(S.cut_lists(shuffled, "pid", ["day", "at"], pieces=pieces))
    assert out.where("pos <> at").count() == 0 and out.count() == len(rows)


def test_one_path_for_a_third_of_all_rows_and_null_lists(spark):
    """A list with a third of the rows, a NULL list as long, and short ones; counted positions, all results at once."""
    rng = random.Random(5)
    lengths = {None: 400, 7: 400, **{p: rng.randrange(1, 12) for p in range(100, 160)}}
    rows = [(p, i, f"t{rng.randrange(50)}", rng.choice([None, "a", "b", "c", f"x{i}"]), f"b{rng.randrange(9)}", float(rng.randrange(9))) for p, n in lengths.items() for i in range(n)]
    expected = prefixes(rows)
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "pid bigint, at bigint, track string, artist string, album string, ms double")
    lists = S.cut_lists(df, "pid", ["at"], pieces=23)
    assert lists.shared.where("pid = 7").count() == lists.shared.where("pid is null").count() == 400
    out = S.fan_out(lists, {"track_pl": "track"}, 5, "rank", {"total": "ms"}, {"artists": "artist", "albums": "album"}, "n").collect()
    assert {(r.pid, r.pos): (r.total, r.n, r.artists, r.albums) for r in out} == expected
    tracks = {(p, i): t for p, i, t, *_ in rows}
    for r in out:
        assert r.pos == r["at"] and r.track_pl == [tracks[r.pid, q] for q in range(max(0, r.pos - 5), r.pos)]
        assert r.rank == [float(d) for d in range(min(5, r.pos), 0, -1)]


def test_empty_lists_and_pieces_shorter_than_the_history(spark):
    empty = spark.createDataFrame([], "pid bigint, at bigint, track string")
    assert S.fan_out(S.cut_lists(empty, "pid", ["at"]), {"h": "track"}, count="n").count() == 0
    df = spark.createDataFrame([(1, i, f"t{i}") for i in range(30)], "pid bigint, at bigint, track string")
    out = S.fan_out(S.cut_lists(df, "pid", ["at"], pieces=15), {"h": "track"}, 5, count="n").collect()
    assert {r.pos: (r.h, r.n) for r in out} == {i: ([f"t{j}" for j in range(max(0, i - 5), i)], float(i)) for i in range(30)}


def test_samples_have_a_full_history(spark):
    df, _ = make_items(spark)
    plain, cut = (
        S.training_samples(S.cut_lists(df, "pid", ["pos"], pieces=k), {"track_pl": "track"}, {"total": "ms"}, {"artists": "artist"}) for k in (1, 30)
    )
    names = ["pid", "pos", "track_pl", "total", "artists", "n_items", "candidate_rank"]
    assert rows_of(plain, *names) == rows_of(cut, *names)
    sizes = {r.pid: r["count"] for r in plain.groupBy("pid").count().collect()}
    # five items have no full history; six items have one sample; a gap costs the five samples after it
    assert 1 not in sizes and 2 not in sizes and sizes[3] == 1 and sizes[5] == 195
    assert plain.where("exists(candidate_rank, r -> r < 1 or r > 5)").count() == 0


def test_chunks_hold_every_item(spark):
    df, rows = make_items(spark)
    nested = S.chunk_lists(df, "pid", "pos", ["track"], chunk=16)
    assert nested.where(F.size("tracks") > 16).count() == 0
    flat = S.unchunk_lists(nested)
    assert rows_of(flat, "pid", "pos", "track") == rows_of(df, "pid", "pos", "track")


def test_prefix_is_chunks_plus_own(spark):
    df, rows = make_items(spark)
    chunks = {(r.pid, r.chunk): [t.track for t in r.tracks] for r in S.chunk_lists(df, "pid", "pos", ["track"], chunk=16).collect()}
    for r in S.prefix_in_chunk(df, "pid", "pos", "track", chunk=16).collect():
        whole = [t for c in range(r.chunk) for t in chunks.get((r.pid, c), [])] + r.prefix
        assert whole == [t for q, t in sorted((x[1], x[2]) for x in rows if x[0] == r.pid and x[1] < r.pos)]


def test_near_pairs_match_the_range_join(spark):
    df, rows = make_items(spark)
    found = S.near_pairs(df, "pid", "pos", 3, ["track"], {"before": "track"})
    expected = sorted(
        (a[0], a[1], b[1]) for a in rows for b in rows if a[0] == b[0] and a[1] - 3 <= b[1] < a[1]
    )
    assert sorted((r.pid, r.pos, r.pos_pl) for r in found.collect()) == expected


def test_last_n_and_sample(spark):
    df, rows = make_items(spark)
    tails = {r.pid: r.t for r in S.last_n(df, "pid", "pos", {"t": "track"}, 5).collect()}
    for pid in (1, 2, 3, 4, 5):
        assert tails[pid] == [t for _, t in sorted((r[1], r[2]) for r in rows if r[0] == pid)][-5:]
    sampled = S.sample_per_list(df, "pid", "pos", 5).groupBy("pid").count().collect()
    assert {r.pid: r["count"] for r in sampled} == {1: 1, 2: 5, 3: 5, 4: 5, 5: 5}


def test_top_per_group_in_pieces(spark):
    df, _ = make_items(spark, gaps=False)
    order = [F.desc("ms"), F.asc("pos")]
    one = skew.top_per_group(df, ["pid"], order, 20)
    cut = skew.top_per_group(df, ["pid"], order, 20, pieces=7)
    assert rows_of(one, "pid", "pos", "rank") == rows_of(cut, "pid", "pos", "rank")


def test_hash_rank_is_a_permutation(spark):
    df = spark.range(5000).withColumnRenamed("id", "key")
    ranked = skew.hash_rank(df, "key")
    stats = ranked.agg(F.min("rank"), F.max("rank"), F.countDistinct("rank"), F.max("total")).first()
    assert tuple(stats) == (1, 5000, 5000, 5000)
    split = sampling.split_shuffled(df, "key").groupBy("split").count().collect()
    assert {r.split: r["count"] for r in split} == {"train": 4000, "valid": 1000}


def test_dense_index_in_pieces(spark):
    words = spark.createDataFrame([(f"w{i * 7919 % 3000:05d}",) for i in range(3000)] + [("",), ("é",)], "w string")
    whole = skew.dense_index(words, "w", start=3)
    ordered = sorted((r.w for r in words.collect()), key=str.encode)
    assert {r.w: r.idx for r in whole.collect()} == {w: i for i, w in enumerate(ordered, 3)}
    cut = skew.dense_index(words.repartition(5), "w", start=3)
    assert rows_of(whole, "w", "idx") == rows_of(cut, "w", "idx")


def test_sorted_lists_are_one_order_beyond_a_chunk(spark):
    rows = [(p, i, (i * 7919) % 600) for p, n in ((1, 600), (2, 3)) for i in range(n)]
    df = spark.createDataFrame(rows, "pid bigint, pos bigint, value int")
    nested = S.sorted_chunks(df, "pid", ["value", "pos"], ["value"]).orderBy("pid", "chunk").collect()
    for p in (1, 2):
        values = [x.value for r in nested if r.pid == p for x in r.tracks]
        assert values == sorted(v for q, _, v in rows if q == p)
    assert [len(r.tracks) for r in nested] == [250, 250, 100, 3]


def test_split_by_mod_is_disjoint(spark):
    df, rows = make_items(spark)
    train, valid = sampling.split_by_mod(df, "pid", 4, 0)
    assert {r.pid for r in valid.collect()} == {4} and train.count() + valid.count() == len(rows)


def test_batches(spark):
    df = spark.range(1000).withColumnRenamed("id", "key")
    out = sampling.batch_rows(df, "key", 64, 3)
    assert out.groupBy("shard", "batch").count().where("count <> 64").count() == 0
    assert sampling.batch_rows(df, "key", 64, 3, drop_remainder=False).count() == 1000
    assert sampling.repeat_epochs(df, 3).groupBy("epoch").count().where("count = 1000").count() == 3


def test_windows_need_one_shuffle(spark):
    df, _ = make_items(spark)
    lists = S.cut_lists(df, "pid", ["pos"])
    out = S.training_samples(lists, {"track_pl": "track"}, {"total": "ms"}, {"artists": "artist", "albums": "album"})
    rows = out._jdf.queryExecution().executedPlan().toString().split("Union")[0]
    assert rows.count("Exchange ") == 1 and "Join" not in rows
