"""What moves between tasks: chunks that lie by slice, texts beside a small vocabulary, flags of first places, decoded texts."""

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from segue.operators import enrich, vocab
from segue.operators import sequence as S
from segue.plans import load_queries

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_chunks_stay_where_their_slice_is(spark):
    rows = [(p, pos, f"t{p}-{pos}", p % 2, None if p == 1 else f"list {p}") for p in range(3) for pos in range(5)]
    df = spark.createDataFrame(rows, "pid bigint, pos bigint, track string, slice bigint, name string").repartition("slice")
    nested = S.chunk_lists(df, "pid", "pos", ["track"], chunk=2, keep=["slice", "name"])
    assert plan(nested).count("Exchange hashpartitioning") == 1
    got = sorted((r.pid, r.chunk, r.slice, r.name or "", [x.track for x in r.tracks]) for r in nested.collect())
    wanted = [(p, c, p % 2, "" if p == 1 else f"list {p}", [f"t{p}-{i}" for i in range(2 * c, min(2 * c + 2, 5))]) for p in range(3) for c in range(3)]
    assert got == wanted


def test_slices_write_each_list_once(spark, monkeypatch):
    seen = []
    chunk_lists = S.chunk_lists
    monkeypatch.setattr(S, "chunk_lists", lambda df, *a, **k: seen.append(df) or chunk_lists(df, *a, **k))
    load_queries()["scan_json_slices"].run(spark, SMALL)
    assert "REPARTITION_BY_COL" in plan(seen[0])  # items are dealt by slice, and no chunk moves after that


def test_ids_of_texts_without_moving_rows(spark, monkeypatch):
    rows = [(1, "a b", ["a b", None, ""]), (2, None, None), (3, "", []), (4, "c", ["b"])]
    df = spark.createDataFrame(rows, "id bigint, one string, many array<string>")
    learnt = spark.createDataFrame([("one", "a", 2), ("one", "a b", 3), ("many", "b", 2), ("other", "b", 9)], "feature string, token string, idx int")
    ids = lambda d: vocab.vectorize_text(d, ["id"], learnt, {"one": "x", "many": "y"}).select("id", "x", "y")
    found = ids(df)
    assert "Exchange" not in plan(found) and dict(found.dtypes) == {"id": "bigint", "x": "array<int>", "y": "array<array<int>>"}
    got = {r.id: (r.x, r.y) for r in found.collect()}
    assert got == {1: ([2, 1, 3], [[1, 2, 1], None, []]), 2: (None, None), 3: ([], []), 4: ([1], [[2]])}
    odd = df.unionByName(df.where("id in (1, 2)")).unionByName(df.where("id = 4").withColumn("id", F.lit(None).cast("bigint")))
    here = sorted(map(str, ids(odd).collect()))
    monkeypatch.setattr(vocab, "TASK_TOKENS", 0)
    assert "Join" in plan(ids(df)) and sorted(map(str, ids(odd).collect())) == here


def test_first_places_come_without_a_join(spark, monkeypatch):
    seen = []
    sums = S.with_prefix_aggregates
    monkeypatch.setattr(S, "with_prefix_aggregates", lambda df, *a, **k: seen.append(df) or sums(df, *a, **k))
    out = load_queries()["agg_playlist_seed_groupby"].run(spark, SMALL)
    assert "Join" not in plan(seen[0]) and seen[0].where(F.col("fa") + F.col("fb") > 2).count() == 0
    other = load_queries()["agg_playlist_seed"].run(spark, SMALL).select(*out.columns)
    assert out.exceptAll(other).count() == other.exceptAll(out).count() == 0


def test_decoded_texts_come_some_at_a_time():
    import numpy as np

    from segue.llm import bpe
    from segue.llm.queries import byte_bpe
    from segue.llm.words import encode_words

    words = [" blue", " train"]
    ids, counts = encode_words(byte_bpe(), words)
    keys, lists = pa.array(range(450)), pa.array([words] * 450, pa.list_(pa.string()))
    [docs] = bpe.chunk_rows([keys], [lists], 1, asking=False)
    [asked] = bpe.chunk_rows([keys], [lists], 1, asking=True)
    order = [words.index(w) for w in bpe.from_blob(asked["words"]).column("word").to_pylist()]
    parts = np.split(ids, np.cumsum(counts)[:-1])
    asked["words"] = bpe.to_blob(ids=pa.array([parts[i].tolist() for i in order], pa.list_(pa.uint32())))
    batches = list(bpe.put_back(iter([pa.RecordBatch.from_pylist([docs, asked], schema=bpe.PACKED)]), byte_bpe(), pa.int64()))
    assert [b.num_rows for b in batches] == [200, 200, 50]
    table = pa.Table.from_batches(batches)
    assert table.column("key").to_pylist() == list(range(450)) and set(table.column("decoded").to_pylist()) == {" blue train"}


def doubled(df, keys):
    return df.unionByName(df.where(F.col(keys).isin(1, 2)))


def odd_lists(spark, pieces):
    rows = [(p, i, None if i == 3 else (i + (p or 0)) % 6, i % 2) for p in (1, 2, None) for i in range(9)]
    df = spark.createDataFrame(rows, "pid bigint, at bigint, item bigint, maker bigint")
    return S.cut_lists(df, "pid", ["at"], pieces=pieces)


def test_placed_items_get_each_row_of_their_features_once(spark):
    items = doubled(spark.createDataFrame([(i, f"t{i}", None if i == 4 else i * 2) for i in range(5)], "item bigint, name string, x int"), "item")
    items = items.unionByName(items.where("item = 2").withColumn("name", F.lit("other")))
    makers = spark.createDataFrame([(0, "m"), (1, "n"), (1, "n"), (None, "o")], "maker bigint, maker_name string")
    numbered = {"maker": enrich.numbered_copies(makers, "maker"), "item": enrich.numbered_copies(items, "item")}
    keys = {k: d.select(k, k + enrich.COPY) for k, d in numbered.items()}
    for pieces in (1, 4):
        lists = odd_lists(spark, pieces)
        early = S.fan_out(S.attach(lists, lambda rows: enrich.enrich_items(rows, {"maker": makers, "item": items})))
        placed = S.fan_out(S.attach(lists, lambda rows: enrich.enrich_items(rows, keys)))
        late = enrich.enrich_items(placed, numbered)
        columns = ["pid", "item", "maker", "name", "x", "maker_name"]
        rows = lambda df: sorted(map(str, df.select(*columns).collect()))
        places = lambda df: sorted(map(str, df.select("pid", "pos", "item").collect()))
        assert rows(late) == rows(early) and places(late) == places(early) and late.count() > 27


def test_no_feature_lies_by_list_that_a_list_does_not_ask_for(spark, monkeypatch):
    seen = []
    fan_out = S.fan_out
    monkeypatch.setattr(S, "fan_out", lambda cut, *a, **k: seen.append(cut) or fan_out(cut, *a, **k))
    out = load_queries()["join_enrich_tracks"].run(spark, SMALL)
    assert not {"track_name", "artist_name", "artist_genres", "album_uri"} & set(seen[0].rows.columns)
    assert {"track_name_can", "artist_name_can", "artist_genres_can"} < set(out.columns)


def test_histories_are_looked_up_once_an_item(spark):
    table = doubled(spark.createDataFrame([(i, None if i == 4 else i, i / 2) for i in range(5)], "key bigint, x bigint, y double"), "key")
    table = table.unionByName(spark.createDataFrame([(2, 0, 9.0), (None, 7, 7.0)], table.schema))
    columns = {"x": 0, "y": 0.0}
    for pieces in (1, 4):
        lists = odd_lists(spark, pieces)
        found = enrich.lookup_arrays(lists, "row", "held", table, "key", columns, 3, "item")
        arrays = S.fan_out(lists, {"held": "item"}, 3).select(F.struct("pid", "pos").alias("row"), "held")
        wanted = enrich.lookup_arrays(arrays, "row", "held", table, "key", columns)
        assert found.columns == wanted.columns and found.dtypes == wanted.dtypes
        assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect())) and found.count() > 15
    assert "posexplode" not in plan(found)


def test_grams_are_counted_in_generated_code(spark):
    texts = ["a-B c\t[d]\\ a-b", "", None, " . ", "x", "x\r\n\ny z", "É e É", "A b {c}", "a\x0bb"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    counts = vocab.count_ngrams(df, ["text"], 3)
    assert "lambda" not in plan(counts)
    cut = lambda t: [w for w in re.split(r"[ \t\n\r]+", re.sub(r"""[!"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~']""", "", re.sub("[A-Z]", lambda m: m[0].lower(), t))) if w]
    wanted = Counter(" ".join(w[i : i + n]) for t in texts if t is not None for w in [cut(t)] for n in (1, 2, 3) for i in range(len(w) - n + 1))
    assert {(r.token, r.n) for r in counts.collect()} == set(wanted.items())


def test_texts_are_described_a_little_at_a_time(monkeypatch):
    import numpy as np

    from segue.llm import quality

    rng = np.random.default_rng(3)
    texts = pa.array([None, "", *(" ".join(rng.choice(["One", "two!", "3", "four."], rng.integers(1, 9_000))) for _ in range(60))])
    whole = [quality.describe(data, edges) for _, data, edges in quality.slices(texts, 1 << 30)]
    parts = [quality.describe(data, edges) for _, data, edges in quality.slices(texts, quality.READ_BYTES)]
    assert quality.READ_BYTES <= 1 << 18 and len(parts) > 2 and len(whole) == 1
    assert np.array_equal(np.concatenate([s for s, _ in parts]), whole[0][0])
    assert np.array_equal(np.concatenate([r.value for _, r in parts]), whole[0][1].value)


def test_a_chunk_is_packed_without_a_copy_of_its_words():
    from segue.llm import bpe

    n = 1_000_000
    lists = pa.ListArray.from_arrays(pa.array(range(0, n + 1, 1000), pa.int32()), pa.array([f" word {i % 100}" for i in range(n)]))
    usual, pool = pa.default_memory_pool(), pa.system_memory_pool()
    pa.set_memory_pool(pool)
    try:
        list(bpe.chunk_rows([pa.array(range(500))] * 2, [lists[:500], lists[500:]], 1, asking=True))
    finally:
        pa.set_memory_pool(usual)
    assert pool.max_memory() < 10 * n  # numbers of four bytes, twice
