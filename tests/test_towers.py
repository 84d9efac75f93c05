"""Tower inputs against plain loops, before and after the state is saved."""

import hashlib

import pytest
from pyspark.sql import functions as F

from segue.operators import vocab
from segue.operators.towers import Feature, TowerFeatures, TowerModel

FEATURES = [
    Feature("pop", "bucket", 100), Feature("pops", "bucket", 100, listed=True), Feature("uri", "hash", 97), Feature("uris", "hash", 97, listed=True),
    Feature("name", "text"), Feature("names", "text", listed=True), Feature("ms", "number"), Feature("mss", "number", listed=True),
]
ROWS = [
    (1, 0.0, [0.0, 50.0, 100.0], "a", ["a", "b"], "Blue Train", ["Blue Train", "So What!"], 1.0, [1.0, 3.0]),
    (2, 100.0, [99.9], "b", [], "blue blue", [], 2.0, []),
    (3, -1.0, [], None, [None, "a"], "", ["", "what"], None, [None, 2.0]),
    (4, None, None, "", None, None, None, 6.0, None),
    (5, 250.0, [None], "c", ["c"] * 9, "unheard of", [None, "so"], float("nan"), [5.0]),
]
SCHEMA = "id bigint, pop double, pops array<double>, uri string, uris array<string>, name string, names array<string>, ms double, mss array<double>"


def md5_number(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def signs(column, ids, dims):
    rows = [[1.0 - 2.0 * (md5_number(f"{column}-{i}") >> j & 1) for j in range(dims)] for i in ids]
    return [sum(r[j] for r in rows) / len(rows) if rows else 0.0 for j in range(dims)]


def grams(text):
    words = "".join(c for c in text.lower() if c not in "!").split()
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def mean(values):
    return sum(values) / len(values) if values else 0.0


@pytest.fixture(scope="module")
def fitted(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df, TowerFeatures(FEATURES, ["id"], dims=3, max_tokens=5).fit(df)


def expected():
    vocab = {}
    for column, texts in (("name", [r[5] for r in ROWS]), ("names", [t for r in ROWS for t in r[6] or []])):
        count = {}
        for g in (g for t in texts if t for g in grams(t)):
            count[g] = count.get(g, 0) + 1
        vocab[column] = {g: i for i, g in enumerate(sorted(count, key=lambda g: (-count[g], g))[:3], 2)}
    place = lambda v: 0 if v is None else sum(b <= v for b in [100 * i / 19 for i in range(20)]) / 20
    numbers = [x for x in (1.0, 2.0, 6.0)], [1.0, 3.0, 2.0, 5.0]
    scale = [(mean(n), mean([(x - mean(n)) ** 2 for x in n]) ** 0.5) for n in numbers]
    z = lambda v, s: 0.0 if v is None or v != v else (v - s[0]) / s[1]
    bins = lambda c, vs: signs(c, [md5_number(v or "") % 97 for v in vs], 3)
    ids = lambda c, texts: [vocab[c].get(g, 1) for t in texts if t for g in grams(t)]
    for id_, pop, pops, uri, uris, name, names, ms, mss in ROWS:
        yield id_, [
            place(pop), mean([place(p) for p in pops or []]), *bins("uri", [uri]), *bins("uris", uris or []),
            *signs("name", ids("name", [name]), 3), *signs("names", ids("names", names or []), 3), z(ms, scale[0]), mean([z(v, scale[1]) for v in mss or []]),
        ]


def test_vectors_as_by_loops(fitted):
    df, model = fitted
    out = model.transform(df)
    got = {r.id: r.features for r in out.collect()}
    assert out.columns == [*df.columns, "features"] and model.width == 16
    for id_, values in expected():
        assert got[id_] == pytest.approx(values), id_


def test_state_is_kept(fitted, spark, tmp_path):
    df, model = fitted
    model.save(str(tmp_path / "tower"))
    again = TowerModel.load(spark, str(tmp_path / "tower"))
    rows = lambda m, d: sorted((r.id, tuple(r.features)) for r in m.transform(d).collect())
    assert rows(again, df) == rows(model, df)
    # other rows meet what was learnt, not their own statistics
    few = df.where("id = 5")
    assert rows(again, few) == [r for r in rows(model, df) if r[0] == 5]
    assert again.transform(df.where("false")).count() == 0


def test_wrong_features_are_refused(spark):
    with pytest.raises(ValueError):
        Feature("x", "buckets")
    with pytest.raises(ValueError):
        TowerFeatures([], ["id"], dims=61)
    empty = spark.createDataFrame([], SCHEMA)
    model = TowerFeatures(FEATURES, ["id"]).fit(empty)
    assert model.transform(spark.createDataFrame(ROWS, SCHEMA)).where(F.size("features") == model.width).count() == 5


def test_rows_do_not_move(fitted, spark, monkeypatch):
    df, model = fitted
    vectors = lambda d: sorted((r.id, tuple(r.features)) for r in d.collect())
    plan = model.transform(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    odd = df.unionByName(df.where("id < 3")).unionByName(df.where("id = 3").withColumn("id", F.lit(None).cast("bigint")))
    here, some = vectors(model.transform(df)), sorted(map(str, model.transform(odd).collect()))
    monkeypatch.setattr(vocab, "TASK_TOKENS", 0)  # a vocabulary too large for the tasks is joined
    joined = model.transform(df)
    assert "Join" in joined._jdf.queryExecution().executedPlan().toString()
    assert vectors(joined) == here and sorted(map(str, model.transform(odd).collect())) == some
