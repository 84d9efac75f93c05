"""What lies on disk while a query runs: no table is copied for each part of another."""

import numpy as np


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stashed(monkeypatch, module):
    """(name, frame) of what a module writes from here on."""
    seen, stash = [], module.stash
    monkeypatch.setattr(module, "stash", lambda df, name: seen.append((name, df)) or stash(df, name))
    return seen


def test_blocks_that_all_meet_are_not_copied(spark, monkeypatch):
    from segue.llm import grid_order

    x = np.random.default_rng(4).normal(size=(300, 6)).astype(np.float32)
    x[290:] = x[:10]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>")
    unit = x / np.linalg.norm(x.astype(float), axis=1)[:, None]
    near = unit @ unit.T >= 0.9
    rows = {}
    for copies in (0, 1 << 30):
        seen = stashed(monkeypatch, grid_order)
        monkeypatch.setattr(grid_order, "COPIES", copies)
        rows[copies] = sorted(map(tuple, grid_order.link_embeddings(df, block=16).collect()))
        [found] = [f for name, f in seen if name == "found"]
        assert ("Exchange" in plan(found)) == (copies > 0)
    assert rows[0] == rows[1 << 30]
    assert [(r[0], r[1]) for r in rows[0]] == [(i, int(near[i].sum()) - 1) for i in range(300)]


def test_visited_leaves_are_not_listed(spark, monkeypatch):
    from segue.operators import neighbors, tree_index

    x = np.random.default_rng(6).integers(-3, 4, (400, 6)).astype(np.float32)  # many ties
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, embedding array<float>")
    asked = df.withColumnRenamed("id", "query")
    index = tree_index.build(df, leaf_size=5, fan=4, parts=3, skip_self=True)
    seen = stashed(monkeypatch, tree_index)
    found = tree_index.search(index, asked, 4, share=1.0, skip_self=True)
    exact = neighbors.knn(asked, df, 4, skip_self=True).select(*found.columns)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, exact.collect()))
    leaves = index.nodes.where("leaf").count()
    assert leaves > 50 and seen and sum(f.count() for _, f in seen) < 400 * leaves / 4


def test_matrix_entries_move_once_and_vectors_by_row(spark, monkeypatch):
    from segue.operators import factors

    rng = np.random.default_rng(8)
    dense = rng.integers(0, 3, (40, 40)) * rng.integers(0, 2, (40, 40))
    dense = dense + dense.T
    dense[0], dense[:, 0] = 3, 3  # an item that stands beside all
    rows = [(i, j, int(dense[i, j])) for i in range(40) for j in range(40) if dense[i, j]]
    counts = spark.createDataFrame(rows, "a bigint, b bigint, n bigint")
    seen = stashed(monkeypatch, factors)
    monkeypatch.setattr(factors, "ENTRIES", 50)
    monkeypatch.setattr(factors, "MARGINS", 7)
    monkeypatch.setattr(factors, "VECTORS", 7)
    found = factors.positive_pmi(counts)
    assert "Exchange" not in plan(found) and {name for name, _ in seen} == {"counts", "margins", "blocks"}
    margin = dense.sum(0)
    x = np.log(np.where(dense > 0, dense, 1e-9) * dense.sum() / margin / margin[:, None])
    wanted = {(i, j): x[i, j] for i, j, _ in rows if x[i, j] > 0}
    got = {(r.a, r.b): r.x for r in found.collect()}
    assert got.keys() == wanted.keys() and all(abs(got[k] - wanted[k]) < 1e-9 for k in wanted)
    vectors, sizes = factors.symmetric_svd(found, 4, rounds=8)
    assert np.allclose(sizes, np.linalg.svd(np.where(x > 0, x, 0))[1][:4], rtol=1e-3) and vectors.count() == len({a for a, _ in wanted})
    products = [plan(f) for name, f in seen if name == "product"]
    assert len(products) == 10 and all("Join" not in p.replace("shuffle_replicate_nl", "") for p in products)


def test_far_scores_are_told_in_single_precision():
    from segue.operators import neighbors

    rng = np.random.default_rng(9)
    x = rng.normal(size=(4000, 16))
    x[:300], x[300:320] = x[0], x[0] * (1 + 1e-9 * np.arange(20))[:, None]  # ties, and scores that only double precision tells apart
    q = np.concatenate([rng.normal(size=(40, 16)), np.zeros((1, 16)), x[:1] * 1e20, x[:1] * np.inf])
    q[-1, 1:] = 1
    ids, asked = rng.permutation(4000), np.arange(43)
    with np.errstate(all="ignore"):
        top = neighbors.TopK(asked, q, 7)
        for i in range(0, 4000, 900):
            top.add(ids[i : i + 900], x[i : i + 900], True)
        scores = np.round(q @ x.T, neighbors.DIGITS)
        scores[asked[:, None] == ids[None, :]] = -np.inf
        rows, cols = neighbors._best(scores, ids, 7)
        exact = neighbors._near_best(q[:40], x.astype(np.float32), 10.0, 7, np.full(40, -np.inf), (asked[:0], asked[:0]))
    assert [*zip(top.row.tolist(), top.id.tolist(), top.score.tolist())] == [*zip(rows.tolist(), ids[cols].tolist(), scores[rows, cols].tolist())]
    assert exact is None or len(exact[0]) < 40 * 400
