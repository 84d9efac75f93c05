"""Grid order join, Hamming search, quality classifier and pipeline against brute force."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from segue.llm import quality
from segue.llm.grid_order import link_embeddings
from segue.llm.hamming_search import hamming_top_k, sign_code

VECTORS = "vec_id bigint, embedding array<float>, key string, u string, row string"


def links(vectors, bound):
    x = np.array(vectors, float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= bound
    np.fill_diagonal(near, False)
    return near


def test_grid_order_as_by_loops(spark):
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(9, 16))
    data = np.concatenate([c + rng.normal(size=(n, 16)) * s for c, n, s in zip(centers, [200, 5, 30, 40, 20, 1, 2, 60, 90], [0.1, 0.5, 0.4, 0.01, 1, 1, 1, 0.35, 0.45])])
    data = np.concatenate([data, data[:3], 5 * data[4:6], -data[:2]]).astype(np.float32)
    ids = rng.permutation(len(data)).tolist()
    ids[10], ids[11] = ids[12], None
    odd = [None, [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [], [1.0, 2.0]]
    rows = [(i, v.tolist(), "k", "u", "r") for i, v in zip(ids, data)] + [(1000 + i, v, "k", "u", "r") for i, v in enumerate(odd)]
    near = links(data, 0.9)
    group = np.arange(len(data))
    while True:
        new = np.minimum(group, np.where(near, group[None, :], len(data)).min(1))
        if (new == group).all():
            break
        group = new
    least = {g: min((ids[i] for i in range(len(data)) if group[i] == g and ids[i] is not None), default=None) for g in set(group.tolist())}
    expected = [(ids[i], int(near[i].sum()), least[int(group[i])], ids[i] == least[int(group[i])]) for i in range(len(data))]
    expected += [(1000 + i, 0, 1000 + i, True) for i in range(len(odd))]
    for block in (2048, 32):
        got = [tuple(r) for r in link_embeddings(spark.createDataFrame(rows, VECTORS), block=block).collect()]
        assert sorted(map(str, got)) == sorted(map(str, expected))
    assert link_embeddings(spark.createDataFrame([], VECTORS)).count() == 0
    assert link_embeddings(spark.createDataFrame(rows[len(data) : len(data) + 2], VECTORS)).count() == 2
    with pytest.raises(ValueError):
        link_embeddings(spark.createDataFrame(rows, VECTORS), cosine=0.0)


def test_hamming_as_by_loops(spark):
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    codes[:120] = codes[0]
    for i in range(60, 120):
        codes[i] ^= np.uint64(1) << np.uint64(i % 64)
    rows = [(int(i), int(c)) for i, c in enumerate(codes.view(np.int64))] + [(5, int(codes.view(np.int64)[5])), (None, 3), (7, None), (8, 77)]
    frame = spark.createDataFrame([(i, c, "s", "v") for i, c in rows], "id bigint, code bigint, segment string, value string")
    clean = sorted({(i, c) for i, c in rows if i is not None and c is not None})
    for k, split in ((4, 50_000), (10, 20)):
        got = sorted(tuple(r) for r in hamming_top_k(frame, frame.where("id % 50 = 0 or id = 8"), k=k, split_rows=split).collect())
        expected = []
        for q, code in clean:
            if q % 50 and q != 8:
                continue
            best = sorted({((code ^ c).__and__((1 << 64) - 1).bit_count(), i) for i, c in clean if i != q})[:k]
            expected += [(q, r, i, d) for r, (d, i) in enumerate(best, 1)]
        assert got == sorted(expected)
    few = frame.where("id in (0, 1, 2)")
    assert hamming_top_k(few, few, k=10).count() == 6
    assert hamming_top_k(frame.where("false"), frame.where("false")).count() == 0


def test_hamming_of_ids_with_many_codes(spark):
    """An id's own codes, near each other, must not push its neighbours out."""
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 62, 21).astype(np.int64)
    rows = [(0, int(base[0]) ^ (1 << j)) for j in range(8)] + [(i, int(base[0]) ^ int(rng.integers(0, 1 << 20)) << 20) for i in range(1, 21)]
    rows += [(30, int(base[0]) ^ (1 << j)) for j in range(20, 50)]
    frame = spark.createDataFrame(rows, "id bigint, code bigint")
    for k in (1, 5):
        expected = set()
        for q, code in set(rows):
            best = sorted({((code ^ c) & (1 << 64) - 1).bit_count() * 1000 + i for i, c in rows if i != q})[:k]
            expected |= {(q, r, b % 1000, b // 1000) for r, b in enumerate(best, 1)}
        got = hamming_top_k(frame, frame, k=k).collect()
        assert set(map(tuple, got)) == expected and len([r for r in got if r.query_id == 0]) == 8 * k


def test_sign_code(spark):
    rows = [(1, [1.0] + [-1.0] * 62 + [2.0]), (2, [0.0] * 64), (3, None), (4, [float("nan"), 1.0])]
    got = {r.i: r.c for r in spark.createDataFrame(rows, "i int, v array<float>").select("i", sign_code(F.col("v")).alias("c")).collect()}
    assert got[1] == (1 | 1 << 63) - (1 << 64) and got[2] == 0 and got[3] is None and got[4] & 2


DOCS = "doc_id bigint, text string, n_chars bigint, lang string, score string, numbers string, label string"


def corpus(n, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(20, 90))]
        good = rng.random() < 0.8
        if not good:
            kind = rng.randrange(3)
            text = [w + "***" for w in text] if kind == 0 else [text[0]] * len(text) if kind == 1 else [w.upper() + "!!" for w in text]
        rows.append((i, " ".join(text), len(" ".join(text)), "en", "s", "n", "l"))
        labels.append((i, int(good), 0))
    return rows, labels


def test_quality_on_held_out_rows(spark):
    rows, labels = corpus(900, 3)
    rows += [(None, None, None, None, None, None, None), (5000, "", 0, "", "", "", ""), (5001, " \n", 2, "", "", "", ""), (5002, "word " * 60_000, 1, "", "", "", ""), rows[0]]
    docs = spark.createDataFrame(rows, DOCS)
    marks = spark.createDataFrame([*labels, (3, None, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    model = quality.train(docs, marks, metadata=["n_chars"])
    got = quality.classify(docs, model, metadata=["n_chars"]).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.held_out == (zlib.crc32((str(r.doc_id) if r.doc_id is not None else "").encode()) % 5 == 0) for r in got)
    truth = {i: q for i, q, _ in labels}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.95
    flipped = spark.createDataFrame([(i, (1 - q) if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in labels], "doc_id bigint, quality int, toxic int")
    again = quality.train(docs, flipped, metadata=["n_chars"])
    assert np.array_equal(again.factors, model.factors)
    kept = quality.keep_good(docs, model, metadata=["n_chars"])
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in got)
    assert quality.classify(docs.where("false"), model, metadata=["n_chars"]).count() == 0
    blank = quality.train(docs, marks.where("false"))
    assert {r.score for r in quality.classify(docs, blank).collect()} == {0.5}


def test_pairs_cost_is_the_sum_of_all_pairs():
    rng = np.random.default_rng(4)
    model = quality.Model(np.zeros(1), np.ones(1), 0.3, rng.normal(size=50), rng.normal(size=(50, 4)))
    index, value = np.array([3, 7, 9, 20, 4, 3], np.int32), rng.normal(size=6)
    x = quality.Rows(index, value, np.array([0, 4, 6]))
    margins, _ = model.sums(x)
    for row, (a, b) in enumerate(((0, 4), (4, 6))):
        slow = 0.3 + sum(model.linear[index[i]] * value[i] for i in range(a, b))
        slow += sum(model.factors[index[i]] @ model.factors[index[j]] * value[i] * value[j] for i in range(a, b) for j in range(i + 1, b))
        assert margins[row] == pytest.approx(slow)


def test_pipeline_stages(spark, sf):
    documents = spark.read.parquet(f"{sf}/documents.parquet").withColumn("doc", F.lit("clash"))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "simhash_near_dedup", "source_mixing", "bpe_encoding"]
    docs, counts = documents, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == documents.columns
        docs = spark.createDataFrame(docs.collect(), documents.schema)
        counts.append(docs.count())
    bad = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 0").collect()}
    kept = {r.doc_id for r in docs.collect()}
    assert counts[0] >= counts[2] and counts[0] == counts[1] and len(kept & bad) <= 3
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert last.count() == counts[3] and last.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]
    empty = spark.createDataFrame([], documents.schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf).count() == 0
