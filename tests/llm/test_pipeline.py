"""The whole pipeline against plain loops on a small table: no row is lost, added or changed between stages."""

import hashlib
import math
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

import corpus_pipeline
from segue.llm import quality
from segue.llm.text_bytes import slices
from tests.llm.test_copies import slow_fingerprint, union
from tests.llm.test_lines_and_mixing import brute, poisson


def made(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared = [line(6) for _ in range(5)] + ["short one", "short two"]
    rows, labels = [], []
    for i in range(160):
        good, copy = rng.random() < 0.8, rng.random()
        if good and copy < 0.2 and rows:
            text = rng.choice(rows)[1]
            text = text + " " + rng.choice(words) if copy < 0.1 else text
        else:
            text = "\n".join(line(rng.randrange(4, 12)) if rng.random() < 0.7 else rng.choice(shared) for _ in range(rng.randrange(2, 9)))
            if not good:
                text = rng.choice([text.replace(" ", "*** "), text.upper() + "!!!", (text[:9] + " ") * 30])
        rows.append((i * 7 % 1000, text, rng.choice(["en", "de"]), rng.choice(["big", "big", "big", "small", "web"]), len(text)))
        labels.append((i * 7 % 1000, int(good), 0))
    return rows, labels


def slow_scores(model, rows):
    """The classifier's score with every pair added up."""
    out = {}
    for id_, text, _, _, n_chars in rows:
        ((_, data, edges),) = slices(pa.array([text]))
        statistics, words = quality.describe(data, edges)
        x = model.inputs(quality.with_metadata(statistics, pa.array([[float(n_chars)]])), words)
        margin = model.bias + sum(model.linear[i] * v for i, v in zip(x.index, x.value))
        vectors = [model.factors[i] * v for i, v in zip(x.index, x.value)]
        margin += sum(float(a @ b) for k, a in enumerate(vectors) for b in vectors[:k])
        out[id_] = 1 / (1 + math.exp(-max(-500.0, min(500.0, margin))))
    return out


def test_pipeline_as_by_loops(spark, tmp_path):
    rows, labels = made(12)
    folder = str(tmp_path / "tables")
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    marks.write.parquet(f"{folder}/labels.parquet")
    got = corpus_pipeline.run(spark, folder).collect()

    scores = slow_scores(quality.train(docs, marks, metadata=["n_chars"]), rows)
    assert all(abs(s - 0.3) > 1e-9 for s in scores.values())
    good = [r for r in rows if scores[r[0]] >= 0.3]
    texts = dict(brute([r[:2] for r in good]))
    prints = {i: slow_fingerprint(t) for i, t in texts.items()}
    near = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    groups = union(near, prints)
    single = [r for r in good if groups[r[0]] == r[0]]
    sources = [r[3] for r in single]
    n = {s: sources.count(s) for s in set(sources)}
    weight = {s: math.sqrt(n[s] / max(n.values())) for s in n}
    mean = {s: len(single) * weight[s] / sum(weight.values()) / n[s] for s in n}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = []
    for id_, _, _, source, _ in single:
        ids = library.encode(texts[id_], add_special_tokens=False).ids
        digest = hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        u = int(hashlib.md5(f"42-{id_}".encode()).hexdigest()[:13], 16) / 2**52
        expected += [(id_, len(ids), ids, digest)] * poisson(u, mean[source])
    assert sorted((r.doc_id, r.n_tokens, list(r.ids), r.decoded_sha256) for r in got) == sorted(expected)
    # each stage had something to do
    assert len(good) < len(rows) and len(single) < len(good) and any(texts[r[0]] != r[1] for r in good) and len(expected) != len(single)
    assert np.mean([scores[i] >= 0.3 for i, q, _ in labels if q]) > 0.95
