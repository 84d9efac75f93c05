"""SimHash near-dedup, suffix dedup and connected components against brute force."""

import random

import numpy as np
import pyarrow as pa
import xxhash

from segue.llm import simhash
from segue.llm.components import Forest, components
from segue.llm.simhash import LeafJoin, fingerprint_of, keep_one, near_links, simhash_components
from segue.llm.suffix_dedup import SuffixSort, remove_repeats

SCHEMA = "doc_id bigint, text string, fp string, component string, id string, th string, spans string"
REST = ("f", "c", "i", "t", "s")


def union(pairs, nodes):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 560)]
    rows = [(max(p), min(p)) if i % 2 else p for i, p in enumerate(pairs)] + [(None, 3), (4, None), (7, 7), *pairs[:5]]
    got = {r.node: r.component for r in components(spark.createDataFrame(rows, "a bigint, b bigint")).collect()}
    linked = {n for a, b in pairs if a != b for n in (a, b)}
    expected = union(pairs, {n for p in pairs for n in p})
    assert got == {n: expected[n] for n in linked}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_forest():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 500, 300), rng.integers(0, 500, 300)
    forest = Forest(500)
    for i in range(0, 300, 50):
        forest.link(a[i : i + 50], b[i : i + 50])
    expected = union(zip(a.tolist(), b.tolist()), range(500))
    assert [forest.root(i) for i in range(500)] == [expected[i] for i in range(500)]
    assert len(forest.edges()[0]) == sum(expected[i] != i for i in range(500))


def slow_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    texts = ["", None, " \t ", "One", "one two three", "a b c d", "É ÀB c D e f", "x y " * 500, "a\x0bb\x0cc d e f g", "z " * 9]
    assert [int(x) for x in fingerprint_of(pa.array(texts))] == [slow_fingerprint(t) for t in texts]
    hashes = [np.random.default_rng(i).integers(0, 1 << 63, n).astype(np.uint64) for i, n in enumerate((5, 0, 3_000_000, 7))]
    got = simhash.majority(hashes, np.array([len(h) for h in hashes]), most=10)
    bits = lambda h: sum(1 << b for b in range(64) if 2 * int(((h >> np.uint64(b)) & np.uint64(1)).sum()) > len(h))
    assert [int(x) for x in got] == [bits(h) for h in hashes]


def clustered(seed, n):
    rng = np.random.default_rng(seed)
    centers = rng.integers(0, 1 << 63, 12).astype(np.uint64)
    points = centers[rng.integers(0, 12, n)]
    for _ in range(6):
        points = points ^ np.where(rng.random(n) < 0.6, np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64), np.uint64(0))
    return np.unique(points)


def test_leaf_join_and_tree(spark):
    points = clustered(3, 900)
    near = np.argwhere(np.triu(np.bitwise_count(points[:, None] ^ points[None, :]) <= 4, 1))
    expected = union([(int(points[a]), int(points[b])) for a, b in near], [int(p) for p in points])
    join = LeafJoin(points, 4, block=64)
    join.alone(np.arange(len(points)))
    assert {int(p): int(min(points[[i for i in range(len(points)) if join.forest.root(i) == join.forest.root(k)]])) for k, p in enumerate(points[:40])} == {int(p): expected[int(p)] for p in points[:40]}
    frame = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp bigint")
    links = [(r.a, r.b) for r in near_links(frame, 4, leaf_rows=60).collect()]
    signed = union([(int(points.view(np.int64)[a]), int(points.view(np.int64)[b])) for a, b in near], points.view(np.int64).tolist())
    assert union(links, points.view(np.int64).tolist()) == signed
    assert len(links) < 3 * len(points)


def test_simhash_rows(spark):
    rng = random.Random(4)
    words = ["w%d" % i for i in range(500)]
    docs = []
    for i in range(12):
        base = [rng.choice(words) for _ in range(120)]
        docs.append(" ".join(base))
        docs += [" ".join(base[:-1] + [rng.choice(words)]) for _ in range(3)] + [" ".join(base).upper()]
    docs += ["", None, "  ", "few words"]
    rows = [(i, t, *REST) for i, t in enumerate(docs)] + [(3, docs[3], *REST), (None, docs[0], *REST), (None, "alone in this", *REST)]
    got = simhash_components(spark.createDataFrame(rows, SCHEMA)).collect()
    big = 1 << 62
    keyed = [(big if i is None else i, slow_fingerprint(t)) for i, t, *_ in rows]
    group = union([(a, b) for a in range(len(rows)) for b in range(a) if (keyed[a][1] ^ keyed[b][1]).bit_count() <= 4], range(len(rows)))
    least = {g: min(keyed[i][0] for i in range(len(rows)) if group[i] == g) for g in group.values()}
    expected = [(i, format(fp, "016x"), None if least[group[n]] == big else least[group[n]]) for n, ((i, *_), (_, fp)) in enumerate(zip(rows, keyed))]
    assert sorted(map(str, ((r.doc_id, r.fingerprint, r.component_id) for r in got))) == sorted(map(str, expected))
    kept = keep_one(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == SCHEMA.replace(" bigint", "").replace(" string", "").split(", ")
    assert kept.count() == len(set(group.values())) and {r.component for r in kept.collect()} == {"c"}
    assert simhash_components(spark.createDataFrame([], SCHEMA)).count() == 0


def slow_repeats(texts, n):
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for b in raw:
        for i in range(len(b) - n + 1):
            seen[b[i : i + n]] = seen.get(b[i : i + n], 0) + 1
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - n + 1):
            if seen[b[i : i + n]] > 1:
                gone[i : i + n] = True
        runs = int(np.diff(np.concatenate(([0], gone.astype(int)))).clip(0).sum())
        out.append((len(b), int(gone.sum()), runs, np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return out


def test_suffix_sort():
    rng = np.random.default_rng(6)
    for letters in (1, 2, 4):
        texts = [bytes(rng.integers(97, 97 + letters, rng.integers(1, 40)).astype(np.uint8)) for _ in range(200)]
        size = np.array([len(t) for t in texts])
        group = np.sort(rng.integers(0, 12, 200))
        found = SuffixSort(np.frombuffer(b"".join(texts), np.uint8), np.cumsum(size) - size, size, group)
        got = [(group[i], texts[i]) for i in found.order]
        assert got == sorted(got)
        for p in range(1, 200):
            a, b = got[p - 1], got[p]
            same = next((k for k, (u, v) in enumerate(zip(a[1], b[1])) if u != v), min(len(a[1]), len(b[1])))
            assert found.common[p] == (same if a[0] == b[0] else 0)
        before = found.order.copy(), found.common.copy()
        found.by_bytes(np.flatnonzero(np.arange(200) > found.group_first))
        assert [texts[i] for i in found.order] == [texts[i] for i in before[0]] and np.array_equal(found.common, before[1])


def test_repeats_as_by_loops(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 7)))
    passage = [" ".join(word() for _ in range(n)) for n in (12, 30, 60)]
    texts = [None, "", "short", "q" * 500, "ab" * 300, "ab" * 150 + "c" + "ba" * 150]
    for i in range(70):
        parts = [" ".join(word() for _ in range(rng.randrange(1, 40))) for _ in range(3)]
        text = rng.choice(passage).join(parts)
        if i % 5 == 0:
            at = rng.randrange(len(text))
            text = text[:at] + "#" + text[at:]
        texts += [text] * rng.choice([1, 1, 1, 2, 3])
    texts += [passage[2] + chr(97 + i % 26) * (i % 7) for i in range(40)]
    rows = [(i if i % 9 else None, t, *REST) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for length, gram, piece in ((60, 20, 1024), (60, 20, 3), (25, 9, 2)):
        got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in remove_repeats(frame, length=length, gram=gram, piece=piece).collect()]
        expected = [(i, *x) for (i, *_), x in zip(rows, slow_repeats(texts, length))]
        assert sorted(map(str, got)) == sorted(map(str, expected))
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repeats_in_long_texts(spark, monkeypatch):
    from segue.llm import suffix_dedup as module

    rng = random.Random(9)
    text = "".join(rng.choice("abcdefgh") for _ in range(9000))
    texts = [text, text[3000:4200] + "x" + text[:700], "".join(rng.choice("abc") for _ in range(5000)), "y" * 7000]
    pieces = list(module.parts(pa.array(texts), module.Spans(200, 40)))
    assert len(pieces) == 1
    frame = spark.createDataFrame([(i, t, *REST) for i, t in enumerate(texts)], SCHEMA).coalesce(1)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in remove_repeats(frame).collect()}
    assert got == dict(enumerate(slow_repeats(texts, 200)))
    whole = [module.Anchors(data, low, high, own, module.Spans(200, 40)) for _, data, low, high, _, own in pieces][0]
    monkeypatch.setattr(module, "PART_BYTES", 1000)
    cut = {}
    for number, data, low, high, offset, own in module.parts(pa.array(texts), module.Spans(200, 40)):
        found = module.Anchors(data, low, high, own, module.Spans(200, 40))
        if len(found.at):
            for at, i, c in zip(found.at - found.edges[0] + offset, number[found.text], found.surroundings()):
                cut[int(i), int(at)] = c
    expected = {(int(i), int(a)): c for a, i, c in zip(whole.at - whole.edges[0], whole.text, whole.surroundings())}
    assert cut == expected


def test_long_text_in_parts_has_each_anchor_once(spark):
    rng = np.random.default_rng(10)
    long = rng.integers(97, 123, (1 << 20) + 300_000).astype(np.uint8).tobytes().decode()
    # a passage over the second boundary stands in another text too, one before the first boundary twice in the long one
    at = (1 << 20) - 300
    texts = [long[: 700_000] + long[1000:1400] + long[700_000:], "z" * 10 + long[at - 400 : at + 100], "short"]
    frame = spark.createDataFrame([(i, t, *REST) for i, t in enumerate(texts)], SCHEMA).coalesce(1)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in remove_repeats(frame).collect()}
    expected = dict(enumerate(slow_repeats(texts, 200)))
    assert {i: x[:3] for i, x in got.items()} == {i: x[:3] for i, x in expected.items()}
    assert got == expected


def test_each_group_keeps_one_row(spark):
    rng = random.Random(11)
    text = lambda: " ".join("w%d" % rng.randrange(500) for _ in range(80))
    alone, copied, other = [text() for _ in range(6)], text(), text()
    rows = [(None, t, *REST) for t in alone]  # unrelated, all without an id
    rows += [(5, copied, *REST), (3, copied, *REST), (5, other, *REST), (None, other, *REST), (None, alone[0], *REST)]
    rows += [(7, t, *REST) for t in (text(), text())] + [(7, rows[0][1], *REST)]
    kept = keep_one(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    expected = [(None, t) for t in alone[1:]] + [(3, copied), (5, other), (7, alone[0])] + [(i, t) for i, t, *_ in rows[-3:-1]]
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept))) == sorted(map(str, expected))


def test_equal_rows_of_a_group_keep_one(spark):
    rows = [(i, "one two three four five six", *REST) for i in (None, None, 4, 4)] + [(None, "", *REST), (None, None, *REST)]
    kept = keep_one(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["4", "None"]


def test_leaves_and_distances_take_one_python_process_a_task(spark):
    points = np.random.default_rng(7).integers(0, 1 << 63, 400)
    fps = spark.createDataFrame([(int(p),) for p in points], "fp bigint")
    tree = simhash.Tree()
    tree.split(0, int(points[0]), 31)
    leaf = tree.home(points.view(np.uint64))
    centers = np.array([0, points[1], points[2]], np.int64).view(np.uint64)
    counts = simhash.distance_counts(fps, tree, centers, [2])
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    far = simhash.distance(points.view(np.uint64), centers[leaf]).astype(int)
    expected = {130 + d: int(((leaf == 2) & (far == d)).sum()) for d in far[leaf == 2].tolist()} | {None: int((leaf != 2).sum())}
    assert {r["code"]: r["count"] for r in counts.collect()} == expected
