"""Decontamination, hard negatives and spelling variants against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from segue.llm import decontamination, hard_negatives, spelling

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = str.maketrans(UPPER, LOWER)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))


def runs_of(text, n=10):
    w = words(text)
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


DOCS = "doc_id bigint, text string, doc string, at int, phrase string, word string, th bigint"


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    common = ["the", "of", "Ñandú", "a", "in", "x9", "été", "ÉTÉ", "漢字", "und"]
    word = lambda: rng.choice(common) if rng.random() < 0.6 else f"w{rng.randrange(60)}"
    say = lambda n: rng.choice([" ", ", ", "\n", "-"]).join(word() for _ in range(n))
    items = [(i, say(rng.choice([1, 3, 9, 10, 11, 25, 40]))) for i in range(25)]
    items += [(100, "the"), (101, "the the the the the the the the the the the"), (102, ""), (103, None), (104, " .,! "), (5, say(15)), (None, say(12)), (106, "Zebra quagga"), (107, items[3][1]), (108, "never seen at all")]
    docs = []
    for i in range(120):
        text = say(rng.choice([0, 1, 5, 30, 200]))
        for _ in range(rng.randrange(3)):
            passage = words(rng.choice(items)[1])
            cut = rng.randrange(max(1, len(passage) - 8)) if passage else 0
            text += "\n" + rng.choice([" ", "; "]).join(w.upper() if rng.random() < 0.3 else w for w in passage[cut:]) + " " + say(rng.randrange(4))
        docs.append((i, text))
    docs += [(200, None), (201, ""), (202, "the " * 3000 + "zebra, QUAGGA"), (None, items[4][1]), (None, items[4][1]), (None, None), (7, items[8][1]), (7, docs[7][1]), (203, "...")]
    return docs, items


def frames(spark, corpus):
    docs, items = corpus
    return (
        spark.createDataFrame([(i, t, "d", 1, "p", "w", 2) for i, t in docs], DOCS),
        spark.createDataFrame([(i, t, "i", "p") for i, t in items], "item_id bigint, text string, item string, phrase string"),
    )


def test_contamination_as_by_loops(spark, corpus):
    docs, items = corpus
    expected = []
    for id_, text in docs:
        w = words(text)
        hit, found = set(), set()
        for item, t in items:
            for run in runs_of(t):
                for i in range(len(w) - len(run) + 1):
                    if tuple(w[i : i + len(run)]) == run:
                        hit |= set(range(i, i + len(run)))
                        found |= {str(item)} if item is not None else set()
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        expected.append((id_, len(w), len(hit), len(found), digest, bool(hit)))
    got = decontamination.contamination(*frames(spark, corpus))
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)
    assert sum(r[2] > 0 for r in expected) > 40


def test_phrases_and_near_words_as_by_loops(spark, corpus):
    docs, items = corpus
    docs, items = [d for d in docs if d[0] is not None][:60], [i for i in items if i[0] is not None]
    exact, near = set(), set()
    counts = Counter(w for _, t in docs for w in words(t))
    for item, t in items:
        for run in runs_of(t):
            if any(not counts[w] for w in run):
                continue
            at1 = min(range(len(run)), key=lambda i: (counts[run[i]], run[i].encode(), i))
            for id_, text in docs:
                w = words(text)
                for i in range(len(w)):
                    if tuple(w[i : i + len(run)]) == run:
                        exact.add((id_, i, len(run), " ".join(run), str(item)))
                    if w[i] == run[at1] and set(run) <= set(w[max(0, i - 15) : i + 16]):
                        near.add((id_, i, len(run), " ".join(run), str(item)))
    d, b = frames(spark, (docs, items))
    assert set(map(tuple, decontamination.phrase_matches(d, b).collect())) == exact and exact
    assert set(map(tuple, decontamination.proximity_matches(d, b, 15).collect())) == near and len(near) > len(exact)


def test_contamination_of_empty_tables(spark, corpus):
    docs, items = frames(spark, corpus)
    assert decontamination.contamination(docs.limit(0), items).count() == 0
    clean = decontamination.contamination(docs, items.limit(0))
    assert clean.count() == len(corpus[0]) and clean.where("contaminated or n_items > 0").count() == 0


def test_index_runs_without_python(spark, corpus):
    plan = decontamination.contamination(*frames(spark, corpus))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_hot_keys_are_dealt_over_parts(spark):
    from segue.llm.hot import dealt_join

    many = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"))
    few = many.select("k").distinct().withColumn("v", F.length("k"))
    got = dealt_join(many, few, ["k"], per_part=100)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, many.join(few, "k").collect()))


# hard negatives


def brute_negatives(rows, n_positives=5, n_negatives=10):
    sound = {(i, l, tuple(math.floor(256 * x) for x in v)) for i, l, v in rows if i is not None and l is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for a in (r for r in sound if r[0] % 10 == 0):
        scored = [(sum(x * y for x, y in zip(a[2], r[2])), r) for r in sound if r != a and len(r[2]) == len(a[2])]
        same = sorted((-s, r[0]) for s, r in scored if r[1] == a[1])[:n_positives]
        for down, positive in same:
            fit = sorted((-s, r[0]) for s, r in scored if r[1] != a[1] and -30 * down <= 100 * s <= -90 * down)[:n_negatives]
            out += [(a[0], positive, k, r, -down, -s) for k, (s, r) in enumerate(fit, 1)]
    return out


@pytest.mark.parametrize("block", [40, 5000])
def test_negatives_as_by_loops(spark, block):
    rng = random.Random(3)
    centres = [[rng.gauss(0, 1) for _ in range(12)] for _ in range(4)]
    rows = []
    for i in range(400):
        label = 0 if rng.random() < 0.4 else rng.randrange(4)
        rows.append((i, label, [c * 0.2 + 0.1 * rng.gauss(0, 1) for c in centres[rng.randrange(4)]]))
    rows[30:34] = [(30 + j, 2, rows[29][2]) for j in range(4)]  # ties
    rows += [(1000, None, [0.1] * 12), (1010, 1, None), (1020, 1, [0.1] * 11 + [None]), (1030, 1, [float("nan")] + [0.1] * 11), (1040, 1, [float("inf")] * 12), (1050, 1, [])]
    rows += [(1060, 1, [0.5, 0.5, 0.5]), (1070, 1, [0.4, 0.4, 0.3]), (1061, 2, [0.2, 0.3, 0.3]), (1080, 9, [0.1] * 12), (None, 1, [0.1] * 12), (1090, 0, [0.0] * 12), rows[50], (1100, 3, [-0.2] * 12)]
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], "vec_id bigint, label int, embedding array<float>, dims string, block int")
    shown = [(r.vec_id, r.label, r.embedding) for r in df.select("vec_id", "label", F.col("embedding").cast("array<double>")).collect()]
    got = hard_negatives.hard_negatives(df, "vec_id % 10 = 0", block=block)
    expected = brute_negatives(shown)
    assert sorted(map(tuple, got.collect())) == sorted(expected) and len(expected) > 500


def test_negatives_of_empty_tables(spark):
    df = spark.createDataFrame([], "vec_id bigint, label int, embedding array<float>")
    assert hard_negatives.hard_negatives(df, "vec_id % 10 = 0").count() == 0
    one = spark.createDataFrame([(10, 1, [0.5, 0.1])], df.schema)
    assert hard_negatives.hard_negatives(one, "vec_id % 10 = 0").count() == 0


def test_intervals_hold_every_score():
    import numpy as np

    rng = np.random.default_rng(2)
    for dims in (1, 3, 64, 100):
        rows = rng.integers(-300, 300, (500, dims)) * rng.integers(0, 3, (500, 1))
        anchor = rows[7]
        codes, align, rest = hard_negatives.encode(rows)
        low, high = hard_negatives.intervals(anchor.astype(float) @ hard_negatives.rotation(dims), codes, align, rest)
        exact = rows @ anchor
        assert (low <= exact).all() and (exact <= high).all()
        assert np.median(high - low) < 2 * np.linalg.norm(anchor) * np.linalg.norm(rows, axis=1).max()


# spelling


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_forms(counts):
    near = {w: [o for o in counts if one_edit(w, o)] for w in counts}
    form = {}
    for w in counts:
        top = min(near[w], key=lambda o: (-counts[o], o.encode()), default=None)
        form[w] = top if top and counts[top] >= 2 * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return out


def test_forms_as_by_loops(spark):
    rng = random.Random(4)
    made = ["".join(rng.choice("abcdé") for _ in range(rng.randint(1, 9))) for _ in range(900)]
    made += ["x" * 70 + "abc", "x" * 70 + "abd", "x" * 70 + "ab", "x" * 35 + "y" + "x" * 37, "x" * 71, "x" * 72, "x" * 73, "y" + "x" * 70 + "abc", "a", "b", "ab"]
    made += ["z" * i for i in range(1, 12)] + ["ÿ" * 63 + "ab", "ÿ" * 64 + "ab", "ÿ" * 65 + "ab", "q" * 64, "q" * 65, "q" * 66]
    counts = {w: rng.choice([3, 4, 5, 8, 20, 50, 120, 500]) for w in made}
    df = spark.createDataFrame([(w, n, "t") for w, n in counts.items()], "word string, n bigint, text string")
    got = spelling.spelling_forms(df)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    expected = brute_forms(counts)
    assert set(map(tuple, got.collect())) == expected and got.count() == len(counts)
    assert sum(r[1] is not None and r[2] != r[1] for r in expected) > 20


def test_variants_of_texts_as_by_loops(spark):
    rng = random.Random(8)
    base = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(4, 8))) for _ in range(60)] + ["Über", "ÜBERALL", "señor×a", "a" * 200]
    rows = [(i, " ".join(rng.choice(base) for _ in range(60)) + rng.choice([".", "", "9", "漢"])) for i in range(150)]
    rows += [(500, None), (501, ""), (None, "abcde abcde abcdf Abcde"), (3, rows[3][1]), (502, "b" * 50_000 + " " + ("b" * 50_000 + " ") * 3)]
    counts = Counter()
    for id_, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(ASCII_LOWER)
            h = zlib.crc32(f"{'' if id_ is None else id_}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 3 and len(w) >= 5}
    df = spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id bigint, text string, word string, n int")
    got = spelling.spelling_variants(df, slip=97)
    assert set(map(tuple, got.collect())) == brute_forms(counts) and any(len(w) == 50_000 for w in counts)


def test_spelling_of_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert spelling.spelling_variants(empty).count() == 0
    with pytest.raises(ValueError):
        spelling.spelling_forms(spark.createDataFrame([], "word string, n bigint"), 1.0)
