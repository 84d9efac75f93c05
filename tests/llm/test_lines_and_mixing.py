"""Line dedup and mixing against loops, and their odd cases."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from segue.llm.line_dedup import dedup_lines
from segue.llm.mixing import mix_sources

DOCS = "doc_id bigint, text string, source string, line string, h1 string, copy string"


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = max(a, b, key=len), min(a, b, key=len)
    return any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute(docs, min_chars=16):
    """Texts after dedup, by comparing every line with all earlier ones."""
    seen, out = [], []
    for doc_id, text in sorted(docs, key=lambda d: d[0]):
        kept = []
        for raw in text.split("\n"):
            line = raw.strip(" \t\r\f\v")
            if line and any(line == s or min(len(line), len(s)) >= min_chars and one_edit(line, s) for s in seen):
                pass
            else:
                kept.append(raw)
            if line:
                seen.append(line)
        out.append((doc_id, "\n".join(kept)))
    return out


def mutated(rng, line):
    i = rng.randrange(len(line) + 1)
    kind = rng.choice(["insert", "delete", "swap", "two"])
    if kind == "insert":
        return line[:i] + rng.choice("abé") + line[i:]
    if kind == "delete":
        return line[:i] + line[i + 1 :]
    if kind == "swap":
        return line[:i] + "ß" + line[i + 1 :]
    return "x" + line[:-1] + "yy"


def test_lines_as_by_loops(spark):
    rng = random.Random(5)
    base = ["".join(rng.choice("ab é") for _ in range(n)) for n in (3, 15, 16, 17, 31, 40, 64, 200)]
    docs = []
    for i in range(60):
        lines = [rng.choice([rng.choice(base), mutated(rng, rng.choice(base)), mutated(rng, mutated(rng, rng.choice(base))), "", "  "]) for _ in range(6)]
        docs.append((i, "\n".join(lines)))
    frame = spark.createDataFrame([(i, t, "s", "l", "h", "c") for i, t in docs], DOCS)
    got = sorted((r.doc_id, r.text) for r in dedup_lines(frame).collect())
    assert got == brute(docs)


def test_short_lines_as_by_loops(spark):
    rng = random.Random(9)
    docs = [(i, "\n".join("".join(rng.choice("abé") for _ in range(rng.randrange(16))) for _ in range(4))) for i in range(60)]
    frame = spark.createDataFrame([(i, t, "s", "l", "h", "c") for i, t in docs], DOCS)
    for min_chars in (1, 5):
        got = sorted((r.doc_id, r.text) for r in dedup_lines(frame, min_chars=min_chars).collect())
        assert got == brute(docs, min_chars) and got != brute(docs)


def test_lines_odd_cases(spark):
    long = "w" * 50_000
    rows = [
        (2, "same line of many words\n\nsame line of many words \r", "a", "x", "y", "z"),
        (None, "a line before any number", None, None, None, None),
        (1, None, None, None, None, None), (3, "", None, None, None, None), (4, long, "b", None, None, None),
        (5, long[:20_000] + "v" + long[20_000:], "b", None, None, None), (6, "a line before any number!", "b", None, None, None),
        (7, "twin line of the seventh", "c", None, None, None), (7, "twin line of the seventh", "c", None, None, None),
        (8, "short", "c", None, None, None), (9, "shorn", "c", None, None, None),
    ]
    got = dedup_lines(spark.createDataFrame(rows, DOCS))
    assert got.columns == ["doc_id", "text", "source", "line", "h1", "copy"]
    texts = {r.doc_id: r.text for r in got.collect()}
    assert texts == {
        2: "same line of many words\n", None: "a line before any number", 1: None, 3: "", 4: long, 5: "", 6: "",
        7: "twin line of the seventh", 8: "short", 9: "shorn",
    }
    assert got.where("doc_id = 7").count() == 2
    assert got.where("doc_id = 2").first().line == "x"
    assert dedup_lines(spark.createDataFrame([], DOCS)).count() == 0
    exact = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame(rows, DOCS), edits=0).collect()}
    assert exact[6] == "a line before any number!"


def test_lines_plan_has_no_python(spark):
    frame = spark.createDataFrame([(1, "a line of some length here", "s", "", "", "")], DOCS)
    plan = dedup_lines(frame)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def poisson(u, mean):
    term = below = math.exp(-mean)
    n = 0
    while below <= u and n < 200:
        n += 1
        term *= mean / n
        below += term
    return n


def test_mix_as_by_loops(spark):
    rows = [(i, f"t{i}", "big" if i % 3 else ("small" if i % 2 else None), "l", "h", "old") for i in range(900)]
    got = mix_sources(spark.createDataFrame(rows, DOCS), weights={"big": 1.0, "small": 2.0}, total=2.0)
    counts = {"big": 600, "small": 150, None: 150}
    weight = {"big": 1.0, "small": 2.0, None: math.sqrt(150 / 600)}
    mean = {s: 2.0 * 900 * weight[s] / sum(weight.values()) / counts[s] for s in counts}
    expected = {}
    for i, _, source, *_ in rows:
        u = int(hashlib.md5(f"42-{i}".encode()).hexdigest()[:13], 16) / 2**52
        expected[i] = poisson(u, mean[source])
    seen = {}
    for r in got.collect():
        assert r.text == f"t{r.doc_id}" and r.line == "l"
        seen.setdefault(r.doc_id, []).append(r["copy"])
    assert {i: len(c) for i, c in seen.items()} == {i: n for i, n in expected.items() if n}
    assert all(sorted(c) == list(range(1, len(c) + 1)) for c in seen.values())
    shares = {s: sum(expected[i] for i, _, x, *_ in rows if x == s) / 1800 for s in counts}
    assert all(abs(shares[s] - weight[s] / sum(weight.values())) < 0.06 for s in counts)


def test_mix_order_is_seeded_and_global(spark):
    rows = [(i, "t", "a" if i < 700 else "b", "", "", "") for i in range(1000)]
    frame = spark.createDataFrame(rows, DOCS)
    first = [r.doc_id for r in mix_sources(frame).collect()]
    assert first == [r.doc_id for r in mix_sources(frame.repartition(7)).collect()]
    assert first != sorted(first) and first != [r.doc_id for r in mix_sources(frame, seed=43).collect()]
    assert 0.3 < sum(i < 500 for i in first[: len(first) // 2]) / sum(i < 500 for i in first) < 0.7


def test_rows_without_key_draw_for_themselves(spark):
    """A third of all rows without key, in a source that is wanted less than once: as many stay as the rate asks."""
    rows = [(i if i % 3 else None, f"t{i}", "hot" if i % 3 != 1 else "rare", "", "", "") for i in range(1500)]
    got = mix_sources(spark.createDataFrame(rows, DOCS), weights={"hot": 1.0, "rare": 1.0}).collect()
    kept = [r for r in got if r.doc_id is None]
    assert abs(len(kept) - 500 * 0.75) < 80 and len({r.text for r in kept}) > 200
    levels = {t: poisson(int(hashlib.md5(f"42-null-{hashlib.md5(t.encode()).hexdigest()}".encode()).hexdigest()[:13], 16) / 2**52, 0.75) for i, t, *_ in rows if i is None}
    assert len(kept) == sum(levels.values())


def test_mixing_moves_the_texts_once(spark):
    frame = spark.createDataFrame([(1, "x", "a", "", "", "")], DOCS)
    plan = mix_sources(frame)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") - plan.count("BroadcastExchange ") == 1 and "Sort [place" in plan


def test_mix_odd_cases(spark):
    assert mix_sources(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(None, None, None, None, None, None), (1, "x", "a", "", "", ""), (1, "x", "a", "", "", "")]
    got = mix_sources(spark.createDataFrame(rows, DOCS), total=20.0)
    per_row = got.groupBy("doc_id", "copy").count().where("doc_id = 1")
    assert {r["count"] for r in per_row.collect()} == {2} and got.where("doc_id is null").count() > 0
    assert mix_sources(spark.createDataFrame(rows, DOCS), copy=None).columns == ["doc_id", "text", "source", "line", "h1", "copy"]
    with pytest.raises(ValueError):
        mix_sources(spark.createDataFrame(rows, DOCS), weights={"a": -1.0})
    assert mix_sources(spark.createDataFrame(rows, DOCS), weights={"a": 0.0}).where(F.col("source") == "a").count() == 0
    with pytest.raises(Exception, match="over 700 copies"):
        mix_sources(spark.createDataFrame(rows, DOCS), total=5000.0).collect()
