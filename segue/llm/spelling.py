"""Spelling variants: words one edit apart, found by walking a relational trie level by level.

The trie is a table of edges. A node is a beginning that several words go on from in different ways; an edge leads from
a node, by its first character, along a label to the next such node or to the end of the one word that is left. Words
are states (word, position, node, edits): a state without an edit opens one at its node, as the first place where two
words differ is always a node of both, and from there on the rest of the other word is known, so the state follows one
edge a level. States that end where a word ends, after one edit, are neighbours.

Near the root every word would open dozens of states. So there are two tries, of the words read forward and backward: of
a word with an edit, one half is whole, so each trie opens edits only from the middle of the word on, where it is sparse.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from segue.llm.hot import ascii_lower, dealt_join
from segue.operators.skew import MANY_ROWS
from segue.session import stash

RUN = r"[A-Za-zÀ-ÿ]+"
#: Longer words, and nodes deeper than this, go by a digest instead of their text.
NAMED = 64


def word_counts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = 5, min_count: int = 3, slip: int | None = None,
) -> DataFrame:
    """(word, n): the words of at least `min_chars` code points that occur at least `min_count` times in all texts.

    A word is a longest run of Latin letters, in lower case as far as A-Z goes. With `slip`, occurrences are spoilt as a
    test of the grouping: where the crc32 of "<key>:<word>" is a multiple of `slip`, the word loses the code point at
    that crc32 modulo its length, before anything is counted. NULL texts have no words; a NULL key is written as nothing.
    """
    id_ = F.coalesce(F.col(key).cast("string"), F.lit(""))
    found = F.regexp_extract_all(ascii_lower(F.col(text)), F.lit(RUN), F.lit(0))
    words = docs.select(id_.alias("id"), F.explode(found).alias("word"))
    if slip:
        h = F.crc32(F.concat_ws(":", "id", "word").cast("binary"))
        at = F.expr("cast(h % char_length(word) as int)")
        spoilt = F.concat(F.left(F.col("word"), at), F.expr("substring(word, cast(h % char_length(word) as int) + 2)"))
        words = words.withColumn("h", h).select(F.when(F.col("h") % slip == 0, spoilt).otherwise(F.col("word")).alias("word"))
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where((F.col("n") >= min_count) & (F.char_length("word") >= min_chars))


def word_name(word: Column) -> Column:
    """The word itself, or its beginning and digest if it is long; '#' is in no word."""
    long = F.concat(F.left(word, F.lit(NAMED)), F.lit("#"), F.sha2(word, 256))
    return F.when(F.char_length(word) > NAMED, long).otherwise(word)


def beginnings(words: DataFrame, long: bool) -> DataFrame:
    """(id, depth, node, code): from its middle on, where each word passes in the trie and how it goes on ('' at its end)."""
    first = F.expr("cast((char_length(text) - 1) div 2 as int)")
    short = words.where(F.char_length("text") <= NAMED)
    depths = short.select("id", "text", F.explode(F.sequence(first, F.char_length("text"))).alias("depth"))
    node = F.left(F.col("text"), F.col("depth"))
    plain = depths.select("id", "depth", node.alias("node"), F.expr("substring(text, depth + 1, 1)").alias("code"))
    if not long:
        return plain

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "depth", "node", "code"]
        for batch in batches:
            for id_, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, digest = [], blake2b(digest_size=16)
                for depth, code in enumerate([*text, ""]):
                    if depth >= (len(text) - 1) // 2:
                        name = text[:depth] if depth <= NAMED else f"{text[:NAMED]}#{depth}#{digest.hexdigest()}"
                        rows.append((id_, depth, name, code))
                    digest.update(code.encode())
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)

    longer = words.where(F.char_length("text") > NAMED).select("id", "text")
    return plain.unionByName(longer.mapInArrow(walk, "id string, depth bigint, node string, code string").withColumn("depth", F.col("depth").cast("int")))


def trie(words: DataFrame, backward: bool, long: bool) -> tuple[DataFrame, DataFrame]:
    """(paths, edges) of the trie over (id, word, n), as written tables.

    paths (id, text, depth, node, code): the nodes of each word from its middle on. edges (node, code, label, child, ends, n,
    codes, after): child is the next node, and codes how it goes on; or child is NULL where one word is left, which `ends`
    names, with its n. `after` is what can follow the first character.
    """
    read = F.reverse if backward else F.col
    words = words.select("id", read("word").alias("text"), "n")
    places = beginnings(words, long)
    point = F.ascii("code")  # numbers are aggregated by hash, strings would be sorted
    passed = places.groupBy("node").agg(F.min(point).alias("low"), F.max(point).alias("high"), F.count(F.lit(1)).alias("n"))
    nodes = stash(passed.where("low <> high").select("node", "n"), "trie-nodes")
    along = dealt_join(places, nodes.select("node"), ["node"], rows=MANY_ROWS, counts=nodes)
    path = W.partitionBy("id").orderBy("depth")
    along = along.withColumns({"child": F.lead("node").over(path), "until": F.lead("depth").over(path)})
    # a short word is its own name
    along = along.join(words.select("id", "text"), "id") if long else along.withColumn("text", read("id"))
    paths = stash(along, "trie-paths")
    label = F.expr("substring(text, depth + 1, coalesce(until, char_length(text)) - depth)")
    step = F.min(F.struct(F.length(label), label.alias("label"), "child", F.when(F.col("child").isNull(), F.col("id")).alias("ends")))
    edges = stash(paths.groupBy("node", "code").agg(step.alias("step")).select("node", "code", "step.label", "step.child", "step.ends"), "edges")
    codes = edges.groupBy(F.col("node").alias("child")).agg(F.array_join(F.collect_list(coded(F.col("code"))), "").alias("codes"))
    # an edge leads to a node or to a word's end
    inner = edges.where("child is not null").join(codes, "child").withColumn("n", F.lit(None).cast("bigint"))
    last = edges.where("child is null").join(words.select(F.col("id").alias("ends"), "n"), "ends").withColumn("codes", F.lit(None).cast("string"))
    second = F.expr("substring(label, 2, 1)")
    after = F.when(second != "", second).when(F.col("child").isNull(), F.lit("#")).otherwise(F.col("codes"))
    edges = inner.unionByName(last).withColumn("after", F.when(F.col("code") != "", after))
    return paths.select("id", "text", "depth", "node", "code"), stash(edges, "trie-edges")


def coded(code: Column) -> Column:
    """A character that stands for the code in a list of them; the end has one of its own."""
    return F.when(code == "", F.lit("#")).otherwise(code)


def near_in_trie(words: DataFrame, backward: bool, long: bool) -> list[DataFrame]:
    """Parts of (id, other, other_n): words one edit apart whose first difference, from where the trie begins, lies in the
    second half of `id`'s word."""
    paths, edges = trie(words, backward, long)
    chars = F.char_length("text")
    next_code = F.expr("substring(text, depth + 2, 1)")
    opened = paths.where(F.col("depth") >= F.floor(chars / 2)).withColumnRenamed("code", "own")
    names = ["id", "text", "position", "child", "ends", "n", "codes"]
    # the other word has one character more here, or another one: two characters of it are known with the edge's first
    looks = F.array(
        F.struct(F.lit(0).alias("skip"), coded(F.col("own")).alias("second")),
        F.when(F.col("depth") < chars, F.struct(F.lit(1).alias("skip"), coded(next_code).alias("second"))),
    )
    looking = opened.select("id", "text", "depth", "node", "own", F.explode(F.array_compact(looks)).alias("look"))
    looking = looking.select("id", "text", "depth", "node", "own", "look.skip", "look.second")
    onward = edges.where("code <> ''").withColumn("second", F.explode(F.split("after", "")))
    n_paths = paths.count()
    met = dealt_join(looking, onward, ["node", "second"], rows=2 * n_paths).where(F.col("own") != F.col("code"))
    met = met.where(F.expr("substring(text, depth + 1 + skip, char_length(label) - 1) = substring(label, 2)"))
    more = met.withColumn("position", F.expr("depth + skip + char_length(label) - 1")).select(*names)
    # the other word lacks a character here
    lacking = opened.where(F.col("depth") < chars).withColumn("code", next_code)
    met = dealt_join(lacking, edges, ["node", "code"], rows=n_paths).where(F.col("own") != F.col("code"))
    met = met.where(F.expr("substring(text, depth + 2, char_length(label)) = label"))
    less = met.withColumn("position", F.expr("depth + 1 + char_length(label)")).select(*names)
    states = more.unionByName(less)
    ahead = F.instr("codes", coded(F.expr("substring(text, position + 1, 1)"))) > 0
    whole = F.when(F.col("child").isNotNull(), ahead).otherwise(F.col("position") == F.char_length("text"))
    found = []
    while True:
        level = stash(states.where(whole).drop("codes"), "trie-states")
        found.append(level.where("child is null").select("id", F.col("ends").alias("other"), F.col("n").alias("other_n")))
        frontier = level.where("child is not null").select("id", "text", "position", F.col("child").alias("node"), F.expr("substring(text, position + 1, 1)").alias("code"))
        rows = frontier.count()
        if not rows:
            return found
        walked = dealt_join(frontier, edges, ["node", "code"], rows=rows)
        walked = walked.where(F.expr("substring(text, position + 1, char_length(label))") == F.col("label"))
        states = walked.select("id", "text", (F.col("position") + F.char_length("label")).alias("position"), "child", "ends", "n", "codes")


def near_words(words: DataFrame, long: bool) -> DataFrame:
    """(id, other, other_n): all ordered pairs of different words (id, word, n) that one inserted, deleted or replaced code
    point makes equal, dealt by id.

    Words go by `word_name`; `long` says whether any is longer than its name. Levels are as many as the most nodes on a
    word's path; each level is written, so a lost executor costs one level. Nodes that many words or states pass are dealt
    over several tasks. A word has at most some hundred near ones for each of its characters.
    """
    found = near_in_trie(words, False, long) + near_in_trie(words, True, long)
    return reduce(DataFrame.unionByName, found).repartition("id").distinct()


def spelling_forms(words: DataFrame, ratio: float = 2.0) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for a table (word, n) of distinct words.

    A word's form is its near word of largest n, ties by code point order, if that n is at least `ratio` times the word's
    own; NULL otherwise. The root is where forms lead to in the end, the word itself if it has none. With a ratio above 1
    counts grow along the forms, so that they have no rings. n_near counts the near words. An empty table gives no rows.
    """
    if not ratio > 1:
        raise ValueError("the ratio is above 1")
    named = stash(words.select(word_name(F.col("word")).alias("id"), "word", F.col("n").cast("bigint").alias("n")), "words")
    long = not named.where(F.char_length("word") > NAMED).isEmpty()
    near = near_words(named, long)
    if long:
        near = near.join(named.select(F.col("id").alias("other"), F.col("word").alias("other_word")), "other")
    else:
        near = near.withColumn("other_word", F.col("other"))
    best = F.min(F.struct((-F.col("other_n")).alias("down"), "other_word", "other"))
    near = near.groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    formed = named.join(near, "id", "left")
    has = -F.col("best.down") >= F.col("n") * ratio
    formed = stash(formed.select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has, F.col("best.other_word")).alias("form"),
        F.when(has, -F.col("best.down")).alias("form_n"), F.when(has, F.col("best.other")).alias("to"),
    ), "forms")

    # forms of forms: each round doubles the steps behind a pointer
    ahead = formed.where("to is not null").select("id", "to")
    while True:
        further = ahead.select(F.col("id").alias("to"), F.col("to").alias("end"))
        joined = stash(ahead.join(further, "to", "left").select("id", F.coalesce("end", "to").alias("to"), F.col("end").isNotNull().alias("moved")), "roots")
        ahead = joined.select("id", "to")
        if joined.where("moved").isEmpty():
            break
    roots = ahead.join(named.select(F.col("id").alias("to"), F.col("word").alias("root")), "to").select("id", "root")
    return formed.join(roots, "id", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = 5, min_count: int = 3, ratio: float = 2.0, slip: int | None = None,
) -> DataFrame:
    """`spelling_forms` of the words of all texts, see `word_counts`: whole texts, rows that repeat count each, other
    columns are not read, words of any length take part, and NULL and empty texts and empty tables have no words."""
    return spelling_forms(word_counts(docs, key, text, min_chars, min_count, slip), ratio)
