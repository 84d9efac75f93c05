"""Benchmark decontamination: phrases of test items found in training texts by a positional inverted index.

Everything here is DataFrame functions. A phrase is a run of words of a test item. Its two rarest words, by their counts
in all training texts, are looked up: the index holds a posting (word, document, position) for each occurrence of these
words, and for the end of each document. The list of the rarest word, shifted by the word's place in the phrase, gives
the places where the phrase may start; the shifted list of the second word thins them out; the words of the few
documents that are left decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segue.llm.hot import ascii_lower, dealt_join, marked
from segue.operators.skew import MANY_ROWS
from segue.session import stash

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Stands for the end of a document in the index; no word holds a space.
END = " "


def words_of(text: Column) -> Column:
    """Words in order, A-Z in lower case; none for NULL."""
    found = F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def documents(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, text): id and hash of the text name a document."""
    return docs.select(F.struct(F.col(key).alias("id"), F.xxhash64(F.col(text)).alias("th")).alias("doc"), F.col(text).alias("text"))


def item_phrases(items: DataFrame, key: str = "item_id", text: str = "text", words: int = 10) -> DataFrame:
    """(item, phrase): each item's runs of `words` consecutive words, joined by spaces; a shorter item is one phrase."""
    split = items.select(F.col(key).cast("string").alias("item"), words_of(F.col(text)).alias("w")).where(F.size("w") > 0)
    starts = F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - (words - 1), F.lit(1)))).alias("at")
    return split.select("item", "w", starts).select("item", F.array_join(F.slice("w", F.col("at"), F.lit(words)), " ").alias("phrase")).distinct()


def rarest_words(docs: DataFrame, phrases: DataFrame, key: str, text: str) -> DataFrame:
    """(phrase, first, second): of each phrase that may occur the two rarest words as (n, word, at); no second for one word.

    All words of all texts are counted. A phrase with a word that no text has cannot occur and is left out.
    """
    counts = docs.select(F.explode(words_of(F.col(text))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    places = phrases.select("phrase", F.posexplode(F.split("phrase", " ")).alias("at", "word"))
    asked = stash(counts.join(places.select("word").distinct(), "word"), "word-counts")
    known = stash(places, "phrase-words").join(asked, "word", "left")
    listed = known.groupBy("phrase").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "at"))).alias("r")  # a phrase's words
    )
    return listed.where("r[0].n > 0").select("phrase", F.get("r", F.lit(0)).alias("first"), F.get("r", F.lit(1)).alias("second"))


def positional_index(docs: DataFrame, words: DataFrame, key: str, text: str) -> DataFrame:
    """(word, doc, at, copies): the postings of `words` and the end of each document; `copies` counts equal rows."""
    listed = words.unionByName(words.sparkSession.range(1).select(F.lit(END).alias("word"))).distinct()
    tokens = documents(docs, key, text).select("doc", F.posexplode(F.concat(words_of(F.col("text")), F.array(F.lit(END)))).alias("at", "word"))
    found = tokens.join(stash(listed, "index-words"), "word")
    return stash(found.groupBy("word", "doc", "at").agg(F.count(F.lit(1)).alias("copies")), "positional-index")


def starts(index: DataFrame, rare: DataFrame, slop: int | None = None) -> DataFrame:
    """(phrase, doc, at): places where both lists agree. Exact: `at` is where the phrase starts. With `slop`: it is a place
    of the rarest word that has the second one at most `slop` words away."""
    postings = index.where(F.col("word") != END).select("word", "doc", F.col("at").alias("p"))
    one = rare.select(F.col("first.word").alias("word"), "phrase", F.col("first.at").alias("at1"), F.col("second").alias("s"))
    led = dealt_join(postings, one, ["word"], rows=MANY_ROWS)
    alone = led.where("s is null").select("phrase", "doc", (F.col("p") - (F.col("at1") if slop is None else 0)).alias("at"))
    led = led.where("s is not null")
    if slop is None:
        led = led.select("phrase", "doc", (F.col("p") - F.col("at1")).alias("at"), F.col("s.word").alias("word"), (F.col("p") - F.col("at1") + F.col("s.at")).alias("p"))
        both = led.where("at >= 0").join(postings, ["word", "doc", "p"])
        return both.select("phrase", "doc", "at").unionByName(alone.where("at >= 0"))
    bins = F.explode(F.sequence(F.floor((F.col("at") - slop) / (slop + 1)), F.floor((F.col("at") + slop) / (slop + 1)))).alias("bin")
    led = led.select("phrase", "doc", F.col("p").alias("at"), F.col("s.word").alias("word")).select("*", bins)
    second = postings.withColumn("bin", F.floor(F.col("p") / (slop + 1)))
    both = led.join(second, ["word", "doc", "bin"]).where(F.abs(F.col("p") - F.col("at")) <= slop)
    return both.select("phrase", "doc", "at").distinct().unionByName(alone)


def checked(docs: DataFrame, places: DataFrame, key: str, text: str, slop: int | None = None) -> DataFrame:
    """(doc, spans, n_hit): the places (at, phrase) that the document's words confirm, and how many words they cover.

    Only documents with a place are read again; a document's places are one row, as its text is.
    """
    by_doc = stash(places.groupBy("doc").agg(F.collect_set(F.struct("at", "phrase")).alias("places")), "phrase-places")
    hashed = by_doc.select(F.col("doc.th").alias("th"))
    rows = documents(docs, key, text).select("doc", "text", F.col("doc.th").alias("th"))
    rows = marked(rows, "th", hashed, by_doc.count()).groupBy("doc").agg(F.first("text").alias("text"))
    held = rows.join(by_doc, "doc")
    asked = lambda x: F.split(x.phrase, " ")

    def true(w: Column, x: Column) -> Column:
        if slop is None:
            return F.slice(w, x.at + 1, F.size(asked(x))) == asked(x)
        first = F.greatest(x.at - slop, F.lit(0))
        return F.size(F.array_except(asked(x), F.slice(w, first + 1, x.at + slop + 1 - first))) == 0

    # the words are held in an array of one, so that a text is split once and not for each place
    spans = F.transform(F.array(words_of(F.col("text"))), lambda w: F.filter("places", lambda x: true(w, x)))[0]
    held = stash(held.select("doc", spans.alias("spans")), "phrase-hits").where(F.size("spans") > 0)
    covered = F.flatten(F.transform("spans", lambda x: F.sequence(x.at, x.at + F.size(asked(x)) - 1)))
    return held.select("doc", "spans", F.size(F.array_distinct(covered)).cast("bigint").alias("n_hit"))


def phrase_matches(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", words: int = 10) -> DataFrame:
    """(key, at, n_words, phrase, item): every place (word number, from 0) where `words` consecutive words of an item stand."""
    return matches(docs, items, key, text, item_key, item_text, words, None)


def proximity_matches(docs: DataFrame, items: DataFrame, slop: int, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", words: int = 10) -> DataFrame:
    """(key, at, n_words, phrase, item): places of a phrase's rarest word (ties by text) that have all its other words,
    in any order, at most `slop` words away."""
    if slop < 1:
        raise ValueError("slop is at least 1")
    return matches(docs, items, key, text, item_key, item_text, words, slop)


def matches(docs: DataFrame, items: DataFrame, key: str, text: str, item_key: str, item_text: str, words: int, slop: int | None) -> DataFrame:
    phrases, _, hits = search(docs, items, key, text, item_key, item_text, words, slop)
    spans = hits.select("doc", F.inline("spans"))
    return dealt_join(spans, phrases, ["phrase"]).select(F.col("doc.id").alias(key), "at", F.size(F.split("phrase", " ")).alias("n_words"), "phrase", "item").distinct()


def search(docs: DataFrame, items: DataFrame, key: str, text: str, item_key: str, item_text: str, words: int, slop: int | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(phrases, index, hits) as written tables."""
    phrases = stash(item_phrases(items, item_key, item_text, words), "phrases")
    rare = stash(rarest_words(docs, phrases.select("phrase").distinct(), key, text), "rarest-words")
    asked = rare.select(F.col("first.word").alias("word")).unionByName(rare.where("second is not null").select(F.col("second.word").alias("word")))
    index = positional_index(docs, asked, key, text)
    return phrases, index, checked(docs, starts(index, rare, slop), key, text, slop)


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", words: int = 10) -> DataFrame:
    """(key, n_words, n_hit, n_items, items_sha256, contaminated) for each row of `docs`.

    A word is a run of letters, digits and characters beyond ASCII, with A-Z in lower case. A word is hit if it lies in
    an occurrence of `words` consecutive words of an item, or of all words of an item that has fewer. n_items counts the
    items that occur with such a run, items_sha256 is of their ids, sorted as text and joined by commas.

    NULL and empty texts have no words, items without words cannot occur. Rows that repeat a key are documents of their
    own, equal rows count each, NULL keys are kept. Items that repeat an id are one item with the phrases of all of them;
    an item without id marks words but is not named. Other columns are not read. Empty tables of documents give no rows,
    of items no hits.
    """
    phrases, index, hits = search(docs, items, key, text, item_key, item_text, words, None)
    spans = hits.select("doc", F.explode(F.array_distinct("spans.phrase")).alias("phrase"))
    named = dealt_join(stash(spans, "hit-phrases"), phrases.where("item is not null"), ["phrase"], rows=MANY_ROWS)
    listed = named.groupBy("doc").agg(F.array_sort(F.collect_set("item")).alias("items"))
    listed = listed.select("doc", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    ends = index.where(F.col("word") == END).select("doc", F.col("at").cast("bigint").alias("n_words"), "copies")
    joined = ends.join(hits.select("doc", "n_hit"), "doc", "left").join(listed, "doc", "left")
    # equal rows again: runs of them are dealt over the tasks
    run = 100_000
    runs = joined.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(copies - 1) div {run}"))).alias("run"))
    runs = runs.repartition("doc", "run")
    runs = runs.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.least(F.lit(run), F.col("copies") - F.col("run") * run))))
    n_hit = F.coalesce("n_hit", F.lit(0))
    return runs.select(
        F.col("doc.id").alias(key), "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )
