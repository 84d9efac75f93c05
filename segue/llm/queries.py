"""The registered queries of this subpackage: each operator over its whole table, with its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segue.llm import (
    bpe, decontamination, grid_order, hamming_search, hard_negatives, line_dedup, mixing, quality, simhash, spelling, suffix_dedup,
    token_counts, token_files,
)
from segue.session import scratch_path, ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(run: Callable[[SparkSession, str], DataFrame]):
        def shipped(spark: SparkSession, sf: str) -> DataFrame:
            ship_package(spark)
            return run(spark, sf)

        QUERIES[name] = shipped
        if sql:
            SQL[name] = sql
        return shipped

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def byte_bpe() -> str:
    """Where the public byte-level vocabulary lies; every machine has the package."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# 2^52, and Poisson terms up to 42 for the rates of the given sources, which stay far below 4
MIXING_SQL = """
WITH counts AS (SELECT source, count(*)::DOUBLE AS n FROM documents GROUP BY source),
weighted AS (SELECT source, n, pow(n / max(n) OVER (), 0.5) AS weight FROM counts),
rates AS (SELECT source, sum(n) OVER () * (weight / sum(weight) OVER ()) / n AS mean FROM weighted),
terms AS (
  SELECT source, k, exp(-mean) * list_product([mean / i FOR i IN range(1, k + 1)] || [1.0::DOUBLE]) AS term
  FROM rates, range(0, 60) r(k)),
levels AS (SELECT source, k, sum(term) OVER (PARTITION BY source ORDER BY k) AS below FROM terms),
drawn AS (
  SELECT *, ('0x' || substr(md5('42-' || coalesce(doc_id::VARCHAR, 'null-' || md5(coalesce(text, '')))), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM documents),
counted AS (
  SELECT d.*, (SELECT count(*) FROM levels l WHERE l.source IS NOT DISTINCT FROM d.source AND l.below <= d.u) AS n FROM drawn d)
SELECT doc_id, text, lang, source, n_chars, unnest(range(1, n + 1))::INTEGER AS copy FROM counted
"""


@query("op3_poisson_mixing", MIXING_SQL)
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf, "documents"))


@query("op5_token_counts")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.limit_table(token_counts.length_histogram(table(spark, sf, "documents"), byte_bpe()))


@query("op8_token_files")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf, "documents"), path, byte_bpe())
    return token_files.id_digests(token_files.read_token_files(spark, path))


@query("op10_bpe_words")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.encoding_digests(bpe.encode_decode(table(spark, sf, "documents"), byte_bpe()))


@query("op9_factorization_quality")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = quality.train(docs, labels, metadata=["n_chars"])
    return quality.classify(docs, model, metadata=["n_chars"])


@query("op6_simhash_vantage")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf, "documents"))


CODES_SQL = """
WITH codes AS (
  SELECT vec_id AS id, list_reduce([0::UBIGINT] || [CASE WHEN embedding[i] > 0 THEN (1::UBIGINT << (i - 1)) ELSE 0::UBIGINT END
    FOR i IN range(1, 65)], lambda a, b: a | b) AS code FROM embeddings WHERE embedding IS NOT NULL),
ranked AS (
  SELECT q.id AS query_id, r.id AS neighbor_id, bit_count(xor(q.code, r.code))::BIGINT AS distance,
         row_number() OVER (PARTITION BY q.id ORDER BY bit_count(xor(q.code, r.code)), r.id)::INTEGER AS rank
  FROM codes q JOIN codes r ON q.id <> r.id WHERE q.id % 100 = 0)
SELECT query_id, rank, neighbor_id, distance FROM ranked WHERE rank <= 10
"""


@query("op7_multi_index_hashing", CODES_SQL)
def op7(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings")
    codes = vectors.select(F.col("vec_id").alias("id"), hamming_search.sign_code(F.col("embedding")).alias("code"))
    return hamming_search.hamming_top_k(codes, codes.where("id % 100 = 0"), k=10)


LINKED_SQL = """
WITH RECURSIVE vectors AS (SELECT vec_id, embedding::DOUBLE[] AS v, list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) AS square FROM embeddings),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id
  WHERE list_dot_product(a.v, b.v) / sqrt(a.square * b.square) >= 0.9),
reached AS (SELECT vec_id AS a, vec_id AS c FROM vectors UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.c = l.a),
least AS (SELECT a, min(c) AS component_id FROM reached GROUP BY 1),
counted AS (SELECT a, count(*) AS n_links FROM links GROUP BY 1)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM vectors JOIN least ON vec_id = least.a LEFT JOIN counted ON vec_id = counted.a
"""


@query("op4_grid_order_embeddings", LINKED_SQL)
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return grid_order.link_embeddings(table(spark, sf, "embeddings"))


NEAR_LINES_SQL = """
raw AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS no
        FROM documents WHERE text IS NOT NULL),
lines AS (SELECT doc_id, no, raw, trim(raw, ' ' || chr(9) || chr(13) || chr(12) || chr(11)) AS line FROM raw),
firsts AS (SELECT line, length(line) AS n, min({'d': doc_id, 'no': no}) AS place FROM lines WHERE line <> '' GROUP BY line),
halves AS (
  SELECT DISTINCT line, n, place, side || CASE side WHEN 'l' THEN left(line, (n + more) // 2) ELSE right(line, (n + more) // 2) END AS k
  FROM firsts, (VALUES ('l'), ('r')) s(side), (VALUES (0), (1)) e(more)),
pairs AS (
  SELECT DISTINCT a.line AS line, b.line AS other, a.n AS n, b.n AS m FROM halves a JOIN halves b USING (k)
  WHERE b.place < a.place AND abs(a.n - b.n) <= 1),
near AS (
  SELECT DISTINCT line FROM pairs
  WHERE len(list_filter(range(0, greatest(n, m)), lambda i: left(line, i) = left(other, i)
    AND right(line, greatest(0, n - i - (n >= m)::INT)) = right(other, greatest(0, m - i - (m >= n)::INT)))) > 0),
kept AS (
  SELECT l.doc_id, l.no FROM lines l JOIN firsts f ON l.line = f.line AND f.place = {'d': l.doc_id, 'no': l.no}
  WHERE l.line NOT IN (SELECT line FROM near)),
left_over AS (
  SELECT l.doc_id, string_agg(l.raw, chr(10) ORDER BY l.no) AS text, count(*) AS n FROM lines l
  LEFT JOIN kept k USING (doc_id, no) WHERE l.line = '' OR k.no IS NOT NULL GROUP BY 1),
totals AS (SELECT doc_id, count(*) AS n_lines FROM raw GROUP BY 1)
"""

LINE_DEDUP_SQL = "WITH " + NEAR_LINES_SQL + """
SELECT t.doc_id, t.n_lines::INTEGER AS n_lines, (t.n_lines - coalesce(o.n, 0))::INTEGER AS n_removed, coalesce(o.text, '') AS text
FROM totals t LEFT JOIN left_over o USING (doc_id)
"""


@query("op1_line_dedup", LINE_DEDUP_SQL)
def op1(spark: SparkSession, sf: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf, "documents"), report=True, min_chars=1)


@query("op2_suffix_dedup")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    left = suffix_dedup.remove_repeats(table(spark, sf, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


LOWER_SQL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
PHRASE_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all({LOWER_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all({LOWER_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
starts AS (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM b WHERE len(w) > 0),
phrases AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[k : k + 9], ' ') AS phrase FROM starts),
places AS (SELECT doc_id, w, n, unnest(range(1, greatest(len(w) - n + 2, 1))) AS k FROM d, (SELECT DISTINCT n FROM phrases)),
runs AS (SELECT doc_id, n, k, array_to_string(w[k : k + n - 1], ' ') AS phrase FROM places),
found AS (SELECT r.* FROM runs r SEMI JOIN phrases p ON r.n = p.n AND r.phrase = p.phrase),
covered AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS i FROM found) GROUP BY 1),
items AS (SELECT DISTINCT f.doc_id, p.item FROM found f JOIN phrases p ON f.n = p.n AND f.phrase = p.phrase),
named AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256 FROM items GROUP BY 1)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query("op11_positional_decontamination", PHRASE_SQL)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


NEGATIVES_SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
ranked AS (
  SELECT anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank
  FROM positives JOIN scored USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""


@query("op12_rotated_code_negatives", NEGATIVES_SQL)
def op12(spark: SparkSession, sf: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf, "embeddings").withColumn("label", moved)
    return hard_negatives.hard_negatives(vectors, "vec_id % 100 = 0")


# The table of the checksum is made by its rule; 3988292384 is its fixed polynomial, 4294967295 its start.
SPELLING_SQL = rf"""
WITH RECURSIVE steps AS (
  SELECT list(list_reduce([i] || range(8), lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) ORDER BY i) AS t
  FROM range(256) r(i)),
runs AS (SELECT doc_id, unnest(regexp_extract_all({LOWER_SQL}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
occurring AS (SELECT doc_id, run, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS bytes FROM runs GROUP BY 1, 2),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    [4294967295] || list_transform(range(0, length(bytes) // 2), lambda i: ('0x' || substr(bytes, 2 * i + 1, 2))::BIGINT),
    lambda a, b: xor(a // 256, t[xor(a, b) % 256 + 1]))) AS h
  FROM occurring, steps),
spoilt AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM spoilt GROUP BY 1 HAVING sum(n) >= 3 AND length(word) >= 5),
less AS (SELECT word, n, unnest(range(0, length(word))) AS i FROM words),
cuts AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM less),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS m FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND length(a.word) = length(b.word) WHERE a.word <> b.word
  UNION SELECT DISTINCT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
  UNION SELECT DISTINCT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word),
ranked AS (SELECT word, other, m, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY m DESC, other) AS r FROM near),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN m >= 2 * n THEN other END AS form, CASE WHEN m >= 2 * n THEN m END AS form_n
  FROM words w LEFT JOIN ranked k ON w.word = k.word AND k.r = 1),
walked AS (
  SELECT word, word AS root, form AS ahead FROM formed
  UNION ALL SELECT w.word, f.word, f.form FROM walked w JOIN formed f ON w.ahead = f.word)
SELECT f.word, f.form, w.root, f.n, f.n_near, f.form_n FROM formed f JOIN walked w ON f.word = w.word AND w.ahead IS NULL
"""


@query("op13_trie_spelling", SPELLING_SQL)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf, "documents"), slip=97)
