"""Queries on model inputs: buckets, hashes, vocabularies, text ids, pooling and normalization."""

from __future__ import annotations

from pyspark.sql import functions as F

from segue.functions import scalars as C
from segue.functions import text as X
from segue.functions import vectors as V
from segue.operators import vocab
from segue.operators import sequence as S
from segue.operators.retrieval import embedding_lookup
from segue.operators.towers import Feature, TowerFeatures, TowerModel
from segue.plans import lists
from segue.plans import tables as t
from segue.plans.basics import md5_sql
from segue.plans.lists import EXAMPLES_SQL, HIST, N
from segue.plans.registry import query
from segue.plans.tables import ITEMS, sql_micro
from segue.session import scratch_path, stash

# The largest value of each bucketed feature.
BUCKET_MAX = {
    "pl_duration_ms": 635_073_792, "num_pl_songs": 376, "num_pl_artists": 238, "num_pl_albums": 244,
    "track_duration_ms": 20_744_575, "pop": 100, "followers": 94_437_255, "audio": 1, "loudness": 5, "tempo": 250,
}
# The number of bins of each hashed feature.
HASH_BINS = {
    "track": 2_249_561, "artist": 295_860, "album_query": 730_377, "album_candidate": 734_684, "key": 12, "mode": 3,
    "time_signature": 6, "collaborative": 3,
}


def _at_most(x: str, high: float) -> str:
    return f"CAST(len(list_filter(list_transform(range(0, 20), lambda i: {high}::DOUBLE * i / 19), lambda b: b <= {x})) AS INTEGER)"


@query(
    "discretize",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, {_at_most('l_quantity', 100)} AS pop, {_at_most('l_extendedprice * 1000', 94437255)} AS followers,
      {_at_most('l_discount', 1)} AS audio, {_at_most('-l_quantity', 5)} AS loudness, {_at_most('l_quantity * 6', 250)} AS tempo FROM lineitem""",
)
def _(spark, sf):
    return t.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", C.bucketize("l_quantity", BUCKET_MAX["pop"]).alias("pop"),
        C.bucketize(F.col("l_extendedprice") * 1000, BUCKET_MAX["followers"]).alias("followers"),
        C.bucketize("l_discount", BUCKET_MAX["audio"]).alias("audio"), C.bucketize(-F.col("l_quantity"), BUCKET_MAX["loudness"]).alias("loudness"),
        C.bucketize(F.col("l_quantity") * 6, BUCKET_MAX["tempo"]).alias("tempo"),
    )


@query(
    "hash_bins",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, {md5_sql('l_partkey')} % 2249561 AS track_bin, {md5_sql('l_suppkey')} % 295860 AS artist_bin,
      {md5_sql('l_linenumber')} % 12 AS key_bin, {md5_sql('l_returnflag')} % 3 AS mode_bin FROM lineitem""",
)
def _(spark, sf):
    bins = {"track_bin": ("l_partkey", "track"), "artist_bin": ("l_suppkey", "artist"), "key_bin": ("l_linenumber", "key"), "mode_bin": ("l_returnflag", "mode")}
    hashed = [C.hash_bin(c, HASH_BINS[kind], portable=True).alias(name) for name, (c, kind) in bins.items()]
    return t.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", *hashed)


@query(
    "hash_bins_masked",
    f"""WITH d AS (SELECT doc_id, CASE WHEN lang = 'en' THEN '' ELSE source END AS v FROM documents)
    SELECT doc_id, CASE WHEN v = '' THEN 0 ELSE 1 + {md5_sql('v')} % 2249560 END AS bin FROM d""",
)
def _(spark, sf):
    value = F.when(F.col("lang") == "en", "").otherwise(F.col("source"))
    return t.table(spark, sf, "documents").select("doc_id", C.hash_bin(value, HASH_BINS["track"], mask="", portable=True).alias("bin"))


@query(
    "string_lookup",
    """WITH v AS (SELECT p_name, CAST(row_number() OVER (ORDER BY p_name) AS INTEGER) AS idx FROM (SELECT DISTINCT p_name FROM part WHERE p_size > 40))
    SELECT p_partkey, part.p_name, coalesce(idx, 0) AS name_idx FROM part LEFT JOIN v ON part.p_name = v.p_name""",
)
def _(spark, sf):
    part = t.table(spark, sf, "part")
    names = vocab.unique_values(part.where("p_size > 40"), "p_name", start=1)
    found = vocab.string_lookup(part.select("p_partkey", "p_name"), "p_name", names, "p_name", "idx", "name_idx")
    return found.withColumn("name_idx", F.col("name_idx").cast("int"))


PUNCT = r"""[!"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~'']"""
LOWER = "translate({c}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def sql_words(column: str) -> str:
    cleaned = f"regexp_replace({LOWER.format(c=column)}, '{PUNCT}', '', 'g')"
    return f"list_filter(regexp_split_to_array({cleaned}, '[ \\t\\n\\r]+'), lambda w: w <> '')"


def sql_grams(words: str) -> str:
    return f"list_concat({words}, list_transform(range(1, len({words})), lambda i: {words}[i] || ' ' || {words}[i + 1]))"


DOC_GRAMS = f"""words AS (SELECT doc_id, lang, source, {sql_words('text')} AS w FROM documents),
grams AS (SELECT doc_id, lang, source, {sql_grams('w')} AS g FROM words)"""


def _doc_counts(spark, sf):
    return vocab.count_ngrams(t.spread_table(spark, sf, "documents"), ["text"])


@query(
    "ngram_vocab_count",
    f"WITH {DOC_GRAMS}, u AS (SELECT unnest(g) AS token FROM grams) SELECT 'text' AS feature, token, CAST(count(*) AS BIGINT) AS n FROM u GROUP BY token",
)
def _(spark, sf):
    return _doc_counts(spark, sf)


@query(
    "topk_tokens",
    f"""WITH {DOC_GRAMS}, u AS (SELECT unnest(g) AS token FROM grams)
    SELECT 'text' AS feature, token, CAST(count(*) AS BIGINT) AS n FROM u GROUP BY token ORDER BY n DESC, token LIMIT 20000""",
)
def _(spark, sf):
    return _doc_counts(spark, sf).orderBy(F.desc("n"), F.asc("token")).limit(vocab.MAX_TOKENS)


FEATURE_TEXTS = f"""texts AS (
  SELECT 'text' AS feature, text FROM conversations UNION ALL SELECT 'role', role FROM conversations
  UNION ALL SELECT 'parts', unnest(string_split(text, chr(10))) FROM conversations),
words AS (SELECT feature, {sql_words('text')} AS w FROM texts),
tokens AS (SELECT feature, unnest({sql_grams('w')}) AS token FROM words)"""


def sql_vocab(source: str, k: int) -> str:
    return f"""SELECT feature, token, n, CAST(r + 1 AS INTEGER) AS idx FROM (
      SELECT feature, token, CAST(count(*) AS BIGINT) AS n, row_number() OVER (PARTITION BY feature ORDER BY count(*) DESC, token) AS r
      FROM {source} GROUP BY feature, token) WHERE r <= {k - 2}"""


@query("vocab_adapt", f"WITH {FEATURE_TEXTS} {sql_vocab('tokens', 20000)}")
def _(spark, sf):
    rows = t.spread_table(spark, sf, "conversations").withColumn("parts", F.split("text", "\n"))
    return vocab.fit_vocab(rows, ["text", "role", "parts"])


NAME_VOCAB = f"""name_words AS (SELECT p_partkey, {sql_words('p_name')} AS w FROM part),
name_tokens AS (SELECT 'p_name' AS feature, unnest({sql_grams('w')}) AS token FROM name_words),
vocab AS ({sql_vocab('name_tokens', 50)})"""


@query(
    "text_vectorize_fixed",
    f"""WITH {NAME_VOCAB}, g AS (SELECT p_partkey, {sql_grams('w')} AS g FROM name_words),
    u AS (SELECT p_partkey, i, g[i] AS token FROM g, range(1, 10) r(i) WHERE i <= len(g))
    SELECT p_partkey, string_agg(CAST(coalesce(idx, 1) AS VARCHAR), ',' ORDER BY i) AS ids FROM u LEFT JOIN vocab ON u.token = vocab.token GROUP BY 1""",
)
def _(spark, sf):
    part = t.table(spark, sf, "part")
    learnt = vocab.fit_vocab(part, ["p_name"], max_tokens=50)
    rows = vocab.vectorize_text(part.select("p_partkey", "p_name"), ["p_partkey"], learnt, {"p_name": "ids"})
    return rows.select("p_partkey", t.text_of("ids").alias("ids"))


@query(
    "text_vectorize_ragged",
    f"""WITH {ITEMS}, {NAME_VOCAB}, h AS (SELECT pid, pos, list(track_id) {HIST} AS track_pl FROM items),
    ids AS (
      SELECT p_partkey, string_agg(CAST(coalesce(idx, 1) AS VARCHAR), ',' ORDER BY i) AS ids FROM (
        SELECT p_partkey, i, g[i] AS token FROM (SELECT p_partkey, {sql_grams('w')} AS g FROM name_words), range(1, 10) r(i) WHERE i <= len(g)) u
      LEFT JOIN vocab ON u.token = vocab.token GROUP BY 1),
    f AS (SELECT pid, pos, j, track_pl[j] AS track_id FROM h, range(1, {N} + 1) q(j) WHERE len(track_pl) = {N})
    SELECT pid, pos, string_agg(ids, '|' ORDER BY j) AS ids FROM f JOIN ids ON f.track_id = p_partkey GROUP BY 1, 2""",
)
def _(spark, sf):
    part = t.table(spark, sf, "part")
    learnt = vocab.fit_vocab(part, ["p_name"], max_tokens=50).withColumn("feature", F.lit("names"))
    rows = S.fan_out(t.item_lists(spark, sf, t.names(spark, sf)), {"names": "p_name"}, N)
    ids = vocab.vectorize_text(rows.where(F.size("names") == N).select("pid", "pos", "names"), ["pid", "pos"], learnt, {"names": "ids"})
    return ids.select("pid", "pos", F.array_join(F.transform("ids", t.text_of), "|").alias("ids"))


@query(
    "merge_vocabs",
    f"""WITH {FEATURE_TEXTS}, a AS ({sql_vocab('tokens', 20000)}), {DOC_GRAMS.replace('words AS', 'dwords AS').replace('FROM words', 'FROM dwords')},
    b AS ({sql_vocab("(SELECT 'text' AS feature, unnest(g) AS token FROM grams)", 10000)})
    SELECT * FROM a WHERE feature NOT IN (SELECT feature FROM b) UNION ALL SELECT * FROM b""",
)
def _(spark, sf):
    rows = t.spread_table(spark, sf, "conversations").withColumn("parts", F.split("text", "\n"))
    first = vocab.fit_vocab(rows, ["text", "role", "parts"])
    second = vocab.fit_vocab(t.spread_table(spark, sf, "documents"), ["text"], max_tokens=10_000)
    return vocab.merge_vocabs(first, second)


@query(
    "vocab_coverage",
    f"""WITH {DOC_GRAMS}, u AS (SELECT lang, unnest(g) AS token FROM grams),
    a AS (SELECT DISTINCT token FROM u WHERE lang = 'en'), b AS (SELECT DISTINCT token FROM u WHERE lang <> 'en')
    SELECT 'text' AS feature, (SELECT count(*) FROM a) AS n_a, (SELECT count(*) FROM b) AS n_b, (SELECT count(*) FROM a JOIN b USING (token)) AS n_both""",
)
def _(spark, sf):
    documents = t.spread_table(spark, sf, "documents")
    english = vocab.count_ngrams(documents.where("lang = 'en'"), ["text"])
    return vocab.compare_vocabs(english, vocab.count_ngrams(documents.where("lang <> 'en'"), ["text"]))


@query(
    "normalize_zscore",
    f"""WITH m AS (SELECT avg(l_extendedprice) AS mu, var_pop(l_extendedprice) AS va FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, round((l_extendedprice - mu) / sqrt(va), 6) AS z FROM lineitem, m""",
)
def _(spark, sf):
    lines = t.table(spark, sf, "lineitem")
    stats = lines.agg(F.avg("l_extendedprice").alias("mean"), F.var_pop("l_extendedprice").alias("var")).first()
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", F.round(V.zscore("l_extendedprice", stats["mean"], stats["var"]), 6).alias("z"))


@query(
    "normalize_zscore_array",
    f"SELECT vec_id, {sql_micro('list_transform(embedding, lambda x: (x::DOUBLE - 0.01) / sqrt(0.02))')} AS z FROM embeddings",
)
def _(spark, sf):
    return t.table(spark, sf, "embeddings").select("vec_id", t.micro_text(V.zscore("embedding", 0.01, 0.02, array=True)).alias("z"))


@query("pool_mean_1d", f"WITH {ITEMS}, h AS (SELECT pid, pos, list(duration) {HIST} AS d FROM items) SELECT pid, pos, round(list_avg(d), 6) AS duration_mean FROM h WHERE len(d) > 0")
def _(spark, sf):
    rows = S.fan_out(t.item_lists(spark, sf), {"d": "duration"}, N)
    return rows.where(F.size("d") > 0).select("pid", "pos", F.round(V.mean("d"), 6).alias("duration_mean"))


@query(
    "pool_mean_2d",
    f"""WITH g AS (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda s: {sql_words('s')}) AS w FROM documents),
    f AS (SELECT doc_id, list_transform(flatten(w), lambda x: length(x)::DOUBLE) AS v FROM g)
    SELECT doc_id, round(list_avg(v), 6) AS mean_length FROM f WHERE len(v) > 0""",
)
def _(spark, sf):
    lines = F.transform(F.split("text", "\n"), lambda s: F.transform(X.tokens(s), lambda w: F.length(w).cast("double")))
    pooled = t.spread_table(spark, sf, "documents").select("doc_id", F.round(V.mean_nested(lines), 6).alias("mean_length"))
    return pooled.where("mean_length IS NOT NULL")


@query(
    "embedding_lookup",
    f"SELECT l_orderkey, l_linenumber, l_partkey, {sql_micro('list_slice(embedding, 1, 4)')} AS head FROM lineitem LEFT JOIN embeddings ON l_partkey = vec_id",
)
def _(spark, sf):
    vectors = t.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.slice("embedding", 1, 4).cast("array<double>").alias("embedding"))
    rows = embedding_lookup(t.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), "l_partkey", vectors, "vector")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", t.micro_text("vector").alias("head"))


@query(
    "concat_features",
    f"SELECT vec_id, {sql_micro('list_concat([label::DOUBLE, vec_id::DOUBLE], list_transform(embedding, lambda x: x::DOUBLE))')} AS features FROM embeddings",
)
def _(spark, sf):
    head = F.array(F.col("label").cast("double"), F.col("vec_id").cast("double"))
    features = V.concat_features(head, F.col("embedding").cast("array<double>"))
    return t.table(spark, sf, "embeddings").select("vec_id", t.micro_text(features).alias("features"))


AUDIO = ["danceability", "energy", "speechiness", "acousticness", "instrumentalness", "liveness", "valence"]


def _audio(suffix: str, listed: bool) -> list[Feature]:
    codes = [Feature(f"track_{c}_{suffix}", "hash", HASH_BINS[c], listed) for c in ("key", "mode", "time_signature")]
    reals = [Feature(f"track_{c}_{suffix}", "bucket", BUCKET_MAX["audio"], listed) for c in AUDIO]
    return [*codes, *reals, *[Feature(f"track_{c}_{suffix}", "bucket", BUCKET_MAX[c], listed) for c in ("loudness", "tempo")]]


def _entities(suffix: str, listed: bool, album: str, duration: str, followers: str) -> list[Feature]:
    return [
        Feature(f"track_uri_{suffix}", "hash", HASH_BINS["track"], listed), Feature(f"artist_uri_{suffix}", "hash", HASH_BINS["artist"], listed),
        Feature(f"album_uri_{suffix}", "hash", HASH_BINS[album], listed), Feature(f"track_name_{suffix}", "text", listed=listed),
        Feature(f"{duration}_{suffix}", "bucket", BUCKET_MAX["track_duration_ms"], listed), Feature(f"track_pop_{suffix}", "bucket", BUCKET_MAX["pop"], listed),
        Feature(f"artist_pop_{suffix}", "bucket", BUCKET_MAX["pop"], listed), Feature(f"{followers}_{suffix}", "bucket", BUCKET_MAX["followers"], listed),
    ]


CANDIDATE_TOWER = [*_entities("can", False, "album_candidate", "duration_ms", "artist_followers"), *_audio("can", False)]
QUERY_TOWER = [
    Feature("pl_name_src", "text"), Feature("pl_collaborative_src", "hash", HASH_BINS["collaborative"]),
    Feature("pl_duration_ms_new", "bucket", BUCKET_MAX["pl_duration_ms"]), Feature("num_pl_songs_new", "bucket", BUCKET_MAX["num_pl_songs"]),
    Feature("num_pl_artists_new", "bucket", BUCKET_MAX["num_pl_artists"]), Feature("num_pl_albums_new", "bucket", BUCKET_MAX["num_pl_albums"]),
    *_entities("pl", True, "album_query", "duration_ms_songs", "artists_followers"), *_audio("pl", True),
]
TOWER_DIMS, TOWER_TOKENS = 4, 50


def sql_tower(features: list[Feature]) -> str:
    """The same vector in SQL, over the columns of EXAMPLES_SQL."""
    signs = "list_transform(range(0, {d}), lambda j: {one})"
    bit = lambda salt, id_: f"(1.0::DOUBLE - 2 * (({md5_sql(f"'{salt}-' || {id_}")} >> j) & 1))"
    place = lambda x, high: f"(CASE WHEN {x} < 0 THEN 0 WHEN {x} >= {high} THEN 20 ELSE floor(19 * {x} / {high}) + 1 END / 20.0::DOUBLE)"
    parts, texts, vocabs = [], [], []
    for f in features:
        c = f.column
        if f.kind == "text":
            held = f"SELECT '{c}' AS feature, pid, pos, {f'unnest({c})' if f.listed else c} AS text FROM x"
            vocabs.append(held)
            texts.append(c)
            parts.append(f"coalesce((SELECT v FROM pooled p WHERE p.feature = '{c}' AND p.pid = x.pid AND p.pos = x.pos), list_transform(range(0, {TOWER_DIMS}), lambda j: 0.0::DOUBLE))")
        elif f.kind == "hash":
            one = lambda x, f=f: bit(f.column, f"({md5_sql(x)} % {int(f.size)})")
            parts.append(signs.format(d=TOWER_DIMS, one=f"list_avg(list_transform({c}, lambda e: {one('e')}))" if f.listed else one(c)))
        else:
            parts.append(f"[list_avg(list_transform({c}, lambda e: {place('e', f.size)}))]" if f.listed else f"[{place(c, f.size)}]")
    return f"""WITH {EXAMPLES_SQL},
    texts AS ({' UNION ALL '.join(vocabs)}),
    words AS (SELECT feature, pid, pos, {sql_words('text')} AS w FROM texts),
    tokens AS (SELECT feature, pid, pos, unnest({sql_grams('w')}) AS token FROM words),
    vocab AS ({sql_vocab('tokens', TOWER_TOKENS)}),
    ids AS (SELECT t.feature, pid, pos, coalesce(idx, 1) AS id FROM tokens t LEFT JOIN vocab v ON t.feature = v.feature AND t.token = v.token),
    hashed AS (SELECT feature, pid, pos, {md5_sql("feature || '-' || id")} AS h FROM ids),
    pooled AS (SELECT feature, pid, pos, [{', '.join(f'avg(1.0::DOUBLE - 2 * ((h >> {j}) & 1))' for j in range(TOWER_DIMS))}] AS v FROM hashed GROUP BY 1, 2, 3)
    SELECT pid, pos, {sql_micro('flatten([' + ', '.join(parts) + '])')} AS features FROM x"""


def _tower(spark, sf, features):
    rows = stash(lists.rank_examples(spark, sf).select("pid", "pos", *[f.column for f in features]), "tower-rows")
    path = scratch_path(spark, "tower")
    TowerFeatures(features, ["pid", "pos"], TOWER_DIMS, TOWER_TOKENS).fit(rows).save(path)
    return TowerModel.load(spark, path).transform(rows).select("pid", "pos", t.micro_text("features").alias("features"))


@query("tower_features_candidate", sql_tower(CANDIDATE_TOWER))
def _(spark, sf):
    return _tower(spark, sf, CANDIDATE_TOWER)


@query("tower_features_query", sql_tower(QUERY_TOWER))
def _(spark, sf):
    return _tower(spark, sf, QUERY_TOWER)


SCALED = "list_transform(embedding, lambda x: x::DOUBLE * (label + 2))"


@query(
    "l2_normalize",
    f"""WITH s AS (SELECT vec_id, {SCALED} AS v FROM embeddings), n AS (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS l FROM s)
    SELECT vec_id, {sql_micro('list_transform(v, lambda x: x / l)')} AS unit FROM n""",
)
def _(spark, sf):
    scaled = F.transform("embedding", lambda x: x.cast("double") * (F.col("label") + 2))
    return t.table(spark, sf, "embeddings").select("vec_id", scaled.alias("v")).select("vec_id", t.micro_text(V.l2_normalize("v")).alias("unit"))


@query(
    "layer_norm",
    f"""WITH s AS (SELECT vec_id, {SCALED} AS v FROM embeddings), m AS (SELECT vec_id, v, list_avg(v) AS mu FROM s),
    q AS (SELECT vec_id, v, mu, list_avg(list_transform(v, lambda x: (x - mu) * (x - mu))) AS va FROM m)
    SELECT vec_id, {sql_micro('list_transform(v, lambda x: (x - mu) / sqrt(va + 0.001))')} AS normed FROM q""",
)
def _(spark, sf):
    scaled = F.transform("embedding", lambda x: x.cast("double") * (F.col("label") + 2))
    return t.table(spark, sf, "embeddings").select("vec_id", scaled.alias("v")).select("vec_id", t.micro_text(V.layer_norm("v")).alias("normed"))

