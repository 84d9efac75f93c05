"""Queries on single operators: scans, projections, scalars, set operations, limits, splits and joins by key."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from segue.functions import scalars as C
from segue.operators import enrich, sampling
from segue.operators.retrieval import interpret
from segue.operators.skew import dense_index, top_per_group
from segue.plans import tables as t
from segue.plans.registry import query
from segue.sources import slices
from segue.sources.tables import shards_of

MD5 = "CAST(('0x' || substr(md5(CAST({c} AS VARCHAR)), 1, 15)) AS BIGINT)"


def md5_sql(column: str) -> str:
    return MD5.format(c=column)


@query("scan_table", "SELECT * FROM lineitem")
def _(spark, sf):
    return t.table(spark, sf, "lineitem")


@query("project_except", "SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_returnflag, l_shipdate FROM lineitem")
def _(spark, sf):
    return t.table(spark, sf, "lineitem").drop("l_suppkey", "l_extendedprice", "l_discount", "l_tax", "l_linestatus")


@query(
    "filter_keyed_read",
    "SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R')",
)
def _(spark, sf):
    wanted = t.table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_partkey").alias("p_partkey"))
    return t.table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice").join(wanted, "p_partkey", "left_semi")


@query("semi_join_known", "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def _(spark, sf):
    known = t.table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return t.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal").join(known, "c_custkey", "left_semi")


@query(
    "anti_join_resume",
    """SELECT DISTINCT l_partkey AS track_id FROM lineitem
    WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_retailprice < 950 AND p_partkey IS NOT NULL)""",
)
def _(spark, sf):
    done = t.table(spark, sf, "part").where("p_retailprice < 950").select(F.col("p_partkey").alias("track_id"))
    return enrich.missing_keys(t.table(spark, sf, "lineitem").select(F.col("l_partkey").alias("track_id")), done, "track_id")


@query("except_keys", "SELECT o_custkey AS key FROM orders WHERE o_orderpriority = '1-URGENT' EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '5-LOW'")
def _(spark, sf):
    orders = t.table(spark, sf, "orders")
    key = F.col("o_custkey").alias("key")
    return orders.where("o_orderpriority = '1-URGENT'").select(key).subtract(orders.where("o_orderpriority = '5-LOW'").select(key))


@query("distinct_keys", "SELECT DISTINCT l_suppkey AS artist_id FROM lineitem")
def _(spark, sf):
    return t.table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("artist_id")).distinct()


@query("dedup_features", "SELECT l_partkey, l_suppkey, l_orderkey, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey, l_linenumber, l_suppkey, l_quantity) AS r FROM lineitem) WHERE r = 1")
def _(spark, sf):
    lines = t.table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    order = [F.desc("l_shipdate"), "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity"]
    return enrich.one_per_key(lines, "l_partkey", order).select("l_partkey", "l_suppkey", "l_orderkey", "l_quantity")


@query("dedup_feature_rows", "SELECT DISTINCT p_name, p_brand, p_type, p_size FROM part")
def _(spark, sf):
    return enrich.distinct_rows(t.table(spark, sf, "part").select("p_name", "p_brand", "p_type", "p_size"))


@query(
    "union_batches",
    """SELECT CAST(l_partkey AS BIGINT) AS key, l_quantity AS value, 'line' AS batch FROM lineitem
    UNION ALL SELECT p_partkey, p_retailprice, 'part' FROM part UNION ALL SELECT s_suppkey, s_acctbal, 'supplier' FROM supplier""",
)
def _(spark, sf):
    lines = t.table(spark, sf, "lineitem").select(F.col("l_partkey").alias("key"), F.col("l_quantity").alias("value"), F.lit("line").alias("batch"))
    part = t.table(spark, sf, "part").select(F.col("p_retailprice").alias("value"), F.col("p_partkey").alias("key"), F.lit("part").alias("batch"))
    supplier = t.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("value"), F.lit("supplier").alias("batch"))
    return lines.unionByName(part).unionByName(supplier)


@query("limit_preview", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def _(spark, sf):
    orders = t.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(5)


@query("skip_take", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 500 OFFSET 100")
def _(spark, sf):
    return sampling.skip_take(t.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey", 100, 500)


@query(
    "take_n_stats",
    """SELECT CAST(count(*) AS BIGINT) AS n, round(avg(value), 6) AS value_mean, round(stddev_pop(value), 6) AS value_std
    FROM (SELECT value FROM events ORDER BY event_id LIMIT 5000)""",
)
def _(spark, sf):
    first = t.table(spark, sf, "events").select("event_id", "value").orderBy("event_id").limit(5000)
    return first.agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("value_mean"), F.round(F.stddev_pop("value"), 6).alias("value_std")
    )


@query("row_counts", "SELECT o_custkey % 100 = 0 AS is_valid, CAST(count(*) AS BIGINT) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1")
def _(spark, sf):
    return t.raw_items(spark, sf).groupBy((F.col("pid") % 100 == 0).alias("is_valid")).agg(F.count(F.lit(1)).alias("n"))


@query("modulo", "SELECT o_orderkey, o_custkey % 100 AS bucket FROM orders")
def _(spark, sf):
    return t.table(spark, sf, "orders").select("o_orderkey", F.pmod("o_custkey", F.lit(100)).alias("bucket"))


@query(
    "split_train_valid_mod",
    """SELECT 'train' AS split, o_custkey AS pid, o_orderkey FROM orders WHERE o_custkey % 100 <> 0
    UNION ALL SELECT 'valid', o_custkey, o_orderkey FROM orders WHERE o_custkey % 100 = 0""",
)
def _(spark, sf):
    orders = t.table(spark, sf, "orders").select(F.col("o_custkey").alias("pid"), "o_orderkey")
    train, valid = sampling.split_by_mod(orders, "pid")
    return train.withColumn("split", F.lit("train")).unionByName(valid.withColumn("split", F.lit("valid")))


@query(
    "split_shuffled_80_20",
    """WITH r AS (SELECT event_id, user_id, row_number() OVER (ORDER BY md5(CAST(event_id AS VARCHAR) || '-42'), event_id) AS r,
      count(*) OVER () AS n FROM events)
    SELECT event_id, user_id, CASE WHEN r <= floor(n * 0.8) THEN 'train' ELSE 'valid' END AS split FROM r""",
)
def _(spark, sf):
    return sampling.split_shuffled(t.table(spark, sf, "events").select("event_id", "user_id"), "event_id")


@query("sample_requests", f"SELECT event_id, user_id, value FROM events WHERE {md5_sql('event_id')} % 1000 < 800")
def _(spark, sf):
    return sampling.sample_requests(t.table(spark, sf, "events").select("event_id", "user_id", "value"), "event_id", 0.8)


@query("chunk_keys", f"SELECT DISTINCT l_partkey AS key, {md5_sql('l_partkey')} % 8 AS chunk FROM lineitem")
def _(spark, sf):
    return sampling.chunk_keys(t.table(spark, sf, "lineitem").select(F.col("l_partkey").alias("key")), "key", 8)


@query(
    "batch_rows",
    f"""WITH s AS (SELECT event_id, {md5_sql('event_id')} % greatest(16, (SELECT count(*) FROM events) // 1000000) AS shard FROM events),
    b AS (SELECT *, CAST((row_number() OVER (PARTITION BY shard ORDER BY event_id) - 1) // 64 AS BIGINT) AS batch FROM s),
    n AS (SELECT *, count(*) OVER (PARTITION BY shard, batch) AS n FROM b)
    SELECT event_id, shard, batch FROM n WHERE n = 64""",
)
def _(spark, sf):
    events = t.table(spark, sf, "events").select("event_id")
    return sampling.batch_rows(events, "event_id", 64, sampling.shards_for(events.count()))


@query("repeat_epochs", "SELECT event_id, value, CAST(e AS INTEGER) AS epoch FROM events, range(0, 3) r(e)")
def _(spark, sf):
    return sampling.repeat_epochs(t.table(spark, sf, "events").select("event_id", "value"), 3)


@query("sort_scores_desc", "SELECT p_partkey, p_name, p_retailprice AS score FROM part ORDER BY score DESC, p_partkey")
def _(spark, sf):
    part = t.table(spark, sf, "part").select("p_partkey", "p_name", F.col("p_retailprice").alias("score"))
    return part.orderBy(F.desc("score"), "p_partkey")


@query(
    "unique_values",
    """SELECT token, CAST(row_number() OVER (ORDER BY token) AS INTEGER) AS idx FROM (
      SELECT DISTINCT unnest(string_split(text, ' ')) AS token FROM documents) WHERE token <> ''""",
)
def _(spark, sf):
    words = t.table(spark, sf, "documents").select(F.explode(F.split("text", " ")).alias("token")).where("token <> ''")
    return dense_index(words.distinct(), "token", "idx", 1).withColumn("idx", F.col("idx").cast("int"))


@query(
    "stats_mean_std",
    """SELECT event_type, CAST(count(*) AS BIGINT) AS n, round(avg(value), 6) AS value_mean, round(stddev_pop(value), 6) AS value_std FROM events GROUP BY 1""",
)
def _(spark, sf):
    return t.table(spark, sf, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("value_mean"), F.round(F.stddev_pop("value"), 6).alias("value_std")
    )


@query("stats_min_max", "SELECT min(l_quantity) AS q_min, max(l_quantity) AS q_max, min(l_extendedprice) AS p_min, max(l_extendedprice) AS p_max FROM lineitem")
def _(spark, sf):
    return t.table(spark, sf, "lineitem").agg(
        F.min("l_quantity").alias("q_min"), F.max("l_quantity").alias("q_max"),
        F.min("l_extendedprice").alias("p_min"), F.max("l_extendedprice").alias("p_max"),
    )


@query("stats_mean_var", "SELECT round(avg(l_quantity), 6) AS q_mean, round(var_pop(l_quantity), 6) AS q_var, round(avg(l_discount), 6) AS d_mean, round(var_pop(l_discount), 9) AS d_var FROM lineitem")
def _(spark, sf):
    return t.table(spark, sf, "lineitem").agg(
        F.round(F.avg("l_quantity"), 6).alias("q_mean"), F.round(F.var_pop("l_quantity"), 6).alias("q_var"),
        F.round(F.avg("l_discount"), 6).alias("d_mean"), F.round(F.var_pop("l_discount"), 9).alias("d_var"),
    )


@query("json_scalar", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def _(spark, sf):
    return t.table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


@query(
    "json_array_of_struct",
    "SELECT l_orderkey, l_partkey, CAST(CAST(l_partkey AS VARCHAR) AS VARCHAR) AS track_uri, CAST(l_linenumber AS VARCHAR) AS pos, l_returnflag AS artist_name FROM lineitem",
)
def _(spark, sf):
    lines = t.spread_table(spark, sf, "lineitem")
    item = F.struct(F.col("l_partkey").alias("track_uri"), F.col("l_linenumber").alias("pos"), F.col("l_returnflag").alias("artist_name"))
    as_text = lines.select("l_orderkey", "l_partkey", F.to_json(F.array(item)).alias("tracks"))
    parsed = slices.parse_items(as_text, "tracks")
    return slices.unnest_items(parsed, "tracks", ("l_orderkey", "l_partkey")).select("l_orderkey", "l_partkey", "track_uri", "pos", "artist_name")


@query("json_normalize", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS "followers.total", event_type AS "owner.kind", value AS "owner.stats.score" FROM events""")
def _(spark, sf):
    record = F.struct(
        F.struct(F.from_json("props", "k bigint").getField("k").alias("total")).alias("followers"),
        F.struct(F.col("event_type").alias("kind"), F.struct(F.col("value").alias("score")).alias("stats")).alias("owner"),
    )
    return slices.normalize(t.table(spark, sf, "events").select("event_id", record.alias("record")), "record")


@query(
    "default_if_empty",
    """SELECT doc_id, CASE WHEN x = '' THEN 'NONE' ELSE x END AS head FROM (SELECT doc_id, trim(replace(split_part(text, ' ', 1), chr(10), '')) AS x FROM documents)""",
)
def _(spark, sf):
    head = F.trim(F.replace(F.split_part("text", F.lit(" "), F.lit(1)), F.lit("\n"), F.lit("")))
    return t.table(spark, sf, "documents").select("doc_id", head.alias("x")).select("doc_id", C.blank_to("x").alias("head"))


@query(
    "null_to_default",
    "SELECT d.doc_id, CAST(coalesce(quality, 0) AS DOUBLE) AS quality, coalesce(CAST(toxic AS VARCHAR), 'NONE') AS toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id",
)
def _(spark, sf):
    joined = t.table(spark, sf, "documents").select("doc_id").join(t.table(spark, sf, "labels"), "doc_id", "left")
    return joined.select("doc_id", C.null_to(C.as_double("quality"), 0.0).alias("quality"), C.null_to(F.col("toxic").cast("string"), "NONE").alias("toxic"))


@query("cast_types", "SELECT CAST(l_orderkey AS VARCHAR) AS order_text, CAST(l_quantity AS BIGINT) AS quantity, l_linenumber / 1.0::DOUBLE AS line, CAST(l_partkey AS DOUBLE) / 1.0::DOUBLE AS part FROM lineitem")
def _(spark, sf):
    return t.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_text"), F.col("l_quantity").cast("bigint").alias("quantity"),
        (F.col("l_linenumber") / F.lit(1.0)).alias("line"), (C.as_double("l_partkey") / 1.0).alias("part"),
    )


@query("genres_parse", f"WITH {t.ARTISTS} SELECT artist_uri, CASE WHEN split_part(substr(genres, 2, length(genres) - 2), ',', 1) = '' THEN 'NONE' ELSE replace(substr(genres, 2, length(genres) - 2), ',', '|') END AS parsed FROM artists")
def _(spark, sf):
    return t.artists(spark, sf).select("artist_uri", F.array_join(C.parse_genres("genres"), "|").alias("parsed"))


@query("genres_join", f"WITH {t.ARTISTS} SELECT artist_uri, CASE WHEN genres = '[]' THEN 'NONE,MISSING' ELSE substr(genres, 2, length(genres) - 2) || ',MISSING' END AS joined FROM artists")
def _(spark, sf):
    with_gap = F.concat(C.parse_genres("genres"), F.array(F.lit(None).cast("string")))
    return t.artists(spark, sf).select("artist_uri", C.join_genres(with_gap).alias("joined"))


@query("genres_slug", f"WITH {t.ARTISTS} SELECT artist_uri, CASE WHEN genres = '[]' THEN 'unknown' ELSE replace(replace(replace(replace(substr(genres, 2, length(genres) - 2), ', ', ','), '''', ''), ' ', '_'), ',', ' ') END AS slug FROM artists")
def _(spark, sf):
    names = F.when(F.col("genres") == "[]", F.array().cast("array<string>")).otherwise(C.clean_genres("genres"))
    return t.artists(spark, sf).select("artist_uri", C.slug_genres(names).alias("slug"))


@query("make_sample_id", "SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id, l_partkey FROM lineitem")
def _(spark, sf):
    return t.table(spark, sf, "lineitem").select(C.sample_id("l_orderkey", "l_linenumber").alias("id"), "l_partkey")


@query("array_length", "SELECT doc_id, CAST(len(string_split(text, ' ')) AS INTEGER) AS n FROM documents")
def _(spark, sf):
    return t.table(spark, sf, "documents").select("doc_id", F.size(F.split("text", " ")).alias("n"))


@query("strip_uri_prefix", "SELECT p_partkey, replace(p_brand, 'Brand#', '') AS brand FROM part")
def _(spark, sf):
    return t.table(spark, sf, "part").select("p_partkey", C.strip_prefix("p_brand", "Brand#").alias("brand"))


@query("uri_from_link", r"SELECT page_id, split_part(list_last(string_split(url, '/')), '?', 1) AS uri FROM pages")
def _(spark, sf):
    return t.table(spark, sf, "pages").select("page_id", C.uri_from_link("url").alias("uri"))


@query("bool_to_lower_string", "SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'true' ELSE 'false' END AS collaborative FROM customer")
def _(spark, sf):
    return t.table(spark, sf, "customer").select("c_custkey", C.lower_bool(F.col("c_mktsegment") == "BUILDING").alias("collaborative"))


@query("bytes_decode", "SELECT doc_id, decode(encode(text)) AS text FROM documents")
def _(spark, sf):
    return t.table(spark, sf, "documents").select("doc_id", F.encode("text", "UTF-8").alias("raw")).select("doc_id", C.decode_utf8("raw").alias("text"))


@query("now_timestamp", "SELECT s_suppkey, s_name, TIMESTAMP '2024-02-01 00:00:00' AS feature_ts FROM supplier")
def _(spark, sf):
    return t.table(spark, sf, "supplier").select("s_suppkey", "s_name", F.lit("2024-02-01 00:00:00").cast("timestamp_ntz").alias("feature_ts"))


@query("round_num", "SELECT event_id, CASE WHEN value - floor(value) = 0.5 THEN CAST(2 * round(value / 2) AS DOUBLE) ELSE round(value) END AS rounded FROM events")
def _(spark, sf):
    return t.table(spark, sf, "events").select("event_id", C.round_half_even("value").alias("rounded"))


@query("clip_values", "SELECT event_id, greatest(least((value - 50) * 1e11, 1e12), -1e12) AS clipped FROM events")
def _(spark, sf):
    return t.table(spark, sf, "events").select("event_id", C.clip((F.col("value") - 50) * 1e11).alias("clipped"))


@query(
    "shard_count",
    """SELECT source, CAST(greatest(1, CAST(floor(sum(n_chars) / 1000.0) AS BIGINT) // 50) AS BIGINT) AS shards FROM documents GROUP BY 1""",
)
def _(spark, sf):
    sizes = t.table(spark, sf, "documents").groupBy("source").agg(F.sum("n_chars").alias("chars"))
    return sizes.select("source", shards_of(F.col("chars") / 1000.0, 50).alias("shards"))


@query(
    "linspace_buckets",
    """WITH m AS (SELECT l_returnflag, max(l_extendedprice) AS high FROM lineitem GROUP BY 1)
    SELECT l_returnflag, CAST(i AS INTEGER) AS bucket, round(high * i / 19.0::DOUBLE, 6) AS boundary FROM m, range(0, 20) r(i)""",
)
def _(spark, sf):
    highs = t.table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.max("l_extendedprice").alias("high"))
    bounds = F.transform(F.sequence(F.lit(0), F.lit(19)), lambda i: F.col("high") * i / F.lit(19.0))
    return highs.select("l_returnflag", F.posexplode(bounds).alias("bucket", "boundary")).withColumn("boundary", F.round("boundary", 6))


@query(
    "external_enrich",
    """SELECT key, 'track:' || CAST(key AS VARCHAR) AS uri, CAST(key % 100 AS BIGINT) AS track_pop FROM (
      SELECT DISTINCT l_partkey AS key FROM lineitem) WHERE key NOT IN (SELECT p_partkey FROM part WHERE p_retailprice < 950)""",
)
def _(spark, sf):
    wanted = t.table(spark, sf, "lineitem").select(F.col("l_partkey").alias("key"))
    done = t.table(spark, sf, "part").where("p_retailprice < 950").select(F.col("p_partkey").alias("key"))
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("uri", T.StringType()), T.StructField("track_pop", T.LongType())])

    def client():
        return lambda keys: [{"key": k, "uri": f"track:{k}", "track_pop": k % 100} for k in keys]

    return enrich.enrich_missing(wanted, done, "key", client, schema, batch_size=50, pause=0)


@query(
    "join_interpret_results",
    """WITH s AS (SELECT l_suppkey AS artist_id, l_partkey AS track_id, CAST(count(*) AS BIGINT) AS score FROM lineitem GROUP BY 1, 2),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY artist_id ORDER BY score DESC, track_id) AS INTEGER) AS rank FROM s)
    SELECT s_name AS query_name, rank, CAST(track_id AS VARCHAR) AS track_uri, p_name AS track_name, p_brand AS album, CAST(score AS DOUBLE) AS neighbor_distance
    FROM r JOIN part ON track_id = p_partkey JOIN supplier ON artist_id = s_suppkey WHERE rank <= 10""",
)
def _(spark, sf):
    pairs = t.table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("query"), F.col("l_partkey").alias("id")).agg(
        F.count(F.lit(1)).cast("double").alias("score")
    )
    found = top_per_group(pairs, ["query"], [F.desc("score"), F.asc("id")], 10)
    catalogue = t.table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_partkey").cast("string").alias("track_uri"), F.col("p_name").alias("track_name"), F.col("p_brand").alias("album")
    )
    named = t.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("query"), F.col("s_name").alias("query_name"))
    return interpret(found, catalogue, named).drop("query", "id")


@query(
    "neighbor_rank",
    """WITH s AS (SELECT l_suppkey AS artist_id, l_partkey AS track_id, CAST(count(*) AS BIGINT) AS score FROM lineitem GROUP BY 1, 2)
    SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY artist_id ORDER BY score DESC, track_id) AS INTEGER) AS rank FROM s) WHERE rank <= 20""",
)
def _(spark, sf):
    pairs = t.table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("artist_id"), F.col("l_partkey").alias("track_id")).agg(
        F.count(F.lit(1)).alias("score")
    )
    return top_per_group(pairs, ["artist_id"], [F.desc("score"), F.asc("track_id")], 20)
