"""Queries that write a table under the shared folder and read it back: sources, sinks and streams."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from segue.operators import monitor, vocab
from segue.operators import feature_store as fs
from segue.operators import sequence as S
from segue.plans import lists, watch
from segue.plans import tables as t
from segue.plans.basics import md5_sql
from segue.plans.features import FEATURE_TEXTS, sql_vocab
from segue.plans.registry import query
from segue.plans.tables import TRACKS, sql_micro
from segue.schemas import SLICE, TRACK_FIELDS, example_type, feature_set
from segue.sources import examples as ex
from segue.session import scratch_path
from segue.sources import slices, tables
from segue.sources.tfrecord import TFRecordSource
from segue.streaming import jobs


@query(
    "scan_json_slices",
    f"""WITH {TRACKS} SELECT pid, c_name AS name, CASE WHEN c_mktsegment = 'BUILDING' THEN 'true' ELSE 'false' END AS collaborative,
      pos, track_uri, track_name, artist_uri, album_uri, CAST(duration_ms AS BIGINT) AS duration_ms FROM tracks JOIN customer ON pid = c_custkey""",
)
def _(spark, sf):
    cut = t.item_lists(spark, sf, t.names(spark, sf))
    sizes = cut.cut.groupBy("pid").agg(F.ceil(F.count(F.lit(1)) / S.CHUNK).alias("chunks"))
    n = max(1, (sizes.agg(F.sum("chunks")).first()[0] or 0) // 1000)
    # a list's own columns come to its items, so that items move once more, by slice
    rows = t.tracks(spark, sf, cut, t.lists(spark, sf)).withColumn("artist_name", F.col("artist_uri")).withColumn("duration_ms", F.col("duration_ms").cast("bigint"))
    chunk = F.floor(F.col("pos") / S.CHUNK).cast("bigint")
    numbered = rows.withColumn("slice", F.pmod(F.xxhash64("pid", chunk), F.lit(n))).repartition("slice")
    nested = S.chunk_lists(numbered, "pid", "pos", TRACK_FIELDS, keep=["slice", "name", "collaborative"])
    playlist = F.struct("pid", "name", "collaborative", "tracks")
    docs = nested.groupBy("slice").agg(F.collect_list(playlist).alias("playlists"))
    info = F.struct(F.col("slice").cast("string").alias("slice"), F.lit("v1").alias("version"))
    path = scratch_path(spark, "slices")
    docs.select(F.to_json(F.struct(info.alias("info"), "playlists"))).write.option("maxRecordsPerFile", 1).option("compression", "gzip").text(path)
    read = slices.read_slices(spark, path, SLICE, pattern="*.txt.gz")
    flat = slices.unnest_items(read.select("pid", "name", "collaborative", "tracks"), "tracks", ("pid", "name", "collaborative"))
    return flat.select("pid", "name", "collaborative", "pos", "track_uri", "track_name", "artist_uri", "album_uri", "duration_ms")


@query("interleave_shards", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def _(spark, sf):
    # Many shards, read in parallel and in no order.
    path = scratch_path(spark, "interleave")
    tables.write_shards(t.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), path, 10)
    return spark.read.parquet(path)


@query("append_table", "SELECT o_orderkey, o_custkey FROM orders UNION ALL SELECT p_partkey, p_size FROM part")
def _(spark, sf):
    path = scratch_path(spark, "append")
    tables.append_table(t.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), path)
    part = t.table(spark, sf, "part").select(F.col("p_partkey").alias("o_orderkey"), F.col("p_size").cast("bigint").alias("o_custkey"))
    tables.append_table(part, path)
    return spark.read.parquet(path)


@query("replace_table", "SELECT p_partkey, p_name FROM part")
def _(spark, sf):
    path = scratch_path(spark, "replace")
    tables.replace_table(t.table(spark, sf, "part"), path)
    tables.replace_table(t.table(spark, sf, "part").select("p_partkey", "p_name"), path)
    return spark.read.parquet(path)


@query("write_with_schema", "SELECT CAST(s_suppkey AS VARCHAR) AS artist_uri, CAST(s_nationkey AS BIGINT) AS artist_pop, CAST(s_acctbal AS DOUBLE) AS followers FROM supplier")
def _(spark, sf):
    path = scratch_path(spark, "declared")
    schema = T.StructType(
        [T.StructField("artist_uri", T.StringType(), False), T.StructField("artist_pop", T.LongType()), T.StructField("followers", T.DoubleType())]
    )
    rows = t.table(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("artist_pop"), F.col("s_suppkey").cast("string").alias("artist_uri"), F.col("s_acctbal").alias("followers")
    )
    tables.write_with_schema(rows, schema, path)
    return spark.read.parquet(path)


EXPORT = f"""WITH {TRACKS}, h AS (SELECT pid, pos, track_uri, list(track_uri) {lists.HIST} AS p, list(duration_ms) {lists.HIST} AS d FROM tracks)
  SELECT track_uri AS track_uri_can, c_name AS pl_name_src, array_to_string(p, ',') AS track_uri_pl,
         {t.sql_whole('d')} AS duration_ms_songs_pl FROM h JOIN customer ON pid = c_custkey WHERE len(p) = {lists.N}"""


def _shown(rows):
    return rows.select(
        "track_uri_can", "pl_name_src", F.array_join("track_uri_pl", ",").alias("track_uri_pl"),
        t.whole_text("duration_ms_songs_pl").alias("duration_ms_songs_pl"),
    )


@query("export_examples", EXPORT)
def _(spark, sf):
    path = scratch_path(spark, "examples")
    ex.export_examples(lists.rank_examples(spark, sf), "rank", path, shard_mb=64)
    return _shown(spark.read.schema(example_type(feature_set("rank"))).parquet(path))


def _catalogue(spark, sf):
    return lists.example_candidates(spark, sf).select(*feature_set("candidate"))


@query(
    "export_candidates",
    f"""WITH {TRACKS}, {t.ARTISTS} SELECT DISTINCT tracks.track_uri AS track_uri_can, track_name AS track_name_can, artist_name AS artist_name_can,
      CAST(tracks.duration_ms AS DOUBLE) AS duration_ms_can FROM tracks JOIN artists ON tracks.artist_uri = artists.artist_uri WHERE pos > 0""",
)
def _(spark, sf):
    path = scratch_path(spark, "candidates")
    ex.export_candidates(_catalogue(spark, sf), path)
    return spark.read.parquet(path).select(
        "track_uri_can", "track_name_can", "artist_name_can", F.col("duration_ms_can").cast("double").alias("duration_ms_can")
    )


TRACK_RECORD = {"p_name": ("string", False), "p_retailprice": ("float", False), "p_size": ("int", False), "words": ("string", True)}


@query(
    "tfrecord_source",
    "SELECT p_name, CAST(p_retailprice AS FLOAT)::DOUBLE AS p_retailprice, CAST(p_size AS BIGINT) AS p_size, replace(p_name, ' ', '|') AS words FROM part",
)
def _(spark, sf):
    spark.dataSource.register(TFRecordSource)
    path = scratch_path(spark, "records")
    rows = t.table(spark, sf, "part").select("p_name", "p_retailprice", "p_size", F.split("p_name", " ").alias("words"))
    tables.write_shards(ex.encode(rows, TRACK_RECORD), path, 64, "tfrecord", mode="append")
    read = spark.read.format("tfrecord").schema(example_type(TRACK_RECORD)).load(path)
    return read.select("p_name", F.col("p_retailprice").cast("double").alias("p_retailprice"), "p_size", F.array_join("words", "|").alias("words"))


@query(
    "tfrecord_sink",
    f"""WITH {TRACKS}, {t.ARTISTS}, {t.AUDIO} SELECT DISTINCT tracks.track_uri AS track_uri_can, track_name AS track_name_can, artist_name AS artist_name_can,
      CAST(tracks.duration_ms AS DOUBLE) AS duration_ms_can, CAST(energy AS FLOAT)::DOUBLE AS track_energy_can
    FROM tracks JOIN artists ON tracks.artist_uri = artists.artist_uri JOIN audio ON tracks.track_uri = audio.track_uri WHERE pos > 0""",
)
def _(spark, sf):
    spark.dataSource.register(TFRecordSource)
    path = scratch_path(spark, "shards")
    features = feature_set("candidate")
    tables.write_shards(ex.encode(_catalogue(spark, sf), features), path, 50, "tfrecord", mode="append")
    read = spark.read.format("tfrecord").schema(example_type(features)).load(path)
    reals = [F.col(c).cast("double").alias(c) for c in ("duration_ms_can", "track_energy_can")]
    return read.select("track_uri_can", "track_name_can", "artist_name_can", *reals)


@query("scan_by_suffix", "SELECT p_brand, CAST(count(*) AS BIGINT) AS n FROM part GROUP BY 1")
def _(spark, sf):
    path = scratch_path(spark, "mixed")
    rows = t.table(spark, sf, "part").select("p_brand", "p_partkey")
    rows.write.mode("overwrite").parquet(path)
    rows.write.mode("append").json(path)
    found = slices.read_by_suffix(spark, path, ".parquet", rows.schema)
    return found.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))


@query("write_embeddings_json", f"SELECT CAST(vec_id AS VARCHAR) AS id, {sql_micro('list_transform(embedding, lambda x: x::DOUBLE)')} AS embedding FROM embeddings")
def _(spark, sf):
    path = scratch_path(spark, "vectors")
    rows = t.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("embedding"))
    tables.write_embeddings_json(rows, path)
    return spark.read.schema("id string, embedding array<double>").json(path).select("id", t.micro_text("embedding").alias("embedding"))


@query("vocab_save", f"WITH {FEATURE_TEXTS} {sql_vocab('tokens', 20000)}")
def _(spark, sf):
    path = scratch_path(spark, "vocab")
    rows = t.spread_table(spark, sf, "conversations").withColumn("parts", F.split("text", "\n"))
    tables.save_vocab(vocab.fit_vocab(rows, ["text", "role", "parts"]), path)
    return tables.load_vocab(spark, path).select("feature", "token", "n", "idx")


@query("vocab_load", f"WITH {FEATURE_TEXTS}, v AS ({sql_vocab('tokens', 20000)}) SELECT * FROM v WHERE feature = 'text'")
def _(spark, sf):
    path = scratch_path(spark, "vocab")
    rows = t.spread_table(spark, sf, "conversations").withColumn("parts", F.split("text", "\n"))
    tables.save_vocab(vocab.fit_vocab(rows, ["text", "role", "parts"]), path)
    return tables.load_vocab(spark, path, "text").select("feature", "token", "n", "idx")


@query("fs_ingest", watch.LATEST.format(where=""))
def _(spark, sf):
    path = scratch_path(spark, "features")
    values = watch._values(spark, sf)
    half = F.lit(watch.HALF).cast("timestamp_ntz")
    fs.ingest(values.where(F.col("feature_ts") < half), path)
    fs.ingest(values.where(F.col("feature_ts") >= half), path)
    return fs.read_path(spark, path, "user_id", ["kind", "value"])


@query("fs_validate_schema", "SELECT 'p_brand' AS feature, 'type' AS problem, 'double' AS expected, 'string' AS actual, CAST(count(*) AS BIGINT) AS n FROM part UNION ALL SELECT 'p_genres', 'missing', 'array<string>', NULL, count(*) FROM part UNION ALL SELECT 'p_partkey', 'extra', NULL, 'bigint', count(*) FROM part")
def _(spark, sf):
    part = t.table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_retailprice")
    config = {"p_name": "STRING", "p_brand": "DOUBLE", "p_retailprice": "DOUBLE", "p_genres": "STRING_ARRAY"}
    return fs.validate_schema(part, config).withColumn("n", F.lit(part.count()).cast("bigint"))


@query(
    "experiment_log",
    """SELECT 'run-' || lower(event_type) AS run, 'n' AS metric, CAST(count(*) AS DOUBLE) AS value FROM events GROUP BY 1
    UNION ALL SELECT 'run-' || lower(event_type), 'value_max', max(value) FROM events GROUP BY 1""",
)
def _(spark, sf):
    path = scratch_path(spark, "runs")
    measured = t.table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("value_max"))
    metrics = {"n": F.col("n"), "value_max": F.col("value_max")}
    tables.log_runs(measured, path, F.concat(F.lit("run-"), F.lower("event_type")), "events", {"kind": F.col("event_type")}, metrics)
    tables.log_run(spark, path, "run-other", "others", {}, {"n": 0})
    return tables.read_runs(spark, path, "events")


@query(
    "experiment_read",
    "SELECT 'size' AS run, 'documents' AS metric, CAST(count(*) AS DOUBLE) AS value FROM documents UNION ALL SELECT 'size', 'chars', CAST(sum(n_chars) AS DOUBLE) FROM documents",
)
def _(spark, sf):
    path = scratch_path(spark, "runs")
    row = t.table(spark, sf, "documents").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars")).first()
    tables.log_run(spark, path, "size", "corpus", {"table": "documents"}, {"documents": row.n, "chars": row.chars})
    tables.log_run(spark, path, "size", "elsewhere", {}, {"documents": -1})
    return tables.read_runs(spark, path, "corpus")


def _stream(spark, sf):
    schema = t.table(spark, sf, "events").schema
    # a pattern that names the table itself, be it a file or a folder of files
    return spark.readStream.schema(schema).parquet(f"{sf}/events.parque[t]")


@query("stream_request_log", f"SELECT event_id, user_id, ts, event_type, value, props FROM events WHERE {md5_sql('event_id')} % 1000 < 800")
def _(spark, sf):
    path = scratch_path(spark, "log")
    jobs.request_log(_stream(spark, sf), "event_id", 0.8, path, scratch_path(spark, "log-state")).awaitTermination()
    return spark.read.parquet(path)


@query(
    "stream_monitor",
    f"""WITH {watch.WINDOWS}, base AS (SELECT feature, kind, cell, count(*) AS n FROM cells GROUP BY ALL),
    b AS (SELECT *, n / sum(n) OVER (PARTITION BY feature)::DOUBLE AS p FROM base),
    closed AS (SELECT DISTINCT window_start FROM s WHERE window_start + INTERVAL 2 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR),
    j AS (SELECT c.window_start, b.feature, b.kind, b.p AS a, coalesce(s.p, 0) AS b FROM closed c CROSS JOIN b
      LEFT JOIN s ON s.window_start = c.window_start AND s.feature = b.feature AND s.cell = b.cell)
    SELECT window_start, feature, kind, round({watch.DISTANCE}, 9) AS distance, {watch.DISTANCE} > 0.05 AS alert FROM j GROUP BY window_start, feature, kind""",
)
def _(spark, sf):
    path = scratch_path(spark, "watch")
    base = monitor.histogram(watch.requests(spark, sf), watch.NUMERIC, watch.TEXT)
    stream = _stream(spark, sf).withColumn("k", F.get_json_object("props", "$.k").cast("double"))
    jobs.stream_monitor(stream, base, "ts", watch.NUMERIC, watch.TEXT, path, scratch_path(spark, "watch-state")).awaitTermination()
    out = spark.read.parquet(path)
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "feature", "kind", F.round("distance", 9).alias("distance"), "alert")

