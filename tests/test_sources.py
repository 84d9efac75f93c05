"""Files, tables, examples and look-ups."""

import json
import struct

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segue.operators import enrich, examples
from segue.operators.sequence import cut_lists
from segue.schemas import AUDIO_FEATURES, example_type, feature_set
from segue.sources import examples as ex
from segue.sources import slices, tables, tfrecord


def playlist(pid, n):
    tracks = [
        {"pos": i, "artist_name": f"A{i}", "track_uri": f"t{i}", "artist_uri": f"a{i}", "track_name": "", "album_uri": "b", "duration_ms": 1000 * i, "album_name": "B"}
        for i in range(n)
    ]
    return {"pid": pid, "name": f"list {pid}", "collaborative": "false", "modified_at": 1, "num_tracks": n, "tracks": tracks}


def test_slices_are_read_once_each(spark, tmp_path):
    for s in range(3):
        doc = {"info": {"slice": str(s)}, "playlists": [playlist(s * 10 + i, 4) for i in range(5)]}
        (tmp_path / f"slice.{s}.json").write_text(json.dumps(doc, indent=1))
    (tmp_path / "notes.txt").write_text("not a slice")
    df = slices.read_slices(spark, str(tmp_path))
    assert df.count() == 15 and df.select("pid").distinct().count() == 15
    assert slices.unnest_items(df).count() == 60


def test_text_lists_are_parsed_as_text_fields(spark):
    text = json.dumps(playlist(1, 2)["tracks"])
    df = spark.createDataFrame([(1, text), (2, "[]")], "pid bigint, tracks string")
    items = slices.unnest_items(slices.parse_items(df))
    assert set(dict(items.drop("pid").dtypes).values()) == {"string"}
    assert [(r.pos, r.duration_ms) for r in items.orderBy("pos").collect()] == [("0", "0"), ("1", "1000")]


def test_declared_schema(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.StringType(), False), T.StructField("x", T.LongType())])
    good = spark.createDataFrame([(1, "a")], "x int, k string")
    tables.write_with_schema(good, schema, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).dtypes == [("k", "string"), ("x", "bigint")]
    bad = spark.createDataFrame([(1, None)], "x int, k string")
    with pytest.raises(Exception, match="required column k"):
        tables.conform(bad, schema).collect()
    assert AUDIO_FEATURES["track_uri"].nullable is False and len(AUDIO_FEATURES) == 20


def test_shards(spark, tmp_path):
    assert [tables.shard_count(*a) for a in ((44_000, 2_000), (500, 250), (10, 250))] == [22, 2, 1]
    df = spark.range(100)
    tables.write_shards(df, str(tmp_path / "s"), 100, by=("id",))
    assert slices.scan_by_suffix(spark, str(tmp_path / "s"), ".parquet").count() == 1
    assert spark.read.parquet(str(tmp_path / "s")).count() == 100


def test_append_and_replace(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append_table(spark.range(3), path)
    tables.append_table(spark.range(2), path)
    assert spark.read.parquet(path).count() == 5
    tables.replace_table(spark.range(1), path)
    assert spark.read.parquet(path).count() == 1


def test_vectors_as_json(spark, tmp_path):
    df = spark.createDataFrame([(7, [0.5, 1.0])], "id bigint, embedding array<double>")
    tables.write_embeddings_json(df, str(tmp_path / "v"))
    lines = [line for p in (tmp_path / "v").glob("*.json") for line in p.read_text().splitlines()]
    assert [json.loads(x) for x in lines] == [{"id": "7", "embedding": [0.5, 1.0]}]


def test_runs(spark, tmp_path):
    path = str(tmp_path / "runs")
    tables.log_run(spark, path, "r1", "e1", {"rank": 8}, {"rmse": 0.5})
    tables.log_run(spark, path, "r2", "e2", {}, {"rmse": 0.7})
    assert [(r.run, r.metric, r.value) for r in tables.read_runs(spark, path, "e1").collect()] == [("r1", "rmse", 0.5)]


def test_feature_sets():
    assert len(feature_set("candidate")) == 23
    assert set(feature_set("rank")) - set(feature_set("towers")) == {"candidate_rank"}
    assert feature_set("query")["artists_followers_pl"] == ("float", True)
    assert "track_time_signature_can" in feature_set("candidate")
    assert len(feature_set("audio-rank")) == len(feature_set("lw-audio-rank")) == 29


def filled_row(name, n):
    row = {}
    for column, (kind, listed) in feature_set(name).items():
        value = "x" if kind == "string" else 1.0
        row[column] = [value] * n if listed else value
    return row


@pytest.mark.parametrize("name", ["candidate", "query", "towers", "rank", "audio-rank", "lw-audio-rank"])
@pytest.mark.parametrize("n", [5, 15])
def test_parse_keeps_the_shape(spark, name, n):
    df = spark.createDataFrame([filled_row(name, n)], example_type(feature_set(name)))
    assert ex.parse(df, name, n).schema == example_type(feature_set(name)) and ex.parse(df, name, n).count() == 1


def test_wrong_length_fails(spark):
    df = spark.createDataFrame([filled_row("rank", 4)], example_type(feature_set("rank")))
    with pytest.raises(Exception, match="5 values expected, found 4"):
        ex.parse(df, "rank", 5).collect()


def test_encode_makes_lists(spark):
    df = spark.createDataFrame([(1, ["a", "b"], 2.5)], "k int, l array<string>, x double")
    row = ex.encode(df, {"k": ("string", False), "l": ("string", True), "x": ("float", False)}).first()
    assert (row.k, row.l, row.x) == (["1"], ["a", "b"], [2.5])


def test_record_checksum_and_codec():
    assert tfrecord.masked_crc(b"") == ((0 >> 15 | 0 << 17) + 0xA282EAD8) & 0xFFFFFFFF
    crc = 0xE3069283  # CRC-32C of "123456789"
    assert tfrecord.masked_crc(b"123456789") == (((crc >> 15) | (crc << 17) & 0xFFFFFFFF) + 0xA282EAD8) & 0xFFFFFFFF
    row = {"t": ["é", "b"], "f": [1.5, -2.0], "i": [1, -3, 1 << 40]}
    back = tfrecord.decode_example(tfrecord.encode_example(row))
    assert back == {"t": ["é".encode(), b"b"], "f": [1.5, -2.0], "i": [1, -3, 1 << 40]}


def test_unpacked_lists_are_read():
    unpacked = b"".join(struct.pack("<Bf", 0x0D, v) for v in (1.0, 2.0))
    feature = bytes([0x12, len(unpacked)]) + unpacked
    assert tfrecord._values(feature) == [1.0, 2.0]


def test_record_files(spark, tmp_path):
    spark.dataSource.register(tfrecord.TFRecordSource)
    df = spark.createDataFrame([("a", [1.0, 2.0], 5), ("b", [], None)], "t string, f array<float>, i bigint")
    path = str(tmp_path / "r")
    df.repartition(2).write.format("tfrecord").mode("append").save(path)
    back = spark.read.format("tfrecord").schema(df.schema).load(path)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    df.limit(1).write.format("tfrecord").mode("overwrite").save(path)
    assert spark.read.format("tfrecord").schema(df.schema).load(path).count() == 1


def test_enrichment_drops_items_without_features_and_keeps_positions(spark):
    items = spark.createDataFrame([(1, i, f"t{i}", "a") for i in range(8)], "pid bigint, pos bigint, track_uri string, artist_uri string")
    audio = spark.createDataFrame([(f"t{i}", i) for i in range(8) if i != 2], "track_uri string, track_pop int")
    artists = spark.createDataFrame([("a", 9)], "artist_uri string, artist_pop int")
    out = enrich.enrich_items(items, {"track_uri": audio, "artist_uri": artists})
    assert sorted(r.pos for r in out.collect()) == [0, 1, 3, 4, 5, 6, 7]


def test_feature_duplicates(spark):
    df = spark.createDataFrame([("k", 1, 2.0), ("k", 1, 2.0), ("k", 2, 1.0)], "key string, v int, w double")
    assert enrich.distinct_rows(df).count() == 2
    assert [r.v for r in enrich.one_per_key(df, "key", [F.desc("v")]).collect()] == [2]


def test_lookup_keeps_array_order(spark):
    df = spark.createDataFrame([(1, ["b", "a", "zz", "b"]), (2, ["a"])], "id int, keys array<string>")
    dim = spark.createDataFrame([("a", 1, None), ("b", 2, 0.5)], "key string, x int, y double")
    out = {r.id: (r.x_pl, r.y_pl) for r in enrich.lookup_arrays(df, "id", "keys", dim, "key", {"x": 0, "y": 0.0}).collect()}
    assert out == {1: ([2, 1, 2], [0.5, 0.0, 0.5]), 2: ([1], [0.0])}


def test_lookups_retry_skip_and_resume(spark):
    wanted = spark.createDataFrame([(i % 10,) for i in range(30)], "key bigint").coalesce(1)
    done = spark.createDataFrame([(0,), (1,)], "key bigint")
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("x", T.LongType())])

    def client():
        tries = {}

        def call(keys):
            for k in keys:
                tries[k] = tries.get(k, 0) + 1
                if k == 3 and tries[k] == 1:
                    raise enrich.Unavailable("time-out")
                if k == 7:
                    raise ValueError("bad key")
            return [{"key": k, "x": k * 2} for k in keys]

        return call

    out = enrich.enrich_missing(wanted, done, "key", client, schema, batch_size=1, pause=0)
    got = {r.key: r.x for r in out.collect()}
    assert got == {k: 2 * k for k in (2, 3, 4, 5, 6, 8, 9)}
    left = enrich.missing_keys(wanted, done.unionByName(out.select("key")), "key")
    assert [r.key for r in left.collect()] == [7]


def test_examples_end_to_end(spark):
    audio = [c.name for c in AUDIO_FEATURES if c.name in ("danceability", "energy", "loudness", "speechiness", "acousticness", "instrumentalness", "liveness", "valence", "tempo", "key", "mode", "time_signature")]
    rows = [(f"t{i}", *[None if i == 3 else 1.0] * len(audio)) for i in range(8)]
    table = spark.createDataFrame(rows, "track_uri string, " + ", ".join(f"{a} double" for a in audio))
    items = spark.createDataFrame([(1, i, f"t{i}") for i in range(8)], "pid bigint, pos bigint, track_uri_can string")
    for c in ("track_name", "artist_uri", "artist_name", "album_uri", "album_name", "artist_genres"):
        items = items.withColumn(f"{c}_can", F.concat(F.lit(c), (F.col("pos") % 3).cast("string")))
    for c in ("duration_ms", "track_pop", "artist_pop", "artist_followers"):
        items = items.withColumn(f"{c}_can", F.lit(2.0))
    items = items.join(examples.fill_audio(table), "track_uri_can")
    named = spark.createDataFrame([(1, None, "false")], "pid bigint, name string, collaborative string")
    out = examples.build_examples(cut_lists(items, "pid", ["pos"]), named, 5)
    parsed = ex.parse(out, "rank", 5).orderBy("track_uri_can").collect()
    assert [r.track_uri_can for r in parsed] == ["t5", "t6", "t7"]
    first = parsed[0]
    assert first.track_uri_pl == ["t0", "t1", "t2", "t3", "t4"] and first.candidate_rank == [5, 4, 3, 2, 1]
    assert first.pl_name_src == "" and first.track_energy_pl == [1, 1, 1, 0, 1] and first.num_pl_artists_new == 3.0
    assert first.pl_duration_ms_new == 10.0 and first.num_pl_songs_new == 5.0


def test_shards_follow_the_data(spark, tmp_path):
    found = []
    for rows in (200, 40_000):
        path = str(tmp_path / f"shards-{rows}")
        tables.write_shards(spark.range(rows).selectExpr("id", "sha2(cast(id AS string), 512) AS text"), path, 0.5, by=("id",))
        assert spark.read.parquet(path).count() == rows
        found.append(len(spark.read.parquet(path).inputFiles()))
    assert found[0] == 1 and found[1] > 4


def test_null_values_in_records(spark):
    rows = spark.createDataFrame([("a", None, ["x", None]), (None, 2.0, None)], "s string, f double, l array<string>")
    got = ex.encode(rows, {"s": ("string", False), "f": ("float", False), "l": ("string", True)}).collect()
    assert [tuple(r) for r in got] == [(["a"], [], ["x"]), ([], [2.0], None)]


def test_streams_read_files_and_folders_alike(spark, sf, tmp_path):
    from segue.plans import load_queries

    spark.read.parquet(f"{sf}/events.parquet").repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    run = load_queries()["stream_request_log"].run
    of = lambda folder: sorted(r.event_id for r in run(spark, folder).collect())
    assert of(str(tmp_path)) == of(sf) and of(sf)
