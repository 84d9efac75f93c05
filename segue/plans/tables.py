"""The given tables read as lists of items, with the SQL for the same views.

A customer is a list, its line items by ship date are the items: part = track, supplier = artist, brand = album.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segue.operators.sequence import Lists, attach, cut_lists, fan_out

LINE = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "track_id", "artist_id", "duration", "l_extendedprice"]
ITEM = ["pid", "track_id", "artist_id", "duration"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread_table(spark: SparkSession, sf: str, name: str, *by: str, columns: list[str] | None = None) -> DataFrame:
    """A table for costly row work: a small one in few files is spread over all cores, a large one is left as it is."""
    rows = table(spark, sf, name)
    rows = rows.select(*columns) if columns else rows
    cores = spark.sparkContext.defaultParallelism
    return rows.repartition(cores, *by) if rows.rdd.getNumPartitions() < cores else rows


def raw_items(spark: SparkSession, sf: str) -> DataFrame:
    """(pid, track_id, artist_id, duration) and the order columns, without positions."""
    lines = spread_table(spark, sf, "lineitem", "l_orderkey", columns=LINE)
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("pid"))
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        "pid", F.col("l_partkey").alias("track_id"), F.col("l_suppkey").alias("artist_id"),
        F.col("l_quantity").alias("duration"), "l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice",
    )


def item_lists(spark: SparkSession, sf: str, *features: DataFrame) -> Lists:
    """The lists of items with the columns of feature tables; items without a row in one of them are not in the lists."""
    lists = cut_lists(raw_items(spark, sf), "pid", ORDER, keep=ITEM)

    def join(rows: DataFrame) -> DataFrame:
        for feature in features:
            rows = rows.join(feature, "track_id" if "track_id" in feature.columns else "artist_id")
        return rows

    return attach(lists, join) if features else lists


def items(spark: SparkSession, sf: str) -> DataFrame:
    """(pid, pos, track_id, artist_id, duration)."""
    return fan_out(item_lists(spark, sf)).select("pid", "pos", "track_id", "artist_id", "duration")


ITEMS = """
items AS (
  SELECT o.o_custkey AS pid,
         CAST(row_number() OVER (PARTITION BY o.o_custkey ORDER BY l.l_shipdate, l.l_orderkey, l.l_linenumber,
              l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice) - 1 AS BIGINT) AS pos,
         l.l_partkey AS track_id, l.l_suppkey AS artist_id, l.l_quantity AS duration
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
"""


def albums(spark: SparkSession, sf: str) -> DataFrame:
    """(track_id, album)."""
    return table(spark, sf, "part").select(F.col("p_partkey").alias("track_id"), F.col("p_brand").alias("album"))


def album_lists(spark: SparkSession, sf: str) -> Lists:
    return item_lists(spark, sf, albums(spark, sf))


ALBUM_ITEMS = ITEMS + """,
album_items AS (
  SELECT i.*, p.p_brand AS album FROM items i JOIN part p ON i.track_id = p.p_partkey)
"""


def audio(spark: SparkSession, sf: str) -> DataFrame:
    """An audio feature table in the shape of the source: one row per track."""
    part = table(spark, sf, "part")
    size, price = F.col("p_size").cast("double"), F.col("p_retailprice")
    return part.select(
        F.col("p_partkey").cast("string").alias("track_uri"),
        (size / 50.0).alias("danceability"), (price / 4000.0).alias("energy"), (size % 12).alias("key"),
        (-size).alias("loudness"), (size / 100.0).alias("speechiness"), (price / 8000.0).alias("acousticness"),
        (size / 200.0).alias("instrumentalness"), (price / 16000.0).alias("liveness"), (size / 400.0).alias("valence"),
        (size * 4.0).alias("tempo"), (F.col("p_size") % 2).cast("bigint").alias("mode"),
        (F.col("p_size") % 5).cast("bigint").alias("time_signature"), F.col("p_size").cast("bigint").alias("track_pop"),
    )


AUDIO = """
audio AS (
  SELECT CAST(p_partkey AS VARCHAR) AS track_uri, p_size / 50.0::DOUBLE AS danceability, p_retailprice / 4000.0::DOUBLE AS energy,
         CAST(p_size % 12 AS DOUBLE) AS key, -CAST(p_size AS DOUBLE) AS loudness, p_size / 100.0::DOUBLE AS speechiness,
         p_retailprice / 8000.0::DOUBLE AS acousticness, p_size / 200.0::DOUBLE AS instrumentalness,
         p_retailprice / 16000.0::DOUBLE AS liveness, p_size / 400.0::DOUBLE AS valence, p_size * 4.0::DOUBLE AS tempo,
         CAST(p_size % 2 AS BIGINT) AS mode, CAST(p_size % 5 AS BIGINT) AS time_signature, CAST(p_size AS BIGINT) AS track_pop
  FROM part)
"""


def artists(spark: SparkSession, sf: str) -> DataFrame:
    """An artist feature table: popularity, followers, and genres as the text of a list."""
    supplier = table(spark, sf, "supplier")
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    joined = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    genres = F.when(F.col("s_nationkey") % 5 == 0, F.lit("[]")).otherwise(
        F.concat(F.lit("['"), F.lower("n_name"), F.lit("', '"), F.lower(F.replace(F.col("s_name"), F.lit("#"), F.lit(" "))), F.lit("']"))
    )
    return joined.select(
        F.col("s_suppkey").cast("string").alias("artist_uri"), F.col("s_nationkey").cast("bigint").alias("artist_pop"),
        F.col("s_acctbal").alias("followers"), genres.alias("genres"), F.col("s_name").alias("artist_name"),
    )


ARTISTS = """
artists AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS artist_uri, CAST(s_nationkey AS BIGINT) AS artist_pop, s_acctbal AS followers,
         CASE WHEN s_nationkey % 5 = 0 THEN '[]'
              ELSE '[''' || lower(n_name) || ''', ''' || lower(replace(s_name, '#', ' ')) || ''']' END AS genres,
         s_name AS artist_name
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)
"""


def names(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    return part.select(F.col("p_partkey").alias("track_id"), "p_name", "p_brand")


def tracks(spark: SparkSession, sf: str, cut: Lists | None = None, of_list: DataFrame | None = None) -> DataFrame:
    """List items in the source's shape: text keys and names. `cut` are the lists with names, if they are there already;
    `of_list` is as in `fan_out`."""
    return fan_out(cut or item_lists(spark, sf, names(spark, sf)), of_list=of_list).select(
        "pid", "pos", F.col("track_id").cast("string").alias("track_uri"), F.col("p_name").alias("track_name"),
        F.col("artist_id").cast("string").alias("artist_uri"), F.col("p_brand").alias("album_uri"),
        F.lower("p_brand").alias("album_name"), F.col("duration").alias("duration_ms"),
        *[c for c in (of_list.columns if of_list is not None else []) if c != "pid"],
    )


TRACKS = ITEMS + """,
tracks AS (
  SELECT pid, pos, CAST(track_id AS VARCHAR) AS track_uri, p_name AS track_name, CAST(artist_id AS VARCHAR) AS artist_uri,
         p_brand AS album_uri, lower(p_brand) AS album_name, duration AS duration_ms
  FROM items JOIN part ON track_id = p_partkey)
"""


def lists(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    return customer.select(
        F.col("c_custkey").alias("pid"), F.col("c_name").alias("name"),
        F.when(F.col("c_mktsegment") == "BUILDING", "true").otherwise("false").alias("collaborative"),
    )


def text_of(values: Column | str) -> Column:
    """An array as comma-separated text, for results that are compared as text."""
    values = F.col(values) if isinstance(values, str) else values
    return F.array_join(values.cast("array<string>"), ",")


def whole_text(values: Column | str) -> Column:
    values = F.col(values) if isinstance(values, str) else values
    return F.array_join(values.cast("array<bigint>").cast("array<string>"), ",")


def micro_text(values: Column | str) -> Column:
    """Real numbers in millionths, as comma-separated text."""
    return F.array_join(F.transform(values, lambda v: F.round(v * 1e6).cast("bigint").cast("string")), ",")


def sql_text(values: str) -> str:
    return f"array_to_string(list_transform({values}, lambda v: CAST(v AS VARCHAR)), ',')"


def sql_whole(values: str) -> str:
    return f"array_to_string(list_transform({values}, lambda v: CAST(CAST(v AS BIGINT) AS VARCHAR)), ',')"


def sql_micro(values: str) -> str:
    return f"array_to_string(list_transform({values}, lambda v: CAST(CAST(round(v * 1e6) AS BIGINT) AS VARCHAR)), ',')"
