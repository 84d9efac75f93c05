"""Bitmaps of hashes, lower case, and the join that keeps hot keys out of single tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segue.operators.skew import dealt_groups as dealt_join  # noqa: F401

MAP_BITS = 32_768


def marked(rows: DataFrame, h: str, found: DataFrame, n: int) -> DataFrame:
    """The rows whose hash `h` may be among the `n` hashes of `found`, by bitmaps of 16 bits for each hash.

    Some others pass as well, so an exact join follows. The bitmaps are broadcast and have 32 MB at most; beyond some
    16 million hashes they only let more rows pass.
    """
    bits = min(1 << 28, max(1 << 20, 1 << (16 * max(n, 1) - 1).bit_length()))
    place = lambda c: F.pmod(c, F.lit(bits))
    bit = lambda c: F.pmod(place(c), F.lit(MAP_BITS))
    number = lambda c: F.floor(place(c) / F.lit(MAP_BITS))
    maps = found.select(number(F.col(h)).alias("_map"), bit(F.col(h)).alias("_bit"))
    maps = maps.groupBy("_map").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    held = rows.withColumn("_own", number(F.col(h))).join(F.broadcast(maps), F.col("_own") == F.col("_map"))
    return held.where(has_bit(F.col("_bits"), bit(F.col(h)))).select(*rows.columns)


def has_bit(bits: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, F.pmod(bit, F.lit(8)).cast("int")) == 1


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else; texts of ASCII alone take Spark's faster way."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
