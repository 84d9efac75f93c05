"""Reading list slices from JSON, and parsing tables whose lists are still text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segue.functions.scalars import parse_structs
from segue.schemas import SLICE, TRACK_FIELDS


def read_slices(spark: SparkSession, path: str, schema: T.StructType = SLICE, pattern: str = "*.json") -> DataFrame:
    """One row per list from files of {info, playlists[]}; each file is read once, many files in parallel.

    A file is one JSON document and so one task's work; the source cuts its data into files of 1,000 lists.
    """
    files = spark.read.schema(schema).option("multiLine", True).option("pathGlobFilter", pattern).json(path)
    return files.select(F.inline("playlists"))


def parse_items(df: DataFrame, col: str = "tracks", fields: Sequence[str] = TRACK_FIELDS) -> DataFrame:
    """The list column from text of a JSON array to array<struct> of text fields."""
    return df.withColumn(col, parse_structs(col, list(fields)))


def unnest_items(df: DataFrame, col: str = "tracks", keep: Sequence[str] = ("pid",)) -> DataFrame:
    """One row per list item, item fields as columns."""
    return df.select(*keep, F.inline(col))


def scan_by_suffix(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """Paths and sizes of the files under a folder whose names end with the suffix."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}")
    return files.load(path).select("path", "length")


def read_by_suffix(spark: SparkSession, path: str, suffix: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """The rows of those files; the reader picks them, so no path comes to the driver's code."""
    return spark.read.format(fmt).schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").load(path)


def normalize(df: DataFrame, col: str) -> DataFrame:
    """Nested fields of a struct column as flat columns named a.b.c."""

    def leaves(kind: T.DataType, path: str, label: str) -> list:
        if isinstance(kind, T.StructType):
            out = []
            for f in kind.fields:
                out += leaves(f.dataType, f"{path}.`{f.name}`", f"{label}.{f.name}" if label else f.name)
            return out
        return [F.col(path).alias(label)]

    others = [F.col(f"`{c}`") for c in df.columns if c != col]
    return df.select(*others, *leaves(df.schema[col].dataType, f"`{col}`", ""))
