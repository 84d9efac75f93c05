"""Column functions for cleaning, parsing, bucketing and hashing; all stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The fillers that stand for missing text.
NONE_TEXT = "NONE"
MISSING_TEXT = "MISSING"
UNKNOWN_TEXT = "unknown"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to(c: Column | str, default: str = NONE_TEXT) -> Column:
    """Empty string becomes `default`; NULL stays NULL."""
    c = _col(c)
    return F.when(c == "", F.lit(default)).otherwise(c)


def null_to(c: Column | str, default) -> Column:
    return F.coalesce(_col(c), F.lit(default))


def as_double(c: Column | str) -> Column:
    return _col(c).cast("double")


def parse_structs(c: Column | str, fields: list[str]) -> Column:
    """Text of a JSON array of objects as array<struct>, every field a string."""
    element = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    return F.from_json(_col(c), T.ArrayType(element))


def parse_genres(c: Column | str) -> Column:
    """Text of a list: cut the outer brackets, split on commas; nothing inside gives ['NONE'].

    Quotes and blanks are kept as they stand; use `clean_genres` for bare names.
    """
    c = _col(c)
    parts = F.split(F.substring(c, F.lit(2), F.length(c) - 2), ",", -1)
    empty = c.isNull() | (F.element_at(parts, 1) == "")
    return F.when(empty, F.array(F.lit(NONE_TEXT))).otherwise(parts)


def clean_genres(c: Column | str) -> Column:
    """`parse_genres` without quotes and outer blanks."""
    return F.transform(parse_genres(c), lambda g: F.regexp_replace(F.trim(g), "^['\"]|['\"]$", ""))


def join_genres(c: Column | str) -> Column:
    return F.array_join(_col(c), ",", MISSING_TEXT)


def slug_genres(c: Column | str) -> Column:
    """Blanks inside a genre become '_', genres are joined with a blank, none gives 'unknown'."""
    c = _col(c)
    slugs = F.array_join(F.transform(c, lambda g: F.regexp_replace(g, " ", "_")), " ")
    return F.when(c.isNull() | (F.size(c) == 0), F.lit(UNKNOWN_TEXT)).otherwise(slugs)


def sample_id(pid: Column | str, pos: Column | str) -> Column:
    return F.concat_ws("-", _col(pid).cast("string"), _col(pos).cast("string"))


def strip_prefix(c: Column | str, prefix: str) -> Column:
    return F.replace(_col(c), F.lit(prefix), F.lit(""))


def uri_from_link(c: Column | str) -> Column:
    """Last path part of a link, without its query string."""
    return F.substring_index(F.substring_index(_col(c), "/", -1), "?", 1)


def lower_bool(c: Column | str) -> Column:
    return F.lower(_col(c).cast("string"))


def decode_utf8(c: Column | str) -> Column:
    return F.decode(_col(c), "UTF-8")


def round_half_even(c: Column | str, digits: int = 0) -> Column:
    return F.bround(_col(c), digits)


def clip(c: Column | str, low: float = -1e12, high: float = 1e12) -> Column:
    """Clamp to [low, high]; NULL stays NULL (least/greatest alone would skip it)."""
    c = _col(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def linspace(high: float, low: float = 0.0, count: int = 20) -> list[float]:
    """`count` evenly spaced boundaries from `low` to `high`, both included."""
    step = (high - low) / (count - 1)
    return [low + step * i for i in range(count - 1)] + [float(high)]


def bucketize(c: Column | str, high: float, low: float = 0.0, boundaries: int = 20) -> Column:
    """Number of `linspace` boundaries that are <= the value: 0 below `low`, `boundaries` from `high` on."""
    return F.width_bucket(as_double(c), F.lit(float(low)), F.lit(float(high)), F.lit(boundaries - 1)).cast("int")


def stable_hash(c: Column | str) -> Column:
    """Sixty bits of md5 as a number: the same in every SQL engine."""
    return F.conv(F.substring(F.md5(_col(c).cast("string")), 1, 15), 16, 10).cast("bigint")


def hash_bin(c: Column | str, bins: int, mask: str | None = None, portable: bool = False) -> Column:
    """Hash into `bins` bins. With `mask`, bin 0 is kept for that value and the rest use 1..bins-1.

    xxhash64 by default; `portable` takes the md5 form, which other engines can repeat.
    """
    text = _col(c).cast("string")
    hashed = stable_hash(text) if portable else F.xxhash64(text)
    if mask is None:
        return F.pmod(hashed, F.lit(bins)).cast("bigint")
    rest = F.lit(1) + F.pmod(hashed, F.lit(bins - 1))
    return F.when(text == mask, F.lit(0)).otherwise(rest).cast("bigint")


def keep_share(c: Column | str, rate: float, buckets: int = 1000, portable: bool = True) -> Column:
    """True for a repeatable share of the keys."""
    return hash_bin(c, buckets, portable=portable) < int(round(rate * buckets))
