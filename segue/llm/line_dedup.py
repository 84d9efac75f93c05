"""Line dedup: a deletion-neighbourhood join that keeps the earliest of equal and nearly equal lines.

Everything here is DataFrame functions. Two lines are within one edit if deleting some character makes them equal, or
makes one equal to the other. The neighbourhood is positional: a line of n characters emits, for M = n and M = n + 1 and
each place e below M, a hash of (M, e, its first e characters, its last M - e - 1). For M = n that is the line without
character e; for M = n + 1 it is the line itself, opened at e. Lines that share such a key are within one edit of each
other, all of them, so only the earliest of a group counts and no pairs within a group are listed.

All these keys of all lines would be some hundred times the corpus. So they are emitted from coarse to fine: first for
two blocks of places, then for about sqrt(M) blocks of lines that shared a key, then for the single places of blocks
that did. A key of a block covers what lies outside it, so lines with a common fine key have a common coarse one: the
coarse rounds drop only lines that cannot have a neighbour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segue.session import stash

#: Shorter lines that nearly equal others may well say something else; a caller may ask for them too.
MIN_CHARS = 16
BITMAP_BITS, BUCKET_BITS = 1 << 24, 32_768  # 512 bitmaps of 4 kB


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def normal(line: Column) -> Column:
    """What is compared: the line without white space at its ends."""
    return F.trim(line, F.lit(" \t\r\f\v"))


def numbered_lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, th, no, line, h1): the lines that are not blank; id and the text's hash th name the document."""
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("t")).where("t is not null")
    rows = rows.select("id", F.xxhash64("t").alias("th"), F.posexplode(lines_of(F.col("t"))).alias("no", "raw"))
    rows = rows.select("id", "th", "no", normal(F.col("raw")).alias("line")).where("line <> ''")
    return rows.withColumn("h1", F.xxhash64("line"))


def half_keys(min_chars: int) -> Column:
    """Keys of the first and of the second half, for M = n and n + 1: a line within one edit shares one of these."""
    n = F.char_length("line")
    key = lambda side, part: F.xxhash64(F.lit(side), part)
    keys = [key(side, F.expr(f"{side}(line, (char_length(line) + {more}) div 2)")) for side in ("left", "right") for more in (0, 1)]
    return F.when(n >= min_chars, F.array_distinct(F.array(*keys)))


def shared(rows: DataFrame, by: list[str]) -> DataFrame:
    """The keys that different lines have; one row for each key and task is shuffled, whatever the size of a group."""
    sides = rows.groupBy(*by).agg(F.min("h1").alias("low"), F.max("h1").alias("high"))
    return sides.where("low <> high").select(*by)


def listed(found: DataFrame, h: str) -> tuple[DataFrame, Column, Column]:
    """Bitmaps of a set of hashes: at most 512 rows of 4 kB, so they may be broadcast whatever the set's size.

    Returns the bitmaps, a hash's bitmap number, and the test of its bit. Other hashes pass too when they share a bit;
    an exact join follows.
    """
    place = lambda c: F.pmod(c, F.lit(BITMAP_BITS))
    number = F.floor(place(F.col(h)) / BUCKET_BITS)
    bit = F.pmod(place(F.col(h)), F.lit(BUCKET_BITS))
    maps = found.select(number.alias("map"), bit.alias("bit")).groupBy("map").agg(F.bitmap_construct_agg("bit").alias("bits"))
    byte = F.conv(F.hex(F.substring("bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return maps, number, F.getbit(byte, F.pmod(bit, F.lit(8)).cast("int")) == 1


def near_lines(docs: DataFrame, distinct: DataFrame, key: str, text: str) -> DataFrame:
    """(h1): lines within one edit of a line that stands earlier, among those with half keys."""
    keyed = distinct.select("h1", F.explode("halves").alias("k"))
    maybe = keyed.join(shared(keyed, ["k"]), "k").select("h1").distinct()
    maybe = stash(distinct.join(maybe, "h1", "left_semi").select("h1", "place"), "maybe-near")

    maps, number, has_bit = listed(maybe, "h1")
    lines = numbered_lines(docs, key, text).select("line", "h1").withColumn("n_map", number)
    texts = lines.join(F.broadcast(maps), F.col("n_map") == F.col("map")).where(has_bit)
    texts = texts.groupBy("h1").agg(F.min("line").alias("line"))
    texts = stash(texts.join(maybe, "h1"), "near-texts")

    # about sqrt(M) blocks of places: what lies before and behind the block
    opened = texts.select("h1", "line", F.explode(F.array(F.char_length("line"), F.char_length("line") + 1)).alias("m"))
    opened = opened.withColumn("w", F.ceil(F.sqrt("m")).cast("int"))
    opened = opened.select("h1", "line", "m", "w", F.explode(F.expr("sequence(0, cast((m - 1) div w as int))")).alias("j"))
    outside = F.xxhash64("m", "j", F.expr("left(line, j * w)"), F.expr("right(line, m - least(m, (j + 1) * w))"))
    blocks = stash(opened.select("h1", "m", "w", "j", outside.alias("k")), "line-blocks")
    blocks = blocks.join(shared(blocks, ["k"]), "k").select("h1", "m", "w", "j")

    # the single places of those blocks: the deletion neighbourhood
    places = blocks.join(texts.select("h1", "line", "place"), "h1")
    places = places.select("h1", "line", "place", "m", F.explode(F.expr("sequence(j * w, least(m, (j + 1) * w) - 1)")).alias("e"))
    variant = F.xxhash64("m", "e", F.expr("left(line, e)"), F.expr("right(line, m - e - 1)"))
    variants = stash(places.select("h1", "place", variant.alias("v")), "variants")
    first = variants.groupBy("v").agg(F.min(F.struct("place", "h1")).alias("first"))
    links = variants.join(first, "v").where(F.col("first.place") < F.col("place"))
    links = links.select("h1", F.col("first.h1").alias("earlier")).distinct()

    # hashes may collide: the edit distance decides
    one = links.join(texts.select("h1", F.col("line").alias("own")), "h1")
    both = one.join(texts.select(F.col("h1").alias("earlier"), F.col("line").alias("other")), "earlier")
    return both.where(F.levenshtein("own", "other", 1) >= 0).select("h1").distinct()


def kept_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", edits: int = 1, min_chars: int = MIN_CHARS) -> DataFrame:
    """(id, th, kept): for each document its lines to keep, by number; blank lines and lines to remove are not named."""
    if edits not in (0, 1):
        raise ValueError("the edit bound is 0 or 1")
    lines = numbered_lines(docs, key, text).select(
        "h1", F.xxhash64(F.lit(1), "line").alias("h2"), F.struct("id", "th", "no").alias("place"), half_keys(min_chars).alias("halves")
    )
    distinct = lines.groupBy("h1", "h2").agg(F.min("place").alias("place"), F.first("halves").alias("halves"))
    distinct = stash(distinct, "distinct-lines")
    first = distinct
    if edits:
        first = distinct.join(near_lines(docs, distinct, key, text), "h1", "left_anti")
    return first.groupBy("place.id", "place.th").agg(F.collect_list("place.no").alias("kept"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", edits: int = 1, report: bool = False, min_chars: int = MIN_CHARS) -> DataFrame:
    """Every row, with the lines removed from its text that equal, or nearly equal, a line that stands earlier.

    Lines end at a line feed and are compared without white space at their ends. Order is by key (NULL first), then
    line number. A line goes when an equal line stands earlier, or a line within one edit (a character inserted, deleted or
    replaced), removed or not; edits=0 asks for equal lines only, and lines under `min_chars` characters only go when they
    equal an earlier one. Blank lines stay. A text whose lines all go becomes empty, a NULL text stays NULL. Rows that repeat a key
    with another text are ordered by a hash of it; identical rows keep the same lines. An empty table gives no rows.

    All columns are kept whatever they are called; with `report`, the result is (key, n_lines, n_removed, text) instead.
    The texts are shuffled once, to meet the numbers of their lines to keep.
    """
    kept = kept_lines(docs, key, text, edits, min_chars)
    rows = docs.select(F.struct("*").alias("doc"), F.col(key).alias("row_id"), F.xxhash64(F.col(text)).alias("row_th"))
    joined = rows.join(kept, F.col("row_id").eqNullSafe(F.col("id")) & (F.col("row_th") == F.col("th")), "left")
    split = joined.select("doc", "row_id", "kept", lines_of(F.col(f"doc.`{text}`")).alias("lines"))
    blank = F.filter(F.transform("lines", lambda x, i: F.when(normal(x) == "", i)), lambda i: i.isNotNull())
    keep = F.array_sort(F.concat(F.coalesce("kept", F.array().cast("array<int>")), blank))
    held = split.withColumn("keep", keep)
    left = F.array_join(F.transform("keep", lambda i: F.get("lines", i)), "\n")
    if report:
        n = F.coalesce(F.size("lines"), F.lit(0))
        removed = F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines") - F.size("keep"))
        return held.select(F.col("row_id").alias(key), F.when(F.col("lines").isNull(), 0).otherwise(n).alias("n_lines"), removed.alias("n_removed"), left.alias(text))
    return held.select(F.col("doc").withField(f"`{text}`", left).alias("doc")).select("doc.*")
