"""Ordered lists as scans: positions, history, running aggregates, chunks.

A list ("playlist") is a key `pid` and an order. All lists together are sorted once by (list, order) and cut into ranges,
the pieces; a list of any length, be its key NULL, lies in one piece or in some that follow each other. Windows run
inside (list, piece). What a piece must know of the pieces before it comes as extra rows: at most one list goes on from
one piece to the next, so there is at most one carried row of sums for a piece, the last n items for its history, and
the values already seen for its distinct counts. No list is looked at for its size and none takes another path.

Lists are best cut with their keys alone: `attach` joins the columns of feature tables to the cut rows, so wide rows are
moved once, by (list, piece), and only the columns that are asked for; columns of the list itself come as one row a piece.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from segue.session import stash

CHUNK, STRETCH = 250, 16
PIECE, LEAD, PLACE, AT, HELD = "_piece", "_lead", "_place", "_at_row", "_held"


@dataclass(frozen=True)
class Lists:
    """Lists cut into pieces. `cut` and `shared` are written tables, and `rows` is `cut` with what was attached; `shared`
    holds the rows of the lists that lie in several pieces, which are fewer than pieces. Without `dense`, positions were
    given and may have gaps; else AT numbers the rows in the order of their lists."""

    cut: DataFrame
    rows: DataFrame
    shared: DataFrame
    pid: str
    order: tuple[str, ...]
    pos: str
    dense: bool

    @property
    def columns(self) -> list[str]:
        names = [c for c in self.rows.columns if c not in (PIECE, AT)]
        return [*names, self.pos] if self.dense else names


def cut_lists(
    df: DataFrame, pid: str, order: Sequence[str], pos: str = "pos", pieces: int | None = None, keep: Sequence[str] | None = None
) -> Lists:
    """Sort the rows by list and order and cut them into ranges; `order` must be total within a list.

    A column called `pos` is taken as the given positions, by which the lists are ordered; else positions are counted.
    Each range is a task's share by the shuffle settings, or there are `pieces` of them. `keep` names the columns that the
    cut rows keep (default: all); the order is kept in any case.
    """
    dense = pos not in df.columns
    order = tuple(order) if dense else (pos,)
    by = [pid, *order]
    ranged = df.repartitionByRange(pieces, *by) if pieces else df.repartitionByRange(*by)
    if dense:  # one number stands for the order from here on
        ranged = ranged.sortWithinPartitions(*by).withColumn(AT, F.monotonically_increasing_id())
        order = (AT,)
        ranged = ranged.select(*keep, AT) if keep is not None else ranged
    rows = stash(ranged.withColumn(PIECE, F.spark_partition_id()), "lists")
    ends = rows.groupBy(PIECE).agg(F.min(F.struct(pid)).alias("first"), F.max(F.struct(pid)).alias("last"))
    before = F.lag("last").over(W.partitionBy(F.lit(0)).orderBy(PIECE))  # a row for each piece
    going = ends.withColumn("before", before).where(F.col("before").isNotNull() & F.col(f"first.{pid}").eqNullSafe(F.col(f"before.{pid}")))
    going = going.select(F.col(f"first.{pid}").alias("_going")).distinct()
    shared = rows.join(F.broadcast(going), F.col(pid).eqNullSafe(F.col("_going")), "left_semi")
    return Lists(rows, rows, stash(shared, "shared-lists"), pid, order, pos, dense)


def attach(lists: Lists, join: Callable[[DataFrame], DataFrame]) -> Lists:
    """The lists after `join`, which joins feature tables to their rows; rows that it drops or repeats are so in the lists.

    The joins run when the rows are read, and read just the columns that are used then; only the rows of lists in several
    pieces are joined at once and written.
    """
    return replace(lists, rows=join(lists.rows), shared=stash(join(lists.shared), "shared-lists"))


def _carried(lists: Lists, totals: DataFrame, values: Sequence[str]) -> DataFrame:
    """Sums of (pid, piece, values...) over a list's earlier pieces, a row for each piece that goes on with a list."""
    before = W.partitionBy(lists.pid).orderBy(PIECE).rowsBetween(W.unboundedPreceding, -1)
    piece = W.partitionBy(lists.pid).orderBy(PIECE)
    sums = totals.withColumns({v: F.sum(v).over(before) for v in values} | {"_no": F.row_number().over(piece)})
    return sums.where("_no > 1").drop("_no")


def _shared_positions(lists: Lists) -> DataFrame:
    """The rows of `shared` with their positions in PLACE."""
    if not lists.dense:
        return lists.shared.withColumn(PLACE, F.col(lists.pos))
    inside = F.row_number().over(W.partitionBy(lists.pid, PIECE).orderBy(*lists.order))
    counts = lists.shared.groupBy(lists.pid, PIECE).agg(F.count(F.lit(1)).alias("_n"))
    carried = _carried(lists, counts, ["_n"]).select(F.col(lists.pid).alias("_list"), F.col(PIECE).alias("_at"), "_n")
    met = (F.col(PIECE) == F.col("_at")) & F.col(lists.pid).eqNullSafe(F.col("_list"))
    joined = lists.shared.withColumn("_r", inside).join(F.broadcast(carried), met, "left")
    return joined.withColumn(PLACE, (F.col("_r") - 1 + F.coalesce("_n", F.lit(0))).cast("bigint")).drop("_r", "_n", "_list", "_at")


def _earlier_items(lists: Lists, n: int) -> DataFrame:
    """The last n positions before each piece that goes on with a list, as rows of that piece."""
    placed = _shared_positions(lists)
    starts = placed.groupBy(lists.pid, PIECE).agg(F.min(PLACE).alias("_start"))
    starts = starts.withColumn("_no", F.row_number().over(W.partitionBy(lists.pid).orderBy(PIECE))).where("_no > 1")
    back = F.explode(F.sequence(F.col("_start") - n, F.col("_start") - 1)).alias("_wanted")
    wanted = starts.select(F.col(lists.pid).alias("_list"), F.col(PIECE).alias("_to"), back)
    met = (F.col(PLACE) == F.col("_wanted")) & F.col(lists.pid).eqNullSafe(F.col("_list"))
    found = placed.join(wanted, met).drop(PIECE, "_list", "_wanted").withColumnRenamed("_to", PIECE)
    return found.withColumn(LEAD, F.lit(1))


def _seen_values(lists: Lists, column: str, name: str) -> tuple[DataFrame, DataFrame]:
    """(rows that say which values earlier pieces have, number of new values in each piece)."""
    held = lists.shared.where(F.col(column).isNotNull()).select(lists.pid, PIECE, column).distinct()
    first = F.row_number().over(W.partitionBy(lists.pid, column).orderBy(PIECE))
    numbered = held.withColumn("_no", first)
    new = numbered.groupBy(lists.pid, PIECE).agg(F.sum(F.when(F.col("_no") == 1, 1.0).otherwise(0.0)).alias(name))
    return numbered.where("_no > 1").drop("_no").withColumn(LEAD, F.lit(0)), new


def fan_out(
    lists: Lists, history: Mapping[str, str | Column] | None = None, n: int = 5, rank: str | None = None,
    sums: Mapping[str, str] | None = None, distincts: Mapping[str, str] | None = None, count: str | None = None,
    of_list: DataFrame | None = None,
) -> DataFrame:
    """Every item with its position, its history and aggregates over all earlier items of its list.

    `history` maps an array's name to an item column: the items at positions [pos-n, pos-1] in order, so gaps stay gaps;
    `rank` names an array of their distances. `sums` and `distincts` map a result to the column that is added up or
    counted once for each value (NULL is not counted), `count` names the number of earlier items. `of_list` is a table with
    the list's key, whose other columns come to each item as by an inner join on that key: its rows go to the pieces of
    their list, so the items do not move for it.

    All of it is one shuffle by (list, piece): a distinct count is the running sum of "first time seen" flags.
    """
    history, sums, distincts = dict(history or {}), dict(sums or {}), dict(distincts or {})
    pid, pos = lists.pid, lists.pos
    counted = {name: f"_c_{name}" for name in [*sums, *distincts, *([count] if count else []), *([PLACE] if lists.dense else [])]}
    totals = {name: F.sum(F.col(c).cast("double")) for name, c in sums.items()}
    totals |= {name: F.count(F.lit(1)).cast("double") for name in counted if name in (count, PLACE)}

    extra, carried = [], lists.shared.groupBy(pid, PIECE).agg(F.lit(1).alias("_one"), *[t.alias(f"_c_{name}") for name, t in totals.items()])
    for name, column in distincts.items():
        seen, new = _seen_values(lists, column, f"_c_{name}")
        extra.append(seen)
        new = new.select(F.col(pid).alias("_list"), F.col(PIECE).alias("_at"), f"_c_{name}")
        met = (F.col(PIECE) == F.col("_at")) & F.col(pid).eqNullSafe(F.col("_list"))
        carried = carried.join(new, met, "left").drop("_list", "_at").fillna(0.0, [f"_c_{name}"])
    if counted:
        extra.append(_carried(lists, carried.drop("_one"), list(counted.values())).withColumn(LEAD, F.lit(0)))
    if history:
        extra.append(_earlier_items(lists, n))
    if of_list is not None:
        row = F.struct(*[c for c in of_list.columns if c != pid])
        named = of_list.groupBy(pid).agg(F.collect_list(row).alias(HELD))
        extra.append(lists.cut.select(pid, PIECE).distinct().join(named, pid).withColumn(LEAD, F.lit(-1)))
    rows = lists.rows.withColumns({LEAD: F.lit(1), "_own": F.lit(True)})
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), extra, rows)
    if PLACE not in rows.columns:
        rows = rows.withColumn(PLACE, F.lit(None).cast("bigint"))

    if distincts:  # else each window over a value would shuffle for itself
        rows = rows.repartition(pid, PIECE)
    along = [LEAD, *lists.order]
    own = F.coalesce("_own", F.lit(False))
    for name, column in distincts.items():
        first = F.row_number().over(W.partitionBy(pid, PIECE, column).orderBy(*along)) == 1
        rows = rows.withColumn(f"_f_{name}", (first & F.col(column).isNotNull()).cast("double"))
    measures = {name: F.col(c).cast("double") for name, c in sums.items()} | {name: F.col(f"_f_{name}") for name in distincts}
    earlier = W.partitionBy(pid, PIECE).orderBy(*along).rowsBetween(W.unboundedPreceding, -1)
    added = {}
    for name, held in counted.items():
        measure = F.when(own, measures.get(name, F.lit(1.0))).otherwise(F.col(held))
        added[name] = F.coalesce(F.sum(measure).over(earlier), F.lit(0.0))
    if lists.dense:
        added[pos] = F.coalesce(PLACE, added.pop(PLACE).cast("bigint"))
    rows = rows.withColumns(added)
    if of_list is not None:  # the list's own row is the first of its piece
        rows = rows.withColumn(HELD, F.first(HELD, ignorenulls=True).over(earlier))
    if history:
        frame = W.partitionBy(pid, PIECE).orderBy(*along).rowsBetween(-n, -1) if lists.dense else W.partitionBy(pid, PIECE).orderBy(pos).rangeBetween(-n, -1)
        # an array for each attribute, so those that are not used are not made; inside structs NULLs stay
        attrs = {"_p": F.col(pos), **{name: F.col(c) if isinstance(c, str) else c for name, c in history.items()}}
        held = {f"_h_{name}": F.collect_list(F.when(F.col(LEAD) == 1, F.struct(c.alias("v")))).over(frame) for name, c in attrs.items()}
        rows = rows.withColumns(held)
        out = {name: F.col(f"_h_{name}.v") for name in history}
        if rank:
            out[rank] = F.transform("_h__p.v", lambda p: (F.col(pos) - p).cast("double"))
        rows = rows.withColumns(out)
    results = [*sums, *distincts, *([count] if count else []), *history, *([rank] if rank and history else [])]
    kept = [*lists.columns, *[c for c in results if c not in lists.columns]]
    if of_list is not None:
        return rows.where(own).select(*kept, F.inline(HELD))
    return rows.where(own).select(*kept)


def positions(df: DataFrame, pid: str, order: Sequence[str], pos: str = "pos") -> DataFrame:
    """Dense 0-based position of each row in its list; `order` must be total within a list."""
    return fan_out(cut_lists(df.drop(pos), pid, order, pos))


def with_history(df: DataFrame, pid: str, pos: str, attrs: Mapping[str, str | Column], n: int = 5, rank: str | None = None) -> DataFrame:
    """`fan_out` of the history alone, for rows whose positions are given."""
    return fan_out(cut_lists(df, pid, [pos], pos), attrs, n, rank)


def with_prefix_aggregates(
    df: DataFrame, pid: str, pos: str, sums: Mapping[str, str], distincts: Mapping[str, str], count: str | None = None
) -> DataFrame:
    """`fan_out` of the aggregates alone, for rows whose positions are given."""
    return fan_out(cut_lists(df, pid, [pos], pos), sums=sums, distincts=distincts, count=count)


def training_samples(
    lists: Lists, history: Mapping[str, str], sums: Mapping[str, str], distincts: Mapping[str, str], count: str = "n_items",
    rank: str | None = "candidate_rank", n: int = 5, full_only: bool = True, of_list: DataFrame | None = None,
) -> DataFrame:
    """One sample per item that has earlier items: history arrays plus aggregates over all earlier items.

    With `full_only` just the samples with exactly n history items stay; otherwise those with at least one
    earlier item.
    """
    out = fan_out(lists, history, n, rank, sums, distincts, count, of_list)
    first = next(iter(history))
    return out.where(F.size(first) == n) if full_only else out.where(F.col(count) > 0)


def near_pairs(
    df: DataFrame, pid: str, pos: str, n: int, left: Sequence[str], right: Mapping[str, str], stretch: str | None = None
) -> DataFrame:
    """Pairs (item, earlier item) at most n positions apart; items without a list or a position have none.

    Lists are cut into stretches of STRETCH * n positions, and the last n positions of a stretch go to the next one as
    well, so items move once and pairs are made inside a stretch: n rows per item, not every pair of a list, and no task
    heavier than a stretch. With `stretch`, that column numbers them: all pairs of an item are in one.
    """
    size, held = STRETCH * n, stretch or "_stretch"
    own = F.floor(F.col(pos) / size).cast("bigint")
    places = F.when(F.col(pos) - own * size >= size - n, F.array(own, own + 1)).otherwise(F.array(own))
    sides = {f"_l_{c}": F.col(c) for c in left} | {f"_r_{name}": F.col(c) for name, c in right.items()}
    rows = df.where(F.col(pid).isNotNull() & F.col(pos).isNotNull()).select(pid, pos, *[c.alias(name) for name, c in sides.items()])
    rows = rows.select("*", F.posexplode(places).alias("_again", held))
    item = F.struct(F.col(pos).alias(f"{pos}_pl"), *[F.col(f"_r_{name}").alias(name) for name in right])
    found = F.collect_list(item).over(W.partitionBy(pid, held).orderBy(pos).rangeBetween(-n, -1))
    paired = rows.withColumn("_near", found).where("_again = 0")
    kept = [pid, pos, *[F.col(f"_l_{c}").alias(c) for c in left], *([held] if stretch else [])]
    return paired.select(*kept, F.inline("_near"))


def chunk_lists(
    df: DataFrame, pid: str, pos: str, fields: Sequence[str], out: str = "tracks", chunk: int = CHUNK, keep: Sequence[str] = ()
) -> DataFrame:
    """Nested form: one row per list and run of `chunk` positions, items in order.

    A list of up to `chunk` items is one row; a longer one continues in further rows, so no row is unbounded. `keep` names
    columns that are the same for all items of a row; rows that lie by one of them already do not move.
    """
    item = F.struct(F.col(pos), *[F.col(f) for f in fields if f != pos])
    placed = df.withColumn("chunk", F.floor(F.col(pos) / chunk).cast("bigint"))
    return placed.groupBy(pid, "chunk", *keep).agg(F.array_sort(F.collect_list(item)).alias(out))


def sorted_chunks(
    df: DataFrame, pid: str, order: Sequence[str], fields: Sequence[str], out: str = "tracks", chunk: int = CHUNK
) -> DataFrame:
    """Lists sorted by other columns than their position: the rows of a list, one after another, are in one order."""
    ranked = positions(df, pid, order, "rank")
    return chunk_lists(ranked, pid, "rank", fields, out, chunk)


def unchunk_lists(df: DataFrame, out: str = "tracks") -> DataFrame:
    """Flat rows again, the inverse of `chunk_lists`."""
    return df.drop("chunk").select("*", F.inline(out)).drop(out)


def prefix_in_chunk(df: DataFrame, pid: str, pos: str, attr: str, out: str = "prefix", chunk: int = CHUNK) -> DataFrame:
    """All earlier items, as the earlier items of the own chunk plus the number of whole chunks before it.

    The whole prefix is the earlier rows of `chunk_lists` followed by this array. Lists within one chunk get the
    plain prefix; longer ones stay linear in size instead of quadratic.
    """
    placed = df.withColumn("chunk", F.floor(F.col(pos) / chunk).cast("bigint"))
    w = W.partitionBy(pid, "chunk").orderBy(pos).rowsBetween(W.unboundedPreceding, -1)
    return placed.withColumn(out, F.collect_list(attr).over(w))


def last_n(df: DataFrame, pid: str, pos: str, attrs: Mapping[str, str], n: int = 5) -> DataFrame:
    """One query row per list: arrays of its last n items in order of position."""
    w = W.partitionBy(pid).orderBy(F.desc(pos))
    tail = df.withColumn("_back", F.row_number().over(w)).where(F.col("_back") <= n)
    item = F.struct(F.col(pos).alias("_p"), *[F.col(c).alias(name) for name, c in attrs.items()])
    grouped = tail.groupBy(pid).agg(F.array_sort(F.collect_list(item)).alias("_items"))
    return grouped.select(pid, *[F.col(f"_items.{name}").alias(name) for name in attrs])


def sample_per_list(df: DataFrame, pid: str, pos: str, k: int = 5, seed: int = 42) -> DataFrame:
    """At most k rows of each list, in a repeatable hash order."""
    order = F.md5(F.concat_ws("-", F.col(pid).cast("string"), F.col(pos).cast("string"), F.lit(str(seed))))
    w = W.partitionBy(pid).orderBy(order, pos)
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r")
