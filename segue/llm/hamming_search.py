"""Exact top-k search among binary codes by incremental multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from segue.session import stash

BITS, SEGMENTS = 64, 4
WIDTH = BITS // SEGMENTS
SPLIT_ROWS = 50_000
GROUPS = 64


def sign_code(vector: Column) -> Column:
    """Bit i is 1 where component i (of the first 64) is above zero, as Spark holds NaN to be; it is 0 where a shorter vector
    has no component. NULL for a NULL vector."""
    bit = lambda i: F.when(F.get(vector, i) > 0, F.shiftleft(F.lit(1).cast("bigint"), i)).otherwise(F.lit(0).cast("bigint"))
    code = F.lit(0).cast("bigint")
    for i in range(BITS):
        code = code.bitwiseOR(bit(i))
    return F.when(vector.isNotNull(), code)


def masks(flips: int) -> np.ndarray:
    """All segment values with so many bits set."""
    return np.array([sum(1 << i for i in at) for at in combinations(range(WIDTH), flips)], np.int64)


def segments_of(codes: np.ndarray) -> np.ndarray:
    """The values of the segments of each code, one column for each segment."""
    shifts = np.arange(SEGMENTS, dtype=np.uint64) * np.uint64(WIDTH)
    return ((codes[:, None] >> shifts) & np.uint64((1 << WIDTH) - 1)).astype(np.int64)


def hamming_top_k(rows: DataFrame, asked: DataFrame, k: int = 10, key: str = "id", code: str = "code", split_rows: int = SPLIT_ROWS) -> DataFrame:
    """(query_id, rank, neighbor_id, distance): the k rows of other ids nearest to each asked row, ties by id.

    Rows without id or code are neither asked nor found, repeated rows count once, and an id may have several codes; those
    at the same distance from a query count once for it. A table with fewer than k other rows gives all of them; an empty one gives no rows.

    A code is cut in four segments. Round r looks up all values that differ from a segment of the query in exactly r
    bits. A code at distance d differs in at most d // 4 bits in some segment, so after round r every code within
    4 r + 3 has been seen, and a query ends when k rows lie within that whichever one id is left out, as its own is.

    Equal codes are one entry with its k + 1 smallest ids, which is all that any answer can use. Entries lie by segment
    and value; a value with very many codes is cut in parts and the query goes to each. Pairs are verified inside the
    tasks, which return 2 k rows for a query at most, of an id no more than k: without any one id, k are left. Only the
    number of unfinished queries comes to the driver.
    """
    clean = rows.select(F.col(key).cast("bigint").alias("id"), F.col(code).alias("code")).where("id is not null and code is not null").distinct()
    smallest = W.partitionBy("code").orderBy("id")
    members = clean.withColumn("r", F.row_number().over(smallest)).where(F.col("r") <= k + 1)
    codes = stash(members.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "codes")
    wanted = asked.select(F.col(key).cast("bigint").alias("query_id"), F.col(code).alias("q")).where("query_id is not null and q is not null").distinct()
    wanted = stash(wanted, "asked")
    most = clean.groupBy("id").agg(F.least(F.count(F.lit(1)), F.lit(k)).alias("n")).agg(F.sum("n")).first()[0] or 0

    def index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = segments_of(np.asarray(batch.column(0)).view(np.uint64))
            for segment in range(SEGMENTS):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(values), segment, np.int32)), pa.array(values[:, segment]), batch.column(0), batch.column(1)],
                    names=["segment", "value", "code", "ids"],
                )

    index = stash(codes.mapInArrow(index_rows, "segment int, value bigint, code bigint, ids array<bigint>"), "index")
    groups = max(GROUPS, -(-codes.count() // split_rows) * 4)
    hot = index.groupBy("segment", "value").agg(F.ceil(F.count(F.lit(1)) / split_rows).alias("parts")).where("parts > 1")
    group = F.pmod(F.xxhash64("value"), F.lit(groups)).alias("grp")
    one = F.coalesce(F.col("parts"), F.lit(1))
    dealt = index.join(hot, ["segment", "value"], "left").select("segment", group, F.pmod(F.xxhash64("code"), one).alias("part"), "value", "code", "ids")

    def probes(flips: int):
        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            flipped = masks(flips)
            for batch in batches:
                codes = np.asarray(batch.column(0))
                values = segments_of(codes.view(np.uint64))
                step = max(1, 100_000 // len(flipped))
                for segment in range(SEGMENTS):
                    for first in range(0, len(codes), step):
                        part = values[first : first + step, segment]
                        tried = (part[:, None] ^ flipped[None, :]).reshape(-1)
                        own = np.repeat(codes[first : first + step], len(flipped))
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(tried), segment, np.int32)), pa.array(tried), pa.array(own)], names=["segment", "value", "q"])

        return look

    def verify(asked_for: pa.Table, entries: pa.Table) -> pa.Table:
        entries = entries.sort_by("value")
        value, point = (np.asarray(entries.column(c).combine_chunks()) for c in ("value", "code"))
        lists = entries.column("ids").combine_chunks()
        offsets, ids = np.asarray(lists.offsets), np.asarray(lists.flatten())
        offsets = offsets - (offsets[0] if len(offsets) else 0)
        tried, q = (np.asarray(asked_for.column(c).combine_chunks()) for c in ("value", "q"))
        low, high = np.searchsorted(value, tried, "left"), np.searchsorted(value, tried, "right")
        hit = np.flatnonzero(high > low)
        best = (np.empty(0, np.int64),) * 3
        ends = np.cumsum(high[hit] - low[hit])
        first = 0
        while first < len(hit):
            last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + (1 << 17), "right")))
            at = hit[first:last]
            count = high[at] - low[at]
            entry = np.repeat(low[at] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
            who = np.repeat(q[at], count)
            far = np.bitwise_count(who.view(np.uint64) ^ point[entry].view(np.uint64)).astype(np.int64)
            size = offsets[entry + 1] - offsets[entry]
            member = np.repeat(offsets[entry] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            new = (np.repeat(who, size), np.repeat(far, size), ids[member])
            best = cut(*(np.concatenate(both) for both in zip(best, new)), k)
            first = last
        return pa.table(dict(zip(("q", "distance", "id"), best)))

    active, state = wanted.select("q").distinct(), None
    for flips in range(WIDTH + 1):
        tried = active.mapInArrow(probes(flips), "segment int, value bigint, q bigint").join(hot, ["segment", "value"], "left")
        tried = tried.select("segment", group, F.explode(F.sequence(F.lit(0).cast("bigint"), one - 1)).alias("part"), "value", "q")
        by = ["segment", "grp", "part"]
        found = tried.groupBy(*by).cogroup(dealt.groupBy(*by)).applyInArrow(verify, "q bigint, distance bigint, id bigint")
        found = found if state is None else found.unionByName(state)
        of_id = F.row_number().over(W.partitionBy("q", "id").orderBy("distance"))
        nearest = F.row_number().over(W.partitionBy("q").orderBy("distance", "id"))
        few = found.distinct().withColumn("r", of_id).where(F.col("r") <= k)
        state = stash(few.withColumn("r", nearest).where(F.col("r") <= 2 * k).drop("r"), "nearest")
        covered = SEGMENTS * (flips + 1) - 1
        sure = state.where(F.col("distance") <= covered).groupBy("q", "id").agg(F.count(F.lit(1)).alias("n"))
        whole = F.sum("n") >= min(2 * k, most)
        done = sure.groupBy("q").agg((whole | (F.sum("n") - F.max("n") >= k)).alias("done")).where("done").select("q")
        active = stash(active.join(done, "q", "left_anti"), "active")
        if active.isEmpty():
            break
    others = wanted.join(state, "q").where("id <> query_id")
    rank = W.partitionBy("query_id", "q").orderBy("distance", "id")
    ranked = others.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias("neighbor_id"), "distance")


def cut(q: np.ndarray, distance: np.ndarray, id_: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The first 2 k different rows of each q by (distance, id), with no more than k of an id."""
    order = np.lexsort((distance, id_, q))
    rows = [c[order] for c in (q, distance, id_)]
    keep = place(*rows) == 0
    rows = [c[keep] for c in rows]
    keep = place(rows[0], rows[2]) < k
    rows = [c[keep] for c in rows]
    order = np.lexsort((rows[2], rows[1], rows[0]))
    rows = [c[order] for c in rows]
    keep = place(rows[0]) < 2 * k
    return tuple(c[keep] for c in rows)


def place(*keys: np.ndarray) -> np.ndarray:
    """The number of each row in its run of equal keys."""
    if not len(keys[0]):
        return np.empty(0, np.int64)
    start = np.concatenate(([True], np.any([k[1:] != k[:-1] for k in keys], axis=0)))
    starts = np.flatnonzero(start)
    return np.arange(len(start)) - np.repeat(starts, np.diff(np.concatenate((starts, [len(start)]))))
