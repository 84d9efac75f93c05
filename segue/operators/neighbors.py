"""Nearest neighbours by dot product: exact in blocks, approximate over leaves, and their comparison.

Exact search must score every query against every candidate, but never lists those pairs: both sides are written as
blocks of vectors, each task reads some blocks of each side, multiplies them pair by pair, and passes on at most k rows per
query. So a vector moves once, however many blocks the other side has.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from segue.functions.vectors import dot
from segue.session import stash

BLOCK = 32_768
SPREAD = 512
TILE = 4_000_000
BLOB_BYTES = 8 << 20  # of vectors in one row
TOGETHER = 8  # blocks of candidates that a task holds
DIGITS = 9
SPAN, PAIRS = 32, 100_000
RECALL = 0.95  # aimed at on a sample, so that all queries together stay above 0.9
SAMPLE = 1_000


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(flat), -1)


def _scores(queries: np.ndarray, items: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Rounded dot products, a strip of query rows at a time so the strip stays within TILE numbers."""
    strip = max(1, TILE // max(1, len(items)))
    for start in range(0, len(queries), strip):
        yield start, np.round(queries[start : start + strip] @ items.T, DIGITS)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the k best scores of each row, ties by id."""
    if scores.shape[1] > k:
        floor = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k][:, None]
        rows, cols = np.nonzero(scores >= floor)
    else:
        rows, cols = np.nonzero(np.ones_like(scores, dtype=bool))
    order = np.lexsort((ids[cols], -scores[rows, cols], rows))
    rows, cols = rows[order], cols[order]
    starts = np.searchsorted(rows, np.arange(len(scores)))
    keep = np.arange(len(rows)) - starts[rows] < k
    return rows[keep], cols[keep]


def _near_best(
    queries: np.ndarray, c: np.ndarray, longest: float, k: int, floor: np.ndarray, out: tuple[np.ndarray, np.ndarray]
) -> tuple[np.ndarray, np.ndarray] | None:
    """Row and column numbers of all scores that may be among the k best of a row, found in single precision: `c` are the
    items' vectors in it, of which the `longest` has that norm.

    Scores in `out` (rows, columns) do not count. A row needs no score below its `floor`. Of the largest scores of sets of SPAN
    columns, the k-th is a bound, as k scores reach it. None where this tells too little, as among many equal vectors.
    """
    q = queries.astype(np.float32)
    size = np.sqrt((queries**2).sum(1)) * longest
    wrong = (2 * q.shape[1] + 16) * 2.0**-24 * size + 2 * 10.0**-DIGITS  # by rounding, on either side
    if not (np.isfinite(wrong).all() and np.isfinite(q).all() and np.isfinite(c).all()):
        return None
    scores = q @ c.T
    scores[out] = -np.inf
    runs = scores.shape[1] // SPAN
    if runs > k:
        most = scores[:, : runs * SPAN].reshape(len(scores), SPAN, runs).max(1)
        floor = np.maximum(floor, np.partition(most, runs - k, axis=1)[:, runs - k] - wrong)
    found = scores >= (floor - wrong)[:, None].astype(np.float32) if len(c) else np.zeros(scores.shape, bool)
    found &= scores > -np.inf
    if found.sum() > max(4 * k * len(q), scores.size // 20):
        return None
    return np.nonzero(found)


def _dots(a: np.ndarray, b: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Rounded dot products of the named pairs."""
    parts = [np.einsum("ij,ij->i", a[rows[i : i + PAIRS]], b[cols[i : i + PAIRS]]) for i in range(0, len(rows), PAIRS)]
    return np.round(np.concatenate([np.empty(0), *parts]), DIGITS)


def _same(queries: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers where a query's id is the candidate's."""
    order = np.argsort(ids, kind="stable")
    low, high = (np.searchsorted(ids, queries, side, sorter=order) for side in ("left", "right"))
    size = high - low
    return np.repeat(np.arange(len(queries)), size), order[np.repeat(low - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]


class TopK:
    """The k best candidates of some queries, as blocks of candidates come; scores are rounded, ties go by id."""

    def __init__(self, queries: np.ndarray, vectors: np.ndarray, k: int):
        self.queries, self.vectors, self.k = queries, vectors, k
        self.row, self.id, self.score = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        self.floor = np.full(len(queries), -np.inf)

    def add(self, ids: np.ndarray, items: np.ndarray, skip_self: bool, copies: np.ndarray | None = None, at: np.ndarray | None = None) -> None:
        """With `copies`, candidate j counts copies[row, at[j]] times for a row."""
        strip, rough = max(1, TILE // max(1, len(ids))), (items.astype(np.float32), np.sqrt((items**2).sum(1).max(initial=0.0)))
        parts = [(self.row, self.id, self.score)]
        for start in range(0, len(self.queries), strip):
            here = slice(start, start + strip)
            q, times = self.vectors[here], copies[here][:, at] if copies is not None else None
            out = _same(self.queries[here], ids) if skip_self else (np.empty(0, np.int64), np.empty(0, np.int64))
            if times is not None and not times.all():
                gone = np.nonzero(times == 0)
                out = tuple(np.concatenate([x, y]) for x, y in zip(out, gone))
            found = _near_best(q, *rough, self.k, self.floor[here], out)
            if found is not None:
                score = _dots(q, items, *found)
            else:
                scores = np.round(q @ items.T, DIGITS)
                scores[out] = -np.inf
                found = _best(scores, ids, self.k)
                score = scores[found]
                found, score = tuple(x[score > -np.inf] for x in found), score[score > -np.inf]
            mine = found[0] + start, ids[found[1]], score
            if times is not None:
                mine = tuple(np.repeat(x, np.minimum(times[found], self.k)) for x in mine)
            parts.append(self._best_of([mine]))
        self.row, self.id, self.score = self._best_of(parts)
        last = np.flatnonzero(np.arange(len(self.row)) - np.searchsorted(self.row, self.row) == self.k - 1)
        self.floor[self.row[last]] = self.score[last]

    def _best_of(self, parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row, ids, score = (np.concatenate([part[i] for part in parts]) for i in range(3))
        order = np.lexsort((ids, -score, row))
        row = row[order]
        keep = np.arange(len(row)) - np.searchsorted(row, row) < self.k
        return row[keep], ids[order[keep]], score[order[keep]]

    def table(self) -> pa.Table:
        return pa.table({"query": pa.array(self.queries[self.row].astype(np.int64)), "id": pa.array(self.id.astype(np.int64)), "score": pa.array(self.score.astype(np.float64))})


def _packed(df: DataFrame, block: int) -> DataFrame:
    """(block, rows): the rows of each partition in blocks of at most about `block` rows and BLOB_BYTES of vectors."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(rows: pa.Table) -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(rows.combine_chunks())
            return pa.RecordBatch.from_pylist([{"block": uuid.uuid4().hex, "rows": sink.getvalue().to_pybytes()}])

        held = None
        for batch in batches:
            here = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, here]) if held is not None else here
            dims = len(pa.compute.list_flatten(batch.column("vector"))) // max(1, len(batch))
            most = max(1, min(block, BLOB_BYTES // max(1, 8 * dims)))
            while held.num_rows > most + most // 4:  # a small rest stays with its block
                yield row(held[:most])
                held = held[most:]
        if held is not None and held.num_rows:
            yield row(held)

    return df.mapInArrow(pack, "block string, rows binary")


def _block_count(df: DataFrame, block: int, spread: int = 0, rows: int | None = None) -> int:
    """Blocks of at most about `block` rows; with `spread`, smaller ones down to that size to keep all cores busy.
    `rows` may give an upper bound where counting means computing the frame."""
    rows = df.count() if rows is None else rows
    busy = min(df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / spread)) if spread else 1
    return max(1, math.ceil(rows / block), busy)


def _grid(
    queries: DataFrame, items: DataFrame, block: int, cell: Callable, merge: Callable, schema: str, query_rows: int | None = None
) -> DataFrame:
    """Run `cell(query block, item block)` for every pair of blocks; blocks are even because ids are hashed.

    Both sides are written as blocks and paired as they are read, so no side is copied for the other. A task takes some
    query blocks and TOGETHER item blocks, and `merge` makes one table of those it found for a query block.
    """
    nq, ni = _block_count(queries, block, SPREAD, query_rows), _block_count(items, block)
    left = stash(_packed(queries.repartition(nq, "query"), block), "query-blocks")
    right = stash(_packed(items.repartition(ni, "id"), block), "item-blocks").coalesce(math.ceil(ni / TOGETHER))

    def read(blob: pa.Scalar) -> pa.Table:
        return pa.ipc.open_stream(blob.as_buffer()).read_all()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, asked, found = None, None, []
        for batch in batches:
            for name, q, c in zip(*(batch.column(i) for i in range(3))):
                if name != last:
                    if found:
                        yield from merge(found).to_batches()
                    last, asked, found = name, read(q), []
                found.append(cell(asked, read(c)))
                if len(found) == TOGETHER:
                    found = [merge(found)]
        if found:
            yield from merge(found).to_batches()

    pairs = left.crossJoin(right.select(F.col("rows").alias("others")).hint("shuffle_replicate_nl"))
    return pairs.mapInArrow(meet, schema)


def _top_cell(k: int, skip_self: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def cell(q: pa.Table, c: pa.Table) -> pa.Table:
        ids = [x.column(name).to_numpy() for x, name in ((q, "query"), (c, "id"))]
        top = TopK(ids[0], _matrix(q.column("vector")) if q.num_rows else np.empty((0, 1)), k)
        if q.num_rows and c.num_rows:
            top.add(ids[1], _matrix(c.column("vector")), skip_self)
        return top.table()

    return cell


def _top_merge(k: int) -> Callable[[list[pa.Table]], pa.Table]:
    """The k best of each query among all that was found."""

    def merge(found: list[pa.Table]) -> pa.Table:
        rows = pa.concat_tables(found).combine_chunks()
        query, ids, score = (rows.column(c).to_numpy() for c in ("query", "id", "score"))
        order = np.lexsort((ids, -score, query))
        query = query[order]
        keep = np.arange(len(query)) - np.searchsorted(query, query) < k
        return rows.take(pa.array(order[keep]))

    return merge


def _ranked(found: DataFrame, k: int) -> DataFrame:
    w = W.partitionBy("query").orderBy(F.desc("score"), F.asc("id"))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _sound(df: DataFrame) -> DataFrame:
    """Rows whose vector can be scored: not NULL, and without NULL or NaN among its numbers."""
    return df.where(F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x)))


def _queries(df: DataFrame, id_col: str, vec: str) -> DataFrame:
    return _sound(df.select(F.col(id_col).cast("bigint").alias("query"), F.col(vec).cast("array<double>").alias("vector")))


def _items(df: DataFrame, id_col: str, vec: str) -> DataFrame:
    return _sound(df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec).cast("array<double>").alias("vector")))


def knn(
    queries: DataFrame,
    items: DataFrame,
    k: int = 10,
    query_id: str = "query",
    item_id: str = "id",
    vec: str = "embedding",
    skip_self: bool = False,
    block: int = BLOCK,
    query_rows: int | None = None,
) -> DataFrame:
    """Exact k best by dot product: (query, id, score, rank), scores to 9 digits, ties by id.

    Ids are whole numbers; number other ids with `dense_index` first. Vectors that are NULL or hold NULL or NaN
    neither ask nor are found.
    """
    found = _grid(
        _queries(queries, query_id, vec),
        _items(items, item_id, vec),
        block,
        _top_cell(k, skip_self),
        _top_merge(k),
        "query bigint, id bigint, score double",
        query_rows,
    )
    return _ranked(found, k)


def count_better(
    queries: DataFrame, items: DataFrame, true_score: str = "true_score", query_id: str = "query",
    item_id: str = "id", vec: str = "embedding", block: int = BLOCK,
) -> DataFrame:
    """(query, better): how many candidates of the whole catalogue score above the query's `true_score`."""

    def cell(q: pa.Table, c: pa.Table) -> pa.Table:
        ids, better = np.array([], np.int64), np.array([], np.int64)
        if q.num_rows and c.num_rows:
            ids = q.column("query").to_numpy()
            true = q.column("true_score").to_numpy()
            strips = _scores(_matrix(q.column("vector")), _matrix(c.column("vector")))
            better = np.concatenate([(s > true[i : i + len(s), None]).sum(axis=1) for i, s in strips])
        return pa.table({"query": pa.array(ids, pa.int64()), "better": pa.array(better, pa.int64())})

    left = _sound(queries.select(
        F.col(query_id).cast("bigint").alias("query"),
        F.col(vec).cast("array<double>").alias("vector"),
        F.col(true_score).cast("double").alias("true_score"),
    ))
    def merge(found: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(found).group_by("query").aggregate([("better", "sum")]).rename_columns(["query", "better"])

    found = _grid(left, _items(items, item_id, vec), block, cell, merge, "query bigint, better bigint")
    return found.groupBy("query").agg(F.sum("better").alias("better"))


@dataclass
class LeafIndex:
    """Vectors by leaf. `centroids` has at most `max_leaves` rows, `leaf_rows` as many counts."""

    centroids: np.ndarray
    leaf_rows: dict[int, int]
    items: DataFrame

    @property
    def leaves(self) -> int:
        return len(self.centroids)


def build_leaves(
    items: DataFrame,
    item_id: str = "id",
    vec: str = "embedding",
    leaf_size: int = 500,
    seed: int = 42,
    max_leaves: int = 4096,
    fit_rows_per_leaf: int = 256,
    path: str | None = None,
) -> LeafIndex:
    """Group the vectors around about n/leaf_size centres.

    Centres are learnt from a share of the rows when there are more than `fit_rows_per_leaf` per leaf; every row
    is then put into a leaf. Above max_leaves * leaf_size rows the leaves get larger instead of more, which keeps
    the centres small enough to send to each task. The placed vectors are written out, partitioned by leaf if a
    `path` is given, so that searches do not place them again.
    """
    base = _items(items, item_id, vec).withColumn("features", array_to_vector("vector"))
    n = base.count()
    leaves = min(max_leaves, max(1, math.ceil(n / leaf_size)))
    share = min(1.0, fit_rows_per_leaf * leaves / max(n, 1))
    fit_on = base if share == 1.0 else base.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(share * 1_000_000))
    model = KMeans(k=leaves, seed=seed, maxIter=10, featuresCol="features", predictionCol="leaf").fit(fit_on)
    placed = model.transform(base).select("id", "vector", "leaf")
    if path:
        placed.repartition("leaf", F.pmod(F.xxhash64("id"), F.lit(8))).write.mode("overwrite").partitionBy("leaf").parquet(path)
        placed = items.sparkSession.read.parquet(path).select("id", "vector", F.col("leaf").cast("int").alias("leaf"))
    else:
        placed = stash(placed, "leaves")
    sizes = {row.leaf: row.n for row in placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}
    return LeafIndex(np.array(model.clusterCenters()), sizes, placed)


def assign_leaves(queries: DataFrame, index: LeafIndex, count: int, enough: int = 1) -> DataFrame:
    """(query, vector, leaf): the `count` leaves with the best centre for each query, and further ones in that order
    until they hold `enough` items together."""
    centres = index.centroids
    count = min(count, len(centres))
    sizes = np.array([index.leaf_rows.get(leaf, 0) for leaf in range(len(centres))])

    @F.pandas_udf("array<int>")
    def best(vectors: pd.Series) -> pd.Series:
        order = np.argsort(-(np.stack(vectors.to_numpy()) @ centres.T), axis=1, kind="stable").astype(np.int32)
        needed = 1 + (np.cumsum(sizes[order], axis=1) < enough).sum(axis=1)
        return pd.Series([row[:n] for row, n in zip(order, np.maximum(count, needed))])

    return queries.withColumn("leaf", F.explode(best("vector")))


def leaves_for_recall(
    index: LeafIndex, queries: DataFrame, k: int = 10, target: float = RECALL, query_id: str = "query", vec: str = "embedding",
    skip_self: bool = False, sample: int = SAMPLE,
) -> int:
    """The fewest leaves to search per query that hold `target` of the true k best, measured on the index itself.

    The true neighbours of at most `sample` queries, the first by hash, are found exactly. A neighbour is found once its
    leaf is searched, so the place of that leaf in the query's order of leaves is all that has to be known.
    """
    asked = _queries(queries, query_id, vec).orderBy(F.xxhash64("query"), "query").limit(sample).collect()
    if not asked:
        return 1
    drawn = index.items.sparkSession.createDataFrame(asked, "query bigint, vector array<double>")
    exact = knn(drawn, index.items, k, "query", "id", "vector", skip_self, query_rows=len(asked))
    order = np.argsort(-(np.array([r.vector for r in asked]) @ index.centroids.T), axis=1, kind="stable")
    places = dict(zip((r.query for r in asked), np.argsort(order, axis=1)))
    found = exact.select("query", "id").join(index.items.select("id", "leaf"), "id").select("query", "leaf").collect()
    ranks = np.sort([places[r.query][r.leaf] for r in found])
    return int(ranks[math.ceil(target * len(ranks)) - 1]) + 1 if len(ranks) else 1


def search_leaves(
    index: LeafIndex,
    queries: DataFrame,
    k: int = 10,
    query_id: str = "query",
    vec: str = "embedding",
    leaf_pct: float | None = None,
    leaves: int | None = None,
    skip_self: bool = False,
    block: int = BLOCK,
    quantize: bool = False,
) -> DataFrame:
    """Approximate k best: score only the items in the best leaves of each query.

    `leaves` leaves are searched if given, or `leaf_pct` percent of them and at least one, else as many as
    `leaves_for_recall` finds necessary; more where these hold too few items for k results. A leaf with more than `block` items is cut into blocks, and so are the queries that ask it,
    by their own number, so a leaf that holds a third of all vectors is many tasks and a leaf that few ask is copied
    for few. `quantize` scores 8-bit copies of the vectors, for a first pass that is rescored later.
    """
    if leaves is None and leaf_pct is not None:
        leaves = max(1, math.ceil(index.leaves * leaf_pct / 100.0))
    count = leaves or leaves_for_recall(index, queries, k, query_id=query_id, vec=vec, skip_self=skip_self)
    asked = _queries(queries, query_id, vec)
    assigned = assign_leaves(asked, index, count, k + int(skip_self))
    blocks = lambda rows: F.ceil(rows / F.lit(block)).cast("int")
    held = index.items.groupBy("leaf").agg(blocks(F.count(F.lit(1))).alias("_pieces"))
    table = assigned.groupBy("leaf").agg(blocks(F.count(F.lit(1))).alias("_asking")).join(held, "leaf")
    left = assigned.join(table, "leaf").withColumn("_q", F.pmod(F.xxhash64("query"), F.col("_asking")).cast("int"))
    left = left.withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1))).select("query", "vector", "leaf", "_q", "_i")
    right = index.items.join(table, "leaf").withColumn("_i", F.pmod(F.xxhash64("id"), F.col("_pieces")).cast("int"))
    right = right.withColumn("_q", F.explode(F.sequence(F.lit(0), F.col("_asking") - 1))).select("id", "vector", "leaf", "_q", "_i")
    cell = _top_cell(k, skip_self)

    def short(q: pa.Table, c: pa.Table) -> pa.Table:
        return cell(q, _quantized(c)) if c.num_rows else cell(q, c)

    keys = ["leaf", "_q", "_i"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys))
    out = found.applyInArrow(short if quantize else cell, "query bigint, id bigint, score double")
    return _ranked(out, k)


def _quantized(items: pa.Table) -> pa.Table:
    values = _matrix(items.column("vector"))
    step = np.abs(values).max(axis=1, keepdims=True) / 127.0
    step[step == 0] = 1.0
    rounded = np.round(values / step).astype(np.int8) * step
    return pa.table({"id": items.column("id"), "vector": pa.array(list(rounded), pa.list_(pa.float64()))})


def rescore(found: DataFrame, queries: DataFrame, items: DataFrame, k: int, query_id: str, item_id: str, vec: str) -> DataFrame:
    """Exact scores for the found pairs, best k of them."""
    pairs = found.select("query", "id").join(_queries(queries, query_id, vec), "query")
    pairs = pairs.join(_items(items, item_id, vec).withColumnRenamed("vector", "_v"), "id")
    return _ranked(pairs.select("query", "id", F.round(dot("vector", "_v"), DIGITS).alias("score")), k)


def search_rerank(
    index: LeafIndex, queries: DataFrame, items: DataFrame, k: int = 10, reorder: int = 500, leaves: int | None = None,
    query_id: str = "query", item_id: str = "id", vec: str = "embedding", skip_self: bool = False,
) -> DataFrame:
    """Two stages: the best `reorder` by 8-bit vectors over `leaves` leaves, then exact scores for those. Without
    `leaves`, as many are searched as `leaves_for_recall` finds necessary for the k best."""
    leaves = leaves or leaves_for_recall(index, queries, k, query_id=query_id, vec=vec, skip_self=skip_self)
    first = search_leaves(index, queries, reorder, query_id, vec, leaves=leaves, skip_self=skip_self, quantize=True)
    return rescore(first, queries, items, k, query_id, item_id, vec)


def recall(approx: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: neighbours found by both, exact neighbours, and their ratio over all queries."""
    hit = approx.select("query", "id").distinct().withColumn("_hit", F.lit(1))
    both = exact.select("query", "id").join(hit, ["query", "id"], "left")
    counted = both.agg(F.count("_hit").alias("recalled"), F.count(F.lit(1)).alias("expected"))
    return counted.withColumn("recall", F.col("recalled") / F.col("expected"))


def compare_latency(timings: DataFrame, exact: str, approx: str) -> DataFrame:
    """Reduction %, increase % and times faster from an exact and an approximate time."""
    b, a = F.col(exact), F.col(approx)
    return timings.withColumns(
        {"reduction_pct": (b - a) / b * 100.0, "increase_pct": (b - a) / a * 100.0, "times_faster": b / a}
    )
