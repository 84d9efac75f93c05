"""Embedding near-dedup: an epsilon grid order join of unit vectors."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segue.llm.components import Forest, components
from segue.session import stash

BLOCK, BOX_DIMS, GRID_DIMS, FAN = 2048, 8, 2, 8
COPIES = 4  # of a block that may move, on average, to meet its partners
TOGETHER = 16  # blocks that a task holds of one side, where all are paired as they are read
SEQ = 1 << 20
ROUGH = 1e-6  # for each component, by which products of unit vectors in single precision may be off


def spread_axes(units: DataFrame, dims: int) -> np.ndarray:
    """The leading principal axes, largest first, from the second moments of all vectors.

    Tasks send sums for each pair of components; what comes to the driver is their total, dims x dims numbers.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims + 1, dims))
        for batch in batches:
            x = np.asarray(batch.column(0).flatten()).reshape(-1, dims)
            total[:dims] += x.T @ x
            total[dims] += x.sum(0)
        row, column = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(row.reshape(-1)), pa.array(column.reshape(-1)), pa.array(total.reshape(-1))], names=["i", "j", "s"])

    found = units.select("u").mapInArrow(sums, "i bigint, j bigint, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    total, n = np.zeros((dims + 1, dims)), units.count()
    for row in found.collect():
        total[row["i"], row["j"]] = row["s"]
    mean = total[dims] / max(n, 1)
    _, axes = np.linalg.eigh(total[:dims] / max(n, 1) - np.outer(mean, mean))
    return np.ascontiguousarray(axes[:, ::-1][:, :BOX_DIMS])


def read_block(blob: bytes, dims: int) -> np.ndarray:
    return np.frombuffer(blob, "<f8").reshape(-1, dims)


class PairJoin:
    """Links between two sequence intervals, found by halving both and skipping halves that are provably apart."""

    def __init__(self, a: np.ndarray, b: np.ndarray, axes: np.ndarray, cosine: float, same: bool, leaf: int = 256):
        self.a, self.b, self.cosine, self.same, self.leaf = a, b, cosine, same, leaf
        self.pa, self.pb = a @ axes, b @ axes
        self.reach = np.sqrt(max(0.0, 2 - 2 * cosine)) + 1e-9
        self.na, self.nb = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []
        # single precision tells what is far; only what may be near is compared in double precision
        self.fa, self.fb = a.astype(np.float32), b.astype(np.float32)
        self.rough = np.float32(cosine - ROUGH * a.shape[1])

    def apart(self, a: slice, b: slice) -> bool:
        pa_, pb_ = self.pa[a], self.pb[b]
        gap = np.maximum(0, np.maximum(pa_.min(0) - pb_.max(0), pb_.min(0) - pa_.max(0)))
        return float(gap @ gap) > self.reach**2

    def join(self, a: slice, b: slice) -> None:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            if self.same and b.stop <= a.start or self.apart(a, b):
                continue
            if a.stop - a.start <= self.leaf and b.stop - b.start <= self.leaf:
                if (self.fa[a] @ self.fb[b].T).max() < self.rough:
                    continue
                near = self.a[a] @ self.b[b].T >= self.cosine
                x, y = np.nonzero(near)
                x, y = x + a.start, y + b.start
                if self.same:
                    x, y = x[x < y], y[x < y]
                    self.na += np.bincount(x, minlength=len(self.na)) + np.bincount(y, minlength=len(self.na))
                else:
                    self.na += np.bincount(x, minlength=len(self.na))
                    self.nb += np.bincount(y, minlength=len(self.nb))
                self.pairs.append((x, y))
                continue
            halves = lambda s: [s] if s.stop - s.start <= self.leaf else [slice(s.start, (s.start + s.stop) // 2), slice((s.start + s.stop) // 2, s.stop)]
            todo += [(x, y) for x in halves(a) for y in halves(b)]


def _met(blocks: DataFrame, near: Column, compare: Callable, schema: str) -> DataFrame:
    """`compare(block, its data, up to FAN partners)` for all blocks whose boxes are `near`. Tasks read some blocks on either
    side, and hold those of one side; nothing is copied."""
    left = blocks.select(F.col("block").alias("a"), F.col("low").alias("al"), F.col("high").alias("ah"), F.col("data").alias("own"))
    right = blocks.select(F.col("block").alias("b"), F.col("low").alias("bl"), F.col("high").alias("bh"), "data")
    right = right.coalesce(math.ceil(blocks.count() / TOGETHER))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own, held = None, None, []
        for batch in batches:
            for i, name in enumerate(batch.column("a").to_pylist()):
                if held and (name != last or len(held) == FAN):
                    yield from compare(last, own, pa.concat_tables(held)).to_batches()
                    held = []
                if name != last:
                    last, own = name, batch.column("own")[i].as_py()
                held.append(pa.Table.from_batches([batch.slice(i, 1)]).select(["b", "data"]))
        if held:
            yield from compare(last, own, pa.concat_tables(held)).to_batches()

    pairs = left.join(right.hint("shuffle_replicate_nl"), (F.col("a") <= F.col("b")) & near)
    return pairs.select("a", "own", "b", "data").mapInArrow(meet, schema)


def link_embeddings(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = 0.9, block: int = BLOCK,
) -> DataFrame:
    """(key, n_links, component_id, kept): every row with the number of other rows whose cosine reaches the bound.

    component_id is the smallest key reachable by links, kept whether that is the row's own key. Vectors that are NULL
    or zero, that hold NULL or non-finite components, or whose length is not the most frequent one link with nothing.
    Rows that repeat a key are vectors of their own; a NULL key takes part, and its component has the smallest key that
    is not NULL. Other columns are not read. An empty table gives no rows.

    Unit vectors are sorted by the grid cells (as wide as the distance bound) of their leading principal components and
    cut into blocks in that order. Blocks meet if their boxes touch: a join on cells, each box also standing in the
    neighbouring ones. A task holds one block and up to eight partners, halves them recursively and compares in double
    precision only what is not provably apart. It returns counts and a spanning forest, never the pairs.

    Where blocks have few partners, they move to them. Where they have more than COPIES on average, as in unclustered data,
    the written blocks are paired as they are read, so that none is copied.
    """
    spark = vectors.sparkSession
    if not 0 < cosine <= 1:
        raise ValueError("the cosine bound lies in (0, 1]")
    rows = vectors.select(F.col(key).cast("bigint").alias("key"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    common = rows.where(finite & (F.size("v") > 0)).groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if common is None:
        return rows.select(F.col("key").alias(key), F.lit(0).cast("bigint").alias("n_links"), F.col("key").alias("component_id"), F.lit(True).alias("kept"))
    dims = common["n"]

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column(1).flatten()).reshape(-1, dims)
            top = np.abs(x).max(1, initial=0)
            scaled = x / np.where(top > 0, top, 1)[:, None]
            norm = np.sqrt((scaled**2).sum(1))
            good = norm > 0
            u = np.ascontiguousarray(scaled[good] / norm[good][:, None])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, u.size + 1, dims, dtype=np.int32)), pa.array(u.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(good)), lists], names=["key", "u"])

    sound = finite & (F.size("v") == dims) & F.exists("v", lambda x: x != 0)
    sound = F.coalesce(sound, F.lit(False))
    units = rows.where(sound).mapInArrow(unit, "key bigint, u array<double>")
    axes = spread_axes(units, dims)
    reach = float(np.sqrt(max(0.0, 2 - 2 * cosine)) + 1e-9)

    @F.arrow_udf("array<double>")
    def project(u: pa.Array) -> pa.Array:
        p = np.asarray(u.flatten()).reshape(-1, dims) @ axes
        return pa.ListArray.from_arrays(pa.array(np.arange(0, p.size + 1, p.shape[1], dtype=np.int32)), pa.array(p.reshape(-1)))

    grid = min(4, axes.shape[1])
    placed = units.withColumn("p", project("u"))
    cells = [F.floor(F.get("p", i) / reach).alias(f"c{i}") for i in range(grid)]
    order = [*(f"c{i}" for i in range(grid)), "p0", "tie"]
    ordered = placed.select("key", "u", *cells, F.get("p", 0).alias("p0"), F.xxhash64("key", "u").alias("tie"))
    ordered = ordered.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "u")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, keys, held = TaskContext.get().partitionId(), 0, [], []

        def flush(count: int) -> pa.RecordBatch:
            nonlocal keys, held
            k, u = pa.concat_arrays(keys), np.concatenate(held)
            p = u[:count] @ axes
            cells = np.floor(np.stack([p.min(0), p.max(0)])[:, :GRID_DIMS] / reach).astype(np.int64)
            row = {"block": part * SEQ + number, "keys": k[:count].to_pylist(), "low": p.min(0).tolist(), "high": p.max(0).tolist(),
                   "first": cells[0].tolist(), "last": cells[1].tolist(), "data": u[:count].astype("<f8").tobytes()}
            keys, held = [k[count:]], [u[count:]]
            return pa.RecordBatch.from_pylist([row], schema=packed)

        for batch in batches:
            keys.append(batch.column(0))
            held.append(np.asarray(batch.column(1).flatten()).reshape(-1, dims))
            while sum(map(len, held)) >= block:
                yield flush(block)
                number += 1
        if sum(map(len, held)):
            yield flush(sum(map(len, held)))

    packed = pa.schema([("block", pa.int64()), ("keys", pa.list_(pa.int64())), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64())), ("first", pa.list_(pa.int64())), ("last", pa.list_(pa.int64())), ("data", pa.binary())])
    kinds = "block bigint, keys array<bigint>, low array<double>, high array<double>, first array<bigint>, last array<bigint>, data binary"
    blocks = stash(ordered.mapInArrow(pack, kinds), "blocks")

    boxes = blocks.select("block", "low", "high", "first", "last")
    touched = boxes
    wider = boxes
    for i in range(min(GRID_DIMS, axes.shape[1])):
        span = lambda more, i=i: F.explode(F.sequence(F.get("first", i) - more, F.get("last", i) + more)).alias(f"x{i}")
        touched, wider = touched.select("*", span(0)), wider.select("*", span(1))
    names = [f"x{i}" for i in range(min(GRID_DIMS, axes.shape[1]))]
    left = touched.select(F.col("block").alias("a"), F.col("low").alias("al"), F.col("high").alias("ah"), *names)
    right = wider.select(F.col("block").alias("b"), F.col("low").alias("bl"), F.col("high").alias("bh"), *names)
    gaps = F.zip_with(F.zip_with("al", "bh", lambda x, y: x - y), F.zip_with("bl", "ah", lambda x, y: x - y), lambda x, y: F.greatest(x, y, F.lit(0.0)))
    far = F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x * x)
    pairs = left.join(right, names).where((F.col("a") <= F.col("b")) & (far <= reach * reach)).select("a", "b").distinct()
    pairs = stash(pairs.withColumn("fan", F.floor(F.col("b") / FAN)), "pairs")
    def compare(a_block: int, a_data: bytes, partners: pa.Table) -> pa.Table:
        a = read_block(a_data, dims)
        kind, left_, right_ = [], [], []
        sums = np.zeros(len(a), np.int64)
        name = lambda block_, at: block_ * 65536 + at
        for b_block, data in zip(partners.column("b").to_pylist(), partners.column("data"), strict=True):
            same = b_block == a_block
            b = a if same else read_block(data.as_py(), dims)
            found = PairJoin(a, b, axes, cosine, same)
            found.join(slice(0, len(a)), slice(0, len(b)))
            sums += found.na
            forest = Forest(len(a) + (0 if same else len(b)))
            for x, y in found.pairs:
                forest.link(x, y if same else y + len(a))
            x, y = forest.edges()
            names_ = name(a_block, np.arange(len(a))) if same else np.concatenate([name(a_block, np.arange(len(a))), name(b_block, np.arange(len(b)))])
            kind.append(np.ones(len(x), np.int64))
            left_.append(names_[x])
            right_.append(names_[y])
            if not same:
                linked = np.flatnonzero(found.nb)
                kind.append(np.zeros(len(linked), np.int64))
                left_.append(name(b_block, linked))
                right_.append(found.nb[linked])
        linked = np.flatnonzero(sums)
        return pa.table({
            "edge": np.concatenate([*kind, np.zeros(len(linked), np.int64)]),
            "x": np.concatenate([*left_, name(a_block, linked)]), "y": np.concatenate([*right_, sums[linked]]),
        })

    payload, kind = blocks.select("block", "data"), "edge bigint, x bigint, y bigint"
    if pairs.count() <= COPIES * blocks.count():
        first = pairs.select("a", "fan").distinct().join(payload, F.col("a") == F.col("block")).select(F.col("a").alias("own"), F.col("fan").alias("own_fan"), F.col("data").alias("own_data"))
        other = pairs.join(payload, F.col("b") == F.col("block")).select("a", "fan", "b", "data")
        moved = lambda own, partners: compare(own.column("own")[0].as_py(), own.column("own_data")[0].as_py(), partners)
        found = first.groupBy("own", "own_fan").cogroup(other.groupBy("a", "fan")).applyInArrow(moved, kind)
    else:
        found = _met(blocks, far <= reach * reach, compare, kind)
    found = stash(found, "found")
    counts = found.where("edge = 0").groupBy(F.col("x").alias("row")).agg(F.sum("y").alias("n_links"))
    linked = components(found.where("edge = 1").select("x", "y"), "x", "y")
    every = blocks.select("block", F.posexplode("keys").alias("at", "key")).select((F.col("block") * 65536 + F.col("at")).alias("row"), "key")
    placed = every.join(linked, F.col("row") == F.col("node"), "left").select("row", "key", F.coalesce("component", "row").alias("component"))
    least = placed.groupBy("component").agg(F.min("key").alias("component_id"))
    sure = placed.join(least, "component").join(counts, "row", "left").select("key", F.coalesce("n_links", F.lit(0)).alias("n_links"), "component_id")
    rest = rows.where(~sound).select("key", F.lit(0).cast("bigint").alias("n_links"), F.col("key").alias("component_id"))
    whole = sure.unionByName(rest)
    return whole.select(F.col("key").alias(key), "n_links", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))
