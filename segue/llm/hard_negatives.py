"""Hard negatives by rotated one-bit codes: popcount estimates with proven intervals, integer scores for what is left.

A vector v is rotated by a fixed random rotation and c is the unit vector of its signs. The alignment A = <v, c> and the
length R of the rest v - A c are stored beside the code. For an anchor q the score is A <q, c> + <q, v - A c>, and the last
term is at most R times the length of q without its part along c (Cauchy-Schwarz). <q, c> is counted: q is cut to eight
bit planes, each met with the code by AND and popcount, and what the cut loses is at most the length of the error, as c
is a unit vector. So the interval is certain, and a row whose interval cannot reach the wanted places is never scored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from segue.llm.text_bytes import release
from segue.session import stash

BLOCK, ANCHORS, FAN = 8192, 2048, 8
PLANES = 8
LARGEST = 1 << 24


def rotation(dims: int, seed: int = 42) -> np.ndarray:
    """The same random rotation everywhere."""
    turned, upper = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return turned * np.sign(np.diag(upper))


def bit_words(bits: np.ndarray) -> np.ndarray:
    """Rows of zeros and ones as rows of 64-bit words."""
    packed = np.packbits(bits.astype(bool), axis=1)
    return np.ascontiguousarray(np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8)))).view(np.uint64)


def encode(ints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, alignments, lengths of the rest) of integer vectors."""
    turned = ints.astype(np.float64) @ rotation(ints.shape[1])
    align = np.abs(turned).sum(1) / np.sqrt(ints.shape[1])
    rest = np.sqrt(np.maximum(0.0, (turned**2).sum(1) - align**2))
    return bit_words(turned > 0), align, rest


def intervals(anchor: np.ndarray, codes: np.ndarray, align: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the scores of a rotated anchor with the rows of the given codes."""
    dims = len(anchor)
    low = anchor.min()
    step = (anchor.max() - low) / (2**PLANES - 1) or 1.0
    level = np.rint((anchor - low) / step).astype(np.int64)
    near = low + step * level
    error = np.sqrt(((anchor - near) ** 2).sum())
    counted = low * np.bitwise_count(codes).sum(1, dtype=np.int64)
    for j, plane in enumerate(bit_words(level >> np.arange(PLANES)[:, None] & 1)):
        counted = counted + step * 2**j * np.bitwise_count(codes & plane).sum(1, dtype=np.int64)
    along = (2 * counted - near.sum()) / np.sqrt(dims)
    square = float(anchor @ anchor)
    across = np.sqrt(np.maximum(0.0, square - np.maximum(0.0, np.abs(along) - error) ** 2))
    rounding = 1e-9 * np.sqrt(square) * (align + rest) + 1e-6
    half = align * error + rest * across + rounding
    return align * along - half, align * along + half


def best(score: np.ndarray, ids: np.ndarray, ties: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ties, ids, -score))[:k]


def scores(rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    return (rows.astype(np.int64) * anchor.astype(np.int64)).sum(1)


def clean_rows(vectors: DataFrame, key: str, label: str, vector: str, scale: float) -> DataFrame:
    """(id, label, v, dims, tie): rows that can be scored, once each; v holds the integers."""
    whole = F.transform(F.col(vector).cast("array<double>"), lambda x: F.floor(F.lit(float(scale)) * x))
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.where(F.col(key).isNotNull() & F.col(label).isNotNull() & F.coalesce(finite, F.lit(False)) & (F.size(vector) > 0))
    rows = rows.select(F.col(key).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), whole.alias("v"))
    fits = F.forall("v", lambda x: F.abs(x) < LARGEST)
    checked = F.when(fits, F.col("v")).otherwise(F.raise_error(F.lit(f"a scaled component reaches {LARGEST}")).cast("array<bigint>"))
    rows = rows.select("id", "label", checked.cast("array<int>").alias("v"))
    return rows.distinct().select("*", F.size("v").cast("bigint").alias("dims"), F.xxhash64("label", "v").alias("tie"))


def matrix(table: pa.Table, name: str, dims: int) -> np.ndarray:
    return np.asarray(table.column(name).combine_chunks().flatten()).reshape(-1, dims)


def blocked(rows: DataFrame, block: int, pack: Callable[[pa.Table, int], dict], schema: str, name: str, table: str) -> DataFrame:
    """Rows of one length dealt by hash into blocks of about `block` rows, each packed into one written row."""
    counts = rows.groupBy("dims").agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"))
    dealt = rows.join(counts, "dims").withColumn("block", F.pmod(F.xxhash64("id", "tie"), F.col("blocks")))

    def packed(group: pa.Table) -> pa.Table:
        dims, number = group.column("dims")[0].as_py(), group.column("block")[0].as_py()
        out = pa.Table.from_pylist([{"dims": dims, name: number, **pack(group, dims)}])
        release()
        return out

    kinds = f"dims bigint, {name} bigint, {schema}"
    return stash(dealt.groupBy("dims", "block").applyInArrow(packed, kinds), table)


def pack_rows(group: pa.Table, dims: int) -> dict:
    ints = matrix(group, "v", dims).astype("<i4")
    labels = np.asarray(group.column("label"))
    order = np.argsort(labels, kind="stable")
    codes, align, rest = encode(ints[order])
    column = lambda c: np.asarray(group.column(c))[order].astype("<i8").tobytes()
    return {"ids": column("id"), "ties": column("tie"), "labels": column("label"), "ints": ints[order].tobytes(), "codes": codes.tobytes(), "align": align.tobytes(), "rest": rest.tobytes()}


def pack_anchors(group: pa.Table, dims: int) -> dict:
    column = lambda c: np.asarray(group.column(c)).astype("<i8").tobytes()
    packed = {"a_ids": column("id"), "a_ties": column("tie"), "a_labels": column("label"), "a_ints": matrix(group, "v", dims).astype("<i4").tobytes()}
    if "caps" in group.column_names:
        caps = group.column("caps").combine_chunks()
        packed |= {"sizes": np.diff(np.asarray(caps.offsets)).astype("<i8").tobytes(), "caps": np.asarray(caps.flatten()).astype("<i8").tobytes()}
    return packed


class Block:
    """The rows of a block, by label, with their codes."""

    def __init__(self, table: pa.Table):
        raw = lambda c, kind: np.frombuffer(table.column(c)[0].as_py(), kind)
        self.dims = table.column("dims")[0].as_py()
        self.ids, self.ties, self.labels = (raw(c, "<i8") for c in ("ids", "ties", "labels"))
        self.ints = raw("ints", "<i4").reshape(-1, self.dims)
        self.codes, self.align, self.rest = raw("codes", np.uint64).reshape(len(self.ids), -1), raw("align", "<f8"), raw("rest", "<f8")

    def bounds(self, anchor: np.ndarray, rows: np.ndarray | slice) -> tuple[np.ndarray, np.ndarray]:
        return intervals(anchor, self.codes[rows], self.align[rows], self.rest[rows])


def anchors_of(table: pa.Table, dims: int):
    """(id, tie, label, integers, rotated, caps) of each anchor in the packed rows."""
    turn = rotation(dims)
    for i in range(table.num_rows):
        raw = lambda c, kind="<i8", i=i: np.frombuffer(table.column(c)[i].as_py(), kind)
        ints = raw("a_ints", "<i4").reshape(-1, dims)
        caps = np.split(raw("caps"), np.cumsum(raw("sizes"))[:-1]) if "caps" in table.column_names else [None] * len(ints)
        yield from zip(raw("a_ids").tolist(), raw("a_ties").tolist(), raw("a_labels").tolist(), ints, ints.astype(np.float64) @ turn, caps)


def meet(blocks: DataFrame, anchors: DataFrame, task: Callable[[Block, pa.Table], pa.Table], schema: str, empty: pa.Schema) -> DataFrame:
    """Run `task` on each block of rows with the anchors of its length, up to FAN blocks of them at a time."""
    groups = anchors.groupBy("dims").agg(F.max(F.floor(F.col("a_block") / FAN)).alias("last"))
    left = blocks.join(groups, "dims").withColumn("grp", F.explode(F.sequence(F.lit(0).cast("bigint"), "last"))).drop("last")
    numbers = blocks.select(F.col("dims").alias("a_dims"), F.col("block").alias("met"))
    right = anchors.withColumn("a_grp", F.floor(F.col("a_block") / FAN)).join(numbers, F.col("dims") == F.col("a_dims"))

    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        if not (rows.num_rows and asked.num_rows):
            return empty.empty_table()
        out = task(Block(rows), asked)
        release()
        return out

    asking = right.groupBy("a_dims", "met", "a_grp")
    return left.groupBy("dims", "block", "grp").cogroup(asking).applyInArrow(run, schema)


def table_of(rows: list[tuple], names: list[str]) -> pa.Table:
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})


def hard_negatives(
    vectors: DataFrame, anchors: str, key: str = "vec_id", label: str = "label", vector: str = "embedding", scale: float = 256.0,
    n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90, block: int = BLOCK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor and positive the first
    negatives by rank.

    `anchors` is a condition on the rows that ask. A score is the inner product of floor(scale * x) over the components;
    higher scores come first, ties by smaller key. An anchor's positives are its first `n_positives` other rows of the
    same label, its negatives for a positive the first `n_negatives` rows of other labels whose score is at least `low`
    and at most `high` per cent of the positive's (so none for a positive below zero).

    Rows with a NULL key, label or vector, an empty vector or a NULL or non-finite component take no part; vectors of
    different lengths do not meet. Equal rows count once; different rows of one key are rows of their own, and ties
    between them go by a hash of label and vector. Other columns are not read. An empty table gives no rows. Scaled
    components of 2^24 or more fail the job, as scores might no longer be exact.

    Rows are dealt by hash into blocks, so a label that holds a third of them is nothing special. Each block meets all
    anchors of its length and passes on at most `n_positives` rows for an anchor, then `n_negatives` for each positive.
    """
    rows = stash(clean_rows(vectors, key, label, vector, scale), "scaled")
    payload = "ids binary, ties binary, labels binary, ints binary, codes binary, align binary, rest binary"
    blocks = blocked(rows, block, pack_rows, payload, "block", "row-blocks")
    asking = rows.where(F.expr(anchors.replace(key, "id")) if key != "id" else F.expr(anchors))
    asked = "a_ids binary, a_ties binary, a_labels binary, a_ints binary"
    first = blocked(asking, ANCHORS, pack_anchors, asked, "a_block", "anchor-blocks")

    def positives(held: Block, asked: pa.Table) -> pa.Table:
        found = []
        for id_, tie, label_, ints, turned, _ in anchors_of(asked, held.dims):
            same = slice(*np.searchsorted(held.labels, [label_, label_ + 1]))
            at = np.arange(same.start, same.stop)
            lower, upper = held.bounds(turned, same)
            other = (held.ids[same] != id_) | (held.ties[same] != tie)
            at, lower, upper = at[other], lower[other], upper[other]
            if len(at) > n_positives:
                at = at[upper >= np.partition(lower, len(lower) - n_positives)[len(lower) - n_positives]]
            score = scores(held.ints[at], ints)
            for i in best(score, held.ids[at], held.ties[at], n_positives):
                found.append((id_, tie, int(held.ids[at[i]]), int(held.ties[at[i]]), int(score[i])))
        return table_of(found, ["anchor_id", "anchor_tie", "positive_id", "positive_tie", "positive_score"])

    names = ["anchor_id", "anchor_tie", "positive_id", "positive_tie", "positive_score"]
    near = meet(blocks, first, positives, ", ".join(f"{n} bigint" for n in names), pa.schema([(n, pa.int64()) for n in names]))
    rank = W.partitionBy("anchor_id", "anchor_tie").orderBy(F.desc("positive_score"), "positive_id", "positive_tie")
    near = near.withColumn("place", F.row_number().over(rank)).where(F.col("place") <= n_positives)
    near = stash(near, "positives")

    listed = near.groupBy(F.col("anchor_id").alias("id"), F.col("anchor_tie").alias("tie")).agg(
        F.array_sort(F.collect_list(F.struct("place", "positive_score"))).alias("caps")  # at most n_positives
    )
    capped = asking.join(listed, ["id", "tie"]).withColumn("caps", F.col("caps.positive_score"))
    second = blocked(capped, ANCHORS, pack_anchors, f"{asked}, sizes binary, caps binary", "a_block", "capped-anchors")

    def negatives(held: Block, asked: pa.Table) -> pa.Table:
        found = []
        for id_, tie, label_, ints, turned, caps in anchors_of(asked, held.dims):
            lower, upper = held.bounds(turned, slice(None))
            other = held.labels != label_
            at = np.flatnonzero(other & (upper >= low * caps.min() / 100) & (lower <= high * caps.max() / 100))
            lower, upper = lower[at], upper[at]
            exact = np.zeros(len(at), np.int64)
            known = np.zeros(len(at), bool)
            for place, cap in enumerate(caps.tolist(), 1):
                least, most = -(-low * cap // 100), high * cap // 100
                maybe = (upper >= least) & (lower <= most)
                sure = lower[(lower >= least) & (upper <= most)]
                if len(sure) > n_negatives:
                    maybe &= upper >= np.partition(sure, len(sure) - n_negatives)[len(sure) - n_negatives]
                new = np.flatnonzero(maybe & ~known)
                exact[new] = scores(held.ints[at[new]], ints)
                known[new] = True
                fit = np.flatnonzero(maybe & (exact >= least) & (exact <= most))
                for i in fit[best(exact[fit], held.ids[at[fit]], held.ties[at[fit]], n_negatives)]:
                    found.append((id_, tie, place, int(held.ids[at[i]]), int(held.ties[at[i]]), int(exact[i])))
        return table_of(found, ["anchor_id", "anchor_tie", "place", "negative_id", "negative_tie", "negative_score"])

    names = ["anchor_id", "anchor_tie", "place", "negative_id", "negative_tie", "negative_score"]
    hard = meet(blocks, second, negatives, ", ".join(f"{n} bigint" for n in names), pa.schema([(n, pa.int64()) for n in names]))
    order = W.partitionBy("anchor_id", "anchor_tie", "place").orderBy(F.desc("negative_score"), "negative_id", "negative_tie")
    hard = hard.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n_negatives)
    return hard.join(near, ["anchor_id", "anchor_tie", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
