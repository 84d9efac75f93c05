"""SimHash near-dedup: fingerprints in a vantage-point tree, whose leaves are joined exactly."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segue.llm.components import Forest, components
from segue.llm.text_bytes import release
from segue.session import stash

LEAF_ROWS = 32_768
NO_ID = (1 << 63) - 1  # stands for a NULL id, so that any other id is smaller


def fingerprint_of(texts: pa.Array, words: int = 4, seed: int = 42) -> np.ndarray:
    """64-bit SimHash of each text over its shingles of `words` words, each counted as often as it stands there."""
    hashes, sizes = [], []
    for text in texts:
        found = (text.as_py() or "").encode().lower().split()
        joined = b" ".join(found)
        if len(found) <= words:
            parts = [xxhash.xxh64_intdigest(joined, seed)] if found else []
        else:
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            ends = np.cumsum(lengths + 1) - 1
            starts = (ends - lengths)[: -words + 1].tolist() if words > 1 else (ends - lengths).tolist()
            parts = [xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts, ends[words - 1 :].tolist(), strict=True)]
        hashes.append(np.array(parts, np.uint64))
        sizes.append(len(parts))
    return majority(hashes, np.array(sizes, np.int64))


def majority(hashes: list[np.ndarray], sizes: np.ndarray, most: int = 1 << 17) -> np.ndarray:
    """The bits that are set in over half of each text's hashes."""
    out, first = np.zeros(len(sizes), np.uint64), 0
    ends = np.cumsum(sizes)
    while first < len(sizes):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + most, "right")))
        counts = np.zeros((last - first, 64), np.int64)
        used = np.flatnonzero(sizes[first:last])
        if len(used):
            flat = np.concatenate([hashes[first + i] for i in used])
            edges = np.concatenate(([0], np.cumsum(sizes[first:last][used])[:-1]))
            for start in range(0, len(flat), 1 << 20):  # a very long text is summed part by part
                bits = np.unpackbits(flat[start : start + (1 << 20)].astype("<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
                own = (edges >= start) & (edges < start + (1 << 20))
                own[max(0, int(np.searchsorted(edges, start, "right")) - 1)] = True
                counts[used[own]] += np.add.reduceat(bits, np.maximum(edges[own] - start, 0), axis=0, dtype=np.int64)
        set_ = (2 * counts > sizes[first:last, None]).astype(np.uint8)
        out[first:last] = np.packbits(set_, axis=1, bitorder="little").view("<u8").reshape(-1)
        first = last
    return out


def id_of(key: str) -> Column:
    return F.coalesce(F.col(key).cast("bigint"), F.lit(NO_ID))


def fingerprints(docs: DataFrame, key: Column, text: str = "text", words: int = 4) -> DataFrame:
    """(key, fp): the fingerprint of each row as a signed 64-bit number; zero for a text without words and for NULL."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                piece = batch.slice(first, 500)
                fps = fingerprint_of(piece.column(1), words).view(np.int64)
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(fps)], names=["key", "fp"])
        release()

    rows = docs.select(key.alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(read, f"key {rows.schema['key'].dataType.simpleString()}, fp bigint")


def distance(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    return np.bitwise_count(a ^ b)


@dataclass
class Tree:
    """Nodes with a vantage point, a radius and two children: points within the radius, and the others.

    A node without vantage point is a leaf. All arrays grow with the leaves only.
    """

    vantage: list[int] = field(default_factory=lambda: [0])
    radius: list[int] = field(default_factory=lambda: [-1])
    inner: list[int] = field(default_factory=lambda: [-1])

    def split(self, leaf: int, vantage: int, radius: int) -> None:
        self.vantage[leaf], self.radius[leaf], self.inner[leaf] = vantage, radius, len(self.inner)
        self.vantage += [0, 0]
        self.radius += [-1, -1]
        self.inner += [-1, -1]

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.array(self.vantage, np.int64).view(np.uint64), np.array(self.radius), np.array(self.inner)

    def home(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point."""
        vantage, radius, inner = self.arrays()
        node = np.zeros(len(points), np.int64)
        while True:
            moving = np.flatnonzero(inner[node] >= 0)
            if not len(moving):
                return node
            at = node[moving]
            node[moving] = inner[at] + (distance(points[moving], vantage[at]) > radius[at])

    def reach(self, points: np.ndarray, within: int) -> tuple[np.ndarray, np.ndarray]:
        """(point, leaf) for every leaf that can hold a point within the distance, by the triangle inequality."""
        vantage, radius, inner = self.arrays()
        point, node = np.arange(len(points)), np.zeros(len(points), np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(point):
            leaf = inner[node] < 0
            done.append((point[leaf], node[leaf]))
            point, node = point[~leaf], node[~leaf]
            d = distance(points[point], vantage[node]).astype(np.int64)
            near, far = d - within <= radius[node], d + within > radius[node]
            point, node = np.concatenate([point[near], point[far]]), np.concatenate([inner[node][near], inner[node][far] + 1])
        return np.concatenate([p for p, _ in done]), np.concatenate([n for _, n in done])


def distance_counts(fps: DataFrame, tree: Tree, centers: np.ndarray, large: list[int]) -> DataFrame:
    """(code, count): how many fingerprints of a leaf of `large` have a distance to its center; code is 65 leaf + distance,
    and NULL for the other leaves. Leaf and distance come from one function, as each one more is a process for each task."""

    @F.arrow_udf("bigint")
    def to_vantage(points: pa.Array) -> pa.Array:
        points = np.asarray(points).view(np.uint64)
        leaf = tree.home(points)
        return pa.array(65 * leaf + distance(points, centers[leaf]).astype(np.int64), mask=~np.isin(leaf, large))

    return fps.groupBy(to_vantage("fp").alias("code")).count()


def grow_tree(fps: DataFrame, leaf_rows: int) -> Tree:
    """A tree over all distinct fingerprints (column fp), split level by level at exact medians.

    Each level is two aggregates: a vantage point for each large leaf, and the counts of distances to it. Only leaves
    come to the driver (one for some 10,000 points) and at most 65 counts of each.
    """
    tree = Tree()

    def leaf_of(tree: Tree):
        @F.arrow_udf("bigint")
        def leaf(points: pa.Array) -> pa.Array:
            return pa.array(tree.home(np.asarray(points).view(np.uint64)))

        return leaf(F.col("fp"))

    final: set[int] = set()
    while True:
        placed = fps.select("fp", leaf_of(tree).alias("leaf"))
        counts = placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.xxhash64("fp").alias("h"), "fp")).alias("v"))
        large = {r["leaf"]: r["v"]["fp"] for r in counts.where(F.col("n") > leaf_rows).collect() if r["leaf"] not in final}
        if not large:
            return tree
        trial = Tree(list(tree.vantage), list(tree.radius), list(tree.inner))
        for leaf, vantage in large.items():
            trial.vantage[leaf] = vantage
        centers = trial.arrays()[0]

        spread: dict[int, np.ndarray] = {leaf: np.zeros(65, np.int64) for leaf in large}
        for row in distance_counts(fps, tree, centers, list(large)).collect():
            if row["code"] is not None:
                spread[row["code"] // 65][row["code"] % 65] = row["count"]
        for leaf, vantage in large.items():
            inside = np.cumsum(spread[leaf])
            radius = int(np.argmin(np.abs(inside - inside[-1] / 2)))
            if inside[radius] in (0, inside[-1]):
                final.add(leaf)
            else:
                tree.split(leaf, vantage, radius)


class LeafJoin:
    """All pairs within a distance among points, found by splitting at vantage points until blocks are small.

    A pair across a split lies within the distance of the split's sphere on both sides, so the rest is never compared.
    """

    def __init__(self, points: np.ndarray, within: int, block: int = 1 << 20):
        self.points, self.within, self.block, self.forest = points, within, block, Forest(len(points))

    def brute(self, a: np.ndarray, b: np.ndarray) -> None:
        step = max(1, self.block // max(1, len(b)))
        for first in range(0, len(a), step):
            rows = a[first : first + step]
            x, y = np.nonzero(distance(self.points[rows][:, None], self.points[b][None, :]) <= self.within)
            self.forest.link(rows[x], b[y])

    def cross(self, a: np.ndarray, b: np.ndarray) -> None:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            if not len(a) or not len(b):
                continue
            if len(a) * len(b) <= self.block:
                self.brute(a, b)
                continue
            longer = a if len(a) >= len(b) else b
            center = self.points[longer[len(longer) // 2]]
            da, db = distance(self.points[a], center).astype(np.int64), distance(self.points[b], center).astype(np.int64)
            radius = int(np.median(np.concatenate([da, db])))
            ia, ib = da <= radius, db <= radius
            near, far = radius - self.within, radius + self.within
            parts = [
                (a[ia], b[ib]), (a[~ia], b[~ib]),
                (a[ia & (da > near)], b[~ib & (db <= far)]), (a[~ia & (da <= far)], b[ib & (db > near)]),
            ]
            if sum(len(x) * len(y) for x, y in parts) > 0.9 * len(a) * len(b):
                self.brute(a, b)
            else:
                todo += parts

    def alone(self, a: np.ndarray) -> None:
        todo = [a]
        while todo:
            a = todo.pop()
            if len(a) ** 2 <= self.block:
                self.brute(a, a)
                continue
            d = distance(self.points[a], self.points[a[len(a) // 2]]).astype(np.int64)
            radius = int(np.median(d))
            inside = d <= radius
            if inside.all():
                radius = int(d.max()) - 1
                inside = d <= radius
            if not inside.any() or inside.all():
                self.brute(a, a)
                continue
            todo += [a[inside], a[~inside]]
            self.cross(a[inside & (d > radius - self.within)], a[~inside & (d <= radius + self.within)])


def near_links(fps: DataFrame, within: int = 4, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(a, b): links that hold together all distinct fingerprints within the distance of each other.

    Each fingerprint has a home leaf and visits the other leaves that it can have a neighbour in; of two leaves, only
    one sends visitors to the other. A leaf returns a spanning forest of the pairs it finds, never all pairs.
    """
    tree = grow_tree(fps, leaf_rows)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = np.asarray(batch.column(0)).view(np.uint64)
            home = tree.home(points)
            point, leaf = tree.reach(points, within)
            own = home[point]
            sends = (own < leaf) == ((own + leaf) % 2 == 0)
            keep = (own == leaf) | sends
            point, leaf, own = point[keep], leaf[keep], own[keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaf), pa.array(points[point].view(np.int64)), pa.array(own == leaf)], names=["leaf", "fp", "home"]
            )

    def join(group: pa.Table) -> pa.Table:
        points = np.asarray(group.column("fp").combine_chunks()).view(np.uint64)
        home = np.asarray(group.column("home").combine_chunks())
        found = LeafJoin(points, within)
        found.alone(np.flatnonzero(home))
        found.cross(np.flatnonzero(home), np.flatnonzero(~home))
        a, b = found.forest.edges()
        release()
        return pa.table({"a": points[a].view(np.int64), "b": points[b].view(np.int64)})

    dealt = fps.select("fp").mapInArrow(deal, "leaf bigint, fp bigint, home boolean")
    return dealt.groupBy("leaf").applyInArrow(join, "a bigint, b bigint")


def linked_groups(rows: DataFrame, within: int, leaf_rows: int) -> DataFrame:
    """(fp, least, component) for each fingerprint of (key, fp): its least key, and a number that its group shares."""
    points = stash(rows.groupBy("fp").agg(F.min("key").alias("least")), "points")
    linked = components(near_links(points, within, leaf_rows))
    return points.join(linked, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))


def simhash_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, within: int = 4, leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """(key, fingerprint, component_id) for every row.

    Rows are linked when their fingerprints differ in at most `within` bits; component_id is the smallest key reachable.
    NULL texts, empty texts and texts of white space have fingerprint zero and are linked like any other. Rows that
    repeat a key and rows with a NULL key take part; a NULL key is larger than any other. Other columns are not read.
    An empty table gives no rows.

    Equal fingerprints are grouped by one aggregate first, so a hot group of copies is one point from there on.
    """
    rows = stash(fingerprints(docs, id_of(key), text, words), "fingerprints")
    placed = linked_groups(rows, within, leaf_rows)
    roots = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = placed.join(roots, "component").select("fp", "component_id")
    id_ = lambda name: F.nullif(F.col(name), F.lit(NO_ID))
    return rows.join(classes, "fp").select(
        id_("key").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), id_("component_id").alias("component_id"),
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, within: int = 4) -> DataFrame:
    """One row of each group, with all its columns: that of the smallest key, of equal keys the least hash of the text.

    A group is known by its first row's key and hash, as keys may be NULL or repeat in unrelated groups. Rows that agree
    in both are one row after a partial aggregate; of these stays the one with the least hash of its other columns.
    """
    own = F.struct(id_of(key).alias("id"), F.xxhash64(text).alias("th"))
    rows = fingerprints(docs, own, text, words)
    firsts = linked_groups(rows, within, LEAF_ROWS).groupBy("component").agg(F.min("least").alias("first")).select("first.id", "first.th")
    tie = F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()])
    nested = docs.select(own.alias("own"), F.struct("*").alias("doc"), tie.alias("tie"))
    single = nested.groupBy("own.id", "own.th").agg(F.min_by("doc", "tie").alias("doc"))
    return single.join(firsts, ["id", "th"], "left_semi").select("doc.*")
