"""Suffix-array dedup: remove every byte that lies in a long string which also starts somewhere else.

Two equal strings of `length` bytes pick the same anchor inside: the leftmost of their grams with the least hash. So a
string can repeat only where its anchor does. The corpus is read three times. The first pass counts anchors. The second
keeps the places of repeated anchors, each with a hash of its surroundings, as far as strings through the anchor reach.
Equal surroundings repeat whole. What is left are surroundings that agree in a part: around the ends of copies and
around edits. The third pass brings the bytes of those, once for each different one, and they are suffix-sorted.

The sort compares suffixes by hashes: from polynomial hashes of all prefixes, a binary search finds how far two
suffixes agree, so a comparison takes logarithmic time, and a mergesort needs few of them. Neighbours in the finished
order are compared byte by byte. Between passes only bitmaps of a fixed size come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segue.llm.text_bytes import PrefixHash, mix, text_parts
from segue.session import stash

GRAM = 40
BITMAP_BITS, BUCKET_BITS = 1 << 26, 32_768  # 2,048 bitmaps of 4 kB
PIECE = 1 << 13  # as many nodes as a task sorts at a time
PART_BYTES, TASK_NODES = 1 << 19, 1 << 13
BLOCKS = 5
LEFT, RIGHT = 0, 1
OWN, EARLIER = 1, 2  # whose part the string starting at a byte belongs to


class Spans:
    """Lengths that all passes share. A string starts up to `reach` before its anchor's gram; a node is one of the two
    halves of the strings through an anchor: those that hold the gram and `half` bytes before it, or behind it."""

    def __init__(self, length: int, gram: int):
        if length < gram + 2:
            raise ValueError("strings have to be longer than their grams")
        self.length, self.gram = length, gram
        self.reach = length - gram
        self.half = self.reach // 2
        self.core = gram + self.half
        self.wide = length - self.core  # starts before a node's core, and bytes behind it, that strings can have


def parts(texts: pa.Array, spans: Spans) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int, np.ndarray]]:
    """Runs of whole texts, or parts of a very long one: (texts' numbers, bytes, first and last byte of each text, offset
    of the part in its text, whether a string may start at a byte). Parts overlap by what surroundings need; where
    strings of the part before start that reach into this one, it says EARLIER."""
    data, edges = text_parts(texts)
    margin = 2 * spans.length
    first = 0
    while first < len(edges) - 1:
        last = max(int(np.searchsorted(edges, edges[first] + PART_BYTES, "right")) - 1, first + 1)
        last = min(last, len(edges) - 1)
        size = int(edges[last] - edges[first])
        if last == first + 1 and size > 2 * PART_BYTES:
            for start in range(0, size, PART_BYTES):
                low, high = max(0, start - margin), min(size, start + PART_BYTES + margin)
                own = np.zeros(high - low, np.int8)
                own[max(0, start - spans.reach - low) : start - low] = EARLIER
                own[start - low : max(0, min(start + PART_BYTES, size - spans.length + 1) - low)] = OWN
                yield np.array([first]), data[edges[first] + low : edges[first] + high], np.array([0]), np.array([high - low]), low, own
        else:
            low, high = edges[first:last] - edges[first], edges[first + 1 : last + 1] - edges[first]
            own = np.zeros(size, bool)
            steps = np.zeros(size + 1, np.int32)
            long = high - low >= spans.length
            steps[low[long]] += 1
            steps[high[long] - spans.length + 1] -= 1
            own[:] = np.cumsum(steps[:-1]) > 0
            yield np.arange(first, last), data[edges[first] : edges[last]], low, high, 0, own
        first = last


class Anchors:
    """The anchors of a part, with their surroundings inside their text. An anchor that the strings of the part before
    pick too is left to that part."""

    def __init__(self, data: np.ndarray, low: np.ndarray, high: np.ndarray, own: np.ndarray, spans: Spans):
        self.data, self.spans = data, spans
        starts = np.flatnonzero(own == OWN)
        if not len(starts):
            self.at = np.empty(0, np.int64)
            return
        self.hash = PrefixHash(data)
        grams = np.arange(len(data) - spans.gram + 1)
        least = (mix(self.hash.part(grams, grams + spans.gram)) & ~np.uint64(0xFFFFFF)) | grams.astype(np.uint64)
        width, size = spans.reach + 1, 1
        while size * 2 <= width:
            least, size = np.minimum(least[:-size], least[size:]), size * 2
        if size < width:
            least = np.minimum(least[: size - width], least[width - size :])
        picked = lambda starts: (least[starts] & np.uint64(0xFFFFFF)).astype(np.int64)
        at = picked(starts)
        self.at = np.setdiff1d(at[np.concatenate(([True], at[1:] != at[:-1]))], picked(np.flatnonzero(own == EARLIER)))
        self.text = np.searchsorted(high, self.at, "right")
        self.low = np.maximum(self.at - spans.reach, low[self.text])
        self.high = np.minimum(self.at + spans.length, high[self.text])
        self.edges = low[self.text], high[self.text]

    def keep(self, chosen: np.ndarray) -> None:
        self.at, self.text, self.low, self.high = self.at[chosen], self.text[chosen], self.low[chosen], self.high[chosen]
        self.edges = self.edges[0][chosen], self.edges[1][chosen]

    def gram_hash(self) -> np.ndarray:
        return mix(self.hash.part(self.at, self.at + self.spans.gram))

    def surroundings(self) -> np.ndarray:
        """Equal where the surroundings are, with as many bytes before the anchor."""
        return mix(mix(self.hash.part(self.low, self.high)) + (self.at - self.low).astype(np.uint64) * np.uint64(1024) + (self.high - self.at).astype(np.uint64))

    def node(self, side: int) -> tuple[np.ndarray, np.ndarray]:
        """(first byte of the node's core, whether the core lies inside the text)."""
        start = self.at - self.spans.half * (side == LEFT)
        return start, (start >= self.edges[0]) & (start + self.spans.core <= self.edges[1])

    def core_hash(self, side: int) -> np.ndarray:
        start, inside = self.node(side)
        start = np.where(inside, start, self.at)
        hashed = mix(mix(self.hash.part(start, np.where(inside, start + self.spans.core, self.at))) + np.uint64(side))
        return np.where(inside, hashed, np.uint64(0))


def bit_of(hashed: np.ndarray) -> np.ndarray:
    return (hashed & np.uint64(BITMAP_BITS - 1)).astype(np.int64)


def has_bit(bitmap: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    bit = bit_of(hashed)
    return (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


def bitmap_of(found: DataFrame, column: str) -> np.ndarray:
    """A bit for each hash, other hashes sharing it: 8 MB however many there are. What passes by a shared bit is found
    to be single later on, so it costs time only."""
    place = F.pmod(F.col(column), F.lit(BITMAP_BITS))
    bits = found.select(F.floor(place / BUCKET_BITS).alias("map"), F.pmod(place, F.lit(BUCKET_BITS)).alias("bit"))
    out = np.zeros(BITMAP_BITS // 8, np.uint8)
    for row in bits.groupBy("map").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
        first = row["map"] * (BUCKET_BITS // 8)
        out[first : first + len(row["bits"])] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return out


def side_mark(c: np.ndarray, side: int) -> np.ndarray:
    return mix(c + np.uint64(side))


def cover(dup: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, from, to) of the bytes that the marked strings cover; first[i] is where string 0 of row i starts."""
    padded = np.zeros((dup.shape[0], dup.shape[1] + 2), np.int8)
    padded[:, 1:-1] = dup
    step = np.diff(padded, axis=1)
    row, start = np.nonzero(step == 1)
    _, stop = np.nonzero(step == -1)
    return row, first[row] + start, first[row] + stop - 1 + length


class SuffixSort:
    """Suffixes of many short byte strings, each starting inside its own string and ending with it, in sorted order.

    Sorting happens inside groups (runs of equal `group` numbers); `order` lists the suffixes group by group, `common`
    says how many bytes each has in common with the one before it in its group.
    """

    def __init__(self, data: np.ndarray, start: np.ndarray, size: np.ndarray, group: np.ndarray):
        self.data, self.start, self.size, self.hash = data, start, size, PrefixHash(data)
        self.order = np.arange(len(start))
        edges = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True]))) if len(group) else np.array([0])
        self.group_first = np.repeat(edges[:-1], np.diff(edges))
        self.group_size = np.repeat(np.diff(edges), np.diff(edges))
        run = 1
        while len(start) and run < int(self.group_size.max()):
            self.merge(run)
            run *= 2
        self.verify()

    def extension(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many bytes two suffixes have in common: a binary search over hashes of their prefixes."""
        low, high = np.zeros(len(x), np.int64), np.minimum(self.size[x], self.size[y])
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = self.hash.part(self.start[x], self.start[x] + middle) == self.hash.part(self.start[y], self.start[y] + middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def before(self, x: np.ndarray, y: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """Whether suffix x comes before suffix y; `ties` is the answer for equal ones."""
        common = self.extension(x, y)
        ends = np.minimum(self.size[x], self.size[y]) == common
        last = len(self.data) - 1
        a, b = self.data[np.minimum(self.start[x] + common, last)], self.data[np.minimum(self.start[y] + common, last)]
        by_size = np.where(self.size[x] == self.size[y], ties, self.size[x] < self.size[y])
        return np.where(ends, by_size, a < b)

    def merge(self, run: int) -> None:
        """Merge neighbouring sorted runs: each suffix finds its rank in the other run."""
        place = np.flatnonzero(self.group_size > run)
        local = place - self.group_first[place]
        number = local // run
        other = np.minimum((number ^ 1) * run, self.group_size[place])
        low, high = other.copy(), np.minimum(other + run, self.group_size[place])
        mine, left = self.order[place], number % 2 == 0
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) // 2
            rival = self.order[self.group_first[place[open_]] + middle]
            # a suffix of the left run stands before its equals of the right one
            rival_first = self.before(rival, mine[open_], ~left[open_])
            low[open_] = np.where(rival_first, middle + 1, low[open_])
            high[open_] = np.where(rival_first, high[open_], middle)
        target = self.group_first[place] + (number // 2) * 2 * run + local % run + low - other
        merged = self.order.copy()
        merged[target] = mine
        self.order = merged

    def verify(self) -> None:
        """Common lengths of neighbours, checked byte by byte; hashes that collided make way for a sort of the bytes."""
        n = len(self.order)
        self.common = np.zeros(n, np.int64)
        inner = np.flatnonzero(np.arange(n) > self.group_first)
        x, y = self.order[inner - 1], self.order[inner]
        common = self.extension(x, y)
        ends = np.cumsum(common)
        at = np.repeat(self.start[x] - (ends - common), common) + np.arange(int(common.sum()))
        shift = np.repeat(self.start[y] - self.start[x], common)
        if not np.array_equal(self.data[at], self.data[at + shift]):
            self.by_bytes(inner)
        else:
            self.common[inner] = common

    def by_bytes(self, inner: np.ndarray) -> None:
        suffix = lambda i: self.data[self.start[i] : self.start[i] + self.size[i]].tobytes()
        keyed = sorted((int(self.group_first[p]), suffix(i), int(i)) for p, i in enumerate(self.order))
        self.order = np.array([i for _, _, i in keyed])
        for p in inner:
            a, b = keyed[p - 1][1], keyed[p][1]
            self.common[p] = next((k for k, (u, v) in enumerate(zip(a, b)) if u != v), min(len(a), len(b)))

    def clusters(self, length: int) -> np.ndarray:
        """A number for each suffix, the same for suffixes of a group whose first `length` bytes agree."""
        out = np.empty(len(self.order), np.int64)
        out[self.order] = np.cumsum((self.common < length) | (np.arange(len(self.order)) == self.group_first))
        return out


def repeats(contexts: list[bytes], left: np.ndarray, group: np.ndarray, spans: Spans) -> tuple[np.ndarray, np.ndarray]:
    """(marked, first) for nodes: marked[i, j] says that the string starting j bytes before node i's core is in another
    node of its group too; first[i, j] that node i is the first of those that have it. Rows come group by group."""
    size = np.array([len(c) for c in contexts], np.int64)
    data = np.frombuffer(b"".join(contexts), np.uint8)
    edge = np.cumsum(size) - size
    behind = SuffixSort(data, edge + left, size - left, group)
    # what stands before the core is sorted from the core outwards: the same sort over reversed bytes
    ahead = SuffixSort(np.ascontiguousarray(data[::-1]), len(data) - edge - left, left, group)
    shape = (len(contexts), spans.wide + 1)
    marked, first = np.zeros(shape, bool), np.zeros(shape, bool)
    for j in range(spans.wide + 1):
        valid = np.flatnonzero((left >= j) & (size - left >= spans.length - j))
        if not len(valid):
            continue
        code = behind.clusters(spans.length - j)[valid] * (len(contexts) + 1) + ahead.clusters(j)[valid]
        order = np.argsort(code, kind="stable")
        new = np.concatenate(([True], code[order][1:] != code[order][:-1]))
        count = np.diff(np.concatenate((np.flatnonzero(new), [len(order)])))
        marked[valid[order], j] = np.repeat(count > 1, count)
        first[valid[order[new]], j] = True
    return marked, first


def covered_spans(docs: DataFrame, key: str, text: str, length: int, gram: int, piece: int) -> DataFrame:
    """(id, th, spans): for each document with repeated strings the byte ranges that they cover; ranges may overlap."""
    spark, spans = docs.sparkSession, Spans(length, gram)
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("t")).where(F.octet_length("t") >= length)
    rows = rows.select("id", F.xxhash64("t").alias("th"), "t")
    kind = rows.schema["id"].dataType.simpleString()

    def count_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, low, high, _, own in parts(batch.column(0), spans):
                found = Anchors(data, low, high, own, spans)
                if len(found.at):
                    yield pa.RecordBatch.from_arrays([pa.array(found.gram_hash().view(np.int64))], names=["a"])

    counts = rows.select("t").mapInArrow(count_pass, "a bigint").groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    repeated = spark.sparkContext.broadcast(bitmap_of(counts.where("n > 1").select("a"), "a"))

    def place_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts, data, low, high, offset, own in parts(batch.column(2), spans):
                found = Anchors(data, low, high, own, spans)
                if not len(found.at):
                    continue
                found.keep(has_bit(repeated.value, found.gram_hash()))
                text_at = pa.array(texts[found.text])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(text_at), batch.column(1).take(text_at), pa.array(found.at - found.edges[0] + offset),
                    *(pa.array(h.view(np.int64)) for h in (found.surroundings(), found.core_hash(LEFT), found.core_hash(RIGHT))),
                    pa.array((found.at - found.low).astype(np.int32)), pa.array((found.high - found.at).astype(np.int32)),
                ], names=["id", "th", "at", "c", "core_l", "core_r", "ahead", "behind"])

    fields = f"id {kind}, th bigint, at bigint, c bigint, core_l bigint, core_r bigint, ahead int, behind int"
    places = stash(rows.select("id", "th", "t").mapInArrow(place_pass, fields), "places")
    sides = [F.first(name).alias(name) for name in ("core_l", "core_r", "ahead", "behind")]
    classes = stash(places.groupBy("c").agg(F.count(F.lit(1)).alias("n"), *sides), "surroundings")
    whole = classes.where((F.col("n") > 1) & (F.col("ahead") + F.col("behind") >= length))
    whole = whole.select("c", (-F.col("ahead")).cast("bigint").alias("first"), F.col("behind").cast("bigint").alias("last"))

    both = F.array(*[F.struct(F.lit(s).alias("side"), F.col(core).alias("core")) for s, core in ((LEFT, "core_l"), (RIGHT, "core_r"))])
    nodes = classes.select("c", "n", F.explode(both).alias("node")).select("c", "n", "node.side", "node.core").where("core <> 0")
    groups = nodes.groupBy("core").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("least")).where("k > 1 and least = 1")
    groups = groups.select("core", F.ceil(F.col("k") / piece).alias("pieces"))
    wanted = stash(nodes.join(groups, "core").select("c", "side", "core", "pieces"), "nodes")

    @F.arrow_udf("bigint")
    def marks(c: pa.Array, side: pa.Array) -> pa.Array:
        return pa.array(mix(np.asarray(c).view(np.uint64) + np.asarray(side).astype(np.uint64)).view(np.int64))

    asked = spark.sparkContext.broadcast(bitmap_of(wanted.select(marks("c", "side").alias("m")), "m"))

    def context_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, low, high, _, own in parts(batch.column(0), spans):
                found = Anchors(data, low, high, own, spans)
                if not len(found.at):
                    continue
                found.keep(has_bit(repeated.value, found.gram_hash()))
                c, raw = found.surroundings(), data.tobytes()
                for side in (LEFT, RIGHT):
                    start, inside = found.node(side)
                    at = np.flatnonzero(inside & has_bit(asked.value, side_mark(c, side)))
                    if not len(at):
                        continue
                    at = at[np.unique(c[at], return_index=True)[1]]
                    first = np.maximum(start[at] - spans.wide, found.edges[0][at])
                    last = np.minimum(start[at] + spans.length, found.edges[1][at])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(c[at].view(np.int64)), pa.array(np.full(len(at), side, np.int32)), pa.array((start[at] - first).astype(np.int32)),
                        pa.array([raw[a:b] for a, b in zip(first.tolist(), last.tolist())], pa.binary()),
                    ], names=["c", "side", "ahead", "context"])

    contexts = rows.select("t").mapInArrow(context_pass, "c bigint, side int, ahead int, context binary")
    contexts = contexts.groupBy("c", "side").agg(F.first("ahead").alias("ahead"), F.first("context").alias("context"))
    nodes = contexts.join(wanted, ["c", "side"]).withColumn("piece", F.pmod(F.xxhash64("c"), F.col("pieces")))
    dealt = nodes.repartition("core", "piece").sortWithinPartitions("core", "piece")
    dealt = dealt.select("core", "piece", "pieces", "c", "side", "ahead", "context")

    def sort_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= TASK_NODES:
                table = pa.Table.from_batches(held).combine_chunks()
                core, part = (np.asarray(table.column(n).combine_chunks()) for n in ("core", "piece"))
                last = int(np.flatnonzero((core != core[-1]) | (part != part[-1]))[-1]) + 1 if (core[0], part[0]) != (core[-1], part[-1]) else 0
                if last:
                    yield from sorted_nodes(table.slice(0, last))
                    held = table.slice(last).to_batches()
        if held:
            yield from sorted_nodes(pa.Table.from_batches(held))

    def sorted_nodes(table: pa.Table) -> Iterator[pa.RecordBatch]:
        if not table.num_rows:
            return
        core, part, pieces, c, side, ahead = (np.asarray(table.column(n).combine_chunks()) for n in ("core", "piece", "pieces", "c", "side", "ahead"))
        group = np.cumsum(np.concatenate(([True], (core[1:] != core[:-1]) | (part[1:] != part[:-1]))))
        texts = table.column("context").to_pylist()
        marked, first = repeats(texts, ahead.astype(np.int64), group, spans)
        # string j of a node starts j bytes before its core; from the anchor that is half more on the left side
        shift = -spans.half * (side == LEFT)
        row, start, stop = cover(marked[:, ::-1], shift - spans.wide, length)
        yield pa.RecordBatch.from_arrays([
            pa.array(c[row]), pa.array(start.astype(np.int64)), pa.array(stop.astype(np.int64)), pa.nulls(len(row), pa.int64()), pa.nulls(len(row), pa.list_(pa.int64())),
        ], names=names)
        # groups in several pieces: blocks of strings that this piece has first, for a comparison between pieces
        many = np.flatnonzero(pieces > 1)
        if not len(many):
            return
        data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts], np.int64)
        zero = np.cumsum(sizes) - sizes + ahead
        hashed = PrefixHash(data)
        for numbers in np.array_split(np.arange(spans.wide + 1), BLOCKS):
            has = many[first[many][:, numbers].any(1)]
            near, far = zero[has] - numbers[0], zero[has] - numbers[-1] + length
            block = mix(mix(hashed.part(near, np.maximum(near, far))) + mix(core[has].view(np.uint64)) + np.uint64(numbers[0]))
            begin = zero[has][:, None] - numbers[None, :]
            ok = first[has][:, numbers]
            each = mix(mix(hashed.part(np.where(ok, begin, 0), np.where(ok, begin + length, 0))) + mix(core[has].view(np.uint64))[:, None] + numbers.astype(np.uint64))
            lists = [e[o].view(np.int64).tolist() + (shift[i] - numbers[o]).tolist() for e, o, i in zip(each, ok, has)]
            yield pa.RecordBatch.from_arrays([
                pa.array(c[has]), pa.nulls(len(has), pa.int64()), pa.nulls(len(has), pa.int64()), pa.array(block.view(np.int64)), pa.array(lists, pa.list_(pa.int64())),
            ], names=names)

    names = ["c", "first", "last", "block", "strings"]
    found = stash(dealt.mapInArrow(sort_pass, "c bigint, first bigint, last bigint, block bigint, strings array<bigint>"), "sorted")
    inside = found.where("block is null").select("c", "first", "last")
    blocks = found.where("block is not null")
    alike = blocks.groupBy("block").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high").select("block")
    half = (F.size("strings") / 2).cast("int")
    single = F.arrays_zip(F.slice("strings", F.lit(1), half).alias("h"), F.slice("strings", half + 1, half).alias("first"))
    strings = blocks.join(alike, "block").select("c", F.explode(single).alias("s")).select("c", "s.h", "s.first")
    twice = strings.groupBy("h").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high").select("h")
    across = strings.join(twice, "h").select("c", "first", (F.col("first") + length).alias("last"))
    spread = whole.unionByName(inside).unionByName(across)
    at = places.select("id", "th", "at", "c").join(spread, "c")
    span = F.struct((F.col("at") + F.col("first")).alias("first"), (F.col("at") + F.col("last")).alias("last"))
    return at.groupBy("id", "th").agg(F.collect_list(span).alias("spans"))


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 200, gram: int = GRAM, piece: int = PIECE,
) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept): every row, with what is left of its bytes.

    A byte goes when it lies in a string of `length` bytes that also starts at another place, in this document or
    another one; overlapping repeats count, and all strings are judged on the input. NULL counts as the empty text.
    Rows that repeat a key are documents of their own, also when their texts are equal (which then repeat each other).
    Other columns are not read. An empty table gives no rows.
    """
    spans = covered_spans(docs, key, text, length, gram, piece)
    rows = docs.select(F.col(key).alias("row_id"), F.coalesce(text, F.lit("")).alias("t")).withColumn("row_th", F.xxhash64("t"))
    joined = rows.join(spans, F.col("row_id").eqNullSafe(F.col("id")) & (F.col("row_th") == F.col("th")), "left")
    kind = rows.schema["row_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw, ranges in zip(batch.column(1), batch.column(2), strict=True):
                raw, ranges = raw.as_py().encode(), ranges.values
                if ranges is None or not len(ranges):
                    out.append((len(raw), 0, 0, raw))
                    continue
                edges = np.zeros(len(raw) + 1, np.int32)
                np.add.at(edges, np.asarray(ranges.flatten()[0]), 1)
                np.add.at(edges, np.asarray(ranges.flatten()[1]), -1)
                gone = np.cumsum(edges[:-1]) > 0
                runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                out.append((len(raw), int(gone.sum()), runs, np.frombuffer(raw, np.uint8)[~gone].tobytes()))
            columns = list(zip(*out)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in columns[:3]), pa.array(columns[3], pa.binary())],
                names=["key", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    done = joined.select("row_id", "t", "spans").mapInArrow(cut, f"key {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    return done.select(F.col("key").alias(key), "n_bytes", "n_removed", "n_spans", "kept")
