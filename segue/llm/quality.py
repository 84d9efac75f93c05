"""Quality classifier: a factorization machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segue.llm.text_bytes import PrefixHash, mix, release, slices

WORD_BUCKETS = 1 << 14
SAMPLE_ROWS = 8_000
READ_BYTES = 1 << 18  # texts described at a time; what is held for them is many times as large
STATISTICS = 14

_kind = np.zeros(256, np.uint8)  # 0 other bytes, 1 white space, 2 capitals, 3 small letters, 4 digits, 5 stops, 6 signs
_kind[[9, 10, 11, 12, 13, 32]] = 1
_kind[65:91], _kind[97:123], _kind[48:58] = 2, 3, 4
_kind[[ord(c) for c in ".,;:'\"?-()"]] = 5
_kind[[ord(c) for c in "!#$%&*+/<=>@[\\]^_`{|}~"]] = 6


@dataclass
class Rows:
    """Sparse rows: the entries of row i lie between edges[i] and edges[i + 1]."""

    index: np.ndarray
    value: np.ndarray
    edges: np.ndarray


def per_text(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(values, dtype=np.float64)))
    return sums[edges[1:]] - sums[edges[:-1]]


def describe(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, Rows]:
    """(structure statistics, hashed words) of the texts of a slice."""
    texts = len(edges) - 1
    kind = _kind[data]
    blank = kind == 1
    start_mask = ~blank & np.concatenate(([True], blank[:-1]))[: len(data)]
    inner = edges[(edges > 0) & (edges < len(data))]
    start_mask[inner] = ~blank[inner]
    end_mask = ~blank & np.concatenate((blank[1:], [True]))[: len(data)]
    end_mask[inner - 1] = ~blank[inner - 1]
    starts, ends = np.flatnonzero(start_mask), np.flatnonzero(end_mask) + 1
    lower = np.where(kind == 2, data + np.uint8(32), data)
    hashed = mix(PrefixHash(lower).part(starts, ends))
    owner = np.searchsorted(edges, starts, "right") - 1
    words = np.bincount(owner, minlength=texts).astype(np.float64)
    same = np.zeros(len(starts))
    same[1:] = (hashed[1:] == hashed[:-1]) & (owner[1:] == owner[:-1])

    key = owner.astype(np.uint64) * np.uint64(WORD_BUCKETS) + hashed % np.uint64(WORD_BUCKETS)
    found, counts = np.unique(key, return_counts=True)
    row = (found // np.uint64(WORD_BUCKETS)).astype(np.int64)
    weight = np.log1p(counts)
    norm = np.sqrt(np.bincount(row, weight**2, minlength=texts))
    rows = Rows((found % np.uint64(WORD_BUCKETS)).astype(np.int32), weight / norm[row], np.searchsorted(row, np.arange(texts + 1)))

    size = np.diff(edges).astype(np.float64)
    n, w = np.maximum(size, 1), np.maximum(words, 1)
    share = [per_text(kind == k, edges) for k in range(7)]
    letters = np.maximum(share[2] + share[3], 1)
    top = np.zeros(texts)
    np.maximum.at(top, row, counts)
    signs = [per_text(data == ord(c), edges) / w for c in "!|"]
    statistics = np.column_stack([
        np.log1p(size), np.log1p(words), share[0] / n, share[1] / n, share[2] / letters, share[4] / n, share[5] / n,
        np.sqrt(share[6] / n), share[6] / w, *signs, np.log1p(size / w), np.bincount(owner, same, minlength=texts) / w,
        np.where(words >= 20, top / w, 0.1),
    ])
    return statistics, rows


@dataclass
class Model:
    """w0 + w.x + the products of all pairs of entries, weighted by the inner products of their factors."""

    center: np.ndarray
    scale: np.ndarray
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def inputs(self, numbers: np.ndarray, words: Rows) -> Rows:
        """The numbers, standardized and held within four deviations, after the words of each row."""
        numbers = np.clip((numbers - self.center) / self.scale, -4, 4)
        rows, width = numbers.shape
        at = np.repeat(words.edges[1:], width)
        index = np.insert(words.index, at, np.tile(WORD_BUCKETS + np.arange(width, dtype=np.int32), rows))
        return Rows(index, np.insert(words.value, at, numbers.reshape(-1)), words.edges + width * np.arange(rows + 1))

    def sums(self, x: Rows) -> tuple[np.ndarray, np.ndarray]:
        """(margin, sum of factors) of each row, in time linear in the entries: the product of all pairs is half of
        the square of the sum less the sum of the squares."""
        scaled = self.factors[x.index] * x.value[:, None]
        both = np.concatenate([(self.linear[x.index] * x.value)[:, None], scaled, (scaled**2).sum(1)[:, None]], axis=1)
        total = np.add.reduceat(both, x.edges[:-1], axis=0)
        held = total[:, 1:-1]
        return self.bias + total[:, 0] + 0.5 * ((held**2).sum(1) - total[:, -1]), held

    def score(self, x: Rows) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.sums(x)[0], -30, 30)))


def fit(numbers: np.ndarray, words: Rows, label: np.ndarray, factors: int = 8, epochs: int = 12, batch: int = 64, rate: float = 0.03, ridge: float = 1e-4, seed: int = 42) -> Model:
    """Logistic loss by AdaGrad over seeded batches."""
    rng = np.random.default_rng(seed)
    size = WORD_BUCKETS + numbers.shape[1]
    center, scale = numbers.mean(0), np.maximum(numbers.std(0), 1e-3)
    good = float(np.clip(label.mean(), 0.01, 0.99))
    model = Model(center, scale, float(np.log(good / (1 - good))), np.zeros(size), rng.normal(0, 0.02, (size, factors)))
    x = model.inputs(numbers, words)
    seen = np.full((size, factors + 1), 1e-3)
    for _ in range(epochs):
        order = rng.permutation(len(label))
        for first in range(0, len(order), batch):
            picked = order[first : first + batch]
            lengths = x.edges[picked + 1] - x.edges[picked]
            edges = np.concatenate(([0], np.cumsum(lengths)))
            at = np.repeat(x.edges[picked] - edges[:-1], lengths) + np.arange(edges[-1])
            part = Rows(x.index[at], x.value[at], edges)
            margin, held = model.sums(part)
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - label[picked]) / len(picked)
            own, error_of = np.repeat(np.arange(len(picked)), lengths), np.repeat(error, lengths)
            value = part.value[:, None]
            towards = value * held[own] - model.factors[part.index] * value**2
            gradient = error_of[:, None] * np.concatenate([value, towards], axis=1)
            used, where = np.unique(part.index, return_inverse=True)
            sums = np.column_stack([np.bincount(where, g, minlength=len(used)) for g in gradient.T])
            sums += ridge * np.column_stack([model.linear[used], model.factors[used]])
            seen[used] += sums**2
            step = rate * sums / np.sqrt(seen[used])
            model.linear[used] -= step[:, 0]
            model.factors[used] -= step[:, 1:]
            model.bias -= rate * float(error.sum())
    return model


def held_out(key: Column) -> Column:
    """Rows whose label is never learned: crc32 of the id as text is divisible by 5; so is a NULL id, as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def numbers_of(metadata: Sequence[str], row: str = "") -> Column:
    """Numeric metadata as an array; NULL and non-numbers count as 0."""
    values = [F.coalesce(F.expr(f"try_cast({row}`{name}` AS double)"), F.lit(0.0)) for name in metadata]
    return F.array(*values).cast("array<double>")


def with_metadata(statistics: np.ndarray, metadata: pa.Array) -> np.ndarray:
    width = len(metadata.flatten()) // max(1, len(metadata))
    extra = np.nan_to_num(np.asarray(metadata.flatten()).reshape(len(metadata), width), posinf=0, neginf=0)
    return np.column_stack([statistics, np.sign(extra) * np.log1p(np.abs(extra))])


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    metadata: Sequence[str] = (), sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """Fit on at most `sample_rows` labelled documents, those first by a hash of the id, none of them held out.

    NULL labels are left out; of several labels of one id the mean decides (0.5 counts as good), of several texts the
    first in order is taken. With no labelled row at all every score is 0.5.
    """
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("double").alias("label")).where(~held_out(F.col("key")))
    known = known.groupBy("key").agg(F.avg("label").alias("label")).where("label is not null")
    sample = F.broadcast(known.orderBy(F.xxhash64(F.lit(17), F.col("key")), "key").limit(sample_rows))
    texts = docs.select(F.col(key).alias("key"), F.struct(F.col(text).alias("text"), numbers_of(metadata).alias("meta")).alias("doc"))
    rows = texts.join(sample, "key").groupBy("key", "label").agg(F.min("doc").alias("doc"))

    def read(batches):
        for batch in batches:
            fields = batch.column(2).flatten()
            for first, data, edges in slices(fields[0], READ_BYTES):
                statistics, words = describe(data, edges)
                numbers = with_metadata(statistics, fields[1][first : first + len(statistics)])
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(i)[first : first + len(statistics)] for i in (0, 1)),
                    pa.array(list(numbers), pa.list_(pa.float64())),
                    pa.ListArray.from_arrays(pa.array(words.edges.astype(np.int32)), pa.array(words.index)),
                    pa.ListArray.from_arrays(pa.array(words.edges.astype(np.int32)), pa.array(words.value)),
                ], names=["key", "label", "numbers", "index", "value"])
        release()

    named = rows.select(F.col("key").cast("string").alias("key"), "label", "doc")
    found = named.mapInArrow(read, "key string, label double, numbers array<double>, index array<int>, value array<double>")
    table = found.toArrow().sort_by("key").combine_chunks()  # the order in which rows arrive must not change the model
    width = STATISTICS + len(metadata)
    if not table.num_rows:
        return Model(np.zeros(width), np.ones(width), 0.0, np.zeros(WORD_BUCKETS + width), np.zeros((WORD_BUCKETS + width, 1)))
    lists = table.column("index").combine_chunks()
    edges = np.concatenate(([0], np.cumsum(np.asarray(pa.compute.list_value_length(lists)))))
    words = Rows(np.asarray(lists.flatten()), np.asarray(table.column("value").combine_chunks().flatten()), edges)
    numbers = np.asarray(table.column("numbers").combine_chunks().flatten()).reshape(-1, width)
    return fit(numbers, words, (np.asarray(table.column("label")) >= 0.5).astype(np.float64))


def quality_score(model: Model, text: Column, metadata: Column) -> Column:
    """The score of each text, 0 to 1. The whole text counts; NULL scores as the empty text does."""

    @F.arrow_udf("double")
    def score(texts: pa.Array, numbers: pa.Array) -> pa.Array:
        out = []
        for first, data, edges in slices(texts, READ_BYTES):
            statistics, words = describe(data, edges)
            numbers_here = with_metadata(statistics, numbers[first : first + len(statistics)])
            out.append(model.score(model.inputs(numbers_here, words)))
        release()
        return pa.array(np.concatenate(out) if out else np.empty(0))

    return score(text, metadata)


def classify(
    docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", metadata: Sequence[str] = (), threshold: float = 0.3,
) -> DataFrame:
    """(key, held_out, score, predicted) for every row, repeated rows and NULL keys included; no row is dropped."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), numbers_of(metadata).alias("numbers"))
    scored = rows.select("key", held_out(F.col("key")).alias("held_out"), quality_score(model, F.col("text"), F.col("numbers")).alias("score"))
    return scored.select(F.col("key").alias(key), "held_out", "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def keep_good(
    docs: DataFrame, model: Model, text: str = "text", metadata: Sequence[str] = (), threshold: float = 0.3,
) -> DataFrame:
    """The rows whose score reaches the threshold, with all their columns whatever they are called."""
    nested = docs.select(F.struct("*").alias("doc"))
    score = quality_score(model, F.col(f"doc.`{text}`"), numbers_of(metadata, "doc."))
    return nested.where(score >= threshold).select("doc.*")
