"""Tower inputs: one list of features, fitted once, turns rows into one vector of numbers in one plan."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segue.functions import text as X
from segue.functions.scalars import bucketize, hash_bin, stable_hash
from segue.operators import vocab as V
from segue.operators.vocab import UNKNOWN_ID, fit_vocab, joined_ids, looked_up, split_keys

BOUNDARIES = 20
KINDS = ("bucket", "hash", "text", "number")


@dataclass(frozen=True)
class Feature:
    """How a column becomes numbers; `size` is the largest value of a bucket, or the number of bins of a hash.

    bucket and number give one number, hash and text `dims` of them. A column that is `listed` holds an array, over whose
    elements the numbers are averaged.
    """

    column: str
    kind: str
    size: float = 0.0
    listed: bool = False

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"{self.column}: {self.kind} is none of {KINDS}")


def pooled(values: Column, parts: int, one) -> Column:
    """`parts` numbers: the mean of `one(element, part)` over an array, zeros without elements. The array is computed once."""

    def over(held: Column) -> Column:
        added = lambda j: F.aggregate(held, F.lit(0.0), lambda acc, x: acc + one(x, j))
        return F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda j: F.when(F.size(held) > 0, added(j) / F.size(held)).otherwise(0.0))

    return F.transform(F.array(F.coalesce(values, F.array().cast("array<bigint>"))), over)[0]


def sign(hashed: Column, part: Column) -> Column:
    """1 or -1 from a bit of a hash."""
    return 1.0 - 2.0 * F.call_function("shiftright", hashed, part).bitwiseAND(F.lit(1)).cast("double")


class TowerFeatures(Estimator):
    """Learns what the features need: vocabularies of all text columns in one job, means and deviations of numbers in one.

    `key` tells the rows apart. A vocabulary has at most `max_tokens` ids, the two fixed ones included.
    """

    def __init__(self, features: Sequence[Feature], key: Sequence[str], dims: int = 4, max_tokens: int = 20_000, ngrams: int = 2):
        super().__init__()
        if not 1 <= dims <= 60:
            raise ValueError("dims is from 1 to 60")
        self.features, self.key, self.dims, self.max_tokens, self.ngrams = list(features), list(key), dims, max_tokens, ngrams

    def _fit(self, dataset: DataFrame) -> TowerModel:
        texts = [f.column for f in self.features if f.kind == "text"]
        spark = dataset.sparkSession
        vocab = fit_vocab(dataset, texts, self.max_tokens, self.ngrams) if texts else spark.createDataFrame([], "feature string, token string, n bigint, idx int")
        sums = {}
        for f in self.features:
            if f.kind == "number":
                values = F.col(f.column).cast("array<double>") if f.listed else F.array(F.col(f.column).cast("double"))
                held = F.filter(values, lambda x: x.isNotNull() & ~F.isnan(x))
                total = lambda power, held=held: F.sum(F.aggregate(held, F.lit(0.0), lambda acc, x: acc + F.pow(x, F.lit(power))))
                sums |= {f"n_{f.column}": F.sum(F.size(held)), f"s_{f.column}": total(1.0), f"q_{f.column}": total(2.0)}
        found = dataset.agg(*[c.alias(n) for n, c in sums.items()]).first().asDict() if sums else {}
        stats = {}
        for f in self.features:
            if f.kind == "number":
                n = found[f"n_{f.column}"] or 0
                mean = (found[f"s_{f.column}"] or 0.0) / n if n else 0.0
                spread = max((found[f"q_{f.column}"] or 0.0) / n - mean**2, 0.0) ** 0.5 if n else 0.0
                stats[f.column] = (mean, spread or 1.0)
        return TowerModel(self.features, self.key, self.dims, self.ngrams, vocab, stats)


class TowerModel(Model):
    """Adds `features`, an array of `width` numbers in the order of the list of features.

    bucket: the number of evenly spaced boundaries from 0 to `size` that are reached, as a share of all 20. number: distance
    from the mean in deviations. hash: the bin's hash as `dims` signs. text: the mean of those signs over the ids of the
    known and unknown 1- to n-grams. NULL counts as 0, as the mean, as the empty text, or as no text; NULL lists are empty.
    All of it is one expression, and only keys move: vocabularies of up to `vocab.TASK_TOKENS` tokens in all go to the tasks. Larger
    ones, and the texts of rows whose key is not whole or repeats, meet it in joins.
    """

    def __init__(self, features: Sequence[Feature], key: Sequence[str], dims: int, ngrams: int, vocab: DataFrame, stats: dict):
        super().__init__()
        self.features, self.key, self.dims, self.ngrams, self.vocab, self.stats = list(features), list(key), dims, ngrams, vocab, dict(stats)

    @property
    def width(self) -> int:
        return sum(self.dims if f.kind in ("hash", "text") else 1 for f in self.features)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        texts = {f.column: f for f in self.features if f.kind == "text"}
        known = self.vocab.where(F.col("feature").isin(*texts)) if texts else self.vocab
        if not texts:
            return self._with_features(dataset, dataset.columns, {})
        if known.limit(V.TASK_TOKENS + 1).count() > V.TASK_TOKENS:
            return self._joined(dataset, texts)
        hashed = {c: self._hash(f, F.col("idx")) for c, f in texts.items()}
        found = known.select("feature", "token", *[h.alias(f"_{i}") for i, h in enumerate(hashed.values())]).collect()
        spark = dataset.sparkSession
        others = spark.range(1).select(*[self._hash(f, F.lit(UNKNOWN_ID)) for f in texts.values()]).first()
        once, several = split_keys(dataset, self.key)
        rows = once
        for i, (c, f) in enumerate(texts.items()):
            mine = [r for r in found if r.feature == c]
            hashes = looked_up(self._grams(f), [r.token for r in mine], [r[f"_{i}"] for r in mine], others[i])
            rows = rows.withColumn(f"_hash_{i}", hashes)
        out = self._with_features(rows, dataset.columns, {c: F.col(f"_hash_{i}") for i, c in enumerate(texts)})
        return out if several is None else out.unionByName(self._joined(several, texts))

    def _joined(self, dataset: DataFrame, texts: dict[str, Feature]) -> DataFrame:
        """The same by joins: for a large vocabulary, and for rows whose key is not whole or repeats."""
        outs = {c: f"_ids_{i}" for i, c in enumerate(texts)}
        held = dataset.select(*self.key, *texts)
        ids = joined_ids(held, self.key, self.vocab, outs, self.ngrams).select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(self.key)], *outs.values())
        same = [F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(self.key)]
        hashes = {}
        for c, f in texts.items():
            values = F.flatten(F.filter(outs[c], lambda x: x.isNotNull())) if f.listed else F.col(outs[c])
            hashes[c] = self._hashes(f, values)
        return self._with_features(dataset.join(ids, same), dataset.columns, hashes)

    def _with_features(self, rows: DataFrame, columns: list[str], hashes: dict[str, Column]) -> DataFrame:
        parts = [self._numbers(f, hashes.get(f.column)) for f in self.features]
        return rows.withColumn("features", F.concat(*parts)).select(*columns, "features")

    def _grams(self, f: Feature) -> Column:
        one = lambda text: X.ngrams(X.tokens(text.cast("string")), self.ngrams)
        return F.flatten(F.transform(F.filter(f.column, lambda x: x.isNotNull()), one)) if f.listed else one(F.col(f.column))

    def _numbers(self, f: Feature, hashes: Column | None) -> Column:
        column = F.col(f.column)
        if f.kind == "text":
            return pooled(hashes, self.dims, sign)
        values = column if f.listed else F.array(column)
        if f.kind == "hash":
            bins = F.transform(values.cast("array<string>"), lambda v: hash_bin(F.coalesce(v, F.lit("")), int(f.size), portable=True))
            return pooled(self._hashes(f, bins), self.dims, sign)
        if f.kind == "bucket":
            places = F.transform(values.cast("array<double>"), lambda v: F.coalesce(bucketize(v, f.size, boundaries=BOUNDARIES), F.lit(0)).cast("bigint"))
            return pooled(places, 1, lambda x, _: x.cast("double") / BOUNDARIES)
        mean, spread = self.stats[f.column]
        scaled = F.transform(values.cast("array<double>"), lambda v: F.when(v.isNull() | F.isnan(v), 0.0).otherwise((v - mean) / spread))
        return pooled(scaled, 1, lambda x, _: x)

    def _hash(self, f: Feature, id_: Column) -> Column:
        return stable_hash(F.concat(F.lit(f"{f.column}-"), id_.cast("string")))

    def _hashes(self, f: Feature, ids: Column) -> Column:
        return F.transform(ids, lambda x: self._hash(f, x))

    def save(self, path: str) -> None:
        """The vocabularies and the rest of the state as two tables under `path`."""
        state = {"features": [asdict(f) for f in self.features], "key": self.key, "dims": self.dims, "ngrams": self.ngrams, "stats": self.stats}
        self.vocab.write.mode("overwrite").parquet(f"{path}/vocab")
        self.vocab.sparkSession.createDataFrame([(json.dumps(state),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/state")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TowerModel:
        state = json.loads(spark.read.text(f"{path}/state").first().value)
        features = [Feature(**f) for f in state["features"]]
        return cls(features, state["key"], state["dims"], state["ngrams"], spark.read.parquet(f"{path}/vocab"), state["stats"])
