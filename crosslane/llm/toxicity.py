"""Toxicity classifier with counterfactual regularisation.

A logistic model over words and word beginnings, hashed. It is fitted on a bounded sample of labelled
texts together with a copy of each text in which identity terms are swapped for others of their kind;
a change of score between the two is penalised, so that naming a group doesn't move the score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scan import _GOLD, _PLACES, mix64, text_slices
from .work import spread, written

#: Identity terms by kind; a term is swapped for the next of its kind.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab", "indigenous"), ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "citizens", "refugees"), ("immigrant", "citizen", "refugee"), ("disabled", "deaf", "blind", "autistic"), ("old", "young", "elderly"),
    ("frauen", "männer"), ("ausländer", "einheimische"), ("femmes", "hommes"), ("étrangers", "citoyens"), ("mujeres", "hombres"), ("extranjeros", "ciudadanos"),
)
#: Most labelled texts that are fitted on; hash buckets; features that are kept; bytes of word beginnings.
SAMPLE, BUCKETS, FEATURES, BEGINNINGS = 6000, 1 << 20, 1024, (4, 5, 6, 7, 8)
#: Strengths of the ridge and of the counterfactual penalty; steps of the fit.
RIDGE, FAIRNESS, STEPS = 1e-3, 1.0, 200

#: Added to the hash of a beginning of so many bytes; the first to that of a whole word.
_SALT = np.arange(1, 17, dtype=np.uint64) * _GOLD
_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def held_out(id_col: str = "doc_id") -> Column:
    """The fifth of the rows that is never learned from; a null id counts as an empty one, which is in it."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def hashed_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of each word and word beginning; words are runs of ASCII letters, digits and other characters."""
    none = np.zeros(0, np.int64)
    if not len(data):
        return none, none
    low = _LOWER[data]
    accented = np.flatnonzero((low[:-1] == 0xC3) & (low[1:] >= 0x80) & (low[1:] <= 0x9E)) + 1
    low[accented] += 0x20
    word = _WORD[low]
    cut = np.zeros(len(low) + 1, bool)
    cut[offsets] = True
    begin, end = word.copy(), word.copy()
    begin[1:] &= ~word[:-1] | cut[1:-1]
    end[:-1] &= ~word[1:] | cut[1:-1]
    start, stop = np.flatnonzero(begin), np.flatnonzero(end) + 1
    if not len(start):
        return none, none
    size = stop - start
    row = np.searchsorted(offsets, start, "right") - 1
    total = np.cumsum(size)
    place = np.arange(total[-1]) - np.repeat(total - size, size)
    value = _PLACES[((place & 63) << 8) | low[place + np.repeat(start, size)]]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)])
    at = total - size
    rows, hashes = [row], [mix64(sums[at + size] - sums[at] + _SALT[0])]
    for k in BEGINNINGS:
        longer = np.flatnonzero(size >= k)
        rows.append(row[longer])
        hashes.append(mix64(sums[at[longer] + k] - sums[at[longer]] + _SALT[k]))
    return np.concatenate(rows), (np.concatenate(hashes) >> np.uint64(44)).astype(np.int64) % BUCKETS


def distinct_features(column: pa.Array) -> list[np.ndarray]:
    """Sorted distinct buckets of each text."""
    out = []
    for _, data, offsets in text_slices(column):
        row, bucket = hashed_features(data, offsets)
        key = np.unique(row * BUCKETS + bucket)
        out += np.split(key % BUCKETS, np.searchsorted(key // BUCKETS, np.arange(1, len(offsets) - 1)))
    return out


_NEXT = {a: group[(i + 1) % len(group)] for group in IDENTITY_TERMS for i, a in enumerate(group)}
_TERM = re.compile(r"\b(?:" + "|".join(sorted(_NEXT, key=len, reverse=True)) + r")\b", re.IGNORECASE)


def counterfactual(text: str) -> str:
    """The text with each identity term swapped for the next of its kind, in the case of its first letter."""

    def swap(m: re.Match) -> str:
        other = _NEXT[m[0].lower()]
        return other.capitalize() if m[0][0].isupper() else other

    return _TERM.sub(swap, text)


@dataclass(frozen=True)
class Model:
    """Weight of each kept bucket (others are 0) and the intercept."""

    buckets: np.ndarray
    weights: np.ndarray
    intercept: float

    def table(self) -> np.ndarray:
        out = np.zeros(BUCKETS, np.float32)
        out[self.buckets] = self.weights
        return out

    def scores(self, column: pa.Array) -> np.ndarray:
        """Between 0 and 1 for each text; a text without known features has the intercept's score."""
        table, out = self.table(), []
        for _, data, offsets in text_slices(column):
            row, bucket = hashed_features(data, offsets)
            known = table[bucket] != 0
            key = np.unique(row[known] * BUCKETS + bucket[known])
            total = np.bincount(key // BUCKETS, table[key % BUCKETS].astype(np.float64), minlength=len(offsets) - 1)
            out.append(1 / (1 + np.exp(-np.clip(total + self.intercept, -30, 30))))
        return np.concatenate(out) if out else np.zeros(0)


def chosen_features(bad: np.ndarray, good: np.ndarray, n_bad: int, n_good: int, features: int = FEATURES) -> np.ndarray:
    """Places of the features that differ most between the labels, by chi-square; ``bad`` and ``good`` count the texts that have them."""
    both, n = (bad + good).astype(float), n_bad + n_good
    if not n_bad or not n_good:
        return np.zeros(0, np.int64)
    expected = both * n_bad / n
    with np.errstate(divide="ignore", invalid="ignore"):
        chi = np.where(both >= 5, (bad - expected) ** 2 / (expected * (1 - n_bad / n) * (1 - both / n) + 1e-9), 0)
    return np.sort(np.argsort(-chi, kind="stable")[: min(features, int((chi > 3.84).sum()))])


def fit(x: np.ndarray, gap: np.ndarray, toxic: np.ndarray, ridge: float = RIDGE, fairness: float = FAIRNESS, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic model of the rows of ``x``; ``gap`` holds what swapping identity terms changes in a
    row, and its effect on the score is penalised. Without both labels the intercept alone is fitted, to the share of toxic rows."""
    n = len(x)
    if not n or toxic.min() == toxic.max():
        rate = (float(toxic.sum()) + 0.5) / (n + 1)
        return np.zeros(x.shape[1]), float(np.log(rate / (1 - rate)))
    n_bad, n_good = float(toxic.sum()), float(n - toxic.sum())
    w, b, y = np.zeros(x.shape[1], np.float32), float(np.log(n_bad / n_good)), toxic.astype(np.float32)
    # Labels weigh the same in the loss; the intercept absorbs the rest.
    weight = np.where(y == 1, n / (2 * n_bad), n / (2 * n_good)).astype(np.float32) / n
    m1, m2, mb1, mb2 = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))
        error = (p - y) * weight
        g = x.T @ error + ridge * w
        if len(gap):
            g += 2 * fairness * (gap.T @ (gap @ w)) / len(gap)
        gb = float(error.sum())
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        mb1, mb2 = 0.9 * mb1 + 0.1 * gb, 0.999 * mb2 + 0.001 * gb * gb
        c1, c2 = 1 - 0.9**t, 1 - 0.999**t
        w -= 0.05 * (m1 / c1) / (np.sqrt(m2 / c2) + 1e-8)
        b -= 0.05 * (mb1 / c1) / (np.sqrt(mb2 / c2) + 1e-8)
    return w.astype(np.float64), b


def _matrix(rows: list, width: int) -> np.ndarray:
    m = np.zeros((len(rows), width), np.float32)
    for i, r in enumerate(rows):
        m[i, r] = 1
    return m


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", features: int = FEATURES, **how) -> Model:
    """Fit on at most ``sample`` labelled rows that aren't held out, picked by a hash of the id.

    Rows without a label, an id or a text aren't learned from; of texts that repeat an id, only the one with the least
    feature set is. Features are counted on the executors; what comes to the driver are the counts of BUCKETS features at
    most, then for each of the picked rows which of the ``features`` chosen ones it has, however long its text is.
    """
    spark = docs.sparkSession
    picked = (
        labels.where(~held_out(id_col) & F.col(id_col).isNotNull() & F.col("toxic").isin(0, 1))
        .groupBy(id_col).agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64(F.col(id_col).cast("string")), id_col).limit(sample)
    )
    rows = docs.where(F.col(text_col).isNotNull()).select(id_col, text_col).join(F.broadcast(picked.withColumnRenamed(id_col, "_id")), F.col(id_col) == F.col("_id")).select(F.col(text_col).alias("text"), "toxic", "_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain = batch.column(0)
            other = [None if t is None or (s := counterfactual(t)) == t else s for t in plain.to_pylist()]
            own = [a.astype(np.int32) for a in distinct_features(plain)]
            sets = distinct_features(pa.array([s or "" for s in other], pa.string()))
            pair = [None if s is None else a.astype(np.int32) for s, a in zip(other, sets, strict=True)]
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(own, kind), pa.array(pair, kind), batch.column(1), batch.column(2)], names=["own", "pair", "toxic", "_id"])

    sets = rows.mapInArrow(run, f"own array<int>, pair array<int>, {', '.join(f'{f.name} {f.dataType.simpleString()}' for f in rows.schema[1:])}")
    once = written(sets.groupBy("_id").agg(F.min(F.struct("own", "pair", "toxic")).alias("one")).select("one.*"), "features")
    toxic = once.groupBy("toxic").count().toArrow().to_pydict()
    n = dict(zip(toxic["toxic"], toxic["count"], strict=True))
    counts = once.select(F.explode("own").alias("bucket"), "toxic").groupBy("bucket").agg(F.sum("toxic").alias("bad"), F.count("*").alias("both")).where("both >= 5").toArrow()
    bad, both = np.zeros(BUCKETS), np.zeros(BUCKETS)
    at = counts["bucket"].to_numpy()
    bad[at], both[at] = counts["bad"].to_numpy(), counts["both"].to_numpy()
    pick = chosen_features(bad, both - bad, n.get(1, 0), n.get(0, 0), features)
    sent = spark.sparkContext.broadcast(pick)

    def narrowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = sent.value
            of = lambda r: None if r is None else np.flatnonzero(np.isin(chosen, r)).astype("<i4").tobytes()
            cols = [pa.array([of(r) for r in batch.column(i).to_pylist()], pa.binary()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*cols, batch.column(2)], names=["own", "pair", "toxic"])

    got = once.mapInArrow(narrowed, "own binary, pair binary, toxic int").toArrow().to_pylist()
    # Sorted, so that the fit doesn't depend on the order in which tasks end.
    got.sort(key=lambda r: (r["own"], r["pair"] or b"", r["toxic"]))
    read = lambda b: np.frombuffer(b, "<i4")
    x = _matrix([read(r["own"]) for r in got], len(pick))
    swapped = [i for i, r in enumerate(got) if r["pair"] is not None]
    gap = x[swapped] - _matrix([read(got[i]["pair"]) for i in swapped], len(pick))
    weights, intercept = fit(x, gap, np.array([r["toxic"] for r in got], np.int64), **how)
    return Model(pick, weights, intercept)


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """The columns of ``docs`` and the score of the whole text (null: empty), in place of a column of that name. Narrow: no shuffle."""
    docs = docs.drop(score_col)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES weights at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = sent.value.scores(batch.column(batch.schema.get_field_index(text_col)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.float64())], names=[*batch.schema.names, score_col])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{fields}, `{score_col}` double")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES = {"op2_toxicity": op2_toxicity}
ORACLE: dict[str, str] = {}
