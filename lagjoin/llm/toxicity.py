"""Toxicity by cumulative-link ordinal regression.

P(grade > k) = sigmoid(w.x - t_k): one weight per word bucket shared by all
ordered thresholds t_1 < t_2 < ...; features are the distinct words of a
whole text and their beginnings, hashed and weighted by how often they occur.  The model is fitted on at most ``sample_rows`` labelled
documents (the least by a hash of their id); words of fewer than MIN_DOCS of
them teach nothing.  Prediction maps every whole text to its expected
severity, the sum of P(grade > k).

Defined results: a null or empty text has the severity of no words; labels
with a null grade or id teach nothing; repeated documents teach once; with
no labels or a single grade the severity is that grade (0 if none); an empty
table has no rows.  A very long text counts whole.  Columns that are not asked
for are not looked at; those asked for must not be named like the results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagjoin.llm.shared import byte_chunks, byte_words, mixed, ship, span_hashes, table

BUCKETS = 1 << 18
SAMPLE_ROWS = 8000
MIN_DOCS = 4
BEGINNINGS = (5, 7)  # lengths in bytes
ROUNDS, RATE, DECAY = 300, 0.1, 1e-4


def word_features(column: pa.Array):
    """Sorted distinct buckets of every text's words and word beginnings,
    and their values: log(1 + occurrences per hundred words)."""
    for a, b, raw, offsets in byte_chunks(column):
        low, starts, ends, hashes, by_row = byte_words(raw, offsets)
        n_words = np.diff(by_row)
        row = np.repeat(np.arange(b - a), n_words)
        cells = [row * BUCKETS + (hashes % np.uint64(BUCKETS)).astype(np.int64)]
        for n in BEGINNINGS:
            longer = np.flatnonzero(ends - starts > n)
            begun = mixed(span_hashes(low, starts[longer], starts[longer] + n)) % np.uint64(BUCKETS)
            cells.append(row[longer] * BUCKETS + begun.astype(np.int64))
        cell, count = np.unique(np.concatenate(cells), return_counts=True)
        at = np.searchsorted(cell, np.arange(b - a + 1) * BUCKETS)
        value = np.log1p(100 * count / n_words[cell // BUCKETS])
        cell %= BUCKETS
        for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()):
            yield cell[lo:hi], value[lo:hi]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class OrdinalModel:
    """Grades, weights and thresholds."""

    def __init__(self, grades: list[int], weights: np.ndarray, thresholds: np.ndarray):
        self.grades, self.weights, self.thresholds = grades, weights, thresholds

    def beyond(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for every threshold."""
        return _sigmoid(score[:, None] - self.thresholds[None, :])

    def score(self, features) -> float:
        buckets, values = features
        return float(self.weights[buckets] @ values)

    def severity(self, score: np.ndarray) -> np.ndarray:
        """Expected grade: the least one and the steps above it."""
        steps = np.diff(np.array(self.grades, float))
        return (self.grades[0] if self.grades else 0) + self.beyond(score) @ steps

    @classmethod
    def fit(cls, features: list[tuple[np.ndarray, np.ndarray]], labels: list[int]) -> "OrdinalModel":
        grades = sorted(set(labels))
        weights = np.zeros(BUCKETS)
        if len(grades) < 2:
            return cls(grades, weights, np.empty(0))
        y = np.searchsorted(grades, labels)
        flat, value = (np.concatenate([f[i] for f in features]) for i in range(2))
        doc = np.repeat(np.arange(len(features)), [len(f[0]) for f in features])
        df = np.bincount(flat, minlength=BUCKETS)
        used = np.flatnonzero(df >= MIN_DOCS)
        place = np.full(BUCKETS, -1)
        place[used] = np.arange(len(used))
        at = place[flat]
        flat, doc, value = at[at >= 0], doc[at >= 0], value[at >= 0]
        k, n = len(grades) - 1, len(y)
        share = np.array([(y > i).mean() for i in range(k)])
        base = np.log((1 - share) / share)
        # the first threshold, then logarithms of the gaps: order is kept
        gaps = np.log(np.maximum(np.diff(base), 1e-2))
        theta = np.concatenate([np.zeros(len(used)), base[:1], gaps])
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        weight = np.array([n / (len(grades) * (y == g).sum()) for g in range(len(grades))])[y]
        weight = np.sqrt(weight)
        rows = np.arange(n)
        for step in range(1, ROUNDS + 1):
            w, t = theta[:len(used)], theta[len(used):]
            cut = np.cumsum(np.concatenate([t[:1], np.exp(t[1:])]))
            s = np.bincount(doc, w[flat] * value, n)
            edge = np.concatenate([[-1e9], cut, [1e9]])
            up, low = _sigmoid(edge[y + 1] - s), _sigmoid(edge[y] - s)
            p = np.maximum(up - low, 1e-9)
            f_up, f_low = up * (1 - up) * (y < k), low * (1 - low) * (y > 0)
            ds = weight * (f_up - f_low) / p / n          # of minus log-likelihood by s
            dcut = np.zeros((n, k + 2))
            dcut[rows, y + 1] -= weight * f_up / p / n
            dcut[rows, y] += weight * f_low / p / n
            dcut = dcut.sum(0)[1:-1]
            tail = np.cumsum(dcut[::-1])[::-1]
            grad = np.concatenate([np.bincount(flat, ds[doc] * value, len(used)) + DECAY * w,
                                   tail[:1], tail[1:] * np.exp(t[1:])])
            m = 0.9 * m + 0.1 * grad
            v = 0.999 * v + 0.001 * grad * grad
            theta = theta - RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        weights[used] = theta[:len(used)]
        t = theta[len(used):]
        return cls(grades, weights, np.cumsum(np.concatenate([t[:1], np.exp(t[1:])])))


def train(docs: DataFrame, labels: DataFrame, grade_col: str = "toxic", id_col: str = "doc_id",
          text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> OrdinalModel:
    """A model of at most ``sample_rows`` labelled documents."""
    ship(docs.sparkSession)
    picked = (labels.where(F.col(id_col).isNotNull() & F.col(grade_col).isNotNull())
              .groupBy(F.col(id_col).alias("id")).agg(F.max(grade_col).cast("int").alias("grade"))
              .orderBy(F.xxhash64("id"), "id").limit(sample_rows))

    def run(batches):
        for batch in batches:
            found = list(word_features(batch.column(2)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.list_(pa.int32())),
                 pa.array([f[1] for f in found], pa.list_(pa.float32()))], ["id", "grade", "buckets", "value"])

    # the labels are at most sample_rows short rows
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(picked), "id")
    found = (rows.select("id", "grade", "text")
             .mapInArrow(run, "id long, grade int, buckets array<int>, value array<float>")
             .dropDuplicates(["id"]).toArrow().sort_by("id"))
    grades = found.column("grade").to_pylist()
    features = []
    for name in ("buckets", "value"):
        column = found.column(name).combine_chunks()
        features.append(np.split(np.asarray(column.flatten()), np.asarray(column.offsets)[1:-1] - column.offsets[0].as_py())
                        if grades else [])
    return OrdinalModel.fit(list(zip(*features)), grades)


def predict(docs: DataFrame, keep: list[str], model: OrdinalModel, text_col: str = "text") -> DataFrame:
    """``keep``, severity (expected grade) and toxic (nearer the upper half
    of the grades)."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)  # BUCKETS weights
    middle = (model.grades[0] + model.grades[-1]) / 2 if model.grades else 0.5

    def run(batches):
        model = shared.value
        for batch in batches:
            score = np.array([model.score(f) for f in word_features(batch.column(len(keep)))])
            severity = model.severity(score).round(6)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], pa.array(severity, pa.float64()), pa.array(severity > middle)],
                [*keep, "severity", "toxic"])

    schema = docs.select(*keep).schema.add("severity", "double").add("toxic", "boolean")
    return docs.select(*keep, text_col).mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: expected severity of every document."""
    docs = table(spark, sf_dir, "documents")
    return predict(docs, ["doc_id"], train(docs, table(spark, sf_dir, "labels")))
