"""Language identification by mixture inference.

Training counts hashed letter trigrams per language over all training rows
(partial counts per task, summed by Spark; the collected table has at most
BUCKETS rows per language).  A document is a mixture: its trigram counts come
from language proportions that expectation-maximisation estimates, for all
documents of a chunk at once.  The language set is chosen by penalised
likelihood: the k strongest languages are refitted alone, and k is the number
with the best log-likelihood less PENALTY * (k - 1) * log(trigrams).  A
document is done when no larger set can be better: log-likelihood is concave
in the proportions, so its slope at the fit of all languages bounds that of
every set.  The choice depends on the document alone, not on its neighbours.

Defined results: ``und`` with score 0 where the text is null or has no
letter, or nothing was learned; ties go to the language first in order; rows
without a language teach nothing; repeated rows count each; an empty table
teaches nothing and has no rows of its own.  A very long text is fitted whole,
in a chunk of its own.  ``predict`` carries the columns asked for, which must
not be named like its results; the stage keeps all, whatever their names.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lagjoin.llm.pretok import LETTER, classes, code_points
from lagjoin.llm.shared import mixed, ship, table, text_chunks

BUCKETS = 1 << 16
ROUNDS = 12
PENALTY = 2.0
#: Log-likelihood per trigram if all buckets are as likely.
CHANCE = -float(np.log(BUCKETS))
UNKNOWN = "und"
#: Code points of a chunk: fitting holds some twenty numbers for each.
FITTED = 100_000


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every trigram of lower-cased letter runs (one blank around
    each run), and the row it belongs to."""
    lowered = [unicodedata.normalize("NFC", t).lower() for t in texts]
    cp = code_points("\n" + "\n".join(lowered) + "\n")  # the first text has a blank before it like the others
    row = np.concatenate(([0], np.repeat(np.arange(len(texts)), [len(t) + 1 for t in lowered])))
    letter = classes()[cp] == LETTER
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first other character after a run is its blank
    keep[:-1] |= letter[1:] & ~letter[:-1]
    cp, row = np.where(letter, cp, 32)[keep].astype(np.uint64), row[keep]
    if len(cp) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    with np.errstate(over="ignore"):
        key = mixed((cp[:-2] << np.uint64(42)) ^ (cp[1:-1] << np.uint64(21)) ^ cp[2:])
    whole = (cp[1:-1] != 32)  # a letter in the middle
    return (key % np.uint64(BUCKETS)).astype(np.int64)[whole], row[1:-1][whole]


def train(rows: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages and their log-probabilities [bucket, language], from every
    row with a language."""
    ship(rows.sparkSession)

    def run(batches):
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for a, b, texts in text_chunks(batch.column(0), FITTED):
                names, code = np.unique(langs[a:b], return_inverse=True)
                bucket, row = trigrams(texts)
                cell = np.bincount(code[row] * BUCKETS + bucket, minlength=len(names) * BUCKETS)
                for k, name in enumerate(names.tolist()):
                    part = cell[k * BUCKETS:(k + 1) * BUCKETS]
                    counts[name] = counts[name] + part if name in counts else part
        for name, count in counts.items():
            at = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int64()),
                                              pa.array(count[at], pa.int64())], ["lang", "bucket", "n"])

    known = rows.where(F.col(lang_col).isNotNull()).select(text_col, F.col(lang_col).cast("string"))
    sums = (known.mapInArrow(run, "lang string, bucket long, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
            .groupBy("lang").agg(F.collect_list("bucket").alias("b"), F.collect_list("n").alias("n")))
    found = sorted(sums.collect(), key=lambda r: r["lang"])
    count = np.full((BUCKETS, len(found)), 0.1)
    for k, r in enumerate(found):
        count[r["b"], k] += r["n"]
    return [r["lang"] for r in found], np.log(count / count.sum(0, keepdims=True)) if found else count


def _fit(p: np.ndarray, n: np.ndarray, heads: np.ndarray, doc: np.ndarray, mask: np.ndarray):
    """Proportions and log-likelihood per document, languages under ``mask``."""
    pi = mask / mask.sum(1, keepdims=True)
    total = np.add.reduceat(n, heads)[:, None]
    for _ in range(ROUNDS):
        share = p * pi[doc]
        share *= (n / share.sum(1))[:, None]
        pi = np.add.reduceat(share, heads, axis=0) / total
    return pi, np.add.reduceat(n * np.log((p * pi[doc]).sum(1)), heads)


def mixtures(texts: list[str], log_p: np.ndarray) -> np.ndarray:
    """Proportions [text, language] of the selected language sets; rows of
    zeros where a text has no letter."""
    return fitted(texts, log_p)[0]


def fitted(texts: list[str], log_p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The proportions, and the log-likelihood per trigram under them (minus
    infinity where a text has no letter)."""
    n_lang = log_p.shape[1]
    out, fit = np.zeros((len(texts), n_lang)), np.full(len(texts), -np.inf)
    bucket, row = trigrams(texts)
    if not len(bucket) or not n_lang:
        return out, fit
    cells, n = np.unique(row * BUCKETS + bucket, return_counts=True)
    row, bucket, n = cells // BUCKETS, cells % BUCKETS, n.astype(float)
    heads = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
    ids = row[heads]
    doc = np.repeat(np.arange(len(ids)), np.diff(np.append(heads, len(row))))
    logs = log_p[bucket]
    alone = np.add.reduceat(logs * n[:, None], heads, axis=0)
    peak = logs.max(1, keepdims=True)
    p = np.exp(logs - peak)
    lift = np.add.reduceat(n * peak[:, 0], heads)
    total = np.add.reduceat(n, heads)
    size = np.log(total + 1)
    first = alone.argmax(1)
    best = np.zeros((len(ids), n_lang))
    best[np.arange(len(ids)), first] = 1
    best_value = alone.max(1)
    chosen = best_value / total
    full, value = _fit(p, n, heads, doc, np.ones((len(ids), n_lang)))
    slope = np.add.reduceat(p * (n / (p * full[doc]).sum(1))[:, None], heads, axis=0).max(1)
    most = (value + slope - total) * (1 - 1e-9) + 1e-6 + lift
    full[np.arange(len(ids)), first] += 1  # the best single language stays in every set
    rank = np.argsort(np.argsort(-full, 1, kind="stable"), 1)
    for k in range(2, n_lang + 1):
        open_ = most - PENALTY * (k - 1) * size > best_value
        if not open_.any():
            break
        cell = open_[doc]
        at = np.flatnonzero(open_)
        length = np.bincount(doc[cell], minlength=len(ids))[at]
        pi, value = _fit(p[cell], n[cell], np.cumsum(length) - length, np.repeat(np.arange(len(at)), length),
                         (rank[at] < k).astype(float))
        value = value + lift[at]
        per_trigram = value / total[at]
        value = value - PENALTY * (k - 1) * size[at]
        better = value > best_value[at]
        best[at[better]], best_value[at[better]] = pi[better], value[better]
        chosen[at[better]] = per_trigram[better]
    out[ids], fit[ids] = best, chosen
    return out, fit


def predict(df: DataFrame, keep: list[str], model: tuple[list[str], np.ndarray], text_col: str = "text") -> DataFrame:
    """``keep``, lang_pred, score (its proportion), proportions and fit (the
    log-likelihood per trigram)."""
    spark = df.sparkSession
    ship(spark)
    langs = model[0]
    shared = spark.sparkContext.broadcast(model[1].astype(np.float32))

    def run(batches):
        log_p = shared.value.astype(float)
        for batch in batches:
            for a, b, texts in text_chunks(batch.column(len(keep)), FITTED):
                pi, fit = fitted(texts, log_p)
                score = np.clip(pi.max(1), 0, 1) if len(langs) else np.zeros(b - a)
                best = pi.argmax(1) if len(langs) else None
                pred = [langs[best[k]] if score[k] > 0 else UNKNOWN for k in range(b - a)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(a, b - a).columns[:len(keep)], pa.array(pred, pa.string()), pa.array(score),
                     pa.array(pi.round(4).tolist(), pa.list_(pa.float64())), pa.array(fit)],
                    [*keep, "lang_pred", "score", "proportions", "fit"])

    schema = (df.select(*keep).schema.add("lang_pred", "string").add("score", "double")
              .add("proportions", T.ArrayType(T.DoubleType())).add("fit", "double"))
    return df.select(*keep, text_col).mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    """The fold that no model learns from; a null id is in it."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(True))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: the language of every document."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out()))
    out = predict(docs, ["doc_id"], model)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents whose language set explains them, however
    many languages it has; texts without a letter go, and texts whose trigrams
    any bucket at random explains as well as the learned languages do.

    Only the texts pass through Python, so columns of any name are kept as
    they are."""
    langs, log_p = train(docs.where(~held_out()))
    ship(spark)
    shared = spark.sparkContext.broadcast(log_p.astype(np.float32))

    @F.arrow_udf("boolean")
    def explained(column: pa.Array) -> pa.Array:
        p, out = shared.value.astype(float), []
        for a, b, texts in text_chunks(column, FITTED):
            pi, fit = fitted(texts, p)
            out.append((pi.max(1) > 0) & (fit > CHANCE) if len(langs) else np.zeros(b - a, bool))
        return pa.array(np.concatenate(out) if out else np.empty(0, bool))

    return docs.where(explained("text"))
