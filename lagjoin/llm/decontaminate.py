"""Benchmark decontamination by hashed word windows.

Items become windows of ``size`` consecutive words (a shorter item is one
window).  The windows are hashed; documents are scanned once, all windows of
a chunk hashed with array operations, and every hash hit is verified against
the window's words.  Verified occurrences mark words; a document is
contaminated when a twentieth of its words or more are marked.

The window table is broadcast only when its measured rows and bytes are under
``MAX_ROWS`` and ``MAX_BYTES``; otherwise document windows meet it in a
shuffle join.  Both ways give the same rows.

Defined results: a null or empty text, or one without a word, has no words,
no hits and is clean; a null item id counts as no item but its windows hit;
repeated documents are judged each; an empty benchmark hits nothing.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagjoin.llm.shared import byte_chunks, byte_words, ship, table, window_hashes, written

SIZE = 13
MAX_ROWS, MAX_BYTES = 1_000_000, 64 << 20
SHARE = 20  # contaminated: SHARE * n_hit >= n_words


def _key(hashes: np.ndarray, size: int) -> np.ndarray:
    return (hashes + np.uint64(size)).view(np.int64)


def benchmark_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                      size: int = SIZE) -> DataFrame:
    """Distinct (key, n, words, item): hash, word count and lowered words of
    every window of every item."""
    ship(items.sparkSession)

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for a, b, raw, offsets in byte_chunks(batch.column(1)):
                low, starts, ends, hashes, by_row = byte_words(raw, offsets)
                rows = []
                for k in range(b - a):
                    lo, hi = by_row[k], by_row[k + 1]
                    n = min(size, hi - lo)
                    if n == 0:
                        continue
                    words = [low[s:e].tobytes() for s, e in zip(starts[lo:hi], ends[lo:hi])]
                    keys = _key(window_hashes(hashes[lo:hi], n), n).tolist()
                    rows += [(key, int(n), b" ".join(words[p:p + n]), ids[a + k]) for p, key in enumerate(keys)]
                cols = list(zip(*rows)) or [(), (), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()),
                     pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.string())], ["key", "n", "words", "item"])

    return (items.select(F.col(id_col).cast("string"), text_col)
            .mapInArrow(run, "key long, n int, words binary, item string").distinct())


class _Windows:
    """The broadcast table, ready for scanning."""

    def __init__(self, rows: list[tuple]):
        self.sizes = sorted({n for _, n, _, _ in rows})
        self.words: dict[int, dict[bytes, list]] = defaultdict(dict)
        for key, _, words, item in rows:
            self.words[key].setdefault(words, []).append(item)
        self.keys = np.array(sorted(self.words), np.int64)


def _hits(windows: _Windows, hashes, by_row, row_of):
    """(word, size, key) of every window start whose hash is in the table."""
    for n in windows.sizes:
        keys = _key(window_hashes(hashes, n), n)
        if not len(keys) or not len(windows.keys):
            continue
        at = np.minimum(np.searchsorted(windows.keys, keys), len(windows.keys) - 1)
        for p in np.flatnonzero((windows.keys[at] == keys) & (row_of[:len(keys)] == row_of[n - 1:])).tolist():
            yield p, n, int(keys[p])


RESULT = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def _digest(items) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def _scan_broadcast(docs: DataFrame, keep: list[str], text_col: str, rows: list[tuple]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(rows)
    made: dict[int, _Windows] = {}
    n_keep = len(keep)

    def run(batches):
        if 0 not in made:
            made[0] = _Windows(shared.value)
        windows = made[0]
        for batch in batches:
            for a, b, raw, offsets in byte_chunks(batch.column(n_keep)):
                low, starts, ends, hashes, by_row = byte_words(raw, offsets)
                row_of = np.repeat(np.arange(b - a), np.diff(by_row))
                edge = np.zeros(len(hashes) + 1, np.int64)
                items = defaultdict(set)
                for p, n, key in _hits(windows, hashes, by_row, row_of):
                    words = b" ".join(low[s:e].tobytes() for s, e in zip(starts[p:p + n], ends[p:p + n]))
                    if (found := windows.words[key].get(words)) is not None:
                        edge[p] += 1
                        edge[p + n] -= 1
                        items[int(row_of[p])].update(i for i in found if i is not None)
                n_hit = np.bincount(row_of[np.cumsum(edge[:-1]) > 0], minlength=b - a)
                n_words = np.diff(by_row)
                yield pa.RecordBatch.from_arrays([
                    *batch.slice(a, b - a).columns[:n_keep], pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                    pa.array([len(items[k]) if k in items else 0 for k in range(b - a)], pa.int64()),
                    pa.array([_digest(items.get(k, ())) for k in range(b - a)]),
                    pa.array((n_hit > 0) & (SHARE * n_hit >= n_words))],
                    [*keep, "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    schema = docs.select(*keep).schema
    for field in RESULT.split(", "):
        schema = schema.add(*field.split(" "))
    return docs.select(*keep, text_col).mapInArrow(run, schema)


def _scan_join(docs: DataFrame, keep: list[str], text_col: str, windows: DataFrame) -> DataFrame:
    """The same through a join on the hash, for window tables of any size."""
    rows = written(docs.select(*keep, F.col(text_col).alias("__text"))
                   .withColumn("__row", F.monotonically_increasing_id()), "documents")
    sizes = [r["n"] for r in windows.select("n").distinct().collect()]  # at most ``size`` numbers

    def run(batches):
        for batch in batches:
            for a, b, raw, offsets in byte_chunks(batch.column(1)):
                low, starts, ends, hashes, by_row = byte_words(raw, offsets)
                row_of = np.repeat(np.arange(b - a), np.diff(by_row))
                ids = np.asarray(batch.column(0))[a:b]
                # a row without size and key carries the word count
                yield _window_batch(ids, np.diff(by_row), np.zeros(b - a, np.int64), [None] * (b - a), [None] * (b - a))
                for n in sizes:
                    keys = _key(window_hashes(hashes, n), n)
                    whole = np.flatnonzero(row_of[:len(keys)] == row_of[n - 1:]) if len(keys) else np.empty(0, int)
                    for lo in range(0, len(whole), 50_000):
                        p = whole[lo:lo + 50_000]
                        words = [b" ".join(low[s:e].tobytes() for s, e in zip(starts[i:i + n], ends[i:i + n])) for i in p]
                        yield _window_batch(ids[row_of[p]], p - by_row[row_of[p]], np.full(len(p), n), keys[p], words)

    found = written(rows.select("__row", "__text").mapInArrow(
        run, "__row long, at long, n int, key long, words binary"), "windows")
    counts = found.where("key is null").select("__row", F.col("at").alias("n_words"))
    hits = written(found.where("key is not null").join(windows.drop("n"), ["key", "words"])
                   .select("__row", "at", "n", "item"), "hits")
    marked = (hits.select("__row", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("n") - 1)).alias("w"))
              .distinct().groupBy("__row").agg(F.count("*").alias("n_hit")))
    items = (hits.where("item is not null").select("__row", "item").distinct().groupBy("__row")
             .agg(F.count("*").alias("n_items"), F.array_join(F.sort_array(F.collect_list("item")), ",").alias("__items")))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return (rows.drop("__text").join(counts, "__row", "left").join(marked, "__row", "left").join(items, "__row", "left")
            .select(*keep, "n_words", n_hit.alias("n_hit"),
                    F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
                    F.sha2(F.coalesce("__items", F.lit("")), 256).alias("items_sha256"),
                    ((n_hit > 0) & (SHARE * n_hit >= F.col("n_words"))).alias("contaminated")))


def _window_batch(ids, at, n, keys, words) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array(ids, pa.int64()), pa.array(at, pa.int64()), pa.array(n, pa.int32()), pa.array(keys, pa.int64()),
        pa.array(words, pa.binary())], ["__row", "at", "n", "key", "words"])


def contamination(docs: DataFrame, items: DataFrame, keep: list[str], text_col: str = "text",
                  max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """``keep`` and n_words, n_hit, n_items, items_sha256, contaminated."""
    windows = written(benchmark_windows(items), "benchmark-windows")
    size = windows.agg(F.count("*"), F.sum(F.octet_length("words") + F.coalesce(F.length("item"), F.lit(0)))).first()
    ship(docs.sparkSession)
    if size[0] <= max_rows and (size[1] or 0) <= max_bytes:
        return _scan_broadcast(docs, keep, text_col, [tuple(r) for r in windows.collect()])
    return _scan_join(docs, keep, text_col, windows)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: contamination of every document."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that are not contaminated.  The columns are
    numbered meanwhile, so none clashes with a name of the result."""
    own = [f"c{k}" for k in range(len(docs.columns))]
    judged = contamination(docs.toDF(*own), table(spark, sf_dir, "benchmark"), own, own[docs.columns.index("text")])
    return judged.where(~F.col("contaminated")).select(*own).toDF(*docs.columns)
