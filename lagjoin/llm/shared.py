"""Helpers shared by the operators of this subpackage.

Three concerns live here: shipping the package to executors, the shared
folder for written intermediate tables, and turning an Arrow column of texts
into bounded chunks of bytes or code points that numpy can work on.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Texts are worked on in chunks of about this many bytes or code points, so
#: a task's numpy buffers stay bounded whatever the Arrow batch holds (one
#: longer text makes a chunk of its own).
CHUNK = 500_000

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once per application, so Python
    workers import it wherever they run."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    target = os.path.join(tempfile.mkdtemp(prefix="lagjoin-ship-"), "lagjoin_package.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, else the
    context's checkpoint folder, else (tests) a scratch folder that is then
    set as the checkpoint folder."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not path:
        path = sc.getCheckpointDir()
    if not path:
        path = "file://" + tempfile.mkdtemp(prefix="lagjoin-shared-", dir="/tmp")
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/lagjoin/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, reread: this cuts its lineage,
    and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table of the data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(column: pa.Array) -> pa.Array:
    """The column as large strings, null as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_string()).fill_null("")


def byte_chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows of a text column in chunks of about ``limit`` bytes: first row,
    row past the last, their UTF-8 bytes, and the rows' offsets in them."""
    arr = texts_of(column)
    n = len(arr)
    if n == 0:
        return
    _, offsets, data = arr.buffers()
    off = np.frombuffer(offsets, np.int64)[arr.offset:arr.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    for a, b in cuts(off, limit):
        yield a, b, raw[off[a]:off[b]], off[a:b + 1] - off[a]


def cuts(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges whose items total about ``limit``, one row at least."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1
        b = min(n, max(a + 1, b))
        yield a, b
        a = b


def text_groups(texts: list[str], limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of a list of texts that total about ``limit`` code points."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    yield from cuts(np.concatenate(([0], np.cumsum(lengths))), limit)


def text_chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, list[str]]]:
    """Rows of a text column in chunks of about ``limit`` code points: first
    row, row past the last, and their texts.  Only one chunk's texts are made
    at a time, whatever the Arrow batch holds."""
    arr = texts_of(column)
    ends = np.cumsum(np.asarray(pc.utf8_length(arr)), dtype=np.int64)
    for a, b in cuts(np.concatenate(([0], ends)), limit):
        yield a, b, arr.slice(a, b - a).to_pylist()


def powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64, by doubling."""
    out = np.ones(max(n, 1), np.uint64)
    size, step = 1, np.uint64(base)
    while size < n:
        m = min(size, n - size)
        out[size:size + m] = out[:m] * step
        size += m
        step = step * step
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads every input bit over the whole word."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


#: Odd multipliers of the polynomial span hash and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLES: dict[str, np.ndarray] = {}


def _table(name: str, base: int, n: int) -> np.ndarray:
    have = _TABLES.get(name)
    if have is None or len(have) < n:
        made = powers(base, max(n, CHUNK + 1))
        if len(made) > 4 * CHUNK:
            return made
        _TABLES[name] = have = made
    return have


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of ``values``, equal for equal spans."""
    if len(starts) == 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        prefix = np.zeros(len(values) + 1, np.uint64)
        terms = (values.astype(np.uint64) + np.uint64(1)) * _table("base", _BASE, len(values) + 1)[:len(values)]
        np.cumsum(terms, out=prefix[1:])
        inverse = _table("inverse", _INVERSE, len(values) + 1)
        return mixed((prefix[ends] - prefix[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


#: Fixed classes of the word rule [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z
#: are lower-cased: digits, a-z and every byte of a non-ASCII character.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
IS_WORD = np.zeros(256, bool)
IS_WORD[ord("0"):ord("9") + 1] = True
IS_WORD[ord("a"):ord("z") + 1] = True
IS_WORD[128:] = True


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of ``mask`` within each row: starts, ends, and the
    runs' offsets by row."""
    n = len(mask)
    if n == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    begin = mask.copy()
    begin[1:] &= ~mask[:-1]
    heads = offsets[:-1][offsets[:-1] < n]
    begin[heads] = mask[heads]
    stop = mask.copy()
    stop[:-1] &= ~mask[1:]
    tails = offsets[1:][offsets[1:] > 0] - 1
    stop[tails] = mask[tails]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(stop) + 1, np.searchsorted(starts, offsets)


def byte_words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of each row by the rule above: lowered bytes, starts, ends,
    hashes, and the words' offsets by row."""
    low = LOWER[raw]
    starts, ends, by_row = runs(IS_WORD[low], offsets)
    return low, starts, ends, span_hashes(low, starts, ends), by_row


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``words[i:i+size]`` for every i with a whole window."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.zeros(n, np.uint64)
        for j in range(size):
            total *= np.uint64(0xD1342543DE82EF95)
            total += words[j:j + n]
        return mixed(total)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start+1, ... for each (start, length), one after another."""
    total = int(lengths.sum())
    out_at = np.cumsum(lengths) - lengths
    return np.repeat(starts - out_at, lengths) + np.arange(total, dtype=np.int64)
