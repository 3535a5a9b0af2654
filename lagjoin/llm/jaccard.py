"""N-gram Jaccard join with Bayesian candidate pruning.

A text's shingles are its runs of five words (lower-cased; a shorter text
with a word is one shingle).  Texts of equal shingle sets form a class.

1. Every class gets MinHash values; 20 bands of three of them deal it into
   buckets (a pair at 0.8 shares no bucket once in two million).  Buckets
   that hold the same classes as one of an earlier band are dropped.
2. Classes that are connected through buckets of more than ``LARGE`` form a
   home.  Where its buckets together have more pairs than the home itself,
   the home takes their place, so its pairs are met once, not once a band.
3. Buckets and homes are cut into cells of two blocks of bounded rows and
   bytes; no task holds a whole group.  A pair of a bucket belongs to the
   first bucket it shares.  MinHash values are compared a few at a time, and
   a pair is dropped once the posterior probability of reaching the threshold
   (uniform prior) is below TOLERANCE.
4. Pairs that are left are verified on the exact shingle sets, which are made
   again for those classes only; a cell's overlaps are one matrix product of
   its classes and their shared shingles.  Tasks return counts and a spanning
   forest of a cell, never a row per pair.
5. Connected classes get one group id by rounds of star joins, each written.

Defined results: a null or empty text, or one without a word, is a class and
group of its own with no links; a null id counts as larger than any other;
equal rows are copies in one class; an empty table gives no rows.  Copies
count as links of each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagjoin.llm.shared import byte_chunks, byte_words, ship, table, window_hashes, written

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS, HASHES = 20, 3, 64
STEP, TOLERANCE = 16, 1e-6
LARGE = 256
BLOCK, BLOCK_BYTES = 2048, 16 << 20
STRIP, COLUMNS = 256, 2048  # of the pair matrices that a task holds at once
_RNG = np.random.default_rng(7)
_MULTIPLY = (_RNG.integers(0, 1 << 32, HASHES, np.uint64) | np.uint64(1)).astype(np.uint32)
_ADD = _RNG.integers(0, 1 << 32, HASHES, np.uint64).astype(np.uint32)


def shingle_sets(column: pa.Array) -> Iterator[list[np.ndarray]]:
    """Sorted distinct 64-bit shingles of every text, a chunk at a time."""
    for _, _, raw, offsets in byte_chunks(column):
        *_, hashes, by_row = byte_words(raw, offsets)
        yield [np.unique(window_hashes(hashes[lo:hi], min(SHINGLE, hi - lo))) if hi > lo else hashes[:0]
               for lo, hi in zip(by_row[:-1].tolist(), by_row[1:].tolist())]


def set_key(shingles: np.ndarray) -> int:
    """Identity of a shingle set."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values [set, hash] of sets that are not empty."""
    out = np.empty((len(sets), HASHES), np.uint32)
    if sets:
        low = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
        heads = np.cumsum([0, *map(len, sets[:-1])])
        for k in range(HASHES):
            out[:, k] = np.minimum.reduceat(low * _MULTIPLY[k] + _ADD[k], heads)
    return out


def band_hashes(values: np.ndarray) -> np.ndarray:
    """A 64-bit hash [set, band] of each band's number and values."""
    v = values[:, :BANDS * ROWS].reshape(-1, BANDS, ROWS).astype(np.uint64)
    with np.errstate(over="ignore"):
        out = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(v), 1))
        for k in range(ROWS):
            out = (out ^ v[:, :, k]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
    return out.view(np.int64)


def fingerprints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, hash of the text, key (null without a word), number of shingles,
    bands and signature of every row."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            at = 0
            for sets in shingle_sets(batch.column(2)):
                full = [s for s in sets if len(s)]
                values = minhashes(full)
                found = zip(map(set_key, full), band_hashes(values).tolist(),
                            map(bytes, (values & 0xFFFF).astype("<u2")))
                key, bands, sig = zip(*(next(found) if len(s) else (None, None, None) for s in sets))
                ids = batch.slice(at, len(sets))
                at += len(sets)
                yield pa.RecordBatch.from_arrays(
                    [ids.column(0), ids.column(1), pa.array(key, pa.int64()), pa.array(map(len, sets), pa.int64()),
                     pa.array(bands, pa.list_(pa.int64())), pa.array(sig, pa.binary())],
                    ["id", "h", "key", "n", "bands", "sig"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("h"), text_col).mapInArrow(
        run, "id long, h long, key long, n long, bands array<long>, sig binary")


def least_matches(n: int, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> int:
    """Fewest equal values among ``n`` for which the similarity still reaches
    the threshold with posterior probability ``tolerance``."""
    below = 0.0
    for m in range(n + 1):
        below += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        if below >= tolerance:
            return m
    return n


def _groups(batches, n_keys: int):
    """Lists of batches' rows by equal first ``n_keys`` columns; the input is
    sorted by them."""
    rest = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = t if rest is None else pa.concat_tables([rest, t]).combine_chunks()
        keys = np.stack([np.asarray(t.column(i)) for i in range(n_keys)])
        cut = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
        cut = [0, *cut.tolist()]
        for a, b in zip(cut[:-1], cut[1:]):
            yield t.slice(a, b - a)
        rest = t.slice(cut[-1])
    if rest is not None and rest.num_rows:
        yield rest


def _fixed(column, dtype, width) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)


def _mine(i, j, rows: dict):
    """Which pairs belong to the cell: not of one block where there are two,
    and in a bucket not shared earlier nor in one home."""
    ok = i < j
    if rows["b1"] != rows["b2"]:
        ok = ok & (rows["block"][i] != rows["block"][j])
    if not rows["dense"]:
        bands, home = rows["bands"], rows["home"]
        ok = ok & ((home[i] != home[j]) | ~rows["homed"][i])
        for t in range(int((bands[0] == rows["g"]).argmax())):
            ok = ok & (bands[i, t] != bands[j, t])
    return ok


def _likely(rows: dict, steps) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs i < j of a cell that pruning leaves, sorted by i, in pieces."""
    sig, m = rows["sig"], len(rows["sig"])
    for lo in range(0, m, STRIP):
        i = np.arange(lo, min(lo + STRIP, m))[:, None]
        alive = _mine(i, np.arange(m)[None, :], rows)
        matches = None
        for n, least in steps:
            if matches is None or matches.ndim == 2:
                matches = np.zeros(alive.shape, np.uint8) if matches is None else matches
                for c in range(n - STEP, n):
                    matches += sig[i, c] == sig[None, :, c]
                alive &= matches >= least
                if n < HASHES and alive.sum() < alive.size / 8:  # few are left: go on with a list of them
                    a, b = np.nonzero(alive)
                    matches, a = matches[a, b].astype(np.int64), a + lo
            else:
                matches += (sig[a, n - STEP:n] == sig[b, n - STEP:n]).sum(1)
                going = matches >= least
                a, b, matches = a[going], b[going], matches[going]
        if matches.ndim == 2:
            a, b = np.nonzero(alive)
            a = a + lo
        if len(a):
            yield a, b


def _cells(batches) -> Iterator[tuple[dict, pa.Table]]:
    """Cells of more than one class, as arrays."""
    for g in _groups(batches, 4):
        m = g.num_rows
        if m > 1:
            dense, name, b1, b2 = (g.column(k)[0].as_py() for k in range(4))
            home = g.column(6).combine_chunks()
            yield {"dense": dense, "g": name, "b1": b1, "b2": b2, "block": np.asarray(g.column(4)),
                   "home": np.asarray(home.fill_null(0)), "homed": np.asarray(home.is_valid()),
                   "bands": np.asarray(g.column(7).combine_chunks().flatten()).reshape(m, BANDS),
                   "sig": _fixed(g.column(8), "<u2", HASHES)}, g


CELL = "dense int, g long, b1 int, b2 int, block int, key long, home long, bands array<long>, sig binary"


def _steps(threshold: float) -> list[tuple[int, int]]:
    return [(n, least_matches(n, threshold)) for n in range(STEP, HASHES + 1, STEP)]


def _blocks(rows: str, n_shingles: str):
    return F.ceil(F.greatest(F.col(rows) / BLOCK, F.col(n_shingles) * 8 / BLOCK_BYTES)).cast("int")


def candidate_cells(classes: DataFrame) -> DataFrame:
    """The classes (key, n, bands, sig) in the cells of buckets and homes."""
    narrow = classes.select("key", "n", F.posexplode("bands").alias("band", "g"))
    sizes = (narrow.groupBy("g").agg(
        F.count("*").alias("size"), F.sum("n").alias("total"), F.min("key").alias("least"), F.max("key").alias("most"),
        F.bit_xor(F.xxhash64("key")).alias("mix"), F.min("band").alias("band")).where("size > 1"))
    # of buckets with the same classes the one of the first band has all first meetings
    kept = (sizes.groupBy("size", "least", "most", "mix")
            .agg(F.min(F.struct("band", "g")).alias("b"), F.first("total").alias("total"))
            .select(F.col("b.g").alias("g"), "size", "total", "least"))
    live = written(narrow.select("key", "n", "g").join(kept, "g"), "buckets")
    big = live.where(F.col("size") > LARGE)
    roots = written(components(big.select(F.col("key").alias("a"), F.col("least").alias("b"))), "homes")
    pairs = (big.select("g", "size", "least").distinct().join(roots, F.col("least") == F.col("node"))
             .groupBy("root").agg(F.sum(F.col("size") * F.col("size")).alias("in_buckets")))
    worth = (classes.select(F.col("key").alias("node"), "n").join(roots, "node").groupBy("root")
             .agg(F.count("*").alias("size"), F.sum("n").alias("total")).join(pairs, "root")
             .where("size * size <= in_buckets").select("root", _blocks("size", "total").alias("blocks")))
    homes = written(roots.join(worth, "root").select(F.col("node").alias("key"), F.col("root").alias("home"), "blocks"),
                    "homes")
    # a large bucket lies in one home: if the home is taken, the bucket isn't
    buckets = (live.join(homes.select("key", "home"), "key", "left")
               .where(F.col("home").isNull() | (F.col("size") <= LARGE))
               .select(F.lit(0).alias("dense"), "g", "key", "home", _blocks("size", "total").alias("blocks")))
    rows = buckets.unionByName(homes.select(F.lit(1).alias("dense"), F.col("home").alias("g"), "key", "home", "blocks"))
    return (rows.withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .join(classes.select("key", "bands", "sig"), "key")
            .select("dense", "g", F.least("block", "other").alias("b1"), F.greatest("block", "other").alias("b2"),
                    "block", "key", "home", "bands", "sig"))


def _dealt(cells: DataFrame) -> DataFrame:
    by = ["dense", "g", "b1", "b2"]
    return cells.repartition(*by).sortWithinPartitions(*by)


def pruned(cells: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The cells less the classes that pruning leaves no partner; homes are
    mostly links and go on whole, to be pruned where they are verified."""
    steps = _steps(threshold)

    def run(batches):
        out, size = [], 0
        for rows, g in _cells(batches):
            left = [k for pair in _likely(rows, steps) for k in pair]
            if left:
                out.append(g.take(pa.array(np.unique(np.concatenate(left)))))
                size += out[-1].num_rows
            if size > 2000:
                yield from pa.concat_tables(out).combine_chunks().to_batches()
                out, size = [], 0
        if out:
            yield from pa.concat_tables(out).combine_chunks().to_batches()

    return _dealt(cells.where("dense = 0")).mapInArrow(run, CELL).unionByName(cells.where("dense = 1"))


#: Classes whose keys (24 bytes each) are sent to all tasks; more are joined by a shuffle.
MAX_WANTED = 2_000_000


def _sets_of(docs: DataFrame, id_col: str, text_col: str, wanted: DataFrame) -> DataFrame:
    """key and shingle set of the wanted classes (key, id, h), from the texts
    of their representatives."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("h"),
                        F.col(text_col).alias("text"))
    # a class is wanted if it may have a partner: its 64-bit keys are sent to
    # the texts while they are few, else texts and keys meet by a shuffle
    few = wanted.count() <= MAX_WANTED
    wanted = F.broadcast(wanted) if few else wanted
    picked = texts.alias("d").join(wanted.alias("w"), (F.col("d.h") == F.col("w.h")) & F.col("d.id").eqNullSafe(
        F.col("w.id"))).select("w.key", "d.text")

    def run(batches):
        for batch in batches:
            key, kept = batch.column(0).to_pylist(), []
            for s in (s for sets in shingle_sets(batch.column(1)) for s in sets):
                kept.append(s.tobytes() if len(s) and set_key(s) == key[len(kept)] else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary())], ["key", "shingles"])

    return picked.mapInArrow(run, "key long, shingles binary").where("shingles is not null").dropDuplicates(["key"])


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Size of the intersection of every set of ``left`` with every one of
    ``right``: a matrix product over the shingles that both sides have."""
    flat = [np.concatenate(side) for side in (left, right)]
    shared = np.intersect1d(*flat)
    place = []
    for side, values in zip((left, right), flat):
        row = np.repeat(np.arange(len(side)), [len(s) for s in side])
        at = np.minimum(np.searchsorted(shared, values), max(len(shared) - 1, 0))
        has = shared[at] == values if len(shared) else np.zeros(len(values), bool)
        order = np.argsort(at[has], kind="stable")
        place.append((row[has][order], at[has][order]))
    out = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, len(shared), COLUMNS):
        parts = []
        for side, (row, at) in zip((left, right), place):
            a, b = np.searchsorted(at, (lo, lo + COLUMNS))
            part = np.zeros((len(side), min(COLUMNS, len(shared) - lo)), np.float32)
            part[row[a:b], at[a:b] - lo] = 1
            parts.append(part)
        out += parts[0] @ parts[1].T
    return out


def _links(rows: dict, shingles: list[np.ndarray], copies: np.ndarray, steps, threshold: float):
    """Links (in documents) and root of every class of a cell."""
    m = len(shingles)
    links, root = np.zeros(m), np.arange(m)
    size = np.array([len(s) for s in shingles])
    for i, j in _likely(rows, steps):
        near = np.minimum(size[i], size[j]) >= threshold * np.maximum(size[i], size[j]) - 1e-9
        i, j = i[near], j[near]
        left, right = np.unique(i), np.unique(j)
        if not len(left):
            continue
        both = overlaps([shingles[k] for k in left], [shingles[k] for k in right])
        common = both[np.searchsorted(left, i), np.searchsorted(right, j)].astype(float)
        linked = common >= threshold * (size[i] + size[j] - common) - 1e-9
        i, j = i[linked], j[linked]
        links += np.bincount(i, copies[j], m) + np.bincount(j, copies[i], m)
        heads = np.flatnonzero(np.diff(i, prepend=-1))
        for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(i)]):
            met = np.append(root[j[a:b]], root[i[a]])
            least = met.min()
            if (met != least).any():
                root[np.isin(root, met)] = least
    return links, root


def verified(cells: DataFrame, sets: DataFrame, sizes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """key, n_links (in documents) and root, a row per cell and class with a
    verified link."""
    steps = _steps(threshold)

    def run(batches):
        for rows, g in _cells(batches):
            shingles = [np.frombuffer(s, np.uint64) for s in g.column(9).to_pylist()]
            links, root = _links(rows, shingles, np.asarray(g.column(10)).astype(float), steps, threshold)
            at, key = np.flatnonzero(links), np.asarray(g.column(5))
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(key[at]), pa.array(links[at].astype(np.int64)),
                                                  pa.array(key[root[at]])], ["key", "n_links", "root"])

    return _dealt(cells.join(sets, "key").join(sizes, "key").select(
        "dense", "g", "b1", "b2", "block", "key", "home", "bands", "sig", "shingles", "copies")).mapInArrow(
        run, "key long, n_links long, root long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the undirected edges (a, b), the root
    being the least node it is connected with.  Alternating large and small
    stars; each round is written, and ends when nothing changes."""
    pairs = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .distinct(), "edges")

    def checksum(df):
        r = df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        return tuple(r)

    before = checksum(pairs)
    while before[0]:
        sym = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = sym.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # large star: every larger neighbour moves to the least one
        large = (sym.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.where("m < a").select("a", F.col("m").alias("b"))).distinct())
        large = written(large, "large-star")
        # small star: a node and its smaller neighbours move to the least one
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        pairs = written(small, "small-star")
        now = checksum(pairs)
        if now == before:
            break
        before = now
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: id, key, class_id (the least id of its class),
    n_copies, n_links (documents at or over the threshold, copies included)
    and group_key (equal for connected documents)."""
    prints = written(fingerprints(docs, id_col, text_col), "fingerprints")
    # rows of one key carry equal numbers, bands and signatures
    classes = written(prints.where("key is not null").groupBy("key").agg(
        F.count("*").alias("copies"), F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h")).alias("rep"),
        *(F.first(c).alias(c) for c in ("n", "bands", "sig"))), "classes")
    sizes = classes.select("key", "copies", "rep.id", "rep.h")
    cells = written(pruned(written(candidate_cells(classes), "cells"), threshold), "pruned")
    wanted = written(cells.select("key").distinct().join(sizes.drop("copies"), "key"), "wanted")
    sets = written(_sets_of(docs, id_col, text_col, wanted), "sets")
    links = written(verified(cells, sets, sizes.select("key", "copies"), threshold), "links")
    roots = written(components(links.select(F.col("key").alias("a"), F.col("root").alias("b"))), "roots")
    per_class = (sizes.join(links.groupBy("key").agg(F.sum("n_links").alias("n")), "key", "left")
                 .join(roots.withColumnRenamed("node", "key"), "key", "left")
                 .select("key", "copies", F.col("id").alias("rep"), F.coalesce("n", F.lit(0).cast("long")).alias("n"),
                         F.coalesce("root", "key").alias("group_key")))
    none = F.lit(0).cast("long")
    return prints.select("id", "key").join(per_class, "key", "left").select(
        F.col("id").alias(id_col), "key", F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("rep")).alias("class_id"),
        F.coalesce("copies", F.lit(1).cast("long")).alias("n_copies"),
        F.coalesce(F.col("n") + F.col("copies") - 1, none).alias("n_links"), "group_key")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: class, links and group of every document."""
    found = written(join(table(spark, sf_dir, "documents")), "joined")
    # a class without others is its own group, so only groups of several
    # classes are looked up: sent to all tasks while they are few, as one
    # group may hold a large part of the rows
    groups = written(found.where("key is not null").groupBy("group_key").agg(
        F.min("doc_id").alias("group_id"), F.min("key").alias("least"), F.max("key").alias("most"))
        .where("least < most").select("group_key", "group_id"), "groups")
    groups = F.broadcast(groups) if groups.count() <= MAX_WANTED else groups
    return found.join(groups, "group_key", "left").select(
        "doc_id", "class_id", "n_copies", "n_links", F.coalesce("group_id", "class_id").alias("group_id"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the document of the least id of each group stays, one
    row if several share it; documents without a word all stay."""
    # a row id of its own, fixed by writing: ids may be null or repeated
    row = "__row"
    while row in docs.columns:
        row += "_"
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    found = join(rows, row, "text").where("group_key is not null").select(row, "group_key")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", row)
    kept = (rows.select("doc_id", row).join(found, row).groupBy("group_key")
            .agg(F.min(order).alias("first")).select(F.col(f"first.{row}").alias(row)))
    wordless = join_free(rows, row)
    return rows.join(kept.unionByName(wordless), row, "left_semi").select(*docs.columns)


def join_free(rows: DataFrame, row: str = "__row") -> DataFrame:
    """Row ids of the documents without a word."""
    has_word = F.col("text").rlike("[0-9A-Za-z]|[^\\x00-\\x7F]")
    return rows.where(~F.coalesce(has_word, F.lit(False))).select(row)
