"""Alignment of two tokenizers on the same texts.

Tokenizer A is a byte-level BPE file, B a piece model with byte fallback; both
spell the text with one blank before it.  A token is a range of those bytes,
and the offsets where tokens of both end cut the text into groups.

*Galloping intersection.*  The ends of a document's tokens are two rising
lists.  The shorter one drives: each of its ends is sought in the longer list
by doubling steps from a place known to lie before it, then by halving within
the last step.  Every 256th end gallops from the document's begin, every 16th
from the 256th before it, the others from the 16th before them, so all ends of
a level, of all documents of a chunk, move at once in arrays.  Common indices
slice the groups, and differences of their ranks are the groups' token counts.

*Links.*  A group links each of its A tokens to each of its B tokens.  Links
are kept per document as distinct id pairs with their numbers.  The corpus
counts (documents that hold a pair) are added up within tasks before they are
shuffled.  The most frequent pairs, at most ``hot_pairs`` of them by count,
are sent to all tasks; no other pair is held by more documents than those, so
the rest is joined by a shuffle without a heavy key.  Both ways always run.

Groups of many tokens (texts in which the tokenizers never meet) are reduced
to their distinct ids before they are multiplied, in slices, so memory stays
bounded however long a group is.

Defined results: texts that are null or empty, or that either tokenizer does
not spell byte by byte (U+2581 is a blank to B), have no tokens: all counts 0,
``groups`` ''.  Strings of special tokens are plain text.  Repeated rows are
documents of their own, each counted; null ids stay null; a table without rows
gives none.  Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lagjoin.llm.bpe import byte_symbols, tokenizer_path
from lagjoin.llm.pretok import code_points, split_keeping_space
from lagjoin.llm.shared import new_path, ranges, ship, table, text_groups, texts_of, written
from lagjoin.llm.words import LONG_WORD, HashedWords, piece_encoder

#: Code points aligned at once.
CHUNK = 500_000
#: Links multiplied out at once, and the group size from which ids are first made distinct.
LINKS, LARGE_GROUP = 1_000_000, 4_096
#: Distinct pairs whose document counts a task holds before it hands them on.
HELD_PAIRS = 1_000_000
#: Pairs sent to every task: this many at most.
HOT_PAIRS = 1 << 20
_STRIDES = (256, 16, 1)


class Coder:
    """Ids and byte lengths of both tokenizers' tokens for chunks of texts."""

    def __init__(self, path_a: str, path_b: str):
        symbols = {s: b for b, s in enumerate(byte_symbols())}
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        added = {t["content"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(symbols[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in added}
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for raw, i in ranks.items():
            self.a_bytes[i] = raw
        self.piece = piece_encoder(ranks)
        self.library = Tokenizer.from_file(path_a)
        self.library.encode_special_tokens = True
        self.model = sentencepiece.SentencePieceProcessor(model_file=path_b)
        model, self.b_bytes = self.model, []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:-1], 16)]) if model.is_byte(i)
                                else piece.replace("▁", " ").encode())
        self.blank = model.piece_to_id("▁")
        self.a_len = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_len = np.array([len(t) for t in self.b_bytes], np.int64)
        self.a_words, self.b_words = HashedWords(self._encode_a), HashedWords(self._encode_b)

    def _spelt(self, words: list[bytes], lists: list[list[int]], tokens: list[bytes]) -> np.ndarray:
        return np.fromiter((b"".join([tokens[i] for i in ids]) == w for w, ids in zip(words, lists)), bool, len(words))

    def _encode_a(self, words: list[str]) -> tuple[list[list[int]], np.ndarray]:
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        ids = [self.piece(w) if len(w) <= LONG_WORD else self.library.encode(t, add_special_tokens=False).ids
               for w, t in zip(raw, words)]
        return ids, self._spelt(raw, ids, self.a_bytes)

    def _encode_b(self, words: list[str]) -> tuple[list[list[int]], np.ndarray]:
        """Words begin with blanks, of which the model adds one, or with line
        feeds, which no piece holds and before which it puts a blank."""
        ids = self.model.encode([w[1:] if w[0] == " " else w for w in words], num_threads=1)
        ids = [([self.blank] if w == " " else i) if w[0] == " " else i[1:] for w, i in zip(words, ids)]
        return ids, self._spelt([w.encode("utf-8", "surrogatepass") for w in words], ids, self.b_bytes)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A with the documents' offsets in them, and those of B; a
        document that has no tokens by definition is empty in both."""
        joined = "".join([" " + t for t in texts])
        offsets = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)))
        cp = code_points(joined)
        good = offsets[1:] - offsets[:-1] > 1
        parts = []
        for words, (starts, ends) in ((self.a_words, split_keeping_space(cp, offsets)),
                                      (self.b_words, _split_at_blanks(cp, offsets))):
            slots = words.lookup(joined, cp, starts, ends)
            ids, lengths = words.gather(slots)
            by_doc = np.searchsorted(starts, offsets)
            good[np.searchsorted(by_doc, np.flatnonzero(~words.spelt[slots]), "right") - 1] = False
            parts.append((ids, np.concatenate(([0], np.cumsum(lengths)))[by_doc]))
        out = []
        for ids, at in parts:
            n = np.where(good, at[1:] - at[:-1], 0)
            out += [ids if good.all() else ids[ranges(at[:-1], n)], np.concatenate(([0], np.cumsum(n)))]
        return tuple(out)


def _split_at_blanks(cp: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words that begin with a run of blanks or of line feeds: no piece of the
    model holds a blank after another character, nor any line feed."""
    blank, feed = cp == 0x20, cp == 0x0A
    begins = blank | feed
    begins[1:] &= ~(blank[1:] & blank[:-1] | feed[1:] & feed[:-1])
    begins[offsets[:-1]] = True
    starts = np.flatnonzero(begins)
    return starts, np.append(starts[1:], len(cp))


def _gallop(values: np.ndarray, sought: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """First place from ``start`` on, before ``stop``, whose value is not less
    than the sought one: doubling steps, then halving."""
    lo, hi = start.copy(), start.copy()
    live, step = np.arange(len(sought)), 1
    while len(live):
        at = hi[live]
        less = at < stop[live]
        less[less] = values[at[less]] < sought[live[less]]
        live = live[less]
        lo[live] = hi[live] + 1
        hi[live] = np.minimum(hi[live] + step, stop[live])
        step *= 2
    live = np.flatnonzero(lo < hi)
    while len(live):
        mid = (lo[live] + hi[live]) >> 1
        less = values[mid] < sought[live]
        lo[live[less]] = mid[less] + 1
        hi[live[~less]] = mid[~less]
        live = live[lo[live] < hi[live]]
    return lo


def common_ends(ends_a: np.ndarray, at_a: np.ndarray, ends_b: np.ndarray, at_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices into both lists of the ends they share, document by document
    (``at_a``, ``at_b``: the documents' offsets in the lists)."""
    both = np.concatenate([ends_a, ends_b])
    n_a, n_b = np.diff(at_a), np.diff(at_b)
    b_begin = at_b[:-1] + len(ends_a)
    a_drives = n_a <= n_b
    n = np.where(a_drives, n_a, n_b)
    first = np.cumsum(n) - n
    driver = ranges(np.where(a_drives, at_a[:-1], b_begin), n)
    sought = both[driver]
    begin = np.repeat(np.where(a_drives, b_begin, at_a[:-1]), n)
    stop = np.repeat(np.where(a_drives, b_begin + n_b, at_a[1:]), n)
    rank = ranges(np.zeros_like(n), n)
    place = begin.copy()
    wider = 0
    for stride in _STRIDES:
        now = rank % stride == 0
        if wider:
            now &= rank % wider != 0
        now = np.flatnonzero(now)
        start = place[now - rank[now] % wider] if wider else begin[now]
        place[now] = _gallop(both, sought[now], start, stop[now])
        wider = stride
    shared = np.flatnonzero(place < stop)
    shared = shared[both[place[shared]] == sought[shared]]
    from_a = np.repeat(a_drives, n)[shared]
    one, other = driver[shared], place[shared]
    return np.where(from_a, one, other), np.where(from_a, other, one) - len(ends_a)


def _distinct(keys: np.ndarray, numbers: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with the sum of their numbers (1 each)."""
    if numbers is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys, kind="stable")
    keys, numbers = keys[order], numbers[order]
    heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    return keys[heads], np.add.reduceat(numbers, heads) if len(heads) else numbers


def link_pairs(ids_a: np.ndarray, ids_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, doc: np.ndarray,
               size_b: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys (document * span + a * size_b + b) of all linked id pairs, and
    how many links each has.  Groups hold ``n_a`` and ``n_b`` tokens."""
    at_a, at_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    links = n_a * n_b
    keys, numbers = [], []
    small = np.flatnonzero(links <= LARGE_GROUP)
    per_slice = np.concatenate(([0], np.cumsum(links[small])))
    cuts = np.searchsorted(per_slice, np.arange(LINKS, per_slice[-1] + LINKS, LINKS), "right") - 1
    lo = 0
    for hi in [*np.unique(cuts).tolist(), len(small)]:
        g = small[lo:hi]
        lo = hi
        if len(g) == 0:
            continue
        a = ranges(at_a[g], n_a[g])                       # the A tokens of these groups
        width = np.repeat(n_b[g], n_a[g])
        b = ranges(np.repeat(at_b[g], n_a[g]), width)     # each with all B tokens of its group
        key = np.repeat(np.repeat(doc[g], n_a[g]) * span + ids_a[a].astype(np.int64) * size_b, width) + ids_b[b]
        k, n = _distinct(key)
        keys.append(k)
        numbers.append(n)
    for g in np.flatnonzero(links > LARGE_GROUP).tolist():
        a, times_a = np.unique(ids_a[at_a[g]:at_a[g] + n_a[g]].astype(np.int64), return_counts=True)
        b, times_b = np.unique(ids_b[at_b[g]:at_b[g] + n_b[g]].astype(np.int64), return_counts=True)
        rows = max(1, LINKS // len(b))
        for k in range(0, len(a), rows):
            keys.append((doc[g] * span + a[k:k + rows, None] * size_b + b).ravel())
            numbers.append((times_a[k:k + rows, None] * times_b).ravel())
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    if len(keys) == 1:
        return keys[0], numbers[0]
    return _distinct(np.concatenate(keys), np.concatenate(numbers))


def _spelled_groups(ids_a: np.ndarray, ids_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray,
                    last: np.ndarray) -> tuple[bytes, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3`` of all groups, and the end in it of each group
    numbered in ``last`` (the sign after a group counts with it)."""
    to_a, to_b = np.cumsum(n_a), np.cumsum(n_b)
    total = len(ids_a) + len(ids_b)
    value, sign = np.empty(total, np.int32), np.full(total, ord(","), np.uint8)
    value[np.arange(len(ids_a)) + np.repeat(to_b - n_b, n_a)] = ids_a
    value[np.arange(len(ids_b)) + np.repeat(to_a, n_b)] = ids_b
    sign[to_a + to_b - n_b - 1], sign[to_a + to_b - 1] = ord("|"), ord(";")
    width = len(str(int(value.max()))) if total else 1
    grid, shown = np.empty((total, width + 1), np.uint8), np.ones((total, width + 1), bool)
    rest = value
    for k in range(width - 1, -1, -1):
        rest, digit = np.divmod(rest, 10)
        grid[:, k] = digit + 48
        if k < width - 1:
            shown[:, k] = value >= 10 ** (width - 1 - k)
    grid[:, width] = sign
    ends = np.cumsum(shown.sum(1))
    return grid[shown].tobytes(), ends[(to_a + to_b - 1)[last]]


_LOADED: dict[tuple[str, str], Coder] = {}


def loaded(path_a: str, path_b: str) -> Coder:
    """The two tokenizers of these files, read once per Python worker."""
    if (path_a, path_b) not in _LOADED:
        _LOADED[path_a, path_b] = Coder(path_a, path_b)
    return _LOADED[path_a, path_b]


_ALIGNED = ("kind string, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
            "groups string, pairs binary, numbers binary, part int, seq long")


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None,
          path_b: str | None = None, digest: bool = False) -> DataFrame:
    """The written alignment.  Rows of kind 'doc': the document's counts, its
    groups as text (``digest``: their lowercase hex SHA-256), its distinct
    linked pairs (a * 2**32 + b, rising, little-endian 64-bit) and the number
    of links of each (little-endian 32-bit); part and seq name the row.  Rows
    of kind 'count': pairs with the number of documents of the task that hold
    them."""
    ship(docs.sparkSession)
    path_a = path_a or tokenizer_path("byte_bpe_50k.json")
    path_b = path_b or tokenizer_path("piece_bpe_32k.model")
    names = [f.split()[0] for f in _ALIGNED.split(", ")]

    def run(batches):
        coder, part, seq = loaded(path_a, path_b), TaskContext.get().partitionId(), 0
        size_b = len(coder.b_len)
        span = len(coder.a_len) * size_b
        held, held_n = [], 0

        def wide(keys):
            a, b = np.divmod(keys, size_b)
            return (a << 32 | b).astype("<i8")

        def counted():
            keys, numbers = _distinct(np.concatenate([k for k, _ in held]), np.concatenate([n for _, n in held]))
            return keys, numbers

        def handed_on(keys, numbers):
            row = {"kind": ["count"], "doc_id": [None], "n_a": [0], "n_b": [0], "n_groups": [0], "n_links": [0],
                   "groups": [""], "pairs": [wide(keys).tobytes()], "numbers": [numbers.astype("<u4").tobytes()],
                   "part": [part], "seq": [0]}
            return pa.RecordBatch.from_pydict(row, schema=arrow)

        arrow = pa.schema([("kind", pa.string()), ("doc_id", pa.int64()), *((n, pa.int64()) for n in names[2:6]),
                           ("groups", pa.string()), ("pairs", pa.binary()), ("numbers", pa.binary()),
                           ("part", pa.int32()), ("seq", pa.int64())])
        for batch in batches:
            ids, texts = batch.column(0), texts_of(batch.column(1)).to_pylist()
            for lo, hi in text_groups(texts, CHUNK):
                m = hi - lo
                a, at_a, b, at_b = coder.encode(texts[lo:hi])
                n_a, n_b = np.diff(at_a), np.diff(at_b)
                i, j = common_ends(np.cumsum(coder.a_len[a]), at_a, np.cumsum(coder.b_len[b]), at_b)
                in_a, in_b = np.diff(i, prepend=-1), np.diff(j, prepend=-1)
                group_end = np.searchsorted(i, at_a[1:])
                n_groups = np.diff(group_end, prepend=0)
                doc = np.repeat(np.arange(m), n_groups)
                links = np.concatenate(([0], np.cumsum(in_a * in_b)))[group_end]
                keys, numbers = link_pairs(a, b, in_a, in_b, doc, size_b, span)
                row, pair = np.divmod(keys, span)
                ends = np.searchsorted(row, np.arange(m), "right").tolist()
                spelled = [""] * m
                if len(i):
                    text, text_ends = _spelled_groups(a, b, in_a, in_b, np.maximum(group_end - 1, 0))
                    at = 0
                    for k, e in enumerate(text_ends.tolist()):
                        if n_groups[k]:
                            whole = text[at:e - 1]
                            spelled[k] = hashlib.sha256(whole).hexdigest() if digest else whole.decode()
                            at = e
                pairs_raw, numbers_raw = wide(pair).tobytes(), numbers.astype("<u4").tobytes()
                begins = [0, *ends[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(["doc"] * m), ids.slice(lo, m).cast(pa.int64()), pa.array(n_a), pa.array(n_b),
                     pa.array(n_groups), pa.array(np.diff(links, prepend=0)), pa.array(spelled),
                     pa.array([pairs_raw[8 * s:8 * e] for s, e in zip(begins, ends)], pa.binary()),
                     pa.array([numbers_raw[4 * s:4 * e] for s, e in zip(begins, ends)], pa.binary()),
                     pa.array(np.full(m, part, np.int32)), pa.array(np.arange(seq, seq + m))], schema=arrow)
                seq += m
                held.append(np.unique(pair, return_counts=True))
                held_n += len(held[-1][0])
                if held_n > 2 * HELD_PAIRS:
                    held = [counted()]
                    held_n = len(held[0][0])
                    if held_n > HELD_PAIRS:
                        yield handed_on(*held[0])
                        held, held_n = [], 0
        if held_n:
            yield handed_on(*counted())

    path = new_path(docs.sparkSession, "aligned")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows.mapInArrow(run, _ALIGNED).write.option("compression", "zstd").partitionBy("kind").parquet(path)
    # read with the schema, so that a table without rows of a kind is read too
    return docs.sparkSession.read.schema(_ALIGNED).parquet(path)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """The written table of linked pairs: pair, n (documents that hold it),
    best (whether no pair of the same A id has a larger n)."""
    def spread(batches):
        for batch in batches:
            for pairs, numbers in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys, n = np.frombuffer(pairs, "<i8"), np.frombuffer(numbers, "<u4").astype(np.int64)
                for k in range(0, len(keys), 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(keys[k:k + 100_000]), pa.array(n[k:k + 100_000])],
                                                     ["pair", "n"])

    parts = aligned.where("kind = 'count'").select("pairs", "numbers").mapInArrow(spread, "pair long, n long")
    counts = written(parts.groupBy("pair").agg(F.sum("n").alias("n")).withColumn(
        "a", F.shiftright("pair", 32)), "pairs")
    top = counts.groupBy("a").agg(F.max("n").alias("top"))
    return written(counts.join(top, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best")), "pairs")


def _hot_from(counts: DataFrame, limit: int) -> int:
    """The least count from which on at most ``limit`` pairs lie, taken at
    borders of a logarithmic scale (a few hundred rows)."""
    scale = F.floor(F.log2("n") * 16)
    rows = counts.groupBy(scale.alias("s")).agg(F.count("*").alias("pairs"), F.min("n").alias("n")).collect()
    out, seen = 1 << 62, 0
    for r in sorted(rows, reverse=True):
        seen += r["pairs"]
        if seen > limit:
            break
        out = r["n"]
    return out


def scored(aligned: DataFrame, counts: DataFrame, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """The documents of an alignment with n_best and count_sum."""
    spark = aligned.sparkSession
    least = _hot_from(counts, hot_pairs)
    hot = counts.where(F.col("n") >= least).toArrow()
    order = np.argsort(hot["pair"].to_numpy())
    sent = spark.sparkContext.broadcast(tuple(hot[c].to_numpy(zero_copy_only=False)[order] for c in ("pair", "n", "best")))
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "part", "seq"]

    def run(batches):
        known, n, best = sent.value
        known = np.append(known, np.int64(-1))  # never met: pairs are not negative
        n, best = np.append(n, 0), np.append(best, False)
        for batch in batches:
            pairs, numbers = (batch.column(k).to_pylist() for k in (len(kept), len(kept) + 1))
            lengths = np.fromiter((len(p) // 8 for p in pairs), np.int64, len(pairs))
            off = np.concatenate(([0], np.cumsum(lengths)))
            keys, times = np.frombuffer(b"".join(pairs), "<i8"), np.frombuffer(b"".join(numbers), "<u4").astype(np.int64)
            at = np.searchsorted(known[:-1], keys)
            met = known[at] == keys
            sums = [np.concatenate(([0], np.cumsum(x)))[off] for x in
                    (np.where(met, times * n[at], 0), np.where(met, times * best[at], 0))]
            cold = np.flatnonzero(~met)
            cold_off = pa.array(np.searchsorted(cold, off).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(kept)], pa.array(np.diff(sums[0])), pa.array(np.diff(sums[1])),
                 pa.ListArray.from_arrays(cold_off, pa.array(keys[cold])),
                 pa.ListArray.from_arrays(cold_off, pa.array(times[cold]))],
                [*kept, "hot_sum", "hot_best", "cold", "times"])

    docs = aligned.where("kind = 'doc'").select(*kept, "pairs", "numbers")
    schema = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, part int, seq long, "
              "hot_sum long, hot_best long, cold array<long>, times array<long>")
    rows = written(docs.mapInArrow(run, schema), "scored")
    apart = rows.where(F.size("cold") > 0).select(
        "part", "seq", F.explode(F.arrays_zip("cold", "times")).alias("c")).select(
        "part", "seq", F.col("c.cold").alias("pair"), F.col("c.times").alias("times"))
    rest = (apart.join(counts.where(F.col("n") < least), "pair").groupBy("part", "seq")
            .agg(F.sum(F.col("times") * F.col("n")).alias("cold_sum"),
                 F.sum(F.when(F.col("best"), F.col("times"))).alias("cold_best")))
    return (rows.drop("cold", "times").join(rest, ["part", "seq"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("hot_best") + F.coalesce("cold_best", F.lit(0))).alias("n_best"),
        (F.col("hot_sum") + F.coalesce("cold_sum", F.lit(0))).alias("count_sum"), "groups"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: both tokenizers aligned on every document."""
    aligned = align(table(spark, sf_dir, "documents"), digest=True)
    return scored(aligned, pair_counts(aligned)).withColumnRenamed("groups", "groups_sha256")
