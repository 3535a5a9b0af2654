"""Harmonic packing of documents into sequences of at most ``capacity`` tokens.

Lengths fall into classes by the reciprocal of the capacity: a class of order
j holds pieces of at most ``capacity // j`` tokens, and each of its sequences
holds exactly j of them.  A piece's place follows from its rank in its class
alone, so workers fill the sequences of a class without looking at each other.

1. *Cut.*  A document longer than a sequence gives whole sequences (order 1).
   The rest, of r tokens, stays one piece if a class holds it with little
   slack; otherwise it is cut at the largest class size below r, which leaves
   a remainder smaller by about the order of that class.
2. *Rank.*  Each task numbers its pieces by class while it encodes, and writes
   them.  Running sums over the (task, class) counts give ranks in the corpus;
   the tables summed have a row per task and class, never one per document.
3. *Fill.*  Piece number r of class j goes to sequence r // j.  Fewer than j
   pieces of each class are left over.  They are strung together in class
   order, each class from its own known start, and cut into whole sequences;
   the last stretch is cut at powers of two, which need no padding.  There
   are at most about ``2 sqrt(capacity)`` such strings of less than a sequence
   each, whatever the size of the corpus.

The padding of a sequence is ``capacity`` less its tokens, none if its tokens
are a power of two in number.  With ``slack`` 1/64 about one token in a
thousand is padding.

Defined results: a null or empty text is its end id alone; repeated rows are
documents of their own; a text of any length is cut into pieces; a table
without rows gives no sequence.  Extra columns of the input are ignored,
whatever their names; null ids are kept as nulls.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lagjoin.llm.bpe import WordBPE, tokenizer_path
from lagjoin.llm.shared import ship, table, text_groups, texts_of, written
from lagjoin.llm.words import LONG_WORD, HashedWords, piece_encoder

CAPACITY = 4096
END_ID = 2
SLACK = 1 / 64
#: Code points encoded at once.
CHUNK = 500_000
#: Stands for the end-of-word suffix in byte strings; UTF-8 never holds it.
_MARK = b"\xff"


class Encoder(WordBPE):
    """The word-level tokenizer with proposals by byte-pair merging; each is
    verified as in :class:`WordBPE`, and words that fail are merged exactly."""

    def __init__(self, path: str):
        super().__init__(path)
        byte_of = {s: b for b, s in enumerate(self.symbols)}
        ranks = {bytes(byte_of[c] for c in t if c != "\0") + _MARK * t.endswith("\0"): int(self.vocab_id[k])
                 for t, k in self.order.items()}
        self.piece = piece_encoder(ranks)
        self.number = np.zeros(len(self.strings), np.int64)
        self.number[self.vocab_id] = np.arange(self.n)
        self.words = HashedWords(lambda words: (self.encode_words(words), np.ones(len(words), bool)))

    def encode_words(self, words: list[str]) -> list[list[int]]:
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        out = [self.piece(w + _MARK) if len(w) <= LONG_WORD else [] for w in raw]
        lengths = np.fromiter(map(len, out), np.int64, len(out))
        flat = self.number[np.fromiter((t for p in out for t in p), np.int64, int(lengths.sum()))]
        word_of = np.repeat(np.arange(len(words)), lengths)
        good = lengths > 0
        good[word_of[~self.sound[flat]]] = False
        pairs = np.flatnonzero(word_of[1:] == word_of[:-1])
        good[word_of[pairs[~self._compatible(flat[pairs], flat[pairs + 1])]]] = False
        for k in np.flatnonzero(~good).tolist():
            inner = "".join([self.symbols[b] for b in raw[k]]) + "\0"
            out[k] = self.vocab_id[self._merged(inner)].tolist()
        return out


_LOADED: dict[str, Encoder] = {}


def loaded(path: str) -> Encoder:
    """The tokenizer of a file, read once per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def cut(length: int, capacity: int = CAPACITY, slack: float = SLACK) -> list[tuple[int, int]]:
    """Pieces of a document as (order of the class, tokens), in order."""
    out = [(1, capacity)] * (length // capacity)
    rest = length % capacity
    while rest:
        order = capacity // rest
        size = capacity // order  # the smallest class size that holds the rest
        if size - rest <= slack * size:
            return [*out, (order, rest)]
        below = capacity // (order + 1)
        out.append((capacity // below, below))
        rest -= below
    return out


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
           end_id: int = END_ID, capacity: int = CAPACITY, slack: float = SLACK) -> DataFrame:
    """The written pieces of all documents: doc_id, start, length, doc_tokens,
    ids (little-endian unsigned 32-bit), the order of the class, the task that
    cut them (part) and their number in that task's class (seq)."""
    ship(docs.sparkSession)
    path = path or tokenizer_path()
    schema = ("doc_id long, start long, length long, doc_tokens long, ids binary, "
              "class_order long, part int, seq long")

    def run(batches):
        coder, part = loaded(path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        cuts: dict[int, list[tuple[int, int]]] = {}
        for batch in batches:
            names, texts = batch.column(0), texts_of(batch.column(1)).to_pylist()
            for a, b in text_groups(texts, CHUNK):
                rows, starts, lengths, totals, blobs, orders, numbers = [], [], [], [], [], [], []
                for row, ids in zip(range(a, b), coder.encode_texts(texts[a:b])):
                    total = len(ids) + 1
                    data = np.append(ids, end_id).astype("<u4").tobytes()
                    if total < capacity and total not in cuts:
                        cuts[total] = cut(total, capacity, slack)
                    at = 0
                    for order, n in cuts.get(total) or cut(total, capacity, slack):
                        rows.append(row)
                        starts.append(at)
                        lengths.append(n)
                        totals.append(total)
                        blobs.append(data[4 * at:4 * (at + n)])
                        orders.append(order)
                        numbers.append(seen[order])
                        seen[order] += 1
                        at += n
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(rows)), *(pa.array(x, pa.int64()) for x in (starts, lengths, totals)),
                     pa.array(blobs, pa.binary()), pa.array(orders, pa.int64()),
                     pa.array(np.full(len(rows), part, np.int32)), pa.array(numbers, pa.int64())],
                    ["doc_id", "start", "length", "doc_tokens", "ids", "class_order", "part", "seq"])

    cut_up = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return written(cut_up.mapInArrow(run, schema), "pieces")


def _stretches(tokens: int, capacity: int) -> list[tuple[int, int]]:
    """Begin and end of the sequences that a string of left-over tokens is
    cut into: whole ones, then powers of two."""
    out, at = [], 0
    while at < tokens:
        size = min(capacity, 1 << (tokens - at).bit_length() - 1) if tokens - at < capacity else capacity
        out.append((at, at + size))
        at += size
    return out


def place(cut_pieces: DataFrame, capacity: int = CAPACITY, payload: str = "ids") -> DataFrame:
    """Every piece with its sequence_id and offset.

    ``payload``: 'ids' keeps the token bytes, 'crc32' their checksum instead
    (``ids_crc32``), so that no tokens are shuffled.  Left-over pieces may be
    cut once more, so a document has at least as many pieces as before."""
    spark = cut_pieces.sparkSession
    order = F.col("class_order")
    counts = cut_pieces.groupBy("part", "class_order").agg(F.count("*").alias("n"))
    before = Window.partitionBy("class_order").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "class_order", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # a class has one row here, and there are about 2 sqrt(capacity) classes
    totals = {r["class_order"]: r["n"]
              for r in counts.groupBy("class_order").agg(F.sum("n").alias("n")).collect()}
    first, begin, rows = 0, 0, []
    for j, n in sorted(totals.items()):
        rows.append((j, n // j, first))
        first += n // j
    classes = spark.createDataFrame(rows, "class_order long, full long, first long")
    name = "ids_crc32" if payload == "crc32" else "ids"
    held = F.crc32("ids").alias(name) if payload == "crc32" else F.col("ids")
    key = ["part", "class_order", "seq"]
    columns = ["doc_id", "start", "length", name, "doc_tokens", "sequence_id", "offset"]
    ranked = (cut_pieces.select(*key, "doc_id", "start", "length", "doc_tokens", held)
              .join(bases, ["part", "class_order"]).join(F.broadcast(classes), "class_order")
              .withColumn("rank", F.col("base") + F.col("seq"))
              .withColumn("nth", F.floor(F.col("rank") / order)))
    left = ranked.where(F.col("nth") >= F.col("full")).select(*key, "doc_id", "start", "length", "doc_tokens", "rank")
    begins = []
    for r in sorted(left.groupBy("class_order").agg(F.sum("length").alias("n")).collect()):
        begins.append((r["class_order"], begin))
        begin += r["n"]

    in_sequence = Window.partitionBy("sequence_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    filled = (ranked.where(F.col("nth") < F.col("full"))
              .withColumn("sequence_id", F.col("first") + F.col("nth"))
              .withColumn("offset", F.coalesce(F.sum("length").over(in_sequence), F.lit(0))).select(*columns))

    # fewer than ``order`` pieces of a class are left over, one small group
    # each: below capacity * ln(capacity) rows, whatever the corpus, so
    # they are sent to where their tokens lie
    cuts = F.array(*[F.struct(F.lit(k).cast("long").alias("k"), F.lit(a).cast("long").alias("a"),
                              F.lit(b).cast("long").alias("b"))
                     for k, (a, b) in enumerate(_stretches(begin, capacity), first)] or
                   [F.struct(F.lit(0).cast("long").alias("k"), F.lit(0).cast("long").alias("a"),
                             F.lit(0).cast("long").alias("b"))])
    in_class = Window.partitionBy("class_order").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    strung = (cut_pieces.select(*key, "ids").join(F.broadcast(left), key)
              .join(F.broadcast(spark.createDataFrame(begins, "class_order long, begin long")), "class_order")
              .withColumn("at", F.col("begin") + F.coalesce(F.sum("length").over(in_class), F.lit(0)))
              .withColumn("cut", F.explode(F.filter(cuts, lambda c: (c["b"] > F.col("at")) &
                                                    (c["a"] < F.col("at") + F.col("length")))))
              .withColumn("skip", F.greatest(F.col("cut.a") - F.col("at"), F.lit(0)))
              .withColumn("offset", F.greatest(F.col("at") - F.col("cut.a"), F.lit(0)))
              .withColumn("length", F.least(F.col("cut.b"), F.col("at") + F.col("length")) -
                          F.greatest(F.col("cut.a"), F.col("at")))
              .withColumn("start", F.col("start") + F.col("skip"))
              .withColumn("ids", F.substring("ids", (4 * F.col("skip") + 1).cast("int"),
                                             (4 * F.col("length")).cast("int")))
              .withColumn("sequence_id", F.col("cut.k")))
    if payload == "crc32":
        strung = strung.withColumn(name, F.crc32("ids"))
    return filled.unionByName(strung.select(*columns))


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (the pieces' bytes
    in order), n_tokens, and doc_ids and lengths of the pieces."""
    one = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    return placed.groupBy("sequence_id").agg(one.alias("held")).select(
        "sequence_id", F.expr("aggregate(held, cast('' as binary), (x, p) -> concat(x, p.ids))").alias("ids"),
        F.expr("aggregate(held, 0L, (x, p) -> x + p.length)").alias("n_tokens"),
        F.col("held.doc_id").alias("doc_ids"), F.col("held.length").alias("lengths"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: all documents packed; a row per piece."""
    return place(pieces(table(spark, sf_dir, "documents")), payload="crc32")
