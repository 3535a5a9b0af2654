"""Token-id output as wavelet matrices.

Documents are dealt by ranges of id and the beginning of the text, so rows of
one id may span tasks; each task encodes its documents and writes shard files.
A shard holds its documents' ids, offsets and a wavelet matrix of all token
ids: one bit-plane per bit, highest first, each stably partitioned by the
planes before.  Planes are stored in blocks of ``STORED_BITS`` bits with a
directory of their places and of the ones before each, so access, counting
and occurrence lookup (:class:`ShardFile`) read and inflate one or two blocks
a plane, never the whole shard.

File: magic ``WVM2``, a little-endian uint32 header length, a JSON header
(numbers of documents, tokens and bits, zeros of each plane, section lengths),
then the sections: the directory (uint32 lengths, then uint64 ones before, of
all blocks, plane by plane), ids, known ids, token counts, and the blocks.
All sections and blocks are compressed by zlib, each alone.

Defined results: a null text is empty and has only its end id; null ids come
first; rows of one id are ordered by text, repeated rows are written each; a
table without rows has no shard; a very long text makes a shard of its own;
columns other than the two named are not looked at, whatever their names.
"""

from __future__ import annotations

import io
import json
import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lagjoin.llm.bpe import byte_symbols, tokenizer_path
from lagjoin.llm.pretok import code_points, split_keeping_space
from lagjoin.llm.shared import new_path, ship, table, text_groups, texts_of, written
from lagjoin.llm.store import filesystem, own_name, read_bytes, write_bytes
from lagjoin.llm.words import LONG_WORD, HashedWords, piece_encoder

END_ID = 2
SHARD_TOKENS = 4_000_000
MAGIC = b"WVM2"
BLOCK = 512
#: Bits of a plane that are stored, and inflated, together.
STORED_BITS = 1 << 17
#: Code points encoded at once.
CHUNK = 500_000


class WaveletMatrix:
    """Planes of an integer sequence with rank and select support."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int]):
        self.n, self.planes, self.zeros = n, planes, zeros  # planes are packed bits
        self.ranks = []
        for plane in planes:
            ones = np.bitwise_count(np.append(plane, np.zeros(-len(plane) % (BLOCK // 8), np.uint8)))
            per = ones.reshape(-1, BLOCK // 8).sum(1, dtype=np.int64)
            self.ranks.append(np.concatenate(([0], np.cumsum(per))))

    @classmethod
    def build(cls, values: np.ndarray) -> "WaveletMatrix":
        bits = max(1, int(values.max()).bit_length()) if len(values) else 1
        values = values.astype(np.uint16 if bits <= 16 else np.uint32)
        planes, zeros = [], []
        for level in range(bits - 1, -1, -1):
            high = (values & values.dtype.type(1 << level)) != 0
            planes.append(np.packbits(high))
            low = values[~high]
            zeros.append(len(low))
            values = np.concatenate([low, values[high]])
        return cls(len(values), planes, zeros)

    def _rank1(self, level: int, at: int) -> int:
        """Ones among the first ``at`` bits of a plane."""
        block, rest = divmod(at, BLOCK)
        lo = block * (BLOCK // 8)
        part = np.unpackbits(self.planes[level][lo:lo + (rest + 7) // 8])[:rest]
        return int(self.ranks[level][block] + part.sum())

    def _bit(self, level: int, at: int) -> int:
        return int(self.planes[level][at >> 3] >> (7 - (at & 7)) & 1)

    def access(self, at: int) -> int:
        value = 0
        if not 0 <= at < self.n:
            raise IndexError(f"position {at} of {self.n} tokens")
        for level in range(len(self.zeros)):
            bit = self._bit(level, at)
            ones = self._rank1(level, at)
            at = self.zeros[level] + ones if bit else at - ones
            value = value << 1 | bit
        return value

    def _narrow(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        if token >> len(self.zeros):
            return 0, 0
        for level in range(len(self.zeros)):
            a, b = self._rank1(level, lo), self._rank1(level, hi)
            if token >> (len(self.zeros) - 1 - level) & 1:
                lo, hi = self.zeros[level] + a, self.zeros[level] + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of ``token`` at positions lo <= p < hi."""
        a, b = self._narrow(token, lo, self.n if hi is None else hi)
        return b - a

    def _select(self, level: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) ``bit`` of a plane."""
        ranks = self.ranks[level]
        before = ranks if bit else np.arange(len(ranks)) * BLOCK - ranks
        block = int(np.searchsorted(before, k, "right")) - 1
        lo = block * (BLOCK // 8)
        part = np.unpackbits(self.planes[level][lo:lo + BLOCK // 8])
        return block * BLOCK + int(np.flatnonzero(part == bit)[k - before[block]])

    def locate(self, token: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of ``token``."""
        lo, hi = self._narrow(token, 0, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(f"token {token} occurs {hi - lo} times")
        at = lo + k
        for level in range(len(self.zeros) - 1, -1, -1):
            bit = token >> (len(self.zeros) - 1 - level) & 1
            at = self._select(level, bit, at - self.zeros[level] if bit else at)
        return at

    def values(self) -> np.ndarray:
        """All values: from the lowest plane upwards, each plane's stable
        partition is undone by its own bits, in sequential passes."""
        out = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for level, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros))):
            high = np.unpackbits(plane, count=self.n).view(bool)
            before = np.empty_like(out)
            before[~high] = out[:zeros]
            before[high] = out[zeros:] | out.dtype.type(1 << level)
            out = before
        return out.astype(np.uint32)


def shard_bytes(doc_ids: list[int | None], lengths: np.ndarray, tokens: np.ndarray,
                stored_bits: int = STORED_BITS) -> bytes:
    """The file of a shard; ``stored_bits`` is a multiple of 8."""
    wm = WaveletMatrix.build(tokens)
    ids = np.array([i or 0 for i in doc_ids], "<i8")
    known = np.packbits(np.array([i is not None for i in doc_ids], np.uint8))
    step = stored_bits // 8
    blocks, ones = [], []
    for plane in wm.planes:
        parts = [plane[k:k + step] for k in range(0, len(plane), step)]
        blocks += [zlib.compress(part.tobytes(), 1) for part in parts]
        ones += [0, *np.cumsum([int(np.bitwise_count(part).sum()) for part in parts])[:-1].tolist()] if parts else []
    directory = np.array([len(b) for b in blocks], "<u4").tobytes() + np.array(ones, "<u8").tobytes()
    sections = [zlib.compress(s, 1) for s in (directory, ids.tobytes(), known.tobytes(), lengths.astype("<i8").tobytes())]
    head = json.dumps({"docs": len(doc_ids), "tokens": wm.n, "zeros": wm.zeros, "stored_bits": stored_bits,
                       "sections": [len(s) for s in sections]}).encode()
    return MAGIC + struct.pack("<I", len(head)) + head + b"".join(sections) + b"".join(blocks)


class ShardFile(WaveletMatrix):
    """Rank, select, access, count and locate on a shard file, by reads of
    the header, the directory and the blocks that a call touches."""

    def __init__(self, file, cached_blocks: int = 64):
        self.file = file
        if file.read(4) != MAGIC:
            raise ValueError("not a wavelet shard")
        size = struct.unpack("<I", file.read(4))[0]
        self.head = json.loads(file.read(size))
        self.n, self.zeros, self.stored = self.head["tokens"], self.head["zeros"], self.head["stored_bits"]
        self.at = np.cumsum([8 + size, *self.head["sections"]]).tolist()
        directory = self._section(0)
        count = len(directory) // 12
        self.per_plane = count // len(self.zeros)
        lengths = np.frombuffer(directory, "<u4", count).astype(np.int64)
        self.places = np.concatenate(([0], np.cumsum(lengths))) + self.at[-1]
        self.before = np.frombuffer(directory, "<u8", offset=4 * count).astype(np.int64).reshape(len(self.zeros), -1)
        self.block = lru_cache(cached_blocks)(self._block)
        self.read_blocks = 0

    def _section(self, k: int) -> bytes:
        self.file.seek(self.at[k])
        return zlib.decompress(self.file.read(self.at[k + 1] - self.at[k]))

    def _block(self, level: int, k: int) -> np.ndarray:
        self.read_blocks += 1
        lo, hi = self.places[level * self.per_plane + k:][:2].tolist()
        self.file.seek(lo)
        return np.frombuffer(zlib.decompress(self.file.read(hi - lo)), np.uint8)

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        """Ids of the documents and their token counts."""
        known = np.unpackbits(np.frombuffer(self._section(2), np.uint8))[:self.head["docs"]]
        ids = [i if k else None for i, k in zip(np.frombuffer(self._section(1), "<i8").tolist(), known)]
        return ids, np.frombuffer(self._section(3), "<i8")

    @property
    def planes(self) -> list[np.ndarray]:
        """All planes whole, each inflated when it is asked for."""
        return [np.concatenate([self._block(level, k) for k in range(self.per_plane)] or [np.empty(0, np.uint8)])
                for level in range(len(self.zeros))]

    def _bit(self, level: int, at: int) -> int:
        k, rest = divmod(at, self.stored)
        return int(self.block(level, k)[rest >> 3] >> (7 - (rest & 7)) & 1)

    def _rank1(self, level: int, at: int) -> int:
        k, rest = divmod(at, self.stored)
        if k >= self.per_plane:
            return self.n - self.zeros[level]
        if not rest:
            return int(self.before[level, k])
        part = self.block(level, k)
        whole = int(np.bitwise_count(part[:rest >> 3]).sum())
        last = int(part[rest >> 3]) >> (8 - (rest & 7)) if rest & 7 else 0
        return int(self.before[level, k]) + whole + last.bit_count()

    def _select(self, level: int, bit: int, k: int) -> int:
        ones = self.before[level]
        before = ones if bit else np.arange(self.per_plane) * self.stored - ones
        block = int(np.searchsorted(before, k, "right")) - 1
        part = np.unpackbits(self.block(level, block))
        return block * self.stored + int(np.flatnonzero(part == bit)[k - before[block]])


def open_shard(data: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """Document ids, their token counts and the matrix of a shard file that
    is in memory."""
    shard = ShardFile(io.BytesIO(data))
    return *shard.documents(), WaveletMatrix(shard.n, shard.planes, shard.zeros)


class ByteEncoder:
    """Encoder of a byte-level BPE file: texts are split at once by array
    operations and each new word is merged by its ranks (very long ones by
    the tokenizers library, whose time grows with n log n)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.added_at = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) or r"(?!)")
        byte_of = {s: b for b, s in enumerate(byte_symbols())}
        self.piece = piece_encoder({bytes(byte_of[c] for c in t): i for t, i in self.tokenizer.get_vocab().items()
                                    if t not in self.added})
        self.words = HashedWords(self._encode_words)

    def _encode_words(self, words: list[str]) -> tuple[list[list[int]], np.ndarray]:
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        ids = [self.piece(w) if len(w) <= LONG_WORD else self.tokenizer.encode(t, add_special_tokens=False).ids
               for w, t in zip(raw, words)]
        return ids, np.ones(len(words), bool)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        pieces, rows = [], []
        for text in texts:
            row, at = [], 0
            for m in self.added_at.finditer(text):
                row += [text[at:m.start()], self.added[m.group()]]
                at = m.end()
            row.append(text[at:])
            rows.append(row)
            pieces += [p for p in row if isinstance(p, str)]
        joined = "".join(pieces)
        offsets = np.concatenate(([0], np.cumsum([len(p) for p in pieces], dtype=np.int64)))
        cp = code_points(joined)
        starts, ends = split_keeping_space(cp, offsets)
        ids, lengths = self.words.gather(self.words.lookup(joined, cp, starts, ends))
        by_word = np.concatenate(([0], np.cumsum(lengths)))
        bounds = by_word[np.searchsorted(starts, offsets)].tolist()
        encoded = (ids[a:b] for a, b in zip(bounds[:-1], bounds[1:]))
        return [np.concatenate([next(encoded) if isinstance(p, str) else np.array([p], np.int32) for p in row])
                for row in rows]


_ENCODERS: dict[str, ByteEncoder] = {}


def write_shards(df: DataFrame, id_col: str, text_col: str, folder: str | None = None, path: str | None = None,
                 end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Shard files in id order; the written table (part, seq, file, docs,
    tokens, base), base being the tokens of all shards before."""
    spark = df.sparkSession
    ship(spark)
    folder, path = folder or new_path(spark, "wavelet"), path or tokenizer_path("byte_bpe_50k.json")

    def run(batches):
        coder = _ENCODERS.get(path) or _ENCODERS.setdefault(path, ByteEncoder(path))
        part, seq, ids, arrays, held = TaskContext.get().partitionId(), 0, [], [], 0

        def flush():
            nonlocal seq, ids, arrays, held
            uri = own_name(folder, ".wvm")
            write_bytes(uri, shard_bytes(ids, np.array([len(a) for a in arrays]), np.concatenate(arrays)))
            row = pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()),
                                              "file": [uri], "docs": [len(ids)], "tokens": [held]})
            seq, ids, arrays, held = seq + 1, [], [], 0
            return row

        for batch in batches:
            names, texts = batch.column(0).to_pylist(), texts_of(batch.column(1)).to_pylist()
            for a, b in text_groups(texts, CHUNK):
                for name, tokens in zip(names[a:b], coder.encode(texts[a:b])):
                    tokens = np.append(tokens, end_id).astype(np.uint32)
                    if ids and held + len(tokens) > shard_tokens:
                        yield flush()
                    ids.append(name)
                    arrays.append(tokens)
                    held += len(tokens)
        if ids:
            yield flush()

    # ranges are cut by id and the beginning of the text, so that no whole
    # text is sampled
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                     F.substring(text_col, 1, 200).alias("head"))
    dealt = rows.repartitionByRange("id", "head").sortWithinPartitions("id", "text")
    shards = written(dealt.select("id", "text").mapInArrow(run, "part int, seq int, file string, docs long, tokens long"), "shards")
    # tokens before a shard: those of earlier tasks, then of its own task's
    per_part = shards.groupBy("part").agg(F.sum("tokens").alias("t"))
    before = per_part.select("part", F.coalesce(F.sum("t").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    own = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return written(shards.join(before, "part").withColumn(
        "base", F.col("before") + F.coalesce(F.sum("tokens").over(own), F.lit(0))).drop("before"), "shards")


def read_shards(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the
    shard files."""
    ship(shards.sparkSession)

    def run(batches):
        for batch in batches:
            for file, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids, lengths, wm = open_shard(read_bytes(file))
                tokens = wm.values().astype("<u4")
                ends = np.cumsum(lengths)
                crc = [zlib.crc32(tokens[e - n:e].tobytes()) for e, n in zip(ends.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(base + ends - lengths, pa.int64()),
                     pa.array(lengths, pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    # shards are of about one size: dealt in turn, a few to a task
    spark = shards.sparkSession
    files = max(1, min(shards.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return shards.select("file", "base").repartition(files).mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def count_tokens(shards: DataFrame, tokens: list[int]) -> DataFrame:
    """token and n, how often it occurs in the whole corpus, from the blocks
    of the shards that counting touches."""
    ship(shards.sparkSession)
    wanted = sorted(set(tokens))

    def run(batches):
        for batch in batches:
            for file in batch.column(0).to_pylist():
                system, path = filesystem(file)
                with system.open_input_file(path) as f:
                    shard = ShardFile(f)
                    n = [shard.count(t) for t in wanted]
                yield pa.RecordBatch.from_arrays([pa.array(wanted, pa.int64()), pa.array(n, pa.int64())], ["token", "n"])

    return (shards.select("file").mapInArrow(run, "token long, n long")
            .groupBy("token").agg(F.sum("n").alias("n")))


def find_token(shards: DataFrame, token: int) -> DataFrame:
    """file and position (in the whole corpus) of every occurrence of
    ``token``, by select in the shards."""
    ship(shards.sparkSession)

    def run(batches):
        for batch in batches:
            for file, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, path = filesystem(file)
                with system.open_input_file(path) as f:
                    shard = ShardFile(f, 2048)
                    total = shard.count(token)
                    for lo in range(0, total, 10_000):
                        at = [base + shard.locate(token, k) for k in range(lo, min(lo + 10_000, total))]
                        yield pa.RecordBatch.from_arrays([pa.array([file] * len(at), pa.string()),
                                                          pa.array(at, pa.int64())], ["file", "position"])

    return shards.select("file", "base").mapInArrow(run, "file string, position long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: every document written to shards and read back."""
    return read_shards(write_shards(table(spark, sf_dir, "documents"), "doc_id", "text"))
