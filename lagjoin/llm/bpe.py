"""BPE encoding and decoding: speculate and verify.

A text is normalised and split into words as the tokenizer file says.  New
words are encoded in three steps:

1. *Speculate*: greedy longest match over the vocabulary proposes tokens.
2. *Verify*: a sequence of tokens is what the merges give exactly when each
   token is what the merges give for its own string and no merge would have
   crossed the border of any adjacent pair.  Both facts are tested for all
   tokens of all words at once with array lookups: the pair's merges are
   undone, latest first, and at each step the two symbols at the border must
   not have a merge that would have come first.
3. *Merge*: only the words that fail are merged exactly, by rank.

Encoded words are kept in a bounded table per Python worker, so a word of the
language is encoded once and looked up afterwards.  The operator is a narrow
map over the rows: no shuffle, nothing collected, no skew.

Defined results: a null text counts as empty; an empty text has no tokens,
``ids`` is empty and the decoded text is empty.  Repeated rows are encoded
independently.  Extra columns are ignored by the query and kept by
:func:`encode` when named in ``keep``.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lagjoin.llm.pretok import WordTable, code_points, split_dropping_space
from lagjoin.llm.shared import ship, table, text_chunks, text_groups

END = "\0"  # stands for the end-of-word suffix inside this module


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level
    vocabularies: itself where printable, else the next free one from 256."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, free = {}, 256
    for b in range(256):
        if b in printable:
            out[b] = chr(b)
        else:
            out[b], free = chr(free), free + 1
    return [out[b] for b in range(256)]


class WordBPE:
    """Encoder and decoder of a word-level BPE file with an end-of-word
    suffix and byte-level symbols."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        vocab = {self._inner(t): i for t, i in model["vocab"].items()}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        pairs = [(self._inner(a), self._inner(b)) for a, b in merges]
        self.rank = {pair: r for r, pair in enumerate(pairs)}
        # own numbering: symbols without a merge first, then by rank
        made = {a + b: r for r, (a, b) in enumerate(pairs)}
        base = [t for t in vocab if t not in made]
        self.n_base = len(base)
        order = {t: k for k, t in enumerate(base)}
        order |= {t: self.n_base + r for t, r in made.items()}
        self.order = order
        n = self.n_base + len(pairs)
        self.left = np.arange(n)
        self.right = np.arange(n)
        self.vocab_id = np.full(n, -1)
        for t, k in order.items():
            self.vocab_id[k] = vocab[t]
        own = np.fromiter((made[a + b] == r for r, (a, b) in enumerate(pairs)), bool, len(pairs))
        for r, (a, b) in enumerate(pairs):
            self.left[self.n_base + r], self.right[self.n_base + r] = order[a], order[b]
        keys = np.fromiter((order[a] * n + order[b] for a, b in pairs), np.int64, len(pairs))
        by_key = np.argsort(keys)
        self.pair_keys, self.pair_made, self.n = keys[by_key], self.n_base + by_key, n
        self.longest: dict[str, int] = {}
        for t in order:
            self.longest[t[:2]] = max(self.longest.get(t[:2], 0), len(t))
        self.symbols = byte_symbols()
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.added_at = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) \
            if self.added else None
        size = max([*vocab.values(), *self.added.values()]) + 1
        self.strings = [""] * size
        for t, i in [*model["vocab"].items(), *self.added.items()]:
            self.strings[i] = t
        merged = np.arange(self.n_base, n)
        self.sound = np.ones(n, bool)
        self.sound[merged] = own & self._compatible(self.left[merged], self.right[merged], merged)
        for k in merged:  # a token is sound when its halves are, too
            self.sound[k] &= self.sound[self.left[k]] & self.sound[self.right[k]]

    def _inner(self, token: str) -> str:
        if self.suffix and token.endswith(self.suffix):
            return token[:-len(self.suffix)] + END
        return token

    def _merge_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of the token that a merge makes of each pair, n if none."""
        key = a * self.n + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_made[at], self.n)

    def _compatible(self, a: np.ndarray, b: np.ndarray, own: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge would have crossed the border of each pair.
        ``own``: the token that the pair itself forms; that merge is due."""
        ok = np.ones(len(a), bool)
        live = np.arange(len(a))
        a, b = a.copy(), b.copy()
        # what is merged at the border must come before this token; equal on
        # the right side still loses, as the left of two equal merges is first
        limit = np.full(len(a), self.n) if own is None else own.copy()
        while len(live):
            crossing = self._merge_of(a, b) < limit
            ok[live[crossing]] = False
            going = ~crossing
            live, a, b, limit = live[going], a[going], b[going], limit[going]
            whole_a, whole_b = a < self.n_base, b < self.n_base
            undo_a = (a > b) & ~whole_a | whole_b & ~whole_a
            undo_b = ~undo_a & ~whole_b
            limit = np.where(undo_a, a, np.where(undo_b, b + 1, limit))
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_b, self.left[b], b)
            going = undo_a | undo_b
            live, a, b, limit = live[going], a[going], b[going], limit[going]
        return ok

    def _greedy(self, word: str) -> list[int]:
        out, at, n = [], 0, len(word)
        order, longest = self.order, self.longest
        while at < n:
            end = min(n, at + (longest.get(word[at:at + 2]) or 1))
            while (token := order.get(word[at:end]) if end != n - 1 or word[end] != END else None) is None:
                end -= 1  # the end mark never stands alone
            out.append(token)
            at = end
        return out

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Vocabulary ids of each word: greedy proposals, array checks of
        every token and adjacent pair, exact merging of what fails."""
        symbols = self.symbols
        inner = ["".join([symbols[b] for b in w.encode("utf-8", "surrogatepass")]) + END * bool(self.suffix)
                 for w in words]
        # base symbols include the marked last one, as one symbol
        proposed = [self._greedy(w) for w in inner]
        lengths = np.fromiter(map(len, proposed), np.int64, len(words))
        flat = np.fromiter((t for p in proposed for t in p), np.int64, int(lengths.sum()))
        word_of = np.repeat(np.arange(len(words)), lengths)
        good = np.ones(len(words), bool)
        good[word_of[~self.sound[flat]]] = False
        pairs = np.flatnonzero(word_of[1:] == word_of[:-1])
        good[word_of[pairs[~self._compatible(flat[pairs], flat[pairs + 1])]]] = False
        ids = self.vocab_id[flat].tolist()
        ends = np.cumsum(lengths).tolist()
        out, at = [], 0
        for k, end in enumerate(ends):
            out.append(ids[at:end] if good[k] else self.vocab_id[self._merged(inner[k])].tolist())
            at = end
        return out

    def _merged(self, word: str) -> list[int]:
        """Exact merging by rank, leftmost first: a heap over a linked list
        of symbols, so a very long word costs n log n.  The last symbol
        carries the end mark."""
        parts = [*word[:-2], word[-2:]] if self.suffix else list(word)
        work: list[str | None] = list(parts)
        n = len(work)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank, heap = self.rank, []

        def offer(i: int, j: int) -> None:
            if (r := rank.get((work[i], work[j]))) is not None:
                heapq.heappush(heap, (r, i, work[i], work[j]))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if work[i] != a or j >= n or work[j] != b:
                continue
            work[i], work[j] = a + b, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                offer(i, k)
            if before[i] >= 0:
                offer(before[i], i)
        return [self.order[p] for p in work if p is not None]

    def normalised(self, text: str) -> str:
        """NFC, then lower case character by character (so a final sigma
        is an ordinary one); white space separates words either way."""
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            text = text.replace("Σ", "σ")
        return text.lower()

    def decode(self, ids: list[int]) -> str:
        """Token strings joined by a blank: the file names no decoder."""
        return " ".join([self.strings[i] for i in ids])


    def encode_texts(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Vocabulary ids of each text, in order."""
        pieces, rows = [], []
        for text in texts:
            row = self._pieces(text) if self.added_at and self.added_at.search(text) else [text]
            rows.append(row)
            pieces += [self.normalised(p) for p in row if isinstance(p, str)]
        encoded = (ids for a, b in text_groups(pieces) for ids in self._encode_chunk(pieces[a:b]))
        for row in rows:
            parts = [next(encoded) if isinstance(p, str) else np.array([p], np.int32) for p in row]
            yield parts[0] if len(parts) == 1 else np.concatenate(parts)

    def _pieces(self, text: str) -> list[str | int]:
        """Ordinary text and the ids of added tokens, alternating."""
        out: list[str | int] = []
        at = 0
        for m in self.added_at.finditer(text):
            out += [text[at:m.start()], self.added[m.group()]]
            at = m.end()
        return [*out, text[at:]]

    def _encode_chunk(self, texts: list[str]) -> list[np.ndarray]:
        if not hasattr(self, "words"):
            self.words = WordTable(self.encode_words)
        joined = "".join(texts)
        offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64)))
        cp = code_points(joined)
        starts, ends = split_dropping_space(cp, offsets)
        slots = self.words.lookup(joined, cp, starts, ends)
        ids, lengths = self.words.gather(slots)
        by_word = np.concatenate(([0], np.cumsum(lengths)))
        bounds = by_word[np.searchsorted(starts, offsets)]
        return [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


_LOADED: dict[str, WordBPE] = {}


def loaded(path: str) -> WordBPE:
    """The tokenizer of a file, read once per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = WordBPE(path)
    return _LOADED[path]


def _list_array(arrays: list[np.ndarray]) -> pa.ListArray:
    lengths = [len(a) for a in arrays]
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)),
                                    pa.array(flat.astype(np.int32)))


def _mapped(df: DataFrame, columns: list[str], schema: T.StructType, rows) -> DataFrame:
    """``rows(batch)`` yields the new columns' arrays for slices of a batch."""
    ship(df.sparkSession)
    names = schema.names

    def run(batches):
        for batch in batches:
            at = 0
            for n, arrays in rows(batch):
                kept = batch.slice(at, n)
                at += n
                yield pa.RecordBatch.from_arrays([*kept.columns[:len(names) - len(arrays)], *arrays], names)

    return df.select(*columns).mapInArrow(run, schema)


def _fields(df: DataFrame, keep: list[str], *new: T.StructField) -> T.StructType:
    return T.StructType([*(df.schema[c] for c in keep), *new])


def roundtrip(df: DataFrame, keep: list[str], text_col: str = "text", path: str | None = None) -> DataFrame:
    """``keep``, ``ids`` (array<int>) and ``decoded`` (string) of every row:
    texts encoded, and those ids decoded again, in one pass."""
    path = path or tokenizer_path()
    schema = _fields(df, keep, T.StructField("ids", T.ArrayType(T.IntegerType(), False), False),
                     T.StructField("decoded", T.StringType(), False))

    def rows(batch):
        bpe = loaded(path)
        for a, b, texts in text_chunks(batch.column(batch.num_columns - 1)):
            ids = list(bpe.encode_texts(texts))
            yield b - a, [_list_array(ids), pa.array([bpe.decode(i.tolist()) for i in ids], pa.string())]

    return _mapped(df, [*keep, text_col], schema, rows)


def encode(df: DataFrame, keep: list[str], text_col: str = "text", path: str | None = None) -> DataFrame:
    """``keep`` and ``ids`` (array<int>) of every row."""
    path = path or tokenizer_path()
    schema = _fields(df, keep, T.StructField("ids", T.ArrayType(T.IntegerType(), False), False))

    def rows(batch):
        bpe = loaded(path)
        for a, b, texts in text_chunks(batch.column(batch.num_columns - 1)):
            yield b - a, [_list_array(list(bpe.encode_texts(texts)))]

    return _mapped(df, [*keep, text_col], schema, rows)


def decode(df: DataFrame, keep: list[str], ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """``keep`` and ``decoded`` (string) of every row of ids; null ids count
    as none."""
    path = path or tokenizer_path()
    schema = _fields(df, keep, T.StructField("decoded", T.StringType(), False))

    def rows(batch):
        bpe = loaded(path)
        ids = batch.column(batch.num_columns - 1).to_pylist()
        yield len(ids), [pa.array([bpe.decode(i or []) for i in ids], pa.string())]

    return _mapped(df, [*keep, ids_col], schema, rows)


def digests(coded: DataFrame, keep: list[str]) -> DataFrame:
    """Token count and SHA-256 digests of ids and decoded text."""
    return coded.select(
        *keep, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: every whole text of ``documents`` encoded and decoded."""
    docs = table(spark, sf_dir, "documents")
    return digests(roundtrip(docs, ["doc_id"]), ["doc_id"])


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the encoding of every document that is left."""
    return digests(roundtrip(docs, ["doc_id"]), ["doc_id"])
