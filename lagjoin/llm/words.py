"""Token ids of words, kept in arrays and found by a 64-bit hash.

Most words of a chunk are known ones, so looking them up is what encoding a
corpus costs.  The table here is open-addressed and probed for all words of a
chunk at once; only words met for the first time are sorted and encoded.

Words are told apart by a 64-bit hash.  A table holds at most ``max_words``
words and about ``max_ids`` ids (plus one chunk's new words) and is then
emptied, so memory is bounded and a result never depends on what was met
before.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import tiktoken

from lagjoin.llm.shared import ranges, span_hashes

#: Longer words, in bytes, take the encoder whose time grows with n log n.
LONG_WORD = 1_000


class HashedWords:
    """``encode(words)`` gives the id lists of new words and, for each,
    whether its tokens spell the word."""

    def __init__(self, encode: Callable[[list[str]], tuple[list[list[int]], np.ndarray]],
                 max_words: int = 400_000, max_ids: int = 4_000_000):
        self.encode, self.max_words, self.max_ids = encode, max_words, max_ids
        self._clear()

    def _clear(self) -> None:
        self.keys, self.slots = np.zeros(1 << 16, np.uint64), np.zeros(1 << 16, np.int32)
        self.ids = np.empty(1 << 16, np.int32)
        self.start, self.length = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.spelt = np.zeros(1 << 14, bool)
        self.count = self.used = 0

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Slot of each hash, -1 where it is not in the table."""
        mask = np.uint64(len(self.keys) - 1)
        out = np.full(len(hashes), -1, np.int64)
        at = (hashes & mask).astype(np.int64)
        found = self.keys[at]
        hit = found == hashes
        out[hit] = self.slots[at[hit]]
        live = np.flatnonzero(~hit & (found != 0))
        at = at[live]
        while len(live):
            at = (at + 1) & int(mask)
            found, want = self.keys[at], hashes[live]
            hit = found == want
            out[live[hit]] = self.slots[at[hit]]
            going = ~hit & (found != 0)
            live, at = live[going], at[going]
        return out

    def _place(self, hashes: np.ndarray, slots: np.ndarray) -> None:
        """Put new, distinct hashes into the table."""
        mask = len(self.keys) - 1
        at = (hashes & np.uint64(mask)).astype(np.int64)
        while len(hashes):
            free = self.keys[at] == 0
            self.keys[at[free]] = hashes[free]
            won = free & (self.keys[at] == hashes)
            self.slots[at[won]] = slots[won]
            hashes, slots, at = hashes[~won], slots[~won], (at[~won] + 1) & mask

    def _add(self, hashes: np.ndarray, lists: list[list[int]], spelt: np.ndarray) -> None:
        count = len(lists)
        lengths = np.fromiter(map(len, lists), np.int64, count)
        flat = np.fromiter((i for ids in lists for i in ids), np.int32, int(lengths.sum()))
        first, self.count = self.count, self.count + count
        while self.count > len(self.start):
            self.start, self.length, self.spelt = (np.concatenate([x, np.zeros_like(x)])
                                                   for x in (self.start, self.length, self.spelt))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        self.ids[self.used:self.used + len(flat)] = flat
        self.start[first:self.count] = self.used + np.cumsum(lengths) - lengths
        self.length[first:self.count] = lengths
        self.spelt[first:self.count] = spelt
        self.used += len(flat)
        if 2 * self.count > len(self.keys):
            old, kept = self.keys[self.keys != 0], self.slots[self.keys != 0]
            size = len(self.keys)
            while 2 * self.count > size:
                size *= 4
            self.keys, self.slots = np.zeros(size, np.uint64), np.zeros(size, np.int32)
            self._place(old, kept)
        self._place(hashes, np.arange(first, self.count, dtype=np.int32))

    def lookup(self, text: str, cp: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Slot of every word of a chunk, valid until the next call."""
        if self.count > self.max_words or self.used > self.max_ids:
            self._clear()
        hashes = np.maximum(span_hashes(cp, starts, ends), np.uint64(1))
        out = self._find(hashes)
        missing = np.flatnonzero(out < 0)
        if len(missing):
            new, first, inverse = np.unique(hashes[missing], return_index=True, return_inverse=True)
            at = missing[first]
            words = [text[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())]
            out[missing] = self.count + inverse
            self._add(new, *self.encode(words))
        return out

    def gather(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words in order, and how many each word has."""
        lengths = self.length[slots]
        return self.ids[ranges(self.start[slots], lengths)], lengths


def piece_encoder(ranks: dict[bytes, int]) -> Callable[[bytes], list[int]]:
    """Byte-pair encoder of single words over tokens whose ids rise in the
    order of their merges."""
    core = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe
    return core.encode_single_piece
