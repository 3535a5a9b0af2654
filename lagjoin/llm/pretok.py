"""Vectorised pre-tokenisation on code points.

Both public tokenizers used here first split a text into words by a regular
expression over letters, numbers, white space and the rest.  That split
depends only on character classes, so it is computed for a whole chunk of
texts at once with array operations instead of one regex match per word.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable

import numpy as np

from lagjoin.llm.shared import ranges, span_hashes

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
#: The code points with Unicode's White_Space property.
_WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
          0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_CLASSES: list[np.ndarray] = []


def classes() -> np.ndarray:
    """Class of every code point."""
    if not _CLASSES:
        kinds = {"L": LETTER, "N": NUMBER}
        table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER)
                             for c in range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)
        table[_WHITE] = SPACE
        _CLASSES.append(table)
    return _CLASSES[0]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _contractions(cp: np.ndarray, cls: np.ndarray, heads: np.ndarray, row_end: np.ndarray,
                  breaks: np.ndarray) -> None:
    """Mark 's 't 're 've 'm 'll 'd as words of their own where an apostrophe
    in ``heads`` begins a word."""
    n = len(cp)
    padded = np.concatenate([cp, np.zeros(2, np.uint32)])
    a, b = padded[heads + 1], padded[heads + 2]
    one = np.isin(a, [ord(c) for c in "stmd"]) & (heads + 1 < row_end)
    two = (((a == ord("r")) | (a == ord("v"))) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
    two &= (heads + 2 < row_end) & ~one
    for hit, width in ((one, 2), (two, 3)):
        at = heads[hit]
        breaks[at + 1] = False
        after = at + width
        after = after[(after < n)]
        breaks[after] = True


def _row_ends(offsets: np.ndarray, at: np.ndarray) -> np.ndarray:
    return offsets[np.searchsorted(offsets, at, "right")]


def split_dropping_space(cp: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of 's|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+
    in each row (rows given by their offsets): starts and ends."""
    n = len(cp)
    if n == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cls = classes()[cp]
    breaks = np.empty(n, bool)
    breaks[0] = True
    np.not_equal(cls[1:], cls[:-1], out=breaks[1:])
    breaks |= cls == NUMBER
    breaks[offsets[:-1][offsets[:-1] < n]] = True
    quotes = np.flatnonzero((cp == ord("'")) & breaks)
    _contractions(cp, cls, quotes, _row_ends(offsets, quotes), breaks)
    starts = np.flatnonzero(breaks)
    ends = np.append(starts[1:], n)
    keep = cls[starts] != SPACE
    return starts[keep], ends[keep]


def split_keeping_space(cp: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of 's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+
    |\\s+(?!\\S)|\\s+ in each row: starts and ends; they cover every row."""
    n = len(cp)
    if n == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cls = classes()[cp]
    breaks = np.empty(n, bool)
    breaks[0] = True
    np.not_equal(cls[1:], cls[:-1], out=breaks[1:])
    heads = np.zeros(n, bool)
    heads[offsets[:-1][offsets[:-1] < n]] = True
    breaks |= heads
    # the last white-space character before other text leaves its run: a
    # blank joins what follows, any other stands alone
    after = np.flatnonzero(breaks[1:] & ~heads[1:] & (cls[:-1] == SPACE)) + 1
    breaks[after - 1] = True
    joined = after[cp[after - 1] == 0x20]
    breaks[joined] = False
    quotes = np.flatnonzero((cp == ord("'")) & breaks)
    _contractions(cp, cls, quotes, _row_ends(offsets, quotes), breaks)
    starts = np.flatnonzero(breaks)
    return starts, np.append(starts[1:], n)


class WordTable:
    """Token ids of words, kept by a 64-bit hash of the word.

    ``encode(words)`` gives a list of id lists for new words.  Hashes and the
    words' slots are sorted arrays, 16 bytes a word.  The table is emptied
    when it holds ``limit`` words, so memory stays bounded."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], limit: int = 600_000):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        self.keys = np.empty(0, np.uint64)
        self.slots = np.empty(0, np.int64)
        self.ids = np.empty(1 << 16, np.int32)
        self.start = np.zeros(1 << 14, np.int64)
        self.length = np.zeros(1 << 14, np.int64)
        self.used = 0
        self.serial = getattr(self, "serial", -1) + 1

    def _add(self, lists: list[list[int]]) -> np.ndarray:
        """Slots of new words with these ids."""
        first, count = len(self.slots), len(lists)
        while first + count > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.length = np.concatenate([self.length, np.zeros_like(self.length)])
        lengths = np.fromiter(map(len, lists), np.int64, count)
        flat = np.fromiter((i for ids in lists for i in ids), np.int32, int(lengths.sum()))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        self.ids[self.used:self.used + len(flat)] = flat
        self.start[first:first + count] = self.used + np.cumsum(lengths) - lengths
        self.length[first:first + count] = lengths
        self.used += len(flat)
        return np.arange(first, first + count)

    def lookup(self, text: str, cp: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Slot of every word of the chunk."""
        hashes, first, inverse = np.unique(span_hashes(cp, starts, ends),
                                           return_index=True, return_inverse=True)
        if len(self.keys) > self.limit:
            self.clear()
        place = np.searchsorted(self.keys, hashes)
        new = np.ones(len(hashes), bool)
        inside = np.flatnonzero(place < len(self.keys))
        new[inside] = self.keys[place[inside]] != hashes[inside]
        slots = np.empty(len(hashes), np.int64)
        slots[~new] = self.slots[place[~new]]
        if new.any():
            at = first[new]
            slots[new] = self._add(self.encode([text[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())]))
            self.keys = np.insert(self.keys, place[new], hashes[new])
            self.slots = np.insert(self.slots, place[new], slots[new])
        return slots[inverse]

    def gather(self, word_slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words in order, and how many each word has."""
        lengths = self.length[word_slots]
        return self.ids[ranges(self.start[word_slots], lengths)], lengths
