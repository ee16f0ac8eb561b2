"""Exact byte-level BPE ids with a cache of words.

A pre-token of the byte-level BPE pattern never holds white space after another character, so a text may be cut before
every blank that has other characters than white space on both sides, and each cut piece has its own ids. Invented and
natural prose repeats its words, so most pieces come from a table. A text for which this doesn't hold (runs of white
space, special strings) is encoded whole by the library.
"""

from __future__ import annotations

import base64

import numpy as np


class WordTokens:
    """ids(text) for a .tiktoken vocabulary. special: string of special tokens to ids, matched inside texts."""

    def __init__(self, path: str, pattern: str, special: dict[str, int] | None = None, limit: int = 900_000):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.ranks, self.special, self.limit = ranks, special or {}, limit
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens=self.special)
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.starts, self.lengths, self.flat = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(8192, np.uint32)
        self.n, self.used, self.new_ids, self.new_lengths = 0, 0, [], []

    def _whole(self, text: str) -> np.ndarray:
        ids = self.encoding.encode(text, allowed_special="all") if self.special else self.encoding.encode_ordinary(text)
        return np.array(ids, np.uint32)

    def _add(self, word: str) -> int:
        if not word or word[0].isspace() or word[-1].isspace():
            self.index[word] = -1
            return -1
        ids = self.encoding.encode_ordinary(" " + word)
        self.new_ids += ids
        self.new_lengths.append(len(ids))
        self.index[word] = n = self.n
        self.n = n + 1
        return n

    def _grow(self) -> None:
        """Takes the words added since the last time into the arrays."""
        size, end = np.array(self.new_lengths, np.int64), self.used + len(self.new_ids)
        old = self.n - len(size)
        while end > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.n > len(self.starts):
            self.starts, self.lengths = (np.concatenate([a, np.zeros_like(a)]) for a in (self.starts, self.lengths))
        self.flat[self.used : end] = self.new_ids
        self.lengths[old : self.n] = size
        self.starts[old : self.n] = self.used + np.cumsum(size) - size
        self.used, self.new_ids, self.new_lengths = end, [], []

    def ids(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        if any(s in text for s in self.special):
            return self._whole(text)
        first, *words = text.split(" ")
        if not words or not first or first[-1].isspace():
            return self._whole(text)
        if len(self.index) > self.limit:
            self._clear()
        codes = list(map(self.index.get, words))
        if None in codes:
            get, add = self.index.get, self._add
            codes = [k if k is not None else add(w) if (n := get(w)) is None else n for k, w in zip(codes, words)]
            if self.new_lengths:
                self._grow()
        k = np.array(codes, np.int64)
        if k.min() < 0:
            return self._whole(text)
        size = self.lengths[k]
        ends = np.cumsum(size)
        rest = self.flat[np.repeat(self.starts[k] - (ends - size), size) + np.arange(ends[-1])]
        return np.concatenate([np.array(self.encoding.encode_ordinary(first), np.uint32), rest])


    def release(self) -> None:
        """Drops the words at the end of a task: worker processes outlive their stage, and a full table (some 300 MB)
        would stand beside all that they run later. The vocabulary stays."""
        self._clear()


_TABLES: dict[tuple, WordTokens] = {}


def word_tokens(path: str, pattern: str, special: dict[str, int] | None = None) -> WordTokens:
    """One table for each vocabulary in a worker process. Who fills it in a task calls release() at its end."""
    key = (path, tuple(sorted((special or {}).items())))
    if key not in _TABLES:
        _TABLES[key] = WordTokens(path, pattern, special)
    return _TABLES[key]
