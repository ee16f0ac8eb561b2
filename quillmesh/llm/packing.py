"""Packing of token ids into fixed windows by minimum bin slack (operator 5).

A document of more than a window gives whole windows; what remains of each document goes to a pool. A bin takes the
longest remainder and then, by a subset-sum dynamic program over the multiset of remaining lengths (a bitset of the
sums that can be reached after each length, so many copies of it), the subset whose sum is closest to the rest of the
window; the counts are read back from the last bitset to the first. Where no subset fills the window exactly, another
remainder is cut to fill it, as cutting is free. What is left when a task ends (less than a window) is dealt to
sequences whose lengths are powers of two, which need no padding either.

Each task packs the documents of its own input split: no shuffle, memory bounded by the pool, and a lost task is
repeated alone with the same result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame

from quillmesh.llm.common import map_batches, texts_of
from quillmesh.llm.word_tokens import word_tokens

#: Remainders in the pool before bins are filled, and after.
FULL, LOW = 512, 256


def closest_subset(counts: dict[int, int], capacity: int) -> tuple[int, dict[int, int]]:
    """(sum, {length: copies}) of the sub-multiset of counts whose sum is the largest up to capacity. Lengths are
    taken from the longest; the search ends early when the capacity itself is reached."""
    within = (1 << (capacity + 1)) - 1
    reach, layers = 1, []
    for length in sorted((x for x in counts if 0 < x <= capacity), reverse=True):
        layers.append((length, counts[length], reach))
        left, block = min(counts[length], capacity // length), 1
        while left:  # binary splitting of the copies
            take = min(block, left)
            reach |= (reach << (take * length)) & within
            left, block = left - take, block * 2
        if reach >> capacity & 1:
            break
    best = rest = reach.bit_length() - 1
    chosen = {}
    for length, copies, before in reversed(layers):
        k = next(k for k in range(copies + 1) if rest >= k * length and before >> (rest - k * length) & 1)
        if k:
            chosen[length] = k
            rest -= k * length
    return best, chosen


class Packer:
    """Pieces are (tag, start, ids); rows come out as (tag, start, ids, sequence, offset)."""

    def __init__(self, window: int, first_sequence: int = 0):
        self.window, self.sequence = window, first_sequence
        self.pool: dict[int, list[tuple]] = {}
        self.counts: Counter = Counter()

    def _put(self, piece: tuple) -> None:
        n = len(piece[2])
        if n:
            self.pool.setdefault(n, []).append(piece)
            self.counts[n] += 1

    def _take(self, length: int) -> tuple:
        piece = self.pool[length].pop()
        self.counts[length] -= 1
        if not self.counts[length]:
            del self.counts[length], self.pool[length]
        return piece

    def _emit(self, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for tag, start, ids in pieces:
            yield tag, start, ids, self.sequence, offset
            offset += len(ids)
        self.sequence += 1

    def add(self, tag: object, ids: np.ndarray) -> Iterator[tuple]:
        whole = len(ids) // self.window * self.window
        for k in range(0, whole, self.window):
            yield from self._emit([(tag, k, ids[k : k + self.window])])
        self._put((tag, whole, ids[whole:]))
        if sum(self.counts.values()) > FULL:
            yield from self._fill(LOW)

    def _fill(self, least: int) -> Iterator[tuple]:
        while sum(self.counts.values()) > least and sum(n * k for n, k in self.counts.items()) >= self.window:
            pieces = [self._take(max(self.counts))]
            room = self.window - len(pieces[0][2])
            total, chosen = closest_subset(self.counts, room)
            pieces += [self._take(n) for n, k in chosen.items() for _ in range(k)]
            if room > total:  # no subset fits exactly, so every piece left is longer than the slack
                tag, start, ids = self._take(min(self.counts))
                cut = room - total
                pieces.append((tag, start, ids[:cut]))
                self._put((tag, start + cut, ids[cut:]))
            yield from self._emit(pieces)

    def close(self) -> Iterator[tuple]:
        yield from self._fill(0)
        total = sum(n * k for n, k in self.counts.items())
        left = [self._take(n) for n in sorted(self.counts.elements(), reverse=True)]
        while total:
            size = 1 << (total.bit_length() - 1)
            pieces, room = [], size
            while room:
                tag, start, ids = left.pop()
                pieces.append((tag, start, ids[:room]))
                if len(ids) > room:
                    left.append((tag, start + room, ids[room:]))
                room -= len(pieces[-1][2])
            yield from self._emit(pieces)
            total -= size


def pack(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    special: dict[str, int] | None = None,
    end_id: int = 1,
    window: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """A row for each piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset. A null or empty text is its
    end id alone; repeated rows are packed one by one; a null id stays null; an empty table gives no rows; other
    columns are dropped. Sequence ids are unique over the job: the partition in the upper bits, then a counter."""
    if window & (window - 1):
        raise ValueError("window must be a power of two")
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        words = word_tokens(vocabulary, pattern, special)
        packer = Packer(window, TaskContext.get().partitionId() << 40)

        def columns(rows):
            out = list(zip(*rows))
            if not out:
                return None
            tags, starts, ids, sequences, offsets = out
            return {
                id_col: [t[0] for t in tags], "start": starts, "length": list(map(len, ids)),
                "ids_crc32": [zlib.crc32(i.astype("<u4").tobytes()) for i in ids], "doc_tokens": [t[1] for t in tags],
                "sequence_id": sequences, "offset": offsets,
            }

        try:
            for b in batches:
                rows = []
                for key, text in zip(b.column(0).to_pylist(), texts_of(b.column(1))):
                    ids = np.append(words.ids(text), np.uint32(end_id))
                    rows.extend(packer.add((key, len(ids)), ids))
                if (c := columns(rows)) is not None:
                    yield c
            if (c := columns(packer.close())) is not None:
                yield c
        finally:
            words.release()

    schema = f"{id_col} {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return map_batches(docs.select(id_col, text_col), run, schema)
