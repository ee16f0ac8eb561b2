"""Token counts by a compiled finite-state transducer (operator 9).

The vocabulary is a BPE over characters with byte fallback, whose pieces carry the blank mark only at their front. Its
greedy merges have two properties that make it a deterministic transducer: a run of neighbouring tokens of an encoding
is the encoding of its own string, and a row of tokens is an encoding if and only if each neighbouring pair is. So the
last token of every prefix is unique, and it follows from the last tokens at the positions where a vocabulary piece may
still have begun. A state holds those positions' pieces, last tokens and counts relative to the newest one; a
transition reads one character and emits the (possibly negative) change of the token count. States and transitions are
compiled on first use and kept. A character outside the vocabulary emits its UTF-8 bytes and resets the state, and so
does a blank after another character, as no piece reaches over it.

A text is cut into chunks, and each chunk is a map from the state in which it is entered to the state in which it is
left and the tokens between. Up to the first reset in a chunk a map depends on the entry state; from there on all entry
states agree. A chunk is evaluated for the states in which it may be entered: what the chunk before it leaves behind its
last reset, or, behind a chunk without one, the states to which the machine settles over the characters before the
border from a number of starts. Maps compose by looking up what one leaves in the next one, and a prefix scan composes
them; a state that wasn't foreseen is evaluated when it comes up, so the counts are exact in any case.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.llm.common import map_batches, texts_of

MARK = "▁"
#: Characters in a chunk, words and states that are kept, and the longest kept word.
CHUNK, KEPT, STATES, LONG = 4096, 200_000, 250_000, 64
#: Characters over which states settle, starts that are tried, and characters after which equal states are merged.
SETTLE, STARTS, MERGE = 96, 12, 256
#: What of a chunk depends on its entry state: blanks that may go on a run of them, and what follows.
_HEAD, _WORDS = re.compile(f"{MARK}*[^{MARK}]*"), re.compile(f"{MARK}+[^{MARK}]*")


class PieceTransducer:
    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(model.get_piece_size())]
        self.scores = {model.id_to_piece(i): model.get_score(i) for i, s in enumerate(special) if not s}
        if any(MARK in p.lstrip(MARK) for p in self.scores):
            raise ValueError("a piece reaches over the front of a word; its texts can't be cut at blanks")
        self.inner = {p[:k] for p in self.scores for k in range(1, len(p))}
        self.words: dict[str, int] = {}
        self._clear()

    def _clear(self) -> None:
        """Compiled states are only a cache; a worker drops them when they have grown large."""
        self.valid: dict[tuple[str, str], bool] = {}
        self.states: dict[tuple, int] = {}
        self.live: list[tuple] = []
        self.blank: list[bool] = []  # whether the last character was a blank
        self.next: list[dict[str, tuple[int, int]]] = []
        self.tails: dict[str, tuple[int, int]] = {}
        self.start = self._state((("", None, 0),), False)

    def greedy(self, text: str) -> list[str]:
        """The merges by definition: the best-scored neighbouring pair first, the leftmost of equals."""
        parts = list(text)
        while True:
            pairs = [(self.scores[a + b], -k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.scores]
            if not pairs:
                return parts
            k = -max(pairs)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    def _fits(self, last: str | None, piece: str) -> bool:
        key = (last or "", piece)
        if (known := self.valid.get(key)) is None:
            known = self.valid[key] = self.greedy((last or "") + piece) == ([last] if last else []) + [piece]
        return known

    def _state(self, live: tuple, blank: bool) -> int:
        if (live, blank) not in self.states:
            self.states[live, blank] = len(self.live)
            self.live.append(live)
            self.blank.append(blank)
            self.next.append({})
        return self.states[live, blank]

    def _compile(self, state: int, char: str) -> tuple[int, int]:
        """live: (piece begun, last token before it, its count less the newest count), the longest piece first."""
        if char not in self.scores:
            step = self.start, len(char.encode("utf-8", "surrogatepass"))
        else:
            live = self.live[self.start if char == MARK and not self.blank[state] else state]
            token, change = next((b + char, d + 1) for b, last, d in live if b + char in self.scores and self._fits(last, b + char))
            kept = tuple((b + char, last, d - change) for b, last, d in live if b + char in self.inner)
            step = self._state((*kept, ("", token, 0)), char == MARK), change
        self.next[state][char] = step
        return step

    def run(self, text: str, state: int | None = None) -> tuple[int, int]:
        """(the state after a text, its tokens) from a state, else from the start."""
        state, count = self.start if state is None else state, 0
        for char in text:
            step = self.next[state].get(char) or self._compile(state, char)
            state, count = step[0], count + step[1]
        return state, count

    def run_all(self, text: str, states: Iterable[int]) -> dict[int, tuple[int, int]]:
        """run() for each of some states; those that have become equal go on as one."""
        found = {s: (s, 0) for s in states}
        for k in range(0, len(text), MERGE):
            part = text[k : k + MERGE]
            steps = {s: self.run(part, s) for s in {s for s, _ in found.values()}}
            found = {entry: (steps[s][0], n + steps[s][1]) for entry, (s, n) in found.items()}
        return found

    def word(self, word: str) -> int:
        """Tokens of a word after one blank."""
        if (n := self.words.get(word)) is None:
            n = self.run(MARK + word)[1]
            if len(word) <= LONG:
                if len(self.words) >= KEPT:
                    self.words.clear()
                self.words[word] = n
        return n

    def tail(self, word: str) -> tuple[int, int]:
        """run() of the blanks and characters after the last reset of a chunk."""
        if (found := self.tails.get(word)) is None:
            found = self.run(word)
            if len(word) <= LONG:
                if len(self.tails) >= KEPT:
                    self.tails.clear()
                self.tails[word] = found
        return found

    def chunk_map(self, marked: str) -> ChunkMap:
        cut = _HEAD.match(marked).end()
        if cut == len(marked):
            return ChunkMap(self, marked, None)
        words = marked[cut + 1 :].split(MARK)
        if "" in words:
            *whole, last = _WORDS.findall(marked[cut:])
            count = sum(self.word(w[1:]) if w[1:2] != MARK else self.run(w)[1] for w in whole)
        else:
            last = MARK + words.pop()
            known = list(map(self.words.get, words))
            if None in known:
                known = [self.word(w) if n is None else n for w, n in zip(words, known)]
            count = sum(known)
        state, more = self.tail(last)
        return ChunkMap(self, marked[:cut], (state, count + more))

    def foresee(self, maps: list[ChunkMap], marked: str, chunk: int) -> None:
        """Evaluates each map for the states in which it may be entered."""
        maps[0].evaluate([self.start])
        for k in range(1, len(maps)):
            if (left := maps[k - 1].rest) is not None:
                maps[k].evaluate([left[0]])
            else:
                border = k * chunk
                froms = range(max(0, border - SETTLE), max(1, border - SETTLE + STARTS))
                maps[k].evaluate({self.run(marked[a:border])[0] for a in froms if a < border})

    @staticmethod
    def scan(maps: list) -> list:
        """Inclusive prefix scan: log2(n) rounds, and the compositions of a round don't depend on each other."""
        step = 1
        while step < len(maps):
            maps = [Composed(maps[k - step], m) if k >= step else m for k, m in enumerate(maps)]
            step *= 2
        return maps

    def count(self, text: str, chunk: int = CHUNK) -> int:
        """Tokens of a whole text, with the blank mark that the library puts before it."""
        if not text:
            return 0
        if len(self.live) > STATES:
            self._clear()
        marked = MARK + text.replace(" ", MARK)
        maps = [self.chunk_map(marked[k : k + chunk]) for k in range(0, len(marked), chunk)]
        self.foresee(maps, marked, chunk)
        return self.scan(maps)[-1].at(self.start)[1]


class ChunkMap:
    """Entry state to (exit state, tokens). head: up to the first reset; rest: the exit state and the tokens from there
    on, which no entry state changes; None without a reset."""

    def __init__(self, machine: PieceTransducer, head: str, rest: tuple[int, int] | None):
        self.machine, self.head, self.rest, self.table = machine, head, rest, {}

    def evaluate(self, states: Iterable[int]) -> None:
        for entry, (state, count) in self.machine.run_all(self.head, [s for s in states if s not in self.table]).items():
            self.table[entry] = (state, count) if self.rest is None else (self.rest[0], count + self.rest[1])

    def at(self, state: int) -> tuple[int, int]:
        if state not in self.table:
            self.evaluate([state])
        return self.table[state]


class Composed:
    """The map of two neighbouring chunks (or rows of them), for the entry states that the first one knows."""

    def __init__(self, first: ChunkMap | Composed, second: ChunkMap | Composed):
        self.first, self.second = first, second
        self.table = {s: self._through(s) for s in first.table}

    def _through(self, state: int) -> tuple[int, int]:
        between, count = self.first.at(state)
        left, more = self.second.at(between)
        return left, count + more

    def at(self, state: int) -> tuple[int, int]:
        if state not in self.table:
            self.table[state] = self._through(state)
        return self.table[state]


_MACHINES: dict[str, PieceTransducer] = {}


def machine(model_file: str) -> PieceTransducer:
    """One compiled machine in a worker process."""
    if model_file not in _MACHINES:
        _MACHINES[model_file] = PieceTransducer(model_file)
    return _MACHINES[model_file]


def count_tokens(docs: DataFrame, model_file: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of each row, without a shuffle. A null text is empty: 0 bytes, 0 tokens.
    Repeated rows and null ids give a row each; other columns are dropped; an empty table gives an empty table."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        fst = machine(model_file)
        for b in batches:
            yield {id_col: b.column(0), "n_bytes": b.column(1), "n_tokens": np.array([fst.count(t) for t in texts_of(b.column(2))], np.int64)}

    rows = docs.select(F.col(id_col), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"), F.col(text_col))
    return map_batches(rows, run, f"{id_col} {kind}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
