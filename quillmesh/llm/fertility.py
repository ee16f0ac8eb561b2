"""Quality rules with tokeniser fertility (operator 1).

A public byte-level vocabulary measures each text: characters per token, the share of tokens that hold only a fragment
of a character (byte fallback) and the entropy of the tokens. Text of the languages that a vocabulary knows stays in a
band; markup, encoded data, keyboard noise and endless repetition leave it. Bands are given per script (or per language
where a text's language has one), so a script that the vocabulary covers badly isn't rejected for it.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from math import log2

import numpy as np
from pyspark.sql import DataFrame

from quillmesh.llm.common import ASCII_SPACE, map_batches, texts_of
from quillmesh.llm.word_tokens import word_tokens

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Band:
    """Characters per token from low to high; at most byte_share fragments; at least entropy bits a token, or
    entropy_share of the most that so many tokens could have if that is less."""

    low: float
    high: float
    byte_share: float
    entropy: float = 4.0
    entropy_share: float = 0.45


#: First code point of a block, and its script.
BLOCKS = [
    (0x0, "latin"), (0x250, "other"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "other"), (0x590, "hebrew"), (0x600, "arabic"),
    (0x780, "other"), (0x900, "indic"), (0xE00, "thai"), (0xE80, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x3040, "cjk"), (0xA000, "other"), (0xAC00, "cjk"), (0xD7B0, "other"), (0xF900, "cjk"), (0xFB00, "other"), (0x20000, "cjk"), (0x30000, "other"),
]
SCRIPTS = ["latin", "greek", "cyrillic", "hebrew", "arabic", "indic", "thai", "cjk", "other"]
#: Rejection bands by script. They hold for texts of every length, and are wider by the sampling error of so many tokens.
BANDS = {
    "latin": Band(2.0, 9.0, 0.25), "greek": Band(0.6, 6.0, 0.6), "cyrillic": Band(0.6, 6.0, 0.6), "hebrew": Band(0.5, 5.0, 0.8),
    "arabic": Band(0.5, 5.0, 0.8), "indic": Band(0.3, 5.0, 0.95), "thai": Band(0.3, 5.0, 0.95), "cjk": Band(0.3, 3.5, 0.95), "other": Band(0.25, 12.0, 0.98),
}

_STARTS = np.array([b for b, _ in BLOCKS], np.uint32)
_SCRIPT = np.array([SCRIPTS.index(s) for _, s in BLOCKS])
_BREAKS = str.maketrans("", "", ASCII_SPACE)


def in_band(band: Band, size: int, per: float, share: float, entropy: float) -> bool:
    """The verdict on a text of size tokens; one standard error is allowed (of a token's characters, the error is taken
    to be their mean), so short texts aren't judged by chance and there is no length from which other rules hold."""
    if not size:
        return False
    error = size**-0.5
    fragments = band.byte_share + error * (band.byte_share * (1 - band.byte_share)) ** 0.5
    return band.low * (1 - error) <= per <= band.high * (1 + error) and share <= fragments and entropy >= min(band.entropy, band.entropy_share * log2(size))


def script_of(text: str) -> str:
    """The script of most letters beyond ASCII if these outnumber the ASCII letters, else Latin."""
    if text.isascii():
        return "latin"
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    wide = codes[codes > 127]
    counts = np.bincount(_SCRIPT[np.searchsorted(_STARTS, wide, "right") - 1], minlength=len(SCRIPTS))
    counts[0] += int(((codes | 32) - 97 < 26).sum())
    return SCRIPTS[int(counts.argmax())]


def repeated_words(words: list, window: int = 5) -> int:
    """Words that lie in a window found twice or more in the text."""
    grams = list(zip(*(words[k:] for k in range(window))))
    if len(set(grams)) == len(grams):
        return 0
    counts = Counter(grams)
    hit = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(np.fromiter((counts[g] > 1 for g in grams), bool, len(grams)))
    np.add.at(hit, at, 1)
    np.add.at(hit, at + window, -1)
    return int((np.cumsum(hit) > 0).sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [x for x in text.split("\n") if x.strip(ASCII_SPACE)]
    return len(words), len(text.translate(_BREAKS)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


def quality(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    bands: dict[str, Band] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str | None = None,
) -> DataFrame:
    """A row for each row of docs, without a shuffle: the base counts, base_failed, n_tokens, chars_per_token,
    byte_share, entropy, script, and kept (false if base_failed or out of the band of its language or else script).
    bands: by language (looked up in lang_col) or script. A null text has no words, so it fails the base rules, as an
    empty one does; null ids and repeated rows give a row each; other columns are dropped."""
    bands = BANDS if bands is None else bands
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        table = word_tokens(vocabulary, pattern)
        fragment = np.zeros(max(table.ranks.values()) + 1, bool)
        for token, rank in table.ranks.items():
            try:
                token.decode()
            except UnicodeDecodeError:
                fragment[rank] = True
        for b in batches:
            texts = texts_of(b.column(1))
            langs = b.column(2).to_pylist() if lang_col else [None] * len(texts)
            rows = []
            for text, lang in zip(texts, langs):
                n, chars, symbols, dups, repeats = base_counts(text)
                failed = n < 10 or 100 * repeats > 20 * n
                ids = table.ids(text)
                size = len(ids)
                share = float(fragment[ids].mean()) if size else 0.0
                counts = np.unique(ids, return_counts=True)[1]
                entropy = float(log2(size) - (counts * np.log2(counts)).sum() / size) if size else 0.0
                script = script_of(text)
                band = bands.get(lang) or bands.get(script) or BANDS["other"]
                per = len(text) / size if size else 0.0
                good = in_band(band, size, per, share, entropy)
                rows.append((n, chars, symbols, dups, repeats, failed, size, per, share, entropy, script, not failed and good))
            names = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed n_tokens chars_per_token byte_share entropy script kept".split()
            yield {id_col: b.column(0)} | dict(zip(names, zip(*rows) if rows else [[]] * len(names)))

    schema = (
        f"{id_col} {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
        "n_tokens long, chars_per_token double, byte_share double, entropy double, script string, kept boolean"
    )
    return map_batches(docs.select(id_col, text_col, *[lang_col] * bool(lang_col)), run, schema)
