"""Benchmark decontamination: rare n-gram seeds, a join, then local alignment (operator 10).

1. Items are cut into parts of a bounded length, and each part's word n-grams are its seeds. Their hashes, and those of
   the items' words, set the bits of a filter of a bounded size.
2. One scan of the documents, whatever the size of the benchmark, passes each n-gram through the filter and writes the
   regions around the hits, once for equal texts of a task: hashes of words that items have, 0 for others.
3. Hits are counted over all regions, and the rare seeds of each part are chosen: those that few regions have, and in
   each stretch of neighbouring seeds the rarest one, so a passage that leaked widely has seeds too. So a copy is found
   if it holds STRETCH + n - 1 words of the part in a row, or any n that are rare, or the part has few seeds.
4. Regions meet parts by a join on rare seeds. All seeds of such a pair then make windows, and a window whose words allow
   a copy is scored by a Smith-Waterman alignment with its part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.llm.common import map_batches, mix64, normal_word, stored, texts_of

U = np.uint64
#: Words in a part of an item and in the overlap of two; regions longer than this are cut.
PART, OVERLAP, REGION = 512, 256, 8192
#: Seeds of which one at least is chosen; a part of so few seeds keeps all; a seed in so many regions, or in such a
#: share of them, is rare.
STRETCH, FEW, RARE, RARE_SHARE = 3, 16, 20, 0.001
#: Bits of the filter for each of its hashes, and the most it may have (32 MB): beyond that more n-grams pass it, and
#: the join drops them.
BITS_EACH, MOST_BITS = 32, 1 << 28
KEPT, KEPT_WINDOWS = 300_000, 100_000


class Words:
    """Hashes of the words of texts, in letter case and punctuation alike; tokens without letters or digits are left out."""

    def __init__(self):
        self.kept: dict[str, int] = {}

    def _add(self, token: str) -> int:
        word = normal_word(token)
        code = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) if word else 0
        self.kept[token] = code = code - (1 << 64) if code >> 63 else code
        return code

    def hashes(self, text: str) -> np.ndarray:
        tokens = text.split()
        if len(self.kept) > KEPT:
            self.kept.clear()
        get, add = self.kept.get, self._add
        row = np.array([add(t) if (h := get(t)) is None else h for t in tokens], np.int64)
        return row[row != 0]


def codes(row: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams of a row of word hashes."""
    if len(row) < n:
        return np.zeros(0, np.int64)
    out = np.full(len(row) - n + 1, n, U)
    for k in range(n):
        out = mix64(out * U(0x9E3779B97F4A7C15) + row[k : len(row) - n + 1 + k].view(U))
    return out.view(np.int64)


def seeds_of(row: np.ndarray, n: int) -> np.ndarray:
    """A part's seeds by their place; a part of fewer than n words is one seed."""
    return codes(row, min(n, max(len(row), 1)))


class Filter:
    """Bits of a power of two; a hash that was added is always found."""

    def __init__(self, words: np.ndarray):
        self.words, self.mask = words, U(len(words) * 64 - 1)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes.view(U) & self.mask
        return (self.words[(at >> U(6)).astype(np.int64)] >> (at & U(63))) & U(1) == 1


def parts_of(items: DataFrame, n: int, item_col: str) -> DataFrame:
    """(part, item, row, seeds) of items (item, text): equal items once."""
    kind = items.schema[item_col].dataType.simpleString()

    def run(batches):
        words = Words()
        for b in batches:
            out = []
            for item, text in zip(b.column(0).to_pylist(), texts_of(b.column(1))):
                row = words.hashes(text)
                for k in range(0, max(1, len(row) - OVERLAP), PART - OVERLAP) if len(row) else ():
                    own = row[k : k + PART]
                    name = hashlib.blake2b(repr((item, k, text)).encode("utf-8", "surrogatepass"), digest_size=8).digest()
                    out.append((int.from_bytes(name, "little", signed=True), item, own.tolist(), seeds_of(own, n).tolist()))
            if out:
                yield dict(zip(("part", "item", "row", "seeds"), zip(*out)))

    distinct = items.where("text is not null").select(item_col, "text").distinct()
    return map_batches(distinct, run, f"part long, item {kind}, row array<long>, seeds array<long>")


def filter_of(parts: DataFrame) -> Filter:
    """The filter of all seeds and words. Its words of 64 bits come to the driver: at most MOST_BITS / 64 rows."""
    hashes = parts.select(F.explode(F.concat("row", "seeds")).alias("h"))
    bits = 1 << 16
    while bits < min(BITS_EACH * hashes.count(), MOST_BITS):
        bits *= 2
    at = F.col("h").bitwiseAND(F.lit(bits - 1))
    found = hashes.select(F.shiftright(at, 6).alias("word"), at.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
    found = found.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toArrow()
    words = np.zeros(bits // 64, np.int64)
    words[found.column(0).to_numpy()] = found.column(1).to_numpy()
    return Filter(words.view(U))


def regions_of(places: np.ndarray, reach: int, size: int) -> Iterator[tuple[int, int]]:
    """[start, stop) around hits at these places, each hit with reach words on both sides; longer regions are cut, and
    the pieces overlap, so every hit has its reach in one of them."""
    starts, stops = np.maximum(places - reach, 0), np.minimum(places + reach + 1, size)
    first = np.flatnonzero(np.r_[True, starts[1:] > stops[:-1]])
    most = max(REGION, 8 * reach)
    for a, b in zip(starts[first].tolist(), stops[np.r_[first[1:] - 1, len(stops) - 1]].tolist()):
        while b - a > most:
            yield a, a + most
            a += most - 2 * reach - 1
        yield a, b


def _regions(docs: DataFrame, kind: str, broadcast, sizes: list[int], reach: int) -> DataFrame:
    """Rows of two kinds for documents (id, text) with hits: (key, id) of each, and the regions (key, start, row, places,
    codes) of each text that the task hasn't seen."""

    def run(batches):
        own, words, seen = broadcast.value, Words(), set()
        for b in batches:
            out = []
            for doc, text in zip(b.column(0).to_pylist(), texts_of(b.column(1))):
                row = words.hashes(text)
                found = [(places := np.flatnonzero(own.has(grams)), grams[places]) for n in sizes if len(grams := codes(row, n))]
                places, grams = (np.concatenate([f[k] for f in found]) for k in (0, 1)) if found else (row[:0], row[:0])
                if not len(places):
                    continue
                key = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()
                out.append((key, doc, None, None, None, None))
                if key in seen:
                    continue
                if len(seen) > 1_000_000:
                    seen.clear()
                seen.add(key)
                order = np.argsort(places, kind="stable")
                places, grams = places[order], grams[order]
                for a, z in regions_of(places, reach, len(row)):
                    inside = slice(*np.searchsorted(places, [a, z]).tolist())
                    part = row[a:z]
                    out.append((key, None, a, np.where(own.has(part), part, 0).tolist(), (places[inside] - a).tolist(), grams[inside].tolist()))
                    if len(out) > 512:
                        yield dict(zip(("key", "doc", "start", "row", "places", "codes"), zip(*out)))
                        out = []
            if out:
                yield dict(zip(("key", "doc", "start", "row", "places", "codes"), zip(*out)))

    return map_batches(docs, run, f"key binary, doc {kind}, start long, row array<long>, places array<int>, codes array<long>")


def chosen(counts: np.ndarray, limit: float) -> np.ndarray:
    """Which seeds of a part are used, from how many regions have each, in their order."""
    keep = (counts <= limit) | (len(counts) <= FEW)
    if len(counts) > FEW:
        rarest = np.lib.stride_tricks.sliding_window_view(counts, STRETCH).argmin(1) + np.arange(len(counts) - STRETCH + 1)
        keep[rarest] = True
    return keep


def rare_seeds(parts: DataFrame, hits: DataFrame, limit: float) -> DataFrame:
    """(code, part) of the seeds to join on. hits: (code, n), of the hashes that passed the filter."""
    seeds = parts.select("part", F.posexplode("seeds").alias("place", "code"))
    counted = seeds.join(hits, "code", "left").groupBy("part").agg(F.sort_array(F.collect_list(F.struct("place", "code", F.coalesce("n", F.lit(0)).alias("n")))).alias("seeds"))

    def run(batches):
        for b in batches:
            out = []
            for part, seeds in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                keep = chosen(np.array([s["n"] for s in seeds], np.int64), limit)
                out += {(seeds[k]["code"], part) for k in np.flatnonzero(keep).tolist() if seeds[k]["n"]}
            if out:
                yield dict(zip(("code", "part"), zip(*out)))

    return map_batches(counted, run, "code long, part long")


def windows(diagonals: np.ndarray, size: int, slack: float) -> Iterator[tuple[int, int]]:
    """[start, stop) around the diagonals (place in the region less place in the part) of a part of that size; windows
    that overlap are one, and long ones are cut into overlapping pieces, so a table of scores has a bounded size."""
    room = int(size * slack) + 4
    one = size + 2 * room
    start = stop = None
    for d in np.unique(diagonals).tolist():
        if start is not None and d - room <= stop:
            stop = d + size + room
            continue
        if start is not None:
            yield from _pieces(start, stop, one)
        start, stop = d - room, d + size + room
    if start is not None:
        yield from _pieces(start, stop, one)


def _pieces(start: int, stop: int, one: int) -> Iterator[tuple[int, int]]:
    while stop - start > 4 * one:
        yield max(0, start), start + 4 * one
        start += 3 * one
    yield max(0, start), stop


def align(item: np.ndarray, window: np.ndarray, match: int = 2, mismatch: int = -1, gap: int = -1) -> tuple[int, int, int, int]:
    """Smith-Waterman with linear gaps: (score, matches, start, stop) of the best local alignment; start and stop are
    places in the window, the first of equals. A row of the table is computed at once: gaps along the window are a
    running maximum of the scores less the gap's slope."""
    steps = np.arange(len(window) + 1, dtype=np.int32)
    table = np.zeros((len(item) + 1, len(window) + 1), np.int32)
    for i, word in enumerate(item.tolist(), 1):
        before = table[i - 1]
        here = np.maximum(before + gap, 0)
        here[1:] = np.maximum(here[1:], before[:-1] + np.where(window == word, match, mismatch))
        table[i] = np.maximum.accumulate(here - gap * steps) + gap * steps
    best = int(table.max())
    if best <= 0:
        return 0, 0, 0, 0
    i, j = map(int, np.unravel_index(int(table.argmax()), table.shape))
    stop, matches = j, 0
    while i and j and table[i, j] > 0:
        same = window[j - 1] == item[i - 1]
        if table[i, j] == table[i - 1, j - 1] + (match if same else mismatch):
            matches, i, j = matches + bool(same), i - 1, j - 1
        elif table[i, j] == table[i - 1, j] + gap:
            i -= 1
        else:
            j -= 1
    return best, matches, j, stop


def is_copy(item: np.ndarray, window: np.ndarray, least: float, run: int, identity: float) -> tuple[float, int, int, int] | None:
    """(score share, matches, start, stop) if the alignment has that share of the item's best score, or run matches
    with that identity. The words in common bound the score, so most windows need no alignment."""
    if int(np.isin(item, window).sum()) < min(least * len(item), run):
        return None
    score, matches, start, stop = align(item, window)
    share = score / (2 * len(item))
    if share >= least or matches >= run and matches >= identity * (stop - start):
        return share, matches, start, stop
    return None


def _aligned(pairs: DataFrame, kind: str, n: int, slack: float, rule: tuple[float, int, float]) -> DataFrame:
    """(key, item, share, matches, first_word, last_word) of the windows of pairs (key, start, row, places, codes, part,
    item, own) that hold a copy."""

    def run(batches):
        known: dict = {}
        for b in batches:
            out = []
            key, start, row, places, grams, part, item, own = (b.column(k) for k in range(8))
            for k in range(b.num_rows):
                words, text = (np.array(c[k].values.to_numpy(), np.int64) for c in (own, row))
                seeds = seeds_of(words, n)
                order = np.argsort(seeds, kind="stable")
                hit, at = (c[k].values.to_numpy() for c in (grams, places))
                low, high = np.searchsorted(seeds[order], hit, "left"), np.searchsorted(seeds[order], hit, "right")
                times = high - low
                offset = order[np.repeat(low - (np.cumsum(times) - times), times) + np.arange(times.sum())]
                for a, z in windows(np.repeat(at, times).astype(np.int64) - offset, len(words), slack):
                    window = text[a : max(a, z)]
                    name = part[k].as_py(), hashlib.blake2b(window.tobytes(), digest_size=16).digest()
                    if name not in known:
                        if len(known) > KEPT_WINDOWS:
                            known.clear()
                        known[name] = is_copy(words, window, *rule)
                    if copy := known[name]:
                        first = start[k].as_py() + a
                        out.append((key[k].as_py(), item[k].as_py(), copy[0], copy[1], first + copy[2], first + copy[3]))
            if out:
                yield dict(zip(("key", "item", "share", "matches", "first_word", "last_word"), zip(*out)))

    return map_batches(pairs, run, f"key binary, item {kind}, share double, matches long, first_word long, last_word long")


def _best(rows: DataFrame, keys: list[str]) -> DataFrame:
    best = F.max(F.struct("share", "matches", (-F.col("first_word")).alias("early"), "last_word"))
    found = rows.groupBy(*keys).agg(best.alias("best"))
    return found.select(*keys, "best.share", "best.matches", (-F.col("best.early")).alias("first_word"), "best.last_word")


def find_copies(
    docs: DataFrame, items: DataFrame, n: int = 3, least: float = 0.5, run: int = 20, identity: float = 0.75, slack: float = 0.5,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
) -> DataFrame:
    """(doc_id, item_id, share, matches, first_word, last_word): the copies of items in documents, the best window of
    each pair. An item of more than PART words is judged by its parts. Null and empty texts and items have no copies;
    documents that share an id are one, and so are repeated items; null ids stay."""
    spark = docs.sparkSession
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    parts = stored(parts_of(items, n, item_col), "benchmark-parts")
    sizes = [r[0] for r in parts.select(F.least(F.size("row"), F.lit(n)).alias("n")).distinct().collect()]  # n at most
    longest = parts.agg(F.max(F.size("row"))).first()[0] or 1
    own = spark.sparkContext.broadcast(filter_of(parts))
    reach = longest + int(longest * slack) + 4
    found = _regions(docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")), kind, own, sorted(sizes), reach)
    found = stored(found, "benchmark-regions")
    members, regions = found.where("start is null").select("key", "doc"), found.where("start is not null").drop("doc")
    hits = regions.select(F.explode(F.array_distinct("codes")).alias("code")).groupBy("code").agg(F.count("*").alias("n"))
    limit = max(RARE, RARE_SHARE * regions.count())
    seeds = rare_seeds(parts, hits, limit)
    pairs = regions.select("key", "start", F.explode(F.array_distinct("codes")).alias("code")).join(seeds, "code").select("key", "start", "part").distinct()
    pairs = pairs.join(parts.select("part", "item", F.col("row").alias("own")), "part")
    # texts that several tasks have read have the same regions
    met = pairs.join(regions.dropDuplicates(["key", "start"]), ["key", "start"]).select("key", "start", "row", "places", "codes", "part", "item", "own")
    copies = _best(_aligned(met, item_kind, n, slack, (least, run, identity)), ["key", "item"])
    rows = _best(members.join(copies, "key"), ["doc", "item"])
    return rows.select(F.col("doc").alias(id_col), F.col("item").alias(item_col), F.round("share", 6).alias("share"), "matches", "first_word", "last_word")


def without_copies(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """docs without the documents that hold a copy of an item. A document with a null id is kept, as it can't be told
    from others of its kind; documents that share an id go together."""
    return docs.join(find_copies(docs, items, id_col=id_col, **options).select(id_col).distinct(), id_col, "left_anti").select(*docs.columns)
