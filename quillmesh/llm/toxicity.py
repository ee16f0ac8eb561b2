"""Class-conditional Kneser-Ney models of toxic and ordinary text (operator 7).

Characters within words are modelled, so that a rare form is judged by its stem. The top order has a count table for
each class; every lower order is shared by both classes and holds Kneser-Ney continuation counts, so an expression that
a class has seen rarely falls back on what all text has. The log-likelihoods of a word (and of a text, a character at a
time) under the two models are compared, and a logistic curve over the length-normalised difference of the text and of
its most telling words turns them into a score.

Counts come from all labelled training rows and are summed by Spark; every distinct n-gram has its own, in a stored
table that grows with the labelled rows. Up to `grams_most` n-grams the tables are broadcast, and words are scored where
their texts are read. Beyond that nothing of them leaves the cluster: the distinct n-grams of the corpus' distinct words
are joined to the counts of each order, words to their n-grams, and texts to their words, which gives the same scores.
The logistic curve is fitted on at most `calibration` labelled rows, which are scored by a model of the other half of
the rows.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh.llm.common import map_batches, normal_word, numbered_columns, stored, texts_of

#: Characters in the longest n-gram, bits of a character (any code point, above the two marks), and the discount.
ORDER, BITS, DISCOUNT = 5, 21, 0.75
FRONT, BACK = 1, 2
KEPT = 150_000
CLASSES = (0, 1)
FEATURES = ("per_char", "top", "top3", "share")
#: A word of so high a ratio counts as telling; the ratios and shares from which more evidence changes nothing.
TELLING, MOST_RATIO, MOST_SHARE = 3.0, 6.0, 0.02
#: N-grams (some 48 bytes each in a table) that may be broadcast.
GRAMS_MOST = 3_000_000


def grams_of(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(high, low, the word's index) of the n-gram that ends at each character or word end. low packs its last three
    characters of BITS bits, high the two before them."""
    joined = "\x03".join(words) + "\x03"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) + BACK + 1
    sizes = np.array([len(w) + 1 for w in words])
    ends = np.cumsum(sizes) - 1
    codes[ends] = BACK
    word = np.repeat(np.arange(len(words)), sizes)
    at = np.arange(len(codes)) - (ends - sizes + 1)[word]
    parts = [codes]
    for k in range(1, ORDER):
        before = np.concatenate([np.full(k, FRONT), codes[:-k]])[: len(codes)]
        parts.append(np.where(at >= k, before, FRONT))
    return parts[3] | parts[4] << BITS, parts[0] | parts[1] << BITS | parts[2] << (2 * BITS), word


def last(high: np.ndarray, low: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The last k characters of n-grams."""
    return high & ((1 << (BITS * max(k - 3, 0))) - 1), low & ((1 << (BITS * min(k, 3))) - 1)


def context(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """N-grams without their last character."""
    return high >> BITS, low >> BITS | (high & ((1 << BITS) - 1)) << (2 * BITS)


class Grams:
    """Distinct n-grams in order. A key is the rank of high and that of low, so no two n-grams share one."""

    def __init__(self, high: np.ndarray, low: np.ndarray):
        self.high, self.low, self.keys = np.unique(high), np.unique(low), None
        self.keys = np.unique(self._keys(high, low)[0])

    def _keys(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = np.minimum(np.searchsorted(self.high, high), len(self.high) - 1)
        w = np.minimum(np.searchsorted(self.low, low), len(self.low) - 1)
        return h * len(self.low) + w, (self.high[h] == high) & (self.low[w] == low)

    def find(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The place of each n-gram; the number of places for one that isn't here."""
        if not len(self.keys):
            return np.zeros(len(high), np.int64)
        keys, known = self._keys(high, low)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(known & (self.keys[at] == keys), at, len(self.keys))

    def codes(self) -> tuple[np.ndarray, np.ndarray]:
        return self.high[self.keys // max(len(self.low), 1)], self.low[self.keys % max(len(self.low), 1)]


def compact(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the narrowest type that holds them, and a 0 for what isn't found."""
    values = np.append(values, 0).astype(np.int64)
    return values.astype(np.min_scalar_type(int(values.max())))


def with_contexts(grams: Grams, counts: list[np.ndarray]) -> tuple[Grams, list, Grams, list, list]:
    """grams and their counts; their contexts with the sums and the numbers of kinds of each of the counts."""
    above = context(*grams.codes())
    contexts = Grams(*above)
    at = contexts.find(*above)
    sums = [compact(np.bincount(at, n, len(contexts.keys))) for n in counts]
    return grams, [compact(n) for n in counts], contexts, sums, [compact(np.bincount(at, n > 0, len(contexts.keys))) for n in counts]


@dataclass
class CharModel:
    """top: with_contexts() of the longest n-grams, by class; shared[k]: that of k characters, by continuations."""

    top: tuple
    shared: dict
    kept: dict = field(default_factory=dict)

    def gram_ratio(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """log p(last character | toxic) - log p(last character | ordinary)."""
        grams, (seen,), *_ = self.shared[1]
        p = (seen[grams.find(*last(high, low, 1))] + 0.5) / (max(float(seen.sum(dtype=float)), 1.0) + len(seen) / 2)
        for k in range(2, ORDER):
            p = self._probability(self.shared[k], 0, last(high, low, k), p)
        q = [self._probability(self.top, c, (high, low), p) for c in CLASSES]
        return np.log(np.maximum(q[1], 1e-12)) - np.log(np.maximum(q[0], 1e-12))

    @staticmethod
    def _probability(tables: tuple, c: int, gram: tuple[np.ndarray, np.ndarray], p: np.ndarray) -> np.ndarray:
        grams, counts, contexts, sums, types = tables
        at, h = grams.find(*gram), contexts.find(*context(*gram))
        n = sums[c][h].astype(float)
        return np.where(n > 0, (np.maximum(counts[c][at] - DISCOUNT, 0) + DISCOUNT * types[c][h] * p) / np.maximum(n, 1), p)

    def add_words(self, tokens: list[str]) -> None:
        words = [normal_word(t) for t in tokens]
        high, low, word = grams_of(words)
        own = Grams(high, low)
        ratio = np.bincount(word, self.gram_ratio(*own.codes())[own.find(high, low)], minlength=len(words))
        for t, w, r in zip(tokens, words, ratio.tolist()):
            self.kept[t] = (r, len(w)) if w else (0.0, 0)

    def features(self, texts: list[str], block: int = 128) -> np.ndarray:
        """A row of FEATURES for each text; the words of one block of texts are held at a time."""
        blocks = [self._features(texts[k : k + block]) for k in range(0, len(texts), block)]
        return np.concatenate(blocks) if blocks else np.zeros((0, len(FEATURES)))

    def _features(self, texts: list[str]) -> np.ndarray:
        split = [t.split() for t in texts]
        if len(self.kept) > KEPT:
            self.kept.clear()
        new = list(set().union(*split) - self.kept.keys()) if split else []
        for k in range(0, len(new), 10_000):
            self.add_words(new[k : k + 10_000])
        out = np.zeros((len(texts), len(FEATURES)))
        for row, tokens in zip(out, split):
            if tokens:
                pairs = np.array([self.kept[t] for t in tokens])
                ratio, chars = pairs[:, 0], pairs[:, 1].sum()
                best = np.sort(np.partition(ratio, len(ratio) - min(3, len(ratio)))[-3:])[::-1]
                row[:] = ratio.sum() / max(chars, 1), best[0], best.sum() / 3, (ratio > TELLING).mean()
        return out


def is_held_out(id_col: str) -> Column:
    """Rows that give no labels: crc32 of the id as text, modulo 3, is 1. A null id is no held-out row."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def _second_half(id_col: str) -> Column:
    return F.floor(F.crc32(F.col(id_col).cast("string")) / 3) % 2 == 1


def gram_counts(rows: DataFrame) -> DataFrame:
    """rows (toxic, half, text) to (high, low, n00, n01, n10, n11): counts by class, then half. Summed within each
    batch first, so a gram crosses the network once for each batch at most."""

    def run(batches):
        for b in batches:
            toxic, half = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
            texts, parts = texts_of(b.column(2)), []
            for c in CLASSES:
                for h in (0, 1):
                    tokens = Counter()
                    for k in np.flatnonzero((toxic == c) & (half == h)):
                        tokens.update(texts[k].split())
                    words = Counter()
                    for t, n in tokens.items():
                        words[normal_word(t)] += n
                    words.pop("", None)
                    if words:
                        high, low, word = grams_of(list(words))
                        own = Grams(high, low)
                        n = np.bincount(own.find(high, low), np.array(list(words.values()), float)[word])
                        parts.append((c * 2 + h, *own.codes(), n))
            if parts:
                grams = Grams(np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts]))
                table = np.zeros((4, len(grams.keys)), np.int64)
                for k, high, low, n in parts:
                    table[k, grams.find(high, low)] = n
                high, low = grams.codes()
                yield {"high": high, "low": low, "n00": table[0], "n01": table[1], "n10": table[2], "n11": table[3]}

    names = ["n00", "n01", "n10", "n11"]
    found = map_batches(rows, run, "high long, low long, " + ", ".join(f"{n} long" for n in names))
    return found.groupBy("high", "low").agg(*[F.sum(n).alias(n) for n in names])


def train(counts: DataFrame) -> tuple[CharModel, CharModel]:
    """Models of the first half and of all rows, from gram_counts() of a bounded size, which come to the driver."""
    found = counts.toArrow()
    high, low, *columns = (found.column(k).to_numpy() for k in range(6))
    top = Grams(high, low)
    order = np.argsort(top.find(high, low))
    n00, n01, n10, n11 = (n[order] for n in columns)
    shared, grams = {}, top
    for k in range(ORDER - 1, 0, -1):
        ends = last(*grams.codes(), k)
        grams = Grams(*ends)
        shared[k] = with_contexts(grams, [np.bincount(grams.find(*ends))])
    return CharModel(with_contexts(top, [n00, n10]), shared), CharModel(with_contexts(top, [n00 + n01, n10 + n11]), shared)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton's method; the first weight is the intercept, which isn't shrunk."""
    x = np.column_stack([np.ones(len(x)), x])
    w, shrink = np.zeros(x.shape[1]), np.r_[1e-6, np.full(x.shape[1] - 1, ridge)]
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(shrink), x.T @ (y - p) - shrink * w)
        w += step
        if abs(step).max() < 1e-8:
            break
    return w


def _last(k: int) -> tuple[Column, Column]:
    """last() of the columns high and low."""
    high, low = F.col("high"), F.col("low")
    return high.bitwiseAND(F.lit((1 << (BITS * max(k - 3, 0))) - 1)), low.bitwiseAND(F.lit((1 << (BITS * min(k, 3))) - 1))


def _context(high: Column, low: Column) -> tuple[Column, Column]:
    """context() of columns."""
    return F.shiftright(high, BITS), F.shiftright(low, BITS).bitwiseOR(F.shiftleft(high.bitwiseAND(F.lit((1 << BITS) - 1)), 2 * BITS))


def _looked_up(grams: DataFrame, table: DataFrame, key: tuple[Column, Column], names: list[str]) -> DataFrame:
    """grams with the columns of a table (h, l, ...) at a key, 0 where it has none."""
    keyed = grams.withColumns({"_h": key[0], "_l": key[1]})
    found = keyed.join(table.select(F.col("h").alias("_h"), F.col("l").alias("_l"), *names), ["_h", "_l"], "left").drop("_h", "_l")
    return found.withColumns({n: F.coalesce(n, F.lit(0)) for n in names})


def gram_ratios(grams: DataFrame, counts: DataFrame, sums: list[Column]) -> DataFrame:
    """(high, low, ratio) of distinct n-grams (high, low): CharModel.gram_ratio() by joins. sums: the two classes'
    counts as columns of counts."""
    level = counts.select("high", "low", *[n.cast("long").alias(f"n{c}") for c, n in enumerate(sums)])
    tables = {ORDER: (level, ["n0", "n1"])}
    below = level
    for k in range(ORDER - 1, 0, -1):
        h, l = _last(k)
        below = below.groupBy(h.alias("high"), l.alias("low")).agg(F.count("*").alias("n0"))
        tables[k] = (stored(below, "toxicity-level"), ["n0"])
        below = tables[k][0]
    singles = tables[1][0].agg(F.coalesce(F.sum("n0"), F.lit(0)), F.count("*")).first()
    out = _looked_up(grams, tables[1][0].select(F.col("high").alias("h"), F.col("low").alias("l"), "n0"), _last(1), ["n0"])
    out = out.select("high", "low", ((F.col("n0") + 0.5) / (max(float(singles[0]), 1.0) + (singles[1] + 1) / 2)).alias("p"))
    for k in range(2, ORDER + 1):
        table, names = tables[k]
        own, key = table.select(F.col("high").alias("h"), F.col("low").alias("l"), *names), _last(k)
        around = _context(F.col("high"), F.col("low"))
        kinds = [F.sum(n).alias(f"s{n}") for n in names] + [F.count_if(F.col(n) > 0).alias(f"t{n}") for n in names]
        contexts = table.groupBy(around[0].alias("h"), around[1].alias("l")).agg(*kinds)
        out = _looked_up(_looked_up(out, own, key, names), contexts, _context(*key), [f"{x}{n}" for n in names for x in "st"])
        share = lambda n: F.when(F.col(f"s{n}") > 0, (F.greatest(F.col(n) - DISCOUNT, F.lit(0.0)) + DISCOUNT * F.col(f"t{n}") * F.col("p")) / F.col(f"s{n}")).otherwise(F.col("p"))
        out = out.select("high", "low", *([share("n0").alias("p")] if k < ORDER else [share(n).alias(f"q{n}") for n in names]))
    ratio = F.log(F.greatest("qn1", F.lit(1e-12))) - F.log(F.greatest("qn0", F.lit(1e-12)))
    return out.select("high", "low", ratio.alias("ratio"))


def joined_features(rows: DataFrame, counts: DataFrame, sums: list[Column]) -> DataFrame:
    """(row, FEATURES) of rows (row, text), without a table of n-grams in any task: texts to their distinct tokens, these
    to n-grams, and back. Joins split tokens and n-grams that most texts have (AQE), as the other side has one row each."""

    def tokens(batches):
        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), texts_of(b.column(1))):
                found = Counter(text.split())
                if found:
                    yield {"row": [key] * len(found), "token": list(found), "n": list(found.values())}

    def grams(batches):
        for b in batches:
            names = b.column(0).to_pylist()
            words = [normal_word(t) for t in names]
            high, low, word = grams_of(words)
            size = np.array([len(w) for w in words])
            yield {"token": [names[k] for k in word.tolist()], "chars": size[word], "high": high, "low": low}

    spoken = stored(map_batches(rows.select("row", "text"), tokens, "row long, token string, n long"), "toxicity-tokens")
    spelt = stored(map_batches(spoken.select("token").distinct(), grams, "token string, chars long, high long, low long"), "toxicity-grams")
    ratios = gram_ratios(spelt.select("high", "low").distinct(), counts, sums)
    words = spelt.join(ratios, ["high", "low"]).groupBy("token").agg(F.max("chars").alias("chars"), F.sum("ratio").alias("r"))
    words = words.select("token", "chars", F.when(F.col("chars") > 0, F.col("r")).otherwise(0.0).alias("r"))
    best = F.sort_array(F.collect_list(F.struct("r", F.least("n", F.lit(3)).cast("int").alias("times"))), False)
    texts = spoken.join(words, "token").groupBy("row").agg(
        F.sum(F.col("n") * F.col("r")).alias("total"), F.sum(F.col("n") * F.col("chars")).alias("chars"), F.sum("n").alias("n"),
        F.sum(F.when(F.col("r") > TELLING, F.col("n")).otherwise(0)).alias("telling"), F.slice(best, 1, 3).alias("best"),
    )
    top = F.slice(F.flatten(F.transform("best", lambda x: F.array_repeat(x["r"], x["times"]))), 1, 3)
    texts = texts.withColumn("top", top).select(
        "row", (F.col("total") / F.greatest("chars", F.lit(1))).alias("per_char"), F.get("top", F.lit(0)).alias("top"),
        (F.aggregate("top", F.lit(0.0), lambda a, x: a + x) / 3).alias("top3"), (F.col("telling") / F.col("n")).alias("share"),
    )
    found = rows.select("row").join(texts, "row", "left")
    return found.select("row", *[F.coalesce(n, F.lit(0.0)).alias(n) for n in FEATURES])


def saturated(x: np.ndarray) -> np.ndarray:
    """FEATURES as the curve takes them: a text full of the plainest insults isn't more toxic than toxic, and mustn't
    make weaker words look harmless."""
    return np.minimum(x, [np.inf, MOST_RATIO, MOST_RATIO, MOST_SHARE])


def _scored(own: DataFrame, labels: DataFrame, id_col: str, text_col: str, calibration: int, grams_most: int) -> DataFrame:
    """own, whose columns are called c0, c1 and so on, with held_out and score. labels: (c0, toxic)."""
    spark = own.sparkSession
    known = labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull() & ~is_held_out(id_col)).groupBy(id_col).agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.withColumn("half", _second_half(id_col).cast("int"))
    texts = own.select(id_col, F.col(text_col).alias("text")).where(F.col(id_col).isNotNull() & ~is_held_out(id_col))
    counts = stored(gram_counts(texts.join(known.hint("shuffle_hash"), id_col).select("toxic", "half", "text")), "toxicity-counts")
    size, ordinary, toxic = counts.agg(F.count("*"), F.sum(F.col("n00") + F.col("n01")), F.sum(F.col("n10") + F.col("n11"))).first()
    rows = own.withColumn("held_out", is_held_out(id_col))
    if not ordinary or not toxic:
        return rows.withColumn("score", F.lit(0.0))
    # the other half's rows, so many at most, in the order of a hash: a bounded table, so it may be broadcast
    sample = known.where("half = 1").orderBy(F.xxhash64(id_col), id_col).limit(calibration).select(id_col, "toxic")
    sample = texts.join(F.broadcast(sample), id_col).select("toxic", "text")
    names = ", ".join(f"{n} double" for n in FEATURES)
    models = train(counts) if size <= grams_most else None

    if models is not None:
        half, full = spark.sparkContext.broadcast(models[0]), spark.sparkContext.broadcast(models[1])

        def measure(batches):
            model = half.value
            for b in batches:
                x = model.features(texts_of(b.column(1)))
                yield {"toxic": b.column(0)} | {n: x[:, k] for k, n in enumerate(FEATURES)}

        measured = map_batches(sample, measure, f"toxic int, {names}")
    else:
        sample = stored(sample.withColumn("row", F.monotonically_increasing_id()), "toxicity-sample")
        measured = joined_features(sample, counts, [F.col("n00"), F.col("n10")]).join(sample.select("row", "toxic"), "row").select("toxic", *FEATURES)
    measured = measured.toPandas()
    x, y = saturated(measured[list(FEATURES)].to_numpy()), measured["toxic"].to_numpy(float)
    mean, scale = (x.mean(0), np.maximum(x.std(0), 1e-9)) if len(x) else (np.zeros(len(FEATURES)), np.ones(len(FEATURES)))
    weights = logistic((x - mean) / scale, y) if 0 < y.sum() < len(y) else np.r_[0.0, np.ones(len(FEATURES))]
    if models is None:
        rows = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "toxicity-rows")
        found = joined_features(rows.select(F.col("_row").alias("row"), F.col(text_col).alias("text")), counts, [F.col("n00") + F.col("n01"), F.col("n10") + F.col("n11")])
        most = {"top": MOST_RATIO, "top3": MOST_RATIO, "share": MOST_SHARE}
        z = F.lit(float(weights[0]))
        for n, w, m, s in zip(FEATURES, weights[1:].tolist(), mean.tolist(), scale.tolist()):
            z = z + ((F.least(F.col(n), F.lit(most[n])) if n in most else F.col(n)) - m) / s * w
        score = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.least(F.greatest(z, F.lit(-30.0)), F.lit(30.0))))
        return rows.join(found.select(F.col("row").alias("_row"), score.alias("score")), "_row").drop("_row")
    names = rows.columns
    place = names.index(text_col)

    def run(batches):
        model = full.value
        for b in batches:
            z = (saturated(model.features(texts_of(b.column(place)))) - mean) / scale
            yield {c: b.column(k) for k, c in enumerate(names)} | {"score": 1 / (1 + np.exp(-np.clip(weights[0] + z @ weights[1:], -30, 30)))}

    return map_batches(rows, run, ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in names) + ", score double")


def score_toxicity(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.7, calibration: int = 20_000, id_col: str = "doc_id", text_col: str = "text", grams_most: int = GRAMS_MOST,
) -> DataFrame:
    """(id, held_out, score, predicted) of each row of docs. labels (id, toxic): repeated ids take their largest label,
    null labels are no labels. A null text is empty; an empty text has the score of no evidence. Without labelled rows
    of both classes every score is 0. Repeated rows give a row each; null ids are scored too; other columns are dropped."""
    own = docs.select(F.col(id_col).alias("c0"), F.col(text_col).alias("c1"))
    found = _scored(own, labels.select(F.col(id_col).alias("c0"), "toxic"), "c0", "c1", calibration, grams_most)
    return found.select(F.col("c0").alias(id_col), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.7, calibration: int = 20_000, id_col: str = "doc_id", text_col: str = "text", grams_most: int = GRAMS_MOST,
) -> DataFrame:
    """The rows of docs that score below the threshold, with their columns, whatever these are called."""
    own, lower = numbered_columns(docs), [c.lower() for c in docs.columns]
    key, text = (own.columns[lower.index(c.lower())] for c in (id_col, text_col))
    found = _scored(own, labels.select(F.col(id_col).alias(key), "toxic"), key, text, calibration, grams_most)
    return found.where(F.col("score") < threshold).select(*own.columns).toDF(*docs.columns)
