"""Exact n-gram Jaccard self-join by universe partition (operator 8).

Sets of hashed word shingles whose Jaccard similarity is t or more differ in at most H elements, H following from their
sizes. The universe of hashes is partitioned into m > H segments, by a hash of the size band, so of two such sets at
least m - H segments agree exactly. Segments are ranked by their content alone (larger first, then by hash), and a set
indexes its H + 1 best; as both sets rank the common segments alike, the best common one is indexed by both. So small
and empty segments, which unrelated sets share by chance or by a common passage, are the ones that are left out. A set
of which an empty segment would be needed is indexed under further partitions until one needs none.

The other allocation gives some segments a one-deletion neighbourhood (the keys of the segment and of it without each
of its elements), which finds segments that differ by one element. A difference of H elements can't be too large for
every segment if e exact and l such segments have e + 2 l > H, so fewer and larger segments do. `plan_of` compares all
mixtures for each band of sizes by the rows that they write and the chance matches that they must expect.

1. One pass over the texts gives each document its set's size, hash and parity bitmap, and the keys of each distinct
   set, packed by key partition. Equal sets are one from here on, so groups of copies cost nothing.
2. A key partition keeps the keys that several sets have. Within a key, a breadth-first search links sets whose sizes
   and bitmaps allow t (the bits of an exclusive or are a lower bound of the difference); it keeps a spanning tree,
   never all pairs. Keys of many sets are dealt to pairs of blocks, each a task of its own.
3. The trees' components hold every true link. Each component's sets meet once and are verified exactly, by a search
   over an inverted index that drops what it has reached. Components beyond a bound are dealt to pairs of blocks.
4. Components of verified links give each document the smallest id it can reach.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import ceil, exp, factorial

import numpy as np
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.llm.common import map_batches, mix64, stored, texts_of

U = np.uint64
#: Partitions that a set is tried under, and the share of segments beyond H + 1 that are ranked out.
SEEDS, SPARE = 8, 1.3
#: Key bytes that cross the network (of eight): a chance match only costs a look at two bitmaps.
KEY_BYTES = 6
#: Shingles of a candidate component that one task verifies; larger components go to pairs of blocks of this size.
COMPONENT_SHINGLES = 30_000_000


#: Rows that a chance match is held to cost, and sets that share a key in one task; more are dealt to pairs of blocks.
CHANCE, GROUP = 20, 4096


@dataclass(frozen=True)
class Plan:
    """Size band [low, high] as the smaller set; limit is H. Of its segments the first `loose` have a one-deletion
    neighbourhood; without any, the segments are ranked and limit + 1 are indexed."""

    number: int
    low: int
    high: int
    limit: int
    segments: int
    loose: int


def _difference(a: int, b: int, percent: int) -> int:
    """The most elements in which sets of these sizes differ if their similarity is percent/100 or more."""
    return (a + b) * (100 - percent) // (100 + percent)


def _thin(mean: float, most: int) -> float:
    """The chance that a segment has so many elements at most (a Poisson distribution)."""
    return exp(-mean) * sum(mean**k / factorial(k) for k in range(most + 1))


def plan_of(number: int, low: int, high: int, percent: int) -> Plan:
    """The cheapest allocation of a band: the rows written, and CHANCE for each key that is expected to be shared by
    chance, that is one of fewer than two elements (after the deletion)."""
    limit = _difference(high, high * 100 // percent, percent)
    ranked = limit + 1 if not limit else max(limit + 2, ceil(SPARE * (limit + 1)))
    mean = low / ranked
    options = [((limit + 1) + CHANCE * max(0.0, _thin(mean, 1) * ranked - (ranked - limit - 1)), ranked, 0)]
    for loose in range(1, limit // 2 + 2):
        exact = max(0, limit + 1 - 2 * loose)
        segments = exact + loose
        rows = exact + loose * (1 + high / segments)
        options.append((rows + CHANCE * (exact * _thin(low / segments, 1) + loose * _thin(low / segments, 2)), segments, loose))
    _, segments, loose = min(options)
    return Plan(number, low, high, limit, segments, loose)


@lru_cache
def plans(percent: int, most: int) -> list[Plan]:
    """Bands that cover sizes up to most. A partner of a set of band k has a size of band k or k + 1."""
    out, low, high = [], 1, 1
    while True:
        out.append(plan_of(len(out), low, high, percent))
        if high >= most:
            return out
        low, high = high + 1, max(high + 1, (high + 1) * 100 // percent)


@lru_cache(maxsize=4096)
def plans_for(size: int, percent: int) -> tuple[Plan, ...]:
    """The band of a size, and the band before it if a set of that band may be a partner."""
    bands = plans(percent, 1 << max(1, size).bit_length())
    k = next(k for k, b in enumerate(bands) if b.low <= size <= b.high)
    lower = [bands[k - 1]] if k and size <= bands[k - 1].high * 100 // percent else []
    return (bands[k], *lower)


def shingles(text: str, words: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; ASCII letters are lower-cased, ASCII white space separates."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.zeros(0, U)
    h = np.fromiter(map(xxhash.xxh64_intdigest, tokens), U, len(tokens))
    n = min(words, len(h))
    code = np.full(len(h) - n + 1, n, U)  # the length tells short sequences from shingles
    for k in range(n):
        code = mix64(code * U(0x9E3779B97F4A7C15) + h[k : len(h) - n + 1 + k])
    return np.unique(code)


def bitmap(values: np.ndarray) -> np.ndarray:
    """Parity bits, as many (a power of two, 64 to 65,536) as there are elements or more."""
    bits = 1 << min(16, max(6, (len(values) - 1).bit_length()))
    odd = np.bincount((mix64(values ^ U(0x5851F42D4C957F2D)) & U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool))


def fold(bits: np.ndarray, size: int) -> np.ndarray:
    """The bitmap of fewer bytes of the same set: bit b of n bits is the parity of bits b, b + size*8, ..."""
    return np.bitwise_xor.reduce(bits.reshape(-1, size), axis=0)


def set_hash(values: np.ndarray) -> int:
    """63 bits of an order-free hash of a set, mixed with its size."""
    with np.errstate(over="ignore"):
        total = mix64(values).sum(dtype=U) + U(len(values))
    return int(mix64(np.array([total], U))[0] >> U(1))


def _loose_keys(values: np.ndarray, plan: Plan, seed: int) -> tuple[np.ndarray, bool]:
    """The keys of a partition with one-deletion neighbourhoods, and whether it needs no empty content: its exact
    segments have an element, the others two. The last partition that is tried has the keys of empty contents too."""
    own = mix64(np.array([(plan.number * SEEDS + seed + 7) << 1 | 1], U))[0]
    mixed = mix64(values ^ own)
    segment = ((mixed >> U(32)) * U(plan.segments) >> U(32)).astype(np.int64)
    size = np.bincount(segment, minlength=plan.segments)
    total = np.zeros(plan.segments, U)
    inner = mix64(mixed)
    np.add.at(total, segment, inner)
    tag = mix64(np.arange(plan.segments, dtype=U) + own)
    loose = segment < plan.loose
    keys = [total ^ tag, (total[segment[loose]] - inner[loose]) ^ tag[segment[loose]]]
    left = [size, size[segment[loose]] - 1]  # elements behind each key
    whole = bool((size[: plan.loose] > 1).all() and (size[plan.loose :] > 0).all())
    flat, some = mix64(np.concatenate(keys)), np.concatenate(left) > 0
    return (flat[some] if whole or seed < SEEDS - 1 else flat), whole


def keys_of(values: np.ndarray, percent: int) -> np.ndarray:
    """The keys under which a set is indexed."""
    out = []
    for plan in plans_for(len(values), percent):
        for seed in range(SEEDS):
            if plan.loose:
                found, whole = _loose_keys(values, plan, seed)
                out.append(found)
                if whole:
                    break
                continue
            own = mix64(np.array([plan.number * SEEDS + seed + 7], U))[0]
            mixed = mix64(values ^ own)
            segment = ((mixed >> U(32)) * U(plan.segments) >> U(32)).astype(np.int64)
            order = np.argsort(segment, kind="stable")
            present, first, size = np.unique(segment[order], return_index=True, return_counts=True)
            content = mix64(np.add.reduceat(mix64(mixed[order]), first) ^ own)
            needed = plan.limit + 1
            if len(present) > needed:
                best = np.lexsort((content, -size))[:needed]
                present, content = present[best], content[best]
            out.append(mix64(content + present.astype(U)))
            if len(present) >= needed:
                break
        else:  # no partition without an empty segment: index the empty ones of the last partition too
            if not plan.loose:
                empty = np.setdiff1d(np.arange(plan.segments), present)
                out.append(mix64(mix64(np.full(len(empty), own, U)) + empty.astype(U)))
    return np.unique(np.concatenate(out)) if out else np.zeros(0, U)


def may_link(size: int, sizes: np.ndarray, percent: int) -> np.ndarray:
    return 100 * np.minimum(size, sizes) >= percent * np.maximum(size, sizes)


def bitmap_tree(sizes: np.ndarray, bitmaps: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """A spanning forest of the graph of pairs that sizes and bitmaps allow."""
    left = np.argsort(sizes, kind="stable")
    width = min(map(len, bitmaps))
    table = np.stack([fold(b, width) for b in bitmaps])
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            at = queue.pop()
            apart = np.bitwise_count(table[left] ^ table[at]).sum(1, dtype=np.int64)
            near = may_link(sizes[at], sizes[left], percent) & (apart * (100 + percent) <= (sizes[left] + sizes[at]) * (100 - percent))
            for other in left[near].tolist():
                yield at, other
                queue.append(other)
            left = left[~near]


def exact_tree(sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """A spanning forest of the graph of pairs that are similar, by counting common elements over an inverted index of
    the sets that haven't been reached."""
    sizes = np.array([len(s) for s in sets], np.int64)
    member = np.repeat(np.arange(len(sets)), sizes)
    _, element = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(element, kind="stable")
    owner, kinds = member[order], int(element.max()) + 1
    ends = np.cumsum(np.bincount(element, minlength=kinds))
    begins = np.r_[0, ends[:-1]]
    first = np.r_[0, np.cumsum(sizes)]
    open_, n_open, indexed = np.ones(len(sets), bool), len(sets), len(sets)
    for root in np.argsort(-sizes, kind="stable").tolist():
        if not open_[root]:
            continue
        open_[root] = False
        n_open -= 1
        queue = [root]
        while queue and n_open:
            at = queue.pop()
            own = element[first[at] : first[at + 1]]
            b, n = begins[own], ends[own] - begins[own]
            stop = np.cumsum(n)
            found = owner[np.repeat(b - (stop - n), n) + np.arange(stop[-1] if len(stop) else 0)]
            common = np.bincount(found, minlength=len(sets))
            near = open_ & (100 * common >= percent * (sizes + sizes[at] - common)) & (common > 0)
            for other in np.flatnonzero(near).tolist():
                yield at, other
                queue.append(other)
            open_ &= ~near
            n_open = int(open_.sum())
            if n_open * 2 < indexed:  # drop what was reached from the index
                keep = open_[owner]
                per = np.add.reduceat(np.r_[keep, False].astype(np.int64), np.minimum(begins, len(owner))) * (ends > begins)
                owner, ends = owner[keep], np.cumsum(per)
                begins, indexed = np.r_[0, ends[:-1]], n_open


def _pack(partitions: int, keys: list[np.ndarray], owners: list[int]) -> Iterator[tuple[int, bytes]]:
    """(partition, bytes) of the keys of many sets: a header, then columns of set hashes, numbers of keys and keys."""
    flat, owner = np.concatenate(keys), np.repeat(np.arange(len(keys)), [len(k) for k in keys])
    part = ((flat >> U(40)) % U(partitions)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    flat, owner, part = flat[order], owner[order], part[order]
    present, first = np.unique(part, return_index=True)
    hashes = np.array(owners, np.int64)
    for p, a, b in zip(present.tolist(), first.tolist(), [*first.tolist()[1:], len(flat)]):
        who, counts = np.unique(owner[a:b], return_counts=True)
        low = flat[a:b].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]
        yield p, b"".join([np.array([len(who), b - a], "<i8").tobytes(), hashes[who].astype("<i8").tobytes(), counts.astype("<i4").tobytes(), low.tobytes()])


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(keys, set hashes), a pair for each key."""
    n, m = np.frombuffer(blob, "<i8", 2)
    hashes, counts = np.frombuffer(blob, "<i8", n, 16), np.frombuffer(blob, "<i4", n, 16 + 8 * n)
    wide = np.zeros((m, 8), np.uint8)
    wide[:, :KEY_BYTES] = np.frombuffer(blob, np.uint8, m * KEY_BYTES, 16 + 12 * n).reshape(m, KEY_BYTES)
    return wide.view("<u8").ravel(), np.repeat(hashes, counts)


def _signatures(docs: DataFrame, partitions: int, words: int, percent: int) -> DataFrame:
    """Rows of two kinds: part >= 0 with packed keys; part < 0 with a document's id, size, set hash and, where this
    task saw the set first, its bitmap."""

    def run(batches):
        seen: set[int] = set()
        spread = TaskContext.get().partitionId()  # documents' own rows go round, as a text may have most of them
        for b in batches:
            ids, texts = b.column(0).to_pylist(), texts_of(b.column(1))
            rows, keys, owners = [], [], []

            def flush():
                out = [(p, blob, None, None, None) for p, blob in _pack(partitions, keys, owners)] if keys else []
                return dict(zip(("part", "blob", "doc", "size", "hash"), zip(*rows, *out)))

            for key, text in zip(ids, texts):
                values = shingles(text, words)
                own = set_hash(values) if len(values) else None
                fresh = own is not None and own not in seen
                if fresh:
                    if len(seen) > 2_000_000:  # a set that comes again is only indexed again
                        seen.clear()
                    seen.add(own)
                    keys.append(keys_of(values, percent))
                    owners.append(own)
                rows.append((-1 - spread % partitions, bitmap(values).tobytes() if fresh else None, key, len(values), own))
                spread += 1
                if sum(map(len, keys)) > 500_000:
                    yield flush()
                    rows, keys, owners = [], [], []
            if rows:
                yield flush()

    return map_batches(docs, run, "part long, blob binary, doc long, size long, hash long")


def _shared_keys(signatures: DataFrame, partitions: int) -> DataFrame:
    """Keys that several sets have, as (group, hash, size: how many) rows (each list of sets once), beside the
    documents' own rows."""

    def groups(blobs: list[bytes]) -> dict | None:
        keys, hashes = (np.concatenate(x) for x in zip(*map(_unpack, blobs)))
        order = np.lexsort((hashes, keys))
        keys, hashes = keys[order], hashes[order]
        new = np.r_[True, (keys[1:] != keys[:-1]) | (hashes[1:] != hashes[:-1])]
        keys, hashes = keys[new], hashes[new]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        size = np.diff(np.r_[first, len(keys)])
        with np.errstate(over="ignore"):
            name = mix64(np.add.reduceat(mix64(hashes.astype(U)), first) + size.astype(U))
        many = np.flatnonzero(size > 1)
        many = many[np.unique(name[many], return_index=True)[1]]
        if not len(many):
            return None
        n = size[many]
        stop = np.cumsum(n)
        member = hashes[np.repeat(first[many] - (stop - n), n) + np.arange(stop[-1])]
        return {"group": np.repeat((name[many] >> U(1)).astype(np.int64), n), "hash": member, "doc": [None] * len(member), "size": np.repeat(n, n), "bits": [None] * len(member)}

    def run(batches):
        at, blobs = None, []
        for b in batches:
            part, blob, doc, size, own = (b.column(k) for k in range(5))
            parts = part.to_numpy()
            plain = np.flatnonzero(parts < 0)
            if len(plain):
                yield {"group": [None] * len(plain), "hash": own.take(plain), "doc": doc.take(plain), "size": size.take(plain), "bits": blob.take(plain)}
            for k in np.flatnonzero(parts >= 0).tolist():
                if parts[k] != at:
                    if blobs and (out := groups(blobs)) is not None:
                        yield out
                    at, blobs = parts[k], []
                blobs.append(blob[k].as_py())
        if blobs and (out := groups(blobs)) is not None:
            yield out

    dealt = signatures.repartition(partitions, "part").sortWithinPartitions("part")
    return map_batches(dealt, run, "group long, hash long, doc long, size long, bits binary")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node that each node of edges (a, b) reaches. Alternates large-star and small-star
    steps; every round's edges are written to the shared folder, and no node gets a list of its neighbours."""
    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    last = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        small_low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(small_low, "a")
        edges = stored(
            small.select("a", F.col("m").alias("b")).unionByName(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).where("a <> b").distinct(), "edges"
        )
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == last:
            break
        last = state
    else:
        raise RuntimeError(f"the components still change after {rounds} rounds; give more")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _by_key(rows: DataFrame, key: str, fn, schema: str) -> DataFrame:
    """fn over the rows of each key, streamed from sorted partitions; fn gets (columns of one key)."""

    def run(batches):
        at, held = None, []
        for b in batches:
            keys = b.column(0).to_numpy()
            cuts = np.r_[0, np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys)]
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if held and keys[lo] != at:
                    if (out := fn(held)) is not None:
                        yield out
                    held = []
                at = keys[lo]
                held.append(b.slice(lo, hi - lo))
        if held and (out := fn(held)) is not None:
            yield out

    return map_batches(rows.repartition(F.col(key)).sortWithinPartitions(key), run, schema)


def _column(parts: list, k: int) -> list:
    return [x for p in parts for x in p.column(k).to_pylist()]


def _in_blocks(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(task, columns) of rows (key, hash, blocks, columns): a task for each key, and for one of several blocks a task
    for each pair of them, so each pair of a key's rows meets in one and no task has more than two blocks."""
    block = F.pmod(F.xxhash64("hash"), F.col("blocks")).cast("int")
    dealt = rows.withColumn("blocks", F.greatest("blocks", F.lit(1))).withColumn("block", block).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.select(F.xxhash64(key, F.least("i", "block"), F.greatest("i", "block")).alias("task"), *columns)


def link_documents(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", group_sets: int = GROUP) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row. Two documents link when 100 * intersection >= percent * union of
    their shingle sets; component_id is the smallest id reached. Null, empty and blank texts have no shingles and link
    with nothing. Ids are integers; a row with a null id counts as a member of its class but gives it no id, and its
    component_id is null if no other member has one. Repeated rows give a row each. An empty table gives no rows."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    found = stored(_shared_keys(_signatures(texts, partitions, words, percent), partitions), "shingle-keys")
    members = found.where("group is null").select("doc", "size", "hash", "bits")
    groups = found.where("group is not null").select("group", "hash", F.col("size").alias("many")).distinct()

    # one bitmap and one document for each distinct set that shares a key
    distinct = members.where("hash is not null").groupBy("hash").agg(F.min("doc").alias("doc"), F.max("size").alias("size"), F.max("bits").alias("bits"), F.count("*").alias("n"))
    distinct = stored(distinct, "shingle-sets")
    shared = groups.join(distinct.select("hash", "size", "bits"), "hash").withColumn("blocks", F.ceil(F.col("many") / group_sets).cast("int"))
    shared = _in_blocks(shared, "group", ["hash", "size", "bits"])

    def tree(parts):
        own, sizes = np.array(_column(parts, 1), np.int64), np.array(_column(parts, 2), np.int64)
        edges = list(bitmap_tree(sizes, [np.frombuffer(x, np.uint8) for x in _column(parts, 3)], percent))
        return {"a": own[[e[0] for e in edges]], "b": own[[e[1] for e in edges]]} if edges else None

    near = components(_by_key(shared, "task", tree, "a long, b long"))
    near = stored(near.unionByName(near.select(F.col("root").alias("node"), "root")).distinct(), "candidates")

    # the sets of candidates, made again from their documents' texts
    wanted = near.join(distinct.select("hash", "doc", "size"), near["node"] == distinct["hash"]).select("doc", "hash", "root", "size")
    weight = wanted.groupBy("root").agg(F.sum("size").alias("weight"))
    wanted = wanted.where("doc is not null").join(weight, "root").select("doc", "hash", "root", "weight")
    again = texts.where("doc is not null").join(wanted.hint("shuffle_hash"), "doc").select("root", "hash", "weight", "text")

    def sets(batches):
        for b in batches:
            rows = [
                (root, own, weight, values.astype("<u8").tobytes())
                for root, own, weight, text in zip(*(b.column(k).to_pylist() for k in range(4)))
                if len(values := shingles(text or "", words)) and set_hash(values) == own
            ]
            if rows:
                yield dict(zip(("root", "hash", "weight", "elements"), zip(*rows)))

    verified = _verified(stored(map_batches(again, sets, "root long, hash long, weight long, elements binary"), "candidate-sets"), percent)
    final = components(verified)
    final = final.unionByName(final.select(F.col("root").alias("node"), "root")).distinct()
    classes = distinct.select("hash", "doc", "n").join(final, F.col("hash") == F.col("node"), "left").where("n > 1 or root is not null").select("hash", "doc", F.coalesce("root", "hash").alias("root"))
    lowest = classes.groupBy("root").agg(F.min("doc").alias("component_id"))
    named = classes.join(lowest, "root").select("hash", "component_id")

    # a set may have a third of all rows: its name goes to several salts; a document of no class is its own
    salts = 16
    named = named.select("hash", "component_id", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    rows = members.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(salts)).cast("int"))
    out = rows.join(named, ["hash", "salt"], "left").select(
        F.col("doc").alias(id_col), F.col("size").alias("n_shingles"), F.coalesce("component_id", "doc").alias("component_id")
    )
    return out


def _verified(sets: DataFrame, percent: int, bound: int = COMPONENT_SHINGLES) -> DataFrame:
    """(a, b): a spanning forest of the true links of each candidate component (root, hash, weight, elements). A
    component of more than bound elements is cut into blocks, and each pair of blocks is verified by a task of its
    own, so none holds more than twice the bound; smaller ones are one block."""
    dealt = _in_blocks(sets.withColumn("blocks", F.ceil(F.col("weight") / bound).cast("int")), "root", ["hash", "elements"])

    def tree(parts):
        own, at = np.unique(np.array(_column(parts, 1), np.int64), return_index=True)
        raw = _column(parts, 2)
        edges = list(exact_tree([np.frombuffer(raw[k], "<u8") for k in at], percent)) if len(own) > 1 else []
        return {"a": own[[e[0] for e in edges]], "b": own[[e[1] for e in edges]]} if edges else None

    return _by_key(dealt, "task", tree, "a long, b long")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """docs with one document (the smallest id; of repeated rows with it, one) of each component. Rows with null ids
    are kept, as nothing tells them apart."""
    found = link_documents(docs, id_col=id_col, **options).where("component_id is not null and component_id <> doc_id").select(F.col("doc_id").alias("_gone")).distinct()
    kept = docs.join(found.hint("shuffle_hash"), docs[id_col].cast("long") == F.col("_gone"), "left_anti")
    return kept.where(F.col(id_col).isNull()).unionByName(kept.where(F.col(id_col).isNotNull()).dropDuplicates([id_col]))
