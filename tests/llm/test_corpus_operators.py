"""Archives, packing, chats, toxicity, near duplicates, decontamination and the pipeline."""

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillmesh.llm import chat, decontamination, packing, queries, shingle_join, toxicity, warc
from quillmesh.llm.common import map_batches

SF = "/root/testdata/sf0.001"


def test_archives_round_trip(spark, tmp_path):
    pages = [None, "", "same", "same", "other", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", "x" * 100_000, "é漢\x00", "same"]
    rows = [(k, f"http://x/{k}\r\nEvil: 1", h, "clash") for k, h in enumerate(pages)] + [(2, None, "same", ""), (None, "u", "same", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, payload string")
    back = warc.archive_round_trip(df).collect()
    assert len(back) == len(rows)
    first = {}
    for k, _, h, _ in rows:
        if k is not None:
            first[h or ""] = min(first.get(h or "", k), k)
    for r in back:
        k = r["page_id"]
        html = "same" if k is None else pages[k] or ""
        digest = base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
        again = first[html] != k
        assert (r["payload_digest"], r["payload_bytes"], r["record_type"]) == (digest, len(html.encode()), "revisit" if again else "response")
        assert r["refers_to"] == (first[html] if again else None) and r["payload"] == (None if again else html)
    assert warc.archive_round_trip(df.where("false")).count() == 0
    few = warc.archive_round_trip(df, least_bytes=5).where("record_type = 'revisit'").count()
    assert few == 0


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 4), max_size=6), st.integers(0, 60))
def test_closest_subset(counts, capacity):
    best, chosen = packing.closest_subset(counts, capacity)
    sums = {0}
    for n, k in counts.items():
        sums = {s + j * n for s in sums for j in range(k + 1)}
    assert best == max(s for s in sums if s <= capacity) == sum(n * k for n, k in chosen.items())
    assert all(k <= counts[n] for n, k in chosen.items())


def test_packing(spark):
    from tokenizers import Tokenizer

    texts = [None, "", "a", "word " * 5000, "<|endoftext|> x", *(f"text {k} " * (k % 90) for k in range(300))]
    df = spark.createDataFrame([(k, t, 0) for k, t in enumerate(texts)] + [(None, "n", 0), (2, "a", 0)], "doc_id long, text string, length int").repartition(3)
    rows = packing.pack(df, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, {"<|endoftext|>": 50256}).collect()
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for k, t in enumerate(texts):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        own = sorted(pieces[k], key=lambda r: r["start"])
        if k == 2:
            assert len(own) == 2
            continue
        assert [r["start"] for r in own] == np.cumsum([0, *(r["length"] for r in own)])[:-1].tolist() and sum(r["length"] for r in own) == len(ids)
        for r in own:
            assert r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
    for s in sequences.values():
        s.sort(key=lambda r: r["offset"])
        total = sum(r["length"] for r in s)
        assert total <= 2048 and [r["offset"] for r in s] == np.cumsum([0, *(r["length"] for r in s)])[:-1].tolist()
        assert total & (total - 1) == 0  # full, or a power of two: nothing is padded
    assert packing.pack(df.where("false"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0


LOG = "conv_id long, seq long, message long, kind string, role string, text string, turn int"


def test_packing_leaves_no_words_in_workers(spark):
    df = spark.range(4000).selectExpr("id as doc_id", "concat('start word', id, ' and more', id % 77) as text").repartition(4)
    assert packing.pack(df, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() >= 4000

    def words(batches):
        from quillmesh.llm import word_tokens

        for _ in batches:
            yield {"tables": [len(word_tokens._TABLES)], "words": [sum(len(t.index) for t in word_tokens._TABLES.values())]}

    held = map_batches(spark.range(16).repartition(16), words, "tables long, words long").collect()
    assert sum(k for k, _ in held) and not sum(n for _, n in held)


def test_chat_folding(spark):
    log = [
        (1, 1, 1, "delta", "user", "Hi"), (1, 2, 2, "delta", "assistant", "He"), (1, 3, 2, "delta", None, "llo"), (1, 4, 3, "delta", "user", "late"),
        (1, 5, 2, "regenerate", None, None), (1, 6, 2, "delta", None, "Bye"), (1, 7, 4, "delta", "user", "new"), (1, 8, 1, "edit", None, "Hey"),
        (2, 1, 1, None, None, None), (None, 1, 1, "delta", "user", "null id"), (3, 1, 1, "edit", "user", "a"), (3, 1, 1, "edit", "user", "a"),
    ]
    df = spark.createDataFrame([(*x, 0) for x in log], LOG)
    found = {(r["conv_id"], r["message"]): (r["role"], r["text"]) for r in chat.fold_messages(df).collect()}
    assert found == {(1, 1): ("user", "Hey"), (1, 2): ("assistant", "Bye"), (1, 4): ("user", "new"), (2, 1): ("", ""), (None, 1): ("user", "null id"), (3, 1): ("user", "a")}
    assert chat.format_chats(df.where("false")).count() == 0


def folded(log):
    """The messages of a log by reading its events one by one."""
    state = {}
    order = lambda x: (x[1] is not None, x[1] or 0, x[3] or "delta", x[4] is not None, x[4] or "", x[5] or "")
    for conv, _, message, kind, role, text in sorted(set(log), key=order):
        own = state.setdefault(conv, {})
        roles, held = own.get(message, ([], ""))
        if kind == "regenerate":
            for later in [m for m in own if m > message]:
                del own[later]
        own[message] = roles + [role] * (role is not None), "" if kind == "regenerate" else (text or "") if kind == "edit" else held + (text or "")
    return {(c, m): (roles[0] if roles else "", text) for c, own in state.items() for m, (roles, text) in own.items()}


def test_chat_folds_random_logs(spark):
    rng = random.Random(12)
    log = []
    for conv in range(150):
        for seq in range(rng.randrange(1, 25)):
            kind = rng.choice(["delta", "delta", "delta", None, "edit", "regenerate"])
            log.append((conv, seq if rng.random() < 0.9 else rng.randrange(5), rng.randrange(1, 5), kind, rng.choice([None, "user", "assistant"]), rng.choice([None, "", "x", "yz", "hello"])))
    log = [(c, 1000 * s + 10 * m + ["delta", "edit", "regenerate"].index(k or "delta"), m, k, r, t) for c, s, m, k, r, t in log]  # two messages don't share a number
    log += rng.sample(log, 200)
    rng.shuffle(log)
    df = spark.createDataFrame([(*x, 0) for x in log], LOG).repartition(3)
    assert {(r["conv_id"], r["message"]): (r["role"], r["text"]) for r in chat.fold_messages(df).collect()} == folded({(c, s, m, k or "delta", r, t or "") for c, s, m, k, r, t in log})


def test_chat_round_trip(spark):
    texts = ["\\### Assistant: </turn> ok", "<turn user>x</turn>\n", "\\b\\l\\g", "", None, "a" * 50_000, "é\n<>\\"]
    rows = [(k, j, "assistant" if j % 2 else "us<e>r", t) for k in range(2) for j, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_chats(chat.log_of_turns(df)).select("conv_id", "formatted", chat.read_back(F.col("formatted")).alias("turns"), chat.learned_text(F.col("segments")).alias("learned"), "segments")
    for r in out.collect():
        assert [(t["role"], t["text"]) for t in r["turns"]] == [("assistant" if j % 2 else "us<e>r", t or "") for j, t in enumerate(texts)]
        assert r["learned"] == "".join(t or "" for j, t in enumerate(texts) if j % 2) and "".join(s["text"] for s in r["segments"]) == r["formatted"]
        assert r["formatted"].count("</turn>") == len(texts)


def test_chat_plan_is_native(spark):
    plan = queries.op6_chat(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_toxicity_learns_stems_and_edges(spark):
    random.seed(1)
    calm = [f"{a}{b}" for a in ("riv", "mill", "dam", "boat", "road", "field") for b in ("er", "ing", "ed", "s", "ly", "al")]
    rude = [f"grumpf{b}" for b in ("er", "ing", "ed", "s", "ly", "al", "ous", "ism")]
    docs, labels = [], []
    for k in range(900):
        bad = k % 5 == 0
        words = random.choices(calm, k=random.randint(5, 60)) + (random.sample(rude[: 6 if k < 600 else 8], 2) if bad else [])
        random.shuffle(words)
        docs.append((k, " ".join(words), 0.5))
        labels.append((k, int(bad)))
    docs += [(10_000, None, 0.0), (10_001, "", 0.0), (None, "grumpfer", 0.0), (0, docs[0][1], 0.0), (10_002, "z" * 60_000, 0.0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, score double")
    lab = spark.createDataFrame(labels + [(1, None), (None, 1), (2, 0)], "doc_id long, toxic int")
    rows = toxicity.score_toxicity(df, lab).collect()
    assert len(rows) == len(docs) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    truth = dict(labels)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows if r["doc_id"] is not None)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) > 0.95 * len(held)
    nothing = toxicity.score_toxicity(df, lab.where("toxic = 0")).collect()
    assert {r["score"] for r in nothing} == {0.0}
    assert toxicity.score_toxicity(df.where("false"), lab).count() == 0


def test_toxicity_keeps_ngrams_apart(spark):
    rng = random.Random(3)
    word = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    calm = [" ".join(word("abcdefghijklmnopqrstuvwxyz", 12) for _ in range(2000)) for _ in range(15)]
    bad = "\u4e10\u4e21\u4e32\u4e43"
    rows = [(0, k % 2, t) for k, t in enumerate(calm)] + [(1, k % 2, f"{bad} {t[:200]}") for k, t in enumerate(calm)]
    model = toxicity.train(toxicity.gram_counts(spark.createDataFrame(rows, "toxic int, half int, text string")))[1]
    shifted = "".join(chr(ord(c) + 2047) for c in bad)
    unseen = [shifted, *(word("абвгдежзик", 4) for _ in range(200))]
    model.add_words([bad, *unseen])
    ratios = {round(model.kept[w][0], 9) for w in unseen}
    assert len(ratios) == 1 and model.kept[bad][0] > ratios.pop() + 3
    model.add_words(["z"])
    assert model.kept["z"][1] == 1


def brute_ratio(words, text):
    """Log-likelihood ratio of a word by Kneser-Ney over dictionaries: words is {class: Counter of words}."""
    spelt = lambda w: ["^"] * 4 + list(w) + ["$"]
    grams = {c: Counter() for c in words}
    for c, own in words.items():
        for w, n in own.items():
            s = spelt(w)
            for k in range(4, len(s)):
                grams[c][tuple(s[k - 4 : k + 1])] += n
    level, shared = {*grams[0], *grams[1]}, {}
    for k in range(4, 0, -1):
        shared[k] = Counter(g[1:] for g in level)
        level = set(shared[k])

    def backed(table, gram, p):
        own = {g: n for g, n in table.items() if g[:-1] == gram[:-1] and n}
        total = sum(own.values())
        return (max(own.get(gram, 0) - 0.75, 0) + 0.75 * len(own) * p) / total if total else p

    s, ratio = spelt(text), 0.0
    for k in range(4, len(s)):
        gram = tuple(s[k - 4 : k + 1])
        p = (shared[1].get(gram[-1:], 0) + 0.5) / (sum(shared[1].values()) + (len(shared[1]) + 1) / 2)
        for n in (2, 3, 4):
            p = backed(shared[n], gram[-n:], p)
        ratio += np.log(max(backed(grams[1], gram, p), 1e-12)) - np.log(max(backed(grams[0], gram, p), 1e-12))
    return ratio


def test_models_against_brute_force(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcé漢") for _ in range(rng.randrange(1, 7)))
    texts = [(c, h, " ".join(word() for _ in range(12))) for c in (0, 1) for h in (0, 1) for _ in range(4)]
    counts = toxicity.gram_counts(spark.createDataFrame(texts, "toxic int, half int, text string"))
    half, full = toxicity.train(counts)
    probes = sorted({w for *_, t in texts for w in t.split()})[:40] + [word() for _ in range(40)] + ["zzz", "a"]
    for model, halves in ((half, (0,)), (full, (0, 1))):
        words = {c: Counter(w for k, h, t in texts if k == c and h in halves for w in t.split()) for c in (0, 1)}
        both = {c: Counter(w for k, _, t in texts if k == c for w in t.split()) for c in (0, 1)}
        model.add_words(probes)
        for w in probes:
            if model is full:  # the half model shares its lower orders with the full one
                assert abs(model.kept[w][0] - brute_ratio(both, w)) < 1e-9
            elif w in words[0] and w in words[1]:
                assert np.isfinite(model.kept[w][0])


def test_scores_by_joins_are_those_of_the_broadcast_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(None, "idiot idiot idiot trash"), (3, ""), (4, None), (4, None)], docs.schema))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    a, b = (sorted(map(tuple, toxicity.score_toxicity(docs, labels, grams_most=n).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[2])) for n in (10**9, 0))
    assert len(a) == docs.count() and [r[:2] + r[3:] for r in a] == [r[:2] + r[3:] for r in b]
    assert np.abs(np.array([r[2] for r in a]) - np.array([r[2] for r in b])).max() < 1e-9


def test_held_out_toxicity(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    truth = {r["doc_id"]: r["toxic"] for r in labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).collect()}
    rows = [r for r in toxicity.score_toxicity(docs, labels).where("held_out").collect() if truth.get(r["doc_id"]) is not None]
    bad = [r for r in rows if truth[r["doc_id"]]]
    assert len(bad) > 100 and sum(r["predicted"] for r in bad) > 0.85 * len(bad)
    assert sum(r["predicted"] for r in rows if not truth[r["doc_id"]]) < 0.01 * (len(rows) - len(bad))


def test_toxicity_keeps_columns_of_any_name(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", F.lit(1).alias("score"), F.lit("x").alias("Held_Out"), F.lit(None).cast("string").alias("predicted"), F.lit(2).alias("c0"), F.lit(3).alias("toxic"))
    out = toxicity.without_toxic(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert out.columns == docs.columns and 0 < out.count() <= docs.count()
    assert {tuple(r)[2:] for r in out.collect()} == {(1, "x", None, 2, 3)}


def brute_components(texts, percent=80):
    sets = {}
    for k, t in texts:
        w = (t or "").encode().lower().split()
        sets[k] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: (len(s), find(k)) for k, s in sets.items()}


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        k = rng.randrange(len(words))
        words[k : k + 1] = rng.choice([[], [f"n{rng.randrange(50)}"], [words[k], f"i{rng.randrange(50)}"]])
    return words


def test_join_finds_exactly_the_links(spark):
    rng = random.Random(4)
    texts = [None, "", " \t", "One two", "one TWO", "one two three four five", "a b c d e f g h"]
    for size in (5, 6, 8, 9, 12, 20, 45, 90, 200):
        base = [f"w{rng.randrange(60)}" for _ in range(size)]
        texts += [" ".join(edited(rng, base, rng.randrange(0, 1 + size // 12))) if size >= 12 or k % 2 else " ".join(base) for k in range(14)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame([(k, t, "c", 1) for k, t in rows], "doc_id long, text string, component_id string, n_shingles int").repartition(4)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in shingle_join.link_documents(df).collect()}
    assert found == brute_components(rows)
    repeated = df.unionByName(df.where("doc_id in (0, 5)")).unionByName(spark.createDataFrame([(None, texts[5], "", 0)], df.schema))
    out = shingle_join.link_documents(repeated).collect()
    assert len(out) == len(rows) + 3 and {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out if r["doc_id"] is not None} == found
    assert next(r["component_id"] for r in out if r["doc_id"] is None) == found[5][1]
    assert shingle_join.link_documents(df.where("false")).count() == 0
    kept = sorted(r["doc_id"] for r in shingle_join.one_of_each(df).collect())
    assert kept == sorted({c for _, c in found.values()})


def test_join_keys_miss_no_link():
    rng = np.random.default_rng(3)
    for _ in range(3000):
        n = int(rng.choice([rng.integers(1, 12), rng.integers(1, 40), rng.integers(1, 400)]))
        a = np.unique(rng.integers(1, 1 << 60, n).astype(np.uint64))
        most = (2 * len(a)) // 9 + 2
        b = np.unique(np.concatenate([np.delete(a, rng.choice(len(a), min(len(a) - 1, int(rng.integers(0, most))), replace=False)), rng.integers(1, 1 << 60, int(rng.integers(0, most))).astype(np.uint64)]))
        common = len(np.intersect1d(a, b))
        if 100 * common >= 80 * (len(a) + len(b) - common):
            assert len(np.intersect1d(shingle_join.keys_of(a, 80), shingle_join.keys_of(b, 80)))
            assert len(list(shingle_join.bitmap_tree(np.array([len(a), len(b)]), [shingle_join.bitmap(a), shingle_join.bitmap(b)], 80))) == 1


def test_join_equals_brute_force_on_a_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    sets, index, parent = {}, defaultdict(list), {k: k for k, _ in rows}
    for k, t in rows:
        w = (t or "").encode().lower().split()
        sets[k] = {tuple(w[j : j + 5]) for j in range(max(len(w) - 4, 1))} if w else set()

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k in sorted(sets):
        common = Counter(other for x in sets[k] for other in index[x])
        for other, n in common.items():
            if 100 * n >= 80 * (len(sets[k]) + len(sets[other]) - n):
                x, y = find(k), find(other)
                parent[max(x, y)] = min(x, y)
        for x in sets[k]:
            index[x].append(k)
    for options in ({}, {"group_sets": 3}):
        found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in shingle_join.link_documents(docs, **options).collect()}
        assert found == {k: (len(s), find(k)) for k, s in sets.items()}


def test_allocations_compare_costs():
    plans = shingle_join.plans(80, 3000)
    assert any(p.loose == 0 for p in plans if p.limit) and any(p.loose and p.limit > 1 for p in plans) and any(0 < p.loose < p.segments for p in plans)
    assert all((p.segments - p.loose) + 2 * p.loose > p.limit and (p.loose or p.segments > p.limit) for p in plans)


def test_unfinished_components_are_an_error(spark):
    chain = spark.createDataFrame([(k, k + 1) for k in range(200)], "a long, b long")
    assert {r["root"] for r in shingle_join.components(chain).collect()} == {0}
    with pytest.raises(RuntimeError):
        shingle_join.components(chain, rounds=2)


def test_large_components_in_blocks(spark):
    rng = np.random.default_rng(8)
    base = rng.integers(1, 1 << 60, 60).astype(np.uint64)
    sets = [np.unique(np.concatenate([np.delete(base, rng.choice(60, int(rng.integers(0, 12)), replace=False)), rng.integers(1, 1 << 60, int(rng.integers(0, 12))).astype(np.uint64)])) for _ in range(60)]
    weight = sum(map(len, sets))
    df = spark.createDataFrame([(7, k, weight, bytearray(s.astype("<u8").tobytes())) for k, s in enumerate(sets)], "root long, hash long, weight long, elements binary")
    trees = [{frozenset((r["a"], r["b"])) for r in shingle_join._verified(df, 80, bound).collect()} for bound in (1 << 30, 500)]

    def classes(edges):
        parent = list(range(len(sets)))
        for a, b in map(tuple, edges):
            while parent[a] != a:
                a = parent[a]
            while parent[b] != b:
                b = parent[b]
            parent[max(a, b)] = min(a, b)
        root = lambda x: x if parent[x] == x else root(parent[x])
        return [root(k) for k in range(len(sets))]

    assert classes(trees[0]) == classes(trees[1])


def brute_align(item, window):
    best, table = 0, np.zeros((len(item) + 1, len(window) + 1), int)
    for i in range(1, len(item) + 1):
        for j in range(1, len(window) + 1):
            table[i, j] = max(0, table[i - 1, j - 1] + (2 if item[i - 1] == window[j - 1] else -1), table[i - 1, j] - 1, table[i, j - 1] - 1)
            best = max(best, table[i, j])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=12), st.lists(st.integers(-1, 4), max_size=20))
def test_alignment(item, window):
    score, matches, start, stop = decontamination.align(np.array(item), np.array(window, int))
    assert score == brute_align(item, window) and 0 <= start <= stop <= len(window) and matches <= len(item)


def test_decontamination(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    filler = lambda n: [rng.choice(["the", "of", "and"]) if rng.random() < 0.3 else word() for _ in range(n)]
    items = [filler(30) for _ in range(8)] + [["short", "item"]]
    docs = [filler(80) for _ in range(60)]
    planted = set()
    for k in range(0, 24, 2):
        item = list(items[k % 8])
        for _ in range(k % 5):
            item[rng.randrange(len(item))] = word()
        if k % 6 == 0:
            item = [w.upper() + "," for w in item]
        docs[k][20:20] = item
        planted.add((k, k % 8))
    docs[1][5:5] = ["short", "item"]
    planted.add((1, 8))
    rows = [(k, " ".join(d), 1.0) for k, d in enumerate(docs)] + [(100, None, 0.0), (101, "", 0.0), (None, " ".join(items[0]), 0.0), (0, " ".join(docs[0]), 0.0), (102, "the " * 20_000, 0.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, share double")
    bench = spark.createDataFrame([(k, " ".join(i)) for k, i in enumerate(items)] + [(50, None), (51, "")], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.find_copies(df, bench).collect()}
    assert found == planted | {(None, 0)}
    kept = {r["doc_id"] for r in decontamination.without_copies(df, bench).collect()}
    assert kept == {r[0] for r in rows} - {d for d, _ in planted}
    assert decontamination.find_copies(df.where("false"), bench).count() == 0 and decontamination.find_copies(df, bench.where("false")).count() == 0


def test_decontamination_of_a_part_that_leaked_widely(spark):
    rng = random.Random(9)
    words = lambda n: ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n)]
    item = words(60)
    docs = [words(40) + (item if k < 3 else item[:25] if k < 33 else []) + words(40) for k in range(99)]
    df = spark.createDataFrame([(k, " ".join(d)) for k, d in enumerate(docs)], "doc_id long, text string")
    found = decontamination.find_copies(df, spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")).collect()
    assert {r["doc_id"]: (r["matches"], r["first_word"]) for r in found} == {k: (60 if k < 3 else 25, 40) for k in range(33)}


def test_seeds_windows_and_regions_are_bounded():
    rng = np.random.default_rng(4)
    for _ in range(200):
        counts = rng.integers(0, 100, int(rng.integers(1, 60)))
        keep = decontamination.chosen(counts, 10)
        assert keep[counts <= 10].all() and (len(counts) > decontamination.FEW or keep.all())
        assert all(keep[k : k + decontamination.STRETCH].any() for k in range(len(counts) - decontamination.STRETCH + 1))
        size, one = int(rng.integers(1, 40)), 0
        diagonals = np.sort(rng.integers(0, 3000, int(rng.integers(1, 200))))
        found = list(decontamination.windows(diagonals, size, 0.5))
        one = size + 2 * (int(size * 0.5) + 4)
        assert all(z - a <= 4 * one for a, z in found)
        assert all(any(a <= max(0, d - int(size * 0.5) - 4) and d + size + int(size * 0.5) + 4 <= z for a, z in found) for d in diagonals.tolist())
        places, reach = np.unique(rng.integers(0, 50_000, int(rng.integers(1, 3000)))), int(rng.integers(1, 200))
        pieces = list(decontamination.regions_of(places, reach, 50_000))
        assert all(z - a <= max(decontamination.REGION, 8 * reach) for a, z in pieces)
        assert all(any(a <= max(p - reach, 0) and min(p + reach + 1, 50_000) <= z for a, z in pieces) for p in places.tolist())


def test_copies_of_long_items_and_in_long_texts(spark):
    rng = random.Random(10)
    words = lambda n: ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n)]
    item, other = words(1500), words(40)
    docs = [words(30) + item + words(30), words(50) + item[900:960] + words(50), words(200), (words(20) + other) * 400, words(30_000) + other]
    df = spark.createDataFrame([(k, " ".join(d)) for k, d in enumerate(docs)], "doc_id long, text string").repartition(2)
    bench = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(other)), (1, " ".join(item))], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r for r in decontamination.find_copies(df, bench).collect()}
    assert found.keys() == {(0, 1), (1, 1), (3, 2), (4, 2)}
    assert found[4, 2]["first_word"] == 30_000 and found[4, 2]["matches"] == 40 and found[1, 1]["matches"] == 60 and found[1, 1]["first_word"] == 50
    assert found[3, 2]["share"] == 1.0 and found[0, 1]["matches"] == decontamination.PART


def test_pipeline(spark):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        ids = Counter(r["doc_id"] for r in out.select("doc_id").collect())
        assert max(ids.values()) == 1 and 0 < len(ids) <= docs.count()
    rows = corpus_pipeline.run(spark, SF).collect()
    total = defaultdict(int)
    for r in rows:
        total[r["doc_id"]] += r["length"]
    assert rows and all(total[r["doc_id"]] == r["doc_tokens"] for r in rows)
