"""Golden cases, invariants and round trips of the operators."""

import random
import subprocess
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmesh.functions import text as text_functions
from quillmesh.functions import vector
from quillmesh.functions.text import same_brand
from quillmesh.operators import aggregates, attributes, blocking, graph, mining, pairs, providers, review, scoring
from quillmesh.plans import catalogue, pipelines
from quillmesh.sources import sinks, tables

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("values,group,dominant", [([10, 11, 12, 20], 3, 11), ([-2.5, -2.5, -3.0], 0, None), ([1, 10, 100], 1, None), ([5, 5, 5], 3, 5)])
def test_dominant_group(spark, values, group, dominant):
    df = spark.createDataFrame([(1, float(v)) for v in values], "k int, v double")
    r = aggregates.dominant_groups(df, ["k"], "v").first()
    assert (r["group_size"], r["dominant"]) == (group, dominant)


def test_bands_and_quartiles_by_brute_force(spark):
    rng = random.Random(2)
    groups = {k: [rng.choice([-3.0, 0.0, 1.0, 10.0]) * round(rng.uniform(0.5, 2.0), 1) for _ in range(rng.randrange(1, 40))] for k in [None, *range(12)]}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs] + [(99, None)], "k int, v double").repartition(3)
    bands = {r["k"]: r for r in aggregates.dominant_groups(df, ["k"], "v").collect()}
    quartiles = {r["k"]: r for r in aggregates.index_quartiles(df, ["k"], "v").collect()}
    assert bands.keys() == quartiles.keys() == groups.keys()
    for k, values in groups.items():
        s = sorted(values)
        near = [[x for x in s if a * 0.85 <= x <= a * 1.15] for a in sorted(set(s))]
        best = max(near, key=len)  # the first of equals
        kernel = best[len(best) // 2] if best else None
        assert (bands[k]["n"], bands[k]["n_distinct"], bands[k]["group_size"], bands[k]["kernel"]) == (len(s), len(set(s)), len(best), kernel)
        assert bands[k]["dominant"] == (kernel if len(best) / len(s) >= 0.4 else None)
        assert tuple(quartiles[k])[1:] == (len(s), s[len(s) // 4], s[len(s) // 2], s[len(s) * 3 // 4])


def test_a_group_of_many_values(spark):
    df = spark.range(100_000).select(F.lit(1).alias("k"), (F.col("id") * 7919 % 100_003 + 1).cast("double").alias("v"))
    values = sorted(k * 7919 % 100_003 + 1.0 for k in range(100_000))
    assert tuple(aggregates.index_quartiles(df, ["k"], "v").first()) == (1, 100_000, values[25_000], values[50_000], values[75_000])
    found = aggregates.dominant_groups(df, ["k"], "v").first()
    assert found["n_distinct"] == 100_000 and 25_000 < found["group_size"] < 27_000


@pytest.mark.parametrize("price,want", [(100, (3, 0, 3.333, 1)), (15, (0, 0, 0.5, 0)), (30, (1, 0, 1.0, 0)), (50, (2, 0, 1.667, 0)), (0, (1, 0, 1.0, 0))])
def test_price_tiers(spark, price, want):
    rows = [(k, 1, 1, float(p)) for k, p in enumerate([10, 20, 30, 40])]
    own = spark.createDataFrame([*rows, (9, 1, 1, 0.0)], "pk long, gid int, niche int, price double")
    stats = scoring.price_tiers(own.unionByName(spark.createDataFrame([(100, 1, 2, -1.0)], own.schema)), ["gid"], "price", ["niche"])
    assert stats.count() == 6
    if price in (10, 20, 30, 40, 0):
        r = scoring.price_tiers(own, ["gid"], "price").where(F.col("price") == price).first()
        assert (r["tier"], r["src"], r["ratio"], r["flag"]) == want


def test_codes(spark):
    codes = ["00000000", "11111112", "1234567", *["12345678"] * 2, *["87654321"] * 51, *["11223344"] * 50]
    edges = blocking.code_edges(spark.createDataFrame(list(enumerate(codes)), "pk_id long, ean string"), "ean")
    assert edges.count() == 1 + 1225 and edges.where("a >= b").count() == 0


def test_nearest_in_cells(spark):
    rng = np.random.default_rng(7)
    centers = rng.normal(size=(12, 16))
    rows = [(k, (centers[k % 12] + 0.4 * rng.normal(size=16)).tolist()) for k in range(900)]
    df = spark.createDataFrame(rows, "pk_id long, embedding array<double>")
    pairs = lambda d: {(r["pk_id"], r["other"]) for r in d.collect()}
    exact = pairs(blocking.nearest(df, 10, 0.3, block=200))
    some = pairs(blocking.nearest_in_cells(df, 16, 4, 10, 0.3, block=50))
    assert len(exact & some) > 0.9 * len(exact)
    assert pairs(blocking.nearest_in_cells(df, 6, 6, 10, 0.3, block=100)) == exact


def test_hard_negatives_in_blocks(spark):
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(120, 6))
    df = spark.createDataFrame([(k, k % 2, k % 5, vectors[k].tolist()) for k in range(120)], "pk_id long, niche long, gid long, embedding array<double>")
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    want = {(a, b) for a in range(120) for b in range(a + 1, 120) if a % 2 == b % 2 and a % 5 != b % 5 and 0.2 <= unit[a] @ unit[b] <= 0.9}
    for block in (7, 1000):
        found = [(r["pk_left"], r["pk_right"]) for r in mining.hard_negatives(df, ["niche"], "gid", "x", (0.2, 0.9), block=block).collect()]
        assert len(found) == len(want) and set(found) == want
        first = [(r["pk_left"], r["pk_right"]) for r in mining.hard_negatives(df, ["niche"], "gid", "x", (0.2, 0.9), 25, block).collect()]
        assert len(first) == 25 and set(first) <= want


def by_join(df, score):
    """Every pair of a key by a join of the rows, as the pair queries once made them."""
    x, y = df.select("k", F.col("pk_id").alias("a"), F.col("v").alias("x")), df.select("k", F.col("pk_id").alias("b"), F.col("v").alias("y"))
    return x.join(y, "k").where("a < b").select("a", "b", score(F.col("x"), F.col("y")).alias("s"))


def same_rows(found, want):
    text = lambda d: sorted((r["a"], r["b"], None if r["s"] is None else str(round(r["s"], 9) + 0.0)) for r in d.collect())
    rows = text(found)
    assert rows == text(want) and rows


@pytest.mark.parametrize("block", [3, 1000])
def test_price_ratios_in_blocks(spark, block):
    prices = [None, 0.0, -1.0, float("nan"), float("inf"), 900.0, 900.0, 1899.0, 0.1, 1e-300, *map(float, range(1, 30))]
    df = spark.createDataFrame([(k, k % 2 if k else None, v) for k, v in enumerate(prices * 2)], "pk_id long, k long, v double")
    found = pairs.pairs_within(df, ["k"], "pk_id", F.col("v"), pairs.price_ratios, "s", block)
    same_rows(found, by_join(df, lambda x, y: F.round(text_functions.price_ratio(x, y), 9)))
    assert pairs.pairs_within(df.where("false"), ["k"], "pk_id", F.col("v"), pairs.price_ratios, "s").count() == 0


@pytest.mark.parametrize("block", [3, 1000])
def test_token_overlaps_in_blocks(spark, block):
    rng = random.Random(3)
    lists = [None, [], ["a"], ["a", "a", "b"], *[[rng.choice("abcdefg") for _ in range(rng.randrange(6))] for _ in range(40)]]
    df = spark.createDataFrame([(k, k % 2, v) for k, v in enumerate(lists)], "pk_id long, k long, v array<string>")
    found = pairs.pairs_within(df, ["k"], "pk_id", F.col("v"), pairs.token_overlaps, "s", block)
    same_rows(found, by_join(df, lambda x, y: F.round(text_functions.token_overlap(x, y), 9)))


@pytest.mark.parametrize("block", [3, 1000])
def test_cosines_in_blocks(spark, block):
    rng = np.random.default_rng(4)
    vectors = [None, [], [0.0] * 4, [1.0, None, 1.0, 1.0], [1.0, 2.0], *rng.normal(size=(40, 4)).tolist()]
    df = spark.createDataFrame([(k, k % 2, v) for k, v in enumerate(vectors)], "pk_id long, k long, v array<double>")
    found = pairs.pairs_within(df, ["k"], "pk_id", F.col("v"), pairs.cosines, "s", block)
    same_rows(found, by_join(df, lambda x, y: F.round(vector.cosine(x, y), 6)))


@pytest.mark.parametrize("name, score", [("price_ratio_pairs", "greatest"), ("token_overlap_pairs", "array_union"), ("cosine_pairs", "zip_with")])
def test_pair_queries_score_blocks(spark, name, score):
    plan = catalogue.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and score not in plan


def test_unfinished_components_are_an_error(spark):
    chain = spark.createDataFrame([(k, k + 1) for k in range(100)], "a long, b long")
    with pytest.raises(RuntimeError):
        graph.connected_components(chain, rounds=2)


def test_edge_weight(spark):
    def weight(sim, a, b, jac, ratio):
        df = spark.createDataFrame([(a, b)], "a string, b string")
        match, known = same_brand(F.col("a"), F.col("b")), (F.col("a") != "") & (F.col("b") != "")
        return df.select(blocking.edge_weight(F.lit(sim), match, known, F.lit(jac), F.lit(ratio))).first()[0]

    assert weight(0.90, "x", "x", 0.6, 1.0) == pytest.approx(0.925)
    assert weight(0.90, "x", "y", 0.0, 1.0) == pytest.approx(0.5355)
    assert weight(0.95, "", "", 0.0, 6.0) == pytest.approx(0.6575)


def test_anomaly_pass(spark):
    def run(values):
        d = spark.createDataFrame([(k, 1, "ok", "") for k in range(len(values))], "pk_id long, cluster_gid long, decision string, reason string")
        a = spark.createDataFrame([(k, 1, "size", float(v), True, 1) for k, v in enumerate(values)], "pk_id long, cluster_gid long, attr string, value_num double, is_numeric boolean, priority int")
        return sorted(r["decision"] for r in scoring.anomaly_pass(d, a).collect())

    assert run([10, 10, 12]) == ["grey"] * 3 and run([10, 10, 11]) == ["ok"] * 3 and run([1]) == ["grey"] and run([1, 1]) == ["grey"] * 2


def test_decide(spark):
    cols = "embedding_score double, token_score double, brand_score double, attr_score double, price_score double, blocker boolean, item_ratio double, cluster_gid long"
    rows = [(0.15, 0.05, 0.03, 0.0, 0.0, False, 1.0, 1), (0.35, 0.15, 0.10, 0.10, 0.05, False, 1.0, 1), (0.35, 0.15, 0.10, 0.10, 0.05, True, 4.0, 1), (0.0, 0.0, 0.0, -0.25, -0.05, False, 1.0, 1), (0.0,) * 5 + (False, 1.0, None)]
    out = scoring.decide(spark.createDataFrame(rows, cols)).collect()
    assert [(r["score"], r["decision"]) for r in out] == [(0.5048, "grey"), (1.0, "ok"), (1.0, "grey"), (0.0, "quarantine"), (0.0, "grey")]
    assert out[2]["reason"].startswith("[COMPOUND] 2 проблем | ") and out[4]["confidence"] == 0.5


def random_graph(n, seed):
    rng = random.Random(seed)
    return [(a, b, rng.random()) for a in range(n) for b in range(a + 1, n) if rng.random() < (0.6 if a // 6 == b // 6 else 0.03)]


def quality(edges, part, resolution=1.0):
    total = 2 * sum(w for *_, w in edges)
    degree = Counter()
    for a, b, w in edges:
        degree[a] += w
        degree[b] += w
    inside = sum(2 * w for a, b, w in edges if part[a] == part[b])
    sums = Counter()
    for n, d in degree.items():
        sums[part[n]] += d
    return inside - resolution * sum(s * s for s in sums.values()) / total


def test_communities(spark):
    edges = random_graph(30, 3) + [(100, 101, 1.0), (101, 102, 1.0)]
    df = spark.createDataFrame(edges, "a long, b long, weight double")
    nodes = spark.createDataFrame([(n,) for n in [*range(30), 100, 101, 102, 500]], "node long")
    part = {r["node"]: r["community"] for r in graph.communities(df, vertices=nodes).collect()}
    comp = {r["node"]: r["component"] for r in graph.connected_components(df, nodes).collect()}
    assert set(part) == set(comp) and part[500] == 500 and part[100] == part[102] == 100
    assert all(comp[n] == comp[part[n]] for n in part)
    assert quality(edges, part) >= max(quality(edges, comp), quality(edges, {n: n for n in part})) - 1e-9
    shuffled = df.orderBy(F.rand(1)).repartition(3)
    assert {r["node"]: r["community"] for r in graph.communities(shuffled, vertices=nodes).collect()} == part
    near = {n: set() for n in part}
    for a, b, _ in edges:
        near[a].add(b)
        near[b].add(a)
    for c in set(part.values()):  # communities are connected
        members, seen, queue = {n for n in part if part[n] == c}, {c}, [c]
        while queue:
            for m in near[queue.pop()] & members - seen:
                seen.add(m)
                queue.append(m)
        assert seen == members


def test_components_of_a_chain_and_a_star(spark):
    chain = [(k, k + 1) for k in range(200)]
    star = [(1000, k) for k in range(1001, 1300)]
    df = spark.createDataFrame(chain + star + [(5, 5)], "a long, b long")
    got = {r["node"]: r["component"] for r in graph.connected_components(df).collect()}
    assert {got[k] for k in range(201)} == {0} and {got[k] for k in range(1000, 1300)} == {1000}


def test_nearest_in_blocks(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(60, 8))
    df = spark.createDataFrame([(k, [float(x) for x in row]) for k, row in enumerate(v)], "pk_id long, embedding array<double>")
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    want = {(i, j) for i in range(60) for j in sorted((j for j in range(60) if j != i and u[i] @ u[j] >= 0.2), key=lambda j: (-round(float(u[i] @ u[j]), 12), j))[:5]}
    for block in (7, 1000):
        assert {(r["pk_id"], r["other"]) for r in blocking.nearest(df, 5, 0.2, block=block).collect()} == want


def test_pack_batches(spark):
    rows = [(1, k, f"s{k % 3}" if k % 4 else None) for k in range(23)] + [(2, 100, "x")]
    out = review.pack_batches(spark.createDataFrame(rows, "cluster_gid long, pk_id long, signature string"), 5).collect()
    assert sorted(r["pk_id"] for r in out) == sorted(r[1] for r in rows)
    assert max(Counter((r["cluster_gid"], r["batch"]) for r in out).values()) <= 5


def test_move_checks(spark):
    attrs = [(1, 1, 10.0), *[(k, 2, 11.0) for k in (20, 21)], *[(k, 3, 25.0) for k in (30, 31)], *[(k, 4, 15.0) for k in (40, 41)], *[(k, 5, 30.0) for k in (50, 51)], *[(k, 6, 12.0) for k in (60, 61)]]
    a = spark.createDataFrame([(p, g, "size", v, True, 1) for p, g, v in attrs], "pk_id long, cluster_gid long, attr string, value_num double, is_numeric boolean, priority int")
    moves = lambda src, tgt: spark.createDataFrame([(1, src, tgt)], "pk_id long, cluster_gid long, target long")
    got = [review.move_checks(moves(s, t), a).first()["fits"] for s, t in [(99, 2), (99, 3), (5, 4), (6, 4), (99, 4)]]
    assert got == [True, False, True, False, False]


def test_diff_table(spark):
    rows = [(1, 5, 5, "ok"), (2, 5, 5, "quarantine"), (3, 5, 9, "quarantine"), (4, 5, 9, "grey"), (5, 5, 0, "move"), (6, None, 9, "ok"), (7, 5, None, "ok"), (8, 5, None, "move")]
    df = spark.createDataFrame([(p, "n", 1, o, n, d, "r", 0.5, 0) for p, o, n, d in rows], "pk_id long, name string, niche_key long, old_gid long, new_gid long, decision string, reason string, confidence double, flags int")
    out = {r["pk_id"]: (r["target_action"], r["old_cluster"], r["new_cluster"]) for r in review.moves_of(df, spark.createDataFrame([(9, "t")], "gid long, title string")).collect()}
    assert out == {4: ("move", 5, 9), 5: ("create", 5, 0), 6: ("create", 0, 9), 8: ("create", 5, 0)}
    again = review.moves_of(df, spark.createDataFrame([(9, "t")], "gid long, title string"))
    assert {r["idempotency_key"] for r in again.collect()} == {r["idempotency_key"] for r in review.moves_of(df.repartition(3), spark.createDataFrame([(9, "t")], "gid long, title string")).collect()}


def test_ids(spark):
    for most, want in [(None, 100), (41, 100), (100, 101)]:
        assert sinks.next_run_id(spark.createDataFrame([(most,)], "run_id int")).first()[0] == want
    assert sinks.next_gid(spark.createDataFrame([], "cluster_gid long")).first()[0] == 400_001


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, 2, 0.123456789)], "pk_id long, cluster_gid long, score double")
    for _ in range(2):
        sinks.write_assignments(rows, f"{tmp_path}/a", 100)
    sinks.write_assignments(rows, f"{tmp_path}/a", 101)
    back = spark.read.parquet(f"{tmp_path}/a")
    assert sorted((r["run_id"], r["score"]) for r in back.collect()) == [(100, 0.123457), (101, 0.123457)]
    groups = spark.createDataFrame([("c", ["v"])], "canonical string, variants array<string>")
    sinks.write_json(groups, f"{tmp_path}/s")
    assert tables.first_that_exists(spark, f"{tmp_path}/none", f"{tmp_path}/s").first()["canonical"] == "c" and tables.first_that_exists(spark, f"{tmp_path}/none") is None
    pairs = spark.createDataFrame([(1, 2, 1, "positive", 0.5), (1, 9, 0, "x", 0.1)], "pk_left long, pk_right long, label int, type string, cosine double")
    sinks.write_pairs(pairs, f"{tmp_path}/p")
    named = tables.training_pairs(spark, f"{tmp_path}/p", spark.createDataFrame([(1, "a"), (2, "b"), (9, "")], "pk_id long, name string"))
    assert [tuple(r) for r in named.collect()] == [(1, 2, "a", "b", 1)]


def test_numbered_keys_are_consecutive(spark):
    df = spark.createDataFrame([(f"k{n % 57:03}",) for n in range(500)], "k string").repartition(5)
    got = sorted((r["k"], r["n"]) for r in tables.numbered(df, "n", 10).collect())
    assert got == [(f"k{n:03}", 11 + n) for n in range(57)]


def test_infer_fill(spark):
    def run(values, missing=1):
        a = spark.createDataFrame([(k, 1, "size", v, None, None, 1) for k, v in enumerate(values)], "pk_id long, cluster_gid long, attr string, value_num double, value_str string, tolerance double, priority int")
        m = spark.createDataFrame([(k, 1) for k in range(len(values) + missing)], "pk_id long, cluster_gid long")
        return attributes.infer_fill(a, m).count()

    assert run([5.0] * 3) == 1 and run([5.0] * 2) == 0 and run([5.0, 5.0, 6.0]) == 0


def test_extract_units(spark):
    sep = "array<struct<attr:string,regex:string,unit:string,unit_factor:map<string,double>,numeric:boolean,priority:int,label:string,tolerance:double>>"
    schema = spark.createDataFrame([(1, [("len", r"(\d+)\s*(см|м)", "м", {"м": 1.0, "см": 0.01}, True, 1, "Длина", None)])], f"niche_key long, separators {sep}")
    texts = spark.createDataFrame([(1, 1, "30 см"), (2, 1, None), (3, 2, "30 см")], "pk_id long, niche_key long, text string")
    assert [(r["pk_id"], r["value_num"], r["raw_match"]) for r in attributes.extract(texts, schema).collect()] == [(1, pytest.approx(0.3), "30 см")]


def test_positive_pairs_are_disjoint(spark):
    m = spark.createDataFrame([(g, g * 100 + k) for g, n in ((1, 2), (2, 3), (3, 25), (4, 51)) for k in range(n)], "cluster_gid long, pk_id long")
    pairs = mining.positive_pairs(m).collect()
    used = [p for r in pairs for p in (r["pk_left"], r["pk_right"])]
    assert len(used) == len(set(used)) and len(pairs) == 1 + 5
    assert mining.budgets(100, 150) == {"total": 50, "hard": 25, "easy": 25, "head": 30, "p1": 12, "rest": 8}


def test_providers(spark):
    v = providers.hashed_trigrams(["abc", "", "abc"])
    assert np.allclose(np.linalg.norm(v, axis=1), [1, 0, 1]) and np.allclose(v[0], v[2])
    df = spark.createDataFrame([(1, "u")], "pk_id long, url string")
    assert providers.read_images(df, lambda u: u.upper()).first()["ocr_text"] == "U"
    assert providers.replay(df, providers.arbitrate(df.limit(0))).first()["decision"] is None


def test_jobs_run_and_highlight_is_idempotent(spark, tmp_path):
    moves = pipelines.highlight(spark, SF, category_id=1)
    assert moves.count() == 0 or moves.where("old_cluster = new_cluster").count() == 0
    rows, moved = pipelines.rebuild(spark, SF, niche_key=1)
    assert rows.count() > 0 and set(moved.select("target_action").distinct().toPandas().target_action) <= {"move", "create"}
    assert pipelines.calibrate(spark, SF).columns[:2] == ["category_id", "attr"]
    pairs = pipelines.mine(spark, SF, 40)
    assert 0 < pairs.count() <= 40
    with pytest.raises(ValueError):
        pipelines.scope(spark, SF, None, None)


def golden_inputs(spark, tmp_path):
    """Two clusters of one type whose sizes differ, hand-made so that each stage of a review changes a row."""
    part = [(k, "red steel pipe", "Brand#1", "PIPE", 10 if k < 12 else 11, 100.0) for k in range(14)]
    part += [(k, "blue garden hose", "Brand#2", "PIPE", 50, 100.0) for k in range(20, 32)] + [(40, "red steel pipe", "Brand#1", "PIPE", 50, 100.0), (41, "red steel pipe", "Brand#1", "PIPE", 10, 900.0)]
    spark.createDataFrame(part, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(r[0], 1.0, float(100 - r[0])) for r in part], "l_partkey long, l_quantity double, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    readings = spark.createDataFrame([(0, "Wall 3 mm", '{"wall": 3}')], "pk_id long, ocr_text string, ocr_attrs string")
    separators = [("color", "^(red|blue)", "", None, False, 2, "Color", None)]
    schemas = spark.createDataFrame([(1, None, separators)], tables.FILES["schemas"])
    weights = spark.createDataFrame([(c, "size", True, "numeric") for c in (1, 2, 3)], "category_id long, attr string, block boolean, type string")
    return str(tmp_path), readings, schemas, weights


def test_each_stage_of_a_review_changes_rows(spark, tmp_path):
    path, readings, schemas, weights = golden_inputs(spark, tmp_path)
    p = pipelines.scope(spark, path, None, 1)
    old = tables.assignments(spark, path)
    full = pipelines.Given(readings, schemas, weights)
    attrs = pipelines.attributes_of(p, pipelines.known_attrs(spark, path), full)
    found = {(r["pk_id"], r["attr"]) for r in attrs.collect()}
    assert (0, "wall") in found and (40, "color") in found and len([x for x in found if x[1] == "size"]) == p.count()
    plain, blocked = (pipelines.scored(p, old, attrs, True, g) for g in (pipelines.Given(), full))
    reasons = {r["pk_id"]: r["reason"] for r in blocked.collect()}
    assert "АТРИБУТ-БЛОКЕР" in reasons[40] and not any("АТРИБУТ" in r["reason"] for r in plain.collect())
    red, blue = (old.where(f"pk_id = {k}").first()["cluster_gid"] for k in (0, 20))
    answers = {40: (f"move:K{blue}", "size of the hose", 0.9), 12: ("new:", "", 0.5), 13: ("quarantine", "odd", 0.8), 3: (f"move:{blue}", "looks alike", 0.9)}
    grey = blocked.withColumns({"decision": F.when(F.col("pk_id").isin(3, 12, 13, 40), "grey").otherwise(F.col("decision")), "name": F.when(F.col("pk_id").isin(3, 12, 13, 40), F.concat("name", F.lit(" hose garden blue kit set new extra"))).otherwise(F.col("name"))})
    grey = tables.saved(grey.withColumn("tokens", F.split("name", " ")))
    arbiter = lambda rows: rows.sparkSession.createDataFrame([(k, *a) for k, a in answers.items()], "pk_id long, decision string, reason string, confidence double")
    run = lambda **x: {r["pk_id"]: r for r in pipelines.arbitrated(grey, attrs, pipelines.Given(arbiter=arbiter, **x), 900_000).collect()}
    settled = run()
    assert "RERANK" in settled[40]["reason"]
    assert (settled[40]["decision"], settled[40]["cluster_gid"]) == ("move", blue)
    assert (settled[13]["decision"], settled[12]["decision"]) == ("quarantine", "quarantine") and "label" in settled[12]["reason"]
    assert settled[3]["decision"] == "quarantine" and "numbers" in settled[3]["reason"]  # 10 mm doesn't go to 50 mm
    tags = spark.createDataFrame([(40, "pipe")] + [(k, "hose") for k in range(20, 26)], "pk_id long, function string")
    gated = run(tags=tags)
    assert gated[40]["decision"] == "quarantine" and "FUNCTION" in gated[40]["reason"]
    images = spark.createDataFrame([(k, [1.0, 0.1 * (k % 3)]) for k in [*range(6), 40]] + [(k, [0.1 * (k % 3), 1.0]) for k in range(20, 26)], "pk_id long, image array<double>")
    seen = run(images=images)
    assert seen[40]["decision"] == "quarantine" and "IMAGE" in seen[40]["reason"]
    without = pipelines.arbitrated(grey, attrs, pipelines.Given(arbiter=None), 900_000)
    assert without.where("decision = 'move'").count() == 0


def test_runs_are_numbered_and_kept(spark, tmp_path):
    rows = spark.createDataFrame([(1, 400_001, 0.5, 1, 2)], "pk_id long, cluster_gid long, score double, main_product int, niche_key long")
    for _ in range(2):
        written = tables.table_or_none(spark, str(tmp_path), "assignments")
        history = spark.createDataFrame([], "run_id long") if written is None else written
        sinks.write_assignments(rows, f"{tmp_path}/assignments.parquet", sinks.next_run_id(history).first()["next_run_id"])
    assert sorted(r["run_id"] for r in spark.read.parquet(f"{tmp_path}/assignments.parquet").collect()) == [100, 101]
    assert tables.file_or_empty(spark, str(tmp_path), "weights").count() == 0
    sinks.write_json(pipelines.thresholds(spark, SF), f"{tmp_path}/thresholds")
    assert tables.file_or_empty(spark, str(tmp_path), "thresholds").where("niche_key is null").count() > 0


def test_streaming(spark, tmp_path):
    from quillmesh.streaming.incremental import score_stream

    events = spark.read.parquet(f"{SF}/events.parquet")
    events.write.parquet(f"{tmp_path}/in")
    feed = spark.readStream.schema(events.schema).parquet(f"{tmp_path}/in")
    q = score_stream(feed, lambda b: scoring.price_tiers(b, ["user_id", "event_type"], "value"), f"{tmp_path}/out", f"{tmp_path}/state")
    q.awaitTermination(120)
    assert spark.read.parquet(f"{tmp_path}/out").count() == events.count()


def test_nothing_outside_imports_the_subpackage():
    root = Path(__file__).resolve().parents[1] / "quillmesh"
    name = "quillmesh." + "llm"
    assert not [p for p in root.rglob("*.py") if "llm" not in p.relative_to(root).parts[0] and name in p.read_text()]
    code = "import sys, importlib.abc\nclass F(importlib.abc.MetaPathFinder):\n def find_spec(self, n, p, t=None):\n  if n.startswith(%r) or n == 'corpus_pipeline': raise ModuleNotFoundError('no', name=n)\nsys.meta_path.insert(0, F())\nimport __spark_entry__ as e\nassert not [q for q in e.queries() if q.startswith('op') and q[2:3].isdigit()] and 'pipeline' not in e.queries() and len(e.queries()) > 90" % name
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root.parent)
