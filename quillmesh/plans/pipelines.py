"""The end-to-end jobs: rebuild, highlight, calibrate and mine, over tables in a folder.

python -m quillmesh rebuild|highlight|calibrate|mine --input DIR --output DIR [--category_id N | --niche_key N]
"""

from __future__ import annotations

import argparse
import json
import time
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.config import DEFAULT, Config
from quillmesh.functions.text import head_noun, strip_numbers, tokenize
from quillmesh.functions.vector import cosine
from quillmesh.operators import aggregates, attributes, blocking, graph, mining, providers, review, scoring
from quillmesh.sources import sinks, tables


def scope(spark: SparkSession, path: str, category_id: int | None, niche_key: int | None) -> DataFrame:
    """The products of a category or niche, with tokens and vectors of their names without numbers. They are stored, as
    a model's output is used by many steps and should be made once."""
    p = tables.products(spark, path)
    if category_id is None and niche_key is None:
        raise ValueError("a category or a niche is needed")
    p = tables.by_niche(p, niche_key) if niche_key is not None else tables.by_category(p, category_id)
    p = tables.coalesced(p).withColumns({"tokens": tokenize("name"), "plain": strip_numbers("name")})
    return tables.saved(providers.embed(p, "plain").drop("plain"))


@dataclass(frozen=True)
class Given:
    """What a job is given beside its tables: cached readings of images (pk_id, ocr_text, ocr_attrs), schemas (niche_key,
    category_id, separators), weights (category_id, attr, block, type), function tags (pk_id, function) and image
    vectors (pk_id, image), each None where a step has nothing to work on; the arbiter, None to leave it out."""

    readings: DataFrame | None = None
    schemas: DataFrame | None = None
    weights: DataFrame | None = None
    tags: DataFrame | None = None
    images: DataFrame | None = None
    arbiter: Callable[[DataFrame], DataFrame] | None = providers.arbitrate


def given(spark: SparkSession, path: str, skip_llm: bool = False) -> Given:
    """What lies in the input folder."""
    schemas, weights = (tables.file_or_empty(spark, path, n) for n in ("schemas", "weights"))
    optional = {n: tables.table_or_none(spark, path, n) for n in ("readings", "tags", "images")}
    return Given(schemas=None if schemas.isEmpty() else schemas, weights=None if weights.isEmpty() else weights, arbiter=None if skip_llm else providers.arbitrate, **optional)


def attributes_of(products: DataFrame, known: DataFrame, extra: Given, conf: Config = DEFAULT) -> DataFrame:
    """The attributes of products: of the table, of cached readings, and what schemas find; stored."""
    if extra.readings is not None:
        cached = tables.json_attrs(extra.readings, "pk_id", "ocr_attrs")
        number = F.col("value").try_cast("double")
        cached = cached.select("pk_id", "attr", number.alias("value_num"), F.when(number.isNull(), F.col("value")).alias("value_str"), F.lit("").alias("unit"), "is_numeric", "priority", F.col("attr").alias("label"))
        known = attributes.merge(known, cached)
    schemas = None
    if extra.schemas is not None:
        own, wide = extra.schemas.where("niche_key is not null"), extra.schemas.where("niche_key is null")
        schemas = attributes.schema_of(products.select("niche_key", "category_id").distinct(), own, wide)
    return tables.saved(attributes.extract_all(products, known, schemas, extra.readings, conf))


def scored(products: DataFrame, assigned: DataFrame, attrs: DataFrame, review_mode: bool, extra: Given = Given(), conf: Config = DEFAULT) -> DataFrame:
    """Products with score, decision, reason and cluster, stored."""
    m = tables.saved(products.join(assigned, "pk_id"))
    summary = graph.cluster_summary(m).select("cluster_gid", "main_pk", "avg_price", F.col("brand").alias("cluster_brand"), "size")
    centroid = aggregates.centroid_vectors(aggregates.centroids(m, "cluster_gid", "embedding"), "cluster_gid")
    m = m.join(summary, "cluster_gid").join(centroid, "cluster_gid", "left")
    if review_mode:
        m = scoring.price_tiers(m, ["cluster_gid"], "price", ["niche_key"], conf)
        price, ratio, flag = scoring.price_score_of_tier(F.col("tier")), F.col("ratio"), F.col("flag").cast("int")
        price = F.when(F.col("price") > 0, price).otherwise(0.0)
    else:
        price, ratio, flag = scoring.price_score_of_ratio("price", "avg_price"), F.when(F.col("avg_price") > 0, F.col("price") / F.col("avg_price")), F.lit(0)
    own = attrs.join(assigned.select("pk_id", "cluster_gid"), "pk_id")
    sizes = summary.select("cluster_gid", "size")
    m = m.join(scoring.attr_scores(own, sizes, conf), "pk_id", "left").join(scoring.token_scores(m, conf), "pk_id")
    m = m.join(scoring.name_numbers_score(m.select("cluster_gid", "pk_id", "name"), conf), "pk_id", "left")  # for products without attributes
    if extra.weights is not None:
        judged = own.join(products.select("pk_id", "category_id"), "pk_id").withColumn("value_str", F.lower(F.trim("value_str")))
        weights = extra.weights.select("category_id", "attr", "block", "type")
        per = judged.join(weights.where("block").select("category_id", "attr"), ["category_id", "attr"], "left_semi")  # of its own category
        m = m.join(scoring.attr_block(per, weights.select("attr", "block", "type").distinct(), sizes, conf), "pk_id", "left")
    parts = m.withColumns({
        "embedding_score": scoring.embedding_score(cosine("embedding", "centroid")), "brand_score": scoring.brand_score("brand", "cluster_brand"),
        "attr_score": F.coalesce("attr_score", "name_score", F.lit(0.0)), "price_score": price, "item_ratio": F.coalesce(ratio, F.lit(0.0)), "flags": flag,
    })
    parts = tables.saved(parts.drop("embedding", "centroid"))
    return tables.saved(scoring.decide(parts, conf))


def arbitrated(rows: DataFrame, attrs: DataFrame, extra: Given, first_gid: int, conf: Config = DEFAULT) -> DataFrame:
    """rows after the reranker, the arbiter with its guards, and the gates on its moves; stored."""
    rows = tables.saved(scoring.rerank_grey(rows, conf))
    if extra.arbiter is None:
        return rows
    answers = tables.saved(extra.arbiter(rows.where("decision = 'grey' and cluster_gid is not null")))
    placed = attrs.join(rows.where("cluster_gid is not null").select("pk_id", "cluster_gid"), "pk_id").withColumn("tolerance", F.lit(None).cast("double"))
    filled = attributes.infer_fill(placed, rows.select("pk_id", "cluster_gid"), conf)
    numeric = F.col("value_num").isNotNull()
    placed = placed.unionByName(filled.withColumns({"is_numeric": numeric, "priority": F.lit(1)}), allowMissingColumns=True)
    main = graph.cluster_summary(rows.where("cluster_gid is not null")).select("cluster_gid", "main_pk")
    clusters = main.join(rows.select(F.col("pk_id").alias("main_pk"), "niche_key", F.col("tokens").alias("main_tokens")), "main_pk")
    outcomes = tables.saved(review.guarded(answers, rows, clusters, placed, conf))
    before = rows.select("pk_id", F.col("cluster_gid").alias("source"))
    rows = tables.saved(review.settled(rows, outcomes, answers, first_gid, conf))
    moves = rows.where("decision = 'move'").join(before, "pk_id").select("pk_id", "source", F.col("cluster_gid").alias("target"))
    members = before.withColumnRenamed("source", "cluster_gid").where("cluster_gid is not null")
    if extra.tags is not None:
        verdicts = review.function_gate(moves, extra.tags, review.functions_of_clusters(members, extra.tags), conf)
        rows = tables.saved(review.quarantined(rows, verdicts, "FUNCTION"))
    if extra.images is not None:
        left = moves.join(rows.where("decision = 'move'").select("pk_id"), "pk_id", "left_semi")
        verdicts = review.image_gate(review.image_pairs(left, members, extra.images, attrs), conf)
        rows = tables.saved(review.quarantined(rows, verdicts, "IMAGE"))
    return rows


def stats_of(rows: DataFrame) -> DataFrame:
    """(decision, n, mean_score) of a run."""
    return rows.groupBy("decision").agg(F.count("*").alias("n"), F.round(F.avg("score"), 4).alias("mean_score"))


def known_attrs(spark: SparkSession, path: str) -> DataFrame:
    return tables.attrs(spark, path).select("pk_id", "attr", "value_num", "value_str", "unit", "is_numeric", "priority", "label")


def rebuild(
    spark: SparkSession, path: str, category_id: int | None = None, niche_key: int | None = None, conf: Config = DEFAULT, extra: Given | None = None, written: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(assignments, moves): new clusters from blocking and communities, scored, arbitrated and compared with the old
    ones. written: the assignments of earlier runs (pk_id, cluster_gid, score, run_id), the newest of which are the old
    ones and above whose clusters new ones are numbered."""
    extra = given(spark, path) if extra is None else extra
    p = scope(spark, path, category_id, niche_key)
    knn = blocking.nearest_in_cells(p, conf.knn_cells, conf.knn_probes, conf.knn_k, conf.min_similarity) if conf.knn_cells else blocking.nearest(p, conf.knn_k, conf.min_similarity)
    near = tables.saved(blocking.embedding_edges(knn, p, conf))
    edges = tables.saved(blocking.all_edges(near, blocking.brand_edges(p, conf, near)))
    nodes = p.select(F.col("pk_id").alias("node"))
    old = tables.assignments(spark, path)
    taken = old.select("cluster_gid")
    if written is not None:
        newest = tables.latest_assignments(written, p.select("pk_id")).select("pk_id", "cluster_gid")
        old = newest.unionByName(old.join(newest.select("pk_id"), "pk_id", "left_anti"))
        taken = taken.unionByName(written.select("cluster_gid"))
    first = sinks.next_gid(taken).first()["next_gid"]
    gids = tables.saved(graph.allocate_gids(tables.saved(graph.communities(edges, conf.resolution, nodes)), first).select(F.col("node").alias("pk_id"), "cluster_gid"))
    attrs = attributes_of(p, known_attrs(spark, path), extra, conf)
    out = scored(p, gids, attrs, False, extra, conf)
    out = arbitrated(out, attrs, extra, sinks.next_gid(gids.select("cluster_gid").unionByName(taken)).first()["next_gid"], conf)
    kept = out.where("decision <> 'quarantine' and cluster_gid is not null")
    rows = kept.select("pk_id", "cluster_gid", "score", (F.col("pk_id") == F.col("main_pk")).cast("int").alias("main_product"), "niche_key")
    return rows, _moves(out, old)


def highlight(
    spark: SparkSession, path: str, category_id: int | None = None, niche_key: int | None = None, cluster_gid: int | None = None, conf: Config = DEFAULT, extra: Given | None = None,
) -> DataFrame:
    """The moves that a review of the existing clusters proposes."""
    extra = given(spark, path) if extra is None else extra
    p, old = scope(spark, path, category_id, niche_key), tables.assignments(spark, path)
    own = old if cluster_gid is None else old.where(F.col("cluster_gid") == cluster_gid)
    attrs = attributes_of(p, known_attrs(spark, path), extra, conf)
    out = scored(p, own, attrs, True, extra, conf)
    placed = attrs.join(own.select("pk_id", "cluster_gid"), "pk_id")
    late = scoring.anomaly_pass(out.select("pk_id", "cluster_gid", "decision", "reason"), placed, conf)
    out = out.drop("decision", "reason", "cluster_gid").join(late, "pk_id")
    return _moves(arbitrated(out, attrs, extra, sinks.next_gid(old).first()["next_gid"], conf), old)


def _moves(out: DataFrame, old: DataFrame) -> DataFrame:
    rows = out.withColumnRenamed("cluster_gid", "new_gid").join(old.select("pk_id", F.col("cluster_gid").alias("old_gid")), "pk_id", "left")
    titles = out.groupBy(F.col("cluster_gid").alias("gid")).agg(F.max_by("name", F.struct("revenue", "sales", -F.col("pk_id"))).alias("title"))
    return review.moves_of(rows.select("pk_id", "name", "niche_key", "old_gid", "new_gid", "decision", "reason", "confidence", "flags"), titles)


def thresholds(spark: SparkSession, path: str, conf: Config = DEFAULT) -> DataFrame:
    """(category_id, niche_key, score_ok): of each niche, and of each category (niche_key is null)."""
    p = providers.embed(tables.products(spark, path), "name").join(tables.assignments(spark, path), "pk_id")
    niches = tables.saved(mining.niche_thresholds(p, conf))
    whole = mining.category_thresholds(niches).select("category_id", F.lit(None).cast("long").alias("niche_key"), "score_ok")
    return niches.select("category_id", "niche_key", "score_ok").unionByName(whole)


def calibrate(spark: SparkSession, path: str) -> DataFrame:
    p = tables.products(spark, path).select("pk_id", "category_id")
    sizes = tables.assignments(spark, path).groupBy("cluster_gid").agg(F.count("*").alias("size"))
    return mining.attr_weights(tables.attrs(spark, path).join(p, "pk_id"), sizes)


def mine(spark: SparkSession, path: str, most: int = 10_000, conf: Config = DEFAULT, by_head: bool = False) -> DataFrame:
    """Training pairs in a shuffled order: positives, and as many negatives: half hard and half easy ones, or (by_head)
    of one niche with different head nouns, of one head noun in different clusters, and easy ones."""
    p = tables.saved(providers.embed(tables.products(spark, path), "name").join(tables.assignments(spark, path), "pk_id"))
    good = mining.positive_pairs(p, conf)
    n = mining.budgets(good.count(), most, conf)
    if by_head:
        headed = p.withColumn("head", head_noun("name")).where("head is not null")
        hard = mining.hard_negatives(headed, ["niche_key"], "head", "hard_neg_head", conf.head_band, n["head"])
        hard = hard.unionByName(mining.hard_negatives(headed, ["niche_key", "head"], "cluster_gid", "hard_neg_p1", conf.head_band, n["p1"])).drop("cosine")
        easy = n["rest"]
    else:
        hard, easy = mining.hard_negatives(p, ["niche_key"], "cluster_gid", "hard_neg", conf.hard_band, n["hard"]).drop("cosine"), n["easy"]
    pairs = good.unionByName(hard).unionByName(mining.easy_negatives(p, easy)).dropDuplicates(["pk_left", "pk_right"])
    return pairs.orderBy(mining.pair_key("pk_left", "pk_right"), "pk_left", "pk_right").limit(most)


def main(args: list[str] | None = None) -> None:
    from quillmesh.session import session

    ap = argparse.ArgumentParser(prog="quillmesh", description=__doc__)
    ap.add_argument("job", choices=["rebuild", "highlight", "calibrate", "mine"])
    ap.add_argument("--input", required=True)
    ap.add_argument("--output", required=True)
    for name in ("category_id", "niche_key", "cluster_gid", "run_id"):
        ap.add_argument(f"--{name}", type=int)
    ap.add_argument("--resolution", type=float, default=DEFAULT.resolution)
    for name in ("dry_run", "skip_llm", "by_head"):
        ap.add_argument(f"--{name}", action="store_true")
    a = ap.parse_args(args)
    spark = session("quillmesh")
    conf, stats = replace(DEFAULT, resolution=a.resolution), {"job": a.job}
    began = time.time()
    if a.job == "rebuild":
        written = tables.table_or_none(spark, a.output, "assignments")
        rows, moves = rebuild(spark, a.input, a.category_id, a.niche_key, conf, given(spark, a.input, a.skip_llm), written)
        rows, moves = tables.saved(rows), tables.saved(moves)
        stats |= {"n_assignments": rows.count(), "n_clusters": rows.select("cluster_gid").distinct().count(), "n_moves": moves.count()}
        if not a.dry_run:
            history = spark.createDataFrame([], "run_id long") if written is None else written
            stats["run_id"] = a.run_id or sinks.next_run_id(history).first()["next_run_id"]
            sinks.write_assignments(rows, f"{a.output}/assignments.parquet", stats["run_id"])
            sinks.write_moves(moves, f"{a.output}/moves")
    elif a.job == "highlight":
        moves = tables.saved(highlight(spark, a.input, a.category_id, a.niche_key, a.cluster_gid, conf, given(spark, a.input, a.skip_llm)))
        stats["n_moves"] = moves.count()
        if not a.dry_run:
            sinks.write_moves(moves, f"{a.output}/moves")
    elif a.job == "calibrate":
        sinks.write_json(calibrate(spark, a.input), f"{a.output}/weights")
        sinks.write_json(thresholds(spark, a.input), f"{a.output}/thresholds")
    else:
        sinks.write_pairs(mine(spark, a.input, by_head=a.by_head), f"{a.output}/pairs")
    print(json.dumps(stats | {"elapsed_seconds": round(time.time() - began, 1)}))


if __name__ == "__main__":
    main()
