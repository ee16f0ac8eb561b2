"""Scores of products against their clusters. Everything that the members of a cluster share is computed once for the
cluster and joined back, so the work is linear in the members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.config import DEFAULT, Config
from quillmesh.functions.text import brand_match, numeric_attrs, price_ratio
from quillmesh.operators.providers import rerank
from quillmesh.operators.aggregates import capped_members, dominant_groups, index_quartiles, modal_values, without_outliers


def embedding_score(sim: Column) -> Column:
    return F.coalesce(F.least(F.greatest((sim - 0.5) * 0.7778, F.lit(0.0)), F.lit(0.35)), F.lit(0.15))


def core_tokens(members: DataFrame, conf: Config = DEFAULT) -> DataFrame:
    """(cluster_gid, token, n) of members (cluster_gid, pk_id, tokens): tokens that occur often enough in the first
    members, twice at least."""
    first = capped_members(members, "cluster_gid", conf.core_members)
    sizes = first.groupBy("cluster_gid").agg(F.count("*").alias("sampled"))
    counts = first.select("cluster_gid", F.explode("tokens").alias("token")).groupBy("cluster_gid", "token").agg(F.count("*").alias("n"))
    return counts.join(sizes, "cluster_gid").where(F.col("n") >= F.greatest(F.lit(2.0), F.col("sampled") * conf.core_share)).select("cluster_gid", "token", "n")


def token_scores(members: DataFrame, conf: Config = DEFAULT) -> DataFrame:
    """(pk_id, token_score): 0.15 times the share of core tokens that the product has; 0.05 where either is missing."""
    core = core_tokens(members, conf).groupBy("cluster_gid").agg(F.collect_set("token").alias("core"))
    share = F.size(F.array_intersect("tokens", "core")) / F.size("core")
    known = F.col("core").isNotNull() & (F.size("tokens") > 0)
    return members.join(core, "cluster_gid", "left").select("pk_id", F.when(known, share * 0.15).otherwise(0.05).alias("token_score"))


def brand_score(brand: str, cluster_brand: str) -> Column:
    match = brand_match(brand, cluster_brand)  # one row a product, so both sides are normalised here
    unknown = (F.coalesce(F.col(brand), F.lit("")) == "") | (F.coalesce(F.col(cluster_brand), F.lit("")) == "")
    return F.when(unknown, 0.03).when(match == 1.0, 0.10).when(match == 0.5, 0.05).otherwise(0.0)


def attr_scores(attrs: DataFrame, sizes: DataFrame, conf: Config = DEFAULT) -> DataFrame:
    """(pk_id, attr_score, blocker) of numeric attributes (pk_id, cluster_gid, attr, value_num, priority)."""
    numeric = attrs.where("is_numeric and value_num is not null")
    kept = without_outliers(numeric, "cluster_gid", "attr", "value_num", sizes, conf.outlier_cluster)
    groups = dominant_groups(kept, ["cluster_gid", "attr"], "value_num", conf.dominance_numeric)
    v, d, k, low, high = F.col("value_num"), F.col("dominant"), F.col("kernel"), *conf.band
    ratio = F.greatest(v, d) / F.least(v, d)
    both = d.isNotNull() & (v > 0) & (d > 0)
    in_kernel = F.coalesce((k * low <= v) & (v <= k * high), F.lit(False))
    split = d.isNull() & (F.col("priority") <= 1) & (F.col("n_distinct") >= 3) & ~in_kernel
    far = both & (ratio > conf.blocker_ratio)
    points = F.when(split, -0.15).when(both & (ratio <= conf.match_ratio) & (F.col("priority") <= 2), 0.05).when(far & (F.col("priority") <= 2), -0.15).when(far, -0.05).otherwise(0.0)
    scored = numeric.join(groups, ["cluster_gid", "attr"]).select("pk_id", points.alias("points"), (split | far & (F.col("priority") <= 2)).alias("blocks"))
    total = F.least(F.greatest(F.round(F.sum("points"), 10), F.lit(-0.25)), F.lit(0.10))
    return scored.groupBy("pk_id").agg(total.alias("attr_score"), F.coalesce(F.bool_or("blocks"), F.lit(False)).alias("blocker"))


def name_numbers_score(members: DataFrame, conf: Config = DEFAULT) -> DataFrame:
    """(pk_id, name_score): the fallback for products without attributes, from units in names (cluster_gid, pk_id,
    name). The modal value comes from the first thirty members; of equally frequent ones the smallest."""
    own = members.select("cluster_gid", "pk_id", F.explode(numeric_attrs("name")).alias("unit", "value"))
    modal = modal_values(capped_members(members, "cluster_gid", 30).select("cluster_gid", "pk_id", F.explode(numeric_attrs("name")).alias("unit", "value")), ["cluster_gid", "unit"], "value")
    modal = modal.where((F.col("n") >= 3) & (F.col("modal_count") / F.col("n") >= conf.dominance_string))
    v, m = F.col("value"), F.col("modal")
    ratio = F.when((v > 0) & (m > 0), F.greatest(v / m, m / v)).otherwise(999.0)
    points = F.when(v == m, 0.05).when(ratio > 3.0, -0.10).when(ratio > 1.5, -0.03).otherwise(0.0)
    sums = own.join(modal, ["cluster_gid", "unit"]).groupBy("pk_id").agg(F.round(F.sum(points), 10).alias("s"))
    clamped = F.least(F.greatest(F.coalesce("s", F.lit(0.0)), F.lit(-0.15)), F.lit(0.10))
    return members.select("pk_id").join(sums, "pk_id", "left").select("pk_id", clamped.alias("name_score"))


def attr_block(attrs: DataFrame, weights: DataFrame, sizes: DataFrame, conf: Config = DEFAULT) -> DataFrame:
    """(pk_id, mismatches): products that differ in an attribute that weights (attr, block, type) blocks on; attrs
    carries value_num for numeric attributes and value_str (canonical) for the others."""
    text = F.coalesce(F.col("value_num").cast("string"), F.col("value_str"))
    own = attrs.withColumn("as_text", text).join(weights.where("block").select("attr", "type"), "attr")
    kept = without_outliers(own, "cluster_gid", "attr", "as_text", sizes, conf.outlier_cluster)
    keys = ["cluster_gid", "attr"]
    numeric = dominant_groups(kept.where("type = 'numeric'"), keys, "value_num", conf.dominance_numeric).where("n >= 3 and dominant > 0")
    v, d = F.col("value_num"), F.col("dominant")
    far = own.where("type = 'numeric'").join(numeric, keys).where((v > 0) & (F.greatest(v, d) / F.least(v, d) > conf.match_ratio)).select("pk_id", "attr")
    modal = modal_values(kept.where("type <> 'numeric'"), keys, "value_str").where((F.col("n") >= 3) & (F.col("modal_count") / F.col("n") >= conf.dominance_string))
    other = own.where("type <> 'numeric'").join(modal, keys).where("value_str <> '' and value_str <> modal").select("pk_id", "attr")
    return far.unionByName(other).groupBy("pk_id").agg(F.array_join(F.sort_array(F.collect_list("attr")), ",").alias("mismatches"))


def price_tiers(rows: DataFrame, group: list[str], price: str, fallback: list[str] | None = None, conf: Config = DEFAULT) -> DataFrame:
    """rows with tier (0 low, 1 middle, 2 high, 3 spike), src (0 the group, 1 the fallback), ratio and flag: quartiles
    by index of the positive prices of the group, or of the fallback group where it has too few. A ratio a hair below a half in
    the third digit goes up, so that engines whose divisions differ in the last bit agree."""
    positive = rows.where(F.col(price) > 0)
    stats = index_quartiles(positive, group, price).select(*group, *[F.col(c).alias(f"g_{c}") for c in ("n", "q1", "median", "q3")])
    joined = rows.join(stats, group, "left")
    if fallback:
        wide = index_quartiles(positive, fallback, price).select(*fallback, *[F.col(c).alias(f"f_{c}") for c in ("n", "q1", "median", "q3")])
        joined = joined.join(wide, fallback, "left")
    else:
        joined = joined.withColumns({f"f_{c}": F.lit(None).cast("double") for c in ("n", "q1", "median", "q3")})
    enough = F.coalesce(F.col("g_n"), F.lit(0)) >= conf.price_group_least
    pick = lambda c: F.when(enough, F.col(f"g_{c}")).otherwise(F.col(f"f_{c}"))
    q1, q3, median, p = pick("q1"), pick("q3"), pick("median"), F.col(price)
    reach = (q3 - q1) * conf.price_iqr
    judged = (p > 0) & (F.coalesce(pick("n"), F.lit(0)) >= conf.price_group_least)
    tier = F.when(~F.coalesce(judged, F.lit(False)), 1).when((p < q1 - reach) | (p > q3 + reach), 3).when(p < q1, 0).when(p > q3, 2).otherwise(1)
    out = joined.withColumns({
        "tier": tier.cast("long"), "src": F.when((p <= 0) | enough, 0).otherwise(1).cast("long"),
        "ratio": F.when(judged & (median > 0), F.round(p / median + 1e-9, 3)).otherwise(1.0),
    })
    return out.withColumn("flag", (F.col("tier") == 3).cast("long")).drop(*[f"{s}_{c}" for s in "gf" for c in ("n", "q1", "median", "q3")])


def price_score_of_tier(tier: Column) -> Column:
    return F.when(tier == 3, -0.05).when(tier == 1, 0.05).otherwise(0.0)


def price_score_of_ratio(price: str, average: str) -> Column:
    r = price_ratio(price, average)
    return F.when((F.col(price) <= 0) | (F.col(average) <= 0), 0.0).when(r <= 1.5, 0.05).when(r <= 3.0, 0.0).otherwise(-0.05)


def decide(parts: DataFrame, conf: Config = DEFAULT) -> DataFrame:
    """parts (embedding_score, token_score, brand_score, attr_score, price_score, blocker, item_ratio, cluster_gid,
    mismatches?) with score, decision, confidence and reason. Without a cluster: grey at confidence 0.5."""
    raw = F.col("embedding_score") + F.col("token_score") + F.col("brand_score") + F.col("attr_score") + F.col("price_score")
    score = F.least(F.greatest((raw + 0.30) / 1.05, F.lit(0.0)), F.lit(1.0))
    none = F.col("cluster_gid").isNull()
    mismatch = F.col("mismatches") if "mismatches" in parts.columns else F.lit(None).cast("string")
    blocker = F.coalesce(F.col("blocker"), F.lit(False)) | mismatch.isNotNull()
    tags = F.array_compact(F.array(
        F.when(mismatch.isNotNull(), F.concat(F.lit("[АТРИБУТ-БЛОКЕР] "), mismatch)).when(blocker, F.lit("[ЧИСЛО-БЛОКЕР] числовые атрибуты не совпадают с кластером")),
        F.when(F.col("item_ratio") > 3.0, F.concat(F.lit("[ЦЕНА] "), F.format_number(F.col("item_ratio"), 1), F.lit("x от средней кластера"))),
    ))
    tags = F.when(F.size(tags) >= 2, F.concat(F.array(F.concat(F.lit("[COMPOUND] "), F.size(tags).cast("string"), F.lit(" проблем"))), tags)).otherwise(tags)
    s = F.col("raw_score")
    return parts.withColumn("raw_score", F.when(none, 0.0).otherwise(score)).withColumns({
        "score": F.round(s, 4), "confidence": F.when(none, 0.5).otherwise(s),
        "decision": F.when(none | blocker, "grey").when(s >= conf.score_ok, "ok").when(s <= conf.score_quarantine, "quarantine").otherwise("grey"),
        "reason": F.when(none, "").otherwise(F.array_join(tags, " | ")),
    }).drop("raw_score")


def anomaly_pass(decisions: DataFrame, attrs: DataFrame, conf: Config = DEFAULT) -> DataFrame:
    """decisions (pk_id, cluster_gid, decision, reason) after the quiet-mismatch pass: ok members of tiny clusters and
    ok members far from the medians of the others turn grey, with the reason added. Medians ignore decisions, so the
    order of products doesn't matter."""
    from quillmesh.operators.aggregates import leave_one_out_medians

    size = F.count("*").over(Window.partitionBy("cluster_gid"))
    numeric = attrs.where("is_numeric and priority <= 2 and value_num is not null")
    loo = leave_one_out_medians(numeric, "cluster_gid", "attr", "value_num").where("value > 0 and others > 0")
    distance = F.abs(F.log(F.col("value") / F.col("others")))
    worst = loo.groupBy("pk_id").agg(F.max(distance).alias("distance"), F.max_by("attr", F.struct(distance, "attr")).alias("worst"))
    joined = decisions.withColumn("size", size).join(worst, "pk_id", "left")
    ok = (F.col("decision") == "ok") & F.col("cluster_gid").isNotNull()
    small = ok & (F.col("size") <= conf.small_cluster)
    far = ok & (F.col("size") > conf.small_cluster) & (F.coalesce(F.col("distance"), F.lit(0.0)) > conf.anomaly_distance)
    note = F.when(small, F.concat(F.lit("[ANOMALY-SMALL] cluster_size="), F.col("size").cast("string"))).when(far, F.concat(F.lit("[ANOMALY-ATTR] "), F.col("worst")))
    reason = F.when(note.isNull(), F.col("reason")).when(F.col("reason") == "", note).otherwise(F.concat(F.col("reason"), F.lit(" | "), note))
    return joined.select("pk_id", "cluster_gid", F.when(small | far, "grey").otherwise(F.col("decision")).alias("decision"), reason.alias("reason"))


def rerank_grey(scored: DataFrame, conf: Config = DEFAULT, name: str = "name") -> DataFrame:
    """scored (pk_id, cluster_gid, name, revenue, sales, decision) with rerank_score, that of a grey product and its
    cluster's best seller, and the decision that follows; a product without a cluster stays as it is."""
    main = scored.where("cluster_gid is not null").groupBy("cluster_gid").agg(F.max_by(F.struct(F.col(name).alias("n"), "pk_id"), F.struct("revenue", "sales", -F.col("pk_id"))).alias("main"))
    grey = scored.where("decision = 'grey'").select("pk_id", "cluster_gid", name).join(main, "cluster_gid")
    found = grey.select("pk_id", rerank(F.col(name), F.col("main.n")).alias("rerank_score"))
    j = scored.join(found, "pk_id", "left").withColumn("_routed", reranked("rerank_score", conf))
    if "reason" in scored.columns:
        tag = F.concat(F.lit("[RERANK="), F.format_number("rerank_score", 3), F.lit("]"), F.when(F.col("_routed") == "grey", "").otherwise(F.concat(F.lit(" auto-"), F.col("_routed"))))
        j = j.withColumn("reason", F.concat_ws(" | ", F.nullif(F.col("reason"), F.lit("")), tag))
    return j.withColumn("decision", F.col("_routed")).drop("_routed")


def reranked(score: str, conf: Config = DEFAULT) -> Column:
    """The decision of a grey product by a reranker's score; a product without a score stays grey."""
    s = F.col(score)
    return F.when((F.col("decision") == "grey") & (s >= conf.rerank_ok), "ok").when((F.col("decision") == "grey") & (s <= conf.rerank_quarantine), "quarantine").otherwise(F.col("decision"))
