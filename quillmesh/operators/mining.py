"""Calibration of attribute weights and thresholds, and training pairs. Random choices are replaced by the order of a
portable hash, so that a run can be repeated and checked."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.config import DEFAULT, Config
from quillmesh.operators.aggregates import coherence, dominant_groups, modal_values


def order_key(c: Column | str, salt: int = 0) -> Column:
    """A shuffled order of ids that any engine can compute: multiplication modulo 2^32."""
    return ((F.col(c) if isinstance(c, str) else c) + salt) % 1_000_003 * 2_654_435_761 % 4_294_967_296


def pair_key(a: str, b: str) -> Column:
    return (order_key(a) + order_key(b, 7)) % 4_294_967_296


def attr_weights(attrs: DataFrame, sizes: DataFrame, conf: Config = DEFAULT) -> DataFrame:
    """(category_id, attr, block, type, uniformity, n_clusters) of attrs (category_id, cluster_gid, attr, value_num,
    value_str) and sizes (cluster_gid, size): how uniform an attribute is within good clusters."""
    low, high = conf.weights_cluster
    good = attrs.join(sizes.where(F.col("size").between(low, high)).select("cluster_gid"), "cluster_gid")
    keys = ["category_id", "cluster_gid", "attr"]
    numeric = dominant_groups(good.where("value_num is not null"), keys, "value_num", 0.0).select(*keys, F.lit("numeric").alias("type"), "n", (F.col("group_size") / F.col("n")).alias("u"))
    text = modal_values(good.where("value_num is null").withColumn("v", F.lower(F.trim("value_str"))), keys, "v").select(*keys, F.lit("string").alias("type"), "n", (F.col("modal_count") / F.col("n")).alias("u"))
    judged = numeric.unionByName(text).where(F.col("n") >= conf.weights_values)
    out = judged.groupBy("category_id", "attr").agg(F.min("type").alias("type"), F.avg("u").alias("mean"), F.count("*").alias("n_clusters")).where(F.col("n_clusters") >= conf.weights_clusters)
    return out.select("category_id", "attr", (F.col("mean") >= conf.weights_block).alias("block"), "type", F.round("mean", 3).alias("uniformity"), "n_clusters")


def threshold_of(c: Column, conf: Config = DEFAULT) -> Column:
    loose, middle, tight = conf.thresholds
    return F.when(c >= 0.85, loose).when(c >= 0.75, middle).otherwise(tight)


def niche_thresholds(vectors: DataFrame, conf: Config = DEFAULT) -> DataFrame:
    """(category_id, niche_key, coherence, score_ok) of vectors (category_id, niche_key, cluster_gid, pk_id, embedding):
    the mean coherence of the largest clusters, from their first names; clusters without coherence don't count."""
    keys = ["category_id", "niche_key"]
    sizes = vectors.groupBy(*keys, "cluster_gid").agg(F.count("*").alias("n")).where(F.col("n") >= conf.coherence_cluster)
    top = sizes.withColumn("r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n"), "cluster_gid"))).where(F.col("r") <= conf.coherence_clusters)
    first = vectors.join(top.select(*keys, "cluster_gid"), [*keys, "cluster_gid"])
    first = first.withColumn("r", F.row_number().over(Window.partitionBy(*keys, "cluster_gid").orderBy("pk_id"))).where(F.col("r") <= conf.coherence_names)
    own = coherence(first.withColumn("k", F.struct(*keys, "cluster_gid")), "k", "embedding").where("coherence > 0")
    mean = own.groupBy("k.category_id", "k.niche_key").agg(F.avg("coherence").alias("coherence"))
    return mean.withColumn("score_ok", threshold_of(F.col("coherence"), conf))


def category_thresholds(niches: DataFrame) -> DataFrame:
    return niches.groupBy("category_id").agg(F.round(F.avg("score_ok"), 3).alias("score_ok"))


def positive_pairs(members: DataFrame, conf: Config = DEFAULT) -> DataFrame:
    """(pk_left, pk_right, label, type): disjoint pairs of neighbours in the shuffled order of each cluster of members
    (cluster_gid, pk_id)."""
    low, high = conf.pairs_cluster
    w = Window.partitionBy("cluster_gid")
    m = members.withColumns({"n": F.count("*").over(w), "r": F.row_number().over(w.orderBy(order_key("pk_id"), "pk_id")) - 1}).where(F.col("n").between(low, high))
    m = m.withColumn("k", F.floor(F.col("r") / 2)).where(F.col("k") < F.least(F.lit(conf.pairs_per_cluster), F.floor(F.col("n") / 2)))
    pairs = m.groupBy("cluster_gid", "k").agg(F.min_by("pk_id", "r").alias("pk_left"), F.max_by("pk_id", "r").alias("pk_right"))
    return pairs.select("pk_left", "pk_right", F.lit(1).cast("long").alias("label"), F.lit("positive").alias("type"))


def _pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """pair_key() of arrays."""
    own = lambda c, salt: (c + salt) % 1_000_003 * 2_654_435_761 % 4_294_967_296
    return (own(a, 0) + own(b, 7)) % 4_294_967_296


def hard_negatives(rows: DataFrame, keys: list[str], differ: str, kind: str, band: tuple[float, float], most: int | None = None, block: int = 1024) -> DataFrame:
    """(pk_left, pk_right, label, type, cosine): pairs of rows (pk_id, keys, differ, embedding) with equal keys whose
    `differ` columns differ and whose cosine lies in the band; the first `most` in the shuffled order. A key's rows are
    dealt to blocks and each pair of blocks is one task's matrix product, of which only its own first `most` leave."""
    sizes = rows.groupBy(*keys).agg(F.ceil(F.count("*") / block).cast("int").alias("_blocks"))
    own = F.pmod(F.xxhash64("pk_id"), F.col("_blocks")).cast("int")
    dealt = rows.select(*keys, "pk_id", F.col(differ).alias("_d"), F.transform("embedding", lambda x: x.cast("double")).alias("_v")).join(sizes, keys).withColumn("_own", own)
    dealt = dealt.withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).withColumns({"_low": F.least("_i", "_own"), "_high": F.greatest("_i", "_own")})

    def pairs(part: pd.DataFrame) -> pd.DataFrame:
        left, right = part[part._own == part._low.iloc[0]], part[part._own == part._high.iloc[0]]
        unit = lambda p: (m := np.stack(p._v.to_numpy())) / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
        if left.empty or right.empty:
            return pd.DataFrame({"pk_left": [], "pk_right": [], "cosine": []})
        sims, a, b = unit(left) @ unit(right).T, left.pk_id.to_numpy(), right.pk_id.to_numpy()
        within = part._low.iloc[0] == part._high.iloc[0]
        good = (sims >= band[0]) & (sims <= band[1]) & (left._d.to_numpy()[:, None] != right._d.to_numpy()[None, :])
        i, j = np.nonzero(good & (a[:, None] < b[None, :]) if within else good & (a[:, None] != b[None, :]))
        low, high, sims = np.minimum(a[i], b[j]), np.maximum(a[i], b[j]), sims[i, j]
        if most is not None:
            first = np.lexsort((high, low, _pair_keys(low, high)))[:most]
            low, high, sims = low[first], high[first], sims[first]
        return pd.DataFrame({"pk_left": low, "pk_right": high, "cosine": sims})

    found = dealt.groupBy(*keys, "_low", "_high").applyInPandas(pairs, "pk_left long, pk_right long, cosine double")
    found = found.select("pk_left", "pk_right", F.lit(0).cast("long").alias("label"), F.lit(kind).alias("type"), "cosine")
    return found if most is None else found.orderBy(pair_key("pk_left", "pk_right"), "pk_left", "pk_right").limit(most)


def easy_negatives(rows: DataFrame, most: int) -> DataFrame:
    """(pk_left, pk_right, label, type): pairs of different categories. Rows (pk_id, category_id) are numbered in the
    shuffled order within their category, and the k-th ones of two categories make a pair: an equi-join, no product
    of the tables; the first `most` in the shuffled order."""
    w = Window.partitionBy("category_id").orderBy(order_key("pk_id"), "pk_id")
    r = rows.withColumn("k", F.row_number().over(w)).where(F.col("k") <= most)
    right = r.select("k", F.col("pk_id").alias("b"), F.col("category_id").alias("c"))
    pairs = r.join(right, "k").where("category_id < c").select(F.least("pk_id", "b").alias("pk_left"), F.greatest("pk_id", "b").alias("pk_right"))
    out = pairs.orderBy(pair_key("pk_left", "pk_right"), "pk_left", "pk_right").limit(most)
    return out.select("pk_left", "pk_right", F.lit(0).cast("long").alias("label"), F.lit("easy_neg").alias("type"))


def budgets(positives: int, most: int, conf: Config = DEFAULT) -> dict[str, int]:
    """How many negatives of each kind go with so many positives: half hard and half easy, or by head noun."""
    total = max(0, min(positives, most - positives))
    easy = int(total * conf.easy_share)
    head, p1 = int(total * conf.shares[0]), int(total * conf.shares[1])
    return {"total": total, "hard": total - easy, "easy": easy, "head": head, "p1": p1, "rest": total - head - p1}
