"""From decisions to the review queue: arbitration guards, gates on moves, and the diff of assignments."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.config import DEFAULT, Config
from quillmesh.functions.text import contradicts, words_only
from quillmesh.functions.vector import cosine
from quillmesh.operators.aggregates import capped_members, centroid_vectors, centroids, coherence, dominant_groups
from quillmesh.sources.tables import numbered


def whole_grey_clusters(decisions: DataFrame) -> DataFrame:
    """All members of clusters with a grey member."""
    return decisions.join(decisions.where("decision = 'grey' and cluster_gid is not null").select("cluster_gid").distinct(), "cluster_gid", "left_semi").select(*decisions.columns)


def pack_batches(rows: DataFrame, size: int = DEFAULT.arbiter_batch) -> DataFrame:
    """(cluster_gid, pk_id, batch): products (cluster_gid, pk_id, signature) with equal signatures together, first fit,
    the largest group first, those without a signature last. First fit is sequential, so a cluster is a group; only
    keys travel."""

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("pk_id").assign(signature=part.signature.fillna(""))
        groups = sorted(part.groupby("signature", sort=False), key=lambda g: (g[0] == "", -len(g[1]), g[0]))
        sizes: list[int] = []
        out = []
        for _, group in groups:
            for k in range(0, len(group), size):
                chunk = group.iloc[k : k + size]
                at = next((b for b, n in enumerate(sizes) if n + len(chunk) <= size), len(sizes))
                if at == len(sizes):
                    sizes.append(0)
                sizes[at] += len(chunk)
                out.append(chunk[["cluster_gid", "pk_id"]].assign(batch=at))
        return pd.concat(out)

    return rows.groupBy("cluster_gid").applyInPandas(pack, "cluster_gid long, pk_id long, batch long")


def parsed(answers: DataFrame) -> DataFrame:
    """Answers (pk_id, decision, reason, confidence) with verb (ok, move, new, quarantine, invalid), target and label."""
    d = F.trim(F.coalesce("decision", F.lit("")))
    target = F.regexp_extract(d, r"^move:[Kk]*\s*(\d+)", 1).try_cast("long")
    verb = F.when(d.isin("ok", "quarantine"), d).when(F.startswith(d, F.lit("move:")), "move").when(F.startswith(d, F.lit("new:")), "new").otherwise("invalid")
    return answers.withColumns({"verb": verb, "target": F.when(verb == "move", target), "label": F.when(verb == "new", F.lower(F.trim(F.substr(d, F.lit(5)))))})


def move_checks(moves: DataFrame, attrs: DataFrame, conf: Config = DEFAULT) -> DataFrame:
    """(pk_id, fits) of moves (pk_id, cluster_gid, target): each first-priority number must be near the target's median,
    or nearer to it than to the source's and not beyond the hard cap. Medians take the first thirty members."""
    first = attrs.where("is_numeric and priority <= 1 and value_num is not null")
    groups = dominant_groups(capped_members(first, "cluster_gid", 30), ["cluster_gid", "attr"], "value_num", conf.dominance_numeric)
    median = lambda key, name: groups.select(F.col("cluster_gid").alias(key), "attr", F.col("dominant").alias(name))
    own = moves.select("pk_id", F.col("cluster_gid").alias("source"), "target").join(first.select("pk_id", "attr", "value_num"), "pk_id").where("value_num > 0")
    own = own.join(median("target", "t"), ["target", "attr"]).join(median("source", "s"), ["source", "attr"], "left").where("t > 0")
    ratio = lambda m: F.greatest("value_num", m) / F.least("value_num", m)
    fits = (ratio("t") <= conf.soft_cap) | (ratio("t") <= conf.hard_cap) & F.coalesce((F.col("s") > 0) & (ratio("t") < ratio("s")), F.lit(False))
    return own.groupBy("pk_id").agg(F.bool_and(fits).alias("fits"))


def guarded(answers: DataFrame, products: DataFrame, clusters: DataFrame, attrs: DataFrame, conf: Config = DEFAULT) -> DataFrame:
    """(pk_id, cluster_gid, verb, target, label, outcome, guard) of answers over products (pk_id, cluster_gid,
    niche_key, tokens) and clusters (cluster_gid, niche_key, main_tokens). The first guard that speaks names why a
    move or split was sent to quarantine."""
    a = parsed(answers).join(products.select("pk_id", "cluster_gid", "niche_key", "tokens"), "pk_id")
    t = clusters.select(F.col("cluster_gid").alias("target"), F.col("niche_key").alias("target_niche"), "main_tokens")
    a = a.join(t, "target", "left")
    fits = move_checks(a.where("verb = 'move' and main_tokens is not null").select("pk_id", "cluster_gid", "target"), attrs, conf)
    a = a.join(fits, "pk_id", "left")
    unknown = F.col("main_tokens").isNull() | F.col("target").isNull() | (F.col("target") == F.col("cluster_gid"))
    niche = (F.col("niche_key") > 0) & (F.col("target_niche") > 0) & (F.col("niche_key") != F.col("target_niche"))
    text = ~F.coalesce(F.arrays_overlap(words_only("tokens"), words_only("main_tokens")), F.lit(False))
    is_move = F.col("verb") == "move"
    guard = (
        F.when(is_move & contradicts("reason"), "contradiction").when(is_move & unknown, "target").when(is_move & niche, "niche").when(is_move & text, "text")
        .when(is_move & ~F.coalesce("fits", F.lit(True)), "numbers").when((F.col("verb") == "new") & (F.col("label") == ""), "label")
    )
    outcome = F.when(guard.isNotNull(), "quarantine").when(is_move, "move").when(F.col("verb") == "new", "split").when(F.col("verb") == "invalid", "unchanged").otherwise(F.col("verb"))
    return a.select("pk_id", "cluster_gid", "verb", "target", "label", outcome.alias("outcome"), guard.alias("guard"))


def splits(outcomes: DataFrame, first_gid: int, conf: Config = DEFAULT) -> DataFrame:
    """(pk_id, cluster_gid, label, n, new_gid): a new cluster for each source cluster and label, numbered in their
    order above every known gid; groups below the least size go back to their source (new_gid is null)."""
    s = outcomes.where("outcome = 'split'")
    sizes = s.groupBy("cluster_gid", "label").agg(F.count("*").alias("n"))
    named = numbered(sizes.where(F.col("n") >= conf.new_cluster_least).select("cluster_gid", "label"), "new_gid", first_gid - 1)
    return s.join(sizes, ["cluster_gid", "label"]).join(named, ["cluster_gid", "label"], "left").select("pk_id", "cluster_gid", "label", "n", "new_gid")


def settled(rows: DataFrame, outcomes: DataFrame, answers: DataFrame, first_gid: int, conf: Config = DEFAULT) -> DataFrame:
    """rows (pk_id, cluster_gid, decision, reason, ...) after arbitration: guarded() outcomes decide grey products. Moves
    take their target, splits of enough products a new cluster of their own (smaller ones stay), and the answer's
    reason and the guard that spoke are added."""
    new = splits(outcomes, first_gid, conf).select("pk_id", "new_gid")
    o = outcomes.select("pk_id", "outcome", "target", "guard").join(new, "pk_id", "left").join(answers.select("pk_id", F.coalesce("reason", F.lit("")).alias("answer")), "pk_id", "left")
    j = rows.join(o, "pk_id", "left")
    split = (F.col("outcome") == "split") & F.col("new_gid").isNotNull()
    heard = F.coalesce((F.col("decision") == "grey") & (F.col("outcome") != "unchanged"), F.lit(False))
    decision = F.when(~heard, F.col("decision")).when((F.col("outcome") == "move") | split, "move").when(F.col("outcome") == "split", "ok").otherwise(F.col("outcome"))
    gid = F.when(heard & (F.col("outcome") == "move"), F.col("target")).when(heard & split, F.col("new_gid")).otherwise(F.col("cluster_gid"))
    note = F.concat_ws(" ", F.nullif(F.col("answer"), F.lit("")), F.concat(F.lit("[GUARD] "), F.col("guard")))
    reason = F.when(~heard | (note == ""), F.col("reason")).otherwise(F.concat_ws(" | ", F.nullif(F.col("reason"), F.lit("")), note))
    return j.withColumns({"decision": decision, "cluster_gid": gid, "reason": reason}).select(*rows.columns)


def quarantined(rows: DataFrame, verdicts: DataFrame, tag: str) -> DataFrame:
    """rows whose verdict (pk_id, verdict) begins with reject go to quarantine, with the verdict in their reason."""
    j = rows.join(verdicts.select("pk_id", "verdict"), "pk_id", "left")
    bad = F.coalesce((F.col("decision") == "move") & F.col("verdict").startswith("reject"), F.lit(False))
    reason = F.concat_ws(" | ", F.nullif(F.col("reason"), F.lit("")), F.concat(F.lit(f"[{tag}] "), F.col("verdict")))
    return j.withColumns({"reason": F.when(bad, reason).otherwise(F.col("reason")), "decision": F.when(bad, "quarantine").otherwise(F.col("decision"))}).drop("verdict")


def image_pairs(moves: DataFrame, members: DataFrame, images: DataFrame, attrs: DataFrame, most: int = 5) -> DataFrame:
    """The input of image_gate() for moves (pk_id, source, target): cosines of the product's image (pk_id, image) with
    the mean images of the first members of both clusters without the product, how alike these members' images are, and
    the distance of its numbers to both clusters' medians. Products and clusters without images are left out."""
    sides = moves.select("pk_id", F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("cluster_gid")) for s in ("source", "target")])).alias("x")).select("pk_id", "x.*")
    first = capped_members(members.select("cluster_gid", "pk_id"), "cluster_gid", most + 1).withColumnRenamed("pk_id", "member")
    others = sides.join(first, "cluster_gid").where("member <> pk_id").withColumn("key", F.struct("pk_id", "side"))
    others = capped_members(others, "key", most, "member")
    seen = others.join(images.select(F.col("pk_id").alias("member"), "image"), "member")
    mean = centroid_vectors(centroids(seen, "key", "image"), "key")
    sims = mean.select("key.pk_id", "key.side", "centroid").join(images, "pk_id").select("pk_id", "side", cosine("image", "centroid").alias("sim"))
    alike = coherence(seen, "key", "image").select("key.pk_id", "key.side", F.when(F.col("n") > 1, F.col("coherence")).alias("coherence"))
    numbers = attrs.where("is_numeric and priority <= 2 and value_num is not null").select("pk_id", "attr", "value_num")
    known = others.select("pk_id", "side", "member").join(numbers.withColumnRenamed("pk_id", "member"), "member")
    medians = known.groupBy("pk_id", "side", "attr").agg(F.sort_array(F.collect_list("value_num")).alias("v")).where(F.size("v") >= 2)  # of `most` members at most
    medians = medians.select("pk_id", "side", "attr", F.get("v", F.floor(F.size("v") / 2).cast("int")).alias("median"))
    far = medians.join(numbers, ["pk_id", "attr"]).where("value_num > 0 and median > 0").groupBy("pk_id", "side").agg(F.sum(F.abs(F.log(F.col("value_num") / F.col("median")))).alias("distance"))
    both = sims.join(alike, ["pk_id", "side"], "left").join(far, ["pk_id", "side"], "left")
    at = lambda c, s: F.max(F.when(F.col("side") == s, F.col(c))).alias(f"{c}_{s}")
    return both.groupBy("pk_id").agg(*[at(c, s) for c in ("sim", "coherence", "distance") for s in ("source", "target")]).where("sim_source is not null and sim_target is not null")


def functions_of_clusters(members: DataFrame, tags: DataFrame) -> DataFrame:
    """(cluster_gid, slug, n): the modal function of the first five members' tags (pk_id, function), unknown ones aside;
    of equals the smallest."""
    first = capped_members(members, "cluster_gid", 5).select("cluster_gid", "pk_id")
    counts = first.join(tags.where("function is not null and function not in ('', 'unknown')"), "pk_id").groupBy("cluster_gid", F.col("function").alias("slug")).agg(F.count("*").alias("n"))
    return counts.withColumn("r", F.row_number().over(Window.partitionBy("cluster_gid").orderBy(F.desc("n"), "slug"))).where("r = 1").drop("r")


def function_gate(moves: DataFrame, tags: DataFrame, functions: DataFrame, conf: Config = DEFAULT) -> DataFrame:
    """(pk_id, target, verdict) of moves (pk_id, target): skip without a tag or a majority, else reject or confirm."""
    own = tags.where("function is not null and function not in ('', 'unknown')").select("pk_id", "function")
    j = moves.join(own, "pk_id", "left").join(functions.select(F.col("cluster_gid").alias("target"), "slug", "n"), "target", "left")
    skip = F.col("function").isNull() | F.col("slug").isNull() | (F.coalesce("n", F.lit(0)) < conf.function_majority)
    return j.select("pk_id", "target", F.when(skip, "skip").when(F.col("function") != F.col("slug"), "reject").otherwise("confirm").alias("verdict"))


def image_gate(pairs: DataFrame, conf: Config = DEFAULT) -> DataFrame:
    """pairs (sim_source, sim_target, coherence_source, coherence_target, distance_source, distance_target) with a
    verdict; null coherences don't speak, null distances mean that there are no numbers to decide a tie."""
    delta = F.col("sim_target") - F.col("sim_source")
    loose = F.coalesce((F.col("coherence_target") < F.col("coherence_source") - conf.image_consistency) & (delta < conf.image_ambiguous), F.lit(False))
    numbers = F.col("distance_source").isNotNull() & F.col("distance_target").isNotNull()
    tie = F.when(~numbers, "reject-ambiguous").when(F.col("distance_target") <= F.col("distance_source"), "confirm-numbers").otherwise("reject-numbers")
    return pairs.withColumn("verdict", F.when(loose, "reject-consistency").when(F.abs(delta) < conf.image_ambiguous, tie).when(delta <= 0, "reject").otherwise("confirm"))


def numeric_distance(values: DataFrame, medians: DataFrame) -> DataFrame:
    """(pk_id, distance, compared) of values (pk_id, cluster_gid, attr, value) to medians (cluster_gid, attr, median)."""
    j = values.join(medians, ["cluster_gid", "attr"]).where("value > 0 and median > 0")
    return j.groupBy("pk_id").agg(F.sum(F.abs(F.log(F.col("value") / F.col("median")))).alias("distance"), F.count("*").alias("compared"))


def moves_of(rows: DataFrame, titles: DataFrame, created_by: str = "quillmesh") -> DataFrame:
    """The review rows of products (pk_id, name, niche_key, old_gid, new_gid, decision, reason, confidence, flags):
    what changed, and what has to be done. titles: (gid, title). Keys are hashes of what the row says, so a repeated
    run makes the same ones."""
    old, new, d = F.col("old_gid"), F.col("new_gid"), F.col("decision")
    changed = rows.where((d != "quarantine") & ~old.eqNullSafe(new) | (d == "move") & (F.coalesce(new, F.lit(0)) == 0) & ~old.eqNullSafe(new))
    create = (d == "move") & (F.coalesce(new, F.lit(0)) == 0)
    action = F.when(create, "create").when(old.isNotNull() & new.isNotNull(), "move").when(old.isNull() & new.isNotNull(), "create")
    t = titles.select(F.col("gid").alias("new_gid"), "title")
    j = changed.withColumn("target_action", action).where("target_action is not null").join(t, "new_gid", "left")
    target = F.when(create, F.lit(0)).otherwise(new).cast("long")
    title = F.when(create, F.when(F.col("reason") != "", F.col("reason")).otherwise("Новый кластер")).otherwise(F.coalesce("title", F.concat(F.lit("cluster_"), new.cast("string"))))
    out = j.select(
        "pk_id", F.col("pk_id").alias("nm_id"), F.substring("name", 1, 200).alias("product_name"), F.coalesce(old, F.lit(0)).cast("long").alias("old_cluster"),
        target.alias("new_cluster"), "target_action", F.substring(title, 1, 200).alias("new_cluster_title"), F.col("niche_key").alias("niche_key_int"),
        F.substring("reason", 1, 500).alias("reason"), F.lit("pending").alias("status"), F.lit(created_by).alias("created_by"),
        F.round("confidence", 4).alias("confidence_score"), F.coalesce("flags", F.lit(0)).cast("int").alias("anomaly_flags"),
    )
    return out.withColumn("idempotency_key", F.sha2(F.concat_ws("|", "pk_id", "old_cluster", "new_cluster", "target_action"), 256))


def peer_clusters(clusters: DataFrame, most: int = 20) -> DataFrame:
    """(cluster_gid, peer, peer_size, place) of clusters (cluster_gid, niche_key, size): the largest of the niche but
    itself, by size, then gid."""
    w = Window.partitionBy("niche_key").orderBy(F.desc("size"), "cluster_gid")
    top = clusters.withColumn("r", F.row_number().over(w)).where(F.col("r") <= most)
    peer = top.select("niche_key", F.col("cluster_gid").alias("peer"), F.col("size").alias("peer_size"), F.col("r").alias("place"))
    return clusters.select("cluster_gid", "niche_key").join(peer, "niche_key").where("cluster_gid <> peer").select("cluster_gid", "peer", "peer_size", F.col("place").cast("long").alias("place"))
