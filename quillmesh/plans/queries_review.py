"""Arbitration, gates, the diff, calibration, mining and attributes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quillmesh.functions.text import head_noun, tokenize
from quillmesh.functions.value import canon_number
from quillmesh.operators import aggregates, attributes, graph, mining, review
from quillmesh.plans.queries_cluster import SCORE_CTES, _members, _vectors, scored_products
from quillmesh.plans.queries_scalar import HEAD
from quillmesh.plans.registry import query
from quillmesh.plans.sql import bands, sql
from quillmesh.sources import sinks, tables


@query(sql("select s.pk_id, s.cluster_gid, s.decision from scored s where cluster_gid in (select cluster_gid from scored where decision = 'grey')", *SCORE_CTES))
def grey_cluster_expansion(spark, sf_dir):
    return review.whole_grey_clusters(scored_products(spark, sf_dir).select("pk_id", "cluster_gid", "decision"))


@query(sql("select s.pk_id, s.cluster_gid, (s.pk_id = main_pk)::bigint as main_product from scored s join (select cluster_gid, arg_max(pk_id, (revenue, sales, -pk_id)) as main_pk from members group by 1) c using (cluster_gid) where decision <> 'quarantine'", *SCORE_CTES))
def assignable_rows(spark, sf_dir):
    s = scored_products(spark, sf_dir).where("cluster_gid is not null and decision <> 'quarantine'").select("pk_id", "cluster_gid")
    c = graph.cluster_summary(_members(spark, sf_dir)).select("cluster_gid", "main_pk")
    return s.join(c, "cluster_gid").select("pk_id", "cluster_gid", (F.col("pk_id") == F.col("main_pk")).cast("long").alias("main_product"))


_SIG = """tol as (select pk_id, cluster_gid, v, case pk_id % 3 when 0 then 2.0 when 1 then 0.05 end as t from nums),
grid as (select *, case when t < 1 then greatest(1.0, v * t) else t end as g from tol),
sig as (select pk_id, cluster_gid, v, round_even(case when t > 0 then round_even(v / g, 0) * g else v end, 6)::double as b from grid)"""


def _toleranced(spark, sf_dir):
    a = tables.attrs(spark, sf_dir).where("attr = 'size'")
    t = F.when(F.col("pk_id") % 3 == 0, 2.0).when(F.col("pk_id") % 3 == 1, 0.05)
    return a.withColumn("tolerance", t)


@query(sql("select pk_id, b from sig", _SIG))
def p1_signature(spark, sf_dir):
    s = attributes.signatures(_toleranced(spark, sf_dir))
    return s.select("pk_id", F.bround(F.split("signature", "=")[1].cast("double"), 6).alias("b"))


@query(sql("""select a.pk_id, a.cluster_gid, agreed.v as value_num from assignments a join (select cluster_gid, count(*) as n, min(v) as v from nums where pk_id % 4 <> 0 group by 1 having count(*) >= 3 and min(v) = max(v)) agreed using (cluster_gid) where pk_id % 4 = 0"""
          .replace("min(v) as v from nums where pk_id % 4 <> 0 group by 1 having count(*) >= 3 and min(v) = max(v)", "min(floor(v / 25) * 25) as v from nums where pk_id % 4 <> 0 group by 1 having count(*) >= 3 and min(floor(v / 25)) = max(floor(v / 25))")))
def infer_fill(spark, sf_dir):
    a = tables.attrs(spark, sf_dir).where("attr = 'size' and pk_id % 4 <> 0").withColumns({"value_num": F.floor(F.col("value_num") / 25) * 25.0, "tolerance": F.lit(None).cast("double")})
    return attributes.infer_fill(a, tables.assignments(spark, sf_dir)).select("pk_id", "cluster_gid", "value_num")


@query()
def pack_batches(spark, sf_dir):
    s = attributes.signatures(_toleranced(spark, sf_dir)).join(tables.assignments(spark, sf_dir), "pk_id")
    return review.pack_batches(s.select("cluster_gid", "pk_id", "signature"), 5)


@query(sql("select cluster_gid, count(*) as members, true as once, true as fits from assignments group by 1"))
def batch_invariants(spark, sf_dir):
    """Each product is in one batch, and no batch is too full."""
    b = pack_batches(spark, sf_dir)
    sizes = b.groupBy("cluster_gid", "batch").agg(F.count("*").alias("n")).groupBy("cluster_gid").agg(F.max("n").alias("most"))
    own = b.groupBy("cluster_gid").agg(F.count("*").alias("members"), (F.count("*") == F.count_distinct("pk_id")).alias("once"))
    return own.join(sizes, "cluster_gid").select("cluster_gid", "members", "once", (F.col("most") <= 5).alias("fits"))


_REPLAY = """replay as (select pk_id, cluster_gid, niche_key, tokens, case pk_id % 8 when 0 then 'ok' when 1 then 'quarantine' when 2 then 'new: Long ' when 3 then 'new:' when 4 then 'what' else 'move:K' || tgt end as decision,
  case when pk_id % 11 = 0 then 'Не совпадает размер' else 'same' end as reason, case when pk_id % 8 >= 5 then tgt end as target from (select m.*, case pk_id % 8 when 5 then cluster_gid + 1 when 6 then cluster_gid else cluster_gid + 25 end as tgt from members m)),
cl as (select c.cluster_gid as target, c.niche_key as target_niche, m.tokens as main_tokens from (select cluster_gid, min(niche_key) as niche_key, arg_max(pk_id, (revenue, sales, -pk_id)) as main_pk from members group by 1) c join members m on m.pk_id = main_pk),
first30 as (select * from (select *, row_number() over (partition by cluster_gid order by pk_id) as r from nums) where r <= 30)"""
_GUARD = """chk as (select r.pk_id, case when t.dominant is null or t.dominant <= 0 then true else greatest(v, t.dominant) / least(v, t.dominant) <= 1.15 or greatest(v, t.dominant) / least(v, t.dominant) <= 2.0 and
    coalesce(s.dominant > 0 and greatest(v, t.dominant) / least(v, t.dominant) < greatest(v, s.dominant) / least(v, s.dominant), false) end as fits
  from replay r join nums n using (pk_id) left join med t on t.cluster_gid = r.target left join med s on s.cluster_gid = r.cluster_gid where v > 0),
gd as (select r.pk_id, r.cluster_gid, r.decision, r.target, case when r.target is not null then
    case when r.reason <> 'same' then 'contradiction' when c.main_tokens is null or r.target = r.cluster_gid then 'target' when r.niche_key <> c.target_niche then 'niche'
      when not list_has_any(list_filter(r.tokens, lambda w: not regexp_matches(w, '^[0-9]+$')), list_filter(c.main_tokens, lambda w: not regexp_matches(w, '^[0-9]+$'))) then 'text' when not coalesce(k.fits, true) then 'numbers' end
    when r.decision = 'new:' then 'label' end as guard from replay r left join cl c using (target) left join chk k on k.pk_id = r.pk_id),
outc as (select *, case when guard is not null then 'quarantine' when target is not null then 'move' when decision like 'new:%' then 'split' when decision = 'what' then 'unchanged' else decision end as outcome from gd)"""


def _guarded(spark, sf_dir):
    m = _members(spark, sf_dir)
    k = F.col("pk_id") % 8
    target = F.when(k == 5, F.col("cluster_gid") + 1).when(k == 6, F.col("cluster_gid")).otherwise(F.col("cluster_gid") + 25)
    answers = m.select(
        "pk_id", F.when(k == 0, "ok").when(k == 1, "quarantine").when(k == 2, "new: Long ").when(k == 3, "new:").when(k == 4, "what").otherwise(F.concat(F.lit("move:K"), target.cast("string"))).alias("decision"),
        F.when(F.col("pk_id") % 11 == 0, "Не совпадает размер").otherwise("same").alias("reason"),
    )
    c = graph.cluster_summary(m).select("cluster_gid", "main_pk").join(m.groupBy("cluster_gid").agg(F.min("niche_key").alias("niche_key")), "cluster_gid")
    c = c.join(m.select(F.col("pk_id").alias("main_pk"), F.col("tokens").alias("main_tokens")), "main_pk")
    return review.guarded(answers, m, c, tables.attrs(spark, sf_dir))


@query(sql("select pk_id, cluster_gid, target, outcome, guard from outc", _REPLAY, bands("first30", "cluster_gid", "v", "med"), _GUARD))
def arbiter_guards(spark, sf_dir):
    return _guarded(spark, sf_dir).select("pk_id", "cluster_gid", "target", "outcome", "guard")


@query(sql("""select o.pk_id, o.cluster_gid, n, gid as new_gid from outc o join (select cluster_gid, count(*) as n from outc where outcome = 'split' group by 1) s using (cluster_gid)
left join (select cluster_gid, 500000 + row_number() over (order by cluster_gid) as gid from (select cluster_gid from outc where outcome = 'split' group by 1 having count(*) >= 4)) g using (cluster_gid) where outcome = 'split'""",
           _REPLAY, bands("first30", "cluster_gid", "v", "med"), _GUARD))
def split_revert(spark, sf_dir):
    return review.splits(_guarded(spark, sf_dir), 500_001).select("pk_id", "cluster_gid", "n", "new_gid")


_TAGS = """tags as (select pk_id, case when pk_id % 10 = 9 then 'unknown' when pk_id % 10 < 7 then 'f' || niche_key % 3 else 'f' || pk_id % 3 end as fn from members),
fc as (select m.cluster_gid, fn as slug, count(*) as n from (select *, row_number() over (partition by cluster_gid order by pk_id) as r from assignments) m join tags using (pk_id) where r <= 5 and fn <> 'unknown' group by 1, 2),
fm as (select cluster_gid, slug, n from (select *, row_number() over (partition by cluster_gid order by n desc, slug) as r from fc) where r = 1)"""


def _tags(spark, sf_dir):
    k = F.col("pk_id") % 10
    fn = F.when(k == 9, "unknown").when(k < 7, F.concat(F.lit("f"), (F.col("niche_key") % 3).cast("string"))).otherwise(F.concat(F.lit("f"), (F.col("pk_id") % 3).cast("string")))
    return tables.products(spark, sf_dir).select("pk_id", fn.alias("function"))


@query(sql("select cluster_gid, slug, n from fm", _TAGS))
def function_majority(spark, sf_dir):
    return review.functions_of_clusters(tables.assignments(spark, sf_dir), _tags(spark, sf_dir))


@query(sql("""select a.pk_id, a.cluster_gid + 25 as target, case when t.fn = 'unknown' or slug is null or n < 2 then 'skip' when t.fn <> slug then 'reject' else 'confirm' end as verdict
from assignments a join tags t using (pk_id) left join fm on fm.cluster_gid = a.cluster_gid + 25""", _TAGS))
def vision_gate(spark, sf_dir):
    moves = tables.assignments(spark, sf_dir).select("pk_id", (F.col("cluster_gid") + 25).alias("target"))
    tags = _tags(spark, sf_dir)
    return review.function_gate(moves, tags, review.functions_of_clusters(tables.assignments(spark, sf_dir), tags))


@query("""with g as (select event_id, (event_id % 101) / 100.0 as ss, (event_id * 7 % 101) / 100.0 as st, case when event_id % 5 <> 0 then event_id % 13 / 13.0 end as cs, event_id % 17 / 17.0 as ct,
case when event_id % 3 <> 0 then event_id % 7 end::double as ds, (event_id % 4)::double as dt from events)
select event_id, case when coalesce(ct < cs - 0.02 and st - ss < 0.03, false) then 'reject-consistency' when abs(st - ss) < 0.03 then case when ds is null or dt is null then 'reject-ambiguous' when dt <= ds then 'confirm-numbers' else 'reject-numbers' end
when st - ss <= 0 then 'reject' else 'confirm' end as verdict from g""")
def image_gate(spark, sf_dir):
    e, i = tables.read(spark, sf_dir, "events").select("event_id"), F.col("event_id")
    pairs = e.withColumns({
        "sim_source": i % 101 / 100.0, "sim_target": i * 7 % 101 / 100.0, "coherence_source": F.when(i % 5 != 0, i % 13 / 13.0), "coherence_target": i % 17 / 17.0,
        "distance_source": F.when(i % 3 != 0, (i % 7).cast("double")), "distance_target": (i % 4).cast("double"),
    })
    return review.image_gate(pairs).select("event_id", "verdict")


@query(sql("select n.pk_id, round(abs(ln(v / m)), 6) as distance, 1::bigint as compared from nums n join (select cluster_gid, list_sort(list(v))[count(*) // 2 + 1] as m from (select *, row_number() over (partition by cluster_gid order by pk_id) as r from nums) where r <= 20 group by 1 having count(*) >= 2) using (cluster_gid)"))
def numeric_distance(spark, sf_dir):
    a = tables.attrs(spark, sf_dir).where("attr = 'size'")
    value = canon_number("value_num", "mm")["value"] * 1000
    d = review.numeric_distance(a.select("pk_id", "cluster_gid", "attr", value.alias("value")), aggregates.capped_medians(a, "cluster_gid", "attr", "value_num"))
    return d.select("pk_id", F.round("distance", 6).alias("distance"), "compared")


@query(sql("""select cluster_gid, peer, peer_size, place from (select a.cluster_gid, a.niche_key from cs a) x join
(select cluster_gid as peer, niche_key, size as peer_size, row_number() over (partition by niche_key order by size desc, cluster_gid) as place from cs) p using (niche_key) where place <= 20 and cluster_gid <> peer""",
           "cs as (select cluster_gid, min(niche_key) as niche_key, count(*) as size from members group by 1)"))
def niche_peer_clusters(spark, sf_dir):
    c = tables.products(spark, sf_dir).join(tables.assignments(spark, sf_dir), "pk_id").groupBy("cluster_gid").agg(F.min("niche_key").alias("niche_key"), F.count("*").alias("size"))
    return review.peer_clusters(c)


_DIFF = """fl as (select user_id as pk_id, arg_min(event_type, event_id) as f, arg_max(event_type, event_id) as l, max(event_id) as last from events group by 1),
df as (select pk_id, case when pk_id % 7 <> 0 then length(f) end as old_gid, case when pk_id % 13 = 0 then null when pk_id % 11 = 0 then 0 else length(l) end as new_gid,
  case pk_id % 5 when 0 then 'move' when 1 then 'ok' when 2 then 'quarantine' when 3 then 'grey' else 'move' end as decision, last % 100 / 100.0 as conf from fl),
mv as (select *, decision = 'move' and coalesce(new_gid, 0) = 0 as cr from df where decision <> 'quarantine' and old_gid is distinct from new_gid)"""


def _moves(spark, sf_dir):
    e = tables.read(spark, sf_dir, "events").groupBy(F.col("user_id").alias("pk_id")).agg(F.min_by("event_type", "event_id").alias("f"), F.max_by("event_type", "event_id").alias("l"), F.max("event_id").alias("last"))
    k = F.col("pk_id")
    rows = e.select(
        "pk_id", F.concat(F.lit("user "), k.cast("string")).alias("name"), (k % 4).cast("long").alias("niche_key"), F.when(k % 7 != 0, F.length("f")).cast("long").alias("old_gid"),
        F.when(k % 13 == 0, F.lit(None)).when(k % 11 == 0, 0).otherwise(F.length("l")).cast("long").alias("new_gid"),
        F.when(k % 5 == 1, "ok").when(k % 5 == 2, "quarantine").when(k % 5 == 3, "grey").otherwise("move").alias("decision"), F.lit("why").alias("reason"), (F.col("last") % 100 / 100.0).alias("confidence"), F.lit(257).alias("flags"),
    )
    titles = tables.read(spark, sf_dir, "events").select(F.length("event_type").cast("long").alias("gid")).distinct().where("gid % 2 = 0").withColumn("title", F.concat(F.lit("t"), F.col("gid").cast("string")))
    return review.moves_of(rows, titles)


_MV = """select pk_id, coalesce(old_gid, 0)::bigint as old_cluster, (case when cr then 0 else new_gid end)::bigint as new_cluster, case when cr then 'create' when old_gid is not null then 'move' else 'create' end as target_action,
case when cr then 'why' when new_gid % 2 = 0 and new_gid > 0 then 't' || new_gid else 'cluster_' || new_gid end as new_cluster_title, round(conf, 4)::double as confidence_score from mv where cr or new_gid is not null"""


@query(sql(_MV, _DIFF))
def diff_moves(spark, sf_dir):
    return _moves(spark, sf_dir).select("pk_id", "old_cluster", "new_cluster", "target_action", "new_cluster_title", "confidence_score")


@query(sql(f"select pk_id, 'user ' || pk_id as product_name, 'pending' as status, 1::bigint as anomaly_flags, confidence_score from ({_MV})", _DIFF))
def review_queue_projection(spark, sf_dir):
    r = sinks.review_rows(_moves(spark, sf_dir))
    return r.select("pk_id", "product_name", "status", F.col("anomaly_flags").cast("long").alias("anomaly_flags"), "confidence_score")


@query(sql("""select category_id, attr, mean >= 0.7 as block, type, round(mean, 3) as uniformity, n_clusters from (
select category_id, 'size' as attr, 'numeric' as type, avg(group_size / n) as mean, count(*) as n_clusters from d join (select cluster_gid, min(category_id) as category_id from members group by 1) using (cluster_gid) join sizes using (cluster_gid) where size between 5 and 100 and n >= 3 group by 1
union all select category_id, 'type', 'string', 1.0, count(*) from (select cluster_gid, min(category_id) as category_id, count(*) as n from members group by 1 having count(*) between 5 and 100) group by 1) where n_clusters >= 3""", bands("nums", "cluster_gid", "v", "d")))
def attr_weights(spark, sf_dir):
    p = tables.products(spark, sf_dir).select("pk_id", "category_id")
    sizes = tables.assignments(spark, sf_dir).groupBy("cluster_gid").agg(F.count("*").alias("size"))
    return mining.attr_weights(tables.attrs(spark, sf_dir).join(p, "pk_id"), sizes)


_COH = """big as (select * from (select *, row_number() over (partition by category_id, niche_key order by n desc, cluster_gid) as r from (select category_id, niche_key, cluster_gid, count(*) as n from vecs group by 1, 2, 3 having count(*) >= 3)) where r <= 30),
fv as (select * from (select v.*, row_number() over (partition by v.category_id, v.niche_key, v.cluster_gid order by pk_id) as k from vecs v join big using (category_id, niche_key, cluster_gid)) where k <= 20),
co as (select a.category_id, a.niche_key, a.cluster_gid, avg(list_cosine_similarity(a.e, b.e)) as c from fv a join fv b on a.category_id = b.category_id and a.niche_key = b.niche_key and a.cluster_gid = b.cluster_gid and a.pk_id < b.pk_id group by 1, 2, 3),
th as (select category_id, niche_key, avg(c) as coherence from co where c > 0 group by 1, 2)"""


@query(sql("select category_id, niche_key, round(coherence, 6) as coherence, case when coherence >= 0.85 then 0.70 when coherence >= 0.75 then 0.75 else 0.80 end::double as score_ok from th", _COH))
def niche_thresholds(spark, sf_dir):
    return mining.niche_thresholds(_vectors(spark, sf_dir)).withColumn("coherence", F.round("coherence", 6))


@query(sql("select category_id, round(avg(case when coherence >= 0.85 then 0.70 when coherence >= 0.75 then 0.75 else 0.80 end::double), 3) as score_ok from th group by 1", _COH))
def category_thresholds(spark, sf_dir):
    return mining.category_thresholds(mining.niche_thresholds(_vectors(spark, sf_dir)))


def _key(c: str, salt: int = 0) -> str:
    return f"(({c} + {salt}) % 1000003 * 2654435761 % 4294967296)"


@query(sql(f"""select min(pk_id) filter (where r % 2 = 0) as pk_left, min(pk_id) filter (where r % 2 = 1) as pk_right, 1::bigint as label, 'positive' as type from
(select *, count(*) over (partition by cluster_gid) as n, row_number() over (partition by cluster_gid order by {_key("pk_id")}, pk_id) - 1 as r from assignments) where n between 3 and 50 and r // 2 < least(5, n // 2) group by cluster_gid, r // 2"""))
def mine_positive_pairs(spark, sf_dir):
    return mining.positive_pairs(tables.assignments(spark, sf_dir))


def _hard(keys: str, differ: str, kind: str, low: float, high: float) -> str:
    on = " and ".join(f"a.{k} = b.{k}" for k in keys.split(","))
    return sql(f"""select * from (select a.pk_id as pk_left, b.pk_id as pk_right, 0::bigint as label, '{kind}' as type, round(list_cosine_similarity(a.e, b.e), 6) as cosine from vecs a join vecs b on {on} and a.pk_id < b.pk_id and a.{differ} <> b.{differ}
where list_cosine_similarity(a.e, b.e) between {low} and {high}) order by ({_key("pk_left")} + {_key("pk_right", 7)}) % 4294967296, pk_left, pk_right limit 200""")


def _cosine6(found):
    return found.withColumn("cosine", F.round("cosine", 6))


@query(_hard("niche_key", "cluster_gid", "hard_neg", 0.2, 0.9))
def mine_hard_negatives(spark, sf_dir):
    return _cosine6(mining.hard_negatives(_vectors(spark, sf_dir), ["niche_key"], "cluster_gid", "hard_neg", (0.2, 0.9), 200))


@query(_hard("niche_key", "head", "hard_neg_head", 0.2, 0.92))
def mine_hard_neg_head(spark, sf_dir):
    return _cosine6(mining.hard_negatives(_vectors(spark, sf_dir), ["niche_key"], "head", "hard_neg_head", (0.2, 0.92), 200))


@query(_hard("niche_key,head", "cluster_gid", "hard_neg_p1", 0.1, 0.92))
def mine_hard_neg_p1(spark, sf_dir):
    return _cosine6(mining.hard_negatives(_vectors(spark, sf_dir), ["niche_key", "head"], "cluster_gid", "hard_neg_p1", (0.1, 0.92), 200))


@query(sql(f"""select * from (select least(a.pk_id, b.pk_id) as pk_left, greatest(a.pk_id, b.pk_id) as pk_right, 0::bigint as label, 'easy_neg' as type from k a join k b using (k) where a.category_id < b.category_id and k <= 200)
order by ({_key("pk_left")} + {_key("pk_right", 7)}) % 4294967296, pk_left, pk_right limit 200""", f"k as (select pk_id, category_id, row_number() over (partition by category_id order by {_key('pk_id')}, pk_id) as k from products)"))
def mine_easy_negatives(spark, sf_dir):
    return mining.easy_negatives(tables.products(spark, sf_dir).select("pk_id", "category_id"), 200)


_SEPARATORS = "array<struct<attr:string,regex:string,unit:string,unit_factor:map<string,double>,numeric:boolean,priority:int,label:string,tolerance:double>>"


def _schemas(spark, sf_dir):
    """A schema for even niches, and one for each category that the other niches fall back to."""
    n = tables.niches(spark, sf_dir).select("niche_key", "category_id")
    size = ("size", r"(\d+)\s*(mm|cm)", "m", {"mm": 0.001, "cm": 0.01}, True, 1, "Size", None)
    late, broken = ("size", r"(\d+)", "", None, True, 2, "Any", None), ("bad", r"(", "", None, False, 0, "Bad", None)
    word = ("word", r"^(\w+)", "", None, False, 2, "Word", None)
    own = spark.createDataFrame([([late, size, broken],)], f"separators {_SEPARATORS}")
    wide = spark.createDataFrame([([word],)], f"separators {_SEPARATORS}")
    niche = n.where("niche_key % 2 = 0").select("niche_key").join(own)  # a table of one row
    category = n.select("category_id").distinct().join(wide)
    return attributes.schema_of(n, niche, category)


@query(sql(r"""select pk_id, 'size' as attr, regexp_extract(name, '(\d+) mm', 1)::double * 0.001 as value_num, null::varchar as value_str, 1::bigint as priority from products where niche_key % 2 = 0
union all select pk_id, 'word', null, regexp_extract(name, '^(\w+)', 1), 2 from products where niche_key % 2 = 1"""))
def schema_extract(spark, sf_dir):
    t = tables.products(spark, sf_dir).select("pk_id", "niche_key", F.col("name").alias("text"))
    e = attributes.extract(t, _schemas(spark, sf_dir))
    return e.select("pk_id", "attr", "value_num", "value_str", F.col("priority").cast("long").alias("priority"))


@query(sql("select niche_key, case when niche_key % 2 = 0 then 3 else 1 end::bigint as separators from niches"))
def schema_merge(spark, sf_dir):
    return _schemas(spark, sf_dir).select("niche_key", F.size("separators").cast("long").alias("separators"))


@query(sql("""select pk_id, priority, attr from (select pk_id, attr, priority, row_number() over (partition by pk_id, attr order by priority, pos) as r from (select pk_id, 'a' || pos % 2 as attr, pos, (pos * 7 + pk_id) % 4 as priority from products, range(1, 7) s(pos))) where r = 1"""))
def separator_priority(spark, sf_dir):
    p = tables.products(spark, sf_dir).select("pk_id", F.explode(F.sequence(F.lit(1), F.lit(6))).alias("pos"))
    s = p.select("pk_id", "pos", F.concat(F.lit("a"), (F.col("pos") % 2).cast("string")).alias("attr"), ((F.col("pos") * 7 + F.col("pk_id")) % 4).alias("priority"))
    return tables.first_by(s, ["pk_id", "attr"], [F.col("priority"), F.col("pos")]).select("pk_id", F.col("priority").cast("long").alias("priority"), "attr")


@query(sql("""select pk_id, attr, value from (select pk_id, attr, value, row_number() over (partition by pk_id, attr order by src) as r from (
select pk_id, 'len' as attr, v as value, 0 as src from nums where pk_id % 3 = 0 union all select pk_id, 'len', v + 1, 1 from nums union all select pk_id, 'size', v * 1.02, 2 from nums where pk_id % 2 = 0)) m
where r = 1 and not (attr = 'size' and exists (select 1 from nums c where c.pk_id = m.pk_id and c.pk_id % 5 = 0 and abs(value - v) / greatest(abs(value), abs(v), 1e-9) < 0.05))"""))
def attr_merge_dedup(spark, sf_dir):
    a = tables.attrs(spark, sf_dir).where("attr = 'size'")
    row = lambda attr, v: a.select("pk_id", F.lit(attr).alias("attr"), v.alias("value"), F.lit("m").alias("dimension"))
    v = F.col("value_num")
    merged = attributes.merge(row("len", v).where("pk_id % 3 = 0"), row("len", v + 1), row("size", v * 1.02).where("pk_id % 2 = 0"))
    cached = row("cached", v).where("pk_id % 5 = 0")
    sized = attributes.without_repeats(merged.where("attr = 'size'"), cached)
    return merged.where("attr <> 'size'").unionByName(sized).select("pk_id", "attr", "value")


@query(sql("select pk_id, '[*Size=' || v::bigint || 'mm, Type=' || p_type || ']' as t from nums join part on p_partkey = pk_id"))
def attr_text(spark, sf_dir):
    from quillmesh.functions.text import format_attrs

    a = tables.attrs(spark, sf_dir)
    raw = F.coalesce(F.concat(F.col("value_num").cast("long").cast("string"), F.col("unit")), F.col("value_str"))
    rows = a.groupBy("pk_id").agg(F.sort_array(F.collect_list(F.struct("priority", "label", raw.alias("raw")))).alias("attrs"))
    return rows.select("pk_id", format_attrs("attrs").alias("t"))


@query(sql("select n.pk_id, case when greatest(v, dominant) / least(v, dominant) <= 1.15 then '✅' else '❌' end as verdict from nums n join d using (cluster_gid) where dominant > 0", bands("nums", "cluster_gid", "v", "d")))
def number_verdict(spark, sf_dir):
    a = tables.attrs(spark, sf_dir).where("attr = 'size'")
    d = aggregates.dominant_groups(a, ["cluster_gid"], "value_num").where("dominant > 0")
    ratio = F.greatest("value_num", "dominant") / F.least("value_num", "dominant")
    return a.join(d, "cluster_gid").select("pk_id", F.when(ratio <= 1.15, "✅").otherwise("❌").alias("verdict"))


@query(sql(f"select niche_key, {HEAD} as head, count(*) as products, max(len(tokens))::int as most_tokens from members group by 1, 2"))
def head_noun_groups(spark, sf_dir):
    p = tables.products(spark, sf_dir).select("niche_key", head_noun("name").alias("head"), F.size(tokenize("name")).alias("n"))
    return p.groupBy("niche_key", "head").agg(F.count("*").alias("products"), F.max("n").alias("most_tokens"))


@query(sql("select pk_id, place, price from (select pk_id, price, row_number() over (partition by niche_key order by price desc, pk_id) as place from products) where place <= 3"))
def niche_price_leaders(spark, sf_dir):
    w = Window.partitionBy("niche_key").orderBy(F.desc("price"), "pk_id")
    return tables.products(spark, sf_dir).select("pk_id", F.row_number().over(w).cast("long").alias("place"), "price").where("place <= 3")
