"""Blocking, graphs, cluster aggregates and scores."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quillmesh.functions.text import tokenize
from quillmesh.functions.vector import cosine
from quillmesh.operators import aggregates, blocking, graph, scoring
from quillmesh.plans.registry import query
from quillmesh.plans.sql import bands, brand, brand_match, jaccard, sql
from quillmesh.sources import tables

SIM = 0.30


def _products(spark, sf_dir):
    return tables.products(spark, sf_dir).withColumn("tokens", tokenize("name"))


def _members(spark, sf_dir):
    return _products(spark, sf_dir).join(tables.assignments(spark, sf_dir), "pk_id")


def _vectors(spark, sf_dir):
    v = tables.read(spark, sf_dir, "embeddings")
    return v.select(
        F.col("vec_id").cast("long").alias("pk_id"), "embedding", F.col("label").cast("long").alias("cluster_gid"), (F.col("vec_id") % 7).cast("long").alias("niche_key"),
        (F.col("vec_id") % 3).cast("long").alias("category_id"), F.concat(F.lit("h"), (F.col("vec_id") % 4).cast("string")).alias("head"),
    )


def _sizes(spark, sf_dir):
    return tables.assignments(spark, sf_dir).groupBy("cluster_gid").agg(F.count("*").alias("size"))


def _knn(spark, sf_dir):
    return blocking.nearest(_vectors(spark, sf_dir), least=SIM)


def _knn_edges(spark, sf_dir):
    n = _knn(spark, sf_dir)
    return n.select(F.least("pk_id", "other").alias("a"), F.greatest("pk_id", "other").alias("b"), F.round("sim", 6).alias("weight")).distinct()


_EDGES = "edges as (select distinct least(pk_id, other) as a, greatest(pk_id, other) as b from knn)"


@query(sql("select pk_id, other, round(sim, 6) as sim, place from knn"))
def knn_blocking(spark, sf_dir):
    return _knn(spark, sf_dir).select("pk_id", "other", F.round("sim", 6).alias("sim"), F.col("place").cast("long").alias("place"))


_CODES = "codes as (select doc_id as pk_id, md5(text) as code from documents)"


@query(sql("""select x.pk_id as a, y.pk_id as b, 1.0::double as weight from codes x join codes y on x.code = y.code and x.pk_id < y.pk_id
join (select code from codes where len(code) >= 8 and not regexp_matches(code, '^0+$') and len(list_distinct(string_split(code, ''))) > 2 group by code having count(*) between 2 and 50) g on g.code = x.code""", _CODES))
def ean_match_edges(spark, sf_dir):
    d = tables.read(spark, sf_dir, "documents").select(F.col("doc_id").alias("pk_id"), F.md5("text").alias("code"))
    return blocking.code_edges(d, "code")


_BRAND = f"""bp as (select m.*, {brand("brand")} as nb, count(*) over (partition by {brand("brand")}, niche_key) as g from members m),
bj as (select x.pk_id as a, y.pk_id as b, {jaccard("x.tokens", "y.tokens")} as overlap from bp x join bp y on x.nb = y.nb and x.niche_key = y.niche_key and x.pk_id < y.pk_id where x.g <= 200)"""


@query(sql("select a, b, round_even(overlap * 0.9, 4)::double as weight from bj where overlap >= 0.4 and overlap * 0.9 >= 0.6", _BRAND))
def brand_token_edges(spark, sf_dir):
    return blocking.brand_edges(_products(spark, sf_dir))


_EMB = f"""ke as (select least(pk_id, other) as a, greatest(pk_id, other) as b, max(sim) as sim from knn group by 1, 2),
kw as (select a, b, sim * 0.85 as w0, {brand_match("x.brand", "y.brand")} as bm, x.brand as ba, y.brand as bb, {jaccard("x.tokens", "y.tokens")} as jac,
  case when x.price > 0 and y.price > 0 then greatest(x.price / y.price, y.price / x.price) else 1.0 end as pr from ke join members x on x.pk_id = a join members y on y.pk_id = b),
k1 as (select *, case when bm = 1.0 then least(w0 + 0.10, 1.0) when bm = 0.0 and ba <> '' and bb <> '' then w0 * 0.7 else w0 end as w1 from kw),
k2 as (select *, case when jac > 0.5 then least(w1 + jac * 0.1, 1.0) else w1 end as w2 from k1),
k3 as (select a, b, case when pr > 3.0 then w2 - 0.15 else w2 end as w from k2),
emb as (select a, b, round(w, 4) as weight from k3 where w >= 0.2)"""


@query(sql("""select a, b, round(max(weight), 3) as weight from (select * from emb union all select a, b, round_even(overlap * 0.9, 4)::double from bj
where overlap >= 0.4 and overlap * 0.9 >= 0.6 and (a, b) not in (select (a, b) from emb)) group by 1, 2""", _BRAND, _EMB))
def candidate_edges(spark, sf_dir):
    p = _products(spark, sf_dir)
    near = blocking.embedding_edges(_knn(spark, sf_dir), p, least=0.2)
    return blocking.all_edges(near, blocking.brand_edges(p, existing=near)).select("a", "b", F.round("weight", 3).alias("weight"))


@query(sql("""select a, b, max(weight) as weight, count(*) as sources from (select *, 'near' as s from emb union all select a, b, 0.5::double, 'niche' from niche_pairs where (a, b) not in (select (a, b) from emb)
union all select a, b, 1.0::double, 'code' from code_pairs) group by 1, 2""", _BRAND, _EMB,
           "niche_pairs as (select a, b from bj where overlap >= 0.4)", "code_pairs as (select x.pk_id as a, y.pk_id as b from products x join products y on x.name = y.name and x.pk_id < y.pk_id)"))
def edge_set_ops(spark, sf_dir):
    p = _products(spark, sf_dir)
    near = blocking.embedding_edges(_knn(spark, sf_dir), p, least=0.2)
    niche = blocking.brand_pairs(p, existing=near).select("a", "b", F.lit(0.5).alias("weight"))  # the difference
    code = p.select("name", F.col("pk_id").alias("a")).join(p.select("name", F.col("pk_id").alias("b")), "name").where("a < b").select("a", "b", F.lit(1.0).alias("weight"))
    sources = near.unionByName(niche).unionByName(code).groupBy("a", "b").agg(F.count("*").alias("sources"))
    return blocking.all_edges(near, niche, code).join(sources, ["a", "b"]).select("a", "b", "weight", "sources")


@query(sql("select a, b from edges where a in (select pk_id from products) and b in (select pk_id from products)", _EDGES))
def edge_vertex_semijoin(spark, sf_dir):
    return graph.known_edges(_knn_edges(spark, sf_dir), tables.products(spark, sf_dir).select(F.col("pk_id").alias("node"))).select("a", "b")


@query("with recursive " + sql("select v.pk_id as node, min(r.b) as component from vecs v join reach r on r.a = v.pk_id group by 1", _EDGES,
       "both_ways as (select a, b from edges union select b, a from edges)", "reach as (select pk_id as a, pk_id as b from vecs union select r.a, e.b from reach r join both_ways e on e.a = r.b)")[5:])
def connected_components(spark, sf_dir):
    nodes = _vectors(spark, sf_dir).select(F.col("pk_id").alias("node"))
    return graph.connected_components(_knn_edges(spark, sf_dir), nodes)


@query()
def leiden_communities(spark, sf_dir):
    nodes = _vectors(spark, sf_dir).select(F.col("pk_id").alias("node"))
    return graph.communities(_knn_edges(spark, sf_dir), vertices=nodes)


@query(sql("select cluster_gid as community, n, 1000 + row_number() over (order by n desc, cluster_gid) as gid from (select cluster_gid, count(*) as n from assignments group by 1)"))
def gid_allocation(spark, sf_dir):
    a = tables.assignments(spark, sf_dir).select(F.col("pk_id").alias("node"), F.col("cluster_gid").alias("community"))
    gids = graph.allocate_gids(a, 1001)
    return a.join(gids, "node").groupBy("community").agg(F.count("*").alias("n"), F.min("cluster_gid").alias("gid"))


@query(sql("""select cluster_gid, count(*) as size, arg_max(pk_id, (revenue, sales, -pk_id)) as main_pk, round(avg(case when price > 0 then price end), 6) as avg_price,
min(pk_id) as first_pk, min(lower(brand)) as brand from members group by 1"""))
def cluster_summary(spark, sf_dir):
    return graph.cluster_summary(_members(spark, sf_dir)).withColumn("avg_price", F.round("avg_price", 6))


@query(sql("""select cluster_gid, pos - 1 as pos, round(m / sqrt(sum(m * m) over (partition by cluster_gid)), 6) as x from
(select cluster_gid, pos, avg(e[pos]) as m from vecs, range(1, 65) r(pos) group by 1, 2)"""))
def cluster_centroids(spark, sf_dir):
    c = aggregates.centroids(_vectors(spark, sf_dir), "cluster_gid", "embedding")
    return c.select("cluster_gid", F.col("pos").cast("long").alias("pos"), F.round("x", 6).alias("x"))


@query(sql("select a.cluster_gid, round(avg(list_cosine_similarity(a.e, b.e)), 6) as coherence from vecs a join vecs b on a.cluster_gid = b.cluster_gid and a.pk_id < b.pk_id group by 1"))
def cluster_coherence(spark, sf_dir):
    return aggregates.coherence(_vectors(spark, sf_dir), "cluster_gid", "embedding").select("cluster_gid", F.round("coherence", 6).alias("coherence"))


@query(sql("""select a.cluster_gid, round(avg(list_cosine_similarity(a.e, b.e)), 6) as coherence from
ov a join ov b on a.cluster_gid = b.cluster_gid and a.pk_id < b.pk_id where a.r <= 10 and b.r <= 10 group by 1""",
           "ov as (select v.*, row_number() over (partition by v.cluster_gid order by pk_id) as r from vecs v join (select cluster_gid, max(pk_id) as judged from vecs group by 1) using (cluster_gid) where pk_id <> judged)"))
def intra_consistency(spark, sf_dir):
    v = _vectors(spark, sf_dir)
    judged = v.groupBy("cluster_gid").agg(F.max("pk_id").alias("pk_id"))  # the product whose move is judged isn't asked
    first = aggregates.capped_members(v.join(judged, ["cluster_gid", "pk_id"], "left_anti"), "cluster_gid", 10)
    return aggregates.coherence(first, "cluster_gid", "embedding").where("n > 1").select("cluster_gid", F.round("coherence", 6).alias("coherence"))


@query(sql("select cluster_gid, n, group_size, kernel, dominant, n_distinct from d", bands("nums", "cluster_gid", "v", "d")))
def dominant_group(spark, sf_dir):
    a = tables.attrs(spark, sf_dir).where("attr = 'size'")
    return aggregates.dominant_groups(a, ["cluster_gid"], "value_num").select("cluster_gid", "n", "group_size", "kernel", "dominant", "n_distinct")


@query(sql("select cluster_gid, min(v) as modal, max(c) as modal_count, max(n) as n from (select *, max(c) over (partition by cluster_gid) as mc, sum(c) over (partition by cluster_gid)::bigint as n from (select cluster_gid, v, count(*) as c from nums group by 1, 2)) where c = mc group by 1"))
def modal_share(spark, sf_dir):
    return aggregates.modal_values(tables.attrs(spark, sf_dir).where("attr = 'size'"), ["cluster_gid"], "value_num").select("cluster_gid", "modal", "modal_count", "n")


@query(sql("select cluster_gid, v as value_num, count(*) as n from kept group by 1, 2"))
def outlier_drop(spark, sf_dir):
    a = tables.attrs(spark, sf_dir).where("attr = 'size'")
    return aggregates.without_outliers(a, "cluster_gid", "attr", "value_num", _sizes(spark, sf_dir)).groupBy("cluster_gid", "value_num").agg(F.count("*").alias("n"))


@query(sql("select cluster_gid, v as value_num, count(*) as n, round(count(*) / sum(count(*)) over (partition by cluster_gid), 9) as share from nums group by 1, 2"))
def value_share(spark, sf_dir):
    s = aggregates.value_shares(tables.attrs(spark, sf_dir).where("attr = 'size'"), ["cluster_gid"], "value_num")
    return s.withColumn("share", F.round("share", 9))


@query(sql("""select a.pk_id, a.cluster_gid, a.v as value, case when count(b.v) >= 2 then list_sort(list(b.v))[count(b.v) // 2 + 1] end as others
from nums a left join nums b on a.cluster_gid = b.cluster_gid and a.pk_id <> b.pk_id group by 1, 2, 3"""))
def leave_one_out_median(spark, sf_dir):
    a = tables.attrs(spark, sf_dir).where("attr = 'size'")
    return aggregates.leave_one_out_medians(a, "cluster_gid", "attr", "value_num").select("pk_id", "cluster_gid", "value", "others")


@query(sql("select cluster_gid, list_sort(list(v))[count(*) // 2 + 1] as median from (select *, row_number() over (partition by cluster_gid order by pk_id) as r from nums) where r <= 20 group by 1 having count(*) >= 2"))
def capped_medians(spark, sf_dir):
    a = tables.attrs(spark, sf_dir).where("attr = 'size'")
    return aggregates.capped_medians(a, "cluster_gid", "attr", "value_num").select("cluster_gid", "median")


@query(sql("select cluster_gid, dominant as median from d where dominant is not null", "first30 as (select * from (select *, row_number() over (partition by cluster_gid order by pk_id) as r from nums) where r <= 30)", bands("first30", "cluster_gid", "v", "d")))
def p1_cluster_median(spark, sf_dir):
    a = aggregates.capped_members(tables.attrs(spark, sf_dir).where("attr = 'size'"), "cluster_gid", 30)
    return aggregates.dominant_groups(a, ["cluster_gid"], "value_num").where("dominant is not null").select("cluster_gid", F.col("dominant").alias("median"))


_PRICES = "pos as (select user_id, event_type, list_sort(list(value)) as s, count(*) as n from events where value > 0 group by 1, 2)"


@query(sql("select user_id, event_type, n, s[n // 4 + 1] as q1, s[n // 2 + 1] as median, s[3 * n // 4 + 1] as q3 from pos", _PRICES))
def index_quartiles(spark, sf_dir):
    return aggregates.index_quartiles(tables.read(spark, sf_dir, "events").where("value > 0"), ["user_id", "event_type"], "value")


_TIERS = """wide as (select event_type, list_sort(list(value)) as s, count(*) as n from events where value > 0 group by 1),
r as (select e.event_id, e.value, coalesce(p.n, 0) >= 4 as own, case when coalesce(p.n, 0) >= 4 then p.s else w.s end as s, case when coalesce(p.n, 0) >= 4 then p.n else w.n end as n
  from events e left join pos p using (user_id, event_type) left join wide w using (event_type)),
q as (select *, s[n // 4 + 1] as q1, s[n // 2 + 1] as m, s[3 * n // 4 + 1] as q3, value > 0 and coalesce(n, 0) >= 4 as judged from r),
tiers as (select event_id, (case when not judged then 1 when value < q1 - 1.5 * (q3 - q1) or value > q3 + 1.5 * (q3 - q1) then 3 when value < q1 then 0 when value > q3 then 2 else 1 end)::bigint as tier,
  (case when value <= 0 or own then 0 else 1 end)::bigint as src, case when judged and m > 0 then round(value / m + 1e-9, 3) else 1.0 end as ratio from q)"""


@query(sql("select event_id, tier, src, ratio, (tier = 3)::bigint as flag, case tier when 3 then -0.05 when 1 then 0.05 else 0.0 end::double as score from tiers", _PRICES, _TIERS))
def price_anomaly_tiers(spark, sf_dir):
    t = scoring.price_tiers(tables.read(spark, sf_dir, "events"), ["user_id", "event_type"], "value", ["event_type"])
    return t.select("event_id", "tier", "src", "ratio", "flag", scoring.price_score_of_tier(F.col("tier")).alias("score"))


_CORE = """c20 as (select * from (select *, row_number() over (partition by cluster_gid order by pk_id) as r from members) where r <= 20),
ct as (select cluster_gid, unnest(tokens) as token from c20),
core as (select t.cluster_gid, token, count(*) as n from ct t join (select cluster_gid, count(*) as sampled from c20 group by 1) s using (cluster_gid) group by 1, 2, sampled having count(*) >= greatest(2.0, sampled * 0.3)),
cores as (select cluster_gid, list(token) as core from core group by 1),
tscore as (select pk_id, case when core is null or len(tokens) = 0 then 0.05 else len(list_intersect(list_distinct(tokens), core)) / len(core) * 0.15 end as token_score from members left join cores using (cluster_gid))"""


@query(sql("select cluster_gid, token, n from core", _CORE))
def core_tokens(spark, sf_dir):
    return scoring.core_tokens(_members(spark, sf_dir))


@query(sql("select pk_id, round(token_score, 9) as token_score from tscore", _CORE))
def token_score(spark, sf_dir):
    return scoring.token_scores(_members(spark, sf_dir)).withColumn("token_score", F.round("token_score", 9))


_CENT = """cent as (select cluster_gid, list(m order by pos) as c from (select cluster_gid, pos, avg(e[pos]) as m from vecs, range(1, 65) r(pos) group by 1, 2) group by 1),
sims as (select pk_id, cluster_gid, list_cosine_similarity(e, c) as sim from vecs join cent using (cluster_gid))"""


def _sims(spark, sf_dir):
    v = _vectors(spark, sf_dir)
    c = aggregates.centroid_vectors(aggregates.centroids(v, "cluster_gid", "embedding"), "cluster_gid")
    return v.join(c, "cluster_gid").select("pk_id", "cluster_gid", cosine("embedding", "centroid").alias("sim"))


@query(sql("select pk_id, round(sim, 6) as sim, round(greatest(0.0, least(0.35, (sim - 0.5) * 0.7778)), 5) as score from sims", _CENT))
def embedding_score(spark, sf_dir):
    return _sims(spark, sf_dir).select("pk_id", F.round("sim", 6).alias("sim"), F.round(scoring.embedding_score(F.col("sim")), 5).alias("score"))


_BS = f"""bs as (select pk_id, case when pk_id % 9 = 0 then 0.03 else case {brand_match("m.brand", "o.brand")} when 1.0 then 0.10 when 0.5 then 0.05 else 0.0 end end::double as brand_score
from members m join (select niche_key, min(brand) as brand from members group by 1) o using (niche_key))"""


@query(sql("select pk_id, brand_score from bs", _BS))
def brand_score(spark, sf_dir):
    p = tables.products(spark, sf_dir)
    top = p.groupBy("niche_key").agg(F.min("brand").alias("top"))
    b = p.join(top, "niche_key").withColumn("brand", F.when(F.col("pk_id") % 9 == 0, "").otherwise(F.col("brand")))
    return b.select("pk_id", scoring.brand_score("brand", "top").alias("brand_score"))


_ATTR = """ag as (select n.pk_id, n.v, d.* from nums n join d using (cluster_gid)),
ap as (select pk_id, dominant is null and n_distinct >= 3 and not coalesce(kernel * 0.85 <= v and v <= kernel * 1.15, false) as split,
  dominant is not null and v > 0 and dominant > 0 as judged, greatest(v, dominant) / least(v, dominant) as ratio from ag),
attr_s as (select pk_id, case when split then -0.15 when judged and ratio <= 1.15 then 0.05 when judged and ratio > 1.3 then -0.15 else 0.0 end as attr_score,
  split or coalesce(judged and ratio > 1.3, false) as blocker from ap)"""


@query(sql("select pk_id, attr_score::double as attr_score, blocker from attr_s", bands("kept", "cluster_gid", "v", "d"), _ATTR))
def numeric_attr_score(spark, sf_dir):
    return scoring.attr_scores(tables.attrs(spark, sf_dir), _sizes(spark, sf_dir))


_NAMES = r"""nm as (select m.pk_id, m.cluster_gid, a.value_num as v, row_number() over (partition by m.cluster_gid order by m.pk_id) as r from members m join attrs a on a.pk_id = m.pk_id and a.attr = 'size'),
nc as (select cluster_gid, v, count(*) as c, sum(count(*)) over (partition by cluster_gid) as n from nm where r <= 30 group by 1, 2),
nt as (select cluster_gid, min(v) as modal, max(c) as c, max(n) as n from (select *, max(c) over (partition by cluster_gid) as mc from nc) where c = mc group by 1),
ns as (select pk_id, case when t.cluster_gid is null then 0.0 when v = modal then 0.05 when greatest(v / modal, modal / v) > 3.0 then -0.10 when greatest(v / modal, modal / v) > 1.5 then -0.03 else 0.0 end as s
  from nm left join (select * from nt where n >= 3 and c / n >= 0.5) t using (cluster_gid))"""


@query(sql("select pk_id, s::double as name_score from ns", _NAMES))
def numeric_name_fallback(spark, sf_dir):
    return scoring.name_numbers_score(_members(spark, sf_dir).select("cluster_gid", "pk_id", "name"))


@query(sql("select n.pk_id, 'size' as mismatches from nums n join d using (cluster_gid) where d.n >= 3 and d.dominant > 0 and v > 0 and greatest(v, d.dominant) / least(v, d.dominant) > 1.15", bands("kept", "cluster_gid", "v", "d")))
def attr_block(spark, sf_dir):
    weights = spark.createDataFrame([("size", True, "numeric"), ("type", True, "string"), ("color", False, "string")], "attr string, block boolean, type string")
    a = tables.attrs(spark, sf_dir).withColumn("value_str", F.lower("value_str"))
    return scoring.attr_block(a, weights, _sizes(spark, sf_dir))


_LEGACY = """avgp as (select cluster_gid, avg(case when price > 0 then price end) as avg_price from members group by 1),
leg as (select pk_id, price, avg_price, case when price > 0 and avg_price > 0 then greatest(price / avg_price, avg_price / price) else 1.0 end as pr from members join avgp using (cluster_gid)),
lp as (select pk_id, pr, case when price <= 0 or avg_price <= 0 then 0.0 when pr <= 1.5 then 0.05 when pr <= 3.0 then 0.0 else -0.05 end::double as price_score from leg)"""


@query(sql("select pk_id, price_score from lp", _LEGACY))
def price_score_legacy(spark, sf_dir):
    m = _members(spark, sf_dir)
    a = m.groupBy("cluster_gid").agg(F.avg(F.when(F.col("price") > 0, F.col("price"))).alias("avg_price"))
    return m.join(a, "cluster_gid").select("pk_id", scoring.price_score_of_ratio("price", "avg_price").alias("price_score"))


_SCORE = """parts as (select m.pk_id, case when m.pk_id % 17 = 0 then null else m.cluster_gid end as cluster_gid, greatest(0.0, least(0.35, (m.pk_id % 100 / 100.0 - 0.5) * 0.7778)) as e, t.token_score as t, 0.10 as b, coalesce(a.attr_score, 0.0) as a,
  l.price_score as p, coalesce(a.blocker, false) as blocker, l.pr from members m join tscore t using (pk_id) left join attr_s a using (pk_id) join lp l using (pk_id)),
raw as (select *, least(1.0, greatest(0.0, (e + t + b + a + p + 0.30) / 1.05)) as s from parts),
scored as (select pk_id, cluster_gid, case when cluster_gid is null then 0.0 else round(s, 4) end as score, case when cluster_gid is null then 0.5 else s end as confidence,
  case when cluster_gid is null or blocker then 'grey' when s >= 0.75 then 'ok' when s <= 0.30 then 'quarantine' else 'grey' end as decision, case when cluster_gid is null or not blocker then '' else '[ЧИСЛО-БЛОКЕР] числовые атрибуты не совпадают с кластером' end as reason from raw)"""
SCORE_CTES = (bands("kept", "cluster_gid", "v", "d"), _CORE, _ATTR, _LEGACY, _SCORE)


def scored_products(spark, sf_dir):
    m, sizes = _members(spark, sf_dir), _sizes(spark, sf_dir)
    average = m.groupBy("cluster_gid").agg(F.avg(F.when(F.col("price") > 0, F.col("price"))).alias("avg_price"))
    parts = (
        m.join(scoring.token_scores(m), "pk_id").join(scoring.attr_scores(tables.attrs(spark, sf_dir), sizes), "pk_id", "left").join(average, "cluster_gid")
        .withColumns({
            "embedding_score": scoring.embedding_score(F.col("pk_id") % 100 / 100.0), "brand_score": F.lit(0.10), "attr_score": F.coalesce("attr_score", F.lit(0.0)),
            "price_score": scoring.price_score_of_ratio("price", "avg_price"), "item_ratio": F.lit(1.0), "cluster_gid": F.when(F.col("pk_id") % 17 != 0, F.col("cluster_gid")),
        })
    )
    return scoring.decide(parts)


@query(sql("select pk_id, round(score, 3) as score, round(confidence, 3) as confidence, decision, reason from scored", *SCORE_CTES))
def score_products(spark, sf_dir):
    s = scored_products(spark, sf_dir)
    return s.select("pk_id", F.round("score", 3).alias("score"), F.round("confidence", 3).alias("confidence"), "decision", "reason")


@query(sql("select decision, count(*) as n, round(avg(score), 4) as mean_score from scored group by 1", *SCORE_CTES))
def decision_stats(spark, sf_dir):
    return scored_products(spark, sf_dir).groupBy("decision").agg(F.count("*").alias("n"), F.round(F.avg("score"), 4).alias("mean_score"))


@query(sql("""select pk_id, case when size <= 2 then 'grey' when size > 2 and d > 0.15 then 'grey' else 'ok' end as decision,
case when size <= 2 then '[ANOMALY-SMALL] cluster_size=' || size when d > 0.15 then '[ANOMALY-ATTR] size' else '' end as reason
from assignments join sizes using (cluster_gid) left join (select a.pk_id, abs(ln(a.v / list_sort(list(b.v))[count(b.v) // 2 + 1])) as d from nums a join nums b on a.cluster_gid = b.cluster_gid and a.pk_id <> b.pk_id group by a.pk_id, a.v having count(b.v) >= 2) using (pk_id)"""))
def attr_anomaly(spark, sf_dir):
    d = tables.assignments(spark, sf_dir).withColumns({"decision": F.lit("ok"), "reason": F.lit("")})
    return scoring.anomaly_pass(d, tables.attrs(spark, sf_dir)).select("pk_id", "decision", "reason")


@query(sql("select pk_id, case when size <= 2 then 'grey' else 'ok' end as decision from assignments join sizes using (cluster_gid)"))
def small_cluster_flag(spark, sf_dir):
    d = tables.assignments(spark, sf_dir).withColumns({"decision": F.lit("ok"), "reason": F.lit("")})
    return scoring.anomaly_pass(d, tables.attrs(spark, sf_dir).where("attr = 'type'")).select("pk_id", "decision")


_RERANK = f"""own as (select m.* from members m join scored s using (pk_id) where s.cluster_gid is not null),
mains as (select cluster_gid, arg_max(tokens, (revenue, sales, -pk_id)) as main_tokens from own group by 1),
rr as (select m.pk_id, 1 / (1 + exp(-({jaccard("m.tokens", "main_tokens")} * 8 - 4))) as s from own m join mains using (cluster_gid))"""


@query(sql("""select pk_id, case when decision = 'grey' and cluster_gid is not null and s >= 0.85 then 'ok' when decision = 'grey' and cluster_gid is not null and s <= 0.20 then 'quarantine' else decision end as decision
from scored left join rr using (pk_id)""", *SCORE_CTES, _RERANK))
def reranker_route(spark, sf_dir):
    return scoring.rerank_grey(scored_products(spark, sf_dir)).select("pk_id", "decision")


@query(sql("select cluster_gid, v as value, n, round(n / total, 9) as share from (select cluster_gid, v, count(*) as n, sum(count(*)) over (partition by cluster_gid) as total from (select *, row_number() over (partition by cluster_gid order by pk_id) as r from nums) where r <= 30 group by 1, 2) where n / total >= 0.4"))
def dominant_context(spark, sf_dir):
    first = aggregates.capped_members(tables.attrs(spark, sf_dir).where("attr = 'size'"), "cluster_gid", 30)
    return aggregates.value_shares(first, ["cluster_gid"], "value_num").where("share >= 0.4").select("cluster_gid", F.col("value_num").alias("value"), "n", F.round("share", 9).alias("share"))


@query(sql("select cluster_gid, pk_id, place from (select cluster_gid, pk_id, row_number() over (partition by cluster_gid order by revenue desc, pk_id) as place from members) where place <= 5"))
def exemplars_top_revenue(spark, sf_dir):
    w = Window.partitionBy("cluster_gid").orderBy(F.desc("revenue"), "pk_id")
    return _members(spark, sf_dir).select("cluster_gid", "pk_id", F.row_number().over(w).cast("long").alias("place")).where("place <= 5")


@query(sql("select pk_id, cluster_gid, place from (select pk_id, cluster_gid, row_number() over (partition by cluster_gid order by pk_id) as place from assignments) where place <= 5"))
def move_members(spark, sf_dir):
    w = Window.partitionBy("cluster_gid").orderBy("pk_id")
    return tables.assignments(spark, sf_dir).withColumn("place", F.row_number().over(w).cast("long")).where("place <= 5")


@query(sql("select pk_id, cluster_gid, main_pk, p.name as main_name from members m join (select cluster_gid, arg_max(pk_id, (revenue, sales, -pk_id)) as main_pk from members group by 1) c using (cluster_gid) join (select pk_id as k, name from products) p on p.k = main_pk where pk_id in (select pk_id from scored where decision = 'grey')", *SCORE_CTES))
def main_name_pairs(spark, sf_dir):
    m = _members(spark, sf_dir)
    c = graph.cluster_summary(m).select("cluster_gid", "main_pk")
    names = m.select(F.col("pk_id").alias("main_pk"), F.col("name").alias("main_name"))
    grey = scored_products(spark, sf_dir).where("decision = 'grey'").select("pk_id")
    return m.join(grey, "pk_id", "left_semi").select("pk_id", "cluster_gid").join(c, "cluster_gid").join(names, "main_pk").select("pk_id", "cluster_gid", "main_pk", "main_name")
