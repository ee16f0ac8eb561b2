"""Scans, lookups, keys, sets and upserts."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillmesh.functions.text import words_only, tokenize
from quillmesh.operators import attributes, mining
from quillmesh.plans.registry import query
from quillmesh.plans.sql import sql
from quillmesh.sources import sinks, tables


def _history(spark, sf_dir):
    """Assignment runs from events: the product is the user, the cluster follows the event type."""
    e = tables.read(spark, sf_dir, "events")
    gid = F.when(F.col("event_type") != "error", F.length("event_type") * 10 + F.ascii("event_type")).cast("long")
    run = F.unix_micros(F.col("ts").cast("timestamp")) * 10 + F.col("event_id") % 10
    return e.select(F.col("user_id").alias("pk_id"), run.alias("run_id"), "event_id", gid.alias("cluster_gid"), F.col("value").alias("score"))


_HISTORY = """hist as (select user_id as pk_id, epoch_us(ts::timestamp) * 10 + event_id % 10 as run_id, event_id,
  case when event_type <> 'error' then length(event_type) * 10 + ascii(event_type) end::bigint as cluster_gid, value as score from events)"""


@query(sql("select pk_id, name, brand, niche_key, price, sales, revenue from products where category_id = 1 and name <> ''"))
def load_products_by_category(spark, sf_dir):
    p = tables.coalesced(tables.by_category(tables.products(spark, sf_dir), 1))
    return p.select("pk_id", "name", "brand", "niche_key", "price", "sales", "revenue")


@query(sql("select pk_id, name, price from products where niche_key = 3"))
def niche_scan(spark, sf_dir):
    return tables.by_niche(tables.products(spark, sf_dir), 3).select("pk_id", "name", "price")


@query(sql("select pk_id, cluster_gid, score from (select *, row_number() over (partition by pk_id order by run_id desc, cluster_gid) as r from hist where cluster_gid is not null) where r = 1", _HISTORY))
def latest_assignment(spark, sf_dir):
    return tables.latest_assignments(_history(spark, sf_dir))


@query("""select (select greatest(coalesce(max(o_orderkey % 977), 0) + 1, 100) from orders)::bigint as next_run_id,
  (select coalesce(max(400000 + p_partkey), 400000) + 1 from part)::bigint as next_gid""")
def next_run_and_gid(spark, sf_dir):
    runs = tables.read(spark, sf_dir, "orders").select((F.col("o_orderkey") % 977).alias("run_id"))
    gids = tables.read(spark, sf_dir, "part").select((F.col("p_partkey") + 400_000).alias("cluster_gid"))
    return sinks.next_run_id(runs).join(sinks.next_gid(gids))  # two tables of one row each


@query("""with kv as (select event_id, unnest(json_keys(props)) as attr, props from events where json_valid(props)),
v as (select event_id, attr, json_extract_string(props, '$."' || attr || '"') as value from kv)
select event_id, attr, value, try_cast(value as double) is not null as is_numeric, case when try_cast(value as double) is not null then 1 else 2 end::bigint as priority from v where value is not null""")
def attr_json_parse(spark, sf_dir):
    found = tables.json_attrs(tables.read(spark, sf_dir, "events"), "event_id", "props")
    return found.withColumn("priority", F.col("priority").cast("long"))


@query("select n_nationkey::bigint as niche_key, coalesce(r_name, 'Category ' || n_regionkey) as category, coalesce(n_name, 'niche_' || n_nationkey) as niche from nation left join region on n_regionkey = r_regionkey and r_regionkey <> 2".replace("'Category ' || n_regionkey", "'Category ' || n_regionkey::varchar"))
def dimension_lookup(spark, sf_dir):
    region = tables.read(spark, sf_dir, "region").where("r_regionkey <> 2")
    n = tables.read(spark, sf_dir, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    name = lambda c, prefix, k: F.coalesce(c, F.concat(F.lit(prefix), F.col(k).cast("string")))
    return n.select(F.col("n_nationkey").cast("long").alias("niche_key"), name("r_name", "Category ", "n_regionkey").alias("category"), name("n_name", "niche_", "n_nationkey").alias("niche"))


@query(sql("""select m.cluster_gid, m.pk_id, m.category_id, a.value_num as ocr_size from members m left join (select pk_id, value_num from attrs where attr = 'size' and value_num > 10) a using (pk_id)
where m.category_id in (1, 2) and m.cluster_gid is not null"""))
def calibration_input(spark, sf_dir):
    a = tables.attrs(spark, sf_dir).where("attr = 'size' and value_num > 10").select("pk_id", F.col("value_num").alias("ocr_size"))
    p = tables.products(spark, sf_dir).where(F.col("category_id").isin(1, 2)).select("pk_id", "category_id")
    return p.join(tables.assignments(spark, sf_dir), "pk_id").join(a, "pk_id", "left").where("cluster_gid is not null").select("cluster_gid", "pk_id", "category_id", "ocr_size")


@query(sql("select niche_key, cluster_gid, count(*) as n, string_agg(name, '|' order by name) as names from members where cluster_gid is not null group by 1, 2"))
def cluster_name_lists(spark, sf_dir):
    m = tables.products(spark, sf_dir).join(tables.assignments(spark, sf_dir), "pk_id").where("cluster_gid is not null")
    return m.groupBy("niche_key", "cluster_gid").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list("name")), "|").alias("names"))


@query(sql("select pk_id, cluster_gid, niche_key, category_id, name from members where category_id = 2"))
def mining_input(spark, sf_dir):
    p = tables.by_category(tables.products(spark, sf_dir), 2)
    return p.join(tables.assignments(spark, sf_dir), "pk_id").select("pk_id", "cluster_gid", "niche_key", "category_id", "name")


@query("select d.doc_id, l.quality::bigint as quality, l.quality is null as to_ask from documents d left join (select doc_id, max(quality) as quality from labels group by 1) l using (doc_id)")
def cache_join(spark, sf_dir):
    cache = tables.read(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").cast("long").alias("quality"))
    joined, to_ask = tables.with_cache(tables.read(spark, sf_dir, "documents").select("doc_id"), cache, "doc_id")
    asked = to_ask.select("doc_id", F.lit(None).cast("long").alias("quality"), F.lit(True).alias("to_ask"))
    return joined.where("quality is not null").withColumn("to_ask", F.lit(False)).unionByName(asked)


@query(sql("select pk_id, event_id, score from (select *, row_number() over (partition by pk_id order by event_id desc) as r from hist) where r = 1", _HISTORY))
def upsert_latest(spark, sf_dir):
    h = _history(spark, sf_dir).select("pk_id", "event_id", "score")
    return sinks.upsert(h.where("event_id % 2 = 0"), h.where("event_id % 2 = 1"), ["pk_id"], "event_id")


@query(sql("select l.pk_id as pk_left, r.pk_id as pk_right, l.name as name_left, r.name as name_right, 1::bigint as label from products l join products r on r.pk_id = l.pk_id + 1"))
def training_pair_join(spark, sf_dir):
    p = tables.products(spark, sf_dir)
    pairs = p.select(F.col("pk_id").alias("pk_left"), (F.col("pk_id") + 1).alias("pk_right"), F.lit(1).cast("long").alias("label"))
    return tables.name_pairs(pairs, p)


@query(sql("select category_id, count(*) filter (where cluster_gid is not null) as with_cluster, count(*) filter (where cluster_gid is null) as without_cluster from (select m.category_id, case when pk_id % 5 <> 0 then cluster_gid end as cluster_gid from members m) group by 1"))
def cluster_presence_split(spark, sf_dir):
    a = tables.assignments(spark, sf_dir).where("pk_id % 5 <> 0")
    p = tables.products(spark, sf_dir).select("pk_id", "category_id").join(a, "pk_id", "left")
    return p.groupBy("category_id").agg(F.count_if(F.col("cluster_gid").isNotNull()).alias("with_cluster"), F.count_if(F.col("cluster_gid").isNull()).alias("without_cluster"))


@query(sql("select pk_id, array_to_string(list_filter(tokens, lambda w: not regexp_matches(w, '^[0-9]+$')), ' ') as words from members"))
def non_digit_tokens(spark, sf_dir):
    return tables.products(spark, sf_dir).select("pk_id", F.array_join(words_only(tokenize("name")), " ").alias("words"))


@query("with kv as (select unnest(json_keys(props)) as attr from events where json_valid(props)) select distinct attr from kv where attr not in ('id', 'name')")
def attr_key_distinct(spark, sf_dir):
    keys = tables.json_attrs(tables.read(spark, sf_dir, "events"), "event_id", "props")
    return tables.attr_keys(keys, ("id", "name"))


@query("""with g(canonical, v) as (values ('color', 'colour'), ('color', 'shade'), ('size', 'dimension'), ('size', 'shade')), r as (select v as variant, canonical from g union select canonical, canonical from g)
select variant, min(canonical) as canonical from r group by 1""")
def synonym_reverse_map(spark, sf_dir):
    groups = spark.createDataFrame([("color", ["colour"]), ("color", ["shade"]), ("size", ["dimension", "shade"])], "canonical string, variants array<string>")
    return attributes.reverse_synonyms(attributes.merge_synonyms(groups))


@query(sql("""select brand || floor(price)::bigint as key from products where category_id = 1 except select brand || floor(price)::bigint from products where category_id = 2"""))
def key_difference(spark, sf_dir):
    p = tables.products(spark, sf_dir).withColumn("key", F.concat("brand", F.floor("price").cast("string")))
    return p.where("category_id = 1").select("key").join(p.where("category_id = 2").select("key"), "key", "left_anti").distinct()


@query(sql("""select pk_id, name, niche_key from products order by (niche_key = 2) desc, pk_id * 2654435761 % 4294967296, pk_id limit 25"""))
def niche_first_order(spark, sf_dir):
    p = tables.products(spark, sf_dir)
    return p.orderBy((F.col("niche_key") == 2).desc(), F.col("pk_id") * 2_654_435_761 % 4_294_967_296, "pk_id").limit(25).select("pk_id", "name", "niche_key")


@query(sql("select pk_id, (pk_id % 1000003 * 2654435761 % 4294967296)::bigint as k from products"))
def shuffled_order(spark, sf_dir):
    return tables.products(spark, sf_dir).select("pk_id", mining.order_key("pk_id").alias("k"))
