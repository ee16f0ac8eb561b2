"""Text, value and vector functions over the driver's texts, parts and vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillmesh.functions import text, value, vector
from quillmesh.operators import pairs, providers
from quillmesh.plans.registry import query
from quillmesh.plans.sql import brand_match, jaccard, norm, sql
from quillmesh.sources import tables


@query(f"select doc_id, {norm('text')} as t from documents")
def normalize_text(spark, sf_dir):
    return tables.read(spark, sf_dir, "documents").select("doc_id", text.normalize_text("text").alias("t"))


@query(r"""with b as (select p_partkey, lower(p_brand || case p_partkey % 4 when 0 then ' LLC' when 1 then ' GmbH' when 2 then ' Inc' else '' end) as b from part)
select p_partkey as pk_id, trim(regexp_replace(regexp_replace(b, ' (llc|gmbh|inc)$', ''), '[^a-z0-9\s/-]', '', 'g')) as b from b""")
def normalize_brand(spark, sf_dir):
    suffix = F.element_at(F.array(F.lit(" LLC"), F.lit(" GmbH"), F.lit(" Inc"), F.lit("")), (F.col("p_partkey") % 4 + 1).cast("int"))
    return tables.read(spark, sf_dir, "part").select(F.col("p_partkey").alias("pk_id"), text.normalize_brand(F.concat("p_brand", suffix)).alias("b"))


@query(sql("select pk_id, array_to_string(tokens, ' ') as tokens from members"))
def tokenize_latin(spark, sf_dir):
    return tables.products(spark, sf_dir).select("pk_id", F.array_join(text.tokenize("name"), " ").alias("tokens"))


@query(sql(r"select pk_id, regexp_extract(" + norm("name") + r", '(\d+)\s*mm', 1)::double as mm from products"))
def numeric_attrs(spark, sf_dir):
    return tables.products(spark, sf_dir).select("pk_id", F.try_element_at(text.numeric_attrs("name"), F.lit("mm")).alias("mm"))


@query(sql("select pk_id, trim(regexp_replace(regexp_replace(regexp_replace(name, '[0-9]+ mm', ''), '#[0-9]+', '#', 'g'), ' +', ' ', 'g')) as t from products"))
def strip_numbers(spark, sf_dir):
    return tables.products(spark, sf_dir).select("pk_id", text.strip_numbers("name").alias("t"))


_UNITS = "[('mm', 0.001, 'm'), ('kw', 1000.0, 'w'), ('kg', 1000.0, 'g'), ('ml', 0.001, 'l'), ('zz', 1.0, '')]"


@query("""with u as (select p_partkey as pk_id, p_size, p_partkey % 5 as k from part)
select pk_id, p_size::double * [0.001, 1000.0, 1000.0, 0.001, 1.0][k + 1]::double as value, ['m', 'w', 'g', 'l', ''][k + 1] as dimension from u""")
def canon_numeric_units(spark, sf_dir):
    unit = F.element_at(F.array(*map(F.lit, ("mm", "kW", "kg", "ml", "zz"))), (F.col("p_partkey") % 5 + 1).cast("int"))
    c = value.canon_numeric(F.concat_ws(" ", F.col("p_size").cast("string"), unit))
    return tables.read(spark, sf_dir, "part").select(F.col("p_partkey").alias("pk_id"), c["value"].alias("value"), c["dimension"].alias("dimension"))


@query(r"select p_partkey as pk_id, trim(regexp_replace(regexp_replace(lower(p_brand || ' -- ' || p_type), '[^\w\s]', ' ', 'g'), '\s+', ' ', 'g')) as t from part")
def canon_string(spark, sf_dir):
    return tables.read(spark, sf_dir, "part").select(F.col("p_partkey").alias("pk_id"), value.canon_string(F.concat_ws(" -- ", "p_brand", "p_type")).alias("t"))


@query(sql(f"select a.pk_id as a, b.pk_id as b, round({jaccard('a.tokens', 'b.tokens')}, 9) as overlap from members a join members b on a.brand = b.brand and a.niche_key = b.niche_key and a.pk_id < b.pk_id"))
def token_overlap_pairs(spark, sf_dir):
    return pairs.pairs_within(tables.products(spark, sf_dir), ["brand", "niche_key"], "pk_id", text.tokenize("name"), pairs.token_overlaps, "overlap")


@query(f"with b as (select distinct p_brand as brand, p_type from part) select distinct x.brand as a, y.brand as b, {brand_match('x.brand', 'y.brand')} as m from b x join b y on x.p_type = y.p_type and x.brand < y.brand")
def brand_match_pairs(spark, sf_dir):
    b = tables.read(spark, sf_dir, "part").select("p_type", F.col("p_brand").alias("a")).distinct()
    pairs = b.join(b.select("p_type", F.col("a").alias("b")), "p_type").where("a < b").select("a", "b").distinct()
    return pairs.select("a", "b", text.brand_match("a", "b").alias("m"))


@query(sql("select a.pk_id as a, b.pk_id as b, round(case when a.price > 0 and b.price > 0 then greatest(a.price / b.price, b.price / a.price) else 1.0 end, 9) as ratio from members a join members b on a.cluster_gid = b.cluster_gid and a.pk_id < b.pk_id"))
def price_ratio_pairs(spark, sf_dir):
    m = tables.products(spark, sf_dir).join(tables.assignments(spark, sf_dir), "pk_id")
    return pairs.pairs_within(m, ["cluster_gid"], "pk_id", F.col("price"), pairs.price_ratios, "ratio")


@query(sql("select a.pk_id as a, b.pk_id as b, round(list_cosine_similarity(a.e, b.e), 6) as sim from vecs a join vecs b on a.niche_key = b.niche_key and a.pk_id < b.pk_id"))
def cosine_pairs(spark, sf_dir):
    v = tables.read(spark, sf_dir, "embeddings").withColumn("k", F.col("vec_id") % 7)
    return pairs.pairs_within(v, ["k"], "vec_id", F.col("embedding"), pairs.cosines, "sim")


@query(sql("select pk_id, round(list_sum(list_transform(e, lambda x: x * x / (list_sum(list_transform(e, lambda y: y * y))))), 6) as length, round(e[1] / sqrt(list_sum(list_transform(e, lambda y: y * y))), 6) as first from vecs"))
def vector_normalise(spark, sf_dir):
    v = tables.read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("pk_id"), vector.unit("embedding").alias("u"))
    return v.select("pk_id", F.round(vector.dot("u", "u"), 6).alias("length"), F.round(F.get("u", F.lit(0)), 6).alias("first"))


@query("select event_id, round(1 / (1 + exp(-value / 100)), 9) as s from events")
def sigmoid(spark, sf_dir):
    return tables.read(spark, sf_dir, "events").select("event_id", F.round(vector.sigmoid(F.col("value") / 100), 9).alias("s"))


#: Each document with one of the pages, by the remainder of its id: all documents, and all pages if there are enough documents.
_READ = """n as (select doc_id, list_distinct(regexp_extract_all(coalesce(text, ''), '[0-9]+')) as a, doc_id % (select max(page_id) + 1 from pages) as page_id from documents),
p as (select page_id, coalesce(html, '') as html, url, list_distinct(regexp_extract_all(coalesce(html, ''), '[0-9]+')) as h, list_distinct(regexp_extract_all(url, '[0-9]+')) as u from pages),
r as (select doc_id, a, list_filter(a, lambda x: len(x) between 2 and 4 and x not in ('2024', '2025', '2026')) as own, coalesce(html, '') as html, coalesce(url, '') as url, coalesce(h, []) as h, coalesce(u, []) as u
  from n left join p using (page_id))"""


def _read(spark, sf_dir):
    pages = tables.read(spark, sf_dir, "pages").select("page_id", "html", "url")
    count = (pages.agg(F.max("page_id")).first()[0] or 0) + 1
    d = tables.read(spark, sf_dir, "documents").select("doc_id", "text", (F.col("doc_id") % count).alias("page_id"))
    return d.join(pages, "page_id", "left")


@query(f"with {_READ} select doc_id, len(own) = 0 or list_has_any(own, h) as matches, len(list_intersect(a, h))::bigint as common from r")
def ocr_number_match(spark, sf_dir):
    return _read(spark, sf_dir).select("doc_id", text.numbers_match("text", "html").alias("matches"), text.number_matches("text", "html").cast("long").alias("common"))


@query(f"with {_READ} select doc_id, list_has_any(a, h) as overlap from r")
def number_overlap(spark, sf_dir):
    numbers = lambda c: F.array_distinct(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit("([0-9]+)"), 1))
    return _read(spark, sf_dir).select("doc_id", F.arrays_overlap(numbers("text"), numbers("html")).alias("overlap"))


@query(f"""with {_READ} select doc_id, md5(case when html = '' or len(own) = 0 or list_has_any(own, h) or url = '' then html
when list_has_any(own, u) or len(list_intersect(a, u)) > len(list_intersect(a, h)) then url else html end) as chosen from r""")
def ocr_choice(spark, sf_dir):
    return _read(spark, sf_dir).select("doc_id", F.md5(text.better_reading("text", "html", "url")).alias("chosen"))


@query("select p_partkey as pk_id, case p_partkey % 2 when 0 then (p_size * 0.001)::double::varchar else lower(p_type) end as k, case p_partkey % 3 when 0 then 'length' else 'width' end as attr from part".replace("(p_size * 0.001)::double::varchar", "round(p_size * 0.001, 6)::double::varchar"))
def compare_key(spark, sf_dir):
    synonyms = spark.createDataFrame([("len", "length")], "variant string, canonical string")
    from quillmesh.operators.attributes import canonical_keys

    p = tables.read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("pk_id"), F.when(F.col("p_partkey") % 3 == 0, "len").otherwise("width").alias("attr"),
        F.when(F.col("p_partkey") % 2 == 0, F.concat(F.col("p_size").cast("string"), F.lit(" mm"))).otherwise(F.col("p_type")).alias("v"),
    )
    return canonical_keys(p, synonyms).select("pk_id", value.compare_key("v").alias("k"), "attr")


@query("select event_id, try_cast(replace(case event_id % 3 when 0 then ' 1 234.5 ' when 1 then 'n/a' else value::decimal(18,2)::varchar end, ' ', '') as double) as v from events")
def safe_float(spark, sf_dir):
    raw = F.when(F.col("event_id") % 3 == 0, " 1 234.5 ").when(F.col("event_id") % 3 == 1, "n/a").otherwise(F.col("value").cast("decimal(18,2)").cast("string"))
    return tables.read(spark, sf_dir, "events").select("event_id", text.safe_float(raw).alias("v"))


_REASONS = ["Одинаковый товар", "Не совпадает длина", "похож, но не спиральный", "Другой размер сопла", "не является насосом", "same item"]


@query("select event_id, event_id % 6 in (1, 2, 3, 4) as flag from events")
def contradiction_flag(spark, sf_dir):
    reason = F.element_at(F.array(*map(F.lit, _REASONS)), (F.col("event_id") % 6 + 1).cast("int"))
    return tables.read(spark, sf_dir, "events").select("event_id", text.contradicts(reason).alias("flag"))


@query("select event_id, ['m', '', 'kg'][event_id % 3 + 1] as hint from events")
def key_hint(spark, sf_dir):
    key = F.element_at(F.array(F.lit("length_m"), F.lit("color"), F.lit("weight_KG")), (F.col("event_id") % 3 + 1).cast("int"))
    return tables.read(spark, sf_dir, "events").select("event_id", text.key_hint(key).alias("hint"))


@query("select event_id, case when event_id % 2 = 0 then props end as j from events")
def json_salvage(spark, sf_dir):
    answer = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("Sure: "), F.col("props"), F.lit(" done"))).otherwise("no json")
    return tables.read(spark, sf_dir, "events").select("event_id", text.json_inside(answer).alias("j"))


@query("""with u as (select page_id, case page_id % 3 when 0 then url when 1 then regexp_replace(url, '^https?:', '') else regexp_replace(url, '^https?://', '') end as raw from pages)
select page_id, case when starts_with(raw, '//') then 'https:' || raw when starts_with(raw, 'http') then raw else 'https://' || raw end as url from u""")
def url_normalise(spark, sf_dir):
    raw = F.when(F.col("page_id") % 3 == 0, F.col("url")).when(F.col("page_id") % 3 == 1, F.regexp_replace("url", "^https?:", "")).otherwise(F.regexp_replace("url", "^https?://", ""))
    return tables.read(spark, sf_dir, "pages").select("page_id", text.full_url(raw).alias("url"))


@query("select page_id, 'https://img.example/' || page_id || '/c516x688/1.jpg' as image from pages")
def image_urls(spark, sf_dir):
    thumb = F.concat(F.lit("//img.example/"), F.col("page_id").cast("string"), F.lit("/c246x328/1.jpg"))
    return tables.read(spark, sf_dir, "pages").select("page_id", text.image_url(thumb).alias("image"))


@query("select p_partkey as pk_id, round_even(case when p_partkey % 3 = 2 then p_size / 7 else round_even(p_size / case when p_partkey % 3 = 0 then 2.0 else greatest(1.0, p_size * 0.05) end, 0) * case when p_partkey % 3 = 0 then 2.0 else greatest(1.0, p_size * 0.05) end end, 2)::double as b from part")
def tolerance_bucket(spark, sf_dir):
    t = F.when(F.col("p_partkey") % 3 == 0, 2.0).when(F.col("p_partkey") % 3 == 1, 0.05)
    v = F.when(F.col("p_partkey") % 3 == 2, F.col("p_size") / 7).otherwise(F.col("p_size").cast("double"))
    return tables.read(spark, sf_dir, "part").select(F.col("p_partkey").alias("pk_id"), F.bround(value.bucket(v, t), 2).alias("b"))


@query()
def offline_embedding(spark, sf_dir):
    d = providers.embed(tables.read(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    return d.select("doc_id", F.size("embedding").alias("dim"), F.round(vector.norm("embedding"), 6).alias("length"))


@query(sql(f"select a.pk_id, round(1 / (1 + exp(-({jaccard('a.tokens', 'b.tokens')} * 8 - 4))), 9) as score from members a join members b on b.pk_id = a.pk_id + 1"))
def offline_rerank(spark, sf_dir):
    p = tables.products(spark, sf_dir).select("pk_id", "name")
    other = p.select((F.col("pk_id") - 1).alias("pk_id"), F.col("name").alias("other"))
    return p.join(other, "pk_id").select("pk_id", F.round(providers.rerank("name", "other"), 9).alias("score"))


HEAD = f"list_filter(string_split({norm('name')}, ' '), lambda w: len(w) >= 3 and not regexp_matches(w, '[0-9]'))[1]"


@query(sql(f"select pk_id, {HEAD} as head from products"))
def head_nouns(spark, sf_dir):
    return tables.products(spark, sf_dir).select("pk_id", text.head_noun("name").alias("head"))
