"""The SQL side of the catalogue: views over the driver's tables that every oracle query may use, and expressions."""

from quillmesh.functions.text import STOP_WORDS

STOP = "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"


def norm(c: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(lower({c}), '[^a-zа-яё0-9\s/-]', ' ', 'g'), '\s+', ' ', 'g'))"


def tokens(c: str) -> str:
    return f"list_filter(string_split({norm(c)}, ' '), lambda w: len(w) >= 2 and (regexp_matches(w, '[0-9]') and not regexp_matches(w, '^[/-]*[0-9]+[/-]+[0-9/-]*$') or not regexp_matches(w, '[0-9]') and not list_contains({STOP}, w)))"


def brand(c: str) -> str:
    """normalize_brand for brands without legal suffixes."""
    return rf"trim(regexp_replace(lower({c}), '[^a-zа-яё0-9\s/-]', '', 'g'))"


def brand_match(a: str, b: str) -> str:
    x, y = brand(a), brand(b)
    return f"case when {x} = '' or {y} = '' then 0.0 when {x} = {y} then 1.0 when contains({x}, {y}) or contains({y}, {x}) then 0.5 else 0.0 end::double"


def jaccard(a: str, b: str) -> str:
    return f"case when len({a}) = 0 or len({b}) = 0 then 0.0 else len(list_intersect({a}, {b}))::double / len(list_distinct(list_concat({a}, {b}))) end"


VIEWS = f"""
niches as (select p_type, niche_key, (niche_key % 3 + 1)::bigint as category_id from
  (select p_type, row_number() over (order by p_type) as niche_key from (select distinct p_type from part))),
gids as (select p_brand, p_type, 400000 + row_number() over (order by p_brand, p_type) as cluster_gid from (select distinct p_brand, p_type from part)),
sold as (select l_partkey as pk_id, sum(l_quantity::decimal(18,2))::double as sales, sum(l_extendedprice::decimal(18,2))::double as revenue from lineitem group by 1),
products as (select p_partkey as pk_id, p_name || ' ' || p_brand || ' ' || p_size || ' mm' as name, p_brand as brand, niche_key, category_id,
  p_retailprice as price, coalesce(sales, 0) as sales, coalesce(revenue, 0) as revenue from part join niches using (p_type) left join sold on pk_id = p_partkey),
assignments as (select p_partkey as pk_id, cluster_gid from part join gids using (p_brand, p_type)),
members as (select p.*, a.cluster_gid, {tokens("name")} as tokens from products p join assignments a using (pk_id)),
sizes as (select cluster_gid, count(*) as size from assignments group by 1),
attrs as (
  select p_partkey as pk_id, cluster_gid, 'size' as attr, p_size::double as value_num, null::varchar as value_str, true as is_numeric, 1 as priority from part join gids using (p_brand, p_type)
  union all select p_partkey, cluster_gid, 'type', null, p_type, false, 2 from part join gids using (p_brand, p_type)),
nums as (select pk_id, cluster_gid, value_num as v from attrs where attr = 'size'),
kept as (select cluster_gid, v from (select n.*, size, count(*) over (partition by n.cluster_gid, v) as c from nums n join sizes using (cluster_gid)) where size < 5 or c >= 2),
vecs as (select vec_id as pk_id, embedding::double[] as e, label::bigint as cluster_gid, (vec_id % 7)::bigint as niche_key, (vec_id % 3)::bigint as category_id, 'h' || vec_id % 4 as head from embeddings),
knn as (select pk_id, other, sim, place from (select a.pk_id, b.pk_id as other, list_cosine_similarity(a.e, b.e) as sim,
  row_number() over (partition by a.pk_id order by round(list_cosine_similarity(a.e, b.e), 12) desc, b.pk_id) as place
  from vecs a join vecs b on a.pk_id <> b.pk_id where list_cosine_similarity(a.e, b.e) >= 0.3) where place <= 15)
"""


def bands(values: str, keys: str, value: str, name: str) -> str:
    """CTEs that end in `name` (keys, n, group_size, kernel, dominant, n_distinct): the largest 15 % band of `values`."""
    on = " and ".join(f"a.{k.strip()} = b.{k.strip()}" for k in keys.split(","))
    mine = ", ".join(f"a.{k.strip()}" for k in keys.split(","))
    return f"""
{name}_a as (select distinct {keys}, {value} as anchor from {values} where {value} is not null),
{name}_g as (select {mine}, anchor, count(*) as group_size, list_sort(list(b.{value})) as g from {name}_a a join {values} b on {on} and b.{value} >= anchor * 0.85 and b.{value} <= anchor * 1.15 group by {mine}, anchor),
{name}_b as (select * from (select *, row_number() over (partition by {keys} order by group_size desc, anchor) as r from {name}_g) where r = 1),
{name}_n as (select {keys}, count(*) as n, count(distinct {value}) as n_distinct from {values} where {value} is not null group by all),
{name} as (select {", ".join(f"n.{k.strip()}" for k in keys.split(","))}, n.n, n.n_distinct, coalesce(b.group_size, 0) as group_size, b.g[b.group_size // 2 + 1] as kernel,
  case when b.group_size / n.n >= 0.4 then b.g[b.group_size // 2 + 1] end as dominant
  from {name}_n n left join {name}_b b on {" and ".join(f"n.{k.strip()} = b.{k.strip()}" for k in keys.split(","))})"""


def sql(body: str, *more: str) -> str:
    """body after the views and further CTEs."""
    return "with " + ",".join([VIEWS.strip(), *more]) + "\n" + body.strip()
