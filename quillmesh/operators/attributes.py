"""Attributes from texts by schema, their merging, and filling from the cluster."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.config import DEFAULT, Config
from quillmesh.functions.value import bucket

EXTRACTED = "attr string, value_num double, value_str string, unit string, is_numeric boolean, priority int, label string, raw_match string, tolerance double"


def extract(texts: DataFrame, schemas: DataFrame, key: str = "niche_key", id_col: str = "pk_id", text: str = "text") -> DataFrame:
    """(id, EXTRACTED) of texts (id, key, text) under schemas (key, separators). A separator is a struct (attr, regex,
    unit, unit_factor, numeric, priority, label, tolerance). Per attribute the first separator by priority that
    matches wins; patterns are Python ones, so they run in Arrow batches, compiled once a worker; broken ones are
    passed over."""
    kind = texts.schema[id_col].dataType.simpleString()

    def run(batches):
        compiled: dict[str, re.Pattern | None] = {}

        def pattern(source):
            if source not in compiled:
                try:
                    compiled[source] = re.compile(source, re.I)
                except re.error:
                    compiled[source] = None
            return compiled[source]

        for frame in batches:
            rows = []
            for pk, body, separators in zip(frame[id_col], frame[text], frame["separators"]):
                seen = set()
                if not body or separators is None:
                    continue
                for s in sorted(separators, key=lambda s: 99 if s["priority"] is None else s["priority"]):
                    if not s["regex"] or s["attr"] in seen or (p := pattern(s["regex"])) is None or not (m := p.search(body)):
                        continue
                    value, number = next((g for g in m.groups() if g is not None), m[0]), None
                    if s["numeric"]:
                        try:
                            number, value = float(value.replace(",", ".")), None
                        except ValueError:
                            continue
                        factors = dict(s["unit_factor"] or {})
                        if factors and m.lastindex and m.lastindex >= 2:
                            number *= factors.get((m[2] or "").strip().lower(), 1.0)
                    seen.add(s["attr"])
                    priority = 99 if s["priority"] is None else s["priority"]
                    rows.append((pk, s["attr"], number, value, s["unit"], bool(s["numeric"]), priority, s["label"] or s["attr"][:6], m[0], s["tolerance"]))
            yield pd.DataFrame(rows, columns=[id_col, *(c.split()[0] for c in EXTRACTED.split(", "))])

    joined = texts.join(schemas.select(key, "separators"), key)  # broadcast by Spark if it is small
    return joined.select(id_col, text, "separators").mapInPandas(run, f"{id_col} {kind}, {EXTRACTED}")


def schema_of(niches: DataFrame, niche_schemas: DataFrame, category_schemas: DataFrame) -> DataFrame:
    """(niche_key, separators): the niche's schema, else its category's."""
    own = niche_schemas.select("niche_key", F.col("separators").alias("own"))
    wide = category_schemas.select("category_id", F.col("separators").alias("wide"))
    return niches.join(own, "niche_key", "left").join(wide, "category_id", "left").select("niche_key", F.coalesce("own", "wide").alias("separators")).where("separators is not null")


def merge(*sources: DataFrame, id_col: str = "pk_id") -> DataFrame:
    """One value for each product and attribute: of several sources the first one's."""
    out = None
    for rank, s in enumerate(sources):
        s = s.withColumn("_source", F.lit(rank))
        out = s if out is None else out.unionByName(s, allowMissingColumns=True)
    first = F.row_number().over(Window.partitionBy(id_col, "attr").orderBy("_source"))
    return out.withColumn("_r", first).where("_r = 1").drop("_r", "_source")


def without_repeats(found: DataFrame, cached: DataFrame, conf: Config = DEFAULT, id_col: str = "pk_id") -> DataFrame:
    """found (id, attr, value, dimension) without values that a cached attribute of the product repeats under another
    name: equal dimensions, values within the tolerance."""
    c = cached.where("dimension <> ''").select(F.col(id_col).alias("_id"), F.col("attr").alias("_attr"), F.col("value").alias("_value"), F.col("dimension").alias("_dimension"))
    size = F.greatest(F.abs("value"), F.abs("_value"), F.lit(1e-9))
    same = (F.col(id_col) == F.col("_id")) & (F.col("dimension") == F.col("_dimension")) & (F.col("attr") != F.col("_attr")) & (F.abs(F.col("value") - F.col("_value")) / size < conf.attr_dedup)
    return found.join(c, same, "left_anti")


def extract_all(products: DataFrame, known: DataFrame, schemas: DataFrame | None = None, readings: DataFrame | None = None, conf: Config = DEFAULT) -> DataFrame:
    """(pk_id, attr, value_num, value_str, unit, is_numeric, priority, label) of products (pk_id, niche_key, name): the
    known attributes, then what a schema (niche_key, separators) finds in the name and the reading (pk_id, ocr_text) of
    the image, without numbers that repeat a known one under another name."""
    names = ["pk_id", "attr", "value_num", "value_str", "unit", "is_numeric", "priority", "label"]
    own = known.join(products.select("pk_id"), "pk_id", "left_semi").select(*names)
    if schemas is None:
        return own
    texts = products.select("pk_id", "niche_key", "name")
    text = F.col("name")
    if readings is not None:
        texts, text = texts.join(readings.select("pk_id", "ocr_text"), "pk_id", "left"), F.concat_ws(" ", "name", "ocr_text")
    found = extract(texts.select("pk_id", "niche_key", text.alias("text")), schemas).select(*names)
    sized = lambda d: d.withColumns({"value": F.col("value_num"), "dimension": F.coalesce("unit", F.lit(""))})
    numeric = without_repeats(sized(found.where("is_numeric")), sized(own.where("is_numeric")).select("pk_id", "attr", "value", "dimension"), conf)
    return merge(own, numeric.select(*names).unionByName(found.where("not is_numeric"))).select(*names)


def normal_value() -> Column:
    """A first-priority value as text: on its tolerance's grid, or in lower case."""
    return F.coalesce(bucket("value_num", "tolerance").cast("string"), F.lower(F.trim("value_str")))


def signatures(attrs: DataFrame) -> DataFrame:
    """(pk_id, signature): label=value of the first-priority attributes, sorted."""
    first = attrs.where("priority <= 1").withColumn("v", normal_value()).where("v is not null")
    return first.groupBy("pk_id").agg(F.array_join(F.sort_array(F.collect_list(F.concat_ws("=", "label", "v"))), "|").alias("signature"))


def infer_fill(attrs: DataFrame, members: DataFrame, conf: Config = DEFAULT) -> DataFrame:
    """(pk_id, cluster_gid, attr, value_num, value_str) to add: a first-priority attribute that enough members have,
    all with the same value, goes to the members (cluster_gid, pk_id) without it. All clusters are filled from one
    snapshot; the template is the smallest id's."""
    have = attrs.where("priority <= 1").withColumn("v", normal_value()).where("v is not null")
    agreed = have.groupBy("cluster_gid", "attr").agg(
        F.count("*").alias("sources"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.min_by(F.struct("value_num", "value_str"), "pk_id").alias("t")
    ).where((F.col("sources") >= conf.infer_sources) & (F.col("lo") == F.col("hi")))
    wanted = members.join(agreed, "cluster_gid").join(have.select("pk_id", "attr"), ["pk_id", "attr"], "left_anti")
    return wanted.select("pk_id", "cluster_gid", "attr", "t.value_num", "t.value_str")


def reverse_synonyms(groups: DataFrame) -> DataFrame:
    """(variant, canonical) of (canonical, variants); a canonical name stands for itself; of two the smaller wins."""
    own = groups.select(F.col("canonical").alias("variant"), "canonical")
    return groups.select(F.explode("variants").alias("variant"), "canonical").unionByName(own).groupBy("variant").agg(F.min("canonical").alias("canonical"))


def merge_synonyms(groups: DataFrame) -> DataFrame:
    """One row a canonical name, with all its variants."""
    return groups.select("canonical", F.explode("variants").alias("v")).groupBy("canonical").agg(F.sort_array(F.collect_set("v")).alias("variants"))


def canonical_keys(attrs: DataFrame, synonyms: DataFrame) -> DataFrame:
    """attrs with canonical attribute names."""
    s = synonyms.select(F.col("variant").alias("attr"), "canonical")
    return attrs.join(s, "attr", "left").withColumn("attr", F.coalesce("canonical", "attr")).drop("canonical").select(*attrs.columns)
