"""Tables of the catalogue, from Parquet: raw reads, the entities over the star-schema tables, and cached lookups.

Filters and column lists stay declarative, so they reach the scan. Dimension tables (niches, clusters' numbers) are
ranked over their distinct keys, never over the facts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmesh.config import DEFAULT


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def saved(df: DataFrame) -> DataFrame:
    """df through the folder that executors share, which ends its lineage."""
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None) or ("/tmp/checkpoints/quillmesh" if spark.sparkContext.master.startswith("local") else None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = f"{base.rstrip('/')}/quillmesh-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(keys: DataFrame, name: str, base: int = 0) -> DataFrame:
    """Distinct keys with consecutive numbers in their order. The rank within each range partition is added to the
    sizes of the partitions before it, so no task sorts all keys."""
    dealt = keys.distinct().repartitionByRange(*[F.col(c) for c in keys.columns]).withColumn("_part", F.spark_partition_id())
    inner = saved(dealt.withColumn("_rank", F.row_number().over(Window.partitionBy("_part").orderBy(*keys.columns))))
    sizes = inner.groupBy("_part").agg(F.count("*").alias("_n"))  # one row a partition
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return inner.join(F.broadcast(before), "_part").select(*keys.columns, (F.col("_rank") + F.col("_before") + base).cast("long").alias(name))


def small_numbered(keys: DataFrame, name: str, base: int = 0) -> DataFrame:
    """numbered() for a dimension that is small by nature (brands, types): one sort of its distinct keys."""
    return keys.distinct().withColumn(name, (F.row_number().over(Window.orderBy(*keys.columns)) + base).cast("long"))


def niches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p_type, niche_key, category_id): a niche for each type; its category is the first word of the type."""
    out = small_numbered(read(spark, sf_dir, "part").select("p_type"), "niche_key")
    return out.withColumn("category_id", (F.col("niche_key") % 3 + 1).cast("long"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pk_id, name, brand, niche_key, category_id, price, sales, revenue) over part and lineitem."""
    part = read(spark, sf_dir, "part")
    sold = read(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("pk_id")).agg(
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("sales"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("revenue"),
    )
    named = part.join(niches(spark, sf_dir), "p_type").select(
        F.col("p_partkey").alias("pk_id"), F.concat_ws(" ", "p_name", "p_brand", F.concat(F.col("p_size").cast("string"), F.lit(" mm"))).alias("name"),
        F.col("p_brand").alias("brand"), "niche_key", "category_id", F.col("p_retailprice").alias("price"),
    )
    return named.join(sold, "pk_id", "left").withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("sales", "revenue")})


def assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pk_id, cluster_gid): a cluster for each brand and type."""
    part = read(spark, sf_dir, "part")
    gids = small_numbered(part.select("p_brand", "p_type"), "cluster_gid", DEFAULT.gid_floor)
    return part.join(gids, ["p_brand", "p_type"]).select(F.col("p_partkey").alias("pk_id"), "cluster_gid")


def attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pk_id, cluster_gid, attr, value_num, value_str, unit, is_numeric, priority, label): size and type of each part."""
    part = read(spark, sf_dir, "part").join(assignments(spark, sf_dir), F.col("p_partkey") == F.col("pk_id"))
    row = lambda attr, num, text, unit, numeric, priority, label: F.struct(
        F.lit(attr).alias("attr"), num.cast("double").alias("value_num"), text.cast("string").alias("value_str"), F.lit(unit).alias("unit"),
        F.lit(numeric).alias("is_numeric"), F.lit(priority).alias("priority"), F.lit(label).alias("label"),
    )
    none = F.lit(None)
    both = F.array(row("size", F.col("p_size"), none, "mm", True, 1, "Size"), row("type", none, F.col("p_type"), "", False, 2, "Type"))
    return part.select("pk_id", "cluster_gid", F.explode(both).alias("a")).select("pk_id", "cluster_gid", "a.*")


def by_niche(products: DataFrame, niche_key: int) -> DataFrame:
    return products.where(F.col("niche_key") == niche_key)


def by_category(products: DataFrame, category_id: int) -> DataFrame:
    return products.where((F.col("category_id") == category_id) & F.col("name").isNotNull() & (F.col("name") != ""))


def coalesced(df: DataFrame) -> DataFrame:
    """Null texts become empty and null numbers zero, but for cluster numbers, which stay null."""
    kinds = {"string": F.lit(""), "double": F.lit(0.0), "float": F.lit(0.0), "int": F.lit(0), "bigint": F.lit(0)}
    return df.select(*[F.coalesce(F.col(c), kinds[k].cast(k)).alias(c) if k in kinds and not c.endswith("gid") else F.col(c) for c, k in df.dtypes])


def first_by(df: DataFrame, keys: list[str], order: list[Column], most: int = 1) -> DataFrame:
    """The first rows of each key in an order; the limit is applied before the shuffle too (window group limit)."""
    rank = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(rank)).where(F.col("_rank") <= most).drop("_rank")


def latest_assignments(history: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """(pk_id, cluster_gid, score): the newest run of each product that has a cluster; ties in a run go to the
    smallest cluster. keys: only these products (a semi-join, never a list of literals)."""
    rows = history.where(F.col("cluster_gid").isNotNull())
    rows = rows if keys is None else rows.join(keys, "pk_id", "left_semi")
    newest = F.max_by(F.struct("cluster_gid", "score"), F.struct(F.col("run_id"), -F.col("cluster_gid")))
    return rows.groupBy("pk_id").agg(newest.alias("n")).select("pk_id", "n.*")


def with_cache(rows: DataFrame, cache: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows with their cached values, rows for which a provider must be asked)."""
    return rows.join(cache, key, "left"), rows.join(cache, key, "left_anti")


def json_attrs(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, attr, value, is_numeric, priority) of a JSON object per row: numbers get the first priority, texts the second."""
    entries = F.explode(F.from_json(column, "map<string,string>")).alias("attr", "value")
    out = df.select(key, entries).where("value is not null")
    numeric = F.col("value").try_cast("double").isNotNull()
    return out.select(key, "attr", "value", numeric.alias("is_numeric"), F.when(numeric, 1).otherwise(2).alias("priority"))


def attr_keys(attrs: DataFrame, trivial: tuple[str, ...] = ()) -> DataFrame:
    return attrs.select("attr").where(~F.col("attr").isin(*trivial) if trivial else F.lit(True)).distinct()


def schema_file(spark: SparkSession, path: str) -> DataFrame:
    """Niche or category schemas (key_separators), weights, thresholds, synonyms: JSON files, one object each."""
    return spark.read.option("multiLine", True).json(path)


def first_that_exists(spark: SparkSession, *paths: str) -> DataFrame | None:
    """The first readable file of several versions; None if there is none."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
            return schema_file(spark, path)
    return None


SEPARATORS = "array<struct<attr:string,regex:string,unit:string,unit_factor:map<string,double>,numeric:boolean,priority:int,label:string,tolerance:double>>"
#: The files that a job may find beside its tables, and their columns.
FILES = {
    "schemas": f"niche_key long, category_id long, separators {SEPARATORS}",
    "weights": "category_id long, attr string, block boolean, type string, uniformity double, n_clusters long",
    "thresholds": "category_id long, niche_key long, score_ok double",
    "synonyms": "canonical string, variants array<string>",
    "functions": "category_id long, slug string",
}


def file_or_empty(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A JSON file of FILES below path, with its columns (a line each row); an empty table if there is none, and rows
    that can't be read are left out."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], FILES[name])
    return spark.read.schema(FILES[name]).option("mode", "DROPMALFORMED").json(f"{path}/{name}")


def table_or_none(spark: SparkSession, path: str, name: str) -> DataFrame | None:
    """An optional Parquet table of a folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}.parquet")
    return read(spark, path, name) if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where) else None


def training_pairs(spark: SparkSession, path: str, products: DataFrame) -> DataFrame:
    """Labelled text pairs of a pair file; pairs with a product that has no name are dropped."""
    pairs = spark.read.option("header", True).schema("pk_left long, pk_right long, label int, type string, cosine double").csv(path)
    return name_pairs(pairs, products)


def name_pairs(pairs: DataFrame, products: DataFrame) -> DataFrame:
    names = products.where("name is not null and name <> ''")
    left, right = (names.select(F.col("pk_id").alias(f"pk_{s}"), F.col("name").alias(f"name_{s}")) for s in ("left", "right"))
    return pairs.join(left, "pk_left").join(right, "pk_right").select("pk_left", "pk_right", "name_left", "name_right", "label")
