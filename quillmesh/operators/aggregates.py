"""Aggregates with the engine's own rules: bands, modes, medians and quartiles by index."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.config import DEFAULT
from quillmesh.sources.tables import saved

LOW, HIGH = DEFAULT.band


def counted_values(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, v, n): each distinct value of a group and its count."""
    return rows.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("v")).agg(F.count("*").alias("n"))


def running(rows: DataFrame, keys: list[str], order: list[str], n: str = "n") -> DataFrame:
    """rows with `before`, the sum of n over the rows of the same keys that come earlier, and `total`, that over all of
    them. Rows are dealt by ranges of keys and order, so a group that holds most of the rows is many tasks' work: each
    adds up its own part, and the sums of the parts (one row a part and group) give the parts' offsets."""
    dealt = rows.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id())
    earlier = Window.partitionBy("_part", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inner = saved(dealt.withColumn("_inner", F.coalesce(F.sum(n).over(earlier), F.lit(0))))
    group = Window.partitionBy(*keys)
    sums = inner.groupBy("_part", *keys).agg(F.sum(n).alias("_sum")).withColumns({
        "_offset": F.coalesce(F.sum("_sum").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "total": F.sum("_sum").over(group),
    })
    sums = sums.select("_offset", "total", *[F.col(c).alias(f"_of_{c}") for c in ("_part", *keys)])
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in ("_part", *keys)])
    return inner.join(sums, same).select(*rows.columns, (F.col("_inner") + F.col("_offset")).alias("before"), "total")


def at_place(k: Column) -> Column:
    """Aggregate of running(): the value at place k (from 0) of the row in which each value stands as often as it counts."""
    return F.max(F.when((F.col("before") <= k) & (k < F.col("before") + F.col("n")), F.col("v")))


def dominant_groups(rows: DataFrame, keys: list[str], value: str, share: float = DEFAULT.dominance_numeric) -> DataFrame:
    """(keys, n, group_size, dominant, kernel, n_distinct): the band is the largest group of values within 15 % of one
    of them, of equal ones the smallest anchor's; dominant is its upper median if it has that share of the values, else
    null; kernel is it regardless. Each value asks for the counts below both ends of its band, so one running sum over
    values and ends answers all of them: no pair of values is made and no group is one row."""
    v = counted_values(rows, keys, value)
    ask = lambda kind, x, n: F.struct(F.lit(kind).alias("kind"), x.alias("x"), n.cast("long").alias("n"))
    own = F.col("v")
    rows3 = v.select(*keys, "v", F.explode(F.array(ask(0, own * LOW, F.lit(0)), ask(1, own, F.col("n")), ask(2, own * HIGH, F.lit(0)))).alias("e")).select(*keys, "v", "e.*")
    summed = running(rows3, keys, ["x", "kind", "v"])
    below = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("before")))
    anchors = summed.where("kind <> 1").groupBy(*keys, "v").agg(below(0).alias("low"), F.greatest(below(2) - below(0), F.lit(0)).alias("size"), F.max("total").alias("n"))
    best = anchors.groupBy(*keys).agg(F.max(F.struct("size", (-F.col("v")).alias("first"), "low")).alias("b"), F.max("n").alias("n"), F.count("*").alias("n_distinct"))
    best = best.select(*keys, "n", "n_distinct", F.col("b.size").alias("group_size"), (F.col("b.low") + F.floor(F.col("b.size") / 2)).alias("place"))
    values = summed.where("kind = 1").select(*[F.col(k).alias(f"_of_{k}") for k in keys], "v", "before", F.col("n").alias("_n"))
    there = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    there = there & (F.col("before") <= F.col("place")) & (F.col("place") < F.col("before") + F.col("_n")) & (F.col("group_size") > 0)
    sized = best.join(values, there, "left").select(*keys, "n", "group_size", F.col("v").alias("kernel"), "n_distinct")
    return sized.withColumn("dominant", F.when(F.col("group_size") / F.col("n") >= share, F.col("kernel")))


def modal_values(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, modal, modal_count, n): the most frequent value, the smallest of equals, and how many values there are."""
    counted = rows.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    best = F.max(F.struct(F.col("_n").alias("k"))).alias("_best")
    top = counted.groupBy(*keys).agg(F.sum("_n").alias("n"), best)
    return counted.join(top, keys).where("_n = _best.k").groupBy(*keys).agg(F.min("_v").alias("modal"), F.first("_n").alias("modal_count"), F.first("n").alias("n"))


def without_outliers(rows: DataFrame, cluster: str, attr: str, value: str, sizes: DataFrame, least: int = DEFAULT.outlier_cluster) -> DataFrame:
    """rows without values that occur once in their cluster and attribute, for clusters of least members or more.
    sizes: (cluster, size)."""
    n = F.count("*").over(Window.partitionBy(cluster, attr, value))
    return rows.join(sizes, cluster).withColumn("_n", n).where((F.col("size") < least) | (F.col("_n") >= 2)).drop("_n", "size")


def index_quartiles(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, n, q1, median, q3) by index n/4, n/2, 3n/4 of the ascending values."""
    found = running(counted_values(rows, keys, value), keys, ["v"])
    at = lambda f: at_place(F.floor(F.col("total") * f / 4))
    return found.groupBy(*keys).agg(F.max("total").alias("n"), at(1).alias("q1"), at(2).alias("median"), at(3).alias("q3"))


def leave_one_out_medians(rows: DataFrame, cluster: str, attr: str, value: str, member: str = "pk_id") -> DataFrame:
    """(cluster, attr, member, value, others): the upper median of the other members' values, null for fewer than two
    others. With one value a member, it is the next value to the middle, so two window reads replace a self-join."""
    w = Window.partitionBy(cluster, attr)
    ranked = rows.where(F.col(value).isNotNull()).withColumns({"_i": F.row_number().over(w.orderBy(value, member)) - 1, "_m": F.count("*").over(w) - 1})
    j = F.floor(F.col("_m") / 2)
    middle = ranked.where((F.col("_i") == j) | (F.col("_i") == j + 1)).groupBy(cluster, attr).agg(
        F.max(F.when(F.col("_i") == j, F.col(value))).alias("_at"), F.max(F.when(F.col("_i") == j + 1, F.col(value))).alias("_next")
    )
    others = F.when(F.col("_m") >= 2, F.when(j < F.col("_i"), F.col("_at")).otherwise(F.col("_next")))
    return ranked.join(middle, [cluster, attr]).select(cluster, attr, member, F.col(value).alias("value"), others.alias("others"))


def capped_members(rows: DataFrame, cluster: str, most: int, member: str = "pk_id") -> DataFrame:
    """The rows of the first members of each cluster, in the order of their ids."""
    rank = F.dense_rank().over(Window.partitionBy(cluster).orderBy(member))
    return rows.withColumn("_rank", rank).where(F.col("_rank") <= most).drop("_rank")


def capped_medians(rows: DataFrame, cluster: str, attr: str, value: str, most: int = 20) -> DataFrame:
    """(cluster, attr, median) of the first members, where two or more have a value."""
    first = capped_members(rows, cluster, most).where(F.col(value).isNotNull())
    w = Window.partitionBy(cluster, attr)
    placed = first.withColumns({"_i": F.row_number().over(w.orderBy(value)) - 1, "_n": F.count("*").over(w)})
    return placed.where((F.col("_n") >= 2) & (F.col("_i") == F.floor(F.col("_n") / 2))).select(cluster, attr, F.col(value).cast("double").alias("median"))


def value_shares(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, value, n, share) of each value within its group."""
    counted = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))
    return counted.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*keys)))


def coherence(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, n, coherence): the mean cosine of all pairs, from the length of the sum of unit vectors: no pair is
    made. 0 for fewer than two vectors."""
    from quillmesh.functions.vector import unit

    parts = vectors.select(key, F.posexplode(unit(vector)).alias("pos", "x"))
    sums = parts.groupBy(key, "pos").agg(F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"), F.count("*").alias("n"))
    total = sums.groupBy(key).agg(F.sum(F.col("s") * F.col("s")).alias("whole"), F.sum("q").alias("own"), F.max("n").alias("n"))
    n = F.col("n")
    return total.select(key, n, F.when(n > 1, (F.col("whole") - F.col("own")) / (n * (n - 1))).otherwise(0.0).alias("coherence"))


def centroids(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, pos, x): mean vectors at length one, in long form, so that no task holds a group's vectors."""
    means = vectors.select(key, F.posexplode(vector).alias("pos", "v")).groupBy(key, "pos").agg(F.avg(F.col("v").cast("double")).alias("x"))
    length = means.groupBy(key).agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("length"))
    return means.join(length, key).select(key, "pos", F.when(F.col("length") > 0, F.col("x") / F.col("length")).otherwise(F.col("x")).alias("x"))


def centroid_vectors(long: DataFrame, key: str) -> DataFrame:
    """(key, centroid) arrays from long form."""
    return long.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "x"))), lambda p: p["x"]).alias("centroid"))
