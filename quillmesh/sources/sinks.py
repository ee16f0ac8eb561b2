"""Writers and key allocation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.config import DEFAULT

#: The columns of the review queue.
MOVES_SCHEMA = (
    "pk_id long, nm_id long, product_name string, old_cluster long, new_cluster long, target_action string, new_cluster_title string, niche_key_int long, "
    "reason string, status string, created_by string, reviewed_by string, confidence_score float, anomaly_flags int, idempotency_key string, "
    "reject_reason string, created_at timestamp, reviewed_at timestamp"
)


def next_run_id(history: DataFrame, start: int = DEFAULT.run_start) -> DataFrame:
    return history.agg(F.greatest(F.coalesce(F.max("run_id"), F.lit(0)) + 1, F.lit(start)).cast("long").alias("next_run_id"))


def next_gid(assignments: DataFrame, floor: int = DEFAULT.gid_floor) -> DataFrame:
    return assignments.agg((F.coalesce(F.max("cluster_gid"), F.lit(floor)) + 1).cast("long").alias("next_gid"))


def write_assignments(rows: DataFrame, path: str, run_id: int) -> None:
    """Appends a run's rows under run_id; a repeated write of the same run replaces it."""
    rows.withColumns({"run_id": F.lit(run_id), "score": F.round("score", 6)}).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)


def review_rows(moves: DataFrame) -> DataFrame:
    """The columns of the review queue, cut to their widths; flags keep eight bits."""
    widths = {"product_name": 200, "target_action": 50, "new_cluster_title": 200, "reason": 500, "status": 20, "created_by": 50, "idempotency_key": 100}
    cut = moves.withColumns({c: F.substring(c, 1, n) for c, n in widths.items() if c in moves.columns})
    return cut.withColumns({"confidence_score": F.round(F.col("confidence_score").cast("double"), 4), "anomaly_flags": F.col("anomaly_flags").cast("int").bitwiseAND(255)})


def queue_rows(moves: DataFrame) -> DataFrame:
    """review_rows() with all columns of the queue in their types: reviewer, reasons of rejection and the time of a
    review are null until there is one."""
    rows = review_rows(moves).withColumn("created_at", F.current_timestamp())
    kinds = [f.split() for f in MOVES_SCHEMA.split(", ")]
    return rows.select(*[(F.col(c) if c in rows.columns else F.lit(None)).cast(k).alias(c) for c, k in kinds])


def write_moves(moves: DataFrame, path: str, replace: bool = False) -> None:
    """Appends to the review queue (or starts it anew), sorted for readers that look up a cluster."""
    queue_rows(moves).sortWithinPartitions("old_cluster", "pk_id").write.mode("overwrite" if replace else "append").parquet(path)


def upsert(old: DataFrame, new: DataFrame, keys: list[str], version: str) -> DataFrame:
    """The newest row of each key of both tables; of equal versions the new table's."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    rest = [c for c in old.columns if c not in keys]
    latest = both.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(version, "_new")).alias("r"))
    return latest.select(*keys, "r.*")


def write_json(df: DataFrame, path: str) -> None:
    """Synonyms, weights and thresholds: small tables for people to read, so one file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_pairs(pairs: DataFrame, path: str) -> None:
    pairs.write.mode("overwrite").option("header", True).csv(path)
