"""Spark sessions for scripts and tests."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def session(name: str = "quillmesh", cores: int | str | None = None, **conf: str) -> SparkSession:
    """A local session; on a cluster the session is the caller's, and nothing here is needed."""
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    settings = {
        "spark.sql.shuffle.partitions": str(cores) if str(cores).isdigit() else "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "6g",
        "spark.driver.host": "127.0.0.1",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
