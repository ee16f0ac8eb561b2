"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes that separate words: blank and \t \n \v \f \r. bytes.split() and bytes.lower() follow the same ASCII rules.
ASCII_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below spark.checkpoint.dir, which every executor of a cluster can reach. The session's setting
    is used as it is; only a local session without one (tests) gets a folder of its own below /tmp."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "/tmp/checkpoints/quillmesh"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """df, written as Parquet to the shared folder and read back: cuts the lineage, and lost executors lose nothing."""
    spark = df.sparkSession
    path, schema = shared_dir(spark, name), df.schema
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(schema).parquet(path)


def texts_of(column: pa.Array) -> list[str]:
    """The strings of a column; null is the empty text."""
    return [x if x is not None else "" for x in column.to_pylist()]


def trim() -> None:
    """Gives memory that is free in this process back to the system (Arrow's pool, and the C library's where it can)."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str) -> DataFrame:
    """mapInArrow for a function that yields dicts of columns; the Arrow schema comes from the Spark one. Worker
    processes are used again by later stages, so each task ends with trim()."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        for columns in fn(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], type=f.type, from_pandas=False) for f in arrow], schema=arrow
            )
        trim()

    return df.mapInArrow(run, schema)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def normal_word(token: str) -> str:
    """Lower case, without the punctuation around it."""
    word = token.lower()
    return word if word.isalnum() else word.strip("".join(c for c in set(word) if not c.isalnum()))


def numbered_columns(df: DataFrame) -> DataFrame:
    """df with its columns called c0, c1 and so on: operators that carry a caller's columns along work on these, so no
    name of theirs can clash with one of the caller's, whatever their case."""
    return df.toDF(*(f"c{k}" for k in range(len(df.columns))))
