"""A training-data pipeline over documents: toxicity, near duplicates, benchmark leaks, personal data, packing.

Each stage takes what the one before it kept, written as Parquet and read again; all but the last return the columns
of documents. Documents that a filter doesn't speak against pass unchanged."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillmesh.llm import queries as q
from quillmesh.llm.common import stored
from quillmesh.llm.decontamination import without_copies
from quillmesh.llm.packing import pack
from quillmesh.llm.pii import redacted
from quillmesh.llm.shingle_join import one_of_each
from quillmesh.llm.toxicity import without_toxic

#: The stages learn, search and align, which SQL can't express; tests hold them against brute force.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is 0.7 or more go."""
    return without_toxic(docs, q.read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a copy of a benchmark item go."""
    return without_copies(docs, q.read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind, and n_chars follows."""
    return redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return pack(docs, q._path("byte_bpe_50k.tiktoken"), q._pattern(), {"<|endoftext|>": 50256})


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = q.read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
