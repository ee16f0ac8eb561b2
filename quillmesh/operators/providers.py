"""Models behind interfaces. Each has a deterministic local form, so that the engine runs without a network; a real
model is another function of the same shape, loaded once a worker."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh.functions.text import token_overlap, tokenize

Embedder = Callable[[list[str]], np.ndarray]


def hashed_trigrams(texts: list[str], size: int = 64) -> np.ndarray:
    """Unit vectors of signed character trigram counts; empty texts are zero vectors."""
    out = np.zeros((len(texts), size))
    for row, text in zip(out, texts):
        padded = f"  {text.lower()} " if text else ""
        for k in range(len(padded) - 2):
            h = zlib.crc32(padded[k : k + 3].encode())
            row[h % size] += 1 - 2 * (h >> 31)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def embed(rows: DataFrame, text: str, out: str = "embedding", load: Callable[[], Embedder] = lambda: hashed_trigrams) -> DataFrame:
    """rows with the vectors of a text column."""

    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for texts in batches:
            yield pd.Series(list(model(texts.fillna("").tolist())))

    return rows.withColumn(out, run(F.col(text)))


def rerank(a: Column | str, b: Column | str) -> Column:
    """The local reranker: a logistic curve over the common tokens of two names."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(token_overlap(tokenize(a), tokenize(b)) * 8 - 4)))


def arbitrate(grey: DataFrame) -> DataFrame:
    """(pk_id, decision, reason, confidence): the local arbiter keeps what a human would have to look at."""
    return grey.select("pk_id", F.lit("ok").alias("decision"), F.lit("").alias("reason"), F.lit(0.5).alias("confidence"))


def replay(grey: DataFrame, recorded: DataFrame) -> DataFrame:
    """Recorded answers (pk_id, decision, reason, confidence); without one the answer is invalid."""
    return grey.select("pk_id").join(recorded, "pk_id", "left")


def read_images(rows: DataFrame, text_of: Callable[[str], str] = lambda url: "") -> DataFrame:
    """(pk_id, ocr_text) of rows (pk_id, url): a provider that fetches and reads; the local one reads nothing."""

    def run(frames):
        for f in frames:
            yield pd.DataFrame({"pk_id": f.pk_id, "ocr_text": [text_of(u or "") for u in f.url]})

    return rows.select("pk_id", "url").mapInPandas(run, "pk_id long, ocr_text string")


def known_function(slug: Column | str, allowed: Column) -> Column:
    """A classifier's answer if it is on the closed list, else unknown."""
    c = F.col(slug) if isinstance(slug, str) else slug
    return F.when(F.array_contains(allowed, c), c).otherwise("unknown")


def prompt(rows: DataFrame) -> DataFrame:
    """(cluster_gid, prompt) of rows (cluster_gid, pk_id, name, attrs_text, verdicts, revenue, peers): the context that
    a language model gets: the best sellers, the clusters nearby, and each product with its attributes."""
    line = F.concat_ws(" ", F.concat(F.lit("#"), F.col("pk_id").cast("string")), "name", "attrs_text", "verdicts")
    sellers = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("revenue")).alias("r"), "pk_id", "name"))), 1, 5)
    return rows.groupBy("cluster_gid").agg(
        F.array_join(F.transform(sellers, lambda x: x["name"]), "\n").alias("best"), F.first("peers").alias("peers"), F.array_join(F.sort_array(F.collect_list(line)), "\n").alias("items")
    ).select("cluster_gid", F.concat_ws("\n\n", "best", "peers", "items").alias("prompt"))
