"""The driver's queries of the operators of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillmesh.llm.fertility import quality

    return quality(read(spark, sf_dir, "documents"), _path("byte_bpe_multi_50k.tiktoken"), _pattern())


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillmesh.llm.html_text import extract_pages

    return extract_pages(read(spark, sf_dir, "pages"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from quillmesh.llm.pii import BASE, digest, find_personal_data

    found = find_personal_data(read(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, BASE), F.sha2(digest("base"), 256).alias("base_sha256"), digest("found").alias("spans"))


def op4_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillmesh.llm.warc import archive_round_trip

    back = archive_round_trip(read(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP4_SQL = """
with p as (select page_id, coalesce(html, '') as payload from pages),
f as (select payload, min(page_id) as first from p group by payload),
d as (
  select p.page_id, p.payload, f.first, (('x' || sha1(p.payload))) as h, strlen(p.payload) as payload_bytes
  from p join f using (payload)
),
b as (
  select *, list_aggregate(list_transform(range(32), lambda k:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
      ((('0x' || substr(h, 2 + 5 * (k // 4), 5))::bigint) >> (15 - 5 * (k % 4))) & 31)::int, 1)), 'string_agg', '') as digest
  from d
)
select page_id, payload_bytes, digest as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id <> first then first end as refers_to
from b
"""


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillmesh.llm.packing import pack

    # the .tiktoken file holds the vocabulary of byte_bpe_50k.json; its library is several times as fast
    return pack(read(spark, sf_dir, "documents"), _path("byte_bpe_50k.tiktoken"), _pattern(), {"<|endoftext|>": 50256})


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from quillmesh.llm.chat import format_chats, learned_text, log_of_turns, read_back

    rows = read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    said = "\\### Assistant: </turn> ok"
    rows = rows.unionByName(spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema))
    out = format_chats(log_of_turns(rows)).select(
        "conv_id", read_back(F.col("formatted")).alias("turns"), learned_text(F.col("segments")).alias("learned"), F.length("formatted").cast("long").alias("formatted_chars")
    )
    spoken = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(spoken, 256).alias("turns_sha256"), F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"), "formatted_chars",
    )


OP6_SQL = r"""
with r as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
),
t as (
  select *, role || chr(10) || text || chr(10) as spoken,
    length(role) + length(text) + 15
      + length(role) - length(replace(replace(replace(role, '\', ''), '<', ''), '>', ''))
      + length(text) - length(replace(replace(replace(text, '\', ''), '<', ''), '>', '')) as chars
  from r
),
g as (
  select conv_id, count(*) as n_turns, string_agg(spoken, '' order by turn, role, text) as spoken,
    coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn, role, text), '') as learned,
    sum(chars)::bigint as formatted_chars
  from t group by conv_id
)
select conv_id, n_turns, sha256(spoken) as turns_sha256, length(learned) as loss_chars, sha256(learned) as loss_sha256, formatted_chars from g
"""


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillmesh.llm.toxicity import score_toxicity

    return score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillmesh.llm.shingle_join import link_documents

    return link_documents(read(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillmesh.llm.token_counts import count_tokens

    return count_tokens(read(spark, sf_dir, "documents"), _path("piece_bpe_32k.model"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillmesh.llm.decontamination import find_copies

    return find_copies(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_fertility, op2_html_text, op3_pii, op4_warc_revisits, op5_packing, op6_chat, op7_toxicity, op8_shingle_join, op9_token_counts, op10_decontamination,
    )}


def oracle_sql() -> dict[str, str]:
    return {"op4_warc_revisits": OP4_SQL, "op6_chat": OP6_SQL}
