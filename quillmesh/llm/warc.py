"""WARC archives with revisits resolved (operator 4).

Headers (id, address, digest) are shuffled by payload digest, without the payloads: each digest that occurs more than
once gets the smallest id that has it. That table is joined to the pages, salted, as one payload may be a third of all
pages. A page with the smallest id of its payload is written as a response; the others become revisit records that
refer to it and carry no payload. Records are written with fresh headers by Spark's text writer, whose commit protocol
survives lost executors: a record ends with two line ends, which are the writer's line separator. Archives are read
back by content length, so payloads may hold anything.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.llm.common import map_batches, shared_dir

#: The end of a record; the name space of record ids; the time of writing, fixed so that archives can be reproduced.
RECORD_END, NAMES, DATE = "\r\n\r\n", "urn:quillmesh:page:", "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SALTS = 16
#: Bytes that an archive is meant to have, and the most that one row of the reader may hold.
ARCHIVE_BYTES, MOST_BYTES = 24 << 20, 1 << 30


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of SHA-1: 160 bits are eight groups of five hexadecimal digits, each four base32 digits."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def resolve_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, refers_to, refers_to_url): refers_to is null for
    responses. Repeated rows with the smallest id are all responses; null ids never are what others refer to."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": base32_sha1(F.encode("payload", "UTF-8"))})
    headers = rows.where(F.col("payload_bytes") >= least_bytes).select("page_id", "url", "payload_digest")
    first = headers.groupBy("payload_digest").agg(F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("first"), F.count("*").alias("n"))
    first = first.where("n > 1 and first is not null").select(
        F.col("payload_digest").alias("d"), F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s")
    )
    salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")
    joined = rows.withColumn("salt", salt).join(first, (F.col("payload_digest") == F.col("d")) & (F.col("salt") == F.col("s")), "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")) & (F.col("payload_bytes") >= least_bytes)
    return joined.select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest", F.when(revisit, F.col("first_id")).alias("refers_to"), F.when(revisit, F.col("first_url")).alias("refers_to_url")
    )


def records(resolved: DataFrame) -> DataFrame:
    """(record): a WARC record for each row, without its end."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    optional = lambda name, value: F.coalesce(line(name, value), F.lit(""))
    address = lambda c: F.replace(F.regexp_replace(c, r"[\x00-\x1f\x7f]", "%20"), F.lit(" "), F.lit("%20"))
    name = lambda c: F.concat(F.lit(f"<{NAMES}"), c.cast("string"), F.lit(">"))
    again = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.concat(http, F.when(again, "").otherwise(F.col("payload")))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        line("WARC-Record-ID", name(F.coalesce(F.col("page_id").cast("string"), F.lit("")))),
        F.lit(f"WARC-Date: {DATE}\r\n"),
        optional("WARC-Target-URI", address(F.col("url"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(again, F.concat(line("WARC-Refers-To", name(F.col("refers_to"))), optional("WARC-Refers-To-Target-URI", address(F.col("refers_to_url"))), F.lit(f"WARC-Profile: {PROFILE}\r\n"))).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    return resolved.select(F.concat(head, block).alias("record"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> None:
    """Deduplicated .gz archives of about ARCHIVE_BYTES of records each, and never more than MOST_BYTES. An empty table
    gives an empty folder. A null payload is empty; a null address leaves its header out."""
    size = pages.agg(F.count("*").alias("n"), F.avg(F.octet_length(payload_col)).alias("mean"), F.max(F.octet_length(payload_col)).alias("most")).first()
    each = max(1, int(min(ARCHIVE_BYTES / ((size["mean"] or 0) + 600), MOST_BYTES / ((size["most"] or 0) + 8000))))
    out = records(resolve_revisits(pages, id_col, url_col, payload_col, least_bytes))
    out.write.option("compression", "gzip").option("lineSep", RECORD_END).option("maxRecordsPerFile", each).text(path)


def parse(archive: bytes) -> list[tuple[dict[str, str], bytes]]:
    """The records (headers by lower-case name, block) of an archive; its end is checked."""
    found, at = [], 0
    while at < len(archive):
        end = archive.index(b"\r\n\r\n", at)
        version, *lines = archive[at:end].decode().split("\r\n")
        if not version.startswith("WARC/1."):
            raise ValueError(f"no record at byte {at}")
        head = {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in lines)}
        start = end + 4
        stop = start + int(head["content-length"])
        if archive[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} has a wrong length")
        found.append((head, archive[start:stop]))
        at = stop + 4
    return found


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row for each record: page_id, url, payload_bytes and payload_digest (both of the full payload; a response's
    are computed anew and its digest is checked), record_type, refers_to, payload (null for revisits)."""
    number = re.compile(re.escape(NAMES) + r"(-?\d+)>")

    def run(batches):
        for b in batches:
            for content in b.column(0):
                data = content.as_py()
                rows = []
                for head, block in parse(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data):
                    again = head["warc-type"] == "revisit"
                    http, _, payload = block.partition(b"\r\n\r\n")
                    digest, size = head["warc-payload-digest"].removeprefix("sha1:"), int(re.search(rb"Content-Length: (\d+)", http)[1])
                    if not again and (size != len(payload) or digest != base64.b32encode(hashlib.sha1(payload).digest()).decode()):
                        raise ValueError(f"the payload of {head['warc-record-id']} isn't what its header says")
                    ids = [int(m[1]) if (m := number.search(head.get(k, ""))) else None for k in ("warc-record-id", "warc-refers-to")]
                    rows.append((ids[0], head.get("warc-target-uri"), size, digest, head["warc-type"], ids[1], None if again else payload.decode("utf-8", "replace")))
                names = "page_id url payload_bytes payload_digest record_type refers_to payload".split()
                for k in range(0, len(rows), 512):
                    yield dict(zip(names, zip(*rows[k : k + 512])))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload string"
    return map_batches(files, run, schema)


def archive_round_trip(pages: DataFrame, least_bytes: int = 0, path: str | None = None) -> DataFrame:
    """Writes the archives of pages and returns what reading them gives."""
    path = path or shared_dir(pages.sparkSession, "warc")
    write_archives(pages, path, least_bytes)
    return read_archives(pages.sparkSession, path)
