"""Content-addressed web archive: payloads stored once by digest, record headers beside them."""

from __future__ import annotations

import hashlib
import os
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitepulse.llm.common import map_batches

#: Payloads below this size are always written as responses.
LEAST_REVISIT_BYTES = 1000
#: Copies of one payload that meet in a task when records are put together.
COPIES_PER_SALT = 500
CRLF = "\r\n"


def _pack(rows: dict) -> dict:
    return {"payload_key": rows["payload_key"], "packed": [zlib.compress(p, 4) for p in rows["payload"]]}


def _unpack(rows: dict) -> dict:
    payloads = []
    for key, packed in zip(rows["payload_key"], rows["packed"]):
        try:
            payload = zlib.decompress(packed)
        except zlib.error:
            payload = None
        if payload is None or hashlib.sha256(payload).hexdigest() != key:
            raise ValueError(f"stored payload is damaged: {key}")
        payloads.append(payload)
    return {"record_id": rows["record_id"], "header": rows["header"], "payload": payloads}


def _line(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(CRLF))).otherwise("")


def write_archive(
    pages: DataFrame,
    folder: str,
    record_id: str = "page_id",
    uri: str = "url",
    body: str = "html",
    least_bytes: int = LEAST_REVISIT_BYTES,
) -> None:
    """Write one WARC record per row of ``pages`` below ``folder``.

    ``payloads`` holds each payload once, compressed, under its SHA-256, with the number of its copies. ``headers``
    holds per record the exact header block, the key of its payload and that number. SHA-256, SHA-1 and length of all copies of a key must agree, else the
    write fails; ``read_archive`` computes them again from the stored bytes.

    Of equal payloads of at least ``least_bytes`` bytes the one with the largest id is a response and
    the others revisits; all smaller ones are responses. A null body is an empty payload, a null URI
    gives a record without target; rows with a null id are written too (a copy without id is a revisit
    if any copy has one). Rows that repeat an id with the same body are records of their own, all
    responses if that id is the largest. No rows give an archive without records.
    """
    rows = pages.select(
        F.col(record_id).cast("bigint").alias("record_id"),
        F.col(uri).cast("string").alias("uri"),
        F.coalesce(F.encode(F.col(body).cast("string"), "utf-8"), F.lit(b"")).alias("payload"),
    )
    digested = rows.select(
        "record_id",
        "uri",
        F.sha2("payload", 256).alias("payload_key"),
        F.sha1("payload").alias("sha1"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
    )
    groups = digested.groupBy("payload_key").agg(
        F.max("record_id").alias("holder"),
        F.count(F.lit(1)).alias("copies"),
        F.min(F.struct("sha1", "payload_bytes")).alias("_low"),
        F.max(F.struct("sha1", "payload_bytes")).alias("_high"),
    )
    groups = groups.where(
        F.when(F.col("_low") == F.col("_high"), True).otherwise(F.raise_error(F.lit("payloads differ under one digest")))
    ).drop("_low", "_high")
    groups.write.parquet(os.path.join(folder, "groups"))
    groups = pages.sparkSession.read.parquet(os.path.join(folder, "groups"))

    response = (
        F.col("record_id").eqNullSafe(F.col("holder")) | F.col("holder").isNull() | (F.col("payload_bytes") < least_bytes)
    )
    kind = F.when(response, "response").otherwise("revisit")
    block = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _line("WARC-Type", kind),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("record_id").cast("string"), F.lit(">"))),
        _line("WARC-Target-URI", F.regexp_replace("uri", r"[\r\n]+", " ")),
        _line("WARC-Refers-To", F.when(~response, F.concat(F.lit("<urn:page:"), F.col("holder").cast("string"), F.lit(">")))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(response, F.col("payload_bytes")).otherwise(0)),
        _line("X-Payload-Length", F.col("payload_bytes")),
        F.lit(CRLF),
    )
    (
        digested.join(groups, "payload_key")
        .select("record_id", F.encode(block, "utf-8").alias("header"), "payload_key", "copies")
        .write.parquet(os.path.join(folder, "headers"))
    )
    # Equal bodies are dropped before the shuffle; which of them is kept doesn't matter.
    packed = map_batches(
        rows.select(F.sha2("payload", 256).alias("payload_key"), "payload"), _pack, "payload_key string, packed binary"
    )
    (
        packed.groupBy("payload_key")
        .agg(F.first("packed").alias("packed"), F.count(F.lit(1)).alias("copies"))
        .write.parquet(os.path.join(folder, "payloads"))
    )


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """The records of an archive: record_id, header and payload, each as the exact bytes written.

    Every revisit gets the payload it refers to. Records of a payload with very many copies are
    dealt out over salts, each of which gets the payload once. A payload whose bytes no longer give
    its key fails the query.
    """
    headers = spark.read.parquet(os.path.join(folder, "headers"))
    payloads = spark.read.parquet(os.path.join(folder, "payloads"))

    def salts(count: Column) -> Column:
        return F.greatest(F.lit(1), F.ceil(count / COPIES_PER_SALT)).cast("int")

    dealt = payloads.withColumn("salt", F.explode(F.sequence(F.lit(0), salts(F.col("copies")) - 1))).drop("copies")
    salted = headers.withColumn("salt", F.pmod(F.xxhash64("record_id"), salts(F.col("copies"))).cast("int"))
    return map_batches(
        salted.join(dealt, ["payload_key", "salt"]).select("record_id", "header", "payload_key", "packed"),
        _unpack,
        "record_id bigint, header binary, payload binary",
    )


def parse_records(records: DataFrame) -> DataFrame:
    """What the records say and hold: page_id, payload_bytes, payload_digest, record_type, refers_to, uri.

    Type and reference are read from the header, length and SHA-1 from the payload; a header that
    disagrees with its payload fails the query.
    """
    head = F.decode("header", "utf-8")

    def field(name: str) -> Column:
        found = F.regexp_extract(head, rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
        return F.when(found != "", found)

    digest = F.sha1("payload")
    length = F.octet_length("payload").cast("bigint")
    agrees = (field("WARC-Payload-Digest") == F.concat(F.lit("sha1:"), digest)) & (
        field("X-Payload-Length").cast("bigint") == length
    )
    return records.where(
        F.when(agrees, True).otherwise(F.raise_error(F.lit("a record header doesn't fit its payload")))
    ).select(
        F.col("record_id").alias("page_id"),
        length.alias("payload_bytes"),
        digest.alias("payload_digest"),
        field("WARC-Type").alias("record_type"),
        F.regexp_extract(field("WARC-Refers-To"), r"<urn:page:(-?\d+)>", 1).cast("bigint").alias("refers_to"),
        field("WARC-Target-URI").alias("uri"),
    )


def export_warc(records: DataFrame, path: str) -> None:
    """Write records as plain WARC text files: header, payload (none for a revisit), two line ends."""
    head = F.decode("header", "utf-8")
    body = F.when(head.contains(f"{CRLF}WARC-Type: revisit{CRLF}"), "").otherwise(F.decode("payload", "utf-8"))
    records.select(F.concat(head, body).alias("value")).write.option("lineSep", CRLF * 2).text(path)
