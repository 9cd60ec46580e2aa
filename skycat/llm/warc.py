"""Content-addressed WARC archive: payload bytes once per digest, record headers apart, records by a join.

An archive is a folder with two Parquet tables:

* ``payloads``: ``content_key`` (SHA-256 and length), ``payload``; each payload once.
* ``headers``: ``content_key`` and ``header``, the exact bytes of each record's header, with its blank line.

A record is header + payload + two line ends; a revisit's own block is empty, and its payload is the one it refers to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REVISIT_FROM = 1000
UNDATED = "1970-01-01T00:00:00Z"  # date of records whose pages bring none


def content_key(payload: Column) -> Column:
    return F.concat(F.sha2(payload, 256), F.lit("-"), F.octet_length(payload).cast("string"))


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def page_records(pages: DataFrame, revisit_from: int = REVISIT_FROM, date: str = UNDATED) -> DataFrame:
    """One record per row of ``pages`` (page_id, url, html; other columns are left out): record_id, content_key, header, payload.

    Of the records with equal payloads of at least ``revisit_from`` bytes, that with the largest id is
    the response and the others revisit it; rows that repeat the largest id are all responses.  A null
    html is the empty payload, a null url the empty target, a null id counts as smaller than any
    other and is written as ``null``.  ``date`` (UTC) is the date of all records.  Control characters in a url are written as spaces, so a
    header keeps its lines.  An empty table gives an empty table.
    """
    rows = pages.select(F.col("page_id").alias("record_id"), F.coalesce("url", F.lit("")).alias("url"),
                        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("content_key", content_key(F.col("payload"))).withColumns({"sha1": F.sha1("payload"), "size": F.octet_length("payload")})
    large = rows.filter(F.col("size") >= revisit_from).select("record_id", "content_key")
    # one small row per digest and task is shuffled, however many copies a payload has
    first = large.groupBy("content_key").agg(F.max("record_id").alias("holder"), F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    rows = rows.join(first.select("content_key", "holder"), "content_key", "left")
    revisit = F.col("holder").isNotNull() & ~F.col("holder").eqNullSafe(F.col("record_id"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", urn(F.col("record_id"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.regexp_replace("url", r"\p{Cntrl}", " ")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, _line("WARC-Refers-To", urn(F.col("holder")))).otherwise(F.lit("")),
        F.when(revisit, _line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))).otherwise(F.lit("")),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("size").cast("string"))),
        F.lit("\r\n"))
    return rows.select("record_id", "content_key", F.encode(header, "UTF-8").alias("header"), "payload")


def write_archive(records: DataFrame, path: str) -> None:
    """Write ``records`` (content_key, header, payload) to the archive at ``path``.

    The payload table keeps one row per key: copies meet in a partial aggregate, so a task sends a
    hot payload once.  Headers never travel.
    """
    records.groupBy("content_key").agg(F.first("payload").alias("payload")).write.parquet(f"{path}/payloads")
    records.select("content_key", "header").write.parquet(f"{path}/headers")


def verified_payloads(spark: SparkSession, path: str) -> DataFrame:
    """The stored payloads; reading fails where the bytes do not give the key they are stored under."""
    stored = spark.read.schema("content_key string, payload binary").parquet(f"{path}/payloads")
    same = content_key(F.col("payload")) == F.col("content_key")
    fail = F.raise_error(F.concat(F.lit("damaged payload "), F.col("content_key")))
    return stored.filter(F.when(same, F.lit(True)).otherwise(fail.cast("boolean")))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archive: parsed header fields, ``payload``, its length and SHA-1, and ``record``, the record's exact bytes.

    Reading ``record`` fails where the digest in a header is not that of the payload.  Digests are taken from the stored bytes once per payload, before the join.  Columns that the
    caller does not select are not shuffled.
    """
    payloads = verified_payloads(spark, path).select(
        "content_key", "payload", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"))
    text = F.decode("header", "UTF-8")
    field = lambda name, form: F.regexp_extract(text, rf"\r\n{name}: {form}\r\n", 1)
    headers = spark.read.schema("content_key string, header binary").parquet(f"{path}/headers").select(
        "content_key", "header",
        field("WARC-Type", "([a-z]+)").alias("record_type"),
        F.expr("try_cast(regexp_extract(decode(header, 'UTF-8'), 'WARC-Record-ID: <urn:page:([^>]*)>', 1) AS bigint)").alias("record_id"),
        F.expr("try_cast(regexp_extract(decode(header, 'UTF-8'), 'WARC-Refers-To: <urn:page:([^>]*)>', 1) AS bigint)").alias("refers_to"),
        field("WARC-Target-URI", "([^\r\n]*)").alias("url"),
        field("WARC-Payload-Digest", "sha1:([0-9a-f]+)").alias("header_digest"))
    joined = headers.join(payloads, "content_key")
    block = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    fail = F.raise_error(F.concat(F.lit("the header of record "), F.coalesce(F.col("record_id").cast("string"), F.lit("null")), F.lit(" has another digest")))
    head = F.when(F.col("header_digest") == F.col("payload_digest"), F.col("header")).otherwise(fail.cast("binary"))
    return joined.withColumn("record", F.concat(head, block, F.lit(b"\r\n\r\n")))
