"""Content-addressed WARC archive.

An archive is two Parquet tables in one folder: ``payloads`` holds each distinct
payload once under its SHA-256, ``headers`` holds one row per record with the
exact bytes that precede the payload (WARC header, blank line, HTTP header, blank
line) and the digest that leads to the payload.  Reading joins the two again and
rebuilds every record byte for byte; digests are verified on both ways.

Of records with equal payloads of at least ``min_revisit_bytes`` bytes the one with
the largest id is a ``response``; the others are ``revisit`` records that refer to it
and have no payload of their own in the record.  Smaller payloads are also stored
once, but every record of theirs is a ``response``.

Edge cases: a null payload counts as empty; a null uri leaves its header line out,
line breaks in a uri are percent-encoded; rows that repeat an id are records with
the same record id (all of them are responses if the id is the largest); a null id
never is the largest, and a payload held by null ids alone gives responses only; an
empty table gives an empty archive; columns beside the named ones are dropped.

Payloads are shuffled once, to rebuild the records; all else moves narrow rows
(beyond ``BROADCAST_DIGESTS`` shared payloads, storing shuffles payloads as well).  A payload that a third of all records share is
reduced to one row by partial aggregation, and adaptive execution splits its
records in the joins (both sides are plain scans or exchanges for that reason).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm.sizes import broadcast_within
from encore.sources.scratch import materialize, release

CRLF = "\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_URN = "urn:x-record:"
#: Digests of payloads with several records that are sent to all executors at most (some
#: 100 bytes each); more are joined by a shuffle.
BROADCAST_DIGESTS = 500_000


def _checked(ok: Column, value: Column, message: str) -> Column:
    return F.when(ok, value).otherwise(F.raise_error(F.lit(message)).cast("string"))


def _head(date: str) -> Column:
    """The exact bytes before the payload."""
    revisit = F.col("record_type") == "revisit"
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("bytes").cast("string"), F.lit(CRLF + CRLF))
    uri = F.regexp_replace(F.regexp_replace("uri", "\r", "%0D"), "\n", "%0A")
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("bytes"))
    urn = lambda c: F.concat(F.lit(f"<{RECORD_URN}"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", urn(F.col("id"))),
        F.coalesce(line("WARC-Target-URI", uri), F.lit("")),
        line("WARC-Date", F.lit(date)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(REVISIT_PROFILE)),
                                 line("WARC-Refers-To", urn(F.col("response_id"))))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", length.cast("string")),
        F.lit(CRLF), http).cast("binary")


def write_archive(df: DataFrame, path: str, id_col: str = "page_id", uri_col: str = "url",
                  payload_col: str = "html", min_revisit_bytes: int = 1000,
                  date: str = "1970-01-01T00:00:00Z") -> None:
    """Write a record per row of ``df`` to the archive folder ``path``.

    ``date`` is the WARC-Date of all records (the input has no capture time).
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    full = df.select(F.col(id_col).alias("id"), F.col(uri_col).alias("uri"), payload.alias("payload"),
                     F.sha2(payload, 256).alias("sha256"))
    narrow = full.select("id", "uri", "sha256", F.sha1("payload").alias("sha1"),
                         F.octet_length("payload").cast("long").alias("bytes"))
    # one row per payload; equal SHA-256 must mean equal SHA-1 and size
    index = materialize(
        narrow.groupBy("sha256").agg(F.max("id").alias("response_id"), F.count(F.lit(1)).alias("records"),
                                     F.min("sha1").alias("a"), F.max("sha1").alias("b"),
                                     F.min("bytes").alias("c"), F.max("bytes").alias("d"))
        .select(_checked((F.col("a") == F.col("b")) & (F.col("c") == F.col("d")), F.col("sha256"),
                         "two payloads share a digest").alias("sha256"), "response_id", "records"), "warc-index")
    other = index.withColumnRenamed("sha256", "key")
    is_revisit = (F.col("bytes") >= min_revisit_bytes) & F.coalesce(~F.col("id").eqNullSafe(F.col("response_id")), F.lit(False)) \
        & F.col("response_id").isNotNull()
    (narrow.join(other, F.col("sha256") == F.col("key"))
           .withColumn("record_type", F.when(is_revisit, "revisit").otherwise("response"))
           .select("sha256", _head(date).alias("head"))
           .write.parquet(f"{path}/headers"))
    # a payload with one record is stored where it is read; of the others, the copy of the largest id
    shared = other.where("records > 1").select("key", "response_id")
    shared = broadcast_within(shared, BROADCAST_DIGESTS)
    full = full.select("id", "payload", "sha256")
    alone = full.join(shared, F.col("sha256") == F.col("key"), "left_anti")
    copies = (full.join(shared, (F.col("sha256") == F.col("key")) & F.col("id").eqNullSafe(F.col("response_id")))
                  .dropDuplicates(["sha256"]))  # repeated rows of one id
    alone.unionByName(copies.select("id", "payload", "sha256")).select("sha256", "payload").write.parquet(f"{path}/payloads")
    release(index)


def read_archive(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """Rebuild the records of an archive.

    Columns: ``id``, ``uri``, ``record_type``, ``refers_to``, ``payload`` (the full
    payload, also for revisits), ``payload_digest`` (SHA-1), and ``record``, the
    bytes of the original record.  A payload that does not match its digests, or a
    record without a payload, raises.
    """
    headers = spark.read.parquet(f"{path}/headers")
    stored = spark.read.parquet(f"{path}/payloads")
    stored = stored.select(
        _checked(F.sha2("payload", 256) == F.col("sha256"), F.col("sha256"), "payload does not match its digest").alias("key"),
        "payload")
    field = lambda name: F.nullif(F.regexp_extract(F.col("head").cast("string"), f"\r\n{name}: ([^\r]*)\r\n", 1), F.lit(""))
    number = lambda name: F.nullif(F.regexp_extract(F.col("head").cast("string"), f"\r\n{name}: <{RECORD_URN}([^>]*)>", 1), F.lit("")).cast(id_type)
    kind, sha1 = field("WARC-Type"), F.sha1("payload")
    return headers.join(stored, F.col("sha256") == F.col("key"), "left").select(
        number("WARC-Record-ID").alias("id"), field("WARC-Target-URI").alias("uri"), kind.alias("record_type"),
        number("WARC-Refers-To").alias("refers_to"), "payload",
        _checked(F.coalesce(field("WARC-Payload-Digest") == F.concat(F.lit("sha1:"), sha1), F.lit(False)), sha1,
                 "record does not match its payload").alias("payload_digest"),
        F.concat("head", F.when(kind == "response", F.col("payload")).otherwise(F.lit(b"")),
                 F.lit((CRLF + CRLF).encode())).alias("record"))


def export_warc(records: DataFrame, path: str) -> None:
    """Write rebuilt records as plain WARC files (one per partition, no shuffle)."""
    end = CRLF + CRLF
    body = F.expr(f"substring(record, 1, octet_length(record) - {len(end)})").cast("string")
    records.select(body.alias("value")).write.option("lineSep", end).text(path)
