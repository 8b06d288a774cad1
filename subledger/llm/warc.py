"""Content-addressed archive of WARC records: payloads once, headers apart, records by a join.

``write`` makes two tables. ``payloads`` holds the bytes of each different payload once under its SHA-256. ``records``
holds a row per record: the exact bytes of its header, and the digest that leads to the payload. ``read`` checks every
stored payload against its digests and puts the original records together again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger.llm.common import with_row_id
from subledger.session import materialized

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_CONV = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


@dataclass(frozen=True)
class Archive:
    records: DataFrame
    payloads: DataFrame


def sha1_base32(payload: Column) -> Column:
    """Five hexadecimal digits are four of base 32: forty digits make eight such groups."""
    digits = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digits, 5 * at + 1, 5), 16, 32), 4, "0") for at in range(8)]
    return F.translate(F.concat(*groups), _CONV, _BASE32)


def _one_line(value: Column) -> Column:
    """A header field must stay on its line: line ends inside an address are percent-encoded."""
    return F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _name(key: Column, record: Column) -> Column:
    page = F.coalesce(key.cast("string"), F.lit(""))
    return F.concat(F.lit("<urn:page:"), page, F.lit(":"), record.cast("string"), F.lit(">"))


def _line(field: str, value: Column) -> Column:
    return F.concat(F.lit(f"{field}: "), value, F.lit("\r\n"))


def write(
    df: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
) -> Archive:
    """Archive every row.

    Of the records with equal payloads of at least ``least_bytes`` bytes the one with the largest key is a response and
    the others are revisits of it; smaller ones are all responses. A null key is smaller than any; of rows that tie in
    their key one, the same on every later read, is the response. A null payload is empty, a null address an empty field.
    Other columns of the input are not looked at; an empty table gives an empty archive.
    """
    body = F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8")
    rows = df.select(F.col(key).cast("bigint").alias("key"), F.col(url).cast("string").alias("url"), body.alias("payload"))
    digest, size = F.unhex(F.sha2("payload", 256)).alias("digest"), F.length("payload").cast("bigint").alias("bytes")
    stubs = with_row_id(rows.select("key", "url", digest, sha1_base32(F.col("payload")).alias("sha1"), size), "record")
    different = F.raise_error(F.lit("two payloads have one digest"))
    payloads = materialized(
        rows.groupBy(digest)
        .agg(F.min("payload").alias("payload"), F.max("payload").alias("other"))
        .select("digest", F.when(F.col("payload") == F.col("other"), F.col("payload")).otherwise(different).alias("payload"))
    )
    first = stubs.groupBy("digest").agg(F.max(F.struct("key", "record")).alias("first"))
    marked = stubs.join(first, "digest").withColumn(
        "revisits", (F.col("bytes") >= least_bytes) & (F.col("record") != F.col("first.record"))
    )
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(F.col("revisits"), F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", _name(F.col("key"), F.col("record"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", _one_line(F.coalesce("url", F.lit("")))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(F.col("revisits"), F.concat(
            _line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            _line("WARC-Refers-To", _name(F.col("first.key"), F.col("first.record"))),
        )).otherwise(F.lit("")),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(F.col("revisits"), F.lit(0)).otherwise(F.col("bytes")).cast("string")),
        F.lit("\r\n"),
    )
    records = materialized(marked.select("record", "digest", F.encode(header, "UTF-8").alias("header")))
    return Archive(records, payloads)


def _field(header: Column, name: str) -> Column:
    """A header field's value; null if there is none."""
    found = F.regexp_extract(header, rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(found != "", found)


def _page(name: Column) -> Column:
    """The page of a record's name; null if it had none."""
    key = F.regexp_extract(name, r"^<urn:page:(-?\d*):", 1)
    return F.when(key != "", key.cast("bigint"))


def verified(payloads: DataFrame) -> DataFrame:
    """The stored payloads with length and SHA-1, having checked that each still has the digest it is stored under."""
    intact = F.unhex(F.sha2("payload", 256)) == F.col("digest")
    checked = F.when(intact, F.col("payload")).otherwise(F.raise_error(F.lit("a stored payload does not have its digest")))
    return payloads.select("digest", checked.alias("payload")).select(
        "digest", "payload", sha1_base32(F.col("payload")).alias("sha1"), F.length("payload").cast("bigint").alias("bytes")
    )


def read(archive: Archive, key: str = "page_id") -> DataFrame:
    """The records: fields from their headers, payload, and the bytes of the original record (``warc``).

    A revisit's record has no body of its own; its payload is that of the record it refers to.
    """
    header = F.decode("header", "UTF-8")
    joined = archive.records.join(verified(archive.payloads), "digest")
    fields = joined.withColumn("type", _field(header, "WARC-Type"))
    agrees = _field(header, "WARC-Payload-Digest") == F.concat(F.lit("sha1:"), F.col("sha1"))
    other = F.raise_error(F.lit("a header names another digest"))
    body = F.when(F.col("type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return fields.select(
        _page(_field(header, "WARC-Record-ID")).alias(key),
        F.col("bytes").alias("payload_bytes"),
        F.when(agrees, F.col("sha1")).otherwise(other).alias("payload_digest"),
        F.col("type").alias("record_type"),
        _page(_field(header, "WARC-Refers-To")).alias("refers_to"),
        F.col("payload"),
        F.concat(F.col("header"), body, F.lit(b"\r\n\r\n")).alias("warc"),
    )
