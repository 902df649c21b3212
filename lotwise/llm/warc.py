"""A content-addressed web archive: payload bytes once, record heads apart, records by join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the WARC and HTTP formats.
END = "\r\n"
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MIN_REVISIT_BYTES = 1000
DATE = "1970-01-01T00:00:00Z"


def _field(name: str, value: Column | str) -> Column:
    """A header line; none where the value is null."""
    value = F.lit(value) if isinstance(value, str) else value
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(END)), F.lit(""))


def _one_line(value: Column) -> Column:
    return F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _page_urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def _head(date: str) -> Column:
    """WARC head and HTTP head of a record: all its bytes before the payload."""
    revisit = F.col("record_type") == "revisit"
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}"),
        _field("Content-Length", F.col("payload_bytes").cast("string")),
        F.lit(END),
    )
    block = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    return F.concat(
        F.lit(f"{VERSION}{END}"),
        _field("WARC-Type", F.col("record_type")),
        _field("WARC-Record-ID", _page_urn(F.col("page_id"))),
        _field("WARC-Date", date),
        _field("WARC-Target-URI", _one_line(F.col("url"))),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _field("WARC-Refers-To", F.when(revisit, _page_urn(F.col("first_id")))),
        _field("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        _field("Content-Type", "application/http; msgtype=response"),
        _field("Content-Length", block.cast("string")),
        F.lit(END),
        http,
    )


def write_archive(pages: DataFrame, path: str, date: str = DATE, min_revisit: int = MIN_REVISIT_BYTES) -> None:
    """Write a record per row of ``pages`` (``page_id, url, html``) as two tables under ``path``.

    ``payloads`` holds each payload once by its SHA-256; rows that share the digest must agree on SHA-1 and length, else
    the write fails. ``heads`` holds the exact bytes of each record before its payload, and the digest.
    Of records with equal payloads of at least ``min_revisit`` bytes, that with the largest page_id is the response and
    the others revisit it.

    A null html is an empty payload, a null url leaves its header out, line breaks in a url are percent-encoded.
    A null page_id counts as the smallest; rows with the same page_id and payload are records of the same type.
    An empty table gives an empty archive. Other columns are ignored.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    facts = [
        F.unhex(F.sha2(payload, 256)).alias("digest"),
        F.sha1(payload).alias("sha1"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
    ]
    # Equal payloads meet before the shuffle as well, so a page with a third of all rows moves once per task.
    stored = (
        pages.select(*facts, payload.alias("payload"))
        .groupBy("digest")
        .agg(
            F.first("payload").alias("payload"),
            F.min("sha1").alias("sha1"),
            F.max("sha1").alias("other"),
            F.min("payload_bytes").alias("n"),
            F.max("payload_bytes").alias("m"),
        )
    )
    clash = F.raise_error(F.concat(F.lit("two payloads with digest "), F.hex("digest")))
    stored.select(
        "digest",
        F.when((F.col("sha1") == F.col("other")) & (F.col("n") == F.col("m")), F.col("payload"))
        .otherwise(clash.cast("binary"))
        .alias("payload"),
    ).write.option("compression", "zstd").parquet(f"{path}/payloads")

    records = pages.select("page_id", "url", *facts)
    first = (
        records.filter(F.col("payload_bytes") >= min_revisit)
        .groupBy("digest")
        .agg(F.max("page_id").alias("first_id"), F.count("*").alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    later = F.col("first_id").isNotNull() & F.coalesce(F.col("page_id") < F.col("first_id"), F.lit(True))
    records = records.join(first, "digest", "left").withColumn(
        "record_type", F.when(later, F.lit("revisit")).otherwise(F.lit("response"))
    )
    records.select("digest", _head(date).cast("binary").alias("head")).write.parquet(f"{path}/heads")


def _parsed(head: Column, name: str) -> Column:
    found = F.regexp_extract(head, rf"\r\n{name}: ([^\r\n]*)", 1)
    return F.when(found != "", found)


def read_heads(spark: SparkSession, path: str) -> DataFrame:
    """The parsed heads: ``digest, page_id, record_type, url, sha1, refers_to``."""
    head = F.col("head").cast("string")
    page = lambda name: F.try_to_number(
        F.regexp_extract(_parsed(head, name), r"^<urn:page:(-?\d+)>$", 1), F.lit("S9999999999999999999")
    ).cast("long")
    return spark.read.schema("digest binary, head binary").parquet(f"{path}/heads").select(
        "digest",
        "head",
        page("WARC-Record-ID").alias("page_id"),
        _parsed(head, "WARC-Type").alias("record_type"),
        _parsed(head, "WARC-Target-URI").alias("url"),
        F.regexp_extract(_parsed(head, "WARC-Payload-Digest"), "^sha1:(.*)$", 1).alias("sha1"),
        page("WARC-Refers-To").alias("refers_to"),
    )


def _payloads(spark: SparkSession, path: str) -> DataFrame:
    """The stored payloads, each checked against its digest."""
    broken = F.raise_error(F.concat(F.lit("payload differs from its digest "), F.hex("digest"))).cast("binary")
    checked = F.when(F.unhex(F.sha2("payload", 256)) == F.col("digest"), F.col("payload")).otherwise(broken)
    return spark.read.schema("digest binary, payload binary").parquet(f"{path}/payloads").select(
        "digest", checked.alias("payload")
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records as bytes: ``page_id, record_type, record, payload``; a revisit's record ends after its HTTP head.

    A head whose payload is missing or differs fails the read.
    """
    end = F.lit(END * 2).cast("binary")
    both = read_heads(spark, path).join(_payloads(spark, path), "digest", "left")
    missing = F.raise_error(F.concat(F.lit("no payload for record "), F.col("page_id").cast("string"))).cast("binary")
    payload = F.when(F.col("payload").isNotNull(), F.col("payload")).otherwise(missing)
    block = F.when(F.col("record_type") == "revisit", F.col("head")).otherwise(F.concat("head", payload))
    return both.select("page_id", "record_type", F.concat(block, end).alias("record"), payload.alias("payload"))


def parsed_records(records: DataFrame) -> DataFrame:
    """What the bytes of records say: ``page_id, record_type, refers_to, sha1, body`` beside their other columns.

    A record is read like any other: its head up to the first empty line, an HTTP head up to the second, and as many
    bytes of payload as that states. Stated lengths that are not those found fail the read.
    """
    end = END * 2
    text = F.col("record").cast("string")
    head = F.substring_index(text, end, 1)
    # What follows the payload is the record's end.
    start = F.octet_length(F.substring_index(text, end, 2)) + len(end)
    body = F.substring(F.col("record"), start + 1, F.octet_length("record") - start - len(end))
    block = F.octet_length("record") - F.octet_length(head) - 2 * len(end)
    page = lambda name: F.try_to_number(
        F.regexp_extract(_parsed(head, name), r"^<urn:page:(-?\d+)>$", 1), F.lit("S9999999999999999999")
    ).cast("long")
    wrong = F.raise_error(F.lit("a record's length is not the one it states")).cast("binary")
    rows = records.select(
        page("WARC-Record-ID").alias("page_id"),
        _parsed(head, "WARC-Type").alias("record_type"),
        page("WARC-Refers-To").alias("refers_to"),
        F.regexp_extract(_parsed(head, "WARC-Payload-Digest"), "^sha1:(.*)$", 1).alias("sha1"),
        F.when(_parsed(head, "Content-Length").cast("long") == block, body).otherwise(wrong).alias("body"),
        "payload",
    )
    return rows


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Facts of each archived page, read from its record: ``page_id, payload_bytes, payload_digest, record_type,
    refers_to``. A revisit's payload is the stored one that it shares. A record whose payload is missing, or is not
    what its head says, fails the read."""
    rows = parsed_records(read_records(spark, path))
    whole = F.when(F.col("record_type") == "revisit", F.col("payload")).otherwise(F.col("body"))
    facts = rows.withColumn("found", F.sha1(whole))
    wrong = F.raise_error(F.concat(F.lit("another payload in record "), F.col("page_id").cast("string")))
    return facts.select(
        "page_id",
        F.octet_length(whole).cast("long").alias("payload_bytes"),
        F.when(F.col("found") == F.col("sha1"), F.col("found")).otherwise(wrong.cast("string")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )
