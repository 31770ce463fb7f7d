"""Content-addressed web archive.

`payloads/` holds every distinct payload once under its SHA-256; `records/` holds the exact header
bytes of every record with the address of its payload. Joining the two gives the records back,
byte for byte.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import written

REVISIT_BYTES = 1000  # smaller payloads aren't worth a revisit record
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def payload(html: Column) -> Column:
    return F.coalesce(html, F.lit("")).cast("binary")


def _line(name: str, value: Column) -> Column:
    """One header line, nothing where the value is missing; line ends in a value are escaped."""
    clean = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"\r\n{name}: "), clean), F.lit(""))


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), page_id.cast("string"), F.lit(">"))


def records(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """(address, header): the header bytes of each page's record, up to the payload.

    Of pages with equal payloads of at least REVISIT_BYTES bytes, the one with the largest page_id
    is a response and the others are revisits of it; smaller ones are all responses. Pages without
    an id refer to the largest id there is, or are responses if there is none.
    """
    body = payload(F.col("html"))
    rows = pages.select("page_id", "url", F.sha2(body, 256).alias("address"), F.sha1(body).alias("sha1"), F.octet_length(body).alias("n"))
    large = rows.where(F.col("n") >= REVISIT_BYTES).groupBy("address")
    several = large.agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("pages"))
    first = written(several.where("pages > 1 and first is not null").select("address", "first"), "first")
    rows = rows.join(first, "address", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "), F.col("n"), F.lit(END)
    )
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("n"))
    header = F.concat(
        F.lit("WARC/1.0"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _urn(F.col("page_id"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _line("WARC-Refers-To", F.when(revisit, _urn(F.col("first")))),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", length.cast("string")),
        F.lit(END),
        http,
    )
    return rows.select("address", header.cast("binary").alias("header"))


def write_archive(pages: DataFrame, path: str) -> None:
    """Store the pages below `path`; raises if two payloads share a digest."""
    spark = pages.sparkSession
    stored = pages.select(payload(F.col("html")).alias("payload"))
    stored = stored.select(F.sha2("payload", 256).alias("address"), "payload")
    counts = stored.groupBy("address").agg(F.count(F.lit(1)).alias("n"))
    several = written(counts.where("n > 1").select("address"), "several")
    # only payloads that occur more than once are shuffled, and combined before
    alone = stored.join(several, "address", "left_anti")
    once = stored.join(several, "address", "left_semi").distinct()
    alone.unionByName(once).write.parquet(f"{path}/payloads")
    check = spark.read.parquet(f"{path}/payloads")
    wrong = check.where(F.sha2("payload", 256) != F.col("address"))
    clash = check.select("address").groupBy("address").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not wrong.isEmpty() or not clash.isEmpty():
        raise ValueError("two payloads share a digest, or a stored payload differs from its own")
    records(pages).write.parquet(f"{path}/records")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(header, payload) of every record, the payload joined back by its address."""
    heads = spark.read.parquet(f"{path}/records")
    return heads.join(spark.read.parquet(f"{path}/payloads"), "address").select("header", "payload")


def record_bytes() -> Column:
    """A record as it stands in a WARC file; a revisit has no payload of its own."""
    own = F.when(header_field("WARC-Type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return F.concat("header", own, F.lit(END).cast("binary"))


def header_field(name: str) -> Column:
    """A field of the record's header, NULL where it has none."""
    found = F.regexp_extract(F.col("header").cast("string"), rf"\r\n{name}: ([^\r\n]*)", 1)
    return F.when(found != "", found)


def parsed(archive: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) as the archive holds them.

    Bytes and digest are those of the payload that was read back. A missing page is the empty
    payload, a missing id stays missing, repeated rows give a record each, and other columns of
    the pages aren't stored. An empty table gives an empty archive. A very long page is one payload,
    which one task holds.
    """

    def page(name: str) -> Column:
        return F.regexp_extract(header_field(name), r"<urn:page:(-?\d+)>", 1).cast("long")

    return archive.select(
        page("WARC-Record-ID").alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
        header_field("WARC-Type").alias("record_type"),
        page("WARC-Refers-To").alias("refers_to"),
    )


def rebuilt(archive: DataFrame) -> DataFrame:
    """(page_id, record_bytes, record_sha256, content_length, lengths_agree) of every record put together.

    The lengths agree if the record's Content-Length counts the bytes between its header and the
    line ends that close it, and the Content-Length of the page's own header those of the payload.
    """
    page_id = F.regexp_extract(header_field("WARC-Record-ID"), r"<urn:page:(-?\d+)>", 1).cast("long")
    header = F.col("header").cast("string")
    head = F.octet_length(F.substring_index(header, END, 1)) + len(END)
    block = F.octet_length("record") - head - len(END)
    stated = header_field("Content-Length").cast("long")
    http = F.regexp_extract(header, r"(?s)\r\n\r\nHTTP/.*\r\nContent-Length: (\d+)\r\n\r\n$", 1)
    agree = stated.eqNullSafe(block) & http.eqNullSafe(F.octet_length("payload").cast("string"))
    return archive.select("header", "payload", record_bytes().alias("record")).select(
        page_id.alias("page_id"),
        F.octet_length("record").cast("long").alias("record_bytes"),
        F.sha2("record", 256).alias("record_sha256"),
        stated.alias("content_length"),
        agree.alias("lengths_agree"),
    )


def export(archive: DataFrame, path: str) -> None:
    """Write the records as WARC text files: each record ends in the two line ends that part them."""
    whole = F.concat("header", F.when(header_field("WARC-Type") == "revisit", F.lit(b"")).otherwise(F.col("payload")))
    archive.select(whole.cast("string").alias("value")).write.option("lineSep", END).text(path)
