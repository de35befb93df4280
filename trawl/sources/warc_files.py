"""S2 from crawl output: response records of WARC files as a table of fetches, and the sink that writes them.

Files are read by Spark's text source with the end of a record and the next
version line as separator, so any file system Spark knows works, plain files
are split over tasks at record boundaries, and a compressed file (one gzip
member or one for each record) streams through a task record by record. All
else is column expressions on one record, with no shuffle.

Defined results: records other than responses are left out; a record without a
target gets a null ``url``; a response that isn't HTTP, or whose status line
can't be read, has a null ``status``; a record whose block isn't as long as its
``Content-Length`` says (a cut file, or a page that quotes a whole record) has
an ``error`` and no page; header names are lower-cased and repeated ones kept;
pages are taken as UTF-8 unless their charset is Latin-1, with bytes that are
not valid replaced; an empty folder of files gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CRLF = "\r\n"
VERSION = "WARC/1.0"
LATIN_1 = ("iso-8859-1", "latin-1", "latin1", "l1")


def _head(block: Column) -> Column:
    return F.substring_index(block.cast("string"), CRLF + CRLF, 1)


def _after_head(block: Column) -> Column:
    """The bytes after the first empty line."""
    return F.substring(block.cast("binary"), F.octet_length(_head(block)) + 5, F.octet_length(block.cast("binary")))


def header_fields(head: Column) -> Column:
    """``array<struct<name, value>>`` of the header lines, names in lower case, in their order."""
    lines = F.filter(F.split(head, CRLF), lambda x: F.instr(x, ":") > 1)
    return F.transform(
        lines,
        lambda x: F.struct(
            F.lower(F.btrim(F.substring_index(x, ":", 1))).alias("name"),
            F.btrim(F.substring(x, F.instr(x, ":") + 1, F.length(x))).alias("value"),
        ),
    )


def field(fields: Column, name: str) -> Column:
    """The first value of a header, null where it isn't there."""
    return F.get(F.filter(fields, lambda f: f["name"] == name), F.lit(0))["value"]


def read_records(spark: SparkSession, path: str, version: str = VERSION) -> DataFrame:
    """``(fields, block, complete)`` of every record of the WARC files in ``path``."""
    end = CRLF + CRLF
    raw = spark.read.option("lineSep", f"{end}{version}{CRLF}").text(path).select("value")
    fields = header_fields(_head(F.col("value")))
    records = raw.select(fields.alias("fields"), _after_head(F.col("value")).alias("rest"))
    length = F.expr("try_cast(length AS BIGINT)")
    sized = records.where(field(F.col("fields"), "warc-type").isNotNull()).withColumn("length", field(F.col("fields"), "content-length"))
    block = F.substring("rest", F.lit(1), length.cast("int"))
    # the last record of a file still has its end
    over = F.octet_length("rest") - length
    return sized.select("fields", block.alias("block"), F.coalesce(over.isin(0, len(end)), F.lit(False)).alias("complete"))


def _page(payload: Column, content_type: Column) -> Column:
    charset = F.lower(F.regexp_extract(F.coalesce(content_type, F.lit("")), r"(?i)charset\s*=\s*[\"']?([^\s;\"']+)", 1))
    return F.when(charset.isin(*LATIN_1), F.decode(payload, "ISO-8859-1")).otherwise(F.make_valid_utf8(payload.cast("string")))


def read_fetches(spark: SparkSession, path: str, version: str = VERSION) -> DataFrame:
    """``(url, status, html, error, date, headers)`` of the response records: input of ``pages.split_fetches``."""
    fields, block = F.col("fields"), F.col("block")
    found = read_records(spark, path, version).where(F.lower(field(fields, "warc-type")) == "response")
    http = found.select(
        # some writers put the target in angle brackets
        F.regexp_replace(field(fields, "warc-target-uri"), "^<(.*)>$", "$1").alias("url"),
        field(fields, "warc-date").alias("date"),
        "complete",
        _head(block).alias("head"),
        _after_head(block).alias("payload"),
    )
    status = F.regexp_extract("head", r"^HTTP/[0-9.]+[ ]+([0-9]{3})(?![0-9])", 1)
    number = F.when(status != "", status.cast("int"))
    named = http.select("*", number.alias("status"), header_fields(F.col("head")).alias("headers"))
    cut = F.when(~F.col("complete"), F.lit("record is not as long as its Content-Length"))
    return named.select(
        "url",
        "status",
        F.when(F.col("complete"), _page(F.col("payload"), field(F.col("headers"), "content-type"))).alias("html"),
        cut.alias("error"),
        "date",
        "headers",
    )


def write_fetches(fetches: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write ``fetches(url, status, html)`` as response records, one file for each partition.

    Rows without a status had no answer and give no record; line ends in a URL are percent-encoded.
    """
    url = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "\r", "%0D"), "\n", "%0A")
    payload = F.coalesce("html", F.lit(""))
    block = F.concat(
        F.lit("HTTP/1.1 "), F.lpad(F.col("status").cast("string"), 3, "0"), F.lit(f" {CRLF}Content-Type: text/html; charset=utf-8{CRLF}{CRLF}"), payload
    )
    head = F.concat(
        F.lit(f"{VERSION}{CRLF}WARC-Type: response{CRLF}WARC-Record-ID: <urn:uuid:"), F.uuid(), F.lit(f">{CRLF}WARC-Target-URI: "), url,
        F.lit(f"{CRLF}WARC-Date: "), F.date_format(F.to_utc_timestamp(F.now(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.lit(f"{CRLF}Content-Type: application/http; msgtype=response{CRLF}Content-Length: "), F.octet_length("block"), F.lit(CRLF + CRLF),
    )
    records = fetches.where(F.col("status").isNotNull()).withColumn("block", block).select(F.concat(head, "block").alias("warc"))
    records.write.option("lineSep", CRLF + CRLF).option("compression", compression).text(path)
