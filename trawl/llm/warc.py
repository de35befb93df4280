"""Derivative records of WARC responses (operator 2).

Every response record gives two linked records, as WARC/1.1 has them:

- ``conversion``: the payload as plain text (``text/plain``),
- ``metadata``: ``application/warc-fields`` about the response: its HTTP status
  and headers, digests, title, language, out-links and the conversion's id.

Both keep ``WARC-Refers-To`` (the response's id), ``WARC-Refers-To-Target-URI``,
``WARC-Refers-To-Date``, and point at each other with ``WARC-Concurrent-To``. The
source's own block and payload digests are carried unchanged in the metadata;
each derived record has a block digest of its own. Record ids are UUIDs made
from the response's id and the record's type, so that a repeated run names the
same records.

A response is one row and nothing is shuffled: HTML goes through one Arrow
batch at a time, records are put together by column functions. ``write_warc``
writes plain WARC files: Spark's text writer ends every row with the two line
breaks that end a WARC record.

Defined results: records that aren't responses give nothing; a null payload
counts as empty; a null target or date leaves its header out; a null record id
gives records that refer to nothing, named after target, date and payload;
repeated rows give repeated records; extra columns are dropped.
"""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import small_batches

CRLF = "\r\n"
PAGE = "title string, lang string, links array<string>, body string"

# Elements that break a line.
_BREAKS = frozenset(
    "address article aside blockquote br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "li main nav ol option p pre section table td th title tr ul".split()
)
# Attributes as HTML's tokenizer reads them: a quote opens a value only right after "="; elsewhere it is part of a name
# or an unquoted value, and so is one that is never closed. Any text but ">" fits, so a tag ends at the next one.
_VALUE = r"\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*))"
_NAME = r"[^\s/>][^\s/>=]*"
_ATTRIBUTES = rf"(?:[\s/]+|{_NAME}(?:{_VALUE.replace('([', '(?:[')})?)*"
_TOKEN = re.compile(
    r"<!--(?P<comment>.*?)(?:-->|\Z)"
    rf"|<(?P<raw>script|style|textarea|title|noscript|iframe|template|svg)\b(?P<rawattrs>{_ATTRIBUTES})(?:>|\Z)"
    r"(?P<rawtext>.*?)(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    rf"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>{_ATTRIBUTES})(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(rf"({_NAME})(?:{_VALUE})?")
# Of the elements whose content isn't markup, those whose text is shown.
_SHOWN_RAW = frozenset({"textarea"})


def _attribute(attrs: str, name: str) -> str | None:
    for m in _ATTRIBUTE.finditer(attrs):
        value = next((g for g in m.groups()[1:] if g is not None), None)
        if m[1].lower() == name and value is not None and not (m[4] or "").startswith(('"', "'")):
            return html.unescape(value)
    return None


def _tidy(text: str) -> str:
    """White space runs become one space within a line; blank lines go."""
    lines = (" ".join(line.split()) for line in text.split("\n"))
    return "\n".join(line for line in lines if line)


def page_text(page: str | None) -> tuple[str | None, str | None, list[str], str]:
    """``(title, language, links, plain text)`` of an HTML page.

    Scripts, styles and comments give no text, also where their end is missing;
    block elements break lines; character references are resolved once.
    """
    page = (page or "").replace("\r\n", "\n").replace("\r", "\n")
    parts: list[str] = []
    title = lang = None
    links: list[str] = []
    at = 0
    for m in _TOKEN.finditer(page):
        parts.append(html.unescape(page[at : m.start()].replace("\n", " ")))
        at = m.end()
        if m["raw"]:
            name = m["raw"].lower()
            if name == "title" and title is None:
                title = _tidy(html.unescape(m["rawtext"]).replace("\n", " ")) or None
            elif name in _SHOWN_RAW:
                parts.append(f"\n{html.unescape(m['rawtext'])}\n")
        elif m["tag"]:
            name = m["tag"].lower()
            if name in _BREAKS:
                parts.append("\n")
            if not m["close"]:
                if name == "html" and lang is None:
                    lang = _attribute(m["attrs"], "lang")
                elif name == "a" and (href := _attribute(m["attrs"], "href")) is not None:
                    links.append(" ".join(href.split()))
    parts.append(html.unescape(page[at:].replace("\n", " ")))
    return title, lang, links, _tidy("".join(parts))


def page_column(payload: str) -> Column:
    """``page_text`` of a column, as a struct."""

    @F.pandas_udf(PAGE)
    def pages(payloads: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([page_text(p) for p in payloads], columns=["title", "lang", "links", "body"])

    return pages(F.col(payload))


def record_id(*parts: Column) -> Column:
    """``<urn:uuid:...>`` made from the MD5 of the parts (a name-based UUID)."""
    h = F.md5(F.concat_ws("\n", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    cut = lambda a, n: F.substring(h, a, n)
    return F.concat(
        F.lit("<urn:uuid:"), cut(1, 8), F.lit("-"), cut(9, 4), F.lit("-3"), cut(14, 3), F.lit("-a"), cut(18, 3), F.lit("-"), cut(21, 12), F.lit(">")
    )


def sha256(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block.cast("binary"), 256))


def _fields(pairs: list[tuple[str, Column]]) -> Column:
    """``Name: value`` lines; null values leave theirs out. Line breaks in a value become spaces."""
    lines = [F.concat(F.lit(f"{name}: "), F.regexp_replace(value.cast("string"), r"[\r\n]+", " ")) for name, value in pairs]
    return F.concat_ws(CRLF, *lines)


def derive(responses: DataFrame) -> DataFrame:
    """Metadata and conversion records of ``responses``.

    In: ``warc_type, record_id, target_uri, date, http_headers, payload,
    block_digest, payload_digest`` (strings; ``http_headers`` is the status line
    and the headers). Out: ``warc_type, record_id, refers_to, target_uri, date,
    concurrent_to, content_type, block, block_digest, source_block_digest,
    source_payload_digest, warc`` where ``warc`` is the record's header and
    block, without the two line breaks that end it.
    """
    source = small_batches(responses).where("warc_type = 'response'")
    named = source.withColumn("__base", F.coalesce("record_id", record_id(F.col("target_uri"), F.col("date"), F.col("payload"))))
    both = named.select(
        "record_id", "target_uri", "date", "http_headers", "block_digest", "payload_digest",
        record_id(F.lit("metadata"), F.col("__base")).alias("meta_id"),
        record_id(F.lit("conversion"), F.col("__base")).alias("conv_id"),
        F.octet_length(F.coalesce("payload", F.lit(""))).alias("size"),
        page_column("payload").alias("page"),
    )
    header_lines = F.filter(F.split(F.coalesce("http_headers", F.lit("")), "\r?\n"), lambda x: F.trim(x) != "")
    http = F.array_join(F.transform(header_lines, lambda x, i: F.concat(F.when(i == 0, "http-status: ").otherwise("http-header: "), x)), CRLF)
    links = F.array_join(F.transform("page.links", lambda x: F.concat(F.lit("outlink: "), x)), CRLF)
    about = _fields(
        [
            ("source-block-digest", F.col("block_digest")),
            ("source-payload-digest", F.col("payload_digest")),
            ("source-payload-bytes", F.col("size")),
            ("title", F.col("page.title")),
            ("language", F.col("page.lang")),
            ("conversion", F.col("conv_id")),
            ("text-digest", sha256(F.col("page.body"))),
        ]
    )
    block = F.concat(F.concat_ws(CRLF, *[F.when(x != "", x) for x in (http, about, links)]), F.lit(CRLF))
    kinds = F.array(
        F.struct(
            F.lit("metadata").alias("warc_type"), F.col("meta_id").alias("id"), F.col("conv_id").alias("other"),
            F.lit("application/warc-fields").alias("content_type"), block.alias("block"),
        ),
        F.struct(
            F.lit("conversion").alias("warc_type"), F.col("conv_id").alias("id"), F.col("meta_id").alias("other"),
            F.lit("text/plain; charset=utf-8").alias("content_type"), F.col("page.body").alias("block"),
        ),
    )
    records = both.select(
        F.col("record_id").alias("refers_to"), "target_uri", "date", F.col("block_digest").alias("source_block_digest"),
        F.col("payload_digest").alias("source_payload_digest"), F.inline_outer(kinds),
    ).select("*", sha256(F.col("block")).alias("block_digest"))
    header = F.concat(
        F.lit("WARC/1.1" + CRLF),
        _fields(
            [
                ("WARC-Type", F.col("warc_type")),
                ("WARC-Record-ID", F.col("id")),
                ("WARC-Date", F.col("date")),
                ("WARC-Target-URI", F.col("target_uri")),
                ("WARC-Refers-To", F.col("refers_to")),
                ("WARC-Refers-To-Target-URI", F.when(F.col("refers_to").isNotNull(), F.col("target_uri"))),
                ("WARC-Refers-To-Date", F.when(F.col("refers_to").isNotNull(), F.col("date"))),
                ("WARC-Concurrent-To", F.col("other")),
                ("WARC-Block-Digest", F.col("block_digest")),
                ("Content-Type", F.col("content_type")),
                ("Content-Length", F.octet_length("block")),
            ]
        ),
        F.lit(CRLF + CRLF),
    )
    return records.select(
        "warc_type", F.col("id").alias("record_id"), "refers_to", "target_uri", "date", F.col("other").alias("concurrent_to"),
        "content_type", "block", "block_digest", "source_block_digest", "source_payload_digest", F.concat(header, "block").alias("warc"),
    )


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write ``warc`` records as WARC files under ``path``, one for each partition."""
    records.select("warc").write.option("lineSep", CRLF + CRLF).option("compression", compression).text(path)


def responses_from_pages(pages: DataFrame) -> DataFrame:
    """Stand-in input: ``pages`` as the response records a crawl would have written."""
    payload = F.coalesce("html", F.lit(""))
    headers = F.concat(
        F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF + "Content-Length: "), F.octet_length(payload)
    )
    return pages.select(
        F.lit("response").alias("warc_type"),
        record_id(F.lit("response"), F.col("page_id"), F.col("url")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.date_format(F.timestamp_seconds(F.coalesce("page_id", F.lit(0)) + 1_700_000_000), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"),
        headers.alias("http_headers"),
        F.col("html").alias("payload"),
        sha256(F.concat(headers, F.lit(CRLF + CRLF), payload)).alias("block_digest"),
        sha256(payload).alias("payload_digest"),
    )
