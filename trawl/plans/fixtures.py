"""Derived inputs built from the given tables, the same way as in the oracle SQL.

These only shape test-table rows into the schemas the operators expect
(queries, fetch logs, robots files, link graphs, page requests). They do none
of the operators' work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.sources.tables import benchmark_queries, read_table, spread, web_pages

# Inline query cases added to the benchmark queries (negative qids):
# repeats, punctuation, stop words with and without comma, mixed case, an
# unknown word and a blank query.
EXTRA_QUERIES = (
    (-1, "the the, THE and"),
    (-2, "Is is, IS; is"),
    (-3, "ouen: thon! anat?"),
    (-4, "zzqxunknownword"),
    (-5, ""),
    (-6, "  ,;:  "),
    (-7, "Reorea. Nd. nd nd,"),
)

# Page request parameters (blank, non-numeric, < 1, past the end).
PAGE_REQUESTS = ("1", "2", "0", "-1", "abc", "", "999", "+3", " 2", "1_0", "2147483647", "99999999999", "9" * 19, "9" * 25)


def search_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark texts as whole queries plus the inline cases."""
    cases = F.array(*[F.struct(F.lit(i).cast("bigint").alias("qid"), F.lit(q).alias("q")) for i, q in EXTRA_QUERIES])
    extra = spark.range(1).select(F.inline(cases))
    return benchmark_queries(spark, sf_dir).unionByName(extra)


def page_requests(queries: DataFrame) -> DataFrame:
    """Every query asked for each page parameter of ``PAGE_REQUESTS`` (a generator, not a join)."""
    return queries.select("qid", F.explode(F.array(*[F.lit(p) for p in PAGE_REQUESTS])).alias("page"))


def host_of(url: Column) -> Column:
    """Host (with port) of an absolute URL, '' when there is none."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)


def absolute_time(ts: Column) -> Column:
    """A TIMESTAMP_NTZ read as UTC, as an instant (watermarks need TIMESTAMP; no session-zone dependence)."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, ts))


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(url, ts, status)`` from ``events``: two events per URL, every tenth event a 404."""
    events = read_table(spark, sf_dir, "events")
    return events.select(
        F.concat(F.lit("https://crawl.example.org/p/"), F.floor(F.col("event_id") / 2).cast("bigint")).alias("url"),
        absolute_time(F.col("ts")).alias("ts"),
        F.when(F.col("event_id") % 10 == 0, F.lit(404)).otherwise(F.lit(200)).alias("status"),
    )


def fetched_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetch results ``(url, status, html)``: pages with every tenth page id answered 404."""
    pages = web_pages(spark, sf_dir)
    return pages.select(
        "url",
        F.when(F.col("page_id") % 10 == 0, F.lit(404)).otherwise(F.lit(200)).alias("status"),
        "html",
    )


# Robots.txt bodies (lines in order); a host gets one by its name's hash.
ROBOTS_BODIES = tuple(
    "\n".join(lines)
    for lines in (
        (
            "# robots for the test hosts",
            "User-agent: *",
            "Disallow: /en/",
            "Allow: /en/4*",
            "Disallow: /*.html$",
            "Crawl-delay: 2",
            "",
            "User-agent: other",
            "Disallow: /",
            "Crawl-delay: oops",
        ),
        ("user-agent: Trawl-Bot", "DISALLOW: /fr/", "crawl-delay: NaN", "Crawl-Delay: .5", "crawl-delay: 2d"),
        ("Disallow: /", "User-agent: someone", "Disallow: /", "no colon here", "Crawl-delay: 3"),
        ("User-agent: *", "Disallow:", "Allow: ", "Disallow: /de/*7$", "Disallow: /e\\E.n", "Crawl-delay: 1e1", "Crawl-delay: -1"),
    )
)


def robots_body(host: Column) -> Column:
    """One of ``ROBOTS_BODIES`` by the second hexadecimal digit of the host's md5."""
    digit = F.conv(F.substring(F.md5(host), 2, 1), 16, 10).cast("int")
    return F.element_at(F.array(*[F.lit(b) for b in ROBOTS_BODIES]), digit % len(ROBOTS_BODIES) + 1)


def robots_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(host, fetched_at, status, body)``: one robots file per distinct host of ``pages``.

    A fixed share of hosts (hash-chosen) answered 404, another share is 25 hours
    older than the rest (stale at the check time).
    """
    hosts = web_pages(spark, sf_dir).select(host_of(F.col("url")).alias("host")).distinct()
    h = F.substring(F.md5("host"), 1, 1)
    return hosts.select(
        "host",
        F.when(h == "1", F.to_timestamp(F.lit("2024-01-29 23:00:00")))
        .otherwise(F.to_timestamp(F.lit("2024-01-31 00:00:00")))
        .alias("fetched_at"),
        F.when(h == "2", F.lit(404)).otherwise(F.lit(200)).alias("status"),
        robots_body(F.col("host")).alias("body"),
    )


def reindex_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents re-sent under one URL per ``source``: ``(url, text, seq)`` with ``seq = doc_id``.

    Sources hold several documents, so a URL arrives several times with
    different contents: first-wins documents and last-wins postings apply.
    """
    docs = spread(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return docs.select(
        F.concat(F.lit("src:"), F.col("source")).alias("url"), "text", F.col("doc_id").alias("seq")
    )



# Href cases resolved against every page, beside the page's own links.
HREF_CASES = (
    "about.html",
    "/x/y",
    "../z",
    "?page=2",
    "//o.com/p",
    "mailto:a@b",
    "https://h.com",
    "/a.html?x=1",
    "/a.HTML",
    "#top",
    "",
    "/für",
    "/a b",
    "/a%20b",
    "/a%zz",
    ":foo",
    "1a:b",
    "HTTPS://Upper.example/X#frag",
    "https://user:pw@h.com/x",
    "https://h:abc/p",
    "https://h:8080/p",
    "http://[::1/p",
    "http://[::1]:8/p",
    "http://[::1]x/p",
)


def href_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(src, pos, href)``: each case of ``HREF_CASES`` on every page (pos -1, -2, ...)."""
    cases = F.array(*[F.struct(F.lit(-i - 1).cast("bigint").alias("pos"), F.lit(h).alias("href")) for i, h in enumerate(HREF_CASES)])
    return web_pages(spark, sf_dir).select(F.col("url").alias("src"), F.inline(cases))


def site_links(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, str]:
    """A crawlable site graph over ``pages``: ``(pages(url), links(src, href), seed)``.

    Per host, pages are numbered n = 0, 1, 2, ... by page_id, with links
    n -> 2n+1 and n -> 2n+2 where those pages exist, one link to the first page
    of the next host (in host order) and one to ``scheme://host/missing``. The
    seed is the first page of the host with most pages (ties by host).
    """
    from trawl.operators.sequence import number_rows

    pages = web_pages(spark, sf_dir).select("page_id", "url", host_of(F.col("url")).alias("host"))
    numbered = number_rows(pages, [F.col("page_id")], ["host"], name="n").withColumn("n", F.col("n") - 1)
    children = numbered.select(
        F.col("url").alias("src"), "host", F.explode(F.array(2 * F.col("n") + 1, 2 * F.col("n") + 2)).alias("n")
    )
    tree = children.join(numbered.select("host", "n", F.col("url").alias("href")), ["host", "n"]).select("src", "href")
    hosts = number_rows(pages.select("host").distinct(), [F.col("host")], name="hn")
    firsts = numbered.where(F.col("n") == 0).join(hosts, "host").select((F.col("hn") - 1).alias("hn"), F.col("url").alias("href"))
    cross = numbered.join(hosts, "host").join(firsts, "hn").select(F.col("url").alias("src"), "href")
    scheme = F.regexp_extract("url", r"^([A-Za-z][A-Za-z0-9+.\-]*)://", 1)
    missing = numbered.select(F.col("url").alias("src"), F.concat(scheme, F.lit("://"), "host", F.lit("/missing")).alias("href"))
    links = tree.unionByName(cross).unionByName(missing)
    top = pages.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.min_by("url", "page_id").alias("first"))
    seed = top.orderBy(F.desc("n"), "host").select("first").first()[0]
    return pages.select("url"), links, seed


# Markup that ends a tag or an anchor only for a careless reader.
ODD_START = """<a title="x>y" href="quoted.html">in</a><a-b href="own.html">custom</a-b><a href='one.html' title='p>q' lang=it's>in</a> """
ODD_PARAGRAPH = """<p title="a>b" lang='x > y' id=it's><a-card class="c>d">card</a-card> <title-bar>bar</title-bar> """


def odd_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` with quoted ``>``, stray quotes and custom elements in their markup."""
    html = F.concat(F.lit(ODD_START), F.replace(F.col("html"), F.lit("<p>"), F.lit(ODD_PARAGRAPH)))
    return web_pages(spark, sf_dir).withColumn("html", html)
