"""robots.txt rules."""

from pyspark.sql import functions as F

from trawl.operators import robots as rb

BODY = "\n".join([
    "# comment",
    "User-agent: *",
    "Disallow: /private/",
    "Allow: /private/ok*",
    "Disallow: /*.pdf$",
    "Crawl-delay: 3",
    "User-agent: badbot",
    "Disallow: /",
    "Crawl-delay: 10",
    "User-agent: Trawl-Crawler",
    "  disallow :  /only-us  ",
    "Crawl-delay: x",
    "Crawl-delay: 1.5",
    "no colon line",
    "Allow:",
])


def files(spark):
    return spark.createDataFrame(
        [("h", "2024-01-31 00:00:00", 200, BODY), ("gone", "2024-01-31 00:00:00", 404, BODY),
         ("old", "2024-01-01 00:00:00", 200, BODY), ("old", "2024-01-31 06:00:00", 200, "User-agent: *\nDisallow: /new")],
        "host STRING, fetched_at STRING, status INT, body STRING",
    ).withColumn("fetched_at", F.to_timestamp("fetched_at"))


def test_parse_rules_and_groups(spark):
    rules = rb.parse_robots(files(spark).where("host = 'h'"))
    got = sorted((r.kind, r.pattern) for r in rules.collect())
    # badbot's group does not apply; each user-agent line resets the flag
    assert got == [("allow", "/private/ok*"), ("disallow", "/*.pdf$"), ("disallow", "/only-us"), ("disallow", "/private/")]
    assert rules.where("host = 'gone'").count() == 0


def test_crawl_delay_last_valid_wins(spark):
    d = {r.host: r.delay_s for r in rb.crawl_delays(files(spark)).collect()}
    assert d["h"] == 1.5 and "gone" not in d


def test_crawl_delay_takes_plain_numbers_only(spark):
    values = ["NaN", "2d", "Infinity", "0x10", "1_0", "-3", "0", "+.5", "1e1"]
    body = lambda v: f"User-agent: *\nCrawl-delay: {v}"
    df = spark.createDataFrame([(v, "t", 200, body(v)) for v in values], "host STRING, fetched_at STRING, status INT, body STRING")
    assert {r.host: r.delay_s for r in rb.crawl_delays(df).collect()} == {"+.5": 0.5, "1e1": 10.0}


def test_filter(spark):
    rules = rb.parse_robots(files(spark).where("host = 'h'"))
    cases = [
        ("https://h/private/x", False),
        ("https://h/private/ok/1", True),  # any allow wins (K10)
        ("https://h/doc.pdf", False),
        ("https://h/doc.pdf?x=1", False),  # only the path is matched
        ("https://h/doc.pdfx", True),  # $ anchors the end
        ("https://h/only-us/more", False),  # prefix match
        ("https://h", True),  # blank path is /
        ("https://other/private/x", True),  # no rules for the host
        ("https://h/%zz", True),  # unparsable: allowed
        ("https://h/priv%61te/x", False),  # matched on the decoded path
    ]
    urls = spark.createDataFrame([(u,) for u, _ in cases], "url STRING")
    got = {r.url: r.allowed for r in rb.robots_filter(urls, rules).collect()}
    assert got == dict(cases)


def test_freshness(spark):
    fresh = rb.fresh_files(files(spark), F.to_timestamp(F.lit("2024-01-31 12:00:00")))
    got = {r.host: r.body for r in fresh.collect()}
    assert set(got) == {"h", "gone", "old"} and got["old"].endswith("/new")  # latest snapshot per host
    stale = rb.fresh_files(files(spark), F.to_timestamp(F.lit("2024-02-02 00:00:00")))
    assert stale.count() == 0  # older than 24 hours: no rules, allowed


def test_fetch_schedule(spark):
    urls = spark.createDataFrame([("https://h/a", 3), ("https://h/b", 1), ("https://z/c", 2)], "url STRING, ord INT")
    delays = spark.createDataFrame([("h", 2.0)], "host STRING, delay_s DOUBLE")
    got = {r.url: (r.n, r.offset_s) for r in rb.fetch_schedule(urls, delays).collect()}
    assert got == {"https://h/b": (1, 0.0), "https://h/a": (2, 2.0), "https://z/c": (1, 0.0)}


def test_pattern_metacharacters_are_literal(spark):
    body = "User-agent: *\nDisallow: /a+b(c)\nDisallow: /x.y$\nDisallow: /q?z\nDisallow: /w\\Ev\nDisallow: /[br]"
    files = spark.createDataFrame([("h", "2024-01-31 00:00:00", 200, body)], "host STRING, fetched_at STRING, status INT, body STRING")
    rules = rb.parse_robots(files.withColumn("fetched_at", F.to_timestamp("fetched_at")))
    cases = [
        ("https://h/a+b(c)/1", False),
        ("https://h/aab(c)", True),  # '+' is not a quantifier
        ("https://h/x.y", False),
        ("https://h/xzy", True),  # '.' is not any character
        ("https://h/x.y/z", True),  # '$' anchors the end
        ("https://h/q?z", True),  # the query is not part of the matched path
        ("https://h/w%5CEv", False),  # a literal backslash-E in the pattern
        ("https://h/[br]", False),
        ("https://h/b", True),
    ]
    urls = spark.createDataFrame([(u,) for u, _ in cases], "url STRING")
    got = {r.url: r.allowed for r in rb.robots_filter(urls, rules).collect()}
    assert got == dict(cases)
