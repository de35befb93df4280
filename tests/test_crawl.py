"""Same-site reachability (O1-O3, J4, J8, L6) against a brute-force walk."""

from trawl.operators.links import crawl_reachable


def test_crawl_small_graph(spark):
    pages = spark.createDataFrame([(u,) for u in ["https://s/a", "https://s/b", "https://s/c", "https://s/d", "https://o/x"]], "url STRING")
    links = spark.createDataFrame(
        [
            ("https://s/a", "/b"),
            ("https://s/a", "https://s/b#frag"),  # same URL once the fragment is gone
            ("https://s/b", "c"),
            ("https://s/c", "/a"),  # cycle
            ("https://s/b", "https://o/x"),  # other host: filtered
            ("https://s/c", "/missing"),  # not a page: visited, not fetched
            ("https://s/missing", "/d"),  # a URL that is not a page has no links
            ("https://s/d", "/a"),
        ],
        "src STRING, href STRING",
    )
    got = {(r.url, r.depth, r.fetched) for r in crawl_reachable(pages, links, "https://s/a").collect()}
    assert got == {
        ("https://s/a", 0, True),
        ("https://s/b", 1, True),
        ("https://s/c", 2, True),
        ("https://s/missing", 3, False),
    }


def test_crawl_matches_brute_force(spark):
    import random

    rnd = random.Random(7)
    n = 40
    urls = [f"https://s/p{i}" for i in range(n)]
    edges = [(urls[rnd.randrange(n)], f"/p{rnd.randrange(n + 5)}") for _ in range(80)]
    pages = spark.createDataFrame([(u,) for u in urls], "url STRING")
    links = spark.createDataFrame(edges, "src STRING, href STRING")
    got = {r.url: r.depth for r in crawl_reachable(pages, links, urls[0]).collect()}
    # brute force BFS
    adj = {}
    for s, h in edges:
        adj.setdefault(s, []).append("https://s" + h)
    depth = {urls[0]: 0}
    frontier = [urls[0]]
    while frontier:
        nxt = []
        for u in frontier:
            for v in adj.get(u, []) if u in set(urls) else []:
                if v not in depth:
                    depth[v] = depth[u] + 1
                    nxt.append(v)
        frontier = nxt
    assert got == depth


def test_crawl_index_reads_only_allowed_answered_and_reached_pages(spark):
    from trawl.operators.links import crawl_index
    from trawl.operators.robots import pattern_regex
    from pyspark.sql import functions as F

    pages = [("https://s/a", 200, "<p>one"), ("https://s/b", 200, "<p>two"), ("https://s/no/c", 200, "<p>three"),
             ("https://s/d", 404, None), ("https://s/e", 200, "<p>five"), ("https://s/f", 200, "<p>six")]
    fetched = spark.createDataFrame(pages, "url STRING, status INT, html STRING")
    links = spark.createDataFrame(
        [("https://s/a", "/b"), ("https://s/a", "/no/c"), ("https://s/no/c", "/e"), ("https://s/b", "/d"), ("https://s/d", "/f")],
        "src STRING, href STRING",
    )
    rules = spark.createDataFrame([("s", "disallow", "/no/")], "host STRING, kind STRING, p STRING").withColumn("regex", pattern_regex(F.col("p")))
    visited, index = crawl_index(fetched, links, "https://s/a", rules)
    got = {(r.url, r.depth, r.fetched) for r in visited.collect()}
    assert got == {("https://s/a", 0, True), ("https://s/b", 1, True), ("https://s/no/c", 1, False), ("https://s/d", 2, False)}
    assert {r.term for r in index.postings.collect()} == {"one", "two"}
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("trawl_crawl")]
