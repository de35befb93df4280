"""Links: extraction, resolution, per-page counts and same-site reachability."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions import text as tx
from trawl.functions.urls import followed_link, link_extension, resolvable, resolve_link, resolved_host, url_host
from trawl.operators.indexing import Index, build_page_index
from trawl.operators.robots import robots_filter
from trawl.session import ensure_checkpoint_dir, scratch_path
from trawl.sources.pages import split_fetches

# The link-extraction patterns. Complete `<a ...>` tags in page
# order (the last one may be cut off), then the first href value (double-quoted,
# single-quoted or bare).
ANCHOR_TAG = rf"(?is)<a{tx.TAG_REST}"
HREF = r"""(?is)\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""


def _href_of(tag: Column) -> Column:
    value = F.concat(
        F.regexp_extract(tag, HREF, 1), F.regexp_extract(tag, HREF, 2), F.regexp_extract(tag, HREF, 3)
    )
    return tx.decode_entities(value)


def anchor_hrefs(pages: DataFrame) -> DataFrame:
    """L1: ``(src, pos, href)`` for every ``<a>`` tag outside comments and elements without markup; repeats kept."""
    body = F.regexp_replace("html", tx.OPAQUE, " ")
    tags = F.filter(F.regexp_extract_all(body, F.lit(ANCHOR_TAG), 0), lambda t: t.rlike(r"(?is)^<a[\s/].*>\z"))
    exploded = pages.select(F.col("url").alias("src"), F.posexplode(tags).alias("pos", "tag"))
    return exploded.select("src", F.col("pos").cast("bigint"), _href_of(F.col("tag")).alias("href"))


def extract_links(pages: DataFrame) -> DataFrame:
    """L1+L2+L3: hrefs that are followed: not blank, not ``#...``, extension '' or ``.html``."""
    return anchor_hrefs(pages).where(followed_link(F.col("href")))


def classify_links(pages: DataFrame) -> DataFrame:
    """L3 in detail: every non-blank, non-fragment href with its extension and the keep decision."""
    hrefs = anchor_hrefs(pages).where((F.col("href") != "") & ~F.col("href").startswith("#"))
    ext = link_extension(F.col("href"))
    return hrefs.select("src", "pos", "href", ext.alias("ext"), followed_link(F.col("href")).alias("keep"))


def resolved_links(pages: DataFrame) -> DataFrame:
    """L4+L5: followed links resolved against their page: ``(src, pos, href, url)``; url null if invalid."""
    links = extract_links(pages)
    return links.select("src", "pos", "href", resolve_link(F.col("src"), F.col("href")).alias("url"))


def same_host_links(links: DataFrame) -> DataFrame:
    """Resolved links whose host equals their page's host (exact, case-sensitive, with port).

    Decided from the link's parts (``resolvable``, ``resolved_host``), so the
    filter does not repeat the resolution expression of the ``url`` column.
    """
    src, href = F.col("src"), F.col("href")
    return links.where(resolvable(src, href) & (resolved_host(src, href) == url_host(src)))


def outlink_counts(links: DataFrame) -> DataFrame:
    """Per page, followed links, distinct resolved URLs and distinct same-host URLs.

    Counted over (page, URL) groups first, so no row is expanded for a second
    distinct count.
    """
    same = F.col("url").isNotNull() & (resolved_host(F.col("src"), F.col("href")) == url_host(F.col("src")))
    each = links.groupBy("src", "url").agg(F.count(F.lit(1)).alias("n"), F.bool_or(same).alias("same"))
    return each.groupBy("src").agg(
        F.sum("n").alias("n_links"), F.count("url").alias("n_urls"), F.count_if("same").alias("n_same_host")
    )


def crawl_reachable(pages: DataFrame, links: DataFrame, seed: str) -> DataFrame:
    """O1-O3 (J4, J8, L6): the URLs a same-site crawl from ``seed`` visits.

    ``pages(url)`` are the fetchable URLs, ``links(src, href)`` the hrefs found
    on them. Returns ``(url, depth, fetched)``: every URL reached through links
    on the seed's host, deduplicated on the exact resolved URL, with its BFS
    depth; a URL that is not a page is visited but not fetched and has no links.

    A semi-naive BFS, one write per round. The edges (resolved, filtered to
    the seed host and to fetched pages once) and the visited set live in
    tables bucketed on the join keys in the shared scratch folder, so a round
    moves only the new frontier: it is shuffled once to meet the edge buckets,
    and its deduplicated candidates already sit in the visited set's buckets
    for the anti-join. The visited table is also partitioned by depth: a round
    appends partition ``depth = d`` (the written table cuts the lineage) and
    the next round reads only that partition as its frontier. The loop ends
    at the fixpoint, when a round adds nothing.
    """
    spark = pages.sparkSession
    ensure_checkpoint_dir(spark)
    n_buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    seed_col = F.lit(seed)
    page_keys = pages.select(resolve_link(F.col("url"), F.col("url")).alias("url")).distinct()
    # J8 keys: links of a page are reachable from its resolved URL.
    # L6 from the link's parts, so the filter does not repeat the resolution.
    same_site = resolvable(F.col("src"), F.col("href")) & (
        resolved_host(F.col("src"), F.col("href")) == url_host(seed_col)
    )
    edges = (
        links.where(same_site)
        .select(
            resolve_link(F.col("src"), F.col("src")).alias("src"),
            resolve_link(F.col("src"), F.col("href")).alias("dst"),
        )
        .join(page_keys.withColumnRenamed("url", "src"), "src", "left_semi")  # only fetched pages have links
        .distinct()
    )
    edge_table, _ = _bucketed(edges, "src", n_buckets, "crawl_edges")
    seed_url = spark.range(1).select(resolve_link(seed_col, seed_col).alias("url"), F.lit(0).alias("depth"))
    visited_table, visited_path = _bucketed(seed_url, "url", n_buckets, "crawl_visited", partition="depth")
    try:
        depth = 0
        while True:  # until no new URL: as many rounds as the site is deep
            depth += 1
            visited = spark.table(visited_table)
            frontier = visited.where(F.col("depth") == depth - 1).select("url")
            edges_b = spark.table(edge_table)
            step = (
                frontier.join(edges_b, frontier["url"] == edges_b["src"])
                .select(F.col("dst").alias("url"))
                .distinct()
                .join(visited.select("url"), "url", "left_anti")  # J4 / O2
                .select("url", F.lit(depth).alias("depth"))
            )
            _append_bucketed(step, "url", n_buckets, visited_table, partition="depth")  # O1
            if spark.table(visited_table).where(F.col("depth") == depth).isEmpty():  # fixpoint (D5)
                break
    finally:
        # The files stay under the scratch folder, whose owner clears it; the catalogue keeps nothing, also after a failure.
        for table in (edge_table, visited_table):
            spark.sql(f"DROP TABLE IF EXISTS {table}")
    visited = spark.read.parquet(visited_path)
    return visited.join(page_keys.select("url", F.lit(True).alias("fetched")), "url", "left").select(
        "url", F.col("depth").cast("int"), F.coalesce("fetched", F.lit(False)).alias("fetched")
    )


def _bucketed(df: DataFrame, key: str, buckets: int, name: str, partition: str | None = None) -> tuple[str, str]:
    """Write ``df`` as a table bucketed on ``key`` under the shared scratch folder; returns its name and path."""
    path = scratch_path(df.sparkSession, name)
    table = f"trawl_{name}_{path.rsplit('-', 1)[-1]}"
    writer = df.write.bucketBy(buckets, key).mode("overwrite").option("path", path)
    (writer.partitionBy(partition) if partition else writer).saveAsTable(table)
    return table, path


def _append_bucketed(df: DataFrame, key: str, buckets: int, table: str, partition: str | None = None) -> None:
    writer = df.write.bucketBy(buckets, key).mode("append")
    (writer.partitionBy(partition) if partition else writer).saveAsTable(table)


def readable_pages(fetched: DataFrame, rules: DataFrame) -> DataFrame:
    """``(url, html)`` of the fetch results answered 200 and allowed by their host's rules."""
    pages, _ = split_fetches(fetched)
    allowed = robots_filter(pages.select("url").distinct(), rules).where("allowed").select("url")
    return pages.join(allowed, "url", "left_semi")


def crawl_index(
    fetched: DataFrame, links: DataFrame, seed: str, rules: DataFrame, *, stop_words: Sequence[str] | None = None
) -> tuple[DataFrame, Index]:
    """A crawl over given tables, from fetch results to an index: ``(visited(url, depth, fetched), index)``.

    ``fetched(url, status, html)`` are fetch results, ``links(src, href)`` the
    hrefs on them and ``rules`` parsed robots rules. Only pages answered 200 and
    allowed by their host's rules are read: links of any other URL are never
    followed, and only pages that the crawl reaches are indexed.
    """
    readable = readable_pages(fetched, rules)
    visited = crawl_reachable(readable.select("url"), links, seed)
    reached = visited.where("fetched").select(F.col("url").alias("r_url"))
    kept = readable.join(reached, resolve_link(F.col("url"), F.col("url")) == F.col("r_url"), "left_semi")
    return visited, build_page_index(kept, stop_words=stop_words)
