"""Registered queries: one per operator group of the survey, each ``(spark, sf_dir) -> DataFrame``.

Doubles are rounded to 6 decimals and counts cast to BIGINT at this layer
only, so the results compare exactly with the DuckDB oracle.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.functions.text import clean_word, html_text, is_stop_word, suffix_stem, tokenize
from trawl.operators import indexing as ix
from trawl.operators import search as se
from trawl.plans import fixtures as fx
from trawl.sources.stopwords import read_stop_words, stop_word_list
from trawl.sources.tables import text_documents, web_pages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def r6(col) -> F.Column:
    return F.round(col, 6)


def doc_index(spark: SparkSession, sf_dir: str, **kw) -> ix.Index:
    return ix.build_text_index(text_documents(spark, sf_dir), **kw)


# Indexes already written, by application, input and kind: built once, searched many times.
_WRITTEN: dict[tuple, str] = {}
TERM_BUCKETS = 16


def stored_index(spark: SparkSession, sf_dir: str, kind: str = "documents") -> ix.Index:
    """The ``documents`` index (or the one with stemmed terms) on disk, as searches read it."""
    key = (spark.sparkContext.applicationId, str(sf_dir), kind)
    if key not in _WRITTEN:
        path = scratch_path(spark, f"index-{kind}")
        built = doc_index(spark, sf_dir, stem=suffix_stem) if kind == "stemmed" else doc_index(spark, sf_dir)
        st.write_index(built, path, buckets=TERM_BUCKETS)
        _WRITTEN[key] = path
    return st.open_index(spark, _WRITTEN[key])


# Digits that rankings are compared by in these queries: engines add in other orders.
RANK_DECIMALS = 9


def page_index(spark: SparkSession, sf_dir: str, **kw) -> ix.Index:
    return ix.build_page_index(web_pages(spark, sf_dir), **kw)


# --- tokenising and cleaning ----------------------------------------------


@query
def stop_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1+P6: every stop word of the list file with its number of raw tokens in ``documents``."""
    words = read_stop_words(spark)
    tokens = text_documents(spark, sf_dir).select(F.explode(tokenize(F.col("text"))).alias("word"))
    hits = tokens.join(words, "word").groupBy("word").agg(F.count(F.lit(1)).alias("n_tokens"))
    return words.join(hits, "word", "left").select("word", F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"))


@query
def tokenize_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: per document, number of tokens, distinct tokens and token characters."""
    docs = text_documents(spark, sf_dir).select("doc_id", tokenize(F.col("text")).alias("toks"))
    return docs.select(
        "doc_id",
        F.size("toks").cast("bigint").alias("n_tokens"),
        F.size(F.array_distinct("toks")).cast("bigint").alias("n_distinct"),
        F.aggregate("toks", F.lit(0).cast("bigint"), lambda acc, t: acc + F.length(t)).alias("token_chars"),
    )


@query
def stopword_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document, tokens kept and dropped by the raw-token stop test (K1)."""
    stops = stop_word_list()
    toks = text_documents(spark, sf_dir).select("doc_id", F.explode(tokenize(F.col("text"))).alias("tok"))
    return toks.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_tokens"),
        F.count_if(~is_stop_word(F.col("tok"), stops)).alias("n_kept"),
        F.count_if(is_stop_word(F.col("tok"), stops)).alias("n_stop"),
    )


@query
def clean_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collection-wide count of each cleaned term of kept tokens (empty term included)."""
    analyzed = ix.analyze(text_documents(spark, sf_dir), F.col("text"))
    terms = analyzed.select(F.explode("kept").alias("tok")).select(clean_word(F.col("tok")).alias("term"))
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


@query
def html_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw token bag of every page's extracted text."""
    toks = web_pages(spark, sf_dir).select("url", F.explode(tokenize(html_text(F.col("html")))).alias("token"))
    return toks.groupBy("url", "token").agg(F.count(F.lit(1)).alias("cnt"))


@query
def query_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: query terms with multiplicity."""
    return se.query_terms(fx.search_queries(spark, sf_dir))


# --- index -----------------------------------------------------------------


@query
def term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: term count per page."""
    counts = ix.term_counts(ix.analyze(web_pages(spark, sf_dir), html_text(F.col("html"))))
    return counts.select("url", "term", "cnt")


@query
def word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: word_count per page, 0 for pages without kept tokens."""
    return page_index(spark, sf_dir).documents.select("url", "word_count")


@query
def term_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9+A3+J7: postings of the ``documents`` index with tf."""
    post = doc_index(spark, sf_dir).postings
    return post.select("term", "url", "cnt", "word_count", r6("tf").alias("tf"))


@query
def collection_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: sizes of the ``pages`` index."""
    return ix.collection_stats(page_index(spark, sf_dir))


@query
def document_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: documents per term in the ``pages`` index."""
    return ix.document_frequency(page_index(spark, sf_dir).postings)


@query
def idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2+J3+A6: df, N and idf of every term of the ``documents`` index."""
    index = doc_index(spark, sf_dir)
    out = se.term_idf(index, index.postings)
    return out.select("term", "df", "n_docs", r6("idf").alias("idf"))


# --- search ----------------------------------------------------------------


@query
def term_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings matched by each query's terms."""
    qt = materialize(se.query_terms(fx.search_queries(spark, sf_dir)), "query-terms")
    hits = se.term_lookup(stored_index(spark, sf_dir), qt)
    # rounded before one posting meets its many queries
    return qt.join(hits.withColumn("tf", r6("tf")), "term").select("qid", "term", "m", "url", "tf")


@query
def search_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summed TF-IDF per (query, document)."""
    out = se.search_scores(stored_index(spark, sf_dir), fx.search_queries(spark, sf_dir))
    return out.select("qid", "url", r6("score").alias("score"))


@query
def search_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All matches ranked per query."""
    out = se.search_ranked(stored_index(spark, sf_dir), fx.search_queries(spark, sf_dir), decimals=RANK_DECIMALS)
    return out.select("qid", "rank", "url", r6("score").alias("score"))


@query
def batch_search_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: top 10 per query for the whole query table in one job (the flagship)."""
    out = se.search(stored_index(spark, sf_dir), fx.search_queries(spark, sf_dir), k=10, decimals=RANK_DECIMALS)
    return out.select("qid", "rank", "url", r6("score").alias("score"))


@query
def stem_hook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 10 per query with a suffix stemmer applied on both index and query side."""
    index = stored_index(spark, sf_dir, "stemmed")
    out = se.search(index, fx.search_queries(spark, sf_dir), k=10, stem=suffix_stem, decimals=RANK_DECIMALS)
    return out.select("qid", "rank", "url", r6("score").alias("score"))


@query
def result_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2+U4+A10: the requested page of results per query, score formatted to 4 decimals."""
    queries = fx.search_queries(spark, sf_dir)
    ranked = se.search_ranked(stored_index(spark, sf_dir), queries, decimals=RANK_DECIMALS)
    page = se.result_page(ranked, fx.page_requests(queries))
    return page.select("qid", "page", "page_no", "rank", "url", F.format_string("%.4f", "score").alias("score"))


@query
def paging_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paging facts per (query, page request)."""
    queries = fx.search_queries(spark, sf_dir)
    # Paging needs only the number of results per query, not their order.
    scores = se.search_scores(stored_index(spark, sf_dir), queries)
    return se.paging_facts(scores, fx.page_requests(queries))


@query
def search_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2+T3+U1-U4: result pages as a user sees them, for every (query, page request)."""
    queries = fx.search_queries(spark, sf_dir)
    return se.search_page(stored_index(spark, sf_dir), queries, fx.page_requests(queries), decimals=RANK_DECIMALS)


def _grown(spark: SparkSession, *parts: ix.Index) -> str:
    """An index of runs, one for each part."""
    path = scratch_path(spark, "runs")
    rs.create(spark, path, buckets=TERM_BUCKETS)
    for part in parts:
        rs.append_run(part, path)
    return path


@query
def append_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3+S4+S6+A5: an index of runs - ``documents``, ``pages`` and the documents once more - searched without a recount."""
    path = _grown(spark, doc_index(spark, sf_dir), page_index(spark, sf_dir), doc_index(spark, sf_dir))
    out = se.search(rs.open_runs(spark, path), fx.search_queries(spark, sf_dir), k=10, decimals=RANK_DECIMALS)
    return out.select("qid", "rank", "url", r6("score").alias("score"))


@query
def append_parts_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3+S6+W1: the same appends as unresolved parts of one written index, resolved when searched."""
    path = scratch_path(spark, "appended-index")
    st.write_index(doc_index(spark, sf_dir), path, buckets=TERM_BUCKETS)
    st.append_index(page_index(spark, sf_dir), path)
    st.append_index(doc_index(spark, sf_dir), path)
    out = se.search(st.open_index(spark, path), fx.search_queries(spark, sf_dir), k=10, decimals=RANK_DECIMALS)
    return out.select("qid", "rank", "url", r6("score").alias("score"))


@query
def bounded_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4+A7: top 10 per query by upper bounds from the stored term statistics."""
    out = se.search_bounded(stored_index(spark, sf_dir), fx.search_queries(spark, sf_dir), k=10, decimals=RANK_DECIMALS)
    return out.select("qid", "rank", "url", r6("score").alias("score"))


@query
def append_term_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8+A9: term ids after the ``documents`` were indexed and the ``pages`` appended: old ids stay, new terms go on from them."""
    path = _grown(spark, doc_index(spark, sf_dir), page_index(spark, sf_dir))
    counts = rs.term_bridge(spark, path).groupBy("term_id").agg(F.count(F.lit(1)).alias("n_urls"))
    return rs.dictionary(spark, path).select("term_id", "term").join(counts, "term_id")


# --- links and URLs -----------------------------------------------------------

from trawl.functions import urls as ur  # noqa: E402
from trawl.operators import links as lk  # noqa: E402


@query
def extract_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1+L2: hrefs of every page in page order, blank and ``#`` ones dropped."""
    hrefs = lk.anchor_hrefs(web_pages(spark, sf_dir))
    return hrefs.where((F.col("href") != "") & ~F.col("href").startswith("#"))


@query
def odd_markup_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1-P5 on pages with quoted ``>``, stray quotes and custom elements."""
    toks = fx.odd_pages(spark, sf_dir).select("url", F.explode(tokenize(html_text(F.col("html")))).alias("token"))
    return toks.groupBy("url", "token").agg(F.count(F.lit(1)).alias("cnt"))


@query
def odd_markup_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1+L2 on the same pages."""
    hrefs = lk.anchor_hrefs(fx.odd_pages(spark, sf_dir))
    return hrefs.where((F.col("href") != "") & ~F.col("href").startswith("#"))


@query
def link_extension_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3: extension of each href and whether it is followed."""
    return lk.classify_links(web_pages(spark, sf_dir))


@query
def resolve_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4+L5: page links and the fixed href cases resolved against each page."""
    pages = web_pages(spark, sf_dir)
    hrefs = lk.extract_links(pages).unionByName(fx.href_cases(spark, sf_dir))
    return hrefs.select("src", "pos", "href", ur.resolve_link(F.col("src"), F.col("href")).alias("url"))


@query
def same_host_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolved links on their page's own host."""
    return lk.same_host_links(lk.resolved_links(web_pages(spark, sf_dir))).select("src", "pos", "url")


@query
def outlink_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Followed links, distinct URLs and distinct same-host URLs per page."""
    return lk.outlink_counts(lk.resolved_links(web_pages(spark, sf_dir)))


@query
def crawl_reachable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1-O3: URLs visited by a same-site crawl from the seed, with BFS depth and fetched flag."""
    pages, links, seed = fx.site_links(spark, sf_dir)
    return lk.crawl_reachable(pages, links, seed)


def _display_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page URLs and every resolved link URL, distinct."""
    pages = web_pages(spark, sf_dir)
    linked = lk.resolved_links(pages).where(F.col("url").isNotNull()).select("url")
    return pages.select("url").unionByName(linked).distinct()


@query
def url_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1+U2: display URL and title."""
    urls = _display_urls(spark, sf_dir)
    return urls.select("url", ur.format_url(F.col("url")).alias("display_url"), ur.display_title(F.col("url")).alias("title"))


@query
def url_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slug of each URL."""
    return _display_urls(spark, sf_dir).select("url", ur.clean_path(F.col("url")).alias("slug"))


@query
def resolve_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slugs of linked URLs looked up among the page slugs; a clash resolves to the lowest url."""
    pages = web_pages(spark, sf_dir)
    table = pages.select(ur.clean_path(F.col("url")).alias("slug"), "url").groupBy("slug").agg(F.min("url").alias("url"))
    linked = lk.resolved_links(pages).where(F.col("url").isNotNull())
    requests = linked.select(ur.clean_path(F.col("url")).alias("slug")).distinct()
    found = requests.join(table, "slug", "left")
    return found.select("slug", "url", F.col("url").isNotNull().alias("found"))


# --- robots ---------------------------------------------------------------------

from trawl.operators import robots as rb  # noqa: E402

# Fixed value: the time at which robots files are checked for freshness.
ROBOTS_AS_OF = "2024-01-31 12:00:00"


def _as_of() -> F.Column:
    return F.to_timestamp(F.lit(ROBOTS_AS_OF))


@query
def robots_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1+R2+W2: allow/disallow rules of every robots file, in the group of the user-agent above them."""
    rules = rb.parse_robots(fx.robots_files(spark, sf_dir))
    return rules.select("host", "line_no", "kind", "pattern", "regex")


@query
def robots_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawl delay per host (last valid value > 0 wins)."""
    return rb.crawl_delays(fx.robots_files(spark, sf_dir)).select("host", "delay_s")


@query
def robots_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R3+J5: page and link URLs checked against the fresh robots rules of their host."""
    rules = rb.parse_robots(rb.fresh_files(fx.robots_files(spark, sf_dir), _as_of()))
    return rb.robots_filter(_display_urls(spark, sf_dir), rules)


@query
def crawl_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2+R3+O1-O3+A2: pages answered 200, allowed by robots rules and reached from the seed, indexed."""
    _, links, _ = fx.site_links(spark, sf_dir)
    rules = rb.parse_robots(rb.fresh_files(fx.robots_files(spark, sf_dir), _as_of()))
    fetched = fx.fetched_pages(spark, sf_dir)
    # A seed that may be read: the first such page of the host that has most of them.
    readable = lk.readable_pages(fetched, rules).select("url").join(web_pages(spark, sf_dir).select("url", "page_id"), "url")
    sites = readable.groupBy(fx.host_of(F.col("url")).alias("host")).agg(F.count(F.lit(1)).alias("n"), F.min_by("url", "page_id").alias("first"))
    seed = sites.orderBy(F.desc("n"), "host").select("first").first()
    visited, index = lk.crawl_index(fetched, links, seed["first"] if seed else "", rules)
    sizes = _with_postings(index).select(F.col("url").alias("d_url"), "word_count", "n_postings")
    joined = visited.join(sizes, F.col("url") == ur.resolve_link(F.col("d_url"), F.col("d_url")), "left")
    return joined.select("url", "depth", "fetched", "word_count", "n_postings")


@query
def robots_fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per host, whether its latest robots file is fresh, with its delay and rule count when it is."""
    files = fx.robots_files(spark, sf_dir)
    fresh = rb.fresh_files(files, _as_of())
    delays = rb.crawl_delays(fresh).select("host", "delay_s")
    n_rules = rb.parse_robots(fresh).groupBy("host").agg(F.count(F.lit(1)).alias("n_rules"))
    hosts = files.select("host").distinct()
    out = hosts.join(fresh.select("host", "status", F.lit(True).alias("fresh")), "host", "left")
    out = out.join(delays, "host", "left").join(n_rules, "host", "left")
    return out.select(
        "host",
        F.coalesce("fresh", F.lit(False)).alias("fresh"),
        F.coalesce("delay_s", F.lit(0.0)).alias("delay_s"),
        F.coalesce("n_rules", F.lit(0)).cast("bigint").alias("n_rules"),
    )


@query
def fetch_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polite fetch offsets per host in page_id order, from the fresh crawl delays."""
    fresh = rb.fresh_files(fx.robots_files(spark, sf_dir), _as_of())
    urls = web_pages(spark, sf_dir).select("url", F.col("page_id").alias("ord"))
    return rb.fetch_schedule(urls, rb.crawl_delays(fresh).select("host", "delay_s"))


# --- sources, storage, appending ------------------------------------------------

from trawl.functions.sqlfuncs import register_sql_functions  # noqa: E402
from trawl.operators import reports as rp  # noqa: E402
from trawl.session import materialize, scratch_path  # noqa: E402
from trawl.sources import index_store as st  # noqa: E402
from trawl.sources import run_store as rs  # noqa: E402
from trawl.sources.pages import fetch_outcomes, split_fetches  # noqa: E402
from trawl.sources import warc_files as wf
from trawl.streaming import index_stream as xs  # noqa: E402
from trawl.streaming.stall_stream import stall_stream  # noqa: E402


@query
def page_source_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetch results split into pages (status 200) and error rows."""
    return fetch_outcomes(fx.fetched_pages(spark, sf_dir))


@query
def warc_fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 from crawl output: fetch results written as WARC response records, read back from the files and split."""
    path = scratch_path(spark, "warc")
    wf.write_fetches(fx.fetched_pages(spark, sf_dir), path)
    pages, errors = split_fetches(wf.read_fetches(spark, path))
    digest = pages.select("url", F.md5(F.col("html").cast("binary")).alias("html_md5"), F.lit(None).cast("string").alias("error"))
    return digest.unionByName(errors.select("url", F.lit(None).cast("string").alias("html_md5"), "error"))


@query
def index_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3+S4: the ``pages`` index written as bucketed Parquet and read back."""
    path = scratch_path(spark, "index")
    st.write_index(page_index(spark, sf_dir), path, buckets=TERM_BUCKETS)
    post = st.open_index(spark, path).postings
    return post.select("term", "url", "cnt", "word_count", r6("tf").alias("tf"))


def _with_postings(index: ix.Index) -> DataFrame:
    counts = index.postings.groupBy("url").agg(F.count(F.lit(1)).alias("n_postings"))
    return index.documents.join(counts, "url", "left").withColumn(
        "n_postings", F.coalesce("n_postings", F.lit(0)).cast("bigint")
    )


@query
def import_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5+O4: the ``documents`` and ``pages`` postings imported in nested map form into the ``pages`` index."""
    pages_ix = st.kept_index(page_index(spark, sf_dir))
    nested = ix.export_nested(doc_index(spark, sf_dir)).unionByName(ix.export_nested(pages_ix))
    # written, as the import reads it for its postings and for its URLs
    nested = materialize(nested, "nested-index")
    merged = ix.import_index(pages_ix, nested, seq=1).resolved()
    return _with_postings(merged).select("url", "word_count", "n_postings")


def _reindexed(spark: SparkSession, sf_dir: str) -> ix.Index:
    log = fx.reindex_log(spark, sf_dir)
    return ix.build_text_index(log, seq=F.col("seq"))


@query
def add_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-sent documents ``(url, word_count, word_map, seq)`` appended to the ``pages`` index."""
    part = _reindexed(spark, sf_dir)
    # a document's row has all its terms; written, as documents and postings are read from it
    maps = materialize(part.packed.select("url", "seq", "word_count", F.map_from_entries("terms").alias("word_map")), "word-maps")
    merged = ix.add_documents(st.kept_index(page_index(spark, sf_dir)), maps).resolved()
    return _with_postings(merged).select("url", "word_count", "seq", "n_postings")


@query
def first_wins_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One documents row per URL, the earliest ``seq`` winning."""
    return ix.first_wins_documents(_reindexed(spark, sf_dir).documents)


@query
def last_wins_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One posting per (term, url), the latest ``seq`` winning."""
    post = ix.last_wins_postings(_reindexed(spark, sf_dir).postings)
    return post.select("term", "url", "cnt", "word_count", r6("tf").alias("tf"), "seq")


@query
def term_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Term ids 1..n in term order over the ``documents`` index."""
    return ix.term_dictionary(stored_index(spark, sf_dir).terms)


@query
def term_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The (term_id, url) bridge of the ``pages`` index."""
    post = page_index(spark, sf_dir).postings
    return ix.term_key(post, ix.term_dictionary(post))


# --- reports ------------------------------------------------------------------


@query
def crawl_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visited, documents, errors, elapsed time and pages per second of the fetch log."""
    out = rp.crawl_report(fx.fetch_log(spark, sf_dir))
    return out.select(
        "visited", "documents", "errors", "fetches",
        r6("elapsed_s").alias("elapsed_s"), r6("ms_per_page").alias("ms_per_page"),
        r6("pages_per_second").alias("pages_per_second"),
    )


def _doc_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    carry = ("lang", "doc_id")
    analyzed = ix.analyze(text_documents(spark, sf_dir), F.col("text"), carry=carry)
    return rp.document_batches(ix.document_sizes(analyzed, carry), F.col("doc_id"), "lang")


@query
def document_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in batches of 150 in doc_id order per language (one language = one crawl)."""
    return _doc_batches(spark, sf_dir).select("url", "lang", F.col("n").cast("bigint"), "batch_id")


@query
def batch_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, postings and words per batch."""
    return rp.batch_report(_doc_batches(spark, sf_dir), "lang")


@query
def stall_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visited count at every 30-second tick of the fetch log, stalled ticks and the first one."""
    return rp.stall_ticks(fx.fetch_log(spark, sf_dir))


# --- streaming -----------------------------------------------------------------


# The arriving files are taken in so many micro-batches.
MICRO_BATCHES = 4
# How long a live crawl's tick stays open for fetches out of order, and how often its fetches arrive.
STALL_DELAY_SECONDS = 30
STALL_ARRIVALS = 2


def _landing_files(spark: SparkSession) -> int:
    """Files that stand for arriving data: as many as the session's shuffles have partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@query
def streaming_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1+X3: pages arriving in files indexed micro-batch by micro-batch, drained, then resolved."""
    base = scratch_path(spark, "stream-index")
    pages = web_pages(spark, sf_dir).select("url", "html")
    files = _landing_files(spark)
    landing = xs.land_files(pages, f"{base}/landing", files)
    stream = xs.file_stream(spark, landing, pages.schema, files_per_trigger=-(-files // MICRO_BATCHES))
    xs.index_stream(stream, f"{base}/index", f"{base}/checkpoint").awaitTermination()
    post = xs.read_streamed_index(spark, f"{base}/index").resolved().postings
    return post.select("term", "url", "cnt", "word_count", r6("tf").alias("tf"))


@query
def streaming_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1+X3+A5: pages arriving in files, each micro-batch committed as a run; searched as it stands after the last one."""
    base = scratch_path(spark, "stream-runs")
    pages = web_pages(spark, sf_dir).select("url", "html")
    files = _landing_files(spark)
    landing = xs.land_files(pages, f"{base}/landing", files)
    stream = xs.file_stream(spark, landing, pages.schema, files_per_trigger=-(-files // MICRO_BATCHES))
    xs.run_stream(stream, f"{base}/index", f"{base}/checkpoint", buckets=TERM_BUCKETS).awaitTermination()
    out = se.search(rs.open_runs(spark, f"{base}/index"), fx.search_queries(spark, sf_dir), k=10, decimals=RANK_DECIMALS)
    return out.select("qid", "rank", "url", r6("score").alias("score"))


def _fetch_stream(spark: SparkSession, sf_dir: str, base: str) -> DataFrame:
    log = fx.fetch_log(spark, sf_dir)
    files = _landing_files(spark)
    landing = xs.land_files(log, f"{base}/landing", files)
    return xs.file_stream(spark, landing, log.schema, files_per_trigger=-(-files // MICRO_BATCHES))


@query
def streaming_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visited set of a fetch stream, each URL once."""
    base = scratch_path(spark, "stream-dedupe")
    visited = xs.dedupe_stream(_fetch_stream(spark, sf_dir, base))
    xs.write_stream(visited, f"{base}/out", f"{base}/checkpoint", state=xs.ROCKSDB).awaitTermination()
    return spark.read.parquet(f"{base}/out").select("url")


@query
def streaming_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct URLs per 30-second window of a fetch stream (drained, complete mode)."""
    base = scratch_path(spark, "stream-progress")
    progress = xs.progress_stream(_fetch_stream(spark, sf_dir, base))
    xs.write_stream(progress, f"{base}/out", f"{base}/checkpoint", mode="complete").awaitTermination()
    out = spark.read.parquet(f"{base}/out")
    return out.select(F.unix_seconds("window.start").alias("window_start"), F.col("n_urls").cast("bigint"))


@query
def streaming_progress_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X4 with bounded state: per window, whether the sketch's count is within its stated error of the exact one."""
    base = scratch_path(spark, "stream-sketch")
    sketches = xs.progress_sketches(_fetch_stream(spark, sf_dir, base))
    xs.write_stream(sketches, f"{base}/out", f"{base}/checkpoint", mode="complete").awaitTermination()
    exact = fx.fetch_log(spark, sf_dir).groupBy(F.window("ts", xs.DEFAULT_TICK).alias("window")).agg(F.countDistinct("url").alias("n"))
    both = spark.read.parquet(f"{base}/out").join(exact, "window")
    near = F.abs(xs.sketch_count(F.col("sketch")) - F.col("n")) <= F.ceil(F.col("n") * 3 * xs.SKETCH_ERROR)
    return both.select(F.unix_seconds("window.start").alias("window_start"), near.alias("within_bound"))


@query
def streaming_stall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W6 live: ticks closed by timers while fetches arrive in order of time, the query restarted for each arrival."""
    base = scratch_path(spark, "stream-stall")
    log = fx.fetch_log(spark, sf_dir).select("url", "ts")
    start, end = log.agg(F.min("ts"), F.max("ts")).first()
    schema = log.schema
    cuts = [start + (end - start) * i / STALL_ARRIVALS for i in range(STALL_ARRIVALS)]
    # After the last fetch's tick is over, a heartbeat says that nothing more came.
    tick = timedelta(seconds=rp.TICK_SECONDS)
    over = start + tick * ((end - start) // tick + 1) + timedelta(seconds=STALL_DELAY_SECONDS + 1)
    heartbeat = spark.createDataFrame([(None, over)], schema)
    for i, cut in enumerate(cuts):
        came = log.where(F.col("ts") >= F.lit(cut))
        if i + 1 < len(cuts):
            came = came.where(F.col("ts") < F.lit(cuts[i + 1]))
        else:
            came = came.unionByName(heartbeat)
        came.write.mode("append").parquet(f"{base}/landing")
        stream = xs.file_stream(spark, f"{base}/landing", schema, files_per_trigger=None)
        ticks = stall_stream(stream, start, rp.TICK_SECONDS, f"{STALL_DELAY_SECONDS} seconds")
        xs.write_stream(ticks, f"{base}/out", f"{base}/checkpoint", state=xs.ROCKSDB).awaitTermination()
    return spark.read.parquet(f"{base}/out")


@query
def sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the display functions registered as SQL functions and used from ``spark.sql``."""
    register_sql_functions(spark)
    web_pages(spark, sf_dir).createOrReplaceTempView("trawl_pages")
    return spark.sql(
        """SELECT url, format_url(url) AS display_url, display_title(url) AS title, clean_path(url) AS slug,
                  format_score(CAST(length(html) AS DOUBLE) / 7) AS size_score
           FROM trawl_pages"""
    )
