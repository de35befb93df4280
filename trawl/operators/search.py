"""Ranked keyword search by summed TF-IDF.

A query is a row ``(qid, q)``; a batch of queries is a DataFrame of them, so
one job answers many requests. Per query term ``t`` with multiplicity ``m``::

    idf(t)     = ln(N / (df(t) + 1)) + 1      (0 when df = 0)
    score(q,d) = sum over t of m * tf(t, d) * idf(t)

Postings are touched only through a join with the distinct query terms. Spark
chooses the join by the sizes it sees: few terms are sent to the postings where
they lie, many are shuffled, and a frequent term is split as a skewed key. The
matched postings are dealt by url before they meet the queries, so that one
posting travels once, however many queries have its term, and sums need no
second shuffle. An
index on disk carries its term statistics, so df is looked up and the postings
of the query terms are read once. Of an index of unresolved parts, the query
terms' postings are resolved before any statistic is taken.
"""

from __future__ import annotations

import re
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trawl.functions.text import Stemmer, clean_word, identity_stem, split_words
from trawl.functions.urls import clean_path, display_title, format_score, format_url
from trawl.operators.indexing import Index, document_frequency, last_wins_postings
from trawl.operators.sequence import number_rows
from trawl.session import materialize

RESULTS_PER_PAGE = 10


def query_terms(queries: DataFrame, stem: Stemmer = identity_stem) -> DataFrame:
    """P10: ``(qid, term, m)``: lower, split, trim, stem, drop empties; no stop filter, repeats add up."""
    tokens = queries.select("qid", F.explode(split_words(F.col("q"))).alias("token"))
    terms = tokens.where(F.col("token") != "").select("qid", stem(clean_word(F.col("token"))).alias("term"))
    return terms.where(F.col("term") != "").groupBy("qid", "term").agg(F.count(F.lit(1)).alias("m"))


def idf(df: Column, n_docs: Column) -> Column:
    """``ln(N/(df+1)) + 1``, 0 when the term is in no document."""
    return F.when(df == 0, F.lit(0.0)).otherwise(F.ln(n_docs.cast("double") / (df + 1)) + 1)


def _wanted(index: Index, terms: DataFrame) -> tuple[DataFrame, list[str]]:
    """The distinct terms and the join keys; on disk the bucket is one, so that other buckets are pruned."""
    wanted = terms.select("term").distinct()
    if not index.buckets:
        return wanted, ["term"]
    from trawl.sources.index_store import term_bucket

    return wanted.withColumn("term_bucket", term_bucket(F.col("term"), index.buckets)), ["term_bucket", "term"]


def term_lookup(index: Index, terms: DataFrame) -> DataFrame:
    """Postings of the given terms (inner join: absent terms contribute nothing).

    W1 is settled per (term, url), so an unresolved index is narrowed to the terms first.
    """
    wanted, keys = _wanted(index, terms)
    if not index.is_resolved:
        hits = index.postings.select("term", "url", "cnt", "word_count", "tf", "seq").join(wanted.select("term"), "term")
        return last_wins_postings(hits).select("term", "url", "tf")
    if index.stored is None:
        return index.postings.select(*keys, "url", "tf").join(wanted, keys).select("term", "url", "tf")
    alone, shared = (x.select(*keys, "url", "seq", "tf").join(wanted, keys).select("term", "url", "seq", "tf") for x in index.stored)
    return _by_url(alone).select("term", "url", "tf").unionByName(_newest(_by_url(shared)))


def _newest(dealt: DataFrame) -> DataFrame:
    """Of postings dealt by url, those of the highest ``seq`` of their (term, url), copies in one run summed.

    A null url is nobody's: its postings all stay.
    """
    of_run = dealt.groupBy("term", "url", "seq").agg(F.sum("tf").alias("tf"))
    nobody = F.when(F.col("url").isNull(), F.col("seq")).alias("_seq")
    return of_run.groupBy("term", "url", nobody).agg(F.max_by("tf", "seq").alias("tf")).select("term", "url", "tf")


def term_idf(index: Index, hits: DataFrame) -> DataFrame:
    """J2+J3+A5+A6: ``(term, df, n_docs, idf)`` for the matched terms, N as a scalar subquery."""
    n_docs = index.document_count()
    return document_frequency(hits).select(
        "term", "df", n_docs.alias("n_docs"), idf(F.col("df"), n_docs).alias("idf")
    )


def search_scores(index: Index, queries: DataFrame, stem: Stemmer = identity_stem) -> DataFrame:
    """``(qid, url, score)`` for every document matching at least one query term."""
    qt = query_terms(queries, stem)
    if index.terms is None:
        # df is counted from the hits, which are then read a second time
        hits = materialize(term_lookup(index, qt), "hits")
        idfs = term_idf(index, hits)
    else:
        hits, idfs = term_lookup(index, qt), stored_idf(index, qt)
    # written, so that Spark knows their size when it picks the join
    return _summed(hits if index.stored else _by_url(hits), materialize(_weights(qt, idfs), "weights"))


def _by_url(hits: DataFrame) -> DataFrame:
    """Postings dealt by url into as many partitions as the session's shuffles have."""
    return hits.repartition(int(hits.sparkSession.conf.get("spark.sql.shuffle.partitions")), "url")


def _weights(qt: DataFrame, idfs: DataFrame) -> DataFrame:
    """``(qid, term, w)`` with ``w = m * idf``."""
    return qt.join(idfs.select("term", "idf"), "term").select("qid", "term", (F.col("m") * F.col("idf")).alias("w"))


def _summed(hits: DataFrame, weights: DataFrame, name: str = "score") -> DataFrame:
    """``(qid, url, name)``: the weighted tf of hits that are dealt by url, summed."""
    scored = hits.join(weights, "term")
    return scored.groupBy("qid", "url").agg(F.sum(F.col("w") * F.col("tf")).alias(name))


def stored_idf(index: Index, qt: DataFrame) -> DataFrame:
    """J2+A6 from an index's stored term statistics: a bucket-pruned lookup, no postings read."""
    wanted, keys = _wanted(index, qt)
    n_docs = index.document_count()
    stats = index.terms.join(wanted, keys).select("term", "df", "max_tf")
    if index.term_parts > 1:
        stats = stats.groupBy("term").agg(F.sum("df").alias("df"), F.max("max_tf").alias("max_tf"))
    return stats.select("term", "df", n_docs.alias("n_docs"), idf(F.col("df"), n_docs).alias("idf"), "max_tf")


def scores_for_terms(index: Index, qt: DataFrame) -> DataFrame:
    """A7 from query terms ``(qid, term, m)``.

    The weights are joined to the query terms first, so the postings meet one
    table of ``(qid, term, m * idf)``.
    """
    hits = term_lookup(index, qt)
    idfs = stored_idf(index, qt) if index.terms is not None else term_idf(index, hits)
    scored = hits.join(_weights(qt, idfs), "term")
    return scored.groupBy("qid", "url").agg(F.sum(F.col("w") * F.col("tf")).alias("score"))


_ROUNDED = "_rounded_score"


def _rank_order(decimals: int | None) -> list[Column]:
    """Score descending, url ascending on ties; with ``decimals`` scores equal to so many digits are ties."""
    return [F.col("score" if decimals is None else _ROUNDED).desc(), F.col("url").asc()]


def _rankable(scores: DataFrame, decimals: int | None) -> DataFrame:
    """``scores`` with the rounded score as a column: a sort evaluates an expression anew for every comparison."""
    return scores if decimals is None else scores.withColumn(_ROUNDED, F.round("score", decimals))


def search_ranked(
    index: Index, queries: DataFrame, stem: Stemmer = identity_stem, decimals: int | None = None
) -> DataFrame:
    """Every match with its rank per query, score descending, url ascending on ties.

    Ranks are numbered by range partitioning, so a query matching a third of
    the collection is spread over many tasks rather than sorted in one.
    """
    # written, as range partitioning reads its input twice
    return _ranked(materialize(search_scores(index, queries, stem), "scores"), decimals)


def _ranked(scores: DataFrame, decimals: int | None) -> DataFrame:
    return number_rows(_rankable(scores, decimals), _rank_order(decimals), ["qid"], name="rank").select(
        "qid", F.col("rank").cast("bigint"), "url", "score"
    )


def search(
    index: Index,
    queries: DataFrame,
    k: int = RESULTS_PER_PAGE,
    stem: Stemmer = identity_stem,
    decimals: int | None = None,
) -> DataFrame:
    """T4 / F2: the top ``k`` results per query in one job.

    ``row_number() <= k`` lets Spark insert a partial WindowGroupLimit before
    the shuffle, so at most ``k`` rows per query and task travel.
    """
    scores = search_scores(index, queries, stem)
    w = Window.partitionBy("qid").orderBy(*_rank_order(decimals))
    return (
        _rankable(scores, decimals)
        .withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= k)
        .select("qid", F.col("rank").cast("bigint"), "url", "score")
    )


# Sums in another order differ by less than this share; a bound must not cut what rounding lifts over it.
_SUM_MARGIN = 1e-12


def bounded_terms(
    index: Index, queries: DataFrame, k: int = RESULTS_PER_PAGE, stem: Stemmer = identity_stem, decimals: int | None = None
) -> DataFrame:
    """``(qid, term, w, most, least, essential)``: what each query term can add to a score, and whether it must be looked up.

    ``most = w * max_tf`` bounds a term's share of any score. The postings of the
    query's strongest term alone give ``least``: at least ``k`` documents score
    that much. Terms in ascending order of ``most`` whose bounds together stay
    below ``least`` are not essential: no document with only such terms is among
    the top ``k``. A query's terms are bounded by its text, so the windows are small.
    """
    qt = query_terms(queries, stem)
    stats = stored_idf(index, qt).select("term", "idf", "max_tf")
    weights = qt.join(stats, "term").select("qid", "term", (F.col("m") * F.col("idf")).alias("w"), "max_tf")
    weights = weights.withColumn("most", F.col("w") * F.col("max_tf")).drop("max_tf")
    by_bound = Window.partitionBy("qid").orderBy(F.col("most").desc(), "term")
    strongest = weights.withColumn("n", F.row_number().over(by_bound)).where("n = 1").select("qid", "term", "w")
    alone = term_lookup(index, strongest).join(strongest, "term").select("qid", (F.col("w") * F.col("tf")).alias("s"))
    ranked = alone.withColumn("n", F.row_number().over(Window.partitionBy("qid").orderBy(F.col("s").desc())))
    kth = ranked.where(F.col("n") <= k).where(F.col("n") == k).select("qid", F.col("s").alias("least"))
    margin = F.lit(0.0 if decimals is None else 10.0**-decimals) + F.col("least") * _SUM_MARGIN
    least = weights.join(kth, "qid", "left").withColumn("least", F.coalesce(F.col("least") - margin, F.lit(0.0)))
    upto = Window.partitionBy("qid").orderBy("most", "term").rowsBetween(Window.unboundedPreceding, 0)
    return least.withColumn("essential", F.sum("most").over(upto) >= F.col("least"))


def search_bounded(
    index: Index,
    queries: DataFrame,
    k: int = RESULTS_PER_PAGE,
    stem: Stemmer = identity_stem,
    decimals: int | None = None,
) -> DataFrame:
    """T4 by upper bounds: the same rows as ``search``, from fewer scored postings.

    Documents come from the essential terms' postings. Those that could not
    reach the k-th score even with the largest share of all other terms are
    dropped before the other terms are looked up, for the remaining documents
    only. Needs an index with term statistics (read from disk).
    """
    if index.terms is None:
        raise ValueError("upper bounds need an index with stored term statistics")
    terms = materialize(bounded_terms(index, queries, k, stem, decimals), "bounded-terms")
    must, may = terms.where("essential"), terms.where("NOT essential").select("qid", "term", "w")
    may = materialize(may, "other-terms")
    rest = terms.groupBy("qid").agg(F.max("least").alias("least"), F.sum(F.when(~F.col("essential"), F.col("most")).otherwise(0.0)).alias("rest"))
    must = materialize(must.select("qid", "term", "w"), "essential-terms")
    rest = materialize(rest, "bounds")
    found = term_lookup(index, must)
    found = _summed(found if index.stored else _by_url(found), must, "part")
    kept = found.join(rest, "qid").where(F.col("part") + F.col("rest") >= F.col("least")).select("qid", "url", "part")
    kept = materialize(kept, "candidates")
    # the candidates' other terms: postings meet the queries that their url is a candidate of, and among those the ones with the term
    asked = _by_url(kept.select("qid", "url")).groupBy("url").agg(F.collect_list("qid").alias("qids"))
    more = _by_url(term_lookup(index, may)).join(asked, "url").join(may, "term").where(F.array_contains("qids", F.col("qid")))
    more = more.select("qid", "url", (F.col("w") * F.col("tf")).alias("part"))
    scores = kept.unionByName(more).groupBy("qid", "url").agg(F.sum("part").alias("score"))
    w = Window.partitionBy("qid").orderBy(*_rank_order(decimals))
    return _rankable(scores, decimals).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("qid", F.col("rank").cast("bigint"), "url", "score")


def search_one(index: Index, text: str, page: str | int | None = 1, stem: Stemmer = identity_stem) -> DataFrame:
    """one request - the page ``page`` of results for ``text`` (10 per page)."""
    from trawl.sources.index_store import postings_for

    index = index.resolved()
    spark = index.postings.sparkSession
    one = spark.range(1).select(F.lit(1).cast("bigint").alias("qid"), F.lit(text).alias("q"))
    # The request's own terms (bounded by its length) become literals, so only
    # their term buckets and row groups of the index are read.
    terms = query_terms(one, stem).select("term", "m").collect()
    literal = F.array(*[F.struct(F.lit(t).alias("term"), F.lit(m).alias("m")) for t, m in terms])
    pairs = F.inline(literal.cast("array<struct<term: string, m: bigint>>"))
    qt = spark.range(1).select(F.lit(1).cast("bigint").alias("qid"), pairs)
    narrowed = replace(index, postings=postings_for(index, [t for t, _ in terms]), rows=None, stored=None)
    scores = scores_for_terms(narrowed, qt)
    start = (page_number(page) - 1) * RESULTS_PER_PAGE
    order = _rank_order(None)
    if start + RESULTS_PER_PAGE < 1 << 31:
        # orderBy + offset + limit plans as TakeOrderedAndProject: a bounded top-k, no full sort.
        return scores.orderBy(*order).offset(start).limit(RESULTS_PER_PAGE).select("qid", "url", "score")
    far = _ranked(scores, None).where((F.col("rank") > start) & (F.col("rank") <= start + RESULTS_PER_PAGE))
    return far.orderBy("rank").select("qid", "url", "score")


_WHOLE_NUMBER = "^[+-]?[0-9]+$"
_MAX_LONG = (1 << 63) - 1


def page_number(page: str | int | None) -> int:
    """The request parameter as a page number: anything but a whole number from 1 to a long's largest means 1."""
    text = "" if page is None else str(page)
    n = int(text) if re.fullmatch("[+-]?[0-9]+", text) else 1
    return n if 1 <= n <= _MAX_LONG else 1


# --- T2 / T3: pages of results ---------------------------------------------


def parse_page(page: Column) -> Column:
    """``page_number`` as a Column, a BIGINT."""
    n = F.when(page.rlike(_WHOLE_NUMBER), page.try_cast("bigint"))
    return F.coalesce(F.when(n >= 1, n), F.lit(1).cast("bigint"))


def _start_index(page_no: Column) -> Column:
    """Results before a page; pages beyond a long's range start at its end."""
    return F.least(page_no - 1, F.lit(_MAX_LONG // RESULTS_PER_PAGE - 1)) * RESULTS_PER_PAGE


def result_page(ranked: DataFrame, requests: DataFrame) -> DataFrame:
    """The requested page of each query's ranked results; a page past the end is empty.

    ``ranked`` holds every rank (``search_ranked``), so no page is out of reach.
    The join is on (query, page), so each result meets only the requests that
    show it.
    """
    req = requests.select("qid", "page", parse_page(F.col("page")).alias("page_no"))
    paged = ranked.withColumn("page_no", F.floor((F.col("rank") - 1) / RESULTS_PER_PAGE).cast("bigint") + 1)
    return req.join(paged, ["qid", "page_no"])


def search_page(index: Index, queries: DataFrame, requests: DataFrame, decimals: int | None = None) -> DataFrame:
    """A result page as a user sees it: rank, URL, display URL, title, clean path, score text, total and paging.

    One row for each result shown; a request whose page is empty gives one row
    with null result columns.
    """
    scores = materialize(search_scores(index, queries), "scores")
    ranked = _ranked(scores, decimals)
    facts = paging_facts(scores, requests)
    shown = result_page(ranked, requests).select(
        "qid",
        "page",
        "rank",
        "url",
        format_url(F.col("url")).alias("display_url"),
        display_title(F.col("url")).alias("title"),
        clean_path(F.col("url")).alias("clean_path"),
        format_score(F.col("score")).alias("score"),
    )
    same = (F.col("f.qid") == F.col("s.qid")) & F.col("f.page").eqNullSafe(F.col("s.page"))
    return facts.alias("f").join(shown.alias("s"), same, "left").select(
        "f.qid", "f.page", "page_no", "rank", "url", "display_url", "title", "clean_path", "score",
        "total", "total_pages", "start_index", "end_index", "has_next", "has_prev", "page_range",
    )


def result_counts(results: DataFrame) -> DataFrame:
    """A10: number of results per query (of scored or ranked rows)."""
    return results.groupBy("qid").agg(F.count(F.lit(1)).alias("total"))


def paging_facts(results: DataFrame, requests: DataFrame) -> DataFrame:
    """Paging facts per request; the page range exists only when there is more than one page.

    ``results`` are the scored (or ranked) rows; only their count per query is used.
    """
    req = requests.select("qid", "page", parse_page(F.col("page")).alias("page_no"))
    totals = req.join(result_counts(results), "qid", "left").withColumn("total", F.coalesce("total", F.lit(0)))
    total_pages = F.floor((F.col("total") + RESULTS_PER_PAGE - 1) / RESULTS_PER_PAGE).cast("bigint")
    facts = totals.select(
        "qid",
        "page",
        "page_no",
        F.col("total").cast("bigint").alias("total"),
        total_pages.alias("total_pages"),
        _start_index(F.col("page_no")).alias("start_index"),
    )
    one = F.lit(1).cast("bigint")
    first = F.greatest(one, F.col("page_no") - 2)
    last = F.least(F.col("total_pages"), first + F.least(F.lit(4), F.lit(_MAX_LONG) - first))
    first = F.when(last - first < 4, F.greatest(one, last - 4)).otherwise(first)
    page_range = F.when(F.col("total_pages") > 1, F.array_join(F.sequence(first, last), ","))
    return facts.select(
        "*",
        F.least(F.col("start_index") + RESULTS_PER_PAGE, F.col("total")).alias("end_index"),
        (F.col("page_no") < F.col("total_pages")).alias("has_next"),
        (F.col("page_no") > 1).alias("has_prev"),
        page_range.alias("page_range"),
    )
