"""Ranking, paging and search invariants (T1-T4, D6, D8, property tests)."""

from pyspark.sql import functions as F

from trawl.operators import indexing as ix
from trawl.operators import search as se


def docs(spark):
    return spark.createDataFrame(
        [("u1", "apple banana apple"), ("u2", "banana cherry"), ("u0", "banana cherry"), ("u3", "date"), ("u4", "")],
        "url STRING, text STRING",
    )


def test_ties_broken_by_url(spark):
    index = ix.build_text_index(docs(spark))
    q = spark.createDataFrame([(1, "cherry")], "qid BIGINT, q STRING")
    got = [(r.rank, r.url) for r in se.search_ranked(index, q).orderBy("rank").collect()]
    assert got == [(1, "u0"), (2, "u2")]  # D6: equal scores, url ascending


def test_idf_uses_all_documents(spark):
    index = ix.build_text_index(docs(spark))  # 5 documents, one of them empty (K7)
    q = spark.createDataFrame([(1, "date")], "qid BIGINT, q STRING")
    score = se.search_scores(index, q).first().score
    import math

    assert abs(score - 1.0 * (math.log(5 / 2) + 1)) < 1e-12


def test_query_word_order_does_not_matter(spark):
    index = ix.build_text_index(docs(spark))
    q = spark.createDataFrame([(1, "apple banana cherry"), (2, "cherry apple banana")], "qid BIGINT, q STRING")
    s = {}
    for r in se.search_scores(index, q).collect():
        s.setdefault(r.url, {})[r.qid] = r.score
    assert all(abs(v[1] - v[2]) < 1e-9 for v in s.values())


def test_same_part_twice_leaves_search_unchanged(spark):
    part = ix.build_text_index(docs(spark))
    again = ix.build_text_index(docs(spark), seq=F.lit(1))
    doubled = ix.Index(
        part.documents.unionByName(again.documents), part.postings.unionByName(again.postings), is_resolved=False
    )
    q = spark.createDataFrame([(1, "banana cherry apple")], "qid BIGINT, q STRING")
    a = sorted((r.url, round(r.score, 12)) for r in se.search_scores(part, q).collect())
    b = sorted((r.url, round(r.score, 12)) for r in se.search_scores(doubled, q).collect())
    assert a == b


def test_result_page_and_paging_facts(spark):
    ranked = spark.range(1, 36).select(
        F.lit(1).cast("bigint").alias("qid"), F.col("id").alias("rank"),
        F.concat(F.lit("u"), F.col("id")).alias("url"), (1.0 / F.col("id")).alias("score"),
    )
    reqs = spark.createDataFrame([(1, p) for p in ["1", "4", "0", "-1", "abc", "", "9"]] + [(2, "1")], "qid BIGINT, page STRING")
    page = se.result_page(ranked, reqs)
    counts = {r.page: r["count"] for r in page.groupBy("page").count().collect()}
    assert counts == {"1": 10, "4": 5, "0": 10, "-1": 10, "abc": 10, "": 10}  # D8: page 9 is empty
    facts = {(r.qid, r.page): r for r in se.paging_facts(ranked, reqs).collect()}
    f = facts[(1, "4")]
    assert (f.total, f.total_pages, f.start_index, f.end_index, f.has_next, f.has_prev, f.page_range) == (
        35, 4, 30, 35, False, True, "1,2,3,4")
    assert facts[(1, "9")].page_range == "1,2,3,4"
    assert facts[(2, "1")].total == 0 and facts[(2, "1")].page_range is None


def test_page_range_window(spark):
    ranked = spark.range(1, 101).select(
        F.lit(1).cast("bigint").alias("qid"), F.col("id").alias("rank"), F.lit("u").alias("url"), F.lit(1.0).alias("score")
    )
    reqs = spark.createDataFrame([(1, p) for p in ["1", "5", "10"]], "qid BIGINT, page STRING")
    got = {r.page: r.page_range for r in se.paging_facts(ranked, reqs).collect()}
    assert got == {"1": "1,2,3,4,5", "5": "3,4,5,6,7", "10": "6,7,8,9,10"}


def test_search_one_on_disk_index(spark, tmp_path):
    from trawl.sources import index_store as st

    path = str(tmp_path / "ix")
    st.write_index(ix.build_text_index(docs(spark)), path, buckets=4)
    index = st.open_index(spark, path)
    assert index.buckets == 4 and index.documents.count() == 5
    first = se.search_one(index, "Banana, cherry", page=1).collect()
    assert [r.url for r in first] == ["u0", "u2", "u1"]
    assert se.search_one(index, "banana", page=2).count() == 0


def test_stored_term_statistics_match_postings(spark, tmp_path):
    from trawl.sources import index_store as st
    from sf_dirs import SF001
    from trawl.plans import fixtures as fx
    from trawl.sources.tables import text_documents

    built = ix.build_text_index(text_documents(spark, SF001))
    path = str(tmp_path / "ix")
    st.write_index(built, path, buckets=8)
    index = st.open_index(spark, path)
    counted = {r.term: r.df for r in ix.document_frequency(built.postings).collect()}
    stored = {r.term: r.df for r in index.terms.collect()}
    assert stored == counted
    queries = fx.search_queries(spark, SF001)
    a = sorted((r.qid, r.rank, r.url, round(r.score, 9)) for r in se.search(built, queries, k=10).collect())
    b = sorted((r.qid, r.rank, r.url, round(r.score, 9)) for r in se.search(index, queries, k=10).collect())
    assert a == b


def test_open_incomplete_index_fails_clearly(spark, tmp_path):
    import pytest

    from trawl.sources import index_store as st

    path = str(tmp_path / "half")
    ix.build_text_index(docs(spark)).rows.write.parquet(path)  # data without the commit marker
    with pytest.raises(FileNotFoundError):
        st.open_index(spark, path)


PAGES = ["1", "2", "0", "-1", "abc", "", None, " 3 ", "+4", "1_0", "３", "2147483648", "9" * 19, "9" * 25]
NUMBERS = [1, 2, 1, 1, 1, 1, 1, 1, 4, 1, 1, 2147483648, 1, 1]


def test_page_number_parsing(spark):
    assert [se.page_number(p) for p in PAGES] == NUMBERS and se.page_number(4) == 4
    df = spark.createDataFrame([(i, p) for i, p in enumerate(PAGES)], "i INT, page STRING").orderBy("i")
    assert [r[0] for r in df.select(se.parse_page(F.col("page"))).collect()] == NUMBERS


def test_far_pages_are_empty_and_never_fail(spark):
    ranked = spark.range(1, 36).select(
        F.lit(1).cast("bigint").alias("qid"), F.col("id").alias("rank"), F.lit("u").alias("url"), F.lit(1.0).alias("score")
    )
    pages = ["300000000", "2147483647", "99999999999", str(2**63 - 1), "1"]
    reqs = spark.createDataFrame([(1, p) for p in pages], "qid BIGINT, page STRING")
    assert {r.page for r in se.result_page(ranked, reqs).collect()} == {"1"}
    facts = {r.page: r for r in se.paging_facts(ranked, reqs).collect()}
    assert facts["99999999999"].start_index == 999999999980 and facts["99999999999"].end_index == 35
    assert facts[str(2**63 - 1)].page_range == "1,2,3,4" and not facts[str(2**63 - 1)].has_next


def test_requests_without_terms_or_far_away(spark, tmp_path):
    from trawl.sources import index_store as st

    path = str(tmp_path / "ix")
    st.write_index(ix.build_text_index(docs(spark)), path, buckets=4)
    for index in (ix.build_text_index(docs(spark)), st.open_index(spark, path)):
        assert se.search_one(index, "").collect() == [] and se.search_one(index, ",;").collect() == []
        for page in ("300000000", "99999999999", "x"):
            assert se.search_one(index, "banana", page=page).count() == (3 if page == "x" else 0)


def test_close_scores_rank_by_score(spark):
    postings = spark.createDataFrame([("x", "a", 0.5), ("x", "b", 0.5 + 1e-12)], "term STRING, url STRING, tf DOUBLE")
    index = ix.Index(spark.createDataFrame([("a", 1), ("b", 1)], "url STRING, word_count BIGINT"), postings)
    q = spark.createDataFrame([(1, "x")], "qid BIGINT, q STRING")
    assert [r.url for r in se.search_ranked(index, q).orderBy("rank").collect()] == ["b", "a"]
    assert [r.url for r in se.search_ranked(index, q, decimals=9).orderBy("rank").collect()] == ["a", "b"]


def test_search_page_shows_all_a_page_has(spark):
    index = ix.build_text_index(
        spark.createDataFrame([(f"https://h/a-{i:02d}.html", "x " + "y " * i) for i in range(12)], "url STRING, text STRING")
    )
    q = spark.createDataFrame([(1, "x"), (2, "nothing")], "qid BIGINT, q STRING")
    reqs = spark.createDataFrame([(1, "2"), (2, "1"), (1, None)], "qid BIGINT, page STRING")
    rows = se.search_page(index, q, reqs).orderBy("qid", "page", "rank").collect()
    second = [r for r in rows if r.qid == 1 and r.page == "2"]
    assert [r.rank for r in second] == [11, 12] and second[0].total == 12 and not second[0].has_next
    assert second[0].display_url == "h/a-10.html" and second[0].title == "A 10" and second[0].clean_path.startswith("a-10-")
    assert [(r.rank, r.total) for r in rows if r.qid == 2] == [(None, 0)]
    assert len([r for r in rows if r.page is None]) == 10
