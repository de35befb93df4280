"""Plan shape tests: the scale properties the design relies on, read from the physical plans."""

from pyspark.sql import functions as F

from sf_dirs import SF001
from trawl.operators import indexing as ix
from trawl.operators import search as se
from trawl.operators import robots as rb
from trawl.operators.links import _bucketed
from trawl.sources import index_store as st
from trawl.sources.tables import text_documents


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_term_counts_need_no_shuffle(spark):
    analyzed = ix.analyze(text_documents(spark, SF001).select("url", "text"), F.col("text"))
    p = plan(ix.term_counts(analyzed))
    # the only exchange is the input rebalancing of an under-split scan
    assert p.count("Exchange") <= 1 and "HashAggregate" not in p


def test_single_search_prunes_buckets_and_pushes_terms(spark, tmp_path):
    path = str(tmp_path / "ix")
    st.write_index(ix.build_text_index(text_documents(spark, SF001)), path, buckets=8)
    index = st.open_index(spark, path)
    df = se.search_one(index, "the quick thon", page=1)
    text = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    pruning = [line for line in text.splitlines() if "PartitionFilters" in line and "term_bucket" in line]
    assert pruning and all("INSET" in line or " IN (" in line for line in pruning[:1])
    assert "PushedFilters: [In(term" in text
    assert "SortMergeJoin" not in text


def test_batch_search_on_disk_uses_dynamic_pruning_and_broadcast(spark, tmp_path):
    path = str(tmp_path / "ix")
    st.write_index(ix.build_text_index(text_documents(spark, SF001)), path, buckets=8)
    index = st.open_index(spark, path)
    spark.createDataFrame([(1, "anat ouen"), (2, "thon the")], "qid BIGINT, q STRING").write.parquet(str(tmp_path / "q"))
    q = spark.read.parquet(str(tmp_path / "q"))
    text = se.search(index, q, k=10)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in text
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "WindowGroupLimit" in text  # top-k limited before the shuffle


def test_robots_join_keeps_the_host_key(spark):
    rules = spark.createDataFrame([("h", "disallow", "^\\Q/x\\E")], "host STRING, kind STRING, regex STRING")
    urls = spark.createDataFrame([("https://h/x",)], "url STRING")
    p = plan(rb.robots_filter(urls, rules))
    assert "NestedLoopJoin" not in p and ("HashJoin" in p or "SortMergeJoin" in p)


def test_crawl_round_does_not_shuffle_edges_or_visited(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        edges = spark.range(100).select(F.concat(F.lit("u"), F.col("id")).alias("src"), F.lit("u1").alias("dst"))
        et, _ = _bucketed(edges, "src", 8, "plan_edges")
        vt, _ = _bucketed(spark.range(3).select(F.concat(F.lit("u"), F.col("id")).alias("url")), "url", 8, "plan_vis")
        frontier = spark.range(2).select(F.concat(F.lit("u"), F.col("id")).alias("url"))
        e = spark.table(et)
        step = (
            frontier.join(e, frontier["url"] == e["src"]).select(F.col("dst").alias("url")).distinct()
            .join(spark.table(vt).select("url"), "url", "left_anti")
        )
        text = step._jdf.queryExecution().executedPlan().toString()
        # two exchanges at most: the frontier meeting the edge buckets and the candidates' distinct
        assert text.count("Exchange hashpartitioning") <= 2
        assert text.count("Bucketed: true") == 2 or "SelectedBucketsCount" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_numbering_and_counts_need_no_single_partition_sort_or_expand(spark):
    from trawl.operators import links as lk
    from trawl.operators import reports as rp
    from trawl.plans import fixtures as fx
    from trawl.sources.tables import web_pages

    index = ix.build_text_index(text_documents(spark, SF001))
    dictionary = ix.term_dictionary(index.postings)
    assert dictionary.select(F.max("term_id")).first()[0] == index.postings.select("term").distinct().count()
    for df in (lk.outlink_counts(lk.resolved_links(web_pages(spark, SF001))), rp.crawl_report(fx.fetch_log(spark, SF001))):
        assert "Expand" not in plan(df)
    assert "SortAggregate" not in plan(ix.last_wins_postings(index.postings))
    assert "SortAggregate" not in plan(ix.first_wins_documents(index.documents))
