"""The reference's own test cases, as DataFrame tests."""

import math

from pyspark.sql import functions as F

from trawl.operators.indexing import Index
from trawl.operators.search import idf, search


def test_idf_table(spark):
    # name, matching documents, total documents, expected (tolerance 1e-4)
    cases = [
        ("half of documents", 2, 4, math.log(4 / 3) + 1),
        ("no documents", 0, 5, 0.0),
        ("all documents", 3, 3, math.log(3 / 4) + 1),
        ("rare term", 1, 100, math.log(100 / 2) + 1),
    ]
    df = spark.createDataFrame([(n, d, t) for n, d, t, _ in cases], "name STRING, df BIGINT, n BIGINT")
    got = dict(df.select("name", idf(F.col("df"), F.col("n")).alias("idf")).collect())
    for name, _, _, want in cases:
        assert abs(got[name] - want) < 1e-4, name


def _mock_index(spark, n_docs=5):
    postings = spark.createDataFrame(
        [("science", "doc1", 0.08), ("science", "doc2", 0.04), ("science", "doc3", 0.01),
         ("computer", "doc2", 0.06), ("computer", "doc1", 0.01)],
        "term STRING, url STRING, tf DOUBLE",
    )
    docs = spark.range(n_docs).select(F.concat(F.lit("doc"), (F.col("id") + 1).cast("string")).alias("url"))
    return Index(docs.select("url", F.lit(0).cast("bigint").alias("word_count")), postings)


def test_basic_ranking(spark):
    index = _mock_index(spark)
    queries = spark.createDataFrame([(1, "science"), (2, "computer")], "qid BIGINT, q STRING")
    top = {(r.qid, r.rank): r.url for r in search(index, queries, k=3).collect()}
    assert top[(1, 1)] == "doc1"
    assert top[(2, 1)] == "doc2"
    assert [top[(1, i)] for i in (1, 2, 3)] == ["doc1", "doc2", "doc3"]
