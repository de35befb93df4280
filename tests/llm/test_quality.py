import zlib

import pytest
from helpers import SF, documents, odd_documents, table
from pyspark.sql import functions as F

from trawl.llm import quality as q
from trawl.llm.queries import QUERIES

SF1 = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def scored(spark):
    """The registered query's rows by id at sf0.01, with the labels."""
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in table(spark, "labels", sf).collect()}
    return QUERIES["op8_quality"](spark, sf).collect(), labels


def test_columns_and_held_out_rows(scored):
    rows, _ = scored
    assert len(rows) == 1000
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)


def test_held_out_accuracy(scored):
    rows, labels = scored
    held = [(r, labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert len(held) > 50
    assert sum(r["predicted"] == y for r, y in held) / len(held) >= 0.95
    kept = [r["predicted"] for r, y in held if y == 1]
    assert sum(kept) / len(kept) >= 0.97


def test_held_out_labels_change_nothing(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    flipped = labels.withColumn("quality", F.when(q.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert q.fit_on_kept_labels(docs, labels) == q.fit_on_kept_labels(docs, flipped)


def value(stats, model):
    """Score by plain evaluation of the rules."""
    import math

    total = model.intercept
    for rule, w in model.weights:
        if all((stats[n] > b) if above else (stats[n] <= b) for n, above, b in rule.terms):
            total += w
    return 1 / (1 + math.exp(-total))


def test_compiled_rules_equal_plain_evaluation(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    model = q.fit_on_kept_labels(docs, labels)
    assert model.weights
    got = docs.select(model.score(F.col("text")).alias("score"), q.statistics(F.col("text")).alias("s")).select("score", "s.*")
    for r in got.collect():
        assert abs(r["score"] - value(r.asDict(), model)) < 1e-12


def test_statistics_by_hand(spark):
    text = "One two two three.\nFOUR! https://x.y | 12\n\nOne two two three."
    r = documents(spark, [text]).select(q.statistics(F.col("text")).alias("s")).select("s.*").first()
    words = text.lower().split()
    assert r["distinct_words"] == len(set(words)) / len(words)
    assert r["capitals"] == sum(c.isupper() for c in text) / len(text)
    assert r["letters"] == sum(c.isalpha() for c in text) / len(text)
    assert r["words_a_line"] == len(words) / 3 and r["distinct_lines"] == 2 / 3 and r["open_lines"] == 1 / 3
    assert list(q.STATISTICS) == list(r.asDict())
    blank = documents(spark, [" \n"]).select(q.statistics(F.col("text")).alias("s")).select("s.*").first()
    assert blank["log_words"] == 0 and blank["letters"] == 0


def test_rules_are_the_paths_of_the_trees(spark):
    rows = [(float(i % 7 > 3), [float(i % 7), float(i % 5)]) for i in range(200)]
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    df = spark.createDataFrame(rows, "label double, f array<double>").select("label", array_to_vector("f").alias("features"))
    rules = q.tree_rules(GBTClassifier(maxDepth=2, maxIter=1, seed=1).fit(df), ("a", "b"))
    assert q.Rule((("a", True, 3.5),)) in rules and q.Rule((("a", False, 3.5),)) in rules
    assert q.simplified([("a", True, 1.0), ("b", False, 2.0), ("a", True, 3.0)]) == q.Rule((("a", True, 3.0), ("b", False, 2.0)))


def test_odd_rows(spark):
    docs = odd_documents(spark).withColumn("label", F.lit("x")).withColumn("score", F.lit(1))
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (3, 0), (3, 1), (5, None), (None, 1), (6, 1), (99, 0)], "doc_id bigint, quality int"
    )
    model = q.fit(docs, labels)
    got = docs.withColumn("s", model.score(F.col("text"))).collect()
    assert len(got) == docs.count() and all(0 <= r["s"] <= 1 for r in got)
    by_text = {r["text"]: r["s"] for r in got}
    assert by_text[None] == by_text[""]
    for one_class in (labels.where("quality = 1"), labels.limit(0)):
        model = q.fit(docs, one_class)
        assert not model.weights
        s = docs.select(model.score(F.col("text")).alias("s")).first()["s"]
        assert s == 0.5 if one_class.count() == 0 else s > 0.99
    assert docs.limit(0).withColumn("s", model.score(F.col("text"))).count() == 0
