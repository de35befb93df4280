"""Index parts, first/last wins, import, dictionary, grouped numbering."""

from pyspark.sql import functions as F

from trawl.operators import indexing as ix
from trawl.operators.sequence import number_rows
from trawl.sources import index_store as st


def test_first_and_last_wins(spark):
    log = spark.createDataFrame(
        [("u", "x x y", 2), ("u", "x z", 1), ("u", "x", 3), ("v", "y", 1)], "url STRING, text STRING, seq BIGINT"
    )
    index = ix.build_text_index(log, seq=F.col("seq"))
    docs = {r.url: (r.word_count, r.seq) for r in ix.first_wins_documents(index.documents).collect()}
    assert docs == {"u": (2, 1), "v": (1, 1)}  # INSERT OR IGNORE: the first one stays
    post = {(r.term, r.url): (r.tf, r.seq) for r in ix.last_wins_postings(index.postings).collect()}
    assert post == {("x", "u"): (1.0, 3), ("y", "u"): (1 / 3, 2), ("z", "u"): (0.5, 1), ("y", "v"): (1.0, 1)}


def test_import_adds_zero_word_documents(spark):
    base = ix.build_text_index(spark.createDataFrame([("u1", "x y")], "url STRING, text STRING"))
    nested = spark.createDataFrame(
        [({"x": {"u1": 0.9, "u9": 0.1}, "": {"u8": 1.0}},)], "index MAP<STRING, MAP<STRING, DOUBLE>>"
    )
    merged = ix.import_index(base, nested).resolved()
    docs = {r.url: r.word_count for r in merged.documents.collect()}
    assert docs == {"u1": 2, "u9": 0}  # the empty term is skipped, u8 never added
    tf = {(r.term, r.url): r.tf for r in merged.postings.collect()}
    assert tf[("x", "u1")] == 0.9 and tf[("x", "u9")] == 0.1 and tf[("y", "u1")] == 0.5


def test_add_documents_insert_or_ignore(spark):
    base = ix.build_text_index(spark.createDataFrame([("u1", "x y")], "url STRING, text STRING"))
    add = spark.createDataFrame(
        [("u1", 5, {"z": 5}, 1), ("u2", 1, {"x": 1, "": 3}, 1)], "url STRING, word_count BIGINT, word_map MAP<STRING,BIGINT>, seq BIGINT"
    )
    merged = ix.add_documents(base, add).resolved()
    assert {r.url: r.word_count for r in merged.documents.collect()} == {"u1": 2, "u2": 1}
    assert {(r.term, r.url) for r in merged.postings.collect()} == {("x", "u1"), ("y", "u1"), ("z", "u1"), ("x", "u2")}


def test_term_dictionary_dense(spark):
    post = spark.createDataFrame([(t, "u") for t in ["b", "a", "c", "a", "é", "B"]], "term STRING, url STRING")
    got = sorted((r.term_id, r.term) for r in ix.term_dictionary(post).collect())
    assert got == [(1, "B"), (2, "a"), (3, "b"), (4, "c"), (5, "é")]


def test_number_rows_with_a_hot_group(spark):
    hot = spark.range(3000).select(F.lit("hot").alias("g"), F.col("id").alias("o"))
    cold = spark.range(7).select(F.lit("cold").alias("g"), F.col("id").alias("o"))
    none = spark.range(2).select(F.lit(None).cast("string").alias("g"), F.col("id").alias("o"))
    df = hot.unionByName(cold).unionByName(none)
    out = number_rows(df, [F.col("o")], ["g"], name="rn", partitions=8)
    bad = out.where(F.col("rn") != F.col("o") + 1).count()
    assert bad == 0 and out.count() == 3009


def test_collection_stats(spark):
    index = ix.build_text_index(spark.createDataFrame([("u1", "x y x"), ("u2", "")], "url STRING, text STRING"))
    r = ix.collection_stats(index).first()
    assert (r.n_docs, r.n_words, r.n_empty_docs, r.n_postings, r.n_terms) == (2, 3, 1, 2, 2)


def test_number_rows_aqe_sized_ranges(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        hot = spark.range(5000).select((F.col("id") % 3).alias("g"), F.col("id").alias("o"))
        out = number_rows(hot, [F.col("o")], ["g"], name="rn")
        bad = out.where(F.col("rn") != (F.floor(F.col("o") / 3) + 1)).count()
        assert bad == 0 and out.count() == 5000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_number_rows_without_a_group(spark):
    df = spark.range(2000).select((F.col("id") * 7919 % 2000).alias("o"))
    out = number_rows(df, [F.col("o")], name="rn")
    assert out.where(F.col("rn") != F.col("o") + 1).count() == 0 and out.count() == 2000


def _scores(index, spark):
    from trawl.operators import search as se

    q = spark.createDataFrame([(1, "x y")], "qid BIGINT, q STRING")
    return {r.url: round(r.score, 12) for r in se.search_scores(index, q).collect()}


def test_appended_parts_on_disk_search_like_one_index(spark, tmp_path):
    import pytest

    from trawl.sources import index_store as st

    rows = [("u1", "x y"), ("u2", "x z"), ("u3", "z"), ("u4", "y y w")]
    def index(some, **kw):
        return ix.build_text_index(spark.createDataFrame(some, "url STRING, text STRING"), **kw)
    whole, path = _scores(index(rows), spark), str(tmp_path / "ix")
    st.write_index(index(rows[:2]), path, buckets=4)
    st.append_index(index(rows[2:]), path)
    st.append_index(index(rows[1:3], seq=F.lit(0)), path)  # again: nothing changes
    appended = st.open_index(spark, path)
    assert not appended.is_resolved and _scores(appended, spark) == whole
    compact = st.compact_index(appended, str(tmp_path / "one"), buckets=4)
    assert compact.is_resolved and _scores(compact, spark) == whole
    assert {r.term: r.df for r in compact.terms.collect()} == {"x": 2, "y": 2, "z": 2, "w": 1}
    st.append_index(index([("u1", "x x x w")]), path)  # a page sent again: last postings, first document
    again = st.open_index(spark, path).resolved()
    assert {r.url: r.word_count for r in again.documents.collect()}["u1"] == 2
    assert {(r.term, r.cnt) for r in again.postings.where("url = 'u1'").collect()} == {("x", 3), ("y", 1), ("w", 1)}
    with pytest.raises(ValueError):
        st.write_index(index(rows), path, buckets=4, mode="append")
    assert ix.export_nested(st.open_index(spark, path)).count() == 4


def test_a_term_is_in_few_files_of_its_bucket(spark, tmp_path):
    """Files hold disjoint ranges of terms, so a lookup opens only those with the term."""
    from trawl.sources import index_store as st

    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        text = spark.range(400).select(
            F.concat(F.lit("u"), F.col("id")).alias("url"),
            F.array_join(F.transform(F.sequence(F.lit(0), F.lit(40)), lambda i: F.concat(F.lit("w"), i * 37 + F.col("id") % 37)), " ").alias("text"),
        )
        path = str(tmp_path / "ix")
        st.write_index(ix.build_text_index(text), path, buckets=2)
        stored = spark.read.parquet(path).where("term_bucket >= 0").withColumn("file", F.input_file_name())
        spans = stored.groupBy("term_bucket", "file").agg(F.min("term").alias("a"), F.max("term").alias("b")).collect()
        assert len(spans) > 4
        for x in spans:
            for y in spans:
                if x.term_bucket == y.term_bucket and x.file < y.file:
                    assert x.b <= y.a or y.b <= x.a
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_an_appended_part_is_a_row_a_document(spark, tmp_path):
    """Postings of a part are unfolded when they are read; parts with tf of their own stay as they are."""
    path, schema = str(tmp_path / "index"), "url STRING, text STRING"
    st.write_index(ix.build_text_index(spark.createDataFrame([("a", "x y"), ("b", "x")], schema)), path, buckets=2)
    st.append_index(ix.build_text_index(spark.createDataFrame([("a", "x x z"), ("c", ""), (None, "z")], schema)), path)
    assert spark.read.parquet(f"{path}/_parts").count() == 3
    nested = spark.createDataFrame([({"y": {"b": 0.75}, "q": {"d": 0.5}},)], "index MAP<STRING, MAP<STRING, DOUBLE>>")
    empty = ix.build_text_index(spark.createDataFrame([], schema))
    st.append_index(ix.import_index(empty, nested).resolved(), path)
    st.append_index(empty, path)
    index = st.open_index(spark, path).resolved()
    assert {(r.url, r.word_count) for r in index.documents.collect()} == {("a", 2), ("b", 1), ("c", 0), (None, 1), ("d", 0)}
    found = {(r.term, r.url): round(r.tf, 9) for r in index.postings.collect()}
    assert found == {("x", "a"): round(2 / 3, 9), ("z", "a"): round(1 / 3, 9), ("y", "a"): 0.5, ("x", "b"): 1.0, ("z", None): 1.0, ("y", "b"): 0.75, ("q", "d"): 0.5}
