"""Page source split (S2), stop-list source (S1) and SQL functions (F1)."""

from pyspark.sql import functions as F

from trawl.functions.sqlfuncs import register_sql_functions
from trawl.functions.urls import clean_path, display_title, format_score, format_url
from trawl.sources.pages import split_fetches
from trawl.sources.stopwords import read_stop_words, stop_word_list


def test_split_fetches(spark):
    fetched = spark.createDataFrame(
        [("a", 200, "<p>x</p>", None), ("b", 404, None, None), ("c", 200, None, "URL disallowed by robots.txt: c")],
        "url STRING, status INT, html STRING, error STRING",
    )
    pages, errors = split_fetches(fetched)
    assert [r.url for r in pages.collect()] == ["a"]
    assert {r.url: r.error for r in errors.collect()} == {
        "b": "unexpected status code: 404",
        "c": "URL disallowed by robots.txt: c",
    }


def test_stop_list_source(spark, tmp_path):
    words = read_stop_words(spark)
    assert words.count() == 127 == len(stop_word_list())
    assert read_stop_words(spark, str(tmp_path / "missing.json")).count() == 0  # unreadable: empty
    bad = tmp_path / "bad.json"
    bad.write_text("{not json")
    assert read_stop_words(spark, str(bad)).count() == 0
    assert stop_word_list(spark, str(bad)) == ()
    good = tmp_path / "good.json"
    good.write_text('{"stopwords": ["x", "y", "x"]}')
    assert stop_word_list(spark, str(good)) == ("x", "y")


def test_sql_functions_equal_column_functions(spark):
    register_sql_functions(spark)
    urls = ["https://h.example/en/about-us_now.html", "https://h.example/", "http://x/a-b/c_d", ""]
    df = spark.createDataFrame([(u, i / 7) for i, u in enumerate(urls)], "url STRING, x DOUBLE")
    df.createOrReplaceTempView("t_urls")
    got = spark.sql(
        "SELECT url, format_url(url) f, display_title(url) d, clean_path(url) c, format_score(x) s FROM t_urls"
    ).collect()
    want = df.select(
        "url",
        format_url(F.col("url")).alias("f"),
        display_title(F.col("url")).alias("d"),
        clean_path(F.col("url")).alias("c"),
        format_score(F.col("x")).alias("s"),
    ).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
