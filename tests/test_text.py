"""Extraction and tokenising: kept semantics K1-K3, K5, K8 and the HTML recipe."""

from pyspark.sql import functions as F

from trawl.functions.text import clean_word, html_text, tokenize
from trawl.operators import indexing as ix
from trawl.operators.search import query_terms


def words(spark, html):
    df = spark.createDataFrame([(html,)], "html STRING")
    return df.select(tokenize(html_text(F.col("html")))).first()[0]


def test_html_text_nodes_and_skips(spark):
    html = (
        "<html><head><title>My Title</title><style>p{x:1}</style>"
        "<script>var t=\"</p>\";go();</script></head><body>"
        "foo<b>bar</b> <a href='/x'>anchor words</a><!-- hidden comment -->"
        "<p>a&amp;b &copy;2024 x&middot;y &quot;q&quot;</p></body></html>"
    )
    got = words(spark, html)
    assert "my" in got and "title" in got  # title text is indexed (K8)
    assert "foo" in got and "bar" in got  # tags are word boundaries
    assert "anchor" not in got and "words" not in got  # anchor text is not (K8)
    assert "hidden" not in got and "p{x:1}" not in got  # comments, style skipped
    assert 'var' in got and 't="</p>";go();' in got  # script text raw
    assert "a&b" in got and "©2024" in got and "x·y" in got and '"q"' in got


def test_cut_off_page_and_unclosed_anchor(spark):
    assert words(spark, "<p>one two</p><a href='/z'>lost words") == ["one", "two"]
    assert words(spark, "<p>alpha</p><div class='x") == ["alpha"]
    assert words(spark, "<p>tail &am") == ["tail", "&am"]
    assert words(spark, "<p>tail &amp") == ["tail", "&"]


def test_unclosed_and_unmarked_elements(spark):
    assert words(spark, "<p>a</p><style>p{color:red} zz") == ["a"]
    assert words(spark, "y<!-- x <b>no</b> z") == ["y"]
    assert words(spark, "<p>k</p><script>a<b>c d") == ["k", "a<b>c", "d"]
    assert words(spark, "<!-- <script> -->rest<!-- </script> -->") == ["rest"]
    assert words(spark, "<title>T &lt;i></title><textarea><b>raw&amp;</b></textarea> end") == ["end", "t", "<i>", "<b>raw&</b>"]


def test_quoted_ends_and_custom_elements(spark):
    assert words(spark, "<p title='a>b'>c") == ["c"]
    assert words(spark, "one <a-card>two</a-card> three <p>four") == ["one", "two", "three", "four"]
    assert words(spark, "<p>a</p><p title=it's>b</p><p>words that don't vanish</p>") == ["a", "b", "words", "that", "don't", "vanish"]
    assert words(spark, '<a title="x>y" href="z.html">in</a> out <abbr title="q>r">s</abbr>') == ["out", "s"]
    assert words(spark, "<title-bar>t</title-bar><script-x>u</script-x><script src='a>b'>v</script>") == ["t", "u", "v"]
    many = "".join(f' a{i}="{i}>"' for i in range(300))  # a long cut-off tag is passed once
    assert words(spark, f"x <p{many}") == ["x"] and words(spark, f"x <a{many}") == ["x"]
    assert words(spark, "x <p " + "a=b " * 20_000 + "> y") == ["x", "y"]


def test_links_in_tags_with_quoted_ends(spark):
    from trawl.operators.links import anchor_hrefs

    html = """<a title="x>y" href="z.html">1</a><a-b href="no.html">2</a-b><A\nHREF='q>.html'>3</A><a href=it's.html>4</a><abbr href="n">5</abbr><a href="cut.html"""
    df = spark.createDataFrame([("u", html), ("v", '<a href="end">x'), ("w", '<a href="end"')], "url STRING, html STRING")
    got = [(r.src, r.href) for r in anchor_hrefs(df).orderBy("src", "pos").collect()]
    assert got[:3] == [("u", "z.html"), ("u", "q>.html"), ("u", "it")] and got[3:] == [("v", "end")]


def test_character_references(spark):
    page = "caf&eacute; it&#8217;s f&uuml;r a&mdash;b &#x41;&#128;&#0;&#xD800;&#99999999999; &notit; &amp;lt; &bogus; &copy2 1&lt"
    want = "café it’s für a—b a€\ufffd\ufffd\ufffd ¬it; &lt; &bogus; ©2 1<"
    assert words(spark, page) == want.split()


def test_unicode_whitespace_split(spark):
    df = spark.createDataFrame([("A b C\n\td  ",)], "t STRING")
    assert df.select(tokenize(F.col("t"))).first()[0] == ["a", "b", "c", "d"]


def test_stop_test_before_trim_and_empty_tokens(spark):
    # K1: "the" is dropped, "the," is kept and indexed as "the";
    # K2: "..." is counted in word_count but never indexed.
    docs = spark.createDataFrame([("u", "The the, cat ... cat!")], "url STRING, text STRING")
    index = ix.build_text_index(docs)
    assert index.documents.first()["word_count"] == 4
    post = {r.term: (r.cnt, r.tf) for r in index.postings.collect()}
    assert set(post) == {"the", "cat"}
    assert post["cat"] == (2, 0.5) and post["the"] == (1, 0.25)


def test_no_stemming_by_default(spark):
    docs = spark.createDataFrame([("u", "running runs ran")], "url STRING, text STRING")
    terms = {r.term for r in ix.build_text_index(docs).postings.collect()}
    assert terms == {"running", "runs", "ran"}  # K3


def test_clean_word(spark):
    df = spark.createDataFrame([("'Hello,!",), ("...",), ("a.b",)], "t STRING")
    assert [r[0] for r in df.select(clean_word(F.col("t"))).collect()] == ["hello", "", "a.b"]


def test_query_terms_repeats_and_no_stop_filter(spark):
    q = spark.createDataFrame([(1, "Foo foo, the THE; ..."), (2, "")], "qid BIGINT, q STRING")
    got = {(r.qid, r.term): r.m for r in query_terms(q).collect()}
    assert got == {(1, "foo"): 2, (1, "the"): 2}  # K4, K5; blank query has none


def test_tf_sums_property(spark):
    # tf of a document sums to (word_count - tokens that trim to '') / word_count
    from sf_dirs import SF001
    from trawl.sources.tables import text_documents

    index = ix.build_text_index(text_documents(spark, SF001))
    sums = index.postings.groupBy("url").agg(F.sum("tf").alias("s"), F.sum("cnt").alias("c"))
    joined = sums.join(index.documents, "url")
    for r in joined.collect():
        assert abs(r.s - r.c / r.word_count) < 1e-9
        assert r.c <= r.word_count
