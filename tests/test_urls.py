"""Link filtering and resolution (L3-L6, K9) and display functions."""

from pyspark.sql import functions as F

from trawl.functions.urls import clean_path, display_title, followed_link, format_url, resolve_link

BASE = "https://h.example/dir/page.html"

RESOLVE = [
    ("about.html", "https://h.example/about.html"),  # root-relative, never joined to /dir/
    ("/x/y", "https://h.example/x/y"),
    ("../z", "https://h.example/../z"),  # no dot-segment removal
    ("?page=2", "https://h.example?page=2"),
    ("//o.com/p", "https://o.com/p"),
    ("mailto:a@b", "mailto:a@b"),  # opaque: kept
    ("https://h.com", "https://h.com"),
    ("/a.html?x=1", "https://h.example/a.html?x=1"),
    ("#top", "https://h.example"),
    ("", ""),
    ("/für", "https://h.example/f%C3%BCr"),
    ("/a b", "https://h.example/a%20b"),
    ("/a%20b", "https://h.example/a%20b"),
    ("/a%zz", None),  # bad escape: does not parse
    (":foo", None),
    ("1a:b", None),  # colon in a scheme-less first segment
    ("HTTPS://Upper.example/X#frag", "https://Upper.example/X"),  # scheme lower-cased, host kept
    ("/p#frag", "https://h.example/p"),
    ("https://u:pw@h.com/x", "https://u:pw@h.com/x"),
    ("https://h:abc/p", None),  # a port is a number
    ("https://h:8080/p", "https://h:8080/p"),
    ("https://h:/p", "https://h:/p"),
    ("http://[::1/p", None),  # a bracket that doesn't close
    ("http://[::1]:8/p", "http://[::1]:8/p"),
    ("http://[::1]x/p", None),
]


def test_host_leaves_user_information_out(spark):
    from trawl.operators.links import same_host_links

    src = "https://user:pw@h.example/a"
    links = spark.createDataFrame([(src, 0, "/b"), (src, 1, "https://h.example/c"), (src, 2, "https://x@o/d")], "src STRING, pos INT, href STRING")
    assert sorted(r.pos for r in same_host_links(links).collect()) == [0, 1]

EXTENSIONS = [
    ("/a?p=2", True),
    ("https://h.com", False),  # extension of the whole href: .com
    ("/a.html?x=1", False),
    ("/et.", False),
    ("/a.HTML", True),
    ("/x/y", True),
    ("about.html", True),
    ("#top", False),
    ("", False),
    ('/q.html"', True),
]


def test_resolve_link(spark):
    df = spark.createDataFrame([(BASE, h) for h, _ in RESOLVE], "base STRING, href STRING")
    got = [r[0] for r in df.select(resolve_link(F.col("base"), F.col("href"))).collect()]
    assert got == [want for _, want in RESOLVE]


def test_blank_base(spark):
    df = spark.createDataFrame([("", "/x")], "base STRING, href STRING")
    assert df.select(resolve_link(F.col("base"), F.col("href"))).first()[0] == ""


def test_followed_extensions(spark):
    df = spark.createDataFrame([(h,) for h, _ in EXTENSIONS], "href STRING")
    got = [r[0] for r in df.select(followed_link(F.col("href"))).collect()]
    assert got == [keep for _, keep in EXTENSIONS]


def test_display_functions(spark):
    urls = ["https://h.example/en/about-us_now.html", "https://h.example/", "https://h.example/ÉCOLE", "http://x/a", ""]
    df = spark.createDataFrame([(u,) for u in urls], "url STRING")
    out = df.select(format_url(F.col("url")), display_title(F.col("url")), clean_path(F.col("url"))).collect()
    assert [r[0] for r in out] == ["h.example/en/about-us_now.html", "h.example/", "h.example/ÉCOLE", "http://x/a", ""]
    assert [r[1] for r in out] == ["About Us Now", "H.example", "École", "A", ""]
    slug = out[0][2]
    assert slug.startswith("about-us-now-") and slug.rsplit("-", 1)[1].isdigit()
    again = df.select(clean_path(F.col("url"))).first()[0]
    assert again == slug  # one URL always gets the same slug (D7)


def test_resolved_host_and_resolvable_agree_with_resolution(spark):
    from trawl.functions.urls import resolvable, resolved_host, url_host

    df = spark.createDataFrame([(BASE, h) for h, _ in RESOLVE] + [("", "/x"), (BASE, None)], "base STRING, href STRING")
    url = resolve_link(F.col("base"), F.col("href"))
    rows = df.select(
        url.isNotNull().alias("a"), resolvable(F.col("base"), F.col("href")).alias("b"),
        url_host(url).alias("h1"), resolved_host(F.col("base"), F.col("href")).alias("h2"),
    ).collect()
    for r in rows:
        assert r.a == r.b
        if r.a:
            assert r.h1 == r.h2
