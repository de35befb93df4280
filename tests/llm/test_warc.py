import hashlib
import html
from html.parser import HTMLParser

from helpers import SF, table
from pyspark.sql import functions as F

from trawl.llm import warc
from trawl.llm.queries import QUERIES

RESPONSE = (
    "warc_type string, record_id string, target_uri string, date string, http_headers string, payload string, "
    "block_digest string, payload_digest string, block string, page int"
)


class Plain(HTMLParser):
    """Words of a page by the standard library's parser."""

    HIDDEN = {"script", "style", "title", "noscript", "iframe", "template", "svg"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.words, self.hidden, self.links, self.title = [], 0, [], None
        self.parts = []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in self.HIDDEN
        if tag in warc._BREAKS:
            self.parts.append(" ")
        if tag == "a" and dict(attrs).get("href") is not None:
            self.links.append(dict(attrs)["href"])

    def handle_endtag(self, tag):
        self.hidden -= tag in self.HIDDEN and self.hidden > 0
        if tag in warc._BREAKS:
            self.parts.append(" ")

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)


def parse(record):
    """``(headers, block)`` of a serialised record."""
    head, block = record.split("\r\n\r\n", 1)
    first, *lines = head.split("\r\n")
    assert first == "WARC/1.1"
    return dict(x.split(": ", 1) for x in lines), block


def test_every_page_gives_two_linked_records(spark):
    rows = QUERIES["op2_warc_derivatives"](spark, SF).collect()
    sources = {r["record_id"]: r for r in warc.responses_from_pages(table(spark, "pages")).collect()}
    assert len(rows) == 2 * len(sources) and len({r["record_id"] for r in rows}) == len(rows)
    by_id = {r["record_id"]: r for r in rows}
    for r in rows:
        source, other = sources[r["refers_to"]], by_id[r["concurrent_to"]]
        assert other["refers_to"] == r["refers_to"] and {r["warc_type"], other["warc_type"]} == {"metadata", "conversion"}
        assert other["concurrent_to"] == r["record_id"]
        headers, block = parse(r["warc"])
        assert block == r["block"] and int(headers["Content-Length"]) == len(block.encode())
        assert headers["WARC-Block-Digest"] == "sha256:" + hashlib.sha256(block.encode()).hexdigest()
        assert headers["WARC-Refers-To"] == source["record_id"] and headers["WARC-Refers-To-Date"] == source["date"]
        assert headers["WARC-Refers-To-Target-URI"] == headers["WARC-Target-URI"] == source["target_uri"]
        if r["warc_type"] == "metadata":
            fields = [x.split(": ", 1) for x in block.split("\r\n") if x]
            have = dict(fields)
            assert have["source-payload-digest"] == source["payload_digest"] and have["source-block-digest"] == source["block_digest"]
            assert have["http-status"] == "HTTP/1.1 200 OK" and have["conversion"] == other["record_id"]
            assert have["text-digest"] == other["block_digest"]
            assert sum(k == "http-header" for k, _ in fields) == 2


def test_text_matches_the_standard_parser(spark):
    """Whole pages (those not cut off) have the same words, in the same order."""
    compared = 0
    for r in table(spark, "pages").collect():
        page = r["html"] or ""
        if not page.rstrip().endswith("</html>"):
            continue
        p = Plain()
        p.feed(page)
        p.close()
        title, lang, links, body = warc.page_text(page)
        if "<svg" in page or "<template" in page:
            continue
        assert body.split() == "".join(p.parts).split()
        assert links == [" ".join(x.split()) for x in p.links]
        compared += 1
    assert compared > 20


def test_pages_by_hand():
    page = (
        '<!DOCTYPE html><HTML lang="fr"><head><title>A &amp; B\n c</title><style>p{}</style></head><body>'
        '<p>caf&eacute; it&#8217;s<br>x<b>y</b> &lt;z&gt;<script>var a="</p>";</script>'
        "<a href='/u?a=1&amp;b=2'>link</a><a name=n>n</a><!-- <p>no</p> --><textarea><b>raw</b></textarea>"
        '<img alt="a>b">end<style>never closed'
    )
    title, lang, links, body = warc.page_text(page)
    assert (title, lang, links) == ("A & B c", "fr", ["/u?a=1&b=2"])
    assert body == "café it’s\nxy <z>linkn\n<b>raw</b>\nend"
    assert warc.page_text(None) == (None, None, [], "") and warc.page_text("a < b <3") == (None, None, [], "a < b <3")
    assert warc.page_text("one<!-- cut <p>off")[3] == "one"
    assert warc.page_text("&amp;lt;")[3] == html.unescape("&amp;lt;")


STRAY_QUOTES = [
    ("<p>a</p><p title=it's>b</p><p>clean words that don't vanish</p>", "a b clean words that don't vanish", []),
    ('<p>a</p><p title=5">b</p><p>the 6" pipe</p>', 'a b the 6" pipe', []),
    ("<p 'x>b</p><p>it's here</p>", "b it's here", []),
    ('<p class="a"">b</p><p>say "so"</p>', 'b say "so"', []),
    ("<a title=it's href=/u?x=1'>l</a><p>don't</p>", "l don't", ["/u?x=1'"]),
    ('<a href="/u" "title>l</a><a href = \'/v>"\' x>m</a>', "lm", ["/u", '/v>"']),
    ("<p>a</p><p title=it's>b</p>", "a b", []),
    ("<p alt=can't>only one quote", "only one quote", []),
    ("<script src=it's>var a='<p>no</p>';</script><p>don't</p>", "don't", []),
    ("<br/><img src=/a/b/><a href=/c/>l</a ' ><p>it's</p>", "l it's", ["/c/"]),
]


def test_stray_quotes_open_nothing():
    for page, words, links in STRAY_QUOTES:
        got = warc.page_text(page)
        assert (got[3].split(), got[2]) == (words.split(), links), page


def test_unclosed_quote_and_cut_off_tags():
    assert warc.page_text('<p>a</p><p title="never>b</p><p>c</p>')[3] == "a\nb\nc"
    assert warc.page_text('<p>a</p><a href="http://x/y z') == (None, None, [], "a")
    for cut in ("<p ", "<script ", '<p x="', "<script x='"):
        assert warc.page_text("one " + cut + "a=b' c " * 5_000)[3] == "one"


def odd(spark):
    rows = [
        ("response", "<a>", "http://x/", "2020-01-01T00:00:00Z", "HTTP/1.1 404 Not\r\nA: b\r\n", "<p>é\n\n</p>", "sha1:X", "sha1:Y", "z", 1),
        ("response", "<a>", "http://x/", "2020-01-01T00:00:00Z", "HTTP/1.1 404 Not\r\nA: b\r\n", "<p>é\n\n</p>", "sha1:X", "sha1:Y", "z", 1),
        ("response", None, None, None, None, None, None, None, None, None),
        ("response", "<b>", "u\r\nX-Evil: 1", "", "", "", "", "", "", 2),
        ("request", "<c>", "u", "d", "h", "p", "b", "d", "x", 3),
        (None, "<d>", "u", "d", "h", "p", "b", "d", "x", 3),
        ("response", "<e>", "long", "d", "h", "<p>word " * 100_000, "b", "d", "x", 3),
    ]
    return spark.createDataFrame(rows, RESPONSE)


def test_odd_rows(spark):
    rows = warc.derive(odd(spark)).collect()
    assert len(rows) == 10 and sorted({r["refers_to"] or "" for r in rows}) == ["", "<a>", "<b>", "<e>"]
    for r in rows:
        headers, block = parse(r["warc"])
        assert block == r["block"] and "X-Evil" not in headers
        assert ("WARC-Refers-To" in headers) == (r["refers_to"] is not None)
    (first,) = {r["block"] for r in rows if r["refers_to"] == "<a>" and r["warc_type"] == "conversion"}
    assert first == "é"
    assert warc.derive(odd(spark).limit(0)).count() == 0


def test_files_round_trip(spark, tmp_path):
    records = warc.derive(warc.responses_from_pages(table(spark, "pages").limit(20)))
    warc.write_warc(records, str(tmp_path / "out"), "none")
    raw = b"".join(p.read_bytes() for p in sorted((tmp_path / "out").glob("part-*")))
    got, at = [], 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        headers = dict(x.split(": ", 1) for x in raw[at:end].decode().split("\r\n")[1:])
        size = int(headers["Content-Length"])
        got.append((headers["WARC-Record-ID"], raw[end + 4 : end + 4 + size].decode()))
        at = end + 4 + size + 4
        assert raw[at - 4 : at] == b"\r\n\r\n"
    assert sorted(got) == sorted((r["record_id"], r["block"]) for r in records.collect())
