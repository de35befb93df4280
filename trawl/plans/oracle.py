"""DuckDB SQL for each registered query: an independent statement of the same semantics.

Nothing of the functions and operators under test is imported: patterns, lists
and constants are stated here again, and character references come from the
standard library's table.

Written against the pre-registered views (``documents``, ``pages``, ``benchmark``,
``events``, ...). Regular expressions follow RE2: ``(?U)`` would mean
ungreedy there, so white space is spelt out as a class, and replacement needs
the ``'g'`` flag.
"""

from __future__ import annotations

import json
from html.entities import html5
from pathlib import Path

from trawl.plans import fixtures as fx

ORACLE: dict[str, str] = {}

TRIM_CHARS = ".,!?:;'"
SPLIT = r"[\s\x0b\x85\p{Z}]+"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


STOP_WORDS = json.loads((Path(__file__).parent.parent / "sources" / "stop_words.json").read_text())["stopwords"]


def stops_sql() -> str:
    return ", ".join(q(w) for w in STOP_WORDS)


# The rest of a start tag after its name: quoted values (right after "=") may hold ">".
IN_TAG = r"""(?:[^>]*?=\s*(?:"[^"]*"|'[^']*'))*[^>]*"""
TAG_END = r"(?:[\s/]" + IN_TAG + r")?(?:>|\z)"
# Comments and elements without markup, to their end or the page's.
UNREAD = "|".join(
    [
        r"<!--(?s:.)*?(?:-->|\z)",
        r"<script" + TAG_END + r"(?s:.)*?(?:</script\s*>|\z)",
        r"<style" + TAG_END + r"(?s:.)*?(?:</style\s*>|\z)",
        r"<textarea" + TAG_END + r"(?s:.)*?(?:</textarea\s*>|\z)",
        r"<title" + TAG_END + r"(?s:.)*?(?:</title\s*>|\z)",
    ]
)
LINKED = (r"(?is)<a" + TAG_END + r".*?(?:</a\s*>|\z)", r"<[/!?a-zA-Z]" + IN_TAG + r"(?:>|\z)")
REF = r"&(?:#[0-9]+;?|#[xX][0-9A-Fa-f]+;?|[A-Za-z][A-Za-z0-9]*;?)"
CP1252 = {128 + i: c for i, c in enumerate(bytes(range(128, 160)).decode("cp1252", "replace"))}


def _map_sql(pairs) -> str:
    keys, values = zip(*pairs)
    return f"MAP {{{', '.join(f'{k}: {v}' for k, v in zip(keys, values))}}}"


# One-row tables of names and of the numbers that mean windows-1252 characters.
REFERENCES = f"""
refs AS (SELECT {_map_sql((q(k), q(v)) for k, v in html5.items())} AS names,
                {_map_sql((k, q(v)) for k, v in CP1252.items())} AS old)"""
SHORT = "^(" + "|".join(sorted((k for k in html5 if k[-1] != ";"), key=len, reverse=True)) + ")"


def decode_sql(text: str) -> str:
    """References decoded; needs the one-row table ``refs`` in scope."""
    names, old = "refs.names", "refs.old"
    number = (
        "CASE WHEN starts_with(lower(r), '&#x') THEN TRY_CAST('0x' || regexp_extract(r, '^&#[xX]([0-9A-Fa-f]{1,8});?$', 1) AS BIGINT)"
        " ELSE TRY_CAST(regexp_extract(r, '^&#([0-9]+)', 1) AS BIGINT) END"
    )
    char = (
        f"CASE WHEN ({number}) IS NULL OR ({number}) <= 0 OR ({number}) > 1114111 OR ({number}) BETWEEN 55296 AND 57343 THEN chr(65533)"
        f" WHEN ({number}) BETWEEN 128 AND 159 THEN {old}[({number})] ELSE chr(CAST(({number}) AS INTEGER)) END"
    )
    named = (
        f"coalesce({names}[substr(r, 2)], {names}[regexp_extract(r[2:], {q(SHORT)}, 1)]"
        f" || substr(r, 2 + length(regexp_extract(r[2:], {q(SHORT)}, 1))), r)"
    )
    refs = f"regexp_extract_all({text}, {q(REF)})"
    decoded = f"list_transform({refs}, lambda r: CASE WHEN starts_with(r, '&#') THEN {char} ELSE {named} END)"
    gaps = f"string_split_regex({text}, {q(REF)})"
    return (
        f"(CASE WHEN contains({text}, '&') THEN array_to_string(list_transform(list_zip({gaps}, {decoded}),"
        f" lambda z: coalesce(z[1], '') || coalesce(z[2], '')), '') ELSE {text} END)"
    )


def visible_sql(col: str) -> str:
    body = f"regexp_replace({col}, {q('(?i)' + UNREAD)}, ' ', 'g')"
    for pat in LINKED:
        body = f"regexp_replace({body}, {q(pat)}, ' ', 'g')"
    return body


def inner_sql(col: str, names: str) -> str:
    """The text inside the elements ``names`` among the unread ones, joined by spaces."""
    pattern = rf"(?is)\A<(?:{names}){TAG_END}(.*?)(?:</(?:{names})\s*>)?\z"
    return (
        f"array_to_string(list_transform(regexp_extract_all({col}, {q('(?i)' + UNREAD)}),"
        f" lambda u: regexp_extract(u, {q(pattern)}, 1)), ' ')"
    )


def html_text_sql(col: str = "html") -> str:
    return f"({col}_text || ' ' || {inner_sql(col, 'script')})"


# Pages with their text before references are decoded, and after.
PAGE_TEXT = f"""
page_raw AS (SELECT *, {visible_sql('html')} || ' ' || {inner_sql('html', 'textarea|title')} AS raw FROM pages),
page_text AS (SELECT page_id, url, html, {decode_sql('raw')} AS html_text FROM page_raw, refs)"""


def tokens_sql(text: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({text}), {q(SPLIT)}), lambda x: x <> '')"


def clean_sql(tok: str) -> str:
    return f"lower(trim({tok}, {q(TRIM_CHARS)}))"


def suffix_stem_sql(term: str) -> str:
    return f"(CASE WHEN length({term}) > 4 THEN regexp_replace({term}, '(ing|ed|es|s)\\z', '') ELSE {term} END)"


DOC_SRC = "SELECT 'doc:' || CAST(doc_id AS VARCHAR) AS url, text FROM documents"
PAGE_SRC = f"SELECT url, {html_text_sql('html')} AS text FROM page_text"


def corpus(kind: str, src: str, stem=lambda t: t) -> str:
    """CTEs ``{kind}_src/_tok/_kept/_docs/_post`` for an index over ``src(url, text)``."""
    term = stem(clean_sql("tok"))
    before = f"{REFERENCES},{PAGE_TEXT}," if "page_text" in src else ""
    return f"""{before}
{kind}_src AS ({src}),
{kind}_tok AS (SELECT s.url, t.tok FROM {kind}_src s, unnest({tokens_sql('s.text')}) AS t(tok)),
{kind}_kept AS (SELECT url, tok FROM {kind}_tok WHERE tok NOT IN ({stops_sql()})),
{kind}_docs AS (
  SELECT s.url, CAST(coalesce(k.n, 0) AS BIGINT) AS word_count
  FROM {kind}_src s LEFT JOIN (SELECT url, count(*) AS n FROM {kind}_kept GROUP BY url) k ON k.url = s.url),
{kind}_post AS (
  SELECT c.term, c.url, c.cnt, d.word_count, c.cnt / d.word_count AS tf
  FROM (SELECT {term} AS term, url, CAST(count(*) AS BIGINT) AS cnt FROM {kind}_kept
        WHERE {term} <> '' GROUP BY 1, 2) c
  JOIN {kind}_docs d ON d.url = c.url)"""


def queries_sql() -> str:
    extra = ", ".join(f"({qid}, {q(text)})" for qid, text in fx.EXTRA_QUERIES)
    return f"""
qs AS (SELECT item_id AS qid, text AS q FROM benchmark
       UNION ALL SELECT * FROM (VALUES {extra}) v(qid, q))"""


def query_terms_sql(stem=lambda t: t) -> str:
    term = stem(clean_sql("t.tok"))
    return f"""
qt AS (
  SELECT qid, term, CAST(count(*) AS BIGINT) AS m FROM (
    SELECT qs.qid, {term} AS term
    FROM qs, unnest(regexp_split_to_array(lower(qs.q), {q(SPLIT)})) AS t(tok) WHERE t.tok <> '')
  WHERE term <> '' GROUP BY 1, 2)"""


def scores_sql(kind: str) -> str:
    return f"""
nd AS (SELECT count(*) AS n FROM {kind}_docs),
hits AS (SELECT p.term, p.url, p.tf FROM {kind}_post p WHERE p.term IN (SELECT term FROM qt)),
dfs AS (SELECT term, count(*) AS df FROM hits GROUP BY term),
idfs AS (SELECT term, CASE WHEN df = 0 THEN 0 ELSE ln((SELECT n FROM nd) / (df + 1)) + 1 END AS idf FROM dfs),
scores AS (
  SELECT qt.qid, h.url, sum(qt.m * h.tf * i.idf) AS score
  FROM hits h JOIN idfs i ON i.term = h.term JOIN qt ON qt.term = h.term GROUP BY 1, 2),
ranked AS (
  SELECT qid, url, score,
         row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, url) AS rank
  FROM scores)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in ctes) + "\n"


def register(name: str, sql: str) -> None:
    ORACLE[name] = sql.strip()


STOP_VALUES = lambda: ", ".join(f"({q(w)})" for w in STOP_WORDS)

register("stop_words", f"""
WITH words AS (SELECT DISTINCT w AS word FROM (VALUES {STOP_VALUES()}) v(w)),
toks AS (SELECT t.tok FROM documents d, unnest({tokens_sql('d.text')}) AS t(tok))
SELECT w.word, CAST(count(t.tok) AS BIGINT) AS n_tokens
FROM words w LEFT JOIN toks t ON t.tok = w.word GROUP BY w.word
""")

register("tokenize_documents", f"""
SELECT doc_id, CAST(len(toks) AS BIGINT) AS n_tokens,
       CAST(len(list_distinct(toks)) AS BIGINT) AS n_distinct,
       CAST(coalesce(list_sum(list_transform(toks, lambda t: length(t))), 0) AS BIGINT) AS token_chars
FROM (SELECT doc_id, {tokens_sql('text')} AS toks FROM documents)
""")

register("stopword_filter", f"""
SELECT d.doc_id, CAST(count(*) AS BIGINT) AS n_tokens,
       CAST(count(*) FILTER (WHERE t.tok NOT IN ({stops_sql()})) AS BIGINT) AS n_kept,
       CAST(count(*) FILTER (WHERE t.tok IN ({stops_sql()})) AS BIGINT) AS n_stop
FROM documents d, unnest({tokens_sql('d.text')}) AS t(tok) GROUP BY d.doc_id
""")

register("clean_terms", with_(corpus("doc", DOC_SRC)) + f"""
SELECT {clean_sql('tok')} AS term, CAST(count(*) AS BIGINT) AS n FROM doc_kept GROUP BY 1
""")

register("html_words", with_(corpus("page", PAGE_SRC)) + "SELECT url, tok AS token, CAST(count(*) AS BIGINT) AS cnt FROM page_tok GROUP BY 1, 2")

register("query_terms", with_(queries_sql(), query_terms_sql()) + "SELECT qid, term, m FROM qt")

register("term_counts", with_(corpus("page", PAGE_SRC)) + "SELECT url, term, cnt FROM page_post")

register("word_counts", with_(corpus("page", PAGE_SRC)) + "SELECT url, word_count FROM page_docs")

register("term_frequency", with_(corpus("doc", DOC_SRC)) + """
SELECT term, url, cnt, word_count, round(tf, 6) AS tf FROM doc_post
""")

register("collection_stats", with_(corpus("page", PAGE_SRC)) + """
SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(word_count) AS BIGINT) AS n_words,
       CAST(count(*) FILTER (WHERE word_count = 0) AS BIGINT) AS n_empty_docs,
       (SELECT CAST(count(*) AS BIGINT) FROM page_post) AS n_postings,
       (SELECT CAST(count(DISTINCT term) AS BIGINT) FROM page_post) AS n_terms
FROM page_docs
""")

register("document_frequency", with_(corpus("page", PAGE_SRC)) + """
SELECT term, CAST(count(*) AS BIGINT) AS df FROM page_post GROUP BY term
""")

register("idf", with_(corpus("doc", DOC_SRC)) + """
SELECT term, df, n_docs, round(ln(n_docs / (df + 1)) + 1, 6) AS idf
FROM (SELECT term, CAST(count(*) AS BIGINT) AS df, (SELECT CAST(count(*) AS BIGINT) FROM doc_docs) AS n_docs
      FROM doc_post GROUP BY term)
""")

register("term_lookup", with_(corpus("doc", DOC_SRC), queries_sql(), query_terms_sql()) + """
SELECT qt.qid, qt.term, qt.m, p.url, round(p.tf, 6) AS tf FROM qt JOIN doc_post p ON p.term = qt.term
""")

register("search_scores", with_(corpus("doc", DOC_SRC), queries_sql(), query_terms_sql(), scores_sql("doc")) + """
SELECT qid, url, round(score, 6) AS score FROM scores
""")

register("search_ranked", with_(corpus("doc", DOC_SRC), queries_sql(), query_terms_sql(), scores_sql("doc")) + """
SELECT qid, CAST(rank AS BIGINT) AS rank, url, round(score, 6) AS score FROM ranked
""")

register("batch_search_topk", with_(corpus("doc", DOC_SRC), queries_sql(), query_terms_sql(), scores_sql("doc")) + """
SELECT qid, CAST(rank AS BIGINT) AS rank, url, round(score, 6) AS score FROM ranked WHERE rank <= 10
""")

register(
    "stem_hook",
    with_(corpus("doc", DOC_SRC, stem=suffix_stem_sql), queries_sql(), query_terms_sql(stem=suffix_stem_sql), scores_sql("doc"))
    + """
SELECT qid, CAST(rank AS BIGINT) AS rank, url, round(score, 6) AS score FROM ranked WHERE rank <= 10
""",
)


def page_requests_sql() -> str:
    pages = ", ".join(q(p) for p in fx.PAGE_REQUESTS)
    number = "CASE WHEN regexp_full_match(page, '[+-]?[0-9]+') THEN TRY_CAST(page AS BIGINT) END"
    return f"""
reqs AS (
  SELECT qid, page, CASE WHEN ({number}) >= 1 THEN ({number}) ELSE 1 END AS page_no
  FROM qs, unnest([{pages}]) AS r(page)),
facts0 AS (
  SELECT r.qid, r.page, r.page_no, CAST(coalesce(c.total, 0) AS BIGINT) AS total,
         CAST((coalesce(c.total, 0) + 9) // 10 AS BIGINT) AS total_pages,
         CAST(least(CAST(r.page_no AS HUGEINT) - 1, 922337203685477579) * 10 AS BIGINT) AS start_index
  FROM reqs r LEFT JOIN (SELECT qid, count(*) AS total FROM ranked GROUP BY qid) c ON c.qid = r.qid),
rng AS (
  SELECT *, least(total_pages, greatest(1, CAST(page_no AS HUGEINT) - 2) + 4) AS last_p FROM facts0),
rng2 AS (
  SELECT *, CASE WHEN last_p - greatest(1, page_no - 2) < 4 THEN greatest(1, last_p - 4)
                 ELSE greatest(1, page_no - 2) END AS first_p FROM rng),
paging AS (
  SELECT qid, page, page_no, total, total_pages, start_index,
         CAST(least(CAST(start_index AS HUGEINT) + 10, total) AS BIGINT) AS end_index,
         page_no < total_pages AS has_next, page_no > 1 AS has_prev,
         CASE WHEN total_pages > 1 THEN array_to_string(range(CAST(first_p AS BIGINT), CAST(last_p AS BIGINT) + 1), ',')
         END AS page_range
  FROM rng2)"""


register("result_page", with_(corpus("doc", DOC_SRC), queries_sql(), query_terms_sql(), scores_sql("doc"), page_requests_sql()) + """
SELECT r.qid, r.page, r.page_no, CAST(k.rank AS BIGINT) AS rank, k.url, printf('%.4f', k.score) AS score
FROM reqs r JOIN ranked k ON k.qid = r.qid
WHERE (k.rank - 1) // 10 = r.page_no - 1
""")

PAGED = with_(corpus("doc", DOC_SRC), queries_sql(), query_terms_sql(), scores_sql("doc"), page_requests_sql())

register("paging_facts", PAGED + "SELECT * FROM paging")


# --- links and URLs -----------------------------------------------------------

URL_RE = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(\?[^#]*)?(#.*)?"
KEPT_PATH = r"^[A-Za-z0-9\-_.~!$&'()*+,;=:@/\[\]%]*\z"
UNESCAPED = {"%2F": "/", "%24": "$", "%26": "&", "%2B": "+", "%2C": ",", "%3A": ":", "%3B": ";", "%3D": "=", "%40": "@", "%7E": "~"}
A_TAG = r"(?is)<a" + TAG_END
HREF_RE = r"""(?is)\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""
AFTER_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:([^#]*)"


def part_sql(x: str, i: int) -> str:
    return f"regexp_extract({x}, {q(URL_RE)}, {i})"


def rx(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {q(pattern)})"


def escape_path_sql(p: str) -> str:
    enc = f"url_encode(url_decode({p}))"
    for code, ch in UNESCAPED.items():
        enc = f"replace({enc}, {q(code)}, {q(ch)})"
    return f"(CASE WHEN {rx(p, KEPT_PATH)} THEN {p} ELSE {enc} END)"


def bad_port_sql(host: str) -> str:
    rest = f"regexp_extract({host}, '\\]([^\\]]*)\\z', 1)"
    last = f"regexp_extract({host}, '(:[^:]*)\\z', 1)"
    return (
        f"(CASE WHEN starts_with({host}, '[') THEN NOT contains({host}, ']') OR NOT regexp_full_match({rest}, '(:[0-9]*)?')"
        f" ELSE {last} <> '' AND NOT regexp_full_match({last}, ':[0-9]*') END)"
    )


def invalid_sql(ref: str) -> str:
    scheme, host, path, frag = (part_sql(ref, i) for i in (1, 2, 3, 5))
    return (
        f"({rx(ref, '[' + chr(92) + 'x00-' + chr(92) + 'x1f' + chr(92) + 'x7f]')}"
        f" OR {rx(f'({host} || {path} || {frag})', '%([^0-9A-Fa-f]|[0-9A-Fa-f][^0-9A-Fa-f]|[0-9A-Fa-f]?' + chr(92) + 'z)')}"
        f" OR {rx(host, r'[\s{}|\\^`]')} OR {bad_port_sql(host_sql(ref))}"
        f" OR ({scheme} = '' AND NOT {rx(ref, r'^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//')} AND {rx(path, '^[^/]*:')})"
        f" OR starts_with({ref}, ':'))"
    )


def resolve_sql(base: str, href: str) -> str:
    rs, rh, rp, rq = (part_sql(href, i) for i in (1, 2, 3, 4))
    scheme = f"lower(CASE WHEN {rs} <> '' THEN {rs} ELSE {part_sql(base, 1)} END)"
    host = f"(CASE WHEN {rh} <> '' THEN {rh} ELSE {host_sql(base)} END)"
    rest = f"regexp_extract({href}, {q(AFTER_SCHEME)}, 1)"
    opaque = f"({rs} <> '' AND NOT starts_with({rest}, '/'))"
    path = escape_path_sql(rp)
    slash = f"(CASE WHEN {rp} <> '' AND NOT starts_with({rp}, '/') AND {host} <> '' THEN '/' ELSE '' END)"
    authority = f"(CASE WHEN {host} <> '' OR {rp} <> '' THEN '//' || {host} ELSE '' END)"
    hier = f"((CASE WHEN {scheme} <> '' THEN {scheme} || ':' ELSE '' END) || {authority} || {slash} || {path} || {rq})"
    opaque_url = f"(lower({rs}) || ':' || {rest})"
    return (
        f"(CASE WHEN coalesce({base}, '') = '' OR coalesce({href}, '') = '' THEN ''"
        f" WHEN {invalid_sql(href)} OR {invalid_sql(base)} THEN NULL"
        f" WHEN {opaque} THEN {opaque_url} ELSE {hier} END)"
    )


def host_sql(x: str) -> str:
    return f"regexp_replace({part_sql(x, 2)}, '^.*@', '')"


def ext_sql(h: str) -> str:
    return f"trim(replace(lower(regexp_extract({h}, '(\\.[^./]*)\\z', 1)), '\\', ''), '\"')"


def followed_sql(h: str) -> str:
    return f"({h} <> '' AND NOT starts_with({h}, '#') AND {ext_sql(h)} IN ('', '.html'))"


HREF_SQL = " || ".join(f"regexp_extract(tag, {q(HREF_RE)}, {i})" for i in (1, 2, 3))

ANCHORS = f"""{REFERENCES},
tags AS (
  SELECT src, pos, {HREF_SQL} AS raw FROM (
    SELECT url AS src, unnest(l) AS tag, generate_subscripts(l, 1) - 1 AS pos
    FROM (SELECT url, list_filter(regexp_extract_all(regexp_replace(html, {q('(?i)' + UNREAD)}, ' ', 'g'), {q(A_TAG)}, 0),
                                  lambda t: regexp_matches(t, '(?is)^<a[\\s/]') AND ends_with(t, '>')) AS l FROM pages))),
anchors AS (SELECT src, CAST(pos AS BIGINT) AS pos, {decode_sql('raw')} AS href FROM tags, refs),
followed AS (SELECT src, pos, href FROM anchors WHERE {followed_sql('href')}),
resolved AS (SELECT src, pos, href, {resolve_sql('src', 'href')} AS url FROM followed)"""

register("extract_links", with_(ANCHORS) + "SELECT src, pos, href FROM anchors WHERE href <> '' AND NOT starts_with(href, '#')")

ODD_PAGES = (
    f"odd_pages AS (SELECT page_id, url, {q(fx.ODD_START)} || replace(html, '<p>', {q(fx.ODD_PARAGRAPH)}) AS html FROM pages)"
)
register(
    "odd_markup_words",
    with_(ODD_PAGES, corpus("page", PAGE_SRC).replace("FROM pages", "FROM odd_pages"))
    + "SELECT url, tok AS token, CAST(count(*) AS BIGINT) AS cnt FROM page_tok GROUP BY 1, 2",
)
register(
    "odd_markup_links",
    with_(ODD_PAGES, ANCHORS.replace("FROM pages", "FROM odd_pages"))
    + "SELECT src, pos, href FROM anchors WHERE href <> '' AND NOT starts_with(href, '#')",
)

register("link_extension_filter", with_(ANCHORS) + f"""
SELECT src, pos, href, {ext_sql('href')} AS ext, {followed_sql('href')} AS keep
FROM anchors WHERE href <> '' AND NOT starts_with(href, '#')
""")

_CASES = ", ".join(f"({-i - 1}, {q(h)})" for i, h in enumerate(fx.HREF_CASES))
register("resolve_links", with_(ANCHORS, f"""
cases AS (SELECT p.url AS src, CAST(c.pos AS BIGINT) AS pos, c.href FROM pages p, (VALUES {_CASES}) c(pos, href)),
allh AS (SELECT src, pos, href FROM followed UNION ALL SELECT src, pos, href FROM cases)""") + f"""
SELECT src, pos, href, {resolve_sql('src', 'href')} AS url FROM allh
""")

register("same_host_links", with_(ANCHORS) + f"""
SELECT src, pos, url FROM resolved WHERE url IS NOT NULL AND {host_sql('url')} = {host_sql('src')}
""")

register("outlink_counts", with_(ANCHORS) + f"""
SELECT src, CAST(count(*) AS BIGINT) AS n_links, CAST(count(DISTINCT url) AS BIGINT) AS n_urls,
       CAST(count(DISTINCT CASE WHEN {host_sql('url')} = {host_sql('src')} THEN url END) AS BIGINT) AS n_same_host
FROM resolved GROUP BY src
""")


def display_title_sql(u: str) -> str:
    word = "upper(w[1]) || lower(w[2:])"
    part = f"regexp_replace(replace(replace(regexp_replace(p, '\\.html\\z', ''), '-', ' '), '_', ' '), '^{SPLIT[:-1]}+|{SPLIT[:-1]}+$', '', 'g')"
    words = f"list_filter(regexp_split_to_array({part}, {q(SPLIT)}), lambda w: w <> '')"
    title = f"array_to_string(list_transform({words}, lambda w: {word}), ' ')"
    titles = f"list_filter(list_transform(list_reverse(string_split({u}, '/')), lambda p: {title}), lambda t: t <> '')"
    return f"coalesce({titles}[1], regexp_replace({u}, '^https://', ''))"


def clean_path_sql(u: str) -> str:
    suffix = f"CAST(CAST(('0x' || substr(md5({u}), 1, 8)) AS BIGINT) % 1000 AS VARCHAR)"
    return f"(translate(lower({display_title_sql(u)}), ' /.', '---') || '-' || {suffix})"


DISPLAY = with_(ANCHORS, "urls AS (SELECT url FROM pages UNION SELECT url FROM resolved WHERE url IS NOT NULL)")

register("url_display", DISPLAY + f"""
SELECT url, regexp_replace(url, '^https://', '') AS display_url, {display_title_sql('url')} AS title FROM urls
""")

register("url_slug", DISPLAY + f"SELECT url, {clean_path_sql('url')} AS slug FROM urls")

register("resolve_slug", with_(ANCHORS, f"""
tbl AS (SELECT slug, min(url) AS url FROM (SELECT {clean_path_sql('url')} AS slug, url FROM pages) GROUP BY slug),
req AS (SELECT DISTINCT {clean_path_sql('url')} AS slug FROM resolved WHERE url IS NOT NULL)""") + """
SELECT r.slug, t.url, t.url IS NOT NULL AS found FROM req r LEFT JOIN tbl t ON t.slug = r.slug
""")

HOST_RE = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"
SCHEME_RE = r"^([A-Za-z][A-Za-z0-9+.\-]*)://"

CRAWL_LINKS = f"""
pg AS (SELECT page_id, url, regexp_extract(url, {q(HOST_RE)}, 1) AS host FROM pages),
num AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY page_id) - 1 AS n FROM pg),
hosts AS (SELECT host, row_number() OVER (ORDER BY host) AS hn FROM (SELECT DISTINCT host FROM pg)),
firsts AS (SELECT h.hn, m.url FROM num m JOIN hosts h ON h.host = m.host WHERE m.n = 0),
links AS (
  SELECT a.url AS src, b.url AS href FROM num a JOIN num b ON a.host = b.host AND (b.n = 2 * a.n + 1 OR b.n = 2 * a.n + 2)
  UNION ALL SELECT a.url, f.url FROM num a JOIN hosts h ON h.host = a.host JOIN firsts f ON f.hn = h.hn + 1
  UNION ALL SELECT url, regexp_extract(url, {q(SCHEME_RE)}, 1) || '://' || host || '/missing' FROM num)"""

CRAWL_REACH = f"""
seed AS (
  SELECT first AS url FROM (SELECT host, count(*) AS c, arg_min(url, page_id) AS first FROM pg GROUP BY host)
  ORDER BY c DESC, host LIMIT 1),
seed_url AS (SELECT {resolve_sql('url', 'url')} AS url FROM seed),
cand AS (SELECT {resolve_sql('src', 'src')} AS src, {resolve_sql('src', 'href')} AS dst FROM links),
edges AS (
  SELECT DISTINCT src, dst FROM cand
  WHERE dst IS NOT NULL AND {host_sql('dst')} = (SELECT {host_sql('url')} FROM seed_url)
    AND src IN (SELECT url FROM keys)),
reach(url, depth) AS (
  SELECT url, 0 FROM seed_url
  UNION ALL
  SELECT e.dst, r.depth + 1 FROM reach r JOIN edges e ON e.src = r.url
  WHERE r.depth < (SELECT count(*) FROM pages))"""

register("crawl_reachable", f"""
WITH RECURSIVE {CRAWL_LINKS.strip()},
keys AS (SELECT DISTINCT {resolve_sql('url', 'url')} AS url FROM pages),
{CRAWL_REACH.strip()}
SELECT url, CAST(min(depth) AS INTEGER) AS depth, url IN (SELECT url FROM keys) AS fetched FROM reach GROUP BY url
""")


# --- robots ---------------------------------------------------------------------

AGENT = "trawl"
# The time at which files are checked, as the query has it.
ROBOTS_AS_OF = "2024-01-31 12:00:00"

TRIM_RE = r"^[\s\x0b\x85\p{Z}]+|[\s\x0b\x85\p{Z}]+\z"


def trim_sql(x: str) -> str:
    return f"regexp_replace({x}, {q(TRIM_RE)}, '', 'g')"


def robots_files_sql() -> str:
    return f"""
rhosts AS (SELECT DISTINCT regexp_extract(url, {q(HOST_RE)}, 1) AS host FROM pages),
rfiles AS (
  SELECT host,
         CASE WHEN substr(md5(host), 1, 1) = '1' THEN TIMESTAMP '2024-01-29 23:00:00'
              ELSE TIMESTAMP '2024-01-31 00:00:00' END AS fetched_at,
         CASE WHEN substr(md5(host), 1, 1) = '2' THEN 404 ELSE 200 END AS status,
         CASE CAST('0x' || substr(md5(host), 2, 1) AS INTEGER) % 4
           {' '.join(f'WHEN {i} THEN {q(b)}' for i, b in enumerate(fx.ROBOTS_BODIES))} END AS body
  FROM rhosts)"""


def robots_lines_sql(files: str) -> str:
    agent = q(AGENT)
    return f"""
rl0 AS (
  SELECT host, fetched_at, CAST(line_no AS BIGINT) AS line_no, {trim_sql('raw')} AS line FROM (
    SELECT host, fetched_at, unnest(string_split(body, chr(10))) AS raw,
           generate_subscripts(string_split(body, chr(10)), 1) - 1 AS line_no
    FROM {files} WHERE status < 400)),
rl1 AS (
  SELECT host, fetched_at, line_no,
         lower({trim_sql("split_part(line, ':', 1)")}) AS directive,
         {trim_sql("substr(line, strpos(line, ':') + 1)")} AS value
  FROM rl0 WHERE line <> '' AND NOT starts_with(line, '#') AND strpos(line, ':') > 0),
rlines AS (
  SELECT *, coalesce(last_value(CASE WHEN directive = 'user-agent'
                                     THEN lower(value) = '*' OR contains(lower(value), {agent}) END IGNORE NULLS)
             OVER (PARTITION BY host, fetched_at ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             false) AS applies
  FROM rl1),
rrules AS (
  SELECT host, fetched_at, line_no, directive AS kind, value AS pattern,
         '^\\Q' || replace(replace(replace(value, '\\E', '\\E\\\\E\\Q'), '*', '\\E.*\\Q'), '$', '\\E\\z\\Q') || '\\E' AS regex
  FROM rlines WHERE applies AND directive IN ('allow', 'disallow') AND value <> ''),
rdelay AS (
  SELECT host, fetched_at, arg_max(d, line_no) AS delay_s FROM (
    SELECT host, fetched_at, line_no, TRY_CAST(value AS DOUBLE) AS d FROM rlines
    WHERE applies AND directive = 'crawl-delay'
      AND regexp_full_match(value, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?')) WHERE d > 0 GROUP BY host, fetched_at)"""


FRESH_SQL = f"""
rfresh AS (
  SELECT host, f.fetched_at, f.status, f.body FROM (
    SELECT host, arg_max({{'fetched_at': fetched_at, 'status': status, 'body': body}}, fetched_at) AS f
    FROM rfiles GROUP BY host)
  WHERE f.fetched_at >= TIMESTAMP '{ROBOTS_AS_OF}' - INTERVAL 24 HOURS)"""

register("robots_rules", with_(robots_files_sql(), robots_lines_sql("rfiles")) + """
SELECT host, line_no, kind, pattern, regex FROM rrules
""")

register("robots_delay", with_(robots_files_sql(), robots_lines_sql("rfiles")) + "SELECT host, delay_s FROM rdelay")

register("robots_filter", with_(ANCHORS, robots_files_sql(), FRESH_SQL, robots_lines_sql("rfresh"), f"""
urls AS (SELECT url FROM pages UNION SELECT url FROM resolved WHERE url IS NOT NULL),
keyed AS (
  SELECT url, {host_sql('url')} AS host,
         CASE WHEN {part_sql('url', 3)} = '' THEN '/' ELSE url_decode({part_sql('url', 3)}) END AS path,
         {invalid_sql('url')} AS unparsable
  FROM urls)""") + """
SELECT k.url,
       bool_or(k.unparsable) OR coalesce(bool_or(r.kind = 'allow'), false)
         OR NOT coalesce(bool_or(r.kind = 'disallow'), false) AS allowed
FROM keyed k LEFT JOIN rrules r ON r.host = k.host AND regexp_matches(k.path, r.regex)
GROUP BY k.url
""")

register("robots_fresh", with_(robots_files_sql(), FRESH_SQL, robots_lines_sql("rfresh")) + """
SELECT h.host, f.host IS NOT NULL AS fresh, coalesce(d.delay_s, 0.0) AS delay_s,
       CAST(coalesce(n.n_rules, 0) AS BIGINT) AS n_rules
FROM (SELECT DISTINCT host FROM rfiles) h
LEFT JOIN rfresh f ON f.host = h.host
LEFT JOIN rdelay d ON d.host = h.host
LEFT JOIN (SELECT host, count(*) AS n_rules FROM rrules GROUP BY host) n ON n.host = h.host
""")

register("fetch_schedule", with_(robots_files_sql(), FRESH_SQL, robots_lines_sql("rfresh"), f"""
fu AS (SELECT url, page_id, {host_sql('url')} AS host FROM pages),
fn AS (SELECT url, host, row_number() OVER (PARTITION BY host ORDER BY page_id, url) AS n FROM fu)""") + """
SELECT fn.url, fn.host, CAST(fn.n AS BIGINT) AS n, (fn.n - 1) * coalesce(d.delay_s, 0.0) AS offset_s
FROM fn LEFT JOIN rdelay d ON d.host = fn.host
""")


# --- sources, storage, appending ------------------------------------------------

register("page_source_split", """
SELECT url, page_id % 10 <> 0 AS ok,
       CASE WHEN page_id % 10 = 0 THEN 'unexpected status code: 404' END AS error
FROM pages
""")

register("warc_fetches", """
SELECT url, CASE WHEN page_id % 10 <> 0 THEN md5(coalesce(html, '')) END AS html_md5,
       CASE WHEN page_id % 10 = 0 THEN 'unexpected status code: 404' END AS error
FROM pages
""")

register("index_roundtrip", with_(corpus("page", PAGE_SRC)) + """
SELECT term, url, cnt, word_count, round(tf, 6) AS tf FROM page_post
""")

register("import_index", with_(corpus("page", PAGE_SRC), corpus("doc", DOC_SRC)) + """
, docs AS (
  SELECT url, word_count FROM page_docs
  UNION ALL
  SELECT url, 0 FROM (SELECT DISTINCT url FROM doc_post) x WHERE url NOT IN (SELECT url FROM page_docs)),
np AS (SELECT url, count(*) AS n FROM (SELECT term, url FROM page_post UNION SELECT term, url FROM doc_post) GROUP BY url)
SELECT d.url, CAST(d.word_count AS BIGINT) AS word_count, CAST(coalesce(np.n, 0) AS BIGINT) AS n_postings
FROM docs d LEFT JOIN np ON np.url = d.url
""")

RL = corpus("rl", "SELECT CAST(doc_id AS VARCHAR) AS url, text FROM documents")
RL_KEYED = """
rl_map AS (SELECT CAST(doc_id AS VARCHAR) AS k, 'src:' || source AS url, doc_id AS seq FROM documents),
rdocs AS (SELECT m.url, m.seq, d.word_count FROM rl_docs d JOIN rl_map m ON m.k = d.url),
rpost AS (SELECT p.term, m.url, m.seq, p.cnt, p.word_count, p.tf FROM rl_post p JOIN rl_map m ON m.k = p.url)"""

register("add_documents", with_(corpus("page", PAGE_SRC), RL, RL_KEYED) + """
, alld AS (SELECT url, word_count, 0 AS seq FROM page_docs UNION ALL SELECT url, word_count, seq FROM rdocs),
firstd AS (SELECT url, arg_min(word_count, seq) AS word_count, min(seq) AS seq FROM alld GROUP BY url),
np AS (SELECT url, count(*) AS n FROM (SELECT term, url FROM page_post UNION SELECT term, url FROM rpost) GROUP BY url)
SELECT f.url, CAST(f.word_count AS BIGINT) AS word_count, CAST(f.seq AS BIGINT) AS seq,
       CAST(coalesce(np.n, 0) AS BIGINT) AS n_postings
FROM firstd f LEFT JOIN np ON np.url = f.url
""")

register("first_wins_documents", with_(RL, RL_KEYED) + """
SELECT url, CAST(arg_min(word_count, seq) AS BIGINT) AS word_count, CAST(min(seq) AS BIGINT) AS seq FROM rdocs GROUP BY url
""")

register("last_wins_postings", with_(RL, RL_KEYED) + """
SELECT term, url, CAST(arg_max(cnt, seq) AS BIGINT) AS cnt, CAST(arg_max(word_count, seq) AS BIGINT) AS word_count,
       round(arg_max(tf, seq), 6) AS tf, CAST(max(seq) AS BIGINT) AS seq
FROM rpost GROUP BY term, url
""")

register("term_dictionary", with_(corpus("doc", DOC_SRC)) + """
SELECT CAST(row_number() OVER (ORDER BY term) AS BIGINT) AS term_id, term FROM (SELECT DISTINCT term FROM doc_post)
""")

register("term_key", with_(corpus("page", PAGE_SRC)) + """
, dict AS (SELECT CAST(row_number() OVER (ORDER BY term) AS BIGINT) AS term_id, term FROM (SELECT DISTINCT term FROM page_post))
SELECT d.term_id, p.url, p.term FROM page_post p JOIN dict d ON d.term = p.term
""")


# --- reports ------------------------------------------------------------------

FETCH_LOG = """
fl AS (
  SELECT 'https://crawl.example.org/p/' || CAST(event_id // 2 AS VARCHAR) AS url, ts,
         CASE WHEN event_id % 10 = 0 THEN 404 ELSE 200 END AS status
  FROM events)"""

register("crawl_report", with_(FETCH_LOG) + """
, a AS (
  SELECT count(DISTINCT url) AS visited,
         count(DISTINCT url) FILTER (WHERE status = 200) AS documents,
         count(DISTINCT url) FILTER (WHERE status <> 200) AS errors,
         count(*) AS fetches,
         (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS elapsed_s
  FROM fl)
SELECT CAST(visited AS BIGINT) AS visited, CAST(documents AS BIGINT) AS documents, CAST(errors AS BIGINT) AS errors,
       CAST(fetches AS BIGINT) AS fetches, round(elapsed_s, 6) AS elapsed_s,
       round(elapsed_s * 1000 / visited, 6) AS ms_per_page,
       round(CASE WHEN elapsed_s * 1000 / visited > 0 THEN 1000 / (elapsed_s * 1000 / visited) END, 6) AS pages_per_second
FROM a
""")

BATCHES = """
nb AS (
  SELECT 'doc:' || CAST(doc_id AS VARCHAR) AS url, lang,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id, 'doc:' || CAST(doc_id AS VARCHAR)) AS n
  FROM documents)"""

register("document_batches", with_(BATCHES) + """
SELECT url, lang, CAST(n AS BIGINT) AS n, CAST((n - 1) // 150 AS BIGINT) AS batch_id FROM nb
""")

register("batch_report", with_(corpus("doc", DOC_SRC), BATCHES) + """
SELECT nb.lang, CAST((nb.n - 1) // 150 AS BIGINT) AS batch_id, CAST(count(*) AS BIGINT) AS n_docs,
       CAST(sum(coalesce(np.n, 0)) AS BIGINT) AS n_postings, CAST(sum(d.word_count) AS BIGINT) AS n_words
FROM nb JOIN doc_docs d ON d.url = nb.url
LEFT JOIN (SELECT url, count(*) AS n FROM doc_post GROUP BY url) np ON np.url = nb.url
GROUP BY 1, 2
""")

STALL_SQL = with_(FETCH_LOG) + """
, st AS (SELECT epoch_us(min(ts)) AS s FROM fl),
fs AS (SELECT url, epoch_us(min(ts)) AS f FROM fl GROUP BY url),
nw AS (SELECT (f - (SELECT s FROM st)) // 30000000 + 1 AS tick, count(*) AS new FROM fs GROUP BY 1),
tk AS (SELECT range AS tick FROM range(1, (SELECT max(tick) FROM nw) + 1)),
v AS (
  SELECT t.tick, coalesce(nw.new, 0) AS new,
         sum(coalesce(nw.new, 0)) OVER (ORDER BY t.tick ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS visited
  FROM tk t LEFT JOIN nw ON nw.tick = t.tick),
f2 AS (SELECT *, visited > 0 AND new = 0 AS stalled FROM v)
SELECT CAST(tick AS BIGINT) AS tick, CAST(new AS BIGINT) AS new, CAST(visited AS BIGINT) AS visited, stalled,
       coalesce(tick = (SELECT min(tick) FROM f2 WHERE stalled), false) AS first_stall
FROM f2
"""

register("stall_ticks", STALL_SQL)

# Live, ticks go on to that of the last fetch, whether it brings a new URL or not.
LAST_NEW, LAST_FETCH = "(SELECT max(tick) FROM nw)", "(SELECT (epoch_us(max(ts)) - (SELECT s FROM st)) // 30000000 + 1 FROM fl)"
register("streaming_stall", STALL_SQL.replace(LAST_NEW, LAST_FETCH))


# --- streaming (drained streams equal these batch statements) --------------------

register("streaming_index", with_(corpus("page", PAGE_SRC)) + """
SELECT term, url, cnt, word_count, round(tf, 6) AS tf FROM page_post
""")

register("streaming_dedupe", with_(FETCH_LOG) + "SELECT DISTINCT url FROM fl")

register("streaming_progress", with_(FETCH_LOG) + """
SELECT CAST((epoch_us(ts) // 30000000) * 30 AS BIGINT) AS window_start, CAST(count(DISTINCT url) AS BIGINT) AS n_urls
FROM fl GROUP BY 1
""")

# Every window's sketch is within its bound.
register("streaming_progress_sketch", with_(FETCH_LOG) + """
SELECT DISTINCT CAST((epoch_us(ts) // 30000000) * 30 AS BIGINT) AS window_start, true AS within_bound FROM fl
""")

register("sql_functions", f"""
SELECT url, regexp_replace(url, '^https://', '') AS display_url, {display_title_sql('url')} AS title,
       {clean_path_sql('url')} AS slug, printf('%.4f', CAST(length(html) AS DOUBLE) / 7) AS size_score
FROM pages
""")


# --- pages of results, appended indexes, crawl to index -----------------------------

register("search_page", PAGED + f"""
SELECT p.qid, p.page, p.page_no, CAST(k.rank AS BIGINT) AS rank, k.url,
       regexp_replace(k.url, '^https://', '') AS display_url, {display_title_sql('k.url')} AS title,
       {clean_path_sql('k.url')} AS clean_path, printf('%.4f', k.score) AS score,
       p.total, p.total_pages, p.start_index, p.end_index, p.has_next, p.has_prev, p.page_range
FROM paging p LEFT JOIN ranked k ON k.qid = p.qid AND (k.rank - 1) // 10 = p.page_no - 1
""")

APPENDED = with_(corpus("doc", DOC_SRC), corpus("page", PAGE_SRC), """
both_docs AS (SELECT * FROM doc_docs UNION ALL SELECT * FROM page_docs),
both_post AS (SELECT * FROM doc_post UNION ALL SELECT * FROM page_post)""", queries_sql(), query_terms_sql(), scores_sql("both")) + """
SELECT qid, CAST(rank AS BIGINT) AS rank, url, round(score, 6) AS score FROM ranked WHERE rank <= 10
"""
register("append_search", APPENDED)
register("append_parts_search", APPENDED)

TOP_10 = "SELECT qid, CAST(rank AS BIGINT) AS rank, url, round(score, 6) AS score FROM ranked WHERE rank <= 10"
register("bounded_search", with_(corpus("doc", DOC_SRC), queries_sql(), query_terms_sql(), scores_sql("doc")) + TOP_10)
register("streaming_search", with_(corpus("page", PAGE_SRC), queries_sql(), query_terms_sql(), scores_sql("page")) + TOP_10)

register("append_term_ids", with_(corpus("doc", DOC_SRC), corpus("page", PAGE_SRC), """
old AS (SELECT DISTINCT term FROM doc_post),
added AS (SELECT DISTINCT term FROM page_post WHERE term NOT IN (SELECT term FROM old)),
ids AS (
  SELECT row_number() OVER (ORDER BY term) AS term_id, term FROM old
  UNION ALL
  SELECT (SELECT count(*) FROM old) + row_number() OVER (ORDER BY term), term FROM added)""") + """
SELECT term_id, term, count(*) AS n_urls
FROM ids JOIN (SELECT url, term FROM doc_post UNION SELECT url, term FROM page_post) p USING (term)
GROUP BY term_id, term
""")

register("crawl_index", f"""
WITH RECURSIVE {REFERENCES.strip()},{PAGE_TEXT},{corpus("page", PAGE_SRC).split(PAGE_TEXT + ",", 1)[1]},
{robots_files_sql().strip()},{FRESH_SQL},{robots_lines_sql("rfresh")},
keyed AS (
  SELECT page_id, url, {host_sql('url')} AS host,
         CASE WHEN {part_sql('url', 3)} = '' THEN '/' ELSE url_decode({part_sql('url', 3)}) END AS path,
         {invalid_sql('url')} AS unparsable
  FROM pages WHERE page_id % 10 <> 0),
readable AS (
  SELECT k.page_id, k.url
  FROM keyed k LEFT JOIN rrules r ON r.host = k.host AND regexp_matches(k.path, r.regex)
  GROUP BY ALL
  HAVING bool_or(k.unparsable) OR coalesce(bool_or(r.kind = 'allow'), false) OR NOT coalesce(bool_or(r.kind = 'disallow'), false)),
{CRAWL_LINKS},
keys AS (SELECT DISTINCT {resolve_sql('url', 'url')} AS url FROM readable),
{CRAWL_REACH.replace("FROM pg GROUP BY", "FROM pg WHERE url IN (SELECT url FROM readable) GROUP BY")}
SELECT r.url, CAST(min(r.depth) AS INTEGER) AS depth, r.url IN (SELECT url FROM keys) AS fetched,
       any_value(d.word_count) AS word_count, any_value(d.n) AS n_postings
FROM reach r LEFT JOIN (
  SELECT {resolve_sql('d.url', 'd.url')} AS key, d.word_count, CAST(coalesce(p.n, 0) AS BIGINT) AS n
  FROM page_docs d LEFT JOIN (SELECT url, count(*) AS n FROM page_post GROUP BY url) p ON p.url = d.url
  WHERE d.url IN (SELECT url FROM readable)) d ON d.key = r.url
GROUP BY r.url
""")
