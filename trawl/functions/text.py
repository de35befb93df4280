"""Text extraction and tokenising as Column expressions.

Everything here is a built-in expression, so a whole analysis chain stays in
one whole-stage-codegen projection (the higher-order ``filter`` excepted).
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# The HTML text-extraction chain. Comments and elements whose
# content isn't markup go in one pass, so that none hides in another; each
# reaches to its end tag or, where a page is cut off, to the end. The content of
# scripts is kept as it is, of textarea and title with references decoded.
# Then anchor subtrees and all tags (also cut-off ones) go.
# A quote opens a value only right after "=", and a ">" in a quoted value doesn't
# end the tag. Every pattern may also end with the page, so none is tried in
# more than one way.
_ATTRIBUTES = r"""(?:[^>]*?=\s*(?:"[^"]*"|'[^']*'))*[^>]*"""
# What follows an element's name in its start tag: white space, a slash, or the end (so not ``<a-card>``).
TAG_REST = rf"(?:[\s/]{_ATTRIBUTES})?(?:>|\z)"
_NOT_MARKUP = ("script", "style", "textarea", "title")
OPAQUE = r"(?is)<!--.*?(?:-->|\z)" + "".join(rf"|<{t}{TAG_REST}.*?(?:</{t}\s*>|\z)" for t in _NOT_MARKUP)
SCRIPT_TEXT = rf"(?is)\A<script{TAG_REST}(.*?)(?:</script\s*>)?\z"
RAW_TEXT = rf"(?is)\A<(?:textarea|title){TAG_REST}(.*?)(?:</(?:textarea|title)\s*>)?\z"
ANCHOR = rf"(?is)<a{TAG_REST}.*?(?:</a\s*>|\z)"
TAG = rf"<[/!?a-zA-Z]{_ATTRIBUTES}(?:>|\z)"

# Character references, by the table of the standard library: names that need a
# semicolon end in one there; the others may stand without it.
REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9A-Fa-f]+;?|[A-Za-z][A-Za-z0-9]*;?)"
_SHORT_NAMES = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
SHORT_NAME = "^(" + "|".join(_SHORT_NAMES) + ")"
# Numbers 128 to 159 mean the characters of windows-1252.
_WINDOWS_1252 = bytes(range(128, 160)).decode("cp1252", "replace")

# Fixed value: characters trimmed from both ends of a token.
TRIM_CHARS = ".,!?:;'"

# Unicode white space, as the tokenizer splits on it.
WHITESPACE = r"(?U)\s+"

Stemmer = Callable[[Column], Column]


def identity_stem(term: Column) -> Column:
    """The default stem hook. The reference's stemmer never fires, so terms pass through."""
    return term


def _code_point(n: Column) -> Column:
    """The character of a number; those that are none give U+FFFD, as in HTML."""
    odd = n.isNull() | (n <= 0) | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF)
    windows = F.substring(F.lit(_WINDOWS_1252), (n - 127).cast("int"), F.lit(1))
    plain = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    return F.when(odd, "\ufffd").when(n.between(128, 159), windows).otherwise(plain)


def _reference(ref: Column, names: Column) -> Column:
    """One reference decoded; unknown names stay as they are."""
    hexadecimal = F.conv(F.regexp_extract(ref, r"^&#[xX]([0-9A-Fa-f]{1,8});?$", 1), 16, 10).try_cast("bigint")
    number = F.when(ref.rlike("^&#[xX]"), hexadecimal).otherwise(F.regexp_extract(ref, r"^&#([0-9]+)", 1).try_cast("bigint"))
    name = F.substring(ref, 2, 1 << 20)
    short = F.regexp_extract(name, SHORT_NAME, 1)
    prefix = F.concat(F.try_element_at(names, short), F.substr(name, F.length(short) + 1))
    return F.when(ref.startswith("&#"), _code_point(number)).otherwise(F.coalesce(F.try_element_at(names, name), prefix, ref))


def decode_entities(text: Column) -> Column:
    """Named and numeric character references decoded once."""
    names = F.from_json(F.lit(json.dumps(html5)), "map<string,string>")
    pairs = F.arrays_zip(F.split(text, REFERENCE, -1).alias("gap"), F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0)).alias("ref"))
    decoded = F.transform(pairs, lambda p: F.concat(p["gap"], F.coalesce(_reference(p["ref"], names), F.lit(""))))
    return F.when(text.contains("&"), F.array_join(decoded, "")).otherwise(text)


def strip_markup(html: Column) -> Column:
    """Remove comments, elements without markup, anchors and tags; each removal is a word boundary."""
    body = html
    for pattern in (OPAQUE, ANCHOR, TAG):
        body = F.regexp_replace(body, pattern, " ")
    return body


def html_text(html: Column) -> Column:
    """The indexable text of a page.

    Text nodes outside ``<a>`` and ``<style>`` with references decoded, and the
    text of every textarea and title, and of every script as it is, appended at
    the end (word bags do not depend on order).
    """
    opaque = F.regexp_extract_all(html, F.lit(OPAQUE), F.lit(0))

    def content(pattern: str) -> Column:
        return F.array_join(F.transform(opaque, lambda x: F.regexp_extract(x, pattern, 1)), " ")

    return F.concat_ws(" ", decode_entities(F.concat_ws(" ", strip_markup(html), content(RAW_TEXT))), content(SCRIPT_TEXT))


def split_words(text: Column) -> Column:
    """Lower-case and split on Unicode white space; may hold empty strings at the ends."""
    return F.split(F.lower(text), WHITESPACE)


def tokenize(text: Column) -> Column:
    """P5: lower-cased whitespace tokens, no empty ones."""
    return F.filter(split_words(text), lambda t: t != "")


def is_stop_word(token: Column, stop_words: Sequence[str]) -> Column:
    """Membership of the raw lower-cased token (before trimming) in the stop list."""
    if not stop_words:
        return F.lit(False)
    return token.isin(list(stop_words))


def kept_tokens(text: Column, stop_words: Sequence[str]) -> Column:
    """P5+P6: tokens that are neither empty nor stop words; their count is the word_count."""
    if not stop_words:
        return tokenize(text)
    stops = list(stop_words)
    return F.filter(split_words(text), lambda t: (t != "") & ~t.isin(stops))


def clean_word(token: Column) -> Column:
    """Trim ``TRIM_CHARS`` from both ends, then lower-case."""
    return F.lower(F.btrim(token, F.lit(TRIM_CHARS)))


def index_term(token: Column, stem: Stemmer = identity_stem) -> Column:
    """P7+P8: the term a kept token is indexed under ('' is never indexed, P9)."""
    return stem(clean_word(token))


def suffix_stem(term: Column) -> Column:
    """An example stem hook: strip one plural or verb suffix from words over four characters."""
    return F.when(F.length(term) > 4, F.regexp_replace(term, r"(ing|ed|es|s)\z", "")).otherwise(term)
