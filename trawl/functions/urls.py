"""URL Column functions.

Link resolution is root-relative, not RFC 3986: a reference missing a scheme
or host takes them from the base, its path is never joined to the base path
and dot segments stay. Fragments are removed. References that do not parse
give null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# URL parts (RFC 3986 appendix B): 1 scheme, 2 authority, 3 path, 4 query with '?', 5 fragment.
URL_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(\?[^#]*)?(#.*)?"
HAS_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"
HAS_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//"
OPAQUE_REST = r"^[A-Za-z][A-Za-z0-9+.\-]*:([^#]*)"
# A '%' not followed by two hex digits.
BAD_PERCENT = r"%([^0-9A-Fa-f]|[0-9A-Fa-f][^0-9A-Fa-f]|[0-9A-Fa-f]?\z)"
CONTROL = r"[\x00-\x1f\x7f]"
BAD_HOST = r"[\s{}|\\^`]"
# A port that isn't a number (after the last ':'), or brackets that don't close before it.
BAD_PORT = r"^[^\[].*:[0-9]*[^0-9:][^:]*\z|^:[0-9]*[^0-9:][^:]*\z|^\[[^\]]*\z|^\[.*\](?!(?::[0-9]*)?\z)[^\]]*\z"
USER_INFO = r"^.*@"
# A path made only of these characters is kept as written.
PATH_KEPT = r"^[A-Za-z0-9\-_.~!$&'()*+,;=:@/\[\]%]*\z"
# Escapes put back after encoding, so the path keeps these characters.
PATH_RESTORE = (
    ("%2F", "/"),
    ("%24", "$"),
    ("%26", "&"),
    ("%2B", "+"),
    ("%2C", ","),
    ("%3A", ":"),
    ("%3B", ";"),
    ("%3D", "="),
    ("%40", "@"),
    ("%7E", "~"),
)
# Fixed value: the extension a link must have (or none) to be followed.
FOLLOWED_EXTENSIONS = ("", ".html")


def url_part(url: Column, idx: int) -> Column:
    return F.regexp_extract(url, URL_PARTS, idx)


def url_host(url: Column) -> Column:
    """Host with port, without user information ('' when there is no authority)."""
    return F.regexp_replace(url_part(url, 2), USER_INFO, "")


def escape_path(path: Column) -> Column:
    """Percent-encode a path the way it is written back: kept when already clean."""
    decoded = F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    enc = F.replace(F.replace(F.url_encode(decoded), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A"))
    for code, char in PATH_RESTORE:
        enc = F.replace(enc, F.lit(code), F.lit(char))
    return F.when(path.rlike(PATH_KEPT), path).otherwise(enc)


def invalid_url(ref: Column) -> Column:
    """True when the URL would not parse: control characters, a bad escape, host or port, or a colon in a scheme-less first segment."""
    scheme = url_part(ref, 1)
    host = url_part(ref, 2)
    path = url_part(ref, 3)
    frag = url_part(ref, 5)
    no_scheme_colon = (scheme == "") & ~ref.rlike(HAS_AUTHORITY) & path.rlike(r"^[^/]*:")
    return (
        ref.rlike(CONTROL)
        | F.concat(host, path, frag).rlike(BAD_PERCENT)
        | host.rlike(BAD_HOST)
        | F.regexp_replace(host, USER_INFO, "").rlike(BAD_PORT)
        | no_scheme_colon
        | ref.startswith(":")
    )


def resolve_link(base: Column, href: Column) -> Column:
    """L4+L5: absolute URL of ``href`` on page ``base``; '' for a blank side, null when invalid."""
    r_scheme = url_part(href, 1)
    r_host = url_part(href, 2)
    r_path = url_part(href, 3)
    r_query = url_part(href, 4)
    scheme = F.lower(F.when(r_scheme != "", r_scheme).otherwise(url_part(base, 1)))
    host = F.when(r_host != "", r_host).otherwise(url_host(base))
    opaque = (r_scheme != "") & ~F.regexp_extract(href, OPAQUE_REST, 1).startswith("/")
    # Escaping keeps a path empty or not, and keeps its leading '/', so the
    # conditions test the raw path and the escape is built only once.
    slash = F.when((r_path != "") & ~r_path.startswith("/") & (host != ""), F.lit("/")).otherwise(F.lit(""))
    authority = F.when((host != "") | (r_path != ""), F.concat(F.lit("//"), host)).otherwise(F.lit(""))
    hierarchical = F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(F.lit("")),
        authority,
        slash,
        escape_path(r_path),
        r_query,
    )
    opaque_url = F.concat(F.lower(r_scheme), F.lit(":"), F.regexp_extract(href, OPAQUE_REST, 1))
    resolved = F.when(opaque, opaque_url).otherwise(hierarchical)
    return (
        F.when((F.coalesce(base, F.lit("")) == "") | (F.coalesce(href, F.lit("")) == ""), F.lit(""))
        .when(invalid_url(href) | invalid_url(base), F.lit(None).cast("string"))
        .otherwise(resolved)
    )


def resolvable(base: Column, href: Column) -> Column:
    """True when ``resolve_link(base, href)`` is not null (cheap: no URL is built)."""
    blank = (F.coalesce(base, F.lit("")) == "") | (F.coalesce(href, F.lit("")) == "")
    return blank | ~(invalid_url(href) | invalid_url(base))


def resolved_host(base: Column, href: Column) -> Column:
    """``url_host(resolve_link(base, href))`` without building the URL: '' for blank or opaque references.

    Filters on the resolved host then stay small; a predicate on the resolved
    URL itself would copy the whole resolution expression into the filter.
    """
    blank = (F.coalesce(base, F.lit("")) == "") | (F.coalesce(href, F.lit("")) == "")
    r_host = url_part(href, 2)
    opaque = (url_part(href, 1) != "") & ~F.regexp_extract(href, OPAQUE_REST, 1).startswith("/")
    return F.when(blank | opaque, F.lit("")).when(r_host != "", url_host(href)).otherwise(url_host(base))


def link_extension(href: Column) -> Column:
    """L3: suffix from the last '.' after the last '/' of the whole href, lower-cased, '\\' removed, quotes trimmed."""
    ext = F.lower(F.regexp_extract(href, r"(\.[^./]*)\z", 1))
    return F.btrim(F.replace(ext, F.lit("\\"), F.lit("")), F.lit('"'))


def followed_link(href: Column) -> Column:
    """L2+L3: not blank, not a fragment, and a followed extension."""
    return (href != "") & ~href.startswith("#") & link_extension(href).isin(list(FOLLOWED_EXTENSIONS))


# --- display functions (U1-U3) ----------------------------------------------


def format_url(url: Column) -> Column:
    """Drop a leading ``https://`` only."""
    return F.regexp_replace(url, r"^https://", "")


def display_title(url: Column) -> Column:
    """Title from the last non-blank ``/`` segment, else ``format_url``."""

    def title(part: Column) -> Column:
        words = F.split(F.translate(F.regexp_replace(part, r"\.html\z", ""), "-_", "  "), r"(?U)\s+")
        words = F.filter(words, lambda w: w != "")
        cased = F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 30))))
        return F.array_join(cased, " ")

    titles = F.filter(F.transform(F.reverse(F.split(url, "/")), title), lambda t: t != "")
    return F.coalesce(F.get(titles, 0), format_url(url))


def slug_suffix(url: Column) -> Column:
    """Three-digit suffix from the URL's md5, so one URL always gets one slug."""
    return (F.conv(F.substring(F.md5(url), 1, 8), 16, 10).cast("bigint") % 1000).cast("string")


def clean_path(url: Column) -> Column:
    """Slug of the display title with ' ', '/', '.' as '-', plus ``-NNN``."""
    base = F.translate(F.lower(display_title(url)), " /.", "---")
    return F.concat(base, F.lit("-"), slug_suffix(url))


def format_score(score: Column) -> Column:
    """U4: four decimals."""
    return F.format_string("%.4f", score)
