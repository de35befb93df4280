"""robots.txt rules as tables.

A robots file is a row ``(host, fetched_at, status, body)``. Parsing explodes
the body into numbered lines; the user-agent group a rule belongs to is the
last ``user-agent`` line before it (a running ``last(..., ignorenulls)``
window within one file, so the window is as large as one file). Checking URLs
is an equi-join on host with the host's rules as one array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trawl.functions.urls import invalid_url, url_host, url_part
from trawl.operators.sequence import number_rows

DEFAULT_AGENT = "trawl"
FRESH_HOURS = 24
_NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\z"


def _trim(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+\z", "")


def pattern_regex(pattern: Column) -> Column:
    """R2: quote the pattern, ``*`` matches anything, ``$`` anchors the end; prefix match otherwise."""
    quoted = F.replace(pattern, F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
    quoted = F.replace(quoted, F.lit("*"), F.lit("\\E.*\\Q"))
    quoted = F.replace(quoted, F.lit("$"), F.lit("\\E\\z\\Q"))
    return F.concat(F.lit("^\\Q"), quoted, F.lit("\\E"))


def robots_lines(files: DataFrame, agent: str = DEFAULT_AGENT) -> DataFrame:
    """R1 + W2: directive lines of every file with the group flag of the user-agent above them.

    Returns ``(host, fetched_at, line_no, directive, value, applies)``. Files
    answered with status >= 400 have no lines.
    """
    lines = files.where(F.col("status") < 400).select(
        "host", "fetched_at", F.posexplode(F.split("body", "\n")).alias("line_no", "raw")
    )
    line = _trim(F.col("raw"))
    parsed = (
        lines.select("host", "fetched_at", F.col("line_no").cast("bigint"), line.alias("line"))
        .where((F.col("line") != "") & ~F.col("line").startswith("#") & (F.instr("line", ":") > 0))
        .select(
            "host",
            "fetched_at",
            "line_no",
            F.lower(_trim(F.substring_index("line", ":", 1))).alias("directive"),
            _trim(F.col("line").substr(F.instr("line", ":") + 1, F.lit(1 << 30))).alias("value"),
        )
    )
    token = F.lower(F.col("value"))
    flag = F.when(F.col("directive") == "user-agent", (token == "*") | token.contains(agent.lower()))
    # Each user-agent line resets the flag; one file is one window partition.
    w = Window.partitionBy("host", "fetched_at").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    return parsed.select("*", F.coalesce(F.last(flag, ignorenulls=True).over(w), F.lit(False)).alias("applies"))


def parse_robots(files: DataFrame, agent: str = DEFAULT_AGENT) -> DataFrame:
    """R1+R2: ``(host, fetched_at, line_no, kind, pattern, regex)`` for allow and disallow rules."""
    lines = robots_lines(files, agent)
    rules = lines.where(
        F.col("applies") & F.col("directive").isin("allow", "disallow") & (F.col("value") != "")
    )
    return rules.select(
        "host",
        "fetched_at",
        "line_no",
        F.col("directive").alias("kind"),
        F.col("value").alias("pattern"),
        pattern_regex(F.col("value")).alias("regex"),
    )


def crawl_delays(files: DataFrame, agent: str = DEFAULT_AGENT) -> DataFrame:
    """``(host, fetched_at, delay_s)``: the last valid crawl-delay > 0 of each file."""
    lines = robots_lines(files, agent)
    delay = F.when(F.col("value").rlike(_NUMBER), F.col("value").try_cast("double"))
    valid = lines.where(F.col("applies") & (F.col("directive") == "crawl-delay")).select(
        "host", "fetched_at", "line_no", delay.alias("delay_s")
    ).where(F.col("delay_s") > 0)
    return valid.groupBy("host", "fetched_at").agg(F.max_by("delay_s", "line_no").alias("delay_s"))


def fresh_files(files: DataFrame, as_of: Column, hours: int = FRESH_HOURS) -> DataFrame:
    """The latest file per host, kept only when fetched within ``hours`` of ``as_of``."""
    latest = files.groupBy("host").agg(F.max_by(F.struct("fetched_at", "status", "body"), "fetched_at").alias("f"))
    return latest.select("host", "f.fetched_at", "f.status", "f.body").where(
        F.col("fetched_at") >= as_of - F.expr(f"INTERVAL {int(hours)} HOURS")
    )


def robots_filter(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """R3 + J5: ``(url, allowed)``.

    Any matching allow wins, then any matching disallow denies, otherwise the
    URL is allowed; a host without rules and an unparsable URL are allowed.
    Only the percent-decoded path is matched (no query); a blank path is ``/``.
    The rules of a host are one row (bounded by its one file): a pattern of all
    its allow rules and one of all its disallow rules. URLs come sorted by host,
    and ``regexp_instr`` keeps its last compiled pattern, so a pattern is compiled
    once for a host's run of URLs and not for each (URL, rule).
    """
    raw_path = url_part(F.col("url"), 3)
    path = F.try_url_decode(F.replace(raw_path, F.lit("+"), F.lit("%2B")))
    keyed = urls.select(
        "url",
        url_host(F.col("url")).alias("host"),
        F.when(raw_path == "", F.lit("/")).otherwise(path).alias("path"),
        invalid_url(F.col("url")).alias("unparsable"),
    )

    def one_of(kind: str) -> Column:
        """The patterns of a kind as one; null where a host has none."""
        each = F.collect_set(F.when(F.col("kind") == kind, F.concat(F.lit("(?:"), "regex", F.lit(")"))))
        return F.nullif(F.array_join(F.array_sort(each), "|"), F.lit("")).alias(kind)

    per_host = rules.groupBy(F.col("host").alias("r_host")).agg(one_of("allow"), one_of("disallow"))
    joined = keyed.sortWithinPartitions("host").join(per_host, F.col("host") == F.col("r_host"), "left")

    def any_of(kind: str) -> Column:
        return F.coalesce(F.regexp_instr("path", F.col(kind)) > 0, F.lit(False))

    return joined.select("url", (F.col("unparsable") | any_of("allow") | ~any_of("disallow")).alias("allowed"))


def fetch_schedule(urls: DataFrame, delays: DataFrame) -> DataFrame:
    """``(url, host, n, offset_s)``: the n-th fetch on a host starts ``(n - 1) * delay`` after the first.

    ``urls(url, ord)`` gives the fetch order. Hosts are numbered by range
    partitioning, so one host with most of the URLs is still split over tasks.
    """
    keyed = urls.select("url", "ord", url_host(F.col("url")).alias("host"))
    numbered = number_rows(keyed, [F.col("ord"), F.col("url")], ["host"], name="n")
    d = delays.select(F.col("host").alias("d_host"), "delay_s")
    joined = numbered.join(d, numbered["host"] == d["d_host"], "left")
    delay = F.coalesce(F.col("delay_s"), F.lit(0.0))
    return joined.select("url", "host", F.col("n").cast("bigint"), ((F.col("n") - 1) * delay).alias("offset_s"))
