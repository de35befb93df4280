"""Fetch results as a page source.

Only status 200 is a page; any other status (or a fetch error) becomes an
error row that is not indexed but still counts as visited.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_fetches(fetched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``fetched(url, status, html[, error])`` -> ``(pages(url, html), errors(url, error))``."""
    has_error = "error" in fetched.columns
    err = F.col("error") if has_error else F.lit(None).cast("string")
    ok = F.coalesce(F.col("status") == 200, F.lit(False)) & err.isNull()
    pages = fetched.where(ok).select("url", "html")
    message = F.coalesce(err, F.concat(F.lit("unexpected status code: "), F.coalesce(F.col("status").cast("string"), F.lit("none"))))
    errors = fetched.where(~ok).select("url", message.alias("error"))
    return pages, errors


def fetch_outcomes(fetched: DataFrame) -> DataFrame:
    """Both sides of the split in one table: ``(url, ok, error)``."""
    pages, errors = split_fetches(fetched)
    return pages.select("url", F.lit(True).alias("ok"), F.lit(None).cast("string").alias("error")).unionByName(
        errors.select("url", F.lit(False).alias("ok"), "error")
    )
