"""Crawl and batch reports over fetch logs and indexes.

A fetch log is ``(url, ts, status)``: one row per fetch attempt; status 200
is a document, anything else an error. Every attempted URL counts as visited.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trawl.operators.sequence import number_rows

BATCH_SIZE = 150
TICK_SECONDS = 30
_US = 1_000_000


def crawl_report(fetches: DataFrame) -> DataFrame:
    """One row: URLs visited (errors included), documents, errors, elapsed time and speed.

    One grouping by URL, then plain counts.
    """
    per_url = fetches.groupBy("url").agg(
        F.bool_or(F.col("status") == 200).alias("ok"),
        F.bool_or(F.col("status") != 200).alias("bad"),
        F.count(F.lit(1)).alias("n"),
        F.min("ts").alias("first"),
        F.max("ts").alias("last"),
    )
    agg = per_url.agg(
        F.count("url").alias("visited"),
        F.count_if(F.col("ok") & F.col("url").isNotNull()).alias("documents"),
        F.count_if(F.col("bad") & F.col("url").isNotNull()).alias("errors"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("fetches"),
        ((F.unix_micros(F.max("last")) - F.unix_micros(F.min("first"))) / _US).alias("elapsed_s"),
    )
    ms_per_page = F.col("elapsed_s") * 1000 / F.col("visited")
    return agg.select(
        "*",
        ms_per_page.alias("ms_per_page"),
        F.when(ms_per_page > 0, 1000 / ms_per_page).alias("pages_per_second"),
    )


def document_batches(docs: DataFrame, order: Column, site: str, size: int = BATCH_SIZE) -> DataFrame:
    """``batch_id = floor((n - 1) / size)`` in arrival order within each site.

    Numbered by range partitioning, so one site holding most documents is
    still spread over many tasks.
    """
    numbered = number_rows(docs.withColumn("_ord", order), [F.col("_ord"), F.col("url")], [site], name="n")
    return numbered.drop("_ord").withColumn("batch_id", F.floor((F.col("n") - 1) / size).cast("bigint"))


def batch_report(batches: DataFrame, site: str) -> DataFrame:
    """Per (site, batch): documents, postings (terms written) and words, from per-document sizes."""
    return batches.groupBy(site, "batch_id").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum("n_postings").cast("bigint").alias("n_postings"),
        F.sum("word_count").cast("bigint").alias("n_words"),
    )


def stall_ticks(fetches: DataFrame, tick_seconds: int = TICK_SECONDS) -> DataFrame:
    """Progress at every tick ``start + k * tick`` (k >= 1) of a crawl.

    ``visited`` is the number of distinct URLs first fetched before the tick;
    a tick is stalled when visited > 0 and unchanged since the previous tick
    (no new URL in it). ``first_stall`` marks the first stalled tick, where
    the crawl would stop.

    The running count is two-level, so no window spans all ticks: a running
    sum within each day of ticks plus the total of all earlier days.
    """
    spark = fetches.sparkSession
    tick_us = tick_seconds * _US
    first = fetches.groupBy("url").agg(F.unix_micros(F.min("ts")).alias("first_us"))
    start_us = fetches.select(F.unix_micros(F.min("ts"))).scalar()
    k_of = ((F.col("first_us") - start_us) / tick_us).cast("bigint") + 1
    new = first.select(k_of.alias("tick")).groupBy("tick").agg(F.count(F.lit(1)).alias("new"))
    last_tick = new.agg(F.max("tick")).first()[0] or 0
    ticks = spark.range(1, last_tick + 1).select(F.col("id").alias("tick"))
    per_day = 86_400 // tick_seconds
    rows = ticks.join(new, "tick", "left").select(
        "tick", (F.col("tick") / per_day).cast("bigint").alias("day"), F.coalesce("new", F.lit(0)).alias("new")
    )
    day_totals = rows.groupBy("day").agg(F.sum("new").alias("day_new"))
    before = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)  # one row per day
    offsets = day_totals.select("day", F.coalesce(F.sum("day_new").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("day").orderBy("tick").rowsBetween(Window.unboundedPreceding, 0)
    visited = rows.join(offsets, "day").select(
        "tick", "new", (F.col("offset") + F.sum("new").over(within)).cast("bigint").alias("visited")
    )
    flagged = visited.withColumn("stalled", (F.col("visited") > 0) & (F.col("new") == 0))
    first_stall = flagged.where("stalled").select(F.min("tick")).scalar()
    return flagged.select(
        "tick",
        F.col("new").cast("bigint"),
        "visited",
        "stalled",
        F.coalesce(F.col("tick") == first_stall, F.lit(False)).alias("first_stall"),
    )
