"""Readers for the input tables and the document views the operators index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table: ``{sf_dir}/{name}.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Session setting: spread text scans over so many partitions before CPU-heavy work.
READ_PARTITIONS = "spark.trawl.readPartitions"


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows out evenly when the session sets ``spark.trawl.readPartitions``; else leave the scan as it is.

    Meant for few large files with one row group each, which Spark can't split.
    """
    n = df.sparkSession.conf.get(READ_PARTITIONS, None)
    return df.repartition(int(n)) if n else df


def text_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as indexable rows ``(url, text, doc_id, lang)``; the url is ``doc:<doc_id>``."""
    docs = spread(read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return docs.select(F.concat(F.lit("doc:"), F.col("doc_id")).alias("url"), "text", "doc_id", "lang")


def web_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` as ``(page_id, url, html)``."""
    return spread(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``benchmark`` as a table of queries ``(qid, q)``: each whole text is one query."""
    return read_table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), F.col("text").alias("q"))
