"""Corpus pipeline: five training-data operators one after the other over ``documents``.

1. quality classifier: documents that the rule ensemble rejects go;
2. line dedup: lines with an earlier match go, and documents that lose all of theirs;
3. SimHash near-dedup: one document of each component stays;
4. mixing: documents are taken, up to a few epochs, until their source's budget is spent;
5. best-fit packing: what is left as token sequences.

All stages but the last return the columns of ``documents``. Each works on all
rows its predecessor kept, and the model of the first is fitted on the given
documents' labels outside the held-out fifth.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.llm import line_dedup, mixing, packing, quality, simhash
from trawl.llm.common import materialize, read


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels", "doc_id", "quality")
    model = quality.fit_on_kept_labels(docs.select("doc_id", "text"), labels)
    return docs.where(model.score(F.col("text")) >= quality.THRESHOLD)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(docs, mixing.CORPUS_MIX).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_repeated_lines),
    ("simhash near-dedup", drop_near_duplicates),
    ("mixing", mix),
    ("best-fit packing", pack),
]

# SQL can express neither the fitted classifier nor the tokeniser; tests/llm/test_pipeline.py has a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
