"""The index on disk as Parquet.

One dataset holds both tables, partitioned by ``term_bucket``::

    term_bucket=-1/         documents: url, word_count, seq (term, cnt, tf null)
    term_bucket=B/          postings:  term, url, cnt, word_count, tf, seq (sorted by term)
    _terms/term_bucket=B/   term statistics: term, df (document frequency), max_tf (the largest tf)
    _meta/                  the number of buckets

``term_bucket = pmod(xxhash64(term), buckets)``; the caller gives the number
of buckets, about one per 256 MB of postings. The rows of an index are computed
once, then range-partitioned on (bucket, term, url): a lookup of known terms
reads only their buckets (static or dynamic partition pruning), within a bucket
the files hold disjoint ranges of terms, so only files (and row groups) with the
term are opened, and a very frequent term is split over files by url.

``append_index`` adds a part beside the index (``_parts/part=P/shift=S/``), a
document with its terms as one row where the part was built from text; ``S`` puts its
``seq`` behind all that was there. An index with parts is unresolved until it is
read: searches apply W1 before any statistic is taken, and ``compact_index`` writes
it back as one. An index that grows all the
time is better kept in ``run_store``, which settles W1 when it appends.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.operators.indexing import DOCUMENT_COLUMNS, POSTING_COLUMNS, Index, index_of_packed
from trawl.session import drop_scratch, ensure_checkpoint_dir, materialize

# Of what an index keeps on disk: a third smaller than the default.
COMPRESSION = "zstd"


def term_bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def tf_of() -> Column:
    """A3 of a row that was built from text; null for a document's row."""
    return F.when(F.col("term").isNotNull(), F.col("cnt") / F.col("word_count"))


def in_term_order(rows: DataFrame, buckets: int) -> DataFrame:
    """``rows`` with ``term_bucket``, range-partitioned and sorted on (bucket, term, url); documents are in bucket -1.

    Shuffled as they come: what can be made from them (the bucket, tf, constants) is added behind the shuffle.
    """
    bucket = F.when(F.col("term").isNull(), F.lit(-1)).otherwise(term_bucket(F.col("term"), buckets))
    dealt = rows.repartitionByRange(bucket, "term", "url").withColumn("term_bucket", bucket)
    return dealt.sortWithinPartitions("term_bucket", "term", "url")


def write_buckets(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).option("compression", COMPRESSION).partitionBy("term_bucket").parquet(path)


def combined_rows(index: Index) -> DataFrame:
    """``(url, seq, word_count, term, cnt, tf)``: document rows (term null) and postings together."""
    if index.rows is not None:
        return index.rows.select("url", "seq", "word_count", "term", "cnt", tf_of().alias("tf"))
    docs = index.documents.select(
        "url", "seq", "word_count",
        F.lit(None).cast("string").alias("term"), F.lit(None).cast("bigint").alias("cnt"),
        F.lit(None).cast("double").alias("tf"),
    )
    return docs.unionByName(index.postings.select("url", "seq", "word_count", "term", "cnt", "tf"))


def kept_rows(index: Index) -> DataFrame:
    """``combined_rows`` of a resolved index, computed once and kept in scratch files; a document stays one row there.

    ``tf`` is left out of an index built from text (``tf_of`` makes it).
    """
    if index.packed is None:
        return materialize(combined_rows(index), "index-rows")
    return kept_index(index).rows


def kept_index(index: Index) -> Index:
    """An index built from text, its text analysed once and its documents kept in scratch files."""
    return index_of_packed(materialize(index.packed, "index-rows", COMPRESSION))


def write_index(index: Index, path: str, *, buckets: int, mode: str = "overwrite") -> None:
    """Write documents, postings and term statistics of the resolved index.

    ``mode`` is ``overwrite`` (replaces any old index) or ``error`` (the caller
    picks, D11); adding to an index is ``append_index``.
    """
    if mode not in ("overwrite", "error"):
        raise ValueError(f"mode {mode!r}: an index is overwritten or written anew; use append_index to add to one")
    spark = index.documents.sparkSession
    ensure_checkpoint_dir(spark)
    # Computed once: range partitioning reads its input twice (sample and rows).
    rows = kept_rows(index.resolved())
    tf = "tf" if "tf" in rows.columns else tf_of().alias("tf")
    write_buckets(in_term_order(rows, buckets).select("url", "seq", "word_count", "term", "cnt", tf, "term_bucket"), path, mode)
    drop_scratch(rows)
    # Term statistics from the postings just written (one column read, map-side
    # partial counts), bucketed like the postings for pruned lookups.
    written = spark.read.parquet(path).where(F.col("term_bucket") >= 0)
    stats = written.groupBy("term_bucket", "term").agg(F.count(F.lit(1)).alias("df"), F.max("tf").alias("max_tf"))
    write_buckets(stats.hint("rebalance", "term_bucket").sortWithinPartitions("term_bucket", "term"), f"{path}/_terms", mode)
    # A one-row side table (ignored by partition discovery: leading '_'),
    # written last: it is the commit marker of a complete index.
    spark.createDataFrame([(buckets,)], "buckets INT").write.mode(mode).json(f"{path}/_meta")


def append_index(part: Index, path: str) -> None:
    """Add ``part`` to the index at ``path``: after everything already there, whatever its own ``seq``.

    Documents stay first-wins and postings last-wins across parts. One writer
    at a time; a part shows up when its write is committed.
    """
    spark = part.documents.sparkSession
    _, table, parts = _stored(spark, path)
    seqs = table.select("seq") if parts is None else table.select("seq").unionByName(parts.select("seq"))
    newest = seqs.agg(F.max("seq")).first()[0]
    part = part.resolved()
    rows = combined_rows(part) if part.packed is None else part.packed
    name, fs, at = uuid.uuid4().hex[:12], *_files(spark, path)
    staged = f"{path}/_staged/{name}"
    rows.write.option("compression", COMPRESSION).parquet(staged)
    oldest = spark.read.schema(rows.schema).parquet(staged).agg(F.min("seq")).first()[0]
    if oldest is None:
        fs.delete(at(staged), True)
        return
    # the shift is in the folder's name, so the rows are written once; a rename commits them
    fs.mkdirs(at(f"{path}/_parts/part={name}"))
    if not fs.rename(at(staged), at(f"{path}/_parts/part={name}/shift={(newest if newest is not None else -1) + 1 - oldest}")):
        raise OSError(f"the part can't be moved to its place at {path}")


def compact_index(index: Index, path: str, *, buckets: int) -> Index:
    """Rewrite an index of appended parts as one resolved index on disk (W1 applied once)."""
    write_index(index, path, buckets=buckets)
    return open_index(index.postings.sparkSession, path)


def _missing(err: AnalysisException) -> bool:
    return err.getCondition() == "PATH_NOT_FOUND"


def _files(spark: SparkSession, path: str):
    """The file system of ``path``, and what makes a path of a name."""
    at = spark._jvm.org.apache.hadoop.fs.Path
    return at(path).getFileSystem(spark._jsc.hadoopConfiguration()), at


_PART_ROWS = (
    "url string, seq bigint, word_count bigint, term string, cnt bigint, tf double, "
    "terms array<struct<term: string, cnt: bigint>>, shift bigint"
)


def _stored(spark: SparkSession, path: str) -> tuple[int, DataFrame, DataFrame | None]:
    """The number of buckets, the rows written as one index, and those of appended parts with their place in ``seq``."""
    try:
        meta = spark.read.schema("buckets INT").json(f"{path}/_meta").first()
    except AnalysisException as err:
        if not _missing(err):
            raise
        meta = None
    if meta is None:
        raise FileNotFoundError(f"no complete index at {path} (missing _meta; the write did not finish)")
    try:
        parts = spark.read.schema(_PART_ROWS).parquet(f"{path}/_parts")
    except AnalysisException as err:
        if not _missing(err):
            raise
        return meta[0], spark.read.parquet(path), None
    return meta[0], spark.read.parquet(path), parts.withColumn("seq", F.col("seq") + F.col("shift"))


def open_index(spark: SparkSession, path: str) -> Index:
    """Read an index written by ``write_index``; postings keep their ``term_bucket`` column."""
    buckets, table, parts = _stored(spark, path)
    documents = table.where(F.col("term_bucket") == -1).select(*DOCUMENT_COLUMNS)
    postings = table.where(F.col("term_bucket") >= 0).select(*POSTING_COLUMNS, "term_bucket")
    if parts is None:
        terms = spark.read.parquet(f"{path}/_terms").select("term", "df", "max_tf", "term_bucket")
        return Index(documents, postings, buckets=buckets, terms=terms)
    added = index_of_packed(parts.select("url", "seq", "word_count", "terms")).postings
    given = parts.where(F.col("term").isNotNull()).select(*POSTING_COLUMNS)
    return Index(
        documents.unionByName(parts.where(F.col("term").isNull()).select(*DOCUMENT_COLUMNS)),
        postings.select(*POSTING_COLUMNS).unionByName(added).unionByName(given),
        is_resolved=False,
    )


def postings_for(index: Index, terms: Iterable[str]) -> DataFrame:
    """Postings of known terms: bucket partitions pruned, ``term IN (...)`` pushed to the Parquet scan."""
    terms = list(dict.fromkeys(terms))
    post = index.postings
    if index.buckets and "term_bucket" in post.columns:
        post = post.where(F.col("term_bucket").isin([term_bucket(F.lit(t), index.buckets) for t in terms]))
    return post.where(F.col("term").isin(terms))
