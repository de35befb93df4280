"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.session import scratch_path

# Rows and bytes of an Arrow batch where a row is a whole text: a batch of very long texts still fits a worker.
TEXT_ROWS_PER_BATCH = 1000
TEXT_BYTES_PER_BATCH = 64 << 20


def read(spark: SparkSession, sf_dir: str, table: str, *cols: str) -> DataFrame:
    """One input table through Spark's own reader, so any file system Spark knows works."""
    df = spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{table}.parquet")
    return df.select(*cols) if cols else df


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the executors once, as ``spark-submit --py-files`` would."""
    sc = spark.sparkContext
    if getattr(sc, "_trawl_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="trawl-code-"), "trawl-code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith((".py", ".json")):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(archive)
    sc._trawl_shipped = True


def small_batches(df: DataFrame) -> DataFrame:
    """Get ``df`` ready for Python workers: code shipped, and a bound on the rows and bytes of an Arrow batch.

    The bounds are session settings, read when the job runs, so they stay set.
    """
    ship_package(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_ROWS_PER_BATCH))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(TEXT_BYTES_PER_BATCH))
    return df


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table under ``spark.checkpoint.dir`` and read it back: lineage ends there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bits_apart(a: Column, b: Column) -> Column:
    """Hamming distance of two longs."""
    return F.bit_count(a.bitwiseXOR(b))
