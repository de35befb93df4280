"""Session helpers: a local session for tests and bench, and shared scratch paths.

On a cluster the session is created by the platform; the library only reads
``spark.checkpoint.dir`` from it. A local temporary folder is used only when
the master is ``local`` and no checkpoint folder is configured (tests, bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "trawl") -> SparkSession:
    """A ``local[cpus]`` session configured the way tests and bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TRAWL_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # the test tables are single files of one row group
        .config("spark.trawl.readPartitions", str(shuffle_partitions))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, configuring the context with it.

    The folder comes from ``spark.checkpoint.dir``. Only a local-mode session
    without one gets a fresh temporary folder; on a cluster a missing setting is
    an error, because a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="trawl-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def materialize(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to a fresh table in the shared scratch folder and read it back: computed once, of known size, lineage cut.

    Columnar files: a small part of what a checkpoint of the same rows takes.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(df: DataFrame) -> None:
    """Delete the files of a ``materialize``d table that nothing reads any more."""
    spark = df.sparkSession
    base = spark._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark).rstrip('/')}/scratch")
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        at = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if at.getParent().toUri().getPath() == base.toUri().getPath():
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/scratch/{name}-{uuid.uuid4().hex[:12]}"
