"""The stop-list source.

The list is a JSON object with one array ``stopwords``. The default list ships
with the package (fixed values) and is read as package data, so it doesn't
depend on any file system setting. A file that the caller names is read by
Spark; if it isn't there or isn't such an object, the list is empty, not an error.
"""

from __future__ import annotations

import json
from functools import lru_cache
from importlib import resources

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SCHEMA = T.StructType([T.StructField("stopwords", T.ArrayType(T.StringType()))])


def read_stop_words(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Stop list as a one-column DataFrame ``(word)``, distinct."""
    words = F.array(*[F.lit(w) for w in stop_word_list(spark, path)]).cast("array<string>")
    return spark.range(1).select(F.explode(words).alias("word"))


def stop_word_list(spark: SparkSession | None = None, path: str | None = None) -> tuple[str, ...]:
    """The stop list as a small in-expression constant (a config file, not data).

    Used to build an ``InSet`` predicate inside the tokenising projection so the
    filter runs in the same codegen stage as the split, with no join at all.
    """
    if path is None:
        return _packaged()
    try:
        raw = spark.read.schema(_SCHEMA).option("multiLine", "true").option("mode", "PERMISSIVE").json(path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return ()
    words = raw.select(F.explode_outer("stopwords").alias("word")).where("word IS NOT NULL")
    return tuple(dict.fromkeys(r["word"] for r in words.collect()))


@lru_cache(maxsize=1)
def _packaged() -> tuple[str, ...]:
    words = json.loads(resources.files("trawl.sources").joinpath("stop_words.json").read_text(encoding="utf-8"))["stopwords"]
    return tuple(dict.fromkeys(words))
