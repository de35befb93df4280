"""Vectors as bounded groups: queries in blocks against parts of the candidates."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def finite(vec: Column) -> Column:
    """True for an array without null, NaN or infinite components (and not null itself)."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(vec.isNotNull() & ~F.exists(vec, bad), F.lit(False))


def distinct_vectors(df: DataFrame, id_col: str, vec: Column) -> DataFrame:
    """``(id, vec, dim)`` without invalid vectors; rows alike in id and vector count once.

    The distinct is aggregated before its shuffle, so a row repeated many times
    is no hot key.
    """
    valid = df.select(F.col(id_col).cast("bigint").alias("id"), vec.alias("vec")).where("id IS NOT NULL")
    return valid.where(finite(F.col("vec").cast("array<double>"))).distinct().withColumn("dim", F.size("vec"))


def dealt(n: Column) -> Column:
    """Which of ``n`` parts a vector falls in, the same in every run."""
    return F.pmod(F.xxhash64("id", "vec"), n).cast("int")


def to_numpy(table: pa.Table, dtype: type) -> tuple[np.ndarray, np.ndarray]:
    """Ids, and vectors as a matrix."""
    ids = table.column("id").to_numpy()
    vec = table.column("vec").combine_chunks()
    flat = vec.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    return ids, flat.reshape(len(ids), -1)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest scores, best first, ties to smaller ids."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.nonzero(scores >= least)[0]
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def merged(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query from the best of every part: ``(query_id, rank, vec_id, score)``.

    A query has at most ``k`` rows from each part, and Spark keeps ``k`` of
    them before the shuffle.
    """
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
