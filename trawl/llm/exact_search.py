"""Exact top-k by inner product with norm buckets (operator 3).

Method: candidates are grouped by vector length into buckets of a factor
``LENGTH_FACTOR``. Each query first gets a threshold, its k-th best product
with a fixed number of the longest vectors. In a bucket whose longest vector
has length ``l``, only candidates with a cosine of at least
``t = threshold / (|query| l)`` can matter, so

- ``t > 1`` prunes the bucket (pairs of query blocks and buckets where this
  holds for all queries are never formed),
- from ``COORDINATE_FROM`` on, coordinate pruning: a few focus coordinates with
  the largest share of the query bound the candidate's coordinates, the sorted
  list of the most selective one gives the candidates, the others filter them,
- below it, length pruning: candidates sorted by length, the prefix long enough
  to reach the threshold.

What is left is verified by its full product. Nothing is approximate: every
bound is widened by a rounding margin, and the products are exact integers.

Work is dealt into groups of one part of a bucket (about ``PART_ROWS``
candidates, however many vectors share a length) and one block of queries, so
no group grows with the data. Thresholds come from at most ``SEEDS`` vectors,
which alone pass through the driver.

Defined results: vectors that are null or hold null, NaN or infinite components
take no part, nor do rows without an id; products are taken between vectors of
the same dimension; rows alike in id and vector count once; two vectors under
one query id are two queries; products beyond a long saturate.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import materialize, ship_package
from trawl.llm.vectors import best, dealt, distinct_vectors, finite, merged, to_numpy

LENGTH_FACTOR = 1.05
COORDINATE_FROM = 0.5
FOCUS = 4
PART_ROWS = 4096
BLOCK_QUERIES = 512
SEEDS = 1024
# Relative margin for bounds computed in double precision.
MARGIN = 1e-9
FOUND = "query_id bigint, query_key bigint, vec_id bigint, score bigint"
_FAR = 1 << 53


def scaled(vec: Column, factor: int = 1024) -> Column:
    """``floor(factor * x)`` of each component, as longs; null where a vector isn't finite."""
    whole = F.transform(vec, lambda x: F.floor(x.cast("double") * factor).cast("bigint"))
    return F.when(finite(vec), whole)


def _length(vec: Column) -> Column:
    return F.sqrt(F.aggregate(vec, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def products(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact integer products of the rows of ``p`` with ``q``, as longs."""
    bound = np.sqrt((p.astype(float) ** 2).sum(axis=1).max(initial=0)) * math.sqrt((q.astype(float) ** 2).sum())
    if bound < _FAR / 2:  # every partial sum is an integer that a double holds
        return (p.astype(float) @ q.astype(float)).astype(np.int64)
    exact = p.astype(object) @ q.astype(object)
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


class Part:
    """One part of a norm bucket, ready for both kinds of pruning."""

    def __init__(self, ids: np.ndarray, vecs: np.ndarray) -> None:
        lengths = np.sqrt((vecs.astype(float) ** 2).sum(axis=1))
        order = np.argsort(-lengths, kind="stable")
        self.ids, self.vecs, self.lengths = ids[order], vecs[order], lengths[order]
        self.longest = float(self.lengths[0])
        self.unit = self.vecs / np.where(self.lengths > 0, self.lengths, 1)[:, None]
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sorted_list(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self.lists:
            order = np.argsort(self.unit[:, f], kind="stable")
            self.lists[f] = self.unit[order, f], order
        return self.lists[f]

    def candidates(self, q: np.ndarray, length: float, threshold: float) -> np.ndarray:
        """Positions that may reach the threshold."""
        n = len(self.ids)
        reach = length * self.longest
        if threshold <= -reach or reach == 0:
            return np.arange(n)
        t = threshold / reach - MARGIN
        if t > 1:
            return np.arange(0)
        if t < COORDINATE_FROM:
            if threshold <= 0:
                return np.arange(n)
            return np.arange(np.searchsorted(-self.lengths, -(threshold / length) * (1 - MARGIN), side="right"))
        unit = q / length
        focus = np.argsort(-np.abs(unit))[:FOCUS]
        spread = math.sqrt(max(0.0, 1 - t * t))
        ranges = []
        for f in focus:
            # a unit vector whose cosine with the query is at least t has this coordinate between low and high
            x = float(np.clip(unit[f], -1, 1))
            side = spread * math.sqrt(1 - x * x)
            low = -1.0 if -x >= t else x * t - side
            high = 1.0 if x >= t else x * t + side
            ranges.append((int(f), low - MARGIN, high + MARGIN))
        spans = []
        for f, low, high in ranges:
            values, order = self.sorted_list(f)
            a, b = np.searchsorted(values, low), np.searchsorted(values, high, side="right")
            spans.append((b - a, a, b, order))
        _, a, b, order = min(spans, key=lambda s: s[0])
        at = order[a:b]
        for f, low, high in ranges:
            x = self.unit[at, f]
            at = at[(x >= low) & (x <= high)]
        return at

    def search(self, query_id: int, q: np.ndarray, threshold: float, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact products of the best ``k`` here that reach the threshold."""
        at = self.candidates(q.astype(float), math.sqrt((q.astype(float) ** 2).sum()), threshold)
        at = at[self.ids[at] != query_id]
        scores = products(self.vecs[at], q)
        reach = scores >= threshold
        ids, scores = self.ids[at][reach], scores[reach]
        top = best(ids, scores, k)
        return ids[top], scores[top]


def _with_thresholds(queries: DataFrame, seeds: list, k: int) -> DataFrame:
    """``queries`` with ``threshold``: the k-th best product with the seeds, else minus infinity."""
    by_dim: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for dim in {s["dim"] for s in seeds}:
        own = [s for s in seeds if s["dim"] == dim]
        by_dim[dim] = np.array([s["id"] for s in own]), np.array([s["vec"] for s in own], dtype=np.int64)

    @F.pandas_udf("double")
    def threshold(ids: pd.Series, vecs: pd.Series) -> pd.Series:
        out = []
        for i, v in zip(ids, vecs):
            known = by_dim.get(len(v))
            scores = products(known[1], np.asarray(v))[known[0] != i] if known else []
            # as a double, and one step lower, so that rounding never raises it
            out.append(np.nextafter(float(np.sort(scores)[-k]), -np.inf) if len(scores) >= k else -np.inf)
        return pd.Series(out, dtype="float64")

    return queries.withColumn("threshold", threshold("id", "vec"))


def exact_top_k(
    candidates: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vec: str = "vec"
) -> DataFrame:
    """The ``k`` highest integer products of each query with all other ids: ``(query_id, rank, vec_id, score)``.

    ``vec`` holds arrays of longs in both tables.
    """
    ship_package(candidates.sparkSession)
    every = distinct_vectors(candidates, id_col, F.col(vec)).where("dim > 0").withColumn("length", _length(F.col("vec")))
    seeds = every.orderBy(F.desc("length"), "id").limit(SEEDS).select("id", "dim", "vec").collect()
    asked = distinct_vectors(queries, id_col, F.col(vec)).where("dim > 0")
    n_blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    asked = _with_thresholds(asked, seeds, k).withColumns(
        {"block": dealt(F.lit(n_blocks)), "key": F.xxhash64("vec"), "length": _length(F.col("vec"))}
    )
    asked = materialize(asked, "queries")

    # Levels are bounded in number: the logarithm of a double's range over that of the factor.
    level = F.when(F.col("length") > 0, F.floor(F.log("length") / math.log(LENGTH_FACTOR))).otherwise(-(1 << 20)).cast("int")
    every = every.withColumn("level", level)
    levels = (
        every.groupBy("dim", "level").agg(F.count("*").alias("n"), F.max("length").alias("longest"))
        .withColumn("parts", F.ceil(F.col("n") / PART_ROWS).cast("int"))
    )
    # least cosine-free bound of a block: what a vector must be as long as to matter to any of its queries
    needs = asked.groupBy("dim", "block").agg(
        F.min(F.when(F.col("length") > 0, F.col("threshold") / F.col("length")).otherwise(float("-inf"))).alias("needed")
    )
    pairs = materialize(
        levels.join(needs, "dim").where(F.col("needed") <= F.col("longest") * (1 + MARGIN)).select("dim", "level", "parts", "block"),
        "pairs",
    )
    blocks = pairs.groupBy("dim", "level", "parts").agg(F.collect_list("block").alias("blocks"))
    left = (
        every.join(blocks, ["dim", "level"])
        .withColumn("part", dealt(F.col("parts")))
        .select("dim", "level", "part", F.explode("blocks").alias("block"), "id", "vec")
    )
    right = asked.join(pairs, ["dim", "block"]).select(
        "dim", "level", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "block", "id", "vec", "key", "threshold"
    )
    keys = ["dim", "level", "part", "block"]

    def search(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if candidates.num_rows and queries.num_rows:
            part = Part(*to_numpy(candidates, np.int64))
            ids, vecs = to_numpy(queries, np.int64)
            for i, q, key, t in zip(ids, vecs, queries.column("key").to_pylist(), queries.column("threshold").to_pylist()):
                found, scores = part.search(i, q, t, k)
                out.append((np.full(len(found), i), np.full(len(found), key), found, scores))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.array([], dtype=np.int64)] * 4
        return pa.table([pa.array(c, type=pa.int64()) for c in columns], names=["query_id", "query_key", "vec_id", "score"])

    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, FOUND)
    return merged(found, k)
