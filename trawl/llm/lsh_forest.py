"""Approximate nearest neighbours with a hash-prefix forest (operator 5).

Method: each tree gives every vector a hash string of 64 bits (signs of random
projections) and keeps the strings in a sorted array. A query descends in each
tree to the longest prefix it shares with any string, found by binary search;
then all trees ascend together, one prefix bit at a time, until the prefixes
together cover at least ``min_candidates`` entries. All vectors below these
prefixes are candidates (a prefix with more is taken whole, so there is no cap)
and are ranked by their exact inner product.

The vectors are dealt into shards of about ``SHARD_ROWS`` rows, each with a
forest of its own, and every query block is answered by every shard; the best
of all shards are merged. Every row is indexed, a task holds one shard and one
block, and copies of one vector spread over the shards. The share of a shard
that is looked at, and with it the recall, doesn't depend on how many shards
there are. Projections are drawn from a fixed seed, nothing is fitted.

Hash strings depend on direction only; the measure is the inner product, so
recall is meant for vectors of similar length (README: measured recall).

Defined results: vectors that are null, zero, or hold null, NaN or infinite
components take no part, nor do rows without an id; neighbours have the query's
dimension; rows alike in id and vector count once; two vectors under one query
id are two queries.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import ship_package
from trawl.llm.vectors import best, dealt, distinct_vectors, merged, to_numpy

TREES = 32
BITS = 64
MIN_CANDIDATES = 5000
SHARD_ROWS = 8192
BLOCK_QUERIES = 2048
SEED = 20
FOUND = "query_id bigint, query_key bigint, vec_id bigint, score double"
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def hash_strings(vecs: np.ndarray, trees: int, seed: int = SEED) -> np.ndarray:
    """``(trees, rows)`` strings of 64 bits, first bit highest."""
    weights = np.uint64(1) << np.arange(BITS, dtype=np.uint64)[::-1]
    unit = vecs / np.abs(vecs).max(axis=1, keepdims=True)  # so that no projection overflows
    out = np.empty((trees, len(vecs)), dtype=np.uint64)
    for t in range(trees):
        planes = np.random.default_rng((seed, t)).standard_normal((vecs.shape[1], BITS))
        out[t] = ((unit @ planes > 0) * weights).sum(axis=1, dtype=np.uint64)
    return out


class Forest:
    """Sorted arrays of hash strings, one per tree."""

    def __init__(self, ids: np.ndarray, vecs: np.ndarray, trees: int = TREES) -> None:
        self.ids, self.vecs, self.trees = ids, vecs, trees
        # equal vectors get their exact product from the same row, the first of them
        whole = np.ascontiguousarray(vecs + 0.0)  # -0.0 is 0.0
        _, first, same = np.unique(whole.view(np.dtype((np.void, whole.dtype.itemsize * whole.shape[1]))).ravel(), return_index=True, return_inverse=True)
        self.first = first[same.ravel()]
        # a product in another order of adding differs by less than this times the query's length
        self.error = 2 * (vecs.shape[1] + 2) * np.finfo(np.float64).eps * np.linalg.norm(vecs, axis=1)
        strings = hash_strings(vecs, trees)
        self.order = np.argsort(strings, axis=1, kind="stable")
        self.strings = np.take_along_axis(strings, self.order, axis=1)

    def ranges(self, strings: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each tree and query, the entries that share the query's first ``bits`` bits."""
        mask = np.where(bits > 0, _ALL << (np.uint64(BITS) - np.maximum(bits, 1).astype(np.uint64)), np.uint64(0))
        low = np.stack([np.searchsorted(s, q & mask) for s, q in zip(self.strings, strings)])
        high = np.stack([np.searchsorted(s, q | ~mask, side="right") for s, q in zip(self.strings, strings)])
        return low, high

    def ascend(self, strings: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """The ranges at the longest prefix, the same in all trees, that covers ``least`` entries.

        The cover only grows on the way up, so the level where the ascent
        stops, starting from the deepest match, is found by bisection.
        """
        short = np.zeros(strings.shape[1], dtype=np.int64)
        long = np.full(strings.shape[1], BITS + 1)
        while (long - short > 1).any():
            middle = (short + long) // 2
            low, high = self.ranges(strings, middle)
            enough = (high - low).sum(axis=0) >= least
            short, long = np.where(enough, middle, short), np.where(enough, long, middle)
        return self.ranges(strings, short)

    def within_error(self, at: np.ndarray, scores: np.ndarray, q: np.ndarray, k: int) -> np.ndarray:
        """Positions of all scores that may be among the best ``k`` once they are exact."""
        if len(scores) <= k:
            return np.arange(len(scores))
        with np.errstate(invalid="ignore", over="ignore"):
            error = self.error[at] * np.linalg.norm(q) + len(q) * np.finfo(np.float64).tiny
            lowest = scores - error
            lowest[np.isnan(lowest)] = -np.inf
            least = np.partition(lowest, len(lowest) - k)[len(lowest) - k]
            return np.nonzero(~(scores + error < least))[0]

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, least: int):
        """Ids and exact products of the best ``k`` candidates of each query."""
        low, high = self.ascend(hash_strings(queries, self.trees), least)
        seen = np.zeros(len(self.ids), dtype=bool)
        for j, q in enumerate(queries):
            seen[:] = False
            for t in range(self.trees):
                seen[self.order[t, low[t, j] : high[t, j]]] = True
            at = np.nonzero(seen & (self.ids != query_ids[j]))[0]
            scores = self.vecs[at] @ q
            near = self.within_error(at, self.vecs[at] @ q, q, k)
            # exactly one way of adding up for what is returned, whatever the matrix product does
            rows, which = np.unique(self.first[at[near]], return_inverse=True)
            exact = np.array([float(np.dot(self.vecs[i], q)) for i in rows])[which.ravel()]
            top = best(self.ids[at[near]], exact, k)
            yield self.ids[at[near]][top], exact[top]


def nearest(
    candidates: DataFrame,
    queries: DataFrame,
    k: int,
    id_col: str = "vec_id",
    vec: str = "embedding",
    trees: int = TREES,
    min_candidates: int = MIN_CANDIDATES,
) -> DataFrame:
    """About the ``k`` largest inner products of each query: ``(query_id, rank, vec_id, score)``."""
    ship_package(candidates.sparkSession)

    def valid(df: DataFrame) -> DataFrame:
        doubles: Column = F.col(vec).cast("array<double>")
        return distinct_vectors(df, id_col, doubles).where(F.exists("vec", lambda x: x != 0))

    every, asked = valid(candidates), valid(queries)
    shards = max(1, -(-every.count() // SHARD_ROWS))
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = every.select("dim", dealt(F.lit(shards)).alias("shard"), numbers(blocks).alias("block"), "id", "vec")
    right = asked.select(
        "dim", numbers(shards).alias("shard"), dealt(F.lit(blocks)).alias("block"), "id", "vec", F.xxhash64("vec").alias("key")
    )
    keys = ["dim", "shard", "block"]

    def search(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows and queries.num_rows:
            forest = Forest(*to_numpy(rows, np.float64), trees)
            ids, vecs = to_numpy(queries, np.float64)
            found = forest.search(ids, vecs, k, min_candidates)
            for i, key, (near, scores) in zip(ids, queries.column("key").to_pylist(), found):
                out.append((np.full(len(near), i), np.full(len(near), key), near, scores))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.array([])] * 4
        kinds = [pa.int64()] * 3 + [pa.float64()]
        return pa.table([pa.array(c, type=t) for c, t in zip(columns, kinds)], names=["query_id", "query_key", "vec_id", "score"])

    return merged(left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, FOUND), k)
