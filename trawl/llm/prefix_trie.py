"""Prefix trie of conversations by padded turn-id matrices (operator 11).

A turn's id is 128 bits of SHA-256 over (role, text). A conversation is the
sequence of its turn ids, cut into panels of ``PANEL`` turns; a panel's rows
carry a 128-bit hash of what stands before it, so panels of one prefix are a
trie of their own and a very long conversation is many short rows.

Rows are range-partitioned on (panel, prefix, turn ids, conversation) into
shards. In a shard the ids become a matrix padded to its longest row and are
sorted by numpy's lexsort. A row starts a node at depth d if any of its first d
columns differs from the row above: change masks are OR-ed column by column. As
rows of a node are neighbours, ``reduceat`` over the node starts gives every
sum of a depth, from the deepest column up.

Nodes that touch a shard's first or last row may go on in the next shard. They
are put out as partial sums under their path and recombined by one aggregate;
what they owe each other (their own texts, leaves and children) is added through
their paths' prefixes, at most ``PANEL`` a node. All other nodes are complete in
their shard. The totals of a deeper panel go to the smallest conversation of its
prefix, whose rows carry them to every node above.

Turns are numbered by range partitioning (``number_rows``), so a conversation
with most of all turns isn't in one task; only its panels (a row for each
``PANEL`` turns) pass through one running sum. Copies of one conversation or
first turn are split over shards. The digest of a node's ends is a SHA-256 over
all of them, which no two tasks can share: partial lists of a node stream through
one task, a shard's list at a time.

Defined results: null roles and texts are empty; a null turn comes first, turns
of equal number are ordered by their id, repeated rows stay; rows without a
conversation id take no part; a text of any length counts by its hash and size;
a table without conversations gives no rows, not even a root; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trawl.llm.common import materialize, ship_package
from trawl.operators.sequence import number_rows

PANEL = 32
SHARD_ROWS = 100_000
# Copies of an edge node that its children are joined to.
SALTS = 64
ID_BYTES = 16
_HEAD = struct.Struct(">iqq")
NO_ENDS = hashlib.sha256(b"").hexdigest()

NODE, PARTIAL, GROUP = 0, 1, 2
_LONGS = ("conv_id", "parent", "n_convs", "n_children", "n_leaves", "saved", "n_ends", "size", "p1", "p2", "q1", "q2")
_SCHEMA = "kind int, shard int, k int, depth int, key binary, parent_key binary, ends string, " + ", ".join(f"{c} bigint" for c in _LONGS)


# --- conversations as rows ---------------------------------------------------------


def turns_of(conversations: DataFrame) -> DataFrame:
    """``(conv_id, pos, id, size)``: turns by number from 1, with their 128-bit id and UTF-8 size."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.unhex(F.substring(F.sha2(named, 256), 1, 2 * ID_BYTES)).alias("id"),
        F.octet_length(text).cast("bigint").alias("size"),
    )
    numbered = number_rows(turns, [F.col("turn").asc_nulls_first(), F.col("id")], ["conv_id"], name="pos")
    return numbered.select("conv_id", "pos", "id", "size")


def rebuilt(turns: DataFrame, family: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations begun by their family's first: ``(turns, conversations)``.

    Conversation c takes the first h turns of c - c % ``family`` and then its own
    after its first h, with h = crc32(c) % ``heads``: at most ``heads`` - 1 turns are taken over.
    """
    c = F.col("conv_id")
    sizes = turns.groupBy("conv_id").agg(F.max("pos").alias("n"))
    convs = sizes.select("conv_id", "n", (c - c % family).alias("base"), (F.crc32(c.cast("string").cast("binary")) % heads).alias("h"))
    first = turns.where((c % family == 0) & (F.col("pos") < heads))
    first = first.groupBy(c.alias("base")).agg(F.array_sort(F.collect_list(F.struct("pos", "id", "size"))).alias("head"))
    head = F.coalesce("head", F.array().cast("array<struct<pos: bigint, id: binary, size: bigint>>"))
    convs = convs.join(first, "base", "left").withColumn("head", F.slice(head, F.lit(1), F.col("h").cast("int")))
    taken = F.size("head")
    convs = convs.withColumn("taken", taken).withColumn("total", taken + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    front = convs.select("conv_id", "total", F.inline("head"))
    own = turns.join(convs.select("conv_id", "h", "taken", "total"), "conv_id").where("pos > h")
    own = own.select("conv_id", "total", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "id", "size")
    return front.unionByName(own), convs.select("conv_id", "total")


def whole(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations as they are, in the form of ``rebuilt``."""
    convs = turns.groupBy("conv_id").agg(F.max("pos").alias("total"))
    return turns.join(convs, "conv_id"), convs


def _half(digest: Column, first: int) -> Column:
    return F.conv(F.substring(digest, first, 16), 16, -10).cast("bigint")


def panels(turns: DataFrame, convs: DataFrame, panel: int) -> DataFrame:
    """``(k, p1, p2, q1, q2, path, sizes, conv_id, more)``: a row for each panel; p is the hash before it, q after it."""
    k = F.floor((F.col("pos") - 1) / panel).cast("int")
    parts = turns.groupBy("conv_id", k.alias("k")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "id", "size"))).alias("t"), F.first("total").alias("total")
    )
    path = F.aggregate("t", F.lit(b"").cast("binary"), lambda done, x: F.concat(done, x["id"]))
    parts = parts.select("conv_id", "k", path.alias("path"), F.col("t.size").alias("sizes"), (F.col("total") > (F.col("k") + 1) * panel).alias("more"))
    none = convs.where("total = 0").select(
        "conv_id", F.lit(0).alias("k"), F.lit(b"").cast("binary").alias("path"), F.array().cast("array<bigint>").alias("sizes"), F.lit(False).alias("more")
    )
    parts = materialize(parts.unionByName(none), "trie-panels")
    digest = F.sha2(F.concat(F.col("k").cast("string").cast("binary"), F.lit(b":").cast("binary"), F.col("path")), 256)
    upto = Window.partitionBy("conv_id").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    long = parts.where("k > 0 OR more").withColumn("d1", _half(digest, 1)).withColumn("d2", _half(digest, 17))
    long = long.withColumn("q1", F.bit_xor("d1").over(upto)).withColumn("q2", F.bit_xor("d2").over(upto))
    long = long.withColumn("p1", F.col("q1").bitwiseXOR(F.col("d1"))).withColumn("p2", F.col("q2").bitwiseXOR(F.col("d2")))
    zero = F.lit(0).cast("bigint")
    short = parts.where("k = 0 AND NOT more").withColumns({c: zero for c in ("p1", "p2", "q1", "q2")})
    columns = ["k", "p1", "p2", "q1", "q2", "path", "sizes", "conv_id", "more"]
    return materialize(short.select(columns).unionByName(long.select(columns)), "trie-rows")


# --- one shard --------------------------------------------------------------------


def _matrices(path: pa.Array, sizes: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Turn ids (rows x columns x 2 words) and sizes, padded with zeros, and the lengths."""
    lens = pc.binary_length(path).to_numpy(zero_copy_only=False).astype(np.int64) // ID_BYTES
    width = int(lens.max(initial=0))
    filled = np.arange(width) < lens[:, None]
    ids, texts = np.zeros((len(lens), width, 2), dtype=np.uint64), np.zeros((len(lens), width), dtype=np.int64)
    ids[filled] = np.frombuffer(b"".join(path.to_pylist()), ">u8").reshape(-1, 2)
    texts[filled] = sizes.flatten().to_numpy()
    return ids, texts, lens


def trie_of_shard(table: pa.Table, shard: int, panel: int) -> Iterator[dict[str, list | np.ndarray]]:
    """Columns of the nodes of one shard, depth by depth; see the module's text."""
    get = lambda name: table.column(name).to_numpy().astype(np.int64)
    k, p1, p2, q1, q2, conv = map(get, ("k", "p1", "p2", "q1", "q2", "conv_id"))
    more = table.column("more").to_numpy().astype(bool)
    add_children, add_leaves, add_saved = map(get, ("x_children", "x_leaves", "x_saved"))
    ids, sizes, lens = _matrices(table.column("path").combine_chunks(), table.column("sizes").combine_chunks())
    n, width = sizes.shape
    order = np.lexsort([conv, *(ids[:, d, w] for d in reversed(range(width)) for w in (1, 0)), p2, p1, k])
    k, p1, p2, q1, q2, conv, more, add_children, add_leaves, add_saved, ids, sizes, lens = (
        x[order] for x in (k, p1, p2, q1, q2, conv, more, add_children, add_leaves, add_saved, ids, sizes, lens)
    )

    change = np.ones((width + 1, n), dtype=bool)
    change[0, 1:] = (np.diff(k) != 0) | (np.diff(p1) != 0) | (np.diff(p2) != 0)
    for d in range(1, width + 1):
        change[d, 1:] = change[d - 1, 1:] | (ids[1:, d - 1] != ids[:-1, d - 1]).any(axis=1)

    # Running sums per row, from the deepest column up: all texts, texts of complete nodes once, leaves; starts of complete children.
    every, once, leaves, born = add_saved.copy(), np.zeros(n, np.int64), add_leaves.copy(), np.zeros(n, np.int64)
    levels = []
    for d in reversed(range(width + 1)):
        rows = np.flatnonzero(lens >= d)
        if not len(rows):
            levels.append(None)
            continue
        starts = np.flatnonzero(change[d, rows])
        total = lambda x: np.add.reduceat(x[rows], starts)  # noqa: B023, E731
        first, last = rows[starts], rows[np.append(starts[1:], len(rows)) - 1]
        edge = (first == 0) | (last == n - 1)
        size = sizes[first, d - 1] if d else np.zeros(len(first), np.int64)
        ended = (lens == d) & ~more
        n_convs, n_ends = np.diff(np.append(starts, len(rows))), total(ended.astype(np.int64))
        if d:
            every[rows] += sizes[rows, d - 1]
        np.add.at(once, first[~edge], size[~edge])
        np.add.at(leaves, first[~edge & (n_ends == n_convs)], 1)
        children = total(born) + (total(add_children) if d == panel else 0)
        goes_on = np.minimum.reduceat(np.where(more, np.arange(n), n)[rows], starts) if d == panel else np.full(len(first), n)
        levels.append(
            {"first": first, "edge": edge, "size": size, "n_convs": n_convs, "n_ends": n_ends, "n_children": children, "n_leaves": total(leaves),
             "saved": total(every) - total(once), "conv_id": np.minimum.reduceat(conv[rows], starts), "ended": np.flatnonzero(ended),
             "goes_on": goes_on, "rows": rows, "starts": starts}
        )
        born[:] = 0
        born[first[~edge]] = 1
    levels.reverse()

    def key(row: int, d: int) -> bytes:
        return _HEAD.pack(int(k[row]), int(p1[row]), int(p2[row])) + ids[row, :d].astype(">u8").tobytes()

    above, above_edge = np.zeros(n, np.int64), np.zeros(n, dtype=bool)
    for d, level in enumerate(levels):
        if level is None:
            continue
        first, edge, n_ends, goes_on = level["first"], level["edge"], level["n_ends"], level["goes_on"]
        upto = np.concatenate([[0], np.cumsum(n_ends)])
        ends: list[str | None] = [None] * len(first)
        for i in np.flatnonzero(n_ends).tolist():
            text = ",".join(map(str, conv[level["ended"][upto[i] : upto[i + 1]]].tolist()))
            ends[i] = text if edge[i] else hashlib.sha256(text.encode()).hexdigest()
        kind = np.where(edge, PARTIAL, NODE if d else np.where(k[first] > 0, GROUP, NODE))
        there = goes_on < n
        at = np.where(there, goes_on, 0)
        out = {
            "kind": kind, "shard": np.full(len(first), shard), "k": k[first], "depth": np.full(len(first), d),
            "key": [key(r, d) if e else None for r, e in zip(first.tolist(), edge.tolist())],
            "parent_key": [key(r, d - 1) if d and e else None for r, e in zip(first.tolist(), above_edge[first].tolist())],
            "ends": ends, "parent": pa.array(above[first], mask=(above_edge[first] | (d == 0))),
            "p1": p1[first], "p2": p2[first], "q1": pa.array(q1[at], mask=~there), "q2": pa.array(q2[at], mask=~there),
        }
        yield out | {c: level[c] for c in ("conv_id", "n_convs", "n_children", "n_leaves", "saved", "n_ends", "size")}
        run = np.diff(np.append(level["starts"], len(level["rows"])))
        above[level["rows"]], above_edge[level["rows"]] = np.repeat(level["conv_id"], run), np.repeat(edge, run)


def _shards(rows: DataFrame, panel: int) -> DataFrame:
    """All shards' nodes, written: complete ones, partial ones at the shards' edges, and roots of deeper panels."""
    spark = rows.sparkSession
    ship_package(spark)

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held = [b for b in batches if b.num_rows]
        if not held:
            return
        for columns in trie_of_shard(pa.Table.from_batches(held), TaskContext.get().partitionId(), panel):
            arrays = [pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], pa.Array) else columns[f.name].cast(f.type) for f in arrow]
            for lo in range(0, len(arrays[0]), 10_000):
                yield pa.RecordBatch.from_arrays([a.slice(lo, 10_000) for a in arrays], schema=arrow)

    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    arrow = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in _SCHEMA.split(", "))])
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // SHARD_ROWS))
    return materialize(rows.repartitionByRange(tasks, "k", "p1", "p2", "path", "conv_id").mapInArrow(shard, _SCHEMA), "trie-nodes")


# --- recombining ------------------------------------------------------------------


def _key_upto(key: Column, depth: Column) -> Column:
    return F.substring(key, F.lit(1), (depth * ID_BYTES + _HEAD.size).cast("int"))


def _recombined(nodes: DataFrame) -> DataFrame:
    """The nodes on shards' edges, each once: sums of their parts and of the edge nodes below them."""
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved", "n_ends")]
    same = [F.max(c).alias(c) for c in ("k", "depth", "size", "p1", "p2", "q1", "q2")]
    edge = nodes.where(F.col("kind") == PARTIAL).groupBy("key").agg(F.min("conv_id").alias("conv_id"), *sums, *same)
    edge = materialize(edge, "trie-edges")
    depth = F.col("depth")
    each = edge.select("key", depth, "size", (F.col("n_ends") == F.col("n_convs")).cast("bigint").alias("leaf"), F.explode(F.sequence(F.lit(0), depth)).alias("d"))
    owed = each.groupBy(_key_upto(F.col("key"), F.col("d")).alias("key")).agg(
        F.sum("size").alias("own"), F.sum("leaf").alias("leaf"), F.count_if(F.col("d") == depth - 1).alias("child")
    )
    added = {"n_children": F.col("n_children") + F.col("child"), "n_leaves": F.col("n_leaves") + F.col("leaf"), "saved": F.col("saved") - F.col("own")}
    return materialize(edge.join(owed, "key").withColumns(added).drop("child", "leaf", "own"), "trie-recombined")


def _edge_ends(nodes: DataFrame) -> DataFrame:
    """``(key, digest)`` of edge nodes with ends: a shard's list after the other through one hash."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        done = lambda: pa.record_batch([pa.array([last], pa.binary()), pa.array([state.hexdigest()])], names=["key", "digest"])
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name != last:
                    if last is not None:
                        yield done()
                    last, state = name, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
        if last is not None:
            yield done()

    parts = nodes.where((F.col("kind") == PARTIAL) & F.col("ends").isNotNull()).select("key", "shard", "ends")
    return parts.repartition("key").sortWithinPartitions("key", "shard").select("key", "ends").mapInArrow(digest, "key binary, digest string")


def _below(rows: DataFrame, panel: int) -> DataFrame:
    """``(conv_id, k, x_children, x_leaves, x_saved)``: what deeper panels add to a row's nodes."""
    zero = F.lit(0).cast("bigint")
    deep = _shards(rows.where("k > 0").withColumns({c: zero for c in ("x_children", "x_leaves", "x_saved")}), panel)
    found = ["conv_id", "k", "n_children", "n_leaves", "saved"]
    groups = deep.where(F.col("kind") == GROUP).select(found).unionByName(_recombined(deep).where("depth = 0").select(found))
    held = rows.where("k > 0 OR more").select("conv_id", "k").join(groups, ["conv_id", "k"], "left")
    down = Window.partitionBy("conv_id").orderBy(F.col("k").desc())
    below = down.rowsBetween(Window.unboundedPreceding, -1)
    return held.select(
        "conv_id", "k", F.lag("n_children").over(down).alias("x_children"),
        F.sum("n_leaves").over(below).alias("x_leaves"), F.sum("saved").over(below).alias("x_saved"),
    )


def prefix_trie(turns: DataFrame, convs: DataFrame, panel: int = PANEL) -> DataFrame:
    """Every node: ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``.

    ``turns`` are ``(conv_id, total, pos, id, size)`` with positions from 1 to
    the conversation's ``total``, ``convs`` are ``(conv_id, total)``.
    """
    rows = panels(turns, convs, panel)
    extras = ("x_children", "x_leaves", "x_saved")
    zero = F.lit(0).cast("bigint")
    if rows.where("k > 0").isEmpty():
        nodes = _shards(rows.withColumns({c: zero for c in extras}), panel)
    else:
        joined = rows.join(_below(rows, panel), ["conv_id", "k"], "left")
        nodes = _shards(materialize(joined.withColumns({c: F.coalesce(c, zero) for c in extras}), "trie-weighted"), panel)
    edges = _recombined(nodes).join(_edge_ends(nodes), "key", "left")
    edges = edges.withColumn("parent_key", F.when(F.col("depth") > 0, _key_upto(F.col("key"), F.col("depth") - 1)))
    columns = ["k", "depth", "conv_id", "parent", "parent_key", "n_convs", "n_children", "n_leaves", "saved", "digest", "p1", "p2", "q1", "q2"]
    every = nodes.where(F.col("kind") == NODE).withColumn("digest", F.col("ends")).select(columns)
    every = every.unionByName(edges.where("depth > 0 OR k = 0").withColumn("parent", F.lit(None).cast("bigint")).select(columns))
    # A parent on a shard's edge is found by its path; the parent of a deeper panel's first nodes by the hash of the prefix.
    over = edges.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("edge_parent"))
    prefix = every.where((F.col("depth") == panel) & F.col("q1").isNotNull()).select(
        (F.col("k") + 1).alias("k"), F.lit(1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2"), F.col("conv_id").alias("panel_parent")
    )
    # Most nodes know their parent: only the others are joined, so no null key gathers them in one task.
    first = (F.col("k") > 0) & (F.col("depth") == 1)
    known = every.where(~first & F.col("parent_key").isNull())
    # An edge node may have very many children (the root has all first turns), so they are dealt over SALTS tasks.
    over = over.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    children = every.where(~first & F.col("parent_key").isNotNull()).withColumn("salt", F.pmod("conv_id", F.lit(SALTS)).cast("int"))
    by_path = children.join(over, ["parent_key", "salt"]).withColumn("parent", F.col("edge_parent"))
    by_hash = every.where(first).join(prefix, ["k", "depth", "p1", "p2"]).withColumn("parent", F.col("panel_parent"))
    every = known.unionByName(by_path.select(columns)).unionByName(by_hash.select(columns))
    return every.select(
        "conv_id", (F.col("k").cast("bigint") * panel + F.col("depth")).alias("depth"), F.col("parent").alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.coalesce("digest", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
