"""Best-fit packing by sum of squares (operator 4).

Method: a sequence (bin) with ``h`` tokens in it has a residual gap; the state
is the number of open bins per gap. Each piece goes where the sum of the
squared counts becomes smallest: into an open bin, moving it to another gap,
and into a new bin only where no open bin has room (so that as few sequences as
possible are begun). Long pieces go first, as leftovers are filled by short
ones.

Tokenising runs where the text lies and its small result (no ids) is written
once. The piece lengths are then dealt round-robin into shards of a fixed
expected size; each shard is packed on its own, so a task holds
``SHARD_PIECES`` lengths whatever the corpus size, and a shard leaves at most a
few sequences unfilled. Nothing depends on a key, so no source or group of
copies can be hot.

Defined results: a null or empty text is a document of the end token alone; a
text of any length is taken whole (a worker holds one text and its ids);
documents longer than a sequence are cut into full pieces and a rest, all
others stay whole; repeated rows are packed once each; an empty table gives no
rows; extra columns are ignored here and can be joined on the id.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.llm.common import materialize, small_batches
from trawl.llm.word_ids import default_tokenizer, slices, word_ids

CAPACITY = 4096
END_ID = 1
SHARD_PIECES = 65_536


def token_pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of every document: ``(id_col, piece, start, length, ids_crc32[, ids])``."""
    path = tokenizer or default_tokenizer()
    key = docs.schema[id_col]
    long = T.LongType()
    fields = [key, T.StructField("piece", T.IntegerType()), *(T.StructField(c, long) for c in ("start", "length", "ids_crc32"))]
    schema = T.StructType(fields + [T.StructField("ids", T.ArrayType(long))] * with_ids)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_ids(path)
        for batch in batches:
            names, at = batch.column(0), 0
            for texts in slices(batch.column(1)):
                ids, ends = known.encode_ended(texts, end_id)
                size = np.diff(ends)
                pieces = -(-size // capacity)
                doc = np.repeat(np.arange(len(size)), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(size[doc] - start, capacity)
                first = ends[doc] + start
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * f : 4 * (f + n)]) for f, n in zip(first.tolist(), length.tolist())]
                columns = [names.take(pa.array(doc + at)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
                if with_ids:  # the pieces follow each other, so one list column over all ids
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(first, len(ids)), pa.int32()), pa.array(ids.astype(np.int64))))
                at += len(texts)
                yield pa.record_batch(columns, names=schema.names)

    texts = small_batches(docs).select(F.col(id_col), F.col(text).cast("string").alias("_text"))
    return texts.mapInArrow(cut, schema)


def sum_of_squares(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """``(bin, offset)`` of each item by the sum-of-squares rule; sizes from 1 to ``capacity``.

    With ``count[h]`` open bins at level ``h``, moving a bin from ``h`` to
    ``h + s`` changes the sum of squares by ``2 (count[h + s] - count[h]) + 2``,
    and by ``1 - 2 count[h]`` where it becomes full and so closes. Ties go to
    the fullest bin.
    """
    bins = np.zeros(len(sizes), dtype=np.int64)
    offsets = np.zeros(len(sizes), dtype=np.int64)
    count = np.zeros(capacity + 1, dtype=np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    made = 0
    never = np.iinfo(np.int64).max
    for i in np.argsort(-sizes, kind="stable"):
        s = int(sizes[i])
        room = capacity - s
        before = count[1 : room + 1]
        level = 0
        if room and before.any():
            change = 2 * (count[1 + s : capacity + 1] - before) + 2
            change[-1] = 1 - 2 * before[-1]
            change[before == 0] = never
            level = room - int(change[::-1].argmin())
        if level:
            b = open_bins[level].pop()
            count[level] -= 1
        else:
            b, made = made, made + 1
        bins[i], offsets[i] = b, level
        if level + s < capacity:
            open_bins[level + s].append(b)
            count[level + s] += 1
    return bins, offsets


def pack(pieces: DataFrame, n_pieces: int, capacity: int = CAPACITY, length: str = "length") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``n_pieces`` sets the number of shards.

    Sequence ids are unique, not gapless: the shard's number in the high bits.
    """
    schema = T.StructType(
        [*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    names = pieces.columns

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        sizes = table.column(length).to_numpy().astype(np.int64)
        bins, offsets = sum_of_squares(sizes, capacity)
        first = TaskContext.get().partitionId() << 33
        columns = [table.column(c) for c in names] + [pa.array(bins + first), pa.array(offsets)]
        yield from pa.table(columns, names=[*names, "sequence_id", "offset"]).to_batches()

    shards = max(1, -(-n_pieces // SHARD_PIECES))
    return pieces.repartition(shards).mapInArrow(shard, schema)


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """Every piece of every document with its place: ``sequence_id`` and ``offset``."""
    pieces = materialize(token_pieces(docs, id_col, text, tokenizer, capacity, end_id), "pieces")
    return pack(pieces, pieces.count(), capacity)


def sequences(pieces_with_ids: DataFrame, packed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Whole sequences ``(sequence_id, ids, parts)``: ids of the pieces joined by ``(id, piece)`` in offset order.

    Ids must name one document each. A sequence holds at most ``capacity`` ids,
    so the groups are bounded.
    """
    placed = packed.select(id_col, "piece", "sequence_id", "offset")
    part = F.struct("offset", F.col(id_col).alias("id"), "piece", "ids")
    grouped = (
        pieces_with_ids.select(id_col, "piece", "ids")
        .join(placed, [id_col, "piece"])
        .groupBy("sequence_id")
        .agg(F.array_sort(F.collect_list(part)).alias("p"))
    )
    return grouped.select(
        "sequence_id",
        F.flatten("p.ids").alias("ids"),
        F.transform("p", lambda x: F.struct(x["id"].alias(id_col), x["piece"], x["offset"])).alias("parts"),
    )
