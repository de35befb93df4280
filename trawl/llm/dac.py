"""Token ids in files of directly addressable codes (operator 12).

An id is cut into 8-bit chunks, lowest first. Level 0 holds the first chunk of
every token; a continuation bitmap says which tokens go on, and level 1 holds
the next chunk of those alone, and so on. A rank directory per bitmap (set bits
before every 512th bit) gives the place of any token's next chunk, so one token
or a range is read at its own place and no block is decoded around it.

Segment (all numbers little-endian)::

    header    magic "DAC1", version, levels (u16 each), shard, number in the shard,
              tokens, documents (u64 each), length of the segment (u64)
    documents first token of each and the end (u64), ids (i64), null ids (u8)
    levels    number of chunks (u64), chunks (u8), bitmap (u64 words), ranks (u64)

A file is one segment and a closing LF (Spark's text writer puts it there).
Files are written by a Spark job with Spark's own commit, so a lost or repeated
task leaves no second copy, on any file system Spark writes to, and read back
by ``binaryFile``. Documents are range-partitioned on (id, hash of the text,
row number): ids ascend over the segments, and a document repeated any number of
times is split over tasks. A segment is closed once it has ``SEGMENT_TOKENS``
tokens, so a task holds one segment, or one text if that is longer. Segments know their shard
and number; where a shard starts follows from a sum over shards.

Defined results: a null or empty text is the end id alone; a null document id
comes first; rows of one id are ordered by their text's hash and rows equal in
both are alike; a text of any length is taken whole; an empty table writes no
segment and reads back as no rows; extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trawl.llm.common import materialize, small_batches
from trawl.llm.word_ids import SLICE_BYTES, default_tokenizer, slices, word_ids

END_ID = 1
SEGMENT_TOKENS = 8_000_000
# Entries of a worker's word cache: a task's texts hold more distinct words than the default, and would encode most anew.
CACHED_WORDS = 500_000
RANK_BITS = 512
MAGIC = b"DAC1"
_HEADER = struct.Struct("<4sHHQQQQQ")


# --- the code ---------------------------------------------------------------------


def _bitmap(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A bitmap in whole blocks of ``RANK_BITS`` and the set bits before each block."""
    padded = np.zeros(-(-max(len(bits), 1) // RANK_BITS) * RANK_BITS, dtype=bool)
    padded[: len(bits)] = bits
    words = np.packbits(padded, bitorder="little").view("<u8")
    per_block = np.bitwise_count(words.reshape(-1, RANK_BITS // 64)).sum(axis=1, dtype=np.uint64)
    return words, np.concatenate([[0], np.cumsum(per_block)[:-1]]).astype("<u8")


def encode_levels(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(chunks, bitmap, ranks)`` per level; at least one level."""
    left, out = ids.astype(np.uint64), []
    while not out or len(left):
        more = left > 0xFF
        out.append(((left & 0xFF).astype(np.uint8), *_bitmap(more)))
        left = left[more] >> 8
    return out


def write_segment(ids: np.ndarray, starts: np.ndarray, doc_ids: list[int | None], shard: int, number: int) -> bytes:
    """One segment; ``starts`` are the first tokens of the documents and the end."""
    levels = encode_levels(ids)
    body = [
        starts.astype("<u8").tobytes(),
        np.array([x or 0 for x in doc_ids], dtype="<i8").tobytes(),
        np.array([x is None for x in doc_ids], dtype=np.uint8).tobytes(),
    ]
    for chunks, words, ranks in levels:
        body += [struct.pack("<Q", len(chunks)), chunks.tobytes(), words.tobytes(), ranks.tobytes()]
    length = _HEADER.size + sum(map(len, body))
    return _HEADER.pack(MAGIC, 1, len(levels), shard, number, len(ids), len(doc_ids), length) + b"".join(body)


@dataclass
class _Level:
    size: int
    chunks: int  # places in the segment
    words: int
    ranks: int


class Segment:
    """Reader of one segment through ``read(at, length) -> bytes``, which may be a slice of a buffer or a ranged file read.

    Opening reads the header and each level's length; ``token`` reads one chunk,
    one bitmap block and one rank a level.
    """

    def __init__(self, read) -> None:
        self._read = read
        head = read(0, _HEADER.size)
        if len(head) < _HEADER.size or head[:4] != MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        _, version, levels, self.shard, self.number, self.n_tokens, self.n_docs, self.length = _HEADER.unpack(head)
        if version != 1:
            raise ValueError(f"segment version {version} is not known")
        self._starts = _HEADER.size
        self._ids = self._starts + 8 * (self.n_docs + 1)
        self._nulls = self._ids + 8 * self.n_docs
        at = self._nulls + self.n_docs
        self.levels = []
        for _ in range(levels):
            (size,) = struct.unpack("<Q", read(at, 8))
            blocks = -(-max(size, 1) // RANK_BITS)
            words = at + 8 + size
            ranks = words + blocks * RANK_BITS // 8
            self.levels.append(_Level(size, at + 8, words, ranks))
            at = ranks + 8 * blocks

    @classmethod
    def of(cls, data) -> Segment:
        """A segment held in memory."""
        view = memoryview(data)
        return cls(lambda at, n: bytes(view[at : at + n]))

    def _array(self, at: int, n: int, kind: str) -> np.ndarray:
        return np.frombuffer(self._read(at, n * np.dtype(kind).itemsize), kind)

    def starts(self) -> np.ndarray:
        """First token of each document, and the number of tokens."""
        return self._array(self._starts, self.n_docs + 1, "<u8").astype(np.int64)

    def doc_ids(self) -> list[int | None]:
        nulls = self._array(self._nulls, self.n_docs, "u1")
        return [None if x else int(i) for i, x in zip(self._array(self._ids, self.n_docs, "<i8"), nulls)]

    def _rank(self, level: _Level, bit: int) -> int:
        """Set bits before ``bit`` of a level's bitmap."""
        block, inside = divmod(bit, RANK_BITS)
        before = int(self._array(level.ranks + 8 * block, 1, "<u8")[0]) if bit < level.size else None
        if before is None:  # the end of the bitmap: the last block's rank and its bits
            block, inside = (level.size - 1) // RANK_BITS, (level.size - 1) % RANK_BITS + 1
            before = int(self._array(level.ranks + 8 * block, 1, "<u8")[0])
        words = self._array(level.words + RANK_BITS // 8 * block, -(-inside // 64), "<u8")
        if not inside:
            return before
        last = int(words[-1]) & ((1 << ((inside - 1) % 64 + 1)) - 1)
        return before + int(np.bitwise_count(words[:-1]).sum()) + last.bit_count()

    def token(self, i: int) -> int:
        """The id of token ``i``, by one probe a level."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(f"token {i} of {self.n_tokens}")
        out = 0
        for k, level in enumerate(self.levels):
            out |= self._read(level.chunks + i, 1)[0] << 8 * k
            word = int(self._array(level.words + i // 64 * 8, 1, "<u8")[0])
            if not word >> i % 64 & 1:
                break
            i = self._rank(level, i)
        return out

    def tokens(self, start: int, stop: int) -> np.ndarray:
        """Ids of tokens ``start`` to ``stop``, reading only their chunks: two ranks a level bound the next one."""
        if not 0 <= start <= stop <= self.n_tokens:
            raise IndexError(f"tokens {start} to {stop} of {self.n_tokens}")
        out = np.zeros(stop - start, dtype="<u4")
        places = np.arange(stop - start)
        for k, level in enumerate(self.levels):
            if start == stop:
                break
            out[places] |= self._array(level.chunks + start, stop - start, "u1").astype("<u4") << np.uint32(8 * k)
            first = start // 8
            bits = np.unpackbits(self._array(level.words + first, -(-stop // 8) - first, "u1"), bitorder="little")
            places = places[bits[start - 8 * first : stop - 8 * first].astype(bool)]
            start = self._rank(level, start)
            stop = start + len(places)
        return out


# --- writing and reading as Spark jobs -------------------------------------------------


def write_ids(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    end_id: int = END_ID,
    segment_tokens: int = SEGMENT_TOKENS,
) -> None:
    """Encode every text and write the ids, in ascending ``id_col`` order, as segment files under ``path``."""
    vocabulary = tokenizer or default_tokenizer()

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known, shard, number = word_ids(vocabulary, CACHED_WORDS), TaskContext.get().partitionId(), 0
        held: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        names: list[int | None] = []

        def closed() -> pa.RecordBatch:
            starts = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
            return pa.record_batch([pa.array([write_segment(np.concatenate(held), starts, names, shard, number)], pa.binary())], names=["segment"])

        for batch in batches:
            at = 0
            for texts in slices(batch.column(1), min(SLICE_BYTES, 4 * segment_tokens)):
                ids, ends = known.encode_ended(texts, end_id)
                held.append(ids)
                sizes.append(np.diff(ends))
                names += batch.column(0).slice(at, len(texts)).to_pylist()
                at += len(texts)
                if sum(map(len, held)) >= segment_tokens:
                    yield closed()
                    held, sizes, names, number = [], [], [], number + 1
        if names:
            yield closed()

    rows = small_batches(docs).select(F.col(id_col).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    order = [F.col("id").asc_nulls_first(), "hash", "row"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")
    # the writer takes a string's bytes as they are
    made = ranged.mapInArrow(segments, "segment binary").select(F.col("segment").cast("string"))
    made.write.option("maxRecordsPerFile", 1).option("compression", "none").text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return small_batches(spark.read.format("binaryFile").load(path).select("path", "content"))


def _with_base(rows: DataFrame) -> DataFrame:
    """``rows`` with ``base``, the tokens in all segments before theirs: one row a segment is summed, shard by shard."""
    segments = rows.groupBy("shard", "number").agg(F.max("segment_tokens").alias("n"))
    shards = segments.groupBy("shard").agg(F.sum("n").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select(F.col("shard").alias("s"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_base"))
    inside = Window.partitionBy("shard").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    bases = segments.withColumn("inner", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(shards, F.col("shard") == F.col("s"))
    bases = bases.select("shard", "number", (F.col("shard_base") + F.col("inner")).alias("base"))
    return rows.join(bases, ["shard", "number"])


def read_documents(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Per document of the files: ``(doc_id, start, n_tokens, ids_crc32[, ids])``, ``start`` counted over all files."""
    fields = "shard bigint, number bigint, segment_tokens bigint, doc_id bigint, place bigint, n_tokens bigint, ids_crc32 bigint"

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                s = Segment.of(content.as_buffer())
                starts, names = s.starts(), s.doc_ids()
                for lo in range(0, s.n_docs, 1000):  # bounded output batches
                    some = range(lo, min(lo + 1000, s.n_docs))
                    ids = [s.tokens(int(starts[i]), int(starts[i + 1])) for i in some]
                    n = len(some)
                    part = starts[lo : lo + n + 1]
                    columns = [np.full(n, s.shard), np.full(n, s.number), np.full(n, s.n_tokens)]
                    columns += [pa.array(names[lo : lo + n], pa.int64()), part[:-1], np.diff(part)]
                    columns += [np.array([zlib.crc32(x.tobytes()) for x in ids], dtype=np.int64)]
                    arrays = [pa.array(c, pa.int64()) for c in columns]
                    if with_ids:
                        arrays.append(pa.array([x.astype(np.int64) for x in ids], pa.list_(pa.int64())))
                    yield pa.record_batch(arrays, names=[f.split()[0] for f in fields.split(", ")] + ["ids"] * with_ids)

    rows = _files(spark, path).select("content").mapInArrow(parse, fields + ", ids array<bigint>" * with_ids)
    rows = _with_base(materialize(rows, "dac-documents"))
    return rows.select("doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def tokens_at(spark: SparkSession, path: str, places: DataFrame, place: str = "place", segment_tokens: int = SEGMENT_TOKENS) -> DataFrame:
    """``places`` with ``token``: the id at each place counted over all files (null beyond them), by random access.

    The places go to the segments that hold them; a segment's file is opened
    once for each of its places' batches and probed, not decoded.
    """
    heads = "shard bigint, number bigint, segment_tokens bigint, path string"

    def head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                s = Segment.of(content.as_buffer())
                columns = [[s.shard], [s.number], [s.n_tokens], [name]]
                yield pa.record_batch([pa.array(c) for c in columns], names=["shard", "number", "segment_tokens", "path"])

    files = _files(spark, path)
    segments = _with_base(materialize(files.mapInArrow(head, heads), "dac-heads"))
    # Equal-width blocks of places make the range join an equi-join: a segment meets each block it touches.
    block = lambda c: F.floor(c / segment_tokens)
    spans = segments.where("segment_tokens > 0").withColumn("end", F.col("base") + F.col("segment_tokens"))
    spans = spans.select("path", "base", "end", F.explode(F.sequence(block(F.col("base")), block(F.col("end") - 1))).alias("block"))
    asked = places.select(F.col(place).cast("bigint").alias("_place")).distinct().withColumn("block", block(F.col("_place")))
    met = asked.join(spans, "block").where((F.col("_place") >= F.col("base")) & (F.col("_place") < F.col("end")))
    wanted = met.groupBy("path", "block").agg(F.collect_list(F.struct("_place", (F.col("_place") - F.col("base")).alias("at"))).alias("asked"))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, asked in zip(batch.column(0), batch.column(1)):
                s = Segment.of(content.as_buffer())
                pairs = asked.as_py()
                found = [s.token(p["at"]) for p in pairs]
                yield pa.record_batch([pa.array([p["_place"] for p in pairs], pa.int64()), pa.array(found, pa.int64())], names=["_place", "token"])

    found = files.join(wanted, "path").select("content", "asked").mapInArrow(probe, "_place bigint, token bigint")
    return places.join(found, places[place].cast("bigint") == found["_place"], "left").select(*[places[c] for c in places.columns], "token")
