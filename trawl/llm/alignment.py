"""Cross-tokenizer alignment by inverted pair bitmaps (operator 13).

Each text is encoded by two tokenizers over the same bytes (a space and the
text). Byte offsets where tokens of both end cut them into groups; a token of A
and one of B are linked where their byte ranges overlap. For each pair of ids
the index holds the documents that link it:

* documents get a place in a chunk (``CHUNK_DOCUMENTS`` documents or
  ``CHUNK_POSTINGS`` postings, whichever comes first), the high part of a
  document's number;
* per pair and chunk a container holds the bits of the chunk's documents,
  compressed: sorted 16-bit places, or a plain bitmap where that is shorter;
* multiplicity planes hold, for the documents of a container in order, the bits
  of (links of the pair in the document) - 1, so links are counted too.

Containers of one chunk are OR-ed as they are built and those of other chunks
have no document in common, so the OR over all chunks is the list of containers
and its popcount the sum of theirs: one aggregate per pair. Every container then
gets its pair's count (and whether that is the highest of its A id) and goes
back to its chunk, where the bits return the scores to the documents.

Texts are cut at the starts of white-space runs, where tokens of both files end
whatever stands around, so a distinct word is encoded and aligned once and
cached. The files' own settings are checked for that; with other files a text is
one piece. Shuffles move containers, not links; a chunk is the largest group.

Defined results: texts null, empty or not restored by a tokenizer have no tokens:
zeros and an empty digest; every row is a document, also with a repeated or null
id; a very long text is taken whole, in the memory of its tokens; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.llm.common import materialize, small_batches
from trawl.llm.word_ids import CACHED_LENGTH, byte_characters, slices

CHUNK_DOCUMENTS = 32_768
CHUNK_POSTINGS = 4_000_000
# A container with more documents than this is a plain bitmap of 4 KB, else places of 2 bytes.
DENSE = CHUNK_DOCUMENTS // 16
# Entries of a worker's caches of pieces and of A's words.
CACHED_PIECES = 300_000
# No character of any text; a text that has it all the same is cut by another way.
MARK = "\ufdd0"
_SPACES = "\t-\r \x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_RUN_START = f"([^{_SPACES}])([ \n])"
# Fixed value: how byte-level files of this kind split a text.
BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Aligned(NamedTuple):
    """One piece of text: numbers of tokens and groups, the groups as text, and the linked pairs."""

    valid: bool
    n_a: int
    n_b: int
    n_groups: int
    groups: str
    pairs: bytes  # a * |B| + b, 8 bytes each


_NOTHING = Aligned(False, 0, 0, 0, "", b"")


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links as places in A and in B, and the common ends, of two tilings of the same bytes by their ascending ends.

    Between two neighbouring ends of either tiling lies exactly one link: no end
    falls inside the overlap of two tokens.
    """
    ends = np.union1d(ends_a, ends_b)
    return np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends), np.intersect1d(ends_a, ends_b, assume_unique=True)


class Aligner:
    """Both tokenizers and a cache of aligned pieces of text."""

    def __init__(self, path_a: str, path_b: str) -> None:
        import regex
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pre = spec.get("pre_tokenizer") or {}
        plain_a = (
            not spec.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        )
        self.n_b = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(self.n_b)]
        # A space is only ever first in a piece, no piece holds a line end, and spaces stay as they are.
        plain_b = not any("▁" in p.lstrip("▁") or "\n" in p for p in pieces) and (
            self.b.encode("a  b ", out_type=str) and "".join(self.b.encode("a  b ", out_type=str)) == "▁a▁▁b▁"
        )
        self.by_piece = bool(plain_a and plain_b)
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.b_space = self.b.piece_to_id("▁")
        self.b_size = np.array([len(x) for x in self.b_bytes])
        self.byte_chars = byte_characters()
        chars = {chr(c): b for b, c in self.byte_chars.items()} | {chr(b): b for b in range(256) if b not in self.byte_chars}
        n_a = self.a.get_vocab_size()
        self.a_bytes = [bytes(chars.get(c, 0) for c in self.a.id_to_token(i) or "") for i in range(n_a)]
        self.a_size = np.array([len(x) for x in self.a_bytes])
        # A token as the groups' text has it: by what follows it.
        self.shown_a = np.array([f"{i}{end}" for end in ",|" for i in range(n_a)], dtype=object)
        self.shown_b = np.array([f"{i}{end}" for end in (",", ";") for i in range(self.n_b)], dtype=object)
        self.split = regex.compile(BYTE_LEVEL_SPLIT).findall
        self.model = self.a.model
        self.words: dict[str, bytes] = {}
        self.known: dict[str, Aligned] = {}

    def _a_word(self, word: str) -> bytes:
        shown = word.encode().decode("latin-1").translate(self.byte_chars)
        out = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
        if len(self.words) >= CACHED_PIECES:
            self.words.clear()
        if len(word) <= CACHED_LENGTH:
            self.words[word] = out
        return out

    def _a_tokens(self, texts: list[str]) -> list[bytes]:
        """A's ids of each piece, 4 bytes each."""
        if not self.by_piece:
            found = self.a.encode_batch(texts, add_special_tokens=False)
            return [array("I", e.ids).tobytes() for e in found]
        known, new, split = self.words.get, self._a_word, self.split
        return [b"".join([known(w) or new(w) for w in split(t)]) for t in texts]

    def _b_tokens(self, texts: list[str]) -> list[list[int]]:
        """B's ids of pieces that start with a space or a line end; B puts a space in front itself."""
        found = self.b.encode([t[1:] if t[0] == " " else t for t in texts], num_threads=1)
        if not self.by_piece:
            return found
        return [ids[1:] if t[0] == "\n" else ids or [self.b_space] for t, ids in zip(texts, found)]

    def _align(self, texts: list[str]) -> list[Aligned]:
        """Pieces (with their leading space or line end) aligned, all at once."""
        raws = [t.encode() for t in texts]
        a_ids = self._a_tokens(texts)
        b_ids = self._b_tokens(texts)
        a_bytes, b_bytes = self.a_bytes, self.b_bytes
        valid = [b"".join([b_bytes[i] for i in ids]) == raw for ids, raw in zip(b_ids, raws)]
        if not self.by_piece:  # else A's bytes are the text's by construction
            valid = [v and b"".join([a_bytes[i] for i in array("I", ids)]) == raw for v, ids, raw in zip(valid, a_ids, raws)]
        good = [i for i, v in enumerate(valid) if v]
        a = np.frombuffer(b"".join([a_ids[i] for i in good]), np.uint32).astype(np.int64)
        b = np.fromiter((x for i in good for x in b_ids[i]), np.int64)
        ends_a, ends_b = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        ends = np.cumsum([len(raws[i]) for i in good]) if good else np.zeros(0, np.int64)
        in_a, in_b, cuts = overlaps(ends_a, ends_b)
        pairs = (a[in_a] * self.n_b + b[in_b]).tobytes()
        upto_link = 8 * np.searchsorted(np.maximum(ends_a[in_a] - self.a_size[a[in_a]], ends_b[in_b] - self.b_size[b[in_b]]), ends)
        # The groups' text: A's tokens, then B's, of each group; the last of A in a group ends in a bar, the last of B in a semicolon.
        group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        last_a, last_b = np.isin(ends_a, cuts, assume_unique=True), np.isin(ends_b, cuts, assume_unique=True)
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        shown = np.concatenate([self.shown_a[a + last_a * len(self.a_size)], self.shown_b[b + last_b * self.n_b]])[order].tolist()
        n_a, n_b = np.searchsorted(ends_a, ends, side="right"), np.searchsorted(ends_b, ends, side="right")
        n_groups = np.searchsorted(cuts, ends, side="right")
        out = [_NOTHING] * len(texts)
        pa_, pb, pg, pl = 0, 0, 0, 0
        for i, ea, eb, eg, el in zip(good, n_a.tolist(), n_b.tolist(), n_groups.tolist(), upto_link.tolist()):
            text = "".join(shown[pa_ + pb : ea + eb])[:-1]
            out[i] = Aligned(True, ea - pa_, eb - pb, eg - pg, text, pairs[pl:el])
            pa_, pb, pg, pl = ea, eb, eg, el
        return out

    def aligned(self, texts: list[str]) -> list[Aligned]:
        """Pieces aligned, the known ones from the cache, which keeps the pieces at hand where it is full."""
        new = [t for t in texts if t not in self.known]
        found = dict(zip(new, self._align(new))) if new else {}
        out = [x if (x := self.known.get(t)) is not None else found[t] for t in texts]
        if len(self.known) + len(found) > CACHED_PIECES:
            found = dict(zip(texts[:CACHED_PIECES], out))
            self.known = {}
        self.known.update((t, x) for t, x in found.items() if len(t) <= CACHED_LENGTH)
        return out

    def pieces(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All pieces on end as a dictionary array, and ``len(texts) + 1`` offsets; a null or empty text has none."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        no_text = pa.scalar("", pa.large_string())
        spaced = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, no_text)
        if not self.by_piece:
            cut = pa.array([[t] for t in spaced.to_pylist()], pa.large_list(pa.large_string()))
        elif pc.any(pc.match_substring(texts, MARK)).as_py():
            cut = pa.array([_cut(t) for t in spaced.to_pylist()], pa.large_list(pa.large_string()))
        else:
            cut = pc.split_pattern(pc.replace_substring_regex(spaced, _RUN_START, "\\1" + MARK + "\\2"), MARK)
        empty = pc.equal(texts, no_text).to_numpy(zero_copy_only=False)
        coded = cut.flatten().dictionary_encode()
        counts = pc.list_value_length(cut).to_numpy()
        codes = coded.indices.to_numpy()
        if empty.any():  # the space alone of an empty text is no piece
            codes = codes[~np.repeat(empty, counts)]
            counts = np.where(empty, 0, counts)
        return coded.dictionary, codes, np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])


def _cut(text: str) -> list[str]:
    """The pieces of one text by Python's own patterns, as ``Aligner.pieces`` cuts them."""
    return re.split(f"(?<=[^{_SPACES}])(?=[ \n])", text)


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def gather(starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Indices ``starts[i], ..., starts[i] + n[i] - 1`` for every i, on end."""
    ends = np.cumsum(n)
    return np.repeat(starts - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)


class Batch(NamedTuple):
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[str]
    doc: np.ndarray  # of each posting
    pair: np.ndarray
    links: np.ndarray


def align_texts(known: Aligner, texts: pa.Array) -> Batch:
    """Counts and groups per text, and its postings: (text, pair, number of links)."""
    names, codes, offsets = known.pieces(texts)
    words = known.aligned(names.to_numpy(zero_copy_only=False).tolist())
    docs = np.repeat(np.arange(len(texts)), np.diff(offsets))
    valid = np.array([w.valid for w in words], dtype=bool)[codes]
    good = np.ones(len(texts), dtype=bool)
    good[docs[~valid]] = False
    codes, docs = codes[good[docs]], docs[good[docs]]

    def per_doc(values: list[int]) -> np.ndarray:
        out = np.zeros(len(texts), dtype=np.int64)
        np.add.at(out, docs, np.array(values, dtype=np.int64)[codes])
        return out

    n_pairs = np.array([len(w.pairs) >> 3 for w in words], dtype=np.int64)
    table = np.frombuffer(b"".join([w.pairs for w in words]), np.int64)
    n = n_pairs[codes]
    pairs = table[gather((np.cumsum(n_pairs) - n_pairs)[codes], n)]
    key = pairs * len(texts) + np.repeat(docs, n)
    key, links = np.unique(key, return_counts=True)
    shown = np.array([w.groups for w in words], dtype=object)
    ends = np.searchsorted(docs, np.arange(len(texts) + 1))
    groups = [";".join(shown[codes[lo:hi]]) for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist())]
    return Batch(
        per_doc([w.n_a for w in words]), per_doc([w.n_b for w in words]), per_doc([w.n_groups for w in words]), per_doc(n_pairs),
        groups, key % len(texts), key // len(texts), links,
    )


# --- containers -----------------------------------------------------------------


def containers(pair: np.ndarray, place: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes], list[bytes]]:
    """``(pair, documents, links, bitmap, planes)`` per pair; (pair, place) is unique and sorted."""
    first = np.flatnonzero(np.diff(pair, prepend=-1))
    sizes = np.diff(np.append(first, len(pair)))
    raw = memoryview(place.astype("<u2").tobytes())
    bounds = zip(first.tolist(), sizes.tolist())
    most = np.maximum.reduceat(links, first) if len(first) else links
    bitmaps, planes = [], []
    for (at, n), top in zip(bounds, most.tolist()):
        if n > DENSE:
            bits = np.zeros(CHUNK_DOCUMENTS, dtype=bool)
            bits[place[at : at + n]] = True
            bitmaps.append(np.packbits(bits, bitorder="little").tobytes())
        else:
            bitmaps.append(bytes(raw[2 * at : 2 * (at + n)]))
        extra = b""
        if top > 1:
            left = links[at : at + n] - 1
            extra = b"".join(np.packbits((left >> k & 1).astype(bool), bitorder="little").tobytes() for k in range(int(top - 1).bit_length()))
        planes.append(extra)
    total = np.add.reduceat(links, first) if len(first) else links
    return pair[first], sizes, total, bitmaps, planes


def places_of(n: int, bitmap: bytes) -> np.ndarray:
    """The places in a container of ``n`` documents, ascending."""
    if n <= DENSE:
        return np.frombuffer(bitmap, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little"))


def links_of(n: int, planes: bytes) -> np.ndarray:
    """Links of each of the ``n`` documents, from the planes."""
    out = np.ones(n, dtype=np.int64)
    width = -(-n // 8)
    for k in range(len(planes) // width):
        plane = np.frombuffer(planes, np.uint8, width, k * width)
        out += np.unpackbits(plane, count=n, bitorder="little").astype(np.int64) << k
    return out


def or_merge(n: int, bitmap: bytes, n2: int, bitmap2: bytes) -> tuple[int, bytes]:
    """Documents and container of the union of two containers of one chunk."""
    places = np.union1d(places_of(n, bitmap), places_of(n2, bitmap2))
    _, sizes, _, bitmaps, _ = containers(np.zeros(len(places), np.int64), places, np.ones(len(places), np.int64))
    return int(sizes[0]), bitmaps[0]


# --- jobs -------------------------------------------------------------------------


def _paths(path_a: str | None, path_b: str | None) -> tuple[str, str]:
    if path_a and path_b:
        return path_a, path_b
    import public_tokenizers as files

    return path_a or files.path("byte_bpe_50k.json"), path_b or files.path("piece_bpe_32k.model")


_DOC = ("n_a", "n_b", "n_groups", "n_links")


def pair_index(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", path_a: str | None = None, path_b: str | None = None, with_groups: bool = False
) -> tuple[DataFrame, DataFrame]:
    """``(documents, postings)`` from one pass over the texts, both read from one written table.

    documents: ``(id_col, chunk, place, n_a, n_b, n_groups, n_links, groups_sha256[, groups])``;
    postings: ``(chunk, a, b, n_docs, pair_links, bitmap, planes)``, a row per chunk and pair.
    """
    paths = _paths(path_a, path_b)
    long, text_type, raw = T.LongType(), T.StringType(), T.BinaryType()
    kinds = {id_col: docs.schema[id_col].dataType, "chunk": long, "place": T.IntegerType()} | dict.fromkeys(_DOC, long)
    kinds |= {"groups_sha256": text_type} | ({"groups": text_type} if with_groups else {})
    n_doc = len(kinds)
    kinds |= {"a": long, "b": long, "n_docs": long, "pair_links": long, "bitmap": raw, "planes": raw}
    schema = T.StructType([T.StructField(n, k) for n, k in kinds.items()])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known, arrow = aligner(*paths), None
        chunk, filled, held = TaskContext.get().partitionId() << 31, 0, []

        def table(columns: dict[str, pa.Array]) -> pa.RecordBatch:
            n = len(next(iter(columns.values())))
            return pa.record_batch([columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in arrow], schema=arrow)

        def postings() -> Iterator[pa.RecordBatch]:
            pair, place, links = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(pair * CHUNK_DOCUMENTS + place)
            pair, sizes, total, bitmaps, planes = containers(pair[order], place[order], links[order])
            step = 20_000
            for lo in range(0, len(pair), step):
                to = slice(lo, lo + step)
                yield table(
                    {"chunk": pa.array(np.full(len(pair[to]), chunk)), "a": pa.array(pair[to] // known.n_b), "b": pa.array(pair[to] % known.n_b),
                     "n_docs": pa.array(sizes[to]), "pair_links": pa.array(total[to]), "bitmap": pa.array(bitmaps[to], pa.binary()),
                     "planes": pa.array(planes[to], pa.binary())}
                )

        for batch in batches:
            if arrow is None:
                from pyspark.sql.pandas.types import to_arrow_schema

                arrow = to_arrow_schema(schema).set(0, pa.field(id_col, batch.schema.field(0).type))
            at = 0
            for texts in slices(batch.column(1)):
                if held and (filled + len(texts) > CHUNK_DOCUMENTS or sum(len(x[0]) for x in held) >= CHUNK_POSTINGS):
                    yield from postings()
                    chunk, filled, held = chunk + 1, 0, []
                found = align_texts(known, texts)
                digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in found.groups]
                columns = {
                    id_col: batch.column(0).slice(at, len(texts)),
                    "chunk": pa.array(np.full(len(texts), chunk)),
                    "place": pa.array(np.arange(filled, filled + len(texts))),
                    "groups_sha256": pa.array(digests, pa.string()),
                } | {c: pa.array(getattr(found, c)) for c in _DOC}
                if with_groups:
                    columns["groups"] = pa.array(found.groups, pa.string())
                yield table(columns)
                held.append((found.pair, found.doc + filled, found.links))
                filled += len(texts)
                at += len(texts)
        if held:
            yield from postings()

    rows = small_batches(docs).select(F.col(id_col), F.col(text).cast("string").alias("_text")).mapInArrow(index, schema)
    rows = materialize(rows, "pair-index")
    names = list(kinds)
    documents = rows.where("a IS NULL").select(names[:n_doc])
    return documents, rows.where("a IS NOT NULL").select("chunk", *names[n_doc:])


def pair_counts(postings: DataFrame) -> DataFrame:
    """``(a, b, n_docs, pair_links, best)`` of the corpus: popcounts of the OR over all chunks; ``best`` where no pair of ``a`` has more documents."""
    counts = postings.groupBy("a", "b").agg(F.sum("n_docs").alias("n_docs"), F.sum("pair_links").alias("pair_links"))
    top = counts.groupBy("a").agg(F.max("n_docs").alias("top"))
    return counts.join(top, "a").select("a", "b", "n_docs", "pair_links", (F.col("n_docs") == F.col("top")).alias("best"))


def scores(postings: DataFrame) -> DataFrame:
    """``(chunk, place, n_best, count_sum)``: the scores that postings return to their documents."""
    counts = materialize(pair_counts(postings), "pair-counts").select("a", "b", F.col("n_docs").alias("count"), "best")
    scored = postings.join(counts, ["a", "b"]).select("chunk", "n_docs", "bitmap", "planes", "count", "best")
    names = ["chunk", "place", "n_best", "count_sum"]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, best, total, seen = None, None, None, None

        def done() -> pa.RecordBatch:
            at = np.flatnonzero(seen)
            return pa.record_batch([pa.array(np.full(len(at), chunk)), pa.array(at), pa.array(best[at]), pa.array(total[at])], names=names)

        for batch in batches:
            chunks = batch.column(0).to_numpy()
            cuts = np.append(np.flatnonzero(np.diff(chunks, prepend=chunks[0] - 1 if len(chunks) else 0)), len(chunks))
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if chunks[lo] != chunk:
                    if chunk is not None:
                        yield done()
                    chunk, best, total, seen = int(chunks[lo]), *(np.zeros(CHUNK_DOCUMENTS, np.int64) for _ in range(2)), np.zeros(CHUNK_DOCUMENTS, bool)
                n = batch.column(1).slice(lo, hi - lo).to_numpy()
                bitmaps = batch.column(2).slice(lo, hi - lo).to_pylist()
                planes = batch.column(3).slice(lo, hi - lo).to_pylist()
                if (n <= DENSE).all():
                    places = np.frombuffer(b"".join(bitmaps), "<u2").astype(np.int64)
                else:
                    places = np.concatenate([places_of(k, x) for k, x in zip(n.tolist(), bitmaps)])
                links = np.ones(len(places), np.int64)
                starts = np.cumsum(n) - n
                for i, x in enumerate(planes):
                    if x:
                        links[starts[i] : starts[i] + n[i]] = links_of(int(n[i]), x)
                is_best = batch.column(5).slice(lo, hi - lo).to_numpy(zero_copy_only=False)
                np.add.at(total, places, links * np.repeat(batch.column(4).slice(lo, hi - lo).to_numpy(), n))
                np.add.at(best, places, links * np.repeat(is_best, n))
                seen[places] = True
        if chunk is not None:
            yield done()

    dealt = scored.repartition("chunk").sortWithinPartitions("chunk")
    return dealt.mapInArrow(add, "chunk bigint, place bigint, n_best bigint, count_sum bigint")


def cross_alignment(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", path_a: str | None = None, path_b: str | None = None, with_groups: bool = False
) -> DataFrame:
    """Per document: token, group and link counts, ``n_best``, ``count_sum``, ``groups_sha256`` and, if asked for, ``groups`` as text."""
    documents, postings = pair_index(docs, id_col, text, path_a, path_b, with_groups)
    found = documents.join(scores(postings), ["chunk", "place"], "left")
    zero = F.lit(0).cast("bigint")
    return found.select(
        id_col, *_DOC, F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
        *["groups"] * with_groups,
    )
