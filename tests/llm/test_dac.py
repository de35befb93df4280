import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import SF, documents, odd_documents, table
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trawl.llm import dac, word_ids
from trawl.llm.queries import QUERIES
from trawl.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")


def expected(rows):
    tok = Tokenizer.from_file(PATH)
    return [(r["doc_id"], tok.encode(r["text"] or "", add_special_tokens=False).ids + [1]) for r in rows]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_query_against_the_whole_tokenizer(spark):
    want, at = [], 0
    for doc, ids in expected(sorted(table(spark, "documents").collect(), key=lambda r: r["doc_id"])):
        want.append((doc, at, len(ids), crc(ids)))
        at += len(ids)
    rows = QUERIES["op12_token_codes"](spark, SF).collect()
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows) == want


def test_words_beyond_the_default_cache_are_encoded_once(monkeypatch):
    known = word_ids.WordIds(PATH, dac.CACHED_WORDS)
    n = word_ids.CACHED_WORDS + 20_000
    encoded, word = [], known._word
    monkeypatch.setattr(known, "_word", lambda w: encoded.append(w) or word(w))
    texts = pa.array([" ".join(f"{i:x}" for i in range(n))])
    first, again = known.encode(texts)[0], known.encode(texts)[0]
    assert len(encoded) == n and np.array_equal(first, again)
    small = word_ids.WordIds(PATH, 10)  # a cache that begins anew gives the same ids
    assert np.array_equal(small.encode(texts.cast(pa.string()))[0], first) and len(small.words) <= 10


@pytest.mark.parametrize("top", [1, 200, 255, 256, 70_000, 2**24, 2**32 - 1])
def test_round_trip_and_random_access(top):
    rng = np.random.default_rng(top)
    for n in (0, 1, 7, 511, 512, 513, 5000):
        ids = rng.integers(0, top, n, endpoint=True).astype("<u4")
        ids[rng.random(n) < 0.5] %= 256
        cuts = np.sort(rng.integers(0, n + 1, 3))
        starts = np.array([0, *cuts, n])
        s = dac.Segment.of(dac.write_segment(ids, starts, [None, -5, 2**62, 7], 3, 9) + b"\n")
        assert (s.shard, s.number, s.n_tokens, s.doc_ids()) == (3, 9, n, [None, -5, 2**62, 7])
        assert s.starts().tolist() == starts.tolist()
        assert s.tokens(0, n).tolist() == ids.tolist()
        assert [s.token(i) for i in range(n)] == ids.tolist()
        for _ in range(20):
            a, b = sorted(rng.integers(0, n + 1, 2))
            assert s.tokens(int(a), int(b)).tolist() == ids[a:b].tolist()
        for bad in (-1, n):
            with pytest.raises(IndexError):
                s.token(bad)


def test_a_token_is_read_without_decoding_its_block():
    ids = np.random.default_rng(1).integers(0, 50_000, 200_000).astype("<u4")
    data, read = dac.write_segment(ids, np.array([0, len(ids)]), [1], 0, 0), []
    s = dac.Segment(lambda at, n: read.append(n) or data[at : at + n])
    read.clear()
    assert s.token(123_456) == ids[123_456]
    assert sum(read) <= 2 * (1 + 8 + 8 + dac.RANK_BITS // 8)


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        dac.Segment.of(b"no such file at all" * 10)
    with pytest.raises(ValueError):
        dac.Segment.of(dac._HEADER.pack(dac.MAGIC, 2, 1, 0, 0, 0, 0, 0) + struct.pack("<Q", 0))


def test_many_segments_and_places(spark):
    rng = random.Random(2)
    docs = documents(spark, [" ".join(rng.choices(["alpha", "beta", "gamma", "Δelta", "x1"], k=rng.randint(0, 60))) for _ in range(200)])
    path = scratch_path(spark, "dac-test")
    dac.write_ids(docs.repartition(5), path, segment_tokens=500)
    assert spark.read.format("binaryFile").load(path).count() > 8
    want = expected(docs.orderBy("doc_id").collect())
    flat = [i for _, ids in want for i in ids]
    got = sorted(dac.read_documents(spark, path, with_ids=True).collect(), key=lambda r: r["start"])
    assert [(r["doc_id"], r["ids"]) for r in got] == want
    places = spark.range(-2, len(flat) + 2, 3).select(F.col("id").alias("place"))
    found = dac.tokens_at(spark, path, places, segment_tokens=500).collect()
    assert {r["place"]: r["token"] for r in found} == {p: flat[p] if 0 <= p < len(flat) else None for p in range(-2, len(flat) + 2, 3)}


def test_odd_rows(spark):
    docs = odd_documents(spark).withColumn("id", F.lit("x")).withColumn("hash", F.lit(1)).withColumn("row", F.lit(None).cast("string"))
    path = scratch_path(spark, "dac-odd")
    dac.write_ids(docs, path)
    rows = sorted(dac.read_documents(spark, path).collect(), key=lambda r: r["start"])
    key = lambda x: (x[0] is not None, x[0] or 0, *x[1:])
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows), key=key) == sorted(
        ((d, len(ids), crc(ids)) for d, ids in expected(docs.collect())), key=key
    )
    assert [r["doc_id"] for r in rows] == [None, 1, 1, 1, 2, 3, 4, 5, 6, 7]
    assert [r["start"] for r in rows] == [sum(x["n_tokens"] for x in rows[:i]) for i in range(len(rows))]
    empty = scratch_path(spark, "dac-empty")
    dac.write_ids(docs.limit(0), empty)
    assert dac.read_documents(spark, empty).count() == 0
