import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from helpers import SF, documents, odd_documents, table
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trawl.llm import packing, word_ids
from trawl.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


def expected(docs):
    tok = Tokenizer.from_file(PATH)
    out = []
    for d in docs:
        ids = tok.encode(d["text"] or "", add_special_tokens=False).ids + [1]
        for i, at in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[at : at + 4096], dtype="<u4")
            out.append((d["doc_id"], i, at, len(part), zlib.crc32(part.tobytes())))
    return out


def check_places(rows, capacity=4096):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_pieces_and_places(spark):
    rows = QUERIES["op4_best_fit_packing"](spark, SF).collect()
    got = sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    assert got == sorted(expected(table(spark, "documents").collect()))
    least = -(-sum(r["length"] for r in rows) // 4096)
    assert least <= check_places(rows) <= least + 1


def test_odd_rows(spark):
    docs = odd_documents(spark).withColumn("offset", F.lit(5)).withColumn("sequence_id", F.lit("x"))
    rows = packing.pack_documents(docs).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    got = sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows), key=key)
    assert got == sorted(expected(docs.collect()), key=key)
    check_places(rows)
    assert packing.pack_documents(docs.limit(0)).count() == 0


ODD = [*"aAbzZ09 .,'\n\t\u00e9\u0301\u00c9\u0130\u00df\u00aa\u2082\u3000\ufb01\x00\x1c\x85<|>", "'s", "'LL", "<|endoftext|>", "  ", "\U0001f600"]


def test_word_cache_equals_the_tokenizer_on_odd_strings():
    rng = random.Random(5)
    tok, own = Tokenizer.from_file(PATH), word_ids.WordIds(PATH)
    assert own.by_word
    texts = [
        "It's I'LL we've 'Tis o''clock a.b,c!! x1y22 ½ ² ªº µm Straße ÀÉÎ ÿŸ",
        "é ́x áb Å İ ſs ﬁ \x1c\x1dq \x85  z   　 ​",
        "<|endoftext|>a <|startoftext|> <| endoftext |> <|endoftext|",
        "日本語 テキスト мир ΟΔΥΣΣΕΥΣ Σ \U0001f600\U0001f601 \x00\x01\x7f",
    ]
    texts += ["", " \n", " lead and trail ", *("".join(rng.choices(ODD, k=40)) for _ in range(2000))]
    ids, ends = own.encode(pa.array([*texts, None]))
    want = [tok.encode(t, add_special_tokens=False).ids for t in [*texts, ""]]
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == want


def test_other_tokenizer_files_encode_whole_texts(spark):
    """A file with another pre-tokenizer isn't taken word by word: its ids are those of the whole text."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    assert not word_ids.WordIds(path).by_word
    texts = ["two  words", " \n x", "", "plain text here"]
    got = packing.token_pieces(documents(spark, texts), tokenizer=path, end_id=50256, with_ids=True).collect()
    assert {r["doc_id"]: r["ids"] for r in got} == {i: tok.encode(t, add_special_tokens=False).ids + [50256] for i, t in enumerate(texts)}


def test_slices_hold_whole_texts():
    texts = pa.array(["a" * 10, None, "b" * 100, "", "c"])
    parts = [p.to_pylist() for p in word_ids.slices(texts, 20)]
    assert sum(parts, []) == texts.to_pylist() and parts[0] == ["a" * 10, None]


def test_sum_of_squares_rule_against_brute_force():
    """Every placement has the least sum of squared gap counts of all open bins with room."""
    rng = np.random.default_rng(3)
    for _ in range(20):
        capacity = int(rng.integers(5, 30))
        sizes = rng.integers(1, capacity + 1, size=60)
        bins, offsets = packing.sum_of_squares(sizes, capacity)
        level = {}
        for i in np.argsort(-sizes, kind="stable"):
            s, b = int(sizes[i]), int(bins[i])

            def score(choice):
                after = {**level, choice: level.get(choice, 0) + s}
                counts = defaultdict(int)
                for h in after.values():
                    counts[h] += h < capacity
                return sum(c * c for c in counts.values())

            fits = [x for x, h in level.items() if h < capacity and h + s <= capacity]
            assert offsets[i] == level.get(b, 0)
            if fits:
                assert b in level and score(b) == min(map(score, fits))
            else:
                assert b not in level
            level[b] = level.get(b, 0) + s


def test_sequences_hold_the_ids(spark):
    docs = documents(spark, ["a b c", "", "d e " * 3000, None])
    ids = packing.token_pieces(docs, with_ids=True)
    packed = packing.pack(ids.drop("ids"), 4)
    tok = Tokenizer.from_file(PATH)
    want = {d["doc_id"]: tok.encode(d["text"] or "", add_special_tokens=False).ids + [1] for d in docs.collect()}
    got = defaultdict(dict)
    for s in packing.sequences(ids, packed).collect():
        for p, q in zip(s["parts"], [*s["parts"][1:], None]):
            got[p["doc_id"]][p["piece"]] = s["ids"][p["offset"] : q["offset"] if q else None]
    assert {k: sum((v[i] for i in sorted(v)), []) for k, v in got.items()} == want
