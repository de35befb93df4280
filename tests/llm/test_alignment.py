import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from helpers import SF, documents, odd_documents, table
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trawl.llm import alignment as al
from trawl.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


class Plain:
    """Whole texts, every pair of tokens looked at."""

    def __init__(self):
        self.a, self.b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        self.chars = {c: i for i, c in enumerate(self._table())}

    @staticmethod
    def _table():
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        odd = iter(range(256, 512))
        return [chr(i) if i in printable else chr(next(odd)) for i in range(256)]

    def tokens(self, text):
        if not text:
            return None
        raw = (" " + text).encode()
        ids = self.a.encode(" " + text, add_special_tokens=False).ids
        a = [(i, bytes(self.chars[c] for c in self.a.id_to_token(i))) for i in ids]
        b = []
        for i in self.b.encode(text):
            p = self.b.id_to_piece(i)
            b.append((i, bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()))
        if b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
            return None
        return a, b

    def links(self, text):
        found = self.tokens(text)
        if found is None:
            return 0, 0, [], ""
        spans = []
        for tokens in found:
            at, out = 0, []
            for i, x in tokens:
                out.append((i, at, at + len(x)))
                at += len(x)
            spans.append(out)
        cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        inside = lambda s, lo, hi: ",".join(str(i) for i, _, e in s if lo < e <= hi)
        groups = [f"{inside(spans[0], lo, hi)}|{inside(spans[1], lo, hi)}" for lo, hi in zip([0, *cuts], cuts)]
        pairs = [(i, j) for i, s, e in spans[0] for j, t, f in spans[1] if s < f and t < e]
        return len(spans[0]), len(spans[1]), pairs, ";".join(groups)


def expected(texts):
    plain = Plain()
    found = [plain.links(t) for t in texts]
    count = Counter(p for _, _, pairs, _ in found for p in set(pairs))
    top = defaultdict(int)
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    return [
        (n_a, n_b, groups.count(";") + 1 if groups else 0, len(pairs), sum(count[p] == top[p[0]] for p in pairs), sum(count[p] for p in pairs),
         hashlib.sha256(groups.encode()).hexdigest() if groups else "")
        for n_a, n_b, pairs, groups in found
    ]


def test_query_against_brute_force(spark):
    docs = [r for r in table(spark, "documents").collect()]
    short = [r for r in docs if len(r["text"] or "") < 3000]
    got = al.cross_alignment(spark.createDataFrame(short, table(spark, "documents").schema)).collect()
    want = dict(zip([r["doc_id"] for r in short], expected([r["text"] for r in short])))
    assert len(got) == len(short)
    assert {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in got} == want


def test_the_query_covers_the_whole_table(spark):
    rows = QUERIES["op13_token_alignment"](spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in table(spark, "documents").collect()}
    plain = Plain()
    for r in rows:
        a, b = plain.tokens(texts[r["doc_id"]])
        assert (r["n_a"], r["n_b"]) == (len(a), len(b))
    assert len(rows) == len(texts) and all(r["count_sum"] >= r["n_links"] >= r["n_best"] for r in rows)


def test_pieces_give_what_whole_texts_give():
    known, plain = al.Aligner(A, B), Plain()
    assert known.by_piece
    rng = random.Random(3)
    odd = [*" \n\t.,'é́　\x1c\x85 ▁<>0aZ", "  ", "\n\n", "ing", "'s", "\U0001f600", "<0x0A>", "<s>", "<|endoftext|>", "ß", "word", al.MARK]
    texts = ["".join(rng.choices(odd, k=rng.randint(1, 25))) for _ in range(3000)] + [" ", "  ", "\n", "a ", " a", "a\n", "\na", "a \n b"]
    for part in (texts[:1500], texts[1500:], [t.replace(al.MARK, "") for t in texts]):
        found = al.align_texts(known, pa.array(part))
        for i, t in enumerate(part):
            n_a, n_b, pairs, groups = plain.links(t)
            assert (found.n_a[i], found.n_b[i], found.n_links[i], found.groups[i]) == (n_a, n_b, len(pairs), groups), repr(t)


def test_containers_and_planes_round_trip():
    rng = np.random.default_rng(4)
    for n in (1, 2, al.DENSE, al.DENSE + 1, 20_000):
        place = np.sort(rng.choice(al.CHUNK_DOCUMENTS, n, replace=False))
        links = rng.integers(1, 70, n)
        pair, sizes, total, bitmaps, planes = al.containers(np.full(n, 9), place, links)
        assert (pair.tolist(), sizes.tolist(), total.tolist()) == ([9], [n], [links.sum()])
        assert al.places_of(n, bitmaps[0]).tolist() == place.tolist()
        assert al.links_of(n, planes[0]).tolist() == links.tolist()
        other = np.sort(rng.choice(al.CHUNK_DOCUMENTS, 50, replace=False))
        _, m, _, more, _ = al.containers(np.zeros(50, np.int64), other, np.ones(50, np.int64))
        size, merged = al.or_merge(n, bitmaps[0], int(m[0]), more[0])
        assert al.places_of(size, merged).tolist() == sorted({*place.tolist(), *other.tolist()})


def test_odd_rows_and_repeats(spark):
    docs = odd_documents(spark).withColumn("chunk", F.lit("x")).withColumn("a", F.lit(1)).withColumn("place", F.lit(None).cast("int"))
    rows = al.cross_alignment(docs.repartition(3), with_groups=True).collect()
    texts = [r for r in docs.collect() if len(r["text"] or "") < 20_000]
    assert len(rows) == 10 and [r["n_a"] for r in rows if r["doc_id"] in (2, 3)] == [0, 0]
    assert all(hashlib.sha256(r["groups"].encode()).hexdigest() == r["groups_sha256"] for r in rows if r["groups"])
    plain = Plain()
    for r in texts:
        n_a, n_b, pairs, groups = plain.links(r["text"])
        assert (n_a, n_b, len(pairs), groups) in [(x["n_a"], x["n_b"], x["n_links"], x["groups"]) for x in rows if x["doc_id"] == r["doc_id"]]
    assert al.cross_alignment(docs.limit(0)).count() == 0


def test_pair_counts(spark):
    texts = ["some words here", "some words", "some other words here", None, "some some some"]
    _, postings = al.pair_index(documents(spark, texts).repartition(3))
    plain = Plain()
    found = [plain.links(t)[2] for t in texts]
    n_docs, links = Counter(p for pairs in found for p in set(pairs)), Counter(p for pairs in found for p in pairs)
    got = {(r["a"], r["b"]): (r["n_docs"], r["pair_links"]) for r in al.pair_counts(postings).collect()}
    assert got == {p: (n_docs[p], links[p]) for p in n_docs}


def test_other_files_take_whole_texts(spark):
    """A is a file whose settings aren't the known ones: nothing is cut, and its ids are those of the whole text."""
    known = al.Aligner(public_tokenizers.path("word_bpe_49k.json"), B)
    assert not known.by_piece
    found = al.align_texts(known, pa.array(["a b", None, ""]))
    assert found.n_a.tolist() == [0, 0, 0]  # it drops white space, so the bytes aren't restored
