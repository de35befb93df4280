import random
import re

import xxhash
from helpers import SF, documents, odd_documents, table
from pyspark.sql import functions as F

from trawl.llm import simhash
from trawl.llm.components import components
from trawl.llm.queries import QUERIES


def brute_print(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lower)
    if not words:
        return 0
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(prints):
    """Least index reachable over links of at most 2 bits."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_query_matches_brute_force(spark):
    docs = table(spark, "documents").orderBy("doc_id").collect()
    prints = [brute_print(d["text"]) for d in docs]
    roots = brute_roots(prints)
    want = {d["doc_id"]: (f"{p:016x}", docs[r]["doc_id"]) for d, p, r in zip(docs, prints, roots)}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op6_simhash"](spark, SF).collect()}
    assert got == want
    assert len({c for _, c in got.values()}) < len(got)


def close_prints(rng, n, flips):
    """Chains and clouds of fingerprints around a few centres, some shared by many blocks."""
    out = set()
    for _ in range(n):
        p = rng.getrandbits(64)
        for _ in range(rng.randint(1, flips)):
            out.add(p)
            p ^= 1 << rng.randrange(64)
            if rng.random() < 0.5:
                p ^= 1 << rng.randrange(64)
    return sorted(out)


def test_links_give_the_components_with_and_without_hot_keys(spark, monkeypatch):
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    cloud = {centre ^ (1 << a) ^ (1 << b) ^ (1 << c) for a in range(0, 64, 9) for b in range(1, 64, 7) for c in range(8)}
    prints = sorted(set(close_prints(rng, 60, 12)) | cloud)
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp bigint")
    want = brute_roots(prints)
    classes = {}
    for i, r in enumerate(want):
        classes.setdefault(r, set()).add(signed(prints[i]))
    want_sets = sorted(map(sorted, classes.values()))
    for hot in (0, 3, 64, 10_000):
        monkeypatch.setattr(simhash, "HOT_KEY", hot)
        root = {r["node"]: r["root"] for r in components(simhash.links(df)).collect()}
        got = {}
        for p in prints:
            got.setdefault(root.get(signed(p), signed(p)), set()).add(signed(p))
        assert sorted(map(sorted, got.values())) == want_sets


def test_components_of_a_long_chain_and_a_star(spark):
    rows = [(i, i + 1) for i in range(300)] + [(1000, 2000 + i) for i in range(300)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(rows, "u bigint, v bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, **{2000 + i: 1000 for i in range(300)}}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_odd_rows(spark):
    docs = odd_documents(spark).withColumn("fp", F.lit("x")).withColumn("root", F.lit(1))
    got = {}
    for r in simhash.near_duplicates(docs).collect():
        got.setdefault(r["doc_id"], set()).add((r["fp"], r["component_id"]))
    assert {x for i in (2, 3, 4) for x in got[i]} == {(0, 2)}
    assert got[None] == {(signed(brute_print("No id at all.")), None)}
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect() if r["doc_id"] not in (2, 5, 6, 7))
    assert ids == [(0, "No id at all."), (1, "Another text under the same id."), (1, "One plain text here.")]
    assert simhash.drop_near_duplicates(docs.limit(0)).count() == 0
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_one_of_each_group_stays(spark):
    texts = ["the same words here", "The SAME\twords  here", "something else altogether now", "the same words here"]
    kept = simhash.drop_near_duplicates(documents(spark, texts))
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2]
