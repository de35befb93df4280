import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from helpers import SF, table
from pyspark.sql import functions as F

from trawl.llm import prefix_trie as pt
from trawl.llm.queries import QUERIES

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def ordered(rows):
    """Turns (role, text) by conversation; turns of one number by their id, as the operator states."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            convs[c].append((turn is not None, turn or 0, digest, (role, text)))
    return {c: [t[3] for t in sorted(x, key=lambda t: t[:3])] for c, x in convs.items()}


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + turns[h:]
    return out


def brute_force(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in sorted(convs.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, held in members.items():
        if path:
            children[path[:-1]] += 1
    for path, held in members.items():
        cost = (len(held) - 1) * len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += cost
    digest = lambda p: hashlib.sha256(",".join(map(str, ends.get(p, []))).encode()).hexdigest()
    return sorted(
        (held[0], len(p), members[p[:-1]][0] if p else -1, len(held), children[p], leaves[p], saved[p], digest(p)) for p, held in members.items()
    )


def nodes(df):
    return sorted(tuple(-1 if r[c] is None else r[c] for c in COLUMNS) for r in df.collect())


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in table(spark, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert nodes(QUERIES["op11_prefix_trie"](spark, SF)) == brute_force(rebuilt(ordered(rows)))


@pytest.mark.parametrize("panel, seed", [(32, 1), (2, 2), (3, 3), (1, 4)])
def test_shared_prefixes_over_many_shards_and_panels(spark, panel, seed):
    """Few different turns, so nodes are large and span shards; conversations end inside others and go over panels."""
    rng = random.Random(seed)
    rows = []
    for c in range(150):
        length = rng.choice([1, 2, 3, 5, 6, 13]) if c % 10 else 6
        words = [rng.choice("xxxy") for _ in range(length)] if c % 3 else ["x"] * length
        rows += [(c * 7, i, "user", w * (i + 1)) for i, w in enumerate(words)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    turns = pt.turns_of(df)
    assert nodes(pt.prefix_trie(*pt.whole(turns), panel=panel)) == brute_force(ordered(rows))
    assert nodes(pt.prefix_trie(*pt.rebuilt(turns), panel=panel)) == brute_force(rebuilt(ordered(rows)))


def test_odd_rows(spark):
    rows = [
        (0, None, None, None), (0, 1, "user", "a"), (0, 1, "user", "a"), (0, 0, "", "é" * 1000), (1, 3, "user", ""), (1, 3, None, "z"),
        (None, 0, "user", "nobody"), (-7, 0, "user", "a"), (-5, 0, "user", "b"), (2**40, 0, "1:", "x"), (2**40 + 1, 0, "1", ":x"),
        (4, 0, "user", "w" * 200_000), (7, 1, "user", "only"),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"id": F.lit(1), "pos": F.lit("x"), "total": F.lit(None).cast("int")})
    turns = pt.turns_of(df)
    assert nodes(pt.prefix_trie(*pt.whole(turns))) == brute_force(ordered(rows))
    convs = ordered(rows)
    truncated = {c: c - (c % 5 if c >= 0 else -(-c % 5)) for c in convs}  # % keeps the sign of c
    want = {c: convs.get(truncated[c], [])[: (h := zlib.crc32(str(c).encode()) % 9)] + x[h:] for c, x in convs.items()}
    assert nodes(pt.prefix_trie(*pt.rebuilt(turns))) == brute_force(want)
    assert nodes(pt.prefix_trie(*pt.rebuilt(pt.turns_of(df.limit(0))))) == []
    only = spark.createDataFrame([(1, 0, "user", "gone")], SCHEMA)  # h of 1 is over 0: nothing is left but the root
    assert nodes(pt.prefix_trie(*pt.rebuilt(pt.turns_of(only)))) == brute_force(rebuilt(ordered([(1, 0, "user", "gone")])))
