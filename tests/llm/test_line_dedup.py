import random
import re

from helpers import documents, odd_documents
from pyspark.sql import functions as F

from trawl.llm import line_dedup as ld


def words_of(line):
    return frozenset(re.findall("[^\x20\x09-\x0d]+", line.lower()))


def brute(texts):
    """Line numbers that go, by document: any earlier line with a Jaccard similarity of 4/5 or more."""
    lines = [(d, i, words_of(x)) for d, t in enumerate(texts) for i, x in enumerate((t or "").split("\n"))]
    gone = [[] for _ in texts]
    for k, (d, i, x) in enumerate(lines):
        if x and any(y and 5 * len(x & y) >= 4 * len(x | y) for _, _, y in lines[:k]):
            gone[d].append(i)
    return gone


def report(spark, texts):
    rows = ld.line_report(documents(spark, texts)).orderBy("doc_id").collect()
    assert [r["n_lines"] for r in rows] == [(t or "").count("\n") + 1 for t in texts]
    got = [[int(x) for x in r["removed_lines"].split(",") if x] for r in rows]
    assert [r["n_removed"] for r in rows] == [len(x) for x in got]
    return got


def near_copies(rng, line, n, edits):
    out = []
    for _ in range(n):
        words = line.split()
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(400)}"
        out.append(" ".join(words))
    return out


def test_random_corpora_match_brute_force(spark):
    for seed in range(3):
        rng = random.Random(seed)
        pool = [" ".join(f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(rng.randint(1, 30))) for _ in range(40)]
        pool += [x for base in pool[:6] for x in near_copies(rng, base, 25, 4)] + ["", " \t", "The same line.", "the SAME  line."]
        texts = ["\n".join(rng.choice(pool) for _ in range(rng.randint(1, 8))) for _ in range(80)]
        assert report(spark, texts) == brute(texts)


def test_a_group_of_near_copies_and_the_join_without_the_first_look(spark, monkeypatch):
    rng = random.Random(4)
    base = " ".join(f"x{i}" for i in range(40))
    texts = near_copies(rng, base, 120, 9)
    want = brute(texts)
    assert report(spark, texts) == want
    monkeypatch.setattr(ld, "LOOK_BACK", 1)
    monkeypatch.setattr(ld, "LOOK_KEYS", 1)
    assert report(spark, texts) == want


def test_threshold_and_chains(spark):
    ten = [f"t{i}" for i in range(10)]
    texts = [
        " ".join(ten),
        " ".join([*ten[:8], "o1", "o2"]),  # 8 / 12: stays
        " ".join(ten[:8]),  # 8 / 10: goes
        " ".join(ten[:7]),  # 7 / 8 with the one that went: goes
        "t0",
        "T0 t0",
    ]
    assert report(spark, texts) == brute(texts) == [[], [], [0], [0], [], [0]]


def test_dedup_lines_keeps_the_rest(spark):
    texts = ["a b c\n\nd e f", "d e f\n  \ng h i", "a b c", None, "", "  \n", "d e f\na b c\n"]
    docs = documents(spark, texts).withColumn("kept", F.lit("x")).withColumn("line_no", F.lit(1))
    got = ld.dedup_lines(docs)
    assert got.columns == docs.columns
    rows = {r["doc_id"]: (r["text"], r["n_chars"]) for r in got.collect()}
    assert rows == {0: (texts[0], 12), 1: ("  \ng h i", 8), 3: (None, 0), 4: ("", 0), 5: ("  \n", 3)} or rows[3][0] is None
    assert set(rows) == {0, 1, 3, 4, 5} and rows[1] == ("  \ng h i", 8)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    got = ld.line_report(docs)
    assert got.count() == docs.count()
    by_text = {}
    for r in got.join(docs.select("doc_id", "text"), "doc_id").collect():
        by_text.setdefault(r["doc_id"], set()).add(r["n_removed"])
    assert by_text[5] == {0} and by_text[1] == {0}
    kept = ld.dedup_lines(docs)
    assert sorted(map(str, kept.select("doc_id", "text").collect())) == sorted(map(str, docs.select("doc_id", "text").collect()))
    assert ld.dedup_lines(docs.limit(0)).count() == 0 and ld.line_report(docs.limit(0)).count() == 0


def test_keys_sort_by_rarity(spark):
    docs = documents(spark, ["b a", "a c", "a b d", "a"])
    own = ld._documents(docs, "doc_id", "text")
    rows = ld._keyed(ld._lines(own), ld._levels(own)).collect()
    hashes = spark.createDataFrame([(w,) for w in "abcd"], "line string").select("line", F.xxhash64("line").alias("h"))
    low = (1 << 58) - 1
    name = {r["h"] & low: r["line"] for r in hashes.collect()}
    order = ["".join(name[k & low] for k in r["keys"]) for r in sorted(rows, key=lambda r: r["__id"])]
    assert order == ["ba", "ca", "dba", "a"]  # a is found four times, b twice, the others once
    levels = {name[k & low]: (k >> 58) + 32 for r in rows for k in r["keys"]}
    assert levels == {"a": 5, "b": 3, "c": 0, "d": 0}


def test_words_found_once_have_no_postings_and_summaries_count_differences(spark):
    own = ld._documents(documents(spark, ["a b c d e f g h", "a b c d e f g i", "j k l m n o p q"]), "doc_id", "text")
    classes = ld._classes(ld._keyed(ld._lines(own), ld._levels(own)))
    first = {r["__id"]: r for r in classes.collect()}
    assert [r["cid"] for r in sorted(first.values(), key=lambda r: r["__id"])] == sorted(r["cid"] for r in first.values())
    assert first[2]["prefix"] == [None, None] and first[0]["prefix"][0] is None and first[0]["prefix"][1] is not None
    ids = {r["cid"]: i for i, r in first.items()}
    assert {ids[r["cid"]] for r in ld._postings(classes).collect()} == {0, 1}
    apart = sum(bin((first[0][p] ^ first[1][p]) & (2**64 - 1)).count("1") for p in ("p0", "p1"))
    assert apart in (0, 2)  # h and i, unless both hashes point to one place


def test_no_python_on_the_main_path(spark):
    docs = ld._documents(documents(spark, ["a b"]), "doc_id", "text")
    keyed = ld._keyed(ld._lines(docs), spark.createDataFrame([([0] * (1 << ld.COUNTER_BITS),)], "levels array<tinyint>"))
    for df in (ld._levels(docs), ld._classes(keyed)):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "Arrow" not in text


def test_keys_are_never_null(spark):
    """So they are sorted as plain longs, without a comparator."""
    docs = ld._documents(documents(spark, ["a b\tc", None]), "doc_id", "text")
    assert not ld._keyed(ld._lines(docs), ld._levels(docs)).schema["keys"].dataType.containsNull


def test_every_separator_and_case(spark):
    texts = ["A B\tC\x0bD\x0cE\r", "\r\t a  b c d e\x0c", "\x0b\t \r", " e d c b a\n\tE\nΟΔΟΣ a b c", "οδος a b c", "a\u00a0b\x85c", "A\u00a0B\x85C"]
    assert report(spark, texts) == [[], [0], [], [0], [0], [], [0]]


def test_a_near_copy_behind_several_lines_under_every_key_is_looked_at(spark):
    a = [f"a{i}" for i in range(20)]
    between = [" ".join([*(a[:10] if i % 2 else a[10:]), *(f"f{i}x{j}" for j in range(10))]) for i in range(10)]
    texts = [" ".join(a), *between, " ".join([*a[:19], "b"])]
    own = ld._documents(documents(spark, texts), "doc_id", "text")
    classes = ld._classes(ld._keyed(ld._lines(own), ld._levels(own))).cache()
    doc = {r["cid"]: r["__id"] for r in classes.collect()}
    assert [(doc[r["a"]], doc[r["b"]]) for r in ld._near_predecessors(classes).collect()] == [(0, 11)]
    assert report(spark, texts) == brute(texts)


def test_both_sides_of_the_join_read_one_shuffle(spark):
    own = ld._documents(documents(spark, ["a b c d e f g h i j", "a b c d e f g h i k", "x"]), "doc_id", "text")
    classes = ld.materialize(ld._classes(ld._keyed(ld._lines(own), ld._levels(own))), "classes")
    settled = spark.createDataFrame([], "b bigint")
    pairs = ld._joined_pairs(classes, settled)
    assert pairs.count() == 1
    entry = ld._joined_pairs(classes, settled)
    entry.collect()
    plan = entry._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan and "[meet#" in plan


def test_only_frequent_keys_are_looked_at_before_the_join(spark):
    rare = [" ".join(f"r{i}" for i in range(20)), " ".join([*(f"r{i}" for i in range(19)), "s"])]
    group = [" ".join([*(f"g{i}" for i in range(20)), f"u{j}"]) for j in range(12)]
    texts = [*rare, *group]
    own = ld._documents(documents(spark, texts), "doc_id", "text")
    classes = ld._classes(ld._keyed(ld._lines(own), ld._levels(own))).cache()
    doc = {r["cid"]: r["__id"] for r in classes.collect()}
    assert {doc[r["b"]] for r in ld._near_predecessors(classes).collect()} == set(range(3, 14))
    assert report(spark, texts) == brute(texts)


def test_summaries_are_parities_of_the_keys(spark):
    own = ld._documents(documents(spark, ["a b\tc d e", "f g", "A\x0bh\ri\x0cj k l m n o p"]), "doc_id", "text")
    keyed = ld._keyed(ld._lines(own), ld._levels(own))
    want = set()
    for r in keyed.collect():
        p = [0, 0]
        for k in r["keys"]:
            p[k >> 6 & 1] ^= 1 << (k & 63)
        want.add((r["__id"], *p))
    got = {(r["__id"], *(r[c] & (2**64 - 1) for c in ("p0", "p1"))) for r in ld._classes(keyed).collect()}
    assert got == want and len(got) == 3


def test_separators_are_replaced_only_where_there_are_some(spark):
    texts = ["A b", "A\tb\x0bc\x0cd\re\nf", "Ä B", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(ld._spaced("t").alias("s")).collect()
    assert [r["s"] for r in rows] == ["a b", "a b c d e\nf", "ä b", None]


def test_pairs_of_every_size_meet_on_the_smaller_ones_short_prefix(spark):
    """One frequent word order, so that prefixes decide; sizes on both sides of the bands' borders, in both orders."""
    rng = random.Random(9)
    texts = []
    for n in [*range(4, 36), 61, 64, 77, 80, 81, 100, 127, 128, 160]:
        base = [f"b{n}x{i}" for i in range(n)]
        longest = base + [f"e{n}x{i}" for i in range(n // 4)]
        for line in (base, longest, longest[:-1], rng.sample(base, n - n // 9)):
            texts.append(" ".join(rng.sample(line, len(line))))
    rng.shuffle(texts)
    want = brute(texts)
    assert report(spark, texts) == want and sum(map(len, want)) > 100


def test_a_visitor_has_its_short_prefix_only(spark):
    a, b = [f"a{i}" for i in range(15)], [f"a{i}" for i in range(17)]
    own = ld._documents(documents(spark, [" ".join(a), " ".join(b)]), "doc_id", "text")
    classes = ld.materialize(ld._classes(ld._keyed(ld._lines(own), ld._levels(own))), "classes")
    pairs = ld._joined_pairs(classes, spark.createDataFrame([], "b bigint"))
    assert pairs.count() == 1
    short = classes.select("n", F.size("prefix").alias("full"), ld._smaller_prefix_size().alias("short"))
    assert sorted(map(tuple, short.collect())) == [(15, 4, 2), (17, 4, 2)]
    # the word shared by both in the prefix of one only, past the short prefix of the smaller: no meeting is needed there
    assert report(spark, [" ".join(a), " ".join(b)]) == [[], [0]]


def test_a_sieve_parts_rows_without_losing_any(spark):
    rows = spark.range(5000).select(F.col("id").alias("cid"))
    some = rows.where("cid % 50 = 0")
    perhaps, others = ld._sifted(rows, some, "sieve", "cid")
    p, o = {r["cid"] for r in perhaps.collect()}, {r["cid"] for r in others.collect()}
    assert not p & o and p | o == set(range(5000)) and p >= set(range(0, 5000, 50)) and len(p) < 200
    perhaps, others = ld._sifted(rows, some.limit(0), "sieve", "cid")
    assert perhaps.count() == 0 and others.count() == 5000


def test_classes_are_not_shuffled_for_the_few_settled_ones(spark):
    own = ld._documents(documents(spark, ["a b c d e f g h i j", "a b c d e f g h i k", "x"]), "doc_id", "text")
    classes = ld.materialize(ld._classes(ld._keyed(ld._lines(own), ld._levels(own))), "classes")
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = ld._joined_pairs(classes, spark.createDataFrame([(10**9,)], "b bigint"))
        assert pairs.count() == 1
        assert "Union" in pairs._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
