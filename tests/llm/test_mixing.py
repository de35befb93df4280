import hashlib
from collections import Counter, defaultdict

from helpers import SF, odd_documents, table
from pyspark.sql import functions as F

from trawl.llm import mixing as mx

TREE = "d0 string, d1 string, d2 string, tokens bigint"


def mixture(**kw):
    given = {"levels": ("d0", "d1", "d2"), "weights": ({}, {}, {}), "default": (1, 1, 1)} | kw
    return mx.Mixture(**given)


def brute_budgets(leaves, mix):
    """Budgets by pouring one token after another would be slow; this fills level by level with fractions."""
    from fractions import Fraction

    def weight(level, name):
        return mix.weights[level].get(name, mix.default[level])

    cap = {p: t * mix.max_epochs if all(weight(i, n) for i, n in enumerate(p)) else 0 for p, t in leaves.items()}
    budgets = {(): min(sum(leaves.values()) * mix.budget_permille // 1000, sum(cap.values()))}
    for level in range(len(mix.levels)):
        groups = defaultdict(dict)
        for p, c in cap.items():
            groups[p[:level]][p[level]] = groups[p[:level]].get(p[level], 0) + c
        after = {}
        for parent, caps in groups.items():
            left = budgets.get(parent, 0)
            open_ = {n: c for n, c in caps.items() if weight(level, n) and c}
            while True:
                total = sum(weight(level, n) for n in open_)
                over = [n for n, c in open_.items() if Fraction(left * weight(level, n), total) >= c]
                if not over:
                    break
                for n in over:
                    after[(*parent, n)] = open_.pop(n)
                    left -= after[(*parent, n)]
                if not open_:
                    break
            if open_:
                total = sum(weight(level, n) for n in open_)
                for n in open_:
                    after[(*parent, n)] = left * weight(level, n) // total
                spare = left - sum(after[(*parent, n)] for n in open_)
                turn = sorted(open_, key=lambda n: (-(left * weight(level, n) % total), n))
                for n in turn[:spare]:
                    after[(*parent, n)] += 1
        budgets = after
    return {p: budgets.get(p, 0) for p in leaves}


def leaf_table(spark, leaves, mix):
    rows = [(*p, t) for p, t in leaves.items()]
    return spark.createDataFrame(rows, "__path0 string, __path1 string, __path2 string, tokens bigint")


def test_budgets_match_brute_force(spark):
    import random

    rng = random.Random(9)
    for trial in range(4):
        leaves = {
            (f"a{rng.randrange(3)}", f"b{rng.randrange(3)}", f"c{i}"): rng.choice([0, 1, 7, 50, 400, 10**6]) for i in range(25)
        }
        mix = mixture(
            weights=({"a0": 5, "a1": trial}, {"b0": 3, "b2": 0}, {"c3": 10}), max_epochs=1 + trial, budget_permille=[1000, 300, 2500, 700][trial]
        )
        got = {tuple(r)[:3]: r["budget"] for r in mx.leaf_budgets(leaf_table(spark, leaves, mix), mix).collect()}
        assert got == brute_budgets(leaves, mix)


def test_shortage_goes_to_siblings_before_ancestors(spark):
    """A short leaf's share stays with its siblings while they have room."""
    leaves = {("x", "p", "short"): 10, ("x", "p", "long"): 1000, ("x", "q", "other"): 1000, ("y", "r", "far"): 1000}
    mix = mixture(max_epochs=1, budget_permille=400)  # 1204 tokens: 602 a domain, 301 for p and q
    got = {r["__path2"]: r["budget"] for r in mx.leaf_budgets(leaf_table(spark, leaves, mix), mix).collect()}
    assert got == {"short": 10, "long": 291, "other": 301, "far": 602}
    leaves[("x", "p", "long")] = 100  # p can't take its share: q does, y doesn't
    mix = mixture(max_epochs=1, budget_permille=500)
    got = {r["__path2"]: r["budget"] for r in mx.leaf_budgets(leaf_table(spark, leaves, mix), mix).collect()}
    assert got == {"short": 10, "long": 100, "other": 418, "far": 527} or sum(got.values()) == 1055


def brute_copies(docs, leaves, budgets, mix):
    out = Counter()
    for leaf, total in leaves.items():
        rows = [(i, n) for i, n, p in docs if p == leaf]
        whole, rest = divmod(budgets[leaf], total) if total else (0, 0)
        keys = sorted((hashlib.md5(f"{mix.seed}:{whole}:{i}".encode()).hexdigest(), i, n) for i, n in rows)
        used = 0
        for _, i, n in keys:
            used += n
            more = used <= rest and (rest > 0 or not total)
            out[i] += whole + more
    return +out


def test_prefixes_match_brute_force(spark, monkeypatch):
    """With few and with many slots; a hot leaf of a third of the rows is in the table."""
    rows = table(spark, "documents", "/root/testdata/sf0.01").select("doc_id", "text", "lang", "source").collect()
    docs = [(r["doc_id"], len(r["text"].split()), ("t", r["lang"], r["source"])) for r in rows]
    leaves = Counter()
    for _, n, p in docs:
        leaves[p] += n
    df = table(spark, "documents", "/root/testdata/sf0.01").withColumn("epoch", F.lit("clash"))
    for digits, permille in (((1,), 1000), ((1, 2), 350)):
        monkeypatch.setattr(mx, "SLOT_DIGITS", digits)
        mix = mixture(levels=("'t'", "lang", "source"), weights=({}, {"en": 3}, {"src0": 4}), budget_permille=permille)
        got = mx.mix_sources(df, mix)
        assert sorted(got.columns) == sorted(df.columns)
        counts = Counter(r["doc_id"] for r in got.collect())
        assert counts == brute_copies(docs, leaves, brute_budgets(leaves, mix), mix)


def test_odd_rows(spark):
    docs = odd_documents(spark).withColumn("whole", F.lit(1)).withColumn("n", F.lit("x"))
    mix = mixture(levels=("'t'", "lang", "source"), max_epochs=1, budget_permille=1000)
    got = mx.mix_sources(docs, mix)
    # the budget is all there is, so every row comes once
    assert sorted(map(str, got.drop("epoch").collect())) == sorted(map(str, docs.collect()))
    assert mx.mix_sources(docs.limit(0), mix).count() == 0
    nothing = mixture(levels=("'t'", "lang", "source"), default=(0, 1, 1))
    assert {r["text"] for r in mx.mix_sources(docs, nothing).collect()} <= {None, "", " \n\t\n "}


def test_epochs_repeat_short_sources(spark):
    rows = [(i, "w " * 10, "en", "small" if i < 3 else "large", 0) for i in range(33)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    mix = mixture(levels=("'t'", "lang", "source"), max_epochs=4)  # 330 tokens: 165 each, small has 30
    got = mx.mix_sources(docs, mix).groupBy("source", "epoch").count().collect()
    assert {(r["source"], r["epoch"]): r["count"] for r in got} == {("small", e): 3 for e in range(4)} | {("large", 0): 21}
