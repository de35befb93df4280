"""Each stage against a plain version on its own input, and ``run`` against the stages."""

from collections import Counter

import pytest
from helpers import SF, odd_documents, table
from pyspark.sql import functions as F
from test_line_dedup import brute as brute_lines
from test_mixing import brute_budgets, brute_copies
from test_packing import check_places, expected
from test_quality import value
from test_simhash import brute_print, brute_roots

import corpus_pipeline as cp
from trawl.llm import mixing, quality
from trawl.llm.common import materialize


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before and after each stage."""
    out = [table(spark, "documents")]
    for name, stage in cp.STAGES:
        out.append(materialize(stage(spark, out[-1], SF), f"test-{name.replace(' ', '-')}"))
    return out


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_order_and_columns(stages):
    assert [n for n, _ in cp.STAGES] == ["quality classifier", "line dedup", "simhash near-dedup", "mixing", "best-fit packing"]
    for df in stages[:5]:
        assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    counts = [df.count() for df in stages]
    assert counts[0] > counts[1] > counts[2] > 0 and counts[2] >= counts[3] > 0


def test_quality_stage(spark, stages):
    model = quality.fit_on_kept_labels(stages[0].select("doc_id", "text"), table(spark, "labels"))
    stats = stages[0].select("*", quality.statistics(F.col("text")).alias("s")).collect()
    want = [tuple(r)[:5] for r in stats if value(r["s"].asDict(), model) >= 0.3]
    assert rows(stages[1]) == sorted(want, key=str)


def test_line_stage(stages):
    docs = sorted(stages[1].collect(), key=lambda r: r["doc_id"])
    want = []
    for r, gone in zip(docs, brute_lines([r["text"] for r in docs])):
        lines = r["text"].split("\n")
        left = [x for i, x in enumerate(lines) if i not in gone]
        if not gone or any(x.split() for x in left):
            text = "\n".join(left)
            want.append((r["doc_id"], text, r["lang"], r["source"], len(text)))
    assert rows(stages[2]) == sorted(want, key=str)


def test_near_duplicate_stage(stages):
    docs = sorted(stages[2].collect(), key=lambda r: r["doc_id"])
    roots = brute_roots([brute_print(r["text"]) for r in docs])
    assert rows(stages[3]) == sorted((tuple(r) for i, r in enumerate(docs) if roots[i] == i), key=str)


def test_mixing_stage(stages):
    docs = stages[3].withColumn("domain", F.expr(mixing.domain())).collect()
    paths = [(r["doc_id"], len(r["text"].split()), (r["domain"], r["lang"], r["source"])) for r in docs]
    leaves = Counter()
    for _, n, p in paths:
        leaves[p] += n
    want = brute_copies(paths, leaves, brute_budgets(leaves, mixing.CORPUS_MIX), mixing.CORPUS_MIX)
    assert Counter(r["doc_id"] for r in stages[4].collect()) == want


def test_packing_stage(stages):
    got = stages[5].collect()
    assert sorted(tuple(r)[:5] for r in got) == sorted(expected(stages[4].collect()))
    least = -(-sum(r["length"] for r in got) // 4096)
    assert check_places(got) <= least + 1


def test_run_is_the_stages_one_after_the_other(spark, stages):
    got = cp.run(spark, SF)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert rows(got.select(*key)) == rows(stages[5].select(*key))


def test_odd_documents_pass_all_stages(spark):
    docs = odd_documents(spark)
    for frame in (docs, docs.limit(0)):
        for _, stage in cp.STAGES[:-1]:
            frame = materialize(stage(spark, frame, SF), "odd")
            assert frame.columns == docs.columns
        cp.STAGES[-1][1](spark, frame, SF).count()
