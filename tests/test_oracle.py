"""Every registered query against its DuckDB statement (the round driver's check, at sf0.001)."""

import math
from pathlib import Path
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from sf_dirs import SF001
from trawl.plans import oracle
from trawl.plans.catalog import QUERIES

TABLES = "events documents pages benchmark".split()


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def table(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), Counter(tuple(norm(r[i]) for i in order) for r in records)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_query_of_the_survey_has_an_oracle():
    assert set(oracle_sql()) <= set(queries())
    assert {q for q in queries() if not q.startswith("op") and q != "pipeline"} <= set(oracle_sql())


def test_the_oracle_imports_nothing_it_checks():
    source = Path(oracle.__file__).read_text()
    assert "trawl.functions" not in source and "trawl.operators" not in source


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["qid", "rank", "url", "score"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF001)
    rel = con.sql(oracle_sql()[name])
    assert table(df.columns, df.collect()) == table(rel.columns, rel.fetchall())
