"""Live stall detection (W6): drained stream equals the batch report; odd rows."""

from datetime import datetime, timedelta

import pytest

from trawl.operators.reports import stall_ticks
from trawl.streaming import index_stream as xs
from trawl.streaming.stall_stream import stall_stream

START = datetime(2024, 1, 1, 12, 0, 0, 500)
SCHEMA = "url STRING, ts TIMESTAMP, note STRING"


def at(seconds):
    return START + timedelta(seconds=seconds)


@pytest.fixture
def crawl(spark, tmp_path):
    """Lands fetches and drains the query over all that came so far; gives every tick closed until then."""
    schema = spark.createDataFrame([], SCHEMA).schema

    def arrive(*fetches):
        rows = [(url, None if s is None else at(s), "x") for url, s in fetches]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "landing"))
        stream = xs.file_stream(spark, str(tmp_path / "landing"), schema, files_per_trigger=None)
        ticks = stall_stream(stream, START, 30, "10 seconds", buckets=4)
        out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
        xs.write_stream(ticks, out, checkpoint, state=xs.ROCKSDB, state_partitions=2).awaitTermination()
        return sorted(tuple(r) for r in spark.read.schema(ticks.schema).parquet(out).collect())

    return arrive


def test_ticks_close_as_time_goes_on_and_equal_the_report(spark, crawl):
    first = [("a", 0), ("b", 29.9), ("a", 35), ("c", 31), ("b", 32), (None, 45)]
    assert crawl(*first) == [(1, 2, 2, False, False)]
    # a heartbeat alone closes ticks: a stall shows without any fetch
    assert crawl((None, 131)) == [
        (1, 2, 2, False, False),
        (2, 1, 3, False, False),
        (3, 0, 3, True, True),
        (4, 0, 3, True, False),
    ]
    second = [("a", 135), ("d", 152), ("d", 140), (None, 165)]
    got = crawl(*second)
    log = spark.createDataFrame([(u, at(s)) for u, s in first + second if u], "url STRING, ts TIMESTAMP")
    assert got == sorted(tuple(r) for r in stall_ticks(log).collect())
    assert got[-1] == (5, 1, 4, False, False)


def test_odd_rows_have_defined_results(crawl):
    # before the start: tick 1; no time: nothing; the empty URL is a URL; nothing visited: no stall
    rows = [("early", -100), ("no-time", None), ("", 1), ("é" * 5000, 2), ("", 2), (None, 71)]
    assert crawl(*rows) == [(1, 3, 3, False, False), (2, 0, 3, True, True)]


def test_no_stall_before_anything_is_visited(crawl):
    assert crawl((None, 61), ("a", 80), (None, 101)) == [(1, 0, 0, False, False), (2, 0, 0, False, False), (3, 1, 1, False, False)]
