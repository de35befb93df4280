"""Benchmark: headline index and search queries at one scale factor.

Prints one JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query runs to completion (``noop`` write or collect); the JVM start and a
warm-up query are not timed.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


from trawl.operators import indexing as ix  # noqa: E402
from trawl.operators import search as se  # noqa: E402
from trawl.plans import fixtures as fx  # noqa: E402
from trawl.plans.catalog import QUERIES  # noqa: E402
from trawl.session import local_session, scratch_path  # noqa: E402
from trawl.sources import index_store as st  # noqa: E402
from trawl.sources.tables import benchmark_queries, text_documents, web_pages  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
BUCKETS = 16
# Registered queries also timed end to end (beside the headline ones).
EXTRA = (
    "search_ranked",
    "result_page",
    "term_dictionary",
    "resolve_links",
    "robots_filter",
    "crawl_reachable",
    "streaming_index",
    "stall_ticks",
)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=max(8, CPUS))
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t0, 3)

    # Warm-up (not timed): JVM start and JIT/codegen of the index and search paths, on a small slice.
    warm = scratch_path(spark, "bench-warm")
    st.write_index(ix.build_text_index(text_documents(spark, SF_DIR).limit(200)), warm, buckets=BUCKETS)
    st.write_index(ix.build_page_index(web_pages(spark, SF_DIR).limit(50)), scratch_path(spark, "bench-warm-pages"), buckets=BUCKETS)
    warm_index = st.open_index(spark, warm)
    se.search(warm_index, fx.search_queries(spark, SF_DIR).limit(5), k=10).collect()
    se.search_one(warm_index, "warm up query", page=1).collect()

    doc_path = scratch_path(spark, "bench-doc-index")
    page_path = scratch_path(spark, "bench-page-index")
    timed("index_documents", lambda: st.write_index(ix.build_text_index(text_documents(spark, SF_DIR)), doc_path, buckets=BUCKETS))
    timed("index_pages", lambda: st.write_index(ix.build_page_index(web_pages(spark, SF_DIR)), page_path, buckets=BUCKETS))

    index = st.open_index(spark, doc_path)
    first_query = benchmark_queries(spark, SF_DIR).orderBy("qid").select("q").first()[0]
    timed("search_one", lambda: se.search_one(index, first_query, page=1).collect())
    timed("batch_search_k10", lambda: se.search(index, fx.search_queries(spark, SF_DIR), k=10).collect())

    for name in EXTRA:
        timed(name, lambda name=name: run(QUERIES[name](spark, SF_DIR)))

    sf = re.search(r"sf([0-9.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf.group(1)) if sf else SF_DIR,
                "cpus": CPUS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
