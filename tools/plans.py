"""Write docs/PLANS.md: the physical plans of the key queries, with their scan details.

Usage: python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from trawl.operators import indexing as ix  # noqa: E402
from trawl.operators import search as se  # noqa: E402
from trawl.plans import fixtures as fx  # noqa: E402
from trawl.plans.catalog import QUERIES  # noqa: E402
from trawl.session import local_session, scratch_path  # noqa: E402
from trawl.sources import index_store as st  # noqa: E402
from trawl.sources.tables import text_documents  # noqa: E402


def formatted(spark, df) -> str:
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    tree = text.split("\n\n\n")[0]
    details = [
        line.strip()
        for line in text.splitlines()
        if line.strip().startswith(("PushedFilters", "PartitionFilters", "ReadSchema", "Bucketed", "Location"))
        and "[]" not in line.split(":", 1)[1][:3]
    ]
    return tree.strip() + "\n\n" + "\n".join(dict.fromkeys(details))


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    path = scratch_path(spark, "plans-index")
    st.write_index(ix.build_text_index(text_documents(spark, sf)), path, buckets=16)
    index = st.open_index(spark, path)
    sections = [
        ("Index build: documents and postings rows (no shuffle before the write)",
         ix.build_text_index(text_documents(spark, sf)).rows),
        ("One search on the written index (bucket pruning, term IN pushed down, broadcasts)",
         se.search_one(index, "the quick anat", page=1)),
        ("Batch search on the written index (checked broadcast, dynamic pruning, WindowGroupLimit)",
         se.search(index, fx.search_queries(spark, sf), k=10)),
        ("Robots filter (hash join on host with an rlike condition)", QUERIES["robots_filter"](spark, sf)),
        ("Paging facts (counts only, no ranking)", QUERIES["paging_facts"](spark, sf)),
    ]
    out = ["# Physical plans", "", f"Generated by `tools/plans.py` at `{sf}` on `local[8]`.", ""]
    for title, df in sections:
        out += [f"## {title}", "", "```", formatted(spark, df), "```", ""]
    target = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md")
    with open(target, "w") as fh:
        fh.write("\n".join(out))
    print("wrote", target)
    spark.stop()


if __name__ == "__main__":
    main()
