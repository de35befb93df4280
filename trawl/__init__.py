"""trawl: web-text indexing and ranked search as Spark DataFrame jobs."""

from trawl.operators.indexing import Index, build_index, build_page_index, build_text_index
from trawl.operators.search import search, search_one, search_ranked, search_scores

__all__ = [
    "Index",
    "build_index",
    "build_page_index",
    "build_text_index",
    "search",
    "search_one",
    "search_ranked",
    "search_scores",
]
