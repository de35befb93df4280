"""Small inputs that every operator must bear: nulls, empty and long texts, ties, repeated rows, clashing names."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, texts, first=0):
    """A ``documents`` table of the given texts."""
    rows = [(first + i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def odd_documents(spark):
    """Nulls in every column, empty and blank texts, a long text, repeated rows and ids."""
    rows = [
        (1, "One plain text here.", "en", "a", 20),
        (1, "One plain text here.", "en", "a", 20),
        (1, "Another text under the same id.", "en", "a", 31),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (4, " \n\t\n ", "en", "b", 5),
        (None, "No id at all.", "en", "b", 13),
        (5, "word " * 60_000, "de", "b", 300_000),
        (6, "é" * 5_000 + "\n" + "x" * 5_000, "fr", "c", 10_001),
        (7, "<|endoftext|> İstanbul ﬁne text \U0001f600 don't 'S ₂ ½ µ", "en", "c", 40),
    ]
    return spark.createDataFrame(rows, DOCS)


def table(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")
