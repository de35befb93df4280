"""Property tests: the Column functions against plain-Python statements of the same rules."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trawl.functions.text import TRIM_CHARS, clean_word, tokenize

# Go's unicode.IsSpace: the Latin-1 spaces plus the Unicode White_Space property.
SPACES = "\t\n\x0b\x0c\r \x85\xa0                　"
ALPHABET = "abcXYZ.,!?:;'é-ü" + SPACES


def py_tokens(text: str) -> list[str]:
    out, cur = [], []
    for ch in text.lower():
        if ch in SPACES:
            if cur:
                out.append("".join(cur))
                cur = []
        else:
            cur.append(ch)
    if cur:
        out.append("".join(cur))
    return out


def py_clean(tok: str) -> str:
    return tok.strip(TRIM_CHARS).lower()


@settings(max_examples=5, deadline=None)
@given(st.integers(min_value=0, max_value=2**31))
def test_tokenize_and_clean_match_python(spark, seed):
    rnd = random.Random(seed)
    texts = ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randrange(0, 40))) for _ in range(200)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING")
    got = df.select("i", tokenize(F.col("t")).alias("toks"), F.transform(tokenize(F.col("t")), clean_word).alias("clean"))
    for r in got.collect():
        want = py_tokens(texts[r.i])
        assert r.toks == want, texts[r.i]
        assert r.clean == [py_clean(w) for w in want]
