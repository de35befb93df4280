import re

import regex
from helpers import SF, documents, odd_documents, table
from pyspark.sql import functions as F

from trawl.llm import license_scan as ls
from trawl.llm.queries import QUERIES

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORDS.findall(lower)


def brute_base(text):
    words = words_of(text)
    places = [
        (i, label)
        for phrase, label in BASE.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in places]
    labels = ",".join(sorted({x for _, x in places}))
    return len(words), len(places), min(starts, default=None), max(starts, default=None), labels


def test_base_columns_match_brute_force(spark):
    got = {r["doc_id"]: r for r in QUERIES["op1_license_scan"](spark, SF).collect()}
    docs = table(spark, "documents").collect()
    assert len(got) == len(docs)
    assert sum(r["n_base"] for r in got.values()) > 0
    for d in docs:
        r = got[d["doc_id"]]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_base(d["text"])
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) | {""}
        assert 0 <= r["score"] <= 1


def test_every_base_place_counts(spark):
    text = "Under the MIT License, under-the_mit/license. CC-BY-NC cc by nc cc by nc; Apache License, Version 2.0"
    assert brute_base(text)[1] == 6
    (row,) = ls.license_scan(documents(spark, [text])).collect()
    assert row["license_scan"][:5] == brute_base(text)


def test_edits_are_found_and_bounded(spark):
    texts = ["given under te mit licence now", "gnu genral public license", "under a quite different permit", "the apache licence, version 2"]
    got = [r["license_scan"] for r in ls.license_scan(documents(spark, texts)).orderBy("doc_id").collect()]
    assert [r["labels"] for r in got] == ["mit", "gpl", "", "apache-2"]
    assert [r["n_base"] for r in got] == [0, 0, 0, 0]
    place = got[0]["places"][0]
    assert texts[0][place["start"] : place["end"]] == "under te mit licence" and 0 < place["edits"] <= 2


def test_seeds_lose_no_place_that_the_whole_text_search_finds():
    """Pigeonhole: any best match anywhere in the text is also found from the seeds."""
    import random

    rng = random.Random(7)
    letters = "abcdefgilmnoprstuvy "
    for _ in range(300):
        n = rng.choice(ls.NOTICES)
        k = ls.edits_for(n.phrase)
        broken = list(n.phrase)
        for _ in range(rng.randint(0, k)):
            at = rng.randrange(1, len(broken) - 1)
            kind = rng.randrange(3)
            broken[at : at + (kind > 0)] = [] if kind == 2 else [rng.choice(letters.strip())]
        joined = " zz " + " ".join("".join(broken).split()) + " zz "
        whole = regex.search(rf"(?b)(?<= )(?:{regex.escape(n.phrase)}){{e<={k}}}(?= )", joined)
        if whole:
            found = [p for p in ls.find_places(joined) if ls.NOTICES[p[2]] == n]
            assert found and min(p[3] for p in found) == sum(whole.fuzzy_counts)


def test_odd_rows(spark):
    docs = odd_documents(spark).withColumn("score", F.lit(0))
    out = ls.license_scan(docs)
    assert out.columns == [*docs.columns, "license_scan"] and out.count() == docs.count()
    assert ls.license_scan(docs.limit(0)).count() == 0
    by_id = {r["doc_id"]: r["license_scan"] for r in out.collect()}
    for i in (2, 3, 4):
        assert by_id[i][:7] == (0, 0, None, None, "", "", 0.0)
    assert by_id[5]["n_words"] == 60_000


def test_very_many_places_take_linear_time():
    import time

    from trawl.llm import license_scan

    began = time.time()
    out = license_scan.scan_text("all rights reserved " * 50_000 + "under the mit license " * 20_000)
    assert time.time() - began < 60
    assert out[1] == 20_000 and len(out[7]) >= 70_000 and (out[2], out[3]) == (150_000, 150_000 + 4 * 19_999)
