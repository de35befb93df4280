"""SimHash near-duplicates by pigeonhole blocks (operator 6).

Fingerprint: words are runs of characters other than space, tab, LF, VT, FF and
CR, after lower-casing A-Z; every run of ``shingle`` words, repeats included,
is hashed by XXH64 (seed 42); a bit is 1 if it is set in over half the hashes.

Links: with at most ``distance`` = 2 differing bits, a fingerprint cut into
four blocks of 16 bits agrees with its partner in two blocks at least, so every
linked pair shares one of six keys of two blocks each (32 bits). Distinct
fingerprints are joined on these keys and verified by Hamming distance; copies
with one fingerprint are one node.

A key shared by more than ``HOT_KEY`` distinct fingerprints isn't joined pair by
pair. Its fingerprints are cut to the finest: each one emits itself and its 64
one-bit neighbours, two fingerprints are at most 2 bits apart exactly if they
share such a probe, and each probe links its members to the least one. This
finds the same components from 65 rows a fingerprint, without all pairs.

Components come from star rounds over the links of distinct fingerprints.

Defined results: a null or blank text has fingerprint zero and links like any
other; a text of fewer words than ``shingle`` is one shingle; a null id never
becomes a component id unless its component has no other; repeated rows are
rows of one component; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trawl.llm.common import bits_apart, materialize, small_batches
from trawl.llm.components import components

SHINGLE = 3
SEED = 42
# Pigeonhole: 4 blocks of 16 bits, of which 2 agree if at most 2 bits differ.
DISTANCE = 2
BLOCK_BITS = 16
HOT_KEY = 64


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the 64-bit hashes have each bit set, bit 0 first.

    Bits are unpacked to bytes and added 255 rows at a time as eight 64-bit
    lanes of eight byte counters each, which can't overflow.
    """
    n = len(hashes)
    padded = np.zeros(-(-n // 255) * 255, dtype="<u8")
    padded[:n] = hashes
    total = np.zeros(64, dtype=np.int64)
    for at in range(0, len(padded), 255 * 256):
        part = padded[at : at + 255 * 256]
        bits = np.unpackbits(part.view(np.uint8), bitorder="little").view("<u8").reshape(-1, 255, 8)
        total += bits.sum(axis=1, dtype=np.uint64).view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return total


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit integer."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxh64_intdigest(joined, SEED)], dtype="<u8")
    else:
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        first = np.concatenate(([0], ends[:-shingle] + 1)).tolist()
        parts = [joined[a:b] for a, b in zip(first, ends[shingle - 1 :].tolist())]
        hashes = np.fromiter(map(xxh64_intdigest, parts, repeat(SEED)), dtype="<u8", count=len(parts))
    on = 2 * bit_counts(hashes) > len(hashes)
    return int(np.packbits(on, bitorder="little").view("<i8")[0])


def fingerprint_column(text: str = "text", shingle: int = SHINGLE) -> Column:
    @F.pandas_udf("bigint")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return prints(F.col(text).cast("string"))


def _block_keys(fp: Column) -> Column:
    """An array of the six ``(kind, key)`` of two blocks each."""
    width, keys = BLOCK_BITS, []
    for i in range(4):
        for j in range(i + 1, 4):
            mask = ((1 << width) - 1) << (i * width) | ((1 << width) - 1) << (j * width)
            signed = mask - (1 << 64) if mask >> 63 else mask
            keys.append(F.struct(F.lit(len(keys)).alias("kind"), fp.bitwiseAND(F.lit(signed)).alias("key")))
    return F.array(*keys)


def links(prints: DataFrame) -> DataFrame:
    """Links ``(u, v)`` that connect all distinct fingerprints ``fp`` at most 2 bits apart."""
    keyed = prints.select("fp", F.inline(_block_keys(F.col("fp"))))
    sizes = keyed.groupBy("kind", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = materialize(keyed.join(sizes, ["kind", "key"]), "blocks")

    few = shared.where(F.col("n") <= HOT_KEY)
    a = few.select("kind", "key", F.col("fp").alias("u"))
    b = few.select("kind", "key", F.col("fp").alias("v"))
    paired = a.join(b, ["kind", "key"]).where((F.col("u") < F.col("v")) & (bits_apart(F.col("u"), F.col("v")) <= DISTANCE))

    hot = shared.where(F.col("n") > HOT_KEY).select("fp").distinct()
    flips = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("fp").bitwiseXOR(_bit(i)))
    near = F.concat(F.array("fp"), flips)
    probes = hot.select("fp", F.explode(near).alias("probe"))
    least = probes.groupBy("probe").agg(F.min("fp").alias("u"), F.count("*").alias("n")).where("n > 1")
    starred = probes.join(least, "probe").where(
        (F.col("u") < F.col("fp")) & (bits_apart(F.col("u"), F.col("fp")) <= DISTANCE)
    )
    return paired.select("u", "v").unionByName(starred.select("u", F.col("fp").alias("v"))).distinct()


def _bit(i: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), i)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``(id_col, text_key, fp, root, component_id)`` for every row of ``docs``.

    ``text_key`` (XXH64 of the text) tells rows of one id apart; ``root`` is the
    least fingerprint of the component.
    """
    rows = materialize(
        small_batches(docs).select(
            F.col(id_col), F.xxhash64(F.col(text).cast("string")).alias("text_key"), fingerprint_column(text, shingle).alias("fp")
        ),
        "fingerprints",
    )
    classes = rows.groupBy("fp").agg(F.min(id_col).alias("least_id"))
    roots = components(links(rows.select("fp").distinct()))
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root")
    )
    ids = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_class = materialize(rooted.join(ids, "root").select("fp", "root", "component_id"), "classes")
    return rows.join(of_class, "fp").select(id_col, "text_key", "fp", "root", "component_id")


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row of each component, with all columns of ``docs``.

    The row kept has the component's least id (then the least text key); of
    repeated rows one stays.
    """
    found = near_duplicates(docs, id_col, text, shingle).withColumnRenamed(id_col, "__id")
    # the least (id, text key) of each component, null ids last
    order = F.struct(F.col("__id").isNull().alias("no_id"), F.col("__id").alias("id"), F.col("text_key").alias("key"))
    kept = (
        found.groupBy("root").agg(F.min(order).alias("__keep"))
        .select(F.col("__keep.id").alias("__id"), F.col("__keep.key").alias("__text_key"))
    )
    out = docs.columns
    keyed = docs.withColumns({"__doc": F.col(id_col), "__key": F.xxhash64(F.col(text).cast("string"))})
    same = keyed["__doc"].eqNullSafe(kept["__id"]) & (keyed["__key"] == kept["__text_key"])
    first = Window.partitionBy("__doc", "__key").orderBy(F.lit(0))
    return (
        keyed.join(kept, same, "left_semi")
        .withColumn("__row", F.row_number().over(first))
        .where("__row = 1")
        .select(*out)
    )
