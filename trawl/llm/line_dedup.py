"""Line deduplication by an exact set-similarity join (operator 10), in DataFrame functions only.

A line (texts are cut at LF) is the set of its lower-cased words, runs of
characters other than space, tab, LF, VT, FF and CR. A line goes if any earlier
line of the corpus, by document id, then line number, has a Jaccard similarity
of at least 4/5 with it; it goes too if that earlier line goes itself.

Method (prefix filtering with positional and length filters):

1. Words become hashes, and their occurrences in the corpus are counted in
   ``2 ** COUNTER_BITS`` counters chosen by the hash. A counter is kept as one of
   64 levels, half a power of two each, which becomes the first six bits of the
   word's key: sorting a line's keys puts its rarest words first, in one order
   for the whole corpus.
2. Lines with equal key sets are one class, named by its first line (a
   pre-aggregated minimum); its other lines go.
3. Two sets of ``n`` and ``m`` keys at 4/5 or more share ``l`` of the first
   ``n - ceil(4n/5) + l`` keys of each, for any ``l`` up to their overlap; long
   lines use a larger ``l``, as they often share one rare word by chance.
   The smaller set needs only the first ``n - ceil(8n/9) + l`` of its keys, as the overlap is at least
   ``ceil(8n/9)`` of them. Classes of similar size meet on these prefix keys, and a meeting stays if their sizes (length
   filter), the positions of the shared key (positional filter) and the
   differing bits of their 128-bit parity summaries (each needs a word that only
   one line has) allow the similarity. A word whose counter says 1 is in no other
   line, so its key has a position and no posting. Pairs that meet ``l`` times
   are candidates.
4. Candidates are verified: the Jaccard similarity of the full sets.

A group of many near copies shares its prefix keys, so all its pairs would meet.
As a line needs one earlier match only, step 3 first looks at the closest of a
few predecessors of each class under its rarest keys among those that are much
more frequent than the mean counter, as the keys of a large group are; classes
matched there are settled. Only the others are joined, as the later line, with all classes, which
loses nothing and is small for copies. Postings are short rows keyed by words
that are rare, and skewed keys of the join are split by adaptive execution.

The full sets are needed only for candidates: their lines are read again from
the texts through a sieve of ``2 ** SIEVE_BITS`` bits, which lets all candidates
and few others pass, before anything is shuffled. Classes go through such
sieves before they are joined with settled, candidate or matched ones; what a
sieve lets pass by chance is joined exactly.

Hash width: two different words of one level are taken for one key only if 58
bits of their hashes are equal, two different sets for one class only if 128
bits are; candidates are verified by 64-bit hashes.

Defined results: blank lines, null and empty texts stay as they are; a document
that loses its last line with words goes from ``dedup_lines``; null ids come
first; under repeated ids, lines of one number are ordered by a hash of their
words, equal ones by that of their text; rows alike in id and text are decided
alike (neither is later); an empty table gives no rows; extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trawl.llm.common import materialize

COUNTER_BITS = 20
# The table of levels is put together from so many parts.
TABLE_PARTS = 1024
SIEVE_BITS = 22
# Predecessors looked at under so many of a class's rarest frequent keys.
LOOK_KEYS = 6
LOOK_BACK = 8
# A key is frequent from so many levels above the mean counter's on: two levels are twice as many occurrences.
FREQUENT = 6
# A line must share one prefix key more for each so many keys.
KEYS_PER_MEETING = 128

_WORDED = "[^\\x20\\x09-\\x0D]"
# Word separators other than space; LF cuts lines before.
_SEPARATORS = "\t\x0b\x0c\r"
_PLACE = ["__id", "__key", "line_no"]
# J >= 4/5 of sets of n and m keys that share o: o / (n + m - o) >= 4/5.
_ENOUGH = "9 * {o} >= 4 * ({n} + {m})"


def _documents(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    whole = F.col(text).cast("string")
    return docs.select(F.col(id_col).alias("__id"), F.xxhash64(whole).alias("__key"), whole.alias("__text"))


def _lines(docs: DataFrame) -> DataFrame:
    """``(place, line)`` of every line that has words: lower-cased, words set apart by spaces."""
    return _cut(docs, _spaced("__text")).where(F.trim("line") != "")


def _cut(docs: DataFrame, text: Column) -> DataFrame:
    return docs.select("__id", "__key", F.posexplode(F.split(text, "\n", -1)).alias("line_no", "line"))


def _spaced(text: str) -> Column:
    """Lower case, with a space for every separator but LF: a split at one character needs no regular expression.

    Most texts have no other separator; looking for each of the four is much cheaper than the expression.
    """
    found = reduce(Column.__or__, [F.contains(F.col(text), F.lit(c)) for c in _SEPARATORS])
    return F.when(found, F.regexp_replace(F.lower(text), f"[{_SEPARATORS}]", " ")).otherwise(F.lower(text))


def _words(line: Column) -> Column:
    return F.array_remove(F.split(line, " "), "")


def _hashes(line: Column) -> Column:
    return F.array_distinct(F.transform(_words(line), lambda w: F.xxhash64(w)))


def _counter(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - COUNTER_BITS).cast("int")


def _levels(docs: DataFrame) -> DataFrame:
    """One row ``levels``: a byte for every counter, 0 for a count of 1 at most, then two for each doubling, up to 63."""
    each = F.split(F.replace(_spaced("__text"), F.lit("\n"), F.lit(" ")), " ")
    words = docs.select(F.explode(each).alias("w")).where("w <> ''")
    counted = words.groupBy(_counter(F.xxhash64("w")).alias("c")).agg(F.count("*").alias("n"))
    level = F.when(F.col("n") > 1, F.least(F.floor(2 * F.log2("n")) + 1, F.lit(63))).otherwise(0).cast("byte")
    size = (1 << COUNTER_BITS) // TABLE_PARTS
    every = docs.sparkSession.range(1 << COUNTER_BITS).select(F.col("id").cast("int").alias("c"))
    parts = every.join(counted.select("c", level.alias("v")), "c", "left").groupBy(F.floor(F.col("c") / size).alias("p")).agg(
        F.array_sort(F.collect_list(F.struct("c", F.coalesce("v", F.lit(0).cast("byte")).alias("v"))))["v"].alias("v")
    )
    one = parts.agg(F.array_sort(F.collect_list(F.struct("p", "v"))).alias("x"))
    return one.select(F.flatten("x.v").alias("levels"))


def _keyed(lines: DataFrame, levels: DataFrame) -> DataFrame:
    """Lines with ``keys``: sorted, rarest first; a key is its word's level, then 58 bits of its hash."""

    def change(level: Column, counter: Column) -> Column:
        """What turns the first six bits of a hash, those of its counter too, into the level; keys are signed."""
        return F.shiftleft((level.cast("bigint") - 32).bitwiseXOR(F.shiftright(counter, COUNTER_BITS - 6).cast("bigint")), 58)

    # put together once for a counter, not once for a word, as lambdas are interpreted
    table = levels.select(F.transform("levels", change)).scalar()

    def key(h: Column) -> Column:
        # never null, so that the keys are sorted as plain longs
        return h.bitwiseXOR(F.coalesce(F.get(F.col("__levels"), _counter(h)), F.lit(0).cast("bigint")))

    keys = F.sort_array(F.transform(_hashes(F.col("line")), key))
    # the key from which on words are frequent: every level is at least one step of 58 bits
    total = F.aggregate("levels", F.lit(0).cast("bigint"), lambda t, v: t + v)
    frequent = F.least(F.floor(total / F.size("levels")) + FREQUENT, F.lit(63)).cast("bigint")
    least = levels.select(F.shiftleft(frequent - 32, 58)).scalar()
    return lines.withColumn("__levels", table).select(*_PLACE, keys.alias("keys"), least.alias("frequent"))


def _shared(n: str) -> str:
    """How many prefix keys a line of ``n`` keys and its partner must share."""
    return f"(1 + {n} div {KEYS_PER_MEETING})"


def _prefix_size() -> Column:
    """``n - ceil(4n/5) + l`` in whole numbers, at most ``n``."""
    return F.expr(f"CAST(least(n, n - (4 * n + 4) div 5 + {_shared('n')}) AS INT)")


def _smaller_prefix_size() -> Column:
    """The same for the smaller set of a pair: the overlap is at least ``ceil(8n/9)``, as the other has no fewer keys."""
    return F.expr(f"CAST(least(n, n - (8 * n + 8) div 9 + {_shared('n')}) AS INT)")


def _parity(places: Callable[[Column], Column]) -> Column:
    """Parity, in 64 places, of the keys: each flips its place if ``places`` of it is 1."""

    def flip(p: Column, k: Column) -> Column:
        return p.bitwiseXOR(F.call_function("shiftleft", places(k), k.bitwiseAND(F.lit(63).cast("bigint")).cast("int")))

    return F.aggregate("keys", F.lit(0).cast("bigint"), flip)


def _classes(keyed: DataFrame) -> DataFrame:
    """One row for each distinct set: its first line's place, size, short prefix keys and summary (``p0``, ``p1``).

    Prefix keys are cut to 32 bits here, which can only add candidates; words
    found once in the corpus are nulls, the first ``rare`` are not frequent.
    ``p0`` is of the keys whose bit 6 is 0, ``p1`` of the others. ``cid`` is in
    the order of the places.
    """
    once = F.lit(-31 * (1 << 58)).cast("bigint")  # keys of level 0 are below
    one = F.lit(1).cast("bigint")
    summed = keyed.withColumns({"n": F.size("keys"), "all": _parity(lambda k: one), "p1": _parity(lambda k: F.shiftright(k, 6).bitwiseAND(one))})
    first_keys = F.slice("keys", 1, _prefix_size())
    sets = summed.select(
        F.xxhash64("keys").alias("s1"),
        F.xxhash64(F.lit(1), F.col("keys")).alias("s2"),
        F.struct("__id", "line_no", "__key").alias("place"),
        "n",
        F.transform(first_keys, lambda k: F.when(k >= once, F.hash(k))).alias("prefix"),
        F.size(F.filter(first_keys, lambda k: k < F.col("frequent"))).alias("rare"),
        F.col("all").bitwiseXOR(F.col("p1")).alias("p0"),
        "p1",
    )
    own = ("n", "prefix", "rare", "p0", "p1")
    same = [F.any_value(c).alias(c) for c in own]
    first = sets.groupBy("s1", "s2").agg(F.min("place").alias("place"), *same).select("place.*", *own)
    # places are tied only under repeated ids
    ordered = first.orderBy("__id", "line_no", "p0", "p1")
    return ordered.select(F.monotonically_increasing_id().alias("cid"), "*")


def _postings(classes: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """Prefix keys of the classes that can have a partner: of different sets, one of 4 and one of 5 keys are the first."""
    every = classes.where("n >= 4").select(F.posexplode("prefix").alias("pos", "key"), "cid", "n", "p0", "p1", *more)
    return every.where("key IS NOT NULL")


def _apart(a: str, b: str) -> str:
    return f"(bit_count({a}p0 ^ {b}p0) + bit_count({a}p1 ^ {b}p1))"


def _possible(a: str, b: str) -> Column:
    """The filters on a pair that shares a prefix key, from both postings; what most pairs fail comes first."""
    n, m = f"{a}n", f"{b}n"
    size = f"5 * least({n}, {m}) >= 4 * greatest({n}, {m})"
    # up to l - 1 shared keys come before the l-th; those still to come bound the rest of the overlap
    earlier = f"least({_shared(n)}, {_shared(m)}) - 1"
    place = _ENOUGH.format(o=f"({earlier} + least({n} - {a}pos, {m} - {b}pos))", n=n, m=m)
    # each differing bit needs a word of one line only: at most n + m - 2 o of them, with o the least overlap allowed
    need = f"((4 * ({n} + {m}) + 8) div 9)"
    # different sets of one size share all but one key at most
    differ = f"({n} <> {m} OR {need} < {n})"
    return F.expr(f"{_apart(a, b)} <= {n} + {m} - 2 * {need} AND {size} AND {differ} AND {place}")


def _near_predecessors(classes: DataFrame) -> DataFrame:
    """Candidate pairs ``(a, b)``: for each class ``b`` the closest of the last few before it under its rarest frequent keys."""
    posting = _postings(classes.where("size(prefix) > rare"), ["rare"]).where(f"pos BETWEEN rare AND rare + {LOOK_KEYS - 1}")
    order = Window.partitionBy("key").orderBy("cid")
    fields = ("cid", "n", "pos", "p0", "p1")
    before = posting.withColumn("before", F.array(*[F.lag(F.struct(*fields), i).over(order) for i in range(1, LOOK_BACK + 1)]))
    looked = before.select(*fields, F.explode("before").alias("p")).where("p.cid <> cid")
    flat = looked.select(*fields, *[F.col(f"p.{c}").alias(f"p_{c}") for c in fields])
    apart = F.expr(_apart("", "p_"))
    return flat.where(_possible("", "p_")).groupBy(F.col("cid").alias("b")).agg(F.min_by("p_cid", apart).alias("a"))


def _joined_pairs(classes: DataFrame, settled: DataFrame) -> DataFrame:
    """Candidate pairs ``(a, b)``, ``a`` the earlier, of all classes with each unsettled one.

    Each pair meets on the short prefix of its smaller class (of two alike in
    size, the earlier) and the full prefix of the larger one. Classes meet
    within bands of sizes (by the bits of ``n``), so that a long line's prefix
    doesn't meet short ones; a class that may have a larger partner in the next
    band is there too, as a visitor, with its short prefix. Both sides of the
    join read one shuffle of postings, each a row of five longs: ``meet`` is the
    key and its band, ``who`` the class with three flags (in the short prefix,
    visitor, settled) and ``size`` its ``n`` and the key's position.
    """
    some = settled.select(F.col("b").alias("cid"), F.lit(1).cast("bigint").alias("settled"))
    perhaps, others = _sifted(classes.where("n >= 4").select("cid", "n", "prefix", "p0", "p1"), some, "settled-sieve", "cid")
    # a table, so that both sides of the join have the same plan whatever size it is
    looked = materialize(perhaps.join(some, "cid", "left"), "settled-classes")
    marked = looked.unionByName(others.withColumn("settled", F.lit(None).cast("bigint")))
    n = F.col("n").cast("bigint")
    bits = F.length(F.bin("n"))
    who = 8 * F.col("cid") + F.coalesce("settled", F.lit(0).cast("bigint"))
    short = _smaller_prefix_size()
    home = F.struct(bits.alias("band"), who.alias("who"), F.col("prefix"))
    visit = F.struct((bits + 1).alias("band"), (who + 2).alias("who"), F.slice("prefix", 1, short).alias("prefix"))
    near_next = 5 * n >= 4 * F.call_function("shiftleft", F.lit(1).cast("bigint"), bits)
    places = F.when(near_next, F.array(home, visit)).otherwise(F.array(home))
    placed = marked.select("cid", "n", "p0", "p1", F.inline(places))
    posting = _postings(placed, ["band", "who"]).select(
        (F.shiftleft(F.col("key").cast("bigint"), 6) + F.col("band")).alias("meet"),
        (F.col("who") + F.when(F.col("pos") < short, 4).otherwise(0)).alias("who"),
        (F.shiftleft(n, 32) + F.col("pos")).alias("size"),
        "p0",
        "p1",
    )

    def side(name: str) -> DataFrame:
        return posting.select("meet", *[F.col(c).alias(f"{name}_{c}") for c in ("who", "size", "p0", "p1")])

    # s is the smaller class. That its key is in the short prefix and t is no visitor is one condition on both, as one on
    # either alone would be filtered before the shuffle they share; a class doesn't meet itself, where two of its keys are
    # cut to one; the later of both is unsettled
    s_n, t_n, s, t = "(s_size >> 32)", "(t_size >> 32)", "(s_who >> 3)", "(t_who >> 3)"
    order = f"(s_who & 4) - (t_who & 2) = 4 AND ({s_n} < {t_n} OR {s_n} = {t_n} AND {s} < {t}) AND if({s} < {t}, t_who, s_who) & 1 = 0"
    parts = {f"{x}_{c}": e for x in "st" for c, e in (("n", f"({x}_size >> 32)"), ("pos", f"({x}_size & 4294967295)"))}
    met = side("s").hint("merge").join(side("t"), "meet").where(order).withColumns({c: F.expr(e) for c, e in parts.items()}).where(_possible("s_", "t_"))
    times = F.expr(f"least({_shared('s_n')}, {_shared('t_n')})").alias("l")
    pairs = met.select(F.expr(f"least({s}, {t})").alias("a"), F.expr(f"greatest({s}, {t})").alias("b"), times)
    return pairs.groupBy("a", "b", "l").agg(F.count("*").alias("c")).where("c >= l").select("a", "b")


def _sieve(rows: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row ``words``: ``2 ** SIEVE_BITS`` bits, set where a hash of ``cols`` points."""
    n_words = 1 << (SIEVE_BITS - 6)
    h = F.xxhash64(*cols)
    some = rows.groupBy(F.pmod(h, F.lit(n_words)).cast("int").alias("w")).agg(F.bit_or(_bit_of(h)).alias("bits"))
    every = rows.sparkSession.range(n_words).select(F.col("id").cast("int").alias("w"))
    one = every.join(some, "w", "left").agg(
        F.array_sort(F.collect_list(F.struct("w", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits")))).alias("x")
    )
    return one.select(F.transform("x", lambda x: x["bits"]).alias("words"))


def _sifted(df: DataFrame, rows: DataFrame, name: str, *cols: str) -> tuple[DataFrame, DataFrame]:
    """``df`` in two, without a shuffle: what may have ``cols`` alike with a row of ``rows``, and what surely has not."""
    sieve = materialize(_sieve(rows, cols), name)
    h = F.xxhash64(*cols)
    word = F.get(F.col("__words"), F.pmod(h, F.lit(1 << (SIEVE_BITS - 6))).cast("int"))
    hit = word.bitwiseAND(_bit_of(h)) != 0
    with_words = df.withColumn("__words", sieve.scalar())
    return with_words.where(hit).drop("__words"), with_words.where(~hit).drop("__words")


def _bit_of(h: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(h, 58).cast("int"))


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """``b`` of the pairs whose full sets have a Jaccard similarity of 4/5 or more; only their lines are lower-cased again."""
    needed = pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "cid")
    perhaps, _ = _sifted(classes.select("cid", *_PLACE), needed, "candidate-sieve", "cid")
    places = materialize(perhaps.join(needed, "cid"), "candidate-lines")
    passed, _ = _sifted(_cut(docs, F.col("__text")), places, "line-sieve", *_PLACE)
    here = passed.alias("l").join(
        places.alias("p"),
        F.col("l.__id").eqNullSafe(F.col("p.__id")) & (F.col("l.__key") == F.col("p.__key")) & (F.col("l.line_no") == F.col("p.line_no")),
    )
    # rows alike in id and text give the same line more than once
    found = here.groupBy("cid").agg(F.any_value("line").alias("line")).select("cid", _spaced("line").alias("line"))
    # hashed once for a class, not once for a pair
    sets = materialize(found.select("cid", _hashes(F.col("line")).alias("words")), "candidate-sets")
    a = sets.select(F.col("cid").alias("a"), F.col("words").alias("x"))
    b = sets.select(F.col("cid").alias("b"), F.col("words").alias("y"))
    both = pairs.join(a, "a").join(b, "b")
    sized = both.select("b", F.size(F.array_intersect("x", "y")).alias("o"), F.size("x").alias("n"), F.size("y").alias("m"))
    return sized.where(_ENOUGH.format(o="o", n="n", m="m")).select("b").distinct()


def kept_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(__id, __key, kept)``: for every document with words left, the numbers of the lines with words that stay."""
    own = _documents(docs, id_col, text)
    levels = materialize(_levels(own), "levels")
    classes = materialize(_classes(_keyed(_lines(own), levels)), "classes")
    near = materialize(_near_predecessors(classes), "near-pairs")
    settled = materialize(_verified(near, classes, own), "settled")
    pairs = materialize(_joined_pairs(classes, settled), "pairs")
    matched = _verified(pairs, classes, own)
    gone = materialize(settled.union(matched).distinct(), "gone")
    perhaps, others = _sifted(classes.select("cid", *_PLACE), gone.select(F.col("b").alias("cid")), "gone-sieve", "cid")
    left = others.union(perhaps.join(gone, perhaps["cid"] == gone["b"], "left_anti"))
    return left.groupBy("__id", "__key").agg(F.sort_array(F.collect_list("line_no")).alias("kept"))


def line_report(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id_col, n_lines, n_removed, removed_lines)`` for every row of ``docs``; line numbers from 0, comma-joined."""
    kept = kept_lines(docs, id_col, text)
    each = F.split(F.coalesce("__text", F.lit("")), "\n", -1)
    # texts are split once: an entry for every line, null for blank ones
    numbered = F.transform(each, lambda line, i: F.when(line.rlike(_WORDED), i))
    rows = _documents(docs, id_col, text).select("__id", "__key", numbered.alias("numbered"))
    same = F.col("d.__id").eqNullSafe(F.col("k.__id")) & (F.col("d.__key") == F.col("k.__key"))
    found = rows.alias("d").join(kept.alias("k"), same, "left")
    removed = F.array_except(F.array_compact("numbered"), F.coalesce("kept", F.array().cast("array<int>")))
    return found.select(
        F.col("d.__id").alias(id_col),
        F.size("numbered").cast("bigint").alias("n_lines"),
        F.size(removed).cast("bigint").alias("n_removed"),
        F.array_join(removed.cast("array<string>"), ",").alias("removed_lines"),
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``docs`` without the lines that go; documents that lose all their lines with words go too.

    A column ``length``, if there is one, is set to the new text's length.
    """
    kept = kept_lines(docs, id_col, text).withColumnsRenamed({"__id": "__kept_id", "__key": "__kept_key", "kept": "__kept"})
    whole = F.col(text).cast("string")
    keyed = docs.withColumns({"__doc": F.col(id_col), "__text_key": F.xxhash64(whole)})
    same = F.col("__doc").eqNullSafe(F.col("__kept_id")) & (F.col("__text_key") == F.col("__kept_key"))
    worded = F.coalesce(whole.rlike(_WORDED), F.lit(False))
    found = keyed.join(kept, same, "left").where(F.col("__kept").isNotNull() | ~worded)
    stays = F.filter(
        F.transform(
            F.split(whole, "\n", -1),
            lambda line, i: F.when(~line.rlike(_WORDED) | F.array_contains(F.col("__kept"), i), line),
        ),
        lambda line: line.isNotNull(),
    )
    out = found.withColumn("__new", F.when(F.col("__kept").isNull(), whole).otherwise(F.array_join(stays, "\n")))
    renewed = {text: F.col("__new")}
    if length and length in docs.columns:
        renewed[length] = F.length("__new").cast(docs.schema[length].dataType)
    return out.select(*[renewed.get(c, F.col(c)).alias(c) for c in docs.columns])
