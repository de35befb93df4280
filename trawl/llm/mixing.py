"""Mixing sources to target weights by hierarchical budgeting (operator 9).

Documents lie in a tree given by path columns (domain, language, source). The
token budget is propagated from the root: at each node it is shared among the
children by their weights, and no child gets more than its subtree can give
(its leaves' tokens times ``max_epochs``). What a child can't take is
redistributed among its siblings, by weight, and only what all siblings
together can't take reaches their parent's siblings: capacities are added up
from the leaves first, so a node's budget never exceeds its own capacity, and
each group of siblings is filled like connected vessels.

A leaf's budget is spent in seeded epochs: every epoch is a permutation of the
leaf's documents by ``md5(seed:epoch:id)``. Whole epochs are taken while the
budget lasts; of the next one the longest prefix that fits is taken.

Scale: token counts are made once and written without the texts. Shares are
window functions over the leaves, not the documents. The prefix of a leaf is
found in steps, so that a source with a third of all rows is no single group:
token sums of 256 slots of the permutation (pre-aggregated), then of 256 parts
of the one slot where the budget ends, then the documents of the last part. The
result per leaf, whole epochs and the last key taken, is joined to the
documents by path.

All shares are whole numbers: shares are rounded down and the tokens left over
go to the siblings with the largest remainders.

Defined results: null path values count as ``''``; a null text has no tokens; a
weight of 0 takes nothing; a document without tokens costs nothing and comes
with the prefix it lies in (a leaf without any takes all of it once); rows whose id ties are taken together or not at all; an empty table gives no rows; extra columns are kept.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trawl.llm.common import materialize

# Hexadecimal digits of the key that make a slot, step by step.
SLOT_DIGITS = (2, 4)
_WORD = r"[^\x20\x09-\x0D]+"
_BIG = "decimal(38,0)"


@dataclass(frozen=True)
class Mixture:
    """Target weights: for each level of the tree, whole numbers by name and a default."""

    levels: tuple[str, ...]
    weights: tuple[dict[str, int], ...]
    default: tuple[int, ...]
    max_epochs: int = 4
    # budget as a share of all tokens of the input, in thousandths
    budget_permille: int = 1000
    seed: int = 17
    names: tuple[str, ...] = field(init=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "names", tuple(f"__path{i}" for i in range(len(self.levels))))

    def weight(self, level: int, name: Column) -> Column:
        out = F.lit(self.default[level])
        for key, w in self.weights[level].items():
            out = F.when(name == key, w).otherwise(out)
        return out.cast(_BIG)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("bigint")


def _fill(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Share each parent's ``budget`` among its children by ``weight``, up to ``cap``.

    In order of ``cap / weight`` the children that get their whole cap come
    first: such a child's fair share of what is left is at least its cap. The
    others share the rest by weight.
    """
    order = [(F.col("cap").cast("double") / F.col("weight").cast("double")).asc(), F.col(name)]
    group = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    before = group.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    after = group.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    upto = group.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    zero = F.lit(0).cast(_BIG)
    active = children.where((F.col("weight") > 0) & (F.col("cap") > 0))
    marked = active.withColumns(
        {
            "__left": F.col("budget") - F.coalesce(F.sum("cap").over(before), zero).cast(_BIG),
            "__rest": F.sum("weight").over(after).cast(_BIG),
        }
    ).withColumn("__own", (F.col("__left") * F.col("weight") >= F.col("cap") * F.col("__rest")).cast("int"))
    full = marked.withColumn("__full", F.min("__own").over(upto))
    taken = F.sum(F.when(F.col("__full") == 1, F.col("cap")).otherwise(zero)).over(group).cast(_BIG)
    weights = F.sum(F.when(F.col("__full") == 0, F.col("weight")).otherwise(zero)).over(group).cast(_BIG)
    shared = full.withColumns({"__r": F.col("budget") - taken, "__w": weights})
    share = F.expr("CASE WHEN __full = 1 THEN CAST(cap AS BIGINT) ELSE (__r * weight) div __w END")
    over = F.expr(f"CASE WHEN __full = 1 THEN CAST(-1 AS {_BIG}) ELSE CAST((__r * weight) % __w AS {_BIG}) END")
    cut = shared.withColumns({"__share": share, "__over": over})
    spare = F.col("budget") - F.sum("__share").over(group)
    turn = F.row_number().over(group.orderBy(F.desc("__over"), F.col(name)))
    more = F.when((F.col("__full") == 0) & (turn <= spare), 1).otherwise(0)
    return cut.withColumn("budget", (F.col("__share") + more).cast(_BIG)).select(*children.columns)


def leaf_budgets(leaves: DataFrame, mix: Mixture) -> DataFrame:
    """``(path columns, tokens, budget)`` of every leaf from ``(path columns, tokens)``."""
    names, n = list(mix.names), len(mix.levels)
    usable = F.lit(1).cast("boolean")
    for i, c in enumerate(names):
        usable = usable & (mix.weight(i, F.col(c)) > 0)
    cap = F.when(usable, F.col("tokens") * mix.max_epochs).otherwise(0).cast(_BIG)
    caps = leaves.select(*names, "tokens", cap.alias("cap"))
    # one row: what the root may spend
    wanted = F.expr(f"CAST(sum(tokens) AS {_BIG}) * {mix.budget_permille} div 1000").cast(_BIG)
    total = caps.agg(F.least(wanted, F.sum("cap").cast(_BIG)).alias("budget"))
    budgets = None
    for i in range(n):
        level = caps.groupBy(*names[: i + 1]).agg(F.sum("cap").cast(_BIG).alias("cap"))
        level = level.withColumn("weight", mix.weight(i, F.col(names[i])))
        if budgets is None:
            level = level.withColumn("budget", F.coalesce(total.scalar(), F.lit(0).cast(_BIG)))
        else:
            level = level.join(budgets, names[:i])
        budgets = _fill(level, names[:i], names[i]).select(*names[: i + 1], "budget")
    return leaves.join(budgets, names, "left").select(
        *names, "tokens", F.coalesce(F.col("budget"), F.lit(0)).cast("bigint").alias("budget")
    )


def _key(seed: int, epoch: Column, id_col: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed).cast("string"), epoch.cast("string"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))


def _cuts(counted: DataFrame, budgets: DataFrame, mix: Mixture, id_col: str) -> DataFrame:
    """``(path columns, __whole, __last_key)``: whole epochs, and the last key of the prefix (null: none)."""
    names = list(mix.names)
    spent = budgets.withColumns(
        {
            "whole": F.expr("CASE WHEN tokens > 0 THEN budget div tokens ELSE 0 END"),
            "rest": F.expr("CASE WHEN tokens = 0 THEN 0 WHEN budget % tokens = 0 THEN -1 ELSE budget % tokens END"),
        }
    ).select(*names, "whole", "rest")
    keyed = counted.join(spent, names).withColumn("key", _key(mix.seed, F.col("whole"), id_col))
    rows = materialize(keyed.select(*names, "key", "n", "rest"), "epoch").withColumn("before", F.lit(0).cast("bigint"))
    found = []
    for digits in SLOT_DIGITS:
        slot = F.substring("key", 1, digits).alias("slot")
        slots = rows.groupBy(*names, slot, "rest", "before").agg(F.sum("n").alias("n"), F.max("key").alias("key"))
        running = Window.partitionBy(*names).orderBy("slot")
        slots = slots.withColumn("upto", F.col("before") + F.sum("n").over(running))
        found.append(slots.where("upto <= rest").select(*names, "key"))
        # the first slot that doesn't fit as a whole
        edge = slots.where("upto > rest AND upto - n <= rest").select(*names, "slot", (F.col("upto") - F.col("n")).alias("before"))
        rows = rows.drop("before").withColumn("slot", slot).join(edge, [*names, "slot"]).drop("slot")
    inside = rows.withColumn("upto", F.col("before") + F.sum("n").over(Window.partitionBy(*names).orderBy("key")))
    found.append(inside.where("upto <= rest").select(*names, "key"))
    last = reduce(DataFrame.union, found).groupBy(*names).agg(F.max("key").alias("__last_key"))
    return spent.join(last, names, "left").select(*names, F.col("whole").alias("__whole"), "__last_key")


def mix_sources(docs: DataFrame, mix: Mixture, id_col: str = "doc_id", text: str = "text", epoch: str = "epoch") -> DataFrame:
    """``docs`` as often as each one is taken, with the path's columns and one more, ``epoch`` (from 0).

    ``mix.levels`` are SQL expressions over the columns of ``docs``.
    """
    names = list(mix.names)
    path = {c: F.coalesce(F.expr(e).cast("string"), F.lit("")) for c, e in zip(names, mix.levels)}
    counted = materialize(
        docs.select(F.col(id_col), *[e.alias(c) for c, e in path.items()], word_count(F.col(text).cast("string")).alias("n")),
        "token-counts",
    )
    leaves = materialize(counted.groupBy(*names).agg(F.sum("n").cast("bigint").alias("tokens")), "leaves")
    cuts = materialize(_cuts(counted, leaf_budgets(leaves, mix), mix, id_col), "cuts")
    out = docs.columns
    placed = docs.withColumns(path).join(cuts, names)
    in_prefix = _key(mix.seed, F.col("__whole"), id_col) <= F.col("__last_key")
    copies = placed.withColumn("__taken", (F.col("__whole") + F.when(in_prefix, 1).otherwise(0)).cast("int")).where("__taken > 0")
    numbered = copies.withColumn("__epoch", F.explode(F.sequence(F.lit(0), F.col("__taken") - 1)))
    return numbered.select(*[F.col(c) for c in out if c != epoch], F.col("__epoch").alias(epoch))


def domain(source: str = "source") -> str:
    """A stand-in for a domain column: sources fall in one of four domains."""
    return f"concat('d', ascii(md5(coalesce({source}, ''))) % 4)"


# Production parameters of the registered query and of the pipeline.
CORPUS_MIX = Mixture(
    levels=(domain(), "lang", "source"),
    weights=({"d0": 4, "d1": 3, "d2": 2, "d3": 1}, {"en": 5, "de": 2, "fr": 2, "es": 1}, {}),
    default=(1, 1, 1),
)
