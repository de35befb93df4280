"""Quality classifier as a sparse rule ensemble (operator 8).

Method: boosted trees are grown on statistics of labelled texts; every path from
a root to a node is read off as a rule, a conjunction of comparisons; a logistic
model with a lasso penalty weighs the rules, which leaves most at zero; the rest
are compiled into one Spark column expression, so scoring is a projection
without Python, join or shuffle.

Inputs of a score are statistics of the whole text alone: never labels,
language, source or id. Fitting takes at most ``SAMPLE_ROWS`` labelled rows, the
first by a hash of the id, a documented bound; scoring covers every row.

Defined results: a null text counts as empty, and an empty text is scored like
any other; labels that are null or differ for one id are left out; with fewer
than two classes among the labels, or too few rows to split, the score is the
share of label 1 (0.5 without labels); repeated rows each give a row; extra columns are kept.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import materialize

SAMPLE_ROWS = 20_000
TREES = 20
DEPTH = 3
LASSO = 0.001
SEED = 8
THRESHOLD = 0.3

_SPACES = " \t\n\x0b\x0c\r\u00a0"


def statistics(text: Column) -> Column:
    """Statistics of a whole text (null: empty) as a struct of doubles, in the order of ``STATISTICS``.

    Shares are of characters unless named otherwise. The text's words and lines
    are bound once and then referred to.
    """
    whole = F.coalesce(text.cast("string"), F.lit(""))
    parts = F.struct(
        whole.alias("text"),
        F.split(F.btrim(F.lower(whole), F.lit(_SPACES)), f"[{_SPACES}]+").alias("words"),
        F.filter(F.split(whole, "\n"), lambda x: F.trim(x) != "").alias("lines"),
    )
    return F.get(F.transform(F.array(parts), _statistics), F.lit(0))


def _statistics(parts: Column) -> Column:
    text, words, lines = parts["text"], parts["words"], parts["lines"]
    chars = F.greatest(F.length(text), F.lit(1)).cast("double")
    # a blank text splits into one empty word
    counted = F.when(F.get(words, F.lit(0)) == "", 0).otherwise(F.size(words))
    n_words = F.greatest(counted, F.lit(1)).cast("double")
    n_lines = F.greatest(F.size(lines), F.lit(1)).cast("double")

    def count(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern))

    values = {
        "log_chars": F.log1p(F.length(text).cast("double")),
        "log_words": F.log1p(counted.cast("double")),
        "word_length": F.length(F.translate(text, " \t\r\n", "")) / n_words,
        "distinct_words": F.size(F.array_distinct(words)) / n_words,
        "capitals": count(r"\p{Lu}") / chars,
        "letters": F.length(F.regexp_replace(text, r"\P{L}+", "")) / chars,
        "digits": count(r"[0-9]") / chars,
        "marks": count(r"[.,;:?]") / chars,
        "shouts": count(r"!") / chars,
        "symbols": count(r"[#$%&*+/<=>@\[\]\\^_`{|}~]") / chars,
        "sentence_ends": count(r"[.!?](?:\s|$)") / n_words,
        "capital_starts": count(r"(?:^|\s)\p{Lu}") / n_words,
        "lines": F.log1p(n_lines),
        "words_a_line": n_words / n_lines,
        "distinct_lines": F.size(F.array_distinct(lines)) / n_lines,
        "open_lines": F.size(F.filter(lines, lambda x: ~F.rtrim(x).rlike(r"[.!?]$"))) / n_lines,
        "links": count(r"https?://|www\.") / n_words,
    }
    return F.struct(*[values[n].cast("double").alias(n) for n in STATISTICS])


# The names of the statistics, in the order of a feature vector.
STATISTICS = (
    "log_chars", "log_words", "word_length", "distinct_words", "capitals", "letters", "digits", "marks",
    "shouts", "symbols", "sentence_ends", "capital_starts", "lines", "words_a_line", "distinct_lines", "open_lines", "links",
)


@dataclass(frozen=True, order=True)
class Rule:
    """A conjunction: ``(statistic, above, bound)`` is ``x > bound`` or, if not above, ``x <= bound``."""

    terms: tuple[tuple[str, bool, float], ...]

    def column(self, stats: Column) -> Column:
        out = F.lit(True)
        for name, above, bound in self.terms:
            out = out & ((stats[name] > bound) if above else (stats[name] <= bound))
        return out

    def __str__(self) -> str:
        return " and ".join(f"{n} {'>' if a else '<='} {b:.6g}" for n, a, b in self.terms)


@dataclass(frozen=True)
class RuleModel:
    """Weighted rules and an intercept."""

    intercept: float
    weights: tuple[tuple[Rule, float], ...]

    def score(self, text: Column) -> Column:
        """The score as one column expression.

        The statistics are bound once, as a struct that the rules then refer to.
        """

        def logistic(s: Column) -> Column:
            total = F.lit(self.intercept)
            for rule, weight in self.weights:
                total = total + F.when(rule.column(s), weight).otherwise(0.0)
            return 1 / (1 + F.exp(-total))

        return F.get(F.transform(F.array(statistics(text)), logistic), F.lit(0))


def simplified(terms: list[tuple[str, bool, float]]) -> Rule:
    """One term for each statistic and direction, the tightest."""
    tight: dict[tuple[str, bool], float] = {}
    for name, above, bound in terms:
        key = (name, above)
        tight[key] = bound if key not in tight else max(tight[key], bound) if above else min(tight[key], bound)
    return Rule(tuple(sorted((n, a, b) for (n, a), b in tight.items())))


def tree_rules(model, names: tuple[str, ...]) -> list[Rule]:
    """Every path from a root to a node of the model's trees, once each."""
    rules: set[Rule] = set()

    def walk(node, terms: list) -> None:
        if terms:
            rules.add(simplified(terms))
        if node.numDescendants():
            split = node.split()
            name, bound = names[split.featureIndex()], float(split.threshold())
            walk(node.leftChild(), [*terms, (name, False, bound)])
            walk(node.rightChild(), [*terms, (name, True, bound)])

    for tree in model.trees:
        walk(tree._java_obj.rootNode(), [])
    return sorted(rules)


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text: str, label: str) -> DataFrame:
    """``(label, one column for each statistic)`` of at most ``SAMPLE_ROWS`` labelled rows, the first by a hash of the id."""
    one = (
        labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__id"))
        .agg(F.min(label).alias("label"), F.max(label).alias("__max")).where("label = __max")
    )
    picked = one.orderBy(F.xxhash64("__id"), "__id").limit(SAMPLE_ROWS).select("__id", F.col("label").cast("double"))
    # of a bounded number of rows, so small enough to send to all
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text).alias("__text"))
    found = rows.join(F.broadcast(picked), "__id").select("label", statistics(F.col("__text")).alias("s"))
    return materialize(found.select("label", "s.*"), "statistics")


def _constant(share: float) -> RuleModel:
    share = min(max(share, 1e-6), 1 - 1e-6)
    return RuleModel(math.log(share / (1 - share)), ())


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality") -> RuleModel:
    """Fit the ensemble on labelled rows; rows to hold out must be left out of ``labels``."""
    rows = training_rows(docs, labels, id_col, text, label)
    n, ones = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if ones in (0, n):
        return _constant(ones / n if n else 0.5)
    vectors = rows.select("label", array_to_vector(F.array(*STATISTICS)).alias("features"))
    trees = GBTClassifier(maxDepth=DEPTH, maxIter=TREES, stepSize=0.3, subsamplingRate=0.7, maxBins=64, minInstancesPerNode=5, seed=SEED).fit(vectors)
    rules = tree_rules(trees, STATISTICS)
    if not rules:  # too few rows for any split
        return _constant(ones / n)
    stats = F.struct(*STATISTICS)
    held = F.transform(F.array(stats), lambda s: F.array(*[r.column(s).cast("double") for r in rules]))
    fired = materialize(rows.select("label", F.get(held, F.lit(0)).alias("fired")), "rules")
    lasso = LogisticRegression(
        featuresCol="features", labelCol="label", elasticNetParam=1.0, regParam=LASSO, maxIter=60, standardization=False
    ).fit(fired.select("label", array_to_vector("fired").alias("features")))
    weights = tuple((r, float(w)) for r, w in zip(rules, lasso.coefficients) if w)
    return RuleModel(float(lasso.intercept), weights)


def held_out(id_col: str = "doc_id") -> Column:
    """True where crc32 of the id as text is divisible by 5 (a null id: as of the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit_on_kept_labels(docs: DataFrame, labels: DataFrame) -> RuleModel:
    """The registered query's and pipeline's model: quality labels outside the held-out fifth."""
    return fit(docs, labels.where(~held_out()))


def to_json(model: RuleModel) -> str:
    return json.dumps({"intercept": model.intercept, "rules": [[str(r), w] for r, w in model.weights]}, indent=1)
