"""A quality classifier of few rules.

Trees over text statistics propose rules: every path from a root is a conjunction of bounds. A logistic regression with an
L1 penalty keeps a few of them. The result is compiled into one column expression, so scoring a corpus is a plain scan.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliovane.llm.common import let, stored

#: Labelled rows that the fit reads, about; more are thinned by a hash of their id.
TRAINING_ROWS = 20_000

#: Scores from which a document counts as good.
THRESHOLD = 0.3

SEED = 17

FEATURES = [
    "log_words",
    "word_chars",
    "distinct_words",
    "capitals",
    "digits",
    "symbols",
    "exclamations",
    "line_words",
    "distinct_lines",
]


def statistics(text: Column) -> dict[str, Column]:
    """Numbers that describe a text, whatever its language; an empty or null text has zeros."""
    text = F.coalesce(text, F.lit(""))
    chars = F.greatest(F.length(text), F.lit(1))
    empty = F.trim(text) == ""
    words = F.split(F.lower(F.trim(text)), r"\s+")
    count = F.when(empty, 0).otherwise(F.size(words))
    some = F.greatest(count, F.lit(1))
    lines = F.split(text, "\n")

    def share(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)) / chars

    values = [
        F.log1p(count),
        F.length(text) / some,
        F.when(empty, 0).otherwise(F.size(F.array_distinct(words))) / some,
        share(r"\p{Lu}"),
        share(r"[0-9]"),
        share(r"[^\p{L}\p{N}\s.,;:'\"()!?-]"),
        share(r"[!?]"),
        count / F.size(lines),
        F.size(F.array_distinct(lines)) / F.size(lines),
    ]
    return dict(zip(FEATURES, values, strict=True))



@dataclass(frozen=True)
class Rule:
    """A conjunction of ``low < statistic <= high``."""

    bounds: tuple[tuple[str, float, float], ...]

    def column(self, of: Callable[[str], Column] = F.col) -> Column:
        """The rule over the statistics that ``of`` gives by their names."""
        infinite = float("inf")
        tests = [of(name) > low for name, low, _ in self.bounds if low > -infinite]
        tests += [of(name) <= high for name, _, high in self.bounds if high < infinite]
        return reduce(and_, tests)

    def __str__(self) -> str:
        return " and ".join(f"{low:.4g} < {name} <= {high:.4g}" for name, low, high in self.bounds)


@dataclass(frozen=True)
class RuleModel:
    """``intercept`` and weighted rules; the score is the logistic of their sum."""

    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self, of: Callable[[str], Column] = F.col) -> Column:
        """The score over the statistics that ``of`` gives, by default columns named like ``FEATURES``."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(rule.column(of), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def held_out(identifier: Column) -> Column:
    """Whether a row is kept out of training: CRC-32 of its id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(identifier.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, bound: int = TRAINING_ROWS) -> DataFrame:
    """Statistics and label of about ``bound`` labelled rows at most, none of them held out.

    The labels are thinned before the join by a hash of the id, so their number bounds what is broadcast.
    """
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.where(~held_out(F.col("doc_id"))).select(
        F.col("doc_id").alias("labelled"), F.col("quality").cast("double").alias("label")
    )
    total, range_ = known.count(), 1 << 30
    if total > bound:
        known = known.where(F.pmod(F.xxhash64("labelled"), F.lit(range_)) < range_ * bound // total)
    texts = docs.select(F.col("doc_id"), F.col("text"))
    rows = texts.join(F.broadcast(known), F.col("doc_id") == F.col("labelled"))
    rows = rows.select("label", *[c.alias(n) for n, c in statistics(F.col("text")).items()])
    return stored(rows, "quality-sample").coalesce(8)


def tree_rules(node, bounds: dict[str, tuple[float, float]] | None = None) -> Iterator[Rule]:
    """Every path from the root of a fitted tree, bounds on one statistic merged into one interval."""
    bounds = bounds or {}
    if bounds:
        yield Rule(tuple((name, *bounds[name]) for name in sorted(bounds)))
    if node.subtreeDepth() > 0:
        split = node.split()
        name, at = FEATURES[split.featureIndex()], split.threshold()
        low, high = bounds.get(name, (float("-inf"), float("inf")))
        yield from tree_rules(node.leftChild(), bounds | {name: (low, min(high, at))})
        yield from tree_rules(node.rightChild(), bounds | {name: (max(low, at), high)})


def fit_rules(
    sample: DataFrame, trees: int = 16, depth: int = 3, penalty: float = 0.002
) -> RuleModel:
    """Fit on columns ``label`` and ``FEATURES``. With one label only the score is that label, almost, and 0.5 without any."""
    counts = {row["label"]: row["count"] for row in sample.groupBy("label").count().collect()}
    if len(counts) < 2:
        return RuleModel({1.0: 20.0, 0.0: -20.0}.get(next(iter(counts), None), 0.0), ())
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample)
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, seed=SEED, minInstancesPerNode=5, featureSubsetStrategy="onethird"
    ).fit(vectors.select("label", "features"))
    found = {rule for tree in forest.trees for rule in tree_rules(tree._call_java("rootNode"))}
    rules = sorted(found, key=str)
    if not rules:
        return RuleModel(math.log(counts[1.0] / counts[0.0]), ())
    names = [f"rule_{k}" for k in range(len(rules))]
    hits = sample.select(
        "label", *[r.column().cast("double").alias(n) for n, r in zip(names, rules, strict=True)]
    )
    hits = VectorAssembler(inputCols=names, outputCol="hits").transform(hits).select("label", "hits")
    lasso = LogisticRegression(
        featuresCol="hits", elasticNetParam=1.0, regParam=penalty, maxIter=60, standardization=True
    ).fit(hits)
    weights = zip(rules, lasso.coefficients.toArray().tolist(), strict=True)
    return RuleModel(lasso.intercept, tuple((r, w) for r, w in weights if abs(w) > 1e-9))


def quality_scores(docs: DataFrame, model: RuleModel) -> DataFrame:
    """``docs`` with a column ``quality_score`` from 0 to 1; all other columns and all rows stay as they are.

    One expression computes the statistics once and all rules on them, so neither a filter on the score that moves below
    it nor columns of ``docs`` with the same names matter. Null and empty texts have a score like any other; repeated
    rows and an empty table need no care.
    """
    values = F.struct(*[column.alias(name) for name, column in statistics(F.col("text")).items()])
    return docs.withColumn("quality_score", let(values, lambda v: model.score(lambda name: v[name])))
