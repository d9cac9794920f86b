"""Quality classifier: a sparse ensemble of rules.

Statistics of a text are Spark columns. A forest of shallow trees is grown on labelled
rows; every path from a root to a node below it is a rule, a conjunction of comparisons.
A logistic regression with an L1 penalty weighs the rules, most of them with zero. The
rules that remain are compiled into one column expression, so scoring needs no join, no
model object and no Python on the executors.

Defined results: null is as empty; statistics of an empty text are 0, and it is scored
like any other; with no labelled rows, or one class only, the score is the (smoothed)
share of ones. All labelled rows are learnt from, read once and kept as statistics.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardbook.llm.common import WORD, whole
from hazardbook.session import stage

TREES, DEPTH = 12, 3
PENALTY = 0.0005
SEED = 20240


def statistics(text: str) -> dict[str, Column]:
    """Statistics of the whole text by name."""
    body = whole(text)
    chars, words = F.length(body), F.regexp_count(body, F.lit(WORD))
    lines = F.split(body, "\n")
    per_char = lambda n: F.coalesce(n / F.nullif(chars, F.lit(0)), F.lit(0.0))
    per_word = lambda n: F.coalesce(n / F.nullif(words, F.lit(0)), F.lit(0.0))
    return {
        "log_chars": F.log1p(chars.cast("double")),
        "chars_per_word": per_word(chars.cast("double")),
        "capitals": per_char(F.regexp_count(body, F.lit(r"\p{Lu}"))),
        "digits": per_char(F.regexp_count(body, F.lit("[0-9]"))),
        "symbols": per_char(F.regexp_count(body, F.lit(r"[\p{S}#$%&*@/\\_|<>=+~^]"))),
        "exclamations": per_word(F.regexp_count(body, F.lit("!"))),
        "sentences": per_word(F.regexp_count(body, F.lit(r"[.?!](?=\s|$)"))),
        "new_words": per_word(F.size(F.array_distinct(F.split(body, r"[\x20\x09-\x0D]+")))),
        "new_lines": F.size(F.array_distinct(lines)) / F.size(lines),
    }


@dataclass(frozen=True)
class Rule:
    """Comparisons (statistic, at most, bound) that all hold, and the rule's weight."""

    terms: tuple[tuple[str, bool, float], ...]
    weight: float = 0.0

    def column(self, of: dict[str, Column]) -> Column:
        held = [of[s] <= bound if most else of[s] > bound for s, most, bound in self.terms]
        return reduce(lambda a, b: a & b, held)


@dataclass(frozen=True)
class Ensemble:
    rules: tuple[Rule, ...]
    intercept: float

    def score(self, of: dict[str, Column]) -> Column:
        sum_ = reduce(
            lambda total, r: total + F.when(r.column(of), r.weight).otherwise(0.0),
            self.rules, F.lit(self.intercept),
        )
        return 1 / (1 + F.exp(-sum_))


_TEST = re.compile(r"( *)(If|Else) \(feature (\d+) (<=|>) ([-+.\dEe]+)\)")


def paths(tree: str, names: list[str]) -> list[tuple[tuple[str, bool, float], ...]]:
    """Every path of a printed tree, as comparisons; a comparison implied by a later one
    of the path is left out."""
    stack: list[tuple[int, tuple[str, bool, float]]] = []
    found = []
    for indent, _, feature, sign, bound in _TEST.findall(tree):
        while stack and stack[-1][0] >= len(indent):
            stack.pop()
        stack.append((len(indent), (names[int(feature)], sign == "<=", float(bound))))
        kept = {(s, most): bound for _, (s, most, bound) in stack}
        found.append(tuple(sorted((s, most, bound) for (s, most), bound in kept.items())))
    return found


def learn(rows: DataFrame, label: str, names: list[str]) -> Ensemble:
    """An ensemble from rows with the statistics ``names`` and a 0/1 label."""
    ones, all_ = rows.agg(F.coalesce(F.sum(label), F.lit(0)), F.count(label)).first()
    if not 0 < ones < all_:
        share = (ones + 1) / (all_ + 2)
        return Ensemble((), _logit(share))
    assembled = VectorAssembler(inputCols=names, outputCol="features").transform(rows)
    labelled = assembled.select("features", F.col(label).cast("double").alias("label"))
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, minInstancesPerNode=20, featureSubsetStrategy="0.6", seed=SEED
    ).fit(labelled)
    rules = sorted({path for tree in forest.trees for path in paths(tree.toDebugString, names)})
    if not rules:
        return Ensemble((), _logit(ones / all_))
    of = {n: F.col(n) for n in names}
    held = [Rule(terms).column(of).cast("double").alias(f"r{i}") for i, terms in enumerate(rules)]
    table = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features").transform(
        rows.select(*held, F.col(label).cast("double").alias("label"))
    ).select("features", "label")
    fitted = LogisticRegression(elasticNetParam=1.0, regParam=PENALTY, maxIter=60).fit(table)
    weights = fitted.coefficients.toArray()
    return Ensemble(
        tuple(Rule(t, float(w)) for t, w in zip(rules, weights, strict=True) if w), float(fitted.intercept)
    )


def _logit(share: float) -> float:
    return math.log(share / (1 - share))


def scored(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, held_out: Column) -> DataFrame:
    """``doc_id``, ``held_out``, the statistics and the ``score`` of every row. Labels of
    rows that are held out are never read. An id with several labels is learnt with
    each."""
    of = statistics(text)
    told = stage(docs.select(F.col(doc_id).alias("doc_id"), held_out.alias("held_out"),
                             *[c.cast("double").alias(n) for n, c in of.items()]))
    known = labels.where(F.col(label).isNotNull()).select(
        F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label")
    )
    # A stable order of rows makes the forest's samples, and so the rules, repeatable.
    rows = stage(told.where("NOT held_out").join(known, "doc_id").repartitionByRange("doc_id").sortWithinPartitions(
        "doc_id", *of))
    ensemble = learn(rows, "label", list(of))
    return told.select("*", ensemble.score({n: F.col(n) for n in of}).alias("score"))
