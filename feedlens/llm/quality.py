"""Operator 12, quality classifier: a sparse ensemble of rules over text statistics.

``statistics`` gives numbers of a whole text by built-in functions: shares of
letters, capitals, digits and symbols, repeats of words and lines, lengths. Trees of small
depth are grown on labelled rows; the path to every node but the root is a
rule, a conjunction of bounds on statistics. A logistic regression with lasso
penalty over the rules (0 or 1 each) keeps few of them. The rules left,
their weights and the intercept are compiled into one column expression, so scoring
is part of the plan and runs over statistics without any model object.

Fit sample (documented bound): about ``sample_rows`` rows of each label, by the
hashes of their ids; each label keeps its weight in the whole. Spark grows the trees over that
sample; what reaches the driver are the trees, whose size the parameters fix, and the distinct patterns of
rules that hold in rows of the sample, with their weights.

Defined cases: null text counts as empty, and has a score like any other; rows without an
id are scored and never learned from; labels other than 0 and 1, or null, are not learned
from; several labels of one id are learned from each; repeated rows are scored each; with one
label only the score is that label, with none (or an empty table of labels) 0.5;
an empty table gives an empty result; input columns beside ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SAMPLE_ROWS = 20_000
TREES = 24
DEPTH = 3
BINS = 64
LASSO = 5e-4
PASSES = 5000
TOLERANCE = 1e-6
SEED = 12
THRESHOLD = 0.7

STATISTICS = (
    "chars", "words", "word_length", "longest_word", "short_words", "letters", "capitals", "digits", "symbols",
    "distinct_words", "repeated_words", "ends", "distinct_lines", "line_words",
)


def statistics(documents: DataFrame) -> DataFrame:
    """``doc_id`` and the ``STATISTICS`` of every whole text of ``documents`` (doc_id, text), as doubles."""
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def count(pattern: str) -> Column:
        return F.regexp_count("text", F.lit(pattern)).cast("double")

    def share(part: Column | str, whole: str) -> Column:
        part = F.col(part) if isinstance(part, str) else part
        return part / F.greatest(F.col(whole), F.lit(1.0))

    # Counts first, each once a text; the shares are taken from them.
    rows = rows.select(
        "doc_id", F.length("text").cast("double").alias("chars"), F.filter(F.split("text", r"[ \t\n\x0B\f\r]+"), lambda w: w != "").alias("w"),
        F.filter(F.split("text", r"\n"), lambda x: F.trim(x) != "").alias("lines"),
        count(r"\p{L}").alias("n_letters"), count(r"\p{Lu}").alias("n_capitals"), count(r"\p{N}").alias("n_digits"),
        count(r"[^\p{L}\p{N}\s.,;:'\"()-]").alias("n_symbols"), count(r"[.!?]").alias("n_ends"),
        # A word that stands again right after itself.
        count(r"(?<!\S)(\S+)(?=\s+\1(?!\S))").alias("n_repeated"),
    )
    rows = rows.select(
        "doc_id", "chars", "n_letters", "n_capitals", "n_digits", "n_symbols", "n_ends", "n_repeated",
        F.size("w").cast("double").alias("words"), F.size(F.array_distinct("w")).cast("double").alias("n_distinct"),
        F.size(F.filter("w", lambda x: F.length(x) <= 3)).cast("double").alias("n_short"),
        F.aggregate("w", F.lit(0), lambda a, x: a + F.length(x)).cast("double").alias("visible"),
        F.coalesce(F.array_max(F.transform("w", F.length)), F.lit(0)).cast("double").alias("longest_word"),
        F.size("lines").cast("double").alias("n_lines"), F.size(F.array_distinct("lines")).cast("double").alias("n_distinct_lines"),
    )
    return rows.select(
        "doc_id", "chars", "words", share("visible", "words").alias("word_length"), "longest_word", share("n_short", "words").alias("short_words"),
        share("n_letters", "visible").alias("letters"), share("n_capitals", "n_letters").alias("capitals"), share("n_digits", "visible").alias("digits"),
        share("n_symbols", "visible").alias("symbols"), share("n_distinct", "words").alias("distinct_words"),
        share("n_repeated", "words").alias("repeated_words"), share("n_ends", "words").alias("ends"),
        share("n_distinct_lines", "n_lines").alias("distinct_lines"), share("words", "n_lines").alias("line_words"),
    )


@dataclass(frozen=True)
class Rule:
    """A conjunction: every statistic above its lower bound and at most its upper one."""

    bounds: tuple[tuple[str, float, float], ...]

    def column(self) -> Column:
        parts = []
        for name, low, high in self.bounds:
            parts += [F.col(name) > F.lit(low)] if low > float("-inf") else []
            parts += [F.col(name) <= F.lit(high)] if high < float("inf") else []
        return reduce(lambda a, b: a & b, parts)


@dataclass(frozen=True)
class Model:
    """Rules with their weights, and the intercept; ``constant`` where there was no rule to learn."""

    rules: tuple[tuple[Rule, float], ...] = ()
    intercept: float = 0.0
    constant: float | None = None

    def column(self) -> Column:
        """The score, from 0 to 1, as an expression over the statistics."""
        if self.constant is not None:
            return F.lit(float(self.constant))
        terms = [F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0)) for rule, weight in self.rules]
        while len(terms) > 1:  # sums of pairs, so that the expression stays flat
            terms = [terms[i] + terms[i + 1] if i + 1 < len(terms) else terms[i] for i in range(0, len(terms), 2)]
        margin = terms[0] + F.lit(self.intercept) if terms else F.lit(self.intercept)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def tree_rules(root, names: tuple[str, ...]) -> list[Rule]:
    """The path to every node below ``root`` (a node of a fitted tree) as a rule; of two siblings under the root one."""
    out, todo = [], [(root, {})]
    while todo:
        node, bounds = todo.pop()
        if bounds:
            out.append(Rule(tuple((name, *bounds[name]) for name in sorted(bounds))))
        if node.subtreeDepth() == 0:
            continue
        split = node.split()
        name, threshold = names[split.featureIndex()], float(split.threshold())
        low, high = bounds.get(name, (float("-inf"), float("inf")))
        todo.append((node.leftChild(), bounds | {name: (low, min(high, threshold))}))
        todo.append((node.rightChild(), bounds | {name: (max(low, threshold), high)}))
    # At the root "at most t" is "above t" with the sign of its weight turned.
    return [r for r in out if not (len(r.bounds) == 1 and r.bounds[0][1] == float("-inf"))]


def _sample(labelled: DataFrame, rows: int) -> tuple[DataFrame | None, dict[int, float]]:
    """Rows of both labels by hash, about ``rows`` of each, with ``weight``; and the share of each label.

    Rows that repeat an id, its statistics and its label are one row of more
    weight, and the hash is over all of these: an id of very many rows does not break the bound.
    """
    held = common.written(labelled.groupBy("doc_id", "label", *STATISTICS).agg(F.count(F.lit(1)).alias("n")), "quality-labelled")
    counts = {int(r["label"]): r for r in held.groupBy("label").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n")).collect()}  # two rows
    shares = {k: r["n"] / sum(x["n"] for x in counts.values()) for k, r in counts.items()}
    if len(counts) < 2:
        return None, shares
    part = {k: min(1.0, rows / r["rows"]) for k, r in counts.items()}
    of_label = F.when(F.col("label") == 1, F.lit(part[1])).otherwise(F.lit(part[0]))
    below = F.pmod(F.xxhash64("doc_id", *STATISTICS), F.lit(1 << 30)) < of_label * (1 << 30)
    return held.where(below).withColumn("weight", F.col("n") / of_label), shares


def lasso_logistic(x: np.ndarray, label: np.ndarray, weight: np.ndarray, lasso: float, passes: int = PASSES) -> tuple[np.ndarray, float]:
    """Weights and intercept with the least mean log loss plus ``lasso`` times the weights' absolute sum (accelerated proximal steps)."""
    weight = weight / weight.sum()
    x = np.column_stack([x, np.ones(len(x))])
    step = 4.0 / np.linalg.eigvalsh((x * weight[:, None]).T @ x)[-1]
    shrink = np.append(np.full(x.shape[1] - 1, step * lasso), 0.0)
    now = ahead = np.zeros(x.shape[1])
    pace = 1.0
    for _ in range(passes):
        slope = x.T @ (weight * (1.0 / (1.0 + np.exp(-np.clip(x @ ahead, -500, 500))) - label))
        then = ahead - step * slope
        then = np.sign(then) * np.maximum(np.abs(then) - shrink, 0.0)
        faster = (1.0 + np.sqrt(1.0 + 4.0 * pace * pace)) / 2.0
        ahead = then + (pace - 1.0) / faster * (then - now)
        done = np.abs(then - now).max() < TOLERANCE
        now, pace = then, faster
        if done:
            break
    return now[:-1], now[-1]


def fit(labelled: DataFrame, *, sample_rows: int = SAMPLE_ROWS, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO) -> Model:
    """The model of ``labelled``: rows of ``statistics`` with ``label`` (0 or 1; others are left out)."""
    rows, shares = _sample(labelled.where("doc_id is not null and label in (0, 1)").withColumn("label", F.col("label").cast("double")), sample_rows)
    if rows is None:
        return Model(constant=float(next(iter(shares), 0.5)))
    rows = common.written(rows.withColumn("stats", array_to_vector(F.array(*STATISTICS))), "quality-sample").cache()
    try:
        # Every tree sees all rows and some of the statistics at each node: no draw that depends on how rows are dealt.
        forest = RandomForestClassifier(featuresCol="stats", labelCol="label", weightCol="weight", numTrees=trees, maxDepth=depth, maxBins=BINS,
                                        bootstrap=False, featureSubsetStrategy="onethird", seed=SEED).fit(rows)
        rules = sorted({r for tree in forest.trees for r in tree_rules(tree._call_java("rootNode"), STATISTICS)}, key=lambda r: r.bounds)
        if not rules:
            return Model(constant=shares[1])
        # Rows in which the same rules hold are one row of the fit.
        pattern = F.concat(*[F.when(r.column(), F.lit("1")).otherwise(F.lit("0")) for r in rules])
        held = rows.groupBy(pattern.alias("pattern"), "label").agg(F.sum("weight").alias("weight")).toPandas()
    finally:
        rows.unpersist()
    held = held.sort_values(["pattern", "label"])
    fired = np.frombuffer("".join(held["pattern"]).encode(), np.uint8).reshape(len(held), len(rules)) == ord("1")
    weights, intercept = lasso_logistic(fired.astype(np.float64), held["label"].to_numpy(), held["weight"].to_numpy(), lasso)
    return Model(tuple((r, float(w)) for r, w in zip(rules, weights, strict=True) if w), float(intercept))
