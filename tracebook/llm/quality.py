"""Quality scores by a sparse ensemble of rules over text statistics.

Trees are grown on statistics of labelled documents; every path of a tree is a rule, a
conjunction of thresholds. A logistic model with a lasso penalty weighs the rules, which leaves
few of them. The rules left are compiled into one column expression, so scoring is a projection:
no Python runs on the executors, and only statistics of the sample reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracebook.llm.labelled import chosen_rows
from tracebook.llm.native import let, space_words
from tracebook.llm.trees import Rule, forest, paths

STATISTICS = (
    "log_words", "word_length", "symbol_share", "pipe_rate", "bang_rate", "upper_share", "digit_share",
    "comma_rate", "stop_rate", "distinct_words", "same_as_before", "short_words", "line_words", "distinct_lines",
)


def statistics(text: Column) -> Column:
    """A struct of ``STATISTICS``, all doubles; texts without words have zeros."""

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))

    def of(words: Column, lines: Column) -> Column:
        n, chars = F.size(words), F.length(text)
        before = F.filter(words, lambda word, i: word.eqNullSafe(F.get(words, i - 1)))

        def one(character: str) -> Column:
            return F.length(text) - F.length(F.replace(text, F.lit(character), F.lit("")))

        def any_of(characters: str) -> Column:
            return F.regexp_count(text, F.lit(characters))

        values = [
            F.log1p(n.cast("double")),
            share(chars - any_of(r"[\x20\x09-\x0D]"), n),
            share(any_of(r"[#*$%&<>]"), chars),
            share(one("|"), n),
            share(one("!"), n),
            share(any_of(r"[A-Z]"), chars),
            share(any_of(r"[0-9]"), chars),
            share(one(","), n),
            share(one("."), n),
            share(F.size(F.array_distinct(words)), n),
            share(F.size(before), n),
            share(F.size(F.filter(words, lambda word: F.length(word) <= 3)), n),
            share(n, F.size(lines)),
            share(F.size(F.array_distinct(lines)), F.size(lines)),
        ]
        return F.struct(*[value.alias(name) for name, value in zip(STATISTICS, values, strict=True)])

    lines = F.filter(F.split(text, "\n"), lambda line: F.trim(line) != "")
    return let(space_words(text), lambda words: let(lines, lambda kept: of(words, kept)))


def with_statistics(docs: DataFrame, *kept: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *kept, statistics(text).alias("stat"))


@dataclass
class RuleModel:
    """Weighted rules; a rule is a conjunction of (statistic, is low side, threshold)."""

    rules: list[Rule]
    weights: list[float]
    intercept: float

    def column(self, stat: str = "stat") -> Column:
        """The score as an expression over a struct of statistics."""
        logit = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            holds = F.lit(True)
            for feature, low, threshold in rule:
                value = F.col(f"{stat}.{STATISTICS[feature]}")
                holds = holds & (value <= threshold if low else value > threshold)
            logit = logit + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-logit))

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.intercept + holds(self.rules, x) @ np.array(self.weights))))


def holds(rules: list[Rule], x: np.ndarray) -> np.ndarray:
    """Which rules hold, row by row."""
    found = np.ones((len(x), len(rules)))
    for at, rule in enumerate(rules):
        for feature, low, threshold in rule:
            found[:, at] *= (x[:, feature] <= threshold) == low
    return found


def lasso_logistic(
    a: np.ndarray, y: np.ndarray, w: np.ndarray, penalty: float, rounds: int = 1500
) -> tuple[np.ndarray, float]:
    """Weights and intercept by accelerated proximal gradient; the intercept is not penalised."""
    weights, intercept = np.zeros(a.shape[1]), 0.0
    ahead, ahead_0, speed = weights.copy(), intercept, 1.0
    curve = 0.25 * (float(np.linalg.norm(a * np.sqrt(w)[:, None], 2)) ** 2 + 1)
    for _ in range(rounds):
        slope = w * (1 / (1 + np.exp(-np.clip(a @ ahead + ahead_0, -30, 30))) - y)
        step = ahead - a.T @ slope / curve
        new = np.sign(step) * np.maximum(np.abs(step) - penalty / curve, 0)
        new_0 = ahead_0 - slope.sum() / curve
        next_speed = (1 + (1 + 4 * speed**2) ** 0.5) / 2
        ahead = new + (speed - 1) / next_speed * (new - weights)
        ahead_0 = new_0 + (speed - 1) / next_speed * (new_0 - intercept)
        weights, intercept, speed = new, new_0, next_speed
    return weights, intercept


def fit_rules(
    x: np.ndarray, y: np.ndarray, w: np.ndarray, trees: int = 40, depth: int = 3, penalty: float = 0.002
) -> RuleModel:
    """Rules of a forest, weighed by the lasso. Without both labels the model is a constant."""
    w = w / w.sum() if len(w) else w
    share = float((w * y).sum()) if len(w) else 0.5
    if not 0 < share < 1:
        return RuleModel([], [], 4.0 if share else -4.0)
    least = max(4.0, 0.003 * len(y))
    grown = forest(x, y, w * len(w), trees, depth, 5, seed=3, least=least)
    rules = sorted({rule for tree in grown for rule in paths(tree)})
    a = holds(rules, x)
    # rules that hold for the same rows are one rule: the shortest
    seen: dict[bytes, int] = {}
    for at in sorted(range(len(rules)), key=lambda k: (len(rules[k]), rules[k])):
        seen.setdefault(np.packbits(a[:, at] > 0).tobytes(), at)
    kept = sorted(seen.values())
    weights, intercept = lasso_logistic(a[:, kept], y, w, penalty)
    used = np.flatnonzero(np.abs(weights) > 1e-6)
    return RuleModel([rules[kept[at]] for at in used], [float(weights[at]) for at in used], float(intercept))


def fitted(docs: DataFrame, labels: DataFrame, usable: Column, per_class: int = 4000) -> RuleModel:
    """A model from the statistics of at most ``per_class`` labelled rows of each class.

    Rows of a class weigh as much as all its labelled rows, so scores are shares of label 1.
    """
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & usable).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label")
    )
    counts = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    # two times ``per_class`` rows at most
    chosen = chosen_rows(docs, labels, "quality", usable, per_class)
    rows = with_statistics(chosen, "label").select("doc_id", "label", "stat").collect()
    values = sorted((r.doc_id, r.label, *r.stat) for r in rows)
    y = np.array([v[1] for v in values], float)
    x = np.array([v[2:] for v in values], float).reshape(len(values), len(STATISTICS))
    weight = {c: counts.get(c, 0) / max(int((y == c).sum()), 1) for c in (0, 1)}
    return fit_rules(x, y, np.array([weight[int(c)] for c in y]))


def quality(
    docs: DataFrame, labels: DataFrame, held_out: Column, per_class: int = 4000, threshold: float = 0.3
) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs`` (doc_id, text).

    ``labels``: doc_id, quality; other columns of both are not read. Rows where ``held_out`` is
    true are never trained on. A null or empty text has zeros for statistics and is scored like
    any other; repeated rows get a row each; without labels of both kinds the score is one
    constant; an empty table gives an empty result.
    """
    model = fitted(docs, labels, ~held_out, per_class)
    return (
        with_statistics(docs)
        .withColumn("score", model.column())
        .select(
            "doc_id",
            held_out.alias("held_out"),
            "score",
            F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
        )
    )
