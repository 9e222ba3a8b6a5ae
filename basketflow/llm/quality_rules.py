"""Quality rules: a decision list learned from labelled statistics, applied as Spark expressions.

Sequential covering: a rule is a conjunction of thresholds. It is grown on one part of the labelled
rows by the condition with the best information gain, then pruned on the other part, its last
conditions going as long as that does not hurt. If it is right often enough there, it joins the list
and the rows that it covers leave; else the list ends. The list becomes a chain of ``when``s, so it
reads as text and runs inside Spark's generated code.
"""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.llm.shared import map_text
from basketflow.llm.text_stats import COUNTS, MORE, text_stats

FEWEST_WORDS = 50
MOST_REPEATED = 50  # percent of the words
ROWS = 20_000
# A rule must be right about this share of the rows that it covers, and cover at least so many.
PRECISION = 0.9
SUPPORT = 8
MOST_RULES = 12
_CUTS = 40

# Ratios that rules may test: name, dividend, divisor.
RATIOS = (
    ("symbols_per_word", "n_symbols", "n_words"),
    ("repeated", "n_repeat_words", "n_words"),
    ("duplicate_lines", "n_dup_lines", "n_lines"),
    ("word_length", "word_chars", "n_words"),
    ("distinct", "n_distinct", "n_words"),
    ("upper", "n_upper", "word_chars"),
    ("digits", "n_digits", "word_chars"),
    ("stops", "n_stops", "n_words"),
    ("odd_words", "n_odd_words", "n_words"),
)
FEATURES = tuple(name for name, _, _ in RATIOS)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        values = table[self.feature]
        return values > self.threshold if self.above else values <= self.threshold

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > self.threshold if self.above else value <= self.threshold


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]

    def covers(self, table: dict[str, np.ndarray]) -> np.ndarray:
        covered = np.ones(len(table[FEATURES[0]]), bool)
        for condition in self.conditions:
            covered &= condition.holds(table)
        return covered

    def __str__(self) -> str:
        tests = [f"{c.feature} {'>' if c.above else '<='} {c.threshold:.6g}" for c in self.conditions]
        return " and ".join(tests)


def with_statistics(docs: DataFrame, drop_text: bool = False) -> DataFrame:
    """Adds the counts of text_stats and the ratios; a ratio with divisor 0 is 0."""
    counted = map_text(docs, text_stats, {name: "long" for name in COUNTS + MORE}, drop_text=drop_text)
    ratios = {
        name: F.col(top) / F.greatest(F.col(bottom), F.lit(1)) for name, top, bottom in RATIOS
    }
    return counted.withColumns(ratios)


def base_failed() -> Column:
    few = F.col("n_words") < FEWEST_WORDS
    return few | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def _gain(covered: np.ndarray, bad: np.ndarray, before: np.ndarray) -> float:
    """Information gain of a refinement: the bad rows it keeps, times how much purer they are."""
    p, p0 = (covered & bad).sum(), (before & bad).sum()
    if p == 0 or p0 == 0:
        return 0.0
    return float(p * (np.log2(p / covered.sum()) - np.log2(p0 / before.sum())))


def _grow(table: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    conditions: list[Condition] = []
    covered = np.ones(len(bad), bool)
    while (covered & ~bad).any() and len(conditions) < 4:
        best, gain, kept = None, 1e-9, covered
        for feature in FEATURES:
            values = table[feature][covered]
            steps = np.unique(np.quantile(values, np.linspace(0, 1, _CUTS), method="lower"))
            # Half-way between neighbouring values, so that a rule keeps its distance from both.
            for cut in ((steps[1:] + steps[:-1]) / 2).tolist():
                for above in (True, False):
                    condition = Condition(feature, above, cut)
                    refined = covered & condition.holds(table)
                    if refined.any() and (value := _gain(refined, bad, covered)) > gain:
                        best, gain, kept = condition, value, refined
        if best is None:
            break
        conditions.append(best)
        covered = kept
    return Rule(tuple(conditions))


def _worth(rule: Rule, table: dict[str, np.ndarray], bad: np.ndarray) -> float:
    covered = rule.covers(table)
    wrong = (covered & ~bad).sum()
    right = (covered & bad).sum()
    return (right - wrong) / max(right + wrong, 1)


def _prune(rule: Rule, table: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    best, worth = rule, _worth(rule, table, bad)
    for size in range(len(rule.conditions) - 1, 0, -1):
        shorter = Rule(rule.conditions[:size])
        if (value := _worth(shorter, table, bad)) >= worth:
            best, worth = shorter, value
    return best


def learn(
    table: dict[str, np.ndarray],
    bad: np.ndarray,
    precision: float = PRECISION,
    support: int = SUPPORT,
    seed: int = 17,
) -> list[Rule]:
    """The decision list; each rule covers rows that are bad. Without bad rows it is empty."""
    rng = np.random.default_rng(seed)
    grow = rng.random(len(bad)) < 2 / 3
    left = np.ones(len(bad), bool)
    rules: list[Rule] = []
    while len(rules) < MOST_RULES:
        parts = [
            ({f: table[f][left & part] for f in FEATURES}, bad[left & part])
            for part in (grow, ~grow)
        ]
        if not parts[0][1].any():
            break
        rule = _prune(_grow(*parts[0]), *parts[1])
        covered = rule.covers(parts[1][0])
        right = (covered & parts[1][1]).sum()
        if not rule.conditions or covered.sum() < support or right < precision * covered.sum():
            break
        rules.append(rule)
        left &= ~rule.covers(table)
    return rules


def fit(docs: DataFrame, labels: DataFrame, rows: int = ROWS, **options) -> list[Rule]:
    """Rules for quality 0, from up to ``rows`` labelled documents that pass the base rules.

    Labelled rows of smallest hash of doc_id are taken. Null keys and qualities are left out; a
    document with several labels counts with each.
    """
    chosen = (
        labels.where("doc_id is not null and quality is not null")
        .select("doc_id", "quality")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality")
        .limit(rows)
    )
    # At most ``rows`` rows of two numbers: small enough to broadcast.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    measured = with_statistics(texts, drop_text=True).where(~base_failed())
    found = measured.select("doc_id", "quality", *FEATURES).orderBy("doc_id", "quality", *FEATURES)
    values = found.toPandas()
    table = {name: values[name].to_numpy(float) for name in FEATURES}
    return learn(table, (values["quality"] == 0).to_numpy(bool), **options)


def verdict(rules: list[Rule]) -> tuple[Column, Column]:
    """Whether the list keeps a row, and the number of the rule that took it (0: none)."""
    number = F.lit(0)
    for i in reversed(range(len(rules))):
        test = F.lit(True)
        for condition in rules[i].conditions:
            test = test & condition.column()
        number = F.when(test, F.lit(i + 1)).otherwise(number)
    return number == 0, number


def judge(docs: DataFrame, rules: list[Rule], drop_text: bool = False) -> DataFrame:
    """Adds the statistics, base_failed, rule and kept.

    A null or empty text has no words and fails. Rows are judged one by one, so repeated rows agree.
    Columns of these names are replaced; all others are kept.
    """
    clashing = [c for c in docs.columns if c in (*FEATURES, "base_failed", "rule", "kept")]
    measured = with_statistics(docs.drop(*clashing), drop_text)
    keeps, number = verdict(rules)
    return measured.withColumns({"base_failed": base_failed(), "rule": number}).withColumn(
        "kept", ~F.col("base_failed") & keeps
    )
