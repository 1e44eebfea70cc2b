"""Quality rules as a learned decision list.

Statistics of each text are compared with thresholds. Rules (conjunctions of thresholds) are learned one
after another from labelled statistics: a rule is grown condition by condition on part of the rows, pruned on
the rest, and the rows it covers are set aside. The list becomes one Spark conditional expression, tested in
the order the rules were learned; rows that no rule covers are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airq.llm.common import WORD_SPACE, byte_slices, sample_by_class, texts_of

# Rows taken of each label, at most (on average over hashes of the ids).
SAMPLE_PER_CLASS = 5000
SYMBOLS = "#*$%&|<>"
WINDOW = 5
COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct_words", "n_upper", "n_marks", "n_lines",
]

_WORDS = re.compile(f"[^{re.escape(WORD_SPACE)}]+").findall
_UPPER = re.compile("[A-ZÀ-ÖØ-Þ]").findall


def repeated_words(ids: np.ndarray, distinct: int) -> int:
    """Number of words that lie in a window of five words found twice or more."""
    n = len(ids) - WINDOW + 1
    if n < 2:
        return 0
    keys, size = ids[:n].astype(np.int64), distinct
    for k in range(1, WINDOW):
        if size > (1 << 62) // max(distinct, 1):  # renumber before the product leaves 64 bits
            keys, size = np.unique(keys, return_inverse=True)[1], n
        keys = keys * distinct + ids[k : k + n]
        size = size * distinct
    _, where, counts = np.unique(keys, return_inverse=True, return_counts=True)
    twice = counts[where] > 1
    edge = np.zeros(len(ids) + 1, dtype=np.int64)
    edge[:n] += twice
    edge[WINDOW:] -= twice
    return int((np.cumsum(edge[:-1]) > 0).sum())


def counts_of(text: str) -> tuple[int, ...]:
    """The figures named by ``COUNTS`` of a whole text."""
    words = _WORDS(text)
    number: dict[str, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    seen: set[str] = set()
    lines = duplicates = 0
    for line in text.split("\n"):
        if line.strip(WORD_SPACE):
            lines += 1
            duplicates += line in seen
            seen.add(line)
    return (
        len(words),
        sum(map(len, words)),
        sum(map(text.count, SYMBOLS)),
        duplicates,
        repeated_words(ids, len(number)),
        len(number),
        len(_UPPER(text)),
        text.count("!") + text.count("?"),
        lines,
    )


def text_statistics(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: id and the columns of ``COUNTS``; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "_text"):
                rows = np.array([counts_of(t) for t in texts_of(part, "_text")], dtype=np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, rows.T)], ["_id", *COUNTS])

    kind = docs.schema[id_column].dataType.simpleString()
    found = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text")).mapInArrow(
        run, f"_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS)
    )
    return found.select(F.col("_id").alias(id_column), *COUNTS)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    """Fixed rule: fewer than 10 words, or more than a fifth of the words repeat."""
    return (n_words < 10) | (n_repeat_words * 100 > n_words * 20)


def shares() -> dict[str, Column]:
    """What the learned rules look at: shares of the counts, comparable between short and long texts."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))
    return {
        "symbols_per_word": F.col("n_symbols") / words,
        "marks_per_word": F.col("n_marks") / words,
        "upper_share": F.col("n_upper") / chars,
        "repeat_share": F.col("n_repeat_words") / words,
        "distinct_share": F.col("n_distinct_words") / words,
        "duplicate_line_share": F.col("n_dup_lines") / lines,
        "word_length": F.col("word_chars") / words,
        "words": F.col("n_words").cast("double"),
    }


@dataclass(frozen=True)
class Condition:
    """``feature <= threshold`` or ``feature > threshold``."""

    feature: str
    above: bool
    threshold: float

    def holds(self, column: np.ndarray) -> np.ndarray:
        return column > self.threshold if self.above else column <= self.threshold

    def column(self, features: dict[str, Column]) -> Column:
        c, t = features[self.feature], F.lit(self.threshold)
        return c > t if self.above else c <= t

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


@dataclass(frozen=True)
class Settings:
    """Growth stops at ``longest`` conditions, the list at ``most_rules`` rules or a rule that is right too seldom."""

    candidates: int = 64
    longest: int = 4
    most_rules: int = 12
    least_rows: int = 5
    least_precision: float = 0.8
    grow_share: float = 2 / 3
    seed: int = 5


def covered(rule: Rule, data: dict[str, np.ndarray], rows: np.ndarray) -> np.ndarray:
    for c in rule:
        rows = rows[c.holds(data[c.feature][rows])]
    return rows


def grow(data: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray, settings: Settings) -> Rule:
    """Add the condition with the largest information gain until only bad rows are covered."""
    rule: list[Condition] = []
    while len(rule) < settings.longest:
        positive = bad[rows].sum()
        if positive == 0 or positive == len(rows):
            break
        now = np.log2(positive / len(rows))
        best, best_gain = None, 1e-9
        for name, values in data.items():
            column = values[rows]
            cuts = np.unique(np.quantile(column, np.linspace(0, 1, settings.candidates + 2)[1:-1], method="lower"))
            order = np.argsort(column, kind="stable")
            upto = np.cumsum(bad[rows][order])
            at = np.searchsorted(column[order], cuts, "right")
            for cut, k in zip(cuts, at):
                for above in (False, True):
                    n = len(rows) - k if above else k
                    p = positive - (upto[k - 1] if k else 0) if above else (upto[k - 1] if k else 0)
                    if p and n < len(rows):
                        gain = p * (np.log2(p / n) - now)
                        if gain > best_gain:
                            best, best_gain = Condition(name, above, float(cut)), gain
        if best is None:
            break
        rule.append(best)
        rows = covered((best,), data, rows)
    return tuple(rule)


def prune(rule: Rule, data: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray) -> Rule:
    """Drop last conditions as long as ``(bad - good) / covered`` on the pruning rows does not fall."""

    def worth(r: Rule) -> float:
        found = covered(r, data, rows)
        return (2 * bad[found].sum() - len(found)) / len(found) if len(found) else -1.0

    best = rule
    for k in range(len(rule) - 1, 0, -1):
        if worth(rule[:k]) >= worth(best):
            best = rule[:k]
    return best


def middle(rule: Rule, data: dict[str, np.ndarray], rows: np.ndarray) -> Rule:
    """Move each threshold half way to the next larger value seen, away from the rows at its edge."""
    out = []
    for c in rule:
        column = data[c.feature][rows]
        larger = column[column > c.threshold]
        at = (c.threshold + larger.min()) / 2 if len(larger) else c.threshold
        out.append(Condition(c.feature, c.above, float(at)))
    return tuple(out)


def learn_rules(data: dict[str, np.ndarray], bad: np.ndarray, settings: Settings = Settings()) -> list[Rule]:
    """Ordered rules for rows to reject, by sequential covering; empty where nothing can be learned."""
    rng = np.random.default_rng(settings.seed)
    rest = np.arange(len(bad))
    rules: list[Rule] = []
    while len(rules) < settings.most_rules and bad[rest].sum() >= settings.least_rows:
        shuffled = rng.permutation(rest)
        cut = int(len(shuffled) * settings.grow_share)
        rule = grow(data, bad, shuffled[:cut], settings)
        if not rule:
            break
        rule = middle(prune(rule, data, bad, shuffled[cut:]), data, rest)
        found = covered(rule, data, rest)
        if len(found) < settings.least_rows or bad[found].mean() < settings.least_precision:
            break
        rules.append(rule)
        rest = np.setdiff1d(rest, found, assume_unique=True)
    return rules


def fit_rules(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    per_class: int = SAMPLE_PER_CLASS,
    settings: Settings = Settings(),
) -> list[Rule]:
    """Learn from labelled texts (label 0: reject) that pass the base rule, at most about ``per_class`` of each label.

    The bound makes the ids small enough to broadcast; statistics are taken of the chosen texts only. Rows
    with a null id or another label are left out.
    """
    marked = (
        labels.select(F.col(id_column).alias("_id"), F.col(label_column).cast("int").alias("_label"))
        .where(F.col("_id").isNotNull() & F.col("_label").isin(0, 1))
        .distinct()
    )
    chosen = F.broadcast(sample_by_class(marked, "_id", "_label", per_class))
    texts = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    statistics = text_statistics(texts.join(chosen, "_id", "left_semi"), "_id", "_text")
    passed = statistics.where(~base_failed(F.col("n_words"), F.col("n_repeat_words")))
    features = shares()
    rows = passed.join(chosen, "_id").select("_id", "_label", *[c.alias(f"_{name}") for name, c in features.items()]).toArrow()
    rows = rows.take(pc.sort_indices(rows, [(c, "ascending") for c in rows.column_names]))
    return learn_rules({name: rows[f"_{name}"].to_numpy() for name in features}, rows["_label"].to_numpy() == 0, settings)


def rule_column(rules: list[Rule]) -> Column:
    """Number (from 1) of the first rule that covers a row of statistics, null if none does."""
    features = shares()
    out = F.lit(None).cast("int")
    for i, rule in reversed(list(enumerate(rules, 1))):
        holds = F.lit(True)
        for c in rule:
            holds = holds & c.column(features)
        out = F.when(holds, F.lit(i)).otherwise(out)
    return out


def apply_rules(statistics: DataFrame, rules: list[Rule]) -> DataFrame:
    """``statistics`` with ``base_failed``, ``failed_rule`` (text of the first rule that covers it) and ``kept``."""
    names = F.array(*[F.lit(" and ".join(map(str, r))) for r in rules]) if rules else F.array().cast("array<string>")
    judged = statistics.withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words")))
    judged = judged.withColumn("_rule", rule_column(rules))
    return judged.select(
        *statistics.columns,
        "base_failed",
        F.when(F.col("_rule").isNotNull(), F.element_at(names, F.col("_rule"))).alias("failed_rule"),
        (~F.col("base_failed") & F.col("_rule").isNull()).alias("kept"),
    )
