"""Quality rules as a learned decision list, all of it in Spark's own expressions.

Statistics of each whole text are column expressions. From labelled rows an ordered list of rules is
learned by sequential covering: a rule is a conjunction of thresholds, grown on two thirds of what no
earlier rule covers, condition by condition by information gain, and pruned on the last third from
the end while that raises its value there. Rules are added while they are right more often than not
on that third. The list becomes one conditional expression: the first rule that holds rejects.

Learning takes at most ``sample`` labelled rows, those with the smallest hash of their id; only these
numbers come to the driver. Statistics, rules and verdicts cover all rows and whole texts.

Null texts count as empty and have no words; rows with fewer than 50 words or mostly repeated ones
fail the base rule whatever was learned. A threshold on an undefined share compares with 0. Without
labels, or with labels of one kind, the list is empty and rejects nothing beyond the base rule. Labels
without an id or value are left out. Repeated rows get repeated results. Other columns stay.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firstpour.llm.tasks import unused

#: Labelled rows that learning takes at most; they are also what is broadcast, 24 bytes each.
SAMPLE = 20_000
SPACE = r"[\x20\x09-\x0D]+"
#: What the rules look at: per word or share, so that they hold for texts of any length.
STATISTICS = {
    "n_words": "n_words",
    "word_length": "word_chars / n_words",
    "symbols_per_word": "n_symbols / n_words",
    "duplicate_lines": "n_dup_lines / n_lines",
    "repeated_words": "n_repeat_words / n_words",
    "distinct_words": "n_distinct / n_words",
}


def _held(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _repeats(words: Column) -> Column:
    """Words that lie in a three-word window found twice or more."""

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(w) - 2), lambda i: F.xxhash64(*(F.element_at(w, i + k) for k in range(3))))

    def covered(hashes: Column) -> Column:
        # sort places by hash; a place counts if a neighbour has the same; then merge the windows in order
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        same = lambda s, k, by: F.coalesce(F.get(s, k + by).h == F.get(s, k).h, F.lit(False))
        places = _held(pairs, lambda s: F.transform(F.filter(s, lambda x, k: same(s, k, -1) | same(s, k, 1)), lambda x: x.i))
        start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
        step = lambda a, i: F.struct((a.n + F.least(F.lit(3), i - a.last)).alias("n"), i.alias("last"))
        return F.aggregate(F.array_sort(places), start, step, lambda a: a.n)

    some = lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0)
    return F.when(F.size(words) < 4, 0).otherwise(_held(words, lambda w: _held(windows(w), some)))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_distinct as long.

    A column of ``docs`` with one of these names is replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))

    def numbers(words: Column) -> Column:
        return F.struct(
            F.size(words).alias("n_words"),
            F.length(F.array_join(words, "")).alias("word_chars"),
            _repeats(words).alias("n_repeat_words"),
            F.size(F.array_distinct(words)).alias("n_distinct"),
        )

    def lines(found: Column) -> Column:
        return F.struct(F.size(found).alias("n_lines"), (F.size(found) - F.size(F.array_distinct(found))).alias("n_dup_lines"))

    words = F.array_remove(F.split(whole, SPACE), "")
    with_word = F.filter(F.split(whole, "\n"), lambda line: F.length(F.btrim(line, F.lit(" \t\n\x0b\f\r"))) > 0)
    by_word, by_line, symbols = unused(docs, "_words"), unused(docs, "_lines"), unused(docs, "_symbols")
    found = docs.select(
        "*",
        _held(words, numbers).alias(by_word),
        _held(with_word, lines).alias(by_line),
        F.length(F.regexp_replace(whole, r"[^#*$%&|<>]+", "")).alias(symbols),
    )
    made = {
        "n_words": f"{by_word}.n_words",
        "word_chars": f"{by_word}.word_chars",
        "n_symbols": symbols,
        "n_dup_lines": f"{by_line}.n_dup_lines",
        "n_repeat_words": f"{by_word}.n_repeat_words",
        "n_lines": f"{by_line}.n_lines",
        "n_distinct": f"{by_word}.n_distinct",
    }
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in made]
    return found.select(*kept, *[F.col(c).cast("long").alias(name) for name, c in made.items()])


def statistic(name: str) -> Column:
    return F.coalesce(F.try_divide(*(F.col(c) for c in STATISTICS[name].split(" / "))) if "/" in STATISTICS[name] else F.col(name), F.lit(0)).cast("double")


@dataclass(frozen=True)
class Rule:
    """Rejects where every condition (statistic, above, threshold) holds."""

    conditions: tuple[tuple[str, bool, float], ...]

    def holds(self) -> Column:
        found = F.lit(True)
        for name, above, threshold in self.conditions:
            found = found & (statistic(name) > threshold if above else statistic(name) <= threshold)
        return found

    def covers(self, rows: np.ndarray) -> np.ndarray:
        found = np.ones(len(rows), bool)
        for name, above, threshold in self.conditions:
            value = rows[:, list(STATISTICS).index(name)]
            found &= value > threshold if above else value <= threshold
        return found

    def __str__(self) -> str:
        return " and ".join(f"{n} {'>' if a else '<='} {t:.4g}" for n, a, t in self.conditions)


def _grown(rows: np.ndarray, bad: np.ndarray, longest: int) -> Rule:
    """Adds the condition that gains most until only bad rows are covered or nothing is gained."""
    rule = Rule(())
    for _ in range(longest):
        inside = rule.covers(rows)
        p, n = bad[inside].sum(), (~bad[inside]).sum()
        if not n or not p:
            break
        base, best, chosen = math.log2(p / (p + n)), 1e-9, None
        for j, name in enumerate(STATISTICS):
            value = rows[inside, j]
            for threshold in np.unique(np.quantile(value, np.linspace(0.01, 0.99, 99), method="lower")):
                for above in (True, False):
                    hit = value > threshold if above else value <= threshold
                    q, m = (hit & bad[inside]).sum(), (hit & ~bad[inside]).sum()
                    if q and q + m < p + n:
                        gain = q * (math.log2(q / (q + m)) - base)
                        if gain > best:
                            best, chosen = gain, (name, above, float(threshold))
        if chosen is None:
            break
        rule = Rule((*rule.conditions, chosen))
    return rule


def _pruned(rule: Rule, rows: np.ndarray, bad: np.ndarray) -> tuple[Rule, float]:
    """The shortest beginning of a rule with the best value, (p - n) / (p + n), on other rows."""
    best, value = rule, -2.0
    for k in range(len(rule.conditions), 0, -1):
        short = Rule(rule.conditions[:k])
        inside = short.covers(rows)
        p, n = int(bad[inside].sum()), int((~bad[inside]).sum())
        now = (p - n) / (p + n) if p + n else -1.0
        if now >= value:
            best, value = short, now
    return best, value


def cover(rows: np.ndarray, bad: np.ndarray, most: int = 12, longest: int = 4) -> list[Rule]:
    """An ordered list of rules that reject bad rows, by sequential covering."""
    rules: list[Rule] = []
    third = np.arange(len(rows)) % 3 == 2
    while len(rules) < most and bad.any() and (~bad).any():
        rule = _grown(rows[~third], bad[~third], longest)
        if not rule.conditions:
            break
        rule, value = _pruned(rule, rows[third], bad[third])
        if value <= 0:
            break
        rules.append(rule)
        left = ~rule.covers(rows)
        if left.all():
            break
        rows, bad, third = rows[left], bad[left], third[left]
    return rules


def learn(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", quality: str = "quality", sample: int = SAMPLE
) -> list[Rule]:
    """Rules from labels (id, quality: 1 good, 0 bad) of at most ``sample`` rows."""
    own = labels.select(F.col(id).cast("long").alias("id"), F.col(quality).cast("int").alias("good"))
    own = own.where("id is not null and good is not null").distinct().orderBy(F.xxhash64("id"), "id", "good").limit(sample)
    texts = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).where("id is not null")
    known = measured(texts.join(F.broadcast(own), "id"))  # at most ``sample`` small rows
    found = known.select("id", "good", *[statistic(name).alias(name) for name in STATISTICS]).collect()
    found.sort()
    rows = np.array([r[2:] for r in found], float).reshape(-1, len(STATISTICS))
    return cover(rows, np.array([r[1] == 0 for r in found], bool))


def verdict(rules: list[Rule]) -> Column:
    """True where no rule rejects: one conditional expression, the rules in order."""
    found = F.lit(True)
    for rule in reversed(rules):
        found = F.when(rule.holds(), False).otherwise(found)
    return found


def judged(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """``docs`` with its statistics, base_failed and kept."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measured(docs, text).withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & verdict(rules))
