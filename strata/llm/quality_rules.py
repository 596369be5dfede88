"""Quality rules combined by weak supervision.

Each rule votes good (1), bad (0) or abstains (-1) on a document. The rules'
accuracies are unknown: expectation-maximisation estimates, for each rule and
each hidden class, how often it votes each way, from the counts of the vote
patterns over the whole corpus. One class is the good texts. How many classes
of bad texts there are is estimated too: a class is added while the vote
patterns become clearly likelier by it. A rule that votes bad as often on good
texts as on bad ones is no evidence, and is outvoted. A document is kept if its
posterior probability of being good is at least one half.

Everything per document is built-in expressions. The estimation sees one row
per distinct vote pattern (at most 3 ** rules of them, whatever the corpus
size), so it runs on the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import fresh, let, staged, words_of

#: The symbols and windows of the base statistics.
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

GOOD, BAD, ABSTAIN = 1, 0, -1
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeat_words(words: Column) -> Column:
    """Words that lie in a WINDOW-word window found twice or more.

    Windows are compared by 64-bit hash. Most texts repeat none, which one
    hash set shows; only the others sort their windows to find which repeat.
    """
    none = F.lit(0).cast("long")

    def covered(positions: Column) -> Column:
        start = F.struct(none.alias("n"), F.lit(-WINDOW).alias("last"))
        step = lambda a, p: F.struct(
            (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last"))
        return F.aggregate(positions, start, step, lambda a: a["n"])

    def repeated(hashes: Column) -> Column:
        ranked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(ranked, lambda s: covered(F.sort_array(F.filter(
            F.transform(s, lambda x, k: F.when(
                F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
                | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)), x["i"])),
            lambda p: p.isNotNull()))))

    def pairs(items: Column, apart: int) -> Column:
        return F.transform(items, lambda x, i: F.xxhash64(x, F.get(items, i + apart)))

    def windows(two: Column) -> Column:  # hashes of two words, then four, then eight
        return let(pairs(two, 2), lambda four: F.slice(pairs(four, 4), 1, F.size(four) - (WINDOW - 1)))

    return F.when(F.size(words) < WINDOW, none).otherwise(let(
        let(pairs(words, 1), windows),
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(repeated(h))))


def with_statistics(docs: DataFrame, name: str, text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``name`` of the statistics of ``text``
    that the rules read (NULL text counts as empty). Counts are longs."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))

    def count(pattern: str) -> Column:
        return F.regexp_count(t, F.lit(pattern)).cast("long")

    def share(words: Column, test) -> Column:
        return F.size(F.filter(words, test)).cast("long")

    def stats(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            (F.length(t) - count(r"[\x20\x09-\x0D]")).alias("word_chars"),
            count(SYMBOLS).alias("n_symbols"),
            let(lines, lambda s: F.size(s) - F.size(F.array_distinct(s))).cast("long").alias("n_dup_lines"),
            _repeat_words(words).cast("long").alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
            share(words, lambda w: F.length(w) <= 3).alias("n_short"),
            count(r"\p{Lu}").alias("n_capitals"),
            share(words, lambda w, i: w == F.get(words, i - 1)).alias("n_stutter"),
            count(r"[!?](?![^\x20\x09-\x0D])").alias("n_loud"),
            F.size(F.array_distinct(words)).cast("long").alias("n_distinct"))

    return docs.withColumn(name, let(words_of(F.col(text)), stats))


@dataclass(frozen=True)
class Rule:
    """Votes good below ``good``, bad above ``bad`` (or the other way round
    if ``good`` is the larger) on ``value``; abstains between them, and on
    texts of fewer than ``least`` words."""

    name: str
    value: str
    good: float
    bad: float
    least: int = 8

    def vote(self, stats: str) -> Column:
        v = F.expr(self.value.replace("@", f"`{stats}`."))
        up = self.good > self.bad
        is_good, is_bad = (v >= self.good, v <= self.bad) if up else (v <= self.good, v >= self.bad)
        short = F.col(f"`{stats}`.n_words") < self.least
        return F.when(short | v.isNull(), ABSTAIN).when(is_bad, BAD).when(is_good, GOOD).otherwise(ABSTAIN)


#: Shares are of words or lines. try_divide: an empty text abstains.
RULES: tuple[Rule, ...] = (
    Rule("symbols", "try_divide(@n_symbols, @n_words)", 0.05, 0.25),
    Rule("word_length_max", "try_divide(@word_chars, @n_words)", 9.0, 12.0),
    Rule("word_length_min", "try_divide(@word_chars, @n_words)", 3.5, 2.5),
    Rule("duplicate_lines", "try_divide(@n_dup_lines, @n_lines)", 0.15, 0.35),
    Rule("repeated_windows", "try_divide(@n_repeat_words, @n_words)", 0.10, 0.30),
    Rule("capitals", "try_divide(@n_capitals, @word_chars)", 0.20, 0.50),
    Rule("shouting", "try_divide(@n_loud, @n_words)", 0.10, 0.30),
    Rule("short_words", "try_divide(@n_short, @n_words)", 0.12, 0.04, 30),
    Rule("stuttering", "try_divide(@n_stutter, @n_words)", 0.10, 0.30),
    Rule("variety", "try_divide(@n_distinct, sqrt(@n_words))", 3.5, 2.0, 20),
)


@dataclass(frozen=True)
class LabelModel:
    """``share`` of each hidden class and, for each class and rule, how often
    a vote of that rule is "good". Class 0 is the good texts, the others are
    kinds of bad texts."""

    share: tuple[float, ...]
    says_good: tuple[tuple[float, ...], ...]

    def quality(self, pattern: Sequence[int]) -> float:
        """Posterior probability of the good class; abstaining is no evidence."""
        like = [math.log(n) + sum(math.log(g if v == GOOD else 1 - g)
                                  for v, g in zip(pattern, says, strict=True) if v != ABSTAIN)
                for n, says in zip(self.share, self.says_good, strict=True)]
        return 1 / sum(math.exp(min(x - like[0], 700.0)) for x in like)


def ordered_rates(yes: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``yes / total`` per class and rule, the likeliest under which a rule
    votes bad on no class less often than on the good one (class 0): classes
    below it are pooled with it, the lowest first."""
    rates = yes / total
    order = np.argsort(rates[1:], axis=0) + 1
    rule = np.arange(rates.shape[1])
    pooled_yes, pooled = yes[0].copy(), total[0].copy()
    for c in order:
        below = rates[c, rule] < pooled_yes / pooled
        pooled_yes += np.where(below, yes[c, rule], 0)
        pooled += np.where(below, total[c, rule], 0)
    lowest = pooled_yes / pooled
    return np.vstack([lowest, np.maximum(rates[1:], lowest)])


def estimate(good: np.ndarray, bad: np.ndarray, count: np.ndarray, start: np.ndarray,
             rounds: int = 300) -> tuple[float, np.ndarray, np.ndarray]:
    """Expectation-maximisation from ``start`` (class x rule: how often a vote
    is bad): log-likelihood, class shares, and the estimate in the shape of
    ``start``. ``good`` and ``bad`` tell each pattern's votes. ``start`` counts
    as 10 votes for the good class and 2 for the others, the shares as 9
    texts and 1: enough to tell the classes apart, nothing beside a corpus."""
    weight = np.array([10.0] + [2.0] * (len(start) - 1))[:, None]
    base = np.array([9.0] + [1.0] * (len(start) - 1))
    share, says_bad, last = base / base.sum(), start, -math.inf
    for _ in range(rounds):
        logs = np.log(share) + good @ np.log(1 - says_bad).T + bad @ np.log(says_bad).T
        top = logs.max(axis=1, keepdims=True)
        like = np.exp(logs - top)
        total = like.sum(axis=1, keepdims=True)
        fit = float(count @ (top + np.log(total))[:, 0])
        if fit - last < 1e-9 * abs(fit):
            break
        last = fit
        part = like / total * count[:, None]
        share = (part.sum(axis=0) + base) / (count.sum() + base.sum())
        yes = part.T @ bad + weight * start
        says_bad = np.clip(ordered_rates(yes, yes + part.T @ good + weight * (1 - start)), 1e-6, 1 - 1e-6)
    return last, share, says_bad


def fit_label_model(patterns: dict[tuple[int, ...], int], rules: int) -> LabelModel:
    """Hidden classes and their accuracies from vote-pattern counts.

    It begins with the good texts and one class of bad texts. A further class
    is tried from each rule in turn, as the texts that this rule calls bad and
    the others mostly do not; the likeliest one stays if it adds more than the
    logarithm of the number of texts to the log-likelihood, and the next is
    tried. Accuracies are free but for one thing that tells a noisy rule from one
    that sees a kind of its own: no rule calls good texts bad more often than
    it does any kind of bad text. An empty corpus returns the pseudo-counts.
    """
    votes = np.array(list(patterns), dtype=int).reshape(-1, rules)
    count = np.array(list(patterns.values()), dtype=float)
    good, bad = (votes == GOOD).astype(float), (votes == BAD).astype(float)
    start = np.vstack([np.full(rules, 0.02), np.full(rules, 0.5)])
    best = estimate(good, bad, count, start)
    for _ in range(rules if patterns else 0):
        tries = [np.vstack([start, np.where(np.arange(rules) == k, 0.9, 0.1)]) for k in range(rules)]
        found = [estimate(good, bad, count, t) for t in tries]
        k = max(range(rules), key=lambda i: found[i][0])
        if found[k][0] - best[0] <= math.log(count.sum()):
            break
        start, best = tries[k], found[k]
    _, share, says_bad = best
    return LabelModel(tuple(share.tolist()), tuple(tuple(x) for x in (1 - says_bad).tolist()))


def pattern_code(stats: str, rules: Sequence[Rule]) -> Column:
    """The votes of all rules as the digits of one number."""
    code = F.lit(0)
    for r in rules:
        code = code * 3 + (r.vote(stats) + 1)
    return code


def learn_rules(with_stats: DataFrame, stats: str, rules: Sequence[Rule] = RULES) -> dict[int, float]:
    """Fit the label model to the votes of every row. Returns the posterior
    quality of each vote pattern that occurs, by its code."""
    code = pattern_code(stats, rules).alias("code")
    counts = {r["code"]: r["n"] for r in with_stats.groupBy(code).agg(F.count(F.lit(1)).alias("n")).collect()}
    votes = {c: tuple(c // 3 ** k % 3 - 1 for k in reversed(range(len(rules)))) for c in counts}
    model = fit_label_model({votes[c]: n for c, n in counts.items()}, len(rules))
    return {c: model.quality(v) for c, v in votes.items()}


def base_failed(stats: str) -> Column:
    s = F.col(stats)
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"])


def quality_verdicts(docs: DataFrame, keys: Sequence[str], text: str = "text",
                     rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per document: ``keys``, the base statistics, ``base_failed``,
    ``quality`` (posterior probability of being good) and ``kept``.

    NULL and empty texts have no words, so they fail the base check. Keys are
    passed through as they are: NULL or repeated keys give a row each. Other
    columns of ``docs`` are ignored, whatever their names. An empty table
    gives no rows. The statistics are computed once and staged in the shared
    folder, narrow, because both the estimation and the verdict read them.
    """
    narrow = docs.select(*[F.col(k) for k in keys], F.col(text).alias(fresh(docs, "__text")))
    stats = fresh(narrow, "__stats")
    held = staged(with_statistics(narrow, stats, narrow.columns[-1]).drop(narrow.columns[-1]), "rule-stats")
    qualities = learn_rules(held, stats, rules)
    known = docs.sparkSession.createDataFrame(sorted(qualities.items()), "code int, quality double")
    scored = held.withColumn(code := fresh(held, "code"), pattern_code(stats, rules)).join(
        F.broadcast(known.withColumnRenamed("code", code)), code)
    return scored.select(
        *keys, *[F.col(stats)[s].alias(s) for s in STATS], base_failed(stats).alias("base_failed"),
        "quality", (~base_failed(stats) & (F.col("quality") >= 0.5)).alias("kept"))


def keep_good(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``docs`` without the rows that the verdict rejects (among them those
    with NULL or empty text). The model is fitted to every row; the verdict
    is a filter on the rows as they are read, so nothing is joined."""
    stats = fresh(docs, "__stats")
    marked = with_statistics(docs, stats, text)
    good = [code for code, q in learn_rules(marked, stats, rules).items() if q >= 0.5]
    return marked.where(~base_failed(stats) & pattern_code(stats, rules).isin(good)).drop(stats)
