"""Quality rules whose cutoffs carry a guarantee against rejecting good documents.

Each rule is a ratio of a text, and a text breaks it if the ratio is above a cutoff. Cutoffs are
chosen per stratum (band of text lengths) from labelled documents by fixed-sequence testing: from
the loosest cutoff of a fixed grid to the strictest, "more than its share of ``risk`` of the good
documents are rejected" is tested by its exact binomial probability, and the first test that fails
ends the sequence. That keeps the error of one rule in one stratum at the level spent on it; the
level is divided by the number of rules and strata (Bonferroni), so with probability ``1 - error``
every chosen cutoff holds at once. The risk itself is divided by the number of rules, so all rules
together reject at most ``risk`` of the good documents of a stratum. Among the cutoffs that passed, the one with the best balance of bad
documents rejected against good ones is taken, or none if none pays.

Defined cases: a null or empty text has no word and fails the base rules. Ratios of a text without
words are 0. Repeated rows are judged each for itself, but a labelled id is one trial of a rule, with
the highest ratio among its rows, in the lowest stratum that they have; otherwise copies of one good document
would prove a cutoff. Labels that contradict each other count as bad. Without (enough) labels nothing is certified, and only the base rules reject.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.llm.common import map_rows
from seriesloom.llm.words import slices
from seriesloom.session import materialize

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_capitals"]
SYMBOLS = b"#*$%&|<>"

# Share of words or letters above which a text is suspect. Every ratio is cut at i / 40, i = 1 to 40.
RULES = {
    "symbols": ("n_symbols", "n_words"),
    "repeated_words": ("n_repeat_words", "n_words"),
    "repeated_lines": ("n_dup_lines", "n_lines"),
    "capitals": ("n_capitals", "n_letters"),
}
STEPS = 40


@dataclass(frozen=True)
class Guarantee:
    """At most ``risk`` of the good documents of a stratum break any rule, in all strata at once with probability 1 - ``error``."""

    risk: float = 0.01
    error: float = 0.05
    bands: tuple[int, ...] = (200, 1000)  # strata: texts of up to so many words
    price: float = 10.0  # bad documents that must fall for each good one


def _flags(values) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(values)] = True
    return out


def text_counts(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and the counts on which all rules rest, for each row."""

    def make():
        symbols, capitals = _flags(SYMBOLS), _flags(range(65, 91))
        letters = _flags([*range(65, 91), *range(97, 123)])
        blank = _flags([32, 9, 10, 11, 12, 13])
        first = np.ones(256, bool)
        first[128:192] = False  # bytes that continue a code point

        def work(texts: pa.Array) -> list:
            columns = [[] for _ in COUNTS]
            for a, b, words in slices(texts):
                def within(flags):
                    sums = np.concatenate([[0], np.cumsum(flags[words.data])])
                    return sums[words.offsets[1:]] - sums[words.offsets[:-1]]

                dup_lines, n_lines, repeats = np.zeros(b - a, int), np.zeros(b - a, int), np.zeros(b - a, int)
                raw = words.data.tobytes()
                for i in range(b - a):
                    one = raw[words.offsets[i] : words.offsets[i + 1]]
                    lines = one.split(b"\n")
                    n_lines[i] = len(lines)
                    if len(set(lines)) < len(lines):
                        seen: set[bytes] = set()
                        for line in lines:
                            if line in seen:
                                dup_lines[i] += bool(line.strip(b" \t\n\x0b\x0c\r"))
                            seen.add(line)
                    repeats[i] = repeated_words(one.split())
                values = [words.counts, within(first & ~blank), within(symbols), dup_lines, repeats, n_lines, within(letters), within(capitals)]
                for column, v in zip(columns, values):
                    column.append(np.asarray(v, np.int64))
            return [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64)) for c in columns]

        return work

    return map_rows(docs, keep, make, [T.StructField(c, T.LongType()) for c in COUNTS], text)


def repeated_words(words: list) -> int:
    """Words that lie in a run of three which the text has more than once."""
    runs = list(zip(words, words[1:], words[2:]))
    if len(set(runs)) == len(runs):
        return 0
    place: dict = {}
    ids = np.fromiter((place.setdefault(r, len(place)) for r in runs), np.int64, len(runs))
    again = np.bincount(ids)[ids] > 1
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(runs)] |= again
    return int(covered.sum())


def base_failed() -> Column:
    n = F.col("n_words")
    return (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)


def stratum(bands: tuple[int, ...]) -> Column:
    out = F.lit(len(bands))
    for i in reversed(range(len(bands))):
        out = F.when(F.col("n_words") <= bands[i], i).otherwise(out)
    return out


def level(rule: str) -> Column:
    """The number of grid cutoffs that the text's ratio exceeds."""
    over, under = RULES[rule]
    steps = F.when(F.col(under) > 0, F.ceil(F.col(over) * STEPS / F.col(under)) - 1).otherwise(0)
    return F.greatest(F.lit(0), F.least(F.lit(STEPS), steps)).cast("int")


def tail(k: int, n: int, p: float) -> float:
    """Probability of at most ``k`` hits in ``n`` trials."""
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(logs)
    return math.exp(top) * math.fsum(math.exp(x - top) for x in logs)


def choose(counts: dict[tuple[int, str], tuple[np.ndarray, np.ndarray]], g: Guarantee) -> dict[tuple[int, str], int]:
    """The chosen grid cutoff of each (stratum, rule). ``counts``: good and bad labelled texts by level (0 to ``STEPS``)."""
    spent, risk = g.error / (len(RULES) * (len(g.bands) + 1)), g.risk / len(RULES)
    out = {}
    for key, (good, bad) in counts.items():
        n = int(good.sum())
        best = None
        for cut in range(STEPS, 0, -1):  # a text breaks cutoff ``cut`` if its level is at least ``cut``
            k, hits = int(good[cut:].sum()), int(bad[cut:].sum())
            if not n or k >= risk * n or tail(k, n, risk) > spent:
                break
            gain = hits - g.price * k
            if gain > 0 and (best is None or gain > best[0]):
                best = (gain, cut)
        if best:
            out[key] = best[1]
    return out


def calibrate(counted: DataFrame, labels: DataFrame, g: Guarantee = Guarantee()) -> dict[tuple[int, str], int]:
    """Cutoffs from the labelled rows of ``counted`` (doc_id and counts); ``labels``: doc_id, quality.

    Rows that fail the base rules take no part, and a doc_id counts once, however many rows it has. What comes to the driver is a count for each
    stratum, rule, level and label: at most (strata * rules * 41 * 2) rows.
    """
    truth = labels.filter(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("_quality"))
    # One row for each id before the join, combined on the map side: an id with a third of all rows is one row then.
    once = counted.filter(~base_failed() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(stratum(g.bands)).alias("stratum"), *[F.max(level(r)).alias(r) for r in RULES])
    levels = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("level")) for r in RULES])
    rows = (once.join(truth, "doc_id").select("stratum", (F.col("_quality") == 1).alias("good"), F.inline(levels))
            .groupBy("stratum", "rule", "level", "good").count().collect())
    counts = {(s, r): (np.zeros(STEPS + 1, int), np.zeros(STEPS + 1, int)) for s in range(len(g.bands) + 1) for r in RULES}
    for row in rows:
        counts[row["stratum"], row["rule"]][0 if row["good"] else 1][row["level"]] += row["count"]
    return choose(counts, g)


def broken(cutoffs: dict[tuple[int, str], int], bands: tuple[int, ...]) -> Column:
    """Names of the rules that a counted text breaks."""
    hits = [F.when((stratum(bands) == s) & (level(r) >= cut), F.lit(r)) for (s, r), cut in sorted(cutoffs.items())]
    return F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")


def judge(docs: DataFrame, labels: DataFrame, g: Guarantee = Guarantee()) -> DataFrame:
    """One row for each row of ``docs``: doc_id, counts, base_failed, broken rules, kept."""
    counted = materialize(text_counts(docs, ["doc_id"]), "rule-counts")
    cutoffs = calibrate(counted, labels, g)
    return (counted.withColumn("base_failed", base_failed()).withColumn("broken_rules", broken(cutoffs, g.bands))
            .withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0)))
