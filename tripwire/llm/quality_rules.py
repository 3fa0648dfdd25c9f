"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Each rule looks at one measure of a text and votes that it is good, votes that
it is bad, or abstains between its two thresholds. Over all texts, the EM of
Dawid and Skene estimates how often each rule votes "bad" on bad and on good
texts, and how many texts are bad, from the counts of the vote patterns. A text
is kept when the posterior probability of "good" is at least 0.5.

The estimates are kept within MAX_FALSE and MIN_HIT, so the rules are nearly
hard: one bad vote costs at least ln(MIN_HIT / MAX_FALSE) = 3.9 and mostly
decides alone, and a rule that is wrong on many good texts loses no weight. The
README has the figures, also those of estimates without these bounds.

Everything runs in DataFrame expressions. Measures need no shuffle: repeated
windows are found in each text's own array of window hashes. The vote patterns
are at most 3^rules, however many rows there are; their counts are all that
reaches the driver.

Defined results: a null or empty text, or one of white space only, has all
counts 0 and fails the base limits. Repeated rows count as often as they
occur. An empty table gives no rows (and no patterns: the starting estimates
stand). Columns other than doc_id and text are ignored by ``score_quality`` and
kept by ``keep_good``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwire.llm._tables import stored

SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\x0b\x0c\r"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
KEEP_AT = 0.5
# Kinds of bad text are mostly exclusive (shouting isn't also a table), so few rules agree on one. These bounds say
# what the rules are: thresholds that a good text meets at most this often, and that some share of bad texts does.
MAX_FALSE, MIN_HIT = 0.001, 0.05
ROUNDS = 50

# name -> (measure, bad from, good up to); a rule abstains between the two
RULES = {
    "symbols": ("n_symbols / n_words", 0.10, 0.03),
    "repeats": ("n_repeat_words / n_words", 0.15, 0.05),
    "dup_lines": ("n_dup_lines / n_lines", 0.30, 0.10),
    "shouting": ("n_marks / n_words", 0.20, 0.05),
    "capitals": ("n_capitals / word_chars", 0.40, 0.20),
    "variety": ("1 - n_distinct / n_words", 0.80, 0.65),
    "long_words": ("word_chars / n_words", 14.0, 11.0),
    "short_words": ("n_words / word_chars", 0.45, 0.34),
}


def _count_of(chars: str, text: Column) -> Column:
    """Characters of ``text`` that are one of ``chars``."""
    return F.length(text) - F.length(F.translate(text, chars, ""))


def measures(documents: DataFrame) -> DataFrame:
    """``doc_id`` and the counts that the rules use, one row for each row."""
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    spoken = F.filter(F.split(text, "\n", -1), lambda line: F.length(F.translate(line, SPACE, "")) > 0)
    base = documents.select("doc_id", text.alias("text"), words.alias("words"), spoken.alias("lines"))
    # one number for each 5-word window; equal windows of a text have equal numbers
    window = lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(5)])
    last = F.size("words") - 5
    windows = F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), window)).otherwise(F.expr("cast(array() as array<bigint>)"))
    base = base.withColumn("windows", windows)
    # places of windows found twice or more: neighbours in (hash, place) order that share the hash
    ordered = F.array_sort(F.arrays_zip(F.col("windows").alias("h"), F.sequence(F.lit(0), last).alias("at")))
    base = base.withColumn("ordered", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), ordered))
    same = lambda i, j: F.coalesce(F.get("ordered", i)["h"] == F.get("ordered", j)["h"], F.lit(False))
    places = F.array_sort(F.transform(F.filter(F.transform("ordered", lambda x, i: F.struct(x["at"].alias("at"), (same(i, i - 1) | same(i, i + 1)).alias("dup"))), lambda x: x["dup"]), lambda x: x["at"]))
    base = base.withColumn("places", places)
    # each place covers five words, or as many as there are before the next
    cover = F.aggregate(F.transform("places", lambda at, i: F.least(F.lit(5), F.coalesce(F.get("places", i + 1) - at, F.lit(5)))), F.lit(0), lambda total, n: total + n)
    n = lambda c: c.cast("long")
    return base.select(
        "doc_id",
        n(F.size("words")).alias("n_words"),
        n(F.length("text") - _count_of(SPACE, F.col("text"))).alias("word_chars"),
        n(_count_of(SYMBOLS, F.col("text"))).alias("n_symbols"),
        n(F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        n(F.coalesce(cover, F.lit(0))).alias("n_repeat_words"),
        n(F.size("lines")).alias("n_lines"),
        n(F.size(F.array_distinct("words"))).alias("n_distinct"),
        n(_count_of("!?", F.col("text"))).alias("n_marks"),
        n(_count_of(CAPITALS, F.col("text"))).alias("n_capitals"),
    )


def _vote(rule: str) -> Column:
    """1 bad, 0 good, null abstains."""
    measure, bad, good = RULES[rule]
    share = F.expr(f"try_divide({measure.split(' / ')[0]}, {measure.split(' / ')[1]})") if not measure.startswith("1 -") else F.expr(f"1 - try_divide({measure[4:].replace(' / ', ', ')})")
    return F.when(share >= bad, F.lit(1)).when(share <= good, F.lit(0)).alias(f"v_{rule}")


def estimate(patterns: list[tuple[tuple, int]], rules: int, rounds: int = ROUNDS) -> tuple[float, list[tuple[float, float]]]:
    """EM over vote patterns and their counts: the share of bad texts, and for each rule the probability that
    it votes bad on bad and on good texts. The bounds keep "bad" the class on which rules vote bad."""
    prior, rates = 0.15, [(0.3, 0.001)] * rules
    for _ in range(rounds):
        total = bad_total = 0.0
        votes = [[1.0, 1.0, 1.0, 50.0] for _ in range(rules)]  # bad votes on bad, good on bad, bad on good, good on good
        for pattern, n in patterns:
            p = 1.0 - posterior(pattern, prior, rates)
            total, bad_total = total + n, bad_total + n * p
            for tally, vote in zip(votes, pattern, strict=True):
                if vote is not None:
                    tally[0 if vote else 1] += n * p
                    tally[2 if vote else 3] += n * (1.0 - p)
        prior = min(0.6, max(0.001, (bad_total + 0.15) / (total + 1.0)))
        rates = [(min(0.98, max(MIN_HIT, a / (a + b))), min(MAX_FALSE, max(1e-5, c / (c + d)))) for a, b, c, d in votes]
    return prior, rates


def posterior(pattern: tuple, prior: float, rates: list[tuple[float, float]]) -> float:
    """Probability that a text with these votes is good."""
    odds = math.log((1.0 - prior) / prior)
    for vote, (on_bad, on_good) in zip(pattern, rates, strict=True):
        if vote is not None:
            odds += math.log(on_good / on_bad) if vote else math.log((1.0 - on_good) / (1.0 - on_bad))
    return 1.0 / (1.0 + math.exp(-odds))


def score_quality(documents: DataFrame) -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, p_good)``."""
    names = list(RULES)
    voted = stored(measures(documents).select("*", *[_vote(r) for r in names]), "votes")
    return _judged(voted).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")


def _judged(voted: DataFrame) -> DataFrame:
    names = list(RULES)
    # at most 3^rules rows
    counted = voted.groupBy(*[f"v_{r}" for r in names]).count().orderBy(*[f"v_{r}" for r in names]).collect()
    prior, rates = estimate([(tuple(row[:-1]), row[-1]) for row in counted], len(names))
    odds = F.lit(math.log((1.0 - prior) / prior))
    for rule, (on_bad, on_good) in zip(names, rates, strict=True):
        vote = F.col(f"v_{rule}")
        odds = odds + F.when(vote == 1, F.lit(math.log(on_good / on_bad))).when(vote == 0, F.lit(math.log((1.0 - on_good) / (1.0 - on_bad)))).otherwise(F.lit(0.0))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    judged = voted.withColumn("base_failed", failed).withColumn("p_good", 1.0 / (1.0 + F.exp(-odds)))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= KEEP_AT))


def keep_good(documents: DataFrame) -> DataFrame:
    """``documents`` without the rows that the rules reject; a row is judged by its text."""
    key = F.xxhash64("doc_id", "text")
    numbered = documents.select(key.alias("doc_id"), "text")
    verdict = stored(measures(numbered).select("*", *[_vote(r) for r in RULES]), "votes")
    kept = _judged(verdict).where("kept").select(F.col("doc_id").alias("__key")).distinct()
    return documents.join(kept, key == F.col("__key"), "left_semi")
