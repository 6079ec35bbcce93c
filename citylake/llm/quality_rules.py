"""Operator 1: weak supervision of document quality.

Rules over text statistics vote good, bad or abstain. Expectation-maximisation over the counts of vote
patterns (at most 3**rules rows, whatever the input) estimates for each rule how often good and bad
documents draw each vote, and the share of good documents. A document is kept by its posterior
probability of being good; hard limits (``base_failed``) reject beforehand.

A kind of bad document that a single rule notices cannot be told from that rule's errors, so the rules
overlap: symbols, share of letters and function words see the same noise from different sides.

Everything that touches documents is a built-in expression in one pass without a shuffle of texts; only
vote patterns are grouped. Null and empty texts count no words and fail the base. Rows that repeat are
judged alike. With no documents, or none that passes the base, the posterior rests on the start values.
``annotate`` keeps other columns and replaces those named like its own; ``keep_good`` changes none.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citylake.functions.base import let
from citylake.operators.schema import named

SPACE_CLASS = r"[ \t\n\x0B\f\r]+"
SPACES = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
GOOD, ABSTAIN, BAD = "g", "a", "b"
#: Common short words of running text, by language.
FUNCTION_WORDS = (
    *"the of and to in a is that it for was on are as with be by this at or from".split(),
    *"le la les de des et un une du en que pour dans est pas sur par avec".split(),
    *"der die das und ist von mit den zu ein eine im nicht auf für sich auch".split(),
    *"el los las y que no se lo para con del al su es por".split(),
)
#: Few repeated windows are looked up by value, more are found by sorting positions.
FEW = 16


def repeated_words(words: Column, size: int = WINDOW) -> Column:
    """Number of words inside a window of ``size`` words that occurs twice or more in the array."""
    starts = F.sequence(F.lit(1), F.size(words) - (size - 1))
    windows = F.transform(starts, lambda i: F.xxhash64(*[F.element_at(words, (i + k).cast("int")) for k in range(size)]))

    def again(sorted_values: Column) -> Column:
        return F.array_distinct(
            F.filter(sorted_values, lambda v, i: (i > 0) & (F.get(sorted_values, i - 1) == v))
        )

    def by_value(values: Column, twice: Column) -> Column:
        return F.filter(F.sequence(F.lit(0), F.size(values) - 1), lambda i: F.array_contains(twice, F.get(values, i)))

    def by_sorting(values: Column) -> Column:
        pairs = F.sort_array(F.transform(values, lambda v, i: F.struct(v.alias("v"), i.alias("i"))))
        return let(pairs, lambda p: F.sort_array(F.transform(
            F.filter(p, lambda x, k: ((k > 0) & (F.get(p, k - 1)["v"] == x["v"])) | (F.get(p, k + 1)["v"] == x["v"])),
            lambda x: x["i"],
        )))

    def covered(positions: Column) -> Column:
        start = F.struct(F.lit(-size).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(
            positions, start,
            lambda acc, x: F.struct(x.alias("last"), (acc["n"] + F.least(F.lit(size), x - acc["last"])).alias("n")),
            lambda acc: acc["n"],
        )

    counted = let(windows, lambda values: let(let(F.sort_array(values), again), lambda twice: F.when(
        F.size(twice) == 0, 0
    ).when(F.size(twice) <= FEW, covered(by_value(values, twice))).otherwise(covered(by_sorting(values)))))
    return F.when(F.size(words) < size, 0).otherwise(counted).cast("bigint")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    return let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("bigint")


def statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words`` and, for rules, ``_q_*``."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    counts = let(F.array_remove(F.split(whole, SPACE_CLASS), ""), lambda w: F.struct(
        F.size(w).cast("bigint").alias("n_words"),
        F.char_length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
        repeated_words(w).alias("n_repeat_words"),
        F.size(F.array_distinct(w)).alias("distinct"),
        F.size(F.filter(w, lambda x: x.isin(*FUNCTION_WORDS))).alias("function"),
    ))
    counted = df.withColumn("_q_counts", counts)
    return counted.select(
        *[named(c) for c in df.columns if c not in COLUMNS],
        F.col("_q_counts.n_words"), F.col("_q_counts.word_chars"),
        F.regexp_count(whole, F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        duplicate_lines(whole).alias("n_dup_lines"),
        F.col("_q_counts.n_repeat_words"), F.col("_q_counts.distinct").alias("_q_distinct"),
        F.col("_q_counts.function").alias("_q_function"),
        F.char_length(F.regexp_replace(whole, r"[\x00-@\[-`{-\x7F]+", "")).alias("_q_letters"),
        F.regexp_count(whole, F.lit(r"[\p{Lu}]")).alias("_q_upper"),
        F.regexp_count(whole, F.lit(r"[.!?]")).alias("_q_stops"),
        F.regexp_count(whole, F.lit(r"\n")).alias("_q_breaks"),
    )


#: Columns that ``annotate`` makes.
COLUMNS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "votes", "quality", "kept",
)


class Rule(NamedTuple):
    """Votes bad where ``bad`` holds, good where ``good`` holds, else abstains."""

    name: str
    bad: str
    good: str


RULES = (
    Rule("symbols", "10 * n_symbols > n_words", "50 * n_symbols < n_words"),
    Rule("letters", "100 * _q_letters < 86 * word_chars", "100 * _q_letters > 93 * word_chars"),
    Rule("function_words", "100 * _q_function < 4 * n_words", "100 * _q_function > 10 * n_words"),
    Rule("capitals", "10 * _q_upper > 3 * word_chars", "10 * _q_upper < word_chars"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 12 * n_words",
         "word_chars > 3 * n_words AND word_chars < 9 * n_words"),
    Rule("sentence_marks", "100 * _q_stops < n_words OR 2 * _q_stops > n_words",
         "40 * _q_stops > n_words AND 4 * _q_stops < n_words"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words", "100 * n_repeat_words < 10 * n_words"),
    Rule("repeated_lines", "10 * n_dup_lines > 3 * (_q_breaks + 1)", "n_dup_lines = 0"),
    Rule("vocabulary", "100 * _q_distinct < 15 * n_words", "100 * _q_distinct > 30 * n_words"),
)


def votes(rules: tuple[Rule, ...] = RULES) -> Column:
    """One letter per rule."""
    each = [F.when(F.expr(r.bad), BAD).when(F.expr(r.good), GOOD).otherwise(ABSTAIN) for r in rules]
    return F.concat(*each)


#: What is expected of a rule before any data: votes on good and on bad documents. It weighs as much as
#: this share of the documents, so that a small class of bad ones is not explained away.
GOOD_VOTES = {GOOD: 0.69, ABSTAIN: 0.30, BAD: 0.01}
BAD_VOTES = {GOOD: 0.55, ABSTAIN: 0.20, BAD: 0.25}
PRIOR_SHARE = 0.03


class Model(NamedTuple):
    """Log-odds of good: ``prior`` plus ``weight[rule][vote]``."""

    prior: float
    weight: list[dict[str, float]]


def fit(patterns: list[tuple[str, int]], rules: int, rounds: int = 30, good_share: float = 0.9) -> Model:
    """Expectation-maximisation from the start that any bad vote makes a document bad with 0.9."""
    patterns = sorted(patterns)
    posterior = [0.1 if BAD in p else 0.95 for p, _ in patterns]
    if not patterns:
        return Model(_log_odds(good_share), [{GOOD: 0.0, ABSTAIN: 0.0, BAD: 0.0}] * rules)
    for _ in range(rounds):
        good = sum(n * q for (_, n), q in zip(patterns, posterior))
        bad = sum(n * (1 - q) for (_, n), q in zip(patterns, posterior))
        weight, strength = [], PRIOR_SHARE * (good + bad)
        for r in range(rules):
            row = {}
            for vote in (GOOD, ABSTAIN, BAD):
                g = sum(n * q for (p, n), q in zip(patterns, posterior) if p[r] == vote)
                b = sum(n * (1 - q) for (p, n), q in zip(patterns, posterior) if p[r] == vote)
                g = (g + strength * GOOD_VOTES[vote]) / (good + strength)
                b = (b + strength * BAD_VOTES[vote]) / (bad + strength)
                row[vote] = math.log(g) - math.log(b)
            # A vote never speaks against what it says.
            weight.append({GOOD: max(row[GOOD], 0.0), ABSTAIN: 0.0, BAD: min(row[BAD], 0.0)})
        model = Model(math.log((good + 1) / (bad + 1)), weight)
        posterior = [_probability(model.prior + sum(w[v] for w, v in zip(weight, p))) for p, _ in patterns]
    return model


def _log_odds(p: float) -> float:
    return math.log(p / (1 - p))


def _probability(x: float) -> float:
    return 1 / (1 + math.exp(-max(min(x, 500.0), -500.0)))


def posterior(model: Model, pattern: Column) -> Column:
    """Probability of good for a column of vote patterns."""
    odds = F.lit(model.prior)
    for r, weight in enumerate(model.weight):
        vote = F.substring(pattern, r + 1, 1)
        odds = odds + F.when(vote == GOOD, weight[GOOD]).when(vote == BAD, weight[BAD]).otherwise(weight[ABSTAIN])
    return 1 / (1 + F.exp(-odds))


def annotate(
    df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, threshold: float = 0.5,
    keep_with: str | None = None, keep_text: bool = False,
) -> DataFrame:
    """``df`` with the statistics, ``base_failed``, ``votes``, ``quality`` and ``kept``.

    ``keep_with`` is a folder for the annotated rows, with their texts only if ``keep_text``; statistics
    are then computed once, for the fit and for the result.
    """
    spark = df.sparkSession
    base = F.expr(
        f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"
    )
    stats = statistics(df, text).withColumn("base_failed", base).withColumn("votes", votes(rules))
    stats = stats.drop(*[c for c in stats.columns if c.startswith("_q_")])
    if keep_with:
        slim = stats if keep_text else stats.drop(text)
        slim.write.parquet(keep_with)
        stats = spark.read.schema(slim.schema).parquet(keep_with)
    counts = stats.where("NOT base_failed").groupBy("votes").count().collect()  # at most 3**rules rows
    model = fit([(r["votes"], r["count"]) for r in counts], len(rules))
    judged = stats.withColumn("quality", posterior(model, F.col("votes")))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))


def keep_good(df: DataFrame, folder: str, text: str = "text") -> DataFrame:
    """The rows that are kept, with the columns of ``df``; ``folder`` takes the annotated rows."""
    # The other columns travel packed, whatever their names.
    rest = F.struct(*[named(c) for c in df.columns if c != text], F.lit(0).alias("_")).alias("rest")
    packed = df.select(named(text).alias("text"), rest)
    kept = annotate(packed, keep_with=folder, keep_text=True).where("kept")
    return kept.select([F.col("text").alias(c) if c == text else F.col("rest")[c].alias(c) for c in df.columns])
