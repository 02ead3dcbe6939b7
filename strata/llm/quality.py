"""Quality filter by weak supervision: rules vote or abstain, and expectation-maximisation says how far to trust each.

All text work is built-in expressions.  The rules see a few counts of a text; each votes that it is fit (1) or unfit
(-1), or abstains (0).  Documents with the same votes are alike to the model, so expectation-maximisation runs over the
counts of vote patterns, of which there are at most 3 to the number of rules, and covers all documents at every size.
A document stays if the base rules hold and its posterior probability of being fit is at least one half.

A null text counts as empty; a text without words fails the base rules.  Repeated rows are judged alike.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import common
from strata.llm.common import let

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 5
#: Base rules: fewest words, and the greatest percentage of words in repeated windows.
LEAST_WORDS, MOST_REPEATED = 10, 20
#: Expectation-maximisation: rounds; the share of fit documents among those with each vote at first; and how many times
#: its own documents this first accuracy of a vote counts afterwards, so that "unfit" goes on to mean what the rules
#: vote against and not some other split of the corpus.
ROUNDS = 50
FIRST_FIT = {-1: 0.03, 0: 0.8, 1: 0.82}
FIRST_TIMES = 2

#: Counted marks, fixed values.
SYMBOLS = r"[#*$%&|<>]"


def repeated_window_words(words: Column) -> Column:
    """How many words lie in windows of ``WINDOW`` words that occur at least twice, the first occurrence included."""

    def of_hashes(hashes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(hashes) - WINDOW)
        keys = F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + d) for d in range(WINDOW)]))
        return F.when(F.size(hashes) <= WINDOW, 0).otherwise(let(keys, of_keys))

    def of_keys(keys: Column) -> Column:
        placed = F.array_sort(F.transform(keys, lambda key, i: F.struct(key.alias("key"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), 0).otherwise(let(placed, of_sorted))

    def of_sorted(placed: Column) -> Column:
        same = lambda x, i, step: F.coalesce(F.get(placed, i + step)["key"] == x["key"], F.lit(False))
        twice = F.filter(placed, lambda x, i: same(x, i, -1) | same(x, i, 1))
        return let(F.array_sort(F.transform(twice, lambda x: x["at"])), covered)

    def covered(starts: Column) -> Column:
        # A window adds the words up to the next repeated window, all of them if that begins beyond its end.
        added = F.transform(starts, lambda at, i: F.least(F.lit(WINDOW), F.get(starts, i + 1) - at))
        return F.aggregate(added, F.lit(0), lambda total, n: total + n)

    return let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)


def measures(text: Column) -> Column:
    """A struct of what base rules and voting rules look at."""

    def of_words(words: Column) -> Column:
        lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
        return let(lines, lambda kept: F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.aggregate(words, F.lit(0).cast("long"), lambda n, w: n + F.char_length(w)).alias("word_chars"),
            F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            (F.size(kept) - F.size(F.array_distinct(kept))).cast("long").alias("n_dup_lines"),
            repeated_window_words(words).cast("long").alias("n_repeat_words"),
            F.size(kept).cast("long").alias("n_lines"),
            F.size(F.array_distinct(words)).cast("long").alias("n_distinct"),
            F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
            F.regexp_count(text, F.lit("!")).cast("long").alias("n_shouts"),
            F.regexp_count(text, F.lit(r"\|")).cast("long").alias("n_bars"),
        ))

    return let(F.filter(F.split(text, SPACE), lambda w: w != ""), of_words)


def vote(against: Column, fit: Column) -> Column:
    return F.when(against, -1).when(fit, 1).otherwise(0)


def rules(m: Column) -> dict[str, Column]:
    """Votes of the rules on measures ``m``; short texts leave most of them undecided."""
    words, chars = m["n_words"], m["word_chars"]
    enough = words >= LEAST_WORDS
    return {
        "symbols": vote(enough & (10 * m["n_symbols"] > words), 50 * m["n_symbols"] <= words),
        "capitals": vote(enough & (2 * m["n_capitals"] > chars), 5 * m["n_capitals"] < chars),
        "shouting": vote(enough & (5 * m["n_shouts"] > words), 50 * m["n_shouts"] <= words),
        "tables": vote(enough & (10 * m["n_bars"] > words), 50 * m["n_bars"] <= words),
        "repeats": vote(10 * m["n_repeat_words"] > words, 50 * m["n_repeat_words"] <= words),
        "lines": vote(10 * m["n_dup_lines"] > 3 * m["n_lines"], 20 * m["n_dup_lines"] <= m["n_lines"]),
        "variety": vote((words >= 50) & (5 * m["n_distinct"] < words), enough & (5 * m["n_distinct"] > 2 * words)),
        "length": vote(enough & ((chars < 2 * words) | (chars > 20 * words)), (chars >= 3 * words) & (chars <= 12 * words)),
    }


def base_failed(m: Column) -> Column:
    return (m["n_words"] < LEAST_WORDS) | (100 * m["n_repeat_words"] > MOST_REPEATED * m["n_words"])


def estimate(patterns: dict[tuple[int, ...], int], n_rules: int) -> tuple[float, list[dict[int, float]]]:
    """Log-odds of being fit: the prior and, for each rule, what each vote adds.  ``patterns``: documents by votes."""
    total = sum(patterns.values())
    with_vote = [{v: sum(n for votes, n in patterns.items() if votes[r] == v) for v in FIRST_FIT} for r in range(n_rules)]

    def first(r: int, v: int) -> list[float]:
        known = FIRST_TIMES * (with_vote[r][v] + 1)
        return [known * FIRST_FIT[v], known * (1 - FIRST_FIT[v])]

    def chances_of(weights: list[dict[int, list[float]]]) -> list[dict[int, tuple[float, float]]]:
        """For each rule and vote, the chances that a fit and an unfit document gets it."""
        sums = [[sum(w[c] for w in by_vote.values()) for c in (0, 1)] for by_vote in weights]
        return [{v: (w[0] / s[0], w[1] / s[1]) for v, w in by_vote.items()} for by_vote, s in zip(weights, sums, strict=True)]

    weights = [{v: first(r, v) for v in FIRST_FIT} for r in range(n_rules)]
    chances, fit_share = chances_of(weights), FIRST_FIT[0]
    for _ in range(ROUNDS if total else 0):
        weights = [{v: first(r, v) for v in FIRST_FIT} for r in range(n_rules)]
        fit_total = FIRST_TIMES * total * FIRST_FIT[0]
        for votes, n in patterns.items():
            odds = math.log(fit_share / (1 - fit_share))
            odds += sum(math.log(chances[r][v][0] / chances[r][v][1]) for r, v in enumerate(votes))
            fit = n / (1 + math.exp(-max(-700.0, min(700.0, odds))))
            fit_total += fit
            for r, v in enumerate(votes):
                weights[r][v][0] += fit
                weights[r][v][1] += n - fit
        chances, fit_share = chances_of(weights), fit_total / ((1 + FIRST_TIMES) * total)
    odds = [{v: math.log(c[0] / c[1]) for v, c in chances[r].items()} for r in range(n_rules)]
    return math.log(fit_share / (1 - fit_share)), odds


def pattern_counts(voted: DataFrame, votes: list[Column]) -> dict[tuple[int, ...], int]:
    """Documents by votes: at most 3 to the number of rules."""
    rows = voted.groupBy(*[v.alias(f"v{k}") for k, v in enumerate(votes)]).agg(F.count("*").alias("n")).collect()
    return {tuple(r)[:-1]: r["n"] for r in rows}


def posterior(votes: list[Column], prior: float, odds: list[dict[int, float]]) -> Column:
    total = F.lit(prior)
    for column, added in zip(votes, odds, strict=True):
        total = total + F.when(column == 1, added[1]).when(column == -1, added[-1]).otherwise(added[0])
    return 1 / (1 + F.exp(-total))


def judged(docs: DataFrame, columns: list[str]) -> tuple[DataFrame, Column, Column]:
    """The rows of ``docs`` with their measures, written; and columns of them: the posterior and what is kept."""
    name = common.fresh("quality_measures", docs.columns)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    staged = common.stage(docs.select(*[F.col(f"`{c}`") for c in columns], measures(text).alias(name)), "quality")
    m = F.col(name)
    votes = list(rules(m).values())
    prior, odds = estimate(pattern_counts(staged, votes), len(votes))
    fit = posterior(votes, prior, odds)
    return staged, fit, ~base_failed(m) & (fit >= 0.5)


def verdicts(docs: DataFrame) -> DataFrame:
    """Measures, base verdict, posterior and verdict of every document of ``docs`` (doc_id, text)."""
    staged, fit, kept = judged(docs.select("doc_id", "text"), ["doc_id"])
    m = F.col("quality_measures")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return staged.select(
        "doc_id", *[m[n].alias(n) for n in names], base_failed(m).alias("base_failed"), kept.alias("kept"),
        fit.alias("quality"),
    )


def keep_fit(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    staged, _, kept = judged(docs, docs.columns)
    return staged.filter(kept).select(*[F.col(f"`{c}`") for c in docs.columns])
