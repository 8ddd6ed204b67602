"""Weak supervision of document quality: rules vote, expectation-maximisation weighs the votes.

Each rule looks at a few counts of the text and votes good, bad or abstains.
The votes on all documents that no hard rule fails are counted by pattern (with R rules at most 3^R
rows, whatever the corpus). Expectation-maximisation over these rows estimates how often each
rule votes each way for good and for bad documents, and the share of good
ones. A document is kept when its posterior probability of being good is at
least ``THRESHOLD``, unless a hard rule fails it.

Everything is built of DataFrame functions; only fitted numbers, one row per
round, reach the driver.

Defined cases: a null or empty text has no words, fails the hard rule and is
not kept. Repeated rows get repeated results and count once each. Other columns
are ignored (or kept, by ``keep_good``). An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedfold.llm.common import landed

SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LINE_ENDS = [".", "!", "?", "…", '"', "”", "»", ":", ";", "。"]
#: Frequent small words of English, French, Spanish and German.
SMALL_WORDS = (
    "the of and to in a is that it was for on are as with be at by this have from or an "
    "le la les de des du et un une est que en dans au pour par sur "
    "el los las y del se no con lo su "
    "der die das und zu den von ist mit ein eine nicht im auf für"
).split()

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
THRESHOLD = 0.5
ROUNDS = 12
#: Strength of the prior that rules vote rightly, as a share of the corpus.
PRIOR_SHARE = 0.02
GOOD, BAD, ABSTAIN = 1, -1, 0


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Each row as struct ``row``, with the counts of its text beside it."""
    steps = [
        {"text": F.coalesce(F.col("text"), F.lit(""))},
        {
            "words": F.array_remove(F.split("text", SPACE), ""),
            "lines": F.filter(F.split("text", "\n"), lambda x: F.translate(x, SPACES, "") != ""),
            "word_chars": F.length(F.translate("text", SPACES, "")).cast("long"),
            "n_symbols": (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long"),
            "n_capitals": (F.length("text") - F.length(F.translate("text", CAPITALS, ""))).cast("long"),
        },
        {
            "n_words": F.size("words").cast("long"),
            "n_lines": F.size("lines").cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            "n_ended": F.size(F.filter("lines", lambda x: F.substring(F.rtrim(x), -1, 1).isin(LINE_ENDS))).cast("long"),
            "n_small": F.size(F.filter("words", lambda w: F.lower(w).isin(SMALL_WORDS))).cast("long"),
            # hash and place of each window of three words, by hash
            "windows": F.expr(
                "sort_array(slice(transform(words, (w, i) -> struct(xxhash64(w, get(words, i + 1), get(words, i + 2))"
                " AS h, i AS i)), 1, greatest(size(words) - 2, 0)))"
            ),
        },
        {
            # places of windows that occur more than once, in order of the text
            "repeats": F.expr(
                "sort_array(filter(transform(windows, (x, k) -> CASE WHEN x.h = get(windows, k - 1).h"
                " OR x.h = get(windows, k + 1).h THEN x.i END), i -> i IS NOT NULL))"
            )
        },
        {
            "n_repeat_words": F.expr(
                "aggregate(repeats, named_struct('n', 0L, 'last', -3), (a, i) -> named_struct("
                "'n', a.n + least(3, i - a.last), 'last', i), a -> a.n)"
            )
        },
    ]
    rows = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    for step in steps:
        rows = rows.withColumns(step)
    return rows.select(
        "row",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed(F.col("n_words"), F.col("n_repeat_words")).alias("base_failed"),
        F.array(*votes()).alias("votes"),
    )


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def ballot(bad: Column, good: Column) -> Column:
    return F.when(bad, BAD).when(good, GOOD).otherwise(ABSTAIN)


def share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def votes() -> list[Column]:
    """One vote per rule: +1 good, -1 bad, 0 abstains."""
    words, length = F.col("n_words"), share("word_chars", "n_words")
    symbols, repeated = share("n_symbols", "n_words"), share("n_repeat_words", "n_words")
    doubled, capitals = share("n_dup_lines", "n_lines"), share("n_capitals", "word_chars")
    ended, small = share("n_ended", "n_lines"), share("n_small", "n_words")
    return [
        ballot(words < MIN_WORDS, words >= 2 * MIN_WORDS),
        ballot((length < 3) | (length > 12), (length >= 3.5) & (length <= 8)),
        ballot(symbols > 0.1, symbols < 0.01),
        ballot(repeated > 0.3, repeated < 0.1),
        ballot(doubled > 0.3, doubled < 0.1),
        ballot(capitals > 0.3, capitals < 0.1),
        ballot(ended < 0.2, ended > 0.7),
        ballot(small < 0.01, small > 0.08),
    ]


N_RULES = 8


class Verdict:
    """Fitted model: the share of good documents and how each rule votes for either class."""

    def __init__(self, good: float, rates: list[dict[int, tuple[float, float]]]):
        self.good, self.rates = good, rates

    @classmethod
    def prior(cls) -> Verdict:
        # a bad document fails some rules and passes most; a good one seldom fails any
        rates = [{GOOD: (0.88, 0.6), BAD: (0.02, 0.3), ABSTAIN: (0.1, 0.1)} for _ in range(N_RULES)]
        return cls(0.8, rates)

    def posterior(self, votes: Column) -> Column:
        """Probability of being good, given the array of votes."""
        odds = F.lit(math.log(self.good / (1 - self.good)))
        for rule, rate in enumerate(self.rates):
            vote, weight = F.get(votes, F.lit(rule)), {v: math.log(g / b) for v, (g, b) in rate.items()}
            odds += F.when(vote == GOOD, weight[GOOD]).when(vote == BAD, weight[BAD]).otherwise(weight[ABSTAIN])
        return 1 / (1 + F.exp(-odds))


def fit(patterns: DataFrame, rounds: int = ROUNDS) -> Verdict:
    """Expectation-maximisation over (votes, n), a table of at most 3^R rows; one row a round is fetched."""
    model = Verdict.prior()
    for _ in range(rounds):
        good, n = F.col("n") * F.col("good"), F.col("n")
        sums = [F.sum(n).alias("n"), F.sum(good).alias("good")]
        for rule in range(N_RULES):
            for vote in (GOOD, BAD, ABSTAIN):
                hit = F.get("votes", F.lit(rule)) == vote
                sums.append(F.sum(F.when(hit, good).otherwise(0.0)).alias(f"g{rule}_{vote}"))
                sums.append(F.sum(F.when(hit, n - good).otherwise(0.0)).alias(f"b{rule}_{vote}"))
        row = patterns.withColumn("good", model.posterior(F.col("votes"))).agg(*sums).first()
        if not row["n"]:
            return model
        extra, start = PRIOR_SHARE * row["n"] + 1, Verdict.prior()
        bad = row["n"] - row["good"]
        rates = [
            {
                vote: (
                    (row[f"g{rule}_{vote}"] + extra * start.rates[rule][vote][0]) / (row["good"] + extra),
                    (row[f"b{rule}_{vote}"] + extra * start.rates[rule][vote][1]) / (bad + extra),
                )
                for vote in (GOOD, BAD, ABSTAIN)
            }
            for rule in range(N_RULES)
        ]
        model = Verdict((row["good"] + extra * start.good) / (row["n"] + extra), rates)
    return model


def patterns_of(rows: DataFrame) -> DataFrame:
    """Vote patterns of the documents that the hard rule leaves to the votes, counted."""
    counted = landed(rows.groupBy("base_failed", "votes").agg(F.count("*").alias("n")), "vote_patterns")
    return counted.where(~F.col("base_failed"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its id, counts, base verdict, posterior and verdict; texts are read once."""
    rows = measured(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text")
    rows = landed(rows.withColumn("doc_id", F.col("row.doc_id")).drop("row"), "quality_counts")
    posterior = fit(patterns_of(rows)).posterior(F.col("votes"))
    return rows.withColumn("posterior", posterior).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= THRESHOLD))


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows that are kept, with their own columns; they are written down with their votes, and texts are counted once."""
    rows = landed(measured(docs, text_col).select("row", "base_failed", "votes"), "quality_rows")
    posterior = fit(patterns_of(rows)).posterior(F.col("votes"))
    return rows.where(~F.col("base_failed") & (posterior >= THRESHOLD)).select("row.*")
