"""Quality rules as weak supervision.

Rules vote "good", vote "bad" or abstain. Expectation-maximisation over the vote patterns of all documents within
the base limits estimates how often each rule is right in either class; a document stays if its posterior probability of
being good is high enough. The range in which a rule's errors on good documents are looked for is narrow (``ON_GOOD``): each
kind of bad document offends few rules, most often one, and with wide ranges the estimates take such offences for noise. So
a bad vote is outweighed only where the fit finds the rule weak on bad documents, and mostly it rejects. The two base limits
(too few words, mostly repeated passages) always do.

All of it is DataFrame functions. The vote patterns are counted by Spark; there are at most 3 to the power of the
number of rules, whatever the corpus holds, and each round of expectation-maximisation is one aggregate over them.

Null and empty texts have no words and fail the base limits. Rows are judged one by one: repeated rows get equal
verdicts, a null doc_id is no obstacle, further columns are left alone. A table without rows gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratescope.llm.common import words_of, write_stage

MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
WINDOW = 8
SYMBOLS = "#*$%&|<>"
KEEP_AT = 0.5
#: Ranges of the estimates. A rule seldom speaks against a good document, and each kind of bad document offends only
#: some rules; without these ranges the two classes could settle on some other split of the corpus.
ON_GOOD, START_ON_GOOD = (0.999, 0.9999), 0.999
ON_BAD, START_ON_BAD = (0.1, 0.95), 0.4
ROUNDS = 20

FEATURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_lower", "n_exclaim", "n_distinct",
)


def _count_of(text: Column, characters: str) -> Column:
    """How many characters of the text are among ``characters``."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def with_features(docs: DataFrame) -> DataFrame:
    """``docs`` with a struct ``_q`` of counts per row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.withColumn("_q_words", words_of(F.col("text")))
    df = df.withColumn("_q_word_keys", F.transform("_q_words", lambda w: F.xxhash64(w)))
    n = F.size("_q_words")
    df = df.withColumn(
        "_q_windows",
        F.when(
            n >= WINDOW,
            F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("_q_word_keys", i, WINDOW))),
        ),
    )
    repeats = F.size(F.array_distinct("_q_windows")) < F.size("_q_windows")
    df = df.withColumn(
        "_q_ranked",
        F.when(repeats, F.sort_array(F.transform("_q_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
    )
    same = lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
    twice = F.filter(
        "_q_ranked",
        lambda x, i: same(F.get("_q_ranked", i - 1), x) | same(F.get("_q_ranked", i + 1), x),
    )
    df = df.withColumn("_q_starts", F.sort_array(F.transform(twice, lambda x: x["i"])))
    covered = F.aggregate(
        F.transform("_q_starts", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("_q_starts", i + 1) - p, F.lit(WINDOW)))),
        F.lit(0),
        lambda total, x: total + x,
    )
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumn("_q_lines", lines)
    counts = F.struct(
        n.cast("long").alias("n_words"),
        F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        _count_of(text, SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_q_lines").cast("long").alias("n_lines"),
        F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
        F.length(F.regexp_replace(text, r"[^\p{Ll}]+", "")).cast("long").alias("n_lower"),
        _count_of(text, "!").cast("long").alias("n_exclaim"),
        F.size(F.array_distinct("_q_word_keys")).cast("long").alias("n_distinct"),
    )
    scratch = ["_q_words", "_q_word_keys", "_q_windows", "_q_ranked", "_q_starts", "_q_lines"]
    # As the output of a generator the counts are computed once per row; a filter on plain columns would be pushed below
    # them and repeat the whole computation for each mention.
    kept = [F.col(f"`{c}`") for c in df.columns if c not in scratch]
    return df.select(*kept, F.explode(F.array(counts)).alias("_q"))


def base_failed(q: Column) -> Column:
    return (q["n_words"] < MIN_WORDS) | (100 * q["n_repeat_words"] > MAX_REPEATED_PERCENT * q["n_words"])


def _vote(value: Column, good: Column, bad: Column) -> Column:
    return F.when(value.isNull(), 0).when(bad, -1).when(good, 1).otherwise(0)


def votes(q: Column) -> dict[str, Column]:
    """1 good, -1 bad, 0 abstains. A rule abstains in the range where the measure says little."""
    words = F.nullif(q["n_words"], F.lit(0))
    ratio = lambda part, whole: part / whole
    symbols = ratio(q["n_symbols"], words)
    shouting = ratio(q["n_upper"], F.nullif(q["n_upper"] + q["n_lower"], F.lit(0)))
    exclaims = ratio(q["n_exclaim"], words)
    repeated = ratio(q["n_repeat_words"], words)
    doubled = ratio(q["n_dup_lines"], F.nullif(q["n_lines"], F.lit(0)))
    variety = ratio(q["n_distinct"], F.sqrt(words))
    width = ratio(q["word_chars"], words)
    return {
        "symbols": _vote(symbols, symbols <= 0.02, symbols >= 0.2),
        "shouting": _vote(shouting, shouting <= 0.15, shouting >= 0.5),
        "exclaims": _vote(exclaims, exclaims <= 0.02, exclaims >= 0.2),
        "repeated": _vote(repeated, repeated <= 0.1, repeated >= 0.3),
        "doubled": _vote(doubled, doubled <= 0.1, doubled >= 0.5),
        "variety": _vote(variety, variety >= 3.0, variety <= 1.5),
        "width": _vote(width, (width >= 3.0) & (width <= 8.0), (width <= 2.2) | (width >= 12.0)),
        "length": _vote(words, words >= 40, F.lit(False)),
    }


@dataclass(frozen=True)
class LabelModel:
    """Share of good documents, and per rule how often it is right on good and on bad ones when it votes."""

    prior: float
    right_on_good: dict[str, float]
    right_on_bad: dict[str, float]

    def posterior(self, vote: dict[str, Column]) -> Column:
        """Probability of being good."""
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for rule, column in vote.items():
            good, bad = self.right_on_good[rule], self.right_on_bad[rule]
            odds = odds + (
                F.when(column == 1, math.log(good / (1 - bad))).when(column == -1, math.log((1 - good) / bad)).otherwise(0.0)
            )
        return 1 / (1 + F.exp(-odds))


def start_model(rules: list[str]) -> LabelModel:
    return LabelModel(0.8, dict.fromkeys(rules, START_ON_GOOD), dict.fromkeys(rules, START_ON_BAD))


def _held(share: float, low: float, high: float) -> float:
    """Rounded, so that the order in which floating-point sums were added does not show in later runs."""
    return round(min(max(share, low), high), 6)


def fit_label_model(votes_table: DataFrame, rules: list[str], rounds: int = ROUNDS) -> LabelModel:
    """Expectation-maximisation over counted vote patterns; ``votes_table`` has one column per rule."""
    patterns = write_stage(votes_table.groupBy(*rules).agg(F.count("*").alias("n")), "vote-patterns").coalesce(1)
    model = start_model(rules)
    for _ in range(rounds):
        vote = {r: F.col(r) for r in rules}
        weighed = patterns.withColumn("good", F.col("n") * model.posterior(vote)).withColumn("bad", F.col("n") - F.col("good"))
        sums = [F.sum("good").alias("good"), F.sum("bad").alias("bad")]
        for r in rules:
            sums += [
                F.sum(F.when(F.col(r) == 1, F.col("good"))).alias(f"{r}_1g"),
                F.sum(F.when(F.col(r) != 0, F.col("good"))).alias(f"{r}_g"),
                F.sum(F.when(F.col(r) == -1, F.col("bad"))).alias(f"{r}_1b"),
                F.sum(F.when(F.col(r) != 0, F.col("bad"))).alias(f"{r}_b"),
            ]
        got = {k: v or 0.0 for k, v in weighed.agg(*sums).first().asDict().items()}
        total = got["good"] + got["bad"]
        if not total:
            break
        new = LabelModel(
            _held(got["good"] / total, 0.05, 0.95),
            {r: _held((got[f"{r}_1g"] + 10 * START_ON_GOOD) / (got[f"{r}_g"] + 10), *ON_GOOD) for r in rules},
            {r: _held((got[f"{r}_1b"] + 10 * START_ON_BAD) / (got[f"{r}_b"] + 10), *ON_BAD) for r in rules},
        )
        if new == model:
            break
        model = new
    return model


def judge(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the counts, votes, base_failed, posterior and kept."""
    counted = write_stage(with_features(docs.select("doc_id", "text")).select("doc_id", "_q.*"), "quality-counts")
    q = F.struct(*FEATURES)
    counted = counted.withColumn("_q", q)
    vote = votes(F.col("_q"))
    rules = list(vote)
    voted = counted.withColumns(vote)
    model = fit_label_model(voted.where(~base_failed(F.col("_q"))).select(*rules), rules)
    failed = base_failed(F.col("_q"))
    verdict = voted.withColumn("base_failed", failed).withColumn("posterior", model.posterior({r: F.col(r) for r in rules}))
    return verdict.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= KEEP_AT)).drop("_q")


def keep_good(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` that the rules keep, with the same columns.

    The counts of all rows train the label model first; the verdict is then computed next to the text in one more
    pass, so no text is shuffled.
    """
    featured = with_features(docs)
    vote = votes(F.col("_q"))
    rules = list(vote)
    only_text = with_features(docs.select("text"))
    within = only_text.where(~base_failed(F.col("_q")))
    model = fit_label_model(within.select(*[c.alias(r) for r, c in votes(F.col("_q")).items()]), rules)
    good = ~base_failed(F.col("_q")) & (model.posterior(vote) >= KEEP_AT)
    return featured.where(good).select(*[F.col(f"`{c}`") for c in docs.columns])
