"""Quality rules as weak supervision.

Each rule looks at one signal of a text and votes good, bad or abstains. How far
each rule can be trusted is estimated from the votes alone: expectation-maximisation
fits, for the hidden quality, each rule's chance of calling a good text bad and of calling a bad
text bad, where it votes at all; an abstention says nothing. A text is kept when its
posterior chance of being good reaches ``threshold``, so a rule that errs is overruled.

Edge cases: a null or empty text has no words, fails the base test and is dropped;
repeated rows are scored alike; very long texts are read whole; a posterior equal to the
threshold keeps a text; an empty table gives an empty result; further
columns of the input, whatever their names, are carried as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linklake.llm.words import covered, hashes, windows, words_of

SYMBOLS = b"#*$%&|<>"
_CONTINUATION = bytes(range(0x80, 0xC0))
FALSE_ALARM = 0.01  # chance that a rule calls a good text bad, before votes are seen
STRENGTH = 1.0  # weight of that belief, in times the number of texts
SIGNALS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_lines long, n_repeat_words long, n_distinct long"


def _signals(text: bytes | None) -> tuple[int, ...]:
    words = words_of(text)
    if not words:
        return 0, 0, len(text) - len(text.translate(None, SYMBOLS)) if text else 0, 0, 0, 0, 0
    characters = len(b"".join(words).translate(None, _CONTINUATION))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip()]
    word_hashes = hashes(words)
    triples = windows(word_hashes, 3)
    repeated = 0
    if len(triples):
        _, group, counts = np.unique(triples, return_inverse=True, return_counts=True)
        starts = np.flatnonzero(counts[group] > 1)
        repeated = int(covered(starts, 3, len(words)).sum()) if len(starts) else 0
    distinct = len(np.unique(word_hashes))
    return len(words), characters, symbols, len(lines) - len(set(lines)), len(lines), repeated, distinct


def signals(text: Column) -> Column:
    """A struct of the signals of a text, given as UTF-8 bytes."""

    @F.pandas_udf(SIGNALS)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [part.split()[0] for part in SIGNALS.split(", ")]
        for texts in batches:
            yield pd.DataFrame([_signals(text) for text in texts], columns=names, dtype="int64")

    return run(text)


def base_failed(s: Column) -> Column:
    return (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])


def votes(s: Column) -> list[Column]:
    """One vote a rule: 1 good, 0 bad, -1 abstains. Ratios are compared in whole numbers."""
    words = s["n_words"]

    def rule(good: Column, bad: Column) -> Column:
        return F.when(bad, 0).when(good, 1).otherwise(-1).cast("int")

    return [
        rule(words >= 100, words < 50),
        rule(10 * s["n_repeat_words"] <= words, 100 * s["n_repeat_words"] > 40 * words),
        rule(100 * s["n_symbols"] <= 2 * words, 10 * s["n_symbols"] > 3 * words),
        rule(4 * s["n_dup_lines"] <= s["n_lines"], 2 * s["n_dup_lines"] > s["n_lines"]),
        rule((s["word_chars"] >= 3 * words) & (s["word_chars"] <= 10 * words), (s["word_chars"] < 2 * words) | (s["word_chars"] > 14 * words)),
        rule(5 * s["n_distinct"] >= words, 20 * s["n_distinct"] < words),
    ]


@dataclass(frozen=True)
class VoteModel:
    """``log_odds[rule][vote + 1]``: what a vote adds to the log-odds of good."""

    prior: float
    log_odds: tuple[tuple[float, float, float], ...]

    def posterior(self, given: list[Column]) -> Column:
        total = F.lit(float(np.log(self.prior) - np.log1p(-self.prior)))
        for weights, vote in zip(self.log_odds, given, strict=True):
            total = total + F.when(vote == 1, weights[2]).when(vote == 0, weights[1]).otherwise(weights[0])
        return 1 / (1 + F.exp(-total))


def fitted(
    patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, false_alarm: float = FALSE_ALARM, strength: float = STRENGTH
) -> VoteModel:
    """Expectation-maximisation over distinct vote patterns and how often each occurs.

    The hidden classes are named by the start: a pattern begins as bad if any rule says
    so, since texts are bad in different ways that seldom meet. For the same reason votes alone
    cannot tell a rare fault from a rule's error, so false alarms have a prior: ``false_alarm``, worth
    ``strength`` times as many texts as there are. Votes move it: a rule that the others
    contradict often enough is learnt to err. A bad vote never counts for good.
    """
    bad, good_vote = (patterns == 0).astype(float), (patterns == 1).astype(float)
    good = np.where(bad.any(1), 0.05, 0.95)
    total = counts.sum()
    for _ in range(rounds):
        of_good, of_bad = good * counts, (1 - good) * counts
        prior = np.clip((of_good.sum() + 1) / (total + 2), 0.01, 0.99)
        alarm = (of_good @ bad + false_alarm * strength * total) / (of_good @ (bad + good_vote) + strength * total)
        found = np.maximum((of_bad @ bad + 1) / (of_bad @ (bad + good_vote) + 2), alarm)
        odds = np.stack([np.zeros(len(alarm)), np.log(alarm / found), np.log((1 - alarm) / (1 - found))], axis=1)
        score = np.log(prior) - np.log1p(-prior) + bad @ odds[:, 1] + good_vote @ odds[:, 2]
        new = 1 / (1 + np.exp(-np.clip(score, -50, 50)))
        if np.abs(new - good).max() < 1e-10:
            break
        good = new
    return VoteModel(float(prior), tuple(tuple(map(float, row)) for row in odds))


def fit(votes_table: DataFrame, names: list[str]) -> VoteModel:
    """The model of a table of votes. Only pattern counts, at most 3 to the power of the
    number of rules, reach the driver."""
    rows = votes_table.groupBy(*names).count().orderBy(*names).collect()
    if not rows:
        return VoteModel(0.5, ((0.0, 0.0, 0.0),) * len(names))
    return fitted(np.array([[row[n] for n in names] for row in rows]), np.array([row["count"] for row in rows], float))


def scored(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row with its signals: columns ``row`` (the input's) and ``s``."""
    return docs.select(F.struct("*").alias("row"), signals(F.col(text).cast("binary")).alias("s"))


def vote_frame(rows: DataFrame) -> tuple[DataFrame, list[str]]:
    given = votes(F.col("s"))
    names = [f"v{i}" for i in range(len(given))]
    return rows.select(*(v.alias(n) for n, v in zip(names, given, strict=True))), names


def verdict(model: VoteModel, threshold: float = 0.5) -> tuple[Column, Column]:
    """Posterior chance of good, and whether the row is kept."""
    s = F.col("s")
    posterior = model.posterior(votes(s))
    return posterior, ~base_failed(s) & (posterior >= threshold)


def good_rows(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows that are kept, with the columns of the input."""
    model = fit(*vote_frame(docs.select(signals(F.col(text).cast("binary")).alias("s"))))
    return scored(docs, text).where(verdict(model, threshold)[1]).select("row.*")
