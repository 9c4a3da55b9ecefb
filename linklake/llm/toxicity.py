"""Toxicity by weak supervision.

1. *Voters.* Lexicons of whole words, word beginnings and word endings are mined from all
   labelled rows outside the held-out part: features that labelled toxic texts have and
   clean ones hardly ever. Each lexicon is a voter (words are dealt over several); further voters look
   at patterns: several hits, dense hits, runs of exclamation marks, shouted words.
2. *Label model.* Expectation-maximisation over the vote patterns of all rows estimates,
   for toxic and clean, how each voter votes given the voter it depends on most (a tree of
   dependencies grown from the votes), hence accuracies and correlations.
3. *Classifier.* Logistic regression on lexicon hits and pattern votes is trained on the
   posteriors of a bounded sample of rows. Its output is the score.

Labels are read only where ``train`` holds. Scores depend on the text alone.

Edge cases: a row without an id counts as held out; null and empty texts have no hits and get the score of the bias; repeated rows
get equal scores; without labelled toxic rows the lexicons are empty and every score is
low; an empty table gives an empty result; other columns are carried as they are.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linklake.llm.tables import discard, sized, stored

FIRST_ROWS = 12_000  # clean rows that features are tried on before all are counted
AT_ONCE = 100_000  # features at most that are counted over the clean rows at a time
TRAINING_ROWS = 20_000  # rows at most that the classifier is trained on
LEXICON_SIZE = 4_096  # features at most of all lexicons
LEAST_SUPPORT = 6
LEAST_PRECISION = 0.9
FALSE_ALARM = 0.001
WORD_VOTERS = 4
KINDS = ("w", "p3", "p4", "p5", "p6", "s4")
VOTERS = (*(f"w{i}" for i in range(WORD_VOTERS)), *KINDS[1:], "several", "dense", "exclaims", "shouts")
PATTERN_VOTERS = len(VOTERS) - 4  # where the pattern voters begin
LEXICON_BASED = PATTERN_VOTERS + 2  # voters that depend on lexicon hits
THRESHOLD = 0.7
_CORE = re.compile(r"\w+")
_EXCLAIMS = re.compile(rb"!{3,}")
_SHOUTS = re.compile(rb"\b[A-Z]{4,}\b")
KEPT_WORDS = 120_000
KEPT_FEATURES = 250_000


def word_features(word: bytes) -> tuple[str, ...]:
    """Features of the words inside one white-space word."""
    found = []
    for core in _CORE.findall(word.decode("utf-8", "replace").lower()):
        found.append(f"w {core}")
        found.extend(f"p{n} {core[:n]}" for n in (3, 4, 5, 6) if len(core) > n)
        if len(core) > 4:
            found.append(f"s4 {core[-4:]}")
    return tuple(found)


def held_out(ident: Column) -> Column:
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def _mined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per task and feature: texts that have it."""
    counts: Counter = Counter()

    def flushed() -> pd.DataFrame:
        found = pd.DataFrame({"feature": list(counts.keys()), "texts": list(counts.values())})
        counts.clear()
        return found

    for batch in batches:
        for text in batch["text"]:
            words = set(text.split()) if text else ()
            counts.update({f for w in words for f in word_features(w)})
            if len(counts) >= KEPT_FEATURES:
                yield flushed()
    if counts:
        yield flushed()


def _hit(features: list[str]):
    """The places of features that a text has, with the text's digest; nothing for texts without one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hits = _Hits({f: i for i, f in enumerate(features)})
        for batch in batches:
            rows = []
            for text in batch["text"]:
                places = sorted({p for w in set(text.split()) for p in hits[w]}) if text else []
                if places:
                    rows.append((xxhash.xxh3_128_digest(text), np.array(places, np.int32)))
            yield pd.DataFrame(rows, columns=["digest", "places"])

    return run


def _texts_with(rows: DataFrame, name: str) -> DataFrame:
    """Per feature: distinct texts of the rows that have it. Copies are one piece of evidence."""
    counts = rows.select("text").distinct().mapInPandas(_mined, "feature string, texts long")
    return counts.groupBy("feature").agg(F.sum("texts").alias(name))


def lexicon(docs: DataFrame, labels: DataFrame, ident: str = "doc_id", text: str = "text", rows: int = FIRST_ROWS, at_once: int = AT_ONCE) -> list[str]:
    """Features that mark toxic texts, from all labelled rows outside the held-out part.

    Features of enough toxic texts are tried on ``rows`` clean rows first, which rules out
    those that are too common already there. The rest are counted over all clean rows,
    ``at_once`` at a time from the best possible rank down, until no other can enter.
    """
    known = labels.where(~held_out(F.col(ident)) & F.col("toxic").isNotNull())
    known = stored(known.select(ident, (F.col("toxic") == 1).alias("is_toxic")).distinct(), "known")
    texts = docs.select(ident, F.col(text).cast("binary").alias("text"))
    toxic = texts.join(sized(known.where("is_toxic").select(ident)), ident)
    clean_ids = known.where("not is_toxic").select(ident)
    clean = texts.join(sized(clean_ids), ident)
    first = texts.join(F.broadcast(clean_ids.orderBy(F.xxhash64(ident), ident).limit(rows)), ident)  # rows ids at most
    tried = _texts_with(toxic, "toxic").where(F.col("toxic") >= LEAST_SUPPORT).join(_texts_with(first, "clean"), "feature", "left")
    tried = tried.select("feature", "toxic", F.coalesce("clean", F.lit(0)).alias("clean"))
    tried = tried.where(F.col("toxic") >= LEAST_PRECISION * (F.col("toxic") + F.col("clean")))
    tried = stored(tried.select("feature", "toxic", (F.col("toxic") - 9 * F.col("clean")).alias("most")), "tried")
    best: list[tuple[int, str]] = []
    left = tried
    while True:
        chunk = left.orderBy(F.desc("most"), "feature").limit(at_once).collect()
        if not chunk:
            break
        hits = clean.select("text").mapInPandas(_hit([r["feature"] for r in chunk]), "digest binary, places array<int>")
        counts = hits.distinct().select(F.explode("places").alias("place")).groupBy("place").count().collect()
        having = {r["place"]: r["count"] for r in counts}
        for place, r in enumerate(chunk):
            if r["toxic"] >= LEAST_PRECISION * (r["toxic"] + having.get(place, 0)):
                best.append((9 * having.get(place, 0) - r["toxic"], r["feature"]))
        best = sorted(best)[:LEXICON_SIZE]
        last = chunk[-1]
        if len(chunk) < at_once or (len(best) == LEXICON_SIZE and -best[-1][0] > last["most"]):
            break
        left = tried.where((F.col("most") < last["most"]) | ((F.col("most") == last["most"]) & (F.col("feature") > F.lit(last["feature"]))))
    discard(known, tried)
    return [feature for _, feature in best]


class _Hits(dict):
    """White-space word to the lexicon places it hits; emptied when full."""

    def __init__(self, places: dict[str, int]):
        super().__init__()
        self.places = places

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= KEPT_WORDS:
            self.clear()
        value = self[word] = tuple(self.places[f] for f in word_features(word) if f in self.places)
        return value


def _voter_of(feature: str) -> int:
    kind, word = feature.split(" ", 1)
    if kind == "w":
        return zlib.crc32(word.encode()) % WORD_VOTERS
    return WORD_VOTERS - 1 + KINDS.index(kind)


class Voters:
    """Hits and votes of a text under a fixed lexicon."""

    def __init__(self, features: list[str]):
        self.hits = _Hits({f: i for i, f in enumerate(features)})
        self.voter = [_voter_of(f) for f in features]
        self.is_word = [f.startswith("w ") for f in features]

    def __call__(self, text: bytes | None) -> tuple[list[int], list[int]]:
        """Distinct lexicon places, and one vote a voter: 1 toxic, 0 clean, -1 abstains."""
        words = text.split() if text else []
        if not words:
            return [], [-1] * len(VOTERS)
        found = [h for h in map(self.hits.__getitem__, words) if h]
        places = sorted({place for hit in found for place in hit})
        votes = [0] * PATTERN_VOTERS
        for place in places:
            votes[self.voter[place]] = 1
        several = 1 if len(found) > 1 else -1 if found else 0
        dense = 1 if 100 * len(found) >= len(words) else -1 if found else 0
        exclaims = 1 if _EXCLAIMS.search(text) else -1
        shouts = 1 if len(_SHOUTS.findall(text)) > 2 else -1
        return places, [*votes, several, dense, exclaims, shouts]


def _looked_at(features: list[str]):
    @F.pandas_udf("hits array<int>, votes array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        voters = Voters(features)
        for texts in batches:
            rows = [voters(t) for t in texts]
            yield pd.DataFrame({"hits": [np.array(r[0], np.int32) for r in rows], "votes": [np.array(r[1], np.int32) for r in rows]})

    return run


def looked_at(text: Column, features: list[str]) -> Column:
    """A struct of a text's lexicon hits and votes."""
    return _looked_at(features)(text.cast("binary"))


def _tree(patterns: np.ndarray, weights: np.ndarray) -> list[int]:
    """Each voter's parent (-1: none): the spanning tree of the greatest mutual information
    between voters given the class. ``weights``: class, pattern."""
    voters = patterns.shape[1]
    shown = np.stack([patterns == v for v in (-1, 0, 1)], axis=2).astype(float)
    gain = np.zeros((voters, voters))
    for own in weights:
        total = max(own.sum(), 1e-9)
        joint = np.einsum("p,piv,pjw->ijvw", own, shown, shown) / total
        single = np.einsum("p,piv->iv", own, shown) / total
        apart = single[:, None, :, None] * single[None, :, None, :]
        with np.errstate(divide="ignore", invalid="ignore"):
            gain += total * np.where(joint > 0, joint * np.log(joint / np.maximum(apart, 1e-300)), 0).sum((2, 3))
    parent, best, inside = [-1] * voters, [0] * voters, {0}
    while len(inside) < voters:
        new = max((j for j in range(voters) if j not in inside), key=lambda j: (gain[best[j], j], -j))
        parent[new] = best[new] if gain[best[new], new] > 0 else -1
        inside.add(new)
        for j in range(voters):
            if j not in inside and gain[new, j] > gain[best[j], j]:
                best[j] = new
    return parent


def posteriors(patterns: np.ndarray, counts: np.ndarray, rounds: int = 40) -> np.ndarray:
    """Chance of toxic for each vote pattern, from how often each occurs."""
    toxic_votes = (patterns[:, :LEXICON_BASED] == 1).sum(1)
    chance = np.where(toxic_votes > 1, 0.95, np.where(toxic_votes == 1, 0.6, 0.02))
    codes = patterns + 1
    total, every = counts.sum(), range(patterns.shape[1])
    parent: list[int] = []
    for turn in range(rounds):
        weights = np.stack([(1 - chance) * counts, chance * counts])
        if turn < 3:
            parent = _tree(patterns, weights)
        prior = np.clip((weights.sum(1) + 1) / (total + 2), 1e-3, 1 - 1e-3)
        score = np.log(prior)[:, None] + np.zeros((2, len(counts)))
        for j in every:
            above = codes[:, parent[j]] if parent[j] >= 0 else np.zeros(len(codes), int)
            for y in (0, 1):
                table = np.bincount(above * 3 + codes[:, j], weights[y], 9).reshape(3, 3)
                backed = (table.sum(0) + 0.5) / (table.sum() + 1.5)  # thin rows lean on the voter's own rate
                table = (table + 2 * backed) / (table.sum(1, keepdims=True) + 2)
                if y == 0 and j < LEXICON_BASED:  # these seldom call a clean text toxic, unless the parent did
                    table[:2, 2] = np.minimum(table[:2, 2], FALSE_ALARM)
                score[y] += np.log(table[above, codes[:, j]])
        new = 1 / (1 + np.exp(np.clip(score[0] - score[1], -50, 50)))
        if np.abs(new - chance).max() < 1e-6:
            return new
        chance = new
    return chance


@dataclass(frozen=True)
class Classifier:
    features: list[str]
    bias: float
    weights: list[float]  # of the lexicon features, then of pattern votes for toxic

    def score(self, seen: Column) -> Column:
        """Chance of toxic from a struct that ``looked_at`` made."""
        weights = F.array(*map(F.lit, self.weights)) if len(self.weights) < 16 else F.from_json(F.lit(str(self.weights)), "array<double>")
        total = F.aggregate(seen["hits"], F.lit(self.bias), lambda t, place: t + F.element_at(weights, place + 1))
        for i in range(PATTERN_VOTERS, len(VOTERS)):
            own = self.weights[len(self.features) + i - PATTERN_VOTERS]
            total = total + F.when(seen["votes"][i] == 1, own).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def _fitted(rows: list[tuple[list[int], float]], size: int, rounds: int = 400, ridge: float = 0.5) -> tuple[float, np.ndarray]:
    """Logistic regression of soft labels on sets of places, by scaled gradient steps."""
    flat = np.array([p for places, _ in rows for p in places], int)
    row = np.repeat(np.arange(len(rows)), [len(places) for places, _ in rows])
    target = np.array([t for _, t in rows])
    rate = np.clip(target.mean() if len(target) else 0.01, 0.001, 0.999)
    bias, weights = float(np.log(rate / (1 - rate))), np.zeros(size)
    seen = np.bincount(flat, minlength=size)
    each = np.bincount(row, minlength=len(rows)) + 1.0  # steps shrink with the places a row has
    scale = np.bincount(flat, each[row], minlength=size) * 0.25 + ridge
    bias_scale = each.sum() * 0.25 + 1e-9
    for _ in range(rounds if len(rows) else 0):
        wrong = target - 1 / (1 + np.exp(-(bias + np.bincount(row, weights[flat], len(rows)))))
        bias += wrong.sum() / bias_scale
        weights += (np.bincount(flat, wrong[row], size) - ridge * weights) / scale
    return bias, np.where(seen > 0, weights, 0.0)


def trained(rows: DataFrame, features: list[str], limit: int = TRAINING_ROWS) -> Classifier:
    """The classifier of rows (``ident``, ``seen``). Vote patterns are counted over all
    rows; their number is bounded by what the voters can say, not by the rows."""
    patterns = rows.groupBy(F.col("seen.votes").alias("votes")).count().orderBy("votes").collect()
    size = len(features) + len(VOTERS) - PATTERN_VOTERS
    if not patterns:
        return Classifier(features, -5.0, [0.0] * size)
    votes = np.array([p["votes"] for p in patterns])
    chance = posteriors(votes, np.array([p["count"] for p in patterns], float))
    known = {tuple(v): float(c) for v, c in zip(votes.tolist(), chance, strict=True)}
    sample = rows.where(~held_out(F.col("ident"))).orderBy(F.xxhash64("ident"), "ident").limit(limit).select("seen").collect()
    given = []
    for r in sample:
        cast = r["seen"]["votes"]
        extra = [len(features) + i - PATTERN_VOTERS for i in range(PATTERN_VOTERS, len(VOTERS)) if cast[i] == 1]
        given.append(([*r["seen"]["hits"], *extra], known[tuple(cast)]))
    bias, weights = _fitted(given, size)
    return Classifier(features, bias, weights.tolist())


def clean_rows(docs: DataFrame, labels: DataFrame, ident: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score below the threshold, with the columns of the input."""
    features = lexicon(docs, labels, ident, text)
    model = trained(docs.select(F.col(ident).alias("ident"), looked_at(F.col(text), features).alias("seen")), features)
    rows = docs.select(F.struct("*").alias("row"), looked_at(F.col(text), features).alias("seen"))
    return rows.where(model.score(F.col("seen")) < threshold).select("row.*")
