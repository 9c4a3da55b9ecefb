"""Repeated passages, found level by level.

A passage is a run of ``length`` words that starts at two places or more. The first
level looks at runs of half that length, and only at anchors: of all runs that begin
inside one full window, the one with the smallest hash. Equal windows have equal
anchors, so a window whose anchor occurs once cannot repeat. Anchors that repeat are
extended to windows of twice the length, which are counted by 128-bit hashes. The
doubling ends at ``length``: a longer repeated run is covered by its windows.

Texts that occur more than once are settled first, by hashes of whole texts: they repeat
from end to end, and one of them stands for all when other texts are judged.

Rows travel as hashes and places. Counts are partial before the shuffle; the places
are matched by a join whose hot keys adaptive execution splits.

Edge cases: a null or empty text has no words and keeps the hash of an empty string;
texts shorter than ``length`` lose nothing; rows with equal texts repeat each other;
ids may be null or repeat (a row is known by its id and a hash of its text, and equal rows
get equal answers); an empty table gives an empty result; other columns are ignored
by ``removals`` and carried by ``without_repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linklake.llm.tables import discard, sized, stored
from linklake.llm.words import covered, hashes, windows, words_of

BATCH_ROWS = 200_000
WHOLE = -1


def anchor_places(word_hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each full window its anchor's place, and the hash of each half-length run."""
    half = (length + 1) // 2
    runs = windows(word_hashes, half)
    span = length - half + 1  # runs that begin inside one full window
    count = len(word_hashes) - length + 1
    # Sliding minimum by doubling; equal hashes inside a window: the leftmost place.
    best, place, done = runs, np.arange(len(runs)), 1

    def lower(shift: int, best, place):
        take = best[shift:] < best[:-shift]
        return np.where(take, best[shift:], best[:-shift]), np.where(take, place[shift:], place[:-shift])

    while 2 * done <= span:
        best, place = lower(done, best, place)
        done *= 2
    if done < span:
        best, place = lower(span - done, best, place)
    return place[:count], runs


def _keys(frame: DataFrame, ident: str, text: str) -> DataFrame:
    """Rows as (row_key, text). The key depends on content only, so that a task that
    runs again, or a second scan, gives the same one."""
    return frame.select(F.xxhash64(F.col(ident), F.col(text)).alias("row_key"), F.col(text).cast("binary").alias("text"))


def _flushed(columns: list[list[np.ndarray]], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame({n: np.concatenate(c) if c else np.empty(0, np.int64) for n, c in zip(names, columns, strict=True)})


def _anchors(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held, size = [[], []], 0
            for key, text in zip(batch["row_key"], batch["text"], strict=True):
                word_hashes = hashes(words_of(text))
                if len(word_hashes) < length:
                    continue
                place, runs = anchor_places(word_hashes, length)
                values = runs[np.unique(place)].view(np.int64)
                held[0].append(values)
                held[1].append(np.full(len(values), key, np.int64))
                size += len(values)
                if size >= BATCH_ROWS:
                    yield _flushed(held, ["h", "row_key"])
                    held, size = [[], []], 0
            yield _flushed(held, ["h", "row_key"])

    return run


def _windows(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["h1", "h2", "row_key", "place"]
        for batch in batches:
            held, size = [[], [], [], []], 0
            for key, text, found in zip(batch["row_key"], batch["text"], batch["found"], strict=True):
                word_hashes = hashes(words_of(text))
                place, runs = anchor_places(word_hashes, length)
                again = np.isin(runs.view(np.int64), np.asarray(found, np.int64))
                starts = np.flatnonzero(again[place])
                for column, values in zip(held, (
                    windows(word_hashes, length, 0)[starts].view(np.int64),
                    windows(word_hashes, length, 1)[starts].view(np.int64),
                    np.full(len(starts), key, np.int64),
                    starts,
                ), strict=True):
                    column.append(values)
                size += len(starts)
                if size >= BATCH_ROWS:
                    yield _flushed(held, names)
                    held, size = [[], [], [], []], 0
            yield _flushed(held, names)

    return run


def repeated_places(docs: DataFrame, ident: str, text: str, length: int) -> DataFrame:
    """(row_key, places): where a window of ``length`` words starts that also starts elsewhere;
    the place WHOLE stands for every one."""
    rows = _keys(docs, ident, text)
    keyed = stored(rows.select("row_key", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2")), "texts")
    copies = keyed.groupBy("t1", "t2").agg(F.count("*").alias("n"), F.min("row_key").alias("first")).where("n > 1")
    copied = stored(copies.select("t1", "t2", "first"), "copied")
    copies = stored(keyed.join(sized(copied), ["t1", "t2"]).select("row_key", "first").distinct(), "copies")
    others = stored(copies.where("row_key <> first").select("row_key"), "others")
    rows = rows.join(sized(others), "row_key", "left_anti")
    anchors = rows.mapInPandas(_anchors(length), "h long, row_key long")
    # A run that is an anchor of one row only once may still repeat inside that row:
    # anchors are distinct places, so counting rows counts places.
    # Stored first: a join with a table, not an aggregate, has its hot keys split.
    repeated = stored(anchors.groupBy("h").count().where("count > 1").select("h"), "repeated")
    found = stored(
        anchors.join(sized(repeated), "h")
        .groupBy("row_key")
        .agg(F.collect_set("h").alias("found")),  # bounded by one text's length
        "anchors",
    )
    some = rows.join(sized(found.select("row_key")), "row_key", "left_semi")
    level = stored(
        some.join(found.hint("shuffle_hash"), "row_key").mapInPandas(_windows(length), "h1 long, h2 long, row_key long, place int"),
        "windows",
    )
    discard(keyed, copied, repeated, found)
    again = stored(level.groupBy("h1", "h2").count().where("count > 1").select("h1", "h2"), "again")
    places = level.join(sized(again), ["h1", "h2"]).groupBy("row_key").agg(F.collect_set("place").alias("places"))
    whole = copies.select("row_key", F.array(F.lit(WHOLE)).alias("places"))
    places = stored(places.join(whole.select("row_key"), "row_key", "left_anti").union(whole), "places")
    discard(copies, others, level, again)
    return places


def _kept(text: bytes | None, places, length: int) -> tuple[list[bytes], int]:
    """Kept words and how many were removed."""
    words = words_of(text)
    if places is None or not len(places):
        return words, 0
    if places[0] == WHOLE:
        return ([], len(words)) if len(words) >= length else (words, 0)
    gone = covered(np.asarray(places, np.int64), length, len(words))
    return [w for w, g in zip(words, gone.tolist(), strict=True) if not g], int(gone.sum())


def _digests(length: int):
    @F.pandas_udf("n_words long, n_removed long, kept_sha256 string")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, places in batches:
            rows = []
            for text, starts in zip(texts, places, strict=True):
                kept, removed = _kept(text, starts, length)
                rows.append((len(kept) + removed, removed, hashlib.sha256(b" ".join(kept)).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_sha256"])

    return run


def _texts(length: int):
    @F.pandas_udf("string")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, places in batches:
            rows = []
            for text, starts in zip(texts, places, strict=True):
                kept, removed = _kept(text, starts, length)
                rows.append(None if text is None else (b" ".join(kept) if removed else text).decode("utf-8", "replace"))
            yield pd.Series(rows, dtype=object)

    return run


def _matched(docs: DataFrame, ident: str, text: str, length: int) -> DataFrame:
    """Every row (as ``row``) with its repeated places, or null."""
    places = repeated_places(docs, ident, text, length)
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(F.col(ident), F.col(text)).alias("row_key"))
    # Texts without a repeated place need no shuffle.
    keys = sized(places.select("row_key"))
    touched = rows.join(keys, "row_key", "left_semi").join(places.hint("shuffle_hash"), "row_key")
    rest = rows.join(keys, "row_key", "left_anti").withColumn("places", F.lit(None).cast("array<int>"))
    return touched.unionByName(rest)


def removals(docs: DataFrame, ident: str = "doc_id", text: str = "text", length: int = 35) -> DataFrame:
    """Per row: id, word count, words removed, and a digest of the kept words."""
    found = _digests(length)(F.col("row")[text].cast("binary"), F.col("places")).alias("d")
    return _matched(docs.select(ident, text), ident, text, length).select(F.col("row")[ident].alias(ident), found).select(ident, "d.*")


def without_repeats(docs: DataFrame, ident: str = "doc_id", text: str = "text", length: int = 35) -> DataFrame:
    """The rows with the repeated words taken out of their text; untouched texts stay as they are."""
    rows = _matched(docs, ident, text, length)
    cut = _texts(length)(F.col("row")[text].cast("binary"), F.col("places"))
    return rows.select(*(cut.alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns))
