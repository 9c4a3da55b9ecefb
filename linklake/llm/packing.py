"""Packing documents into sequences of a fixed token budget.

Texts are tokenised once and cut into pieces of at most ``budget`` tokens. Every task
packs its own pieces best-fit, longest first. Bins that are nearly full (``slack`` tokens
of room, or less than the shortest piece in sight) are final. The others travel as single items to fewer tasks,
which pack them best-fit again, and so on up a tree until one group is left. A bin
carries its pieces along; it never holds more than ``budget`` of them. A group larger
than ``BLOCK`` items is packed in blocks, so memory does not grow with the data. Merging
ends early only where the bins left need several blocks, the groups get no fewer and a level
saved less than one bin in a hundred.

Edge cases: a null id stays null; null and empty texts are one piece that holds only the end token; a text is
cut only if it is longer than the budget; repeated rows are packed each for itself; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from linklake.llm.tables import ids, ids_back, stored

BUDGET = 2_048
END_ID = 0
BLOCK = 200_000
SLACK = 8  # a bin with no more room than this counts as full
FAN_IN = 8
KEPT_WORDS = 100_000  # some 22 MB; twice as many at most, with those of the time before
KEPT_LENGTH = 48
FIELDS = ("doc", "piece", "start", "length", "ids_crc32")
PIECE = "doc long, piece int, start long, length int, ids_crc32 long"
BIN = "final boolean, size int, number long, members array<long>"  # members: FIELDS of each piece in turn


class WordIds(dict):
    """Piece of a text to the little-endian 32-bit ids of its tokens.

    The tokenizer lowers letters, drops white space, and merges inside runs of letters, single
    digits and runs of other signs only. In a text of Latin-1 characters these runs are
    found by one pattern and handed to the merges directly. In other texts that is done
    for each word that can be written so, and every other word is encoded by the whole tokenizer.
    What was not used since the table was last full is forgotten, so memory stays
    bounded; a run that is missing is worked out when it is asked for.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.older: dict[str, bytes] = {}
        # Only for a tokenizer that cuts texts in this way is the short way right.
        self.short = all(self._short(probe) == self._encoded(probe) for probe in _PROBES)

    def of(self, text: str) -> bytes:
        if self._is_plain(text):
            return self._short(text)
        return b"".join(map(self._word, text.replace("\n", " ").split(" ")))

    def forget(self) -> None:
        self.clear()
        self.older.clear()

    def _word(self, word: str) -> bytes:
        return self._short(word) if self._is_plain(word) else self._encoded(word)

    def _is_plain(self, text: str) -> bool:
        """May the short way be taken? "<|" may begin a special token."""
        return self.short and "<|" not in text and _LATIN.fullmatch(text) is not None

    def _short(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, _RUNS.findall(text.lower())))

    def __missing__(self, run: str) -> bytes:
        found = self.older.get(run)
        if found is None:
            shown = run.encode().decode("latin-1").translate(_SHOWN)
            found = _packed_ids([token.id for token in self.model.tokenize(shown)])
        if len(run) <= KEPT_LENGTH:
            if len(self) >= KEPT_WORDS:
                self.older = dict(self)
                self.clear()
            self[run] = found
        return found

    def _encoded(self, word: str) -> bytes:
        return _packed_ids(self.tokenizer.encode(word, add_special_tokens=False).ids) if word else b""


# Latin-1 without the control characters that parts of the tokenizer see differently.
_LATIN = re.compile(r"[\x00-\x1b\x20-\xff]*")
_RUNS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^\s0-9a-zªµºß-öø-ÿ²³¹¼½¾]+")
_PROBES = ("Probe, probe.", "ÜberprÜft's é² 10½ ## x", "ÉTÉ\tµ\xa0ª…".replace("…", "!?"))
# Bytes are shown to the merges as characters: those that print stand for themselves, the
# others for the code points from 256 on, in order.
_SHOWN = dict(zip((b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)), range(256, 512)))


def _packed_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def _pieces(path: str, budget: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, end = word_ids(path), END_ID.to_bytes(4, "little")
        try:
            for batch in batches:
                rows = []
                for doc, text in zip(batch["doc"], batch["text"], strict=True):
                    ids = own.of(text or "") + end
                    for piece, at in enumerate(range(0, len(ids) // 4, budget)):
                        part = ids[4 * at : 4 * (at + budget)]
                        rows.append((doc, piece, at, len(part) // 4, zlib.crc32(part)))
                yield pd.DataFrame(rows, columns=["doc", "piece", "start", "length", "ids_crc32"])
        finally:  # the worker goes on to other tasks, which need the room
            own.forget()

    return run


def best_fit(sizes: list[int], budget: int) -> list[list[int]]:
    """Bins as lists of places in ``sizes``: longest first, each into the fullest bin it fits.

    Open bins are kept by the room they have left; rooms in use are bits of one number,
    so the tightest one is found by a shift.
    """
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(budget + 1)]
    used = 0  # bit r: some bin has r tokens of room
    for place in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[place]
        fitting = used >> size
        if fitting:
            room = size + ((fitting & -fitting).bit_length() - 1)
            number = by_room[room].pop()
            if not by_room[room]:
                used &= ~(1 << room)
            bins[number].append(place)
        else:
            room, number = budget, len(bins)
            bins.append([place])
        if room > size:
            by_room[room - size].append(number)
            used |= 1 << (room - size)
    return bins


def _packed(items: list[tuple[int, np.ndarray]], budget: int, slack: int, level: int, serial: int, last: bool) -> list[tuple]:
    sizes = [size for size, _ in items]
    shortest = min(sizes)
    rows = []
    for found in best_fit(sizes, budget):
        size = sum(sizes[i] for i in found)
        members = np.concatenate([items[i][1] for i in found])
        room = budget - size
        rows.append((last or room <= slack or room < shortest, size, (level << 58) | (serial + len(rows)), members))
    return rows


def _level(budget: int, slack: int, level: int, last: bool):
    """Pack what a task gets, in blocks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        serial = TaskContext.get().partitionId() << 34
        held: list[tuple[int, np.ndarray]] = []

        def flushed() -> Iterator[pd.DataFrame]:
            nonlocal serial
            rows = _packed(held, budget, slack, level, serial, last)
            serial += len(rows)
            held.clear()
            for at in range(0, len(rows), 5_000):
                yield pd.DataFrame(rows[at : at + 5_000], columns=["final", "size", "number", "members"])

        for batch in batches:
            if "members" in batch:
                held.extend(zip(batch["size"].tolist(), batch["members"], strict=True))
            else:
                held.extend(zip(batch["length"].tolist(), batch[list(FIELDS)].to_numpy(np.int64), strict=True))
            if len(held) >= BLOCK:
                yield from flushed()
        if held:
            yield from flushed()

    return run


def _placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row for each piece of a bin, with its place."""
    for batch in batches:
        if not len(batch):
            continue
        members = [np.asarray(m).reshape(-1, len(FIELDS)) for m in batch["members"]]
        rows = pd.DataFrame(np.concatenate(members), columns=list(FIELDS))
        rows["sequence_id"] = batch["number"].repeat([len(m) for m in members]).to_numpy()
        rows["offset"] = np.concatenate([np.cumsum(m[:, 3]) - m[:, 3] for m in members])
        yield rows


def packed(rows: DataFrame, budget: int = BUDGET, fan_in: int = FAN_IN, slack: int = SLACK, cut=None) -> DataFrame:
    """Pieces (columns of ``PIECE``) with ``sequence_id`` and ``offset``. ``cut`` makes the pieces
    of batches of ``rows``, in the worker that packs them: a second one would stay with the executor."""

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _level(budget, slack, 0, False)(cut(batches) if cut else batches)

    def fewer(groups: int, waiting: int) -> int:
        return max(-(-groups // fan_in), -(-waiting // BLOCK))

    level = 0
    bins = stored(rows.mapInPandas(first, BIN), "bins")
    done = [bins.where("final")]
    groups = bins.rdd.getNumPartitions()
    waiting = bins.where("not final").count()
    while waiting:
        level += 1
        groups = fewer(groups, waiting)
        last = groups == 1
        given = bins.where("not final").select("size", "members").repartition(groups)
        bins = stored(given.mapInPandas(_level(budget, slack, level, last), BIN), "bins")
        done.append(bins.where("final"))
        before, waiting = waiting, bins.where("not final").count()
        if waiting > 0.99 * before and fewer(groups, waiting) == groups:  # these meet few others they fit with: they stay
            done.append(bins.where("not final"))
            break
    every = done[0]
    for more in done[1:]:
        every = every.union(more)
    return every.select("number", "members").mapInPandas(_placed, f"{PIECE}, sequence_id long, offset long")


def sequences(docs: DataFrame, path: str, ident: str = "doc_id", text: str = "text", budget: int = BUDGET) -> DataFrame:
    """One row a piece: where it comes from and where it is placed."""
    rows = docs.select(ids(ident).alias("doc"), F.col(text).alias("text"))
    found = packed(rows, budget, cut=_pieces(path, budget))
    return found.select(
        ids_back(F.col("doc")).alias(ident), "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset"
    )
