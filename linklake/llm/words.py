"""Words of a text and hashes of word windows, for use inside tasks.

Words are runs of anything but the six ASCII white-space bytes, which is what
``bytes.split`` gives. A word's hash is computed once per Python worker and kept
in a table of bounded size; windows are hashed by doubling, so a window of any
length costs a few passes over an array.
"""

from __future__ import annotations

import numpy as np
import xxhash

KEPT_WORDS = 150_000  # some 20 MB a worker, which keeps it from task to task
LANES = (
    (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)),
    (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)),
)


class WordHashes(dict):
    """Word to 64-bit hash; emptied when full, so memory stays bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_known = WordHashes()


def words_of(text: bytes | None) -> list[bytes]:
    return text.split() if text else []


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))


def combined(left: np.ndarray, right: np.ndarray, lane: int = 0) -> np.ndarray:
    """One hash of two; order matters."""
    first, second, third = LANES[lane]
    value = left * first + (right ^ (right >> np.uint64(31))) * second
    value ^= value >> np.uint64(32)
    value *= third
    value ^= value >> np.uint64(29)
    return value


def windows(word_hashes: np.ndarray, length: int, lane: int = 0) -> np.ndarray:
    """Hash of each run of ``length`` words, by doubling; empty if there are fewer words."""
    if len(word_hashes) < length:
        return np.empty(0, np.uint64)
    value, done = word_hashes, 1
    while 2 * done <= length:
        value = combined(value[:-done], value[done:], lane)
        done *= 2
    if done < length:  # two overlapping halves cover the rest
        shift = length - done
        value = combined(value[:-shift], value[shift:], lane)
    return value


def mixed(values: np.ndarray, seed: int) -> np.ndarray:
    """The values permuted by a seed."""
    value = (values ^ np.uint64(seed)) * LANES[1][0]
    value ^= value >> np.uint64(30)
    value *= LANES[1][1]
    value ^= value >> np.uint64(27)
    return value


def covered(starts: np.ndarray, length: int, size: int) -> np.ndarray:
    """Which of ``size`` places lie in a run of ``length`` that begins at one of ``starts``."""
    edges = np.zeros(size + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, np.minimum(starts + length, size), -1)
    return np.cumsum(edges[:-1]) > 0
