"""Importance resampling towards a target distribution, on hashed n-gram features.

A text's features are its runs of one to ``LONGEST`` words, and a feature's bucket is its CRC-32
modulo ``BUCKETS``. A document's weight compares how often its buckets occur in the target and in
the documents at large; adding Gumbel noise to the weight and taking the highest scores
draws documents without replacement in proportion to their importance.

CRC-32 is linear: the CRC of a span is the XOR of one contribution a byte, which depends
on the byte and its distance from the span's end alone, and of a constant for the span's
length. Contributions are looked up in a table by distance and byte, and those of all
features of many texts are folded together by ``bitwise_xor.reduceat``. Spans longer than the
table are cut into blocks; the register after one block is carried over the next, as if
it were XORed into its first four bytes.

Bucket counts are summed over all documents; no more than ``BUCKETS`` sums reach the driver.
Documents are ranked by one range shuffle of narrow rows: a row's rank is its place in its
partition and the sizes of the partitions before.

Edge cases: null, empty and wordless texts have no features and weight 0; a null id stays
null, its noise is that of the empty text and it comes last among ties; rows that share an
id have the same noise and are told apart by where they were read; very long texts and
words are hashed whole, in pieces of bounded size; an empty target or an empty table
changes sums only; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linklake.llm.tables import ids, ids_back, stored

BUCKETS = 10_000
LONGEST = 3
SEED = 42
LEAST_WORDS = 20
PERCENT = 5
BLOCK = 64  # distances in the table, bytes
ONES = np.uint32(0xFFFFFFFF)
AT_ONCE = 1 << 19  # bytes of spans that are looked up together
GROUP_BYTES = 1 << 18  # texts that are cut into words together
# Lower case for A-Z; what is no word byte becomes a space.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Contribution of a byte by distance from the end (flat), and the constant of each length."""
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = (byte >> np.uint32(1)) ^ np.where(byte & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    rows = [byte]
    for _ in range(BLOCK - 1):
        rows.append((rows[-1] >> np.uint32(8)) ^ byte[rows[-1] & np.uint32(255)])
    constants = np.array([zlib.crc32(bytes(n)) for n in range(BLOCK + 1)], np.uint32)
    return np.concatenate(rows), constants


def _contributions(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """XOR of the contributions of each span's bytes; no span is empty or longer than the table."""
    table = _tables()[0]
    ends = np.cumsum(lengths)
    places = np.arange(ends[-1])
    keys = (np.repeat(ends - 1, lengths) - places) << 8
    keys |= data[places + np.repeat(starts - (ends - lengths), lengths)]
    return np.bitwise_xor.reduceat(table[keys], ends - lengths)


def _long(data: np.ndarray, start: int, length: int) -> int:
    """The CRC of a span longer than the table, block after block."""
    table, constants = _tables()
    table = table.reshape(BLOCK, 256)
    head = (length - 1) % BLOCK + 1
    register = int(_contributions(data, np.array([start]), np.array([head]))[0] ^ constants[head] ^ ONES)
    start, end = start + head, start + length
    while start < end:
        size = min(AT_ONCE, end - start) // BLOCK
        starts = start + BLOCK * np.arange(size)
        for own in _contributions(data, starts, np.full(size, BLOCK)).tolist():
            carried = 0
            for i in range(4):
                carried ^= int(table[BLOCK - 1 - i, (register >> 8 * i) & 255])
            register = carried ^ own
        start += size * BLOCK
    return register ^ int(ONES)


def crcs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of each span of ``data`` (bytes as numbers); no span is empty."""
    found = np.empty(len(starts), np.uint32)
    short = np.flatnonzero(lengths <= BLOCK)
    for i in np.flatnonzero(lengths > BLOCK):
        found[i] = _long(data, int(starts[i]), int(lengths[i]))
    reach = np.cumsum(lengths[short])
    at = 0
    while at < len(short):
        until = max(at + 1, int(np.searchsorted(reach, (reach[at - 1] if at else 0) + AT_ONCE, "right")))
        own = short[at:until]
        found[own] = _contributions(data, starts[own], lengths[own]) ^ _tables()[1][lengths[own]]
        at = until
    return found


def _grouped(texts) -> Iterator[list[bytes]]:
    """Texts in groups of bounded size; a long one is a group of its own."""
    group, size = [], 0
    for text in texts:
        group.append(text or b"")
        size += len(group[-1])
        if size >= GROUP_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group


def _features(group: list[bytes]) -> tuple[np.ndarray, Iterator[tuple[np.ndarray, np.ndarray]]]:
    """Words of each text, and for each run length the text and bucket of each feature."""
    data = np.frombuffer(b" ".join(group).translate(_BYTES), np.uint8)
    word = np.zeros(len(data) + 2, bool)
    word[1:-1] = data != 32
    edges = np.flatnonzero(word[1:] != word[:-1])
    first, end = edges[::2], edges[1::2]
    texts = np.searchsorted(np.cumsum([len(t) + 1 for t in group]), first, "right")
    kept = word[1:-1].copy()
    kept[end[end < len(data)]] = True  # one space after each word
    data = data[kept]
    lengths = end - first
    starts = np.cumsum(lengths + 1) - lengths - 1
    ends = starts + lengths

    def runs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for n in range(1, LONGEST + 1):
            if len(starts) < n:
                return
            own = np.flatnonzero(texts[n - 1 :] == texts[: len(texts) - n + 1])
            if len(own):
                yield texts[own], crcs(data, starts[own], ends[own + n - 1] - starts[own]) % np.uint32(BUCKETS)

    return np.bincount(texts, minlength=len(group)), runs()


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per task: features in each bucket."""
    counts = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for group in _grouped(batch["text"]):
            for _, buckets in _features(group)[1]:
                counts += np.bincount(buckets, minlength=BUCKETS)
    used = np.flatnonzero(counts)
    yield pd.DataFrame({"bucket": used, "n": counts[used]})


def bucket_counts(docs: DataFrame, text: str = "text") -> list[int]:
    """Features in each bucket over all rows."""
    rows = docs.select(F.col(text).cast("binary").alias("text")).mapInPandas(_counted, "bucket int, n long")
    counts = [0] * BUCKETS
    for row in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row["bucket"]] = row["n"]
    return counts


def gains(source: list[int], target: list[int]) -> list[int]:
    """What a feature of each bucket adds to a weight: a thousandth of a nat is one."""
    all_source, all_target = sum(source), sum(target)
    return [
        math.floor(1000 * math.log((t + 1.0) * (all_source + BUCKETS) / ((s + 1.0) * (all_target + BUCKETS))))
        for s, t in zip(source, target, strict=True)
    ]


def _weighed(gain: list[int]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by_bucket = np.array(gain, np.int64)
        for batch in batches:
            words, features, weights = [], [], []
            for group in _grouped(batch["text"]):
                counts, runs = _features(group)
                found, weight = np.zeros(len(group), np.int64), np.zeros(len(group), np.int64)
                for texts, buckets in runs:
                    edges = np.flatnonzero(np.diff(texts, prepend=-1))
                    weight[texts[edges]] += np.add.reduceat(by_bucket[buckets], edges)
                    found += np.bincount(texts, minlength=len(group))
                words.append(counts)
                features.append(found)
                weights.append(weight)
            if words:
                columns = (np.concatenate(c) for c in (words, features, weights))
                yield pd.DataFrame({"doc": batch["doc"].to_numpy(), **dict(zip(("n_words", "n_features", "weight"), columns))})

    return run


def weighed(docs: DataFrame, gain: list[int], ident: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, words, features and weight."""
    rows = docs.select(ids(ident).alias("doc"), F.col(text).cast("binary").alias("text"))
    found = rows.mapInPandas(_weighed(gain), "doc long, n_words long, n_features long, weight long")
    return found.withColumn("doc", ids_back(F.col("doc")))


def _noise(seed: int):
    """Gumbel noise of an id in thousandths, from the first 32 bits of a SHA-256."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc").cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((drawn + 0.5) / 4294967296.0)))


def resampled(
    docs: DataFrame, target: DataFrame, ident: str = "doc_id", text: str = "text", target_text: str = "text",
    percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED,
) -> DataFrame:
    """Every row with features, weight and score; ``rank`` where it is drawn.

    Drawn are the highest scores of rows with enough words, ``percent`` of these.
    """
    gain = gains(bucket_counts(docs, text), bucket_counts(target, target_text))
    rows = weighed(docs, gain, ident, text)
    rows = rows.select("*", (F.col("weight") + _noise(seed)).alias("score"), F.monotonically_increasing_id().alias("row"))
    rows = stored(rows, "weighed")
    fit = rows.where(F.col("n_words") >= least_words)
    ordered = fit.orderBy(F.desc("score"), F.asc_nulls_last("doc"), "row")
    # Numbered by partition and place there; the sizes of the partitions do the rest.
    placed = stored(ordered.select("doc", "n_features", "weight", "score", F.monotonically_increasing_id().alias("place")), "placed")
    part, inside = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted(map(tuple, placed.groupBy(part.alias("part")).count().collect()))
    before, offsets = 0, []
    for number, size in sizes:
        offsets.append((number, before))
        before += size
    drawn = percent * before // 100
    spark = docs.sparkSession
    offsets = F.broadcast(spark.createDataFrame(offsets, "part long, before long"))  # a row a partition
    ranked = placed.withColumn("part", part).join(offsets, "part")
    rank = F.col("before") + inside + 1
    columns = [F.col("doc").alias(ident), "n_features", "weight", "score"]
    ranked = ranked.select(*columns, F.when(rank <= drawn, rank).alias("rank"))
    rest = rows.where(F.col("n_words") < least_words)
    return ranked.union(rest.select(*columns, F.lit(None).cast("long").alias("rank")))
