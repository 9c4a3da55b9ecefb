"""Byte-level BPE encoding and decoding, with overlapping chunks for long texts.

A text is cut by the pre-token pattern, and each pre-token is merged by rank. Long texts
are first cut into chunks that overlap. Chunks are pre-tokenised in parallel, each from
its own start, so a chunk may begin in the middle of a pre-token. Two neighbours are
stitched at the first place in their overlap where both end a pre-token: a match depends
on nothing before its start, so from there on both see the same pre-tokens. Places after
white space do not count, as a white-space match depends on what follows. The pieces
between stitches are then encoded in parallel. Texts with an overlap that holds no common
place are cut again with chunks and overlaps four times as long, in the end in one chunk.

Decoding joins the raw bytes of the tokens.

Edge cases: null and empty texts have no tokens; a null id stays null; repeated rows give repeated results;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linklake.llm.tables import ids as known_ids
from linklake.llm.tables import ids_back, stored

CHUNK = 16_384
OVERLAP = 1_024
KEPT_PIECES = 300_000
KEPT_LENGTH = 48  # longer pre-tokens are seldom seen again


class _Known(dict):
    """Pre-token to token ids; emptied when full, so memory stays bounded."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = tuple(self.encode(piece))
        if len(piece) <= KEPT_LENGTH:
            if len(self) >= KEPT_PIECES:
                self.clear()
            self[piece] = ids
        return ids


class Codec:
    """A rank file and a pre-token pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.known = _Known(encoding.encode_ordinary)
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.name_of = {rank: str(rank) for rank in self.bytes_of}

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.known.__getitem__, self.pattern.findall(text))))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def names(self, ids: list[int]) -> str:
        return ",".join(map(self.name_of.__getitem__, ids))

    def ends(self, text: str) -> list[int]:
        """Where pre-tokens end that do not end in white space, but for the text's own end."""
        found = [m.end() for m in self.pattern.finditer(text)]
        return [e for e in found if e < len(text) and not text[e - 1].isspace()]


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    """One codec a Python worker."""
    return Codec(path, pattern)


def _digests(path: str, pattern: str):
    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = codec(path, pattern)
        for texts in batches:
            rows = []
            for text in texts:
                ids = own.encode(text or "")
                rows.append((len(ids), hashlib.sha256(own.names(ids).encode()).hexdigest(), hashlib.sha256(own.decode(ids)).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def _ids(path: str, pattern: str):
    @F.pandas_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(path, pattern)
        for texts in batches:
            yield pd.Series([np.array(own.encode(text or ""), np.int32) for text in texts], dtype=object)

    return run


def _bytes(path: str, pattern: str):
    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(path, pattern)
        for ids in batches:
            yield pd.Series([None if row is None else own.decode(row.tolist()) for row in ids], dtype=object)

    return run


def decoded(ids: Column, path: str, pattern: str) -> Column:
    """Raw bytes of a column of token ids (null stays null)."""
    return _bytes(path, pattern)(ids)


def _marked(path: str, pattern: str, chunk: int, overlap: int):
    """For each chunk, the places where it may be stitched to its neighbours."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(path, pattern)
        for batch in batches:
            heads, tails = [], []
            for start, part in zip(batch["start"], batch["part"], strict=True):
                ends = np.array(own.ends(part), np.int64)
                heads.append(ends[ends < overlap] + start)
                tails.append(ends[ends >= chunk] + start)
            yield batch.assign(head=heads, tail=tails)

    return run


def _chunks(texts: DataFrame, path: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """Chunks of (doc, copies, text) spread over tasks, with their stitching places."""
    rows = texts.withColumn("size", F.char_length("text"))
    rows = rows.withColumn("k", F.explode(F.sequence(F.lit(0), ((F.col("size") - 1) / chunk).cast("int"))))
    rows = rows.withColumn("start", F.col("k") * chunk).select(
        "doc", "key", "copies", "size", "k", "start", F.substring("text", F.col("start") + 1, F.lit(chunk + overlap)).alias("part")
    )
    kinds = "doc long, key long, copies long, size int, k int, start int, part string, head array<int>, tail array<int>"
    return rows.repartition("doc", "key", "k").mapInPandas(_marked(path, pattern, chunk, overlap), kinds)


def _stitched(chunks: DataFrame) -> DataFrame:
    """(doc, key, k, begin, end, ok): the piece of each chunk; ok is false where a text holds no stitch."""
    from pyspark.sql import Window

    order = Window.partitionBy("doc", "key").orderBy("k")
    whole = Window.partitionBy("doc", "key")
    light = chunks.select("doc", "key", "size", "k", "head", "tail")
    met = F.array_min(F.array_intersect("head", F.lag("tail").over(order)))
    rows = light.withColumn("begin", F.when(F.col("k") == 0, 0).otherwise(met))
    rows = rows.withColumn("end", F.when(F.lead("k").over(order).isNull(), F.col("size")).otherwise(F.lead("begin").over(order)))
    return rows.select("doc", "key", "k", "begin", "end", F.min(F.col("begin").isNotNull()).over(whole).alias("ok"))


def encoded(docs: DataFrame, path: str, pattern: str, ident: str = "doc_id", text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Per row: id, token count, digest of the ids and digest of the decoded bytes."""
    rows = docs.select(known_ids(ident).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    digests = _digests(path, pattern)
    one = rows.where(F.char_length("text") <= chunk).select("doc", digests("text").alias("d")).select("doc", "d.*")
    left = rows.where(F.char_length("text") > chunk).groupBy("doc", "text").agg(F.count("*").alias("copies"))
    left = left.withColumn("key", F.xxhash64("text"))
    results = [one]
    while not left.isEmpty():
        chunks = stored(_chunks(left, path, pattern, chunk, overlap), "chunks")
        spans = stored(_stitched(chunks), "spans")
        pieces = chunks.select("doc", "key", "k", "copies", "start", "part").join(spans.where("ok"), ["doc", "key", "k"])
        own = F.substring("part", F.col("begin") - F.col("start") + 1, F.col("end") - F.col("begin"))
        ids = pieces.select("doc", "key", "k", "copies", _ids(path, pattern)(own).alias("ids"))
        # One text's ids meet in one row, as its text does in the input.
        joined = ids.groupBy("doc", "key", "copies").agg(F.array_sort(F.collect_list(F.struct("k", "ids"))).alias("parts"))
        joined = joined.withColumn("ids", F.flatten(F.col("parts.ids")))
        results.append(
            joined.select(
                "doc",
                F.size("ids").cast("long").alias("n_tokens"),
                F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                F.sha2(decoded(F.col("ids"), path, pattern), 256).alias("decoded_sha256"),
                F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
            ).drop("copy")
        )
        failed = spans.where("not ok").select("doc", "key").distinct()
        left = left.join(failed, ["doc", "key"], "left_semi")
        chunk, overlap = 4 * chunk, 4 * overlap
    total = results[0]
    for more in results[1:]:
        total = total.union(more)
    return total.select(ids_back(F.col("doc")).alias(ident), "n_tokens", "ids_sha256", "decoded_sha256")
