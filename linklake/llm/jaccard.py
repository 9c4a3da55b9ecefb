"""N-gram Jaccard self-join and its connected groups, by several global token orders.

A document is the set of its distinct word shingles. Two sets whose Jaccard similarity
reaches the threshold share a token among the first ``n - ceil(t * n) + 1`` of each set
under *any* global order of tokens. The orders used here put rare tokens first, as counted
by a frequency sketch of fixed size; they differ in how finely they look at the counts and
in the permutation of equals.

1. Sets with equal content fall into one class; its smallest id stands for it.
2. Rows (token, document) of the first order's prefixes are shuffled by token; tokens of
   one document alone go.
3. A star round joins the bulk: every document is compared with one partner, the one
   with which it shares most prefix tokens.
4. Exact round: between documents that are not yet connected, all pairs that share a
   prefix token and pass size and overlap bounds are candidates. A pair is given out by the
   least of its common tokens and passed over by the others. Links inside a connected
   group change no group, so none is lost.

In both rounds a pair goes on only if its prefixes meet under the other orders too. These prefixes
are worked out once for each document of a pair and joined, as hashes of half the length, to
the pairs that pass the overlap bounds; whole sets are joined to what is left.

The overlap bound counts, per hash bucket, how many tokens two sets can have in common.
Candidates are tried with few buckets first; those that pass, with buckets that grow with
the set. Whole sets are joined only to pairs that pass both.

Overlaps are counted on 64-bit shingle hashes.

Edge cases: null, empty and blank texts have an empty set and link with nothing; fewer
words than a shingle are one shingle; rows without an id share the id null, which counts
as the smallest; equal texts link; rows that share an id count as
one node; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linklake.llm.components import component_labels
from linklake.llm.tables import BROADCAST_KEYS, discard, ids, ids_back, sized, stored
from linklake.llm.words import hashes, mixed, windows, words_of

SHINGLE = 5
PERCENT = 75
CELL_BITS = 21
CELLS = 1 << CELL_BITS  # of the frequency sketch; its size never changes
SLICE = 1 << 12
SLICES = 64  # that leave a task at a time
ORDERS = ((0x51ED2701, 0), (0x2545F491, 4), (0x9E3779B1, 6))  # seed, and bits of a count left out
BUCKETS = 128  # of the overlap bound
BLOCK = 512  # documents of one token that meet in one task at a time
EARLIER = 24  # least open tokens of a document that travel with each of its rows
_SEEN = 200_000


def shingle_set(text: bytes | None, size: int = SHINGLE) -> np.ndarray:
    word_hashes = hashes(words_of(text.lower() if text else text))
    if not len(word_hashes):
        return word_hashes
    return np.unique(windows(word_hashes, min(size, len(word_hashes))))


def needed(n: int | np.ndarray, percent: int = PERCENT):
    """The least overlap of a set of ``n`` with any set similar to it."""
    return -(-percent * n // 100)


def order_keys(tokens: np.ndarray, counts: np.ndarray, order: tuple[int, int]) -> np.ndarray:
    """Sort keys of a global order: tokens of rare cells first, equals by a seeded permutation."""
    seed, coarse = order
    crowd = (counts[(tokens >> np.uint64(64 - CELL_BITS)).astype(np.int64)] >> np.uint16(coarse)).astype(np.uint64)
    return (crowd << np.uint64(48)) | (mixed(tokens, seed) >> np.uint64(16))


def prefix(tokens: np.ndarray, counts: np.ndarray, order: tuple[int, int], percent: int) -> np.ndarray:
    size = len(tokens) - int(needed(len(tokens), percent)) + 1
    keys = order_keys(tokens, counts, order)
    return tokens[np.argpartition(keys, size - 1)[:size]] if size < len(tokens) else tokens


def spread(tokens: np.ndarray) -> np.ndarray:
    """Tokens in each bucket; all 255 where a bucket cannot be told in one byte."""
    found = np.bincount((tokens & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
    return np.full(BUCKETS, 255, np.uint8) if found.max(initial=0) > 254 else found.astype(np.uint8)


def fine_spread(tokens: np.ndarray) -> np.ndarray:
    """Tokens in each of two to four buckets a token; empty where one byte cannot tell."""
    buckets = max(BUCKETS, 1 << (2 * len(tokens)).bit_length())
    found = np.bincount((tokens & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets)
    return found.astype(np.uint8) if found.max() < 256 else np.empty(0, np.uint8)


def finely_bounded(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    """Whether sets of these fine spreads can be similar. Buckets are low bits, so the finer
    spread is folded to the other's."""
    if not len(left) or not len(right):
        return True
    small, large = sorted((left, right), key=len)
    if len(large) > len(small):
        large = large.reshape(-1, len(small)).sum(0, dtype=np.int64)
    most = int(np.minimum(small, large).sum(dtype=np.int64))
    total = int(small.sum(dtype=np.int64)) + int(large.sum(dtype=np.int64))
    return 100 * most >= percent * (total - most)


def may_be_similar(n, spreads: np.ndarray, own_n, own_spread: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets can be similar, by their sizes and spreads (rows against one or rows)."""
    most = np.minimum(spreads, own_spread).sum(-1, dtype=np.int64)
    unknown = (spreads[..., 0] == 255) | (own_spread[..., 0] == 255)
    most = np.where(unknown, np.minimum(n, own_n), most)
    return 100 * most >= percent * (n + own_n - most)


def _digest(tokens: np.ndarray) -> tuple[int, int]:
    value = xxhash.xxh3_128_intdigest(tokens.tobytes())
    signed = np.array([value >> 64, value & (2**64 - 1)], np.uint64).view(np.int64)
    return int(signed[0]), int(signed[1])


def _members(size: int):
    """Per text its set's size, digest and spread; per task how many tokens fell into each
    cell, as slices of fixed length (rows with ``part``)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["doc", "n", "k1", "k2", "data", "part"]
        counts = np.zeros(CELLS, np.int32)
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc"], batch["text"], strict=True):
                tokens = shingle_set(text, size)
                rows.append((doc, len(tokens), *(_digest(tokens) if len(tokens) else (0, 0)), spread(tokens).tobytes(), -1))
                np.add.at(counts, (tokens >> np.uint64(64 - CELL_BITS)).astype(np.int64), np.int32(1))
            yield pd.DataFrame(rows, columns=names)
        parts = counts.reshape(-1, SLICE)
        for low in range(0, len(parts), SLICES):
            found = [(0, 0, 0, 0, p.tobytes(), i) for i, p in enumerate(parts[low : low + SLICES], low) if p.any()]
            yield pd.DataFrame(found, columns=names)

    return run


def _summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(batch["part"], batch["data"], strict=True):
            values = np.frombuffer(counts, np.int32)
            totals[part] = totals[part] + values if part in totals else values.astype(np.int64)
    if totals:
        # Only the order of counts matters, and 16 bits are enough to tell ranks apart.
        yield pd.DataFrame({"part": list(totals), "data": [v.tobytes() for v in totals.values()]})


def cell_counts(slices: DataFrame) -> np.ndarray:
    """The sketch: tokens of each cell, scaled down to 16 bits. CELLS numbers at any input size."""
    counts = np.zeros((CELLS // SLICE, SLICE), np.int64)
    for row in slices.repartition("part").mapInPandas(_summed, "part int, data binary").collect():
        counts[row["part"]] += np.frombuffer(row["data"], np.int64)
    flat = counts.reshape(-1)
    mean = max(1, int(flat.mean()))
    return (flat * 256 // mean if mean > 256 else flat).clip(0, 65535).astype(np.uint16)


def _prefixes(size: int, percent: int, counts):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[tuple[int, int]] = set()  # equal sets of one task are sent once
        for batch in batches:
            tokens_out, docs_out = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            for doc, text in zip(batch["doc"], batch["text"], strict=True):
                tokens = shingle_set(text, size)
                if not len(tokens):
                    continue
                key = _digest(tokens)
                if key in seen:
                    continue
                if len(seen) >= _SEEN:
                    seen.clear()
                seen.add(key)
                first = prefix(tokens, counts.value, ORDERS[0], percent)
                tokens_out.append(first)
                docs_out.append(np.full(len(first), doc, np.int64))
            yield pd.DataFrame({"token": np.concatenate(tokens_out).view(np.int64), "doc": np.concatenate(docs_out)})

    return run


def _shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of rows sorted by token and document, each once, those whose token has another document."""
    held, held_before = None, False
    for batch in batches:
        token, doc = batch["token"].to_numpy(), batch["doc"].to_numpy()
        if held is not None:
            token, doc = np.concatenate([[held[0]], token]), np.concatenate([[held[1]], doc])
        if not len(token):
            continue
        # A row repeated in another task, or under the same id, is the same document again.
        new = np.concatenate([[True], (token[1:] != token[:-1]) | (doc[1:] != doc[:-1])])
        token, doc = token[new], doc[new]
        same = token[1:] == token[:-1]
        keep = np.concatenate([[held_before], same]) | np.concatenate([same, [False]])
        held, held_before = (token[-1], doc[-1]), bool(same[-1]) if len(same) else held_before
        keep = keep[:-1]
        yield pd.DataFrame({"token": token[:-1][keep], "doc": doc[:-1][keep]})
    if held is not None and held_before:
        yield pd.DataFrame({"token": [held[0]], "doc": [held[1]]})


def _sets(size: int, percent: int, counts):
    """Sets with their fine spreads and, one after the other, their prefixes under the further orders."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingle_set(text, size) for text in batch["text"]]
            yield pd.DataFrame({
                "doc": batch["doc"],
                "fine": [fine_spread(t).tobytes() for t in sets],
                "further": [further(t, counts.value, percent) for t in sets],
                "tokens": [t.tobytes() for t in sets],
            })

    return run


def further(tokens: np.ndarray, counts: np.ndarray, percent: int) -> bytes:
    """The prefixes under the further orders, one after the other, half a token each."""
    return b"".join(prefix(tokens, counts, o, percent).astype(np.uint32).tobytes() for o in ORDERS[1:])


def meet(left: bytes, right: bytes) -> bool:
    """Whether prefixes may meet under every further order; never no where they do."""
    sides = (np.frombuffer(side, np.uint32).reshape(len(ORDERS) - 1, -1) for side in (left, right))
    return all(len(np.intersect1d(a, b)) for a, b in zip(*sides, strict=True))


def _centres(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of rows sorted by token and falling degree: each document with the token's first
    document of another group."""
    token, first, second = None, None, None
    for batch in batches:
        docs, centres = [], []
        for now, doc, label in zip(batch["token"].tolist(), batch["doc"].tolist(), batch["label"].tolist(), strict=True):
            if now != token:
                token, first, second = now, (doc, label), None
            elif label != first[1]:
                docs.append(doc)
                centres.append(first[0])
                if second is None:
                    second = (doc, label)
                    docs.append(first[0])
                    centres.append(doc)
            elif second is not None:
                docs.append(doc)
                centres.append(second[0])
        yield pd.DataFrame({"doc": np.array(docs, np.int64), "centre": np.array(centres, np.int64)})


def similar(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    if 100 * min(len(left), len(right)) < percent * max(len(left), len(right)):
        return False
    common = len(left) + len(right) - len(np.union1d(left, right))
    return 100 * common >= percent * (len(left) + len(right) - common)


def _bounded(percent: int):
    """Pairs whose sizes and spreads allow them to be similar."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                left, right = (np.stack([np.frombuffer(v, np.uint8) for v in batch[c]]) for c in ("left", "right"))
                may = may_be_similar(batch["na"].to_numpy(np.int64), left, batch["nb"].to_numpy(np.int64), right, percent)
                yield batch.loc[may, ["a", "b"]]

    return run


def _pairs_where(test):
    """Pairs that pass a test of what two columns hold of their sides."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            left, right = (batch[c] for c in batch.columns[2:])
            yield batch.loc[np.array([test(a, b) for a, b in zip(left, right, strict=True)], bool), ["a", "b"]]

    return run


def _docs_of(pairs: DataFrame) -> DataFrame:
    return stored(pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct(), "wanted")


def _kept(pairs: DataFrame, sets: DataFrame, column: str, test, name: str) -> DataFrame:
    """The pairs that pass a test of a column of ``sets``, which is joined to both sides."""
    left = sets.select(F.col("doc").alias("a"), F.col(column).alias("left"))
    right = sets.select(F.col("doc").alias("b"), F.col(column).alias("right"))
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "left", "right")
    return stored(joined.mapInPandas(_pairs_where(test), "a long, b long"), name)


def _links(pairs: DataFrame, rows: DataFrame, size: int, percent: int, counts) -> DataFrame:
    """The pairs that are similar. Sets are made for the documents of pairs alone, and sent
    for those of pairs that pass the fine bound and the further orders."""

    def bounded(left: bytes, right: bytes) -> bool:
        return finely_bounded(np.frombuffer(left, np.uint8), np.frombuffer(right, np.uint8), percent)

    def alike(left: bytes, right: bytes) -> bool:
        return similar(np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64), percent)

    wanted = _docs_of(pairs)
    made = rows.join(sized(wanted), "doc", "left_semi").mapInPandas(_sets(size, percent, counts), "doc long, fine binary, further binary, tokens binary")
    sets = stored(made, "sets")
    near = _kept(pairs, sets, "fine", bounded, "near")
    left = _docs_of(near)
    sets_left = sets.join(sized(left), "doc", "left_semi")
    meeting = _kept(near, sets_left, "further", meet, "meeting")
    links = _kept(meeting, sets_left, "tokens", alike, "links")
    discard(wanted, sets, near, left, meeting)
    return links


def _cells(live: DataFrame, bounds: DataFrame) -> DataFrame:
    """Rows with the block cells they meet in, so that no token holds a task alone. What
    a row needs of its document is joined to it before it is spread over its tokens."""
    crowded = live.groupBy("token").count().where(F.col("count") > BLOCK)
    crowded = stored(crowded.select("token", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")), "crowded")
    docs = live.groupBy("doc").agg(F.min("label").alias("label"), F.sort_array(F.collect_set("token")).alias("tokens"))
    docs = docs.join(bounds, "doc").withColumn("earlier", F.slice("tokens", 1, EARLIER))
    rows = docs.withColumn("token", F.explode("tokens")).drop("tokens")
    rows = rows.join(F.broadcast(crowded) if crowded.limit(BROADCAST_KEYS).count() < BROADCAST_KEYS else crowded, "token", "left")
    rows = rows.withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("side", F.pmod(F.xxhash64("doc"), "blocks").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high")
    return rows.select("token", low, high, "side", "doc", "label", "n", "spread", "earlier")


def _candidates(percent: int):
    """Pairs of a cell (rows sorted by cell) that pass the bounds, are not connected and
    have no lesser token in common, as far as their ``earlier`` tokens tell."""

    def pairs(rows: list[tuple]) -> Iterator[tuple[int, int]]:
        token, doc, label, n, side = (np.array([r[k] for r in rows]) for k in (0, 4, 5, 6, 3))
        spreads = np.stack([np.frombuffer(r[7], np.uint8) for r in rows])
        # Lesser tokens of each row, the rest filled up with the cell's own.
        earlier = np.full((len(rows), EARLIER), token[0])
        for i, r in enumerate(rows):
            own = np.asarray(r[8], np.int64)
            own = own[own < token[0]]
            earlier[i, : len(own)] = own
        cross = rows[0][1] != rows[0][2]
        values, counts = np.unique(label, return_counts=True)
        usual = values[counts.argmax()]
        # Pairs inside the largest group need no look; every other has a member outside it.
        for i in np.flatnonzero(label != usual):
            may = (label != label[i]) & ((label == usual) | (np.arange(len(doc)) > i)) & (doc != doc[i])
            may &= 100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i])
            if cross:
                may &= side != side[i]
            near = np.flatnonzero(may)
            near = near[may_be_similar(n[near], spreads[near], n[i], spreads[i], percent)] if len(near) else near
            own = earlier[i][earlier[i] < token[0]]
            if len(near) and len(own):
                place = np.minimum(np.searchsorted(own, earlier[near]), len(own) - 1)
                near = near[~(own[place] == earlier[near]).any(1)]
            for j in near:
                yield (min(doc[i], doc[j]), max(doc[i], doc[j]))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell, held = None, []
        for batch in batches:
            found = []
            for row in batch.itertuples(index=False, name=None):
                if row[:3] != cell:
                    if len(held) > 1:
                        found.extend(pairs(held))
                    cell, held = row[:3], []
                held.append(row)
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")
        if len(held) > 1:
            yield pd.DataFrame(list(pairs(held)), columns=["a", "b"], dtype="int64")

    return run


def components(docs: DataFrame, ident: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per input row: id, ``n_shingles`` and ``component_id``."""
    rows = docs.select(ids(ident).alias("doc"), F.col(text).cast("binary").alias("text"))
    first = stored(rows.mapInPandas(_members(size), "doc long, n int, k1 long, k2 long, data binary, part int"), "members")
    members = first.where("part < 0")
    counts = docs.sparkSession.sparkContext.broadcast(cell_counts(first.where("part >= 0").select("part", "data")))
    classes = stored(members.where("n > 0").groupBy("k1", "k2").agg(F.min("doc").alias("least")), "digests")
    rep = F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc")).alias("rep")
    known = stored(members.join(sized(classes), ["k1", "k2"], "left").select("doc", "n", rep), "classes")
    discard(classes)
    bounds = members.select("doc", "n", F.col("data").alias("spread")).distinct()
    reps = known.select("doc", "rep").distinct()

    prefixes = rows.mapInPandas(_prefixes(size, percent, counts), "token long, doc long")
    shared = stored(prefixes.repartition("token").sortWithinPartitions("token", "doc").mapInPandas(_shared, "token long, doc long"), "shared")

    # Star round. Documents of one class are connected from the start.
    degree = shared.groupBy("doc").agg(F.count("*").alias("degree"))
    labels = reps.groupBy("doc").agg(F.min("rep").alias("label"))
    labelled = shared.join(degree.join(labels, "doc"), "doc").repartition("token").sortWithinPartitions("token", F.desc("degree"), "doc")
    votes = labelled.select("token", "doc", "label").mapInPandas(_centres, "doc long, centre long").groupBy("doc", "centre").count()
    best = votes.groupBy("doc").agg(F.max_by("centre", F.struct("count", -F.col("centre"))).alias("centre"))
    pairs = best.select(F.least("doc", "centre").alias("a"), F.greatest("doc", "centre").alias("b")).distinct()
    pairs = pairs.join(bounds.select(F.col("doc").alias("b"), F.col("n").alias("nb"), F.col("spread").alias("right")), "b")
    pairs = pairs.join(bounds.select(F.col("doc").alias("a"), F.col("n").alias("na"), F.col("spread").alias("left")), "a")
    links = _links(stored(pairs.mapInPandas(_bounded(percent), "a long, b long"), "pairs"), rows, size, percent, counts)
    labels = stored(_labels(reps, links), "labels")

    # Exact round, over tokens whose documents are not all connected. Of tokens that the
    # same documents have, one will do: the others have the same pairs.
    live = shared.join(labels, "doc")
    opened = live.groupBy("token").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("doc")).alias("x1"), F.bit_xor(F.xxhash64(F.lit(1), "doc")).alias("x2"),
    )
    opened = stored(opened.where("low <> high").groupBy("n", "x1", "x2").agg(F.min("token").alias("token")).select("token"), "opened")
    # Stored first: a join with a table, not an aggregate, has its hot tokens split.
    live = stored(live.join(sized(opened), "token", "left_semi").select("token", "doc", "label"), "open")
    discard(shared, opened)
    cells = _cells(live, bounds).repartition("token", "low", "high").sortWithinPartitions("token", "low", "high")
    pairs = stored(cells.mapInPandas(_candidates(percent), "a long, b long").distinct(), "candidates")
    discard(live, first)
    links = links.union(_links(pairs, rows, size, percent, counts))
    return known.join(_labels(reps, links), "doc").select(
        ids_back(F.col("doc")).alias(ident), F.col("n").cast("long").alias("n_shingles"), ids_back(F.col("label")).alias("component_id")
    )


def _labels(reps: DataFrame, links: DataFrame) -> DataFrame:
    """(doc, label) of every document, from links between any members of classes."""
    left = reps.select(F.col("doc").alias("a"), F.col("rep").alias("ra"))
    right = reps.select(F.col("doc").alias("b"), F.col("rep").alias("rb"))
    edges = links.join(left, "a").join(right, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    several = reps.groupBy("doc").agg(F.array_sort(F.collect_set("rep")).alias("all")).where("size(all) > 1")
    edges = edges.union(several.select(F.explode("all").alias("a"), F.col("all")[0].alias("b")))
    found = component_labels(edges).select(F.col("node").alias("rep"), "label")
    return reps.join(found, "rep", "left").groupBy("doc").agg(F.min(F.coalesce("label", "rep")).alias("label"))
