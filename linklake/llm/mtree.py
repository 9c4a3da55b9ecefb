"""Exact top-k by inner product with M-trees.

Vectors become whole numbers. One more component, chosen so that all have the same length,
turns the highest inner product into the smallest Euclidean distance, which is a metric.
Rows are dealt into shards of bounded size. A shard's tree is built in one task and kept as
pages: an inner page holds routing vectors with covering radii and distances to the parent,
a leaf page holds vectors with distances to the parent. Queries are dealt into blocks, and
a task searches one tree for one block, many queries at a time: pages wait in a queue by the least
distance anything below can have from any of them; the triangle inequality on stored distances rules entries out before any
distance is computed. The shards' best are merged per query.

Distances only rule out; scores are exact whole numbers, and ties go to the smaller id, then
to the row that was read first.

How much the bounds rule out is up to the data: where neighbours lie in clusters, most rows
are passed over; among vectors that all lie about equally far from each other, as random ones in
many dimensions do, no metric bound can rule out anything.

Edge cases: vectors that are null or hold null or non-finite components take no part; an
empty vector scores 0 with every row; shorter vectors count as padded with zeros; rows that
share an id are rows of their own, as candidates and as queries; a row without an id is a
candidate whose id is null and comes last among ties; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linklake.llm.tables import stored

SHARD_ROWS = 16_384
QUERY_ROWS = 4_096
TOGETHER = 256  # queries of a block that are searched for at once
LEAF_ROWS = 128
FAN_OUT = 16
SCALE = 256
PAGE = "shard int, page int, leaf boolean, size int, ids binary, vectors binary, radii binary, to_parent binary"
FOUND = "query_id long, query_row long, vec_id long, row long, score long"
NO_ID = (1 << 63) - 1  # stands for a null id inside tasks


def whole_numbers(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & finite


def lifted(vectors: np.ndarray, longest: int) -> np.ndarray:
    """One more component, so that all squared lengths are ``longest``."""
    rest = np.sqrt(np.maximum(longest - (vectors * vectors).sum(1), 0).astype(float))
    return np.column_stack([vectors.astype(float), rest])


def _away(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(((points - centre) ** 2).sum(1), 0))


class _Builder:
    """Pages of one shard, built from the top: far-apart routing vectors split the rows."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, longest: int):
        self.ids, self.vectors, self.points = ids, vectors, lifted(vectors, longest)
        self.pages: list[tuple] = []

    def build(self, rows: np.ndarray, centre: np.ndarray) -> int:
        """Page number of a subtree over ``rows`` whose routing vector is ``centre``. Entries of
        a leaf are known by id and row number."""
        number = len(self.pages)
        self.pages.append(())
        if len(rows) <= LEAF_ROWS:
            self.pages[number] = (True, self.ids[rows], self.vectors[rows], np.zeros(0), _away(self.points[rows], centre))
            return number
        # Routing vectors: each new one is the farthest from those before.
        near = _away(self.points[rows], self.points[rows[0]])
        group = np.zeros(len(rows), int)
        seeds = [rows[0]]
        while len(seeds) < FAN_OUT and near.max() > 0:
            far = int(near.argmax())
            distance = _away(self.points[rows], self.points[rows[far]])
            closer = distance < near
            group[closer], near = len(seeds), np.where(closer, distance, near)
            seeds.append(rows[far])
        if len(seeds) == 1:  # all equal: even parts
            group = np.arange(len(rows)) * FAN_OUT // len(rows)
            seeds = seeds * FAN_OUT
        routing, children, radii, to_parent = [], [], [], []
        for g, seed in enumerate(seeds):
            own = rows[group == g]
            if not len(own):
                continue
            point = self.points[seed]
            children.append(self.build(own, point))
            routing.append(point)
            radii.append(_away(self.points[own], point).max())
            to_parent.append(float(np.sqrt(((point - centre) ** 2).sum())))
        self.pages[number] = (False, np.array(children, np.int64), np.array(routing), np.array(radii), np.array(to_parent))
        return number


def _built(longest: int, width: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        order = np.lexsort((rows["row"].to_numpy(), rows["vec_id"].to_numpy()))
        ids = rows[["vec_id", "row"]].to_numpy(np.int64)[order]
        vectors = _matrix([rows["vector"].iloc[i] for i in order], width)
        builder = _Builder(ids, vectors, longest)
        builder.build(np.arange(len(ids)), builder.points[0])
        pages = [
            (key[0], i, leaf, len(kids), np.ascontiguousarray(kids).tobytes(), np.ascontiguousarray(found).tobytes(), radii.tobytes(), np.asarray(to_parent, float).tobytes())
            for i, (leaf, kids, found, radii, to_parent) in enumerate(builder.pages)
        ]
        return pd.DataFrame(pages, columns=[p.split()[0] for p in PAGE.split(", ")])

    return run


def _matrix(vectors: list, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


class Tree:
    """The pages of one shard, opened for search."""

    def __init__(self, pages: pd.DataFrame, width: int, longest: int):
        self.longest = longest
        self.pages = {}
        for row in pages.itertuples(index=False):
            kind, columns = (np.int64, width) if row.leaf else (float, width + 1)
            ids = np.frombuffer(row.ids, np.int64)
            ids = ids.reshape(-1, 2) if row.leaf else ids
            vectors = np.frombuffer(row.vectors, kind).reshape(len(ids), columns)
            self.pages[row.page] = (row.leaf, ids, vectors, np.frombuffer(row.radii, float), np.frombuffer(row.to_parent, float))
        self.first = self._first()
        self.computed = 0

    def _first(self) -> np.ndarray:
        """The root's own routing vector: the shard's row of smallest id."""
        page = self.pages[0]
        while not page[0]:
            page = self.pages[int(page[1][0])]
        return lifted(page[2][:1], self.longest)[0]

    def best(self, own_row: int, query: np.ndarray, k: int) -> list[tuple[int, int, int]]:
        """(score, id, row) of the k best, best first."""
        return self.best_of_each(np.array([own_row]), query[None, :], k)[0]

    def best_of_each(self, own_rows: np.ndarray, queries: np.ndarray, k: int) -> list[list[tuple[int, int, int]]]:
        """The same for several queries, which wait at the pages together: a page is opened once
        for all that its bounds do not rule out. Each has limits of its own."""
        points = np.column_stack([queries.astype(float), np.zeros(len(queries))])
        base = (points * points).sum(1) + self.longest
        slack = 1e-6 * (1 + np.sqrt(base))
        # Sums of products stay whole in doubles below 2^53.
        exact = queries.astype(float) if base.max(initial=0) < 1 << 53 else queries
        found: list[np.ndarray] = [np.empty((0, 3), np.int64) for _ in queries]  # (score, id, row), best first
        worst = np.full(len(queries), np.iinfo(np.int64).min)
        limit = np.full(len(queries), np.inf)
        queue = [(0.0, 0, np.zeros(len(queries)), _away(points, self.first))]
        while queue:
            first, number, least, parent = heapq.heappop(queue)
            if first > limit.max():
                break
            asks = np.flatnonzero(least <= limit)
            if not len(asks):
                continue
            leaf, ids, vectors, radii, to_parent = self.pages[number]
            apart = np.abs(parent[asks, None] - to_parent)
            if not leaf:
                near = apart - radii <= limit[asks, None]
                for i in np.flatnonzero(near.any(0)):
                    own = asks[near[:, i]]
                    self.computed += len(own)
                    distance, bound = np.zeros(len(queries)), np.full(len(queries), np.inf)
                    distance[own] = _away(points[own], vectors[i])
                    bound[own] = np.maximum(distance[own] - radii[i] - slack[own], 0)
                    heapq.heappush(queue, (float(bound.min()), int(ids[i]), bound, distance))
                continue
            near = apart - slack[asks, None] <= limit[asks, None]
            self.computed += int(near.sum())
            scores = exact[asks] @ vectors.astype(exact.dtype).T
            near &= (scores >= worst[asks, None]) & (ids[:, 1] != own_rows[asks, None])
            for j in np.flatnonzero(near.any(1)):
                q, new = asks[j], near[j]
                entries = np.concatenate([found[q], np.column_stack([scores[j, new].astype(np.int64), ids[new]])])
                found[q] = entries[np.lexsort((entries[:, 2], entries[:, 1], -entries[:, 0]))[:k]]
                if len(found[q]) == k:
                    worst[q] = found[q][-1, 0]
                    limit[q] = np.sqrt(max(base[q] - 2.0 * float(worst[q]), 0.0)) + slack[q]
        return [list(map(tuple, entries.tolist())) for entries in found]


def _searched(width: int, longest: int, k: int):
    def run(pages: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(pages) and len(queries):
            tree = Tree(pages, width, longest)
            for at in range(0, len(queries), TOGETHER):
                asking = queries.iloc[at : at + TOGETHER]
                best = tree.best_of_each(asking["row"].to_numpy(np.int64), _matrix(list(asking["vector"]), width), k)
                for own, own_row, entries in zip(asking["vec_id"], asking["row"], best, strict=True):
                    rows.extend((own, own_row, other, row, score) for score, other, row in entries)
        return pd.DataFrame(rows, columns=[p.split()[0] for p in FOUND.split(", ")]).astype("int64")

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of each query row with
    every other row."""
    from pyspark.sql import Window

    rows = vectors.where(usable(F.col(vector))).select(
        F.coalesce(F.col(ident).cast("long"), F.lit(NO_ID)).alias("vec_id"), whole_numbers(F.col(vector)).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"), F.monotonically_increasing_id().alias("row"),
    )
    rows = stored(rows, "vectors")
    length = F.aggregate("vector", F.lit(0).cast("long"), lambda t, x: t + x * x)
    n, asked, width, longest = rows.agg(F.count("*"), F.count_if("asks"), F.max(F.size("vector")), F.max(length)).first()
    shards, blocks = max(1, -(-n // SHARD_ROWS)), max(1, -(-asked // QUERY_ROWS))
    width, longest = width or 0, longest or 0
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    pages = stored(dealt.select("shard", "vec_id", "row", "vector").groupBy("shard").applyInPandas(_built(longest, width), PAGE), "pages")
    tree = pages.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    queries = rows.where("asks").withColumn("block", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).cast("int"))
    queries = queries.select("vec_id", "row", "vector", "block", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    found = tree.groupBy("shard", "block").cogroup(queries.groupBy("shard", "block")).applyInPandas(_searched(width, longest, k), FOUND)
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row"))
    found = found.withColumn("rank", rank).where(F.col("rank") <= k)
    ids = [F.nullif(F.col(name), F.lit(NO_ID)).alias(name) for name in ("query_id", "vec_id")]
    return found.select(ids[0], "rank", ids[1], "score")
