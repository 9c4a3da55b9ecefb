"""How five document filters interact: what each order of them removes, and what that costs.

1. *Flags.* One native scan tells which of the row-wise filters a text fails (bits of a
   mask) and its SHA-256, which stands for the whole text from there on: no two different
   texts with one digest are known, and texts need not travel.
2. *Duplicate prepass.* Every task counts its texts in a counting Bloom sketch cut into
   blocks of ``CELLS`` counters: a text touches ``HASHES`` cells of the one block that its
   hash names. Blocks of all tasks are merged by adding counters, which need not go
   beyond two. A text with a cell that no other text touched is unique for certain and is
   cleared. The number of blocks follows the number of rows, blocks are rows of a table and
   are joined by their number, so neither a task nor the driver ever holds a whole sketch.
3. *Exact duplicates.* Only texts that are not cleared are shuffled, by digest, for the
   smallest id of each; ids above it are repeats.
4. *Counts.* Flags and labels meet, and rows are added up by (part, mask, labels): all that
   the orders need. Every order and step is read off these counts.

Fixed filters: A under 100 words; B 100 * distinct words < 80 * words; C 100 * ``[A-Z]``
characters > 10 * code points; D any of ``#$%&*|``; E the text of a smaller id.

Edge cases: a null text counts as empty, and all empty texts are one text; a null part is the empty
string; a row without an id is never a repeat, makes no other row one, and has no labels;
rows that share an id and a text are not repeats of each other; of several label rows of an id, one 1 is
enough; very long texts are read whole; an empty table gives an empty result; other
columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from linklake.llm.tables import discard, stored

FILTERS = "ABCDE"
REPEATED = 16  # the bit of filter E
CELLS = 1_024  # counters a block
HASHES = 3
CELLS_A_ROW = 8
HELD = 1 << 20  # places that a task holds before it hands them on
_SPLIT = r"[\x20\x09-\x0D]+"


def flags(docs: DataFrame, ident: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """Per row: id, part, mask of the row-wise filters it fails, digest of its text."""
    rows = docs.select(
        F.col(ident).alias("ident"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    rows = rows.select("*", F.array_remove(F.split("text", _SPLIT), "").alias("words"))
    words, distinct = F.size("words"), F.size(F.array_distinct("words"))
    capitals = F.length(F.regexp_replace("text", "[^A-Z]+", ""))
    failed = [
        words < 100,
        100 * distinct.cast("long") < 80 * words.cast("long"),
        100 * capitals.cast("long") > 10 * F.length("text").cast("long"),
        F.col("text").rlike("[#$%&*|]"),
    ]
    mask = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(failed)), F.lit(0))
    return rows.select("ident", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest"))


def _sketched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A task's counters, one row a touched block: 16 bits a touched cell, the highest set
    if it was touched more than once."""
    held: list[np.ndarray] = []

    def handed_on() -> pd.DataFrame:
        places, counts = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        blocks, starts = np.unique(places // CELLS, return_index=True)
        counters = (places % CELLS | (counts > 1) << 15).astype("<u2")
        return pd.DataFrame({"block": blocks, "counters": [c.tobytes() for c in np.split(counters, starts[1:])]})

    for batch in batches:
        cells = np.sort(_cells(batch["bits"].to_numpy(np.int64)), axis=1)
        own = np.ones_like(cells, bool)  # a cell counts once a text
        own[:, 1:] = cells[:, 1:] != cells[:, :-1]
        held.append((batch["block"].to_numpy(np.int64)[:, None] * CELLS + cells)[own])
        if sum(map(len, held)) >= HELD:
            yield handed_on()
    if held:
        yield handed_on()


def _cells(bits: np.ndarray) -> np.ndarray:
    return (bits[:, None] >> np.arange(0, 10 * HASHES, 10)) & (CELLS - 1)


@F.pandas_udf(ArrayType(LongType()))
def _merged(sketches: pd.Series) -> pd.Series:
    """Counters of all tasks added up: a bit a cell, set if its count is two or more."""
    found = []
    for own in sketches:
        cells = np.frombuffer(b"".join(own), "<u2")
        counts = np.bincount(cells & (CELLS - 1), 1 + (cells >> 15), CELLS)
        found.append(np.packbits(counts > 1, bitorder="little").view("<i8"))
    return pd.Series(found)


def _crowded(cell: Column) -> Column:
    word = F.get("crowded", F.shiftright(cell, 6).cast("int"))
    return F.call_function("shiftright", word, (cell % 64).cast("int")).bitwiseAND(F.lit(1)) == 1


def possible_repeats(rows: DataFrame, cells_a_row: int = CELLS_A_ROW) -> DataFrame:
    """Rows (a stored table of ``flags``), with a null digest where the sketch clears them."""
    blocks = max(1, -(-rows.count() * cells_a_row // CELLS))
    hashed = rows.select("*", F.pmod(F.xxhash64("digest"), F.lit(blocks)).alias("block"), F.xxhash64("digest", F.lit(1)).alias("bits"))
    sketch = hashed.select("block", "bits").mapInPandas(_sketched, "block long, counters binary")
    sketch = stored(sketch.groupBy("block").agg(_merged(F.collect_list("counters")).alias("crowded")), "sketch")
    cells = [F.shiftright("bits", 10 * i).bitwiseAND(F.lit(CELLS - 1)) for i in range(HASHES)]
    crowded = _crowded(cells[0]) & _crowded(cells[1]) & _crowded(cells[2])
    looked_up = hashed.join(sketch, "block").select("ident", "part", "mask", F.when(crowded, F.col("digest")).alias("digest"))
    return stored(looked_up, "looked-up")


def masks(rows: DataFrame) -> DataFrame:
    """(ident, part, mask) with the bit of repeated texts, from rows that were looked up."""
    open_rows = rows.where("digest is not null")
    groups = open_rows.groupBy("digest").agg(F.min("ident").alias("least"), F.count("*").alias("n"))
    groups = stored(groups.where("n > 1").select("digest", "least"), "repeats")
    repeated = F.when(F.col("ident") > F.col("least"), REPEATED).otherwise(0)
    told = open_rows.join(groups, "digest", "left").select("ident", "part", (F.col("mask") + repeated).alias("mask"))
    return rows.where("digest is null").select("ident", "part", "mask").union(told)


def mask_counts(docs: DataFrame, labels: DataFrame, ident: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(part, mask, good, toxic, n): rows by what they fail and how they are labelled."""
    rows = stored(flags(docs, ident, text, part), "flags")
    looked_up = possible_repeats(rows)
    discard(rows)
    one = [F.max(F.coalesce((F.col(name) == 1).cast("int"), F.lit(0))).alias(flag) for name, flag in (("quality", "good"), ("toxic", "toxic"))]
    known = labels.where(F.col(ident).isNotNull()).groupBy(F.col(ident).alias("ident")).agg(*one)
    known = stored(known.where("good + toxic > 0"), "labelled")
    joined = masks(looked_up).join(known, "ident", "left")
    flag = [F.coalesce(name, F.lit(0)).alias(name) for name in ("good", "toxic")]
    return joined.select("part", "mask", *flag).groupBy("part", "mask", "good", "toxic").agg(F.count("*").alias("n"))


def interactions(counts: DataFrame) -> DataFrame:
    """Every order of the filters and every step of it, from additive counts.

    A row is removed by the first filter of the order that it fails, so an order's step
    needs no more than the mask. Of all orders, each filter that a row fails comes first
    in an equal share.
    """
    orders = " ".join("".join(order) for order in permutations(FILTERS))
    shares = len(orders.split())
    rows = counts.select("*", F.explode(F.split(F.lit(orders), " ")).alias("filter_order"))
    bits = [F.expr(f"shiftleft(1, ascii(substring(filter_order, {k}, 1)) - 65)") for k in range(1, 6)]
    steps = [F.struct(F.lit(k + 1).alias("step"), bits[k].alias("bit"), sum(bits[:k], F.lit(0)).alias("before")) for k in range(5)]
    rows = rows.select("part", "mask", "good", "toxic", "n", "filter_order", F.inline(F.array(*steps)))
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    gone = F.col("mask").bitwiseAND(F.col("before")) != 0

    def total(when: Column, amount: Column = F.col("n")) -> Column:
        return F.sum(F.when(when, amount).otherwise(0)).cast("long")

    removed = fails & ~gone
    return rows.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone).alias("kept"), total(removed).alias("removed"), total(fails & gone).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(removed & (F.col("good") == 1)).alias("good_lost"), total(removed & (F.col("toxic") == 1)).alias("toxic_lost"),
        total(fails, F.expr(f"n * ({shares} div bit_count(mask))")).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, ident: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    return interactions(mask_counts(docs, labels, ident, text, part))
