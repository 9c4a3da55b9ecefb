"""Token counts per section, from one encoding of the whole text.

A text is encoded once. Its tokens are byte spans that follow one another; its sections
are spans too. The two sorted lists of spans are joined as intervals, and a token that
crosses a boundary is allocated by an explicit rule:

* ``first``: to the section of its first byte,
* ``last``: to the section of its last byte,
* ``share``: to each section by its share of the token's bytes (counts are fractions).

Counts of a text's sections add up to its token count under every rule.

Sections of a single text are its lines, each with its line break. Sections of several
fields are the fields themselves: they are joined by a separator, which belongs to the
field before it, and encoded as one text.

Edge cases: null and empty texts have one empty section without tokens; a null field is an
empty section; a null id stays null; repeated rows give repeated results; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linklake.llm.bpe import Codec, codec
from linklake.llm.tables import ids, ids_back

RULES = ("first", "last", "share")
SECTION = "section int, start long, length long, n_tokens double, n_crossing long"


def allocated(token_ends: np.ndarray, section_ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section under a rule, and tokens that begin there and end elsewhere.

    Both lists hold the ends of spans that follow one another from 0, in bytes. Sections
    may be empty, tokens may not.
    """
    sections = len(section_ends)
    starts = np.concatenate([[0], token_ends[:-1]]) if len(token_ends) else token_ends
    first = np.searchsorted(section_ends, starts, "right")
    last = np.searchsorted(section_ends, token_ends - 1, "right")
    crossing = np.bincount(first[first != last], minlength=sections)
    if rule in ("first", "last"):
        return np.bincount(first if rule == "first" else last, minlength=sections).astype(float), crossing
    # Cut every token at every boundary; each part weighs its bytes over the token's.
    cuts = np.union1d(token_ends, section_ends[section_ends > 0])
    lengths = np.diff(np.concatenate([[0], cuts]))
    token = np.searchsorted(token_ends, cuts, "left")
    section = np.searchsorted(section_ends, cuts, "left")
    weights = lengths / (token_ends - starts)[token] if len(token_ends) else lengths
    return np.bincount(section, weights, minlength=sections), crossing


def _token_ends(own: Codec, text: str) -> np.ndarray:
    ids = own.encode(text)
    return np.cumsum(np.fromiter(map(len, map(own.bytes_of.__getitem__, ids)), np.int64, len(ids)))


def _sections(own: Codec, text: str, section_ends: np.ndarray, rule: str) -> tuple[np.ndarray, ...]:
    counts, crossing = allocated(_token_ends(own, text), section_ends, rule)
    starts = np.concatenate([[0], section_ends[:-1]])
    return np.arange(len(section_ends)), starts, section_ends - starts, counts, crossing


def line_ends(text: bytes) -> np.ndarray:
    """Ends of the lines, in bytes; a text without one is a single empty section."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    return ends if len(ends) and ends[-1] == len(text) else np.append(ends, len(text))


def _rows(path: str, pattern: str, rule: str, cut):
    """One output row a section; ``cut`` gives a value's text and the ends of its sections."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(path, pattern)
        for batch in batches:
            found, sizes = [], []
            for value in batch["value"]:
                found.append(_sections(own, *cut(value), rule))
                sizes.append(len(found[-1][0]))
            if not found:
                continue
            columns = [np.concatenate(c) for c in zip(*found, strict=True)]
            names = [part.split()[0] for part in SECTION.split(", ")]
            yield pd.DataFrame({"doc": batch["doc"].repeat(sizes).to_numpy(), **dict(zip(names, columns, strict=True))})

    return run


def _exploded(docs: DataFrame, ident: str, value: Column, path: str, pattern: str, rule: str, cut) -> DataFrame:
    rows = docs.select(ids(ident).alias("doc"), value.alias("value"))
    found = rows.mapInPandas(_rows(path, pattern, _checked(rule), cut), f"doc long, {SECTION}")
    return found.select(ids_back(F.col("doc")).alias(ident), *found.columns[1:])


def line_counts(docs: DataFrame, path: str, pattern: str, ident: str = "doc_id", text: str = "text", rule: str = "first") -> DataFrame:
    """One row a line: id, section, byte start and length, tokens, and tokens that cross its end."""
    return _exploded(docs, ident, F.col(text), path, pattern, rule, lambda t: (t or "", line_ends((t or "").encode())))


def field_counts(docs: DataFrame, fields: list[str], path: str, pattern: str, ident: str = "doc_id", rule: str = "first", separator: str = "\n") -> DataFrame:
    """One row a field, sections numbered in the order given."""
    values = F.array(*(F.col(f).cast("string") for f in fields))

    def cut(found) -> tuple[str, np.ndarray]:
        parts = [v or "" for v in found]
        parts = [p + separator for p in parts[:-1]] + parts[-1:]
        return "".join(parts), np.cumsum([len(p.encode()) for p in parts])

    return _exploded(docs, ident, values, path, pattern, rule, cut)


def _checked(rule: str) -> str:
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    return rule
