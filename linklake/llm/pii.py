"""Personal data in texts, also where it is written so that plain patterns miss it.

Plain spans come from the patterns on the text as it is. Then the text runs through three
transducers, each of which writes a plainer text and keeps the list of its edits:

1. *letters*: homoglyphs, compatibility forms and digits of other scripts become ASCII, marks
   without width go;
2. *numbers*: runs of spelled digits ("plus four nine, double five ...") become digits;
3. *signs*: at and dot in disguise (``[at]``, ``(dot)``, ``[.]``, " at ... dot ...") become
   ``@`` and ``.``.

The same patterns are applied to the outcome. What is found where something was rewritten is mapped back
through the edits to code points of the source and added to the plain spans, which all
stay. An added span that overlaps a plain one of its kind is dropped, but for an
e-mail address, which a homoglyph can cut short.

All scans are linear in the text, whatever it holds, and texts are read whole.

Edge cases: null and empty texts hold nothing; a null id stays null; repeated rows get equal
results; spans are ordered by kind and place, so there are no ties; an empty table gives an empty result; other columns, whatever
their names, are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linklake.llm.tables import ids, ids_back

KINDS = ("email", "ip", "card", "phone")
SPAN = "struct<kind: string, start: long, end: long, added: boolean, plain: string>"

# --- patterns ---------------------------------------------------------------

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")  # never fails inside a number, so none is looked at twice
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ to the left as far as the name goes, so no run is looked at twice."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """Four parts each from chains of numbers, from the left."""
    for chain in _DOTTED.finditer(text):
        if chain.end() - chain.start() < 7:
            continue
        parts = chain[0].split(".")
        at = chain.start()
        for i in range(0, len(parts) - 3, 4):
            own = parts[i : i + 4]
            end = at + sum(map(len, own)) + 3
            if all(len(value := p.lstrip("0")) <= 3 and int(value or 0) <= 255 for p in own):
                yield at, end
            at = end + 1


def _luhn(digits: str) -> bool:
    twice = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (twice + sum(map(int, digits[-1::-2]))) % 10 == 0


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 13:
            digits = _NOT_DIGIT.sub("", match[0])
            if 13 <= len(digits) <= 19 and _luhn(digits):
                yield match.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for match in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", match[0])) <= 15:
            yield match.span()


_FINDERS = dict(zip(KINDS, (_emails, _ips, _cards, _phones), strict=True))

# --- edits ------------------------------------------------------------------


class Edited:
    """A text rewritten at some places, with the way back to the text before."""

    def __init__(self, text: str, edits: Iterable[tuple[int, int, str]]):
        """``edits``: start, end and new text, in order and apart from each other."""
        parts, done, size = [], 0, 0
        self.new_starts: list[int] = []
        self.new_ends: list[int] = []
        self.old: list[tuple[int, int]] = []
        for start, end, new in edits:
            parts += (text[done:start], new)
            size += start - done
            self.new_starts.append(size)
            size += len(new)
            self.new_ends.append(size)
            self.old.append((start, end))
            done = end
        self.text = "".join((*parts, text[done:])) if parts else text

    def start_before(self, place: int) -> int:
        """Where what begins at ``place`` began before; the start of an edit, if inside one."""
        i = bisect_right(self.new_starts, place) - 1
        if i < 0:
            return place
        return self.old[i][0] if place < self.new_ends[i] else self.old[i][1] + place - self.new_ends[i]

    def end_before(self, place: int) -> int:
        i = bisect_left(self.new_starts, place) - 1
        if i < 0:
            return place
        return self.old[i][1] if place <= self.new_ends[i] else self.old[i][1] + place - self.new_ends[i]


# --- 1: letters -------------------------------------------------------------

# Letters of other scripts that look like ASCII ones, and signs that look like
# the dot, the hyphen and the like. Forms that Unicode itself calls compatible (full width,
# mathematical, circled) and digits of all scripts are told by rule.
_LOOKALIKES = dict(
    pair.split("=")
    for pair in (
        "А=A В=B Е=E К=K М=M Н=H О=O Р=P С=C Т=T Х=X У=Y Ѕ=S І=I Ј=J Ԛ=Q Ԝ=W "
        "а=a е=e о=o р=p с=c х=x у=y ѕ=s і=i ј=j ԛ=q ԝ=w һ=h ԁ=d ӏ=l ո=n ս=u ց=g օ=o "
        "Α=A Β=B Ε=E Ζ=Z Η=H Ι=I Κ=K Μ=M Ν=N Ο=O Ρ=P Τ=T Υ=Y Χ=X α=a ο=o ν=v ι=i ρ=p υ=u κ=k "
        "ı=i ɑ=a ɡ=g ɩ=i ʟ=l "
        "‐=- ‑=- ‒=- –=- —=- ―=- −=- ﹘=- 。=. ․=. ·=. ‧=. ∙=. ⋅=. 。=. ٫=. ｡=. ⁄=/ ＠=@ ﹫=@"
    ).split()
)
# Code points that take no room on the page.
_NO_WIDTH = "­͏؜᠎​‌‍‎‏⁠⁡⁢⁣️﻿"
_FOREIGN = re.compile(r"[^\x00-\x7f]")


@lru_cache(maxsize=1 << 16)
def _plain(character: str) -> str | None:
    """What a code point beyond ASCII is rewritten to; None if it stays."""
    if character in _NO_WIDTH:
        return ""
    if character in _LOOKALIKES:
        return _LOOKALIKES[character]
    digit = unicodedata.decimal(character, None)
    if digit is not None:
        return str(digit)
    form = unicodedata.normalize("NFKC", character)
    return form if len(form) == 1 and form.isascii() and form != character else None


def _letters(text: str) -> Iterator[tuple[int, int, str]]:
    if text.isascii():
        return
    changed = [c for c in set(text) if c > "\x7f" and _plain(c) is not None]
    if changed:
        for match in re.finditer(f"[{''.join(map(re.escape, changed))}]", text):
            yield match.start(), match.end(), _plain(match[0])


# --- 2: numbers -------------------------------------------------------------

# Digits in words, in the four languages of the given texts.
_DIGITS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
_TIMES = {"double": 2, "doppel": 2, "doble": 2, "triple": 3}
_LINKS = {"dot": ".", "point": ".", "punkt": ".", "punto": ".", "dash": "-", "hyphen": "-", "minus": "-"}
_WORD = "|".join(sorted((*_DIGITS, *_TIMES, *_LINKS), key=len, reverse=True))
_SPELLED = re.compile(rf"(?i)(?<![^\W_])(?:{_WORD})(?![^\W_])")
_PIECE = re.compile(rf"(?i)(?:{_WORD}|plus)(?![^\W_])|[0-9]+")
_GAP = re.compile(r"[\x20\t\n,;/]{1,3}|[\x20]?[.()+\[\]-]{1,2}[\x20]?|")
LEAST_SPELLED = 3  # digits in words that a run needs


def _runs(text: str) -> Iterator[list[re.Match]]:
    """Pieces of numbers that follow each other, from the first spelled one."""
    done = 0
    for first in _SPELLED.finditer(text):
        if first.start() < done:
            continue
        run = [first]
        before = re.compile(r"(?i)(?<![^\W_])plus[\x20\t]{1,2}\Z").search(text, max(done, first.start() - 8), first.start())
        while True:
            gap = _GAP.match(text, run[-1].end())
            piece = _PIECE.match(text, gap.end())
            if not piece or gap.end() == gap.start() and piece[0][0].isalnum() and run[-1][0][-1].isalpha() == piece[0][0].isalpha():
                break
            run.append(piece)
        done = run[-1].end()
        yield ([before] if before else []) + run


# Lower case for letters, a space for what parts words: a cheap look at a text's words.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_DIGIT_WORDS = frozenset(word.encode() for word in _DIGITS)


def _words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def _numbers(text: str) -> Iterator[tuple[int, int, str]]:
    """Digits and signs for words; white space between two digits goes."""
    words = _words(text if text.isascii() else text.lower())
    if _DIGIT_WORDS.isdisjoint(words) or sum(map(_DIGIT_WORDS.__contains__, words)) < LEAST_SPELLED:
        return
    for run in _runs(text):
        words = [piece[0].strip().lower() for piece in run]
        if sum(w in _DIGITS for w in words) < LEAST_SPELLED:
            continue
        times, new = 1, []
        for word in words:
            if word in _TIMES:
                new.append("")
                times = _TIMES[word]
            else:
                new.append(_DIGITS[word] * times if word in _DIGITS else _LINKS.get(word, "+" if word == "plus" else word))
                times = 1
        for i, (piece, written) in enumerate(zip(run, new, strict=True)):
            end = piece.start() + len(piece[0].rstrip())
            if written != piece[0]:
                yield piece.start(), end, written
            if i + 1 < len(run) and end < run[i + 1].start() and not text[end : run[i + 1].start()].strip("\x20\t\n,;/"):
                yield end, run[i + 1].start(), ""


# --- 3: signs ---------------------------------------------------------------

_OPEN, _CLOSE = r"[\x20\t]*[\[({<][\x20\t]*", r"[\x20\t]*[\])}>][\x20\t]*"
_DOT_WORD = "dot|punkt|point|punto"
_DOT = rf"(?:{_OPEN}(?:{_DOT_WORD}|\.){_CLOSE}|[\x20\t]+(?:{_DOT_WORD})[\x20\t]+|_(?:{_DOT_WORD})_)"
_LABEL = r"[A-Za-z0-9-]+"
_NAME = r"(?<=[A-Za-z0-9._%+-])"
_SIGN = re.compile(
    rf"(?i)(?P<at>{_NAME}(?:{_OPEN}(?:at|@){_CLOSE}|[\x20\t]+@[\x20\t]*|@[\x20\t]+)(?={_LABEL}(?:{_DOT}|[\x20\t]?\.[\x20\t]?){_LABEL}))"
    rf"|(?P<bare>{_NAME}(?:[\x20\t]+at[\x20\t]+|_at_)(?={_LABEL}{_DOT}{_LABEL}))"
    rf"|(?P<told>{_NAME}[\x20\t]+at[\x20\t]+(?={_LABEL}(?:\.{_LABEL})+))"
    rf"|(?P<dot>(?<=[A-Za-z0-9-]){_DOT}(?={_LABEL}))"
    rf"|(?P<spaced>(?<=[A-Za-z0-9-])(?:[\x20\t]\.[\x20\t]?)(?={_LABEL}))"
)
_HINT = re.compile(rf"[\[({{<][\x20\t]*\.|[\x20\t](?i:at)[\x20\t]+{_LABEL}\.{_LABEL}")
_BRACKETED = re.compile(r"[\[({<][\x20\t]*(?i:at)[\x20\t]*[\])}>]")
_SIGN_WORDS = frozenset(word.encode() for word in _DOT_WORD.split("|"))


def _mailbox(text: str, end: int) -> bool:
    """Does a name that is no plain word end here?"""
    start = end
    while start and end - start < 64 and _LOCAL.match(text, start - 1):
        start -= 1
    return bool(re.search(r"[0-9_%+]|[A-Za-z0-9][.-][A-Za-z0-9]", text[start:end]))


def _signs(text: str) -> Iterator[tuple[int, int, str]]:
    if not ("@" in text or _HINT.search(text) or not _SIGN_WORDS.isdisjoint(_words(text)) or _BRACKETED.search(text)):
        return
    in_domain = -1  # where the domain that is being written ends
    for match in _SIGN.finditer(text):
        kind = match.lastgroup
        if kind == "spaced" and match.start() != in_domain:
            continue
        if kind == "told" and not _mailbox(text, match.start()):
            continue
        yield match.start(), match.end(), "." if kind in ("dot", "spaced") else "@"
        in_domain = re.compile(rf"{_LABEL}(?:\.{_LABEL})*").match(text, match.end()).end()


# --- all together -----------------------------------------------------------

TRANSDUCERS: tuple[Callable[[str], Iterator[tuple[int, int, str]]], ...] = (_letters, _numbers, _signs)


_DIGIT_RUN = re.compile("[0-9]+")


def _digit_letters(text: str) -> Iterator[tuple[int, int, str]]:
    """O, o, l and I beside a digit, read as digits."""
    done = 0
    for run in _DIGIT_RUN.finditer(text):
        for place in (run.start() - 1, run.end()):
            if done <= place < len(text) and text[place] in "OolI":
                yield place, place + 1, "0" if text[place] in "Oo" else "1"
                done = place + 1


def spans(text: str) -> list[tuple[str, int, int, bool, str]]:
    """Kind, start, end, whether it was added, and its plain form; ordered by kind and place."""
    found = {kind: [(start, end, False, text[start:end]) for start, end in find(text)] for kind, find in _FINDERS.items()}
    steps, plain = [], text
    for transducer in TRANSDUCERS:
        step = Edited(plain, transducer(plain))
        if step.old:
            steps.append(step)
            plain = step.text
    variants = [(steps, plain, KINDS)] if steps else []
    step = Edited(plain, _digit_letters(plain))
    if step.old:  # numbers alone, as addresses may well hold such letters
        variants.append(([*steps, step], step.text, KINDS[1:]))
    for way, plain, kinds in variants:
        for kind in kinds:
            own = found[kind]
            for start, end in _FINDERS[kind](plain):
                form = plain[start:end]
                for step in reversed(way):
                    start, end = step.start_before(start), step.end_before(end)
                if text[start:end] == form:
                    continue  # nothing was rewritten here
                met = [s for s in own if s[0] < end and start < s[1]]
                if not met or kind == "email" and all(start <= s[0] and s[1] <= end and not s[2] for s in met):
                    own.append((start, end, True, form))
    return [(kind, *span) for kind in KINDS for span in sorted(found[kind])]


def _found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ("kind", "start", "end", "added", "plain")
    for batch in batches:
        rows = [[dict(zip(names, span, strict=True)) for span in spans(text or "")] for text in batch["text"]]
        yield pd.DataFrame({"doc": batch["doc"].to_numpy(), "spans": rows})


def personal_data(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, and ``spans`` with kind, start, end (code points), whether the span was
    added by a rewriting, and its plain form."""
    rows = docs.select(ids(ident).alias("doc"), F.col(text).alias("text"))
    found = rows.mapInPandas(_found, f"doc long, spans array<{SPAN}>")
    return found.select(ids_back(F.col("doc")).alias(ident), "spans")


def listed(spans_column: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans_column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _is(kind: str) -> Callable[[Column], Column]:
    return lambda own: own == kind


def digest(found: DataFrame) -> DataFrame:
    """Counts of plain spans, a hash of them, and all spans as text."""
    plain = F.filter("spans", lambda s: ~s["added"])
    kinds = F.transform(plain, lambda s: s["kind"])
    count = [F.size(F.array_remove(F.transform(kinds, _is(kind)), False)).cast("long").alias(f"n_{kind}") for kind in KINDS]
    added = F.size(F.filter("spans", lambda s: s["added"])).cast("long").alias("n_added")
    rest = [c for c in found.columns if c != "spans"]
    return found.select(*rest, *count, F.sha2(listed(plain), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"), added)
