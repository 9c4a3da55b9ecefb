"""Ids of whole texts against the tokenizer itself."""

import random
import struct

import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from linklake.llm import packing

PATH = P.path("word_bpe_49k.json")
PARTS = [*"abzABZéÉßÜüñœİıΣσς’'.,!?-_ \t\n0123<|>ﬁ日本́\xa0\x00\x1c\x1f\x85²½ªºµ÷×·", "<|endoftext|>", "the", "'s", "İ.", "BELEDİYESİ.", "BELEDİYESİ,", "l'été", "..."]


def ids(tokenizer, text):
    found = tokenizer.encode(text, add_special_tokens=False).ids
    return struct.pack(f"<{len(found)}I", *found)


@pytest.mark.parametrize("kept", [1, 50, 200_000])
def test_ids_equal_the_tokenizer(monkeypatch, kept):
    monkeypatch.setattr(packing, "KEPT_WORDS", kept)
    words, tokenizer = packing.WordIds(PATH), Tokenizer.from_file(PATH)
    assert words.short
    random.seed(kept)
    for _ in range(5_000):
        text = "".join(random.choices(PARTS, k=random.randrange(0, 30)))
        assert words.of(text) == ids(tokenizer, text), text
    many = " ".join(f"Wort{i % 90} Häuser{'x' * (i % 7)}, {i}." for i in range(3_000))
    assert words.of(many) == ids(tokenizer, many)
    assert len(words) <= kept and len(words.older) <= kept


def test_special_token_strings_are_what_the_plain_call_gives():
    words = packing.WordIds(PATH)
    assert words.of("a <|endoftext|> b") == ids(Tokenizer.from_file(PATH), "a <|endoftext|> b")
    assert struct.pack("<I", 49_407) in words.of("<|endoftext|>")
