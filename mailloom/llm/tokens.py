"""Token ids of documents by a byte-level vocabulary, as one run of bytes per document."""

from __future__ import annotations

import os
import re
from array import array
from codecs import charmap_decode
from functools import lru_cache

import regex

from mailloom.llm.chunks import Known, windows

#: How a byte-level tokenizer splits its input before the merges (fixed value).
_SPLIT = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

#: The same for ASCII.
_SPLIT_ASCII = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII
)

#: Chunks whose classes of characters every version of Unicode agrees on.
_USUAL = re.compile(r"[\t\n\r -~\xa1-ɏ]*")
_USUAL_ASCII = re.compile(r"[\t\n\r -~]*")


def vocabulary(name: str) -> str:
    """The place of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def tokenizer(path: str, plain: bool = False):
    """A tokenizer; ``plain`` reads the strings of special tokens as ordinary text."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.encode_special_tokens = plain
    return found


def byte_letters() -> str:
    """The character that stands for each byte in a byte-level vocabulary.

    Visible characters of Latin-1 stand for themselves, the others for U+0100 and on.
    """
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return "".join(chr(b if b in seen else next(hidden)) for b in range(256))


@lru_cache(maxsize=4)
def _encoders(path: str):
    full = tokenizer(path)
    model, letters = full.model, byte_letters()
    special = re.compile("|".join(
        re.escape(token.content) for token in full.get_added_tokens_decoder().values()
    ) or r"(?!)").search

    def exact(text: str) -> bytes:
        return array("I", full.encode(text, add_special_tokens=False).ids).tobytes()

    def merged(text: str) -> bytes:
        spelt = charmap_decode(text.encode(), "strict", letters)[0]
        return array("I", [token.id for token in model.tokenize(spelt)]).tobytes()

    parts = Known(merged)

    def chunk(c: str) -> bytes:
        text = " " + c
        plain = c.isascii()
        if plain and c.isalpha():
            return merged(text)
        if not (_USUAL_ASCII if plain else _USUAL).fullmatch(c) or special(c):
            return exact(text)
        return b"".join(parts.of((_SPLIT_ASCII if plain else _SPLIT).findall(text)))

    return exact, Known(chunk)


def packed_ids(texts: list[str], path: str) -> list[bytes]:
    """The ids of texts as 32-bit numbers, without special tokens added."""
    exact, known = _encoders(path)

    def ids(text: str) -> bytes:
        lists = windows(text)
        first = next(lists)
        found = [exact(first[0]), *known.of(first[1:])]
        for chunks in lists:
            found += known.of(chunks)
        return b"".join(found)

    return [*map(ids, texts)]
