"""Hashed n-grams of words and characters as sparse vectors."""

from __future__ import annotations

import re
import zlib

import numpy as np

#: Words, and runs of other characters that are not white space.
TOKEN = re.compile(r"\w+|[^\w\s]+")

#: Slots of a word model and of a character model, as powers of two.
WORD_BITS, CHAR_BITS = 18, 16

#: A document's shares of n-grams add up to this, whatever its length.
SCALE = 16.0

#: Distinct words remembered by a worker with their hashes.
REMEMBERED = 200_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0x100000001B3)
_known: dict[str, int] = {}


def _shape(token: str) -> str:
    if not (token[0].isalnum() or token[0] == "_"):
        return token[:1] + str(min(len(token), 4))
    kind = "9" if token.isdigit() else "X" if token.isupper() else "x" if token.islower() else "m"
    return kind + str(min(len(token) // 3, 5))


def _hashes(token: str) -> int:
    both = zlib.crc32(token.lower().encode()) << 32 | zlib.crc32(_shape(token).encode())
    if len(_known) >= REMEMBERED:
        _known.clear()
    _known[token] = both
    return both


def _slots(values: np.ndarray, kind: int, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        mixed = (values + np.uint64(kind)) * _MIX
        mixed ^= mixed >> np.uint64(29)
        mixed *= _MIX
    return (mixed >> np.uint64(64 - bits)).astype(np.int64)


def word_slots(text: str) -> np.ndarray:
    """Slots of the words, word pairs and pairs of word shapes of a text, repeats included."""
    known = _known
    packed = [known.get(t) or _hashes(t) for t in TOKEN.findall(text)]
    if not packed:
        return np.empty(0, np.int64)
    both = np.array(packed, np.uint64)
    word, shape = both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)
    with np.errstate(over="ignore"):
        pairs = word[:-1] * _STEP + word[1:]
        shapes = shape[:-1] * _STEP + shape[1:]
    same = (word[1:] == word[:-1]).astype(np.uint64)
    return np.concatenate([
        _slots(word, 1, WORD_BITS), _slots(pairs, 2, WORD_BITS),
        _slots(shapes, 3, WORD_BITS), _slots(same, 4, WORD_BITS),
    ])


def char_slots(text: str) -> np.ndarray:
    """Slots of the three-byte runs of a lower-cased text, repeats included."""
    raw = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    if raw.size < 3:
        return np.empty(0, np.int64)
    wide = raw.astype(np.uint32)
    runs = wide[:-2] | wide[1:-1] << np.uint32(8) | wide[2:] << np.uint32(16)
    with np.errstate(over="ignore"):
        runs *= np.uint32(0x9E3779B1)
        runs ^= runs >> np.uint32(15)
        runs *= np.uint32(0x85EBCA6B)
    return (runs >> np.uint32(32 - CHAR_BITS)).astype(np.int64)


def vector(slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct slots and their shares, which add up to ``SCALE``."""
    found, counts = np.unique(slots, return_counts=True)
    return found.astype(np.int32), (counts * (SCALE / max(1, slots.size))).astype(np.float32)


def dot(weights: np.ndarray, slots: np.ndarray) -> float:
    """The dot product of a text's shares with the weights."""
    return float(weights[slots].mean() * SCALE) if slots.size else 0.0


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))
