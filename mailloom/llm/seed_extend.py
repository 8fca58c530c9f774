"""Substring dedup: seeds from winnowed anchors, extended both ways.

Texts are joined on their winnowed anchors (``repeats``). In a shard the places of all
anchors are extended one word at a time, to the right and to the left, all at once:
places that agree so far have the same class, and a step parts a class by the next word.
A place and another match from l words to the left up to r words to the right if both
their left classes after l steps and their right classes after r steps are the same; a
window is repeated if that holds for the two reaches that make it up. Words are compared
themselves, not by hash. Runs of repeated windows are the maximal repeats of at least
``WINDOW`` words; the words they cover are removed, on the text as it came in.

Nulls, ties and odd rows: a null text has no words; rows that repeat are copies of each
other, also if they share an id. Texts shorter than the window stay. Extra columns are
passed over. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from mailloom.llm.repeats import Units, covered, repeated, single, with_runs, word_units

#: Words of a repeated passage, and of the runs that texts are joined on.
WINDOW, GRAM = 35, 6


def repeats_in_shard(pieces, heads, groups, units: Units) -> list[np.ndarray]:
    """Which windows of the pieces equal another, by extending their anchors both ways."""
    whole = pieces
    parts = [
        (k, *part) for k, piece in enumerate(whole)
        for part in single(piece, len(piece) - units.window + 1, int(heads[k]), units)
    ]
    pieces = [whole[k][at:at + n + units.window - 1] for k, at, n, _ in parts]
    heads = np.array([head for *_, head in parts], np.int64)
    groups = np.asarray(groups)[[k for k, *_ in parts]]
    size, reach = len(pieces), units.window
    numbers: dict[bytes, int] = {}
    coded = [
        np.array([numbers.setdefault(word, len(numbers)) for word in piece], np.int64)
        for piece in pieces
    ]
    lengths = np.array([piece.size for piece in coded])
    starts = np.cumsum(lengths) - lengths
    words = np.concatenate(coded)
    seeded = starts + heads
    ends = starts + lengths
    rows = np.arange(size)
    base = len(numbers) + 1
    seeds = np.unique(groups, return_inverse=True)[1].astype(np.int64)

    def extended(step: int) -> list[np.ndarray]:
        """Classes after each step to the right (1) or left (-1); out of a piece: its own."""
        classes, now = [], seeds
        for k in range(reach):
            at = seeded + k if step > 0 else seeded - 1 - k
            inside = (at < ends) & (at >= starts)
            word = words[np.clip(at, 0, words.size - 1)]
            key = np.where(inside, now * base + word, -1 - rows)
            now = np.unique(key, return_inverse=True)[1].astype(np.int64)
            classes.append(now)
        return classes

    right, left = extended(1), [seeds, *extended(-1)]
    flags = [np.zeros(length - reach + 1, bool) for length in lengths.tolist()]
    for offset in range(units.offsets):
        # The window that starts ``offset`` words before the anchor.
        have = np.flatnonzero((heads >= offset) & (heads - offset + reach <= lengths))
        if have.size < 2:
            continue
        pair = left[offset][have] * np.int64(size + 1) + right[reach - offset - 1][have]
        _, which, many = np.unique(pair, return_inverse=True, return_counts=True)
        for k in have[many[which] > 1].tolist():
            flags[k][heads[k] - offset] = True
    found = [np.zeros(len(piece) - reach + 1, bool) for piece in whole]
    for (k, at, n, _), hits in zip(parts, flags):
        found[k][at:at + n] |= hits[:n]
    return found


def removals(documents: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept`` of every document.

    ``kept`` is the text that stays, its words joined by single spaces.
    """
    texts = documents.select("doc_id", "text")
    rows = with_runs(texts, repeated(texts, word_units(window, gram), repeats_in_shard))

    def measure(text, at, n):
        words = (text or "").encode("utf-8", "surrogatepass").split()
        gone = covered(len(words), at, n, window).tolist()
        kept = b" ".join([word for word, out in zip(words, gone) if not out])
        return len(words), sum(gone), hashlib.sha256(kept).hexdigest(), kept.decode()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [measure(*row) for row in zip(batch["text"], batch["_at"], batch["_n"])]
            out = pd.DataFrame(made, columns=["n_words", "n_removed", "kept_sha256", "kept"])
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out

    kind = documents.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(
        run, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, kept string"
    )
