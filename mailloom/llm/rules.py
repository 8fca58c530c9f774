"""Quality rules: counts of every text, and a calibrated n-gram model against thresholds.

The counts are of words, symbols, lines that repeat and words in three-word runs that
repeat; fixed limits on them fail a text (``base_failed``). What they let through is
judged by logistic regression over hashed n-grams of words (2^18 slots) and of bytes
(2^16 slots), fitted by gradient steps over all of a bounded sample of labelled rows
(``samples.SAMPLE_ROWS`` and ``SAMPLE_BYTES``). A fifth of the sample is not fitted on;
on it a slope and an offset are found that turn the model's value into a probability.
Whole texts are scored in Arrow batches; below ``THRESHOLD`` a text is not kept.

Nulls, ties and odd rows: a null or empty text has no words and fails. Rows that repeat
have the same result. Null or contradicting labels are not learnt from; with no usable
label, or labels of one kind only, the probability is that kind's share (0.5 without
any). Extra columns are passed over. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailloom.llm.ngrams import CHAR_BITS, WORD_BITS, char_slots, dot, sigmoid, word_slots
from mailloom.llm.samples import labelled_texts, vectors

#: A text needs this many words, and at most this share of them in repeated runs.
LEAST_WORDS, MOST_REPEATED = 50, 50

#: Calibrated probability of good quality that a text needs.
THRESHOLD = 0.3

_SYMBOLS = "#*$%&|<>"
_SPACE = " \t\n\x0b\x0c\r"


def repeated_words(words: list) -> int:
    """Words that lie in a run of three that occurs twice or more."""
    if len(words) < 4:
        return 0
    numbers: dict = {}
    ids = np.array([numbers.setdefault(word, len(numbers)) for word in words], np.int64)
    pair = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)[1]
    run = pair[:-1].astype(np.int64) * len(numbers) + ids[2:]
    _, which, many = np.unique(run, return_inverse=True, return_counts=True)
    again = many[which] > 1
    marked = np.zeros(ids.size, bool)
    for k in range(3):
        marked[k:k + again.size] |= again
    return int(marked.sum())


def counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    words = text.encode("utf-8", "surrogatepass").split()
    seen: set[str] = set()
    again = 0
    for line in text.split("\n"):
        if line.strip(_SPACE):
            if line in seen:
                again += 1
            else:
                seen.add(line)
    return (
        len(words),
        len(text) - sum(text.count(c) for c in _SPACE),
        sum(text.count(c) for c in _SYMBOLS),
        again,
        repeated_words(words),
    )


def _flat(rows):
    """Sparse rows as flat arrays: row, slot and value."""
    sizes = np.array([at.size for at, _ in rows])
    return (
        np.repeat(np.arange(len(rows)), sizes),
        np.concatenate([at for at, _ in rows]) if rows else np.empty(0, np.int32),
        np.concatenate([value for _, value in rows]) if rows else np.empty(0, np.float32),
    )


def fit(labels: np.ndarray, word_rows, char_rows, steps: int = 150, decay: float = 1e-4):
    """Weights of words and of bytes, and the slope and offset of the calibration."""
    words, chars = 1 << WORD_BITS, 1 << CHAR_BITS
    if labels.size == 0 or labels.min() == labels.max():
        share = labels.mean() if labels.size else 0.5
        share = min(max(share, 1e-3), 1 - 1e-3)
        return np.zeros(words), np.zeros(chars), 0.0, float(np.log(share / (1 - share)))
    row_w, at_w, value_w = _flat(word_rows)
    row_c, at_c, value_c = _flat(char_rows)
    n = labels.size
    held = np.arange(n) % 5 == 0
    weight = (~held).astype(np.float64) / max(1, (~held).sum())

    w, c, bias = np.zeros(words), np.zeros(chars), 0.0
    # Squared gradients so far; frequent n-grams take smaller steps.
    sw, sc, sb = np.full(words, 1e-8), np.full(chars, 1e-8), 1e-8

    def values():
        return (
            np.bincount(row_w, w[at_w] * value_w, n) + np.bincount(row_c, c[at_c] * value_c, n) + bias
        )

    for _ in range(steps):
        error = (sigmoid(values()) - labels) * weight
        gw = np.bincount(at_w, error[row_w] * value_w, words) + decay * w
        gc = np.bincount(at_c, error[row_c] * value_c, chars) + decay * c
        gb = error.sum()
        sw, sc, sb = sw + gw**2, sc + gc**2, sb + gb**2
        w, c, bias = w - 0.2 * gw / np.sqrt(sw), c - 0.2 * gc / np.sqrt(sc), bias - 0.2 * gb / sb**0.5
    slope, offset = calibrate(values()[held], labels[held])
    return w, c, slope, slope * bias + offset


def calibrate(value: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through held-back values, by Newton steps.

    The labels are drawn in a little from 0 and 1, so that values that part the kinds
    completely do not make the curve infinitely steep.
    """
    good, bad = label.sum(), (1 - label).sum()
    target = np.where(label > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = sigmoid(slope * value + offset)
        error, spread = p - target, p * (1 - p)
        a = np.array([
            [(spread * value**2).sum() + 1e-3, (spread * value).sum()],
            [(spread * value).sum(), spread.sum() + 1e-3],
        ])
        step = np.linalg.solve(a, np.array([
            (error * value).sum() + 1e-3 * (slope - 1), error.sum() + 1e-3 * offset
        ]))
        slope, offset = slope - step[0], offset - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(max(slope, 0.05)), float(offset)


def judged(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts, ``base_failed``, ``probability`` and ``kept`` of every document."""
    sample = labelled_texts(documents, labels, "quality")
    marks, read = vectors(sample, {"word": word_slots, "char": char_slots})
    w, c, slope, offset = fit(marks, read["word"], read["char"])
    model = documents.sparkSession.sparkContext.broadcast(
        ((slope * w).astype(np.float32), (slope * c).astype(np.float32), offset)
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, chars, base = model.value
        for batch in batches:
            texts = [text or "" for text in batch["text"]]
            out = pd.DataFrame(
                [counts(text) for text in texts],
                columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"],
            )
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            out["base_failed"] = (out["n_words"] < LEAST_WORDS) | (
                100 * out["n_repeat_words"] > MOST_REPEATED * out["n_words"]
            )
            out["probability"] = [
                float(sigmoid(dot(words, word_slots(text)) + dot(chars, char_slots(text)) + base))
                for text in texts
            ]
            out["kept"] = ~out["base_failed"] & (out["probability"] >= THRESHOLD)
            yield out

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInPandas(
        run,
        f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, base_failed boolean, probability double, kept boolean",
    )
