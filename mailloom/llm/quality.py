"""Quality classifier: hashed word n-grams, trained by follow-the-regularised-leader updates.

A document is a sparse vector of the shares of its words, word pairs and pairs of word
shapes, each hashed to one of 2^18 slots. Logistic regression is trained one document
at a time with FTRL-proximal updates (each weight follows from its sums of gradients,
with an L1 and an L2 term) on a bounded sample of the labelled documents
(``samples.SAMPLE_ROWS`` and ``SAMPLE_BYTES``); every whole text is then scored as a
sparse dot product.

Nulls, ties and odd rows: a null or empty text scores the bias alone. Rows that
repeat score the same. Null or contradicting labels are not learnt from; with no
usable label all scores are 0.5. Rows without an id count as held out. Other columns
of the documents pass through :func:`good` unchanged. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailloom.llm.common import held_out, packed, unpacked
from mailloom.llm.ngrams import WORD_BITS, dot, sigmoid, word_slots
from mailloom.llm.samples import labelled_texts, vectors

#: Below this score a document is rejected.
THRESHOLD = 0.3


class Ftrl:
    """Logistic regression with FTRL-proximal updates; the last weight is the bias."""

    def __init__(self, size, alpha=0.5, beta=1.0, l1=0.05, l2=0.5):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at=slice(None)):
        z, n = self.z[at], self.n[at]
        step = (self.beta + np.sqrt(n)) / self.alpha + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / step)

    def learn(self, at, value, label):
        w = self.weights(at)
        gradient = (sigmoid(w @ value) - label) * value
        squares = gradient**2
        n = self.n[at]
        self.z[at] += gradient - (np.sqrt(n + squares) - np.sqrt(n)) / self.alpha * w
        self.n[at] += squares


def train(labels, rows, size: int, epochs: int = 4, seed: int = 1) -> tuple[np.ndarray, float]:
    """Weights and bias after ``epochs`` passes in a seeded random order."""
    model = Ftrl(size)
    order = np.random.default_rng(seed)
    prepared = [(np.append(at, size), np.append(value, 1.0)) for at, value in rows]
    for _ in range(epochs):
        for k in order.permutation(len(prepared)):
            model.learn(*prepared[k], labels[k])
    learnt = model.weights()
    return learnt[:-1].astype(np.float32), float(learnt[-1])


def fit(documents: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    sample = labelled_texts(documents, labels, "quality")
    marks, read = vectors(sample, {"word": word_slots})
    return train(marks, read["word"], 1 << WORD_BITS)


def quality_score(documents: DataFrame, labels: DataFrame):
    """A function of a column of texts: the probability of quality 1."""
    model = documents.sparkSession.sparkContext.broadcast(fit(documents, labels))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        learnt, base = model.value
        for texts in batches:
            yield pd.Series(
                [float(sigmoid(dot(learnt, word_slots(text or "")) + base)) for text in texts],
                dtype="float64",
            )

    return lambda text: score(F.coalesce(text, F.lit("")))


def good(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    score = quality_score(documents, labels)
    kept = packed(documents).where(score("doc.text") >= threshold)
    return unpacked(kept, documents.columns)


def scored(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    score = quality_score(documents, labels)
    found = documents.select("doc_id", score("text").alias("score"))
    return found.select(
        "doc_id", held_out().alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
