"""Toxicity: texts are read through their disguises, then scored by the words found.

The model of characters is counted over the words of all documents. Every whole text is
read with it (``deobfuscation``): its words and what its disguised words were. The
features of a text are these words and their beginnings, each there or not. A logistic
regression with FTRL-proximal updates, whose L1 term leaves few weights, is fitted to a
bounded sample of labelled documents (``samples.SAMPLE_ROWS`` and ``SAMPLE_BYTES``), on
features that at least ``LEAST_DOCS`` documents of the sample have.

Nulls, ties and odd rows: a null or empty text scores the bias alone. Rows that repeat
score the same. Null or contradicting labels are not learnt from; without usable labels
all scores are 0.5. Rows without an id count as held out. Extra columns are passed over.
Empty tables give no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailloom.llm.common import held_out, stored
from mailloom.llm.deobfuscation import Letters, restored, word_runs
from mailloom.llm.ngrams import sigmoid
from mailloom.llm.quality import Ftrl
from mailloom.llm.samples import labelled_texts

#: Lengths of the beginnings of words that are features.
BEGINNINGS = (3, 4, 5, 6, 7, 8)

#: Documents of the sample that a feature has to occur in.
LEAST_DOCS = 5

#: Score from which a document is predicted toxic.
THRESHOLD = 0.5


def letter_counts(documents: DataFrame) -> dict[str, int]:
    """Counts of runs of letters over the words of all documents.

    Words are counted first, so what is shuffled grows with the vocabulary. The runs that
    come back are of 29 symbols and four long at most, so their number is bounded.
    """
    words = documents.select(F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word"))
    counted = words.where("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"))

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: Counter = Counter()
        for batch in batches:
            for word, n in zip(batch["word"].tolist(), batch["n"].tolist()):
                for run in word_runs(word):
                    found[run] += n
        yield pd.DataFrame({"run": list(found), "n": list(found.values())})

    sums = counted.mapInPandas(runs, "run string, n long").groupBy("run").agg(F.sum("n").alias("n"))
    return {row["run"]: row["n"] for row in sums.collect()}


def features(words: set[str]) -> set[str]:
    """Words, marked by a stop, and their beginnings."""
    found = {word + "." for word in words}
    for size in BEGINNINGS:
        found.update(word[:size] for word in words if len(word) >= size)
    return found


def fit(documents: DataFrame, labels: DataFrame, counts: dict[str, int]) -> tuple[dict, float]:
    """Weights of features and the bias."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters, known = Letters(counts), {}
        for batch in batches:
            found = [" ".join(sorted(restored(text, letters, known))) for text in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"], "words": found})

    sample = labelled_texts(documents, labels, "toxic")
    kind = documents.schema["doc_id"].dataType.simpleString()
    texts = stored(sample.mapInPandas(read, f"doc_id {kind}, label int, words string"))

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: Counter = Counter()
            for words in batch["words"]:
                found.update(features(set(words.split())))
            yield pd.DataFrame({"feature": list(found), "n": list(found.values())})

    # Features are counted on the executors; only those that are frequent come here.
    frequent = texts.mapInPandas(spread, "feature string, n long").groupBy("feature").agg(
        F.sum("n").alias("n")
    ).where(F.col("n") >= LEAST_DOCS)
    names = sorted(row["feature"] for row in frequent.select("feature").collect())
    number = {name: k for k, name in enumerate(names)}

    def numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = [
                np.array(sorted(
                    number[f] for f in features(set(words.split())) if f in number
                ), np.int32).tobytes()
                for words in batch["words"]
            ]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"], "at": at})

    rows = texts.mapInPandas(numbered, f"doc_id {kind}, label int, at binary").collect()
    rows.sort(key=lambda row: str(row["doc_id"]))
    return learnt(
        names, [row["label"] for row in rows], [np.frombuffer(row["at"], np.int32) for row in rows]
    )


def learnt(
    names: list[str], labels: list[int], vectors: list[np.ndarray], epochs: int = 6
) -> tuple[dict, float]:
    """Weights by name and the bias, from which features each document has."""
    size = len(names)
    model = Ftrl(size, alpha=0.3, l1=8.0, l2=0.1)
    order = np.random.default_rng(1)
    for _ in range(epochs):
        for k in order.permutation(len(vectors)):
            at = np.append(vectors[k], size)
            model.learn(at, np.ones(at.size), labels[k])
    weights = model.weights()
    return {f: float(w) for f, w in zip(names, weights) if w != 0}, float(weights[size])


def scored(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    counts = letter_counts(documents)
    weights, bias = fit(documents, labels, counts)
    model = documents.sparkSession.sparkContext.broadcast((counts, weights, bias))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        runs, weight, base = model.value
        letters, known = Letters(runs), {}
        for texts in batches:
            out = []
            for text in texts:
                have = features(restored(text or "", letters, known)) & weight.keys()
                out.append(float(sigmoid(sum(weight[f] for f in sorted(have)) + base)))
            yield pd.Series(out, dtype="float64")

    found = documents.select("doc_id", score(F.coalesce("text", F.lit(""))).alias("score"))
    return found.select(
        "doc_id", held_out().alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
