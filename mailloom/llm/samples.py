"""A bounded sample of labelled documents, to fit a model on."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mailloom.llm.common import held_out

#: At most so many labelled documents, and so many bytes of their texts, are learnt from.
SAMPLE_ROWS = 6000
SAMPLE_BYTES = 24_000_000

#: Longer texts come after all others, and a text counts for no more bytes than its vector
#: of 2^18 slots and values can take.
LONG_BYTES, VECTOR_BYTES = 64_000, 8 << 18


def labelled_texts(
    documents: DataFrame,
    labels: DataFrame,
    label: str,
    rows: int = SAMPLE_ROWS,
    most_bytes: int = SAMPLE_BYTES,
) -> DataFrame:
    """``(doc_id, label, text)`` of at most ``rows`` labelled documents outside the held-out fold.

    The documents are those labelled ones with the least hash of their id, so that the sample
    is the same in every run; ids can be of any type. Of these as many are taken as ``most_bytes`` holds: texts of up to
    ``LONG_BYTES`` in the order of the hash, then longer ones, the shortest first. A text
    counts for ``VECTOR_BYTES`` at most, so that none is too long to be learnt from and a
    long one takes no place from the others. Labels that contradict each other for a
    document, or are null, are left out; of documents that share an id, the least text
    counts, with the bytes of the longest.
    """
    labelled = (
        labels.where(F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.min(label).alias("label"), F.max(label).alias("_most"))
        .where((F.col("label") == F.col("_most")) & F.col("label").isin(0, 1))
        .select("doc_id", F.col("label").cast("int").alias("label"))
    )
    # Labels of documents that are not there take no place in the sample. Only ids and
    # lengths are joined; what is left are ``rows`` rows of three numbers.
    sizes = (
        documents.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("_bytes"))
        .join(labelled, "doc_id")
        .groupBy("doc_id", "label").agg(F.max("_bytes").alias("_bytes"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    upto = Window.orderBy(
        F.greatest("_bytes", F.lit(LONG_BYTES)), F.xxhash64("doc_id"), "doc_id"
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    taken = (
        sizes.withColumn("_total", F.sum(F.least("_bytes", F.lit(VECTOR_BYTES))).over(upto))
        .where(F.col("_total") <= most_bytes).select("doc_id", "label")
    )
    return (
        documents.select("doc_id", "text").join(F.broadcast(taken), "doc_id")
        .groupBy("doc_id", "label").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    )


def vectors(
    texts: DataFrame, slots: dict[str, Callable[[str], np.ndarray]]
) -> tuple[np.ndarray, dict[str, list[tuple[np.ndarray, np.ndarray]]]]:
    """Labels and sparse vectors of a bounded sample, made on the executors."""
    from mailloom.llm.ngrams import vector

    def make(batches):
        for batch in batches:
            out = {"doc_id": batch["doc_id"], "label": batch["label"]}
            for name, f in slots.items():
                pairs = [vector(f(text)) for text in batch["text"]]
                out[f"{name}_at"] = [at.tobytes() for at, _ in pairs]
                out[f"{name}_value"] = [value.tobytes() for _, value in pairs]
            yield pd.DataFrame(out)

    kinds = ", ".join(f"{name}_at binary, {name}_value binary" for name in slots)
    kind = texts.schema["doc_id"].dataType.simpleString()
    made = texts.mapInPandas(make, f"doc_id {kind}, label int, {kinds}")
    rows = sorted(made.collect(), key=lambda row: row["doc_id"])
    read = {
        name: [
            (np.frombuffer(row[f"{name}_at"], np.int32), np.frombuffer(row[f"{name}_value"], np.float32))
            for row in rows
        ]
        for name in slots
    }
    return np.array([row["label"] for row in rows], np.float64), read
