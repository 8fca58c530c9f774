"""Suffix-array dedup: remove byte strings of a length that occur anywhere else.

The texts that may repeat are cut into shards (``repeats``). A shard's pieces are set
one after the other, its suffix array is made by induced sorting (``suffix``), and the
permuted common prefixes tell which windows equal the one before or after them in
order. All bytes such a window covers are removed, on the text as it came in.

Nulls, ties and odd rows: a null text is empty; rows that repeat are copies of each
other, also if they share an id. Texts shorter than the window stay. Extra columns are
passed over by :func:`removals` and kept by :func:`without_repeats`, where a character
that loses some of its bytes goes as a whole, and a null text stays null. Empty tables
give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailloom.llm.common import packed, unpacked
from mailloom.llm.repeats import Units, byte_units, covered, repeated, with_runs
from mailloom.llm.suffix import common_prefixes, suffix_array

#: Bytes of a repeated string, and of the runs that shards are dealt out by.
WINDOW, GRAM = 400, 64


def repeats_in_shard(pieces: list[bytes], heads, groups, units: Units) -> list[np.ndarray]:
    """Which windows of the pieces equal another, by the suffix array of all pieces."""
    sizes = np.array([len(piece) for piece in pieces])
    starts = np.cumsum(sizes + 1) - sizes - 1
    # Bytes are 2 to 257, 1 parts the pieces, 0 ends the shard.
    symbols = np.ones(int(sizes.sum()) + sizes.size + 1, np.int64)
    for start, piece in zip(starts.tolist(), pieces):
        symbols[start:start + len(piece)] = np.frombuffer(piece, np.uint8).astype(np.int64) + 2
    symbols[-1] = 0
    order = suffix_array(symbols)
    # The names of symbols that occur fit in a byte: texts have no bytes above 0xF4.
    prefix, after = common_prefixes(symbols.astype(np.uint8), order)
    long = prefix >= units.window
    follows = np.zeros(symbols.size, bool)
    has = after >= 0
    follows[has] = prefix[after[has]] >= units.window
    repeat = long | follows
    return [
        repeat[start:start + size - units.window + 1]
        for start, size in zip(starts.tolist(), sizes.tolist())
    ]


def _runs(documents: DataFrame, window: int, gram: int) -> DataFrame:
    return repeated(documents, byte_units(window, gram), repeats_in_shard)


def removals(documents: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every document."""
    texts = documents.select("doc_id", "text")
    rows = with_runs(texts, _runs(texts, window, gram))

    def measure(text, at, n) -> tuple[int, int, int, str]:
        raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
        gone = covered(raw.size, at, n, window)
        spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[:1].sum())
        kept = hashlib.sha256(raw[~gone].tobytes()).hexdigest()
        return raw.size, int(gone.sum()), spans, kept

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [measure(*row) for row in zip(batch["text"], batch["_at"], batch["_n"])]
            out = pd.DataFrame(made, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out

    kind = documents.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(
        run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


@F.pandas_udf(T.StringType())
def _kept(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
    for texts, ats, ns, windows, least in batches:
        out = []
        for text, at, n, window, words in zip(texts, ats, ns, windows, least):
            if text is None or at is None:
                out.append(text)
                continue
            raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
            gone = covered(raw.size, at, n, int(window))
            if words:
                edges = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False]))))
                for start, end in edges.reshape(-1, 2):
                    if len(raw[start:end].tobytes().split()) < words:
                        gone[start:end] = False
            left = raw[~gone].tobytes()
            out.append(left.decode("utf-8", "ignore"))
        yield pd.Series(out, dtype=object)


def without_repeats(
    documents: DataFrame, window: int = WINDOW, gram: int = GRAM, least_words: int = 0
) -> DataFrame:
    """``documents`` with the repeated bytes taken out of ``text``; ``n_chars`` follows.

    Of the runs that repeated windows cover, only those go that hold ``least_words`` words or
    parts of words. A short window with a number of words finds passages by their words,
    however short these are, and leaves alone phrases that merely recur.
    """
    rows = with_runs(
        packed(documents), _runs(documents.select("doc_id", "text"), window, gram), "doc.text"
    ).withColumn("_text", _kept(
        "doc.text", "_at", "_n", F.lit(window), F.lit(least_words)
    ))
    new = {"text": F.col("_text")}
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        new["n_chars"] = F.when(F.col("_at").isNull(), F.col("doc.n_chars")).otherwise(
            F.length("_text").cast(kind)
        )
    return unpacked(rows, documents.columns, **new)
