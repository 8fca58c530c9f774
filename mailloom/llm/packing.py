"""Pack documents into sequences of bounded length by minimum bin slack.

A document is its token ids and an end id. One that is longer than a sequence is cut into
pieces of full length, the first of which may be shorter; no other is cut. A sequence is
filled around the longest piece that is left: of all combinations of lengths that are still
there, a subset-sum search over bitsets finds the fullest, with the longest pieces where
several are as full, and its pieces are removed. Only lengths matter, so the search works
on the number of pieces per length, at most ``CAPACITY`` numbers whatever the size of the
corpus, and a combination is used as often as all its lengths last: that is what filling
one sequence after the other gives, since no fuller combination can turn up while pieces
only go. Pieces are then ranked within their length by tasks that share the ranks of a
length among them, and each rank is looked up in the ranges that the combinations take.

Nulls, ties and odd rows: a null or empty text has its end id only; a null id is a document
like any other; repeated rows are packed one by one, and which of two equal rows takes which
place does not matter. An empty table gives no rows. Other columns are passed over. Texts
are encoded whole, long ones window by window.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from mailloom.llm.common import stored
from mailloom.llm.ranks import ranked
from mailloom.llm.tokens import packed_ids, vocabulary

#: Tokens of a sequence, and the id after each document.
CAPACITY, END = 2048, 0

#: Ranks within a length stay below 2^50, so that length and rank fit one number.
_RANKS = 50


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of a document."""
    first = (total - 1) % capacity + 1
    return [(0, first), *((at, capacity) for at in range(first, total, capacity))]


def pieces(documents: DataFrame, vocabulary_path: str, capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)`` of all documents."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    end = np.array([END], "<u4").tobytes()

    def make(batches):
        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            rows = []
            for n, ids in enumerate(packed_ids(texts, vocabulary_path)):
                ids += end
                rows += [
                    (n, k, at, size, zlib.crc32(memoryview(ids)[4 * at:4 * (at + size)]))
                    for k, (at, size) in enumerate(cut(len(ids) // 4, capacity))
                ]
            n, k, at, size, crc = np.array(rows, np.int64).reshape(-1, 5).T
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(n)), pa.array(k.astype(np.int32)),
                 pa.array(at), pa.array(size), pa.array(crc)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return documents.select("doc_id", "text").mapInArrow(
        make, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    )


def fullest(counts: dict[int, int], lengths: list[int], room: int) -> dict[int, int]:
    """Of ``lengths`` (ascending), how many of each fill ``room`` best, long ones first.

    Bit s of ``reach`` says that some combination has the sum s.
    """
    mask, reach, steps = (1 << room + 1) - 1, 1, []
    for length in lengths:
        if length > room:
            break
        most = min(counts[length], room // length)
        if not most:
            continue
        steps.append((length, most, reach))
        left, times = most, 1
        while left:  # 1, 2, 4, ... copies at a time, and the rest
            take = min(times, left)
            reach |= reach << take * length & mask
            left, times = left - take, times * 2
    rest, found = reach.bit_length() - 1, {}
    for length, most, before in reversed(steps):
        for n in range(min(most, rest // length), -1, -1):
            if before >> rest - n * length & 1:
                break
        if n:
            found[length] = n
            rest -= n * length
    return found


def combinations(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Which pieces by length share a sequence, and in how many sequences they do."""
    left, made = dict(counts), []
    lengths = sorted(n for n in left if left[n])
    while lengths:
        longest = lengths[-1]
        left[longest] -= 1
        inside = fullest(left, lengths, capacity - longest)
        left[longest] += 1
        inside[longest] = inside.get(longest, 0) + 1
        times = min(left[n] // k for n, k in inside.items())
        for n, k in inside.items():
            left[n] -= k * times
        made.append((inside, times))
        lengths = [n for n in lengths if left[n]]
    return made


def places(made: list[tuple[dict[int, int], int]]) -> pd.DataFrame:
    """Ranges of ranks per length: the first rank, its sequence, pieces in each, offset."""
    rows, taken, sequence = [], {}, 0
    for inside, times in made:
        offset = 0
        for length in sorted(inside, reverse=True):
            each = inside[length]
            first = taken.get(length, 0)
            rows.append((length << _RANKS | first, sequence, each, offset))
            taken[length] = first + each * times
            offset += each * length
        sequence += times
    found = pd.DataFrame(rows, columns=["key", "sequence", "each", "offset"], dtype="int64")
    return found.sort_values("key", ignore_index=True)


def pack(
    documents: DataFrame, vocabulary_path: str | None = None, capacity: int = CAPACITY
) -> DataFrame:
    """One row per piece with the sequence and the offset that it takes."""
    spark = documents.sparkSession
    path = vocabulary_path or vocabulary("byte_bpe_50k.json")
    found = stored(pieces(documents, path, capacity))
    # At most ``capacity`` rows.
    counts = {row["length"]: row["count"] for row in found.groupBy("length").count().collect()}
    # No more ranges than combinations times the lengths in one: a few numbers per length.
    ranges = spark.sparkContext.broadcast(places(combinations(counts, capacity)))
    placed = ranked(found, "length", ["doc_id", "piece", "start", "ids_crc32"]).drop("size")
    kept = found.columns
    columns = [*kept, "sequence_id", "offset"]
    schema = T.StructType([
        *found.schema.fields, T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ])

    def place(batches):
        table = ranges.value
        key, sequence, each, offset = (table[c].to_numpy() for c in table.columns)
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(key, length << _RANKS | rank, side="right") - 1
            inside = rank - (key[at] & (1 << _RANKS) - 1)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(sequence[at] + inside // each[at]),
                 pa.array(offset[at] + inside % each[at] * length)],
                columns,
            )

    return placed.mapInArrow(place, schema)
