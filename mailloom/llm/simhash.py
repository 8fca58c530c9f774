"""SimHash near-duplicates, compared in bit-sliced blocks.

A text's fingerprint has a bit for each of the 64 bits of its shingles' hashes: 1 if it
is set in over half of them. Fingerprints that differ in at most ``RADIUS`` bits are
linked, and documents are grouped by what their fingerprints can reach.

Rows with the same fingerprint meet first; links are sought between distinct
fingerprints only. These are dealt out by parts of their bits: of four parts of 16
bits, two that differ in at most two bits have two parts in common, so every link
falls in one of the six buckets of its ends. A bucket with more than ``BUCKET``
fingerprints is dealt out again by the 32 bits its members do not share, in four parts
of 8 bits: at least two of these agree too, and such a bucket cannot hold more than
2^16 distinct fingerprints, however many copies or near copies there are. No bucket is
capped.

Within blocks of whole buckets the fingerprints are kept as 64 bit planes, one machine
word for 64 fingerprints. Each is compared with the one r places on in its bucket: the
planes are XORed, the differences are added up for all places at once in carry-save
counters of two bits, and words whose places all exceed the radius are abandoned. A
bucket returns for each member the first one it can reach, not the pairs.

Nulls, ties and odd rows: a null text, or one without words, has fingerprint 0 and is
linked like any other; fewer than three words are one shingle. Rows that repeat, or
share an id, are in one group if their texts are. A group's id is its least id that is
not null, or null. Extra columns are passed over by :func:`near_duplicates` and kept by
:func:`keep_one`. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailloom.llm.common import packed, stored, text_key, unpacked
from mailloom.llm.components import components

#: Linked fingerprints differ in at most so many bits.
RADIUS = 2

#: Words of a shingle, and the seed of its hash (XXH64).
SHINGLE, SEED = 3, 42

#: Distinct fingerprints of a bucket above which it is dealt out by more bits.
BUCKET = 4096

#: Fingerprints compared in one block.
BLOCK = 65536

#: Hashes whose bits are counted at once.
_AT_ONCE = 1 << 16


def fingerprint(text: str | None) -> int:
    """The 64-bit fingerprint of a whole text, as a signed number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < SHINGLE:
        return int(np.uint64(xxhash.xxh64_intdigest(joined, SEED)).astype(np.int64))
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes) - 1
    starts = (ends - sizes + 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1:].tolist())),
        np.uint64, len(words) - SHINGLE + 1,
    )
    counts = np.zeros(64, np.int64)
    for k in range(0, hashes.size, _AT_ONCE):
        part = hashes[k:k + _AT_ONCE]
        bits = np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    on = (2 * counts > hashes.size).astype(np.uint8)
    return int(np.packbits(on, bitorder="little").view(np.int64)[0])


@F.pandas_udf(T.LongType())
def fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([fingerprint(text) for text in texts], dtype="int64")


def _lanes(flags: np.ndarray, words: int) -> np.ndarray:
    """Booleans as bits, 64 to a word."""
    out = np.zeros(words * 8, np.uint8)
    packed = np.packbits(flags, bitorder="little")
    out[:packed.size] = packed
    return out.view(np.uint64)


def bit_planes(prints: np.ndarray) -> np.ndarray:
    """64 rows of words: bit k of all fingerprints, 64 fingerprints to a word."""
    words = -(-prints.size // 64) + 1
    bits = np.unpackbits(
        np.ascontiguousarray(prints).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
    )
    planes = np.zeros((64, words * 8), np.uint8)
    packed = np.packbits(bits, axis=0, bitorder="little")
    planes[:, :packed.shape[0]] = packed.T
    return planes.view(np.uint64)


def _moved(planes: np.ndarray, r: int, at: np.ndarray) -> np.ndarray:
    """The words ``at`` of the planes, moved on by ``r`` fingerprints."""
    whole, part = divmod(r, 64)
    last = planes.shape[1] - 1
    low = planes[:, np.minimum(at + whole, last)]
    if not part:
        return low
    high = planes[:, np.minimum(at + whole + 1, last)]
    return low >> np.uint64(part) | high << np.uint64(64 - part)


def linked(buckets: np.ndarray, prints: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each fingerprint the first place it can reach within its (sorted) bucket."""
    size = prints.size
    parent = np.arange(size)
    planes = bit_planes(prints)
    words = planes.shape[1]

    def top(k):
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    for r in range(1, size):
        same = buckets[r:] == buckets[:-r]
        if not same.any():
            break
        live = _lanes(same, words)
        at = np.flatnonzero(live)
        live = live[at]
        here, there = planes[:, at], _moved(planes, r, at)
        ones, twos = np.zeros_like(live), np.zeros_like(live)
        for plane in range(64):
            differ = here[plane] ^ there[plane]
            carry = ones & differ
            ones ^= differ
            # With two bits the counters hold up to three, one over the radius.
            live &= ~(twos & (carry | ones)) if radius == 2 else ~(twos & carry)
            twos |= carry
            if plane % 8 == 7:
                on = live != 0
                if not on.any():
                    break
                if 2 * on.sum() < on.size:
                    here, there = here[:, on], there[:, on]
                    live, ones, twos, at = live[on], ones[on], twos[on], at[on]
        if not live.any():
            continue
        bits = np.unpackbits(live.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        word, bit = np.nonzero(bits)
        left = at[word] * 64 + bit
        open_ = parent[left] != parent[left + r]
        for k in left[open_].tolist():
            a, b = top(k), top(k + r)
            if a != b:
                parent[max(a, b)] = min(a, b)
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
    return parent


def _links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links found in rows sorted by bucket; blocks end where buckets end."""
    held, rows = [], 0

    def found(block: pd.DataFrame) -> pd.DataFrame:
        prints = block["fp"].to_numpy(np.int64)
        first = linked(block["bucket"].to_numpy(np.int64), prints)
        own = np.flatnonzero(first != np.arange(first.size))
        return pd.DataFrame({"a": prints[own], "b": prints[first[own]]})

    for batch in batches:
        held.append(batch)
        rows += len(batch)
        if rows < BLOCK:
            continue
        block = pd.concat(held, ignore_index=True)
        open_ = block["bucket"] == block["bucket"].iloc[-1]
        held, rows = [block[open_]], int(open_.sum())
        if not open_.all():
            yield found(block[~open_])
    if rows:
        yield found(pd.concat(held, ignore_index=True))


def _part(size: int, place: int):
    return F.shiftrightunsigned("fp", size * place).bitwiseAND((1 << size) - 1)


_PAIRS = [(0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3)]


def links(prints: DataFrame) -> DataFrame:
    """``(a, b)`` links that connect all of ``prints(fp)``, distinct, within the radius."""
    first = F.explode(F.array(*[
        F.struct(
            F.lit(n).alias("pair"),
            (F.shiftleft(F.lit(n).cast("long"), 32) + F.shiftleft(_part(16, i), 16) + _part(16, j))
            .alias("bucket"),
        )
        for n, (i, j) in enumerate(_PAIRS)
    ]))
    dealt = prints.select("fp", first.alias("d")).select("fp", "d.pair", "d.bucket")
    sizes = dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    sizes = stored(sizes)
    dealt = stored(dealt.join(sizes, "bucket"))

    def again(n: int, i: int, j: int):
        """Buckets of eight-bit parts of the two 16-bit parts that are not shared."""
        rest = [p for p in range(4) if p not in (i, j)]
        parts = [_part(8, 2 * p + half) for p in rest for half in (0, 1)]
        # The pair of parts, the 32 shared bits and 16 more bits are below 2^54.
        return F.array(*[
            F.shiftleft(F.lit(8 + n).cast("long"), 54)
            + F.shiftleft(F.lit(m).cast("long"), 51)
            + F.shiftleft(F.col("bucket").bitwiseAND((1 << 32) - 1), 16)
            + F.shiftleft(parts[a], 8) + parts[b]
            for m, (a, b) in enumerate(_PAIRS)
        ])

    finer = again(0, *_PAIRS[0])
    for n, (i, j) in list(enumerate(_PAIRS))[1:]:
        finer = F.when(F.col("pair") == n, again(n, i, j)).otherwise(finer)
    large = dealt.where(F.col("members") > BUCKET).select("fp", F.explode(finer).alias("bucket"))
    dealt = dealt.where(F.col("members") <= BUCKET).select("fp", "bucket").unionByName(large)
    spark = prints.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (
        dealt.repartition(parts, "bucket").sortWithinPartitions("bucket", "fp")
        .mapInPandas(_links, "a long, b long").distinct()
    )


def near_duplicates(documents: DataFrame) -> DataFrame:
    """``doc_id, row, fp, root, component_id`` of every document.

    ``row`` is a digest of the id and the text.
    """
    marked = stored(documents.select(
        "doc_id", _row("doc_id", "text").alias("row"), fingerprints("text").alias("fp")
    ))
    prints = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(prints.select("fp")))
    rooted = prints.join(roots, prints["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = stored(rooted)
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.select("fp", "root").join(ids, "root")
    return marked.join(named, "fp").select("doc_id", "row", "fp", "root", "component_id")


def _row(doc_id: str, text: str):
    """A digest of a document's id and text, the same for rows that repeat."""
    return F.unhex(F.md5(F.concat_ws(
        "|", F.hex(text_key(text)), F.isnull(doc_id).cast("string"), F.col(doc_id).cast("string")
    )))


def keep_one(documents: DataFrame) -> DataFrame:
    """The document with the least id of each group, with all its columns.

    Of different texts that share this id and their group, the one with the least digest
    stays; of rows that repeat, the first by their content.
    """
    groups = near_duplicates(documents.select("doc_id", "text"))
    stay = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(
        F.min("row").alias("_stays")
    )
    stay = stored(stay.select("_stays"))
    found = packed(documents).withColumn("_row", _row("doc.doc_id", "doc.text")).join(
        stay, F.col("_row") == F.col("_stays")
    )
    one = found.groupBy("_row").agg(F.min_by("doc", F.to_json("doc")).alias("doc"))
    return unpacked(one, documents.columns)
