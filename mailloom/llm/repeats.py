"""Repeated windows of texts, found in shards; shared by two kinds of substring dedup.

A text is a sequence of units (bytes or words), a window is ``window`` of them in a
row. Each window has an anchor: of its runs of ``gram`` units the one with the least
hash, the leftmost of equals. Equal windows have equal anchors at equal offsets, so
windows need only be compared with those that share their anchor. Windows next to each
other mostly have the same anchor; together they are a piece of text.

1. ``spots``: the pieces of every distinct text, as places without their content.
2. Spots whose anchor occurs once in the whole corpus are done: their windows are
   unique. The others are joined back to the texts and cut out.
3. Equal pieces are summed up before they are shuffled, so that groups of copies shrink
   to one piece that is known to occur twice.
4. The pieces of an anchor go to one shard, unless they exceed ``SHARD_BYTES``. Then each
   is cut by the offset of the anchor into ``WAYS`` ranges, and these are dealt out by all
   that their windows have in common, which is longer; and so on, down to single windows.
   A passage shared by very many texts thus meets only where what is around it agrees.
5. ``detect`` finds the repeated windows of a shard, exactly, on the content.

Every document counts: texts are grouped by a 128-bit digest, and a text that occurs
twice is repeated as a whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailloom.llm.common import prepare, scratch, stored, text_key

#: Bytes of the pieces of a shard, on average, and of an anchor at most.
SHARD_BYTES = 1_000_000

#: Ranges of offsets that the pieces of an anchor with too many bytes are cut into.
WAYS = 8

#: Bytes of pieces a worker gathers before it passes them on.
_OUT_BYTES = 4_000_000

_BASE = 0x9E3779B97F4A7C15
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))


@dataclass(frozen=True)
class Units:
    """What texts are made of, and how long windows and anchors are."""

    split: Callable[[bytes], object]
    join: Callable[[object], bytes]
    hashes: Callable[[object], np.ndarray]
    window: int
    gram: int

    @property
    def offsets(self) -> int:
        """Offsets an anchor can have in a window."""
        return self.window - self.gram + 1


def _whole(raw: bytes) -> bytes:
    return raw


def _byte_values(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint8).astype(np.uint64) + np.uint64(1)


def _word_values(words: list[bytes]) -> np.ndarray:
    known: dict[bytes, int] = {}
    digest = xxhash.xxh64_intdigest
    for word in set(words):
        known[word] = digest(word)
    return np.fromiter((known[word] for word in words), np.uint64, len(words))


def byte_units(window: int, gram: int) -> Units:
    return Units(_whole, _whole, _byte_values, window, gram)


def word_units(window: int, gram: int) -> Units:
    return Units(bytes.split, b" ".join, _word_values, window, gram)


#: Units hashed at once; powers of the base are kept for so many.
_CHUNK = 1 << 18

#: Places in a text that are told apart in the low bits of a key; longer texts are done
#: in several steps.
_PLACES = 1 << 22
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def gram_hashes(values: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of each run of ``gram`` units."""
    if gram not in _powers:
        size = _CHUNK + gram
        with np.errstate(over="ignore"):
            up = np.cumprod(np.append(np.uint64(1), np.full(size, _BASE, np.uint64)))
            down = np.cumprod(np.append(np.uint64(1), np.full(size, _INVERSE, np.uint64)))
        _powers[gram] = up, down
    up, down = _powers[gram]
    found = []
    for start in range(0, values.size - gram + 1, _CHUNK):
        part = values[start:start + _CHUNK + gram - 1]
        with np.errstate(over="ignore"):
            sums = np.zeros(part.size + 1, np.uint64)
            np.cumsum(part * up[:part.size], out=sums[1:])
            h = (sums[gram:] - sums[:-gram]) * down[:part.size - gram + 1]
            h ^= h >> np.uint64(32)
            h *= np.uint64(0xFF51AFD7ED558CCD)
            h ^= h >> np.uint64(29)
        found.append(h)
    return np.concatenate(found)


def anchors(values: np.ndarray, units: Units):
    """Windows by anchor: its hash, the first window, number of windows, anchor's place."""
    if values.size < units.window:
        return (np.empty(0, np.uint64),) + (np.empty(0, np.int64),) * 3
    hashes = gram_hashes(values, units.gram)
    width, count = units.offsets, hashes.size - units.offsets + 1
    places = []
    for base in range(0, count, _PLACES - width):
        part = hashes[base:base + _PLACES - 1]
        # The place in the low bits: the least key is the leftmost of the least hashes.
        keys = part & ~np.uint64(_PLACES - 1) | np.arange(part.size, dtype=np.uint64)
        padded = np.full(-(-part.size // width) * width, np.uint64(2**64 - 1))
        padded[:part.size] = keys
        # The least of each run of ``width`` keys, from running minima within blocks.
        blocks = padded.reshape(-1, width)
        upto = np.minimum.accumulate(blocks, axis=1).ravel()
        onward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        here = part.size - width + 1
        least = np.minimum(onward[:here], upto[width - 1:width - 1 + here])
        places.append((least & np.uint64(_PLACES - 1)).astype(np.int64) + base)
    place = np.concatenate(places)[:count]
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    place = place[first]
    return hashes[place], first, np.diff(np.append(first, count)), place


#: Windows that a piece with several anchors has at most, but for its last anchor's.
_MERGED = 1 << 15

#: The head of a piece that has several anchors with the same hash.
SEVERAL = -1


def spots(values: np.ndarray, units: Units):
    """Pieces of a text: anchor hash, first window, number of windows, anchor's offset.

    In a text that repeats itself the anchor moves on from one occurrence of the same run
    to the next. Such windows stay together in one piece; its offset is ``SEVERAL``.
    """
    g, at, n, place = anchors(values, units)
    if g.size < 2:
        return g, at, n, place - at
    new = np.append(True, (g[1:] != g[:-1]) | (at[1:] // _MERGED != at[:-1] // _MERGED))
    first = np.flatnonzero(new)
    alone = np.diff(np.append(first, g.size)) == 1
    return g[first], at[first], np.add.reduceat(n, first), np.where(alone, (place - at)[first], SEVERAL)


def single(whole, n: int, head: int, units: Units) -> list[tuple[int, int, int]]:
    """The parts of a piece with one anchor each: first window, windows, anchor's offset."""
    if head != SEVERAL:
        return [(0, n, head)]
    _, at, n, place = anchors(units.hashes(whole), units)
    return list(zip(at.tolist(), n.tolist(), (place - at).tolist()))


def repeated(documents: DataFrame, units: Units, detect, folder: str | None = None) -> DataFrame:
    """``(key, copies, at, n)`` for texts with repeated windows; ``key`` is ``text_key()``.

    ``at`` and ``n`` are arrays: runs of ``n`` repeated windows that start at unit
    ``at``. ``detect`` gets a shard's pieces, see :func:`_shards`.
    """
    spark = documents.sparkSession
    prepare(spark)
    folder = folder or scratch(spark)

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                values = units.hashes(units.split(text.encode("utf-8", "surrogatepass")))
                g, at, n, head = spots(values, units)
                rows.append((
                    values.size, g.view(np.int64), at.astype(np.int32), n.astype(np.int32),
                    head.astype(np.int32),
                ))
            size, g, at, n, head = zip(*rows)
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "key": batch["key"], "size": size,
                "g": g, "at": at, "n": n, "head": head,
            })

    keyed = documents.select(
        F.col("doc_id").cast("string").alias("doc_id"), text_key().alias("key"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    marked = stored(
        keyed.mapInPandas(
            mark, "doc_id string, key binary, size long, g array<long>, at array<int>, "
            "n array<int>, head array<int>",
        ),
        f"{folder}/marked",
    )
    # Rows with the same text have the same spots: one row stands for all.
    texts = marked.groupBy("key").agg(
        F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("doc_id"),
        F.first("size").alias("size"),
        F.first(F.arrays_zip("g", "at", "n", "head")).alias("spots"),
    )
    texts = stored(texts, f"{folder}/texts")
    spread = texts.select("key", "doc_id", F.inline("spots"))
    # Written first, so that the join deals out both sides anew and can split a hot anchor.
    several = F.when(F.col("head") == SEVERAL, 2).otherwise(1)
    twice = spread.groupBy("g").agg(F.sum(several).alias("c")).where("c > 1").select("g")
    twice = stored(twice, f"{folder}/twice")
    wanted = spread.join(twice, "g").groupBy("key").agg(
        F.first("doc_id").alias("doc_id"),
        F.collect_list(F.struct("g", "at", "n", "head")).alias("spots"),
    ).select(
        F.col("key").alias("_key"), F.col("doc_id").alias("_doc"),
        F.col("spots.g").alias("g"), F.col("spots.at").alias("at"),
        F.col("spots.n").alias("n"), F.col("spots.head").alias("head"),
    )

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, held = [], 0
            for row in batch.itertuples(index=False):
                whole = units.split(row.text.encode("utf-8", "surrogatepass"))
                for g, at, n, head in zip(row.g, row.at, row.n, row.head):
                    piece = units.join(whole[at:at + n + units.window - 1])
                    out.append((row.key, int(at), int(g), int(n), int(head), piece))
                    held += len(piece)
                if held > _OUT_BYTES:
                    yield pd.DataFrame(out, columns=["owner", "at", "g", "n", "head", "piece"])
                    out, held = [], 0
            if out:
                yield pd.DataFrame(out, columns=["owner", "at", "g", "n", "head", "piece"])

    texts_wanted = keyed.join(
        wanted.hint("shuffle_hash"),
        (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_doc")),
    ).select("key", "text", "g", "at", "n", "head")
    pieces = texts_wanted.mapInPandas(
        cut, "owner binary, at int, g long, n int, head int, piece binary"
    ).select(
        "owner", "at", "g", "n", "head", "piece", F.lit(False).alias("twice"),
        F.lit(0).alias("low"), F.lit(units.offsets - 1).alias("high"),
    )
    runs = _solve(pieces, units, detect, folder, 0)

    copied = texts.where((F.col("copies") > 1) & (F.col("size") >= units.window)).select(
        F.col("key").alias("owner"),
        F.array(F.struct(
            F.lit(0).alias("at"), (F.col("size") - units.window + 1).cast("int").alias("n")
        )).alias("runs"),
    )
    return runs.unionByName(copied).groupBy("owner").agg(
        F.flatten(F.collect_list("runs")).alias("runs")
    ).select(F.col("owner").alias("key"), F.col("runs.at").alias("at"), F.col("runs.n").alias("n"))


def _solve(pieces: DataFrame, units: Units, detect, folder: str, depth: int) -> DataFrame:
    """``(owner, runs)``: runs of repeated windows of the pieces' owners, a row per piece."""
    spark = pieces.sparkSession
    pieces = stored(pieces.withColumn("p", F.xxhash64("piece", "head")), f"{folder}/pieces-{depth}")
    place = F.xxhash64("owner", "at")
    distinct = stored(
        pieces.groupBy("g", "p", "head", "n", "low", "high", "piece").agg(
            (F.max("twice") | (F.min(place) != F.max(place))).alias("twice")
        ),
        f"{folder}/distinct-{depth}",
    )
    stats = distinct.groupBy("g").agg(
        F.count(F.lit(1)).alias("members"), F.min("twice").alias("known"),
        F.sum(F.length("piece")).alias("bytes"), F.min("head").alias("head"),
    )
    # Nothing is left to find where a piece has no other and one anchor, or all occur twice.
    open_ = (F.col("members") > 1) | (F.col("head") == SEVERAL)
    stats = stored(stats.where(open_ & ~F.col("known")), f"{folder}/stats-{depth}")
    small = F.col("bytes") <= SHARD_BYTES
    total = stats.agg(
        F.coalesce(F.sum(F.when(small, F.col("bytes"))), F.lit(0)).alias("small"),
        F.coalesce(F.sum(F.when(~small, F.lit(1))), F.lit(0)).alias("large"),
    ).first()
    shards = max(1, -(-int(total["small"]) // SHARD_BYTES))

    compared = distinct.join(stats.where(small).select("g"), "g").select(
        F.pmod(F.xxhash64("g"), F.lit(shards)).alias("shard"), "g", "p", "n", "head", "piece"
    )
    one_run = F.array(F.struct(F.lit(0).alias("at"), F.col("n").alias("n")))
    found = compared.groupBy("shard").applyInPandas(
        _shards(units, detect), f"g long, p long, runs {_RUNS}"
    ).unionByName(distinct.where("twice").select("g", "p", one_run.alias("runs")))

    if total["large"]:
        ranges = distinct.join(stats.where(~small).select("g"), "g").mapInPandas(
            _ranges(units),
            "owner binary, at int, g long, n int, head int, piece binary, twice boolean, "
            "low int, high int",
        )
        deeper = _solve(ranges, units, detect, folder, depth + 1)
        found = found.unionByName(deeper.select(
            F.conv(F.hex(F.substring("owner", 1, 8)), 16, -10).cast("long").alias("g"),
            F.conv(F.hex(F.substring("owner", 9, 8)), 16, -10).cast("long").alias("p"),
            "runs",
        ))
    # One row for each piece, so that the join makes no more rows than there are pieces.
    found = found.groupBy("g", "p").agg(F.flatten(F.collect_list("runs")).alias("runs"))
    return pieces.select("owner", "at", "g", "p").join(stored(found), ["g", "p"]).select(
        "owner", F.transform("runs", lambda run: F.struct(
            (run["at"] + F.col("at")).alias("at"), run["n"].alias("n")
        )).alias("runs")
    )


_RUNS = "array<struct<at: int, n: int>>"


def _shards(units: Units, detect):
    """``detect(pieces, heads, groups, units)`` returns, per piece, booleans per window."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        content = [units.split(piece) for piece in frame["piece"]]
        flags = detect(content, frame["head"].to_numpy(), frame["g"].to_numpy(), units)
        out = []
        for g, p, hits in zip(frame["g"], frame["p"], flags):
            edge = np.flatnonzero(np.diff(np.concatenate(([0], hits.astype(np.int8), [0]))))
            if edge.size:
                out.append((g, p, [
                    {"at": a, "n": b - a} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())
                ]))
        return pd.DataFrame(out, columns=["g", "p", "runs"])

    return run


def _ranges(units: Units):
    """Each piece cut by its anchor's offset, dealt out by what the windows of a cut share."""

    columns = ["owner", "at", "g", "n", "head", "piece", "twice", "low", "high"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, held = [], 0
            for row in batch.itertuples(index=False):
                whole = units.split(row.piece)
                owner = int(row.g).to_bytes(8, "big", signed=True) + int(row.p).to_bytes(
                    8, "big", signed=True
                )
                step = -(-(row.high - row.low + 1) // WAYS)
                for first, many, head in single(whole, row.n, row.head, units):
                    for low in range(row.low, row.high + 1, step):
                        high = min(low + step - 1, row.high)
                        # Windows of this anchor whose offset lies in this range.
                        most, least = min(high, head), max(low, head - many + 1)
                        if most < least:
                            continue
                        place, start = first + head, first + head - most
                        n = most - least + 1
                        shared = units.join(whole[place - low:place - high + units.window])
                        seen = hashlib.md5(b"%d %d %d " % (row.g, low, high) + shared).digest()
                        piece = units.join(whole[start:start + n + units.window - 1])
                        out.append((
                            owner, start, int.from_bytes(seen[:8], "big", signed=True), n, most,
                            piece, row.twice, low, high,
                        ))
                        held += len(piece)
                    if held > _OUT_BYTES:
                        yield pd.DataFrame(out, columns=columns)
                        out, held = [], 0
            yield pd.DataFrame(out, columns=columns)

    return run


def covered(size: int, at, n, window: int) -> np.ndarray:
    """Which of ``size`` units lie in a repeated window."""
    marks = np.zeros(size + 1, np.int64)
    if at is not None and len(at):
        at = np.asarray(at, np.int64)
        np.add.at(marks, at, 1)
        np.add.at(marks, at + np.asarray(n, np.int64) + window - 1, -1)
    return np.cumsum(marks[:-1]) > 0


def with_runs(documents: DataFrame, runs: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` with the columns ``_at`` and ``_n``, null where nothing repeats."""
    found = runs.select(F.col("key").alias("_found"), F.col("at").alias("_at"), F.col("n").alias("_n"))
    return (
        documents.withColumn("_key", text_key(text))
        .join(found.hint("shuffle_hash"), F.col("_key") == F.col("_found"), "left")
        .drop("_key", "_found")
    )
