"""Align the tokens of two tokenizers over whole texts, and weigh their links by the corpus.

Tokenizer A is a byte-level BPE that reads a space and the text, B a sentencepiece model
that adds that space itself. Where tokens of both end on the same byte the text is cut
into groups; the two tokens that end there are linked.

The ends come from the spans that the libraries report: character offsets of A, spans of
B's protobuf (``return_type="proto"``; the older ``immutable_proto`` is no longer offered).
Those are coarse where a token holds a part of a character: tokens of A that share a
character report all of it, and B's byte-fallback tokens report it with the last byte. There
the end is refined by the bytes that the token decodes to. A text counts only if the bytes of
all tokens of A, and of B, are those of the space and the text.

Texts are aligned chunk by chunk (``chunks.py``); both tokenizers end a token where a chunk
ends, so a text's groups are those of its chunks. A text with a chunk whose bytes differ is
aligned once more as a whole, which decides.

Counts of linked id pairs are sums over all documents. A document brings each of its pairs
once, with how often; the table of pairs is broadcast only if its measured size allows, and
else pairs are dealt out with a salt, so that a pair that every document holds is no hot key.

Nulls and odd rows: a null or empty text, and one whose bytes are not kept (for example a
text with U+2581 in it), has no tokens, zeros and the digest ''. A null id is a document like
any other, repeated rows count as often as they are there. An empty table gives no rows.
Other columns are passed over. Texts of any length are encoded whole, window by window; only a
text without a lone blank is one chunk.
"""

from __future__ import annotations

import hashlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mailloom.llm.chunks import Known, windows
from mailloom.llm.common import stored
from mailloom.llm.tokens import byte_letters, tokenizer, vocabulary
from mailloom.operators.joins import lookup_join

#: Bytes of the table of pairs that are broadcast at most.
PAIR_BYTES = 64 << 20

#: Stands for a chunk whose bytes the tokens do not keep.
DIFFERENT = (0, 0, 0, "", b"")


class Aligner:
    """Two tokenizers, the bytes of their tokens, and chunks aligned before."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor

        self._a = tokenizer(path_a, plain=True)
        self._merges, self._space = self._a.model, byte_letters()[32]
        self._b = SentencePieceProcessor(model_file=path_b)
        byte = {letter: b for b, letter in enumerate(byte_letters())}
        special = self._a.get_added_tokens_decoder()
        self._bytes_a = {
            i: entry.encode() if i in special else bytes(byte[c] for c in entry)
            for entry, i in self._a.get_vocab().items()
        }
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        self._fallback = {i for i in range(len(pieces)) if self._b.is_byte(i)}
        self._bytes_b = [
            bytes([int(p[3:5], 16)]) if i in self._fallback else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self._names = [str(i) for i in range(max(max(self._bytes_a) + 1, len(pieces)))]
        self.known = Known(self.aligned)

    def _ends_a(self, text: str, ids: list[int], spans: list[tuple[int, int]]) -> list[int]:
        if text.isascii():
            return [end for _, end in spans]
        at = [0]
        for c in text:
            at.append(at[-1] + len(c.encode()))
        ends, last = [], 0
        for k, (i, (start, end)) in enumerate(zip(ids, spans)):
            shared = at[start] < last or (k + 1 < len(spans) and spans[k + 1][0] < end)
            last = last + len(self._bytes_a[i]) if shared or at[start] != last else at[end]
            ends.append(last)
        return ends

    def _ends_b(self, pieces) -> list[int]:
        ends, last = [], 0
        for piece in pieces:
            # Spans do not count the space in front of the text.
            last = last + 1 if piece.id in self._fallback else piece.end + 1
            ends.append(last)
        return ends

    def aligned(self, chunk: str) -> tuple[int, int, int, str, bytes]:
        """Tokens of A and B, groups, the groups' text, and the packed pairs that are linked."""
        text = " " + chunk
        if chunk.isascii() and chunk.isalpha():  # one run of letters, which the merges take as it is
            tokens = self._merges.tokenize(self._space + chunk)
            # These spans are of bytes, and the letter of the space has two.
            ids_a, spans = [t.id for t in tokens], [(0, t.offsets[1] - 1) for t in tokens]
        else:
            encoded = self._a.encode(text, add_special_tokens=False)
            ids_a, spans = encoded.ids, encoded.offsets
        pieces = self._b.encode(chunk, return_type="proto").pieces
        raw = text.encode()
        ids_b = [p.id for p in pieces]
        if b"".join([self._bytes_a[i] for i in ids_a]) != raw:
            return DIFFERENT
        if b"".join([self._bytes_b[i] for i in ids_b]) != raw:
            return DIFFERENT
        names_a, names_b = [self._names[i] for i in ids_a], [self._names[i] for i in ids_b]
        places = {end: k + 1 for k, end in enumerate(self._ends_b(pieces))}
        groups, pairs, from_a, from_b = [], [], 0, 0
        for k, end in enumerate(self._ends_a(text, ids_a, spans), 1):
            to_b = places.get(end)
            if to_b:
                groups.append(",".join(names_a[from_a:k]) + "|" + ",".join(names_b[from_b:to_b]))
                pairs.append(ids_a[k - 1] << 32 | ids_b[to_b - 1])
                from_a, from_b = k, to_b
        return len(ids_a), len(ids_b), len(groups), ";".join(groups), array("q", pairs).tobytes()

    def document(self, text: str) -> list[tuple]:
        """The aligned chunks of a text, none where it is empty or bytes differ."""
        found = []
        for chunks in windows(text) if text else ():
            found += self.known.of(chunks)
        if any(chunk is DIFFERENT for chunk in found):
            whole = self.aligned(text)
            return [] if whole is DIFFERENT else [whole]
        return found


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


_TOKENS = (
    "n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, times array<long>"
)


def _lists(found: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, found)])
    flat = np.concatenate(found) if found else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))


def aligned(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document its tokens and groups, and the id pairs that it links with how often."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def make(batches):
        tool = aligner(path_a, path_b)
        for batch in batches:
            counts, digests, pairs, times = [], [], [], []
            for text in batch.column("text").to_pylist():
                found = tool.document(text or "")
                if not found:
                    counts.append((0, 0, 0))
                    digests.append("")
                    pair, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
                else:
                    a, b, groups, written, linked = zip(*found)
                    counts.append((sum(a), sum(b), sum(groups)))
                    digests.append(hashlib.sha256(";".join(written).encode()).hexdigest())
                    pair, n = np.unique(np.frombuffer(b"".join(linked), "<i8"), return_counts=True)
                pairs.append(pair)
                times.append(n)
            numbers = np.array(counts, np.int64).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(n) for n in numbers], pa.array(digests, pa.string()),
                 _lists(pairs), _lists(times)],
                ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"],
            )

    return documents.select("doc_id", "text").mapInArrow(make, f"doc_id {kind}, {_TOKENS}")


def pair_counts(links: DataFrame) -> DataFrame:
    """``(pair, count, best)``: links per id pair, and if no id of A has more with that of B.

    The ids of A that meet one id of B are at most the vocabulary of A.
    """
    counts = links.groupBy("pair").agg(F.sum("n").alias("count"))
    most = F.max("count").over(Window.partitionBy(F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))))
    return counts.withColumn("best", F.col("count") == most)


def align(
    documents: DataFrame, path_a: str | None = None, path_b: str | None = None,
    pair_bytes: int = PAIR_BYTES,
) -> DataFrame:
    """One row per document: tokens, groups, links, and what the corpus says of its links."""
    path_a = path_a or vocabulary("byte_bpe_50k.json")
    path_b = path_b or vocabulary("piece_bpe_32k.model")
    found = stored(
        aligned(documents, path_a, path_b).withColumn("row", F.monotonically_increasing_id())
    )
    links = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select(
        "row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("n")
    )
    weighed = lookup_join(
        links, stored(pair_counts(links)), ["pair"], spread=["row"], max_bytes=pair_bytes
    ).groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("count")).alias("count_sum"),
    )
    zero = F.lit(0).cast("long")
    return found.drop("pairs", "times").join(weighed, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"),
        "groups_sha256",
    )
