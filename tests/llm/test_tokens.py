"""Packing, alignment and the manifest, against brute force on odd rows."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter
from itertools import combinations_with_replacement

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor

from mailloom.llm import alignment, manifest, packing
from mailloom.llm.chunks import Known, windows
from mailloom.llm.ranks import ranked
from mailloom.llm.tokens import byte_letters, packed_ids, tokenizer, vocabulary
from tests.llm.data import documents, odd_texts

A, B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")

_BITS = [
    " ", "a", "'s", "'t", "1", "  ", "\n", "\t", "é", "日本語", "😀", "ꙮ", "!", "<|endoftext|>",
    "<s>", "<0x41>", "\xa0", "\x1c", "\x85", "▁", "the", "ing", "\x00", "́", "²", "ª",
    "한국", "‍", " ", "\xad", "\x7f",
]


def _texts(n: int, seed: int) -> list[str]:
    draw = random.Random(seed)
    return ["".join(draw.choices(_BITS, k=draw.randrange(14))) for _ in range(n)] + [
        "x" * 3000, "ab " * 4000, "long words " * 1000,
    ]


def test_ids_of_chunks_are_those_of_the_text():
    texts = _texts(3000, 1)
    encode = tokenizer(A).encode
    for text, ids in zip(texts, packed_ids(texts, A)):
        assert np.frombuffer(ids, "<u4").tolist() == encode(text, add_special_tokens=False).ids


def test_windows_keep_all_chunks():
    text = "one two  three \n four five " * 50
    whole = [c for chunks in windows(text) for c in chunks]
    parts = [c for chunks in windows(text, 40) for c in chunks]
    assert whole == parts and len([*windows(text, 40)]) > 10


def test_known_forgets_and_makes_again():
    made = []
    known = Known(lambda c: made.append(c) or c.upper(), kept=4)
    for _ in range(2):
        assert known.of(list("abcdefgh") + ["x" * 100]) == list("ABCDEFGH") + ["X" * 100]
    assert made.count("x" * 100) == 2 and len(known) <= 2


def test_ranks(spark):
    draw = random.Random(4)
    rows = [(draw.choice("ab") if k % 3 else "hot", draw.choice([None, *range(50)])) for k in range(500)]
    found = ranked(spark.createDataFrame(rows, "g string, x long"), "g", ["x"], 10).collect()
    for group in ("a", "b", "hot"):
        want = sorted((x for g, x in rows if g == group), key=lambda x: (x is not None, x))
        have = sorted((r for r in found if r["g"] == group), key=lambda r: r["rank"])
        assert [r["x"] for r in have] == want
        assert [r["rank"] for r in have] == [*range(len(want))]
        assert {r["size"] for r in have} == {len(want)}


def test_fullest_combination():
    draw = random.Random(2)
    for _ in range(60):
        counts = {n: draw.randrange(4) for n in draw.sample(range(1, 20), 5)}
        room = draw.randrange(40)
        found = packing.fullest(counts, sorted(counts), room)
        assert all(n <= counts[length] for length, n in found.items())
        best = max(
            sum(some) for k in range(16) for some in combinations_with_replacement(sorted(counts), k)
            if sum(some) <= room and all(n <= counts[x] for x, n in Counter(some).items())
        ) if sum(counts.values()) else 0
        assert sum(length * n for length, n in found.items()) == best


def test_combinations_are_one_bin_after_the_other():
    draw = random.Random(3)
    counts = dict(Counter(draw.choice([3, 7, 7, 7, 12, 20, 31, 64]) for _ in range(400)))
    left, bins = dict(counts), 0
    while any(left.values()):
        longest = max(n for n in left if left[n])
        left[longest] -= 1
        for length, n in packing.fullest(left, sorted(left), 64 - longest).items():
            left[length] -= n
        bins += 1
    assert sum(times for _, times in packing.combinations(counts, 64)) == bins


@pytest.mark.parametrize("capacity", [64, 2048])
def test_packing(spark, capacity):
    rows = odd_texts() + [(2**60 + 1, "a big id"), (400, "w " * 5000)]
    found = packing.pack(documents(spark, rows), capacity=capacity).collect()
    want = []
    for doc_id, text in rows:
        ids = np.array(tokenizer(A).encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        first = len(ids) % capacity or capacity
        starts = [0, *range(first, len(ids), capacity)]
        for k, (at, end) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            want.append((doc_id, k, at, end - at, zlib.crc32(ids[at:end].tobytes())))
    assert Counter(tuple(r)[:5] for r in found) == Counter(want)
    sequences: dict = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for inside in sequences.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(sequences) <= 1.02 * -(-sum(r["length"] for r in found) // capacity) + 1


def test_packing_nothing(spark):
    assert packing.pack(documents(spark, [])).collect() == []


def _token_bytes():
    byte = {c: b for b, c in enumerate(byte_letters())}
    a = {i: entry.encode() if i == 50256 else bytes(byte[c] for c in entry)
         for entry, i in tokenizer(A, plain=True).get_vocab().items()}
    b = SentencePieceProcessor(model_file=B)

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    return a, b, piece


def _aligned(text, a, b, piece):
    """Whole text, ends from decoded bytes alone."""
    if not text:
        return 0, 0, [], ""
    ids_a = tokenizer(A, plain=True).encode(" " + text, add_special_tokens=False).ids
    ids_b, raw = b.encode(text), (" " + text).encode()
    if b"".join(a[i] for i in ids_a) != raw or b"".join(map(piece, ids_b)) != raw:
        return 0, 0, [], ""
    ends_a = np.cumsum([len(a[i]) for i in ids_a]).tolist()
    ends_b = np.cumsum([len(piece(i)) for i in ids_b]).tolist()
    groups, links, x, y = [], [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        i, j = ends_a.index(end) + 1, ends_b.index(end) + 1
        groups.append(",".join(map(str, ids_a[x:i])) + "|" + ",".join(map(str, ids_b[y:j])))
        links.append((ids_a[i - 1], ids_b[j - 1]))
        x, y = i, j
    return len(ids_a), len(ids_b), links, hashlib.sha256(";".join(groups).encode()).hexdigest()


# With no bytes to broadcast, pairs are dealt out.
@pytest.mark.parametrize("pair_bytes", [64 << 20, 0])
def test_alignment(spark, pair_bytes):
    rows = odd_texts() + [(1000 + k, text) for k, text in enumerate(_texts(1500, 8))]
    tools = _token_bytes()
    want = [(doc_id, _aligned(text, *tools)) for doc_id, text in rows]
    counts = Counter(link for _, (_, _, links, _) in want for link in links)
    best: dict = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    have = alignment.align(documents(spark, rows), pair_bytes=pair_bytes).collect()
    assert Counter(map(tuple, have)) == Counter(
        (doc_id, n_a, n_b, len(links), len(links),
         sum(counts[link] == best[link[1]] for link in links), sum(counts[link] for link in links),
         digest)
        for doc_id, (n_a, n_b, links, digest) in want
    )
    assert alignment.align(documents(spark, [])).collect() == []


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def _tree(digests, fan):
    """The top and, per leaf, its siblings on the left and right of every level."""
    paths, at, nodes = [[] for _ in digests], [*range(len(digests))], list(digests)
    while len(nodes) > 1:
        for leaf, k in enumerate(at):
            run = k // fan * fan
            paths[leaf].append(("".join(nodes[run:k]), "".join(nodes[k + 1:run + fan])))
        nodes = [_h(*nodes[k:k + fan]) for k in range(0, len(nodes), fan)]
        at = [k // fan for k in at]
    return nodes[0], paths


@pytest.mark.parametrize("fan", [2, 8])
def test_manifest(spark, fan):
    rows = [
        (k if k % 11 else None, f"Text {'Ab' * k}é" if k % 7 else None,
         [None, "", "en", "é", "one"][0 if k < 3 else 4 if k == 3 else k % 3 + 1], f"s{k % 2}", k)
        for k in range(150)
    ] * 2 + [(999, "alone", "zz", None, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    trees: dict = {}
    for doc_id, text, lang, source, n in rows:
        leaf = _h(*map(_field, (doc_id, source, lang, n, text)))
        folded = leaf
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 and text is not None:
            folded = _h(*map(_field, (doc_id, source, lang, n, text.translate(lower))))
        trees.setdefault(lang, []).append((doc_id is not None, doc_id or 0, leaf, folded, doc_id))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    tops = [_tree([leaf[2] for leaf in sorted(trees[name])], fan) for name in names]
    root, upper = _tree([top for top, _ in tops], fan)
    want = Counter()
    for (subroot, paths), above, name in zip(tops, upper, names):
        for (_, _, leaf, folded, doc_id), path in zip(sorted(trees[name]), paths):
            path = path + above
            at = folded
            for left, right in path:
                at = _h(left, at, right)
            proof = _h(*[left + right for left, right in path])
            want[(doc_id, leaf, subroot, root, proof, at, at == root)] += 1
    found = manifest.manifest(
        table, fan=fan, changed={"text": manifest.F.translate("text", manifest._UPPER, manifest._LOWER)},
        where=manifest.F.crc32(manifest.F.col("doc_id").cast("string")) % 3 == 0,
    ).select("doc_id", "leaf", "subroot", "root", manifest.proof_digest(), "folded_root",
             manifest.F.col("folded_root") == manifest.F.col("root"))
    assert Counter(map(tuple, found.collect())) == want
    assert manifest.verified(table.limit(0)).collect() == []


def test_manifest_of_odd_rows(spark):
    rows = odd_texts()
    found = manifest.verified(documents(spark, rows)).collect()
    assert len(found) == len(rows) and len({r["root"] for r in found}) == 1
    assert all(r["verified"] for r in found if r["doc_id"] is None)
