"""Operators that compare documents with each other, against brute force."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from mailloom.llm import repeats, seed_extend, simhash, suffix_dedup
from mailloom.llm.suffix import common_prefixes, suffix_array
from tests.llm.data import documents, odd_texts


def _gone(sizes, windows, window):
    """Which units lie in a window that occurs twice or more."""
    many = Counter(w for found in windows for w in found)
    out = []
    for size, found in zip(sizes, windows):
        gone = np.zeros(size, bool)
        for k, w in enumerate(found):
            if many[w] > 1:
                gone[k:k + window] = True
        out.append(gone)
    return out


def _removed_bytes(texts, window):
    raws = [(text or "").encode() for text in texts]
    found = [[raw[k:k + window] for k in range(len(raw) - window + 1)] for raw in raws]
    rows = []
    for raw, gone in zip(raws, _gone(map(len, raws), found, window)):
        kept = bytes(b for b, out in zip(raw, gone) if not out)
        edges = np.diff(np.concatenate(([0], gone.astype(int))))
        rows.append((len(raw), int(gone.sum()), int((edges == 1).sum()),
                     hashlib.sha256(kept).hexdigest()))
    return rows


def _removed_words(texts, window):
    lists = [(text or "").encode().split() for text in texts]
    found = [[tuple(ws[k:k + window]) for k in range(len(ws) - window + 1)] for ws in lists]
    rows = []
    for ws, gone in zip(lists, _gone(map(len, lists), found, window)):
        kept = b" ".join(w for w, out in zip(ws, gone) if not out)
        rows.append((len(ws), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
    return rows


def _same(have, ids, want):
    assert Counter(have) == Counter((i, *row) for i, row in zip(ids, want))


# With 1500 bytes to a shard, anchors that many documents share are split again and again.
@pytest.mark.parametrize("shard", [1_000_000, 1500])
def test_suffix_dedup(spark, monkeypatch, shard):
    monkeypatch.setattr(repeats, "SHARD_BYTES", shard)
    rows = odd_texts()
    have = suffix_dedup.removals(documents(spark)).collect()
    _same([tuple(r) for r in have], [i for i, _ in rows], _removed_bytes([t for _, t in rows], 400))


@pytest.mark.parametrize("shard", [1_000_000, 1500])
def test_seed_extend(spark, monkeypatch, shard):
    monkeypatch.setattr(repeats, "SHARD_BYTES", shard)
    rows = odd_texts()
    have = seed_extend.removals(documents(spark)).collect()
    _same([tuple(r)[:4] for r in have], [i for i, _ in rows], _removed_words([t for _, t in rows], 35))
    for row in have:
        assert hashlib.sha256(row["kept"].encode()).hexdigest() == row["kept_sha256"]


def test_without_repeats_keeps_columns(spark):
    docs = documents(spark)
    have = suffix_dedup.without_repeats(docs)
    assert have.columns == docs.columns
    found = {r["doc_id"]: r for r in have.collect()}
    assert found[1]["text"] is None and found[200]["text"] == "" and found[200]["n_chars"] == 0
    assert found[5]["text"] == "One TWO" and found[5]["g"] == "gg"


def test_suffix_array_by_hand():
    draw = np.random.default_rng(3)
    for n in range(200):
        kinds = int(draw.integers(1, 4))
        part = draw.integers(1, kinds + 1, int(draw.integers(1, 60)))
        symbols = np.append(np.tile(part, 1 + n % 3), 0).astype(np.int64)
        order = suffix_array(symbols)
        assert order.tolist() == sorted(range(symbols.size), key=lambda k: symbols[k:].tolist())
        prefix, after = common_prefixes(symbols.astype(np.uint8), order)
        for a, b in zip(order, order[1:]):
            same = 0
            while symbols[a + same] == symbols[b + same]:
                same += 1
            assert prefix[b] == same and after[a] == b


@pytest.mark.parametrize("merged", [1 << 15, 16])
@pytest.mark.parametrize("places", [1 << 22, 1 << 7])
def test_spots_cover_every_window_once(monkeypatch, merged, places):
    monkeypatch.setattr(repeats, "_MERGED", merged)
    monkeypatch.setattr(repeats, "_PLACES", places)
    units = repeats.byte_units(40, 8)
    draw = np.random.default_rng(1)
    for text in (b"ab" * 300, b"x" * 200, bytes(draw.integers(97, 100, 900)), b"abc" * 50 + b"d" + b"abc" * 50):
        values = units.hashes(text)
        hashes = repeats.gram_hashes(values, units.gram)
        g, at, n, head = repeats.spots(values, units)
        assert at[0] == 0 and (at[1:] == at[:-1] + n[:-1]).all() and at[-1] + n[-1] == len(text) - 39
        seen: dict = {}
        for key, start, many, offset in zip(g.tolist(), at.tolist(), n.tolist(), head.tolist()):
            whole = text[start:start + many + 39]
            parts = repeats.single(whole, many, offset, units)
            assert sum(p[1] for p in parts) == many
            for first, windows, place in parts:
                assert hashes[start + first + place] == key
            # Equal windows have equal keys.
            for k in range(many):
                assert seen.setdefault(whole[k:k + 40], key) == key or places < 1 << 22


def _fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _groups(prints, radius=2):
    top = list(range(len(prints)))

    def find(k):
        while top[k] != k:
            k = top[k]
        return k

    for a in range(len(prints)):
        for b in range(a):
            if bin(prints[a] ^ prints[b]).count("1") <= radius:
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(prints))]


@pytest.mark.parametrize("bucket", [4096, 3])
def test_simhash(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rows = odd_texts()
    prints = [_fingerprint(text) for _, text in rows]
    roots = _groups(prints)
    least = {}
    for (i, _), root in zip(rows, roots):
        known = [x for x in (i, least.get(root)) if x is not None]
        least[root] = min(known) if known else None
    have = simhash.near_duplicates(documents(spark)).collect()
    assert Counter((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in have) == Counter(
        (i, p, least[root]) for (i, _), p, root in zip(rows, prints, roots)
    )
    kept = simhash.keep_one(documents(spark))
    assert kept.columns == documents(spark).columns
    assert Counter(_groups_of(kept, rows, roots)) == Counter(set(roots))


def _groups_of(kept, rows, roots):
    by_row = {(i, text or ""): root for (i, text), root in zip(rows, roots)}
    return [by_row[(r["doc_id"], r["text"] or "")] for r in kept.collect()]


def test_linked_blocks():
    draw = np.random.default_rng(5)
    prints = []
    for base in draw.integers(-(2**62), 2**62, 12).tolist():
        for _ in range(40):
            flipped = base
            for bit in draw.integers(0, 62, int(draw.integers(0, 4))).tolist():
                flipped ^= 1 << bit
            prints.append(flipped)
    prints = np.unique(np.array(prints, np.int64))
    have = simhash.linked(np.zeros(prints.size, np.int64), prints)
    assert have.tolist() == _groups([p % 2**64 for p in prints.tolist()])


def test_empty_tables(spark):
    none = documents(spark, [])
    assert suffix_dedup.removals(none).count() == 0
    assert seed_extend.removals(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.keep_one(none).count() == 0
    assert suffix_dedup.without_repeats(none).count() == 0
