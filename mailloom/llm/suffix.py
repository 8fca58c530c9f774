"""Suffix arrays by induced sorting, and permuted common prefixes, on numpy arrays.

``suffix_array`` classifies the suffixes of a shard as smaller or larger than the one
after them, sorts the substrings between leftmost-smaller positions, names them, sorts
the string of names (recursively, or by doubling where the names are many and so the
buckets small) and induces the order of all suffixes from it, bucket by bucket. The
scans are cut into rounds whose members do not depend on each other: what a bucket
holds when the scan reaches it, then what these put into the same bucket, and so on.
"""

from __future__ import annotations

import numpy as np

#: The recursion goes on while names are repeated so often on average.
_PER_NAME = 64


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``symbols``; the last symbol is 0 and occurs once."""
    size = symbols.size
    if size == 1:
        return np.zeros(1, np.int64)
    smaller = _smaller(symbols)
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    order = _induced(symbols, smaller, leftmost)
    is_left = np.zeros(size, bool)
    is_left[leftmost] = True
    order = order[is_left[order]]
    names, distinct = _names(symbols, leftmost, order)
    if distinct < leftmost.size:
        if distinct * _PER_NAME <= leftmost.size:
            below = suffix_array(names)
        else:
            below = _doubled(names)
        order = leftmost[below]
    return _induced(symbols, smaller, order)


def _smaller(symbols: np.ndarray) -> np.ndarray:
    """Whether a suffix is smaller than the next one; true for the last."""
    step = np.diff(symbols.astype(np.int64))
    at = np.where(step != 0, np.arange(step.size), step.size)
    change = np.minimum.accumulate(at[::-1])[::-1]
    return np.append(step[change] > 0, True)


def _induced(symbols: np.ndarray, smaller: np.ndarray, leftmost: np.ndarray) -> np.ndarray:
    """All suffixes in order, from the leftmost-smaller ones in the order given."""
    size = symbols.size
    counts = np.bincount(symbols)
    ends = np.cumsum(counts)
    heads = ends - counts
    order = np.full(size, -1, np.int64)

    # The leftmost-smaller suffixes of each bucket, in their order.
    first = symbols[leftmost]
    grouped = leftmost[np.argsort(first, kind="stable")]
    left_ends = np.cumsum(np.bincount(first, minlength=counts.size))
    left_heads = np.append(0, left_ends[:-1])

    def put(found, free, forward):
        """Into the buckets of their symbols; returns the symbols."""
        into = symbols[found]
        by = np.argsort(into, kind="stable")
        sorted_ = into[by]
        new = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1]))
        many = np.diff(np.append(new, sorted_.size))
        place = np.arange(sorted_.size) - np.repeat(new, many)
        if forward:
            order[free[sorted_] + place] = found[by]
            free[sorted_[new]] += many
        else:
            order[free[sorted_] - 1 - place] = found[by]
            free[sorted_[new]] -= many
        return into

    buckets = np.flatnonzero(counts)
    free = heads.copy()
    for c in buckets:
        done = heads[c]
        while done < free[c]:
            now = order[done:free[c]]
            done = free[c]
            before = now[now > 0] - 1
            before = before[~smaller[before]]
            if before.size:
                put(before, free, True)
        now = grouped[left_heads[c]:left_ends[c]]
        if now.size:
            before = now[now > 0] - 1
            if before.size:
                put(before, free, True)
    larger_ends = free

    free = ends.copy()
    order[0] = size - 1
    free[0] -= 1
    for c in buckets[::-1]:
        done = ends[c]
        while done > free[c]:
            now = order[free[c]:done][::-1]
            done = free[c]
            before = now[now > 0] - 1
            before = before[smaller[before]]
            if before.size:
                put(before, free, False)
        now = order[heads[c]:larger_ends[c]][::-1]
        if now.size:
            before = now[now > 0] - 1
            before = before[smaller[before]]
            if before.size:
                put(before, free, False)
    return order


def _names(symbols, leftmost, order) -> tuple[np.ndarray, int]:
    """Names of the substrings between leftmost-smaller positions, in text order."""
    length = np.zeros(symbols.size, np.int64)
    length[leftmost] = np.diff(np.append(leftmost, leftmost[-1])) + 1
    a, b = order[:-1], order[1:]
    differ = length[a] != length[b]
    live = np.flatnonzero(~differ)
    offset = 0
    while live.size:
        unequal = symbols[a[live] + offset] != symbols[b[live] + offset]
        differ[live[unequal]] = True
        offset += 1
        live = live[~unequal & (length[a[live]] > offset)]
    name = np.append(0, np.cumsum(differ))
    by_place = np.zeros(symbols.size, np.int64)
    by_place[order] = name
    return by_place[leftmost], int(name[-1]) + 1


def _doubled(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of names by doubling the sorted length."""
    rank, size, reach = names.astype(np.int64), names.size, 1
    while True:
        after = np.zeros(size, np.int64)
        after[:max(0, size - reach)] = rank[reach:] + 1
        both = rank * (int(rank.max()) + 2) + after
        order = np.argsort(both, kind="stable")
        new = np.zeros(size, np.int64)
        new[order] = np.append(0, np.cumsum(np.diff(both[order]) != 0))
        rank = new
        if int(rank.max()) == size - 1:
            return order
        reach *= 2


def common_prefixes(symbols: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix, in text order, its common prefix with the one before it in order,
    and the suffix after it (-1 for the last).

    Only where the symbols before the two suffixes differ are they compared, eight at a
    time; from one such place to the next the common prefix goes down by one.
    """
    size = symbols.size
    before = np.full(size, -1, np.int64)
    before[order[1:]] = order[:-1]
    after = np.full(size, -1, np.int64)
    after[order[:-1]] = order[1:]

    padded = np.zeros(size + 8, np.uint64)
    padded[:size] = symbols
    eight = np.zeros(size, np.uint64)
    for k in range(8):
        eight |= padded[k:k + size] << np.uint64(8 * k)

    at = np.arange(size)
    known = before >= 0
    reduced = known & (at > 0) & (before > 0)
    reduced[reduced] = symbols[at[reduced] - 1] == symbols[before[reduced] - 1]
    reduced[1:] &= known[:-1]
    anchors = np.flatnonzero(~reduced)
    prefix = np.zeros(size, np.int64)
    live = anchors[known[anchors]]
    x, y = live.copy(), before[live]
    while live.size:
        inside = np.maximum(x, y) < size
        differ = np.where(inside, eight[np.minimum(x, size - 1)] ^ eight[np.minimum(y, size - 1)], 1)
        equal = differ == 0
        stop = ~equal
        low = differ[stop] & (~differ[stop] + np.uint64(1))
        prefix[live[stop]] += (np.log2(low.astype(np.float64)) // 8).astype(np.int64)
        live, x, y = live[equal], x[equal] + 8, y[equal] + 8
        prefix[live] += 8
    last = np.maximum.accumulate(np.where(~reduced, at, 0))
    return np.maximum(prefix[last] - (at - last), 0), after
