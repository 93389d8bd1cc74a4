"""Suffix arrays by induced sorting and permuted common prefixes, in numpy.

Both inductions run bucket by bucket: what a bucket induces goes to the ends of other buckets in one vectorised step, and
what falls into the bucket itself (runs of one byte) makes further steps. The order that results is that of the
sequential algorithm. Places are 32-bit numbers: texts have less than 2**31 bytes.
"""

from __future__ import annotations

import numpy as np


def suffix_types(t: np.ndarray) -> np.ndarray:
    """True for suffixes smaller than their successors (S); the empty suffix at the end is smaller than all."""
    n = len(t)
    out = np.zeros(n + 1, bool)
    out[n] = True
    if n:
        nxt = np.append(t[1:].astype(np.int32), -1)
        differ = nxt != t
        # the comparison that decides a suffix is that of the next position whose byte differs
        at = np.where(differ, np.arange(n), n)
        at = np.minimum.accumulate(at[::-1])[::-1]
        out[:n] = (nxt > t)[at]
    return out


def _induce(t: np.ndarray, small: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The order of all suffixes that follows from an order of the leftmost S suffixes."""
    n = len(t)
    count = np.bincount(t, minlength=256)
    begin = np.concatenate([[0], np.cumsum(count)])
    sa = np.full(n, -1, np.int32)
    head, tail = begin[:-1].copy(), begin[1:].copy()
    buckets = np.flatnonzero(count)
    lms_at = np.searchsorted(t[lms], np.arange(257)) if len(lms) else np.zeros(257, np.int64)

    def place(before: np.ndarray, up: bool) -> None:
        """before, in the order of their successors, to the free heads or tails of their buckets."""
        d = t[before]
        order = np.argsort(d, kind="stable")
        got = np.bincount(d, minlength=256)
        d = d[order]
        rank = np.arange(len(d)) - (np.cumsum(got) - got)[d]
        if up:
            sa[head[d] + rank] = before[order]
            head[:] += got
        else:
            sa[tail[d] - 1 - rank] = before[order]
            tail[:] -= got

    def large(e):
        e = e[e > 0] - 1
        return e[~small[e]]

    def less(e):
        e = e[e > 0] - 1
        return e[small[e]]

    if n:
        place(np.array([n - 1], np.int32), True)
    for c in buckets.tolist():
        lo = begin[c]
        while lo < head[c]:
            e, lo = sa[lo : head[c]], head[c]
            if len(e := large(e)):
                place(e, True)
        e = large(lms[lms_at[c] : lms_at[c + 1]])
        if len(e):
            place(e, True)
    for c in buckets[::-1].tolist():
        hi = begin[c + 1]
        while tail[c] < hi:
            e, hi = sa[tail[c] : hi][::-1], tail[c]
            if len(e := less(e)):
                place(e, False)
        e = less(sa[begin[c] : head[c]][::-1])
        if len(e):
            place(e, False)
    return sa


def _rank_names(order: np.ndarray, key: np.ndarray, where: np.ndarray, depth: int) -> np.ndarray:
    """The order of the reduced string's suffixes by `depth` bytes of the text at least. Its names are those of pieces that begin at `where`; order has them by name, and key their names in this order. Its alphabet has no small bound, so that buckets don't pay: ranks of
    pieces of twice the length are made from those of two halves until all differ, and what differs from all others is not sorted again."""
    n, width, order = len(order), 1, order.copy()
    bits = np.int64((n + 1).bit_length())
    low = (np.int64(1) << bits) - 1
    # the rank of a suffix is the place of the first of those that are equal so far; slots: places of suffixes that aren't alone
    rank, slots = np.empty(n, np.int32), np.arange(n, dtype=np.int32)
    while True:
        new = np.append(True, key[1:] != key[:-1])
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(key)))
        rank[order[slots]] = np.repeat(slots[begin], size)
        slots = slots[np.repeat(size > 1, size)]
        if not len(slots) or (where[width:] - where[:-width]).min(initial=depth) >= depth:
            return order
        at = order[slots]
        second = at + width
        key = rank[at].astype(np.int64) << bits | np.where(second < n, rank[np.minimum(second, n - 1)] + 1, 0)
        if 3 * bits < 64:  # with its place a key is still one number
            key = key << bits | at
            key.sort()
            order[slots] = key & low
            key >>= bits
        else:
            by_key = np.argsort(key, kind="stable")
            order[slots], key = at[by_key], key[by_key]
        width *= 2


def words_at(t: np.ndarray) -> np.ndarray:
    """For each position the next eight bytes as a number, the first one lowest; beyond the end there are zeros."""
    padded = np.zeros(len(t) + 8, np.uint8)
    padded[: len(t)] = t
    return np.ndarray((len(t) + 1,), "<u8", padded, strides=(1,))


def suffix_array(data: bytes | np.ndarray, depth: int | None = None) -> np.ndarray:
    """The order of all suffixes; with a depth, suffixes that share so many bytes may be in any order."""
    t = np.frombuffer(data, np.uint8) if isinstance(data, bytes) else data
    n = len(t)
    if n < 2:
        return np.arange(n)
    small = suffix_types(t)
    is_lms = np.zeros(n + 1, bool)
    is_lms[1:] = small[1:] & ~small[:-1]
    where = np.flatnonzero(is_lms[:n]).astype(np.int32)
    if len(where) < 2:
        return _induce(t, small, where)
    sa = _induce(t, small, where[np.argsort(t[where], kind="stable")])
    order = sa[is_lms[sa]]
    # equal neighbours in the order of leftmost S substrings get one name
    size = np.empty(n + 1, np.int32)
    size[where] = np.append(where[1:], n) - where + 1
    a, b = order[:-1], order[1:]
    same = size[a] == size[b]
    same &= (a + size[a] <= n) & (b + size[b] <= n)
    words = words_at(t)
    live, k = np.flatnonzero(same), 0
    while len(live):
        beyond = np.clip(8 - (size[a[live]] - k), 0, 7).astype(np.uint64) * np.uint64(8)
        ok = (words[a[live] + k] ^ words[b[live] + k]) << beyond == 0
        same[live[~ok]] = False
        live = live[ok]
        k += 8
        live = live[size[a[live]] > k]
    if same.any():
        number = np.empty(n, np.int32)
        number[where] = np.arange(len(where))
        order = where[_rank_names(number[order], np.append(0, np.cumsum(~same)), where, n if depth is None else depth)]
    return _induce(t, small, order)


def permuted_prefixes(t: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """PLCP: for each position the common prefix with the suffix before it in the order.

    Where the bytes to the left agree with those of the predecessor, a value is one less than its left
    neighbour's, so that only the other (irreducible) values are compared: eight bytes at a time, then one by one."""
    n = len(t)
    i = np.arange(n, dtype=np.int32)
    phi = np.full(n, -1, np.int32)
    phi[sa[1:]] = sa[:-1]
    reducible = np.zeros(n, bool)
    reducible[1:] = (phi[1:] > 0) & (phi[:-1] == phi[1:] - 1) & (t[:-1] == t[phi[1:] - 1])
    a = np.flatnonzero(~reducible & (phi >= 0)).astype(np.int32)
    b, size = phi[a], np.zeros(len(a), np.int32)
    room = n - np.maximum(a, b)
    words = words_at(t)
    live = np.arange(len(a))
    while len(live):
        j = size[live]
        go = j + 8 <= room[live]
        live, j = live[go], j[go]
        live = live[words[a[live] + j] == words[b[live] + j]]
        size[live] += 8
    live = np.arange(len(a))
    while len(live):
        j = size[live]
        go = j < room[live]
        live, j = live[go], j[go]
        live = live[t[a[live] + j] == t[b[live] + j]]
        size[live] += 1
    out = np.zeros(n, np.int32)
    out[a] = size
    start = np.maximum.accumulate(np.where(reducible, np.int32(-1), i))
    return out[start] - (i - start)


def repeat_classes(data: bytes, length: int) -> np.ndarray:
    """For each position a number that positions share whose next `length` bytes are equal."""
    t = np.frombuffer(data, np.uint8)
    if not len(t):
        return np.zeros(0, np.int64)
    sa = suffix_array(t, length)
    plcp = permuted_prefixes(t, sa)
    out = np.empty(len(t), np.int64)
    out[sa] = np.cumsum(plcp[sa] < length)
    return out
