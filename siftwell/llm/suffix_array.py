"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy."""

from __future__ import annotations

import numpy as np

#: Alphabets up to this size are induced a bucket at a time with numpy.
SMALL = 1 << 12


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``text`` (integers >= 0) in sorted order."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    _, ranked = np.unique(text, return_inverse=True)
    # a sentinel below all symbols ends the text
    return _induced_sort(np.append(ranked.astype(np.int64) + 1, 0))[1:]


def _types(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one after it."""
    n = len(s)
    rises = np.append(np.sign(s[1:] - s[:-1]), 1)
    turn = np.where(rises != 0, np.arange(n), n - 1)
    after = np.minimum.accumulate(turn[::-1])[::-1]  # the next place where the symbol changes
    out = rises[after] > 0
    out[-1] = True
    return out


def _induced_sort(s: np.ndarray) -> np.ndarray:
    """Suffix array of ``s``, whose last symbol is its only 0."""
    n = len(s)
    smaller = _types(s)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    induce = _induce_buckets if int(s.max()) < SMALL else _induce_scan
    order = induce(s, smaller, lms[np.argsort(s[lms], kind="stable")])
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    by_substring = order[is_lms[order]]
    name = _names(s, lms, by_substring)
    if name[-1] + 1 < len(lms):
        rank = np.zeros(n, np.int64)
        rank[by_substring] = name
        by_suffix = lms[_induced_sort(rank[lms])]
    else:
        by_suffix = by_substring
    return induce(s, smaller, by_suffix)


def _names(s: np.ndarray, lms: np.ndarray, in_order: np.ndarray) -> np.ndarray:
    """Equal leftmost-smaller substrings get equal names, in ascending order."""
    n = len(s)
    if len(in_order) == 1:
        return np.zeros(1, np.int64)
    end = np.zeros(n, np.int64)
    end[lms] = np.append(lms[1:], n - 1)
    length = end[in_order] - in_order + 1
    same = length[1:] == length[:-1]
    pair = np.flatnonzero(same)
    a, b, m = in_order[pair], in_order[pair + 1], length[pair]
    depth = 0
    while len(pair):  # compare all neighbouring substrings a symbol further
        ok = s[a + depth] == s[b + depth]
        same[pair[~ok]] = False
        ok &= depth + 1 < m
        pair, a, b, m = pair[ok], a[ok], b[ok], m[ok]
        depth += 1
    return np.concatenate([[0], np.cumsum(~same)])


def _induce_buckets(s: np.ndarray, smaller: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Order of all suffixes from that of the leftmost-smaller ones.

    The left-to-right scan of a bucket only appends to itself what is one step
    before what it holds, so it runs in waves; what belongs to later buckets is
    dealt to them in order. The same then from right to left.
    """
    kinds = int(s.max()) + 1
    small_key = s.astype(np.uint16)
    seed_cut = np.searchsorted(s[seeds], np.arange(kinds + 1))
    larger: list[list[np.ndarray]] = [[] for _ in range(kinds)]

    def deal(found: np.ndarray, to: list[list[np.ndarray]]) -> None:
        if not len(found):
            return
        key = small_key[found]
        order = np.argsort(key, kind="stable")
        found, key = found[order], key[order]
        cut = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        for i, j in zip(cut.tolist(), np.append(cut[1:], len(found)).tolist(), strict=True):
            to[int(key[i])].append(found[i:j])

    def joined(parts: list[np.ndarray]) -> np.ndarray:
        return np.concatenate(parts) if len(parts) > 1 else parts[0] if parts else np.zeros(0, np.int64)

    for c in range(kinds):
        wave, all_waves = joined(larger[c]), []
        while len(wave):
            all_waves.append(wave)
            prev = wave[wave > 0] - 1
            prev = prev[~smaller[prev]]
            own = s[prev] == c
            deal(prev[~own], larger)
            wave = prev[own]
        larger[c] = [joined(all_waves)]
        prev = seeds[seed_cut[c] : seed_cut[c + 1]]
        prev = prev[prev > 0] - 1
        deal(prev[~smaller[prev]], larger)
    less: list[list[np.ndarray]] = [[] for _ in range(kinds)]
    for c in range(kinds - 1, -1, -1):
        wave, all_waves = joined(less[c]), []
        while len(wave):
            all_waves.append(wave)
            prev = wave[wave > 0] - 1
            prev = prev[smaller[prev]]
            own = s[prev] == c
            deal(prev[~own], less)
            wave = prev[own]
        less[c] = [joined(all_waves)]
        prev = larger[c][0][::-1]
        prev = prev[prev > 0] - 1
        deal(prev[smaller[prev]], less)
    less[0] = [np.array([len(s) - 1])]  # the sentinel
    return np.concatenate([x for c in range(kinds) for x in (larger[c][0], less[c][0][::-1])])


def _induce_scan(s: np.ndarray, smaller: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The same for large alphabets, whose buckets hold few suffixes: symbol by symbol."""
    n = len(s)
    size = np.bincount(s)
    end = np.cumsum(size)
    text, less = s.tolist(), smaller.tolist()
    out = [-1] * n
    tail = end.tolist()
    for i in seeds[::-1].tolist():
        c = text[i]
        tail[c] -= 1
        out[tail[c]] = i
    head = (end - size).tolist()
    for i in out:
        if i > 0 and not less[i - 1]:
            c = text[i - 1]
            out[head[c]] = i - 1
            head[c] += 1
    tail = end.tolist()
    for k in range(n - 1, -1, -1):
        i = out[k]
        if i > 0 and less[i - 1]:
            c = text[i - 1]
            tail[c] -= 1
            out[tail[c]] = i - 1
    out[0] = n - 1
    return np.array(out)


def common_prefixes(raw: np.ndarray, order: np.ndarray, start: np.ndarray, end: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Permuted common prefixes, up to ``most``, and the neighbour they are with.

    For each position of the strings [start, end) of ``raw``: how many bytes its
    suffix shares with the suffix just before it in ``order``, within the strings
    of both. It falls by one at most from a position to the next, so all strings
    are followed side by side, each going on from where it was.
    """
    n = len(raw)
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    stop = np.zeros(n, np.int64)
    stop[:] = np.repeat(end, np.diff(np.append(start, n)))
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    word = np.zeros(n, np.uint64)
    for k in range(8):
        word |= padded[k : k + n].astype(np.uint64) << np.uint64(8 * k)
    out = np.zeros(n, np.int64)
    lanes = np.argsort(start - end, kind="stable")  # the longest strings first
    first, length = start[lanes], (end - start)[lanes]
    share = np.zeros(len(lanes), np.int64)
    for t in range(int(length.max(initial=0))):
        live = int(np.searchsorted(-length, -t, side="left"))
        i = first[:live] + t
        j = before[i]
        h = np.maximum(share[:live] - 1, 0)
        top = np.where(j < 0, 0, np.minimum(np.minimum(stop[i] - i, stop[j] - j), most))
        h = np.minimum(h, np.maximum(top, 0))
        go = np.flatnonzero(h < top)
        while len(go):
            at, left = h[go], top[go] - h[go]
            same = word[np.minimum(i[go] + at, n - 1)] ^ word[np.minimum(j[go] + at, n - 1)]
            low = same & (~same + np.uint64(1))  # its lowest set bit tells the first byte that differs
            step = np.where(same == 0, 8, np.log2(np.maximum(low, 1).astype(np.float64)).astype(np.int64) >> 3)
            step = np.minimum(step, left)
            h[go] += step
            go = go[(step == 8) & (left > 8)]
        out[i] = h
        share[:live] = h
    return out, before
