"""Repeated strings of a minimum length, from the Burrows-Wheeler transform of a text.

Common prefixes of neighbouring suffixes are derived in the order of their
length: an interval of suffixes that start with a string is extended backward
by each character in front of it, which gives the intervals of strings that
are one longer; the end of a new interval is where the common prefix has just
the length that was reached. Each end is set once and its interval goes on
breadth-first. The expansion stops at the minimum length: ends that are not
set by then have at least that much in common.
"""

from __future__ import annotations

import numpy as np

#: Symbols of a suffix that are packed into its first key.
PACKED = 7
_UNSET = -1


def _order(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of their first ``depth`` symbols, and the packed keys.

    Ranks by ever longer prefixes; only suffixes with equal ranks are sorted
    again. The order of suffixes that agree to the depth is arbitrary.
    """
    size = len(symbols)
    padded = np.concatenate([symbols, np.zeros(depth + PACKED, symbols.dtype)]).astype(np.int64)
    key = np.zeros(size, np.int64)
    for k in range(PACKED):
        key = (key << 9) | padded[k : k + size]
    order = np.argsort(key)
    rank = np.zeros(size + depth, np.int64)  # beyond the end, rank 0

    def number(sorted_keys: np.ndarray, places: np.ndarray, base: np.ndarray) -> None:
        """Ranks from 1: the place of the first one with the same key."""
        new = np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])
        start = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        rank[places] = base[start] + 1

    number(key[order], order, np.arange(size))
    reached = PACKED
    while reached < depth:
        step = min(reached, depth - reached)
        ranks = rank[order]
        same = ranks[1:] == ranks[:-1]
        tied = np.flatnonzero(np.concatenate([[False], same]) | np.concatenate([same, [False]]))
        if not len(tied):
            break
        places = order[tied]
        pair = rank[places] * (size + 1) + rank[places + step]
        by = np.argsort(pair)
        order[tied] = places[by]
        number(pair[by], places[by], tied)
        reached += step
    return order, key


def repeated(symbols: np.ndarray, length: int) -> np.ndarray:
    """For each place whether its string of ``length`` symbols starts at another place too.

    Symbols are 1 .. 256; 0 separates texts, and a string with a separator in
    it is none.
    """
    size = len(symbols)
    out = np.zeros(size, bool)
    if size <= length:
        return out
    order, key = _order(symbols, length)
    place = np.empty(size, np.int64)
    place[order] = np.arange(size)
    before = symbols[order - 1].astype(np.int64)  # the transform; in front of the first is a separator
    before[place[0]] = 0
    back = place[order - 1]
    # Common prefixes shorter than the packed key can be read off the keys.
    common = np.full(size + 1, _UNSET, np.int32)
    common[0] = common[size] = 0
    differ = key[order[1:]] ^ key[order[:-1]]
    some = np.flatnonzero(differ)
    top = np.searchsorted(1 << (9 * np.arange(1, PACKED)), differ[some], side="right")
    common[some + 1] = PACKED - 1 - top
    ends = np.concatenate([some, [size - 1]])
    first = np.concatenate([[0], some + 1])
    take = common[ends + 1] == PACKED - 1
    take[-1] = True
    low, high = first[take], ends[take]
    for reached in range(PACKED, length):
        if not len(low):
            break
        single = low == high
        one = back[low[single]][before[low[single]] > 0]
        wide_low, wide_high = low[~single], high[~single]
        width = wide_high - wide_low + 1
        start = np.cumsum(width) - width
        inside = np.arange(int(width.sum())) + np.repeat(wide_low - start, width)
        group = np.repeat(np.arange(len(width)), width) * 257 + before[inside]
        real = before[inside] > 0
        group, target = group[real], back[inside[real]]
        by = np.argsort(group)
        group, target = group[by], target[by]
        new = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, int)
        low = np.concatenate([one, np.minimum.reduceat(target, new) if len(new) else one[:0]])
        high = np.concatenate([one, np.maximum.reduceat(target, new) if len(new) else one[:0]])
        fresh = common[high + 1] == _UNSET
        low, high = low[fresh], high[fresh]
        common[high + 1] = reached
    close = common == _UNSET
    alike = close[:-1] | close[1:]
    out[order] = alike
    # A separator within the length: the place is not the start of a string.
    parted = np.concatenate([[0], np.cumsum(symbols == 0)])
    last = np.minimum(np.arange(size) + length, size)
    return out & (parted[last] == parted[:-1]) & (np.arange(size) + length <= size)
