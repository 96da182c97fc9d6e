"""Groups of suffixes with equal prefixes, by bounded interval expansion on a Burrows-Wheeler transform.

Suffixes of a set of strings are sorted to a bounded depth. On the transform of that order, intervals of suffixes that
begin with a string are extended backwards by one symbol, breadth first: strings of length 7 first (which the first
sorting step gives), then 8, and so on. The right end of a new interval of strings of length n + 1 where no boundary
was known has common prefix n, so common prefixes come out by increasing value, each boundary once, and expansion
stops at the threshold: neighbours without a boundary then share at least that many symbols.
"""

import numpy as np

FIRST = 7  # symbols of nine bits that fit a 64-bit word


def ranked(values: np.ndarray) -> np.ndarray:
    """Dense ranks of values."""
    order = np.argsort(values)
    new = np.empty(len(values), np.int64)
    new[order] = np.cumsum(np.diff(values[order], prepend=values[order[:1]]) != 0)
    return new


def spread_ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All integers of the ranges start .. start + size - 1, one range after another."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + size, size)


def prefix_groups(data: np.ndarray, sizes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """For strings that lie one after another in `data` (bytes): positions with at least `least` bytes left in their
    string, ordered by group, and the group of each; equal groups are equal prefixes of `least` bytes.
    """
    n = int(sizes.sum() + len(sizes))
    ends = np.cumsum(sizes + 1) - 1  # of each string: the place of its end mark, symbol 0
    symbol = np.zeros(n, np.int64)
    inside = np.ones(n, bool)
    inside[ends] = False
    symbol[inside] = data.astype(np.int64) + 1
    left = np.repeat(ends, sizes + 1) - np.arange(n)

    word = np.zeros(n, np.int64)
    for j in range(FIRST):
        moved = np.zeros(n, np.int64)
        moved[: max(0, n - j)] = symbol[j:]
        word = word << 9 | np.where(left > j, moved, 0)
    first = rank = ranked(word)
    depth = FIRST
    while depth < least + 1:
        after = np.zeros(n, np.int64)
        after[: max(0, n - depth)] = rank[depth:] + 1
        rank = ranked(rank * (n + 2) + np.where(left > depth, after, 0))
        depth *= 2
    order = np.argsort(rank, kind="stable")  # suffixes; equal ones by place

    before = np.roll(symbol, 1)[order].astype(np.uint16)  # the transform
    step = np.empty(n, np.int64)
    step[np.argsort(before, kind="stable")] = np.arange(n)
    head = symbol[order]
    cut = np.zeros(n + 1, bool)
    cut[0] = cut[n] = True
    cut[1:n] = np.diff(first[order]) != 0
    low = np.flatnonzero(cut[:-1])
    size = np.diff(np.append(low, n))
    whole = left[order[low]] >= FIRST
    low, size = low[whole], size[whole]
    for _ in range(FIRST, least):
        if not len(low):
            break
        rows, owner = spread_ranges(low, size), np.repeat(np.arange(len(low)), size)
        real = before[rows] > 0
        to, owner = step[rows[real]], owner[real]
        sort = np.argsort(to)
        to, owner = to[sort], owner[sort]
        starts = np.flatnonzero(np.r_[True, (to[1:] != to[:-1] + 1) | (owner[1:] != owner[:-1]) | (head[to[1:]] != head[to[:-1]])]) if len(to) else np.zeros(0, np.int64)
        size = np.diff(np.append(starts, len(to)))
        low = to[starts]
        new = ~cut[low + size]
        low, size = low[new], size[new]
        cut[low + size] = True
    long = left[order] >= least
    group = np.cumsum(cut[:n])
    # A shorter suffix never lies between two that share `least` bytes, but it may begin a run without a boundary.
    edge = np.r_[True, long[1:] != long[:-1]]
    group = np.cumsum(cut[:n] | edge)
    rows = np.flatnonzero(long)
    place = order[rows]
    return place - np.searchsorted(ends, place), group[rows]
