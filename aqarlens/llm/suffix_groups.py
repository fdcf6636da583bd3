"""Linear-time suffix array by Lyndon-prefix groups.

Suffixes are first grouped by their first symbol.  Groups are taken in
descending order; when a group's turn comes, its suffixes share their longest
Lyndon prefix u.  The pointer to the previous smaller group is found for each
of them, and every suffix pointed to is refined: it moves to a new group right
above the rest of its own, one for each number of u's that follow it.  When
all groups have been taken they are final, and one ascending pass puts each
group's suffixes in order by following the same pointers.  Nothing is renamed
or solved recursively.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: list[int]) -> list[int]:
    """Starts of the suffixes of ``symbols`` (non-negative integers) in ascending order."""
    text = np.empty(len(symbols) + 1, np.int64)
    text[:-1] = np.asarray(symbols, np.int64) + 1
    text[-1] = 0
    n = len(text)
    order = np.argsort(text, kind="stable")
    _, low, sizes = np.unique(text[order], return_index=True, return_counts=True)
    start = np.empty(n, np.int64)
    start[order] = np.repeat(low, sizes)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    size = np.zeros(n, np.int64)
    size[low] = sizes
    by, group, at, size = order.tolist(), start.tolist(), place.tolist(), size.tolist()
    smaller = _group_suffixes(by, group, at, size)
    return _order_groups(group, smaller)[1:]


def _group_suffixes(by: list[int], group: list[int], at: list[int], size: list[int]) -> list[int]:
    """Refine ``group`` (each suffix's group, named by its first place) to the final groups.

    Returns the pointers to each suffix's previous suffix in a smaller group, or -1.
    """
    open_ = -2
    smaller = [open_] * len(by)
    top = len(by)
    while top > 0:
        first = group[by[top - 1]]
        followers: dict[int, int] = {}
        for suffix in by[first:top]:
            if smaller[suffix] != open_:
                continue
            chain = [suffix]
            while True:
                p = chain[-1] - 1
                while p >= 0 and group[p] > first:
                    p = smaller[p]
                if p < 0 or group[p] != first:
                    break
                if smaller[p] != open_:
                    p = smaller[p]
                    break
                chain.append(p)
            for member in chain:
                smaller[member] = p
            if p >= 0:
                followers[p] = followers.get(p, 0) + len(chain)
        if followers:
            if len(followers) == 1 or max(followers.values()) == 1:
                _raise(list(followers), by, group, at, size)
            else:
                tiers: dict[int, list[int]] = {}
                for p, count in followers.items():
                    tiers.setdefault(count, []).append(p)
                for count in sorted(tiers, reverse=True):
                    _raise(tiers[count], by, group, at, size)
        top = first
    return smaller


def _raise(moved: list[int], by: list[int], group: list[int], at: list[int], size: list[int]) -> None:
    """Make the moved suffixes of each group a new group above the rest of theirs."""
    for p in moved:
        own = group[p]
        size[own] -= 1
        last = own + size[own]
        here, other = at[p], by[last]
        by[here], at[other] = other, here
        by[last], at[p] = p, last
    new = [group[p] + size[group[p]] for p in moved]
    for p, own in zip(moved, new, strict=True):
        group[p] = own
        size[own] += 1


def _order_groups(group: list[int], smaller: list[int]) -> list[int]:
    """The suffixes in order: each one taken puts those it ends the Lyndon prefix of into their groups."""
    n = len(group)
    out = [0] * n
    out[0] = n - 1
    free = list(range(n))
    for k in range(n):
        j = out[k] - 1
        while j >= 0 and group[j] >= 0:
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            group[j] = -1
            j = smaller[j]
    return out
