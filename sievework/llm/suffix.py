"""Suffix sorting by linear grouping construction."""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> list[int]:
    """The starts of all suffixes in lexicographic order. The last symbol must be smaller than all others.

    Phase 1 sorts suffixes into groups by their Lyndon prefix, the part up to the next smaller suffix. Groups are segments of one
    array, first by single symbols, and are taken in descending order. Each member points to the nearest suffix before it in a
    smaller group; a suffix that k members of the taken group point to has that group's prefix k times after its own, and so leaves
    its group for a new one right behind it, those of larger k further behind. Phase 2 takes suffixes in ascending order and places
    the one before each, and along the pointers those whose next smaller suffix it is, at the next place of their group. No symbol
    is renamed and nothing is sorted again."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    held = np.asarray(symbols)[order]
    first = np.concatenate(([True], held[1:] != held[:-1]))
    begins = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    group = begins[place].tolist()  # where the suffix's group begins
    ends = np.concatenate((np.nonzero(first)[0][1:] - 1, [n - 1]))
    end = dict(zip(np.nonzero(first)[0].tolist(), ends.tolist(), strict=True))
    row, at, before = order.tolist(), place.tolist(), [-1] * n

    high = n - 1
    while high >= 0:
        begin = group[row[high]]
        times: dict[int, int] = {}
        members = row[begin : high + 1]
        if high > begin:
            members.sort()
        for i in members:
            j = i - 1
            while j >= 0 and group[j] >= begin:
                j = before[j]
            before[i] = j
            if j >= 0:
                times[j] = times.get(j, 0) + 1
        high = begin - 1
        if not times:
            continue
        by_times: dict[int, dict[int, list[int]]] = {}
        for j, k in times.items():
            by_times.setdefault(k, {}).setdefault(group[j], []).append(j)
        for k in sorted(by_times, reverse=True):
            for g, moved in by_times[k].items():
                last = end[g]
                new = last - len(moved) + 1
                if new == g:
                    continue
                free = last
                for j in moved:
                    p, other = at[j], row[free]
                    row[p], at[other] = other, p
                    row[free], at[j] = j, free
                    group[j] = new
                    free -= 1
                end[new], end[g] = last, new - 1

    result, nextfree, placed = [0] * n, {g: g for g in end}, bytearray(n)
    result[0], placed[n - 1] = n - 1, 1
    for i in range(n):
        j = result[i] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            r = nextfree[g]
            result[r], nextfree[g], placed[j] = j, r + 1, 1
            j = before[j]
    return result
