"""Suffix sorting by linear grouping, for many short texts at once.

Phase 1 groups the suffixes of each text by their Lyndon prefix: groups are
taken in descending order; every suffix of a group looks up its previous
smaller suffix through pointers, and the suffixes found there move up into new
groups, as their prefix now extends by this group's. Phase 2 runs over the
order from the smallest suffix on and puts the suffixes that a placed one
bounds next in their groups, which yields each group's order without renaming
or recursion. The texts are independent, so numpy treats the current group of
every text in one step.
"""

from __future__ import annotations

import numpy as np


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, … (count[0] of them), then the same for first[1], …"""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - count), count)


def suffix_arrays(text: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The suffix array of each text, one after the other, as positions in ``text``.

    ``first`` holds where each text begins. Every text must end with a symbol
    that is smaller than all its others.
    """
    n = len(text)
    last = np.append(first[1:], n) - 1
    owner = np.repeat(np.arange(len(first)), last - first + 1)
    order = np.lexsort((text, owner))  # the first groups: suffixes by first symbol
    head = np.concatenate(([True], (text[order][1:] != text[order][:-1]) | (owner[order][1:] != owner[order][:-1])))
    starts = np.flatnonzero(head)
    group = np.empty(n + 1, np.int64)  # where a suffix's group begins in the order
    group[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    group[n] = -1  # "no previous suffix"
    size = np.zeros(n, np.int64)
    size[starts] = np.diff(np.append(starts, n))
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    prev = np.arange(-1, n)
    prev[first] = n
    hit = np.zeros(n, bool)

    top = last.copy()  # the last place that is not processed yet, for each text
    while True:
        low = group[order[top]]
        live = low > first  # the last symbol's own group stays
        if not live.all():
            top, low, first = top[live], low[live], first[live]
            if not len(top):
                break
        count = top - low + 1
        members = order[_ranges(low, count)]
        floor = np.repeat(low, count)
        p = prev[members]
        behind = np.flatnonzero(group[p] >= floor)
        while len(behind):
            p[behind] = prev[p[behind]]
            behind = behind[group[p[behind]] >= floor[behind]]
        prev[members] = p
        top = low - 1

        p = np.sort(p[p < n])
        if not len(p):
            continue
        edge = np.flatnonzero(np.concatenate(([True], p[1:] != p[:-1])))
        found, times = p[edge], np.diff(np.append(edge, len(p)))
        old = group[found]
        rank = np.lexsort((times, old))
        found, times, old = found[rank], times[rank], old[rank]
        # The hit suffixes of a group go to its end, more repeats further up.
        block = np.flatnonzero(np.concatenate(([True], old[1:] != old[:-1])))
        hits = np.diff(np.append(block, len(old)))
        tail = np.repeat(old[block] + size[old[block]] - hits, hits)
        target = tail + np.arange(len(old)) - np.repeat(block, hits)
        was = place[found]
        hit[found] = True
        there = order[target]
        moved = there[~hit[there]]
        hit[found] = False
        if len(moved):
            free = was[was < tail]
            order[free] = moved
            place[moved] = free
        order[target] = found
        place[found] = target
        size[old[block]] -= hits
        new = np.flatnonzero(np.concatenate(([True], (old[1:] != old[:-1]) | (times[1:] != times[:-1]))))
        lengths = np.diff(np.append(new, len(old)))
        size[target[new]] = lengths
        group[found] = np.repeat(target[new], lengths)

    first = np.append(0, last[:-1] + 1)
    result = np.full(n, -1, np.int64)
    result[first] = last
    fill = np.arange(n + 1)  # next free place of each group, by where it begins
    done = np.zeros(n + 1, bool)
    done[last] = True
    done[n] = True
    at, ends, alive = first.copy(), last, np.arange(len(first))
    while len(at):
        p = np.where(result[at] == first[alive], n, result[at] - 1)
        p = p[~done[p]]
        while len(p):
            slot = fill[group[p]]
            fill[group[p]] += 1
            result[slot] = p
            done[p] = True
            p = prev[p]
            p = p[~done[p]]
        at = at + 1
        more = at <= ends[alive]
        if not more.all():
            at, alive = at[more], alive[more]
    return result
