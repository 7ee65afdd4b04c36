"""Suffix sorting of an integer text by linear grouping (Lyndon-prefix groups, no recursive renaming)."""

from __future__ import annotations

import numpy as np

UNKNOWN = -2


def suffix_array(text: np.ndarray) -> list[int]:
    """Starts of the suffixes of `text` (non-negative integers) in lexicographic order; a shorter prefix is first.

    Phase 1 keeps the suffixes in groups, at first by their first symbol, and goes through the groups from the
    largest down. Each suffix of the current group points to the nearest earlier suffix of a smaller group (found
    over the pointers already known). Those pointed to take the group's context as the next part of their own: they
    move to the end of their groups, those with more pointers behind those with fewer. At the end a group holds the
    suffixes with one longest Lyndon prefix. Phase 2 goes through the order from the smallest suffix on and puts the
    suffixes whose Lyndon prefix ends there, the chain of pointers from the one before it, at the front of what is
    left of their groups.
    """
    n = len(text) + 1  # with a sentinel, smaller than all
    if n == 1:
        return []
    sym = np.empty(n, np.int64)
    sym[:-1] = np.asarray(text, np.int64) + 1
    sym[-1] = 0
    order = np.argsort(sym, kind="stable")
    ranked = sym[order]
    first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    sizes = np.diff(np.r_[first, n])
    start = np.empty(n, np.int64)
    start[order] = np.repeat(first, sizes)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    count = np.zeros(n, np.int64)
    count[first] = sizes
    at, where, group, size = order.tolist(), place.tolist(), start.tolist(), count.tolist()
    prev = [UNKNOWN] * n

    end = n - 1
    while end > 0:
        low = group[at[end]]
        if low == end:
            # one suffix: at most one suffix is pointed to
            s = at[end]
            p = s - 1
            while p >= 0 and group[p] > low:
                p = prev[p]
            prev[s] = p
            if p >= 0:
                g = group[p]
                m = size[g]
                if m > 1:
                    last = g + m - 1
                    other, i = at[last], where[p]
                    at[last], at[i] = p, other
                    where[p], where[other] = last, i
                    size[g] = m - 1
                    group[p] = last
                    size[last] = 1
            end = low - 1
            continue
        pointed: dict[int, int] = {}
        for last in at[low : end + 1]:
            waiting = [last]  # a suffix waits for the earlier one of its own group whose pointer it takes over
            while waiting:
                s = waiting[-1]
                if prev[s] != UNKNOWN:
                    waiting.pop()
                    continue
                p = s - 1
                while p >= 0 and group[p] > low:
                    p = prev[p]
                if p >= 0 and group[p] == low:
                    if prev[p] == UNKNOWN:
                        waiting.append(p)
                        continue
                    p = prev[p]
                prev[s] = p
                waiting.pop()
                if p >= 0:
                    pointed[p] = pointed.get(p, 0) + 1
        by_count: dict[int, dict[int, list[int]]] = {}
        for p, c in pointed.items():
            by_count.setdefault(c, {}).setdefault(group[p], []).append(p)
        levels = sorted(by_count, reverse=True) if len(by_count) > 1 else by_count
        for c in levels:
            for g, members in by_count[c].items():
                k, m = len(members), size[g]
                if k == m:
                    continue
                new = g + m - k
                i = new
                # those already in the last k places stay; the others change places with those that must leave
                inside = {where[p] for p in members}
                free = [j for j in range(new, g + m) if j not in inside]
                for p in members:
                    i = where[p]
                    if i < new:
                        j = free.pop()
                        other = at[j]
                        at[j], at[i] = p, other
                        where[p], where[other] = j, i
                    group[p] = new
                size[g] = m - k
                size[new] = k
        end = low - 1

    done = [False] * n
    out = [0] * n
    out[0] = n - 1
    done[n - 1] = True
    head = group  # the next free place of a group is kept at its start
    filled = [0] * n
    for i in range(n):
        s = out[i] - 1
        while s >= 0 and not done[s]:
            g = head[s]
            out[g + filled[g]] = s
            filled[g] += 1
            done[s] = True
            s = prev[s]
    return out[1:]
