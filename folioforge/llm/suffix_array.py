"""Suffix arrays by linear grouping: suffixes are grouped by their longest Lyndon prefix, and the groups put in order.

Phase one takes the groups from the largest to the smallest. The previous
smaller suffix of each member is found by pointers past all that is known to be
larger; the members that share one extend its prefix, which therefore leaves its
group for a new one just above. Phase two walks the order from the smallest
suffix up and lets each suffix place those whose next smaller suffix it is, at
the front of what is left of their group. Nothing is renamed and nothing is
sorted by comparison, so the work is linear in the text.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate


def suffix_array(text: Sequence[int]) -> list[int]:
    """Start positions of all suffixes of a text over small non-negative integers, in order; a suffix comes before those that it begins."""
    n = len(text) + 1
    symbols = [s + 1 for s in text]
    symbols.append(0)
    sizes = [0] * (max(symbols) + 1)
    for s in symbols:
        sizes[s] += 1
    starts = [0, *accumulate(sizes)]
    # order: suffixes, group beside group; place: where a suffix stands; group: the start of its group; size: by that start.
    order, place, size = [0] * n, [0] * n, [0] * (n + 1)
    group = [starts[s] for s in symbols]
    fill = list(starts)
    for i, s in enumerate(symbols):
        at = fill[s]
        order[at], place[i] = i, at
        fill[s] = at + 1
    for s, k in enumerate(sizes):
        if k:
            size[starts[s]] = k
    previous = _group(order, place, group, size)
    return _emit(order, group, previous)[1:]


def _group(order: list[int], place: list[int], group: list[int], size: list[int]) -> list[int]:
    """Refine the groups in place, from the largest down; returns each suffix's previous smaller one, or -1."""
    previous = [-1] * len(order)
    last = len(order) - 1
    while last >= 0:
        first = group[order[last]]
        members = order[first : last + 1]
        if len(members) == 1:
            # The most frequent case: one member, and at most one suffix to move.
            i = members[0]
            p = i - 1
            while p >= 0 and group[p] >= first:
                p = previous[p]
            previous[i] = p
            if p >= 0:
                g = group[p]
                k = size[g] - 1
                if k:
                    end, at = g + k, place[p]
                    q = order[end]
                    order[at], place[q] = q, at
                    order[end], place[p] = p, end
                    size[g] = k
                    group[p] = end
                    size[end] = 1
        else:
            # In the order of the text, so that pointers of members further left are there.
            members.sort()
            times: dict[int, int] = {}
            for i in members:
                p = i - 1
                while p >= 0 and group[p] >= first:
                    p = previous[p]
                previous[i] = p
                if p >= 0:
                    times[p] = times.get(p, 0) + 1
            if times:
                most = max(times.values())
                if most == 1:
                    _move_up(list(times), order, place, group, size)
                else:
                    # A prefix that is extended more often is larger, and leaves first.
                    sets: dict[int, list[int]] = {}
                    for p, k in times.items():
                        sets.setdefault(k, []).append(p)
                    for k in sorted(sets, reverse=True):
                        _move_up(sets[k], order, place, group, size)
        last = first - 1
    return previous


def _move_up(moved: list[int], order: list[int], place: list[int], group: list[int], size: list[int]) -> None:
    """Take suffixes to the ends of their groups, where those of one group make a new one."""
    for p in moved:
        g = group[p]
        k = size[g] - 1
        size[g] = k
        end, at = g + k, place[p]
        q = order[end]
        order[at], place[q] = q, at
        order[end], place[p] = p, end
    for p in moved:
        g = group[p]
        group[p] = g + size[g]
    # A group that left as a whole starts where it did, and counts anew.
    for p in moved:
        size[group[p]] = 0
    for p in moved:
        size[group[p]] += 1


def _emit(order: list[int], group: list[int], previous: list[int]) -> list[int]:
    """The order of all suffixes, from the final groups."""
    n = len(order)
    free = list(range(n))
    placed = bytearray(n)
    out = [n - 1] * n
    placed[n - 1] = 1
    for k in range(n):
        i = out[k] - 1
        while i >= 0 and not placed[i]:
            g = group[i]
            at = free[g]
            out[at] = i
            free[g] = at + 1
            placed[i] = 1
            i = previous[i]
    return out
