"""Suffix array of an integer string by grouping suffixes on their Lyndon prefixes."""

from __future__ import annotations


def suffix_array(s: list[int]) -> list[int]:
    """Suffixes of `s` in order. Its last symbol must be smaller than all others.

    Linear in len(s), which must have symbols from 0 to at most len(s).

    First, groups of suffixes are handled from the largest to the smallest. When a group's
    turn comes, its Lyndon prefix w is final. Each of its suffixes looks back for the
    nearest suffix in a smaller group: the previous smaller one. One that finds k of them
    in a row behind it continues as w repeated k times, and so leaves its group upwards,
    the further the larger k. Then the order within the groups follows by walking the
    suffixes in their final order: the one before a suffix, and those that the pointers
    lead to from there, are the next of their groups.
    """
    n = len(s)
    if n < 2:
        return list(range(n))
    count = [0] * (max(s) + 2)
    for c in s:
        count[c + 1] += 1
    for c in range(1, len(count)):
        count[c] += count[c - 1]
    # Groups are known by where they begin in `order`; `stop` holds their ends.
    group = [count[c] for c in s]
    stop = [0] * (n + 1)
    for c in range(len(count) - 1):
        stop[count[c]] = count[c + 1] if count[c + 1] > count[c] else stop[count[c]]
    order, place, free = [0] * n, [0] * n, count[:]
    for i, c in enumerate(s):
        order[free[c]], place[i] = i, free[c]
        free[c] += 1

    unknown = -2
    before = [unknown] * n  # the previous smaller suffix, once its group is handled
    top = n
    while top > 0:
        here = group[order[top - 1]]
        behind: dict[int, int] = {}
        for at in range(here, top):
            i = order[at]
            if before[i] != unknown:
                continue
            # Larger suffixes in between have been handled and point further back; those
            # of this group share the pointer.
            chain, p = [i], i - 1
            while p >= 0 and (g := group[p]) >= here:
                if g == here and before[p] == unknown:
                    chain.append(p)
                    p -= 1
                else:
                    p = before[p]
            for i in chain:
                before[i] = p
            if p >= 0:
                behind[p] = behind.get(p, 0) + len(chain)
        by_count: dict[int, list[int]] = {}
        for p, k in behind.items():
            by_count.setdefault(k, []).append(p)
        for k in sorted(by_count, reverse=True):
            moved: dict[int, list[int]] = {}
            for p in by_count[k]:
                moved.setdefault(group[p], []).append(p)
            for old, members in moved.items():
                end = stop[old]
                begin = end - len(members)
                if begin == old:
                    continue  # all of the group: it stays where it is
                for p in members:
                    end -= 1
                    other, at = order[end], place[p]
                    order[at], place[other] = other, at
                    order[end], place[p] = p, end
                for p in members:
                    group[p] = begin
                stop[begin], stop[old] = stop[old], begin
        top = here

    out = [-1] * n
    out[0] = n - 1
    placed = [False] * n
    placed[n - 1] = True
    free = list(range(n))
    for at in range(n):
        p = out[at] - 1
        while p >= 0 and not placed[p]:
            g = group[p]
            out[free[g]] = p
            free[g] += 1
            placed[p] = True
            p = before[p]
    return out
