"""Suffix order of an integer text by linear grouping."""

from __future__ import annotations


def suffix_order(text: list[int]) -> list[int]:
    """Positions of the symbols above 0 in the order of their suffixes.

    0 ends a string; nothing is compared beyond it, and suffixes that are equal up to their 0 stand in
    any order. The text has to begin and end with 0.

    First every suffix comes into a group with those of the same Lyndon prefix. Groups start as symbols and
    are processed from the highest down. When a group with prefix u is processed, each of its suffixes
    points to the nearest suffix to the left that is still to be processed and lower (its previous
    smaller). That suffix is now known to go on with u, so it moves, with those of its group that go on
    with u as often, to a new group just above its old one; more repeats stand higher. The groups come out
    in their final order, highest first.

    Then each group's order is emitted: a suffix is its Lyndon prefix followed by a smaller suffix, so going
    through the suffixes from the smallest up, each one puts those that reach it by their prefix to the next
    free place of their group. No names are ranked again and nothing recurses.
    """
    n = len(text)
    ranks = {s: i for i, s in enumerate(sorted(set(text)))}
    group = [ranks[s] for s in text]  # 0 for the ends
    members: list[list[int]] = [[] for _ in ranks]
    for p, g in enumerate(group):
        members[g].append(p)
    count = [len(m) for m in members]  # those that have not moved on
    lower = [g - 1 for g in range(len(ranks))]
    upper = [g + 1 for g in range(len(ranks))]
    upper[-1] = -1
    length = [1] * len(ranks)
    left = list(range(n))  # of a processed suffix: one further left
    done: list[tuple[list[int], int]] = []

    g = len(ranks) - 1
    while g > 0:
        own = members[g]
        if count[g] < len(own):
            own = [p for p in own if group[p] == g]
        if own:
            size = length[g]
            hits: dict[int, int] = {}
            for p in own:
                left[p] = p - 1
            for p in own:
                q = p - 1
                r = left[q]
                while r != q:
                    left[q] = q = left[r]
                    r = left[q]
                if group[q]:
                    hits[q] = hits.get(q, 0) + 1
            moved: dict[int, list[int]] = {}
            for q in hits:
                moved.setdefault(group[q], []).append(q)
            for old, found in moved.items():
                by_times: dict[int, list[int]] = {}
                for q in found:
                    by_times.setdefault(hits[q], []).append(q)
                was = length[old]
                count[old] -= len(found)
                levels = sorted(by_times)
                if not count[old]:  # nothing is left below: the lowest of them keep the group
                    times = levels.pop(0)
                    members[old], length[old] = by_times[times], was + times * size
                    count[old] = len(by_times[times])
                below = old
                for times in levels:
                    new = len(members)
                    above = upper[below]
                    members.append(by_times[times])
                    count.append(len(by_times[times]))
                    length.append(was + times * size)
                    lower.append(below)
                    upper.append(above)
                    upper[below] = new
                    lower[above] = new  # `above` exists: it is at most the group being processed
                    for q in by_times[times]:
                        group[q] = new
                    below = new
            done.append((own, size))
        g = lower[g]

    # next free places of the groups, lowest first, and the suffixes that reach each position, chained
    place = [0] * n
    reach = [-1] * (n + 1)
    chain = [-1] * n
    free: list[int] = []
    start = 0
    for k, (own, size) in enumerate(reversed(done)):
        free.append(start)
        start += len(own)
        for p in own:
            place[p] = k
            chain[p] = reach[p + size]
            reach[p + size] = p
    order = [0] * start
    for some in ([x for x in range(n) if text[x] == 0], order):
        for x in some:
            p = reach[x]
            while p >= 0:
                k = place[p]
                order[free[k]] = p
                free[k] += 1
                p = chain[p]
    return order
