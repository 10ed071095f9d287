"""Suffix arrays in linear time by grouping suffixes under their Lyndon prefixes.

A suffix's Lyndon prefix is its longest prefix that is smaller than all its own proper suffixes; it ends where the next
smaller suffix starts. Suffixes with equal Lyndon prefixes form a group, and groups are ordered like those prefixes.

The first phase finds the groups. They begin as one group per first symbol and are taken from the highest down. A group that
is taken is final. Its members' previous smaller suffixes, the nearest positions to the left that belong to lower groups,
have Lyndon prefixes that go on with this group's; those of them that share a group with others leave it for one just above,
the more members of the taken group they precede, the higher.

The second phase goes up the suffix array as it fills it: the suffixes whose next smaller suffix is the one reached are the
chain of previous smaller suffixes from the position before it, and each goes to the next free place of its group. No suffix
is renamed or sorted again.
"""

from __future__ import annotations

from collections.abc import Sequence


def suffix_array(symbols: Sequence[int]) -> list[int]:
    """Starts of all suffixes in ascending order; an end of the sequence is smaller than any symbol."""
    n = len(symbols)
    before, groups = lyndon_groups(symbols)
    place = [0] * (n + 1)
    at = n
    heads = [0] * len(groups)
    for number, members in enumerate(groups):
        at -= len(members)
        heads[number] = at
        for i in members:
            place[i] = number
    # Positions count from 1 here; 0 is the end of every chain, placed from the start.
    place[0] = -1
    array = [0] * n
    reached, k = n + 1, 0
    while True:
        j = reached - 1
        while place[j] >= 0:
            number = place[j]
            array[heads[number]] = j
            heads[number] += 1
            place[j] = -1
            j = before[j]
        if k == n:
            return [i - 1 for i in array]
        reached = array[k]
        k += 1


def lyndon_groups(symbols: Sequence[int]) -> tuple[list[int], list[list[int]]]:
    """Previous smaller suffixes, and the groups from the highest down. Positions count from 1; 0 is before all."""
    n = len(symbols)
    by_symbol: dict[int, list[int]] = {}
    for i, symbol in enumerate(symbols, 1):
        if symbol in by_symbol:
            by_symbol[symbol].append(i)
        else:
            by_symbol[symbol] = [i]
    # Groups are a list linked both ways; what has left a group is still in its list, and told by ``group``.
    members = [by_symbol[symbol] for symbol in sorted(by_symbol, reverse=True)]
    sizes = [len(own) for own in members]
    lower = [*range(1, len(members)), -1]
    upper = [*range(-1, len(members) - 1)]
    group = [0] * (n + 1)
    for number, own in enumerate(members):
        for i in own:
            group[i] = number
    # Positions of groups not yet taken are a list linked both ways: the left one is the previous smaller suffix.
    left = [0, *range(n + 1)]
    right = [*range(1, n + 3)]
    taken = []
    now = 0 if members else -1
    while now >= 0:
        own = members[now]
        if len(own) != sizes[now]:
            own = [i for i in own if group[i] == now]
        taken.append(own)
        preceding: dict[int, list[int]] = {}
        repeated = None
        last = 0
        for i in own:
            p, q = left[i], right[i]
            right[p] = q
            left[q] = p
            if p:
                if p != last:
                    number = group[p]
                    if sizes[number] > 1:
                        if number in preceding:
                            preceding[number].append(p)
                        else:
                            preceding[number] = [p]
                    last = p
                else:
                    if repeated is None:
                        repeated = {}
                    repeated[p] = repeated.get(p, 1) + 1
        for number, leaving in preceding.items():
            by_count = [leaving]
            if repeated is not None:
                counted: dict[int, list[int]] = {}
                for p in leaving:
                    counted.setdefault(repeated.get(p, 1), []).append(p)
                by_count = [counted[count] for count in sorted(counted)]
            if sum(map(len, by_count)) == sizes[number]:
                # None stays behind: those that precede fewest keep the group.
                by_count = by_count[1:]
            below = number
            for going in by_count:
                new, above = len(members), upper[below]
                members.append(going)
                sizes.append(len(going))
                sizes[number] -= len(going)
                lower.append(below)
                upper.append(above)
                lower[above] = upper[below] = new
                for p in going:
                    group[p] = new
                below = new
        now = lower[now]
    return left, taken
