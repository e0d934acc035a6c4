"""Suffix arrays of many short texts at once, by linear grouping on Lyndon prefixes.

Phase 1 keeps the suffixes of a text in groups that share a prefix, and goes through
the groups from the highest to the lowest. Each suffix of the group in hand points to
the nearest place to its left whose group is lower; that suffix's prefix is extended
by the group's own, as often as it is pointed to, so it moves into a new group just
above its old one. In the end a group holds the suffixes with one Lyndon prefix.
Phase 2 emits the order: from the smallest suffix on, the suffix one to the left of
each, and then those along the pointers, take the next free place of their groups.
Nothing is renamed and nothing recurs.

All texts go in step, one group (phase 1) or one place (phase 2) of each at a time, so
that every step is a few array operations over all of them.
"""

from __future__ import annotations

import numpy as np


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    out = np.arange(ends[-1] if len(ends) else 0)
    return out + np.repeat(starts - (ends - sizes), sizes)


def lyndon_groups(text: np.ndarray, base: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first place of each suffix's final group, its pointer or -1) for texts text[base : base + size].

    Each text ends with a symbol that is smaller than all of its others.
    """
    n = len(text)
    lane = np.repeat(np.arange(len(base)), size)
    floor = base[lane]
    place = np.lexsort((text, lane))  # which suffix is in each place
    where = np.empty(n, np.int64)
    where[place] = np.arange(n)
    new = np.ones(n, bool)
    new[1:] = (text[place][1:] != text[place][:-1]) | (lane[place][1:] != lane[place][:-1])
    first = np.flatnonzero(new)
    group = np.empty(n, np.int64)
    group[place] = np.repeat(first, np.diff(np.append(first, n)))
    count = np.zeros(n + 1, np.int64)
    count[first] = np.diff(np.append(first, n))
    starts_of_end = np.zeros(n + 1, np.int64)
    starts_of_end[first + count[first]] = first
    pointer = np.full(n, -1, np.int64)
    chosen = np.zeros(n, bool)
    todo, end = np.arange(len(base)), base + size
    while True:
        todo = todo[end[todo] > base[todo]]
        if not len(todo):
            return group, pointer
        start = starts_of_end[end[todo]]
        held = count[start]
        end[todo] = start
        i = place[_ranges(start, held)]
        low = np.repeat(start, held)
        left, bottom = i - 1, floor[i]
        pointer[i] = left
        at = np.arange(len(i))
        while len(at):
            at = at[left[at] >= bottom[at]]
            at = at[group[left[at]] >= low[at]]
            left[at] = pointer[left[at]]
            pointer[i[at]] = left[at]
        left[left < bottom] = -1
        pointer[i] = left
        ups, times = np.unique(left[left >= 0], return_counts=True)
        if not len(ups):
            continue
        old = group[ups]
        by = np.lexsort((times, old))
        ups, times, old = ups[by], times[by], old[by]
        head = np.append(True, old[1:] != old[:-1])
        at = np.flatnonzero(head)
        moved = np.diff(np.append(at, len(old)))
        olds = old[at]
        rest = count[olds] - moved
        block = olds + rest
        target = _ranges(block, moved)
        chosen[ups] = True
        pushed = place[target]
        pushed = pushed[~chosen[pushed]]
        chosen[ups] = False
        vacated = where[ups]
        vacated = vacated[vacated < np.repeat(block, moved)]
        place[vacated], where[pushed] = pushed, vacated
        place[target], where[ups] = ups, target
        run = head.copy()
        run[1:] |= times[1:] != times[:-1]
        at = np.flatnonzero(run)
        fresh, sizes = target[at], np.diff(np.append(at, len(ups)))
        count[olds] = rest
        starts_of_end[block[rest > 0]] = olds[rest > 0]
        count[fresh] = sizes
        starts_of_end[fresh + sizes] = fresh
        group[ups] = np.repeat(fresh, sizes)


def suffix_order(text: np.ndarray, base: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The suffixes of all texts, those of each in its places base : base + size, in ascending order."""
    group, pointer = lyndon_groups(text, base, size)
    n = len(text)
    out, free, placed = np.full(n, -1, np.int64), np.arange(n), np.zeros(n, bool)
    last = base + size - 1
    out[base], free[base] = last, base + 1
    placed[last] = True
    lanes = np.argsort(-size, kind="stable")
    base, size = base[lanes], size[lanes]
    for k in range(int(size[0]) if len(size) else 0):
        live = int(np.searchsorted(-size, -k, side="left"))
        i = out[base[:live] + k] - 1
        bottom = base[:live]
        while True:
            go = i >= bottom
            go[go] = ~placed[i[go]]
            i, bottom = i[go], bottom[go]
            if not len(i):
                break
            slot = free[group[i]]
            out[slot] = i
            free[group[i]] = slot + 1
            placed[i] = True
            i = pointer[i]
    return out
