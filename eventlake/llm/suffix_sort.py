"""Suffix arrays by linear grouping, for many small texts side by side.

Suffixes are grouped by their Lyndon prefix. Phase 1 takes each text's groups in descending
order: every suffix of a group finds its previous smaller suffix by pointers, and those are moved,
by how many suffixes point to them, into new groups right behind their old one. Phase 2 emits each
group's order: from the smallest suffix on, a placed suffix places its left neighbour and the
chain of previous smaller suffixes at the front of their groups. Nothing is renamed or recursed.
All texts take each step at once, as numpy arrays.
"""

from __future__ import annotations

import numpy as np


def ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the half-open ranges, and the range each is from."""
    sizes = ends - starts
    owner = np.repeat(np.arange(len(starts)), sizes)
    before = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    return np.arange(len(owner)) - before[owner] + starts[owner], owner


def suffix_arrays(text: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Suffix arrays of the texts ``text[bounds[i]:bounds[i + 1]]``, one after the other.

    Codes are non-negative and below 2**16; the last of each text is smaller than its others.
    """
    lows, highs = bounds[:-1], bounds[1:]
    prev, group = lyndon_groups(text, bounds)
    return emit(lows, highs, prev, group)


def lyndon_groups(text, bounds):
    """Phase 1: each suffix's previous smaller suffix (-1: none) and its group's first rank."""
    n = len(text)
    numbers = np.int32 if n < 2**31 - 1 else np.int64  # several arrays as long as the texts live at once
    key = np.repeat(np.arange(len(bounds) - 1) << 16, np.diff(bounds))
    key |= text
    order = np.argsort(key, kind="stable").astype(numbers)
    key = key[order]
    heads = np.ones(n, dtype=bool)
    heads[1:] = key[1:] != key[:-1]
    del key
    place = np.empty(n, dtype=numbers)
    place[order] = np.arange(n, dtype=numbers)
    starts = np.flatnonzero(heads)
    end = np.zeros(n + 1, dtype=numbers)
    end[starts] = np.concatenate([starts[1:], [n]])
    group = np.empty(n, dtype=numbers)
    group[order] = np.repeat(starts.astype(numbers), np.diff(np.append(starts, n)))
    del heads, starts
    low_of = np.repeat(bounds[:-1].astype(numbers), np.diff(bounds))
    prev = np.full(n, -1, dtype=numbers)
    active, limit = np.arange(len(bounds) - 1), bounds[1:].copy()
    while len(active):
        top = limit[active]
        low = group[order[top - 1]]
        at, which = ranges(low, top)
        members, least = order[at], low[which]
        smaller = members - 1
        smaller[members == low_of[members]] = -1
        prev[members] = smaller
        todo = np.flatnonzero((smaller >= 0) & (group[smaller] >= least))
        while len(todo):
            smaller[todo] = prev[smaller[todo]]
            prev[members[todo]] = smaller[todo]
            s = smaller[todo]
            todo = todo[(s >= 0) & (group[s] >= least[todo])]
        limit[active] = low
        active = active[low > bounds[active]]
        moved, times = np.unique(smaller[smaller >= 0], return_counts=True)
        if not len(moved):
            continue
        old = group[moved]
        by = np.lexsort((times, old))
        moved, times, old = moved[by], times[by], old[by]
        new_run = np.concatenate([[True], old[1:] != old[:-1]])
        runs = np.flatnonzero(new_run)
        sizes = np.diff(np.append(runs, len(moved)))
        run = np.cumsum(new_run) - 1
        stop = end[old[runs]]
        target = (stop - sizes)[run] + np.arange(len(moved)) - runs[run]
        # members in the way go to the places that the moved ones leave
        end_run, start_run = stop[run], (stop - sizes)[run]
        was = place[moved]
        left = was[(was < start_run) | (was >= end_run)]
        left_run = run[(was < start_run) | (was >= end_run)]
        inside = np.zeros(len(moved), dtype=bool)
        taken = was[(was >= start_run) & (was < end_run)]
        inside[np.searchsorted(target, taken)] = True
        displaced = order[target[~inside]]
        room = left[np.argsort(left_run, kind="stable")]
        order[room] = displaced
        place[displaced] = room
        order[target] = moved
        place[moved] = target
        fresh = new_run | np.concatenate([[True], times[1:] != times[:-1]])
        at_fresh = np.flatnonzero(fresh)
        head = target[at_fresh]
        group[moved] = head[np.cumsum(fresh) - 1]
        tails = target[np.append(at_fresh[1:], len(moved)) - 1] + 1
        end[old[runs]] = stop - sizes
        end[head] = tails
    return prev, group


def emit(lows, highs, prev, group):
    """Phase 2: ranks by rank, every text at its own pace."""
    n = len(group)
    out = np.full(n, -1, dtype=prev.dtype)
    slot = np.arange(n + 1, dtype=prev.dtype)
    done = np.zeros(n, dtype=bool)
    last = highs - 1
    out[lows] = last
    slot[lows] += 1
    done[last] = True
    scan, high, low = lows.copy(), highs, lows
    current = last - 1
    while len(scan):
        fit = current >= low
        fit[fit] = ~done[current[fit]]
        placing = current[fit]
        where = slot[group[placing]]
        out[where] = placing
        slot[group[placing]] += 1
        done[placing] = True
        current[fit] = prev[placing]
        rest = ~fit
        scan[rest] += 1
        going = scan < high
        if not going.all():
            scan, high, low, current, rest = (x[going] for x in (scan, high, low, current, rest))
        current[rest] = out[scan[rest]] - 1
    return out
