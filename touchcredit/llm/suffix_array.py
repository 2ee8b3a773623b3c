"""Suffix arrays by linear grouping, for many texts at a time.

The construction sorts suffixes by their Lyndon prefixes first.  Suffixes start
in groups of equal first symbols; groups are processed from the greatest to the
least.  Every member of the group in turn has a pointer to the previous smaller
suffix: the nearest earlier position in a lower group, found by following the
pointers of the positions between (all of greater or equal groups).  The
positions pointed at are extended by the group's word, as often as they are
pointed at, so they leave their own group for new ones right behind it, ordered
by that number.  When all groups are done a group holds the suffixes that share
a Lyndon prefix, and the groups are in order.  Their order inside is emitted in
one pass from the least suffix up: a suffix that is in place puts each suffix
whose Lyndon prefix ends where it begins at the next free place of its group.
Nothing is renamed or sorted recursively.

The steps of one text depend on each other, but texts do not, so all texts take
each step together, as arrays.
"""

from __future__ import annotations

import numpy as np


def ragged(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``first[i], first[i] + 1, ...`` for ``size[i]`` places, one after the other."""
    end = np.cumsum(size, dtype=first.dtype)
    return np.repeat(first - end + size, size) + np.arange(int(end[-1]) if len(end) else 0, dtype=first.dtype)


def suffix_arrays(symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Start places of all suffixes: text ``q``'s, ascending, lie at ``bounds[q]:bounds[q + 1]``.

    ``symbols`` (unsigned 16-bit) holds the texts one after the other; each ends
    with a 0 that occurs nowhere else in it.
    """
    bounds = bounds.astype(np.int32 if len(symbols) < 2 ** 30 else np.int64)
    group, length = _lyndon_groups(symbols, bounds)
    return _emit(group, length, bounds)


def _lyndon_groups(symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every suffix's final group (the place where it begins) and the length of its Lyndon prefix."""
    n, kind = len(symbols), bounds.dtype
    text = np.repeat(np.arange(len(bounds) - 1, dtype=kind), np.diff(bounds))
    order = np.argsort(symbols, kind="stable")
    order = order[np.argsort(text[order], kind="stable")].astype(kind)
    place = np.empty(n, kind)
    place[order] = np.arange(n, dtype=kind)
    by_symbol, by_text = symbols.take(order), text.take(order)
    heads = np.flatnonzero(np.concatenate([[True], (by_symbol[1:] != by_symbol[:-1]) | (by_text[1:] != by_text[:-1])]))
    heads = heads.astype(kind)
    sizes = np.diff(np.append(heads, kind.type(n)))
    group = np.empty(n, kind)
    group[order] = np.repeat(heads, sizes)
    size = np.zeros(n, kind)
    size[heads] = sizes
    smaller = np.arange(-1, n - 1, dtype=kind)  # the previous smaller suffix, or a place on the way to it
    smaller[bounds[:-1]] = -1
    length = np.ones(n, kind)
    pointed = np.zeros(n, bool)
    times_of, last_of = np.zeros(n, kind), np.empty(n, kind)  # scratch, by place
    low, high = bounds[:-1], bounds[1:]
    while len(high):
        head = group.take(order.take(high - 1))
        count = high - head
        member = order.take(ragged(head, count))
        floor = np.repeat(head, count)
        to = smaller.take(member)
        way = np.flatnonzero((to >= 0) & (group.take(to, mode="wrap") >= floor))
        while len(way):
            next_to = smaller.take(to.take(way))
            to[way] = next_to
            smaller[member.take(way)] = next_to
            way = way[(next_to >= 0) & (group.take(next_to, mode="wrap") >= floor.take(way))]
        hit = np.flatnonzero(to >= 0)
        if len(hit):
            to, member = to.take(hit), member.take(hit)
            number = np.arange(len(to), dtype=kind)
            last_of[to] = number
            one = last_of.take(to) == number  # of equal targets the last
            target = to[one]
            more, extra = np.unique(to[~one], return_counts=True)
            times_of[more] = extra
            times = times_of.take(target) + kind.type(1)
            times_of[more] = 0
            length[target] += times * length.take(member[one])
            _split(target, times, order, place, group, size, pointed)
        go = head > low
        low, high = low[go], head[go]
    return group, length


def _split(target, times, order, place, group, size, pointed) -> None:
    """Move ``target`` behind the rest of their groups, into new groups by ``times``."""
    old = group.take(target)
    by = np.argsort(old.astype(np.int64) << 31 | times)
    target, times, old = target.take(by), times.take(by), old.take(by)
    new_old = np.concatenate([[True], old[1:] != old[:-1]])
    segment = np.flatnonzero(new_old)
    moving = np.diff(np.append(segment, len(old))).astype(old.dtype)
    home = old[segment]
    tail = home + size[home] - moving
    to = ragged(tail, moving)
    at = place.take(target)
    pointed[target] = True
    there = order.take(to)
    displaced = there[~pointed.take(there)]
    pointed[target] = False
    freed = at[at < np.repeat(tail, moving)]  # as many a group as are displaced
    order[freed] = displaced
    place[displaced] = freed
    order[to] = target
    place[target] = to
    size[home] -= moving
    run = np.flatnonzero(new_old | np.concatenate([[True], times[1:] != times[:-1]]))
    runs = np.diff(np.append(run, len(old)))
    group[target] = np.repeat(to[run], runs)
    size[to[run]] = runs


def _emit(group: np.ndarray, length: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    n, kind = len(group), bounds.dtype
    last = bounds[1:] - 1
    following = np.arange(n, dtype=kind) + length  # the next smaller suffix
    following[last] = n
    by = np.argsort(following, kind="stable").astype(kind)
    count = np.bincount(following, minlength=n + 1).astype(kind)
    first = np.cumsum(count, dtype=kind) - count
    free = np.arange(n, dtype=kind)
    out = np.empty(n, kind)
    out[bounds[:-1]] = last
    sizes = np.diff(bounds)
    longest = np.argsort(-sizes, kind="stable")
    base, falling = bounds[:-1][longest], -sizes[longest]
    for i in range(int(sizes.max(initial=0))):
        live = np.searchsorted(falling, -i)  # texts longer than i
        x = out.take(base[:live] + kind.type(i))
        s = by.take(ragged(first.take(x), count.take(x)))
        g = group.take(s)
        at = free.take(g)
        out[at] = s
        free[g] = at + 1
    return out
