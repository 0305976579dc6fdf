"""Repeated windows of one shard of text: suffix array, common prefixes (numpy, inside tasks)."""

from __future__ import annotations

import numpy as np


#: Suffixes that are sorted at once in a round, with the rest of their last group; it changes the memory, not the order.
SORTED = 1 << 16


def _first_of_run(new: np.ndarray) -> np.ndarray:
    """For each place, where the run that it lies in begins; ``new`` marks where runs begin."""
    return np.maximum.accumulate(np.where(new, np.arange(len(new), dtype=np.int32), np.int32(0)))


def _alone(new: np.ndarray) -> np.ndarray:
    """Which places are runs by themselves."""
    alone = new.copy()
    alone[:-1] &= new[1:]
    return alone


def suffix_order(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of ``text`` (uint8), sorted by the first ``depth`` bytes, and the ranks.

    Larsson-Sadakane refinement: suffixes start sorted by 8 bytes; each round doubles the sorted
    prefix by the rank of the suffix that many bytes further on, and touches only groups
    that are not yet split to single suffixes. Suffixes of one rank agree in ``depth`` bytes.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key <<= np.uint64(8)
        key |= padded[i:n + i]
    order = np.argsort(key, kind="stable").astype(np.int32)
    key = key[order]
    new = np.ones(n, bool)
    np.not_equal(key[1:], key[:-1], out=new[1:])
    del key, padded
    rank = np.empty(n + 1, np.int32)
    rank[order] = _first_of_run(new)
    rank[n] = -1
    sorted_to = 8
    open_at = np.flatnonzero(~_alone(new)).astype(np.int32)
    while sorted_to < depth and len(open_at):
        reach = min(2 * sorted_to, depth)
        # ranks of the last round, read before this one writes any; groups lie in the order of their ranks
        group = rank[order[open_at]]
        after = rank[np.minimum(order[open_at] + np.int32(reach - sorted_to), n)]
        alone = np.empty(len(open_at), bool)
        begin = 0
        while begin < len(open_at):
            end = int(np.searchsorted(group, group[min(begin + SORTED, len(open_at)) - 1], side="right"))
            at, own, then = open_at[begin:end], group[begin:end], after[begin:end]
            place = np.argsort(own.astype(np.int64) * (n + 1) + then + 1, kind="stable")
            suffix, then = order[at][place], then[place]
            new = np.ones(end - begin, bool)
            new[1:] = (own[1:] != own[:-1]) | (then[1:] != then[:-1])
            order[at] = suffix
            rank[suffix] = at[_first_of_run(new)]
            alone[begin:end] = _alone(new)
            begin = end
        open_at = open_at[~alone]
        sorted_to = reach
    return order, rank[:n]


def common_prefixes(text: np.ndarray, room: np.ndarray, suffix: np.ndarray, other: np.ndarray,
                    limit: int) -> np.ndarray:
    """Length, up to ``limit``, of the prefix that each suffix shares with ``other``.

    Kasai's rule: if the next suffix of the text is paired with the next of the other, its common
    prefix is one shorter. So only the first pair of such a run is compared with the text, eight
    bytes at a time, and the rest of the run follows. ``suffix`` ascends; ``room`` is what
    each suffix has left before its own string ends.
    """
    if not len(suffix):
        return np.empty(0, np.int64)
    head = np.concatenate([[True], (suffix[1:] != suffix[:-1] + 1) | (other[1:] != other[:-1] + 1)])
    first = np.flatnonzero(head)
    length = np.diff(np.append(first, len(suffix)))
    need = limit + length - 1  # so that the whole run knows its prefixes up to the limit
    a, b = suffix[first], other[first]
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.as_strided(padded, (n + 1, 8), (1, 1))
    common = np.zeros(len(first), np.int64)
    live = np.arange(len(first))
    while len(live):
        x, y = a[live] + common[live], b[live] + common[live]
        inside = (x < n) & (y < n)
        same = words[np.minimum(x, n)] == words[np.minimum(y, n)]
        run = np.where(same.all(1), 8, same.argmin(1)) * inside
        common[live] += run
        live = live[(run == 8) & (common[live] < need[live])]
    run_of = np.cumsum(head) - 1
    return np.minimum(common[run_of] - (np.arange(len(suffix)) - first[run_of]),
                      np.minimum(np.minimum(room[suffix], room[other]), limit))


def window_classes(strings: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of equal windows of a list of strings.

    Returns, for every window in text order, (string number, offset, class); windows have one
    class if and only if their bytes are equal. Built from the suffix array of all strings: neighbours
    with a common prefix of at least ``window`` bytes inside their strings are one class.
    """
    text = np.frombuffer(b"".join(strings), np.uint8)
    sizes = np.array([len(s) for s in strings], np.int64)
    ends = np.cumsum(sizes)
    room = np.repeat(ends.astype(np.int32), sizes) - np.arange(len(text), dtype=np.int32)
    order, rank = suffix_order(text, window)
    order = order[room[order] >= window]
    if not len(order):
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    rank = rank[order]
    near = np.flatnonzero(rank[1:] == rank[:-1])  # candidates for a common window
    del rank
    suffix, other = order[near + 1], order[near]
    by_place = np.argsort(suffix)
    shared = np.empty(len(near), np.int64)
    shared[by_place] = common_prefixes(text, room, suffix[by_place], other[by_place], window)
    starts = np.ones(len(order), bool)
    starts[near + 1] = shared < window
    del near, suffix, other, by_place, shared
    in_text = np.argsort(order).astype(np.int32)
    classes, place = np.cumsum(starts, dtype=np.int32)[in_text] - np.int32(1), order[in_text]
    del in_text, order
    number = np.searchsorted(ends, place, side="right").astype(np.int32)
    return number, place - (ends - sizes)[number], classes
