"""Vectorised hashes of bytes, words and word runs (numpy, inside tasks).

All hashes are 64-bit polynomial hashes over random byte values, taken from one running sum
per text, so that the hash of any slice costs two look-ups.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTES = np.random.default_rng(20260).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _BYTES.copy()
_FOLDED[ord("A"):ord("Z") + 1] = _BYTES[ord("a"):ord("z") + 1]
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least ``n`` of each."""
    if len(_powers["up"]) < n:
        size = 1 << max(n - 1, 1).bit_length()
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _powers[name] = np.multiply.accumulate(factors)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser: spreads all bits of a hash."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def running(values: np.ndarray) -> np.ndarray:
    """Running polynomial sums of ``values`` (uint64), one longer than the input."""
    up, _ = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=sums[1:])
    return sums


def slices(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed hashes of the slices [start, end); equal slices have equal hashes wherever they are."""
    _, down = powers(len(sums))
    return mix((sums[end] - sums[start]) * down[start] + np.uint64(0x632BE59BD9B4E019) * (end - start).astype(np.uint64))


def joined(texts) -> tuple[np.ndarray, np.ndarray]:
    """All texts (an Arrow string array without nulls) as one byte array, and the bounds of each."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32 if texts.type in (pa.string(), pa.binary()) else np.int64)
    offsets = offsets[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def byte_values(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A random 64-bit value for each byte, and the bounds of each text."""
    return _BYTES[data], bounds


def word_bounds(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` of joined texts, and the bounds of each text."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[bounds] = True
    start = np.flatnonzero(inside[1:] & (cut | ~inside[:-1]))
    end = np.flatnonzero(inside[:-1] & (cut | ~inside[1:]))
    return start, end, np.searchsorted(start, bounds)


def word_hashes(data: np.ndarray, bounds: np.ndarray, fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word, and the bounds of each text; ``fold`` lower-cases A-Z first."""
    start, end, of_text = word_bounds(data, bounds)
    return slices(running((_FOLDED if fold else _BYTES)[data]), start, end), of_text


def shingle_sets(data: np.ndarray, bounds: np.ndarray, size: int = 5) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``size`` words, A-Z lower-cased.

    A shorter text is one run of all its words; a text without words has none.
    """
    words, of_text = word_hashes(data, bounds, fold=True)
    sums = running(words)
    start = np.arange(max(len(words) - size + 1, 0))
    runs = slices(sums, start, start + size)
    short = np.flatnonzero(np.diff(of_text) < size)
    whole = slices(sums, of_text[short], of_text[short + 1])
    sets = [np.unique(runs[a:b - size + 1]) if b - a >= size else None
            for a, b in zip(of_text[:-1].tolist(), of_text[1:].tolist())]
    for i, h in zip(short.tolist(), whole):
        sets[i] = np.array([h], np.uint64) if of_text[i + 1] > of_text[i] else np.empty(0, np.uint64)
    return sets


def anchored_segments(values: np.ndarray, bounds: np.ndarray, window: int, gram: int, step: int = 1 << 21):
    """Cut the windows of joined sequences into runs that share their anchor.

    The anchor of a window is the place of its smallest gram hash, the leftmost if tied; it depends
    on the content of the window alone, so equal windows have equal anchor hashes, wherever they
    start. Returns arrays (sequence number, anchor hash, segment hash, first window, number of
    windows): all windows of a run lie in one segment of ``windows + window - 1`` values. A sequence
    shorter than a window has none.
    """
    n_windows = max(len(values) - window + 1, 0)
    sums = running(values)
    width = window - gram + 1
    low = np.uint64((1 << 22) - 1)
    parts = []
    for first in range(0, n_windows, step):
        last = min(first + step, n_windows)
        at = np.arange(first, last + width - 1)
        grams = slices(sums, at, at + gram)
        least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        done = 1
        while done < width:
            shift = min(done, width - done)
            least = np.minimum(least[:-shift], least[shift:])
            done += shift
        place = (least & low).astype(np.int64)
        sequence = np.searchsorted(bounds, np.arange(first, last), side="right") - 1
        begin = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (sequence[1:] != sequence[:-1])]))
        own = sequence[begin]
        stop = np.minimum(np.append(begin[1:], len(place)), bounds[own + 1] - window + 1 - first)
        keep = stop > begin
        begin, stop, own = begin[keep], stop[keep], own[keep]
        anchor = grams[place[begin]]
        offset = (place[begin] - begin).astype(np.uint64)
        content = slices(sums, first + begin, first + stop + window - 1)
        parts.append((own, anchor, mix(content ^ (offset * np.uint64(0xD6E8FEB86659FD93))),
                      first + begin - bounds[own], stop - begin))
    if not parts:
        empty, places = np.empty(0, np.uint64), np.empty(0, np.int64)
        return places, empty, empty, places, places
    return tuple(np.concatenate(column) for column in zip(*parts))
