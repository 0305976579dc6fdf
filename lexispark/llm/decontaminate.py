"""Benchmark decontamination by q-gram counting in diagonal bands (operator 1)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .hashing import mix, running, slices
from .segments import pieces, text_of
from .tables import keyed

#: Characters of a gram, and edits per character that a copy of an item may have.
GRAM, EDIT_RATE = 10, 0.08
#: Characters of the segments of an item that are searched by themselves, and of the step from one to the next.
SEGMENT, STEP = 200, 25
#: Characters of benchmark items that one pass holds in memory.
BLOCK_CHARS = 2_000_000
#: Pairs of a place in a text and a place in an item that are held at once.
HITS = 50_000
_FILTER_BITS = 22


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Lower case, and whether a letter or digit, of every character below 2^16."""
    plain = [chr(c) for c in range(1 << 16)]
    lower = np.array([ord(low) if len(low := c.lower()) == 1 else ord(c) for c in plain], np.uint32)
    return lower, np.array([c.isalnum() for c in plain])


_LOWER, _WORD = _tables()


def normalised(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in one array, and where each starts and the array ends.

    Letters and digits are lower-cased, anything between is one blank; a zero ends each text. Characters
    from 2^16 on count as letters.
    """
    chars = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64) - 1
    small = chars < 1 << 16
    low = np.where(small, chars, 0)
    word = _WORD[low] | ~small
    chars = np.where(word, np.where(small, _LOWER[low], chars), np.uint32(32))
    keep = word.copy()
    keep[1:] |= word[:-1]
    chars[ends] = 0
    keep[ends] = True
    return chars[keep], np.concatenate([[0], np.cumsum(keep)[ends]])


def edit_budget(length: int, gram: int = GRAM, rate: float = EDIT_RATE) -> int:
    """Edits allowed for an item; never so many that the q-gram lemma says nothing."""
    return max(0, min(int(length * rate), (length - gram) // gram))


def shared_grams(length: int, edits: int, gram: int = GRAM) -> int:
    """Grams of an item of ``length`` that a copy with ``edits`` edits shares at least (q-gram lemma)."""
    return length - gram + 1 - edits * gram


def fitting_distance(item: np.ndarray, text: np.ndarray, low: int, high: int) -> int:
    """Fewest edits that turn ``item`` into a part of ``text``, on the diagonals ``low`` to ``high``.

    Diagonal d pairs item place i with text place i + d; the part may start and end anywhere.
    """
    part = text[max(low, 0):max(high + len(item), 0)]
    if part.tobytes().find(item.tobytes()) % 4 == 0:
        return 0
    width = high - low + 1
    at = np.arange(width)
    padded = np.full(len(item) + width, np.uint32(0xFFFFFFFF))
    a, b = max(low, 0), min(low + len(padded), len(text))
    if b > a:
        padded[a - low:b - low] = text[a:b]
    row = np.zeros(width, np.int64)
    for i in range(len(item)):
        step = row + (padded[i:i + width] != item[i])
        step[:-1] = np.minimum(step[:-1], row[1:] + 1)
        row = np.minimum.accumulate(step - at) + at
    return int(row.min())


@dataclass
class GramIndex:
    """Grams of a block of benchmark items: sorted hashes with their items and places.

    An item has regions: the whole item is region 0, and one that is longer than ``segment`` has a segment at every
    STEP characters, and one at its end. ``edits`` and ``need`` have two columns: of the whole item, of a segment.
    """

    ids: list[int]
    items: list[np.ndarray]
    segment: int
    lengths: np.ndarray
    edits: np.ndarray
    need: np.ndarray
    grams: np.ndarray
    item_of: np.ndarray
    place_of: np.ndarray
    present: np.ndarray
    short: dict[str, list[int]]

    @classmethod
    def build(cls, rows: list[tuple[int, str]], segment: int = SEGMENT) -> GramIndex:
        line, starts = normalised([t or "" for _, t in rows])
        whole = [line[a:b - 1] for a, b in zip(starts[:-1], starts[1:])]
        whole = [c[:-1] if len(c) and c[-1] == 32 else c for c in whole]
        short: dict[str, list[int]] = {}
        for (i, _), c in zip(rows, whole):
            if 0 < len(c) < GRAM:
                short.setdefault(_string(c), []).append(i)
        kept = [(i, c) for (i, _), c in zip(rows, whole) if len(c) >= GRAM]
        items = [c for _, c in kept]
        size = [len(c) - GRAM + 1 for c in items]
        grams = [gram_hashes(c) for c in items]
        grams = np.concatenate(grams) if grams else np.empty(0, np.uint64)
        item_of = np.repeat(np.arange(len(items)), size)
        place_of = np.concatenate([np.arange(n) for n in size]) if size else np.empty(0, np.int64)
        order = np.argsort(grams, kind="stable")
        present = np.zeros(1 << _FILTER_BITS, bool)
        present[grams >> np.uint64(64 - _FILTER_BITS)] = True
        lengths = np.array([len(c) for c in items], np.int64)
        edits = np.array([[edit_budget(n), edit_budget(min(n, segment))] for n in lengths], np.int64).reshape(-1, 2)
        need = shared_grams(np.stack([lengths, np.minimum(lengths, segment)], 1), edits)
        return cls([i for i, _ in kept], items, segment, lengths, edits, need, grams[order], item_of[order], place_of[order], present, short)

    def regions(self, item: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The regions that hold each gram, given by item and place: number of the gram, and region."""
        length = self.lengths[item]
        last = -(-(length - self.segment) // STEP)  # steps to the segment at the end; below 1: no segments
        first = np.maximum(-((self.segment - GRAM - place) // STEP), 0)
        within = np.minimum(place // STEP, last - 1)
        count = np.where(last > 0, np.maximum(within - first + 1, 0), 0)
        gram = np.repeat(np.arange(len(item)), count)
        inner = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + first[gram] + 1
        end = np.flatnonzero((last > 0) & (place >= length - self.segment))
        return (np.concatenate([np.arange(len(item)), gram, end]),
                np.concatenate([np.zeros(len(item), np.int64), inner, last[end] + 1]))

    def region(self, item: int, number: int) -> tuple[int, int]:
        """Start and length of a region."""
        size = len(self.items[item])
        return (0, size) if number == 0 else (min((number - 1) * STEP, size - self.segment), self.segment)

    def matches(self, texts: list[str]) -> list[tuple[int, int, int, int]]:
        """(text number, item id, edits, start in the normalised text) of every text and item it holds."""
        line, starts = normalised(texts)
        found = self._short(texts, line, starts)
        grams = gram_hashes(line)
        hit = np.flatnonzero(self.present[grams >> np.uint64(64 - _FILTER_BITS)])
        lo = np.searchsorted(self.grams, grams[hit], "left")
        count = np.searchsorted(self.grams, grams[hit], "right") - lo
        hit, lo, count = hit[count > 0], lo[count > 0], count[count > 0]
        text = np.searchsorted(starts, hit, "right") - 1
        # a pair with too few grams for its smallest region has no match
        pairs, hits = _summed(text[own] * len(self.items) + self.item_of[entry] for own, entry in _expanded(lo, count))
        pairs = pairs[hits >= self.need.min(1)[pairs % max(len(self.items), 1)]]
        if len(pairs):
            found += self._aligned(line, starts, hit, lo, count, text, pairs)
        return sorted(found)

    def _short(self, texts: list[str], line: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, int, int]]:
        """Items shorter than a gram: too little to be known inside running text, they have to be a line of their own."""
        if not self.short:
            return []
        rows = [(number, row) for number, text in enumerate(texts) for row in text.split("\n")]
        chars, bounds = normalised([row for _, row in rows])
        size = np.diff(bounds) - 1
        found = {}
        for r in np.flatnonzero((size > 0) & (size <= GRAM)).tolist():
            words = _string(chars[bounds[r]:bounds[r + 1] - 1]).rstrip(" ")
            if words in self.short:
                found[rows[r][0], words] = None
        return [(number, item, 0, f" {_string(line[starts[number]:starts[number + 1] - 1])} ".find(f" {words} "))
                for number, words in found for item in self.short[words]]

    def _aligned(self, line: np.ndarray, starts: np.ndarray, hit: np.ndarray, lo: np.ndarray, count: np.ndarray,
                 text_of_hit: np.ndarray, pairs: np.ndarray) -> list[tuple[int, int, int, int]]:
        """Count the hits of the given pairs of text and item in each region and band, and align where they are enough."""
        n_items, longest = len(self.items), int(self.lengths.max())
        zero = len(line) + longest  # diagonals are counted from here: none is negative
        n_bands = 2 * zero + 2
        n_regions = max(-(-(longest - self.segment) // STEP), 0) + 2

        def bands():
            for own, entry in _expanded(lo, count):
                pair = text_of_hit[own] * n_items + self.item_of[entry]
                at = np.searchsorted(pairs, pair)
                near = np.flatnonzero(pairs[np.minimum(at, len(pairs) - 1)] == pair)
                item, place = self.item_of[entry[near]], self.place_of[entry[near]]
                gram, number = self.regions(item, place)
                item, place, text, pair = item[gram], place[gram], text_of_hit[own[near]][gram], at[near][gram]
                # bands of width 2 (k + 1) overlap by half, so that all diagonals within k of each other share one
                diagonal = hit[own[near]][gram] - place - starts[text] + zero
                band = diagonal // (self.edits[item, (number > 0).astype(np.int64)] + 1)
                key = (pair * n_regions + number) * n_bands + band
                yield np.concatenate([key, key - 1])

        keys, counts = _summed(bands())
        pair, band = np.divmod(keys, n_bands)
        pair, number = np.divmod(pair, n_regions)
        text, item = np.divmod(pairs[pair], n_items)
        good = np.flatnonzero(counts >= self.need[item, (number > 0).astype(np.int64)])
        best: dict[tuple[int, int], tuple[int, int]] = {}
        whole: set[tuple[int, int]] = set()
        for t, i, n, b in zip(text[good].tolist(), item[good].tolist(), number[good].tolist(), band[good].tolist()):
            if best.get((t, i), (1, 0))[0] == 0 or n > 0 and (t, i) in whole:  # a pair's whole item comes first
                continue
            start, size = self.region(i, n)
            k = int(self.edits[i, min(n, 1)])
            low = b * (k + 1) - zero + start
            found = fitting_distance(self.items[i][start:start + size], line[starts[t]:starts[t + 1]], low - k, low + 2 * (k + 1) + k)
            if found <= k:
                best[t, i] = min(best.get((t, i), (found, low)), (found, low))
                if n == 0:
                    whole.add((t, i))
        return [(t, self.ids[i], edits, max(low, 0)) for (t, i), (edits, low) in best.items()]


def _string(chars: np.ndarray) -> str:
    return chars.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


def _expanded(lo: np.ndarray, count: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of the hits and their index entries, all pairs of one hit together, about HITS pairs at a time."""
    ends = np.cumsum(count)
    first = 0
    while first < len(count):
        last = max(int(np.searchsorted(ends, (ends[first - 1] if first else 0) + HITS, "right")), first + 1)
        some = count[first:last]
        before = np.cumsum(some) - some
        yield (np.repeat(np.arange(first, last), some),
               np.repeat(lo[first:last] - before, some) + np.arange(int(some.sum())))
        first = last


def _summed(parts: Iterator[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of all parts, ascending, and how often they occur; holds distinct keys and one part."""
    keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def merge() -> tuple[np.ndarray, np.ndarray]:
        every = np.concatenate([keys, *(k for k, _ in waiting)])
        distinct, place = np.unique(every, return_inverse=True)
        weight = np.concatenate([counts, *(c for _, c in waiting)])
        return distinct, np.bincount(place, weight, len(distinct)).astype(np.int64)

    for part in parts:
        own = np.unique(part, return_counts=True)
        waiting.append(own)
        size += len(own[0])
        if size > max(len(keys), 8 * HITS):
            keys, counts = merge()
            waiting, size = [], 0
    return merge() if waiting else (keys, counts)


def gram_hashes(chars: np.ndarray) -> np.ndarray:
    if len(chars) < GRAM:
        return np.empty(0, np.uint64)
    at = np.arange(len(chars) - GRAM + 1)
    return slices(running(mix(chars.astype(np.uint64) + np.uint64(1))), at, at + GRAM)


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in blocks of about BLOCK_CHARS characters, one at a time on the driver."""
    rows = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select("item_id", "text")
    total = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = max(1, -(-total // BLOCK_CHARS))
    for i in range(n):
        yield [tuple(r) for r in rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).collect()]


def leaks(docs: DataFrame, benchmark: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(rid, doc_id, item_id, edits, start): documents that hold a benchmark item or a long passage of one.

    Texts and items are normalised to lower-case letters and digits. A document holds an item if some
    part of it is at most ``edit_budget`` edits away (0.08 edits per character) from the item, or from one
    of its segments of ``segment`` characters, one at every STEP: a passage copied word for word
    is found from ``segment + STEP - 1`` characters on. An item of up to ``segment`` characters is found
    whole only. ``edits`` and ``start`` are those of the whole item where it is held, else of the best segment. By the q-gram
    lemma such a part shares at least ``shared_grams`` grams with the item, on diagonals no more
    than the budget apart, so only items and bands of diagonals with that many hits are
    aligned. The benchmark is a stated query set: it passes over the documents in blocks of bounded
    size, whatever its own size. ``rid`` is the key of ``tables.row_key``.

    Items shorter than a gram are held where they are a line of their own. What is found in a text depends on that
    text alone, not on those processed with it.

    Defined cases: items with null text or id, or without letters and digits, match nothing; a null text
    holds nothing; repeated rows of documents are all reported, repeated items count once; other columns
    are ignored; with either table empty there are no rows.
    """
    schema = "rid bigint, doc_id bigint, item_id bigint, edits int, start int"
    texts = keyed(docs)
    found = None
    for rows in _blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(GramIndex.build(rows, segment))

        def search(batches, shared=shared):
            for batch in batches:
                for piece in pieces(batch):
                    hits = shared.value.matches(text_of(piece).to_pylist())
                    row = pa.array([h[0] for h in hits], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [piece.column(0).take(row), piece.column(1).take(row), pa.array([h[1] for h in hits], pa.int64()),
                         pa.array([h[2] for h in hits], pa.int32()), pa.array([h[3] for h in hits], pa.int32())],
                        names=["rid", "doc_id", "item_id", "edits", "start"])

        block = texts.mapInArrow(search, schema)
        found = block if found is None else found.unionByName(block)
    return found


def judged(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, contaminated, item_ids, edits) of every document.

    ``item_ids`` are the items that it holds, or long passages of, ascending; ``edits`` is the least distance, null without any.
    """
    held = leaks(docs, benchmark).groupBy("rid").agg(
        F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.min("edits").alias("edits"))
    rows = keyed(docs).select("rid", "doc_id").join(held, "rid", "left")
    return rows.select("doc_id", F.col("item_ids").isNotNull().alias("contaminated"),
                       F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"), "edits")
