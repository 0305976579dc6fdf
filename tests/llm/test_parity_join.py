"""Parity-sketch join against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest

from lexispark.llm import parity_join
from lexispark.llm.parity_join import sketch_words, similar_documents

SCHEMA = "doc_id bigint, text string, a bigint, word int, first string"


def shingles(text, size=5):
    words = (text or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")).split()
    if not words:
        return set()
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))}


def brute(rows, percent=80):
    sets = [(d, shingles(t)) for d, t, *_ in rows]
    root = {d: d for d, _ in sets if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, (d, s) in enumerate(sets):
        for e, t in sets[:i]:
            if d is not None and e is not None and s and 100 * len(s & t) >= percent * len(s | t):
                a, b = sorted((find(d), find(e)))
                root[b] = a
    return sorted(((d, len(s), None if d is None else find(d)) for d, s in sets), key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    shared = [rng.choice(vocabulary) for _ in range(40)]
    texts = []
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 5, 6, 9, 12, 30, 60, 130, 400]))]
        if rng.random() < .5:
            base += shared
        for _ in range(rng.randint(1, 7)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                at = rng.randrange(len(copy))
                copy[at:at + 1] = rng.choice([[], [rng.choice(vocabulary)], [copy[at], "new"]])
            texts.append(rng.choice([" ", "\n"]).join(copy).upper() if rng.random() < .2 else " ".join(copy))
    texts += [None, "", " \t", "one", "ONE", "one two"]
    ids = rng.sample(range(-50, 2000), len(texts))
    rows = [(d, t, 1, 2, "x") for d, t in zip(ids, texts)]
    rng.shuffle(rows)
    return rows + [rows[0], rows[1], (None, texts[0], None, None, None), (None, texts[0], None, None, None)]


@pytest.mark.parametrize("seed, block", [(1, 256), (2, 2)])
def test_components(spark, monkeypatch, seed, block):
    monkeypatch.setattr(parity_join, "BLOCK_DOCS", block)
    rows = corpus(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = sorted(map(tuple, similar_documents(df).collect()), key=str)
    assert got == brute(rows)


def test_almost_linked_groups(spark, monkeypatch):
    """Two large groups around texts that share just under the limit, and a few documents between them."""
    monkeypatch.setattr(parity_join, "BLOCK_DOCS", 16)
    monkeypatch.setattr(parity_join, "COMPARED", 100)
    monkeypatch.setattr(parity_join, "BRIEF_BYTES", 32)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(300)]
    other = base[:262] + [f"v{i}" for i in range(38)]
    rows = []
    for text in (base, other):
        for _ in range(80):
            copy = list(text)
            for _ in range(3):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10 ** 6)}"
            rows.append(" ".join(copy))
    rows = [(i, t, 1, 2, "x") for i, t in enumerate(rows)]
    got = sorted(map(tuple, similar_documents(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()), key=str)
    assert got == brute(rows)


def test_blocks_across_batches():
    """Groups that end inside of a batch, at its end, or fill several batches."""
    keys = [1] * 5 + [2] * 3 + [3] * 9 + [4] + [5] * 2
    table = pa.table({"word": keys, "low": [0] * 20, "high": [0] * 20, "row": list(range(20))})
    for size in range(1, 21):
        got = list(parity_join._groups(iter(table.to_batches(max_chunksize=size))))
        assert [r for t in got for r in t.column("row").to_pylist()] == list(range(20))
        words = [w for t in got for w in set(t.column("word").to_pylist())]
        assert sorted(words) == [1, 2, 3, 4, 5]


def test_empty(spark):
    assert similar_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sketch_guarantee():
    rng = np.random.default_rng(5)
    for n in [1, 2, 3, 4, 5, 6, 7, 9, 15, 16, 31, 33, 60, 120, 500]:
        for _ in range(60):
            a = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
            drop, add = rng.integers(0, n // 5 + 2), rng.integers(0, n // 4 + 2)
            b = np.concatenate([a[drop:], rng.integers(0, 1 << 63, add, dtype=np.uint64) * np.uint64(2)])
            a, b = np.unique(a), np.unique(b)
            both = len(np.intersect1d(a, b))
            if len(b) and 100 * both >= 80 * (len(a) + len(b) - both):
                (x, need_a), (y, need_b) = sketch_words(a, 80), sketch_words(b, 80)
                same = len(np.intersect1d(x, y))
                assert same >= max(need_a, need_b) >= 1, (n, len(a), len(b))


@pytest.mark.parametrize("size", [1, 4, 7, 9, 20, 63, 64, 102, 128, 250, 1000, 1020])
def test_head_words_and_bit_sketches(size):
    rng = np.random.default_rng(size)
    for other in sorted({size, size * 9 // 10, size * 100 // 81}):
        for _ in range(20):
            both = -(-80 * (size + other) // 180)  # the smallest intersection of a link
            tokens = rng.integers(0, 1 << 64, size + other, dtype=np.uint64)
            if both > min(size, other):
                continue
            a, b = np.unique(tokens[:size]), np.unique(tokens[size - both:size - both + other])
            assert set(parity_join.head_words(a, 80).tolist()) & set(parity_join.head_words(b, 80).tolist())
            x, y = parity_join.bit_sketch(a), parity_join.bit_sketch(b)
            assert parity_join.least_difference(x, y) == parity_join.least_difference(y, x) <= len(np.setxor1d(a, b))
    assert len(parity_join.head_words(np.empty(0, np.uint64), 80)) == 0
    assert parity_join.least_difference(parity_join.bit_sketch(a), parity_join.bit_sketch(a)) == 0


def test_repeated_words_move_once(spark):
    """Which words several documents have is found without a join: the rows are exchanged once."""
    rows = [(1, 7), (2, 7), (1, 8), (1, 8), (3, 9), (4, 9), (5, 9), (6, 5)]
    found = parity_join._repeated(spark.createDataFrame(rows, "doc_id bigint, word bigint"))
    assert sorted((r.doc_id, r.word) for r in found.collect()) == [(1, 7), (2, 7), (3, 9), (4, 9), (5, 9)]
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan


def test_head_words_are_full_words():
    """Sets that share half of their tokens, too few for a link, share fewer heads than any choice by chance would."""
    rng = np.random.default_rng(3)
    heads = words = share = 0
    for size in range(140, 250, 2):
        tokens = rng.integers(0, 1 << 63, 3 * size // 2, dtype=np.uint64) * np.uint64(2)
        a, b = np.unique(tokens[:size]), np.unique(tokens[size // 2:])
        heads += len(np.intersect1d(parity_join.head_words(a, 80), parity_join.head_words(b, 80)))
        words += len(np.intersect1d(sketch_words(a, 80)[0], sketch_words(b, 80)[0]))
        share += len(parity_join.head_words(a, 80)) / len(sketch_words(a, 80)[0])
    assert heads < 0.6 * words * share / 55
