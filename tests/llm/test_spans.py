"""Suffix-array and substring dedup against brute force."""

import hashlib
import random
import tracemalloc

import numpy as np
import pytest

from lexispark.llm import segments, substring_dedup, suffix_arrays, suffix_dedup

SCHEMA = "doc_id bigint, text string, rid string, lo int, spans string"


def corpus(seed, words=("aa", "b", "cé", "dd", "e\x0bf", " g")):
    rng = random.Random(seed)
    passage = [" ".join(rng.choice(words) for _ in range(n)) for n in (40, 70, 25)]
    texts = []
    for i in range(60):
        parts = [" ".join(rng.choice(words) + str(rng.randint(0, 400)) for _ in range(rng.randint(0, 60)))]
        for p in rng.sample(passage, rng.randint(0, 2)):
            at = rng.randint(0, 6)
            parts += [p[at:] if rng.random() < .5 else p, str(rng.random())]
        texts.append("\n".join(parts))
    texts += [texts[3], texts[4] + " tail", "ab" * 300, "", None, " \t ", "ababab" * 40]
    rows = [(i * 3 - 20, t, "x", 1, "y") for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows + [rows[0], rows[5], (None, texts[3], "n", None, None), (None, texts[3], "n", None, None)]


def brute_bytes(rows, window):
    data = [(t or "").encode() for _, t, *_ in rows]
    seen = {}
    for d in data:
        for i in range(len(d) - window + 1):
            seen[d[i:i + window]] = seen.get(d[i:i + window], 0) + 1
    out = []
    for (doc, *_), d in zip(rows, data):
        gone = [False] * len(d)
        for i in range(len(d) - window + 1):
            if seen[d[i:i + window]] > 1:
                gone[i:i + window] = [True] * window
        n_spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((doc, len(d), sum(gone), n_spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def brute_words(rows, window):
    data = [(t or "").encode().split() for _, t, *_ in rows]
    first = {}
    for (doc, *_), w in zip(rows, data):
        for i in range(len(w) - window + 1):
            if doc is not None:
                key = tuple(w[i:i + window])
                first[key] = min(first.get(key, doc), doc)
    out = []
    for (doc, *_), w in zip(rows, data):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if doc is not None and first[tuple(w[i:i + window])] < doc:
                gone[i:i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("variants", [4096, 2])
def test_repeated_bytes(spark, monkeypatch, variants):
    monkeypatch.setattr(segments, "ANCHOR_VARIANTS", variants)
    rows = corpus(variants)
    df = spark.createDataFrame(rows, SCHEMA)
    got = suffix_dedup.digest(suffix_dedup.repeated_spans(df, window=50, gram=12)).collect()
    assert sorted(map(tuple, got), key=str) == brute_bytes(rows, 50)


@pytest.mark.parametrize("variants", [4096, 2])
def test_earlier_words(spark, monkeypatch, variants):
    monkeypatch.setattr(segments, "ANCHOR_VARIANTS", variants)
    rows = corpus(variants + 1)
    df = spark.createDataFrame(rows, SCHEMA)
    got = substring_dedup.digest(substring_dedup.earlier_spans(df, window=15, gram=4)).collect()
    assert sorted(map(tuple, got), key=str) == brute_words(rows, 15)


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert suffix_dedup.repeated_spans(df).count() == 0
    assert substring_dedup.earlier_spans(df).count() == 0
    nothing = spark.createDataFrame([(1, None, "", 0, ""), (2, "", "", 0, "")], SCHEMA)
    assert [tuple(r)[1:4] for r in suffix_dedup.digest(suffix_dedup.repeated_spans(nothing)).collect()] == [(0, 0, 0)] * 2


def test_suffix_order_memory():
    rng = np.random.default_rng(1)
    base = [rng.integers(97, 123, 900, dtype=np.uint8).tobytes() for _ in range(150)]
    text = np.frombuffer(b"".join(base[i % 150][i % 97:] for i in range(300)), np.uint8)
    tracemalloc.start()
    order, rank = suffix_arrays.suffix_order(text, 200)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 45 * len(text)  # was 59 bytes for each byte of text
    data = text.tobytes()
    prefix = [data[i:i + 200] for i in order.tolist()]
    assert prefix == sorted(prefix) and sorted(order.tolist()) == list(range(len(data)))
    # nothing is cut off before the last 200 bytes, so ranks agree just where 200 bytes do
    assert all((a == b) == (rank[i] == rank[j]) for a, b, i, j in zip(prefix, prefix[1:], order, order[1:]) if max(i, j) < len(data) - 200)
