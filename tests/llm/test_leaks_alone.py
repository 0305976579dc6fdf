"""Leaks do not depend on the texts around them; periodic texts stay within bounds."""

import random
import resource

import numpy as np
import pytest

from lexispark.llm import decontaminate
from lexispark.llm.decontaminate import GramIndex


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))


def test_a_passage_of_a_long_item_is_found_alone():
    rng = random.Random(5)
    item = words(rng, 1000)
    index = GramIndex.build([(1, item), (2, words(rng, 40))])
    parts = [item[a:a + 320] for a in (0, 600, 2000, 4000, len(item) - 320)]
    clean = [words(rng, 50), "", "x", item[100:220]]
    alone = [[m[1:] for m in index.matches([t])] for t in parts + clean]
    assert all(m and m[0][0] == 1 for m in alone[:5]) and not any(alone[5:])
    together = index.matches(parts + clean + [words(rng, 4000)])
    assert [(t, i, e) for t, i, e, _ in together] == [(k, i, e) for k, found in enumerate(alone) for i, e, _ in found]


def test_any_partitioning_finds_the_same(spark):
    rng = random.Random(6)
    items = [(i, words(rng, rng.choice([12, 60, 400]))) for i in range(20)]
    docs = [(d, words(rng, 30) + " " + items[d % 20][1][:rng.choice([90, 300, 3000])] + " " + words(rng, rng.randint(0, 60)))
            for d in range(60)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    results = []
    try:
        for parts, batch in ((1, 1000), (7, 1), (3, 4)):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
            found = decontaminate.leaks(df.repartition(parts), bench).select("doc_id", "item_id", "edits").collect()
            results.append(sorted(map(tuple, found)))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert results[0] == results[1] == results[2] and len(results[0]) > 20


def test_repeated_characters_stay_in_bounds():
    index = GramIndex.build([(1, "a" * 1000), (2, "ab" * 300), (3, "x" * 400 + "y" * 400)])
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    got = index.matches(["a" * 20_000, "b" * 3000, "ab" * 2000, "x" * 3000])
    assert (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024 < 300
    assert {(t, i) for t, i, *_ in got} == {(0, 1), (2, 2), (3, 3)}


def test_items_shorter_than_a_gram_are_searched():
    index = GramIndex.build([(1, "Why not?"), (2, "語言模"), (3, "??"), (4, "why not"), (5, "a longer item of text")])
    got = index.matches(["so\n  why, NOT\nhere", "whynot", "so why not here", "語言模", "why not?", "", "one\n語言模\n"])
    assert got == [(0, 1, 0, 3), (0, 4, 0, 3), (3, 2, 0, 0), (4, 1, 0, 0), (4, 4, 0, 0), (6, 2, 0, 4)]


@pytest.mark.parametrize("size", [1, 7, 50_000])
def test_slices_cover_all_pairs(monkeypatch, size):
    monkeypatch.setattr(decontaminate, "HITS", size)
    lo, count = np.array([5, 0, 9, 2]), np.array([3, 1, 40, 2])
    got = [(int(h), int(e)) for own, entry in decontaminate._expanded(lo, count) for h, e in zip(own, entry)]
    assert got == [(h, e) for h in range(4) for e in range(lo[h], lo[h] + count[h])]
    keys, counts = decontaminate._summed(entry % 7 for _, entry in decontaminate._expanded(lo, count))
    assert dict(zip(keys.tolist(), counts.tolist())) == {k: sum(e % 7 == k for _, e in got) for k in range(7)}
