"""Small fixtures: nulls, empty and long texts, ties, repeated rows, clashing columns, empty tables."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexispark.llm import decontaminate, hamming_index, language_id, licenses, mixing, quality, url_filter
from lexispark.llm.queries import RULES

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, rid string, score string, word int"


def docs(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 3) for r in rows], DOCS)


def texts(rng, letters, n):
    return [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(rng.randint(5, 60))) for _ in range(n)]


def test_language(spark):
    rng = random.Random(3)
    rows = [(i, t, lang, "s", 1) for lang, letters in (("aa", "abcde"), ("bb", "cdefgh"), ("cc", "жзийк"))
            for i, t in enumerate(texts(rng, letters, 40))]
    rows += [(900, None, "aa", None, None), (None, "", None, None, None), (901, "12 34 ..", "bb", "s", 0), (902, "ab" * 200_000, None, "s", 1)]
    df = docs(spark, rows + rows[:2])
    model = language_id.fit(df.where(F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 != 0, F.lit(False))))
    got = df.select("doc_id", "text", "lang", language_id.language(F.col("text"), model).alias("p")).collect()
    assert len(got) == len(rows) + 2
    held = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 900 and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert np.mean([r["p"]["lang"] == r["lang"] for r in held]) > 0.9
    assert {r["p"]["lang"] for r in got if r["text"] in (None, "", "12 34 ..")} == {"und"}
    assert all(0 <= r["p"]["score"] <= 1 for r in got)
    nothing = language_id.fit(df.where("false"))
    assert {r[0]["lang"] for r in df.select(language_id.language(F.col("text"), nothing)).collect()} == {"und"}


def test_quality(spark):
    rng = random.Random(4)
    good = [(i, t + ".", "aa", "s", 1) for i, t in enumerate(texts(rng, "abcdefgh", 80))]
    bad = [(i + 100, t.upper().replace(" ", "## "), "aa", "s", 1) for i, t in enumerate(texts(rng, "abcdefgh", 60))]
    df = docs(spark, good + bad + [(500, None, None, None, None), (501, "", None, None, None), (None, "x", None, None, None), good[0]])
    labels = spark.createDataFrame([(d, int(d < 100), None) for d, *_ in good + bad] + [(None, 1, 0), (3, None, 0), (777, 1, 1)],
                                   "doc_id bigint, quality int, toxic int")
    train = F.crc32(F.col("doc_id").cast("string")) % 5 != 0
    model = quality.fit(df.where(train), labels.where(train))
    got = quality.scored(df, model).collect()
    assert len(got) == len(good) + len(bad) + 4
    held = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 500 and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert np.mean([(r["score"] >= 0.3) == (r["doc_id"] < 100) for r in held]) > 0.9
    assert all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in quality.scored(df, quality.fit(df, labels.where("false"))).collect()} == {0.5}


def test_urls(spark):
    rows = [(1, "http://A.Example.com/en/x?adult", "block", "example.com/en/"), (2, "https://www.example.com/en/", "allow", "www.example.com/en/"),
            (3, "http://x.net/es/1", "block", "net/es/"), (4, "http://net/fr/", "block", "net/fr/"), (5, "http://x.com?casino", "block", None),
            (6, "http://x.com/casino", "allow", "com/"), (7, "http://free-bets.org/", "block", None), (8, "http://free.org/free", "allow", None),
            (9, None, "allow", None), (10, "casino", "block", None), (11, "http://casinos.org", "allow", None), (None, "", "allow", None),
            (12, "a://b://CASINO", "block", None), (1, "http://A.Example.com/en/x?adult", "block", "example.com/en/")]
    df = spark.createDataFrame([(p, u, "h", "r") for p, u, *_ in rows], "page_id bigint, url string, host string, rule string")
    got = sorted((tuple(r) for r in url_filter.judged(df, RULES).select("page_id", "verdict", "rule").collect()), key=str)
    assert got == sorted(((p, v, r) for p, _, v, r in rows), key=str)


def test_licenses(spark):
    rows = [(1, "Text. Released under the MIT License.\nAll rights reserved."), (2, None), (3, ""), (None, "licensed under cc by-nc 4.0"),
            (4, "Permission is hereby granted"), (5, "Licensed under the Apache License, Version 2.0.\nLicensed under CC BY-NC 4.0. x"),
            (6, "x " * 200_000 + "\nAll rights reserved.")]
    df = docs(spark, [(d, t, None, None, None) for d, t in rows])
    got = sorted(((r["doc_id"], r["licenses"], r["category"]) for r in licenses.scanned(df).collect()), key=str)
    assert got == sorted([(1, "MIT,Proprietary", "reserved"), (2, "", "none"), (3, "", "none"), (None, "CC-BY-NC-4.0", "noncommercial"),
                          (4, "", "none"), (5, "Apache-2.0,CC-BY-NC-4.0", "noncommercial"), (6, "Proprietary", "reserved")], key=str)


MIT = """MIT License

Copyright (c) 2020 A Person

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY."""
BSD2 = """Copyright (c) 2020, A Person

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = BSD2 + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
"""
GPL3 = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.
"""
GPL2 = GPL3.replace("Foundation, either version 3", "Foundation; either version 2").replace("software: you", "software; you")


def test_wrapped_licenses(spark):
    comment = "\n".join(f" * {line}".rstrip() for line in MIT.split("\n"))
    rows = [("MIT", 4, t) for t in (MIT, MIT.replace("\n", "\r\n"), f"/*\n{comment}\n */\nint main;", f"Some text\n{MIT}\nmore")]
    rows += [("BSD-2-Clause", 3, BSD2), ("BSD-3-Clause", 4, BSD3), ("GPL-3.0-or-later", 3, GPL3), ("GPL-2.0-or-later", 4, GPL2),
             ("GPL-3.0-or-later", 3, " ".join(GPL3.split())), ("MIT,Proprietary", 2, "Copyright A\nAll rights reserved\nReleased under the\nMIT License"),
             ("", 0, "Permission is hereby granted\n\nfree of charge"), ("", 0, "the\n\nreleased under the. mit license x"),
             ("Proprietary", 1, "\x01жж " + "ж" * 300_000 + "." * 300_000 + "x" + "\n" * 300_000 + "All rights\nreserved")]
    got = licenses.scanned(docs(spark, [(i, t, None, None, None) for i, (_, _, t) in enumerate(rows)])).collect()
    assert [(r["licenses"], r["n_sentences"]) for r in sorted(got, key=lambda r: r["doc_id"])] == [(n, k) for n, k, _ in rows]


def test_mixing(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * rng.randint(0, 40)), None, rng.choice(["b", "a", "a", "a", "c", None, "é"]), 1) for i in range(600)]
    rows += [(None, "a b", None, "a", 0), (5, None, None, "z", 0), rows[0]]
    first = mixing.mixed(docs(spark, rows)).collect()
    size, target, taken = {}, {}, {}
    for r in first:
        size[r["source"]] = size.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"] + r["part_words"]
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    free, rest, want = set(order), 1.5 * sum(size.values()), {}
    while True:
        level = rest / sum(weights[s] for s in free)
        full = {s for s in free if level * weights[s] > 2 * size[s]}
        if not full:
            break
        for s in full:
            want[s] = 2.0 * size[s]
            rest -= want[s]
        free -= full
    want |= {s: level * weights[s] for s in free}
    assert target == pytest.approx(want)
    assert all(abs(taken[s] - want[s]) <= 0.03 * want[s] + 10 for s in order)
    assert all(abs(taken[s] - want[s]) <= 1 for s in order)
    assert sum(r["part_words"] > 0 for r in first) <= 2 * len(order)  # all others are taken by whole copies
    again = mixing.mixed(docs(spark, rows[::-1]).repartition(3)).collect()
    assert sorted((str(r["doc_id"]), r["taken"]) for r in first) == sorted((str(r["doc_id"]), r["taken"]) for r in again)
    assert mixing.mixed(docs(spark, [])).count() == 0


def test_neighbours(spark):
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(700, 24)).astype(np.float32)
    vectors[300:304] = vectors[50]
    rows = [(i, [float(x) for x in v], 1, 2) for i, v in enumerate(vectors)]
    rows += [(50, rows[50][1], 1, 2), (800, None, 1, 2), (850, [0.0] * 24, 1, 2), (None, rows[3][1], 1, 2), (900, [1.0] * 5, 1, 2),
             (901, [None] + [1.0] * 23, 1, 2), (902, [float("nan")] + [1.0] * 23, 1, 2)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, row int, shard int")
    got = {}
    for r in hamming_index.nearest(df, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    ids = [*range(700), 50]
    data = np.vstack([vectors, vectors[50:51]]).astype(float)
    data /= np.linalg.norm(data, axis=1, keepdims=True)
    hit = total = 0
    for q in range(0, 700, 50):
        score = data @ data[q]
        best = sorted((-round(float(s), 9), ids[i]) for i, s in enumerate(score) if i != q)[:5]
        if q != 50:
            assert len(got[q]) == 5 and sorted(r for r, *_ in got[q]) == [1, 2, 3, 4, 5]
            hit += len({v for _, v, _ in got[q]} & {v for _, v in best})
            total += 5
    assert hit / total >= 0.9
    assert sorted(v for r, v, _ in got[50]) == sorted([50, 300, 301, 302, 303] * 2)
    assert hamming_index.nearest(df.where("false"), F.col("vec_id") % 50 == 0).count() == 0


def test_leaks(spark):
    rng = random.Random(7)
    items = [(i, t) for i, t in enumerate(texts(rng, "abcdefghij", 12)) if len(t) > 60]
    rows = []
    for d in range(60):
        body = texts(rng, "abcdefghij", 1)[0]
        i, item = rng.choice(items)
        kind = d % 4
        if kind == 1:
            body = body + "\n" + item.upper().replace(" ", ", ") + " " + body
        if kind == 2:
            edited = list(item)
            for at in rng.sample(range(len(edited)), len(edited) // 30):
                edited[at] = "z"
            body = "".join(edited) + " " + body
        if kind == 3:
            body = item[:len(item) // 2] + " " + body
        rows.append(((d, body, None, None, None), i if kind in (1, 2) else None))
    df = docs(spark, [r for r, _ in rows] + [(None, None, None, None, None), (99, "", None, None, None), rows[1][0]])
    benchmark = spark.createDataFrame(items + [items[0], (None, items[1][1]), (77, None), (78, ""), (79, "ab")], "item_id bigint, text string")
    got = decontaminate.judged(df, benchmark).collect()
    assert len(got) == 63
    for r in got:
        want = rows[r["doc_id"]][1] if r["doc_id"] is not None and r["doc_id"] < 60 else None
        assert r["item_ids"] == ([] if want is None else [want]) and r["contaminated"] == (want is not None)
    assert decontaminate.leaks(df, benchmark.where("false")).count() == 0


def test_partial_leaks(spark):
    rng = random.Random(9)
    words = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))
    item, short = words(67), words(20)
    edited = list(item[:330])
    for at in range(7, 330, 30):
        edited[at] = "z"
    rows = [(0, words(40) + " " + item[:350] + " " + words(50)), (1, words(300) + " " + item[:230]), (2, item[170:] + " " + words(9)),
            (3, words(9) + " " + item[61:290] + " " + words(9)), (4, "".join(edited) + " " + words(9)), (5, item), (6, words(400)),
            (7, item[:100] + " " + words(90) + " " + item[300:]), (8, item[37:162])]
    df = docs(spark, [(i, t, None, None, None) for i, t in rows])
    benchmark = spark.createDataFrame([(1, item), (2, short)], "item_id bigint, text string")
    found = {r["doc_id"]: r["edits"] for r in decontaminate.leaks(df, benchmark).collect()}
    assert found.keys() == {0, 1, 2, 3, 4, 5} and all(found[i] == 0 for i in (0, 1, 2, 3, 5))
    assert {r["doc_id"] for r in decontaminate.leaks(df, benchmark, 100).collect()} == {0, 1, 2, 3, 4, 5, 7, 8}


def test_alignment_against_full_table():
    rng = random.Random(8)
    for _ in range(60):
        item = [rng.randint(97, 100) for _ in range(20)]
        text = [rng.randint(97, 100) for _ in range(rng.randint(5, 50))] + item[:rng.randint(0, 20)]
        row = [0] * (len(text) + 1)
        for i, c in enumerate(item, 1):
            new = [i]
            for j, t in enumerate(text, 1):
                new.append(min(row[j - 1] + (c != t), row[j] + 1, new[j - 1] + 1))
            row = new
        full = decontaminate.fitting_distance(np.array(item, np.uint32), np.array(text, np.uint32), -25, len(text) + 5)
        assert full == min(row)


def test_language_of_signs_that_are_no_letters(spark):
    """Fractions, circled and Roman numeral signs are no letters; a repeated row is one training text."""
    rng = random.Random(8)
    rows = [(i, t, lang, "s", 1) for lang, letters in (("aa", "abcde"), ("bb", "fghij")) for i, t in enumerate(texts(rng, letters, 12))]
    df = docs(spark, rows)
    model = language_id.fit(df, per_language=8, landmarks=4)
    signs = docs(spark, [(i, t, None, "s", 1) for i, t in enumerate(["½ ²", "①", "Ⅷ", "12 _", "a½"])])
    got = {r["doc_id"]: r["p"]["lang"] for r in signs.select("doc_id", language_id.language(F.col("text"), model).alias("p")).collect()}
    assert [got[i] for i in range(4)] == ["und"] * 4 and got[4] != "und"
    again = language_id.fit(docs(spark, rows + rows + [(None, rows[0][1], "aa", None, None)] * 3), per_language=50, landmarks=4)
    once = language_id.fit(docs(spark, rows + [(None, rows[0][1], "aa", None, None)]), per_language=50, landmarks=4)
    assert again.languages == once.languages and np.array_equal(again.weights, once.weights)


def test_pipeline_stage_without_labels_keeps_documents(spark):
    import corpus_pipeline

    df = docs(spark, [(1, "some words", None, "s", 1), (2, "123", None, "s", 1), (3, None, None, "s", 1)])
    assert [r["doc_id"] for r in corpus_pipeline.identify(spark, df, "").collect()] == [1]
