from hashlib import sha256

import numpy as np
import pytest

from lexispark.llm import vector_codes
from lexispark.llm.vector_codes import Slices, squared, whole_root

SCHEMA = "vec_id bigint, embedding array<double>, label int, sorted string"


def brute(rows, entries=16, rounds=6, parts=8):
    """(vec_id, code, error), and the codebooks, by comparing every part with every entry."""
    kept = sorted(((i, [int(np.floor(4096 * c)) for c in v], label) for i, v, label, _ in rows
                   if v is not None and all(c is not None and np.isfinite(c) for c in v)),
                  key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = [[tuple(v[p * width:(p + 1) * width]) for _, v, _ in kept] for p in range(parts)]
    books = [[list(c) for c in column[:entries]] for column in cut]

    def best(book, point):
        return min((sum((a - b) ** 2 for a, b in zip(point, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for book, column in zip(books, cut):
            own = [best(book, point)[1] for point in column]
            for k in range(len(book)):
                members = [point for point, o in zip(column, own) if o == k]
                if members:
                    book[k] = [sum(x) // len(members) for x in zip(*members)]
    out = []
    for n, (i, _, label) in enumerate(kept):
        found = [best(book, column[n]) for book, column in zip(books, cut)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    return out, sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()


def test_codes_equal_brute_force(spark):
    """Ties, repeated rows, null ids, unusable vectors and a column whose name clashes."""
    draw = np.random.default_rng(3)
    rows = [(i, [float(c) for c in np.round(draw.normal(size=16) * 2) / 4096], i % 3, "x") for i in range(120)]
    rows += [rows[5], rows[5], (None, rows[7][1], None, None), (200, None, 1, None), (201, [None] * 16, 1, None),
             (202, [float("nan")] * 16, 1, None), (203, [float("inf")] + [0.0] * 15, 1, None), (204, [0.0] * 16, None, None)]
    codes, books = vector_codes.encoded(spark.createDataFrame(rows, SCHEMA).repartition(5))
    got = [(r["vec_id"], r["code"], r["error"]) for r in
           codes.select("vec_id", vector_codes.hex_code(codes["entry_ids"]).alias("code"), "error").collect()]
    want, digest = brute(rows)
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(got, key=order) == sorted(want, key=order)
    assert vector_codes.digest(books) == digest


def test_label_errors(spark, monkeypatch):
    """Null labels are one group; too many labels for a broadcast give the same sums."""
    draw = np.random.default_rng(4)
    rows = [(i, draw.normal(size=8).tolist(), None if i % 4 == 0 else i % 4, "x") for i in range(60)]
    codes, _ = vector_codes.encoded(spark.createDataFrame(rows, SCHEMA), entries=4, rounds=2)
    want = {}
    for r in codes.collect():
        want[r["label"]] = want.get(r["label"], 0) + r["error"]
    for bound in (True, False):
        monkeypatch.setattr(vector_codes, "small_enough", lambda df, bound=bound: bound)
        got = vector_codes.with_group_error(codes).collect()
        assert len(got) == 60 and all(r["label_error"] == want[r["label"]] for r in got)


def test_few_empty_and_uneven_vectors(spark):
    empty, books = vector_codes.encoded(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and books.size == 0
    few, books = vector_codes.encoded(spark.createDataFrame([(1, [1.0] * 8, 1, ""), (2, [0.5] * 3, 1, "")], SCHEMA))
    assert [r["error"] for r in few.collect()] == [0, 0] and books.shape == (8, 2, 1)
    nothing, _ = vector_codes.encoded(spark.createDataFrame([(1, [], 1, ""), (2, [], 1, "")], SCHEMA))
    assert [r["entry_ids"] for r in nothing.collect()] == [[0] * 8] * 2
    with pytest.raises(ValueError, match="too large"):
        vector_codes.encoded(spark.createDataFrame([(1, [1e9] * 8, 1, "")], SCHEMA))


def test_masks_hold_exactly_the_box():
    draw = np.random.default_rng(5)
    for n in (1, 3, 64, 70, 130):
        entries, points = draw.integers(-9, 9, (n, 4)), draw.integers(-12, 12, (50, 4))
        cut, radius = Slices.of(entries), draw.integers(0, 9, 50)
        mask = cut.candidates(points, radius)
        inside = (np.abs(points[:, None, :] - entries[None]) <= radius[:, None, None]).all(2)
        held = np.array([[bool(int(m[e // 64]) >> (e % 64) & 1) for e in range(n)] for m in mask])
        assert (held == inside).all()
        best, least = cut.nearest(points)
        distance = np.stack([squared(points, e) for e in entries], axis=1)
        assert (best == distance.argmin(1)).all() and (least == distance.min(1)).all()


def test_whole_roots():
    near = np.array([k * k + d for k in (0, 1, 2, 94_906_267, 2_000_000_011) for d in (-1, 0, 1) if k * k + d >= 0])
    assert [int(r) for r in whole_root(near)] == [int(np.floor(np.sqrt(np.longdouble(v)))) for v in near.tolist()]
