import numpy as np
import pytest

from lexispark.llm import whitening
from lexispark.llm.whitening import Inertia, components, feast, intervals, tridiagonal

SCHEMA = "vec_id bigint, embedding array<double>, label int, n string, component double"


def matrix_with(values, seed=1):
    turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))[0]
    made = turn @ np.diag(values) @ turn.T
    return (made + made.T) / 2


def test_inertia_counts():
    values = np.array([9.0, 4.0, 4.0, 1.0, 0.5, 0.0, 0.0])
    inertia = Inertia(matrix_with(values))
    shifts = np.array([10.0, 8.0, 4.1, 3.9, 0.7, 1e-9, -1e-9])
    assert inertia.above(shifts).tolist() == [(values > s).sum() for s in shifts]
    assert np.allclose(inertia.values(7), values, atol=1e-12)
    assert np.allclose(np.linalg.eigvalsh(np.diag(tridiagonal(matrix_with(values))[0])).sum(), values.sum())


@pytest.mark.parametrize("values", [
    np.linspace(5, 1, 40), np.geomspace(1e6, 1e-3, 40), np.r_[[7.0] * 11, np.linspace(3, 1, 20)],
    np.r_[100.0, [1.0] * 30], np.r_[np.linspace(2, 1, 10), np.zeros(20)], [3.0], [2.0, 2.0]])
def test_intervals_hold_every_wanted_value(values):
    matrix = matrix_with(np.asarray(values))
    inertia = Inertia(matrix)
    wanted = min(32, int((np.asarray(values) > 1e-9).sum()))
    found, vectors = [], []
    for low, high, count in intervals(inertia, wanted):
        got, own = feast(matrix, low, high, count, inertia.scale)
        assert len(got) == count
        found.extend(got)
        vectors.append(own)
    want = np.sort(np.linalg.eigvalsh(matrix))[::-1][:len(found)]
    assert len(found) >= wanted and np.allclose(found, want, rtol=0, atol=1e-12 * inertia.scale)
    vectors = np.hstack(vectors)
    assert np.abs(matrix @ vectors - vectors * np.array(found)).max() < 1e-12 * inertia.scale


def brute(rows, wanted=32):
    kept = [(i, v) for i, v, *_ in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v in kept], object)
    n, sums = len(x), x.sum(0)
    gap = n * x - sums
    covariance = (gap.T @ gap / n ** 3).astype(float)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:wanted], vectors[:, ::-1][:, :wanted]
    return kept, n, (gap * gap).sum(1), (gap / n).astype(float) @ vectors / np.sqrt(values), values / np.trace(covariance)


def test_whitened_equals_brute_force(spark):
    """Repeated rows, null ids, unusable vectors and columns whose names clash."""
    draw = np.random.default_rng(7)
    rows = [(i, (draw.normal(size=40) * (0.3 + 0.1 * np.arange(40))).tolist(), 1, "x", 0.5) for i in range(300)]
    rows += [rows[3], (None, rows[9][1], None, None, None), (400, None, 1, "", 0.0), (401, [None] * 40, 1, "", 0.0),
             (402, [float("inf")] * 40, 1, "", 0.0), (403, [float("nan")] * 40, 1, "", 0.0)]
    got = whitening.whitened(spark.createDataFrame(rows, SCHEMA).repartition(6)).collect()
    kept, n, deviation, want, explained = brute(rows)
    assert len(got) == 32 * n
    by_id = {}
    for r in got:
        by_id.setdefault(r["vec_id"], []).append(r)
    sign = {}
    for k, (i, _) in enumerate(kept):
        for r in by_id[i]:
            c = r["component"] - 1
            sign.setdefault(c, np.sign(want[k, c] * r["whitened"]))
            assert abs(sign[c] * r["whitened"] - want[k, c]) < 1e-7
            assert r["n"] == n and r["deviation"] == deviation[k]
            assert abs(r["explained"] / explained[c] - 1) < 1e-9 and r["identity_error"] < 1e-10


def test_few_equal_and_empty_vectors(spark):
    assert whitening.whitened(spark.createDataFrame([], SCHEMA)).count() == 0
    same = [(i, [0.5, 0.25], 1, "", 0.0) for i in range(5)]
    assert whitening.whitened(spark.createDataFrame(same, SCHEMA)).count() == 0
    short = spark.createDataFrame([(1, [1.0, 2.0, 3.0], 1, "", 0.0), (2, [1.0], 1, "", 0.0), (3, [2.0, 2.0], 1, "", 0.0)], SCHEMA)
    got = whitening.whitened(short).collect()
    assert {r["component"] for r in got} == {1, 2} and len(got) == 6 and got[0]["identity_error"] < 1e-9
    with pytest.raises(ValueError, match="too large"):
        whitening.whitened(spark.createDataFrame([(1, [1e9], 1, "", 0.0)], SCHEMA))


def test_components_of_a_cluster(spark):
    matrix = matrix_with(np.r_[5.0, [2.0] * 40, np.linspace(1, 0.5, 9)])
    got = components(spark, matrix)
    assert np.allclose(got.values, [5.0] + [2.0] * 31) and np.allclose(got.vectors.T @ got.vectors, np.eye(32), atol=1e-12)


def test_deviations_beyond_64_bits():
    assert whitening.deviations(np.array([[3, 4], [1, 0]])) == [25, 1]
    assert whitening.deviations(np.array([[1 << 40, 0], [1 << 31, 1]])) == [None, (1 << 62) + 1]
