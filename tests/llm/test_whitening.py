import math

import numpy as np
import pytest

from layercake.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, z string, a int, id string, v int"


def make(spark, rows):
    return spark.createDataFrame([(i, v, "z", 1, "i", None) for i, v in rows], SCHEMA)


def brute(rows):
    """(ids, exact integers) of the usable rows and their deviations."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * c) + 100000 for c in v] for _, v in kept]
    n, sums = len(x), [sum(col) for col in zip(*x)]
    return [i for i, _ in kept], x, n, sums, [sum((n * e - s) ** 2 for e, s in zip(row, sums)) for row in x]


def check(spark, rows, components=8):
    ids, x, n, sums, deviations = brute(rows)
    frame, model = whitening.whiten(make(spark, rows))
    out = whitening.by_component(frame, model).collect()
    assert sorted(map(repr, ids * min(components, len(x[0])))) == sorted(repr(r["vec_id"]) for r in out)
    assert all(r["n"] == n for r in out)
    assert sorted((repr(i), d) for i, d in zip(ids, deviations)) == sorted(
        (repr(r["vec_id"]), r["deviation"]) for r in out if r["component"] == 1
    )
    assert model["sums"] == sums and model["n"] == n
    return out, model, np.array(x, float), n


def test_equals_numpy(spark):
    rng = np.random.default_rng(1)
    data = rng.normal(size=(3000, 12)) @ rng.normal(size=(12, 12)) / 8
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(data)]
    rows += [(9000, None), (9001, [math.nan, *[0.0] * 11]), (9002, [math.inf, *[0.0] * 11]), (9003, [None, *[0.0] * 11])]
    out, model, x, n = check(spark, rows)
    centred = x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    expected = centred @ vectors / np.sqrt(values)
    for k in range(8):
        own = np.array([r["whitened"] for r in sorted(out, key=lambda r: r["vec_id"]) if r["component"] == k + 1])
        sign = np.sign(own @ expected[:, k])
        assert np.allclose(own, sign * expected[:, k], atol=1e-8)
    for r in out:
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / values.sum(), rel=1e-9)
        assert r["identity_error"] < 1e-9


def test_exact_products():
    """Bit planes give the products of integers, of any sign and of many places."""
    rng = np.random.default_rng(2)
    for low, high, shape in ((0, 2, (200, 5)), (-(1 << 48), 1 << 48, (130, 3)), (-5, 900, (64, 9)), (7, 8, (3, 2))):
        x = rng.integers(low, high, shape)
        full = np.hstack([x, np.ones((len(x), 1), np.int64)]).astype(object)
        assert (whitening.scatter(x) == full.T.dot(full)).all()


def test_values_far_apart(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(a), float(a * 300 + b), float(b)]) for i, (a, b) in enumerate(rng.normal(size=(300, 2)))]
    out, model, x, n = check(spark, rows, 3)
    assert max(r["identity_error"] for r in out) < 1e-4


def test_odd_rows(spark):
    same = [(1, [0.5, 0.25])] * 4 + [(None, [0.5, 0.25]), (2, [1.0, -3.0])]
    out, _, _, _ = check(spark, same, 2)
    # One direction has no variance: it has no value, and the other is exact.
    assert {r["component"]: r["whitened"] is None for r in out} == {1: False, 2: True}
    assert all(r["identity_error"] < 1e-9 for r in out)
    out, model, _, _ = check(spark, [(1, [0.5, 0.25])], 2)
    assert [r["whitened"] for r in out] == [None, None] and model["error"] is None
    for rows in ([], [(1, None)], [(1, [])], [(1, [math.nan])]):
        frame, model = whitening.whiten(make(spark, rows))
        assert model is None and whitening.by_component(frame, model).collect() == []
    # Vectors of another length than most are left out; of equally many the longer ones stay.
    frame, model = whitening.whiten(make(spark, [(1, [1.0]), (2, [1.0, 2.0]), (3, [2.0, 1.0]), (4, [5.0])]))
    assert sorted(r["vec_id"] for r in frame.collect()) == [2, 3] and model["dimension"] == 2


def test_deviation_beyond_64_bits(spark):
    rows = [(1, [1e9, 0.0]), (2, [-1e9, 1.0]), (3, [0.0, 2.0])]
    frame, model = whitening.whiten(make(spark, rows))
    _, _, _, _, deviations = brute(rows)
    expected = [d if d < 1 << 63 else None for d in deviations]
    assert [r["deviation"] for r in sorted(frame.collect(), key=lambda r: r["vec_id"])] == expected
    assert None in expected and any(expected)
    # Entries without a place among the integers are cut to the ends.
    frame, model = whitening.whiten(make(spark, [(1, [1e300, 0.0]), (2, [-1e300, 1.0])]))
    assert frame.count() == 2 and model["sums"][0] == 2 * whitening.SHIFT
