import numpy as np
import pytest

from tablemover.llm.whitening import whiten

SCHEMA = "id long, embedding array<float>, n string"


def brute(vectors, k, weights="count"):
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors], dtype=object)
    fit = x if weights == "count" else np.array(sorted(set(map(tuple, x.tolist()))), dtype=object)
    n, s = len(fit), fit.sum(axis=0)
    c = ((fit * n - s) / n).astype(float)
    e, v = np.linalg.eigh(c.T @ c / n)
    order = np.argsort(-e)[:k]
    white = ((x * n - s) / n).astype(float) @ v[:, order] / np.sqrt(e[order])
    return n, [int(((row * n - s) ** 2).sum()) for row in x], white, e[order] / e.sum()


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, "clash") for i, v in rows], SCHEMA).repartition(3)
    return sorted(whiten(df, ["id", "n"], **kw).collect(), key=lambda r: (r["id"] is None, r["id"] or 0))


def vectors(n, dims, seed=0):
    rng = np.random.default_rng(seed)
    return [[float(c) for c in v] for v in (rng.standard_normal((n, dims)) @ np.diag(np.arange(1, dims + 1))).astype(np.float32)]


@pytest.mark.parametrize("weights", ["count", "one"])
def test_equals_numpy_with_hot_and_repeated_vectors(spark, weights):
    v = vectors(80, 5)
    rows = list(enumerate(v + [v[3]] * 60 + v[:20]))
    got = run(spark, rows, components=4, weights=weights, hot_share=8)
    n, deviation, white, share = brute([r[1] for r in rows], 4, weights)
    assert [r["id"] for r in got] == list(range(160)) and {r["n_"] for r in got} == {n}
    assert [int(r["deviation"]) for r in got] == deviation
    w = np.array([r["whitened"] for r in got])
    assert np.abs(w * np.sign((w * white).sum(axis=0)) - white).max() < 1e-9
    assert np.allclose(got[0]["explained"], share, rtol=1e-9) and got[0]["identity_error"] < 1e-9


def test_unusable_vectors_null_ids_and_flat_directions(spark):
    good = [[1.0, 2.0, 5.0], [2.0, 0.5, 5.0], [0.0, 1.0, 5.0], [3.0, 3.0, 5.0]]
    rows = [(i, v) for i, v in enumerate(good)] + [(None, good[0]), (7, None), (8, []), (9, [1.0, None, 2.0]),
                                                   (10, [1.0, float("nan"), 2.0]), (11, [1.0, float("inf"), 2.0])]
    got = run(spark, rows)
    assert [r["id"] for r in got] == [0, 1, 2, 3, None]
    assert len(got[0]["whitened"]) == 2 and got[4]["whitened"] == got[0]["whitened"]  # the third dimension doesn't vary


def test_one_vector_none_and_wrong_lengths(spark):
    assert run(spark, []) == [] and run(spark, [(1, None)]) == []
    got = run(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])
    assert [(r["whitened"], r["explained"], int(r["deviation"])) for r in got] == [([], [], 0)] * 2
    with pytest.raises(ValueError, match="components"):
        run(spark, [(1, [1.0]), (2, [1.0, 2.0])])


def test_far_from_zero_keeps_its_digits(spark):
    v = vectors(40, 3, 2)
    got = run(spark, list(enumerate(v)), shift=10 ** 11)
    near = run(spark, list(enumerate(v)), shift=0)
    assert [r["deviation"] for r in got] == [r["deviation"] for r in near]
    assert np.allclose([r["whitened"] for r in got], [r["whitened"] for r in near], atol=1e-12)
