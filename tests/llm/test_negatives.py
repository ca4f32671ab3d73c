import numpy as np
import pytest

from tablemover.llm.negatives import Group, hard_negatives, merge_ranges, spanning_tree

SCHEMA = "id long, label int, v array<float>, anchor boolean, x string"


def brute(rows, positives=5, negatives=10, low=30, high=90, scale=256):
    """By position: every row once, whatever its id."""
    ok = [(i, l, np.floor(np.array(v, float) * scale).astype(np.int64), a) for i, l, v, a in rows
          if i is not None and l is not None and v and None not in v and np.isfinite(v).all()]
    out = []
    for k, (i, l, x, a) in enumerate(ok):
        if not a:
            continue
        s = [(-int(x @ y[2]), y[0], j) for j, y in enumerate(ok) if j != k]
        for ps, p, _ in sorted(t for t in s if ok[t[2]][1] == l)[:positives]:
            fit = sorted(t for t in s if ok[t[2]][1] != l and low * -ps <= 100 * -t[0] <= high * -ps)[:negatives]
            out += [(i, p, r + 1, n, -ps, -ns) for r, (ns, n, _) in enumerate(fit)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(3, "label")


def found(df, **kw):
    return sorted(tuple(r) for r in hard_negatives(df, "id", "label", "v", "anchor", **kw).collect())


def vectors(n, dims=6, clusters=4, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((clusters, dims))
    return [(int(i), int(rng.integers(3)), [float(c) for c in (centres[i % clusters] + 0.2 * rng.standard_normal(dims)).astype(np.float32)],
             i % 5 == 0) for i in range(n)]


@pytest.mark.parametrize("seed, small", [(1, dict(group=4, block=16)), (2, dict(group=64, block=50, column_bytes=3000, band_bytes=400))])
def test_equals_brute_force(spark, seed, small):
    rows = vectors(240, seed=seed)
    assert found(frame(spark, rows), **small) == brute(rows)


def test_nulls_ties_repeats_and_few_positives(spark):
    rows = vectors(60, seed=3)
    v = rows[7][2]
    rows += [(7, rows[7][1], v, True)] * 3 + [(200 + i, (rows[7][1] + 1) % 3, [x * 0.5 for x in v], False) for i in range(30)]
    rows += [(None, 1, v, True), (300, None, v, True), (301, 1, None, True), (302, 1, [], True),
             (303, 1, [float("nan")] * 6, True), (304, 1, [None] * 6, True), (305, 99, v, True), (306, 1, v, None)]
    got = found(frame(spark, rows), block=16)
    assert got == brute(rows)
    assert not any(r[0] == 305 for r in got)  # no other row of its label


def test_empty_and_wrong_lengths(spark):
    assert found(frame(spark, [])) == []
    assert found(frame(spark, [(1, 1, [1.0], False)])) == []
    with pytest.raises(ValueError, match="components"):
        found(frame(spark, [(1, 1, [1.0], True), (2, 1, [1.0, 2.0], True)]))


def test_tree_bounds_pass_by_what_no_window_overlaps():
    rng = np.random.default_rng(5)
    x = np.floor(256 * (rng.standard_normal(8) + 0.01 * rng.standard_normal((40, 8))))
    order, parent, edge = spanning_tree(x)
    assert sorted(order) == list(range(40)) and np.isinf(edge).sum() == 1
    total = sum(edge[1:]) if np.isinf(edge[0]) else sum(e for e in edge if np.isfinite(e))
    d = np.sqrt(((x[:, None] - x) ** 2).sum(-1))
    reached, left, best = [0], set(range(1, 40)), 0.0
    while left:
        e, j = min((d[i, j], j) for i in reached for j in left)
        best, reached, left = best + e, reached + [j], left - {j}
    assert abs(total - best) < 1e-6
    block = np.floor(256 * rng.standard_normal((500, 8)))
    g = Group(np.arange(40), np.zeros(40), np.arange(40), x, np.zeros((40, 0)))
    top = np.sort(block @ g.x[0])[-20]
    rescored = 0
    for k, at, s in g.scores(block, lambda k: (np.ones(500, bool), [(top, np.inf)])):
        exact = block @ g.x[k]
        assert set(np.flatnonzero(exact >= top)) <= set(at) and (s == exact[at]).all()
        rescored += len(at)
    assert rescored < 0.2 * 40 * 500


def test_merge_ranges():
    assert merge_ranges([(5, 9), (1, 3), (3, 6), (20, 10), (11, 12)]) == [(1, 9), (11, 12)]
