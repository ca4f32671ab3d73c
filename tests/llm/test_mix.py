"""Pivotal mixing: word totals, caps, targets by hand, reruns, edge rows."""

import numpy as np
import pytest

from tablemover.llm import mix


def brute_targets(sizes, weights, limit=3.0):
    total, full = sum(sizes.values()), {}
    while True:
        free = [s for s in sizes if s not in full]
        left = total - sum(full.values())
        w = sum(weights[s] for s in free)
        share = {s: left * weights[s] / w for s in free} if w else {}
        over = [s for s in free if share[s] > limit * sizes[s]]
        if not over:
            return {**full, **share}
        full.update({s: limit * sizes[s] for s in over})


def test_pair_round_keeps_words_and_leaves_one_open():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 50, 501):
        size, frac = rng.integers(1, 500, n).astype(float), rng.random(n)
        p = mix.pair_round(size, frac, rng.integers(-2 ** 62, 2 ** 62, n), 0, 7)
        assert ((p > 0) & (p < 1)).sum() <= 1 and (p >= 0).all() and (p <= 1).all()
        assert abs((size * p).sum() - (size * frac).sum()) < 1e-6 * size.sum()


def test_a_huge_document_is_decided_by_the_pool():
    rng = np.random.default_rng(4)
    size, frac = np.concatenate([[5000.0], rng.integers(50, 500, 60)]), np.full(61, 0.3)
    got = [mix.pair_round(size, frac, rng.integers(-2 ** 62, 2 ** 62, 61), 0, s) for s in range(400)]
    assert all(p[0] in (0.0, 1.0) for p in got) and abs(np.mean([p[0] for p in got]) - 0.3) < 0.08
    assert all(abs((size * p).sum() - (size * frac).sum()) < 1e-6 * size.sum() for p in got)
    assert np.abs(np.mean(got, axis=0) - 0.3).max() < 0.1


def test_pair_round_keeps_expectations():
    size, frac = np.array([10.0, 40.0, 7.0, 100.0]), np.array([0.2, 0.7, 0.5, 0.9])
    rng = np.random.default_rng(2)
    # What stays open counts with its fraction: the mean of every document is its own fraction.
    mean = np.mean([mix.pair_round(size, frac, rng.integers(-2 ** 62, 2 ** 62, 4), 0, s) for s in range(4000)], axis=0)
    assert np.abs(mean - frac).max() < 0.04


def test_targets_and_taken_words(spark, docs_of):
    rng = np.random.default_rng(3)
    rows = [(i, "w " * int(rng.integers(1, 40)), "en", f"src{i % 7}" if i % 7 else None) for i in range(700)]
    rows += [(1000 + i, "w " * 90, "en", "hot") for i in range(900)]
    d = docs_of(rows)
    sizes = d.selectExpr("doc_id as doc", "source", "cast(size(split(trim(text), ' ')) as long) as size")
    got = mix.mix_decisions(sizes, mix.cycle_weights(sizes.select("source")), block=64).collect()
    assert len(got) == 1600
    by = {}
    for r in got:
        by.setdefault(r["source"], []).append(r)
    names = sorted((s for s in by if s is not None)) + [None]
    size = {s: sum(r["size"] for r in by[s]) for s in by}
    want = brute_targets(size, {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)})
    for s, rs in by.items():
        assert rs[0]["target"] == pytest.approx(want[s]) and rs[0]["source_size"] == size[s]
        assert abs(sum(r["copies"] * r["size"] for r in rs) - want[s]) <= max(r["size"] for r in rs)
        assert all(0 <= r["copies"] <= 3 for r in rs)
    again = mix.mix_decisions(sizes.repartition(3), mix.cycle_weights(sizes.select("source")), block=64).collect()
    key = lambda r: (r["doc"], r["copies"])
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_edges_and_clashing_columns(spark, docs_of):
    d = docs_of([(None, None, None, None), (1, "", "en", "a"), (2, "x y", "en", "a"), (2, "x y", "en", "a"),
                 (3, "z " * 5000, "en", None)]).selectExpr("*", "1 as size", "2 as copies", "'k' as row_id")
    out = mix.mix_sources(d)
    assert out.columns == d.columns
    keys = {(r["doc_id"], r["text"]) for r in d.collect()}
    assert all((r["doc_id"], r["text"]) in keys for r in out.collect())
    assert mix.mix_sources(d.limit(0)).count() == 0
    assert mix.mix_sources(d.where("text is null")).count() >= 0


def test_repeated_and_null_ids_are_dealt_to_blocks(spark):
    rows = [(None, "a", 7)] * 3000 + [(5, "a", 3)] * 1500 + [(i, "b", i % 9 + 1) for i in range(100, 400)]
    sizes = spark.createDataFrame(rows, "doc long, source string, size long")
    from tablemover.llm.common import written
    d = mix.mix_decisions(written(sizes, "t"), mix.cycle_weights(sizes.select("source")), block=64).collect()
    assert len(d) == len(rows)
    for s in ("a", "b"):
        mine = [r for r in d if r["source"] == s]
        taken = sum(r["copies"] * r["size"] for r in mine)
        assert abs(taken - mine[0]["target"]) <= max(r["size"] for r in mine)


def test_row_numbers_are_not_broadcast(docs_of, monkeypatch):
    plans = {}

    def noted(df, purpose, real=mix.written):
        plans[purpose] = df._jdf.queryExecution().executedPlan().toString()
        return real(df, purpose)

    monkeypatch.setattr(mix, "written", noted)
    assert mix.mix_sources(docs_of([(i, "a b c", "en", f"s{i % 2}") for i in range(20)])).count()
    assert "SortMergeJoin [doc#" in plans["mix-copies"]
