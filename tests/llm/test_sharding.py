"""Look-up table by hand, shares, minimal moves, native plan, edge rows."""

import re

import duckdb

from tablemover.llm import sharding as S


def test_table_is_filled_in_turns():
    names = S.shard_names(5)
    slots = S.next_prime(500)
    owner = S.fill_table(names, slots)
    assert sorted(set(owner)) == list(range(5))
    counts = [owner.count(i) for i in range(5)]
    assert max(counts) - min(counts) <= 1
    prefs = [[(S._number(s + "/offset") + j * (S._number(s + "/step") % (slots - 1) + 1)) % slots for j in range(slots)] for s in names]
    free, want = set(range(slots)), [None] * slots
    for turn in range(slots):
        c = next(x for x in prefs[turn % 5] if x in free)
        free.remove(c)
        want[c] = turn % 5
    assert owner == want


def test_losing_a_shard_moves_little():
    names = S.shard_names(10)
    slots = S.next_prime(2000)
    a, b = S.fill_table(names, slots), S.fill_table(names[:-1], slots)
    stay = sum(x == y for x, y in zip(a, b) if x != 9) / sum(x != 9 for x in a)
    assert stay > 0.8


def test_bad_parameters():
    import pytest
    for shards, slots in (([], 7), (["a", "a"], 7), (["a"], 8), (["a", "b", "c"], 2)):
        with pytest.raises(ValueError):
            S.fill_table(shards, slots)


def test_edges_and_oracle(spark, docs_of):
    d = docs_of([(None, "x"), (1, None), (1, None), *[(i, "t") for i in range(2, 3000)]]).selectExpr("*", "'c' as shard", "0 as SLOT")
    out = S.assign_shards(d, 8)
    assert out.columns == [*d.columns, "slot_", "shard_"] and out.count() == d.count()
    rows = out.collect()
    assert len({r["shard_"] for r in rows if r["doc_id"] == 1}) == 1 and all(r["shard_"] for r in rows)
    sizes = [sum(r["shard_"] == s for r in rows) for s in S.shard_names(8)]
    assert min(sizes) > 3000 / 8 * 0.7
    con = duckdb.connect()
    con.sql("CREATE TABLE documents AS SELECT unnest([%s]) AS doc_id" % ",".join("NULL" if r["doc_id"] is None else str(r["doc_id"]) for r in rows))
    assert sorted(con.sql(S.oracle(8)).fetchall(), key=str) == sorted(((r["doc_id"], r["slot_"], r["shard_"]) for r in rows), key=str)
    assert S.assign_shards(d.limit(0), 8).count() == 0


def test_native_plan(spark, docs_of):
    plan = S.assign_shards(docs_of([(1, "x")]), 8)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and not re.search("Python|Arrow|Pandas", plan)
