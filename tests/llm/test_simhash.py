"""Fingerprints, exact pairs and components against brute force."""

import random
from collections import Counter

import pytest
import xxhash

from tablemover.llm import components, simhash as S


def brute_fingerprint(text):
    import re
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not w:
        return 0
    sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(fps))]


def test_fingerprint_matches_brute_force():
    rng = random.Random(4)
    texts = [None, "", " \t", "One", "one TWO", "a b c", "É É É É", "x y z w", " ".join(rng.choice("abcdef") for _ in range(70_000))]
    texts += [" ".join(rng.choice(["ab", "Cd", "é", "the"]) for _ in range(rng.randint(1, 60))) for _ in range(50)]
    for t in texts:
        assert S.fingerprint(t) == brute_fingerprint(t)


@pytest.mark.parametrize("slices", [4, 8, 16])
def test_pairs_are_exact(spark, slices):
    rng = random.Random(slices)
    fps = {0, (1 << 64) - 1, 1, 3, 7}
    for _ in range(60):
        x = rng.getrandbits(64)
        fps.add(x)
        for _ in range(3):
            y = x
            for _ in range(rng.randint(1, 4)):
                y ^= 1 << rng.randrange(64)
            fps.add(y)
    fps = sorted(fps)
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    df = spark.createDataFrame([(signed(v),) for v in fps], "fp long")
    got = Counter(tuple(sorted((r["a"], r["b"]))) for r in S.near_pairs(df, 2, slices).collect())
    want = {tuple(sorted((signed(a), signed(b)))) for i, a in enumerate(fps) for b in fps[:i] if (a ^ b).bit_count() <= 2}
    assert set(got) == want and set(got.values()) <= {1}


def test_lists_that_grow_are_not_broadcast(spark, docs_of, tmp_path):
    def final(df):
        rows = df.collect()
        return rows, df._jdf.queryExecution().executedPlan().toString()
    spark.range(50).selectExpr("id * 1000003 as fp").write.parquet(str(tmp_path / "fps"))
    _, plan = final(S.near_pairs(spark.read.parquet(str(tmp_path / "fps"))))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    docs_of([(i, f"word{i} word{i % 3}") for i in range(20)]).write.parquet(str(tmp_path / "docs"))
    rows, plan = final(S.near_duplicates(spark.read.parquet(str(tmp_path / "docs"))))
    assert len(rows) == 20 and plan.count("SortMergeJoin") >= 2 and "Broadcast" not in plan


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(300, 200), (200, 250), (7, 7), (300, 200)]
    got = dict(components.connected_components(spark.createDataFrame(links, "a long, b long")).collect())
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(30))
    assert got[200] == got[250] == got[300] == 200
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_and_dedup(spark, docs_of):
    rng = random.Random(6)
    base = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eps"]) + str(rng.randrange(50)) for _ in range(300)) for _ in range(12)]
    rows = [(1000 + i, t) for i, t in enumerate(base)]
    for i, t in enumerate(base):
        w = t.split()
        w[rng.randrange(300)] = "changed"
        rows += [(i, " ".join(w)), (500 + i, t.upper()), (500 + i, t.upper())]
    rows += [(None, ""), (77, None), (78, " "), (None, base[0])]
    d = docs_of(rows).selectExpr("*", "'f' as fingerprint", "5 as row_id")
    got = S.near_duplicates(d).collect()
    assert len(got) == len(rows)
    fps = {}
    for r in rows:
        fps.setdefault(brute_fingerprint(r[1]), []).append(r[0])
    keys = sorted(fps)
    comp = brute_components(keys)
    least = {}
    for k, c in zip(keys, comp):
        ids = [x for x in fps[k] if x is not None]
        least[c] = min([least.get(c)] + ids if least.get(c) is not None else ids, default=None)
    want = Counter((i, f"{k:016x}", least[c]) for k, c in zip(keys, comp) for i in fps[k])
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == want
    kept = S.drop_near_duplicates(d)
    assert kept.columns == d.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(v for v in least.values())
    assert S.drop_near_duplicates(d.limit(0)).count() == 0
