import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tablemover.llm import packing
from tablemover.llm.packing import Encoder, Places, best_fit, knapsack, pack, plan, sequences, solve, token_pieces

PATH = public_tokenizers.path("byte_bpe_50k.json")
ENCODER = Encoder(PATH)


def direct(text):
    return ENCODER.tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abZ1.'sl \t\n\r\x0b  　 \u0085é漢р١<|>endoftext​\U0001f600", max_size=60), max_size=6))
def test_cut_texts_have_the_tokenizers_ids(texts):
    texts = texts + ["a <|endoftext|> b", " it's <|endoftext|>'s  x\n\n y"]
    ids, off = ENCODER.encode(pa.array(texts))
    assert [ids[off[k]:off[k + 1]].tolist() for k in range(len(texts))] == [direct(t) for t in texts]


def test_pieces_cover_every_text(spark):
    long = "the quick 'brown' fox, 12 " * 3000
    rows = [(1, "hello world"), (2, None), (3, ""), (None, "x"), (4, long), (4, long), (5, "y" * 50_000)]
    docs = spark.createDataFrame([(i, t, "c") for i, t in rows], "id long, text string, ids string").repartition(3)
    got = token_pieces(docs, ["id", "ids"], "text", PATH, 256).collect()
    want = []
    for i, t in rows:
        ids = direct(t) + [0]
        first = len(ids) % 256 or 256
        cuts = [0, *range(first, len(ids) + 1, 256)]
        want += [(str(i), k, a, b - a, ids[a:b]) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted((str(r["id"]), r["piece"], r["start"], r["length"], np.frombuffer(r["ids_"], "<u4").tolist()) for r in got) == sorted(want)


def counts_of(lengths, capacity):
    return np.bincount(lengths, minlength=capacity + 1)


def used(configs, capacity):
    out = np.zeros(capacity + 1, int)
    for config, times in configs:
        assert sum(config) <= capacity and list(config) == sorted(config, reverse=True) and times > 0
        np.add.at(out, list(config), times)
    return out


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120))
def test_plans_hold_every_piece_once(lengths):
    c = counts_of(lengths, 40)
    for p in (plan(c, 40, 8), best_fit(c, 40)):
        assert (used(p, 40) == c).all()


def test_plan_is_near_the_least():
    rng = np.random.default_rng(1)
    for lengths in (rng.integers(1, 200, 5000), rng.integers(60, 180, 5000), rng.choice([40, 70, 90, 110], 5000)):
        c = counts_of(lengths, 200)
        n = sum(t for _, t in plan(c, 200))
        assert n <= 1.005 * sum(t for _, t in best_fit(c, 200)) + 1
    assert sum(t for _, t in plan(counts_of(rng.integers(1, 200, 5000), 200), 200)) <= -(-5000 * 100.5 // 200) * 1.02


def test_program_covers_what_it_says():
    c = counts_of(np.random.default_rng(2).integers(20, 100, 2000), 100)
    amounts = solve(c, 100)
    covered = np.zeros(101)
    for config, x in amounts.items():
        assert sum(config) <= 100 and x > 0
        np.add.at(covered, list(config), x)
    assert (covered <= c * (1 + 1e-9)).all() and covered[20:].sum() > 0.5 * c.sum()


def test_knapsack_against_brute_force():
    price = np.full(13, -1.0)
    price[[3, 5, 7]] = [3.1, 5.0, 7.3]
    best, _ = knapsack(price, 12)
    for c in range(13):
        assert best[c] == pytest.approx(max(3.1 * a + 5 * b + 7.3 * d for a in range(5) for b in range(3) for d in range(2)
                                            if 3 * a + 5 * b + 7 * d <= c))


def test_places_of_a_plan():
    configs = [((5, 3, 3), 2), ((8,), 1), ((3,), 4)]
    places = Places(configs, 10)
    got = [tuple(int(v) for v in x) for x in zip(*places.of(np.array([5, 5, 8] + [3] * 8), np.array([0, 1, 0] + list(range(8)))))]
    assert got == [(0, 0), (1, 0), (2, 0), (0, 5), (0, 8), (1, 5), (1, 8), (3, 0), (4, 0), (5, 0), (6, 0)]


def check(rows, capacity):
    by = {}
    for s, o, n in rows:
        by.setdefault(s, []).append((o, n))
    for spans in by.values():
        end = 0
        for o, n in sorted(spans):
            assert o == end
            end += n
        assert end <= capacity
    return len(by)


def test_pack_places_without_gaps_also_hot_lengths_and_repeats(spark):
    rng = np.random.default_rng(3)
    lengths = [37] * 3000 + rng.integers(1, 101, 2000).tolist() + [100] * 50
    df = spark.createDataFrame([(i % 7 if i % 11 else None, int(l), "z") for i, l in enumerate(lengths)], "id long, length long, offset string")
    out = pack(df.repartition(5), "length", 100, 16)
    assert out.columns == ["id", "length", "offset", "sequence_id", "offset_"]
    rows = out.collect()
    assert sorted((r["length"]) for r in rows) == sorted(lengths)
    n = check([(r["sequence_id"], r["offset_"], r["length"]) for r in rows], 100)
    assert n <= 1.03 * sum(t for _, t in best_fit(counts_of(lengths, 100), 100))


def test_pack_of_nothing_and_of_wrong_lengths(spark):
    empty = spark.createDataFrame([], "id long, length int")
    assert pack(empty).collect() == []
    for bad in (0, 11, None):
        with pytest.raises(ValueError, match="lengths must be"):
            pack(spark.createDataFrame([(1, bad)], "id long, length int"), "length", 10)


def test_sequences_hold_the_texts(spark):
    texts = [f"document {i} says {'so ' * (i % 40)}" for i in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    packed = pack(token_pieces(docs, ["id"], "text", PATH, 64), "length", 64, 16)
    whole = {r["sequence_id"]: np.frombuffer(r["ids"], "<u4") for r in sequences(packed).collect()}
    back = {}
    for r in packed.orderBy("id", "piece").collect():
        back.setdefault(r["id"], []).extend(whole[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]].tolist())
    assert back == {i: direct(t) + [0] for i, t in enumerate(texts)}
    assert sequences(packed).where(F.col("n_tokens") > 64).count() == 0
