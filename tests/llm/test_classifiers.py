"""Toxicity and quality: held-out accuracy, labels outside the fold only, edge rows."""

import random
import zlib

import numpy as np
import pyarrow as pa

from tablemover.llm import common, quality, toxicity


def test_word_hashes_are_words():
    import re
    texts = ["Hello, hello WORLD!", "", "été Été x9", "###", "a" * 300_000 + " b", "end"]
    h, off, a, b = common.word_hashes(pa.array(texts))
    words = [re.findall(r"[0-9a-z\u0080-\U0010ffff]+", t.lower()) for t in texts]
    assert np.diff(off).tolist() == [len(w) for w in words]
    flat = [w for ws in words for w in ws]
    seen = {}
    for w, x in zip(flat, h.tolist()):
        assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


def test_text_slices_cover_everything():
    t = pa.array(["x" * 10, None, "", "y" * 100, "z"])
    assert list(common.text_slices(t, 12)) == [(0, 3), (3, 4), (4, 5)]
    assert list(common.text_slices(pa.array([], pa.string()))) == []


def _corpus(n, mark, seed):
    rng = random.Random(seed)
    vocab = [a + b + c for a in "bcdfgklm" for b in "aeiou" for c in ("rin", "tal", "mes", "dor")]
    rows, labels = [], []
    for i in range(n):
        y = int(rng.random() < 0.3)
        words = [rng.choice(vocab) for _ in range(rng.randint(40, 120))]
        if y:
            mark(words, rng)
        rows.append((i, " ".join(words)))
        labels.append((i, y, y))
    return rows, labels


def _accuracy(scored, labels, kind):
    y = {i: k for i, k, _ in labels}
    held = [(r["predicted"], y[r["doc_id"]]) for r in scored if r["held_out"]]
    assert len(held) > 100
    return sum(a == b for a, b in held) / len(held)


def test_toxicity_held_out(spark, docs_of):
    def insult(words, rng):
        for _ in range(3):
            words.insert(rng.randrange(len(words)), rng.choice(["idiot", "scum", "moron"]))

    rows, labels = _corpus(1500, insult, 1)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.toxicity_scores(docs_of(rows), lab).collect()
    assert _accuracy(got, labels, "toxic") > 0.95
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    # Held-out labels change nothing.
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    again = toxicity.toxicity_scores(docs_of(rows), spark.createDataFrame(flipped, lab.schema)).collect()
    assert {(r["doc_id"], r["score"]) for r in got} == {(r["doc_id"], r["score"]) for r in again}


def test_quality_held_out(spark, docs_of):
    def junk(words, rng):
        words[:] = [w + rng.choice(["###", "***", "$$$"]) for w in words]

    rows, labels = _corpus(1500, junk, 2)
    lab = spark.createDataFrame([(i, 1 - q, t) for i, q, t in labels], "doc_id long, quality int, toxic int")
    d = docs_of(rows)
    model = quality.fit_quality(d, lab)
    got = quality.quality_scores(d, model).collect()
    assert _accuracy(got, [(i, 1 - q, t) for i, q, t in labels], "quality") > 0.95
    kept = {r["doc_id"] for r in quality.keep_quality(d, model).collect()}
    assert kept == {r["doc_id"] for r in got if r["predicted"] == 1}


def test_sum_of_squares_identity():
    m = quality.start_model()
    texts = pa.array(["one two three two", "", "FOUR ### |"])
    idx, off, bins = quality.text_features(texts)
    fast = quality._logits(m, (m.vectors * m.vectors).sum(axis=1), idx, off, bins)
    for k in range(3):
        words = idx[off[k]:off[k + 1]]
        feats = [(i, 1 / np.sqrt(max(len(words), 1))) for i in words] + [(i, 1.0) for i in bins[k]]
        slow = sum(x * m.weights[i] for i, x in feats) + sum(
            feats[a][1] * feats[b][1] * float(m.vectors[feats[a][0]] @ m.vectors[feats[b][0]])
            for a in range(len(feats)) for b in range(a))
        assert abs(fast[k] - slow) < 1e-4


def test_edge_rows(spark, docs_of):
    d = docs_of([(None, None), (1, ""), (1, ""), (2, "x " * 200_000)]).selectExpr("*", "'c' as score", "1 as held_out")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(1, None, None), (2, 1, 0), (2, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for lab in (none, odd):
        t = toxicity.toxicity_scores(d, lab).collect()
        q = quality.quality_scores(d, quality.fit_quality(d, lab)).collect()
        assert len(t) == len(q) == 4 and all(0 <= r["score"] <= 1 for r in t + q)
        assert [r["held_out"] for r in t if r["doc_id"] is None] == [False]
    assert toxicity.toxicity_scores(d.limit(0), none).count() == 0
    assert quality.keep_quality(d.limit(0), quality.fit_quality(d, none)).columns == d.columns


def test_training_sample_is_bounded_by_rows(spark, docs_of):
    from tablemover.llm.toxicity import training_rows

    rows = [(1, f"text {i}") for i in range(500)] + [(1, "same")] * 500 + [(i, f"doc {i}") for i in range(2, 40)] + [(2, None), (3, "")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    got = training_rows(docs_of(rows), labels, "toxic", "doc_id", "text", 5, 99, 10_000, 1).collect()
    of_one = [r for r in got if r["place"] == next(x["place"] for x in got if x["text"] and x["text"].startswith("text"))]
    assert len(of_one) == 4 and len({r["text"] for r in of_one}) == 4
    assert sorted(r["text"] or "" for r in got if r not in of_one) == sorted([f"doc {i}" for i in range(2, 40)] + ["", ""])


def test_ftrl_against_a_plain_one():
    """The weights of a few examples, against the update written out coordinate by coordinate."""
    import inspect
    import math

    from tablemover.llm.toxicity import fit_ftrl

    rng = np.random.default_rng(3)
    examples = [(np.unique(rng.integers(0, 12, 4)), int(rng.integers(2))) for _ in range(60)]
    given = {k: p.default for k, p in inspect.signature(fit_ftrl).parameters.items() if p.default is not inspect.Parameter.empty}
    alpha, beta, l1, l2, epochs = (given[k] for k in ("alpha", "beta", "l1", "l2", "epochs"))
    z, n, bias, bn = {}, {}, 0.0, 0.0

    def weight(c):
        if abs(z.get(c, 0.0)) <= l1:
            return 0.0
        return -(z[c] - math.copysign(l1, z[c])) / ((beta + math.sqrt(n[c])) / alpha + l2)

    for _ in range(epochs):
        for cells, y in examples:
            x = sum(weight(c) for c in cells.tolist()) + bias
            g = 1 / (1 + math.exp(-max(-35, min(35, x)))) - y
            for c in cells.tolist():
                w, old = weight(c), n.get(c, 0.0)
                z[c] = z.get(c, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / alpha * w
                n[c] = old + g * g
            bn += g * g
            bias -= 0.1 * g / (1 + math.sqrt(bn))
    m = fit_ftrl(examples)
    want = {c: weight(c) for c in z if abs(z[c]) > l1}
    assert dict(zip(m.coords.tolist(), m.weights.tolist())).keys() == want.keys() and want
    assert all(abs(w - want[c]) < 1e-6 for c, w in zip(m.coords.tolist(), m.weights.tolist())) and abs(m.bias - bias) < 1e-9
