"""Edit distance and the walk by hand; exact, edited and missing copies; edge rows."""

import random

import numpy as np

from tablemover.llm import decontaminate as D


def brute_edit(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern):
        new = [i + 1]
        for j, c in enumerate(text):
            new.append(min(row[j] + (p != c), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_edit_distance_matches_table():
    rng = random.Random(1)
    for _ in range(200):
        p = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 90)))
        t = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 120)))
        assert D.edit_distance(p, t)[0] == brute_edit(p, t)


def test_walk_by_hand():
    h = np.random.default_rng(2).integers(0, 2 ** 63, 40).astype(np.uint64)
    for steps in D.STEPS:
        key, last = D.walk_keys(h, steps, 1)
        same, _ = D.walk_keys(h[5:], steps, 1)
        inside = np.flatnonzero(last[5:] <= 40)
        assert (key[5:][inside] == same[inside]).all()  # a key depends on the window alone
        assert (last - np.arange(40) <= steps).all() and (last > np.arange(40)).all()


WORDS = [a + b + c for a in "bcdfgklmnp" for b in "aeiou" for c in ("rin", "tal", "mes", "dor", "vik")]


def _texts(seed=3):
    rng = random.Random(seed)
    some = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    return rng, some


def test_copies_are_found_and_clean_texts_are_not(spark, docs_of):
    rng, some = _texts()
    items = [(i, some(rng.randint(20, 60)).capitalize() + ".") for i in range(40)] + [(90, some(9)), (91, some(5)), (92, "Yes"), (93, ""), (94, None)]
    item = dict(items)
    rows, want = [], set()
    for i in range(300):
        text, kind = some(rng.randint(50, 400)), i % 6
        if kind < 3:
            k = rng.choice(sorted(x for x in item if x < 92))
            copy = item[k]
            if kind == 1:
                copy = "***".join(copy.upper().split(" "))  # case and marks don't hide it
            if kind == 2 and k < 90:  # a tenth of the words changed, dropped or doubled
                w = copy.split()
                for _ in range(len(w) // 10):
                    at = rng.randrange(len(w))
                    w[at:at + 1] = rng.choice([[], [w[at], w[at]], ["zzzz"]])
                copy = " ".join(w)
            text = f"{text} {copy} {some(20)}"
            want.add((i, k))
        rows.append((i, text))
    rows += [(None, "x " + item[0]), (700, None), (701, ""), (702, item[91]), (702, item[91]), (703, " ".join([item[1]] * 300))]
    want |= {(None, 0), (702, 91), (703, 1)}
    b = spark.createDataFrame(items, "doc_id long, text string")
    d = docs_of(rows)
    got = D.contaminated(d, b, item_col="doc_id").collect()
    assert got[0].asDict().keys() == {"doc_id", "doc_id_", "item_chars", "edits"} if got else False
    pairs = {(r["doc_id"], r["doc_id_"]) for r in got}
    assert pairs - {(r, 92) for r, _ in pairs} <= want
    missed = want - pairs
    assert all(i is not None and i % 6 == 2 for i, _ in missed) and len(missed) <= 2  # design recall 0.9, edited copies only
    assert sum(r["doc_id"] == 702 for r in got) == 2
    clean = D.drop_contaminated(d, b, item_col="doc_id")
    assert clean.columns == d.columns
    kept = [r["doc_id"] for r in clean.collect()]
    assert set(kept) == {r[0] for r in rows} - {i for i, _ in pairs}


def test_blocks_agree_and_empty(spark, docs_of):
    rng, some = _texts(5)
    b = spark.createDataFrame([(i, some(30)) for i in range(30)], "item_id long, text string")
    texts = {r["item_id"]: r["text"] for r in b.collect()}
    d = docs_of([(i, some(50) + " " + texts[i % 30]) for i in range(60)])
    one = {tuple(r) for r in D.contaminated(d, b).collect()}
    many = {tuple(r) for r in D.contaminated(d, b, block_words=100).collect()}
    assert one == many and len(one) == 60
    assert D.contaminated(d.limit(0), b).count() == 0 and D.contaminated(d, b.limit(0)).count() == 0
    assert D.drop_contaminated(d, b.limit(0)).count() == 60


def test_recall_up_to_max_edits():
    """Copies with up to 20% of their characters edited anywhere, against brute-force edit distance."""
    import pyarrow as pa

    rng, some = _texts(7)
    items = [some(n) for n in (8, 15, 25, 40, 60) for _ in range(6)]
    index = D.Index(list(range(len(items))), items, 0.9, 0.92)
    texts, want = [], []
    for k in range(300):
        i = rng.randrange(len(items))
        copy = list(items[i])
        for _ in range(int(len(copy) * 0.2 * rng.random())):
            at = rng.randrange(len(copy))
            copy[at:at + 1] = rng.choice([[], [copy[at], "x"], ["x"]])
        texts.append(f"{some(10)} {''.join(copy)} {some(10)}")
        if brute_edit(items[i], texts[-1]) <= 0.2 * len(items[i]):
            want.append((k, i))
    got = {(t, i): e for t, i, e in D.find_items(pa.array(texts), index)}
    assert len(want) > 250 and sum(x in got for x in want) >= 0.9 * len(want)
    assert all(brute_edit(items[i], texts[t]) <= e <= 0.2 * len(items[i]) for (t, i), e in got.items())


def test_many_places_agree_with_one():
    rng = random.Random(8)
    code = lambda s: np.array([ord(c) for c in s], np.uint32)
    pats = ["".join(rng.choice("abé ") for _ in range(n)) for n in (1, 63, 64, 65, 129, 300)]
    text = "".join(rng.choice("abéz ") for _ in range(500))
    which = np.array([rng.randrange(6) for _ in range(60)])
    a = np.array([rng.randrange(400) for _ in which])
    b = a + np.array([rng.randint(1, 100) for _ in which])
    got = D.least_edits([code(p) for p in pats], which, code(text), a, b)
    assert got.tolist() == [D.edit_distance(pats[w], text[x:y])[0] for w, x, y in zip(which, a, b)]


def test_typos_in_most_words_are_verified():
    """A copy that shares few whole words with its item, but lies well within the allowed edits."""
    import pyarrow as pa

    rng, some = _texts(9)
    index = D.Index([0], [item := some(50)], 0.9, 0.92)
    words = item.split()
    for at in rng.sample(range(50), 32):
        words[at] = words[at][:2] + "q" + words[at][3:]
    copy = " ".join(words)
    assert len(set(words) & set(item.split())) < 0.4 * len(set(item.split()))
    assert [(t, i, e) for t, i, e in D.find_items(pa.array([some(30) + " " + copy + " " + some(30), some(200)]), index)] == [(0, 0, 32)]


def _spread(text, kind, rng, share=0.2):
    """A copy with edits in one of every few characters, so that no run of characters is left alone."""
    if kind == "words":  # one replaced character in each word
        return " ".join(w[:len(w) // 2] + "q" + w[len(w) // 2 + 1:] for w in text.split())
    out, k = list(text), int(share * len(text))
    for at in sorted((i * len(text) // k for i in range(k)), reverse=True):
        out[at:at + 1] = ["q"] if kind == "replaced" else rng.choice([[], [out[at], "x"], ["x"]])
    return "".join(out)


def test_recall_of_evenly_spread_edits():
    import pyarrow as pa

    rng, some = _texts(11)
    for words in (12, 25, 50):
        items = [some(words) for _ in range(40)]
        index = D.Index(list(range(40)), items, 0.9, 0.92)
        for kind in ("words", "replaced", "mixed"):
            texts = [f"{some(15)} {_spread(x, kind, rng)} {some(15)}" for x in items]
            got = {(t, i) for t, i, _ in D.find_items(pa.array(texts), index)}
            want = [i for i, x in enumerate(items) if D.edit_distance(x, texts[i])[0] <= int(0.2 * len(x))]
            assert len(want) >= 25 and sum((i, i) in got for i in want) >= 0.85 * len(want), (words, kind)


def test_long_item_and_long_text():
    import time
    import pyarrow as pa

    rng, some = _texts(12)
    long = some(1800)
    index = D.Index([0, 1], [long, some(40)], 0.9, 0.92)
    copy = list(long)
    for at in rng.sample(range(len(copy)), len(copy) // 10):
        copy[at] = "x"
    texts = [some(100) + " " + long + " " + some(100), some(100) + " " + "".join(copy), some(4000)]
    start = time.process_time()
    got = list(D.find_items(pa.array(texts), index))
    assert [(t, i) for t, i, _ in got] == [(0, 0), (1, 0)] and got[0][2] == 0 and 0 < got[1][2] <= len(long) // 10
    assert time.process_time() - start < 30


def test_piece_bound_is_never_above_the_distance():
    rng = random.Random(13)
    code = lambda s: np.array([ord(c) for c in s], np.uint32)
    pieces = ["".join(rng.choice("abcdé漢 ") for _ in range(64)) for _ in range(5)]
    text = "".join(rng.choice("abcdéz漢 ") for _ in range(600))
    which = np.array([rng.randrange(5) for _ in range(80)])
    a = np.array([rng.randrange(560) for _ in which])
    b = np.minimum(600, a + np.array([rng.randint(0, 150) for _ in which]))
    got = D.piece_edits(np.stack([D._codes(code(p)) for p in pieces]), which, D._codes(code(text)), a, b)
    exact = [D.edit_distance(pieces[w], text[x:y])[0] for w, x, y in zip(which, a, b)]
    assert all(g <= e for g, e in zip(got, exact)) and sum(g == e for g, e in zip(got, exact)) > 70
