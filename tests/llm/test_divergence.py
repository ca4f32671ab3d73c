"""Base counts against plain Python, distances against numpy, verdict edges, native plan."""

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from tablemover.llm import divergence as D

SF = "/root/testdata/sf0.001"


def brute(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    ct = Counter(zip(w, w[1:], w[2:]))
    spots = {i + k for i in range(len(w) - 2) if ct[tuple(w[i:i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(spots)


TEXTS = [None, "", "   \n\t ", "a", "a a", "a a a", "a a a a", "x y z x y z", "x y z q x y z x y", "l\nl\n \n \nl",
         "\x0bA|B\x0c#é ñ#\r\nA|B\x0c#é ñ#", "one two three " * 4000, "日本 語 日本 語 日本", "a b c a b c", " \na b c\n a b c\n"]


def test_base_counts_match_brute_force(spark, docs_of):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "a"), (None, "n n n n")]
    d = docs_of(rows).unionByName(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source"))
    texts = {}
    for r in d.collect():
        texts.setdefault(r["doc_id"], r["text"])
    out = D.quality_rules(d, ["doc_id", "source"]).collect()
    assert len(out) == d.count()
    for r in out:
        if r["doc_id"] in texts and r["source"] == "s" or r["doc_id"] not in range(len(TEXTS)):
            got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
            assert got == brute(texts[r["doc_id"]]), r["doc_id"]
            assert r["base_failed"] == (got[0] < 50 or 100 * got[4] > 50 * got[0])
            assert not (r["base_failed"] and r["kept"])


def test_clashing_half_hashes_are_told_apart(spark):
    # Suspects that share the half hash but not the words: made by hand, as real ones are rare.
    d = spark.createDataFrame([(["a", "b", "c", "d", "a", "b", "c"], [(7 << 32) | 0, (7 << 32) | 1, (7 << 32) | 4])],
                              "w array<string>, found array<long>")
    d = d.withColumn("pairs", D.by_words(F.col("w"), F.col("found")))
    r = d.select(D.clashes(F.col("w"), F.col("found")).alias("n"), D.real_repeats(F.col("pairs")).alias("real")).first()
    assert r["n"] == 2 and sorted(x & 0xFFFFFFFF for x in r["real"]) == [0, 4]


def test_distance(spark):
    p, q = [0.5, 0.2], [0.1, 0.9]
    a, b = [*p, 0.3], [*q, 0.0]
    m = [(x + y) / 2 for x, y in zip(a, b)]
    kl = lambda u: sum(x * math.log2(x / y) for x, y in zip(u, m) if x > 0)
    got = spark.createDataFrame([(p, q)], "p array<double>, q array<double>").select(D.distance(F.col("p"), F.col("q"))).first()[0]
    assert abs(got - math.sqrt((kl(a) + kl(b)) / 2)) < 1e-12


def test_verdicts(spark, docs_of):
    import random
    rng = random.Random(5)
    vocab = ["the", "of", "and", "to", "a", "in"] + [a + b + c for a in "bcdfg" for b in "aeiou" for c in ("ring", "tal", "mes")]
    clean = lambda n: " ".join(rng.choice(vocab) for _ in range(n)) + "."
    rows = [(i, clean(400)) for i in range(60)]
    rows += [(100, " ".join(w.upper() + "##" for w in clean(300).split())), (101, clean(70)), (102, "short text"),
             (103, " ".join("0123456789"[rng.randrange(10)] * rng.randint(3, 9) + str(k) for k in range(300)))]
    d = docs_of(rows).unionByName(docs_of([(104, clean(300), "xx", "s"), (105, clean(300), None, None)]))
    kept = {r["doc_id"]: r["kept"] for r in D.quality_rules(d, ["doc_id"], min_share=0.02).collect()}
    assert all(kept[i] for i in range(60))
    assert not kept[100] and not kept[103] and not kept[102]
    assert kept[101] and kept[104] and kept[105]  # too short to judge, unknown language, null language


def test_empty_and_clashing_columns(spark, docs_of):
    d = docs_of([(1, "a b c")]).withColumn("kept", F.lit("k")).withColumn("n_words", F.lit(9))
    out = D.quality_rules(d, ["doc_id", "kept", "n_words"])
    assert out.columns[:3] == ["doc_id", "kept_", "n_words_"] and out.first()["kept_"] == "k"
    assert D.quality_rules(d.limit(0), ["doc_id"]).count() == 0


def test_no_python_in_the_plan(spark, docs_of):
    plan = D.quality_rules(docs_of([(1, "a b c")]), ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_every_language_with_text_is_judged(spark, docs_of):
    import random
    rng = random.Random(6)
    vocab = [a + b + c for a in "bcdfg" for b in "aeiou" for c in ("ringe", "talum", "mesto")]  # no word of four characters or less
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    rows = [(i, text(300), "yy", "s") for i in range(30)] + [(100, "##".join(text(300).upper().split(" ")).replace("##", "## "), "yy", "s")]
    rows += [(200 + i, " ".join("日本語文章" for _ in range(120)), "zz", "s") for i in range(20)]
    rows += [(300, " ".join("123456" for _ in range(60)) + " " + " ".join(str(10 ** 6 + k) for k in range(200)), "zz", "s")]
    got = {r["doc_id"]: r for r in D.quality_rules(docs_of(rows), ["doc_id"]).collect()}
    assert all(got[i]["kept"] and got[i]["class_distance"] is not None for i in range(30))
    assert got[100]["class_distance"] is not None and not got[100]["kept"]
    assert got[300]["class_distance"] > 0.25 and not got[300]["kept"]


def test_small_share_has_a_reference(spark):
    base = spark.createDataFrame([("a", "the", 2_000_000), ("b", "und", 1500), ("c", "et", 900)], "lang string, w string, n int")
    base = base.select("lang", F.expr("array_repeat(w, n)").alias("words"))
    assert {r["lang"] for r in D.common_words(base).collect()} == {"a", "b"}
