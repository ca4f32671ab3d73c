"""Registration of the eleven queries, and the pipeline stage by stage on the smallest tables."""

from collections import Counter

import __spark_entry__ as E
import corpus_pipeline as P
from tablemover.llm import decontaminate, quality, simhash

SF = "/root/testdata/sf0.001"


def test_registered():
    q = E.queries()
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in q) == 1
    assert "pipeline" in q and [n for n, _ in P.STAGES] == ["quality", "simhash", "decontaminate", "mix", "shard"]


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    outs, now = [], docs
    for name, stage in P.STAGES:
        now = stage(spark, now, SF).cache()
        outs.append(now.collect())
        assert now.columns[:5] == docs.columns and (name == "shard" or now.columns == docs.columns)
    kept, unique, clean, mixed, sharded = outs
    model = quality.fit_quality(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = {r["doc_id"] for r in quality.quality_scores(docs, model).collect() if r["predicted"]}
    assert {r["doc_id"] for r in kept} == good and len(kept) == len(good)
    comps = simhash.near_duplicates(docs.where(docs.doc_id.isin(*good)))
    assert {r["doc_id"] for r in unique} == {r["component_id"] for r in comps.collect()} and len(unique) == len({r["doc_id"] for r in unique})
    leaks = decontaminate.contaminated(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()
    assert {r["doc_id"] for r in clean} == {r["doc_id"] for r in unique} - {r["doc_id"] for r in leaks}
    copies = Counter(r["doc_id"] for r in mixed)
    assert set(copies) <= {r["doc_id"] for r in clean} and max(copies.values()) <= 3
    assert all(r["text"] == rows[r["doc_id"]]["text"] for r in mixed)
    assert Counter(r["doc_id"] for r in sharded) == copies and all(r["shard"].startswith("shard-") for r in sharded)
