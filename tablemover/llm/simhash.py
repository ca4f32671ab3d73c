"""SimHash near-duplicates: 64-bit fingerprints, linked exactly within a few bits by a vantage-point tree.

**Tree.** The 64 bits are cut into ``slices`` equal slices, and level i of the tree holds one vantage
point on slice i. A level splits its fingerprints into shells by their Hamming distance to the vantage
point, so a leaf (the shard) is the tuple of those distances. The triangle inequality bounds a pair's
distance on a slice from below by the difference of its two shells, and slices are disjoint, so the
bounds of all levels add up: a branch is pruned as soon as the sum of shell differences on the way down
exceeds the radius. What is left is a short, fixed list of leaves that overlap the ball around a
fingerprint (73 of 9^8 for eight slices and two bits, one direction only). Every fingerprint is sent to
those leaves, and pairs that meet in a leaf are checked on all 64 bits. Nothing is approximate: a pair
within the radius always meets exactly once.

**Skew.** Copies share one fingerprint and count once in the tree, so a group of copies of any size is
one row there. The join on leaves is a sort-merge join at every size, which adaptive execution can split.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import clean_strings, col, fresh, with_row_id, written
from .components import connected_components

SEED = 42
_CHUNK = 1 << 15


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of the word shingles of ``text`` (A-Z lower-cased; words split on ASCII white space),
    repeats included. Fewer words than a shingle: the whole sequence is the one shingle; none: 0."""
    import xxhash

    hash64 = xxhash.xxh64_intdigest
    words = (text or "").encode("utf-8").lower().split()
    n = len(words)
    if not n:
        return 0
    if n <= shingle:
        return hash64(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n - shingle + 1].tolist()
    ends = ends[shingle - 1:].tolist()
    total = len(starts)
    ones = np.zeros(64, np.int64)
    for i in range(0, total, _CHUNK):
        h = np.array([hash64(joined[a:b], SEED) for a, b in zip(starts[i:i + _CHUNK], ends[i:i + _CHUNK])], "<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text_col: str, keep: list[str], name: str, shingle: int = 3) -> DataFrame:
    """Columns ``keep`` and the fingerprint of ``text_col`` as a signed long ``name``."""
    schema = docs.select(*[col(c) for c in keep]).schema.add(name, "long")
    n = len(keep)

    def score(batches):
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in clean_strings(batch.column(n))]
            fp = pa.array(np.array(fps, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], fp], names=[*keep, name])

    return docs.select(*[col(c) for c in keep], col(text_col).alias(fresh(keep, "text"))).mapInArrow(score, schema)


def vantage_points(slices: int) -> list[int]:
    """One fixed pseudo-random vantage point per slice."""
    import xxhash

    width = 64 // slices
    return [xxhash.xxh64_intdigest(b"vantage", i) & ((1 << width) - 1) for i in range(slices)]


def leaf_column(fp, slices: int):
    """The leaf of a fingerprint: its slices' distances to the vantage points, packed in one long."""
    width = 64 // slices
    digit = width.bit_length()
    key = F.lit(0).cast("long")
    for i, v in enumerate(vantage_points(slices)):
        part = F.shiftrightunsigned(fp, width * i).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        key = key + F.shiftleft(F.bit_count(part.bitwiseXOR(F.lit(v).cast("long"))).cast("long"), digit * i)
    return key


def probe_offsets(slices: int, radius: int) -> list[int]:
    """Key differences of the leaves within ``radius`` by the summed bounds, one of each +/- pair."""
    width = 64 // slices
    digit = width.bit_length()

    def grow(i, left):
        if i == slices:
            yield ()
            return
        for d in range(-min(left, width), min(left, width) + 1):
            for rest in grow(i + 1, left - abs(d)):
                yield (d, *rest)

    out = []
    for deltas in grow(0, radius):
        first = next((d for d in deltas if d), 0)
        if first >= 0:
            out.append(sum(d << (digit * i) for i, d in enumerate(deltas)))
    return out


def near_pairs(fps: DataFrame, radius: int = 2, slices: int = 8) -> DataFrame:
    """(a, b) for all pairs of distinct fingerprints (column ``fp``, each once) within ``radius`` bits.

    ``slices`` (a divisor of 64 up to 16) sets the tree's depth: 8 suits up to about 10^8 distinct
    fingerprints; 16 has smaller leaves and 273 instead of 73 probes.
    """
    # A digit of a leaf key holds distances up to the slice's width plus spill-over of a probe that
    # leaves the range; such probes name no existing leaf.
    homes = fps.select(leaf_column(F.col("fp"), slices).alias("leaf"), F.col("fp").alias("b"))
    offsets = F.array(*[F.lit(o).cast("long") for o in probe_offsets(slices, radius)])
    probes = (fps.select(F.col("fp").alias("a"), leaf_column(F.col("fp"), slices).alias("home"),
                         F.explode(offsets).alias("off"))
              .select("a", (F.col("home") + F.col("off")).alias("leaf"), (F.col("off") == 0).alias("own")))
    # A merge join at every size: Spark sizes the probes as before the explode and would broadcast them.
    return (homes.join(probes.hint("merge"), "leaf")
            .where((F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius) & (~F.col("own") | (F.col("a") < F.col("b"))))
            .select("a", "b"))


def _grouped(docs: DataFrame, keep: list[str], text_col: str, shingle: int, radius: int, slices: int) -> DataFrame:
    """Columns ``keep`` as c0.., ``fp``, the fingerprint ``root`` that stands for the component, and
    ``component_id``, the least c0 in it."""
    ids = [f"c{i}" for i in range(len(keep))]
    src = docs.select(*[col(c).alias(a) for c, a in zip(keep, ids)], col(text_col).alias("t"))
    prints = written(with_fingerprints(src, "t", ids, "fp", shingle), "simhash")
    nodes = written(prints.groupBy("fp").agg(F.min(ids[0]).alias("least")), "simhash-nodes")
    links = written(near_pairs(nodes.select("fp"), radius, slices), "simhash-links")
    comps = connected_components(links)
    rooted = nodes.join(comps, nodes["fp"] == comps["u"], "left").select(
        "fp", "least", F.coalesce("v", "fp").alias("root"))
    rooted = written(rooted, "simhash-roots")
    best = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    # Merge joins at every size: these lists grow with the documents.
    label = rooted.join(best.hint("merge"), "root").select(F.col("fp").alias("nfp"), "root", "component_id")
    return prints.join(label.hint("merge"), prints["fp"] == label["nfp"], "left").drop("nfp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    radius: int = 2, slices: int = 8, extra: list[str] | None = None) -> DataFrame:
    """One row per document: id (and ``extra`` columns), ``fingerprint`` (16 hex digits) and
    ``component_id``, the smallest id among all documents that links of at most ``radius`` bits reach.

    Null text counts as empty; texts without words have fingerprint 0 and are linked like any other.
    Null ids are kept as rows and never name a component unless it has no other id (then null).
    Repeated rows appear as often as given. An empty table gives no rows. The result's own column
    names win over equally named extra columns, which are renamed with a trailing underscore.
    """
    keep = [id_col, *(extra or [])]
    out = _grouped(docs, keep, text_col, shingle, radius, slices)
    names = []
    for c in keep:
        names.append(c if c == id_col else fresh([id_col, "fingerprint", "component_id", *names], c))
    return out.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)],
                      F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                         radius: int = 2, slices: int = 8) -> DataFrame:
    """``docs`` with one document of each near-duplicate group: the one with the smallest id (among
    equal or null ids, the first stored row). Columns and their order stay as they are."""
    named, row = with_row_id(docs, "simhash-docs")
    groups = _grouped(named, [id_col, *row], text_col, shingle, radius, slices)
    ranked = F.struct(F.col("c0").isNull().alias("n"), "c0", "c1", "c2")
    kept = groups.groupBy("root").agg(F.min(ranked).alias("k")).select(*[F.col(f"k.c{i + 1}").alias(r) for i, r in enumerate(row)])
    kept = written(kept, "simhash-kept")
    # A merge join at every size: the list of kept rows grows with the documents.
    return named.join(kept.hint("merge"), row, "left_semi").select(*[col(c) for c in docs.columns])
