"""Mixing sources to target weights by pivotal dependent rounding.

A document of a source that should yield ``target`` words out of ``source_size`` gets target /
source_size copies: the whole part always, the fraction by rounding. Rounding is dependent: two open
fractions of a source are paired and words move from one document's copies to the other's, up or down
at random with the odds that keep both expectations, until one fraction is 0 or 1. Words move one for
one, so a pair's total never changes, and a source ends with one open document, a small one: its taken
words miss the target by less than that document's size.

The pairs form a reduction tree. Documents are dealt by hash to blocks of about ``block`` rows within
their source, so a source with a third of all rows is many blocks; each block rounds its own documents
and keeps one residual, and residuals of ``block`` blocks meet in a block of the next level. All
randomness is a hash of (seed, level, document), so reruns and retried tasks agree.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..operators.sequence import with_sequence
from .common import WORD, col, fresh, with_row_id, written

_LEAF = "doc long, source string, block long, size long, copies long, open boolean, frac double, h long"


def word_count(c):
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")


def cycle_weights(sources: DataFrame, cycle=(5.0, 2.0, 1.0)) -> DataFrame:
    """Weights repeating ``cycle`` over the sources by code point, null last. Sources are numbered by
    ranges, so any number of them works."""
    s = sources.select("source").distinct().select("source", F.col("source").isNull().alias("last"))
    n = with_sequence(s, ["last", "source"], name="place", start=0)
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), (F.col("place") % len(cycle) + 1).cast("int"))
    return n.select("source", pick.alias("weight"))


def source_targets(sizes: DataFrame, weights: DataFrame, limit: float = 3.0) -> DataFrame:
    """(source, source_size, n_docs, target): shares of all words by weight; a source stops at ``limit``
    times its own size and the rest is shared anew by weight until none is above.

    Sources without a weight take nothing. The rounds carry one number, the words per unit of weight,
    which only rises; each is one small aggregate over the table of sources.
    """
    t = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")))
    t = t.join(weights.select(F.col("source").alias("w_source"), "weight"),
               F.col("source").eqNullSafe(F.col("w_source")), "left").drop("w_source")
    t = written(t.withColumn("weight", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0))), "mix-sources")
    cap = F.col("source_size") * F.lit(float(limit))
    total = t.agg(F.sum("source_size")).first()[0] or 0
    rate, before = 0.0, -1
    while True:
        full = cap < F.col("weight") * F.lit(rate)
        r = t.agg(F.sum(F.when(full, cap)).alias("capped"), F.sum(F.when(~full, F.col("weight"))).alias("rest"),
                  F.sum(full.cast("long")).alias("n")).first()
        if (r["n"] or 0) == before or not r["rest"]:
            break
        before = r["n"]
        rate = (total - (r["capped"] or 0.0)) / r["rest"]
    target = F.least(cap, F.col("weight") * F.lit(rate)) if r["rest"] else F.when(F.col("weight") > 0, cap).otherwise(0.0)
    return t.select("source", "source_size", "n_docs", target.cast("double").alias("target"))


def _uniform(h: np.ndarray, level: int, rnd: int, seed: int) -> np.ndarray:
    x = h.view(np.uint64) + np.uint64((seed * 1000003 + level * 1009 + rnd * 9176 + 1) & (2 ** 63 - 1))
    for shift, mul in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(mul)
    return ((x ^ (x >> np.uint64(33))) >> np.uint64(11)).astype(np.float64) / 2.0 ** 53


#: From so many open documents on, the largest is paired with all others at once.
POOL = 160


def pair_round(size: np.ndarray, frac: np.ndarray, h: np.ndarray, level: int, seed: int) -> np.ndarray:
    """Round fractions in (0, 1) of positive sizes by pairs: returns fractions, all but one 0 or 1.

    Open documents are paired with their neighbours by size until ``POOL`` are left. Then the largest is
    paired with the pool of all others, which give or take words in proportion to size * p * (1 - p): that
    keeps every expectation too, and the document that stays open in the end is the smallest.
    """
    p = frac.astype(np.float64).copy()
    order = np.lexsort((h, -size))
    live = order[(p[order] > 0) & (p[order] < 1)]
    rnd = 0
    while len(live) > POOL:
        a, b = live[0:len(live) - 1:2], live[1::2]
        sa, sb = size[a], size[b]
        up = np.minimum(sa * (1 - p[a]), sb * p[b])      # words moved from b to a
        down = np.minimum(sa * p[a], sb * (1 - p[b]))    # words moved from a to b
        rise = _uniform(h[a] ^ (h[b] << 1), level, rnd, seed) * (up + down) < down
        a_end = np.where(rise, sa * (1 - p[a]) <= sb * p[b], sa * p[a] <= sb * (1 - p[b]))
        move = np.where(rise, up, -down)
        pa_, pb_ = p[a] + move / sa, p[b] - move / sb
        # The side that ran out lands exactly on 0 or 1; the other stays in range.
        p[a] = np.where(a_end, rise.astype(float), np.clip(pa_, 0, 1))
        p[b] = np.where(~a_end, (~rise).astype(float), np.clip(pb_, 0, 1))
        rnd += 1
        live = live[(p[live] > 0) & (p[live] < 1)]
    coins = _uniform(h[live], level, 1000, seed)
    turn = 0
    while len(live) > 1:
        a, rest = live[0], live[1:]
        q = p[rest]
        weight = size[rest] * q * (1 - q)
        total = weight.sum()
        room_up, room_down = size[a] * (1 - p[a]), size[a] * p[a]
        up, down = min(room_up, total / (1 - q).max()), min(room_down, total / q.max())
        rise = coins[turn % len(coins)] * (up + down) < down
        turn += 1
        move = up if rise else -down
        q = q - move * q * (1 - q) / total
        if (room_up if rise else room_down) <= abs(move):
            p[a] = 1.0 if rise else 0.0
        else:  # a document of the pool ran out first
            p[a] += move / size[a]
            k = int(np.argmin(q) if rise else np.argmax(q))
            q[k] = 0.0 if rise else 1.0
        p[rest] = np.where(q < 1e-12, 0.0, np.where(q > 1 - 1e-12, 1.0, q))
        live = live[(p[live] > 0) & (p[live] < 1)]
        if turn % len(coins) == 0:
            coins = _uniform(h[live], level, 1000 + turn, seed) if len(live) else coins
    return p


def _level(level: int, seed: int):
    def one(table: pa.Table) -> pa.Table:
        table = table.sort_by([("h", "ascending"), ("size", "ascending"), ("doc", "ascending")])
        size, frac = table["size"].to_numpy().astype(np.float64), table["frac"].to_numpy()
        p = pair_round(size, frac, table["h"].to_numpy(), level, seed)
        put = {"frac": p, "copies": table["copies"].to_numpy() + (p >= 1), "open": (p > 0) & (p < 1)}
        return pa.table([pa.array(put[c]) if c in put else table[c] for c in table.column_names],
                        names=table.column_names)
    return one


def mix_decisions(sizes: DataFrame, weights: DataFrame, limit: float = 3.0, block: int = 512,
                  seed: int = 7) -> DataFrame:
    """(doc, source, size, source_size, target, copies) for ``sizes`` (doc, source, size): how often the
    mix repeats each document. Documents without words get no copies to round: whole copies only."""
    targets = source_targets(sizes, weights, limit)
    targets = written(targets.withColumn("blocks", F.ceil(F.col("n_docs") / F.lit(block))), "mix-targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    t = targets.select(F.col("source").alias("t_source"), "blocks", ratio.alias("ratio"))
    whole = F.floor("ratio").cast("long")
    # Rows that repeat (an id, or a null one, with one size) more often than a block holds are dealt by their row, too.
    same = ["source", "doc", "size"]
    often = written(sizes.groupBy(*same).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block).select(
        *[F.col(c).alias(f"o_{c}") for c in same]), "mix-repeats")
    if not often.isEmpty():
        row = F.monotonically_increasing_id()
        each = [F.col(c).eqNullSafe(F.col(f"o_{c}")) for c in same]
        sizes = sizes.withColumn("row", row).join(often, each, "left").select(
            *same, F.when(F.col("o_size").isNotNull(), F.col("row")).otherwise(F.lit(0)).alias("row"))
    else:
        sizes = sizes.withColumn("row", F.lit(0))
    number = F.when(F.col("row") == 0, F.xxhash64("doc", "size")).otherwise(F.xxhash64("doc", "size", "row"))
    base = (sizes.join(t, F.col("source").eqNullSafe(F.col("t_source")))
            .withColumn("h", number)
            .withColumn("frac", F.when(F.col("size") > 0, F.col("ratio") - whole).otherwise(F.lit(0.0)))
            .select("doc", "source", F.pmod("h", "blocks").alias("block"), "size", whole.alias("copies"),
                    F.lit(False).alias("open"), "frac", "h"))
    leaves = written(base.groupBy("source", "block").applyInArrow(_level(0, seed), _LEAF), "mix-leaves")
    most = targets.agg(F.max("blocks")).first()[0] or 1
    # Climb: each open document stands for its block; (source, block) names it.
    opened = leaves.where("open").withColumn("leaf", F.col("block"))
    schema = _LEAF + ", leaf long"
    settled = []
    level = 0
    while True:
        level += 1
        up = opened.withColumn("block", F.floor(F.col("block") / F.lit(block)).cast("long"))
        done = written(up.groupBy("source", "block").applyInArrow(_level(level, seed), schema), f"mix-level{level}")
        settled.append(done.where("not open"))
        opened = done.where("open")
        most = -(-most // block)
        if most <= 1:
            break
    # A source's last open document goes to the nearer side: a bias of one document in exchange for half
    # the distance to the target.
    last = opened.withColumn("copies", F.col("copies") + (F.col("frac") >= 0.5).cast("long"))
    final = last
    for s in settled:
        final = final.unionByName(s)
    rows = leaves.where("not open").select("doc", "source", "size", "copies").unionByName(
        final.select("doc", "source", "size", "copies"))
    out = targets.select(F.col("source").alias("t_source"), "source_size", "target")
    return (rows.join(out, F.col("source").eqNullSafe(F.col("t_source")))
            .select("doc", "source", "size", "source_size", "target", "copies"))


def mix_sources(docs: DataFrame, weights: DataFrame | None = None, text_col: str = "text",
                source_col: str = "source", limit: float = 3.0, block: int = 512, seed: int = 7) -> DataFrame:
    """``docs`` repeated so that each source's words come near its target; columns stay as they are.

    ``weights`` (source, weight) defaults to 5, 2, 1 repeating over the sources by code point, null
    last. Null or empty texts have no words and whole copies only; a null source is a source like any
    other; repeated rows are rounded each for itself; an empty table stays empty.
    """
    named, row = with_row_id(docs, "mix-docs")
    names = written(named.select(*[col(c).alias(f"r{i}") for i, c in enumerate(row)], col(source_col).cast("string").alias("source"),
                                 word_count(col(text_col)).alias("size"), F.monotonically_increasing_id().alias("doc")), "mix-sizes")
    sizes = names.select("doc", "source", "size")
    if weights is None:
        weights = cycle_weights(sizes.select("source"))
    d = mix_decisions(sizes, weights, limit, block, seed).where("copies > 0").select("doc", F.col("copies").cast("int").alias("n"))
    n, k = fresh(named.columns, "copies"), fresh(named.columns, "copy")
    # Merge joins at every size: both lists grow with the documents, and files of row numbers are far smaller than their rows.
    d = written(names.select("doc", "r0", "r1").hint("merge").join(d, "doc")
                .select(*[F.col(f"r{i}").alias(c) for i, c in enumerate(row)], F.col("n").alias(n)), "mix-copies")
    return (named.join(d.hint("merge"), row).withColumn(k, F.explode(F.sequence(F.lit(1), col(n))))
            .select(*[col(c) for c in docs.columns]))
