"""Hard-negative mining with score bounds along spanning trees of the anchors.

**Bounds.** For an anchor a, its parent p in a spanning tree and a candidate c,
``|a.c - p.c| <= |a - p| |c|``: the parent's score plus or minus the edge's length times the candidate's norm
bounds the child's. Going down a minimum spanning tree of a group of anchors, each candidate carries an
interval of possible scores; where the interval overlaps none of the anchor's score windows the candidate
is passed by (and keeps its interval, which the next edge widens), otherwise its exact score is taken,
which makes the interval a point again. Vectors are integers, so scores are exact.

**Two searches.** The first finds each anchor's positives: its window is open above and begins at the least
score that can still matter, that of the last of the best positives among the first candidates of its label.
Their scores give the windows of the second search, for negatives.

**Scale.** Anchors travel in groups of ``group`` rows with their tree (neighbours by random hyperplanes
come into one group, so edges stay short), candidates in blocks of ``block`` rows. Every group meets every
block in a grid: ``columns`` sets of candidate blocks by ``bands`` sets of groups, each cell one bounded task,
so blocks travel once per band and groups once per column. Each cell returns a few best rows per anchor,
and what is merged at the end per anchor grows with the number of columns only.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import col, fresh, written
from .whitening import integer_vectors, matrix

_CELLS = ["ids", "labels", "rows", "vectors", "extra"]
_PLANES = 24


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum spanning tree of the rows (Prim): (order of visit, parent of each row, edge to the parent). The
    first in order is the root: its own parent, with an edge of infinite length."""
    n = len(x)
    norms = (x * x).sum(axis=1)
    parent, near, done = np.zeros(n, np.int64), np.full(n, np.inf), np.zeros(n, bool)
    order = np.zeros(n, np.int64)
    edge = np.full(n, np.inf)
    at = 0
    for k in range(n):
        order[k], done[at] = at, True
        d = np.sqrt(np.maximum(norms + norms[at] - 2 * (x @ x[at]), 0))
        closer = ~done & (d < near)
        near[closer], parent[closer] = d[closer], at
        if k + 1 < n:
            left = np.flatnonzero(~done)
            at = int(left[np.argmin(near[left])])
            edge[at] = near[at]
    return order, parent, edge


class Group:
    """Anchors of a group, in the tree's order, each after its parent."""

    def __init__(self, ids, labels, rows, x: np.ndarray, extra: np.ndarray):
        order, parent, edge = spanning_tree(x)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.ids, self.labels, self.rows, self.x = ids[order], labels[order], rows[order], x[order]
        self.parent, self.edge, self.extra = place[parent[order]], edge[order], extra[order]

    def scores(self, block: np.ndarray, windows):
        """For each anchor: (its place, candidates whose score may lie in a window, their exact scores).
        ``windows(place)`` gives (mask of candidates, list of (low, high)); the others are not rescored."""
        norms = np.sqrt((block * block).sum(axis=1))
        low, high = {}, {}
        last_child = {int(p): k for k, p in enumerate(self.parent)}
        for k in range(len(self.ids)):
            p = int(self.parent[k])
            if k == 0:
                lo, hi = np.full(len(block), -np.inf), np.full(len(block), np.inf)
            else:
                slack = self.edge[k] * norms * (1 + 1e-9) + 1
                lo, hi = low[p] - slack, high[p] + slack
            mine, ranges = windows(k)
            meets = np.zeros(len(block), bool)
            for a, b in ranges:
                meets |= (hi >= a) & (lo <= b)
            # The root's scores start all intervals.
            exact = np.arange(len(block)) if k == 0 and len(self.ids) > 1 else np.flatnonzero(meets & mine)
            s = (block @ self.x[k])[exact] if 2 * len(exact) > len(block) else block[exact] @ self.x[k]
            lo[exact] = hi[exact] = s
            if last_child.get(k, k) > k:
                low[k], high[k] = lo, hi
            if last_child[p] == k and p in low and p != k:
                del low[p], high[p]
            keep = (meets & mine)[exact]
            yield k, exact[keep], s[keep]


def merge_ranges(ranges: list) -> list:
    """The union of closed ranges, those that are empty left out."""
    out: list = []
    for a, b in sorted(r for r in ranges if r[0] <= r[1]):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def first_rows(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` first: higher scores, then smaller ids, then smaller row numbers."""
    if len(scores) > n:
        some = np.flatnonzero(scores >= np.partition(scores, len(scores) - n)[len(scores) - n])
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((rows[some], ids[some], -scores[some]))[:n]]


def _packed(rows: DataFrame, dims: int, size: int) -> DataFrame:
    """Rows (id, label, row, x, more) packed by task into named blocks of at most ``size`` rows."""
    def run(batches):
        held, count, number = [], 0, 0

        def out(table):
            cells = [np.ascontiguousarray(table.column(c).to_numpy().astype(np.int64)) for c in ("id", "label", "row")]
            cells.append(matrix(table.column("x"), dims).astype(np.float64))
            cells.append(table.column("more").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64))
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), *[pa.array([c.tobytes()]) for c in cells]],
                                              names=["number", *_CELLS])

        for b in batches:
            while b.num_rows:
                take = min(size - count, b.num_rows)
                held.append(b.slice(0, take))
                count, b = count + take, b.slice(take)
                if count == size:
                    yield out(pa.Table.from_batches(held))
                    held, count, number = [], 0, number + 1
        if held:
            yield out(pa.Table.from_batches(held))

    packed = rows.select("id", "label", "row", "x", "more").mapInArrow(run, "number int, " + ", ".join(f"{c} binary" for c in _CELLS))
    return packed.withColumn("name", F.struct(F.spark_partition_id(), "number")).drop("number")


def _unpacked(table: pa.Table, dims: int):
    for r in table.select(_CELLS).to_pylist():
        ids, labels, rows = (np.frombuffer(r[c], np.int64) for c in _CELLS[:3])
        yield ids, labels, rows, np.frombuffer(r["vectors"]).reshape(-1, dims), np.frombuffer(r["extra"], np.int64).reshape(len(ids), -1)


def _grid(groups: DataFrame, blocks: DataFrame, bands: int, columns: int, run, schema: str) -> DataFrame:
    """``run(groups, blocks)`` on every cell of the grid."""
    g = groups.withColumn("band", F.pmod(F.xxhash64("name"), F.lit(bands)).cast("int")).withColumn(
        "column", F.explode(F.sequence(F.lit(0), F.lit(columns - 1))))
    b = blocks.withColumn("column", F.pmod(F.xxhash64("name"), F.lit(columns)).cast("int")).withColumn(
        "band", F.explode(F.sequence(F.lit(0), F.lit(bands - 1))))
    return g.groupBy("band", "column").cogroup(b.groupBy("band", "column")).applyInArrow(run, schema)


def _best(found: DataFrame, keys: list, n: int) -> DataFrame:
    first = Window.partitionBy(*keys).orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= n)


def hard_negatives(df: DataFrame, id_col: str, label_col: str, vector_col: str, anchor_col: str, positives: int = 5,
                   negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256, group: int = 256,
                   block: int = 4096, column_bytes: int = 32 << 20, band_bytes: int = 16 << 20) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for every row whose
    ``anchor_col`` is true and each of its ``positives`` best other rows of the same label, the ``negatives`` best
    rows of other labels with ``low * positive_score <= 100 * negative_score <= high * positive_score``. A score
    is the inner product of the vectors floor(scale * component); ties go to the smaller id, then to the
    row read first.

    Rows take no part if their id, label or vector is null or their vector is empty or holds null or
    non-finite components; a null ``anchor_col`` is false. Repeated rows and ids are rows of their own: each
    can be positive, negative or anchor, only the anchor's own row is left out. An empty table, one label
    alone, or an anchor without other rows of its label give no rows. Ids and labels are integers; extra
    columns don't matter. Vectors of different lengths, or so long that scores pass 2^53, are an error.
    """
    spark = df.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    x = fresh(df.columns, "x")
    rows = written(df.withColumn(x, integer_vectors(col(vector_col), scale)).where(
        col(x).isNotNull() & col(id_col).isNotNull() & col(label_col).isNotNull()).select(
        col(id_col).cast("long").alias("id"), col(label_col).cast("long").alias("label"),
        F.monotonically_increasing_id().alias("row"), F.coalesce(col(anchor_col), F.lit(False)).alias("anchor"),
        col(x).alias("x")), "negatives-rows")
    size = rows.agg(F.min(F.size("x")).alias("a"), F.max(F.size("x")).alias("b"), F.count(F.lit(1)).alias("n"),
                    F.count_if("anchor").alias("anchors"),
                    F.max(F.aggregate("x", F.lit(0.0), lambda a, c: a + c.cast("double") * c)).alias("square")).first()
    if size["a"] != size["b"]:
        raise ValueError(f"vectors of {size['a']} to {size['b']} components")
    if (size["square"] or 0) >= 1 << 53:  # |a.c| and all partial sums are at most the larger square
        raise ValueError("vectors are too long for exact scores")
    if not size["anchors"]:
        return spark.createDataFrame([], schema)
    dims = size["a"]
    columns = max(math.ceil(size["n"] * dims * 8 / column_bytes), min(16, math.ceil(size["n"] / block)))
    bands = math.ceil(size["anchors"] * dims * 8 / band_bytes)

    none = F.array().cast("array<bigint>")
    blocks = written(_packed(rows.withColumn("more", none), dims, block), "negatives-blocks")

    # Anchors in the order of their sides of random hyperplanes, so that a group holds neighbours.
    planes = np.random.default_rng(11).standard_normal((_PLANES, dims))

    def sides(batches):
        for b in batches:
            v = matrix(b.column(3), dims) @ planes.T > 0
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(v @ (1 << np.arange(_PLANES)))],
                                             names=["id", "label", "row", "x", "more", "side"])

    def grouped(anchors: DataFrame, purpose: str) -> DataFrame:
        sided = anchors.select("id", "label", "row", "x", "more").mapInArrow(
            sides, "id long, label long, row long, x array<bigint>, more array<bigint>, side long")
        parts = math.ceil(size["anchors"] / (16 * group))
        return written(_packed(sided.repartitionByRange(parts, "side", "row").sortWithinPartitions("side", "row"), dims, group), purpose)

    anchors = rows.where("anchor").withColumn("more", none)
    nothing = (np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64))

    def merged(best, s, ids, numbers, n):
        s, i, r = (np.concatenate(c) for c in zip(best, (s, ids, numbers)))
        top = first_rows(s, i, r, n)
        return s[top], i[top], r[top]

    def table(names, parts):
        cells = [np.concatenate(c).astype(np.int64) for c in zip(*parts)] or [np.zeros(0, np.int64)] * len(names)
        return pa.table({k: pa.array(c, pa.int64()) for k, c in zip(names, cells)})

    def find_positives(left: pa.Table, right: pa.Table) -> pa.Table:
        out, candidates = [], list(_unpacked(right, dims))
        for g in (Group(*u) for u in _unpacked(left, dims)):
            best = [nothing] * len(g.ids)
            for ids, labels, numbers, vectors, _ in candidates:
                def windows(k):
                    mine = (labels == g.labels[k]) & (numbers != g.rows[k])
                    least = best[k][0][-1] if len(best[k][0]) == positives else -np.inf
                    first = np.flatnonzero(mine)[:8 * positives]
                    if len(first) >= positives:
                        least = max(least, np.sort(vectors[first] @ g.x[k])[-positives])
                    return mine, [(least, np.inf)]

                for k, at, s in g.scores(vectors, windows):
                    best[k] = merged(best[k], s, ids[at], numbers[at], positives)
            out += [(np.full(len(s), g.rows[k]), i, r, s) for k, (s, i, r) in enumerate(best)]
        return table(["anchor_row", "id", "row", "score"], out)

    found = _grid(grouped(anchors, "negatives-anchors"), blocks, bands, columns, find_positives,
                  "anchor_row long, id long, row long, score long")
    # Of each positive: its id, its score, and the least and greatest score of its negatives (none if least is greater).
    score = F.col("score")
    window = F.array("id", "score", F.ceil(score * low / F.lit(100).cast("decimal(3,0)")).cast("long"),
                     F.floor(score * high / F.lit(100).cast("decimal(3,0)")).cast("long"))
    best = _best(found, ["anchor_row"], positives).groupBy("anchor_row").agg(
        F.sort_array(F.collect_list(F.struct("rank", window.alias("w")))).alias("best"))
    empty = F.array(*[F.lit(v).cast("long") for v in (0, 0, 1, 0)])
    more = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(positives - 1)), lambda i: F.coalesce(F.get("best.w", i), empty)))
    seekers = rows.where("anchor").join(best, F.col("row") == F.col("anchor_row")).withColumn("more", more)

    def find_negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        out, candidates = [], list(_unpacked(right, dims))
        for g in (Group(*u) for u in _unpacked(left, dims)):
            wanted = g.extra.reshape(len(g.ids), positives, 4)
            best = [[nothing] * positives for _ in g.ids]
            for ids, labels, numbers, vectors, _ in candidates:
                def ranges(k):
                    for (_, _, a, b), held in zip(wanted[k], best[k]):
                        yield (max(a, held[0][-1]) if len(held[0]) == negatives else a), b

                def windows(k):
                    return labels != g.labels[k], merge_ranges(list(ranges(k)))

                for k, at, s in g.scores(vectors, windows):
                    for p, (a, b) in enumerate(list(ranges(k))):
                        inside = np.flatnonzero((s >= a) & (s <= b))
                        if len(inside):
                            best[k][p] = merged(best[k][p], s[inside], ids[at[inside]], numbers[at[inside]], negatives)
            for k in range(len(g.ids)):
                for p, (s, i, r) in enumerate(best[k]):
                    same = [np.full(len(s), v) for v in (g.ids[k], g.rows[k], p, wanted[k][p][0], wanted[k][p][1])]
                    out.append((*same, i, r, s))
        return table(["anchor_id", "anchor_row", "place", "positive_id", "positive_score", "id", "row", "score"], out)

    found = _grid(grouped(seekers, "negatives-seekers"), blocks, bands, columns, find_negatives,
                  "anchor_id long, anchor_row long, place long, positive_id long, positive_score long, id long, row long, score long")
    return _best(found, ["anchor_row", "place"], negatives).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
