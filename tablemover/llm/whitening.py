"""Embedding whitening over distinct vectors with weighted multiplicity covariance.

**Distinct vectors.** Rows become integer vectors, and identical ones are one group with a count: every
numeric step below runs once per distinct vector, whatever the number of its copies. The fit weights are
the counts (``weights="count"``: the covariance of all rows) or one per distinct vector (``"one"``).

**Covariance.** Means are exact (integer sums). Each task centres its vectors, multiplies
``(w * c)^T c`` into one d x d matrix and gives its upper triangle as rows; their sum over tasks, at most
``partials`` of them, is all that is added up, and d x d numbers are all that reaches the driver.
Centring takes off the integer part of the mean before its fraction, so nothing is lost to the size of
the integers.

**Whitening.** Eigenvectors of the covariance, by falling eigenvalue, divided by the root of the
eigenvalue: a d x k matrix that travels with the tasks. Each distinct vector is whitened once.

**Join back.** Rows find their vector's result by the vector itself. Vectors that hold more than one in
``hot_share`` of all rows, fewer than ``hot_share`` by construction, are broadcast, so that copies of one
vector are never gathered in one task; the others are joined by a shuffle.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DecimalType, DoubleType

from .common import col, fresh, written

_LARGEST = 1 << 40


def integer_vectors(vector: Column, scale: int, shift: int = 0) -> Column:
    """``floor(scale * c) + shift`` of every component as array<long>; null unless the vector has components
    and all of them are finite."""
    finite = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False)))
    return F.when(finite & (F.size(vector) > 0), F.transform(
        vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("long") + F.lit(shift).cast("long")))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list array of ``dims`` numbers each."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(flat) != dims * len(column):
        raise ValueError(f"vectors must all have {dims} components")
    return flat.reshape(len(column), dims)


def weighted_sums(frame: DataFrame, vec: str, weight: str, dims: int) -> list:
    """Sums of weight * component by dimension, exact for integers: ``dims`` numbers."""
    whole = dict(frame.dtypes)[vec] == "array<bigint>"
    kind = "decimal(38,0)" if whole else "double"

    def run(batches):
        total = [0] * dims
        for b in batches:
            x, w = matrix(b.column(0), dims), b.column(1).to_numpy()
            if whole:
                most = int(np.abs(x).max(initial=0))
                if most >= _LARGEST:
                    raise ValueError("vector components are too large")
                if most * int(w.sum()) >= 1 << 63:
                    x, w = x.astype(object), w.astype(object)
            total = [t + (int(p) if whole else float(p)) for t, p in zip(total, (x * w[:, None]).sum(axis=0))]
        values = pa.array([Decimal(t) for t in total], pa.decimal128(38, 0)) if whole else pa.array(total, pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), values], names=["dim", "part"])

    parts = frame.select(col(vec), col(weight)).mapInArrow(run, f"dim int, part {kind}")
    got = {r["dim"]: r["s"] for r in parts.groupBy("dim").agg(F.sum("part").alias("s")).collect()}
    return [(int if whole else float)(got.get(k) or 0) for k in range(dims)]


def split_mean(sums: list, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The mean as (whole part, fraction): subtracting them one after the other loses no digits."""
    if all(isinstance(s, int) for s in sums):
        return np.array([s // n for s in sums], np.int64), np.array([(s % n) / n for s in sums])
    return np.zeros(len(sums), np.int64), np.array(sums) / n


def weighted_covariance(frame: DataFrame, vec: str, weight: str, dims: int, sums: list, n: int,
                        partials: int = 4096) -> np.ndarray:
    """Covariance over the weighted vectors, divisor ``n``, centred before multiplying."""
    base, rest = split_mean(sums, n)
    upper = np.triu_indices(dims)

    def run(batches):
        total = np.zeros((dims, dims))
        for b in batches:
            x, w = matrix(b.column(0), dims), b.column(1).to_numpy().astype(float)
            for a in range(0, len(x), 1 << 13):
                c = (x[a:a + (1 << 13)] - base) - rest
                total += (c * w[a:a + (1 << 13), None]).T @ c
        yield pa.RecordBatch.from_arrays(
            [pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()), pa.array(total[upper])], names=["i", "j", "part"])

    parts = frame.select(col(vec), col(weight)).coalesce(partials).mapInArrow(run, "i int, j int, part double")
    out = np.zeros((dims, dims))
    for r in parts.groupBy("i", "j").agg(F.sum("part").alias("s")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["s"] / n
    return out


def components_of(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(eigenvalues falling, unit eigenvectors as columns, trace): at most ``most``, without those that are
    zero to double precision, which cannot be whitened."""
    e, v = np.linalg.eigh(covariance)
    order = np.argsort(-e, kind="stable")[:most]
    trace = float(np.trace(covariance))
    order = order[e[order] > 1e-13 * len(e) * max(trace, 0.0)]
    return e[order], v[:, order], trace


def whiten(df: DataFrame, id_cols: list[str], vector_col: str = "embedding", scale: int = 64, shift: int = 1_000_000,
           components: int = 32, weights: str = "count", hot_share: int = 1024) -> DataFrame:
    """One row per row of ``df`` with a usable vector: ``id_cols``, ``n`` (the fit weights' sum), ``deviation``
    (decimal, the exact sum over dimensions of ``(n x - S)^2``), ``whitened`` (array of at most ``components``
    doubles), ``explained`` (array: eigenvalue over trace) and ``identity_error``.

    Rows whose vector is null, empty, or holds null or non-finite components are dropped. Null ids are
    carried; repeated rows each give a row; extra columns don't matter, and result names that clash with
    ``id_cols`` get a trailing underscore. An empty table gives an empty frame. If all vectors are equal, or
    span fewer dimensions than ``components``, only the dimensions that vary are whitened (none: empty
    arrays). Vectors of different lengths, or with components of 2^40 and more, are an error.
    """
    if weights not in ("count", "one"):
        raise ValueError(f"unknown weights {weights!r}")
    spark = df.sparkSession
    names = {x: fresh(id_cols, x) for x in ("n", "deviation", "whitened", "explained", "identity_error")}
    x = fresh(id_cols, "x")
    rows = (df.select(*[col(c) for c in id_cols], integer_vectors(col(vector_col), scale, shift).alias(x))
            .where(col(x).isNotNull()))
    distinct = written(rows.groupBy(col(x).alias("x")).agg(F.count(F.lit(1)).alias("times")), "whiten-distinct")
    size = distinct.agg(F.min(F.size("x")).alias("a"), F.max(F.size("x")).alias("b"), F.sum("times").alias("rows"),
                        F.count(F.lit(1)).alias("distinct")).first()
    if size["a"] != size["b"]:
        raise ValueError(f"vectors of {size['a']} to {size['b']} components")
    dims, n_rows = size["a"] or 0, size["rows"] or 0
    fit = distinct.withColumn("w", F.col("times") if weights == "count" else F.lit(1).cast("long"))
    n = int(n_rows if weights == "count" else size["distinct"])
    out_schema = (df.select(*[col(c) for c in id_cols]).schema.add(names["n"], "long").add(names["deviation"], DecimalType(38, 0))
                  .add(names["whitened"], ArrayType(DoubleType())).add(names["explained"], ArrayType(DoubleType()))
                  .add(names["identity_error"], "double"))
    if not n:
        return spark.createDataFrame([], out_schema)

    sums = weighted_sums(fit, "x", "w", dims)
    values, vectors, trace = components_of(weighted_covariance(fit, "x", "w", dims, sums, n), components)
    base, rest = split_mean(sums, n)
    left = np.array([s - n * int(q) for s, q in zip(sums, base)], np.int64)
    project = vectors / np.sqrt(values) if len(values) else np.zeros((dims, 0))
    k = project.shape[1]

    def run(batches):
        for b in batches:
            v = matrix(b.column(0), dims)
            off = v - base
            white = (off - rest) @ project
            most = (int(np.abs(off).max(initial=0)) + 1) * n
            if dims * most * most < 1 << 63:
                d = n * off - left
                deviation = pa.array((d * d).sum(axis=1)).cast(pa.decimal128(38, 0))
            else:
                d = off.astype(object) * n - left.astype(object)
                deviation = pa.array([Decimal(int(t)) for t in (d * d).sum(axis=1)], pa.decimal128(38, 0))
            offsets = pa.array(np.arange(0, k * (len(v) + 1), k) if k else np.zeros(len(v) + 1, np.int32), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), deviation, pa.ListArray.from_arrays(offsets, pa.array(white.ravel()))],
                names=["x", "times", "w", "deviation", "whitened"])

    done = written(fit.mapInArrow(run, "x array<bigint>, times long, w long, deviation decimal(38,0), whitened array<double>"),
                   "whiten-done")
    error = 0.0
    if k:
        white_sums = weighted_sums(done, "whitened", "w", k)
        error = float(np.abs(weighted_covariance(done, "whitened", "w", k, white_sums, n) - np.eye(k)).max())

    result = done.select(F.col("x").alias(x), "times", F.col("deviation").alias(names["deviation"]),
                         F.col("whitened").alias(names["whitened"]))
    hot = F.col("times") * hot_share > n_rows  # fewer than hot_share vectors
    first = rows.join(F.broadcast(result.where(hot).drop("times")), [x], "left")
    missing = col(names["whitened"]).isNull()
    rest = first.where(missing).select(*[col(c) for c in id_cols], col(x)).join(result.where(~hot).drop("times"), [x])
    share = F.array(*[F.lit(float(v / trace)) for v in values]).cast("array<double>")
    parts = [f.select(*[col(c) for c in id_cols], F.lit(n).cast("long").alias(names["n"]), col(names["deviation"]),
                      col(names["whitened"]), share.alias(names["explained"]), F.lit(error).alias(names["identity_error"]))
             for f in (first.where(~missing), rest)]
    return parts[0].unionByName(parts[1])
