"""Shared pieces: fresh column names, materialised row ids, vectorised word hashes of Arrow texts."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import new_work_dir

#: Word separators of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def fresh(columns: Iterable[str], base: str) -> str:
    """A column name based on ``base`` that clashes with none of ``columns`` (case-insensitive)."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base += "_"
    return base


def col(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written as Parquet to the shared scratch folder and read back: cuts the lineage, keeps
    column pruning, and gives retried tasks the very same rows."""
    path = new_work_dir(df.sparkSession, purpose) + "/t"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_row_id(df: DataFrame, purpose: str) -> tuple[DataFrame, list[str]]:
    """``df`` with columns that name each row, and their names: the hash of its file and its place in it if
    ``df`` reads files, without a copy; otherwise ids fixed by a written copy. Rows that repeat, or have a
    null id of their own, stay apart, and retried tasks see the same ids. A frame whose rows change from
    read to read (a limit, a random sample) must be written by the caller first."""
    file, row = fresh(df.columns, "row_file"), fresh(df.columns, "row_place")
    try:
        out = df.select("*", F.xxhash64("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row))
        return out, [file, row]
    except AnalysisException:  # not a plain scan of files that count their rows
        return (written(df.withColumn(file, F.lit(0).cast("long")).withColumn(row, F.monotonically_increasing_id()), purpose),
                [file, row])


# -- vectorised tokenising -------------------------------------------------------------------------

_SEGMENT = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_TABLES: dict = {}


def _tables():
    if not _TABLES:
        word = np.zeros(256, bool)
        word[0x80:] = True
        for a, b in (("0", "9"), ("A", "Z"), ("a", "z")):
            word[ord(a):ord(b) + 1] = True
        _TABLES["word"] = word
        _TABLES["pow"] = _powers(_BASE, _SEGMENT + 1)
        _TABLES["inv"] = _powers(np.uint64(pow(int(_BASE), -1, 1 << 64)), _SEGMENT + 1)
    return _TABLES


def _powers(base, n):
    p = np.full(n, base, np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


def mix(h):
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def utf8_parts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array without nulls."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_string(texts.type)
    off = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    return data[off[0]:off[-1]], off.astype(np.int64) - int(off[0])


def text_slices(texts: pa.Array, max_bytes: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``max_bytes`` of text each (one row at least), so that temporaries stay
    bounded whatever the batch size."""
    n = len(texts)
    if not n:
        return
    size = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)
    end = np.cumsum(size)
    i = 0
    while i < n:
        done = int(end[i - 1]) if i else 0
        j = max(i + 1, int(np.searchsorted(end, done + max_bytes, "right")))
        yield i, j
        i = j


def clean_strings(arr: pa.Array) -> pa.Array:
    return pc.fill_null(arr.cast(pa.large_string()), "")


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of lower-cased texts (runs of letters, digits and non-ASCII characters) as 64-bit hashes.

    Returns (hashes, word offsets per text, word start bytes, word end bytes); bytes count from the
    start of the lower-cased array's data. Each hash is a polynomial in the word's bytes taken from
    prefix sums, segment by segment, so a text of any length needs the same memory besides its words.
    """
    t = _tables()
    data, off = utf8_parts(pc.utf8_lower(clean_strings(texts)))
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    is_word = t["word"][data]
    first = is_word.copy()
    first[1:] &= ~is_word[:-1]
    inner = off[:-1][off[:-1] < n]
    first[inner] = is_word[inner]
    last = is_word.copy()
    last[:-1] &= ~is_word[1:]
    ends = off[1:][off[1:] > 0] - 1
    last[ends] = is_word[ends]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    h = np.empty(len(starts), np.uint64)
    w = 0
    while w < len(starts):
        base = int(starts[w])
        e = int(np.searchsorted(stops, base + _SEGMENT, "right"))
        if e <= w:  # one word longer than a segment
            h[w] = _long_word(data[base:stops[w]], t)
            w += 1
            continue
        part = data[base:stops[e - 1]].astype(np.uint64)
        part += np.uint64(1)
        part *= t["pow"][:len(part)]
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(part, out=sums[1:])
        a, b = starts[w:e] - base, stops[w:e] - base
        h[w:e] = (sums[b] - sums[a]) * t["inv"][a]
        w = e
    return mix(h), np.searchsorted(starts, off).astype(np.int64), starts, stops


def _long_word(data, t):
    total, scale = np.uint64(0), np.uint64(1)
    step = t["pow"][_SEGMENT]
    with np.errstate(over="ignore"):
        for i in range(0, len(data), _SEGMENT):
            part = (data[i:i + _SEGMENT].astype(np.uint64) + np.uint64(1)) * t["pow"][:min(_SEGMENT, len(data) - i)]
            total = total + part.sum(dtype=np.uint64) * scale
            scale = scale * step
    return total


def segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive ``offsets``; empty segments give 0."""
    out = np.zeros((len(offsets) - 1,) + values.shape[1:], values.dtype if values.dtype.kind == "f" else np.int64)
    full = offsets[1:] > offsets[:-1]
    if full.any():
        out[full] = np.add.reduceat(values, offsets[:-1][full], axis=0, dtype=out.dtype)
    return out
