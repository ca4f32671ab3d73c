"""File listings made by tasks: directories are dealt to tasks, level by level, so no file name reaches the driver.

Spark's own file index lists in parallel too but gathers every file's status in the driver. Here a level of
directories is a DataFrame; each task lists its directories through PyArrow's file systems (local, HDFS, S3,
GCS, ABFS), files become rows, and sub-directories are the next level. The driver sees how many there are.
"""

from __future__ import annotations

import math
import re
import sys
from functools import reduce
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import pinned

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the library

_SCHEMA = "label string, path string, size long, modified long, is_dir boolean"
_ARROW = pa.schema([("label", pa.string()), ("path", pa.string()), ("size", pa.int64()), ("modified", pa.int64()), ("is_dir", pa.bool_())])
#: Directories that one task lists.
_PER_TASK = 16


def _open(uri: str):
    """(file system, path in it, what stands before a path in its URI). A path without a scheme is local."""
    from pyarrow import fs

    parts = urlsplit(uri)
    if len(parts.scheme) < 2 or parts.scheme == "file":
        return fs.LocalFileSystem(), unquote(parts.path) if parts.scheme == "file" else uri, "file:"
    system, path = fs.FileSystem.from_uri(uri)
    host = f"{parts.scheme}://{parts.netloc}"
    return system, path, host if path.startswith("/") else f"{parts.scheme}://"


def hidden(name: str) -> bool:
    """Names that Spark's readers pass over."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _list(label: str, uri: str):
    from pyarrow import fs

    system, path, before = _open(uri)
    own = system.get_file_info(path)
    found = [own] if own.type == fs.FileType.File else system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    for f in found:
        if f.type in (fs.FileType.File, fs.FileType.Directory) and (f is own or not hidden(f.base_name)):
            time = f.mtime_ns // 1000 if f.mtime_ns is not None else None
            yield label, before + f.path, f.size if f.is_file else 0, time, not f.is_file


def listable(uri: str) -> bool:
    """Whether tasks can list ``uri``: its file system is one of PyArrow's."""
    try:
        _open(uri)
        return True
    except Exception:  # noqa: BLE001 - an unknown scheme, or a library that is not installed
        return False


def list_files(spark: SparkSession, roots: list[tuple[str, str]]) -> DataFrame:
    """(label, path, size, modified in microseconds) of every file under the (label, path) roots, hidden ones left
    out as Spark's readers leave them out; a root may be a file, and one that doesn't exist has none."""
    def run(batches):
        for b in batches:
            rows = [r for label, uri in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for r in _list(label, uri)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_ARROW)], schema=_ARROW)

    level, n = spark.createDataFrame(sorted(set(roots)), "label string, path string"), len(roots)
    found = []
    while n:
        listed, _ = pinned(level.repartition(math.ceil(n / _PER_TASK)).mapInArrow(run, _SCHEMA), "list")
        found.append(listed.where("not is_dir").drop("is_dir"))
        level = listed.where("is_dir").select("label", "path")
        n = level.count()
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], _SCHEMA).drop("is_dir")


def table_locations(spark: SparkSession, name: str) -> list[str] | None:
    """Where a table of the session catalog keeps its files: its location, and those of partitions stored
    elsewhere; None for views, other catalogs, and file systems that tasks can't list."""
    try:
        session = spark._jsparkSession.sessionState()
        ident = session.sqlParser().parseTableIdentifier(name)
        meta = session.catalog().getTableMetadata(ident)
        if meta.storage().locationUri().isEmpty():
            return None
        out = [meta.location().toString()]
        if meta.partitionColumnNames().nonEmpty() and meta.tracksPartitionsInCatalog():
            none = spark.sparkContext._jvm.scala.Option.apply(None)
            parts = session.catalog().listPartitions(ident, none).iterator()
            plain = lambda uri: re.sub("^file:/+", "/", uri)  # noqa: E731 - file:/x and file:///x are one place
            base = plain(out[0]).rstrip("/") + "/"
            while parts.hasNext():  # partitions are metadata: one catalog entry each
                uri = parts.next().location().toString()
                if not plain(uri).startswith(base):
                    out.append(uri)
        return out if all(map(listable, out)) else None
    except Exception:  # noqa: BLE001 - the caller lists what the table's own scan reads
        return None
