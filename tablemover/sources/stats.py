"""Row counts and storage sizes of tables.

Bytes, files and modification times come from a listing of the table's files, without opening them; rows
from one plain count over a scan that reads no data columns, only when asked for. Tables given with their
locations are listed by tasks (``sources.listing``), all of a chunk together; frames without a known location
by the files that their scan reads. Views have no files: their bytes and files are null, not zero.
"""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.estimate import BYTES_PER_MB
from .listing import list_files, table_locations


def _files(df: DataFrame, label: str) -> DataFrame | None:
    """(table_name, path, size, time) of the files a scan of ``df`` reads; None without files."""
    names = [unquote(f) for f in df.inputFiles()]
    if not names:
        return None
    # A listing: the content column isn't asked for, so no file is opened.
    listed = df.sparkSession.read.format("binaryFile").load(names)
    return listed.select(F.lit(label).alias("table_name"), F.col("path").alias("_p"), F.col("length").alias("_s"),
                         F.unix_micros("modificationTime").alias("_t"))


def _stats_of(tables: dict[str, DataFrame], no_files: set[str], rows: bool, locations: dict[str, list[str]]) -> DataFrame:
    """Statistics of several tables: one grouped count over all of them, one aggregate over their file
    lists (a row per file), put together by label; the labels are the broadcast side."""
    spark = next(iter(tables.values())).sparkSession
    out = F.broadcast(spark.createDataFrame([(n,) for n in tables], "table_name string"))
    if rows:
        counts = reduce(DataFrame.unionAll, [df.select(F.lit(n).alias("table_name")) for n, df in tables.items()])
        out = out.join(counts.groupBy("table_name").agg(F.count(F.lit(1)).alias("row_count")), "table_name", "left")
        out = out.withColumn("row_count", F.coalesce("row_count", F.lit(0)).cast("long"))
    else:
        out = out.withColumn("row_count", F.lit(None).cast("long"))
    located = {n: locations[n] for n in tables if n not in no_files and locations.get(n)}
    lists = [x for x in (_files(df, n) for n, df in tables.items() if n not in no_files and n not in located) if x is not None]
    if located:
        lists.append(list_files(spark, [(n, p) for n, paths in located.items() for p in paths]).select(
            F.col("label").alias("table_name"), F.col("path").alias("_p"), F.col("size").alias("_s"), F.col("modified").alias("_t")))
    if not lists:
        return out.select("table_name", "row_count", *[F.lit(None).cast(t).alias(c) for c, t in (
            ("bytes", "long"), ("files", "long"), ("fingerprint", "string"), ("size_mb", "double"))])
    # The file set as one text: count, bytes, newest modification time (in microseconds) and an
    # order-free hash of each file's path, size and time -- any file added, removed or rewritten changes it.
    fingerprint = F.concat_ws(":", F.count("_p").cast("string"), F.sum("_s").cast("string"), F.max("_t").cast("string"),
                              F.sum(F.xxhash64("_p", "_s", "_t").cast("decimal(38,0)")).cast("string"))
    agg = reduce(DataFrame.unionAll, lists).groupBy("table_name").agg(
        F.sum("_s").cast("long").alias("bytes"), F.count("_p").cast("long").alias("files"), fingerprint.alias("fingerprint"))
    # A located table without files has 0 bytes, and a fingerprint that differs from that of any file.
    empty = F.col("bytes").isNull() & F.col("table_name").isin(list(located))
    agg = out.join(agg, "table_name", "left")
    for c, none in (("fingerprint", F.lit("0")), ("files", F.lit(0).cast("long")), ("bytes", F.lit(0).cast("long"))):
        agg = agg.withColumn(c, F.when(empty, none).otherwise(F.col(c)))
    return agg.select(
        "table_name", "row_count", "bytes", "files", "fingerprint",
        (F.col("bytes").cast("double") / F.lit(BYTES_PER_MB)).alias("size_mb"))


STATS_SCHEMA = ("table_name string, row_count long, bytes long, files long, fingerprint string, size_mb double, "
                "error string")


def table_stats(tables: dict[str, DataFrame], chunk: int = 256, no_files: set[str] | list[str] = (),
                errors: str = "raise", rows: bool = True, locations: dict[str, list[str]] | None = None) -> DataFrame:
    """``(table_name, row_count, bytes, files, fingerprint, size_mb)`` per table, in few jobs. Names in
    ``no_files`` (views) get counts only; ``rows=False`` leaves the counts out (null) and reads no table.
    ``locations`` says where tables keep their files (``listing.table_locations``): those are listed by tasks.

    ``errors="isolate"`` runs the chunks eagerly (one small row per table comes back) and, when a
    chunk fails, runs its tables one by one, so an unreadable table yields an ``error`` text
    instead of failing the whole inventory; the result then has an extra ``error`` column.
    """
    nf = set(no_files)
    names = list(tables)
    if not names:
        raise ValueError("no tables")

    def stats(group: list[str]) -> DataFrame:
        return _stats_of({n: tables[n] for n in group}, nf, rows, locations or {})

    groups = [names[i:i + chunk] for i in range(0, len(names), chunk)]
    if errors != "isolate":
        return reduce(DataFrame.unionAll, [stats(g) for g in groups])
    got = []
    for g in groups:
        try:
            got += [tuple(r) + (None,) for r in stats(g).collect()]
        except Exception:  # noqa: BLE001 - find the broken table(s) of this chunk
            for n in g:
                try:
                    got += [tuple(r) + (None,) for r in stats([n]).collect()]
                except Exception as e:  # noqa: BLE001
                    got.append((n, None, None, None, None, None, str(e).strip() or repr(e)))
    spark = tables[names[0]].sparkSession
    return spark.createDataFrame(got, STATS_SCHEMA)


def catalog_table_stats(spark: SparkSession, names: list[str], chunk: int = 32, errors: str = "raise") -> DataFrame:
    """Stats of catalog tables by name; with ``errors="isolate"`` a table that cannot even be
    resolved gets an error row too."""
    tables, views, failed, locations = {}, set(), [], {}
    for n in names:
        try:
            if spark.catalog.getTable(n).tableType == "VIEW":
                views.add(n)
            tables[n] = spark.table(n)
            locations[n] = None if n in views else table_locations(spark, n)
        except Exception as e:  # noqa: BLE001
            if errors != "isolate":
                raise
            failed.append((n, None, None, None, None, None, str(e).strip() or repr(e)))
    out = table_stats(tables, chunk, views, errors, locations=locations) if tables else None
    if errors != "isolate":
        return out
    bad = spark.createDataFrame(failed, STATS_SCHEMA)
    return bad if out is None else out.unionByName(bad)

