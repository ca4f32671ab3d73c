"""Physical copies: table to external location (B8), CSV checkpoint (B18), flag split.

A copy is one scan and one write, with no shuffle: each task writes the files of the input split
it read. Partition columns are kept (``partitionBy``), and because the source is laid out by the
same columns, a split normally holds one partition value, so each task writes one file per
partition it touches. With ``spark.sql.maxConcurrentOutputFileWriters`` set (see
``session.RECOMMENDED_CONF``) the writer keeps those few files open instead of sorting the task's
rows. Bucketed tables keep their bucketing: every source file belongs to one bucket, so a task
reading a split of it writes into that one bucket only -- output files follow input splits, not
tasks x buckets, and no shuffle is needed. Failed tasks are retried by Spark and the commit
protocol publishes only complete task output, so a lost executor does not leave partial files in
the target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.catalog import describe_table, partition_columns


class TargetNotEmpty(RuntimeError):
    pass


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_path(spark, path)
    return bool(fs.exists(p))


def path_has_files(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists and holds anything (one directory listing, not a recursive one)."""
    try:
        fs, p = _hadoop_path(spark, path)
        return bool(fs.exists(p)) and len(fs.listStatus(p)) > 0
    except AttributeError:  # no JVM gateway (e.g. a remote session): fall back to a file listing
        try:
            return spark.read.format("binaryFile").load(path).select("path").limit(1).count() > 0
        except Exception:
            return False


def sql_text(v) -> str:
    """A SQL string literal."""
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _props_sql(props: dict) -> str:
    return ", ".join(f"{sql_text(k)} = {sql_text(v)}" for k, v in props.items())


def copy_table(spark: SparkSession, source: str, target: str, location: str, fmt: str | None = None,
               partition_by: list[str] | None = None, properties: dict | None = None,
               keep_layout: bool = True) -> list[str]:
    """Copy table ``source`` into a new external table ``target`` stored at ``location``.

    Kept from the source unless overridden: storage format (``fmt``), partition columns,
    bucketing and sort columns, storage options, table comment and table properties (plus any
    ``properties`` given). Bucketed output keeps later joins and aggregations on the bucket
    columns free of shuffles. Fails with ``TargetNotEmpty`` when the location already holds files
    (a leftover of an earlier failed copy is reported, never overwritten) and with Spark's own
    error when ``target`` exists. Returns the partition columns.
    """
    if path_has_files(spark, location):
        raise TargetNotEmpty(f"target location is not empty: {location}")
    info = describe_table(spark, source) if keep_layout or fmt is None else {}
    provider = info.get("provider")
    fmt = fmt or (provider if provider not in (None, "hive") else "parquet")
    parts = partition_by if partition_by is not None else partition_columns(spark, source)
    w = spark.table(source).write.format(fmt).options(**info.get("options", {})).option("path", location)
    w = w.mode("errorifexists")
    if parts:
        w = w.partitionBy(*parts)
    if keep_layout and info.get("num_buckets"):
        w = w.bucketBy(info["num_buckets"], *info["bucket_columns"])
        if info["sort_columns"]:
            w = w.sortBy(*info["sort_columns"])
    w.saveAsTable(target)
    props = dict(info.get("properties", {})) if keep_layout else {}
    if keep_layout and info.get("comment"):
        props["comment"] = info["comment"]
    props.update(properties or {})
    if props:
        spark.sql(f"ALTER TABLE {target} SET TBLPROPERTIES ({_props_sql(props)})")
    return parts


def copy_frame(df: DataFrame, location: str, fmt: str = "parquet", partition_by: list[str] | None = None,
               mode: str = "errorifexists") -> None:
    """Write a DataFrame to a path-only (catalog-free) copy."""
    w = df.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(location)


def read_back(spark: SparkSession, target: str, column_order: list[str]) -> DataFrame:
    """Target table with the source's column order (a partitioned write moves partition columns
    last)."""
    return spark.table(target).select(*[F.col(f"`{c}`") for c in column_order])


#: Every text is quoted and quotes are doubled; a null is an unquoted empty field.
CSV_OPTIONS = {"header": True, "quoteAll": True, "quote": '"', "escape": '"', "nullValue": "\\N", "emptyValue": "",
               "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "lineSep": "\n",
               "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", single_file: bool = False) -> None:
    """CSV with a header. Parallel part files by default; ``single_file`` funnels the rows through
    one task and is meant for small reports only. ``read_csv`` gives the same values back: line breaks,
    blanks around a text, quotes, backslashes, empty texts and nulls all survive."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """What ``write_csv`` wrote. Files are read whole by one task each, since a quoted text may span lines;
    the writer's part files keep them to a task's size."""
    return spark.read.options(**CSV_OPTIONS, multiLine=True).schema(schema).csv(path)


ROUTE_PII, ROUTE_NONPII = "pii", "nonpii"


def route_column(flag) -> F.Column:
    """``nonpii`` only for a definite false; true *or unknown* goes to the PII side."""
    f = F.col(flag) if isinstance(flag, str) else flag
    return F.when(f == F.lit(False), F.lit(ROUTE_NONPII)).otherwise(F.lit(ROUTE_PII))


def split_by_flag(df: DataFrame, flag, location: str, fmt: str = "parquet", route_col: str = "route",
                  mode: str = "errorifexists") -> DataFrame:
    """Write the rows of one table into ``location/route=pii`` and ``location/route=nonpii`` in one
    job (no shuffle) and return the written data read back."""
    out = df.withColumn(route_col, route_column(flag))
    out.write.format(fmt).mode(mode).partitionBy(route_col).save(location)
    return df.sparkSession.read.format(fmt).load(location)
