"""Inventory of a metastore (B3): one listing per database, parsed in Spark.

``SHOW TABLE EXTENDED IN db LIKE '*'`` returns type, provider, location, partition columns and
view text of every object of a database in one call, so the inventory costs one catalog call per
database instead of one ``DESCRIBE`` (plus one existence test) per table. The text is parsed with
``regexp_extract``; ``object_type`` comes from the catalog's own table type, never from a
``col_name = 'Type'`` match that a column called ``Type`` could fake.
"""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.select import parse_name_list

log = logging.getLogger(__name__)

INVENTORY_COLUMNS = ["catalog", "database", "name", "object_type", "provider", "location",
                     "partition_columns", "view_text", "upgraded_to"]

# Fixed value: the table property that marks a source table as migrated, and names its target.
UPGRADED_TO = "upgraded_to"


def list_databases(spark: SparkSession, schemas: str | list[str] | None = "all",
                   exclude_schemas: str | list[str] | None = None) -> list[str]:
    """Database names: all of them (``"all"``/None) or the given list, minus the excluded ones (names are
    compared without case, as the catalog does), in name order."""
    if schemas in (None, "all"):
        names = [d.name for d in spark.catalog.listDatabases()]
    else:
        names = parse_name_list(schemas)
    ex = {x.lower() for x in parse_name_list(exclude_schemas)}
    return sorted({n for n in names if n.lower() not in ex})


def _field(info, key: str) -> F.Column:
    v = F.regexp_extract(info, rf"(?m)^{key}: (.*)$", 1)
    return F.when(v != F.lit(""), v)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _in_session_catalog(spark: SparkSession, catalog: str | None) -> bool:
    return catalog in (None, "", "spark_catalog", spark.catalog.currentCatalog())


def _listing(spark: SparkSession, db: str, catalog: str | None = None) -> DataFrame:
    where = _q(db) if _in_session_catalog(spark, catalog) else f"{_q(catalog)}.{_q(db)}"
    return spark.sql(f"SHOW TABLE EXTENDED IN {where} LIKE '*'")


def database_exists(spark: SparkSession, db: str, catalog: str | None = None) -> bool:
    return spark.catalog.databaseExists(db if _in_session_catalog(spark, catalog) else f"{catalog}.{db}")


def inventory(spark: SparkSession, databases: list[str] | None = None,
              catalog_label: str | None = None, errors: str = "raise", parallelism: int = 1,
              with_stats: bool = False, catalog: str | None = None, count_views: bool = False) -> DataFrame:
    """``catalog, database, name, object_type, provider, location, partition_columns, view_text,
    upgraded_to`` (the target a migration recorded on the source table, else null).

    ``object_type`` is ``MANAGED``, ``EXTERNAL`` or ``VIEW``; temporary views are left out.
    ``partition_columns`` is an array of names (empty when unpartitioned). ``errors="skip"`` logs a
    database that cannot be listed and goes on without it. ``parallelism`` lists that many
    databases at once (the calls wait on the metastore, not on executors). ``with_stats`` adds
    ``row_count, bytes, files, size_mb, stats_error`` from ``table_stats`` (batched jobs; an
    unreadable table gets an error text). Views are not run unless ``count_views``: a view can be
    an arbitrarily expensive query and is never copied, so by default it gets no counts. ``catalog`` lists the schemas of
    another configured catalog instead of the session catalog.
    """
    inv = _inventory(spark, databases, catalog_label or catalog, errors, parallelism, catalog)
    if not with_stats:
        return inv
    from .stats import catalog_table_stats
    listed = inv.select("database", "name", "object_type").collect()  # metadata: one row per table
    if not count_views:
        listed = [r for r in listed if r["object_type"] != "VIEW"]
    if not listed:
        return inv.select("*", *[F.lit(None).cast(t).alias(c) for c, t in (
            ("row_count", "long"), ("bytes", "long"), ("files", "long"), ("size_mb", "double"),
            ("stats_error", "string"))])
    prefix = "" if _in_session_catalog(spark, catalog) else f"{_q(catalog)}."
    full = {f"{prefix}{_q(r['database'])}.{_q(r['name'])}": (r["database"], r["name"]) for r in listed}
    st = catalog_table_stats(spark, list(full), errors="isolate")
    keys = spark.createDataFrame([(k, d, n) for k, (d, n) in full.items()], "table_name string, database string, name string")
    st = st.join(keys, "table_name").select("database", "name", "row_count", "bytes", "files", "size_mb",
                                            F.col("error").alias("stats_error"))
    return inv.join(st, ["database", "name"], "left")


def _inventory(spark: SparkSession, databases: list[str] | None, catalog_label: str | None, errors: str,
               parallelism: int, catalog: str | None = None) -> DataFrame:
    dbs = databases if databases is not None else list_databases(spark)
    label = catalog_label or spark.catalog.currentCatalog()

    def listing(d: str):
        try:
            return _listing(spark, d, catalog)
        except Exception as e:  # noqa: BLE001
            if errors != "skip":
                raise
            log.warning("cannot list database %s: %s", d, str(e).splitlines()[0] if str(e) else e)
            return None

    if parallelism > 1 and len(dbs) > 1:
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            found = list(pool.map(listing, dbs))
    else:
        found = [listing(d) for d in dbs]
    listings = [x for x in found if x is not None]
    if not listings:
        return spark.createDataFrame([], ", ".join(
            f"{c} {'array<string>' if c == 'partition_columns' else 'string'}" for c in INVENTORY_COLUMNS))
    raw = reduce(DataFrame.unionByName, listings)
    info = F.col("information")
    parts = F.regexp_extract(info, r"(?m)^Partition Columns: \[(.*)\]$", 1)
    part_arr = F.when(parts == F.lit(""), F.array().cast("array<string>")).otherwise(
        F.transform(F.split(parts, ", "), lambda p: F.regexp_replace(p, r"^`|`$", "")))
    view_text = F.regexp_extract(info, r"(?s)\nView Text: (.*?)\nView Original Text: ", 1)
    upgraded = F.regexp_extract(info, rf"(?m)^Table Properties: \[(?:.*, )?{UPGRADED_TO}=([^,\]]*)", 1)
    return (raw.where(~F.col("isTemporary"))
            .select(F.lit(label).alias("catalog"), F.col("namespace").alias("database"),
                    F.col("tableName").alias("name"), F.upper(_field(info, "Type")).alias("object_type"),
                    F.lower(_field(info, "Provider")).alias("provider"), _field(info, "Location").alias("location"),
                    part_arr.alias("partition_columns"),
                    F.when(view_text != F.lit(""), view_text).alias("view_text"),
                    F.when(upgraded != F.lit(""), upgraded).alias("upgraded_to")))


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def object_type(spark: SparkSession, name: str) -> str | None:
    """``MANAGED`` / ``EXTERNAL`` / ``VIEW`` / ``TEMPORARY`` or None when missing (three-valued,
    so a missing table is never mistaken for an external one)."""
    if not spark.catalog.tableExists(name):
        return None
    return spark.catalog.getTable(name).tableType


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def view_text(spark: SparkSession, name: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'View Text'").collect()
    return rows[-1]["data_type"] if rows else None


def _name_list(text: str | None) -> list[str]:
    if not text:
        return []
    inner = text.strip()[1:-1]
    return [p.strip().strip("`").replace("``", "`") for p in inner.split("`, `")] if inner else []


def describe_table(spark: SparkSession, name: str) -> dict:
    """Table-level facts from ``DESCRIBE TABLE EXTENDED`` (rows after the detailed-information
    header only, so a data column called ``Type`` cannot shadow them): ``type, provider, location,
    comment, num_buckets, bucket_columns, sort_columns, properties`` (user table properties) and
    ``options`` (storage options)."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    info, seen = {}, False
    for r in rows:
        if r["col_name"] == "# Detailed Table Information":
            seen = True
            continue
        if seen and r["col_name"]:
            info[r["col_name"]] = r["data_type"]
    props, options = {}, {}
    for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect():
        k = r["key"]
        if k.startswith("option."):
            if k != "option.path":
                options[k[7:]] = r["value"]
        elif not (k.startswith("spark.sql.") or k in ("transient_lastDdlTime", "comment")):
            props[k] = r["value"]
    return {"type": (info.get("Type") or "").upper() or None, "provider": (info.get("Provider") or "").lower() or None,
            "location": info.get("Location"), "comment": info.get("Comment"),
            "num_buckets": int(info["Num Buckets"]) if info.get("Num Buckets", "").isdigit() else None,
            "bucket_columns": _name_list(info.get("Bucket Columns")),
            "sort_columns": _name_list(info.get("Sort Columns")), "properties": props, "options": options}


def _session_table(spark: SparkSession, name: str):
    """(catalog, identifier, metadata) of a table of the session catalog."""
    state = spark._jsparkSession.sessionState()
    ident = state.sqlParser().parseTableIdentifier(name)
    return state.catalog(), ident, state.catalog().getTableMetadata(ident)


def columns_ddl(spark: SparkSession, name: str) -> str:
    """The table's column list as DDL, as it was declared: char and varchar types, nested names in quotes,
    comments. Tables of another catalog give the columns that a scan shows."""
    try:
        schema = _session_table(spark, name)[2].schema()
    except Exception:  # noqa: BLE001 - another catalog's name has three parts
        schema = spark._jvm.org.apache.spark.sql.types.StructType.fromJson(spark.table(name).schema.json())
    return spark._jvm.org.apache.spark.sql.catalyst.util.CharVarcharUtils.getRawSchema(schema).toDDL()


def copy_partitions(spark: SparkSession, source: str, target: str, batch: int = 500) -> None:
    """Every partition entry of ``source``, with its own location, in batches into ``target``'s catalog entry.
    Between tables of other catalogs, partitions are recovered from the directory layout."""
    try:
        catalog, src, _ = _session_table(spark, source)
        _, dst, _ = _session_table(spark, target)
    except Exception:  # noqa: BLE001
        spark.sql(f"ALTER TABLE {target} RECOVER PARTITIONS")
        return
    groups = catalog.listPartitions(src, spark._jvm.scala.Option.apply(None)).grouped(batch)
    while groups.hasNext():
        catalog.createPartitions(dst, groups.next(), True)
    spark.catalog.refreshTable(target)
