"""Registered queries: each operator run over the test tables, with an equivalent DuckDB SQL text.

Fixture frames are pure projections of the test tables, built the same way on both sides:

* ``man`` (manifest) and ``inv`` (source inventory) from ``customer``: one table per customer;
* ``tinv`` (target inventory, shape of ``information_schema.tables``) from ``customer`` and
  ``region``;
* ``orders_v2``: ``orders`` with some rows gone, some prices changed and some rows doubled.

Every query processes whole tables; the predicates below only decide *which* rows a fixture
perturbs, never how much data a query reads.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, functions as F

from .operators import copy as copy_ops
from .operators.estimate import estimate_transfer
from .operators.reconcile import (count_rows, keyed_diff, not_upgraded, reconcile_counts,
                                  reconcile_inventory, reconcile_rows, table_checksums)
from .operators.rewrite import mapping_from_manifest, rewrite_catalog, rewrite_references
from .operators.select import exclude_schemas, exclude_tables, include_tables
from .plans.convert import convert_to_external, register_external
from .plans.migrate import migrate
from .plans.migration import plan_migration
from .plans.report import ineligible, outcome_counts
from .plans.targets import plan_targets
from .plans.views import migrate_views, view_mapping, view_plan
from .session import new_database, new_work_dir, scratch
from .sources.catalog import inventory
from .sources.manifest import build_manifest, dedup_manifest, manifest_problems, type_manifest
from .sources.stats import table_stats

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Column types of the test tables (used to write the portable checksum in SQL).
TABLE_COLUMNS = {
    "region": [("r_regionkey", "int"), ("r_name", "string")],
    "nation": [("n_nationkey", "int"), ("n_name", "string"), ("n_regionkey", "int")],
    "customer": [("c_custkey", "long"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"),
                 ("c_mktsegment", "string")],
    "supplier": [("s_suppkey", "long"), ("s_name", "string"), ("s_nationkey", "int"), ("s_acctbal", "double")],
    "part": [("p_partkey", "long"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"),
             ("p_size", "int"), ("p_retailprice", "double")],
    "orders": [("o_orderkey", "long"), ("o_custkey", "long"), ("o_orderstatus", "string"),
               ("o_totalprice", "double"), ("o_orderdate", "timestamp"), ("o_orderpriority", "string")],
    "lineitem": [("l_orderkey", "long"), ("l_partkey", "long"), ("l_suppkey", "long"), ("l_linenumber", "int"),
                 ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"),
                 ("l_tax", "double"), ("l_returnflag", "string"), ("l_linestatus", "string"),
                 ("l_shipdate", "timestamp")],
    "events": [("event_id", "long"), ("ts", "timestamp"), ("user_id", "long"), ("event_type", "string"),
               ("value", "double"), ("props", "string")],
    "documents": [("doc_id", "long"), ("text", "string"), ("lang", "string"), ("source", "string"),
                  ("n_chars", "long")],
    "embeddings": [("vec_id", "long"), ("embedding", "array<float>"), ("label", "int")],
    "pages": [("page_id", "long"), ("url", "string"), ("html", "string")],
    "benchmark": [("item_id", "long"), ("text", "string")],
    "labels": [("doc_id", "long"), ("quality", "int"), ("toxic", "int")],
    "conversations": [("conv_id", "long"), ("turn", "long"), ("role", "string"), ("text", "string")],
}

PII_ROOT, NONPII_ROOT = "/mnt/external/pii", "/mnt/external/nonpii"
CATALOG = "main"
SOURCE_CATALOG = "hive_metastore"
EXCLUDED_SCHEMAS = "seg_machinery, seg_household"
RATE = 5.6


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# ------------------------------------------------------------------ fixtures (Spark side)

def _db_expr(nullable: bool) -> F.Column:
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    seg = F.concat(F.lit("seg_"), F.lower("c_mktsegment"))
    e = F.when(n == 8, F.lit("default")).otherwise(seg)
    return F.when(k % 37 == 0, F.lit(None).cast("string")).otherwise(e) if nullable else e


def man_df(spark, sf) -> DataFrame:
    k = F.col("c_custkey")
    name = F.concat(F.lit("cust_"), k.cast("string"))
    return _t(spark, sf, "customer").select(
        _db_expr(False).alias("database"), name.alias("name"),
        F.concat(F.lit("uc_"), F.lower("c_mktsegment")).alias("target_schema"),
        F.when(k % 7 == 0, F.concat(name, F.lit("_v2"))).otherwise(name).alias("target_table"),
        F.when(k % 11 == 0, F.lit(None).cast("boolean")).otherwise(k % 5 == 0).alias("is_pii"),
        (k + 1).cast("int").alias("t_no"))


def inv_df(spark, sf) -> DataFrame:
    c = _t(spark, sf, "customer").where(F.col("c_acctbal") >= 0)
    k = F.col("c_custkey")
    name = F.concat(F.lit("cust_"), k.cast("string"))
    tt = F.when(k % 7 == 0, F.concat(name, F.lit("_v2"))).otherwise(name)
    cols = [_db_expr(True).alias("database"), name.alias("name"),
            F.when(k % 4 == 0, "MANAGED").when(k % 4 == 1, "VIEW").otherwise("EXTERNAL").alias("object_type"),
            F.when(k % 3 != 0, F.concat_ws(".", F.lit(CATALOG), F.concat(F.lit("uc_"), F.lower("c_mktsegment")), tt))
            .alias("upgraded_to")]
    return c.select(*cols).unionAll(c.where(F.col("c_nationkey") == 5).select(*cols))


def tinv_df(spark, sf) -> DataFrame:
    c = _t(spark, sf, "customer")
    k = F.col("c_custkey")
    name = F.concat(F.lit("cust_"), k.cast("string"))
    ttype = F.when(k % 4 == 1, "VIEW").otherwise("EXTERNAL")
    present = c.where(F.col("c_nationkey") != 9).select(
        F.lit(CATALOG).alias("table_catalog"), _db_expr(False).alias("table_schema"), name.alias("table_name"),
        ttype.alias("table_type"))
    extra = c.where(F.col("c_nationkey") == 2).select(
        F.lit(CATALOG).alias("table_catalog"), _db_expr(False).alias("table_schema"),
        F.concat(name, F.lit("_extra")).alias("table_name"), F.lit("EXTERNAL").alias("table_type"))
    info = _t(spark, sf, "region").select(
        F.lit(CATALOG).alias("table_catalog"), F.lit("information_schema").alias("table_schema"),
        F.concat(F.lit("r_"), F.lower("r_name")).alias("table_name"), F.lit("VIEW").alias("table_type"))
    return present.unionAll(extra).unionAll(info)


def tinv_mapped_df(spark, sf) -> DataFrame:
    """Target inventory under the manifest's target names."""
    m = man_df(spark, sf).join(_t(spark, sf, "customer").select(
        F.concat(F.lit("cust_"), F.col("c_custkey").cast("string")).alias("name"), "c_nationkey"), "name")
    return m.where(F.col("c_nationkey") != 9).select(
        F.lit(CATALOG).alias("table_catalog"), F.col("target_schema").alias("table_schema"),
        F.col("target_table").alias("table_name"), F.lit("EXTERNAL").alias("table_type"))


def excl_df(spark, sf) -> DataFrame:
    return man_df(spark, sf).join(_t(spark, sf, "customer").where(F.col("c_nationkey") == 3).select(
        F.concat(F.lit("cust_"), F.col("c_custkey").cast("string")).alias("name")), "name").select("database", "name")


def plan_tinv_df(spark, sf) -> DataFrame:
    m = man_df(spark, sf).join(_t(spark, sf, "customer").where(F.col("c_nationkey") == 7).select(
        F.concat(F.lit("cust_"), F.col("c_custkey").cast("string")).alias("name")), "name")
    return m.select(F.lit(CATALOG).alias("table_catalog"), F.upper("target_schema").alias("table_schema"),
                    F.col("target_table").alias("table_name"), F.lit("EXTERNAL").alias("table_type"))


def orders_v2_df(spark, sf, doubled: bool = True) -> DataFrame:
    o = _t(spark, sf, "orders")
    k = F.col("o_orderkey")
    v2 = o.where(k % 97 != 0).withColumn(
        "o_totalprice", F.when(k % 103 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return v2.unionAll(v2.where(k % 101 == 0)) if doubled else v2


def _plan(spark, sf) -> DataFrame:
    return plan_migration(inv_df(spark, sf), plan_tinv_df(spark, sf), CATALOG, man_df(spark, sf),
                          excl_df(spark, sf).withColumn("name", F.upper("name")), None, SOURCE_CATALOG)


# ------------------------------------------------------------------ queries (Spark side)

def _report(query):
    """For queries that return a report (a row per table or outcome) and not the tables they made: the
    report is kept, the scratch databases and folders go."""
    @functools.wraps(query)
    def run(spark, sf):
        with scratch(spark):
            out = query(spark, sf)
            return spark.createDataFrame(out.collect(), out.schema)
    return run


def q_manifest_number(spark, sf):
    """B2: listing rows -> typed manifest, ``t_no`` 1..n by customer key without a one-partition window."""
    k = F.col("c_custkey")
    rows = _t(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit("cust_"), k.cast("string")).alias("name"), _db_expr(False).alias("database"),
        F.concat(F.lit("uc_"), F.lower("c_mktsegment")).alias("target_schema"),
        F.when(k % 3 == 0, "yes").when(k % 3 == 1, "No").otherwise("maybe").alias("is_pii"))
    return build_manifest(rows, ["c_custkey"])


def q_manifest_from_csv(spark, sf):
    """The people-written manifest CSV (one line per customer table, written in descending key
    order) read back with ``t_no`` = line order."""
    from .sources.manifest import manifest_from_csv
    k = F.col("c_custkey")
    rows = _t(spark, sf, "customer").select(
        F.concat(F.lit("cust_"), k.cast("string")).alias("name"), _db_expr(False).alias("database"),
        F.concat(F.lit("uc_"), F.lower("c_mktsegment")).alias("target_schema"),
        F.when(k % 2 == 0, "True").otherwise("False").alias("is_pii"), k)
    path = new_work_dir(spark, "mancsv") + "/data"
    rows.orderBy(F.desc("c_custkey")).drop("c_custkey").write.option("header", True).csv(path)
    return manifest_from_csv(spark, path)


def q_manifest_dedup(spark, sf):
    """B1: a manifest listing some tables twice, exact duplicates dropped."""
    m = man_df(spark, sf)
    again = m.join(_t(spark, sf, "customer").where(F.col("c_nationkey") == 1).select(
        F.concat(F.lit("cust_"), F.col("c_custkey").cast("string")).alias("name")), "name").select(*m.columns)
    return dedup_manifest(type_manifest(m.unionAll(again)))


def q_manifest_dup_keys(spark, sf):
    """B1: duplicate ``(database, name)`` keys with different rows, and rows with a null key."""
    m = man_df(spark, sf)
    c = _t(spark, sf, "customer").select(
        F.concat(F.lit("cust_"), F.col("c_custkey").cast("string")).alias("name"), "c_nationkey")
    mc = m.join(c, "name")
    other = mc.where(F.col("c_nationkey") == 4).withColumn("target_schema", F.lit("uc_other")).select(*m.columns)
    nulls = mc.where(F.col("c_nationkey") == 6).withColumn("name", F.lit(None).cast("string")).select(*m.columns)
    return manifest_problems(m.unionAll(other).unionAll(nulls))


def q_include_tables(spark, sf):
    """Inventory rows named in the manifest (left semi join)."""
    inc = man_df(spark, sf).join(_t(spark, sf, "customer").where(F.col("c_nationkey") < 10).select(
        F.concat(F.lit("cust_"), F.col("c_custkey").cast("string")).alias("name")), "name")
    odd = F.col("t_no") % 2 == 1  # metastore names don't differ by case
    return include_tables(inv_df(spark, sf), inc.withColumn("name", F.when(odd, F.upper("name")).otherwise(F.col("name"))))


def q_exclude_tables(spark, sf):
    """Inventory rows not in the exclusion list (left anti join)."""
    excl = excl_df(spark, sf)
    return exclude_tables(inv_df(spark, sf), excl.withColumn("database", F.initcap("database")))


def q_exclude_schemas(spark, sf):
    """Inventory rows outside the excluded schemas (SQL ``NOT IN`` semantics)."""
    return exclude_schemas(inv_df(spark, sf), EXCLUDED_SCHEMAS)


def q_plan_targets(spark, sf):
    """Source and target names, quoted names and flag-driven locations."""
    return plan_targets(man_df(spark, sf), CATALOG, PII_ROOT, NONPII_ROOT, SOURCE_CATALOG)


def q_flag_location(spark, sf):
    """Where the tables of the manifest land: tables per storage root and target schema."""
    t = plan_targets(man_df(spark, sf), CATALOG, PII_ROOT, NONPII_ROOT, SOURCE_CATALOG)
    root = F.regexp_extract("location", r"^(.*)/[^/]+/[^/]+$", 1)
    return t.groupBy(root.alias("storage_root"), "target_schema").agg(F.count(F.lit(1)).alias("tables"))


def q_estimate_tables(spark, sf):
    """Per-table transfer estimate from document sizes, both rate readings."""
    sizes = (_t(spark, sf, "documents").groupBy(F.concat(F.lit("docs_"), F.col("lang")).alias("target_schema"),
                                                 F.col("source").alias("table_name"))
             .agg(F.sum("n_chars").alias("bytes")))
    parts = []
    for mode in ("seconds_per_mb", "mb_per_second"):
        per_table, _ = estimate_transfer(sizes, RATE, mode)
        parts.append(per_table.withColumn("mode", F.lit(mode)))
    return parts[0].unionByName(parts[1])


def q_estimate_totals(spark, sf):
    """Estimate totals in seconds, minutes and hours, both rate readings."""
    sizes = (_t(spark, sf, "documents").groupBy(F.col("lang").alias("target_schema"), F.col("source").alias("table_name"))
             .agg(F.sum("n_chars").alias("bytes")))
    parts = []
    for mode in ("seconds_per_mb", "mb_per_second"):
        _, totals = estimate_transfer(sizes, RATE, mode)
        parts.append(totals.withColumn("mode", F.lit(mode)))
    return parts[0].unionByName(parts[1])


@_report
def q_estimate_manifest(spark, sf):
    """The estimate workflow over real tables: managed copies of the test tables are sized from their
    files and estimated; the others are listed with a reason. Of the sizes, whether they are known."""
    from .operators.estimate import estimate_manifest
    db = new_database(spark, "est")
    for t in ("orders", "lineitem", "customer", "documents"):
        _managed(spark, sf, db, t)
    _external(spark, sf, db, "part")
    man = spark.createDataFrame([(db, t, "uc_" + t) for t in ("orders", "lineitem", "customer", "documents",
                                                              "part", "ghost")],
                                "database string, name string, target_schema string")
    per, _, skipped = estimate_manifest(spark, man, RATE, "seconds_per_mb")
    known = (F.col("size_mb") > 0) & (F.col("seconds") > 0) & F.col("elapsed").isNotNull()
    return per.select("table_name", known.alias("size_known"), F.lit(None).cast("string").alias("reason")).unionByName(
        skipped.select(F.col("name").alias("table_name"), F.lit(False).alias("size_known"), "reason"))


def q_table_counts(spark, sf):
    """Row counts of all 14 test tables in one grouped aggregation."""
    return count_rows({t: _t(spark, sf, t) for t in TABLES})


def q_table_stats(spark, sf):
    """Rows and files of all test tables from file metadata, and whether their sizes are known."""
    st = table_stats({t: _t(spark, sf, t) for t in TABLES})
    return st.select("table_name", "row_count", "files", (F.col("bytes") > 0).alias("size_known"))


def q_table_checksum(spark, sf):
    """Portable (md5) order-free checksums of all 14 test tables."""
    return table_checksums({t: _t(spark, sf, t) for t in TABLES}, portable=True)


def q_table_checksum_fast(spark, sf):
    """The default (Spark-only) checksum of every test table against that of a written, reordered copy."""
    root = new_work_dir(spark, "fast")
    both = {}
    for t in TABLES:
        df = _t(spark, sf, t)
        df.orderBy(F.xxhash64(df.columns[0]), df.columns[0]).write.parquet(f"{root}/{t}")
        both[t], both["copy of " + t] = df, spark.read.parquet(f"{root}/{t}")
    c = table_checksums(both)
    copies = c.where(F.col("table_name").startswith("copy of ")).select(
        F.expr("substring(table_name, 9)").alias("table_name"), F.col("checksum").alias("copied"), F.col("row_count").alias("n"))
    return c.join(copies, "table_name").select("table_name", "row_count", (
        (F.col("checksum") == F.col("copied")) & (F.col("row_count") == F.col("n"))).alias("match"))


def q_only_in_source(spark, sf):
    """External tables in the source inventory but not in the target (bag difference)."""
    return reconcile_inventory(inv_df(spark, sf), tinv_df(spark, sf), "EXTERNAL", EXCLUDED_SCHEMAS)[0]


def q_only_in_target(spark, sf):
    """External tables in the target inventory but not in the source."""
    return reconcile_inventory(inv_df(spark, sf), tinv_df(spark, sf), "EXTERNAL", EXCLUDED_SCHEMAS)[1]


def q_views_only_in_source(spark, sf):
    """Views in the source inventory but not in the target."""
    return reconcile_inventory(inv_df(spark, sf), tinv_df(spark, sf), "VIEW", EXCLUDED_SCHEMAS)[0]


def q_views_only_in_target(spark, sf):
    """Views in the target inventory but not in the source."""
    return reconcile_inventory(inv_df(spark, sf), tinv_df(spark, sf), "VIEW", EXCLUDED_SCHEMAS)[1]


def q_only_in_source_mapped(spark, sf):
    """Source objects missing in the target under their mapped (renamed) names."""
    return reconcile_inventory(inv_df(spark, sf), tinv_mapped_df(spark, sf), "EXTERNAL", None, man_df(spark, sf))[0]


def q_only_in_target_mapped(spark, sf):
    """Target objects with no source under the mapped names."""
    return reconcile_inventory(inv_df(spark, sf), tinv_mapped_df(spark, sf), "EXTERNAL", None, man_df(spark, sf))[1]


def q_validation_summary(spark, sf):
    """Counts of every post-migration check in one job."""
    from .plans.validate import validate
    return validate(inv_df(spark, sf), tinv_df(spark, sf), EXCLUDED_SCHEMAS).summary()


def q_not_upgraded(spark, sf):
    """External tables no migration has claimed."""
    return not_upgraded(inv_df(spark, sf), EXCLUDED_SCHEMAS)


def q_count_match(spark, sf):
    """Row counts of tables and their copies, joined per table."""
    src = count_rows({"orders": _t(spark, sf, "orders"), "lineitem": _t(spark, sf, "lineitem")})
    dst = count_rows({"orders": orders_v2_df(spark, sf), "lineitem": _t(spark, sf, "lineitem")})
    return reconcile_counts(src, dst)


def q_rows_only_in_source(spark, sf):
    """Rows of ``orders`` missing from its perturbed copy (exact bag difference)."""
    return reconcile_rows(_t(spark, sf, "orders"), orders_v2_df(spark, sf), "exact")[0]


def q_rows_only_in_target(spark, sf):
    """Rows of the perturbed copy not in ``orders`` (exact bag difference)."""
    return reconcile_rows(_t(spark, sf, "orders"), orders_v2_df(spark, sf), "exact")[1]


def q_rows_only_in_source_narrow(spark, sf):
    """As ``rows_only_in_source``, narrowed by bucket signatures first."""
    return reconcile_rows(_t(spark, sf, "orders"), orders_v2_df(spark, sf), "narrow")[0]


def q_rows_only_in_target_narrow(spark, sf):
    """As ``rows_only_in_target``, narrowed by bucket signatures first."""
    return reconcile_rows(_t(spark, sf, "orders"), orders_v2_df(spark, sf), "narrow")[1]


def q_lineitem_rows_diff(spark, sf):
    """Row difference of lineitem against a copy with shifted quantities, both ways, tagged."""
    li = _t(spark, sf, "lineitem")
    k = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    v2 = li.withColumn("l_quantity", F.when(k % 89 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")))
    s, t = reconcile_rows(li, v2, "narrow")
    return s.withColumn("side", F.lit("source")).unionByName(t.withColumn("side", F.lit("target")))


def q_partition_diff(spark, sf):
    """Which (l_returnflag, l_linestatus) partitions of lineitem differ from a copy in which one
    partition lost its rows, one gained a partition that is new, and returned items changed."""
    li = _t(spark, sf, "lineitem")
    gone = (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O")
    v2 = (li.where(~gone)
          .withColumn("l_quantity", F.when(F.col("l_returnflag") == "R", F.col("l_quantity") + 1)
                      .otherwise(F.col("l_quantity")))
          .unionByName(li.where(F.col("l_orderkey") % 50 == 0).withColumn("l_linestatus", F.lit("X"))))
    from .operators.reconcile import reconcile_partitions
    return reconcile_partitions(li, v2, ["l_returnflag", "l_linestatus"], portable=True)


def q_keyed_diff(spark, sf):
    """Per-key missing / extra / changed status of ``orders`` against its copy."""
    return keyed_diff(_t(spark, sf, "orders"), orders_v2_df(spark, sf, doubled=False), ["o_orderkey"])


def q_plan_status(spark, sf):
    """One status row per manifest object (the dry-run plan)."""
    return _plan(spark, sf)


def q_plan_status_counts(spark, sf):
    """Objects per status."""
    return outcome_counts(_plan(spark, sf))


def q_report_ineligible(spark, sf):
    """Managed tables outside the default schema."""
    managed, _ = ineligible(_plan(spark, sf))
    return managed.select("source_schema", "source_name", "status_code", "description")


def q_report_other_ineligible(spark, sf):
    """Other objects that cannot be migrated as they are."""
    _, other = ineligible(_plan(spark, sf))
    return other.select("source_schema", "source_name", "status_code", "description")


def q_rewrite_catalog(spark, sf):
    """The literal catalog rule over SQL texts built from ``orders``."""
    o = _t(spark, sf, "orders")
    text = F.concat(F.lit("select * from `hive_metastore`.seg.orders_"), F.col("o_orderkey").cast("string"),
                    F.lit(" join hive_metastore.ref.t on my_hive_metastore_z = '"), F.col("o_orderstatus"), F.lit("'"))
    return o.select("o_orderkey", rewrite_catalog(text, SOURCE_CATALOG, CATALOG).alias("new_text"))


def _reference_texts(spark, sf) -> DataFrame:
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = _t(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    j = o.join(c, o["o_custkey"] == c["c_custkey"])
    seg = _db_expr(False)
    cust = F.concat(F.lit("cust_"), F.col("c_custkey").cast("string"))
    ref = F.concat(seg, F.lit("."), cust)
    text = F.concat(
        F.lit("SELECT o.o_totalprice FROM "), ref, F.lit(" o JOIN hive_metastore."), ref,
        F.lit(" h ON o.k = h.k JOIN "), ref, F.lit("x z ON 1 = 1 JOIN x."), ref, F.lit(" w JOIN `"), seg,
        F.lit("`.`"), cust, F.lit("` q JOIN "), F.upper(ref), F.lit(" u WHERE o.s = '"), ref, F.lit("' AND "),
        ref, F.lit(".o_orderkey = "), F.col("o_orderkey").cast("string"), F.lit(" -- "), ref, F.lit("\n/* "), ref,
        F.lit(" */ ;"))
    return j.select("o_orderkey", text.alias("text"))


def q_rewrite_references(spark, sf):
    """The one-pass token rule; Spark picks the join with the mapping by measured size."""
    m = mapping_from_manifest(man_df(spark, sf))
    return rewrite_references(_reference_texts(spark, sf), "text", m, SOURCE_CATALOG, CATALOG,
                              out_col="new_text").select("o_orderkey", "new_text")


def q_rewrite_references_join(spark, sf):
    """The one-pass token rule through a shuffle join with the mapping."""
    m = mapping_from_manifest(man_df(spark, sf))
    return rewrite_references(_reference_texts(spark, sf), "text", m, SOURCE_CATALOG, CATALOG,
                              out_col="new_text", join_hint="merge").select("o_orderkey", "new_text")


def _managed(spark, sf, db: str, table: str, partition_by: list[str] | None = None, name: str | None = None):
    w = _t(spark, sf, table).write.format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(f"`{db}`.`{name or table}`")


def _external(spark, sf, db: str, table: str, partition_by: list[str] | None = None):
    loc = new_work_dir(spark, f"ext-{table}")
    w = _t(spark, sf, table).write.format("parquet").option("path", loc + "/data")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(f"`{db}`.`{table}`")


def q_copy_orders(spark, sf):
    """A managed table copied to an external location and read back."""
    db = new_database(spark, "copy")
    _managed(spark, sf, db, "orders")
    loc = new_work_dir(spark, "copy-orders") + "/data"
    copy_ops.copy_table(spark, f"`{db}`.`orders`", f"`{db}`.`orders_ext`", loc)
    return copy_ops.read_back(spark, f"`{db}`.`orders_ext`", _t(spark, sf, "orders").columns)


def q_copy_lineitem_partitioned(spark, sf):
    """A partitioned managed table copied with its partition columns kept."""
    db = new_database(spark, "copyp")
    _managed(spark, sf, db, "lineitem", ["l_returnflag", "l_linestatus"])
    loc = new_work_dir(spark, "copy-lineitem") + "/data"
    parts = copy_ops.copy_table(spark, f"`{db}`.`lineitem`", f"`{db}`.`lineitem_ext`", loc)
    assert parts == ["l_returnflag", "l_linestatus"], parts
    return copy_ops.read_back(spark, f"`{db}`.`lineitem_ext`", _t(spark, sf, "lineitem").columns)


@_report
def q_copy_verify(spark, sf):
    """Copy proven by row counts and portable checksums of both sides (the flagship)."""
    db = new_database(spark, "verify")
    _managed(spark, sf, db, "orders")
    loc = new_work_dir(spark, "verify-orders") + "/data"
    copy_ops.copy_table(spark, f"`{db}`.`orders`", f"`{db}`.`orders_ext`", loc)
    src = spark.table(f"`{db}`.`orders`")
    cs = table_checksums({"source": src, "target": copy_ops.read_back(spark, f"`{db}`.`orders_ext`", src.columns)},
                         portable=True)

    def pick(side: str, col: str) -> F.Column:
        return F.max(F.when(F.col("table_name") == side, F.col(col)))

    return (cs.agg(pick("source", "row_count").alias("source_rows"), pick("source", "checksum").alias("source_checksum"),
                   pick("target", "row_count").alias("target_rows"), pick("target", "checksum").alias("target_checksum"))
            .select(F.lit("orders").alias("table_name"), "*")
            .withColumn("match", (F.col("source_rows") == F.col("target_rows"))
                        & (F.col("source_checksum") == F.col("target_checksum"))))


def _convert_setup(spark, sf):
    db = new_database(spark, "conv")
    _managed(spark, sf, db, "orders", ["o_orderstatus"])
    _managed(spark, sf, db, "customer")
    _external(spark, sf, db, "supplier")
    root = new_work_dir(spark, "conv-target")
    rows = [(db, "orders", "uc_sales", "orders", False, 1), (db, "customer", "uc_sales", "customer", True, 2),
            (db, "supplier", "uc_sales", "supplier", False, 3), (db, "ghost", "uc_sales", "ghost", None, 4)]
    man = spark.createDataFrame(rows, "database string, name string, target_schema string, target_table string, "
                                      "is_pii boolean, t_no int")
    targets = plan_targets(man, CATALOG, root + "/pii", root + "/nonpii")
    return db, targets


@_report
def q_convert_report(spark, sf):
    """Conversion of managed, external and missing tables, one outcome each."""
    db, targets = _convert_setup(spark, sf)
    out = convert_to_external(spark, targets, drop_old=True, verify="checksum", parallelism=2)
    return out.select("name", "outcome", "source_rows", "target_rows")


@_report
def q_convert_all_tables(spark, sf):
    """Every test table as a managed table, converted to external with checksum verification,
    four at a time; one outcome row per table."""
    db = new_database(spark, "convall")
    for t in TABLES:
        _managed(spark, sf, db, t)
    root = new_work_dir(spark, "convall-target")
    man = spark.createDataFrame([(db, t, "uc", t, t in ("customer", "documents", "conversations"), i)
                                 for i, t in enumerate(TABLES)],
                                "database string, name string, target_schema string, target_table string, "
                                "is_pii boolean, t_no int")
    out = convert_to_external(spark, plan_targets(man, CATALOG, root + "/pii", root + "/nonpii"), drop_old=True,
                              verify="checksum", parallelism=4)
    return out.select("name", "outcome", "source_rows", "target_rows")


@_report
def q_report_counts(spark, sf):
    """Outcome counts of a conversion run over managed, external and missing tables."""
    db, targets = _convert_setup(spark, sf)
    return outcome_counts(convert_to_external(spark, targets, drop_old=True, verify="checksum", parallelism=2),
                          "outcome")


@_report
def q_migrate_dry_run(spark, sf):
    """A dry run of a whole-schema migration, summarised the way a person reads it."""
    from .plans.report import migration_summary
    src = new_database(spark, "drysrc")
    tgt = new_database(spark, "drytgt")
    _external(spark, sf, src, "orders")
    _external(spark, sf, src, "customer")
    _managed(spark, sf, src, "supplier")
    _external(spark, sf, tgt, "customer")
    spark.sql(f"CREATE VIEW `{src}`.`big_orders` AS SELECT * FROM `{src}`.orders WHERE o_totalprice > 100000")
    man = spark.createDataFrame([(src, t, tgt, t, False, i) for i, t in
                                 enumerate(["orders", "customer", "supplier", "big_orders", "ghost"])],
                                "database string, name string, target_schema string, target_table string, "
                                "is_pii boolean, t_no int")
    res = migrate(spark, "all", [src], "spark_catalog", manifest=man, dry_run=True, source_catalog="spark_catalog")
    return migration_summary(res.plan, res.tables, res.views)


def q_convert_content(spark, sf):
    """A converted table read back under its original name."""
    db, targets = _convert_setup(spark, sf)
    out = convert_to_external(spark, targets, drop_old=False, verify="count").collect()
    assert {r["name"]: r["outcome"] for r in out}["orders"] == "CONVERTED", out
    assert spark.catalog.getTable(f"{db}.orders").tableType == "EXTERNAL"
    return copy_ops.read_back(spark, f"`{db}`.`orders`", _t(spark, sf, "orders").columns)


def _register_setup(spark, sf):
    src = new_database(spark, "regsrc")
    tgt = new_database(spark, "regtgt")
    _external(spark, sf, src, "orders")
    _external(spark, sf, src, "lineitem", ["l_returnflag"])
    _managed(spark, sf, src, "customer")
    spark.sql(f"CREATE VIEW `{src}`.`orders_by_status` AS SELECT o_orderstatus, count(*) AS n "
              f"FROM `{src}`.`orders` GROUP BY o_orderstatus")
    inv = inventory(spark, [src])
    man = spark.createDataFrame([(src, t, tgt, t + "_v2" if t == "lineitem" else t, False, i)
                                 for i, t in enumerate(["orders", "lineitem", "customer", "orders_by_status"])],
                                "database string, name string, target_schema string, target_table string, "
                                "is_pii boolean, t_no int")
    tinv = spark.createDataFrame([], "table_catalog string, table_schema string, table_name string, table_type string")
    plan = plan_migration(inv, tinv, "spark_catalog", man)
    return src, tgt, inv, man, plan


@_report
def q_register_report(spark, sf):
    """External tables registered in a target schema, verified against their sources."""
    src, tgt, inv, man, plan = _register_setup(spark, sf)
    return register_external(spark, plan, inv, dry_run=False, verify="checksum").select(
        "name", "target_table", "outcome", "source_rows", "target_rows")


def q_register_content(spark, sf):
    """A registered (renamed, partitioned) table read back."""
    src, tgt, inv, man, plan = _register_setup(spark, sf)
    register_external(spark, plan, inv, dry_run=False).collect()
    return copy_ops.read_back(spark, f"`{tgt}`.`lineitem_v2`", _t(spark, sf, "lineitem").columns)


def q_migrate_views(spark, sf):
    """A view recreated in the target with its references rewritten, then queried."""
    src, tgt, inv, man, plan = _register_setup(spark, sf)
    register_external(spark, plan, inv, dry_run=False).collect()
    vp = view_plan(inv).withColumn("target_schema", F.lit(tgt))
    out = migrate_views(spark, vp, mapping_from_manifest(man), dry_run=False).collect()
    assert [r["outcome"] for r in out] == ["VIEW_CREATED"], out
    return spark.table(f"`{tgt}`.`orders_by_status`")


@_report
def q_inventory(spark, sf):
    """Inventory of a schema with object types, providers, partitioning and row counts."""
    src, tgt, inv, man, plan = _register_setup(spark, sf)
    full = inventory(spark, [src], with_stats=True, count_views=True)
    return full.select("name", "object_type", "provider", (F.size("partition_columns") > 0).alias("is_partitioned"),
                       "row_count")


@_report
def q_migrate_all(spark, sf):
    """End-to-end migration of tables and a view, outcomes with verified counts."""
    src = new_database(spark, "migsrc")
    tgt = new_database(spark, "migtgt")
    _external(spark, sf, src, "orders")
    _external(spark, sf, src, "part")
    _managed(spark, sf, src, "supplier")
    spark.sql(f"CREATE VIEW `{src}`.`part_sizes` AS SELECT p_size, count(*) AS n FROM `{src}`.part GROUP BY p_size")
    man = spark.createDataFrame([(src, t, tgt, t, False, i) for i, t in
                                 enumerate(["orders", "part", "supplier", "part_sizes"])],
                                "database string, name string, target_schema string, target_table string, "
                                "is_pii boolean, t_no int")
    res = migrate(spark, "all", [src], "spark_catalog", [tgt], manifest=man, dry_run=False,
                  source_catalog="spark_catalog")
    t = res.tables.select("name", "outcome", "source_rows", "target_rows")
    v = res.views.select(F.regexp_extract("source_view", r"\.([^.]+)$", 1).alias("name"), "outcome",
                         F.lit(None).cast("long").alias("source_rows"), F.lit(None).cast("long").alias("target_rows"))
    return t.unionByName(v)


def q_split_by_flag(spark, sf):
    """Documents routed to PII / non-PII storage by their label, read back."""
    d = _t(spark, sf, "documents")
    lab = _t(spark, sf, "labels").select("doc_id", "toxic")
    flagged = d.join(lab, "doc_id", "left").withColumn("flag", F.col("toxic") == 1).drop("toxic")
    loc = new_work_dir(spark, "split") + "/data"
    back = copy_ops.split_by_flag(flagged, "flag", loc)
    return back.drop("flag")


def q_checkpoint_csv(spark, sf):
    """A table written as CSV with a header and read back typed."""
    c = _t(spark, sf, "customer")
    path = new_work_dir(spark, "csv") + "/data"
    copy_ops.write_csv(c, path)
    return copy_ops.read_csv(spark, path, c.schema)


def _threads(spark, sf, shifted: bool) -> DataFrame:
    """Conversations as one row each: an array of (turn, role, text) with nulls inside, and a map of roles.
    ``shifted`` moves the nulls of every fourth conversation to another turn, and swaps role and text of
    the null-role turns of every seventh: values move between places, none appears or goes."""
    c = _t(spark, sf, "conversations")
    move = (F.col("conv_id") % 4 == 0) if shifted else F.lit(False)
    swap = ((F.col("conv_id") % 7 == 0) & (F.col("turn") % 2 == 1)) if shifted else F.lit(False)
    gone = F.when(move, F.col("turn") % 3 == 1).otherwise(F.col("turn") % 3 == 0)
    text = F.when(~gone, F.col("text"))
    one = F.struct("turn", F.when(swap, text).otherwise(F.col("role")).alias("a"),
                   F.when(swap, F.col("role")).otherwise(text).alias("b"))
    out = c.groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("turns"), F.max("turn").alias("last"))
    return out.withColumn("sizes", F.create_map(F.lit("turns"), F.array(F.size("turns"), F.lit(None).cast("int"))))


def q_nested_rows_diff(spark, sf):
    """Row difference of nested rows (arrays of structs with moved nulls, maps of arrays), both sides
    from one pass."""
    from .operators.reconcile import SIDE, TIMES, row_differences
    d = row_differences(_threads(spark, sf, False), _threads(spark, sf, True))
    shown = F.array_join(F.transform("turns", lambda t: F.concat(
        t["turn"].cast("string"), F.lit(":"), F.coalesce(F.md5(t["a"]), F.lit("-")), F.lit(":"),
        F.coalesce(F.md5(t["b"]), F.lit("-")))), ",")
    return d.select("conv_id", shown.alias("turns"), F.col("sizes")["turns"][0].cast("long").alias("n_turns"),
                    F.col(SIDE).alias("side"), F.col(TIMES).alias("times"))


def q_nested_rows_diff_narrow(spark, sf):
    """The same difference narrowed by bucket signatures, ids of the rows only in the source."""
    s, t = reconcile_rows(_threads(spark, sf, False), _threads(spark, sf, True), "narrow")
    return (s.select("conv_id", F.lit("source").alias("side")).unionByName(t.select("conv_id", F.lit("target").alias("side"))))


def q_nested_keyed_diff(spark, sf):
    """Per-key status of nested rows whose nulls moved."""
    return keyed_diff(_threads(spark, sf, False), _threads(spark, sf, True), ["conv_id"])


def _typed_orders(spark, sf, changed: bool) -> DataFrame:
    """``orders`` in other types: as they are, or as a copy would hold them whose types were widened, with values
    that only the wider type can hold in some rows."""
    o = _t(spark, sf, "orders")
    k, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    price = F.col("o_totalprice").cast("decimal(12,2)")
    if not changed:
        return o.select(k, (k % 101).cast("int").alias("part"), F.col("o_custkey").cast("int").alias("customer"),
                        day.alias("day"), price.alias("price"), (k % 100).cast("byte").alias("small"))
    return o.select(
        (F.col("o_custkey") + F.when(k % 211 == 0, 0.7).otherwise(0.0)).alias("customer"), k,
        F.when(k % 223 == 0, F.to_timestamp(day) + F.expr("INTERVAL 5 HOURS")).otherwise(F.to_timestamp(day)).alias("day"),
        (price.cast("decimal(16,4)") + F.when(k % 227 == 0, F.lit("0.0001").cast("decimal(16,4)"))
         .otherwise(F.lit("0").cast("decimal(16,4)"))).cast("decimal(16,4)").alias("price"),
        ((k % 100) + F.when(k % 229 == 0, 1000).otherwise(0)).cast("short").alias("small"), (k % 101).alias("part"))


def q_type_changes(spark, sf):
    """``orders`` against a copy with wider types (int to double, date to timestamp, decimal scale, byte to short),
    compared in every form: keys of the rows that differ, partitions that differ, and the columns' changes."""
    from .operators.reconcile import reconcile_partitions, schema_changes
    s, t = _typed_orders(spark, sf, False), _typed_orders(spark, sf, True)
    out = [schema_changes(s, t.withColumn("day", F.col("day").cast("string"))).select(
        F.lit("schema").alias("form"), F.concat_ws(" ", "column", "change").alias("what"), F.lit(1).cast("long").alias("key"))]
    for form in ("exact", "narrow"):
        for side, rows in zip(("source", "target"), reconcile_rows(s, t, form)):
            out.append(rows.select(F.lit(form).alias("form"), F.lit(side).alias("what"), F.col("o_orderkey").alias("key")))
    out.append(keyed_diff(s, t, ["o_orderkey"]).select(F.lit("keyed").alias("form"), F.col("status").alias("what"),
                                                        F.col("o_orderkey").alias("key")))
    out.append(reconcile_partitions(s, t, ["part"]).select(F.lit("partitions").alias("form"), F.col("status").alias("what"),
                                                            F.col("part").cast("long").alias("key")))
    return functools.reduce(DataFrame.unionByName, out)


def q_rows_diff_tree(spark, sf):
    """``lineitem`` against a copy with changes scattered over all nodes of the hash tree's first level (rows
    gone, changed and doubled), found through the tree: every differing row with its side."""
    li = _t(spark, sf, "lineitem")
    h = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    v2 = li.where(h % 11 != 0).withColumn("l_quantity", F.when(h % 13 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")))
    s, t = reconcile_rows(li, v2.unionAll(v2.where(h % 29 == 0)), "narrow", buckets=1024)
    return s.withColumn("side", F.lit("source")).unionByName(t.withColumn("side", F.lit("target")))


def q_hot_repeats_diff(spark, sf):
    """A table whose rows repeat very often on one side only: how often each key is too often there."""
    o = _t(spark, sf, "orders").select("o_orderstatus", F.lit(1).alias("one"))
    s, t = reconcile_rows(o, o.where(F.col("o_orderstatus") == "P"))
    return s.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("times")).unionByName(
        t.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("times")))


@_report
def q_view_chain(spark, sf):
    """Thirty views, each over the next, named so that name order is reverse dependency order; the
    last one to be created is queried."""
    src, tgt = new_database(spark, "chain"), new_database(spark, "chaint")
    _external(spark, sf, src, "orders")
    for i in range(29, -1, -1):
        below = "orders" if i == 29 else f"v{i + 1:02d}"
        spark.sql(f"CREATE VIEW `{src}`.v{i:02d} AS SELECT * FROM `{src}`.{below}")
    vp = view_plan(inventory(spark, [src])).withColumn("target_schema", F.lit(tgt))
    out = migrate_views(spark, vp, view_mapping(vp), dry_run=False)
    made = outcome_counts(out, "outcome").withColumnRenamed("objects", "n")
    return made.unionByName(spark.table(f"`{tgt}`.v00").groupBy(F.col("o_orderstatus").alias("outcome"))
                            .agg(F.count(F.lit(1)).alias("n")))


def _registered(spark, sf, table: str, write) -> DataFrame:
    """An external table made by ``write(location)`` under another name, registered and read back."""
    src, tgt = new_database(spark, "regs"), new_database(spark, "regt")
    write(f"`{src}`.`{table}`", new_work_dir(spark, "reg it's") + "/data")
    inv = inventory(spark, [src])
    man = spark.createDataFrame([(src, table, tgt, table + "_new", False, 1)], "database string, name string, "
                                "target_schema string, target_table string, is_pii boolean, t_no int")
    none = spark.createDataFrame([], "table_catalog string, table_schema string, table_name string, table_type string")
    out = register_external(spark, plan_migration(inv, none, "spark_catalog", man), inv, dry_run=False).collect()
    assert [r["outcome"] for r in out] == ["REGISTERED"], out
    return spark.table(f"`{tgt}`.`{table}_new`")


def q_register_text_partition(spark, sf):
    """A table partitioned by numbers written as text ('01', '02') registered; the column stays text."""
    li = _t(spark, sf, "lineitem").withColumn("line", F.lpad(F.col("l_linenumber").cast("string"), 2, "0"))
    return _registered(spark, sf, "lineitem", lambda name, loc: li.write.partitionBy("line").option("path", loc)
                       .saveAsTable(name)).select(*li.columns)


def q_register_csv(spark, sf):
    """A CSV table with a header and quoted texts registered with its options."""
    c = _t(spark, sf, "customer")
    return _registered(spark, sf, "customer", lambda name, loc: c.write.format("csv").option("header", True)
                       .option("path", loc).saveAsTable(name))


def q_rewrite_long_literals(spark, sf):
    """SQL texts that hold whole documents as escaped string literals, table references around them
    rewritten; documents may look like references themselves."""
    d = _t(spark, sf, "documents")
    body = F.replace(F.replace(F.coalesce("text", F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("''"))
    q = d.select("doc_id", F.concat(F.lit("SELECT 'db.a "), body, F.lit(" db.a' AS t FROM db.a")).alias("text"))
    out = rewrite_references(q, "text", {"db.a": "x.y"}, out_col="new_text")
    return out.select("doc_id", F.md5("new_text").alias("new_md5"), F.length("new_text").cast("long").alias("n_chars"))


def q_manifest_files(spark, sf):
    """B1: one manifest written as JSON, CSV and two YAML files, each read back and typed."""
    from .sources.manifest import load_manifest, write_manifest
    man, root = man_df(spark, sf), new_work_dir(spark, "manfiles")
    write_manifest(man, root + "/json", "json")
    write_manifest(man, root + "/csv", "csv")
    entry = F.concat(F.lit("    "), F.col("name"), F.lit(":\n"), *[
        F.concat(F.lit(f"      {c}: "), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit("\n")) for c in man.columns])
    halves = (man.groupBy((F.col("t_no") % 2).alias("half")).agg(F.concat_ws("", F.collect_list(entry)).alias("body"))
              .select("half", F.concat(F.lit("resources:\n  tables:\n"), F.col("body")).alias("value")))
    # One file per half: the half's number is the partition's.
    halves.repartitionByRange(2, "half").select("value").write.text(root + "/yaml")
    parts = [load_manifest(spark, f"{root}/{fmt}", fmt)[0].withColumn("format", F.lit(fmt)) for fmt in ("json", "csv", "yaml")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_manifest_yaml_documents(spark, sf):
    """The manifest in YAML files of several documents each, some entries twice (told differently the second
    time) and some with a field twice: every entry that was written, with how often its key stands there."""
    from .sources.manifest import YAML_ROOT, YAML_TABLES, yaml_problems
    from .sources.yaml_entries import read_entries
    man, root = man_df(spark, sf), new_work_dir(spark, "mandocs") + "/yaml"

    def entry(target):
        fields = F.concat(F.lit("      name: "), F.col("name"), F.lit("\n      target_schema: "), target, F.lit("\n"))
        again = F.when(F.col("t_no") % 13 == 0, F.concat(F.lit("      name: "), F.col("name"), F.lit("\n"))).otherwise(F.lit(""))
        return F.concat(F.lit("    "), F.col("name"), F.lit(":\n"), fields, again)

    twice = F.when(F.col("t_no") % 5 == 0, entry(F.concat("target_schema", F.lit("_2")))).otherwise(F.lit(""))
    lines = man.select("t_no", F.concat(entry(F.col("target_schema")), twice).alias("e"))
    docs = lines.groupBy((F.col("t_no") % 8).alias("k")).agg(F.array_join(F.sort_array(F.collect_list("e")), "").alias("body"))
    docs = docs.select("k", F.concat(F.lit("---\nresources:\n  tables:\n"), F.col("body")).alias("value"))
    docs.repartitionByRange(3, "k").select("value").write.text(root)
    found = read_entries(spark, root, YAML_ROOT, YAML_TABLES).where("problem is null").select(
        "entry", F.col("fields")["target_schema"].alias("target_schema"))
    problems = yaml_problems(spark, root).groupBy(F.col("entry").alias("key"), "problem").agg(F.count(F.lit(1)).alias("n"))
    rows = found.groupBy("entry", "target_schema").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("entry").alias("key"), F.col("target_schema").alias("what"), "n")
    return rows.unionByName(problems.select("key", F.col("problem").alias("what"), "n"))


def q_manifest_order(spark, sf):
    """O1: the place of each table in a loaded manifest (its migration order) beside its ``t_no``."""
    from .operators.sequence import with_sequence
    from .sources.manifest import load_manifest, write_manifest
    path = new_work_dir(spark, "manorder") + "/json"
    write_manifest(man_df(spark, sf).withColumn("t_no", F.when(F.col("t_no") % 17 != 0, F.col("t_no"))).repartition(5, "name"), path, "json")
    loaded = load_manifest(spark, path, "json")[0].withColumn("_at", F.monotonically_increasing_id())
    return with_sequence(loaded, ["_at"], "place").select("database", "name", "t_no", "place")


def q_view_manifest(spark, sf):
    """A view manifest written as JSON and read back, one row per view."""
    from .sources.manifest import load_view_manifest
    m = man_df(spark, sf).select(F.col("database").alias("source_schema"), F.col("name").alias("source_view"),
                                 "target_schema", F.col("target_table").alias("target_view"))
    path = new_work_dir(spark, "vman") + "/data"
    m.unionAll(m).write.json(path)
    return load_view_manifest(spark, path)


def _text_table(spark, sf, db: str, table: str, columns: list[str], part: str | None = None) -> None:
    """A managed table of plain text lines, so that its bytes are known: a line per row."""
    line = F.concat_ws("|", *[F.col(c).cast("string") for c in columns]).alias("value")
    w = _t(spark, sf, table).select(line, *([part] if part else [])).write.format("text")
    (w.partitionBy(part) if part else w).saveAsTable(f"`{db}`.`{table}`")


#: Tables written as text lines: the columns of a line, and the partition column.
TEXT_TABLES = {"customer": (["c_custkey", "c_name", "c_mktsegment"], None),
               "orders": (["o_orderkey", "o_custkey", "o_orderpriority"], "o_orderstatus"),
               "documents": (["doc_id", "lang", "n_chars"], "source"), "lineitem": (["l_orderkey", "l_partkey", "l_linenumber"], None)}


@_report
def q_table_bytes(spark, sf):
    """Bytes of tables of text lines, from a listing made by tasks: the catalog's tables as the inventory
    sizes them, and the seconds that the estimate makes of them."""
    from .operators.estimate import estimate_manifest
    db = new_database(spark, "bytes")
    for t, (columns, part) in TEXT_TABLES.items():
        _text_table(spark, sf, db, t, columns, part)
    spark.sql(f"CREATE TABLE `{db}`.nothing (value STRING) USING text")
    inv = inventory(spark, [db], with_stats=True).select("name", "row_count", "bytes", "size_mb")
    man = inv.select(F.lit(db).alias("database"), "name", F.lit("uc").alias("target_schema"))
    per = estimate_manifest(spark, man, RATE, "seconds_per_mb")[0]
    return inv.join(per.select(F.col("table_name").alias("name"), "seconds", "elapsed"), "name")


class _Stopped(RuntimeError):
    pass


def _stop_after(n: int):
    """A unit watcher that ends the run at the unit after ``n``, as a lost driver would."""
    seen = []

    def watch(unit, state):
        seen.append(unit)
        if len(seen) > n:
            raise _Stopped(unit)
    return watch


def q_copy_journal(spark, sf):
    """K1, K2: ``lineitem`` (partitioned) copied in units, the run stopped after two of them, run again to the end, then
    again after the source lost a partition and gained rows: the target's rows."""
    from .operators.journal import copy_in_units
    db, loc = new_database(spark, "units"), new_work_dir(spark, "units") + "/data"
    _managed(spark, sf, db, "lineitem", ["l_returnflag", "l_linestatus"])
    src, dst = f"`{db}`.`lineitem`", f"`{db}`.`lineitem_ext`"
    try:
        copy_in_units(spark, src, dst, loc, unit_bytes=1 << 16, parallelism=1, on_unit=_stop_after(2))
    except _Stopped:
        pass
    first = copy_in_units(spark, src, dst, loc, unit_bytes=1 << 16)
    spark.sql(f"ALTER TABLE {src} DROP PARTITION (l_returnflag = 'N', l_linestatus = 'F')")
    spark.sql(f"INSERT INTO {src} BY NAME SELECT * FROM {src} WHERE l_returnflag = 'A'")
    again = copy_in_units(spark, src, dst, loc, unit_bytes=1 << 16)
    states = [{r["state"]: r["n"] for r in x.groupBy("state").agg(F.count(F.lit(1)).alias("n")).collect()} for x in (first, again)]
    assert states[0]["DONE_BEFORE"] == 2 and states[1]["DONE_BEFORE"] and states[1]["TAKEN_BACK"] and states[1]["COPIED"], states
    return spark.table(dst).select(*_t(spark, sf, "lineitem").columns)


def q_registered_declarations(spark, sf):
    """A table with char and varchar columns, comments, odd nested names, properties and a partition stored
    elsewhere, registered and copied: its declarations and rows as both targets have them."""
    src, tgt = new_database(spark, "decl"), new_database(spark, "declt")
    root = new_work_dir(spark, "decl")
    spark.sql(f"CREATE TABLE `{src}`.c (k BIGINT COMMENT 'it''s', name VARCHAR(30), seg CHAR(12), n STRUCT<`a-b`: INT, c: STRING>, "
              f"p INT) USING parquet PARTITIONED BY (p) LOCATION '{root}/base' COMMENT 'customers' TBLPROPERTIES ('path' = 'a\\\\b', 'q' = 'o\\'neil')")
    c = _t(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("seg"),
                                         F.struct(F.col("c_nationkey").alias("a-b"), F.col("c_name").alias("c")).alias("n"),
                                         (F.col("c_custkey") % 3).cast("int").alias("p"))
    c.where("p < 2").write.insertInto(f"`{src}`.c")
    c.where("p = 2").drop("p").write.parquet(f"{root}/else where")
    spark.sql(f"ALTER TABLE `{src}`.c ADD PARTITION (p = 2) LOCATION '{root}/else where'")
    inv = inventory(spark, [src])
    man = spark.createDataFrame([(src, "c", tgt, "c2", False, 1)], "database string, name string, target_schema string, "
                                "target_table string, is_pii boolean, t_no int")
    none = spark.createDataFrame([], "table_catalog string, table_schema string, table_name string, table_type string")
    out = register_external(spark, plan_migration(inv, none, "spark_catalog", man), inv, dry_run=False, owner="o'neil \\ co").collect()
    assert [r["outcome"] for r in out] == ["REGISTERED"], out
    copy_ops.copy_table(spark, f"`{src}`.c", f"`{tgt}`.c3", root + "/copy")
    facts = []
    for t in ("c2", "c3"):
        for r in spark.sql(f"SHOW TBLPROPERTIES `{tgt}`.{t}").collect():
            if r["key"] in ("path", "q", "migration.owner"):
                facts.append((t, r["key"], r["value"]))
    for r in spark.sql(f"DESCRIBE `{tgt}`.c2").collect():
        if r["col_name"] in ("k", "name", "seg", "n"):
            facts.append(("c2", r["col_name"], f"{r['data_type']} {r['comment'] or ''}".strip()))
    rows = [spark.table(f"`{tgt}`.{t}").select(F.lit(t).alias("t"), F.col("k").cast("string").alias("what"), F.concat_ws(
        "|", F.rtrim("name"), F.rtrim("seg"), F.col("n")["a-b"].cast("string"), F.col("n")["c"], F.col("p").cast("string")).alias("value"))
        for t in ("c2", "c3")]
    return rows[0].unionByName(rows[1]).unionByName(spark.createDataFrame(sorted(set(facts)), "t string, what string, value string"))


def q_rewrite_parsed(spark, sf):
    """A query text per supplier, with blanks and comments around dots, doubled back-ticks, an alias that is named
    like a database, sub-queries and common table expressions, rewritten as the parser reads them."""
    from .operators.references import rewrite_parsed
    t = F.concat(F.lit("t"), F.col("s_suppkey").cast("string"))
    k = F.col("s_suppkey") % 5
    text = (F.when(k == 0, F.concat(F.lit("SELECT seg.x FROM old . "), t, F.lit(" seg WHERE seg.x > 1")))
            .when(k == 1, F.concat(F.lit("SELECT * FROM `d``b`."), t, F.lit(" -- old."), t))
            .when(k == 2, F.concat(F.lit("WITH c AS (SELECT old."), t, F.lit(".x FROM old./* old.t */"), t, F.lit(") SELECT 'old."), t, F.lit("' FROM c")))
            .when(k == 3, F.concat(F.lit("SELECT old."), t, F.lit(" FROM other old WHERE EXISTS (SELECT 1 FROM cat.old."), t, F.lit(")")))
            .otherwise(F.concat(F.lit("SELECT old."), t, F.lit(".* FROM old."), t, F.lit(" JOIN x.y USING (id)"))))
    texts = _t(spark, sf, "supplier").select("s_suppkey", text.alias("text"))
    names = _t(spark, sf, "supplier").select(t.alias("t"))
    mapping = names.select(F.concat(F.lit("old."), "t").alias("key"), F.concat(F.lit("new.n_"), "t").alias("value")).unionByName(
        names.select(F.concat(F.lit("d`b."), "t").alias("key"), F.concat(F.lit("new.q-"), "t").alias("value")))
    return rewrite_parsed(texts, "text", mapping, "cat", "main").select("s_suppkey", "new_text")


def q_view_graph(spark, sf):
    """A view per supplier over the view of supplier k/2 (a tree of views), and for some suppliers two views that
    read each other: the level of each view and the cycle that it is part of."""
    from .operators.references import view_graph
    c = _t(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"))
    name = lambda k: F.concat(F.lit("v"), k.cast("string"))
    below = F.floor(F.col("k") / 2).cast("long")
    tree = c.select(name(F.col("k")).alias("v"), F.when(below == 0, F.lit("SELECT 1 AS a FROM base.t")).otherwise(
        F.concat(F.lit("SELECT * FROM s."), name(below))).alias("text")).where("v <> 'v0'")
    loops = c.where("k % 20 = 7")
    a, b = F.concat(F.lit("a"), F.col("k").cast("string")), F.concat(F.lit("b"), F.col("k").cast("string"))
    loop = loops.select(a.alias("v"), F.concat(F.lit("SELECT * FROM s."), b).alias("text")).unionByName(
        loops.select(b.alias("v"), F.concat(F.lit("SELECT 's.c' FROM s."), a, F.lit(" JOIN s."), name(F.col("k")), F.lit(" USING (a)")).alias("text")))
    views = tree.unionByName(loop)
    plan = views.select(F.lit("s").alias("source_schema"), F.col("v").alias("source_view"), F.lit("t").alias("target_schema"),
                        F.col("v").alias("target_view"), F.col("text").alias("view_text"))
    return view_graph(spark, plan, view_mapping(plan))


@_report
def q_conversion_rates(spark, sf):
    """Text tables of known size converted, in units and with verification: the megabytes of each, and
    whether the reported rate and elapsed text are those of its size and seconds."""
    db, root = new_database(spark, "rates"), new_work_dir(spark, "rates")
    for t, (columns, part) in TEXT_TABLES.items():
        _text_table(spark, sf, db, t, columns, part)
    man = spark.createDataFrame([(db, t, "uc", t, False, i) for i, t in enumerate(TEXT_TABLES)], "database string, name string, "
                                "target_schema string, target_table string, is_pii boolean, t_no int")
    out = convert_to_external(spark, plan_targets(man, CATALOG, root + "/pii", root + "/nonpii"), drop_old=True, verify="checksum",
                              parallelism=4, unit_bytes=1 << 18)
    sec = F.col("seconds")
    rate = F.when(sec > 0, F.col("size_mb") / sec).otherwise(0.0)
    text = F.concat_ws(":", F.lpad(F.floor(sec / 60).cast("string"), 2, "0"), F.lpad((F.floor(sec) % 60).cast("string"), 2, "0"))
    return out.select("name", "outcome", "source_rows", "size_mb", (F.abs(F.col("mb_per_s") - rate) < 1e-9).alias("rate_agrees"),
                      (F.col("elapsed") == text).alias("elapsed_agrees"))


@_report
def q_inventory_two_schemas(spark, sf):
    """Schemas listed but for an excluded one (in another case), inventories united."""
    from .sources.catalog import list_databases
    a, b, c = (new_database(spark, x) for x in ("inva", "invb", "invc"))
    _managed(spark, sf, a, "nation")
    _external(spark, sf, b, "region")
    _managed(spark, sf, c, "supplier")
    spark.sql(f"CREATE VIEW `{b}`.big AS SELECT * FROM `{b}`.region")
    dbs = list_databases(spark, [a, b, c], [c.upper()])
    inv = inventory(spark, dbs, with_stats=True)
    place = F.when(F.col("database") == a, "a").when(F.col("database") == b, "b").otherwise("c")
    return inv.select(place.alias("schema"), "name", "object_type", "row_count")


def q_checkpoint_csv_documents(spark, sf):
    """Whole documents (line breaks, quotes, blanks, empty texts) through a CSV checkpoint."""
    d = _t(spark, sf, "documents")
    path = new_work_dir(spark, "csvd") + "/data"
    copy_ops.write_csv(d, path)
    return copy_ops.read_csv(spark, path, d.schema)


@_report
def q_migrate_new_schema(spark, sf):
    """Migration into a schema that does not exist yet, with a renamed view and a view over it; what
    reconciliation still misses in the source is listed (nothing), next to the rows of the second view."""
    src = new_database(spark, "mns")
    tgt = src + "_target"
    _external(spark, sf, src, "orders")
    spark.sql(f"CREATE VIEW `{src}`.v1 AS SELECT o_orderstatus, o_totalprice FROM `{src}`.orders")
    spark.sql(f"CREATE VIEW `{src}`.v2 AS SELECT o_orderstatus, count(*) AS n FROM `{src}`.v1 GROUP BY o_orderstatus")
    man = spark.createDataFrame([(src, "orders", tgt, "orders", False, 1), (src.upper(), "V1", tgt, "a_renamed", False, 2),
                                 (src, "v2", tgt, "v2", False, 3)], "database string, name string, target_schema string, "
                                "target_table string, is_pii boolean, t_no int")
    res = migrate(spark, "all", [src], "spark_catalog", manifest=man, dry_run=False, source_catalog="spark_catalog")
    assert {r["outcome"] for r in res.views.collect()} == {"VIEW_CREATED"}, res.views.collect()
    missing = res.only_in_source.agg(F.count(F.lit(1)).alias("n")).select(F.lit("only_in_source").alias("item"), "n")
    return (missing.unionByName(spark.table(f"`{tgt}`.v2").select(F.col("o_orderstatus").alias("item"), "n"))
            .unionByName(spark.table(f"`{tgt}`.a_renamed").agg(F.count(F.lit(1)).alias("n")).select(F.lit("a_renamed").alias("item"), "n")))


QUERIES = {name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)}
