"""End-to-end driver glue (B20): argument checks, then plan -> register/convert -> views ->
reconcile -> report. It adds no operator of its own; every step is a function of this package."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.reconcile import reconcile_inventory
from ..operators.select import one_per_key, parse_name_list
from ..sources.catalog import database_exists, inventory, list_databases
from .convert import register_external
from .migration import plan_migration
from .report import outcome_counts
from .views import migrate_views, view_mapping, view_plan
from ..operators.rewrite import mapping_from_manifest

SCOPES = ("external-tables", "views", "all")

TARGET_LISTING = "table_catalog string, table_schema string, table_name string, table_type string"

log = logging.getLogger(__name__)


@dataclass
class MigrationResult:
    plan: DataFrame
    tables: DataFrame | None
    views: DataFrame | None
    counts: DataFrame
    only_in_source: DataFrame | None = None
    only_in_target: DataFrame | None = None


def target_inventory(inv: DataFrame, catalog: str) -> DataFrame:
    """An inventory in the shape of ``information_schema.tables``."""
    return inv.select(F.lit(catalog).alias("table_catalog"), F.col("database").alias("table_schema"),
                      F.col("name").alias("table_name"), F.col("object_type").alias("table_type"))


def migrate(spark: SparkSession, scope: str, schemas: str | list[str] = "all", catalog: str = "spark_catalog",
            target_schemas: list[str] | None = None, manifest: DataFrame | None = None,
            exclude: DataFrame | None = None, exclude_schemas: str | list[str] | None = None,
            owner: str | None = None, dry_run: bool = True, source_catalog: str = "hive_metastore",
            verify: str = "checksum", parallelism: int = 1,
            view_manifest: DataFrame | None = None) -> MigrationResult:
    if scope not in SCOPES:
        raise ValueError(f"scope {scope!r} not recognised; choose one of {', '.join(SCOPES)}")
    if not catalog:
        raise ValueError("a target catalog is needed")
    dbs = list_databases(spark, schemas, exclude_schemas)
    log.info("migrating %s of %d schema(s) to %s (%s)", scope, len(dbs), catalog, "dry run" if dry_run else "apply")
    inv = inventory(spark, dbs, parallelism=parallelism)
    if target_schemas is None:
        # The schemas objects will land in: the manifest's target schemas (a short metadata list),
        # else the source schema names.
        target_schemas = (sorted({r[0] for r in manifest.select("target_schema").distinct().collect() if r[0]})
                          if manifest is not None else dbs)
    tgt_dbs = [d for d in target_schemas if database_exists(spark, d, catalog)]
    tinv = target_inventory(inventory(spark, tgt_dbs, parallelism=parallelism, catalog=catalog), catalog) \
        if tgt_dbs else spark.createDataFrame([], TARGET_LISTING)
    plan = plan_migration(inv, tinv, catalog, manifest, exclude, exclude_schemas, source_catalog)
    tables = views = None
    if scope in ("external-tables", "all"):
        tables = register_external(spark, plan, inv, dry_run, verify, owner, parallelism)
    if scope in ("views", "all"):
        vp = view_plan(inv, catalog, view_manifest)
        if view_manifest is None and manifest is not None:
            # Views follow their schema's tables: one target schema per source schema (the
            # smallest name when a manifest splits a schema), so no view row is duplicated.
            per_db = manifest.groupBy(F.lower("database").alias("_db")).agg(F.min("target_schema").alias("_ts"))
            # A view that the manifest names goes where its own row says, under its own new name.
            named = one_per_key(manifest.select(F.lower("database").alias("_vd"), F.lower("name").alias("_vn"),
                                                F.col("target_schema").alias("_vs"),
                                                F.coalesce("target_table", "name").alias("_vt"))
                                .where(F.col("_vd").isNotNull() & F.col("_vn").isNotNull()), ["_vd", "_vn"])
            vp = (vp.join(per_db, F.lower("source_schema") == F.col("_db"), "left")
                  .join(named, (F.lower("source_schema") == F.col("_vd")) & (F.lower("source_view") == F.col("_vn")), "left")
                  .withColumn("target_schema", F.coalesce("_vs", "_ts", "target_schema"))
                  .withColumn("target_view", F.coalesce("_vt", "target_view"))
                  .drop("_db", "_ts", "_vd", "_vn", "_vs", "_vt"))
        # Excluded objects and schemas are left alone, views included.
        xs = parse_name_list(exclude_schemas)
        if xs:
            vp = vp.where(~F.lower("source_schema").isin(*[x.lower() for x in xs]))
        if exclude is not None:
            ex = exclude.select(F.lower("database").alias("_xd"), F.lower("name").alias("_xn")).distinct()
            vp = vp.join(ex, (F.lower("source_schema") == F.col("_xd")) & (F.lower("source_view") == F.col("_xn")), "left_anti")
        # Old -> new names of the tables of the manifest and of the views themselves, so views over
        # tables and views over views both point at the migrated objects.
        mapping = view_mapping(vp)
        if manifest is not None:
            mapping = mapping_from_manifest(manifest).unionByName(mapping)
        views = migrate_views(spark, vp, mapping, source_catalog, catalog, dry_run, owner, target_catalog=catalog)
    counts = outcome_counts(plan)
    res = MigrationResult(plan, tables, views, counts)
    if not dry_run and (tables is not None or views is not None):
        # Everything planned READY must now exist under its target name; anything else in the
        # target schemas that the plan did not account for shows up as only in the target. The
        # schemas are looked up again: this run may have made them.
        tgt_dbs = [d for d in target_schemas if database_exists(spark, d, catalog)]
        ready = plan.where(F.col("status_code") == F.lit("READY")).select(
            F.col("source_schema").alias("database"), F.col("source_name").alias("name"))
        planned = inv.join(ready, ["database", "name"], "left_semi").withColumn(
            "upgraded_to", F.lit(None).cast("string"))
        accounted = plan.where(F.col("status_code") != F.lit("READY")).select(
            F.lower("target_schema").alias("_s"), F.lower("target_name").alias("_n")).distinct()
        after = (target_inventory(inventory(spark, tgt_dbs, catalog=catalog), catalog) if tgt_dbs
                 else spark.createDataFrame([], TARGET_LISTING))
        after = after.join(accounted, (F.lower("table_schema") == F.col("_s")) & (F.lower("table_name") == F.col("_n")),
                           "left_anti")
        mapping = plan.select(F.col("source_schema").alias("database"), F.col("source_name").alias("name"),
                              "target_schema", F.col("target_name").alias("target_table"))
        res.only_in_source, res.only_in_target = reconcile_inventory(planned, after, "EXTERNAL", None, mapping)
    return res
