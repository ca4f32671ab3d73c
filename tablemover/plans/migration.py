"""Migration plan: one status row per object, no writes.

The dry run of a catalog migration as joins: manifest (optional) ⋈ source inventory ⋈ target
inventory ⋈ exclusion list. Every object gets exactly one status, by precedence:

``SOURCE_MISSING`` (named in the manifest, not in the inventory) > ``EXCLUDED`` > ``VIEW``
(recreated by ``migrate_views``) > ``MANAGED_SOURCE`` (convert to external first) >
``TARGET_EXISTS`` > ``READY``.

All joins are on small metadata frames (one row per table); each side is deduplicated on its key
first so that a name listed twice cannot multiply plan rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.names import quoted_full_name
from .. import schemas
from ..operators.select import one_per_key, parse_name_list

# Status codes and their descriptions.
DESCRIPTIONS = {
    "SOURCE_MISSING": "named in the manifest but not found in the source inventory",
    "EXCLUDED": "excluded by the exclusion list",
    "VIEW": "views are recreated with migrate_views",
    "MANAGED_SOURCE": "managed table: convert it to an external table first",
    "TARGET_EXISTS": "an object with the target name already exists",
    "READY": "external table ready to register in the target",
}


def plan_migration(inv: DataFrame, target_inv: DataFrame, catalog: str,
                   manifest: DataFrame | None = None, exclude: DataFrame | None = None,
                   exclude_schemas: list[str] | str | None = None,
                   source_catalog: str = "hive_metastore") -> DataFrame:
    """Status rows (``schemas.STATUS``) for every object of ``inv`` (or of ``manifest``)."""
    inv_k = one_per_key(inv.select("database", "name", "object_type").where(F.col("name").isNotNull()),
                        ["database", "name"])
    if manifest is not None:
        man = one_per_key(manifest.select("database", "name", "target_schema",
                                          F.coalesce("target_table", "name").alias("target_table"))
                          .where(F.col("name").isNotNull()), ["database", "name"])
        listed = inv_k.select(F.lower("database").alias("_db"), F.lower("name").alias("_nm"), "object_type")
        base = man.join(one_per_key(listed, ["_db", "_nm"]), (F.lower(man["database"]) == F.col("_db"))
                        & (F.lower(man["name"]) == F.col("_nm")), "left").drop("_db", "_nm")
    else:
        base = inv_k.select("database", "name", F.col("database").alias("target_schema"),
                            F.col("name").alias("target_table"), "object_type")
    tgt = (target_inv.where(F.col("table_schema") != F.lit("information_schema"))
           .select(F.lower("table_schema").alias("_ts"), F.lower("table_name").alias("_tn"))
           .distinct().withColumn("_exists", F.lit(True)))
    base = base.join(tgt, (F.lower(base["target_schema"]) == tgt["_ts"])
                     & (F.lower(base["target_table"]) == tgt["_tn"]), "left").drop("_ts", "_tn")
    excluded = F.lit(False)
    if exclude is not None:
        ex = exclude.select(F.lower("database").alias("_xd"), F.lower("name").alias("_xn")).distinct()
        ex = ex.withColumn("_excluded", F.lit(True))
        base = base.join(ex, (F.lower(base["database"]) == ex["_xd"]) & (F.lower(base["name"]) == ex["_xn"]), "left")
        excluded = F.coalesce(F.col("_excluded"), F.lit(False))
    xs = parse_name_list(exclude_schemas)
    if xs:
        excluded = excluded | F.coalesce(F.lower("database").isin(*[x.lower() for x in xs]), F.lit(False))
    status = (F.when(F.col("object_type").isNull(), F.lit("SOURCE_MISSING"))
              .when(excluded, F.lit("EXCLUDED"))
              .when(F.col("object_type") == F.lit("VIEW"), F.lit("VIEW"))
              .when(F.col("object_type") == F.lit("MANAGED"), F.lit("MANAGED_SOURCE"))
              .when(F.coalesce(F.col("_exists"), F.lit(False)), F.lit("TARGET_EXISTS"))
              .otherwise(F.lit("READY")))
    desc = F.lit(None).cast("string")
    for code, text in DESCRIPTIONS.items():
        desc = F.when(F.col("status_code") == F.lit(code), F.lit(text)).otherwise(desc)
    stmt = F.when(F.col("status_code") == F.lit("READY"), F.concat(
        F.lit("REGISTER "), quoted_full_name(F.lit(source_catalog), "database", "name"), F.lit(" AS "),
        quoted_full_name(F.lit(catalog), "target_schema", "target_table")))
    return (base.withColumn("status_code", status)
            .select(F.col("database").alias("source_schema"), F.col("name").alias("source_name"),
                    F.lit(catalog).alias("target_catalog"), "target_schema",
                    F.col("target_table").alias("target_name"), "status_code",
                    desc.alias("description"), stmt.alias("statement")))
