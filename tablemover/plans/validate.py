"""Post-migration validation (B13, B14 together): the checks a person reads after a migration.

Every list is expected to be empty except the two inventories themselves. ``summary`` counts all
of them in one job (a union of global counts), so a scheduler can alert on non-zero rows without
looking at the lists.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators.reconcile import not_upgraded, reconcile_inventory
from ..operators.select import exclude_schemas as _exclude


@dataclass
class Validation:
    external_tables: DataFrame
    not_upgraded: DataFrame
    target_tables: DataFrame
    tables_only_in_source: DataFrame
    tables_only_in_target: DataFrame
    views_only_in_source: DataFrame
    views_only_in_target: DataFrame

    def summary(self) -> DataFrame:
        """``(check, objects)`` for every list, computed in one job."""
        parts = [getattr(self, name).agg(F.count(F.lit(1)).alias("objects"))
                 .select(F.lit(name).alias("check"), "objects") for name in self.__dataclass_fields__]
        return reduce(DataFrame.unionAll, parts)


def validate(src_inv: DataFrame, dst_inv: DataFrame, exclude_schemas: list[str] | str | None = None,
             mapping: DataFrame | None = None) -> Validation:
    """``src_inv``: ``database, name, object_type, upgraded_to``; ``dst_inv``: the columns of
    ``information_schema.tables``, or an ``inventory()`` of the target (converted here);
    ``mapping``: a manifest to compare under target names."""
    if "table_schema" not in dst_inv.columns and {"database", "name", "object_type"} <= set(dst_inv.columns):
        dst_inv = dst_inv.select(F.coalesce(F.col("catalog"), F.lit(None).cast("string")).alias("table_catalog")
                                 if "catalog" in dst_inv.columns else F.lit(None).cast("string").alias("table_catalog"),
                                 F.col("database").alias("table_schema"), F.col("name").alias("table_name"),
                                 F.col("object_type").alias("table_type"))
    if "upgraded_to" not in src_inv.columns:
        src_inv = src_inv.withColumn("upgraded_to", F.lit(None).cast("string"))
    ext = _exclude(src_inv.where(F.col("object_type") == F.lit("EXTERNAL")), exclude_schemas, "database")
    tgt = dst_inv.where((F.col("table_schema") != F.lit("information_schema"))
                        & (F.col("table_type") == F.lit("EXTERNAL")))
    ts, tt = reconcile_inventory(src_inv, dst_inv, "EXTERNAL", exclude_schemas, mapping)
    vs, vt = reconcile_inventory(src_inv, dst_inv, "VIEW", exclude_schemas, mapping)
    return Validation(ext, not_upgraded(src_inv, exclude_schemas), tgt, ts, tt, vs, vt)
