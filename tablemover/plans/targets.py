"""Target names and storage locations for each manifest row."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.names import full_name, location_for, quoted_full_name


def plan_targets(manifest: DataFrame, catalog: str, pii_root: str, nonpii_root: str,
                 source_catalog: str = "hive_metastore") -> DataFrame:
    """Per manifest row: source and target names (plain and quoted) and the external location.

    The location is ``<root>/<target_schema>/<target_table>`` with the PII root when ``is_pii`` is
    true or unknown. The target name is built from its parts -- no text replacement of a catalog
    name inside a longer name.
    """
    tt = F.coalesce(F.col("target_table"), F.col("name"))
    return manifest.select(
        "database", "name", "target_schema", tt.alias("target_table"), "is_pii", "t_no",
        full_name(F.lit(source_catalog), "database", "name").alias("source_full_name"),
        full_name(F.lit(catalog), "target_schema", tt).alias("target_full_name"),
        quoted_full_name(F.lit(source_catalog), "database", "name").alias("source_quoted"),
        quoted_full_name(F.lit(catalog), "target_schema", tt).alias("target_quoted"),
        location_for("is_pii", pii_root, nonpii_root, "target_schema", tt).alias("location"))
