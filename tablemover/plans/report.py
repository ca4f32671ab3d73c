"""Migration report (B17): counts per outcome and the lists a person has to look at."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

INELIGIBLE = ["SOURCE_MISSING", "MANAGED_SOURCE", "TARGET_EXISTS"]


def outcome_counts(outcomes: DataFrame, col: str = "status_code") -> DataFrame:
    """``(outcome, objects)`` per distinct outcome."""
    return outcomes.groupBy(F.col(col).alias("outcome")).agg(F.count(F.lit(1)).alias("objects"))


def ineligible(plan: DataFrame, default_schema: str = "default") -> tuple[DataFrame, DataFrame]:
    """(managed tables outside the default schema, other ineligible objects).

    The default schema is matched on the schema column, not by a substring of the full name, so a
    table called ``my_default_t`` is not mistaken for one in ``default``.
    """
    managed = plan.where((F.col("status_code") == F.lit("MANAGED_SOURCE"))
                         & ~F.coalesce(F.lower(F.col("source_schema")) == F.lit(default_schema.lower()), F.lit(False)))
    other = plan.where(F.col("status_code").isin(*[s for s in INELIGIBLE if s != "MANAGED_SOURCE"]))
    return managed, other


def conversion_failures(conv: DataFrame) -> DataFrame:
    """``(full_name, t_no, reason)`` for conversions that did not end converted or skipped."""
    bad = ~F.col("outcome").isin("CONVERTED", "CONVERTED_DROPPED", "PLANNED") & ~F.col("outcome").startswith("SKIPPED_")
    return conv.where(bad).select(F.concat_ws(".", "database", "name").alias("full_name"), "t_no",
                                  F.concat_ws(": ", "outcome", "reason").alias("reason"))


def conversion_summary(conv: DataFrame) -> DataFrame:
    """``(target_schema, table_name, elapsed, size_mb, mb_per_s)`` of converted tables."""
    return conv.where(F.col("outcome").isin("CONVERTED", "CONVERTED_DROPPED")).select(
        "target_schema", F.col("name").alias("table_name"), "elapsed", "size_mb", "mb_per_s")


def migration_summary(plan: DataFrame, tables: DataFrame | None = None, views: DataFrame | None = None,
                      default_schema: str = "default") -> DataFrame:
    """``(category, objects)``: the counts a person checks after a catalog migration -- objects not
    eligible (managed tables outside the default schema listed apart from the rest), tables
    migrated and failed, views migrated and failed. One job: a union of global counts."""
    managed, other = ineligible(plan, default_schema)
    parts = [("NOT_ELIGIBLE", plan.where(F.col("status_code").isin(*INELIGIBLE))),
             ("MANAGED_OUTSIDE_DEFAULT", managed), ("OTHER_NOT_ELIGIBLE", other)]
    if tables is not None:
        parts += [("MIGRATED_TABLES", tables.where(F.col("outcome").isin("REGISTERED", "DRY_RUN"))),
                  ("FAILED_TABLES", tables.where(~F.col("outcome").isin("REGISTERED", "DRY_RUN")))]
    if views is not None:
        parts += [("MIGRATED_VIEWS", views.where(F.col("outcome").isin("VIEW_CREATED", "DRY_RUN"))),
                  ("FAILED_VIEWS", views.where(~F.col("outcome").isin("VIEW_CREATED", "DRY_RUN")))]
    counts = [df.agg(F.count(F.lit(1)).alias("objects")).select(F.lit(name).alias("category"), "objects")
              for name, df in parts]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionAll(c)
    return out
