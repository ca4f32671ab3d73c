"""Transfer-time estimate from table sizes.

Two readings of the rate, both named: ``seconds_per_mb`` multiplies MB by the rate (what the
estimate notebooks compute); ``mb_per_second`` divides MB by it (the unit the conversion report
measures). Totals are computed from the exact integer byte total, so they do not depend on the
order in which per-table doubles are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.timefmt import mm_ss

MODES = ("seconds_per_mb", "mb_per_second")

# Fixed value: bytes per MB as the migration reports count them (decimal megabytes).
BYTES_PER_MB = 1e6


def _seconds(mb: Column, rate: float, mode: str) -> Column:
    if mode == "seconds_per_mb":
        return mb * F.lit(float(rate))
    if mode == "mb_per_second":
        return mb / F.lit(float(rate))
    raise ValueError(f"mode must be one of {MODES}")


def estimate_transfer(sizes: DataFrame, rate: float, mode: str = "mb_per_second",
                      schema_col: str = "target_schema", table_col: str = "table_name",
                      bytes_col: str = "bytes") -> tuple[DataFrame, DataFrame]:
    """Per table ``(target_schema, table_name, size_mb, elapsed, seconds)`` and one totals row
    ``(seconds, minutes, hours)``. Sizes are bytes; MB is 10^6 bytes. A table with an unknown size
    (a view) gets null, not zero."""
    rate = float(rate)
    if rate <= 0:
        raise ValueError("rate must be positive")
    mb = F.col(bytes_col).cast("double") / F.lit(BYTES_PER_MB)
    sec = _seconds(mb, rate, mode)
    per_table = sizes.select(F.col(schema_col).alias("target_schema"), F.col(table_col).alias("table_name"),
                             mb.alias("size_mb"), mm_ss(sec).alias("elapsed"), sec.alias("seconds"))
    total_sec = _seconds(F.sum(F.col(bytes_col).cast("long")).cast("double") / F.lit(BYTES_PER_MB), rate, mode)
    totals = sizes.agg(F.coalesce(total_sec, F.lit(0.0)).alias("seconds")).select(
        "seconds", (F.col("seconds") / 60).alias("minutes"), (F.col("seconds") / 3600).alias("hours"))
    return per_table, totals


def estimate_manifest(spark, manifest: DataFrame, rate: float, mode: str = "mb_per_second",
                      inventory_df: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The estimate workflow for a manifest: (per_table, totals, skipped).

    Tables of the manifest are matched with the inventory of their databases; managed tables are
    sized (``table_stats``: file metadata only) and estimated. Missing and non-managed tables are
    returned in ``skipped`` with a reason instead of being dropped silently.
    """
    from ..sources.catalog import inventory
    from ..sources.listing import table_locations
    from ..sources.stats import table_stats

    from .select import one_per_key
    man = one_per_key(manifest.select("database", "name", "target_schema"), ["database", "name"])
    if inventory_df is None:
        dbs = sorted({r["database"] for r in man.select("database").distinct().collect() if r["database"]})
        dbs = [d for d in dbs if spark.catalog.databaseExists(d)]
        inventory_df = inventory(spark, dbs)
    j = man.join(inventory_df.select("database", "name", "object_type"), ["database", "name"], "left")
    skipped = j.where(F.col("object_type").isNull() | (F.col("object_type") != F.lit("MANAGED"))).select(
        "database", "name", F.when(F.col("object_type").isNull(), F.lit("SOURCE_MISSING"))
        .otherwise(F.concat(F.lit("NOT_MANAGED_"), F.col("object_type"))).alias("reason"))
    managed = [(r["database"], r["name"], r["target_schema"]) for r in
               j.where(F.col("object_type") == F.lit("MANAGED")).select("database", "name", "target_schema").collect()]
    if not managed:
        empty = spark.createDataFrame([], "target_schema string, table_name string, bytes long")
        per, tot = estimate_transfer(empty, rate, mode)
        return per, tot, skipped
    label = {f"{d}.{n}": (d, ts, n) for d, n, ts in managed}
    # One unreadable table must not sink the estimate of the others: it is listed as skipped.
    locations = {f"{d}.{n}": table_locations(spark, f"`{d}`.`{n}`") for d, n, _ in managed}
    stats = table_stats({f"{d}.{n}": spark.table(f"`{d}`.`{n}`") for d, n, _ in managed}, errors="isolate", rows=False,
                        locations=locations)
    keys = spark.createDataFrame([(k, d, ts, n) for k, (d, ts, n) in label.items()],
                                 "table_name string, database string, target_schema string, name string")
    j2 = stats.join(keys, "table_name")
    sizes = j2.where(F.col("error").isNull()).select("target_schema", F.col("name").alias("table_name"), "bytes")
    broken = j2.where(F.col("error").isNotNull()).select(
        "database", "name", F.concat(F.lit("STATS_FAILED: "), F.col("error")).alias("reason"))
    per, tot = estimate_transfer(sizes, rate, mode)
    return per, tot, skipped.unionByName(broken)
