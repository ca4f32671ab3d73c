"""Global 1-based row numbers in a given order, without sending every row to one task.

``row_number().over(Window.orderBy(k))`` has no partition key, so Spark moves the whole frame into
a single partition. Here rows are range-partitioned on the order, numbered inside each range, and
each range gets the count of the ranges before it as an offset. The per-range counts are one row
per partition (a proven bound), so broadcasting them is safe. The numbered ranges are checkpointed
to the shared checkpoint folder, so the counts and the rows they offset come from one materialised
copy even if tasks are retried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import MapType

from ..session import work_root


def with_sequence(df: DataFrame, order_cols: list[str], name: str = "t_no", start: int = 1,
                  partitions: int | None = None) -> DataFrame:
    spark = df.sparkSession
    work_root(spark)  # make sure a checkpoint folder is registered
    # Ties are broken by the other columns so the numbering is the same on every run; map columns
    # cannot be ordered and are left out of the tie-break.
    tie = [f.name for f in df.schema.fields if f.name not in order_cols and not isinstance(f.dataType, MapType)]
    order = [F.col(f"`{c}`").asc_nulls_first() for c in order_cols + tie]
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).withColumn("_tm_pid", F.spark_partition_id())
    local = ranged.withColumn("_tm_rn", F.row_number().over(Window.partitionBy("_tm_pid").orderBy(*order)))
    local = local.checkpoint(eager=True)
    counts = local.groupBy("_tm_pid").agg(F.count(F.lit(1)).alias("_tm_n"))
    before = Window.orderBy("_tm_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_tm_pid", F.coalesce(F.sum("_tm_n").over(before), F.lit(0)).alias("_tm_off"))
    return (local.join(F.broadcast(offsets), "_tm_pid")
            .withColumn(name, (F.col("_tm_off") + F.col("_tm_rn") + F.lit(start - 1)).cast("int"))
            .drop("_tm_pid", "_tm_rn", "_tm_off"))
