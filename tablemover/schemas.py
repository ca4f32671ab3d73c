"""Fixed schemas of the toolkit's inputs and outputs."""

from pyspark.sql.types import (BooleanType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType)


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


S = StringType()

# Table manifest: what to migrate, one row per (database, name).
MANIFEST = _s(("database", S), ("name", S), ("target_schema", S), ("target_table", S),
              ("is_pii", BooleanType()), ("t_no", IntegerType()))

# Manifest as people write it (CSV with a header); is_pii kept as text until parsed.
MANIFEST_CSV = _s(("name", S), ("database", S), ("target_schema", S), ("is_pii", S))

VIEW_MANIFEST = _s(("source_schema", S), ("source_view", S), ("target_schema", S), ("target_view", S))


# Source inventory, the columns an assessment of the old metastore produces.

# Target inventory, the shape of information_schema.tables.
TARGET_INVENTORY = _s(("table_catalog", S), ("table_schema", S), ("table_name", S), ("table_type", S))

STATUS = _s(("source_schema", S), ("source_name", S), ("target_catalog", S), ("target_schema", S),
            ("target_name", S), ("status_code", S), ("description", S), ("statement", S))

CONVERSION = _s(("database", S), ("name", S), ("target_schema", S), ("target_table", S),
                ("location", S), ("t_no", IntegerType()), ("outcome", S), ("reason", S),
                ("source_rows", LongType()), ("target_rows", LongType()), ("size_mb", DoubleType()),
                ("seconds", DoubleType()), ("elapsed", S), ("mb_per_s", DoubleType()))

VIEW_OUTCOME = _s(("source_view", S), ("target_view", S), ("outcome", S), ("reason", S),
                  ("statement", S))
