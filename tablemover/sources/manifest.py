"""Table and view manifests (B1, B2).

A manifest is a small typed table: ``database, name, target_schema, target_table, is_pii, t_no``,
keyed by ``(database, name)`` -- not by bare table name, so two schemas may hold tables of the
same name. It can be read from JSON lines, CSV with a header, Parquet, or the nested YAML layout
``resources: {tables: {<key>: {...}}}`` that migration notebooks commonly use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.sequence import with_sequence
from ..session import pinned
from ..schemas import MANIFEST, MANIFEST_CSV, VIEW_MANIFEST
from .yaml_entries import read_entries

KEYS = ["database", "name"]

# The nested YAML manifest layout -- the top key, then the table and view sections.
YAML_ROOT, YAML_TABLES, YAML_VIEWS = "resources", "tables", "views"

# Texts read as true / false in the is_pii column (compared lower-cased, trimmed).
TRUE_TEXTS = ["true", "t", "yes", "y", "1"]
FALSE_TEXTS = ["false", "f", "no", "n", "0"]


def parse_flag(c) -> F.Column:
    """Text or boolean -> boolean; anything else -> null (treated as PII downstream)."""
    t = F.lower(F.trim(F.col(c).cast("string") if isinstance(c, str) else c.cast("string")))
    return F.when(t.isin(*TRUE_TEXTS), F.lit(True)).when(t.isin(*FALSE_TEXTS), F.lit(False))


def _read_yaml(spark: SparkSession, path: str, leaf: str) -> DataFrame:
    """All entries as text columns. One entry told differently by two files is an error; what is wrong within a
    file is in :func:`yaml_problems`."""
    entries, _ = pinned(read_entries(spark, path, YAML_ROOT, leaf).where("problem is null"), "entries")
    text = F.to_json(F.map_from_entries(F.array_sort(F.map_entries("fields"))))
    differs = (entries.groupBy("entry").agg(F.count_distinct("file").alias("files"), F.count_distinct(text).alias("texts"),
                                            F.min("file").alias("a"), F.max("file").alias("b"))
               .where((F.col("files") > 1) & (F.col("texts") > 1)).orderBy("entry").first())
    if differs:
        raise ValueError(f"entry {differs['entry']!r} differs between {differs['a']} and {differs['b']}")
    schema = MANIFEST if leaf == YAML_TABLES else VIEW_MANIFEST
    return entries.select(*[F.col("fields")[f.name].alias(f.name) for f in schema.fields])


def yaml_problems(spark: SparkSession, path: str, leaf: str = YAML_TABLES) -> DataFrame:
    """(file, document, line, entry, problem, detail): what is wrong inside the YAML files of a manifest --
    keys that stand twice at any level, entries without fields, texts that don't parse, files without entries."""
    return read_entries(spark, path, YAML_ROOT, leaf).where("problem is not null").drop("fields")


def read_manifest(spark: SparkSession, path: str, fmt: str = "json", leaf: str = YAML_TABLES) -> DataFrame:
    """Raw manifest rows with text columns; see ``load_manifest`` for the typed form."""
    if fmt == "yaml":
        return _read_yaml(spark, path, leaf)
    schema = MANIFEST if leaf == YAML_TABLES else VIEW_MANIFEST
    text_schema = ", ".join(f"{f.name} string" for f in schema.fields)
    if fmt == "csv":
        return spark.read.option("header", True).schema(text_schema).csv(path)
    if fmt == "json":
        return spark.read.schema(text_schema).json(path)
    return spark.read.format(fmt).load(path).select(
        *[F.col(f.name).cast("string").alias(f.name) for f in schema.fields])


def type_manifest(raw: DataFrame) -> DataFrame:
    """Cast to the manifest schema; ``target_table`` defaults to ``name``."""
    return raw.select(
        F.col("database").cast("string").alias("database"),
        F.col("name").cast("string").alias("name"),
        F.col("target_schema").cast("string").alias("target_schema"),
        F.coalesce(F.col("target_table").cast("string"), F.col("name").cast("string")).alias("target_table"),
        parse_flag("is_pii").alias("is_pii"),
        F.col("t_no").cast("string").try_cast("int").alias("t_no"))


def dedup_manifest(df: DataFrame) -> DataFrame:
    """Drop exact duplicate rows (a table listed twice the same way)."""
    return df.dropDuplicates()


def manifest_problems(df: DataFrame) -> DataFrame:
    """Rows a migration cannot use as they are: ``(database, name, row_count, problem)``.

    ``DUPLICATE_KEY``: one ``(database, name)`` with different rows (after exact duplicates are
    dropped); ``NULL_KEY``: database or name missing; ``NULL_TARGET``: no target schema (no target
    name or location can be built).
    """
    d = df.dropDuplicates()
    dup = (d.where(F.col("database").isNotNull() & F.col("name").isNotNull())
           .groupBy(*KEYS).agg(F.count(F.lit(1)).alias("row_count"))
           .where(F.col("row_count") > 1).withColumn("problem", F.lit("DUPLICATE_KEY")))
    nul = (d.where(F.col("database").isNull() | F.col("name").isNull())
           .groupBy(*KEYS).agg(F.count(F.lit(1)).alias("row_count")).withColumn("problem", F.lit("NULL_KEY")))
    tgt = (d.where(F.col("database").isNotNull() & F.col("name").isNotNull() & F.col("target_schema").isNull())
           .groupBy(*KEYS).agg(F.count(F.lit(1)).alias("row_count")).withColumn("problem", F.lit("NULL_TARGET")))
    return dup.unionByName(nul).unionByName(tgt)


def load_manifest(spark: SparkSession, path: str, fmt: str = "json") -> tuple[DataFrame, DataFrame]:
    """Typed, deduplicated manifest ordered by ``t_no``, and its problem rows: those of ``manifest_problems``, and
    for YAML those of ``yaml_problems`` with their file and line (``name`` is the entry, ``row_count`` null)."""
    typed = dedup_manifest(type_manifest(read_manifest(spark, path, fmt)))
    problems = manifest_problems(typed)
    if fmt == "yaml":
        problems = problems.unionByName(yaml_problems(spark, path).select(
            F.lit(None).cast("string").alias("database"), F.col("entry").alias("name"),
            F.lit(None).cast("long").alias("row_count"), "problem", "file", "line", "detail"), allowMissingColumns=True)
    return typed.orderBy(F.col("t_no").asc_nulls_last(), *KEYS), problems


def load_view_manifest(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    raw = read_manifest(spark, path, fmt, leaf=YAML_VIEWS)
    return raw.select(*[F.col(f.name).cast("string") for f in VIEW_MANIFEST.fields]).dropDuplicates()


def build_manifest(rows: DataFrame, order_cols: list[str] | None = None) -> DataFrame:
    """Manifest from listing rows (``name, database, target_schema, is_pii`` and optionally
    ``target_table``): ``target_table`` defaults to ``name``, ``is_pii`` becomes boolean and
    ``t_no`` numbers the rows 1..n in ``order_cols`` order (default: database, name).
    """
    cols = set(rows.columns)
    base = rows.select(
        F.col("database").cast("string").alias("database"),
        F.col("name").cast("string").alias("name"),
        F.col("target_schema").cast("string").alias("target_schema"),
        (F.coalesce(F.col("target_table").cast("string"), F.col("name").cast("string"))
         if "target_table" in cols else F.col("name").cast("string")).alias("target_table"),
        parse_flag("is_pii").alias("is_pii"),
        *[F.col(c) for c in (order_cols or []) if c not in MANIFEST.fieldNames()])
    numbered = with_sequence(base, order_cols or KEYS, "t_no")
    return numbered.select(*MANIFEST.fieldNames())


def read_manifest_csv(spark: SparkSession, path: str) -> DataFrame:
    """The people-written CSV: header ``name, database, target_schema, is_pii``."""
    return spark.read.option("header", True).schema(MANIFEST_CSV).csv(path)


def manifest_from_csv(spark: SparkSession, path: str) -> DataFrame:
    """Manifest from the people-written CSV with ``t_no`` = row order in the file(s).

    Row order is taken from the scan itself: the file path, then ``monotonically_increasing_id``,
    which inside one scan stage grows with split index and row position -- the same on every
    recomputation of the same files -- and is numbered 1..n by ``with_sequence``.
    """
    raw = read_manifest_csv(spark, path).select(
        "*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_row"))
    return build_manifest(raw, ["_file", "_row"])


def write_manifest(df: DataFrame, path: str, fmt: str = "json", mode: str = "errorifexists") -> None:
    df.select(*MANIFEST.fieldNames()).write.mode(mode).format(fmt).option("header", True).save(path)
