"""Selecting what to migrate: include by manifest, exclude tables, exclude schemas.

Semi and anti joins on ``(database, name)``. A manifest or exclusion list is small next to the
tables it names, but its size is not known here, so the join strategy is left to the optimizer
and AQE (broadcast when the runtime size is under ``spark.sql.autoBroadcastJoinThreshold``,
otherwise a shuffle join whose hot partitions AQE splits). Keys are deduplicated first so a list
that names a table twice cannot duplicate rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

KEYS = ["database", "name"]


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the smallest of the other columns (as a struct), so the pick is the same
    on every run -- unlike ``dropDuplicates(keys)``, which keeps whichever row comes first. Meant
    for metadata frames (manifests, inventories)."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    return (df.groupBy(*keys).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("_r"))
            .select(*keys, *[F.col("_r").getField(c).alias(c) for c in rest]))


def parse_name_list(text: str | list[str] | None) -> list[str]:
    """``"a, b ,c"`` -> ``["a", "b", "c"]``; blanks removed; empty text means no list. The names of a list
    are taken as they are, but for blanks around them: a name may hold a space."""
    if text is None:
        return []
    if isinstance(text, (list, tuple)):
        return [t for t in (s.strip() for s in text) if t]
    return [t for t in text.replace(" ", "").split(",") if t]


def _folded(df: DataFrame, other: DataFrame, keys: list[str]):
    """``other``'s distinct keys in lower case under internal names, and the join condition: metastore
    names don't differ by case."""
    names = [f"_tm_key{i}" for i in range(len(keys))]
    o = other.select(*[F.lower(F.col(f"`{k}`")).alias(n) for k, n in zip(keys, names)]).distinct()
    return o, [F.lower(df[f"`{k}`"]) == o[n] for k, n in zip(keys, names)]


def include_tables(inv: DataFrame, manifest: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Inventory rows named in the manifest (EXISTS), whatever the case of the names."""
    return inv.join(*_folded(inv, manifest, keys), "left_semi")


def exclude_tables(inv: DataFrame, exclusion: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Inventory rows not named in the exclusion list (NOT EXISTS), whatever the case of the names; an
    empty list keeps all."""
    return inv.join(*_folded(inv, exclusion, keys), "left_anti")


def exclude_schemas(inv: DataFrame, schemas: list[str] | str | None, col: str = "database") -> DataFrame:
    """``col NOT IN (schemas)``. A null schema is dropped, as SQL ``NOT IN`` does; an empty list is
    no filter at all (``NOT IN ()`` is not valid SQL)."""
    xs = parse_name_list(schemas)
    if not xs:
        return inv
    # The exact names are pushed to the scan; the folded ones catch other spellings.
    return inv.where(~F.col(col).isin(*xs) & ~F.lower(F.col(col)).isin(*[x.lower() for x in xs]))


def select_tables(inv: DataFrame, include: DataFrame | None = None, exclude: DataFrame | None = None,
                  exclude_schema_list: list[str] | str | None = None) -> DataFrame:
    out = inv
    if include is not None:
        out = include_tables(out, include)
    if exclude is not None:
        out = exclude_tables(out, exclude)
    return exclude_schemas(out, exclude_schema_list)
