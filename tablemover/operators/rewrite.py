"""Rewriting table references in SQL texts (B12): view definitions, query logs.

Two rules:

* ``rewrite_catalog`` -- the literal rule: every ``hive_metastore`` (optionally back-ticked)
  becomes the back-ticked destination catalog, wherever it occurs. Kept for compatibility with
  notebooks that did exactly this; it also hits inside longer words.
* ``rewrite_references`` -- the token rule: the text is split losslessly into tokens
  (``functions.tokens``); each dotted identifier ``[catalog.]schema.table[.rest]`` is looked up by
  its lower-cased ``schema.table`` in the mapping, replaced in one pass (so ``a->b`` and ``b->c``
  never chain), the source catalog is swapped for the target catalog, and literals, comments and
  longer names are left alone.

Plan of the token rule (all built-in expressions):

1. tokenize each text with one regex pass (``regexp_extract_all``);
2. ``posexplode`` the tokens and keep the dotted identifiers only -- from here on the per-token
   work (split into parts, catalog test, key) is ordinary whole-stage-codegen expressions over
   rows instead of interpreted lambdas over arrays;
3. join the candidates with the mapping on the key: adaptive execution broadcasts the mapping when
   its measured size is under the adaptive broadcast threshold, otherwise the shuffle join stays,
   which AQE can split when a key is hot;
4. gather the replacements of each text into a ``position -> new token`` map (bounded by the
   text's own length), join it back to the texts on an internal id and swap the tokens by position.

Texts without any candidate never reach the join; a text's tokens are never written or shuffled: only its
candidate identifiers are, and the text itself, which is split again where its replacements are. The texts are dealt
evenly over tasks and written once, with a fixed id, as Parquet in the scratch folder, so rows with null or repeated
keys of their own are rewritten like all others.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.tokens import NAME_PART, SQL_TOKEN
from ..session import pinned


# Fixed values of the literal catalog rule: an optional back-tick, the catalog name, an optional
# back-tick; replaced by the destination catalog in back-ticks.
CATALOG_PATTERN = "`?{name}`?"
CATALOG_REPLACEMENT = "`{name}`"


def rewrite_catalog(text, catalog_from: str = "hive_metastore", catalog_to: str = "main") -> Column:
    """Literal rule: ``(`)?catalog_from(`)?`` -> ```catalog_to``` everywhere in the text."""
    t = F.col(text) if isinstance(text, str) else text
    replacement = catalog_to.replace("\\", "\\\\").replace("$", "\\$")  # literal in a Java replacement
    return F.regexp_replace(t, CATALOG_PATTERN.format(name=re.escape(catalog_from)),
                            CATALOG_REPLACEMENT.format(name=replacement))


def _unquote(p: Column) -> Column:
    return F.when(F.instr(p, "`") > 0, F.regexp_replace(p, r"^`|`$", "")).otherwise(p)


def _is_dotted(token: Column) -> Column:
    """Whether a token of ``tokens`` is an identifier of several parts: one that begins with a word character or a
    back-tick, and holds a dot. Only beginnings outside ASCII need a pattern."""
    c = F.ascii(token)
    word = c.between(97, 122) | c.between(65, 90) | c.between(48, 57) | c.isin(95, 96)
    return (F.instr(token, ".") > 0) & (word | ((c > 127) & token.rlike(r"(?U)^\w")))


def _name_parts(token: Column) -> Column:
    return F.when(F.instr(token, "`") > 0, F.regexp_extract_all(token, F.lit(NAME_PART), 1)).otherwise(F.split(token, r"\."))


def _render(name: Column) -> Column:
    """``schema.table`` text -> each part back-ticked only when it needs it."""
    parts = F.split(name, r"\.")
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike(r"(?U)^\w+$"), p)
                                    .otherwise(F.concat(F.lit("`"), F.replace(p, F.lit("`"), F.lit("``")), F.lit("`")))), ".")


def _key(parts: Column, has_cat: Column) -> Column:
    i = F.when(has_cat, F.lit(2)).otherwise(F.lit(1))
    return F.when(F.size(parts) >= i + 1, F.lower(F.concat(
        _unquote(F.try_element_at(parts, i)), F.lit("."), _unquote(F.try_element_at(parts, i + 1)))))


def _has_cat(parts: Column, catalog_from: str | None) -> Column:
    if not catalog_from:
        return F.lit(False)
    return (F.size(parts) >= 3) & (F.lower(_unquote(F.try_element_at(parts, F.lit(1)))) == F.lit(catalog_from.lower()))


def tokens(text) -> Column:
    t = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(t, F.lit(SQL_TOKEN), 1)


def mapping_from_manifest(manifest: DataFrame) -> DataFrame:
    """``(key, value)``: lower-cased ``database.name`` -> ``target_schema.target_table``."""
    return (manifest.where(F.col("database").isNotNull() & F.col("name").isNotNull())
            .select(F.lower(F.concat_ws(".", "database", "name")).alias("key"),
                    F.concat_ws(".", "target_schema", F.coalesce("target_table", "name")).alias("value")))


def _mapping_frame(df: DataFrame, mapping) -> DataFrame:
    """The mapping as ``(_tm_key, _tm_value)`` -- internal names that cannot clash with the texts'
    own columns."""
    if isinstance(mapping, dict):
        rows = sorted((k.lower(), v) for k, v in mapping.items())
        return df.sparkSession.createDataFrame(rows, "_tm_key string, _tm_value string")
    # One value per key; a key listed with two values takes the smallest, never an arbitrary one.
    return mapping.groupBy(F.lower("key").alias("_tm_key")).agg(F.min("value").alias("_tm_value"))


def rewrite_references(df: DataFrame, text_col: str, mapping: DataFrame | dict, catalog_from: str | None = None,
                       catalog_to: str | None = None, out_col: str | None = None,
                       join_hint: str | None = None) -> DataFrame:
    """Add ``out_col`` (default: replace ``text_col``) with references rewritten by the token rule.

    ``mapping`` is a dict or a ``(key, value)`` frame (see ``mapping_from_manifest``); keys are
    lower-cased ``schema.table``. Every row of ``df`` comes back once, rewritten; null texts stay null.
    Spark picks the join with the mapping by its measured size; ``join_hint`` (for instance "merge")
    asks for another.
    """
    out_col = out_col or text_col
    m = _mapping_frame(df, mapping).withColumn("_tm_value", _render(F.col("_tm_value")))
    if join_hint:
        m = m.hint(join_hint)
    cat_swap = F.lit(bool(catalog_to) and bool(catalog_from))
    # Texts are dealt evenly over tasks and written under a fixed id, without their tokens, which are many times as large.
    rid, columns = "_tm_row", df.columns
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df, _ = pinned(df.repartition(n).select(F.monotonically_increasing_id().alias(rid), "*"), "rewrite")
    cand = (df.select(rid, F.posexplode(tokens(F.col(f"`{text_col}`"))).alias("_pos", "_tok"))
            .where(_is_dotted(F.col("_tok")))
            .withColumn("_parts", _name_parts(F.col("_tok")))
            .withColumn("_cat", _has_cat(F.col("_parts"), catalog_from))
            .withColumn("_tm_key", _key(F.col("_parts"), F.col("_cat"))))
    hits = cand.join(m, "_tm_key", "left").where(F.col("_tm_value").isNotNull() | (F.col("_cat") & cat_swap))
    parts, cat, new = F.col("_parts"), F.col("_cat"), F.col("_tm_value")
    i = F.when(cat, F.lit(2)).otherwise(F.lit(1))
    head = F.when(cat, F.lit(catalog_to or catalog_from or ""))
    name = F.when(new.isNotNull(), new).otherwise(F.array_join(F.slice(parts, i, 2), "."))
    rest = F.when(F.size(parts) >= i + 2, F.array_join(F.slice(parts, i + 2, F.size(parts)), "."))
    per_text = (hits.select(rid, "_pos", F.concat_ws(".", head, name, rest).alias("_new"))
                .groupBy(rid).agg(F.map_from_entries(F.collect_list(F.struct("_pos", "_new"))).alias("_hits")))
    j = df.join(per_text, rid, "left")
    swapped = F.transform(tokens(F.col(f"`{text_col}`")), lambda t, p: F.coalesce(F.try_element_at(F.col("_hits"), p), t))
    text = F.when(F.col("_hits").isNull(), F.col(f"`{text_col}`")).otherwise(F.array_join(swapped, ""))
    out = j.withColumn(out_col, text)
    return out.select(*[F.col(f"`{c}`") for c in (columns if out_col in columns else [*columns, out_col])])
