"""Order-free table checksums.

Two kinds of row hash:

* ``row_hash`` -- ``xxhash64`` over the typed columns. Fast, stays inside whole-stage codegen, no
  text is built. Use it when both sides are read by Spark (the normal migration case). Types must
  agree on both sides; ``align`` in the reconcile module casts both to a common type.
* ``row_digest`` -- md5 of a canonical text of the row, of which the first 16 hex digits are read
  as an unsigned 64-bit number. Slower, but any SQL engine with md5 can rebuild it from the same
  rules, so a checksum taken in Spark can be compared with one taken elsewhere.

Canonical text of a row: fields joined by ``,``; a null is ``N``; a string is ``<chars>:<text>``
(length prefixed, so no escaping is needed and no two rows share a text); integers and booleans as
plain text; floating values (floats widened to double, ``-0.0`` as ``0``) exactly, as sign and
``hi.loEk`` with value = (hi + lo / 2^53) * 2^(53 k), 1 <= hi < 2^53 (``Ek`` left out when 0);
``NaN``/``Inf``/``-Inf`` spelled out. Scaling by powers of two and cutting off the fraction are exact
in IEEE arithmetic, so engines that print doubles differently still agree and no two doubles share a text;
timestamps as ``yyyy-MM-dd HH:mm:ss.ffffff``; dates as ``yyyy-MM-dd``; arrays as ``[e,e,...]`` of
canonical elements; structs as ``{f,f,...}``; maps as their entries' texts, sorted. A checksum is the
*sum* of the row values (as ``decimal(38,0)``, so it cannot overflow below 10^19 rows), which is
order-free and keeps duplicate rows (a bag checksum, unlike xor).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, DataType, DateType,
                               DecimalType, DoubleType, FloatType, MapType, StringType, StructType,
                               TimestampNTZType, TimestampType)

NULL_TOKEN = "N"
SEP = ","
TWO53 = 2.0 ** 53


def _hi_lo(m: Column) -> Column:
    """``hi.lo`` of 1 <= m < 2^53: both parts are whole numbers below 2^53."""
    hi = F.floor(m)
    return F.concat(hi.cast("string"), F.lit("."), ((m - hi.cast("double")) * F.lit(TWO53)).cast("long").cast("string"))


def _any_scale(ax: Column) -> Column:
    """``hi.loEk`` of any positive finite value. The logarithm only guesses k; the scaled value, which is
    exact (in two factors, as one alone may leave the range), corrects it by one."""
    guess = F.floor(F.log2(ax) / F.lit(53.0))
    half = F.floor(guess * F.lit(-53.0) / F.lit(2.0))
    m = ax * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), guess * F.lit(-53.0) - half)
    k = F.when(m < 1.0, guess - 1).when(m >= F.lit(TWO53), guess + 1).otherwise(guess)
    scaled = F.when(m < 1.0, m * F.lit(TWO53)).when(m >= F.lit(TWO53), m / F.lit(TWO53)).otherwise(m)
    return F.concat(_hi_lo(scaled), F.lit("E"), k.cast("long").cast("string"))


def _double_text(d: Column) -> Column:
    """Exact, engine-independent text of a finite double (see the module docstring); the common ranges,
    1 to 2^53 and 2^-53 to 1, need no logarithm."""
    ax = F.abs(d)
    body = (F.when(ax == 0, F.lit("0"))
            .when((ax >= 1.0) & (ax < F.lit(TWO53)), _hi_lo(ax))
            .when((ax >= F.lit(1 / TWO53)) & (ax < 1.0), F.concat(_hi_lo(ax * F.lit(TWO53)), F.lit("E-1")))
            .otherwise(_any_scale(ax)))
    return F.when(d.isNotNull(), F.concat(F.when(d < 0, F.lit("-")).otherwise(F.lit("")), body))


def _canon(c: Column, t: DataType) -> Column:
    if isinstance(t, StringType):
        v = F.concat(F.length(c).cast("string"), F.lit(":"), c)
    elif isinstance(t, (DoubleType, FloatType)):
        d = c.cast("double")
        v = (F.when(F.isnan(d), F.lit("NaN"))
             .when(d == F.lit(float("inf")), F.lit("Inf"))
             .when(d == F.lit(float("-inf")), F.lit("-Inf"))
             .otherwise(_double_text(d)))
    elif isinstance(t, (TimestampNTZType, TimestampType)):
        v = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    elif isinstance(t, DateType):
        v = F.date_format(c, "yyyy-MM-dd")
    elif isinstance(t, BinaryType):
        v = F.hex(c)
    elif isinstance(t, ArrayType):
        inner = F.transform(c, lambda e: _canon(e, t.elementType))
        v = F.concat(F.lit("["), F.array_join(inner, SEP), F.lit("]"))
    elif isinstance(t, StructType):
        parts = [_canon(c.getField(f.name), f.dataType) for f in t.fields]
        v = F.when(c.isNotNull(), F.concat(F.lit("{"), F.concat_ws(SEP, *parts), F.lit("}")))
    elif isinstance(t, MapType):
        inner = F.array_sort(F.transform(F.map_entries(c), lambda e: F.concat(
            _canon(e.getField("key"), t.keyType), F.lit("="), _canon(e.getField("value"), t.valueType))))
        v = F.concat(F.lit("<"), F.array_join(inner, SEP), F.lit(">"))
    elif isinstance(t, (BooleanType, DecimalType)):
        v = c.cast("string")
    else:  # integral types
        v = c.cast("string")
    return F.coalesce(v, F.lit(NULL_TOKEN))


def canonical_text(df: DataFrame, cols: list[str] | None = None) -> Column:
    """The canonical text of each row over ``cols`` (default: all columns, in order)."""
    cols = cols or df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    return F.concat_ws(SEP, *[_canon(F.col(f"`{c}`"), types[c]) for c in cols])


def row_digest(df: DataFrame, cols: list[str] | None = None) -> Column:
    """Portable 64-bit row value: first 16 hex digits of md5(canonical text), as decimal(20,0)."""
    h = F.md5(canonical_text(df, cols))
    return F.conv(F.substring(h, 1, 16), 16, 10).cast("decimal(20,0)")


def _marked(c: Column, t: DataType) -> Column:
    """A value inside another: whether it is null, and the value."""
    return F.struct(c.isNull().alias("n"), _hashable(c, t).alias("v"))


def _hashable(c: Column, t: DataType) -> Column:
    """A form of ``c`` that hashes apart whatever differs. Spark's hashes skip nulls at every level, don't
    mark where an array ends, and reject maps: so arrays become (size, elements each with its null mark),
    structs (fields each with its null mark), and maps their entries in key order, at any depth."""
    if isinstance(t, ArrayType):
        return F.struct(F.size(c).alias("size"), F.transform(c, lambda e: _marked(e, t.elementType)).alias("e"))
    if isinstance(t, StructType):
        return F.struct(c.isNull().alias("n"), *[_marked(c.getField(f.name), f.dataType).alias(f"f{i}")
                                                 for i, f in enumerate(t.fields)])
    if isinstance(t, MapType):
        entries = F.transform(F.map_entries(c), lambda e: F.struct(
            _hashable(e.getField("key"), t.keyType).alias("k"), _marked(e.getField("value"), t.valueType).alias("v")))
        return F.struct(F.size(c).alias("size"), F.array_sort(entries).alias("e"))
    return c


def null_masks(cols: list[str]) -> list[Column]:
    """One long per 62 columns with a bit set for each null column.

    Spark's ``xxhash64`` and ``hash`` skip null inputs, so ``(null, 'a')`` and ``('a', null)`` would
    hash alike; hashing the null pattern as well keeps the position of each null.
    """
    out = []
    for i in range(0, len(cols), 62):
        bits = [F.when(F.col(f"`{c}`").isNull(), F.lit(1 << j)).otherwise(F.lit(0))
                for j, c in enumerate(cols[i:i + 62])]
        out.append(reduce(lambda a, b: a + b, bits).cast("long"))
    return out


def hash_inputs(df: DataFrame, cols: list[str] | None = None) -> list[Column]:
    """What a row hash covers: each column in its hashable form, then the null pattern."""
    cols = cols or df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    return [*[_hashable(F.col(f"`{c}`"), types[c]) for c in cols], *null_masks(cols)]


def row_hash(df: DataFrame, cols: list[str] | None = None) -> Column:
    """Fast 64-bit row hash over typed columns and their null pattern (Spark only)."""
    return F.xxhash64(*hash_inputs(df, cols))


def row_hash32(df: DataFrame, cols: list[str] | None = None) -> Column:
    """A second, independent 32-bit row hash (murmur3), also null-position aware."""
    return F.hash(*hash_inputs(df, cols))


def checksum_aggs(df: DataFrame, cols: list[str] | None = None, portable: bool = False) -> list[Column]:
    """``rows`` and ``checksum`` aggregate columns for ``df.agg(*...)`` or a grouped agg."""
    v = row_digest(df, cols) if portable else row_hash(df, cols).cast("decimal(20,0)")
    return [F.count(F.lit(1)).alias("row_count"),
            F.coalesce(F.sum(v.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
            .cast("string").alias("checksum")]
