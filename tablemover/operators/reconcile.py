"""Reconciliation of source and target: inventories, counts, checksums, rows.

Everything here is a DataFrame plan; what the driver collects is the number of differing nodes and their
rows per level of the narrowed comparison. Columns are compared in a common type that loses nothing.

Scale notes
-----------
* The row difference is one union of both sides (+1 / -1) and one aggregate per distinct row: above 0
  is only in the source, below 0 only in the target. Two scans and one exchange give both answers. The
  aggregate is partial map-side, so a row repeated a billion times ships one count per task, not a
  billion rows: a hot duplicate does not make a hot shuffle partition.
* Count and checksum are global aggregates: partial per task, one tiny final merge. No shuffle
  of rows at all, which is why they are the default verification of a copy.
* ``reconcile_rows(method="narrow")`` first compares (count and two independent 64/32-bit hash sums) per node
  of a hash tree, level by level under the nodes that differ, then runs the same difference only over rows
  of differing leaves. On a correct copy that is two scans and a shuffle of ``buckets`` rows instead of
  a shuffle of both tables; otherwise whole rows are shuffled in proportion to the change.
* The keyed diff aggregates each side to one row per key *before* joining, so duplicate or hot
  keys never produce pairs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (ArrayType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType,
                               LongType, MapType, NullType, ShortType, StructField, StructType, TimestampNTZType,
                               TimestampType)

from ..functions.checksum import checksum_aggs, hash_inputs, row_digest, row_hash, row_hash32
from ..session import drop_folder, pinned
from .select import exclude_schemas as _exclude_schemas


class SchemaMismatch(ValueError):
    pass


class TypeChanged(SchemaMismatch):
    pass


#: Decimal digits that hold every value of an integer type.
_DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}


def _decimal(whole: int, scale: int) -> DataType | None:
    return DecimalType(whole + scale, scale) if whole + scale <= 38 else None


def common_type(a: DataType, b: DataType) -> DataType | None:
    """The type to which values of both types can be cast without loss, so that casts are equal exactly when
    the values are; None if there is none (text and numbers, longs and doubles, decimals and doubles,
    timestamps with and without a zone)."""
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        e = common_type(a.elementType, b.elementType)
        return e and ArrayType(e, True)
    if isinstance(a, MapType) and isinstance(b, MapType):
        k, v = common_type(a.keyType, b.keyType), common_type(a.valueType, b.valueType)
        return MapType(k, v, True) if k and v else None
    if isinstance(a, StructType) and isinstance(b, StructType):
        if [f.name.lower() for f in a.fields] != [f.name.lower() for f in b.fields]:
            return None
        kinds = [common_type(x.dataType, y.dataType) for x, y in zip(a.fields, b.fields)]
        return StructType([StructField(f.name, k, True) for f, k in zip(a.fields, kinds)]) if all(kinds) else None
    if a.simpleString() == b.simpleString():
        return a
    if isinstance(a, NullType) or isinstance(b, NullType):
        return b if isinstance(a, NullType) else a
    ints = [_DIGITS.get(type(t)) for t in (a, b)]
    if all(ints):
        return a if ints[0] > ints[1] else b
    if isinstance(b, (DecimalType, FloatType, DoubleType)) and ints[0] or isinstance(b, DoubleType) and isinstance(a, FloatType):
        a, b, ints = b, a, ints[::-1]  # a is the wider kind
    if isinstance(a, DecimalType):
        if isinstance(b, DecimalType):
            return _decimal(max(a.precision - a.scale, b.precision - b.scale), max(a.scale, b.scale))
        return _decimal(max(a.precision - a.scale, ints[1]), a.scale) if ints[1] else None
    if isinstance(a, DoubleType):  # 53 bits hold an int and a float, but not a long
        return a if isinstance(b, FloatType) or (ints[1] or 99) <= 10 else None
    if isinstance(a, FloatType):
        return None if not ints[1] or ints[1] > 10 else a if ints[1] <= 5 else DoubleType()
    times = [t for t in (a, b) if isinstance(t, (TimestampType, TimestampNTZType))]
    if len(times) == 1 and any(isinstance(t, DateType) for t in (a, b)):
        return times[0]
    return None


def _changes(src: StructType, dst: StructType) -> list[tuple]:
    """(column, source type, target type, change) of the columns that differ."""
    theirs = {f.name.lower(): f for f in dst.fields}
    out = []
    for f in src.fields:
        g = theirs.pop(f.name.lower(), None)
        if g is None:
            out.append((f.name, f.dataType.simpleString(), None, "missing"))
        elif f.dataType.simpleString() != g.dataType.simpleString():
            change = "type_changed" if common_type(f.dataType, g.dataType) is None else "widened"
            out.append((f.name, f.dataType.simpleString(), g.dataType.simpleString(), change))
    return out + [(g.name, None, g.dataType.simpleString(), "extra") for g in theirs.values()]


def schema_changes(src: DataFrame, dst: DataFrame) -> DataFrame:
    """(column, source_type, target_type, change) of the columns that differ: ``missing`` or ``extra`` in the
    target, ``widened`` (the values can be compared without loss) or ``type_changed`` (they can't)."""
    return src.sparkSession.createDataFrame(_changes(src.schema, dst.schema),
                                            "column string, source_type string, target_type string, change string")


def align(src: DataFrame, dst: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames with the columns of ``src`` in its order, each cast to the common type of both sides.

    Set operations in Spark match columns by position, so a copy that reordered partition columns to the end
    would otherwise compare column A against column B; and a cast of one side to the other's type would make
    10.7 equal to 10. ``TypeChanged`` if a column's types have no common one without loss.
    """
    changes = _changes(src.schema, dst.schema)
    missing, extra = ([c[0] for c in changes if c[3] == k] for k in ("missing", "extra"))
    if missing or extra:
        raise SchemaMismatch(f"columns only in source: {missing}; only in target: {extra}")
    if changed := [f"{c} ({a} -> {b})" for c, a, b, k in changes if k == "type_changed"]:
        raise TypeChanged(f"type_changed: {', '.join(changed)}")
    theirs = {f.name.lower(): f for f in dst.schema.fields}

    def side(df: DataFrame, field_of) -> DataFrame:
        out = []
        for f in src.schema.fields:
            own, kind = field_of(f), common_type(f.dataType, theirs[f.name.lower()].dataType)
            c = F.col(f"`{own.name}`")
            out.append((c if own.dataType.simpleString() == kind.simpleString() else c.cast(kind)).alias(f.name))
        return df.select(*out)

    return side(src, lambda f: f), side(dst, lambda f: theirs[f.name.lower()])


def align_columns(src: DataFrame, dst: DataFrame) -> DataFrame:
    """``dst`` with the columns of ``src`` in its order, in the common types of :func:`align`."""
    return align(src, dst)[1]


# ---------------------------------------------------------------- inventories

def _source_side(src_inv: DataFrame, object_type: str, exclude: list[str] | None,
                 mapping: DataFrame | None) -> DataFrame:
    s = src_inv.where(F.col("object_type") == F.lit(object_type))
    s = _exclude_schemas(s, exclude, "database")
    s = s.select(F.col("database").alias("table_schema"), F.col("name").alias("table_name"))
    if mapping is not None:
        # Migration may rename schema and table: compare the names the objects should have now.
        # One target per source name; a name mapped twice takes the smallest target, never an
        # arbitrary one.
        m = (mapping.select(F.col("database").alias("table_schema"), F.col("name").alias("table_name"),
                            F.struct(F.col("target_schema").alias("ts"),
                                     F.coalesce("target_table", "name").alias("tt")).alias("_t"))
             .groupBy("table_schema", "table_name").agg(F.min("_t").alias("_t"))
             .select("table_schema", "table_name", F.col("_t.ts").alias("_ts"), F.col("_t.tt").alias("_tt")))
        s = (s.join(m, ["table_schema", "table_name"], "left")
             .select(F.coalesce("_ts", "table_schema").alias("table_schema"),
                     F.coalesce("_tt", "table_name").alias("table_name")))
    return s


def _target_side(dst_inv: DataFrame, object_type: str) -> DataFrame:
    return (dst_inv.where((F.col("table_schema") != F.lit("information_schema"))
                          & (F.col("table_type") == F.lit(object_type)))
            .select("table_schema", "table_name"))


def reconcile_inventory(src_inv: DataFrame, dst_inv: DataFrame, object_type: str = "EXTERNAL",
                        exclude_schemas: list[str] | str | None = None,
                        mapping: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Bag difference of (schema, name) both ways: (only in source, only in target).

    ``src_inv`` has ``database, name, object_type``; ``dst_inv`` has the columns of
    ``information_schema.tables``. ``mapping`` (a manifest) maps source names to target names
    before comparing.
    """
    s = _source_side(src_inv, object_type, exclude_schemas, mapping)
    t = _target_side(dst_inv, object_type)
    return s.exceptAll(t), t.exceptAll(s)


def not_upgraded(src_inv: DataFrame, exclude_schemas: list[str] | str | None = None) -> DataFrame:
    """External tables of the source that no migration has claimed (``upgraded_to`` null)."""
    s = src_inv.where((F.col("object_type") == F.lit("EXTERNAL")) & F.col("upgraded_to").isNull())
    return _exclude_schemas(s, exclude_schemas, "database")


# ---------------------------------------------------------------- counts

def _labels(spark, labels: list[str]) -> DataFrame:
    return F.broadcast(spark.createDataFrame([(n,) for n in labels], "table_name string"))


def count_rows(tables: dict[str, DataFrame], chunk: int = 256) -> DataFrame:
    """``(table_name, row_count)`` for many tables in few jobs.

    Each table contributes one projection (its label); one grouped count over the union gives
    all counts -- a partial count per task, one small shuffle -- and tables without rows are put
    back from the list of labels. The driver builds one DataFrame per table, not four.
    """
    names = list(tables)
    if not names:
        raise ValueError("no tables")
    spark = tables[names[0]].sparkSession
    out = []
    for i in range(0, len(names), chunk):
        group = names[i:i + chunk]
        u = reduce(DataFrame.unionAll, [tables[n].select(F.lit(n).alias("table_name")) for n in group])
        counts = u.groupBy("table_name").agg(F.count(F.lit(1)).alias("row_count"))
        out.append(_labels(spark, group).join(counts, "table_name", "left")
                   .select("table_name", F.coalesce("row_count", F.lit(0)).cast("long").alias("row_count")))
    return reduce(DataFrame.unionAll, out)


def reconcile_counts(source_counts: DataFrame, target_counts: DataFrame) -> DataFrame:
    """Join two ``(table_name, rows)`` frames: ``source_rows, target_rows, match`` per table."""
    s = source_counts.select("table_name", F.col("row_count").alias("source_rows"))
    t = target_counts.select("table_name", F.col("row_count").alias("target_rows"))
    return (s.join(t, "table_name", "full_outer")
            .withColumn("match", F.coalesce(F.col("source_rows") == F.col("target_rows"), F.lit(False))))


# ---------------------------------------------------------------- checksums and rows

def table_checksum(df: DataFrame, cols: list[str] | None = None, portable: bool = False) -> DataFrame:
    """One row ``(rows, checksum)``; ``portable=True`` uses the md5 canonical-text digest."""
    return df.agg(*checksum_aggs(df, cols, portable))


def table_checksums(tables: dict[str, DataFrame], portable: bool = False, chunk: int = 256) -> DataFrame:
    """``(table_name, row_count, checksum)`` for many tables: one projection per table (label and
    row value), one grouped sum over the union, empty tables put back from the list of labels."""
    names = list(tables)
    if not names:
        raise ValueError("no tables")
    spark = tables[names[0]].sparkSession
    zero = F.lit(0).cast("decimal(38,0)")
    out = []
    for i in range(0, len(names), chunk):
        group = names[i:i + chunk]
        parts = []
        for n in group:
            df = tables[n]
            v = row_digest(df) if portable else row_hash(df).cast("decimal(20,0)")
            parts.append(df.select(F.lit(n).alias("table_name"), v.cast("decimal(38,0)").alias("_v")))
        agg = reduce(DataFrame.unionAll, parts).groupBy("table_name").agg(
            F.count(F.lit(1)).alias("row_count"), F.sum("_v").alias("_sum"))
        out.append(_labels(spark, group).join(agg, "table_name", "left").select(
            "table_name", F.coalesce("row_count", F.lit(0)).cast("long").alias("row_count"),
            F.coalesce("_sum", zero).cast("string").alias("checksum")))
    return reduce(DataFrame.unionAll, out)


def reconcile_partitions(src: DataFrame, dst: DataFrame, partition_cols: list[str],
                         portable: bool = False) -> DataFrame:
    """Per partition value: ``missing`` (only in source), ``extra`` (only in target) or ``changed``
    (row count or checksum differ), with both row counts; equal partitions are left out.

    One scan per side grouped by the partition columns (partial aggregates, one small row per
    partition and task are shuffled). On a large partitioned table this says *which* partitions
    to copy again instead of only that the table differs. Null partition values are compared as
    values.
    """
    src, dst = align(src, dst)

    def side(df: DataFrame, p: str) -> DataFrame:
        return (df.groupBy(*partition_cols).agg(*checksum_aggs(df, portable=portable))
                .select(*partition_cols, F.col("row_count").alias(f"{p}_rows"), F.col("checksum").alias(f"{p}_sum")))

    s, t = side(src, "s").alias("s"), side(dst, "t").alias("t")
    cond = reduce(lambda a, b: a & b, [F.col(f"s.`{c}`").eqNullSafe(F.col(f"t.`{c}`")) for c in partition_cols])
    status = (F.when(F.col("t_rows").isNull(), F.lit("missing")).when(F.col("s_rows").isNull(), F.lit("extra"))
              .when((F.col("s_rows") != F.col("t_rows")) | (F.col("s_sum") != F.col("t_sum")), F.lit("changed")))
    keys = [F.when(F.col("s_rows").isNotNull(), F.col(f"s.`{c}`")).otherwise(F.col(f"t.`{c}`")).alias(c)
            for c in partition_cols]
    return (s.join(t, cond, "full_outer")
            .select(*keys, status.alias("status"), F.coalesce("s_rows", F.lit(0)).alias("source_rows"),
                    F.coalesce("t_rows", F.lit(0)).alias("target_rows"))
            .where(F.col("status").isNotNull()))


def _leaf(bits: int) -> F.Column:
    """The node of a row at the depth of ``bits`` bits: the leading bits of its hash."""
    return F.shiftrightunsigned(F.col("_tm_h"), 64 - bits)


def _under(hashed: DataFrame, nodes: DataFrame, bits: int) -> DataFrame:
    return hashed.join(nodes, _leaf(bits) == F.col("_tm_b"), "left_semi")


def _differing(sides: list[DataFrame], bits: int) -> DataFrame:
    """(node, rows) of the nodes at this depth whose count or hash sums differ between two hashed sides."""
    # Sums of 32 bits a row each at most, in longs: half the size of decimals, and without the bits that the node tells.
    # One that overflows (2^31 rows under a node at least) is null and counts as a difference: its rows are looked at.
    parts = {"_sh": F.shiftright(F.col("_tm_h").bitwiseAND(F.lit((1 << (64 - bits)) - 1).cast("long")), 32), "_sl": F.col("_tm_h").bitwiseAND(F.lit(0xFFFFFFFF).cast("long")),
             "_sh2": F.col("_tm_h2").cast("long")}
    s, t = (h.groupBy(_leaf(bits).alias("_tm_b")).agg(
        F.count(F.lit(1)).alias("_n"), *[F.try_sum(c).alias(name) for name, c in parts.items()]).alias(side)
        for h, side in zip(sides, "st"))
    same = F.coalesce(reduce(lambda a, b: a & b, [F.col(f"s.{c}") == F.col(f"t.{c}") for c in ("_n", *parts)]), F.lit(False))
    return s.join(t, "_tm_b", "full_outer").where(~same).select(
        "_tm_b", F.greatest(F.coalesce("s._n", F.lit(0)), F.coalesce("t._n", F.lit(0))).alias("_n"))


def _hashes(df: DataFrame) -> DataFrame:
    return df.select(row_hash(df).alias("_tm_h"), row_hash32(df).alias("_tm_h2"))


def _first_bits(buckets: int) -> int:
    return max(1, min(62, (max(2, buckets) - 1).bit_length()))


def mismatched_buckets(src: DataFrame, dst: DataFrame, buckets: int = 65536) -> DataFrame:
    """The nodes of a hash tree's first level under which two aligned sides differ; ``buckets`` rows at most."""
    return _differing([_hashes(src), _hashes(dst)], _first_bits(buckets)).select("_tm_b")


def differing_leaves(src: DataFrame, dst: DataFrame, buckets: int = 65536, rows_per_leaf: int = 4,
                     broadcast_rows: int = 4_000_000) -> tuple[DataFrame, int, str, int] | None:
    """The leaves of a hash tree under which the sides differ: (frame of ``_tm_b``, depth in bits, its folder, how
    many); None if there are none.

    The first level has ``buckets`` nodes. Each level compares (count, two hash sums) per node under the nodes
    that differed on the level above, and its depth comes from the counts there: enough bits that the rows
    under differing nodes spread to about one a node. It ends when those nodes hold at most ``rows_per_leaf`` rows
    each on average, so what is under them is in proportion to the change, be it one row or millions scattered
    over all nodes. A level costs a scan of both sides and a shuffle of one narrow row per node and task.
    Nodes travel as a broadcast up to ``broadcast_rows`` of them; beyond that a level looks at all rows.
    """
    spark = src.sparkSession
    bits, above = _first_bits(buckets), None
    sides = [_hashes(src), _hashes(dst)]
    while True:
        under = [_under(h, F.broadcast(above[0]), above[1]) for h in sides] if above and above[2] <= broadcast_rows else sides
        bad, folder = pinned(_differing(under, bits), "tree")
        if above:
            drop_folder(spark, above[3])
        size = bad.agg(F.count(F.lit(1)).alias("nodes"), F.sum("_n").alias("rows")).first()
        if not size["nodes"]:
            drop_folder(spark, folder)
            return None
        if size["rows"] <= rows_per_leaf * size["nodes"] or bits == 62:
            return bad.select("_tm_b"), bits, folder, size["nodes"]
        above = bad.select("_tm_b"), bits, size["nodes"], folder
        bits = min(62, bits + max(4, (size["rows"] // size["nodes"]).bit_length() + 1))


#: Up to so many nodes are broadcast as they are.
_FEW_NODES = 500_000
#: Bits of the deepest nodes that are sent to all tasks as a bitmap: at most 2^(_MAP_BITS - 6) rows of 64 nodes each.
_MAP_BITS = 27


def _under_bitmap(hashed: DataFrame, nodes: DataFrame, bits: int) -> DataFrame:
    """The rows under ``nodes``, however many there are: nodes deeper than ``_MAP_BITS`` stand for their ancestor there
    (so some equal rows pass too), and 64 neighbours are one broadcast row."""
    depth = min(bits, _MAP_BITS)
    spot = F.shiftrightunsigned("_tm_b", bits - depth)
    mask = lambda node: F.call_function("shiftleft", F.lit(1).cast("long"), node.bitwiseAND(F.lit(63).cast("long")).cast("int"))
    words = F.broadcast(nodes.groupBy(F.shiftrightunsigned(spot, 6).alias("_tm_w")).agg(F.bit_or(mask(spot)).alias("_tm_m")))
    leaf, mine = _leaf(depth), mask(_leaf(depth))
    return hashed.join(words, (F.shiftrightunsigned(leaf, 6) == F.col("_tm_w")) & (F.col("_tm_m").bitwiseAND(mine) != 0), "left_semi")


def _has_map(t: DataType) -> bool:
    if isinstance(t, MapType):
        return True
    if isinstance(t, ArrayType):
        return _has_map(t.elementType)
    return isinstance(t, StructType) and any(_has_map(f.dataType) for f in t.fields)


def _without_maps(c: F.Column, t: DataType) -> F.Column:
    """Rows with maps cannot be grouped: maps at any depth become their entries sorted by key (equal maps
    give equal arrays)."""
    if not _has_map(t):
        return c
    if isinstance(t, MapType):
        return F.array_sort(F.transform(F.map_entries(c), lambda e: F.struct(
            _without_maps(e.getField("key"), t.keyType).alias("key"),
            _without_maps(e.getField("value"), t.valueType).alias("value"))))
    if isinstance(t, ArrayType):
        return F.transform(c, lambda e: _without_maps(e, t.elementType))
    return F.when(c.isNotNull(), F.struct(*[_without_maps(c.getField(f.name), f.dataType).alias(f.name) for f in t.fields]))


def _with_maps(c: F.Column, t: DataType) -> F.Column:
    """``_without_maps`` undone; ``t`` is the type with maps."""
    if not _has_map(t):
        return c
    if isinstance(t, MapType):
        return F.map_from_entries(F.transform(c, lambda e: F.struct(
            _with_maps(e.getField("key"), t.keyType), _with_maps(e.getField("value"), t.valueType))))
    if isinstance(t, ArrayType):
        return F.transform(c, lambda e: _with_maps(e, t.elementType))
    return F.when(c.isNotNull(), F.struct(*[_with_maps(c.getField(f.name), f.dataType).alias(f.name) for f in t.fields]))


def _each(df: DataFrame, schema: StructType, convert) -> DataFrame:
    if not _has_map(schema):
        return df
    return df.select(*[convert(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in schema.fields])


SIDE, TIMES = "_tm_side", "_tm_times"


def row_differences(src: DataFrame, dst: DataFrame) -> DataFrame:
    """The rows that differ, with ``_tm_side`` (`source` or `target`: where the row is too often) and
    ``_tm_times`` (how many times too often). One scan of each side and one exchange of distinct rows."""
    src, dst = align(src, dst)
    schema = src.schema
    one = _each(src, schema, _without_maps).withColumn(TIMES, F.lit(1).cast("long"))
    other = _each(dst, schema, _without_maps).withColumn(TIMES, F.lit(-1).cast("long"))
    diff = (one.unionAll(other).groupBy(*[F.col(f"`{c}`") for c in src.columns]).agg(F.sum(TIMES).alias(TIMES))
            .where(F.col(TIMES) != 0))
    out = diff.select(*[_with_maps(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in schema.fields],
                      F.when(F.col(TIMES) > 0, F.lit("source")).otherwise(F.lit("target")).alias(SIDE),
                      F.abs(TIMES).alias(TIMES))
    return out


#: A row that is to be repeated more often is repeated by several tasks, so many times each.
_REPEATS = 100_000


def _rows_of(diff: DataFrame, side: str, columns: list[str]) -> DataFrame:
    """The rows of a side, each as often as it is too often there."""
    mine = diff.where(F.col(SIDE) == side)
    up_to = lambda n: F.explode(F.sequence(F.lit(1).cast("long"), n))
    few = mine.where(F.col(TIMES) <= _REPEATS).withColumn(TIMES, up_to(F.col(TIMES)))
    # Portions of at most _REPEATS, dealt to tasks before they are spelled out.
    part, many = "_tm_part", mine.where(F.col(TIMES) > _REPEATS)
    many = many.withColumn(part, up_to(F.ceil(F.col(TIMES) / _REPEATS)))
    many = many.withColumn(TIMES, F.least(F.lit(_REPEATS).cast("long"), F.col(TIMES) - (F.col(part) - 1) * _REPEATS))
    tasks = int(diff.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a stated number isn't merged again
    many = many.repartition(tasks, F.col(part)).withColumn(TIMES, up_to(F.col(TIMES))).drop(part)
    return few.unionByName(many).select(*[F.col(f"`{c}`") for c in columns])


def reconcile_rows(src: DataFrame, dst: DataFrame, method: str = "exact",
                   buckets: int = 65536) -> tuple[DataFrame, DataFrame]:
    """Bag difference of whole rows both ways: (rows only in source, rows only in target), in the common
    types of both sides (``TypeChanged`` if there are none).

    ``method="exact"``: ``row_differences`` over both tables; to use both answers from one pass, call
    that. ``method="narrow"``: a hash tree first (:func:`differing_leaves`, from ``buckets`` nodes down to as many as
    the change needs), then the difference over the rows of differing leaves only; without any, two empty
    frames and no second read. Choose it for copies that should be equal, or differ little: whole rows
    are shuffled in proportion to the change, however scattered. A differing row always changes its node's
    count or hash sums unless another change under the same node cancels both its 64-bit and 32-bit sums at
    once; use ``exact`` when that residual risk is not acceptable.
    """
    if method not in ("exact", "narrow"):
        raise ValueError(f"unknown method {method!r}")
    src, dst = align(src, dst)
    columns = src.columns
    if method == "narrow":
        found = differing_leaves(src, dst, buckets)
        if found is None:
            empty = src.sparkSession.createDataFrame([], src.schema)
            return empty, empty
        bad, bits, _, n = found
        # Whole rows aren't shuffled to find those under differing nodes: few nodes are broadcast, many as a bitmap.
        under = _under_bitmap if n > _FEW_NODES else lambda h, nodes, at: _under(h, F.broadcast(nodes), at)
        src, dst = (under(d.withColumn("_tm_h", row_hash(d)), bad, bits).select(*[F.col(f"`{c}`") for c in columns])
                    for d in (src, dst))
    diff = row_differences(src, dst)
    return _rows_of(diff, "source", columns), _rows_of(diff, "target", columns)


def _zero(t) -> F.Column | None:
    """A stand-in value of type ``t`` for null keys (paired with an is-null flag), or None."""
    from pyspark.sql.types import (BinaryType, BooleanType, DateType, DecimalType, NumericType, StringType,
                                   TimestampNTZType, TimestampType)
    if isinstance(t, (NumericType, DecimalType)):
        return F.lit(0).cast(t)
    if isinstance(t, StringType):
        return F.lit("")
    if isinstance(t, BooleanType):
        return F.lit(False)
    if isinstance(t, BinaryType):
        return F.lit("").cast("binary")
    if isinstance(t, (DateType, TimestampType, TimestampNTZType)):
        return F.lit("1970-01-01").cast(t)
    return None


def keyed_diff(src: DataFrame, dst: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: ``missing`` (only in source), ``extra`` (only in target), ``changed``.

    Each side is first reduced to one row per key -- row count and three independent hash sums of
    the value columns (64 + 64 + 32 bits, null positions included) -- so the join sees one row per
    key and side whatever the key distribution: a hot or duplicated key is one row after the
    map-side partial aggregate, never a set of pairs. Fixed-width aggregates keep it a hash
    aggregate (no sort), and a null key is grouped and joined as a (value, is-null) pair so the
    join reuses the aggregate's partitioning. ``changed`` means the bag of rows under the key
    differs in count or digest; use ``reconcile_rows`` for the rows themselves.
    """
    src, dst = align(src, dst)
    vals = [c for c in src.columns if c not in keys]
    types = {f.name: f.dataType for f in src.schema.fields}
    zeros = {k: _zero(types[k]) for k in keys}
    if any(z is None for z in zeros.values()):
        raise TypeError(f"unsupported key types: {[k for k, z in zeros.items() if z is None]}")
    gk = [f"_k{i}" for i in range(len(keys))] + [f"_n{i}" for i in range(len(keys))]

    def side(df: DataFrame, p: str) -> DataFrame:
        grp = ([F.coalesce(F.col(f"`{k}`"), zeros[k]).alias(f"_k{i}") for i, k in enumerate(keys)]
               + [F.col(f"`{k}`").isNull().alias(f"_n{i}") for i, k in enumerate(keys)])
        if vals:
            h1, h3 = row_hash(df, vals), row_hash32(df, vals)
            h2 = F.xxhash64(F.lit("tablemover"), h1, *hash_inputs(df, vals))
        else:
            h1 = h2 = h3 = F.lit(0)
        return (df.select(*grp, h1.cast("decimal(38,0)").alias("_h1"), h2.cast("decimal(38,0)").alias("_h2"),
                          h3.cast("decimal(38,0)").alias("_h3"))
                .groupBy(*gk).agg(F.count(F.lit(1)).alias(f"{p}_rows"), F.sum("_h1").alias(f"{p}_h1"),
                                  F.sum("_h2").alias(f"{p}_h2"), F.sum("_h3").alias(f"{p}_h3")))

    j = side(src, "s").join(side(dst, "t"), gk, "full_outer")
    differs = reduce(lambda a, b: a | b, [~F.col(f"s_{x}").eqNullSafe(F.col(f"t_{x}")) for x in ("rows", "h1", "h2", "h3")])
    status = (F.when(F.col("t_rows").isNull(), F.lit("missing"))
              .when(F.col("s_rows").isNull(), F.lit("extra"))
              .when(differs, F.lit("changed")))
    key_out = [F.when(F.col(f"_n{i}"), F.lit(None).cast(types[k])).otherwise(F.col(f"_k{i}")).alias(k)
               for i, k in enumerate(keys)]
    return (j.select(*key_out, status.alias("status"), F.coalesce("s_rows", F.lit(0)).alias("source_rows"),
                     F.coalesce("t_rows", F.lit(0)).alias("target_rows"))
            .where(F.col("status").isNotNull()))
