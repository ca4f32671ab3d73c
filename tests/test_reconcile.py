import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tablemover.operators.reconcile import (SchemaMismatch, align_columns, count_rows, keyed_diff,
                                            not_upgraded, reconcile_counts, reconcile_inventory,
                                            reconcile_rows, table_checksum)

SRC = "database string, name string, object_type string, upgraded_to string"
DST = "table_catalog string, table_schema string, table_name string, table_type string"
ROWS = "k long, v string, x double"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, x if x is not None else 0)
                                                                        if not isinstance(x, list) else (False, 0)
                                                                        for x in t))


@pytest.fixture
def invs(spark):
    src = spark.createDataFrame([("a", "t1", "EXTERNAL", None), ("a", "t1", "EXTERNAL", None), ("a", "t2", "EXTERNAL", "x"),
                                 ("a", "v1", "VIEW", None), ("assess", "t9", "EXTERNAL", None), (None, "t3", "EXTERNAL", None)],
                                SRC)
    dst = spark.createDataFrame([("c", "a", "t1", "EXTERNAL"), ("c", "a", "t4", "EXTERNAL"), ("c", "a", "v1", "VIEW"),
                                 ("c", "information_schema", "tables", "VIEW")], DST)
    return src, dst


def test_inventory_bag_difference_both_ways(spark, invs):
    src, dst = invs
    only_s, only_t = reconcile_inventory(src, dst, "EXTERNAL", "assess")
    assert rows(only_s) == [("a", "t1"), ("a", "t2")]  # one of the two t1 copies is unmatched
    assert rows(only_t) == [("a", "t4")]
    vs, vt = reconcile_inventory(src, dst, "VIEW")
    assert rows(vs) == [] and rows(vt) == []


def test_inventory_swap_property(spark, invs):
    # Target inventories (information_schema) have no null schema; a null one would be dropped by
    # the ``table_schema <> 'information_schema'`` filter, so the property is stated without it.
    src, dst = invs
    src = src.where(F.col("database").isNotNull())
    s1, t1 = reconcile_inventory(src, dst, "EXTERNAL")
    as_src = dst.select(F.col("table_schema").alias("database"), F.col("table_name").alias("name"),
                        F.col("table_type").alias("object_type"), F.lit(None).cast("string").alias("upgraded_to"))
    as_dst = src.select(F.lit("c").alias("table_catalog"), F.col("database").alias("table_schema"),
                        F.col("name").alias("table_name"), F.col("object_type").alias("table_type"))
    s2, t2 = reconcile_inventory(as_src, as_dst, "EXTERNAL")
    assert rows(s1) == rows(t2) and rows(t1) == rows(s2)


def test_inventory_with_mapping(spark, invs):
    src, _ = invs
    dst = spark.createDataFrame([("c", "new", "t1x", "EXTERNAL")], DST)
    man = spark.createDataFrame([("a", "t1", "new", "t1x")], "database string, name string, target_schema string, "
                                                             "target_table string")
    only_s, only_t = reconcile_inventory(src.where(F.col("name") == "t1"), dst, "EXTERNAL", mapping=man)
    assert rows(only_s) == [("new", "t1x")] and rows(only_t) == []


def test_not_upgraded(spark, invs):
    src, _ = invs
    assert sorted(r["name"] for r in not_upgraded(src, "assess").collect()) == ["t1", "t1"]
    assert sorted(r["name"] for r in not_upgraded(src, "").collect()) == ["t1", "t1", "t3", "t9"]


def test_counts(spark):
    a = spark.range(10)
    out = {r["table_name"]: (r["source_rows"], r["target_rows"], r["match"])
           for r in reconcile_counts(count_rows({"x": a, "y": a}), count_rows({"x": a, "z": a.limit(3)})).collect()}
    assert out == {"x": (10, 10, True), "y": (10, None, False), "z": (None, 3, False)}


@pytest.fixture
def pair(spark):
    s = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (2, "b", None), (3, None, 3.0), (4, "d", 4.0),
                               (None, "n", 0.0)], ROWS)
    t = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, None, 3.5), (5, "e", 5.0), (None, "n", 0.0),
                               (5, "e", 5.0)], ROWS)
    return s, t


@pytest.mark.parametrize("method", ["exact", "narrow"])
def test_row_difference(spark, pair, method):
    s, t = pair
    only_s, only_t = reconcile_rows(s, t, method, buckets=4)
    assert rows(only_s) == [(2, "b", None), (3, None, 3.0), (4, "d", 4.0)]
    assert rows(only_t) == [(3, None, 3.5), (5, "e", 5.0), (5, "e", 5.0)]


def test_row_difference_of_table_with_itself_is_empty(spark, pair):
    s, _ = pair
    for m in ("exact", "narrow"):
        a, b = reconcile_rows(s, s, m)
        assert a.count() == 0 and b.count() == 0


def test_align_columns_reorders_and_casts(spark):
    s = spark.createDataFrame([(1, "a")], "k long, v string")
    t = spark.createDataFrame([("a", 1)], "V string, k int")
    out = align_columns(s, t)
    assert out.columns == ["k", "v"] and dict(out.dtypes)["k"] == "bigint"
    with pytest.raises(SchemaMismatch):
        align_columns(s, spark.createDataFrame([(1,)], "k long"))


def test_keyed_diff(spark, pair):
    s, t = pair
    out = {r["k"]: (r["status"], r["source_rows"], r["target_rows"]) for r in keyed_diff(s, t, ["k"]).collect()}
    assert out == {2: ("changed", 2, 1), 3: ("changed", 1, 1), 4: ("missing", 1, 0), 5: ("extra", 0, 2)}


def test_keyed_diff_hot_key_is_not_paired(spark):
    # 20k rows under one key on each side: the diff aggregates per key before joining.
    s = spark.range(20000).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    t = s.union(spark.createDataFrame([(1, 99999)], "k int, v long"))
    out = keyed_diff(s, t, ["k"]).collect()
    assert [(r["k"], r["status"], r["source_rows"], r["target_rows"]) for r in out] == [(1, "changed", 20000, 20001)]


def test_checksum_order_free_and_null_position_sensitive(spark):
    a = spark.createDataFrame([(None, "a"), ("b", None)], "x string, y string")
    b = spark.createDataFrame([("b", None), (None, "a")], "x string, y string")
    c = spark.createDataFrame([("a", None), (None, "b")], "x string, y string")
    for portable in (False, True):
        ca, cb, cc = [table_checksum(d, portable=portable).collect()[0]["checksum"] for d in (a, b, c)]
        assert ca == cb and ca != cc


def test_checksum_keeps_duplicates(spark):
    a = spark.createDataFrame([(1,), (1,)], "x int")
    b = spark.createDataFrame([(1,)], "x int")
    for portable in (False, True):
        assert table_checksum(a, portable=portable).collect()[0]["checksum"] != \
            table_checksum(b, portable=portable).collect()[0]["checksum"]


def test_checksum_separator_in_text_does_not_collide(spark):
    a = spark.createDataFrame([("a,b", "c")], "x string, y string")
    b = spark.createDataFrame([("a", "b,c")], "x string, y string")
    assert table_checksum(a, portable=True).collect()[0]["checksum"] != \
        table_checksum(b, portable=True).collect()[0]["checksum"]


def test_checksum_special_values(spark):
    df = spark.createDataFrame([(float("nan"), [1.5, None], {"b": 1, "a": 2}), (-0.0, [], None)],
                               "x double, arr array<double>, m map<string,int>")
    r1 = table_checksum(df, portable=True).collect()[0]
    r2 = table_checksum(df.orderBy(F.desc("x")), portable=True).collect()[0]
    assert r1["row_count"] == 2 and r1["checksum"] == r2["checksum"]
    assert table_checksum(df).collect()[0]["row_count"] == 2


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.sampled_from(["a", "b", None])), max_size=12),
       st.lists(st.tuples(st.integers(0, 5), st.sampled_from(["a", "b", None])), max_size=12))
def test_narrow_equals_exact(spark, left, right):
    s = spark.createDataFrame(left, "k int, v string")
    t = spark.createDataFrame(right, "k int, v string")
    e1, e2 = reconcile_rows(s, t, "exact")
    n1, n2 = reconcile_rows(s, t, "narrow", buckets=3)
    assert rows(e1) == rows(n1) and rows(e2) == rows(n2)


def test_validation_lists_and_summary(spark, invs):
    from tablemover.plans.validate import validate
    src, dst = invs
    v = validate(src, dst, "assess")
    summary = {r["check"]: r["objects"] for r in v.summary().collect()}
    # the null-database row drops out of every NOT IN filter, as in SQL
    assert summary == {"external_tables": 3, "not_upgraded": 2, "target_tables": 2, "tables_only_in_source": 2,
                       "tables_only_in_target": 1, "views_only_in_source": 0, "views_only_in_target": 0}


def test_narrow_paths_empty_sparse_dense(spark):
    a = spark.range(3000).select(F.col("id"), (F.col("id") % 7).alias("v"))
    b = a.withColumn("v", F.when(F.col("id") == 5, 99).otherwise(F.col("v")))
    c = a.withColumn("v", F.col("v") + 1)
    for other, expect in ((a, 0), (b, 1), (c, 3000)):
        s, t = reconcile_rows(a, other, "narrow", buckets=64)
        e1, e2 = reconcile_rows(a, other, "exact")
        assert s.count() == expect == t.count()
        assert rows(s) == rows(e1) and rows(t) == rows(e2)


def test_batched_counts_checksums_and_stats_keep_empty_tables(spark):
    from tablemover.operators.reconcile import table_checksums
    from tablemover.sources.stats import table_stats
    full = spark.range(10).select(F.col("id"), (F.col("id") % 2).alias("p"))
    empty = full.where(F.lit(False))
    counts = {r["table_name"]: r["row_count"] for r in count_rows({"full": full, "empty": empty}).collect()}
    assert counts == {"full": 10, "empty": 0}
    sums = {r["table_name"]: (r["row_count"], r["checksum"]) for r in
            table_checksums({"full": full, "empty": empty, "again": full}).collect()}
    assert sums["empty"] == (0, "0") and sums["full"] == sums["again"] and sums["full"][0] == 10
    st = {r["table_name"]: r["row_count"] for r in table_stats({"full": full, "empty": empty},
                                                                no_files={"full", "empty"}).collect()}
    assert st == {"full": 10, "empty": 0}


def test_reconcile_partitions_with_null_partition(spark):
    from tablemover.operators.reconcile import reconcile_partitions
    s = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "v int, p string")
    t = spark.createDataFrame([(1, "a"), (2, None), (4, "b"), (5, "c")], "v int, p string")
    out = {r["p"]: (r["status"], r["source_rows"], r["target_rows"]) for r in
           reconcile_partitions(s, t, ["p"]).collect()}
    assert out == {"b": ("changed", 1, 1), "c": ("extra", 0, 1)}
    t2 = spark.createDataFrame([(1, "a"), (3, "b")], "v int, p string")
    assert {r["p"]: r["status"] for r in reconcile_partitions(s, t2, ["p"]).collect()} == {None: "missing"}


def test_internal_names_do_not_clash(spark):
    from tablemover.operators.sequence import with_sequence
    df = spark.createDataFrame([(1, 2, 3, 4), (5, 6, 7, 8), (1, 2, 3, 4)], "_b long, _pid long, _rn long, _off long")
    other = df.limit(1)
    s, t = reconcile_rows(df, other, "narrow", buckets=8)
    assert s.count() == 2 and t.count() == 0
    assert sorted(r["n"] for r in with_sequence(df, ["_b"], "n").collect()) == [1, 2, 3]


@pytest.mark.parametrize("method", ["exact", "narrow"])
def test_row_difference_with_map_columns(spark, method):
    s = spark.createDataFrame([(1, {"a": 1, "b": 2}), (2, {"x": 9}), (3, None)], "k int, m map<string,int>")
    t = spark.createDataFrame([(1, {"b": 2, "a": 1}), (2, {"x": 8}), (3, None)], "k int, m map<string,int>")
    only_s, only_t = reconcile_rows(s, t, method, buckets=4)
    assert [(r["k"], r["m"]) for r in only_s.collect()] == [(2, {"x": 9})]
    assert [(r["k"], r["m"]) for r in only_t.collect()] == [(2, {"x": 8})]
    assert dict(only_s.dtypes)["m"] == "map<string,int>"


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-3, 3)),
                          st.one_of(st.none(), st.sampled_from(["", "a", "a,b", "1:a"])),
                          st.one_of(st.none(), st.floats(allow_infinity=True, allow_nan=True, width=64))),
                min_size=1, max_size=10), st.randoms(use_true_random=False))
def test_checksums_are_order_free_and_see_every_row(spark, rows, rnd):
    schema = "i int, s string, d double"
    a = spark.createDataFrame(rows, schema)
    shuffled = list(rows)
    rnd.shuffle(shuffled)
    b = spark.createDataFrame(shuffled, schema)
    c = spark.createDataFrame(rows + [rows[0]], schema)
    for portable in (False, True):
        ca, cb, cc = [table_checksum(x, portable=portable).collect()[0] for x in (a, b, c)]
        assert (ca["row_count"], ca["checksum"]) == (cb["row_count"], cb["checksum"])
        assert cc["checksum"] != ca["checksum"] and cc["row_count"] == ca["row_count"] + 1


@pytest.mark.parametrize("a, b, kind", [
    ("int", "long", "bigint"), ("int", "double", "double"), ("long", "double", None), ("string", "int", None),
    ("date", "timestamp", "timestamp"), ("date", "timestamp_ntz", "timestamp_ntz"), ("timestamp", "timestamp_ntz", None),
    ("decimal(12,2)", "decimal(14,4)", "decimal(14,4)"), ("decimal(38,0)", "decimal(38,10)", None),
    ("int", "decimal(5,2)", "decimal(12,2)"), ("decimal(10,2)", "double", None), ("float", "double", "double"),
    ("float", "int", "double"), ("short", "float", "float"), ("boolean", "int", None), ("array<int>", "array<double>", "array<double>"),
    ("struct<a:int>", "struct<A:long>", "struct<a:bigint>"), ("map<string,int>", "map<string,string>", None)])
def test_common_type_loses_nothing(spark, a, b, kind):
    from tablemover.operators.reconcile import common_type
    from pyspark.sql.types import _parse_datatype_string as parse
    for x, y in ((a, b), (b, a)):
        t = common_type(parse(x), parse(y))
        assert (t and t.simpleString().lower()) == kind


def test_different_types_are_not_equal(spark):
    from tablemover.operators.reconcile import TypeChanged, reconcile_partitions, schema_changes
    s = spark.sql("SELECT 1 AS k, 10 AS v, date'2024-01-01' AS d, 1.50BD AS p")
    for change in ("10.7D AS v, d, p", "v, to_timestamp(d) + INTERVAL 5 HOURS AS d, p", "v, d, 1.501BD AS p"):
        t = s.selectExpr("k", *[x.strip() for x in change.split(", ")])
        for method in ("exact", "narrow"):
            a, b = reconcile_rows(s, t, method)
            assert a.count() == b.count() == 1
        assert [r["status"] for r in keyed_diff(s, t, ["k"]).collect()] == ["changed"]
        assert [r["status"] for r in reconcile_partitions(s, t, ["k"]).collect()] == ["changed"]
    same = s.selectExpr("k", "10D AS v", "to_timestamp(d) AS d", "1.5000BD AS p")
    assert reconcile_rows(s, same)[0].count() == 0 and keyed_diff(s, same, ["k"]).count() == 0
    text = s.selectExpr("k", "'10' AS v", "d", "p")
    assert [(r["column"], r["change"]) for r in schema_changes(s, text).collect()] == [("v", "type_changed")]
    for compare in (lambda: reconcile_rows(s, text), lambda: reconcile_rows(s, text, "narrow"), lambda: keyed_diff(s, text, ["k"]),
                    lambda: reconcile_partitions(s, text, ["k"])):
        with pytest.raises(TypeChanged, match="v .int -> string"):
            compare()


def test_tree_narrows_to_the_change(spark):
    from tablemover.operators.reconcile import _under, differing_leaves
    from tablemover.functions.checksum import row_hash
    a = spark.range(200_000).selectExpr("id", "id % 7 AS v")
    for every, buckets in ((20, 64), (50_000, 64)):  # scattered over all nodes of the first level, and a few
        b = a.withColumn("v", F.when(F.col("id") % every == 0, F.col("v") + 1).otherwise(F.col("v")))
        leaves, bits, _, n = differing_leaves(a, b, buckets)
        changed = 200_000 // every
        assert leaves.count() == n <= 2 * changed
        under = _under(a.withColumn("_tm_h", row_hash(a)), leaves, bits).count()
        assert changed <= under <= 6 * changed
        s, t = reconcile_rows(a, b, "narrow", buckets)
        assert s.count() == t.count() == changed
    assert differing_leaves(a, a, 64) is None


def test_hot_repeats_are_spelled_out_by_several_tasks(spark):
    from tablemover.operators.reconcile import _REPEATS
    a = spark.range(3 * _REPEATS + 5).selectExpr("1 AS v")
    s, t = reconcile_rows(a, a.limit(0))
    sizes = s.groupBy(F.spark_partition_id()).count().collect()
    assert s.count() == 3 * _REPEATS + 5 and t.count() == 0
    assert len(sizes) > 1 and max(r["count"] for r in sizes) <= 2 * _REPEATS + 5


def test_many_differing_nodes_travel_as_a_bitmap(spark, monkeypatch):
    from pyspark.sql import functions as F
    from tablemover.operators import reconcile
    monkeypatch.setattr(reconcile, "_FEW_NODES", 10)
    a = spark.range(20000).select((F.col("id") % 15000).alias("k"), F.concat(F.lit("v"), F.col("id") % 7).alias("v"))
    b = a.where("k % 11 <> 0").withColumn("v", F.when(F.col("k") % 13 == 0, None).otherwise(F.col("v")))
    want = [sorted((r["k"], r["v"] or "") for r in x.collect()) for x in reconcile.reconcile_rows(a, b, "exact")]
    for bits in (27, 9, 6):  # as deep as the nodes, and ancestors that more equal rows share
        monkeypatch.setattr(reconcile, "_MAP_BITS", bits)
        s, t = reconcile.reconcile_rows(a, b, "narrow", buckets=64)
        assert "SortMergeJoin" not in s._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
        assert [sorted((r["k"], r["v"] or "") for r in x.collect()) for x in (s, t)] == want and want[0] and want[1]
