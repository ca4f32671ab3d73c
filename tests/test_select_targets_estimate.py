import pytest
from pyspark.sql import functions as F

from tablemover.operators.estimate import estimate_transfer
from tablemover.operators.select import exclude_schemas, exclude_tables, include_tables, parse_name_list
from tablemover.plans.targets import plan_targets

INV = "database string, name string, object_type string, upgraded_to string"


@pytest.fixture
def inv(spark):
    return spark.createDataFrame([("a", "t1", "EXTERNAL", None), ("a", "t2", "VIEW", None), ("b", "t1", "MANAGED", None),
                                  (None, "t3", "EXTERNAL", None), ("default", "my_default_t", "EXTERNAL", None),
                                  ("a", "t1", "EXTERNAL", None)], INV)


def test_parse_name_list():
    assert parse_name_list(" a, b ,,c ") == ["a", "b", "c"]
    assert parse_name_list("") == [] and parse_name_list(None) == []


def test_exclude_schemas_null_dropped_and_empty_list_keeps_all(spark, inv):
    assert exclude_schemas(inv, "").count() == inv.count()
    out = [r["name"] for r in exclude_schemas(inv, "b, default").collect()]
    assert sorted(out) == ["t1", "t1", "t2"]  # null database dropped like SQL NOT IN


def test_include_keeps_bag_and_ignores_duplicate_list_entries(spark, inv):
    inc = spark.createDataFrame([("a", "t1"), ("a", "t1")], "database string, name string")
    assert include_tables(inv, inc).count() == 2


def test_exclude_tables_composite_key(spark, inv):
    ex = spark.createDataFrame([("a", "t1")], "database string, name string")
    out = sorted((r["database"] or "", r["name"]) for r in exclude_tables(inv, ex).collect())
    assert out == [("", "t3"), ("a", "t2"), ("b", "t1"), ("default", "my_default_t")]
    empty = spark.createDataFrame([], "database string, name string")
    assert exclude_tables(inv, empty).count() == inv.count()


def test_plan_targets_location_by_flag_and_quoting(spark):
    man = spark.createDataFrame([("d", "t", "s", None, True, 1), ("d", "u", "s", "u2", False, 2),
                                 ("d", "w`x", "s", "w", None, 3)],
                                "database string, name string, target_schema string, target_table string, "
                                "is_pii boolean, t_no int")
    out = {r["name"]: r for r in plan_targets(man, "cat", "/pii/", "/nonpii").collect()}
    assert out["t"]["location"] == "/pii/s/t"
    assert out["u"]["location"] == "/nonpii/s/u2"
    assert out["w`x"]["location"] == "/pii/s/w"  # unknown flag goes to the PII side
    assert out["u"]["target_full_name"] == "cat.s.u2"
    assert out["w`x"]["source_quoted"] == "`hive_metastore`.`d`.`w``x`"


# 700 MB x 5.6 is 3919.9999999999995 s in floating point; seconds are truncated, as divmod + int does.
@pytest.mark.parametrize("bytes_,expected", [
    (0, "00:00"), (100_000, "00:00"), (10_714_285, "00:59"), (700_000_000, "65:19"), (20_000_000_000, "1866:40")])
def test_estimate_mm_ss_edges(spark, bytes_, expected):
    sizes = spark.createDataFrame([("s", "t", bytes_)], "target_schema string, table_name string, bytes long")
    per, _ = estimate_transfer(sizes, 5.6, "seconds_per_mb")
    assert per.collect()[0]["elapsed"] == expected


def test_estimate_modes_and_totals(spark):
    sizes = spark.createDataFrame([("s", "a", 1_000_000_000), ("s", "b", None)],
                                  "target_schema string, table_name string, bytes long")
    per, tot = estimate_transfer(sizes, 5.6, "seconds_per_mb")
    rows = {r["table_name"]: r for r in per.collect()}
    assert rows["a"]["seconds"] == pytest.approx(5600.0) and rows["b"]["seconds"] is None
    t = tot.collect()[0]
    assert t["seconds"] == pytest.approx(5600.0) and t["hours"] == pytest.approx(5600 / 3600)
    per2, tot2 = estimate_transfer(sizes, 5.6, "mb_per_second")
    assert per2.where(F.col("table_name") == "a").collect()[0]["seconds"] == pytest.approx(1000 / 5.6)
    with pytest.raises(ValueError):
        estimate_transfer(sizes, 0, "mb_per_second")
    with pytest.raises(ValueError):
        estimate_transfer(sizes, 1, "furlongs")


def test_estimate_manifest_sizes_managed_and_lists_the_rest(spark, db):
    from tablemover.operators.estimate import estimate_manifest
    from tablemover.session import new_work_dir
    from smallest import SF
    o = spark.read.parquet(f"{SF}/orders.parquet")
    o.write.saveAsTable(f"{db}.m")
    o.write.option("path", new_work_dir(spark, "x") + "/d").saveAsTable(f"{db}.e")
    man = spark.createDataFrame([(db, "m", "s"), (db, "e", "s"), (db, "gone", "s")],
                                "database string, name string, target_schema string")
    per, tot, skipped = estimate_manifest(spark, man, 2.0, "mb_per_second")
    rows = per.collect()
    assert [r["table_name"] for r in rows] == ["m"] and rows[0]["size_mb"] > 0
    assert tot.collect()[0]["seconds"] == pytest.approx(rows[0]["size_mb"] / 2.0)
    assert {r["name"]: r["reason"] for r in skipped.collect()} == {"e": "NOT_MANAGED_EXTERNAL", "gone": "SOURCE_MISSING"}


def test_one_per_key_is_deterministic(spark):
    from tablemover.operators.select import one_per_key
    df = spark.createDataFrame([("d", "t", "z", 2), ("d", "t", "a", 9), ("d", "u", None, 1)],
                               "database string, name string, ts string, n int")
    out = {(r["database"], r["name"]): (r["ts"], r["n"]) for r in one_per_key(df.repartition(3), ["database", "name"]).collect()}
    assert out == {("d", "t"): ("a", 9), ("d", "u"): (None, 1)}


def test_missing_target_schema_gives_no_location_and_a_problem(spark):
    from tablemover.sources.manifest import manifest_problems
    man = spark.createDataFrame([("d", "t", None, None, False, 1), ("d", "u", "s", None, True, 2)],
                                "database string, name string, target_schema string, target_table string, "
                                "is_pii boolean, t_no int")
    loc = {r["name"]: r["location"] for r in plan_targets(man, "c", "/p", "/n").collect()}
    assert loc == {"t": None, "u": "/p/s/u"}
    probs = [(r["name"], r["problem"]) for r in manifest_problems(man).collect()]
    assert probs == [("t", "NULL_TARGET")]
