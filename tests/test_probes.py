"""Cases that once went wrong: nested nulls, long literals, several YAML files, one bad table."""

import pytest
from pyspark.sql import functions as F

from tablemover.functions.tokens import SQL_TOKEN
from tablemover.operators.copy import read_csv, write_csv
from tablemover.operators.reconcile import SIDE, keyed_diff, reconcile_rows, row_differences, table_checksums
from tablemover.operators.rewrite import rewrite_references, tokens
from tablemover.plans import convert as conv
from tablemover.plans.targets import plan_targets
from tablemover.session import new_work_dir
from tablemover.sources.manifest import load_manifest

PAIRS = [
    ("array<string>", "array(null, 'a')", "array('a', null)"),
    ("array<string>", "array('a')", "array('a', null)"),
    ("struct<x:array<string>,y:array<string>>", "named_struct('x', array('x', 'y'), 'y', array())",
     "named_struct('x', array('x'), 'y', array('y'))"),
    ("struct<x:string,y:string>", "named_struct('x', null, 'y', 'a')", "named_struct('x', 'a', 'y', null)"),
    ("array<map<string,string>>", "array(map('k', null))", "array(map('k', 'v'))"),
    ("map<string,map<string,int>>", "map('a', map('b', 1))", "map('a', map('b', 2))"),
    ("struct<x:int>", "null", "named_struct('x', null)"),
]


@pytest.mark.parametrize("kind,a,b", PAIRS)
def test_nested_values_that_differ_are_told_apart(spark, kind, a, b):
    one, two = (spark.sql(f"SELECT 1 AS id, CAST({x} AS {kind}) AS v") for x in (a, b))
    for method in ("exact", "narrow"):
        s, t = reconcile_rows(one, two, method)
        assert (s.count(), t.count()) == (1, 1)
        assert reconcile_rows(one, one, method)[0].count() == 0
    assert s.collect() == one.collect() and t.collect() == two.collect()
    assert [r["status"] for r in keyed_diff(one, two, ["id"]).collect()] == ["changed"]
    for portable in (False, True):
        c = {r["table_name"]: r["checksum"] for r in table_checksums({"a": one, "b": two}, portable=portable).collect()}
        assert c["a"] != c["b"]


def test_both_sides_from_two_scans_and_one_exchange(spark, tmp_path):
    spark.range(1000).selectExpr("id", "id % 7 AS x").write.parquet(f"{tmp_path}/a")
    spark.range(990).selectExpr("id", "id % 7 AS x").write.parquet(f"{tmp_path}/b")
    d = row_differences(spark.read.parquet(f"{tmp_path}/a"), spark.read.parquet(f"{tmp_path}/b"))
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2 and plan.count("Exchange hashpartitioning") == 1
    assert [r[SIDE] for r in d.collect()] == ["source"] * 10


@pytest.mark.parametrize("text", ["SELECT '" + "x" * 1_000_000 + "' FROM db.a", "SELECT '" + "\\'" * 600_000 + "' FROM db.a",
                                  "SELECT '" + "''" * 300_000 + "' FROM db.a", "/*" + "* " * 400_000 + "*/ SELECT * FROM db.a",
                                  "SELECT 1 FROM db.a -- '" + "y" * 400_000, "SELECT 'open " + "z" * 200_000])
def test_long_tokens(spark, text):
    df = spark.createDataFrame([(None, text), (None, text)], "id int, text string")
    joined = df.select(F.array_join(tokens("text"), "").alias("t")).first()["t"]
    assert joined == text and SQL_TOKEN
    got = [r["text"] for r in rewrite_references(df, "text", {"db.a": "x.y"}).collect()]
    assert got == [text.replace("FROM db.a", "FROM x.y")] * 2  # null and repeated keys are rewritten too


def test_yaml_manifests_of_a_folder(spark, tmp_path):
    entry = "resources:\n  tables:\n    {0}:\n      database: d\n      name: {0}\n      target_schema: {1}\n"
    (tmp_path / "a.yml").write_text(entry.format("t1", "s"))
    (tmp_path / "b.yml").write_text(entry.format("t2", "s"))
    assert {r["name"] for r in load_manifest(spark, str(tmp_path), "yaml")[0].collect()} == {"t1", "t2"}
    (tmp_path / "c.yml").write_text(entry.format("t1", "other"))
    with pytest.raises(ValueError, match="t1"):
        load_manifest(spark, str(tmp_path), "yaml")


def test_csv_checkpoint_is_lossless(spark, tmp_path):
    rows = [(1, "a\nb"), (2, "  pad  "), (3, ""), (4, None), (5, 'q"u\\"o'), (6, "\\"), (7, "a,b\r\nc"), (8, "x\\N")]
    df = spark.createDataFrame(rows, "id int, text string")
    write_csv(df, f"{tmp_path}/c")
    assert sorted(tuple(r) for r in read_csv(spark, f"{tmp_path}/c", df.schema).collect()) == rows


def test_one_bad_table_fails_alone(spark, db, monkeypatch):
    for t in ("good", "gone"):
        spark.range(5).write.saveAsTable(f"{db}.{t}")
    man = spark.createDataFrame([(db, t, "uc", t, False, i) for i, t in enumerate(["good", "gone", "odd"])],
                                "database string, name string, target_schema string, target_table string, is_pii boolean, t_no int")
    spark.range(3).write.saveAsTable(f"{db}.odd")
    targets = plan_targets(man, "main", new_work_dir(spark, "p"), new_work_dir(spark, "n")).withColumn(
        "location", F.when(F.col("name") == "odd", "nosuchscheme://x/y").otherwise(F.col("location")))
    real = conv._check

    def vanish(spark_, row, *a):
        out = real(spark_, row, *a)
        if row["name"] == "gone":
            spark.sql(f"DROP TABLE IF EXISTS {db}.gone")
        return out

    dry = {r["name"]: r["outcome"] for r in conv.convert_to_external(spark, targets, dry_run=True).collect()}
    assert dry == {"good": "PLANNED", "gone": "PLANNED", "odd": "COPY_FAILED"}
    monkeypatch.setattr(conv, "_check", vanish)
    got = {r["name"]: r["outcome"] for r in conv.convert_to_external(spark, targets).collect()}
    assert got == {"good": "CONVERTED", "gone": "COPY_FAILED", "odd": "COPY_FAILED"}


def test_no_drop_on_counts_alone(spark, db):
    with pytest.raises(ValueError, match="drop_old"):
        conv.convert_one(spark, {"database": db, "name": "t"}, drop_old=True, verify="count")


def test_failed_registration_leaves_no_target(spark, db, tmp_path, monkeypatch):
    spark.range(5).write.option("path", f"file://{tmp_path}/o'x").saveAsTable(f"{db}.e")
    row = {"source_schema": db, "source_name": "e", "target_schema": db, "target_name": "e2", "target_catalog": None,
           "location": f"file://{tmp_path}/o'x", "provider": "parquet"}
    monkeypatch.setattr(conv, "verify_copy", lambda *a: {"ok": False, "reason": "no", "source_rows": 5, "target_rows": 2, "bytes": 0})
    assert conv.register_one(spark, row, dry_run=False)["outcome"] == "VERIFY_FAILED"
    assert not spark.catalog.tableExists(f"{db}.e2")
    monkeypatch.undo()
    assert conv.register_one(spark, row, dry_run=False)["outcome"] == "REGISTERED"


def test_scratch_is_dropped(spark):
    from tablemover.session import new_database, scratch
    with scratch(spark):
        db = new_database(spark, "tmp")
        path = new_work_dir(spark, "tmp")
        spark.range(3).write.saveAsTable(f"{db}.t")
        spark.range(3).write.parquet(path + "/x")
    assert not spark.catalog.databaseExists(db)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path + "/x")
