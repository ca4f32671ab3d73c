import pytest
from pyspark.sql import functions as F

from tablemover.operators import copy as copy_ops
from tablemover.operators.reconcile import reconcile_rows
from tablemover.plans import convert as conv
from tablemover.plans.migration import plan_migration
from tablemover.plans.report import conversion_failures, conversion_summary, ineligible
from tablemover.plans.targets import plan_targets
from tablemover.plans.views import migrate_views, view_plan
from tablemover.session import new_database, new_work_dir
from tablemover.sources.catalog import inventory, object_type, partition_columns

from smallest import SF

MAN = "database string, name string, target_schema string, target_table string, is_pii boolean, t_no int"


def orders(spark):
    return spark.read.parquet(f"{SF}/orders.parquet")


def test_inventory_types_partitions_and_view_text(spark, db):
    orders(spark).write.partitionBy("o_orderstatus").saveAsTable(f"{db}.m")
    orders(spark).write.option("path", new_work_dir(spark, "e") + "/d").saveAsTable(f"{db}.e")
    orders(spark).select(F.col("o_orderkey").alias("Type")).write.saveAsTable(f"{db}.typed")
    spark.sql(f"CREATE VIEW {db}.v AS SELECT o_orderkey,\n 'a: b' AS c FROM {db}.m")
    inv = {r["name"]: r for r in inventory(spark, [db]).collect()}
    assert inv["m"]["object_type"] == "MANAGED" and inv["m"]["partition_columns"] == ["o_orderstatus"]
    assert inv["e"]["object_type"] == "EXTERNAL" and inv["e"]["partition_columns"] == []
    assert inv["typed"]["object_type"] == "MANAGED"  # a column called Type does not fool it
    assert inv["v"]["object_type"] == "VIEW" and inv["v"]["view_text"].startswith("SELECT o_orderkey,\n 'a: b'")
    assert object_type(spark, f"{db}.nope") is None


def test_copy_keeps_partitions_and_content(spark, db):
    orders(spark).write.partitionBy("o_orderstatus").saveAsTable(f"{db}.m")
    loc = new_work_dir(spark, "c") + "/d"
    parts = copy_ops.copy_table(spark, f"{db}.m", f"{db}.m_ext", loc, properties={"k": "it's"})
    assert parts == ["o_orderstatus"] and partition_columns(spark, f"{db}.m_ext") == ["o_orderstatus"]
    assert spark.catalog.getTable(f"{db}.m_ext").tableType == "EXTERNAL"
    back = copy_ops.read_back(spark, f"{db}.m_ext", orders(spark).columns)
    a, b = reconcile_rows(orders(spark), back)
    assert a.count() == 0 and b.count() == 0
    with pytest.raises(copy_ops.TargetNotEmpty):
        copy_ops.copy_table(spark, f"{db}.m", f"{db}.m_ext2", loc)


def _targets(spark, db, names, root):
    man = spark.createDataFrame([(db, n, "tgt", n, False, i) for i, n in enumerate(names)], MAN)
    return plan_targets(man, "cat", root + "/pii", root + "/nonpii")


def test_convert_states(spark, db):
    o = orders(spark)
    for t in ("plain", "has_ext", "has_old", "busy"):
        o.write.saveAsTable(f"{db}.{t}")
    o.limit(1).write.saveAsTable(f"{db}.has_ext_ext")
    o.limit(1).write.saveAsTable(f"{db}.has_old_old")
    o.write.option("path", new_work_dir(spark, "x") + "/d").saveAsTable(f"{db}.ext")
    spark.sql(f"CREATE VIEW {db}.view AS SELECT * FROM {db}.plain")
    root = new_work_dir(spark, "conv")
    o.limit(1).write.parquet(root + "/nonpii/tgt/busy")
    names = ["plain", "has_ext", "has_old", "busy", "ext", "view", "missing"]
    out = {r["name"]: r for r in conv.convert_to_external(spark, _targets(spark, db, names, root), drop_old=True,
                                                           verify="checksum", parallelism=3).collect()}
    assert {n: out[n]["outcome"] for n in names} == {
        "plain": "CONVERTED_DROPPED", "has_ext": "SKIPPED_EXT_EXISTS", "has_old": "SKIPPED_OLD_EXISTS",
        "busy": "TARGET_NOT_EMPTY", "ext": "SKIPPED_EXTERNAL", "view": "SKIPPED_VIEW", "missing": "SOURCE_MISSING"}
    assert out["plain"]["source_rows"] == out["plain"]["target_rows"] == o.count()
    assert out["plain"]["elapsed"] is not None and out["plain"]["size_mb"] > 0
    assert object_type(spark, f"{db}.plain") == "EXTERNAL" and object_type(spark, f"{db}.plain_old") is None
    assert object_type(spark, f"{db}.has_old") == "MANAGED"  # untouched
    fails = {r["full_name"] for r in conversion_failures(
        spark.createDataFrame(list(out.values()), conv.schemas.CONVERSION)).collect()}
    assert fails == {f"{db}.busy", f"{db}.missing"}
    assert conversion_summary(spark.createDataFrame(list(out.values()), conv.schemas.CONVERSION)).count() == 1


def test_convert_copy_failure_leaves_source(spark, db, monkeypatch):
    orders(spark).write.saveAsTable(f"{db}.t")

    def boom(*a, **k):
        raise RuntimeError("disk on fire")

    monkeypatch.setattr(conv.copy_ops, "copy_table", boom)
    r = conv.convert_to_external(spark, _targets(spark, db, ["t"], new_work_dir(spark, "f")), drop_old=True, verify="checksum").collect()[0]
    assert r["outcome"] == "COPY_FAILED" and "disk on fire" in r["reason"]
    assert object_type(spark, f"{db}.t") == "MANAGED"


def test_convert_verify_failure_does_not_swap_or_drop(spark, db, monkeypatch):
    orders(spark).write.saveAsTable(f"{db}.t")
    real = conv.copy_ops.copy_table

    def lossy(spark_, src, dst, loc, **k):
        real(spark_, src, dst, loc, **k)
        spark_.sql(f"INSERT INTO {dst} SELECT * FROM {src} LIMIT 1")

    monkeypatch.setattr(conv.copy_ops, "copy_table", lossy)
    r = conv.convert_to_external(spark, _targets(spark, db, ["t"], new_work_dir(spark, "v")), drop_old=True, verify="checksum").collect()[0]
    assert r["outcome"] == "VERIFY_FAILED" and r["target_rows"] == r["source_rows"] + 1
    assert object_type(spark, f"{db}.t") == "MANAGED" and object_type(spark, f"{db}.t_old") is None


def test_convert_second_rename_failure_is_undone(spark, db, monkeypatch):
    orders(spark).write.saveAsTable(f"{db}.t")
    real_sql = spark.sql

    class Proxy:
        def __getattr__(self, k):
            return getattr(spark, k)

        def sql(self, text, *a, **k):
            if "_ext` RENAME TO" in text:
                raise RuntimeError("metastore timeout")
            return real_sql(text, *a, **k)

    r = conv.convert_one(Proxy(), _targets(spark, db, ["t"], new_work_dir(spark, "r")).collect()[0].asDict(),
                         drop_old=True, verify="checksum")
    assert r["outcome"] == "RENAME_FAILED" and "undone" in r["reason"]
    assert object_type(spark, f"{db}.t") == "MANAGED" and object_type(spark, f"{db}.t_old") is None


def test_plan_register_and_views(spark):
    src, tgt = new_database(spark, "s"), new_database(spark, "t")
    o = orders(spark)
    o.write.option("path", new_work_dir(spark, "a") + "/d").partitionBy("o_orderstatus").saveAsTable(f"{src}.a")
    o.write.option("path", new_work_dir(spark, "b") + "/d").saveAsTable(f"{src}.b")
    o.write.saveAsTable(f"{src}.m")
    o.write.option("path", new_work_dir(spark, "c") + "/d").saveAsTable(f"{tgt}.b")
    spark.sql(f"CREATE VIEW {src}.v1 AS SELECT o_orderstatus, count(*) AS n FROM {src}.a GROUP BY 1")
    spark.sql(f"CREATE VIEW {src}.v2 AS SELECT sum(n) AS total FROM {src}.v1")
    inv = inventory(spark, [src])
    tinv = inventory(spark, [tgt]).select(F.lit("c").alias("table_catalog"), F.col("database").alias("table_schema"),
                                          F.col("name").alias("table_name"), F.col("object_type").alias("table_type"))
    man = spark.createDataFrame([(src, n, tgt, n, False, i) for i, n in enumerate(["a", "b", "m", "v1", "v2", "gone"])],
                                MAN)
    ex = spark.createDataFrame([], "database string, name string")
    plan = plan_migration(inv, tinv, "spark_catalog", man, ex)
    status = {r["source_name"]: r["status_code"] for r in plan.collect()}
    assert status == {"a": "READY", "b": "TARGET_EXISTS", "m": "MANAGED_SOURCE", "v1": "VIEW", "v2": "VIEW",
                      "gone": "SOURCE_MISSING"}
    dry = conv.register_external(spark, plan, inv, dry_run=True).collect()
    assert [r["outcome"] for r in dry] == ["DRY_RUN"] and not spark.catalog.tableExists(f"{tgt}.a")
    reg = conv.register_external(spark, plan, inv, dry_run=False, owner="team").collect()
    assert [(r["name"], r["outcome"], r["target_rows"]) for r in reg] == [("a", "REGISTERED", o.count())]
    assert partition_columns(spark, f"{tgt}.a") == ["o_orderstatus"]
    vp = view_plan(inv).withColumn("target_schema", F.lit(tgt))
    mapping = {f"{src}.a": f"{tgt}.a", f"{src}.v1": f"{tgt}.v1"}
    # v2 depends on v1 and sorts first in no particular way: the retry rounds create both.
    out = {r["source_view"].split(".")[-1]: r["outcome"] for r in
           migrate_views(spark, vp, mapping, dry_run=False).collect()}
    assert out == {"v1": "VIEW_CREATED", "v2": "VIEW_CREATED"}
    assert spark.table(f"{tgt}.v2").collect()[0]["total"] == o.count()
    managed, other = ineligible(plan)
    assert [r["source_name"] for r in managed.collect()] == ["m"]
    assert sorted(r["source_name"] for r in other.collect()) == ["b", "gone"]


def test_ineligible_compares_schema_not_substring(spark):
    plan = spark.createDataFrame([("default", "t", "MANAGED_SOURCE"), ("sales", "my_default_t", "MANAGED_SOURCE")],
                                 "source_schema string, source_name string, status_code string")
    managed, _ = ineligible(plan)
    assert [r["source_name"] for r in managed.collect()] == ["my_default_t"]


def test_split_by_flag_and_csv(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, flag boolean")
    back = copy_ops.split_by_flag(df, "flag", new_work_dir(spark, "s") + "/d")
    assert sorted((r["id"], r["route"]) for r in back.collect()) == [(1, "pii"), (2, "nonpii"), (3, "pii")]
    path = new_work_dir(spark, "csv") + "/d"
    copy_ops.write_csv(df, path, single_file=True)
    assert sorted(tuple(r) for r in copy_ops.read_csv(spark, path, df.schema).collect()) == \
        sorted(tuple(r) for r in df.collect())
    with pytest.raises(Exception):
        copy_ops.write_csv(df, path)  # default mode refuses to overwrite


def test_convert_resumes_after_lost_driver(spark, db):
    o = orders(spark)
    root = new_work_dir(spark, "resume")
    # copied, driver lost before the swap
    o.write.saveAsTable(f"{db}.a")
    copy_ops.copy_table(spark, f"{db}.a", f"{db}.a_ext", root + "/other/a")
    # lost between the two renames
    o.write.saveAsTable(f"{db}.b")
    copy_ops.copy_table(spark, f"{db}.b", f"{db}.b_ext", root + "/other/b")
    spark.sql(f"ALTER TABLE {db}.b RENAME TO {db}.b_old")
    # swap done, drop pending
    o.write.saveAsTable(f"{db}.c")
    copy_ops.copy_table(spark, f"{db}.c", f"{db}.c_ext", root + "/other/c")
    spark.sql(f"ALTER TABLE {db}.c RENAME TO {db}.c_old")
    spark.sql(f"ALTER TABLE {db}.c_ext RENAME TO {db}.c")
    targets = _targets(spark, db, ["a", "b", "c"], root)
    off = {r["name"]: r["outcome"] for r in conv.convert_to_external(spark, targets, resume=False).collect()}
    assert off == {"a": "SKIPPED_EXT_EXISTS", "b": "SOURCE_MISSING", "c": "SKIPPED_EXTERNAL"}
    out = {r["name"]: (r["outcome"], r["reason"], r["target_rows"])
           for r in conv.convert_to_external(spark, targets, drop_old=True, verify="checksum").collect()}
    n = o.count()
    assert {k: v[0] for k, v in out.items()} == {"a": "CONVERTED_DROPPED", "b": "CONVERTED_DROPPED",
                                                "c": "CONVERTED_DROPPED"}
    assert all(v[1].startswith("resumed") and v[2] == n for v in out.values())
    for t in ("a", "b", "c"):
        assert object_type(spark, f"{db}.{t}") == "EXTERNAL" and object_type(spark, f"{db}.{t}_old") is None
        assert not spark.catalog.tableExists(f"{db}.{t}_ext")


def test_plan_without_manifest_and_migrate_checks(spark):
    from tablemover.plans.migrate import migrate
    inv = spark.createDataFrame([("a", "t", "EXTERNAL"), ("a", "m", "MANAGED")], "database string, name string, "
                                                                                  "object_type string")
    tinv = spark.createDataFrame([], "table_catalog string, table_schema string, table_name string, table_type string")
    plan = {r["source_name"]: (r["status_code"], r["target_schema"]) for r in
            plan_migration(inv, tinv, "c", exclude_schemas="b").collect()}
    assert plan == {"t": ("READY", "a"), "m": ("MANAGED_SOURCE", "a")}
    with pytest.raises(ValueError):
        migrate(spark, "everything")


def test_migrate_dry_run_writes_nothing(spark):
    from tablemover.plans.migrate import migrate
    src, tgt = new_database(spark, "ds"), new_database(spark, "dt")
    orders(spark).write.option("path", new_work_dir(spark, "d") + "/d").saveAsTable(f"{src}.o")
    spark.sql(f"CREATE VIEW {src}.v AS SELECT count(*) AS n FROM {src}.o")
    man = spark.createDataFrame([(src, "o", tgt, "o", False, 1)], MAN)
    res = migrate(spark, "all", [src], "spark_catalog", [tgt], manifest=man, dry_run=True,
                  source_catalog="spark_catalog")
    assert [r["outcome"] for r in res.tables.collect()] == ["DRY_RUN"]
    assert [r["outcome"] for r in res.views.collect()] == ["DRY_RUN"]
    assert spark.catalog.listTables(tgt) == []


def test_inventory_skip_unlistable_database(spark, db):
    orders(spark).limit(5).write.saveAsTable(f"{db}.t")
    with pytest.raises(Exception):
        inventory(spark, [db, "no_such_db_xyz"]).collect()
    names = [r["name"] for r in inventory(spark, [db, "no_such_db_xyz"], errors="skip").collect()]
    assert names == ["t"]


def test_convert_largest_first_order(spark, db):
    man = spark.createDataFrame([(db, n, "tgt", n, False, i) for i, n in enumerate(["small", "big", "mid"])], MAN)
    targets = plan_targets(man, "cat", "/p", "/n")
    sizes = spark.createDataFrame([(db, "small", 1), (db, "big", 100), (db, "mid", 10)],
                                  "database string, name string, bytes long")
    assert [r["name"] for r in conv._plan_rows(targets, sizes)] == ["big", "mid", "small"]
    assert [r["name"] for r in conv._plan_rows(targets)] == ["small", "big", "mid"]


def test_copy_keeps_format_buckets_comment_and_properties(spark, db):
    src = orders(spark).select("o_orderkey", "o_custkey", "o_orderstatus")
    (src.write.format("orc").option("compression", "zlib").bucketBy(4, "o_custkey").sortBy("o_custkey")
     .partitionBy("o_orderstatus").saveAsTable(f"{db}.b"))
    spark.sql(f"ALTER TABLE {db}.b SET TBLPROPERTIES ('team' = 'sales', 'comment' = 'orders by customer')")
    copy_ops.copy_table(spark, f"{db}.b", f"{db}.b_ext", new_work_dir(spark, "k") + "/d", properties={"x": "1"})
    from tablemover.sources.catalog import describe_table
    a, b = describe_table(spark, f"{db}.b"), describe_table(spark, f"{db}.b_ext")
    assert b["type"] == "EXTERNAL" and b["provider"] == "orc" and b["comment"] == "orders by customer"
    assert (b["num_buckets"], b["bucket_columns"], b["sort_columns"]) == (4, ["o_custkey"], ["o_custkey"])
    assert b["properties"]["team"] == "sales" and b["properties"]["x"] == "1"
    assert b["options"].get("compression") == "zlib"
    assert partition_columns(spark, f"{db}.b_ext") == ["o_orderstatus"]
    s, t = reconcile_rows(spark.table(f"{db}.b"), spark.table(f"{db}.b_ext"))
    assert s.count() == 0 and t.count() == 0
    assert a["type"] == "MANAGED"


def test_stats_isolate_a_broken_table(spark, db):
    import os
    import shutil
    from tablemover.sources.stats import catalog_table_stats
    orders(spark).write.saveAsTable(f"{db}.good")
    loc = new_work_dir(spark, "broken") + "/d"
    orders(spark).write.option("path", loc).saveAsTable(f"{db}.broken")
    for f in os.listdir(loc.replace("file:", "")):
        if f.endswith(".parquet"):
            with open(os.path.join(loc.replace("file:", ""), f), "wb") as fh:
                fh.write(b"not parquet at all")
    with pytest.raises(Exception):
        catalog_table_stats(spark, [f"{db}.good", f"{db}.broken"]).collect()
    out = {r["table_name"]: r for r in catalog_table_stats(spark, [f"{db}.good", f"{db}.broken", f"{db}.nope"],
                                                           errors="isolate").collect()}
    assert out[f"{db}.good"]["row_count"] == orders(spark).count() and out[f"{db}.good"]["error"] is None
    assert out[f"{db}.broken"]["row_count"] is None and out[f"{db}.broken"]["error"]
    assert out[f"{db}.nope"]["error"]


def test_migrate_moves_views_over_views(spark):
    from tablemover.plans.migrate import migrate
    src, tgt = new_database(spark, "vs"), new_database(spark, "vt")
    orders(spark).write.option("path", new_work_dir(spark, "o") + "/d").saveAsTable(f"{src}.o")
    spark.sql(f"CREATE VIEW {src}.v1 AS SELECT o_orderstatus, count(*) AS n FROM {src}.o GROUP BY 1")
    spark.sql(f"CREATE VIEW {src}.v2 AS SELECT sum(n) AS total FROM {src}.v1")
    man = spark.createDataFrame([(src, "o", tgt, "o", False, 1)], MAN)
    res = migrate(spark, "all", [src], "spark_catalog", [tgt], manifest=man, dry_run=False,
                  source_catalog="spark_catalog")
    assert sorted(r["outcome"] for r in res.views.collect()) == ["VIEW_CREATED", "VIEW_CREATED"]
    text = spark.sql(f"DESCRIBE TABLE EXTENDED {tgt}.v2").where("col_name = 'View Text'").collect()[0][1]
    assert f"{tgt}.v1" in text and src not in text
    assert spark.table(f"{tgt}.v2").collect()[0]["total"] == orders(spark).count()
    spark.sql(f"DROP VIEW {src}.v1")  # the migrated views must not depend on the source ones
    assert spark.table(f"{tgt}.v2").collect()[0]["total"] == orders(spark).count()


def test_migrate_finds_existing_targets_without_being_told_where(spark):
    from tablemover.plans.migrate import migrate
    src, tgt = new_database(spark, "es"), new_database(spark, "et")
    o = orders(spark).limit(10)
    o.write.option("path", new_work_dir(spark, "x") + "/d").saveAsTable(f"{src}.a")
    o.write.option("path", new_work_dir(spark, "y") + "/d").saveAsTable(f"{tgt}.a")
    man = spark.createDataFrame([(src, "a", tgt, "a", False, 1)], MAN)
    res = migrate(spark, "external-tables", [src], "spark_catalog", manifest=man, dry_run=True)
    assert [r["status_code"] for r in res.plan.collect()] == ["TARGET_EXISTS"]


def test_schema_listing_is_ordered_and_excludes(spark):
    from tablemover.sources.catalog import list_databases
    assert list_databases(spark, "zeta, alpha ,beta,alpha", "beta") == ["alpha", "zeta"]
    every = list_databases(spark, "all", "")
    assert every == sorted(every) and "default" in every


def test_view_plan_keeps_source_and_target_in_one_row(spark):
    inv = spark.createDataFrame([("s", "v1", "VIEW", "select 1"), ("s", "v2", "VIEW", "select 2"),
                                 ("s", "t", "EXTERNAL", None)],
                                "database string, name string, object_type string, view_text string")
    vm = spark.createDataFrame([("s", "v2", "n", "w2"), ("s", "v2", "n", "w2"), ("s", "gone", "n", "g")],
                               "source_schema string, source_view string, target_schema string, target_view string")
    rows = {r["source_view"]: (r["target_schema"], r["target_view"], r["view_text"])
            for r in view_plan(inv, view_manifest=vm).collect()}
    assert rows == {"v2": ("n", "w2", "select 2"), "gone": ("n", "g", None)}
    plain = {r["source_view"]: (r["target_schema"], r["target_view"]) for r in view_plan(inv).collect()}
    assert plain == {"v1": ("s", "v1"), "v2": ("s", "v2")}


def test_verify_names_the_partitions_that_differ(spark, db):
    o = orders(spark)
    o.write.partitionBy("o_orderstatus").saveAsTable(f"{db}.p")
    loc = new_work_dir(spark, "pv") + "/d"
    copy_ops.copy_table(spark, f"{db}.p", f"{db}.p_ext", loc)
    spark.sql(f"INSERT INTO {db}.p_ext SELECT o_orderkey + 1000000, o_custkey, o_totalprice, o_orderdate, "
              f"o_orderpriority, 'F' FROM {db}.p WHERE o_orderstatus = 'F' LIMIT 1")
    spark.sql(f"INSERT INTO {db}.p SELECT o_orderkey + 1000000, o_custkey, o_totalprice + 1, o_orderdate, "
              f"o_orderpriority, 'F' FROM {db}.p_ext WHERE o_orderkey >= 1000000")
    v = conv.verify_copy(spark, f"{db}.p", f"{db}.p_ext", "checksum")
    assert not v["ok"] and v["reason"] == "checksums differ in 1 partition(s): o_orderstatus=F"


def test_verify_many_batches_and_isolates(spark, db):
    o = orders(spark)
    o.write.saveAsTable(f"{db}.a")
    o.write.saveAsTable(f"{db}.a2")
    o.write.saveAsTable(f"{db}.b")
    o.limit(10).write.saveAsTable(f"{db}.b2")
    o.write.saveAsTable(f"{db}.c")
    o.withColumn("o_totalprice", F.col("o_totalprice") + 1).write.saveAsTable(f"{db}.c2")
    pairs = [(f"{db}.a", f"{db}.a2"), (f"{db}.b", f"{db}.b2"), (f"{db}.c", f"{db}.c2"), (f"{db}.a", f"{db}.nope")]
    out = conv.verify_many(spark, pairs, "checksum")
    assert out[0]["ok"] is True and out[0]["source_rows"] == o.count()
    assert out[1]["ok"] is False and out[1]["reason"].startswith("row counts differ")
    assert out[2]["ok"] is False and out[2]["reason"] == "checksums differ"
    assert isinstance(out[3], Exception)


def test_migrate_reconciles_what_was_planned(spark):
    from tablemover.plans.migrate import migrate
    src, tgt = new_database(spark, "rs"), new_database(spark, "rt")
    o = orders(spark).limit(20)
    for t in ("a", "b", "skip"):
        o.write.option("path", new_work_dir(spark, t) + "/d").saveAsTable(f"{src}.{t}")
    o.write.option("path", new_work_dir(spark, "pre") + "/d").saveAsTable(f"{tgt}.b2")   # already there
    o.write.option("path", new_work_dir(spark, "odd") + "/d").saveAsTable(f"{tgt}.stray")  # nobody planned it
    man = spark.createDataFrame([(src, "a", tgt, "a2", False, 1), (src, "b", tgt, "b2", False, 2)], MAN)
    res = migrate(spark, "external-tables", [src], "spark_catalog", manifest=man, dry_run=False)
    assert {r["source_name"]: r["status_code"] for r in res.plan.collect()} == {"a": "READY", "b": "TARGET_EXISTS"}
    assert res.only_in_source.count() == 0
    assert [(r["table_schema"], r["table_name"]) for r in res.only_in_target.collect()] == [(tgt, "stray")]


def test_inventory_parallel_equals_serial(spark):
    dbs = [new_database(spark, f"p{i}") for i in range(5)]
    for i, d in enumerate(dbs):
        orders(spark).limit(3).write.saveAsTable(f"{d}.t{i}")
    a = [tuple(r) for r in inventory(spark, dbs).collect()]
    b = [tuple(r) for r in inventory(spark, dbs, parallelism=4).collect()]
    assert a == b and len(a) == 5


def test_migration_summary_counts(spark):
    from tablemover.plans.report import migration_summary
    plan = spark.createDataFrame([("default", "a", "MANAGED_SOURCE"), ("s", "b", "MANAGED_SOURCE"), ("s", "c", "READY"),
                                  ("s", "d", "TARGET_EXISTS"), ("s", "e", "SOURCE_MISSING"), ("s", "v", "VIEW")],
                                 "source_schema string, source_name string, status_code string")
    tables = spark.createDataFrame([("c", "REGISTERED"), ("x", "VERIFY_FAILED")], "name string, outcome string")
    views = spark.createDataFrame([("v", "VIEW_CREATED")], "source_view string, outcome string")
    got = {r["category"]: r["objects"] for r in migration_summary(plan, tables, views).collect()}
    assert got == {"NOT_ELIGIBLE": 4, "MANAGED_OUTSIDE_DEFAULT": 1, "OTHER_NOT_ELIGIBLE": 2, "MIGRATED_TABLES": 1,
                   "FAILED_TABLES": 1, "MIGRATED_VIEWS": 1, "FAILED_VIEWS": 0}


def test_convert_detects_source_written_during_copy(spark, db, monkeypatch):
    orders(spark).write.saveAsTable(f"{db}.busy_src")
    orders(spark).write.saveAsTable(f"{db}.calm")
    real = conv.copy_ops.copy_table

    def copy_then_rewrite_source(spark_, src, dst, loc, **k):
        real(spark_, src, dst, loc, **k)
        if "busy_src" in src:  # same rows, new files: counts and checksums still agree
            spark_.sql(f"INSERT OVERWRITE TABLE {src} SELECT * FROM {dst}")

    monkeypatch.setattr(conv.copy_ops, "copy_table", copy_then_rewrite_source)
    out = {r["name"]: (r["outcome"], r["reason"]) for r in conv.convert_to_external(
        spark, _targets(spark, db, ["busy_src", "calm"], new_work_dir(spark, "chg")), drop_old=True,
        verify="checksum").collect()}
    assert out["busy_src"][0] == "SOURCE_CHANGED" and "copy left" in out["busy_src"][1]
    assert out["calm"][0] == "CONVERTED_DROPPED"
    assert object_type(spark, f"{db}.busy_src") == "MANAGED"  # nothing swapped


def test_convert_auto_sizes_orders_largest_first(spark, db):
    o = orders(spark)
    o.limit(5).write.saveAsTable(f"{db}.small")
    o.write.saveAsTable(f"{db}.big")
    man = spark.createDataFrame([(db, "small", "tgt", "small", False, 1), (db, "big", "tgt", "big", False, 2),
                                 (db, "gone", "tgt", "gone", False, 3)], MAN)
    targets = plan_targets(man, "cat", "/p", "/n")
    sizes = conv._auto_sizes(spark, targets)
    assert [r["name"] for r in conv._plan_rows(targets, sizes)] == ["big", "small", "gone"]


def test_registration_marks_source_and_inventory_reads_it(spark):
    from tablemover.operators.reconcile import not_upgraded
    from tablemover.plans.migrate import migrate
    src, tgt = new_database(spark, "ms"), new_database(spark, "mt")
    o = orders(spark).limit(10)
    for t in ("a", "b"):
        o.write.option("path", new_work_dir(spark, t) + "/d").saveAsTable(f"{src}.{t}")
    man = spark.createDataFrame([(src, "a", tgt, "a", False, 1)], MAN)
    assert [r["upgraded_to"] for r in inventory(spark, [src]).collect()] == [None, None]
    migrate(spark, "external-tables", [src], "spark_catalog", manifest=man, dry_run=False)
    marks = {r["name"]: r["upgraded_to"] for r in inventory(spark, [src]).collect()}
    assert marks == {"a": f"spark_catalog.{tgt}.a", "b": None}
    assert [r["name"] for r in not_upgraded(inventory(spark, [src])).collect()] == ["b"]


def test_convert_empty_and_type_column_tables(spark, db):
    o = orders(spark)
    o.where(F.lit(False)).write.partitionBy("o_orderstatus").saveAsTable(f"{db}.empty_p")
    o.where(F.lit(False)).write.saveAsTable(f"{db}.empty")
    o.limit(20).select(F.col("o_orderkey").alias("Type"), "o_totalprice").write.saveAsTable(f"{db}.typed")
    out = {r["name"]: (r["outcome"], r["source_rows"], r["target_rows"]) for r in conv.convert_to_external(
        spark, _targets(spark, db, ["empty_p", "empty", "typed"], new_work_dir(spark, "emp")), drop_old=True,
        verify="checksum").collect()}
    assert out == {"empty_p": ("CONVERTED_DROPPED", 0, 0), "empty": ("CONVERTED_DROPPED", 0, 0),
                   "typed": ("CONVERTED_DROPPED", 20, 20)}
    assert spark.table(f"{db}.empty_p").count() == 0 and object_type(spark, f"{db}.empty_p") == "EXTERNAL"


def test_migrate_leaves_excluded_views_alone(spark):
    from tablemover.plans.migrate import migrate
    src, tgt = new_database(spark, "xv"), new_database(spark, "xt")
    orders(spark).limit(5).write.option("path", new_work_dir(spark, "o") + "/d").saveAsTable(f"{src}.o")
    spark.sql(f"CREATE VIEW {src}.keep AS SELECT * FROM {src}.o")
    spark.sql(f"CREATE VIEW {src}.skip AS SELECT * FROM {src}.o")
    man = spark.createDataFrame([(src, "o", tgt, "o", False, 1)], MAN)
    ex = spark.createDataFrame([(src, "skip")], "database string, name string")
    res = migrate(spark, "all", [src], "spark_catalog", manifest=man, exclude=ex, dry_run=True)
    assert [r["source_view"].split(".")[-1] for r in res.views.collect()] == ["keep"]


def test_inventory_stats_skip_views_unless_asked(spark, db):
    orders(spark).limit(7).write.saveAsTable(f"{db}.t")
    spark.sql(f"CREATE VIEW {db}.v AS SELECT * FROM {db}.t")
    plain = {r["name"]: r["row_count"] for r in inventory(spark, [db], with_stats=True).collect()}
    assert plain == {"t": 7, "v": None}
    counted = {r["name"]: r["row_count"] for r in inventory(spark, [db], with_stats=True, count_views=True).collect()}
    assert counted == {"t": 7, "v": 7}


def test_convert_dry_run_writes_nothing(spark, db):
    o = orders(spark).limit(10)
    o.write.saveAsTable(f"{db}.a")
    o.write.saveAsTable(f"{db}.busy")
    o.write.option("path", new_work_dir(spark, "e") + "/d").saveAsTable(f"{db}.e")
    root = new_work_dir(spark, "dry")
    o.write.parquet(root + "/nonpii/tgt/busy")
    out = {r["name"]: (r["outcome"], r["reason"]) for r in conv.convert_to_external(
        spark, _targets(spark, db, ["a", "busy", "e"], root), drop_old=True, verify="checksum", dry_run=True).collect()}
    assert out["a"][0] == "PLANNED" and "copy to" in out["a"][1] and "drop" in out["a"][1]
    assert out["busy"][0] == "TARGET_NOT_EMPTY" and out["e"][0] == "SKIPPED_EXTERNAL"
    assert object_type(spark, f"{db}.a") == "MANAGED" and not spark.catalog.tableExists(f"{db}.a_ext")


def test_copy_frame_and_single_file_csv(spark):
    import os
    o = orders(spark)
    path = new_work_dir(spark, "cf") + "/d"
    copy_ops.copy_frame(o, path, partition_by=["o_orderstatus"])
    back = spark.read.parquet(path).select(*o.columns)
    s, t = reconcile_rows(o, back)
    assert s.count() == 0 and t.count() == 0
    csv = new_work_dir(spark, "one") + "/d"
    copy_ops.write_csv(o.repartition(4), csv, single_file=True)
    parts = [f for f in os.listdir(csv.replace("file:", "")) if f.startswith("part-")]
    assert len(parts) == 1
