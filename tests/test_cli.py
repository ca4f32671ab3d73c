
import os

from tablemover.__main__ import main
from tablemover.session import new_work_dir
from tablemover.sources.catalog import object_type

from smallest import SF


def test_cli_manifest_estimate_convert(spark, db, tmp_path, capsys):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    o.write.saveAsTable(f"{db}.orders")
    o.limit(7).write.saveAsTable(f"{db}.small")
    (tmp_path / "list.csv").write_text(f"name,database,target_schema,is_pii\norders,{db},uc,no\nsmall,{db},uc,yes\n")
    man = new_work_dir(spark, "cli") + "/manifest"
    assert main(["manifest", str(tmp_path / "list.csv"), man]) == 0
    assert main(["estimate", man, "--rate", "2"]) == 0
    assert "== estimate" in capsys.readouterr().out
    root = new_work_dir(spark, "cli-roots")
    out = new_work_dir(spark, "cli-out") + "/reports"
    assert main(["--out", out, "convert", man, "--pii-root", root + "/p", "--nonpii-root", root + "/n",
                 "--drop-old", "--verify", "checksum"]) == 0
    assert object_type(spark, f"{db}.orders") == "EXTERNAL" and object_type(spark, f"{db}.orders_old") is None
    conv = {r["name"]: r["outcome"] for r in spark.read.parquet(out + "/conversions").collect()}
    assert conv == {"orders": "CONVERTED_DROPPED", "small": "CONVERTED_DROPPED"}
    loc = [r for r in spark.sql(f"DESCRIBE TABLE EXTENDED {db}.small").collect() if r[0] == "Location"][0][1]
    assert loc.endswith("/p/uc/small")  # is_pii "yes" -> PII root


def test_cli_inventory(spark, db, capsys):
    spark.read.parquet(f"{SF}/region.parquet").write.saveAsTable(f"{db}.r")
    out = new_work_dir(spark, "cli-inv") + "/reports"
    assert main(["--out", out, "inventory", "--schemas", db, "--with-stats"]) == 0
    rows = spark.read.parquet(out + "/inventory").collect()
    assert [(r["name"], r["object_type"], r["row_count"]) for r in rows] == [("r", "MANAGED", 5)]


def test_cli_inventory_then_validate(spark, capsys):
    from tablemover.plans.migrate import migrate
    from tablemover.session import new_database
    src, tgt = new_database(spark, "vsrc"), new_database(spark, "vtgt")
    spark.read.parquet(f"{SF}/nation.parquet").write.option("path", new_work_dir(spark, "n") + "/d").saveAsTable(f"{src}.n")
    spark.read.parquet(f"{SF}/region.parquet").write.option("path", new_work_dir(spark, "r") + "/d").saveAsTable(f"{src}.r")
    man = spark.createDataFrame([(src, "n", tgt, "n", False, 1)],
                                "database string, name string, target_schema string, target_table string, "
                                "is_pii boolean, t_no int")
    migrate(spark, "external-tables", [src], "spark_catalog", [tgt], manifest=man, dry_run=False)
    out = new_work_dir(spark, "cli-val")
    assert main(["--out", out + "/s", "inventory", "--schemas", src]) == 0
    assert main(["--out", out + "/t", "inventory", "--schemas", tgt]) == 0
    assert main(["--out", out + "/v", "validate", out + "/s/inventory", out + "/t/inventory"]) == 0
    summary = {r["check"]: r["objects"] for r in spark.read.parquet(out + "/v/summary").collect()}
    # n was migrated (but its schema name differs, so it is listed on both sides); r was not.
    assert summary["not_upgraded"] == 1 and summary["external_tables"] == 2


def test_cli_migrate_dry_run(spark):
    import json as _json
    from tablemover.session import new_database
    src, tgt = new_database(spark, "cms"), new_database(spark, "cmt")
    spark.read.parquet(f"{SF}/nation.parquet").write.option("path", new_work_dir(spark, "n") + "/d").saveAsTable(f"{src}.n")
    spark.sql(f"CREATE VIEW {src}.v AS SELECT n_name FROM {src}.n")
    man_path = new_work_dir(spark, "cm") + "/man.json"
    os.makedirs(os.path.dirname(man_path), exist_ok=True)
    with open(man_path, "w") as fh:
        for i, t in enumerate(["n", "v"]):
            fh.write(_json.dumps({"database": src, "name": t, "target_schema": tgt, "target_table": t,
                                  "is_pii": False, "t_no": i}) + "\n")
    out = new_work_dir(spark, "cm-out")
    assert main(["--out", out, "migrate", "all", "--schemas", src, "--catalog", "spark_catalog",
                 "--source-catalog", "spark_catalog", "--manifest", man_path]) == 0
    summary = {r["category"]: r["objects"] for r in spark.read.parquet(out + "/summary").collect()}
    assert summary["MIGRATED_TABLES"] == 1 and summary["MIGRATED_VIEWS"] == 1
    assert spark.catalog.listTables(tgt) == []  # a dry run writes nothing
