import os

from pyspark.sql import functions as F

from tablemover.session import new_database
from tablemover.sources.listing import hidden, list_files, listable, table_locations
from tablemover.sources.stats import catalog_table_stats


def _tree(root):
    """Files of known size in nested folders, more of them than one task lists."""
    sizes = {}
    for i in range(40):
        d = root / f"day={i}" / "part=a b%"
        d.mkdir(parents=True)
        (d / f"f{i}.txt").write_text("x" * i)
        sizes[str(d / f"f{i}.txt")] = i
        (d / "_SUCCESS").write_text("no")
        (d / ".f.crc").write_text("no")
    (root / "_temporary" / "0").mkdir(parents=True)
    (root / "_temporary" / "0" / "part").write_text("no")
    (root / "top.txt").write_text("top")
    sizes[str(root / "top.txt")] = 3
    return sizes


def test_every_visible_file_once_with_its_size(spark, tmp_path):
    sizes = _tree(tmp_path)
    for root in (str(tmp_path), f"file://{tmp_path}", f"file:{tmp_path}/"):
        rows = list_files(spark, [("t", root), ("gone", str(tmp_path / "gone"))]).collect()
        assert {r["path"].removeprefix("file:"): r["size"] for r in rows} == sizes and len(rows) == len(sizes)
        assert all(r["label"] == "t" and r["modified"] > 0 for r in rows)
    one = list_files(spark, [("t", str(tmp_path / "top.txt"))]).collect()
    assert [(r["size"]) for r in one] == [3] and list_files(spark, []).collect() == []


def test_hidden_names_and_unknown_schemes():
    assert [hidden(x) for x in ("_x", ".x", "_a=b", "a=_b", "x._COPYING_", "x")] == [True, True, False, False, True, False]
    assert listable("/x") and listable("file:///x") and not listable("nosuchfs://x/y")


def test_partitions_stored_elsewhere_count_once(spark, tmp_path):
    db = new_database(spark, "loc")
    spark.range(20).select("id", (F.col("id") % 4).alias("p")).write.partitionBy("p").saveAsTable(f"{db}.t")
    spark.range(7).write.parquet(str(tmp_path / "else where"))
    spark.sql(f"ALTER TABLE {db}.t ADD PARTITION (p = 9) LOCATION '{tmp_path}/else where'")
    spark.sql(f"CREATE VIEW {db}.v AS SELECT * FROM {db}.t")
    places = table_locations(spark, f"{db}.t")
    assert len(places) == 2 and table_locations(spark, f"{db}.v") is None and table_locations(spark, f"{db}.no") is None
    st = {r["table_name"]: r for r in catalog_table_stats(spark, [f"{db}.t", f"{db}.v"]).collect()}
    want = sum(os.path.getsize(os.path.join(d, f)) for top in (spark.conf.get("spark.checkpoint.dir", None), str(tmp_path))
               for d, _, files in os.walk(top) for f in files
               if f.startswith("part-") and (top == str(tmp_path) or f"/db-loc" in d and db_of(spark, db) in d))
    assert st[f"{db}.t"]["row_count"] == 27 and st[f"{db}.t"]["bytes"] == want and st[f"{db}.v"]["bytes"] is None


def db_of(spark, db):
    return spark.catalog.getDatabase(db).locationUri.rsplit("/", 1)[1]


def test_an_empty_table_has_no_bytes_and_its_own_fingerprint(spark):
    db = new_database(spark, "loc")
    spark.sql(f"CREATE TABLE {db}.e (a INT) USING parquet")
    before = catalog_table_stats(spark, [f"{db}.e"]).first()
    spark.sql(f"INSERT INTO {db}.e VALUES (1)")
    after = catalog_table_stats(spark, [f"{db}.e"]).first()
    assert (before["bytes"], before["files"], before["row_count"]) == (0, 0, 0)
    assert after["bytes"] > 0 and after["fingerprint"] != before["fingerprint"]
