import json

from pyspark.sql import functions as F

from tablemover.sources.manifest import (build_manifest, dedup_manifest, load_manifest, manifest_problems,
                                         type_manifest, write_manifest)
from tablemover.session import new_work_dir
from tablemover.operators.sequence import with_sequence

RAW = "database string, name string, target_schema string, target_table string, is_pii string, t_no string"


def test_is_pii_parsed_not_truthy(spark):
    rows = [("d", "a", "t", None, "True", "1"), ("d", "b", "t", None, "no", "2"), ("d", "c", "t", None, None, "3"),
            ("d", "e", "t", None, "False", "4"), ("d", "f", "t", None, "maybe", "5")]
    out = {r["name"]: r["is_pii"] for r in type_manifest(spark.createDataFrame(rows, RAW)).collect()}
    assert out == {"a": True, "b": False, "c": None, "e": False, "f": None}


def test_target_table_defaults_to_name(spark):
    rows = [("d", "a", "t", None, "true", "1"), ("d", "b", "t", "bb", "true", "2")]
    out = {r["name"]: r["target_table"] for r in type_manifest(spark.createDataFrame(rows, RAW)).collect()}
    assert out == {"a": "a", "b": "bb"}


def test_same_name_two_databases_kept_and_exact_duplicates_dropped(spark):
    rows = [("d1", "t", "x", None, "true", "1"), ("d2", "t", "x", None, "true", "2"),
            ("d2", "t", "x", None, "true", "2")]
    out = dedup_manifest(type_manifest(spark.createDataFrame(rows, RAW)))
    assert sorted((r["database"], r["name"]) for r in out.collect()) == [("d1", "t"), ("d2", "t")]


def test_problems_duplicate_key_and_null_key(spark):
    rows = [("d1", "t", "x", None, "true", "1"), ("d1", "t", "y", None, "true", "2"),
            ("d1", None, "x", None, "true", "3"), ("d1", "u", "x", None, "true", "4"),
            ("d1", "u", "x", None, "true", "4")]
    out = {(r["database"], r["name"], r["problem"]): r["row_count"]
           for r in manifest_problems(type_manifest(spark.createDataFrame(rows, RAW))).collect()}
    assert out == {("d1", "t", "DUPLICATE_KEY"): 2, ("d1", None, "NULL_KEY"): 1}


def test_load_yaml_json_csv_same_rows_ordered_by_t_no(spark, tmp_path):
    entries = {"a": dict(database="d", name="a", target_schema="s", target_table="a", is_pii=True, t_no=3),
               "b": dict(database="d", name="b", target_schema="s", target_table="b2", is_pii="no", t_no=1),
               "c": dict(database="e", name="a", target_schema="s", target_table="a", is_pii=False, t_no=2)}
    y = tmp_path / "m.yaml"
    import yaml
    y.write_text(yaml.safe_dump({"resources": {"tables": entries}}))
    j = tmp_path / "m.json"
    j.write_text("\n".join(json.dumps(v) for v in entries.values()))
    c = tmp_path / "m.csv"
    c.write_text("database,name,target_schema,target_table,is_pii,t_no\n" + "\n".join(
        f"{v['database']},{v['name']},{v['target_schema']},{v['target_table']},{v['is_pii']},{v['t_no']}"
        for v in entries.values()))
    outs = []
    for path, fmt in ((y, "yaml"), (j, "json"), (c, "csv")):
        m, problems = load_manifest(spark, str(path), fmt)
        outs.append([tuple(r) for r in m.collect()])
        assert problems.count() == 0
    assert outs[0] == outs[1] == outs[2]
    assert [r[5] for r in outs[0]] == [1, 2, 3]
    assert outs[0][0][4] is False  # "no" is not PII


def test_build_manifest_numbers_in_order(spark):
    rows = [("b", "d", "s", "yes"), ("a", "d", "s", "no"), ("c", "d", "s", None)]
    df = spark.createDataFrame(rows, "name string, database string, target_schema string, is_pii string")
    out = [(r["name"], r["t_no"], r["target_table"], r["is_pii"]) for r in build_manifest(df).orderBy("t_no").collect()]
    assert out == [("a", 1, "a", False), ("b", 2, "b", True), ("c", 3, "c", None)]


def test_sequence_matches_row_number_across_partitions(spark):
    df = spark.range(0, 5000, 1, 13).select((F.col("id") * 7919 % 5000).alias("k"), (F.col("id") % 3).alias("v"))
    seq = with_sequence(df, ["k"], "n", partitions=7)
    got = sorted((r["k"], r["n"]) for r in seq.collect())
    assert got == [(k, k + 1) for k in range(5000)]


def test_write_and_read_manifest_roundtrip(spark):
    rows = [("d", "a", "t", "a", True, 1), ("d", "b", "t", "b", None, 2)]
    df = spark.createDataFrame(rows, "database string, name string, target_schema string, target_table string, "
                                     "is_pii boolean, t_no int")
    path = new_work_dir(spark, "man") + "/m"
    write_manifest(df, path, "json")
    back, _ = load_manifest(spark, path, "json")
    assert [tuple(r) for r in back.collect()] == [tuple(r) for r in df.collect()]


def test_manifest_from_csv_numbers_in_file_order(spark, tmp_path):
    from tablemover.sources.manifest import manifest_from_csv
    lines = ["name,database,target_schema,is_pii"] + [f"t{i:04d},db{i % 3},s,{'yes' if i % 2 else 'no'}"
                                                      for i in range(2000, 0, -1)]
    (tmp_path / "m.csv").write_text("\n".join(lines))
    m = manifest_from_csv(spark, str(tmp_path / "m.csv")).orderBy("t_no").collect()
    assert [r["name"] for r in m] == [f"t{i:04d}" for i in range(2000, 0, -1)]
    assert [r["t_no"] for r in m] == list(range(1, 2001))
    assert m[0]["is_pii"] is False and m[1]["is_pii"] is True and m[0]["target_table"] == "t2000"


def test_sequence_with_map_column_and_ties(spark):
    df = spark.createDataFrame([(1, "b", {"k": 1}), (1, "a", {"k": 2}), (0, "z", None)], "k int, s string, m map<string,int>")
    out = [(r["k"], r["s"], r["n"]) for r in with_sequence(df, ["k"], "n").orderBy("n").collect()]
    assert out == [(0, "z", 1), (1, "a", 2), (1, "b", 3)]


def test_view_manifest_from_yaml(spark, tmp_path):
    import yaml
    from tablemover.sources.manifest import load_view_manifest
    views = {"v1": dict(source_schema="s", source_view="v1", target_schema="t", target_view="w1"),
             "v1b": dict(source_schema="s", source_view="v1", target_schema="t", target_view="w1"),
             "v2": dict(source_schema="s", source_view="v2", target_schema="t", target_view="w2")}
    p = tmp_path / "views.yaml"
    p.write_text(yaml.safe_dump({"resources": {"views": views}}))
    rows = sorted(tuple(r) for r in load_view_manifest(spark, str(p), "yaml").collect())
    assert rows == [("s", "v1", "t", "w1"), ("s", "v2", "t", "w2")]


def test_yaml_duplicates_at_every_level_are_rows_with_file_and_line(spark, tmp_path):
    (tmp_path / "m.yaml").write_text("""resources:
  tables:
    a: {database: d, name: a, target_schema: s}
    a: {database: d, name: a2, target_schema: s}
    b:
      database: d
      name: b
      name: b2
      target_schema: 007
  tables:
    c: {database: d, name: c, target_schema: ~}
    lone: 5
---
resources:
  tables:
    e: {database: d, name: e, target_schema: s}
resources:
  tables:
    f: {database: d, name: f, target_schema: s}
---
other: 1
""")
    (tmp_path / "broken.yaml").write_text("resources:\n  tables:\n    g: {database: d, name: g, target_schema: s}\n---\nx: [1\n")
    (tmp_path / "empty.yaml").write_text("# nothing\n")
    from tablemover.sources.manifest import yaml_problems
    man, problems = load_manifest(spark, str(tmp_path), "yaml")
    rows = {r["name"]: r["target_schema"] for r in man.collect()}
    assert rows == {"a": "s", "a2": "s", "b2": "007", "c": None, "e": "s", "f": "s", "g": "s"}
    got = {(r["file"].rsplit("/", 1)[1], r["document"], r["line"], r["entry"], r["problem"])
           for r in yaml_problems(spark, str(tmp_path)).collect()}
    assert got == {("m.yaml", 0, 4, "a", "DUPLICATE_YAML_KEY"), ("m.yaml", 0, 8, "name", "DUPLICATE_YAML_KEY"),
                   ("m.yaml", 0, 10, "tables", "DUPLICATE_YAML_KEY"), ("m.yaml", 0, 12, "lone", "NOT_A_MAPPING"),
                   ("m.yaml", 1, 17, "resources", "DUPLICATE_YAML_KEY"), ("broken.yaml", 1, 6, None, "YAML_ERROR"),
                   ("empty.yaml", 0, None, None, "NO_SECTION")}
    assert {r["problem"] for r in problems.collect()} == {"DUPLICATE_YAML_KEY", "NOT_A_MAPPING", "YAML_ERROR", "NO_SECTION",
                                                          "NULL_TARGET"}
    assert all(r["line"] for r in problems.where("problem = 'DUPLICATE_YAML_KEY'").collect())


def test_yaml_merged_defaults_are_no_duplicates(spark, tmp_path):
    (tmp_path / "m.yaml").write_text("""base: &base {database: d, target_schema: s, is_pii: no}
resources:
  tables:
    a: {<<: *base, name: a}
    b: {name: b, <<: *base, target_schema: own}
""")
    man, problems = load_manifest(spark, str(tmp_path / "m.yaml"), "yaml")
    assert sorted((r["database"], r["name"], r["target_schema"], r["is_pii"]) for r in man.collect()) == [
        ("d", "a", "s", False), ("d", "b", "own", False)]
    assert problems.count() == 0


def test_a_file_is_read_entry_by_entry(tmp_path):
    import tracemalloc

    from tablemover.sources.yaml_entries import parse
    peaks = []
    for n in (300, 3000):
        p = tmp_path / f"{n}.yaml"
        p.write_text("resources:\n  tables:\n" + "".join(f"    e{i}:\n      name: e{i}\n      target_schema: s\n" for i in range(n)))
        list(parse(str(p), "resources", "views"))  # imports
        tracemalloc.start()
        assert sum(1 for r in parse(str(p), "resources", "tables") if r[3] == {"name": r[2], "target_schema": "s"}) == n
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert (peaks[1] - peaks[0]) / 2700 < 400, peaks  # bytes an entry: its key and line, to tell repeats


def test_yaml_files_without_a_last_line_end(spark, tmp_path):
    (tmp_path / "a.yaml").write_bytes("resources:\r\n  tables: &t\n    a: {name: 'é', database: d}\n    b: &b\n      <<: {name: q}\n      database: |+\n        x\n\n".encode()[:-1])
    (tmp_path / "b.yaml").write_bytes(b"resources: {views: 1, tables: {c: {name: c}}}\n---\nx: *t")
    from tablemover.sources.yaml_entries import read_entries
    rows = [(r["file"][-6], r["document"], r["entry"], r["fields"], r["problem"]) for r in read_entries(spark, str(tmp_path), "resources", "tables").collect()]
    assert sorted(rows, key=str) == sorted([("a", 0, "a", {"name": "é", "database": "d"}, None), ("a", 0, "b", {"database": "x\n", "name": "q"}, None),
        ("b", 0, "c", {"name": "c"}, None), ("b", 1, None, None, "YAML_ERROR")], key=str)
