import pytest

from tablemover.operators.references import parse_references, rewrite_parsed, view_levels
from tablemover.plans.views import migrate_views, view_mapping, view_plan
from tablemover.session import new_database
from tablemover.sources.catalog import inventory

MAP = {"db.a": "x.y", "d`b.a": "x.z w", "db.b": "db.a"}


def rewritten(spark, text, cat=("hive", "main")):
    df = spark.createDataFrame([(text,)], "text string")
    return rewrite_parsed(df, "text", MAP, *cat).first()["new_text"]


@pytest.mark.parametrize("text, want", [
    ("SELECT db.a FROM other db", "SELECT db.a FROM other db"),                       # an alias named like a database
    ("SELECT * FROM db . a", "SELECT * FROM x.y"),
    ("SELECT * FROM db /* in /* nested */ */ . a", "SELECT * FROM x.y"),
    ("SELECT * FROM `d``b`.a", "SELECT * FROM x.`z w`"),
    ("SELECT * FROM DB.`A` t JOIN db.b u USING (k)", "SELECT * FROM x.y t JOIN db.a u USING (k)"),  # no chains
    ("SELECT db.a.c, db.a.* FROM db.a", "SELECT x.y.c, x.y.* FROM x.y"),
    ("WITH q AS (SELECT * FROM db.a), a AS (SELECT 1 AS k) SELECT 'db.a' FROM q, a", "WITH q AS (SELECT * FROM x.y), a AS (SELECT 1 AS k) SELECT 'db.a' FROM q, a"),
    ("SELECT (SELECT max(k) FROM db.a) FROM t WHERE k IN (SELECT k FROM hive.db.a) -- db.a", "SELECT (SELECT max(k) FROM x.y) FROM t WHERE k IN (SELECT k FROM main.x.y) -- db.a"),
    ("SELECT * FROM hive.zz.q", "SELECT * FROM main.zz.q"),
    ("SELECT 'ü漢😀', c FROM db.a", "SELECT 'ü漢😀', c FROM x.y"),
    ("this is no SQL of db.a", "this is no SQL of x.y"),                               # falls back to the token rule
    (None, None)])
def test_references_as_the_parser_reads_them(spark, text, want):
    assert rewritten(spark, text) == want


def test_a_mapping_frame_and_other_columns(spark):
    m = spark.createDataFrame([(k, v) for k, v in MAP.items()], "key string, value string")
    df = spark.createDataFrame([(1, "SELECT 1 FROM db.a"), (1, "SELECT 1 FROM db.a"), (2, None), (3, "no db.b sql")], "new int, text string")
    out = sorted((r["new"], r["new_text"]) for r in rewrite_parsed(df, "text", m).collect() if r["new"] != 2)
    assert out == [(1, "SELECT 1 FROM x.y")] * 2 + [(3, "no db.a sql")]
    assert parse_references(spark, "no db.b sql") is None


def test_levels_and_cycles():
    level, cycles = view_levels({"a": set(), "b": {"a", "gone"}, "c": {"a", "b"}, "x": {"y"}, "y": {"z", "a"}, "z": {"x"}, "w": {"x"}, "s": {"s"}})
    assert [level[v] for v in "abc"] == [0, 1, 2] and {level[v] for v in "xyzws"} == {3}
    assert cycles == [["s"], ["x", "y", "z"]]
    n = 20_000
    assert view_levels({str(i): {str(i - 1)} for i in range(n)})[0][str(n - 1)] == n - 1


def test_views_by_level_and_cycle_outcome(spark):
    src, tgt = new_database(spark, "vs"), new_database(spark, "vt")
    spark.sql(f"CREATE TABLE {src}.t USING parquet AS SELECT 1 AS k")
    for name, below in (("z1", "t"), ("m2", "z1"), ("a3", "m2")):
        spark.sql(f"CREATE VIEW {src}.{name} AS SELECT * FROM {src}.{below}")
    vp = view_plan(inventory(spark, [src])).select("source_schema", "source_view", "target_schema", "target_view", "view_text")
    loop = spark.createDataFrame([(src, "p", src, "p", f"SELECT * FROM {src}.q"), (src, "q", src, "q", f"SELECT * FROM {src}.p")], vp.schema)
    broken = spark.createDataFrame([(src, "bad", src, "bad", f"SELEC * FROM {src}.t")], vp.schema)
    from pyspark.sql import functions as F
    plan = vp.unionByName(loop).unionByName(broken).withColumn("target_schema", F.lit(tgt))
    dry = {r["source_view"].split(".")[1]: r["outcome"] for r in migrate_views(spark, plan, view_mapping(plan)).collect()}
    assert dry == {"z1": "DRY_RUN", "m2": "DRY_RUN", "a3": "DRY_RUN", "p": "DRY_RUN", "q": "DRY_RUN", "bad": "STATEMENT_INVALID"}
    out = {r["source_view"].split(".")[1]: r for r in migrate_views(spark, plan, view_mapping(plan), dry_run=False, owner="o'neil \\ x", parallelism=3).collect()}
    assert {k: r["outcome"] for k, r in out.items()} == {"z1": "VIEW_CREATED", "m2": "VIEW_CREATED", "a3": "VIEW_CREATED",
                                                         "p": "VIEW_CYCLE", "q": "VIEW_CYCLE", "bad": "VIEW_FAILED"}
    assert out["p"]["reason"] == f"cycle: {tgt}.p -> {tgt}.q -> {tgt}.p".lower()
    assert spark.table(f"{tgt}.a3").count() == 1
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {tgt}.a3").collect()}
    assert props["migration.owner"] == "o'neil \\ x"


def test_registration_dry_run_reports_what_a_run_would(spark, tmp_path):
    from tablemover.plans.convert import register_one
    src = new_database(spark, "rd")
    spark.range(3).write.option("path", str(tmp_path / "t")).saveAsTable(f"{src}.t")
    row = {"source_schema": src, "source_name": "t", "target_schema": src, "target_name": "t2", "location": str(tmp_path / "t"), "provider": "parquet"}
    assert register_one(spark, row)["outcome"] == "DRY_RUN"
    for change, text in (({"provider": "nosuch"}, "nosuch"), ({"location": str(tmp_path / "gone")}, "does not exist"),
                         ({"target_name": "t"}, "exists"), ({"source_name": "ghost"}, "ghost")):
        out = register_one(spark, {**row, **change})
        assert out["outcome"] in ("STATEMENT_INVALID", "REGISTER_FAILED") and text in out["reason"], out


def test_texts_of_one_shape_are_parsed_once(spark, monkeypatch):
    from tablemover.operators import references
    calls, parse = [], references.parse_references
    monkeypatch.setattr(references, "parse_references", lambda s, t: (calls.append(t), parse(s, t))[1])
    forms = ["WITH c AS (SELECT old.t{k}.x FROM old./* old.t */t{k}) SELECT 'old.t{k}' FROM c -- old.t{k}",
             "SELECT t{k}.a FROM old.t{k} t{k} JOIN old.u{k}", "SELECT old.t{k}.* FROM old.t{k} JOIN old.T{k} o{k} USING (k{k})"]
    rows = [(k, f.format(k=k)) for k in range(1, 250) for f in forms]
    df = spark.createDataFrame(rows, "k int, text string")
    m = spark.createDataFrame([(f"old.t{k}", f"new.n-{k}") for k in range(250)], "key string, value string")
    got = sorted((r["k"], r["text"], r["new_text"]) for r in rewrite_parsed(df, "text", m).collect())
    assert len(calls) == len(forms)
    know = {f"old.t{k}": f"new.n-{k}" for k in range(250)}
    for k, text, new in got[::25]:
        assert new == references.rewrite_parsed_text(text, parse(spark, text), know, None, None)
    assert len(got) == len(rows)


def test_what_is_carried_over_is_what_the_parser_says(spark):
    from tablemover.operators.references import carried, lex
    assert not [r[0] for r in spark.sql("SELECT keyword FROM sql_keywords()").collect() if any(c.isdigit() for c in r[0])]
    texts = ["SELECT a1 FROM d1.b2 t", "SELECT a10 FROM d1.b20 t", "SELECT a1 FROM d1.a1 t", "SELECT a1 FROM d1.A1 t", "SELECT A2 FROM d2.a2 t",
             "WITH c1 AS (SELECT 1), c1 AS (SELECT 2) SELECT * FROM c1", "WITH c1 AS (SELECT 1), c2 AS (SELECT 2) SELECT * FROM c1",
             "WITH `c1` AS (SELECT 1), c1 AS (SELECT 2) SELECT * FROM c1", "WITH `c1` AS (SELECT 1), c2 AS (SELECT 2) SELECT * FROM c1",
             "SELECT 'x' FROM d1.t1", "SELECT 'd1.t1 é😀' FROM d1.t22 /* d1.t1 */", "SELECT DATE '2020-01-01' FROM d1.t1", "SELECT DATE 'no' FROM d1.t1",
             "SELECT 1.e5 FROM d1.t1", "SELECT 1.e55 FROM d1.t1", "SELECT d1.t1.a FROM d1 . t1", "SELECT d2.t3.a FROM d4 . t3",
             "SELECT * FROM IDENTIFIER('d1.t1')", "SELECT * FROM IDENTIFIER('d2.t1')", "SELECT x -> 1 FROM `d``1`.t1", "SELECT 'it''s' FROM d1.t1",
             "SELECT /*+ BROADCAST(t1) */ 1 FROM d1.t1 t1", "SELECT 1 /* a /* d1.t1 */ b */ FROM d1.t1", "SELECT '\\' d1.t1' FROM d1.t2", "SELEC 1 FROM d1.t1"]
    shapes = {}
    for t in texts:
        shapes.setdefault(lex(t)[0], []).append(t)
    assert len(shapes) < len(texts) and all("".join(lex(t)[1]) == t for t in texts)
    for like in shapes.values():
        found = parse_references(spark, like[0])
        for t in like:
            assert (None if found is None else carried(t, like[0], found)) == parse_references(spark, t), t
