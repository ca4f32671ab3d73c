import pytest
from hypothesis import given, settings, strategies as st

from tablemover.operators.rewrite import mapping_from_manifest, rewrite_catalog, rewrite_references, tokens

MAP = {"db.a": "new.a2", "db.b": "new.b2", "new.b2": "other.c", "db.weird": "s p.t`x", "dbé.ä": "sé.ü"}

CASES = [
    ("select * from db.a join db.ab", "select * from new.a2 join db.ab"),
    ("select * from `db`.`a`", "select * from new.a2"),
    ("select * from x.db.a", "select * from x.db.a"),
    ("select db.a.col from db.a", "select new.a2.col from new.a2"),
    ("select 'db.a' from db.a", "select 'db.a' from new.a2"),
    ("select 1 -- db.a\nfrom db.a /* db.a */", "select 1 -- db.a\nfrom new.a2 /* db.a */"),
    ("select * from db.b, new.b2", "select * from new.b2, other.c"),
    ("select my_hive_metastore_z from hive_metastore.db.a", "select my_hive_metastore_z from main.new.a2"),
    ("SELECT * FROM DB.A", "SELECT * FROM new.a2"),
    ("select * from `hive_metastore`.`db`.`zz`", "select * from main.`db`.`zz`"),
    ("select * from db.weird", "select * from `s p`.`t``x`"),
    ("select 'it''s db.a', \"db.a\" from db.a", "select 'it''s db.a', \"db.a\" from new.a2"),
    ("select * from dbé.ä join db.a", "select * from sé.ü join new.a2"),
    ("", ""),
]


@pytest.mark.parametrize("broadcast", [True, False])
def test_token_rule_cases(spark, broadcast):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)] + [(len(CASES), None)], "id int, text string")
    mapping = MAP if broadcast else spark.createDataFrame(list(MAP.items()), "key string, value string")
    out = rewrite_references(df, "text", mapping, "hive_metastore", "main", out_col="new",
                             join_hint=None if broadcast else "merge")
    got = {r["id"]: r["new"] for r in out.collect()}
    for i, (_, expected) in enumerate(CASES):
        assert got[i] == expected, CASES[i][0]
    assert got[len(CASES)] is None


def test_literal_catalog_rule_matches_reference_behaviour(spark):
    df = spark.createDataFrame([("a hive_metastore.x `hive_metastore`.y my_hive_metastore_z",)], "t string")
    out = df.select(rewrite_catalog("t", "hive_metastore", "cat").alias("t")).collect()[0]["t"]
    assert out == "a `cat`.x `cat`.y my_`cat`_z"


def test_empty_mapping_is_identity(spark):
    df = spark.createDataFrame([(1, "select * from db.a where x = 'q'")], "id int, text string")
    out = rewrite_references(df, "text", {}, None, None).collect()[0]["text"]
    assert out == "select * from db.a where x = 'q'"


def test_mapping_from_manifest_lowercases_keys(spark):
    man = spark.createDataFrame([("DB", "T", "s", None), ("db", None, "s", "x")],
                                "database string, name string, target_schema string, target_table string")
    assert [tuple(r) for r in mapping_from_manifest(man).collect()] == [("db.t", "s.T")]


@settings(max_examples=40, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab.`'\"-/* \n_x1")), max_size=40))
def test_tokens_join_back_to_input(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    toks = df.select(tokens("t").alias("k")).collect()[0]["k"]
    assert "".join(toks) == text


def test_texts_with_columns_named_like_internals(spark):
    df = spark.createDataFrame([(1, "select * from db.a", "k", "v")], "key int, text string, value string, _pos string")
    out = rewrite_references(df, "text", {"db.a": "x.y"}, out_col="new").collect()[0]
    assert (out["new"], out["value"], out["_pos"]) == ("select * from x.y", "k", "v")
