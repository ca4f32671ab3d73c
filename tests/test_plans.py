"""Physical-plan properties the operators rely on at scale."""

import io
import re
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from tablemover.operators.reconcile import keyed_diff, mismatched_buckets, not_upgraded, table_checksum
from tablemover.operators.rewrite import rewrite_references
from tablemover.session import new_work_dir
from tablemover.sources.stats import table_stats

from smallest import SF


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def orders(spark):
    return spark.read.parquet(f"{SF}/orders.parquet")


def test_checksum_is_one_partial_aggregate_without_row_shuffle(spark):
    p = plan(table_checksum(orders(spark)))
    assert "HashAggregate" in p and "SortAggregate" not in p
    assert "hashpartitioning" not in p  # only the final single-partition merge of partial results


def test_keyed_diff_hash_aggregates_and_one_exchange_per_side(spark):
    o = orders(spark)
    p = plan(keyed_diff(o, o.withColumn("o_totalprice", F.col("o_totalprice") + 1), ["o_orderkey"]))
    assert "SortAggregate" not in p
    assert len(re.findall(r"Exchange \(\d+\)", p.split("\n\n")[0])) == 2


def test_bucket_signatures_are_hash_aggregates(spark):
    p = plan(mismatched_buckets(orders(spark), orders(spark)))
    assert "SortAggregate" not in p and "HashAggregate" in p


def test_stats_read_no_data_columns(spark):
    p = plan(table_stats({"o": orders(spark)}))
    scan = [l for l in p.splitlines() if l.startswith("ReadSchema")]
    assert scan and all("o_totalprice" not in l for l in scan)


def test_inventory_filters_reach_the_scan(spark):
    inv = spark.createDataFrame([("a", "t", "EXTERNAL", None), ("b", "u", "VIEW", "x")],
                                "database string, name string, object_type string, upgraded_to string")
    path = new_work_dir(spark, "inv") + "/p"
    inv.write.parquet(path)
    p = plan(not_upgraded(spark.read.parquet(path), "assess"))
    pushed = [l for l in p.splitlines() if l.startswith("PushedFilters")][0]
    assert "IsNull(upgraded_to)" in pushed and "EqualTo(object_type,EXTERNAL)" in pushed
    assert "Not(In(database" in pushed or "Not(EqualTo(database" in pushed


def test_rewrite_broadcasts_a_small_mapping_but_not_against_a_hint(spark):
    texts = spark.createDataFrame([(1, "select * from db.a")], "id int, text string")
    p = plan(rewrite_references(texts, "text", {"db.a": "x.y"}, join_hint="merge"))
    assert "SortMergeJoin" in p


def test_narrowed_diff_of_equal_tables_reads_nothing_again(spark):
    from tablemover.operators.reconcile import reconcile_rows
    o = orders(spark)
    only_s, only_t = reconcile_rows(o, o.select(*o.columns), "narrow")
    for df in (only_s, only_t):
        p = plan(df)
        assert "Scan parquet" not in p and "Exchange" not in p
