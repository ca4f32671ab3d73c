import __spark_entry__ as E


def test_entry_runs_and_matches(spark):
    rows = E.entry(spark).collect()
    assert len(rows) == 1 and rows[0]["match"] is True and rows[0]["source_rows"] > 0


def test_every_query_has_an_oracle():
    from tablemover.queries import QUERIES
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and set(QUERIES) <= set(o)


def test_queries_run_at_smallest_scale(spark):
    from smallest import SF
    for name in ("plan_status", "rewrite_references", "keyed_diff", "estimate_tables", "table_stats"):
        assert E.queries()[name](spark, SF).count() > 0, name
