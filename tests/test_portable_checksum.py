"""The portable checksum taken by Spark equals the one DuckDB computes from the same file."""

import datetime

import duckdb

from tablemover.operators.reconcile import table_checksum
from tablemover.oracle import _canon
from tablemover.session import new_work_dir

COLS = [("i", "long"), ("s", "string"), ("d", "double"), ("f", "float"), ("b", "boolean"), ("ts", "timestamp"),
        ("arr", "array<float>")]


def test_portable_checksum_equals_duckdb_on_edge_values(spark):
    rows = [
        (1, "plain", 1.5, 0.25, True, datetime.datetime(2001, 2, 3, 4, 5, 6, 789012), [0.1, None, -2.5]),
        (2, "", float("nan"), float("inf"), False, datetime.datetime(1970, 1, 1), []),
        (3, None, float("-inf"), None, None, None, None),
        (4, "é \U0001f468‍\U0001f469 é,4:x", -0.0, -1e-7, True, datetime.datetime(1999, 12, 31, 23, 59, 59),
         [3.4e38, -0.0]),
        (None, "N", 123456789012.125, 1.0, False, datetime.datetime(2024, 2, 29, 12, 0, 0, 1), [None]),
        (7, "big", 1.2345678901234567e20, -3.3e-12, True, None, [1e30, -7.5e-39]),
        (8, "huge", -1.7e308, 2.5, False, None, [2.0 ** 53, 2.0 ** 106 + 2.0 ** 60]),
        (10, "range", 5e-324, 1e-45, True, None, [2.0 ** -126, 2.0 ** -53]),
        (11, "range", 2.0 ** -1022, 2.0 ** 53, True, None, [2.0 ** 52 + 1]),
        (12, "range", 2.0 ** -53, 2.0 ** -54, True, None, [2.0 ** -106]),
        (13, "range", 2.0 ** -954, 2.0 ** 106, True, None, [2.0 ** -107]),
        (14, "range", 1.7976931348623157e308, 2.0 ** 105, True, None, [1 - 2.0 ** -24]),
        (15, "range", 2.0 ** 1007, 1.0, True, None, [0.0]),
        (9, "ties", 0.0000000005, 0.0000000015, True, None, [1.0000000005]),
        (6, "plain", 1.5, 0.25, True, datetime.datetime(2001, 2, 3, 4, 5, 6, 789012), [0.1, None, -2.5]),
    ]
    schema = ", ".join(f"{c} {t.replace('timestamp', 'timestamp_ntz')}" for c, t in COLS)
    df = spark.createDataFrame(rows, schema)
    path = new_work_dir(spark, "pcs") + "/t"
    df.write.parquet(path)
    back = spark.read.parquet(path)
    mine = table_checksum(back, portable=True).collect()[0]
    text = "concat_ws(',', " + ", ".join(_canon(f'"{c}"', t) for c, t in COLS) + ")"
    h = f"CAST(CAST(('0x' || substr(md5({text}), 1, 16)) AS UBIGINT) AS HUGEINT)"
    theirs = duckdb.sql(f"SELECT count(*), CAST(sum({h}) AS VARCHAR) "
                        f"FROM read_parquet('{path.replace('file:', '')}/*.parquet')").fetchall()[0]
    assert (mine["row_count"], mine["checksum"]) == theirs


def test_no_two_doubles_share_a_text(spark):
    import math
    import random
    rng = random.Random(1)
    xs = {0.0, 5e-324, 1e-12, 3e-10, 1e32, 1e33, 1 - 2.0 ** -53, 1.0, 2.0 ** 53, 2.0 ** 53 - 1, 2.0 ** -53, 1.7976931348623157e308}
    for e in range(-1074, 1024, 13):
        x = math.ldexp(rng.random() + 0.5, e)
        if 0 < x < math.inf:
            xs |= {x, math.nextafter(x, math.inf), math.nextafter(x, 0.0), math.ldexp(1.0, e), math.nextafter(math.ldexp(1.0, e), 0.0)}
    xs |= {-x for x in xs if x}
    rows = sorted(x for x in xs if math.isfinite(x))
    from tablemover.functions.checksum import canonical_text
    df = spark.createDataFrame([(x,) for x in rows], "d double")
    texts = [(r["d"], r["t"]) for r in df.select("d", canonical_text(df).alias("t")).collect()]
    assert len({t for _, t in texts}) == len(rows)
    from fractions import Fraction
    for d, t in texts:  # and the text is the value
        if t != "0":
            number, _, k = t.removeprefix("-").partition("E")
            hi, lo = map(int, number.split("."))
            assert (Fraction(hi) + Fraction(lo, 2 ** 53)) * Fraction(2) ** (53 * int(k or 0)) == Fraction(abs(d)), (d, t)
            assert t.startswith("-") == (d < 0)
