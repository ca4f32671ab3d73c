import pytest
from pyspark.sql import functions as F

from tablemover.operators import journal
from tablemover.operators.copy import TargetNotEmpty
from tablemover.operators.journal import NotInUnits, copy_in_units, has_journal
from tablemover.plans.convert import convert_one
from tablemover.session import new_work_dir

ROWS = 4000


@pytest.fixture
def table(spark, db):
    """A managed table in two partitions of several files each."""
    df = spark.range(0, ROWS, 1, 4).select("id", F.concat(F.lit("v"), F.col("id")).alias("v"), (F.col("id") % 2).alias("p"))
    df.write.partitionBy("p").saveAsTable(f"{db}.t")
    return f"`{db}`.`t`", f"`{db}`.`t_ext`", new_work_dir(spark, "units") + "/d"


def states(report):
    return {r["state"]: r["n"] for r in report.groupBy("state").agg(F.count(F.lit(1)).alias("n")).collect()}


def same(spark, a, b):
    x, y = (sorted(tuple(r) for r in spark.table(t).select("id", "v", "p").collect()) for t in (a, b))
    return x == y and len(x) > 0


def test_whole_copy_and_nothing_to_do_again(spark, table):
    src, dst, loc = table
    first = states(copy_in_units(spark, src, dst, loc, unit_bytes=8000))
    assert list(first) == ["COPIED"] and first["COPIED"] > 2 and same(spark, src, dst)
    assert spark.catalog.getTable(dst).tableType == "EXTERNAL"
    assert states(copy_in_units(spark, src, dst, loc, unit_bytes=8000)) == {"DONE_BEFORE": first["COPIED"]}
    report = copy_in_units(spark, src, dst, loc, unit_bytes=8000).agg(F.sum("row_count").alias("n")).first()
    assert report["n"] == ROWS


@pytest.mark.parametrize("place", ["between units", "before a move", "after some moves", "before the record"])
def test_stopped_anywhere_each_unit_counts_once(spark, table, monkeypatch, place):
    src, dst, loc = table
    calls = {"n": 0}

    class Lost(RuntimeError):
        pass

    def stop(after):
        calls["n"] += 1
        if calls["n"] > after:
            raise Lost()

    with monkeypatch.context() as m:
        move, write = journal._Store.move, journal._Store.write
        if place == "before a move":
            m.setattr(journal._Store, "move", lambda self, *a: (stop(0), move(self, *a)))
        elif place == "after some moves":
            m.setattr(journal._Store, "move", lambda self, *a: (stop(3), move(self, *a)))
        elif place == "before the record":
            m.setattr(journal._Store, "write", lambda self, name, text: (stop(1) if "/done/" in name else None, write(self, name, text)))
        hook = (lambda unit, state: stop(2)) if place == "between units" else None
        with pytest.raises(Lost):
            # one unit of all files for the move tests, several otherwise
            copy_in_units(spark, src, dst, loc, unit_bytes=1 << 30 if "move" in place else 8000, parallelism=1, on_unit=hook)
    assert not spark.catalog.tableExists(dst)
    done = states(copy_in_units(spark, src, dst, loc, unit_bytes=8000))
    assert same(spark, src, dst)
    if place == "between units":
        assert done["DONE_BEFORE"] == 2 and done["COPIED"] >= 1
    if place == "before the record":
        assert done["DONE_BEFORE"] == 1


def test_only_units_of_changed_files_are_copied_again(spark, table):
    src, dst, loc = table
    units = states(copy_in_units(spark, src, dst, loc, unit_bytes=8000))["COPIED"]
    spark.sql(f"INSERT INTO {src} VALUES (90001, 'new', 7)")
    assert states(copy_in_units(spark, src, dst, loc, unit_bytes=8000)) == {"DONE_BEFORE": units, "COPIED": 1}
    assert same(spark, src, dst)
    spark.sql(f"ALTER TABLE {src} DROP PARTITION (p = 0)")
    back = states(copy_in_units(spark, src, dst, loc, unit_bytes=8000))
    assert back["TAKEN_BACK"] >= 1 and back["DONE_BEFORE"] >= 1 and same(spark, src, dst)


def test_conversion_goes_on_after_a_stop_and_after_a_change(spark, table, db, monkeypatch):
    src, _, loc = table
    row = {"database": db, "name": "t", "target_schema": "s", "target_table": "t", "location": loc, "t_no": 1}
    calls = {"n": 0}
    write = journal._Store.write

    def flaky(self, name, text):
        calls["n"] += "/done/" in name
        if "/done/" in name and calls["n"] > 2:
            raise RuntimeError("lost")
        write(self, name, text)

    with monkeypatch.context() as m:
        m.setattr(journal._Store, "write", flaky)
        assert convert_one(spark, row, verify="checksum", unit_bytes=8000)["outcome"] == "COPY_FAILED"
    assert has_journal(spark, loc, src)

    copy = copy_in_units

    def meanwhile(*a, **kw):
        out = copy(*a, **kw)
        spark.sql(f"INSERT INTO {src} VALUES (90001, 'new', 7)")
        return out

    with monkeypatch.context() as m:
        m.setattr("tablemover.plans.convert.copy_in_units", meanwhile)
        assert convert_one(spark, row, verify="checksum", unit_bytes=8000)["outcome"] == "SOURCE_CHANGED"
    out = convert_one(spark, row, verify="checksum", drop_old=True, unit_bytes=8000)
    assert out["outcome"] == "CONVERTED_DROPPED" and "1 copied" in out["reason"], out
    assert spark.table(f"{db}.t").count() == ROWS + 1 and not has_journal(spark, loc)


def test_what_cannot_be_copied_in_units(spark, table, db):
    src, dst, loc = table
    spark.range(10).write.bucketBy(2, "id").saveAsTable(f"{db}.b")
    spark.sql(f"CREATE VIEW {db}.v AS SELECT 1 AS a")
    for t in ("b", "v"):
        with pytest.raises(NotInUnits):
            copy_in_units(spark, f"`{db}`.`{t}`", dst, loc)
    spark.range(3).write.parquet(loc)
    with pytest.raises(TargetNotEmpty):
        copy_in_units(spark, src, dst, loc)
    other = new_work_dir(spark, "units") + "/o"
    copy_in_units(spark, src, dst, other)
    spark.range(3).write.saveAsTable(f"{db}.u")
    with pytest.raises(TargetNotEmpty, match="holds a copy"):
        copy_in_units(spark, f"`{db}`.`u`", f"`{db}`.`u_ext`", other)
    # A conversion copies a bucketed table whole.
    row = {"database": db, "name": "b", "target_schema": "s", "target_table": "b", "location": new_work_dir(spark, "units") + "/b", "t_no": 1}
    assert convert_one(spark, row, unit_bytes=1000)["outcome"] == "CONVERTED"


def test_empty_table(spark, db):
    spark.sql(f"CREATE TABLE {db}.e (a INT, v VARCHAR(3)) USING parquet")
    copy_in_units(spark, f"`{db}`.`e`", f"`{db}`.`e_ext`", new_work_dir(spark, "units") + "/e")
    assert spark.table(f"{db}.e_ext").count() == 0


def folders(spark, loc, folder):
    store = journal._Store(spark, loc)
    return [n for n in store.names(f"{journal.JOURNAL}/{folder}") if folder != "staging" or store.exists(f"{journal.JOURNAL}/staging/{n}/_copied")]


def test_a_stopped_run_begins_no_further_unit(spark, table, monkeypatch):
    src, dst, loc = table
    monkeypatch.setattr(journal, "_MOST_UNITS", 2, raising=False)

    def stop(unit, state):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        copy_in_units(spark, src, dst, loc, unit_bytes=8000, parallelism=1, on_unit=stop)
    assert len(folders(spark, loc, "staging")) == 2 and folders(spark, loc, "done") == []
    # What a job left that was lost before it marked its units is deleted, what is marked is only moved.
    spark.range(3).write.parquet(f"{loc}/_journal/staging/job-lost/_unit=x")
    monkeypatch.setattr(journal, "_MOST_UNITS", 64, raising=False)
    assert list(states(copy_in_units(spark, src, dst, loc, unit_bytes=8000))) == ["COPIED"]
    assert same(spark, src, dst) and not journal._Store(spark, loc).exists("_journal/staging")


def test_small_units_share_jobs(spark, table, monkeypatch):
    src, dst, loc = table
    checks = []
    sums = journal.table_checksums
    monkeypatch.setattr(journal, "table_checksums", lambda tables, **kw: (checks.append(len(tables)), sums(tables, **kw))[1])
    units = states(copy_in_units(spark, src, dst, loc, unit_bytes=8000, parallelism=1))["COPIED"]
    assert units > 2 and len(checks) < units and sum(checks) == 2 * units and same(spark, src, dst)


def test_jobs_are_filled_and_large_units_have_their_own():
    mb = 1 << 20
    units = [("a", mb), ("b", 0), ("c", 300 * mb), ("d", 16 << 30), ("e", mb), ("f", mb), ("g", mb), ("h", mb), ("i", mb)]
    assert journal._shared(units, 4) == [["a", "b"], ["c"], ["d"], ["e", "f", "g", "h"], ["i"]]
    assert journal._shared([], 4) == []


def test_a_unit_that_cannot_be_read_or_differs_does_not_hold_up_the_others(spark, table, monkeypatch):
    src, dst, loc = table
    files = sorted(r["f"] for r in spark.table(src).select(F.input_file_name().alias("f")).distinct().collect())
    path = files[0].removeprefix("file://")
    with open(path, "rb") as f:
        whole = f.read()
    with open(path, "wb") as f:
        f.write(b"PAR1 nothing PAR1")
    with pytest.raises(Exception):
        copy_in_units(spark, src, dst, loc, unit_bytes=8000)
    units = {r["unit"] for r in spark.read.parquet(f"{loc}/_journal/plan-1").select("unit").distinct().collect()}
    assert len(folders(spark, loc, "done")) == len(units) - 1 > 1
    with open(path, "wb") as f:
        f.write(whole)
    spark.catalog.refreshTable(src)

    sums, n = journal.table_checksums, {"calls": 0}

    def wrong(tables, **kw):
        n["calls"] += 1
        return sums({k: df.limit(1) if k.startswith("t ") and n["calls"] == 1 else df for k, df in tables.items()}, **kw)

    with monkeypatch.context() as m:
        m.setattr(journal, "table_checksums", wrong)
        with pytest.raises(journal.UnitDiffers):
            copy_in_units(spark, src, dst, loc, unit_bytes=8000)
    assert states(copy_in_units(spark, src, dst, loc, unit_bytes=8000))["COPIED"] >= 1 and same(spark, src, dst)


@pytest.mark.parametrize("parts", [["p"], []])
def test_units_of_a_job_keep_odd_partitions_names_and_nulls(spark, db, parts):
    odd = F.element_at(F.array(F.lit("a b é"), F.lit(None).cast("string"), F.lit("c@1"), F.lit("")), (F.col("id") % 4 + 1).cast("int"))
    w = spark.range(0, 400, 1, 4).select("id", F.lit(1).alias("_unit"), F.lit(None).cast("int").alias("n"), odd.alias("p")).write
    (w.partitionBy(*parts) if parts else w).saveAsTable(f"{db}.odd")
    spark.table(f"{db}.odd").where("false").write.mode("append").insertInto(f"{db}.odd")
    src, dst = f"`{db}`.`odd`", f"`{db}`.`odd_ext`"
    report = copy_in_units(spark, src, dst, new_work_dir(spark, "units") + "/d", unit_bytes=10)
    assert report.count() > 2 and report.agg(F.sum("row_count")).first()[0] == 400
    a, b = spark.table(src), spark.table(dst)
    assert a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and b.count() == 400
