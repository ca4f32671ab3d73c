"""Copies in units with a journal, so that a copy that was stopped goes on where it stopped.

The source's files are dealt into units of about ``unit_bytes``: a folder's files stay together, large folders
are split, small ones share a unit. Each unit is copied into a staging folder beside the target's data, checked
against the source files it was made from, and then committed: its files move to their place under names that
carry the unit, and a record of the unit is written. A unit that gives every core work is copied by a job of its
own; smaller ones share a job, so that neither cores nor the number of jobs depend on how small the units are. All
of this lies in hidden folders of the target location, which Spark's readers pass over:

    _journal/plan-<version>   unit, path, size and time of every source file (Parquet)
    _journal/done/<unit>@<version>  the files that a committed unit consists of
    _journal/staging/<unit>@<version>  a unit that is being copied
    _journal/staging/job-<id>  the files of units that are being copied by one job, a folder for each

A unit whose staging folder is marked complete only moves the rest of its files, one that isn't is copied again, and
a committed one is never touched: whenever the driver or an executor is lost, each unit counts once. If the
source changed between two runs, the difference of the two listings says which units hold files that are new,
gone or rewritten; only those are taken back and copied (and checked) again.
"""

from __future__ import annotations

import json
import logging
import math
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.catalog import _q as quoted, columns_ddl, describe_table, partition_columns
from ..sources.listing import list_files, table_locations
from .copy import TargetNotEmpty, _hadoop_path, path_has_files, sql_text
from .reconcile import table_checksums

log = logging.getLogger(__name__)

JOURNAL = "_journal"
STAGING = f"{JOURNAL}/staging"
#: Bytes that one task reads, and the most units that share a job.
_TASK_BYTES, _MOST_UNITS = 128 << 20, 64
UNITS = "unit string, state string, files long, bytes long, row_count long"


class NotInUnits(ValueError):
    """The table can't be copied in units; ``copy_table`` copies it whole."""


class UnitDiffers(RuntimeError):
    pass


class _Store:
    """The few file operations of a journal, through Hadoop's file systems."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.fs, _ = _hadoop_path(spark, self.root)

    def path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def names(self, folder: str) -> list[str]:
        p = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def files(self, folder: str) -> list[str]:
        """Data files under a folder, by their path from it."""
        out, todo = [], [""]
        while todo:
            at = todo.pop()
            for s in self.fs.listStatus(self.path(folder + at)):
                name = f"{at}/{s.getPath().getName()}"
                if s.isDirectory():
                    todo.append(name)
                elif not s.getPath().getName().startswith(("_", ".")):
                    out.append(name.lstrip("/"))
        return sorted(out)

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """All or nothing: written aside, then renamed."""
        aside = self.path(f"{name}.tmp")
        out = self.fs.create(aside, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if not self.fs.rename(aside, self.path(name)):
            raise OSError(f"cannot write {self.root}/{name}")

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def move(self, name: str, to: str) -> None:
        target = self.path(to)
        self.fs.mkdirs(target.getParent())
        if self.fs.exists(target):  # left by a rename that broke off on a store without atomic ones
            self.fs.delete(target, False)
        if not self.fs.rename(self.path(name), target):
            raise OSError(f"cannot move {self.root}/{name} to {to}")


def _deal(files: DataFrame, unit_bytes: int, version: int) -> DataFrame:
    """(unit, version, path, size, modified): folders of more than ``unit_bytes`` are split, others share units."""
    folder = F.regexp_extract("path", "^(.*)/", 1)
    sized = files.withColumn("folder", F.xxhash64(folder))
    total = sized.agg(F.sum("size").alias("b")).first()["b"] or 0
    # At most total / unit_bytes folders are larger than a unit.
    large = (sized.groupBy("folder").agg(F.sum("size").alias("b")).where(F.col("b") > unit_bytes)
             .select("folder", F.ceil(F.col("b") / unit_bytes).alias("parts")))
    shared = math.ceil(total / unit_bytes) or 1
    own = F.concat(F.lit("d"), F.hex("folder"), F.lit("-"), F.pmod(F.xxhash64("path"), F.col("parts")).cast("string"))
    common = F.concat(F.lit("s"), F.pmod(F.col("folder"), F.lit(shared)).cast("string"))
    unit = F.concat(F.lit(f"v{version}"), F.when(F.col("parts").isNotNull(), own).otherwise(common))
    return sized.join(F.broadcast(large), "folder", "left").select(
        unit.alias("unit"), F.lit(version).alias("version"), "path", "size", "modified")


def _next_plan(old: DataFrame, now: DataFrame, unit_bytes: int, version: int) -> DataFrame:
    """The plan after a change of the source: units whose files are all as they were keep their version, those with
    a file that is gone or rewritten get the new one and what is left of their files, new files get new units."""
    same = ["path", "size", "modified"]
    gone = old.join(now, same, "left_anti").select("unit").distinct()
    kept = old.join(gone.withColumn("_gone", F.lit(True)), "unit", "left").select(
        "unit", F.when(F.col("_gone"), F.lit(version)).otherwise(F.col("version")).alias("version"), "path")
    kept = kept.join(now, "path").select("unit", "version", *same)
    new = now.join(old.select("path"), "path", "left_anti")
    return kept.unionByName(_deal(new, unit_bytes, version))


def source_changes(old: DataFrame, now: DataFrame) -> DataFrame:
    """(path, change) between two listings: ``added``, ``removed`` or ``rewritten`` files."""
    a, b = (d.select("path", F.struct("size", "modified").alias(c)) for d, c in ((old, "a"), (now, "b")))
    change = (F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed")
              .when(F.col("a") != F.col("b"), "rewritten"))
    return a.join(b, "path", "full_outer").select("path", change.alias("change")).where("change is not null")


def has_journal(spark: SparkSession, location: str, source: str | None = None) -> bool:
    """Whether ``location`` holds a copy in units (of ``source``)."""
    store = _Store(spark, location)
    if not store.exists(f"{JOURNAL}/source"):
        return False
    return source is None or store.read(f"{JOURNAL}/source") == source


def drop_journal(spark: SparkSession, location: str) -> None:
    """Ends a copy in units: its records go, the data stays."""
    _Store(spark, location).delete(JOURNAL)


def copy_in_units(spark: SparkSession, source: str, target: str, location: str, unit_bytes: int = 16 << 30,
                  parallelism: int = 4, verify: bool = True, properties: dict | None = None,
                  on_unit: Callable[[str, str], None] | None = None) -> DataFrame:
    """Copy ``source`` to an external table ``target`` at ``location`` unit by unit; one row per unit
    (``unit, state, files, bytes, row_count``), with state ``COPIED``, ``DONE_BEFORE`` or ``TAKEN_BACK``.

    Run again after a failure, it copies what is missing; run again after the source changed, it takes back and
    copies the units whose files changed. The table is created when all units are there, with the source's
    columns, partitions, options, comment and properties. With ``verify`` the rows and checksum of every unit
    are compared with those of its source files before it is committed (``UnitDiffers`` otherwise).
    ``on_unit(unit, state)`` is told of every unit before it is committed; what it raises ends the run, and no
    further unit is copied or committed. (After any other failure of a unit the others go on.) ``parallelism``
    jobs run side by side, each copying one unit, or several if these alone would leave cores without work.
    ``NotInUnits`` for tables that aren't plain files of one location (views, bucketed tables,
    partitions stored elsewhere); ``TargetNotEmpty`` if the location holds anything else.
    """
    info = describe_table(spark, source)
    places = table_locations(spark, source)
    if not places or len(places) > 1 or info.get("num_buckets") or info.get("provider") in (None, "hive"):
        raise NotInUnits(f"{source} can't be copied in units")
    store = _Store(spark, location)
    if not store.exists(f"{JOURNAL}/source"):
        if path_has_files(spark, location):
            raise TargetNotEmpty(f"target location is not empty: {location}")
        store.fs.mkdirs(store.path(f"{JOURNAL}/done"))
        store.write(f"{JOURNAL}/source", source)
    elif store.read(f"{JOURNAL}/source") != source:
        raise TargetNotEmpty(f"target location holds a copy of {store.read(f'{JOURNAL}/source')}: {location}")

    plan = _current_plan(spark, store, list_files(spark, [("t", places[0])]).select("path", "size", "modified"), unit_bytes)
    units = plan.groupBy("unit", "version").agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes")).orderBy("unit").collect()
    wanted = {f"{u['unit']}@{u['version']}": u for u in units}
    done = set(n for n in store.names(f"{JOURNAL}/done") if not n.endswith(".tmp"))
    out = [_take_back(store, name) for name in sorted(done - set(wanted))]
    _drop_leftovers(store)
    parallelism = max(1, parallelism)
    copier = _Copier(spark, store, source, info, places[0], plan, verify, on_unit)
    tasks = math.ceil(2 * spark.sparkContext.defaultParallelism / parallelism)
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        jobs = {name: job for names in _shared([(n, u["bytes"]) for n, u in wanted.items() if n not in done], tasks)
                for job in [pool.submit(copier.copy, names)] for name in names}
        failed = None
        for name, u in wanted.items():
            try:
                if name in done:
                    rows = json.loads(store.read(f"{JOURNAL}/done/{name}"))["rows"]
                elif name not in (ended := jobs[name].result()):
                    continue  # the run was ended before
                elif isinstance(rows := ended[name], Exception):
                    raise rows
                out.append((u["unit"], "DONE_BEFORE" if name in done else "COPIED", u["files"], u["bytes"], rows))
            except Exception as e:  # noqa: BLE001 - the other units go on; the first failure is raised at the end
                log.warning("unit %s of %s: %s", name, source, e)
                failed = failed or e
    if failed:
        raise failed
    store.delete(STAGING)
    _create(spark, source, target, location, info, properties)
    return spark.createDataFrame(out, UNITS)


def _current_plan(spark: SparkSession, store: _Store, now: DataFrame, unit_bytes: int) -> DataFrame:
    """The last complete plan if the source is as it says, else a new one, written."""
    versions = sorted(int(n[5:]) for n in store.names(JOURNAL) if n.startswith("plan-") and store.exists(f"{JOURNAL}/{n}/_SUCCESS"))
    read = lambda v: spark.read.schema("unit string, version int, path string, size long, modified long").parquet(
        f"{store.root}/{JOURNAL}/plan-{v}")
    if versions:
        old = read(versions[-1])
        if source_changes(old, now).isEmpty():
            return old
    version = versions[-1] + 1 if versions else 1
    plan = _next_plan(old, now, unit_bytes, version) if versions else _deal(now, unit_bytes, version)
    plan.write.mode("overwrite").parquet(f"{store.root}/{JOURNAL}/plan-{version}")
    return read(version)


def _take_back(store: _Store, name: str) -> tuple:
    """The files of a committed unit that the plan has no more, then its record."""
    record = json.loads(store.read(f"{JOURNAL}/done/{name}"))
    for f in record["files"]:
        store.delete(f)
    store.delete(f"{JOURNAL}/done/{name}")
    return name.rsplit("@", 1)[0], "TAKEN_BACK", len(record["files"]), None, record["rows"]


def _shared(units: list[tuple[str, int]], tasks: int) -> list[list[str]]:
    """The (name, bytes) units dealt into jobs, in order: a job gets units until it has ``tasks`` tasks."""
    jobs, room = [], 0
    for name, size in units:
        need = max(1, math.ceil(size / _TASK_BYTES))
        if not jobs or need > room or len(jobs[-1]) == _MOST_UNITS:
            jobs.append([])
            room = tasks
        jobs[-1].append(name)
        room -= need
    return jobs


def _drop_leftovers(store: _Store) -> None:
    """Deletes what jobs of a stopped run wrote for units that aren't complete."""
    staged = store.names(STAGING)
    used = set()
    for n in staged:
        if not n.startswith("job-") and store.exists(f"{STAGING}/{n}/_copied"):
            used.add(json.loads(store.read(f"{STAGING}/{n}/_copied")).get("data", "").split("/")[-2:][0])
    for n in staged:
        if n.startswith("job-") and n not in used:
            store.delete(f"{STAGING}/{n}")


class _Copier:
    def __init__(self, spark, store, source, info, base, plan, verify, on_unit):
        self.spark, self.store, self.info, self.base, self.plan, self.verify, self.on_unit = spark, store, info, base, plan, verify, on_unit
        self.schema, self.parts = spark.table(source).schema, partition_columns(spark, source)
        self.ended = False

    def _read(self, paths: list[str], base: str) -> DataFrame:
        return (self.spark.read.format(self.info["provider"]).options(**self.info.get("options", {})).schema(self.schema)
                .option("basePath", base).load(paths))

    def copy(self, names: list[str]) -> dict[str, int | None | Exception]:
        """Copies (unless their staging folders are complete), checks and commits units; the rows or the failure of
        each one that the run came to before it was ended."""
        out: dict[str, int | None | Exception] = {}
        todo = [] if self.ended else [n for n in names if not self.store.exists(f"{STAGING}/{n}/_copied")]
        try:
            if todo:
                out = self._stage(todo)
        except Exception as e:  # noqa: BLE001 - one unit's failure is not the others'
            out = {todo[0]: e}
            if len(todo) > 1:
                log.warning("units %s are copied one by one: %s", ", ".join(todo), e)
                out = {}
                for n in todo:
                    try:
                        out |= {} if self.ended else self._stage([n])
                    except Exception as own:  # noqa: BLE001
                        out[n] = own
        for n in names:
            if n not in out and not self.ended:
                try:
                    out[n] = self._commit(n)
                except Exception as e:  # noqa: BLE001
                    out[n] = e
        return out

    def _stage(self, names: list[str]) -> dict[str, Exception]:
        """Copies units by one job and marks those complete whose copies are right; the others' failures."""
        paths = {n: [] for n in names}
        key = F.concat_ws("@", "unit", "version")
        for r in self.plan.where(key.isin(names)).select(key.alias("name"), "path").collect():
            paths[r["name"]].append(r["path"])
        src = {n: self._read(p, self.base) for n, p in paths.items()}
        for n in names:
            self.store.delete(f"{STAGING}/{n}")
        label = "_unit"
        while label in {f.name.lower() for f in self.schema}:
            label = f"_{label}"
        job = f"{STAGING}/job-{uuid.uuid4().hex}"
        if len(names) == 1:
            data, rows, by, to = {names[0]: f"{STAGING}/{names[0]}/data"}, src[names[0]], self.parts, f"{STAGING}/{names[0]}/data"
        else:
            data = {n: f"{job}/{label}={n}" for n in names}
            rows = reduce(DataFrame.unionByName, [df.withColumn(label, F.lit(n)) for n, df in src.items()])
            by, to = [label, *self.parts], job
        w = rows.write.format(self.info["provider"]).options(**self.info.get("options", {}))
        (w.partitionBy(*by) if by else w).save(f"{self.store.root}/{to}")
        for folder in data.values():
            self.store.fs.mkdirs(self.store.path(folder))  # units without rows
        counts, failed = dict.fromkeys(names), {}
        if self.verify:
            copied = {n: f"{self.store.root}/{folder}" for n, folder in data.items()}
            tables = {f"s {n}": df for n, df in src.items()} | {f"t {n}": self._read([at], at) for n, at in copied.items()}
            sums = {r["table_name"]: (r["row_count"], r["checksum"]) for r in table_checksums(tables).collect()}
            for n in names:
                counts[n] = sums[f"s {n}"][0]
                if sums[f"s {n}"] != sums[f"t {n}"]:
                    failed[n] = UnitDiffers(f"unit {n}: the copy differs from its source files")
        for n in names:
            if n not in failed:
                self.store.write(f"{STAGING}/{n}/_copied", json.dumps({"rows": counts[n], "files": self.store.files(data[n]), "data": data[n]}))
        return failed

    def _commit(self, name: str) -> int | None:
        unit, version = name.rsplit("@", 1)
        if self.on_unit:
            try:
                self.on_unit(unit, "COPIED")
            except Exception:
                self.ended = True
                raise
        record = json.loads(self.store.read(f"{STAGING}/{name}/_copied"))
        data = record.get("data", f"{STAGING}/{name}/data")
        placed = []
        for f in record["files"]:
            folder, _, leaf = f.rpartition("/")
            to = f"{folder}/{unit}-{version}-{leaf}".lstrip("/")
            if self.store.exists(f"{data}/{f}"):  # else it was moved before
                self.store.move(f"{data}/{f}", to)
            placed.append(to)
        self.store.write(f"{JOURNAL}/done/{name}", json.dumps({"rows": record["rows"], "files": placed}))
        self.store.delete(f"{STAGING}/{name}")
        self.store.delete(data)
        return record["rows"]


def _create(spark: SparkSession, source: str, target: str, location: str, info: dict, properties: dict | None) -> None:
    parts = partition_columns(spark, source)
    if not spark.catalog.tableExists(target):
        options = ", ".join(f"{sql_text(k)} {sql_text(v)}" for k, v in info.get("options", {}).items() if k.lower() != "path")
        props = {**info.get("properties", {}), **(properties or {})}
        spark.sql(f"CREATE TABLE {target} ({columns_ddl(spark, source)}) USING {info['provider']}" + (f" OPTIONS ({options})" if options else "")
                  + (f" PARTITIONED BY ({', '.join(quoted(c) for c in parts)})" if parts else "") + f" LOCATION {sql_text(location)}"
                  + (f" COMMENT {sql_text(info['comment'])}" if info.get("comment") else "")
                  + (f" TBLPROPERTIES ({', '.join(f'{sql_text(k)} = {sql_text(v)}' for k, v in props.items())})" if props else ""))
    if parts:
        spark.sql(f"ALTER TABLE {target} RECOVER PARTITIONS")
    spark.catalog.refreshTable(target)
