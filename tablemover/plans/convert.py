"""Managed -> external conversion (B9) and registration of external tables.

Per table the driver issues catalog commands; the data work is Spark jobs (the copies and the
verification scans). A bounded thread pool copies tables side by side (Spark schedules jobs
from different threads concurrently), largest first when sizes are known; finished copies are verified
together in a few batched jobs. Each table ends in exactly one
outcome row, whatever failed; nothing is dropped unless this run verified the copy.

Conversion of ``db.t`` to ``location``:
  1. skip unless ``db.t`` is MANAGED; skip when ``db.t_ext`` or ``db.t_old`` already exists
     (unless an earlier run can be resumed); ``TARGET_NOT_EMPTY`` when the location holds files;
  2. fingerprint the source's files, copy ``db.t`` -> external ``db.t_ext`` at the location
     (format, partitioning, bucketing and properties kept);
  3. verify: row counts (default), or counts + order-free checksums, or the exact row difference;
     ``SOURCE_CHANGED`` when the source's files changed meanwhile;
  4. rename ``db.t`` -> ``db.t_old``, then ``db.t_ext`` -> ``db.t`` (undo the first on failure);
  5. drop ``db.t_old`` only if asked and verified.
"""

from __future__ import annotations

import logging
import time
from concurrent.futures import ThreadPoolExecutor, as_completed
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..functions.timefmt import mm_ss
from ..operators.estimate import BYTES_PER_MB
from ..operators import copy as copy_ops
from ..operators.journal import NotInUnits, copy_in_units, drop_journal, has_journal
from ..operators.reconcile import SIDE, TIMES, _changes, reconcile_partitions, row_differences, table_checksums
from ..sources.catalog import (UPGRADED_TO, _in_session_catalog, columns_ddl, copy_partitions, describe_table, object_type,
                               partition_columns)
from ..sources.listing import table_locations
from ..sources.stats import table_stats


log = logging.getLogger(__name__)


def _q(*parts: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def _may_drop(drop_old: bool, verify: str) -> None:
    if verify not in ("count", "checksum", "rows"):
        raise ValueError(f"unknown verification {verify!r}")
    if drop_old and verify == "count":
        raise ValueError("equal row counts don't prove a copy: drop_old needs verify='checksum' or 'rows'")


def verify_copy(spark: SparkSession, source: str, target: str, verify: str = "count") -> dict:
    """Compare two tables; returns ``source_rows, target_rows, bytes, ok, reason``."""
    stats = {r["table_name"]: r for r in table_stats(
        {"s": spark.table(source), "t": spark.table(target)}, locations=_locations(spark, {"s": source, "t": target})).collect()}
    s, t = stats["s"], stats["t"]
    res = {"source_rows": s["row_count"], "target_rows": t["row_count"], "bytes": s["bytes"],
           "ok": s["row_count"] == t["row_count"], "reason": None, "source_fingerprint": s["fingerprint"]}
    if not res["ok"]:
        res["reason"] = f"row counts differ: {s['row_count']} vs {t['row_count']}"
        return res
    src = spark.table(source)
    if changes := _changes(src.schema, spark.table(target).schema):
        res.update(ok=False, reason="schemas differ: " + ", ".join(f"{c} ({a} -> {b})" for c, a, b, _ in changes))
        return res
    dst = spark.table(target).select(*[F.col(f"`{c}`") for c in src.columns])
    if verify == "checksum":
        cs = {r["table_name"]: r["checksum"] for r in table_checksums({"s": src, "t": dst}).collect()}
        if cs["s"] != cs["t"]:
            reason = "checksums differ"
            parts = partition_columns(spark, source)
            if parts:
                # Name the partitions to copy again: their count, and a few of them for the message.
                # One row per partition value, metadata like the partition listing itself.
                diff = [dict(zip(parts, r)) for r in reconcile_partitions(src, dst, parts).select(*parts).orderBy(*parts).collect()]
                reason += f" in {len(diff)} partition(s): " + ", ".join("/".join(f"{c}={r[c]}" for c in parts) for r in diff)
            res.update(ok=False, reason=reason)
    elif verify == "rows":
        n = {r[SIDE]: r["n"] for r in row_differences(src, dst).groupBy(SIDE).agg(F.sum(TIMES).alias("n")).collect()}
        n_s, n_t = n.get("source", 0), n.get("target", 0)
        if n_s or n_t:
            res.update(ok=False, reason=f"{n_s} rows only in source, {n_t} rows only in target")
    return res


def _locations(spark: SparkSession, names: dict[str, str]) -> dict[str, list[str]]:
    """Of the tables whose files tasks can list, where they are, by label."""
    found = {label: table_locations(spark, n) for label, n in names.items()}
    return {label: paths for label, paths in found.items() if paths}


def _outcome(row: dict, outcome: str, reason: str | None = None, **kw) -> dict:
    level = logging.INFO if outcome in ("CONVERTED", "CONVERTED_DROPPED", "REGISTERED", "DRY_RUN", "PLANNED") \
        or outcome.startswith("SKIPPED_") else logging.WARNING
    log.log(level, "%s.%s: %s%s", row.get("database"), row.get("name"), outcome, f" ({reason})" if reason else "")
    base = {f: None for f in schemas.CONVERSION.fieldNames()}
    base.update({k: row.get(k) for k in ("database", "name", "target_schema", "target_table", "location", "t_no")})
    base.update(outcome=outcome, reason=reason, **kw)
    return base


def _skip(row: dict, db: str, t: str, kind: str | None, has_ext: bool, old_kind: str | None) -> dict:
    if kind is None:
        extra = f" (only {t}_old exists)" if old_kind else ""
        return _outcome(row, "SOURCE_MISSING", f"{db}.{t} not found{extra}")
    if kind != "MANAGED":
        return _outcome(row, f"SKIPPED_{kind}", f"{db}.{t} is {kind.lower()}, not managed")
    if has_ext:
        return _outcome(row, "SKIPPED_EXT_EXISTS", f"{db}.{t}_ext already exists")
    return _outcome(row, "SKIPPED_OLD_EXISTS", f"{db}.{t}_old already exists")


@dataclass
class _Staged:
    """A table whose copy exists (made now or found from an earlier run), waiting for verify."""
    row: dict
    stage: str            # copied | renamed_old | swapped
    note: str | None
    managed_side: str     # the managed data, under its current name
    copy_side: str        # the external copy, under its current name
    copy_seconds: float
    before: str | None = None   # source file fingerprint taken before a fresh copy
    journal: bool = False       # copied in units


def _check(spark: SparkSession, row: dict, resume: bool,
           types: dict[tuple[str, str], str] | None = None) -> dict | tuple[str, str | None]:
    """State of one table: an outcome row when it stops here, else ``(stage, note)`` where stage
    is ``fresh`` (copy it now) or the point an earlier run reached. ``types`` -- object types by
    lower-cased ``(database, name)`` from one listing per database -- saves three catalog lookups
    per table; without it the catalog is asked."""
    db, t = row["database"], row["name"]
    src, ext, old = _q(db, t), _q(db, t + "_ext"), _q(db, t + "_old")
    try:
        if types is not None:
            key = (db or "").lower()
            kind, old_kind, ext_kind = (types.get((key, n.lower())) for n in (t, t + "_old", t + "_ext"))
        else:
            kind, old_kind, ext_kind = object_type(spark, src), object_type(spark, old), object_type(spark, ext)
    except Exception as e:  # noqa: BLE001 - one outcome per table
        return _outcome(row, "CHECK_FAILED", str(e))
    if kind == "MANAGED" and old_kind is None and ext_kind is None:
        if not row.get("location"):
            return _outcome(row, "NO_LOCATION", "no target location (is the target schema missing?)")
        return "fresh", None
    # Only an external ``t_ext`` can be a copy made by this tool; anything else is left alone.
    if resume and kind == "MANAGED" and old_kind is None and ext_kind == "EXTERNAL":
        return "copied", f"resumed: {t}_ext from an earlier run"
    if resume and kind is None and old_kind == "MANAGED" and ext_kind == "EXTERNAL":
        return "renamed_old", "resumed: finished an interrupted swap"
    if resume and kind == "EXTERNAL" and old_kind == "MANAGED" and ext_kind is None:
        return "swapped", "resumed: swap was already done"
    return _skip(row, db, t, kind, ext_kind is not None, old_kind)


def _copy(spark: SparkSession, row: dict, fmt: str | None, before: str | None, unit_bytes: int | None = None) -> dict | _Staged:
    db, t, loc = row["database"], row["name"], row["location"]
    src, ext = _q(db, t), _q(db, t + "_ext")
    start, note = time.monotonic(), None
    try:
        begun = has_journal(spark, loc, src)
        if not begun and copy_ops.path_has_files(spark, loc):
            return _outcome(row, "TARGET_NOT_EMPTY", f"location not empty: {loc}")
        log.info("copy started: %s.%s -> %s", db, t, loc)
        units = unit_bytes is not None and fmt is None
        if units or begun:
            try:
                n = {r["state"]: r["n"] for r in copy_in_units(spark, src, ext, loc, unit_bytes or 16 << 30)
                     .groupBy("state").agg(F.count(F.lit(1)).alias("n")).collect()}
                if begun:
                    note = (f"resumed: {n.get('DONE_BEFORE', 0)} units were done, {n.get('TAKEN_BACK', 0)} taken back, "
                            f"{n.get('COPIED', 0)} copied")
            except NotInUnits:
                units = False
        if not units and not begun:
            copy_ops.copy_table(spark, src, ext, loc, fmt=fmt)
    except Exception as e:  # noqa: BLE001
        return _outcome(row, "COPY_FAILED", str(e))
    log.info("copy done: %s.%s in %.1f s", db, t, time.monotonic() - start)
    return _Staged(row, "copied", note, src, ext, time.monotonic() - start, before, units or begun)


def _stage_of(spark: SparkSession, row: dict, state: tuple, fmt: str | None, unit_bytes: int | None) -> dict | _Staged:
    """What a checked table's state asks for: a copy, the rest of one in units (also when the source changed
    after it), or what an earlier run left."""
    src = _q(row["database"], row["name"])
    if state[0] == "fresh" or state[0] == "copied" and row.get("location") and has_journal(spark, row["location"], src):
        return _copy(spark, row, fmt, _fingerprints(spark, [src]).get(src), unit_bytes)
    return _resumed(row, *state)


def _resumed(row: dict, stage: str, note: str | None) -> _Staged:
    db, t = row["database"], row["name"]
    src, ext, old = _q(db, t), _q(db, t + "_ext"), _q(db, t + "_old")
    return _Staged(row, stage, note, src if stage == "copied" else old, src if stage == "swapped" else ext, 0.0)


def _fingerprints(spark: SparkSession, names: list[str]) -> dict[str, str | None]:
    """Source file fingerprints of many tables in one batched metadata job; None for a table that can't
    be read (its copy will say why)."""
    frames = {}
    for n in names:
        try:
            frames[n] = spark.table(n)
        except Exception as e:  # noqa: BLE001 - one bad table doesn't stop the others
            log.warning("no fingerprint of %s: %s", n, e)
    if not frames:
        return {}
    return {r["table_name"]: r["fingerprint"] for r in table_stats(
        frames, errors="isolate", rows=False, locations=_locations(spark, {n: n for n in frames})).collect()}


def _stage(spark: SparkSession, row: dict, fmt: str | None, resume: bool, unit_bytes: int | None = None) -> dict | _Staged:
    """Checks and copy of one table: an outcome row when it stops here, else the staged copy."""
    state = _check(spark, row, resume)
    return state if isinstance(state, dict) else _stage_of(spark, row, state, fmt, unit_bytes)


def _finish(spark: SparkSession, st: _Staged, v: dict | Exception, drop_old: bool) -> dict:
    """Verdict -> swap (undone if its second rename fails) -> optional drop of ``t_old``."""
    row, stage = st.row, st.stage
    db, t = row["database"], row["name"]
    src, ext, old = _q(db, t), _q(db, t + "_ext"), _q(db, t + "_old")
    if isinstance(v, Exception):
        return _outcome(row, "VERIFY_FAILED", str(v))
    start = time.monotonic()
    counts = dict(source_rows=v["source_rows"], target_rows=v["target_rows"],
                  size_mb=(v["bytes"] or 0) / BYTES_PER_MB)
    after = v.get("source_fingerprint")
    if st.before is not None and after is not None and after != st.before:
        # Files of the source were added, removed or rewritten while it was being copied: the copy
        # may be a mix of old and new data, whatever the counts say.
        return _outcome(row, "SOURCE_CHANGED", f"source files changed during the copy; copy left at {db}.{t}_ext",
                        **counts)
    if not v["ok"]:
        left = f"; copy left at {db}.{t}_ext" if stage != "swapped" else ""
        return _outcome(row, "VERIFY_FAILED", v["reason"] + left, **counts)
    if stage == "copied":
        try:
            spark.sql(f"ALTER TABLE {src} RENAME TO {old}")
        except Exception as e:  # noqa: BLE001
            return _outcome(row, "RENAME_FAILED", f"rename {db}.{t} -> {t}_old: {e}", **counts)
        stage = "renamed_old"
    if stage == "renamed_old":
        try:
            spark.sql(f"ALTER TABLE {ext} RENAME TO {src}")
        except Exception as e:  # noqa: BLE001
            undo = "undone"
            try:
                spark.sql(f"ALTER TABLE {old} RENAME TO {src}")
            except Exception as e2:  # noqa: BLE001
                undo = f"undo failed: {e2}"
            return _outcome(row, "RENAME_FAILED", f"rename {t}_ext -> {t}: {e}; first rename {undo}", **counts)
    outcome = "CONVERTED"
    if st.journal:
        drop_journal(spark, row["location"])
    if drop_old:
        try:
            spark.sql(f"DROP TABLE {old}")
            outcome = "CONVERTED_DROPPED"
        except Exception as e:  # noqa: BLE001
            return _outcome(row, "CONVERTED", f"drop of {t}_old failed: {e}", **counts)
    secs = st.copy_seconds + (time.monotonic() - start)
    return _outcome(row, outcome, st.note, seconds=secs,
                    mb_per_s=(counts["size_mb"] / secs if secs > 0 else 0.0), **counts)


def convert_one(spark: SparkSession, row: dict, drop_old: bool = False, verify: str = "count",
                fmt: str | None = None, resume: bool = True, unit_bytes: int | None = None) -> dict:
    """Convert one table; returns its outcome row. ``unit_bytes`` copies in units (``journal.copy_in_units``).

    With ``resume`` a run picks up where a lost driver left off: a committed ``t_ext`` is verified
    and swapped in, a swap interrupted between its two renames is finished, and a finished swap is
    verified again before ``t_old`` may be dropped. Without it those states are skipped.
    """
    _may_drop(drop_old, verify)
    st = _stage(spark, row, fmt, resume, unit_bytes)
    if isinstance(st, dict):
        return st
    try:
        v = verify_copy(spark, st.managed_side, st.copy_side, verify)
    except Exception as e:  # noqa: BLE001
        v = e
    return _finish(spark, st, v, drop_old)


def verify_many(spark: SparkSession, pairs: list[tuple[str, str]], verify: str = "count",
                chunk: int = 16) -> list[dict | Exception]:
    """``verify_copy`` for many (source, copy) pairs in few jobs.

    Counts and sizes of all tables come from file metadata in chunked union jobs (an unreadable
    table yields an error for its pair only); checksums of the pairs whose counts agree run as
    chunked unions too. Only failing pairs, and ``verify="rows"``, go one by one.
    """
    res: list[dict | Exception | None] = [None] * len(pairs)
    frames: dict[str, DataFrame] = {}
    for i, (m, c) in enumerate(pairs):
        try:
            frames[f"s{i}"], frames[f"t{i}"] = spark.table(m), spark.table(c)
        except Exception as e:  # noqa: BLE001
            res[i] = e
    stats = {r["table_name"]: r for r in table_stats(
        frames, chunk=2 * chunk, errors="isolate", locations=_locations(spark, {k: pairs[int(k[1:])]["st".index(k[0])] for k in frames})
    ).collect()} if frames else {}
    for i in range(len(pairs)):
        if res[i] is not None:
            continue
        s, t = stats[f"s{i}"], stats[f"t{i}"]
        if s["error"] or t["error"]:
            res[i] = RuntimeError(s["error"] or t["error"])
            continue
        ok = s["row_count"] == t["row_count"]
        res[i] = {"source_rows": s["row_count"], "target_rows": t["row_count"], "bytes": s["bytes"], "ok": ok,
                  "reason": None if ok else f"row counts differ: {s['row_count']} vs {t['row_count']}",
                  "source_fingerprint": s["fingerprint"]}
    todo = [i for i, r in enumerate(res) if isinstance(r, dict) and r["ok"]]
    if verify == "checksum" and todo:
        sums: dict[str, str] = {}
        try:
            cs = {}
            for i in todo:
                src = frames[f"s{i}"]
                cs[f"s{i}"], cs[f"t{i}"] = src, frames[f"t{i}"].select(*[F.col(f"`{c}`") for c in src.columns])
            sums = {r["table_name"]: r["checksum"] for r in table_checksums(cs, chunk=2 * chunk).collect()}
        except Exception:  # noqa: BLE001 - a broken pair fails alone below
            sums = {}
        for i in todo:
            if not sums or sums.get(f"s{i}") != sums.get(f"t{i}"):
                try:
                    res[i] = verify_copy(spark, pairs[i][0], pairs[i][1], "checksum")
                except Exception as e:  # noqa: BLE001
                    res[i] = e
    elif verify == "rows":
        for i in todo:
            try:
                res[i] = verify_copy(spark, pairs[i][0], pairs[i][1], "rows")
            except Exception as e:  # noqa: BLE001
                res[i] = e
    return res  # type: ignore[return-value]


def _auto_sizes(spark: SparkSession, targets: DataFrame) -> DataFrame:
    """``database, name, bytes`` of the existing source tables: one batched metadata job."""
    names = {}
    for r in targets.select("database", "name").distinct().collect():  # metadata: one row per table
        if r["database"] and r["name"] and spark.catalog.tableExists(_q(r["database"], r["name"])):
            names[_q(r["database"], r["name"])] = (r["database"], r["name"])
    schema = "database string, name string, bytes long"
    if not names:
        return spark.createDataFrame([], schema)
    st = table_stats({k: spark.table(k) for k in names}, errors="isolate", rows=False,
                     locations=_locations(spark, {k: k for k in names})).collect()
    return spark.createDataFrame([(*names[r["table_name"]], r["bytes"]) for r in st], schema)


def _plan_rows(targets: DataFrame, sizes: DataFrame | None = None) -> list[dict]:
    """The plan is metadata: one row per table to convert, in ``t_no`` order -- or largest first
    when ``sizes`` (``database, name, bytes``) is given, so the longest copies start first and a
    thread pool is not left waiting on one big table at the end."""
    cols = ["database", "name", "target_schema", "target_table", "location", "t_no"]
    t = targets.select(*cols)
    if sizes is not None:
        t = t.join(sizes.select("database", "name", "bytes"), ["database", "name"], "left")
        t = t.orderBy(F.col("bytes").desc_nulls_last(), F.col("t_no").asc_nulls_last(), "database", "name")
    else:
        t = t.orderBy(F.col("t_no").asc_nulls_last(), "database", "name")
    return [{c: r[c] for c in cols} for r in t.collect()]


def convert_to_external(spark: SparkSession, targets: DataFrame, drop_old: bool = False,
                        verify: str = "count", fmt: str | None = None, parallelism: int = 1,
                        resume: bool = True, sizes: DataFrame | str | None = None, batch: int = 16,
                        dry_run: bool = False, unit_bytes: int | None = None) -> DataFrame:
    """Convert every table of ``targets`` (``plan_targets`` output); one outcome row per table.

    A pool of ``parallelism`` driver threads copies the tables one by one (each copy is its own Spark
    job), largest first when ``sizes`` is given -- a frame of ``database, name, bytes``, or ``"auto"`` to
    measure the sources from one file listing. Copies that are done are verified in batches of ``batch``
    (a few jobs each, ``verify_many``) and swapped (catalog calls) while others still copy, so thousands
    of small tables cost a few verification jobs per batch, and a huge one holds back nobody.

    ``unit_bytes`` copies tables in units of about so many bytes with a journal (``journal.copy_in_units``): a run
    that was stopped half-way goes on with the missing units, and after ``SOURCE_CHANGED`` only the units
    whose files changed are copied again. Tables that can't be copied in units are copied whole.

    ``dry_run`` runs the checks only (state of each table and of its target location) and reports
    ``PLANNED`` with the action a real run would take; nothing is written.
    """
    _may_drop(drop_old, verify)
    if isinstance(sizes, str) and sizes == "auto":
        sizes = _auto_sizes(spark, targets)
    rows = _plan_rows(targets, sizes)
    # Object types of every table involved, from one name-and-type listing per database (not three
    # catalog lookups per table).
    types: dict[tuple[str, str], str] = {}
    for d in sorted({r["database"] for r in rows if r["database"]}):
        if spark.catalog.databaseExists(d):
            types.update({(d.lower(), t.name.lower()): t.tableType for t in spark.catalog.listTables(d)
                          if not t.isTemporary})
    def plan_group(idx: list[int]) -> list[tuple[int, dict]]:
        out = []
        for i in idx:
            st, row = _check(spark, rows[i], resume, types), rows[i]
            if isinstance(st, dict):
                out.append((i, st))
            elif st[0] == "fresh":
                try:
                    busy = (not has_journal(spark, row["location"], _q(row["database"], row["name"]))
                            and copy_ops.path_has_files(spark, row["location"]))
                except Exception as e:  # noqa: BLE001 - the same outcome as in a real run
                    out.append((i, _outcome(row, "COPY_FAILED", str(e))))
                    continue
                out.append((i, _outcome(row, "TARGET_NOT_EMPTY", f"location not empty: {row['location']}") if busy
                            else _outcome(row, "PLANNED", f"copy to {row['location']}, verify {verify}, swap"
                                                          + (", drop the managed copy" if drop_old else ""))))
            else:
                out.append((i, _outcome(row, "PLANNED", st[1])))
        return out

    def copy_one(i: int) -> dict | _Staged:
        st = _check(spark, rows[i], resume, types)
        return st if isinstance(st, dict) else _stage_of(spark, rows[i], st, fmt, unit_bytes)

    def finish(staged: list[tuple[int, _Staged]]) -> list[tuple[int, dict]]:
        verdicts = verify_many(spark, [(x.managed_side, x.copy_side) for _, x in staged], verify)
        return [(i, _finish(spark, x, v, drop_old)) for (i, x), v in zip(staged, verdicts)]

    done: list[tuple[int, dict]] = []
    if dry_run:
        done = plan_group(list(range(len(rows))))
    elif rows:
        # Copies run table by table from the pool, so a long one holds back nothing but itself; what is
        # copied meanwhile is verified and swapped in batches.
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            copies = {pool.submit(copy_one, i): i for i in range(len(rows))}
            checks, ready = [], []
            for f in as_completed(copies):
                x = f.result()
                if isinstance(x, dict):
                    done.append((copies[f], x))
                    continue
                ready.append((copies[f], x))
                if len(ready) >= max(1, batch):
                    checks.append(pool.submit(finish, ready))
                    ready = []
            if ready:
                checks.append(pool.submit(finish, ready))
            for c in checks:
                done += c.result()
    out = [o for _, o in sorted(done, key=lambda x: x[0])]
    df = spark.createDataFrame(out, schemas.CONVERSION)
    return df.withColumn("elapsed", F.when(F.col("seconds").isNotNull(), mm_ss("seconds")))


def _target_name(spark: SparkSession, catalog: str | None, schema: str, name: str | None = None) -> str:
    """Quoted ``schema[.name]``, prefixed by the catalog when it is not the session catalog."""
    parts = [schema] + ([name] if name is not None else [])
    return _q(*parts) if _in_session_catalog(spark, catalog) else _q(catalog, *parts)


_text = copy_ops.sql_text


def statement_error(spark: SparkSession, statement: str) -> str | None:
    """Why a statement doesn't parse, found without running it; None if it does."""
    try:
        spark._jsparkSession.sessionState().sqlParser().parsePlan(statement)
        return None
    except Exception as e:  # noqa: BLE001
        return next((x for x in str(e).splitlines() if x.strip()), repr(e))


def _dry_problems(spark: SparkSession, row: dict, statement: str, provider: str) -> str | None:
    """What would stop a registration: the statement, an unknown provider, a source that can't be read, a target
    that exists, a location that is gone."""
    if wrong := statement_error(spark, statement):
        return wrong
    jvm = spark._jvm.org.apache.spark.sql.execution.datasources.DataSource
    try:
        jvm.lookupDataSource(provider, spark._jsparkSession.sessionState().conf())
    except Exception as e:  # noqa: BLE001
        return str(e).splitlines()[0]
    try:
        spark.table(_q(row["source_schema"], row["source_name"])).schema  # noqa: B018 - analysis alone
        if spark.catalog.tableExists(_target_name(spark, row.get("target_catalog"), row["target_schema"], row["target_name"])):
            return "the target exists already"
    except Exception as e:  # noqa: BLE001
        return str(e).splitlines()[0]
    loc = row.get("location")
    if loc and not copy_ops.path_exists(spark, loc):
        return f"location does not exist: {loc}"
    return None


def _register(spark: SparkSession, row: dict, dry_run: bool, owner: str | None) -> tuple[dict, dict | None, str]:
    """Create the target table over the source's files: (base row, failure outcome or None, name)."""
    dst = _target_name(spark, row.get("target_catalog"), row["target_schema"], row["target_name"])
    loc, provider = row.get("location"), (row.get("provider") or "parquet")
    props = {"migration.source": f"{row['source_schema']}.{row['source_name']}"}
    if owner:
        props["migration.owner"] = owner
    tp = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in props.items())
    src = _q(row["source_schema"], row["source_name"])
    base = {"database": row["source_schema"], "name": row["source_name"], "target_schema": row["target_schema"],
            "target_table": row["target_name"], "location": loc, "t_no": None}
    try:
        # Columns with their types, partition columns and storage options are the source's: inferring
        # them from the files would turn a text partition '01' into a number, or lose a CSV's header.
        info = describe_table(spark, src)
        columns = columns_ddl(spark, src)
        options = ", ".join(f"{_text(k)} {_text(v)}" for k, v in info.get("options", {}).items() if k.lower() != "path")
        parts = ", ".join(_q(c) for c in partition_columns(spark, src))
        stmt = (f"CREATE TABLE {dst} ({columns}) USING {provider}" + (f" OPTIONS ({options})" if options else "")
                + (f" PARTITIONED BY ({parts})" if parts else "") + f" LOCATION {_text(loc)}"
                + (f" COMMENT {_text(info['comment'])}" if info.get("comment") else "") + f" TBLPROPERTIES ({tp})")
    except Exception as e:  # noqa: BLE001 - one outcome per table
        return base, _outcome(base, "REGISTER_FAILED", str(e)), dst
    if dry_run:
        wrong = _dry_problems(spark, row, stmt, provider)
        return base, _outcome(base, "STATEMENT_INVALID" if wrong else "DRY_RUN", f"{wrong}: {stmt}" if wrong else stmt), dst
    try:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_target_name(spark, row.get('target_catalog'), row['target_schema'])}")
        spark.sql(stmt)
        if partition_columns(spark, dst):
            copy_partitions(spark, src, dst)
    except Exception as e:  # noqa: BLE001
        return base, _outcome(base, "REGISTER_FAILED", str(e)), dst
    return base, None, dst


def _registered(spark: SparkSession, row: dict, base: dict, v: dict | Exception) -> dict:
    src = _q(row["source_schema"], row["source_name"])
    dst = _target_name(spark, row.get("target_catalog"), row["target_schema"], row["target_name"])
    if not isinstance(v, Exception) and v["ok"]:
        kinds = [columns_ddl(spark, t) for t in (src, dst)]
        if kinds[0] != kinds[1]:
            v = {**v, "ok": False, "reason": f"schemas differ: {kinds[0]} vs {kinds[1]}"}
    if isinstance(v, Exception) or not v["ok"]:
        # The target is an entry over the source's own files: dropping it removes no data, and a later
        # run finds the name free.
        left = ""
        try:
            spark.sql(f"DROP TABLE IF EXISTS {dst}")
        except Exception as e:  # noqa: BLE001
            left = f"; the target could not be removed: {e}"
        if isinstance(v, Exception):
            return _outcome(base, "VERIFY_FAILED", str(v) + left)
        return _outcome(base, "VERIFY_FAILED", v["reason"] + left, source_rows=v["source_rows"], target_rows=v["target_rows"])
    # Mark the source as migrated, naming its target, so an inventory taken later knows it.
    target = ".".join(x for x in (row.get("target_catalog"), row["target_schema"], row["target_name"]) if x)
    try:
        spark.sql(f"ALTER TABLE {_q(row['source_schema'], row['source_name'])} SET TBLPROPERTIES "
                  f"({_text(UPGRADED_TO)} = {_text(target)})")
        reason = None
    except Exception as e:  # noqa: BLE001 - the registration itself stands
        reason = f"registered, but the source could not be marked: {str(e).splitlines()[0] if str(e) else e}"
    return _outcome(base, "REGISTERED", reason, source_rows=v["source_rows"], target_rows=v["target_rows"],
                    size_mb=(v["bytes"] or 0) / BYTES_PER_MB)


def register_one(spark: SparkSession, row: dict, dry_run: bool = True, verify: str = "checksum",
                 owner: str | None = None) -> dict:
    """Register ``source`` as external table ``target`` over the same files, then verify."""
    base, failed, dst = _register(spark, row, dry_run, owner)
    if failed is not None:
        return failed
    try:
        v = verify_copy(spark, _q(row["source_schema"], row["source_name"]), dst, verify)
    except Exception as e:  # noqa: BLE001
        v = e
    return _registered(spark, row, base, v)


def register_external(spark: SparkSession, plan: DataFrame, inv: DataFrame, dry_run: bool = True,
                      verify: str = "checksum", owner: str | None = None, parallelism: int = 1) -> DataFrame:
    """Register every ``READY`` row of a migration plan under its final target name.

    The tables are created first (catalog calls, ``parallelism`` at a time), then all of them are
    verified against their sources in a few batched jobs (``verify_many``).
    """
    ready = plan.where(F.col("status_code") == F.lit("READY"))
    listed = inv.select(F.lower("database").alias("_db"), F.lower("name").alias("_nm"), "location", "provider")
    j = ready.join(listed, (F.lower("source_schema") == F.col("_db")) & (F.lower("source_name") == F.col("_nm")),
                   "left").drop("_db", "_nm")
    rows = [r.asDict() for r in j.orderBy("source_schema", "source_name").collect()]
    make = lambda r: _register(spark, r, dry_run, owner)
    if parallelism <= 1:
        made = [make(r) for r in rows]
    else:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            made = list(pool.map(make, rows))
    todo = [k for k, (_, failed, _) in enumerate(made) if failed is None]
    verdicts = dict(zip(todo, verify_many(
        spark, [(_q(rows[k]["source_schema"], rows[k]["source_name"]), made[k][2]) for k in todo], verify)))
    out = [m[1] if m[1] is not None else _registered(spark, rows[k], m[0], verdicts[k]) for k, m in enumerate(made)]
    df = spark.createDataFrame(out, schemas.CONVERSION)
    return df.withColumn("elapsed", F.when(F.col("seconds").isNotNull(), mm_ss("seconds")))
