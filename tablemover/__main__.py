"""Command-line entry: the migration workflows as Spark jobs (``spark-submit -m tablemover ...`` or
``python -m tablemover ...``). Each subcommand prints its report and, with ``--out``, writes every
report frame under that folder as Parquet (one sub-folder per frame).

  manifest   CSV listing -> typed manifest (t_no = line order), written as JSON/Parquet/CSV
  estimate   manifest -> transfer-time estimate of its managed tables
  convert    manifest -> managed tables copied to external locations, verified, swapped
  migrate    schemas (+ manifest) -> plan, registered tables, recreated views
  inventory  schemas -> objects with type, provider, location, migration mark (+ stats)
  validate   source and target inventories (tables) -> every post-migration list + summary
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession


def _session() -> SparkSession:
    from .session import RECOMMENDED_CONF
    b = SparkSession.builder.appName("tablemover").config("spark.ui.enabled", "false")
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    return b.getOrCreate()


def _emit(frames: dict[str, DataFrame], out: str | None, show: int) -> None:
    for name, df in frames.items():
        if df is None:
            continue
        if out:
            df.write.mode("errorifexists").parquet(f"{out.rstrip('/')}/{name}")
        print(f"== {name}")
        df.show(show, truncate=False)


def _manifest(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    from .sources.manifest import load_manifest
    man, problems = load_manifest(spark, path, fmt)
    bad = problems.count()
    if bad:
        problems.show(50, truncate=False)
        raise SystemExit(f"manifest has {bad} problem rows (duplicate or null keys); fix it first")
    return man


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tablemover")
    p.add_argument("--out", help="folder to write every report frame to (Parquet)")
    p.add_argument("--show", type=int, default=50, help="rows of each report to print")
    sub = p.add_subparsers(dest="cmd", required=True)

    m = sub.add_parser("manifest", help="CSV listing -> typed manifest (t_no = line order)")
    m.add_argument("csv")
    m.add_argument("dest")
    m.add_argument("--format", default="json", choices=["json", "parquet", "csv"])

    helps = {"estimate": "transfer-time estimate of the manifest's managed tables",
             "convert": "copy managed tables to external locations, verify, swap (resumable)"}
    for name in ("estimate", "convert"):
        s = sub.add_parser(name, help=helps[name])
        s.add_argument("manifest")
        s.add_argument("--manifest-format", default="json", choices=["json", "csv", "parquet", "yaml"])
    sub.choices["estimate"].add_argument("--rate", type=float, required=True)
    sub.choices["estimate"].add_argument("--mode", default="mb_per_second", choices=["mb_per_second", "seconds_per_mb"])
    c = sub.choices["convert"]
    c.add_argument("--pii-root", required=True)
    c.add_argument("--nonpii-root", required=True)
    c.add_argument("--drop-old", action="store_true")
    c.add_argument("--verify", default="checksum", choices=["count", "checksum", "rows"])
    c.add_argument("--parallelism", type=int, default=4)
    c.add_argument("--no-resume", action="store_true")
    c.add_argument("--dry-run", action="store_true", help="report what would be done, write nothing")

    g = sub.add_parser("migrate", help="plan, register tables and recreate views in a target catalog")
    g.add_argument("scope", choices=["external-tables", "views", "all"])
    g.add_argument("--schemas", default="all")
    g.add_argument("--exclude-schemas", default="")
    g.add_argument("--catalog", required=True)
    g.add_argument("--source-catalog", default="hive_metastore")
    g.add_argument("--manifest")
    g.add_argument("--manifest-format", default="json", choices=["json", "csv", "parquet", "yaml"])
    g.add_argument("--owner")
    g.add_argument("--apply", action="store_true", help="without it the run is a dry run")
    g.add_argument("--verify", default="checksum", choices=["count", "checksum", "rows"])
    g.add_argument("--parallelism", type=int, default=4)

    i = sub.add_parser("inventory", help="objects of schemas with type, location and migration mark")
    i.add_argument("--schemas", default="all")
    i.add_argument("--exclude-schemas", default="")
    i.add_argument("--with-stats", action="store_true", help="add rows, bytes and files (reads file metadata)")
    i.add_argument("--parallelism", type=int, default=4)

    v = sub.add_parser("validate", help="post-migration checks of source and target inventories")
    v.add_argument("source_inventory", help="table or Parquet folder: database, name, object_type, upgraded_to")
    v.add_argument("target_inventory", help="table or Parquet folder: information_schema.tables shape or an "
                                            "inventory of the target")
    v.add_argument("--exclude-schemas", default="")

    a = p.parse_args(argv)
    import logging
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    spark = _session()

    if a.cmd == "manifest":
        from .sources.manifest import manifest_from_csv, write_manifest
        man = manifest_from_csv(spark, a.csv)
        write_manifest(man, a.dest, a.format)
        _emit({"manifest": man}, a.out, a.show)
    elif a.cmd == "estimate":
        from .operators.estimate import estimate_manifest
        per, tot, skipped = estimate_manifest(spark, _manifest(spark, a.manifest, a.manifest_format), a.rate, a.mode)
        _emit({"estimate": per, "totals": tot, "skipped": skipped}, a.out, a.show)
    elif a.cmd == "convert":
        from .plans.convert import convert_to_external
        from .plans.report import conversion_failures, conversion_summary, outcome_counts
        from .plans.targets import plan_targets
        targets = plan_targets(_manifest(spark, a.manifest, a.manifest_format), "spark_catalog", a.pii_root,
                               a.nonpii_root)
        out = convert_to_external(spark, targets, a.drop_old, a.verify, parallelism=a.parallelism,
                                  resume=not a.no_resume, sizes="auto", dry_run=a.dry_run)
        _emit({"conversions": out, "counts": outcome_counts(out, "outcome"), "failures": conversion_failures(out),
               "converted": conversion_summary(out)}, a.out, a.show)
    elif a.cmd == "migrate":
        from .plans.migrate import migrate
        from .plans.report import migration_summary
        man = _manifest(spark, a.manifest, a.manifest_format) if a.manifest else None
        res = migrate(spark, a.scope, a.schemas, a.catalog, manifest=man, exclude_schemas=a.exclude_schemas,
                      owner=a.owner, dry_run=not a.apply, source_catalog=a.source_catalog, verify=a.verify,
                      parallelism=a.parallelism)
        _emit({"summary": migration_summary(res.plan, res.tables, res.views), "plan": res.plan,
               "counts": res.counts, "tables": res.tables, "views": res.views,
               "only_in_source": res.only_in_source, "only_in_target": res.only_in_target}, a.out, a.show)
    elif a.cmd == "inventory":
        from .sources.catalog import inventory, list_databases
        inv = inventory(spark, list_databases(spark, a.schemas, a.exclude_schemas), parallelism=a.parallelism,
                        with_stats=a.with_stats)
        _emit({"inventory": inv.drop("view_text")}, a.out, a.show)
    elif a.cmd == "validate":
        from .plans.validate import validate
        def load(x: str) -> DataFrame:  # a table name, or a folder written by ``inventory --out``
            return spark.read.parquet(x) if "/" in x else spark.table(x)
        val = validate(load(a.source_inventory), load(a.target_inventory), a.exclude_schemas)
        frames = {name: getattr(val, name) for name in val.__dataclass_fields__}
        _emit({"summary": val.summary(), **frames}, a.out, a.show)
    return 0


if __name__ == "__main__":
    sys.exit(main())
