"""Recreate views in the target with their references rewritten (B12, ``migrate_views``).

View texts come from the inventory listing (one catalog call per database). The driver issues a statement for each
view, so it parses each text with the session's parser (``references``) and maps the relations that it finds;
texts that don't parse go through the token rule. Views are created level by level of the view graph; what
fails is retried in rounds until no round makes progress.
"""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..operators.copy import sql_text
from ..operators.references import rewrite_parsed, view_levels, view_reads
from ..operators.select import one_per_key
from ..sources.catalog import _in_session_catalog
from .convert import _target_name, statement_error


log = logging.getLogger(__name__)


def view_plan(inv: DataFrame, target_catalog: str | None = None, view_manifest: DataFrame | None = None) -> DataFrame:
    """``source_schema, source_view, target_schema, target_view, view_text`` for every view of the
    inventory (or of the view manifest, which may rename) -- source and target in one row."""
    views = inv.where(F.col("object_type") == F.lit("VIEW")).select(
        F.col("database").alias("source_schema"), F.col("name").alias("source_view"), "view_text")
    if view_manifest is None:
        return views.select("source_schema", "source_view", F.col("source_schema").alias("target_schema"),
                            F.col("source_view").alias("target_view"), "view_text")
    vm = one_per_key(view_manifest.select("source_schema", "source_view", "target_schema", "target_view"),
                     ["source_schema", "source_view"])
    return vm.join(views, ["source_schema", "source_view"], "left")


def view_mapping(plan: DataFrame) -> DataFrame:
    """``(key, value)`` from a view plan: each migrated view's old name to its new one, so a view
    that reads another migrated view is pointed at the new one."""
    return plan.select(F.lower(F.concat_ws(".", "source_schema", "source_view")).alias("key"),
                       F.concat_ws(".", "target_schema", "target_view").alias("value"))


def view_statements(plan: DataFrame, mapping, catalog_from: str | None = None, catalog_to: str | None = None,
                    target_catalog: str | None = None) -> DataFrame:
    rw = rewrite_parsed(plan, "view_text", mapping, catalog_from, catalog_to, out_col="new_text")
    parts = ["target_schema", "target_view"]
    spark = plan.sparkSession
    if not _in_session_catalog(spark, target_catalog):
        parts = [F.lit(target_catalog)] + parts
    target = F.concat_ws(".", *[F.concat(F.lit("`"), F.replace(F.col(c) if isinstance(c, str) else c, F.lit("`"),
                                                               F.lit("``")), F.lit("`")) for c in parts])
    return rw.withColumn("statement", F.when(F.col("new_text").isNotNull(), F.concat(
        F.lit("CREATE OR REPLACE VIEW "), target, F.lit(" AS "), F.col("new_text"))))


def _levels(spark: SparkSession, views: list[dict]) -> tuple[list[list[dict]], dict[str, str]]:
    """The views by level (each reads views of lower levels only; what hangs on a cycle comes last), and the cycle
    that a view is part of, by its lower-cased name."""
    level, cycles = view_levels(view_reads(spark, [(r["dst"], r["statement"].partition(" AS ")[2]) for r in views]))
    by: dict[int, list[dict]] = {}
    for r in views:
        by.setdefault(level[r["dst"].lower()], []).append(r)
    return [by[k] for k in sorted(by)], {v: " -> ".join([*c, c[0]]) for c in cycles for v in c}


def migrate_views(spark: SparkSession, plan: DataFrame, mapping, catalog_from: str | None = None,
                  catalog_to: str | None = None, dry_run: bool = True, owner: str | None = None,
                  target_catalog: str | None = None, parallelism: int = 1) -> DataFrame:
    """Create the target views; one outcome row per view (``schemas.VIEW_OUTCOME``).

    Views are created level by level (``references.view_graph``), ``parallelism`` of a level at a time. A view that
    can't be created because it is part of a cycle ends ``VIEW_CYCLE``, and the reason names the cycle.
    A dry run parses every statement and reports what doesn't parse as ``STATEMENT_INVALID``.

    ``target_catalog`` names a configured catalog other than the session catalog; views and
    schemas are then created there with three-part names."""
    stm = view_statements(plan, mapping, catalog_from, catalog_to, target_catalog=target_catalog)
    todo = [r.asDict() for r in stm.select("source_schema", "source_view", "target_schema", "target_view",
                                           "statement").orderBy("source_schema", "source_view").collect()]
    out = []
    for r in todo:
        r["src"] = f"{r['source_schema']}.{r['source_view']}"
        r["dst"] = f"{r['target_schema']}.{r['target_view']}"
    if dry_run:
        for r in todo:
            wrong = statement_error(spark, r["statement"]) if r["statement"] else None
            outcome = "SOURCE_MISSING" if not r["statement"] else "STATEMENT_INVALID" if wrong else "DRY_RUN"
            out.append((r["src"], r["dst"], outcome, wrong, r["statement"]))
        return spark.createDataFrame(out, schemas.VIEW_OUTCOME)
    same = [r for r in todo if r["statement"] and r["src"] == r["dst"] and catalog_to in (None, catalog_from)]
    out += [(r["src"], r["dst"], "SKIPPED_SAME_NAME", "target is the source view itself", None) for r in same]
    todo = [r for r in todo if r not in same]
    missing = [r for r in todo if not r["statement"]]
    out += [(r["src"], r["dst"], "SOURCE_MISSING", "view not found in the inventory", None) for r in missing]
    levels, cycle_of = _levels(spark, [r for r in todo if r["statement"]])
    errors: dict[str, str] = {}

    def create(r: dict) -> tuple | None:
        """The outcome of a created view, or None."""
        try:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {_target_name(spark, target_catalog, r['target_schema'])}")
            spark.sql(r["statement"])
        except Exception as e:  # noqa: BLE001 - retried, then reported
            errors[r["src"]] = str(e) or repr(e)
            return None
        log.info("view created: %s -> %s", r["src"], r["dst"])
        reason = None
        if owner:
            view = _target_name(spark, target_catalog, r["target_schema"], r["target_view"])
            try:
                spark.sql(f"ALTER VIEW {view} SET TBLPROPERTIES ('migration.owner' = {sql_text(owner)})")
            except Exception as e:  # noqa: BLE001 - the view itself stands
                reason = f"created, but its owner could not be set: {str(e).splitlines()[0] if str(e) else e}"
        return (r["src"], r["dst"], "VIEW_CREATED", reason, r["statement"])

    # Level by level, the views of a level side by side; what failed is tried again until a round makes no progress
    # (a text that the parser couldn't read may read views that nobody knew of).
    pending: list[dict] = []
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        rounds = [*levels, None]
        while rounds:
            batch = rounds.pop(0)
            again = batch is None
            batch = pending if again else batch
            made = list(pool.map(create, batch))
            out += [m for m in made if m]
            failed = [r for r, m in zip(batch, made) if m is None]
            if not again:
                pending += failed
            else:
                if failed and len(failed) < len(batch):
                    rounds.append(None)
                pending = failed
    for r in pending:
        cycle = cycle_of.get(r["dst"].lower())
        log.warning("view failed: %s -> %s (%s)", r["src"], r["dst"], cycle or errors.get(r["src"]))
        out.append((r["src"], r["dst"], "VIEW_CYCLE" if cycle else "VIEW_FAILED", f"cycle: {cycle}" if cycle else errors.get(r["src"]),
                    r["statement"]))
    return spark.createDataFrame(out, schemas.VIEW_OUTCOME)
