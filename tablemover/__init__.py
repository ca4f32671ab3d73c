"""tablemover: move tables and views between metastore namespaces on Spark, and prove nothing
was lost.

Manifest -> inventory -> estimate -> plan -> convert / register -> rewrite views -> reconcile ->
report. Every step is a DataFrame plan or a Spark job; the driver only issues catalog commands.
"""

import logging as _logging

# A library logs, the application decides where to: silent unless logging is configured.
_logging.getLogger(__name__).addHandler(_logging.NullHandler())

from .operators.copy import copy_table, split_by_flag, write_csv
from .operators.estimate import estimate_manifest, estimate_transfer
from .operators.reconcile import (count_rows, keyed_diff, not_upgraded, reconcile_counts,
                                  reconcile_inventory, reconcile_partitions, reconcile_rows, row_differences, schema_changes,
                                  table_checksum, table_checksums)
from .operators.rewrite import mapping_from_manifest, rewrite_catalog, rewrite_references
from .operators.select import exclude_schemas, exclude_tables, include_tables, select_tables
from .operators.sequence import with_sequence
from .plans.convert import convert_one, convert_to_external, register_external, verify_copy, verify_many
from .plans.migrate import migrate
from .plans.migration import plan_migration
from .plans.report import (conversion_failures, conversion_summary, ineligible, migration_summary,
                           outcome_counts)
from .plans.targets import plan_targets
from .plans.validate import validate
from .plans.views import migrate_views, view_plan
from .sources.catalog import describe_table, inventory, list_databases
from .sources.manifest import (build_manifest, load_manifest, load_view_manifest, manifest_from_csv,
                               manifest_problems, write_manifest, yaml_problems)
from .session import build_session, scale_conf, scratch, work_root
from .sources.stats import table_stats

__all__ = [n for n in dir() if not n.startswith("_")]
