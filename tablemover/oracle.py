"""DuckDB SQL for the registered queries (same names, same column names).

Written from the operator definitions, not generated from the Spark plans. The portable checksum
is spelled out per column type from the canonical-text rules in ``functions.checksum``.
"""

from __future__ import annotations

from .plans.migration import DESCRIPTIONS
from .queries import CATALOG, NONPII_ROOT, PII_ROOT, RATE, SOURCE_CATALOG, TABLE_COLUMNS, TABLES, TEXT_TABLES

DB = ("CASE WHEN c_nationkey = 8 THEN 'default' ELSE 'seg_' || lower(c_mktsegment) END")
NAME = "'cust_' || CAST(c_custkey AS VARCHAR)"
TT = f"CASE WHEN c_custkey % 7 = 0 THEN {NAME} || '_v2' ELSE {NAME} END"

MAN = f"""man AS (
  SELECT {DB} AS "database", {NAME} AS "name", 'uc_' || lower(c_mktsegment) AS target_schema,
         {TT} AS target_table,
         CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_custkey % 5 = 0 END AS is_pii,
         CAST(c_custkey + 1 AS INTEGER) AS t_no, c_nationkey
  FROM customer)"""

INV = f"""inv0 AS (
  SELECT CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE {DB} END AS "database", {NAME} AS "name",
         CASE c_custkey % 4 WHEN 0 THEN 'MANAGED' WHEN 1 THEN 'VIEW' ELSE 'EXTERNAL' END AS object_type,
         CASE WHEN c_custkey % 3 <> 0 THEN '{CATALOG}.' || 'uc_' || lower(c_mktsegment) || '.' || {TT} END AS upgraded_to,
         c_nationkey
  FROM customer WHERE c_acctbal >= 0),
inv AS (
  SELECT "database", "name", object_type, upgraded_to FROM inv0
  UNION ALL SELECT "database", "name", object_type, upgraded_to FROM inv0 WHERE c_nationkey = 5)"""

TINV = f"""tinv AS (
  SELECT '{CATALOG}' AS table_catalog, {DB} AS table_schema, {NAME} AS table_name,
         CASE WHEN c_custkey % 4 = 1 THEN 'VIEW' ELSE 'EXTERNAL' END AS table_type
  FROM customer WHERE c_nationkey <> 9
  UNION ALL
  SELECT '{CATALOG}', {DB}, {NAME} || '_extra', 'EXTERNAL' FROM customer WHERE c_nationkey = 2
  UNION ALL
  SELECT '{CATALOG}', 'information_schema', 'r_' || lower(r_name), 'VIEW' FROM region)"""

TINV_MAPPED = f"""tinv AS (
  SELECT '{CATALOG}' AS table_catalog, target_schema AS table_schema, target_table AS table_name,
         'EXTERNAL' AS table_type
  FROM man WHERE c_nationkey <> 9)"""

EXCL = """excl AS (SELECT "database", "name" FROM man WHERE c_nationkey = 3)"""

ORDERS_V2 = """v2a AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderkey % 103 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
         o_orderdate, o_orderpriority
  FROM orders WHERE o_orderkey % 97 <> 0),
v2 AS (SELECT * FROM v2a UNION ALL SELECT * FROM v2a WHERE o_orderkey % 101 = 0)"""

XS = "('seg_machinery', 'seg_household')"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _q(x: str) -> str:
    return f"'`' || replace({x}, '`', '``') || '`'"


def _plan_sql() -> str:
    desc = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in DESCRIPTIONS.items())
    return _with(MAN, INV, EXCL, f"""ptinv AS (
  SELECT DISTINCT lower(upper(target_schema)) AS ts, lower(target_table) AS tn FROM man WHERE c_nationkey = 7)""",
                 """invk AS (SELECT DISTINCT "database", "name", object_type FROM inv WHERE "name" IS NOT NULL)""",
                 f"""base AS (
  SELECT m."database", m."name", m.target_schema, m.target_table, i.object_type,
         p.ts IS NOT NULL AS target_exists,
         EXISTS (SELECT 1 FROM excl e WHERE e."database" = m."database" AND e."name" = m."name") AS excluded
  FROM man m
  LEFT JOIN invk i ON i."database" = m."database" AND i."name" = m."name"
  LEFT JOIN ptinv p ON p.ts = lower(m.target_schema) AND p.tn = lower(m.target_table))""",
                 f"""plan AS (
  SELECT "database" AS source_schema, "name" AS source_name, '{CATALOG}' AS target_catalog, target_schema,
         target_table AS target_name, status_code,
         CASE status_code {desc} END AS description,
         CASE WHEN status_code = 'READY' THEN 'REGISTER ' || {_q(f"'{SOURCE_CATALOG}'")} || '.' || {_q('"database"')}
              || '.' || {_q('"name"')} || ' AS ' || {_q(f"'{CATALOG}'")} || '.' || {_q('target_schema')} || '.'
              || {_q('target_table')} END AS statement
  FROM (SELECT *, CASE WHEN object_type IS NULL THEN 'SOURCE_MISSING' WHEN excluded THEN 'EXCLUDED'
                       WHEN object_type = 'VIEW' THEN 'VIEW' WHEN object_type = 'MANAGED' THEN 'MANAGED_SOURCE'
                       WHEN target_exists THEN 'TARGET_EXISTS' ELSE 'READY' END AS status_code FROM base))""")


def _canon(expr: str, typ: str) -> str:
    if typ == "string":
        v = f"CAST(length({expr}) AS VARCHAR) || ':' || {expr}"
    elif typ in ("double", "float"):
        d = f"CAST({expr} AS DOUBLE)"
        ax = f"abs({d})"
        t53 = f"CAST({2.0 ** 53!r} AS DOUBLE)"
        whole = lambda x: f"CAST(CAST({x} AS BIGINT) AS VARCHAR)"
        hi_lo = lambda m: f"{whole(f'floor({m})')} || '.' || {whole(f'(({m}) - floor({m})) * {t53}')}"
        guess = f"floor(log2({ax}) / 53.0::DOUBLE)"
        half = f"floor({guess} * -53.0::DOUBLE / 2.0::DOUBLE)"
        m = f"({ax} * pow(2.0::DOUBLE, {half}) * pow(2.0::DOUBLE, {guess} * -53.0::DOUBLE - {half}))"
        any_scale = (f"CASE WHEN {m} < 1 THEN {hi_lo(f'{m} * {t53}')} || 'E' || {whole(f'{guess} - 1')} "
                     f"WHEN {m} >= {t53} THEN {hi_lo(f'{m} / {t53}')} || 'E' || {whole(f'{guess} + 1')} "
                     f"ELSE {hi_lo(m)} || 'E' || {whole(guess)} END")
        small = f"CAST({2.0 ** -53!r} AS DOUBLE)"
        body = (f"CASE WHEN {ax} = 0 THEN '0' WHEN {ax} >= 1 AND {ax} < {t53} THEN {hi_lo(ax)} "
                f"WHEN {ax} >= {small} AND {ax} < 1 THEN {hi_lo(f'{ax} * {t53}')} || 'E-1' ELSE {any_scale} END")
        v = (f"CASE WHEN {d} IS NULL THEN NULL WHEN isnan({d}) THEN 'NaN' WHEN {d} = CAST('inf' AS DOUBLE) THEN 'Inf' "
             f"WHEN {d} = CAST('-inf' AS DOUBLE) THEN '-Inf' "
             f"ELSE (CASE WHEN {d} < 0 THEN '-' ELSE '' END) || "
             f"({body}) END")
    elif typ == "timestamp":
        v = f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"
    elif typ.startswith("array<"):
        inner = _canon("e", typ[6:-1])
        v = f"'[' || array_to_string(list_transform({expr}, lambda e: {inner}), ',') || ']'"
    else:
        v = f"CAST({expr} AS VARCHAR)"
    return f"coalesce({v}, 'N')"


def _checksum_sql(table: str, label: str | None = None) -> str:
    text = "concat_ws(',', " + ", ".join(_canon(f'"{c}"', t) for c, t in TABLE_COLUMNS[table]) + ")"
    h = f"CAST(('0x' || substr(md5({text}), 1, 16)) AS UBIGINT)"
    return (f"SELECT '{label or table}' AS table_name, count(*) AS row_count, "
            f"CAST(coalesce(sum(CAST({h} AS HUGEINT)), 0) AS VARCHAR) AS checksum FROM {table}")


def _ref_texts() -> str:
    # The texts the Spark query rewrites, with the expected rewrite applied part by part.
    ref = f"({DB} || '.' || {NAME})"
    tgt = f"('uc_' || lower(c_mktsegment) || '.' || {TT})"
    new = (f"'SELECT o.o_totalprice FROM ' || {tgt} || ' o JOIN {CATALOG}.' || {tgt} || ' h ON o.k = h.k JOIN ' "
           f"|| {ref} || 'x z ON 1 = 1 JOIN x.' || {ref} || ' w JOIN ' || {tgt} || ' q JOIN ' || {tgt} "
           f"|| ' u WHERE o.s = ''' || {ref} || ''' AND ' || {tgt} || '.o_orderkey = ' || CAST(o_orderkey AS VARCHAR) "
           f"|| ' -- ' || {ref} || chr(10) || '/* ' || {ref} || ' */ ;'")
    return f"SELECT o_orderkey, {new} AS new_text FROM orders JOIN customer ON o_custkey = c_custkey"


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["manifest_number"] = f"""
SELECT {DB} AS "database", {NAME} AS "name", 'uc_' || lower(c_mktsegment) AS target_schema, {NAME} AS target_table,
       CASE c_custkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS is_pii,
       CAST(row_number() OVER (ORDER BY c_custkey) AS INTEGER) AS t_no
FROM customer"""
    sql["manifest_from_csv"] = f"""
SELECT {DB} AS "database", {NAME} AS "name", 'uc_' || lower(c_mktsegment) AS target_schema, {NAME} AS target_table,
       c_custkey % 2 = 0 AS is_pii, CAST(row_number() OVER (ORDER BY c_custkey DESC) AS INTEGER) AS t_no
FROM customer"""
    sql["manifest_dedup"] = _with(MAN) + """
SELECT DISTINCT "database", "name", target_schema, target_table, is_pii, t_no FROM (
  SELECT * FROM man UNION ALL SELECT * FROM man WHERE c_nationkey = 1)"""
    sql["manifest_dup_keys"] = _with(MAN, """all_rows AS (
  SELECT DISTINCT * FROM (
    SELECT "database", "name", target_schema, target_table, is_pii, t_no FROM man
    UNION ALL SELECT "database", "name", 'uc_other', target_table, is_pii, t_no FROM man WHERE c_nationkey = 4
    UNION ALL SELECT "database", NULL, target_schema, target_table, is_pii, t_no FROM man WHERE c_nationkey = 6))""") + """
SELECT "database", "name", count(*) AS row_count, 'DUPLICATE_KEY' AS problem FROM all_rows
WHERE "database" IS NOT NULL AND "name" IS NOT NULL GROUP BY "database", "name" HAVING count(*) > 1
UNION ALL
SELECT "database", "name", count(*) AS row_count, 'NULL_KEY' AS problem FROM all_rows
WHERE "database" IS NULL OR "name" IS NULL GROUP BY "database", "name" """
    sql["include_tables"] = _with(MAN, INV) + """
SELECT * FROM inv i WHERE EXISTS (
  SELECT 1 FROM man m WHERE m.c_nationkey < 10 AND m."database" = i."database" AND m."name" = i."name")"""
    sql["exclude_tables"] = _with(MAN, INV, EXCL) + """
SELECT * FROM inv i WHERE NOT EXISTS (SELECT 1 FROM excl e WHERE e."database" = i."database" AND e."name" = i."name")"""
    sql["exclude_schemas"] = _with(MAN, INV) + f"""SELECT * FROM inv WHERE "database" NOT IN {XS}"""
    sql["plan_targets"] = _with(MAN) + f"""
SELECT "database", "name", target_schema, coalesce(target_table, "name") AS target_table, is_pii, t_no,
       '{SOURCE_CATALOG}' || '.' || "database" || '.' || "name" AS source_full_name,
       '{CATALOG}' || '.' || target_schema || '.' || target_table AS target_full_name,
       {_q(f"'{SOURCE_CATALOG}'")} || '.' || {_q('"database"')} || '.' || {_q('"name"')} AS source_quoted,
       {_q(f"'{CATALOG}'")} || '.' || {_q('target_schema')} || '.' || {_q('target_table')} AS target_quoted,
       CASE WHEN is_pii = false THEN '{NONPII_ROOT}' ELSE '{PII_ROOT}' END || '/' || target_schema || '/' || target_table
         AS location
FROM man"""
    sql["flag_location"] = _with(MAN) + f"""
SELECT CASE WHEN is_pii = false THEN '{NONPII_ROOT}' ELSE '{PII_ROOT}' END AS storage_root, target_schema,
       count(*) AS tables
FROM man GROUP BY ALL"""
    est = f"""sizes AS (SELECT %s AS target_schema, "source" AS table_name, sum(n_chars) AS bytes
  FROM documents GROUP BY ALL)"""
    r = f"CAST({RATE} AS DOUBLE)"
    mb = "(CAST(bytes AS DOUBLE) / CAST(1000000 AS DOUBLE))"
    parts = []
    for mode, op in (("seconds_per_mb", "*"), ("mb_per_second", "/")):
        s = f"({mb} {op} {r})"
        parts.append(f"""SELECT target_schema, table_name, {mb} AS size_mb,
  printf('%02d:%02d', CAST(floor(floor({s}) / 60) AS BIGINT), CAST(floor({s}) AS BIGINT) % 60) AS elapsed,
  {s} AS seconds, '{mode}' AS mode FROM sizes""")
    sql["estimate_tables"] = _with(est % "'docs_' || lang") + "\nUNION ALL\n".join(parts)
    tparts = []
    for mode, op in (("seconds_per_mb", "*"), ("mb_per_second", "/")):
        s = f"((CAST(sum(bytes) AS DOUBLE) / CAST(1000000 AS DOUBLE)) {op} {r})"
        tparts.append(f"SELECT {s} AS seconds, {s} / 60 AS minutes, {s} / 3600 AS hours, '{mode}' AS mode FROM sizes")
    sql["estimate_totals"] = _with(est % "lang") + "\nUNION ALL\n".join(tparts)
    sql["table_counts"] = "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES)
    sql["table_checksum"] = "\nUNION ALL\n".join(_checksum_sql(t) for t in TABLES)
    hive = lambda ot: f"""hive AS (SELECT "database" AS table_schema, "name" AS table_name FROM inv
  WHERE object_type = '{ot}' AND "database" NOT IN {XS})"""
    uc = lambda ot: f"""uc AS (SELECT table_schema, table_name FROM tinv
  WHERE table_schema <> 'information_schema' AND table_type = '{ot}')"""
    for ot, pre in (("EXTERNAL", ""), ("VIEW", "views_")):
        key_s = "only_in_source" if ot == "EXTERNAL" else "views_only_in_source"
        key_t = "only_in_target" if ot == "EXTERNAL" else "views_only_in_target"
        sql[key_s] = _with(MAN, INV, TINV, hive(ot), uc(ot)) + "SELECT * FROM hive EXCEPT ALL SELECT * FROM uc"
        sql[key_t] = _with(MAN, INV, TINV, hive(ot), uc(ot)) + "SELECT * FROM uc EXCEPT ALL SELECT * FROM hive"
    mapped_hive = """hive AS (
  SELECT coalesce(m.target_schema, i."database") AS table_schema, coalesce(m.target_table, i."name") AS table_name
  FROM inv i LEFT JOIN man m ON m."database" = i."database" AND m."name" = i."name"
  WHERE i.object_type = 'EXTERNAL')"""
    sql["only_in_source_mapped"] = _with(MAN, INV, TINV_MAPPED, mapped_hive, uc("EXTERNAL")) + \
        "SELECT * FROM hive EXCEPT ALL SELECT * FROM uc"
    sql["only_in_target_mapped"] = _with(MAN, INV, TINV_MAPPED, mapped_hive, uc("EXTERNAL")) + \
        "SELECT * FROM uc EXCEPT ALL SELECT * FROM hive"
    checks = {
        "external_tables": f"""SELECT * FROM inv WHERE object_type = 'EXTERNAL' AND "database" NOT IN {XS}""",
        "not_upgraded": f"""SELECT * FROM inv WHERE object_type = 'EXTERNAL' AND upgraded_to IS NULL
                            AND "database" NOT IN {XS}""",
        "target_tables": """SELECT * FROM tinv WHERE table_schema <> 'information_schema' AND table_type = 'EXTERNAL'""",
    }
    for ot, a in (("EXTERNAL", "tables"), ("VIEW", "views")):
        h = f"""(SELECT "database" AS table_schema, "name" AS table_name FROM inv
                 WHERE object_type = '{ot}' AND "database" NOT IN {XS})"""
        u = f"""(SELECT table_schema, table_name FROM tinv
                 WHERE table_schema <> 'information_schema' AND table_type = '{ot}')"""
        checks[f"{a}_only_in_source"] = f"{h} EXCEPT ALL {u}"
        checks[f"{a}_only_in_target"] = f"{u} EXCEPT ALL {h}"
    sql["validation_summary"] = _with(MAN, INV, TINV) + "\nUNION ALL\n".join(
        f"SELECT '{k}' AS \"check\", count(*) AS objects FROM ({v})" for k, v in checks.items())
    sql["not_upgraded"] = _with(MAN, INV) + f"""
SELECT * FROM inv WHERE object_type = 'EXTERNAL' AND upgraded_to IS NULL AND "database" NOT IN {XS}"""
    sql["count_match"] = _with(ORDERS_V2) + """
SELECT 'orders' AS table_name, (SELECT count(*) FROM orders) AS source_rows, (SELECT count(*) FROM v2) AS target_rows,
       (SELECT count(*) FROM orders) = (SELECT count(*) FROM v2) AS "match"
UNION ALL
SELECT 'lineitem', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM lineitem), true"""
    sql["rows_only_in_source"] = _with(ORDERS_V2) + "SELECT * FROM orders EXCEPT ALL SELECT * FROM v2"
    sql["rows_only_in_target"] = _with(ORDERS_V2) + "SELECT * FROM v2 EXCEPT ALL SELECT * FROM orders"
    sql["rows_only_in_source_narrow"] = sql["rows_only_in_source"]
    sql["rows_only_in_target_narrow"] = sql["rows_only_in_target"]
    li2 = """li2 AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
    CASE WHEN (l_orderkey * 8 + l_linenumber) % 89 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
    l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate FROM lineitem)"""
    sql["lineitem_rows_diff"] = _with(li2) + """
SELECT *, 'source' AS side FROM (SELECT * FROM lineitem EXCEPT ALL SELECT * FROM li2)
UNION ALL
SELECT *, 'target' AS side FROM (SELECT * FROM li2 EXCEPT ALL SELECT * FROM lineitem)"""
    li_cols = [c for c, _ in TABLE_COLUMNS["lineitem"]]
    li3 = ",\n".join(c if c != "l_quantity" else
                     "CASE WHEN l_returnflag = 'R' THEN l_quantity + 1 ELSE l_quantity END AS l_quantity"
                     for c in li_cols)
    li3x = ", ".join(c if c != "l_linestatus" else "'X' AS l_linestatus" for c in li_cols)
    canon = "concat_ws(',', " + ", ".join(_canon(f'"{c}"', t) for c, t in TABLE_COLUMNS["lineitem"]) + ")"
    digest = f"CAST(CAST(('0x' || substr(md5({canon}), 1, 16)) AS UBIGINT) AS HUGEINT)"
    sql["partition_diff"] = f"""
WITH v2 AS (
  SELECT {li3} FROM lineitem WHERE NOT (l_returnflag = 'N' AND l_linestatus = 'O')
  UNION ALL SELECT {li3x} FROM lineitem WHERE l_orderkey % 50 = 0),
s AS (SELECT l_returnflag, l_linestatus, count(*) AS n, coalesce(sum({digest}), 0) AS h FROM lineitem GROUP BY ALL),
t AS (SELECT l_returnflag, l_linestatus, count(*) AS n, coalesce(sum({digest}), 0) AS h FROM v2 GROUP BY ALL)
SELECT coalesce(s.l_returnflag, t.l_returnflag) AS l_returnflag, coalesce(s.l_linestatus, t.l_linestatus) AS l_linestatus,
       CASE WHEN t.n IS NULL THEN 'missing' WHEN s.n IS NULL THEN 'extra' ELSE 'changed' END AS status,
       coalesce(s.n, 0) AS source_rows, coalesce(t.n, 0) AS target_rows
FROM s FULL JOIN t ON s.l_returnflag IS NOT DISTINCT FROM t.l_returnflag AND s.l_linestatus IS NOT DISTINCT FROM t.l_linestatus
WHERE t.n IS NULL OR s.n IS NULL OR s.n <> t.n OR s.h <> t.h"""
    vcols = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    differs = " OR ".join(f"s.{c} IS DISTINCT FROM t.{c}" for c in vcols)
    sql["keyed_diff"] = _with(ORDERS_V2) + f"""
SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
       CASE WHEN t.o_orderkey IS NULL THEN 'missing' WHEN s.o_orderkey IS NULL THEN 'extra' ELSE 'changed' END AS status,
       CASE WHEN s.o_orderkey IS NULL THEN 0 ELSE 1 END::BIGINT AS source_rows,
       CASE WHEN t.o_orderkey IS NULL THEN 0 ELSE 1 END::BIGINT AS target_rows
FROM orders s FULL JOIN v2a t ON s.o_orderkey = t.o_orderkey
WHERE s.o_orderkey IS NULL OR t.o_orderkey IS NULL OR {differs}"""
    plan = _plan_sql()
    sql["plan_status"] = plan + "SELECT * FROM plan"
    sql["plan_status_counts"] = plan + "SELECT status_code AS outcome, count(*) AS objects FROM plan GROUP BY 1"
    sql["report_ineligible"] = plan + """
SELECT source_schema, source_name, status_code, description FROM plan
WHERE status_code = 'MANAGED_SOURCE' AND NOT coalesce(lower(source_schema) = 'default', false)"""
    sql["report_other_ineligible"] = plan + """
SELECT source_schema, source_name, status_code, description FROM plan
WHERE status_code IN ('SOURCE_MISSING', 'TARGET_EXISTS')"""
    sql["rewrite_catalog"] = f"""
SELECT o_orderkey, regexp_replace('select * from `hive_metastore`.seg.orders_' || CAST(o_orderkey AS VARCHAR)
  || ' join hive_metastore.ref.t on my_hive_metastore_z = ''' || o_orderstatus || '''',
  '`?{SOURCE_CATALOG}`?', '`{CATALOG}`', 'g') AS new_text FROM orders"""
    sql["rewrite_references"] = _ref_texts()
    sql["rewrite_references_join"] = _ref_texts()
    sql["copy_orders"] = "SELECT * FROM orders"
    sql["copy_lineitem_partitioned"] = "SELECT * FROM lineitem"
    sql["copy_verify"] = "SELECT 'orders' AS table_name, s.row_count AS source_rows, s.checksum AS source_checksum, " \
                         "s.row_count AS target_rows, s.checksum AS target_checksum, true AS \"match\" FROM (" + \
                         _checksum_sql("orders") + ") s"
    sql["convert_report"] = """
SELECT 'orders' AS "name", 'CONVERTED_DROPPED' AS outcome, (SELECT count(*) FROM orders) AS source_rows,
       (SELECT count(*) FROM orders) AS target_rows
UNION ALL SELECT 'customer', 'CONVERTED_DROPPED', (SELECT count(*) FROM customer), (SELECT count(*) FROM customer)
UNION ALL SELECT 'supplier', 'SKIPPED_EXTERNAL', NULL, NULL
UNION ALL SELECT 'ghost', 'SOURCE_MISSING', NULL, NULL"""
    sql["convert_content"] = "SELECT * FROM orders"
    sql["convert_all_tables"] = "\nUNION ALL\n".join(
        f"SELECT '{t}' AS \"name\", 'CONVERTED_DROPPED' AS outcome, count(*) AS source_rows, count(*) AS target_rows "
        f"FROM {t}" for t in TABLES)
    # One outcome per table that has rows to convert; a copy is only proven when rows exist to compare.
    sql["report_counts"] = """
WITH made AS (SELECT 'CONVERTED_DROPPED' AS outcome, count(*) AS n FROM orders UNION ALL SELECT 'CONVERTED_DROPPED', count(*) FROM customer
              UNION ALL SELECT 'SKIPPED_EXTERNAL', count(*) FROM supplier UNION ALL SELECT 'SOURCE_MISSING', 1)
SELECT outcome, count(*) AS objects FROM made WHERE n > 0 GROUP BY outcome"""
    sql["migrate_dry_run"] = """
SELECT category, CAST(objects AS BIGINT) AS objects FROM (VALUES ('NOT_ELIGIBLE', 3), ('MANAGED_OUTSIDE_DEFAULT', 1), ('OTHER_NOT_ELIGIBLE', 2),
                      ('MIGRATED_TABLES', 1), ('FAILED_TABLES', 0), ('MIGRATED_VIEWS', 1), ('FAILED_VIEWS', 0))
  AS t(category, objects)"""
    sql["register_report"] = """
SELECT 'orders' AS "name", 'orders' AS target_table, 'REGISTERED' AS outcome,
       (SELECT count(*) FROM orders) AS source_rows, (SELECT count(*) FROM orders) AS target_rows
UNION ALL SELECT 'lineitem', 'lineitem_v2', 'REGISTERED', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM lineitem)"""
    sql["register_content"] = "SELECT * FROM lineitem"
    sql["migrate_views"] = "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus"
    sql["inventory"] = """
SELECT 'orders' AS "name", 'EXTERNAL' AS object_type, 'parquet' AS provider, false AS is_partitioned,
       (SELECT count(*) FROM orders) AS row_count
UNION ALL SELECT 'lineitem', 'EXTERNAL', 'parquet', true, (SELECT count(*) FROM lineitem)
UNION ALL SELECT 'customer', 'MANAGED', 'parquet', false, (SELECT count(*) FROM customer)
UNION ALL SELECT 'orders_by_status', 'VIEW', NULL, false, (SELECT count(DISTINCT o_orderstatus) FROM orders)"""
    sql["migrate_all"] = """
SELECT 'orders' AS "name", 'REGISTERED' AS outcome, (SELECT count(*) FROM orders) AS source_rows,
       (SELECT count(*) FROM orders) AS target_rows
UNION ALL SELECT 'part', 'REGISTERED', (SELECT count(*) FROM part), (SELECT count(*) FROM part)
UNION ALL SELECT 'part_sizes', 'VIEW_CREATED', NULL, NULL"""
    sql["split_by_flag"] = """
SELECT d.doc_id, d."text", d.lang, d."source", d.n_chars,
       CASE WHEN l.toxic = 0 THEN 'nonpii' ELSE 'pii' END AS route
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"""
    sql["checkpoint_csv_documents"] = "SELECT * FROM documents"
    sql["table_stats"] = "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, CAST(1 AS BIGINT) AS files, true AS size_known FROM {t}" for t in TABLES)
    sql["table_checksum_fast"] = "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, true AS \"match\" FROM {t}" for t in TABLES)
    sql["estimate_manifest"] = "\nUNION ALL\n".join(
        [f"SELECT '{t}' AS table_name, count(*) > 0 AS size_known, CAST(NULL AS VARCHAR) AS reason FROM {t}"
         for t in ("orders", "lineitem", "customer", "documents")]
        + ["SELECT 'part', false, 'NOT_MANAGED_EXTERNAL'", "SELECT 'ghost', false, 'SOURCE_MISSING'"])
    threads = """%s AS (
  SELECT conv_id, list({'turn': turn, 'a': %s, 'b': %s} ORDER BY turn) AS turns, max(turn) AS last
  FROM (SELECT conv_id, turn, role, CASE WHEN NOT (%s) THEN "text" END AS kept FROM conversations) GROUP BY conv_id)"""
    swap = "conv_id % 7 = 0 AND turn % 2 = 1"
    one = threads % ("one", "role", "kept", "turn % 3 = 0")
    two = threads % ("two", f"CASE WHEN {swap} THEN kept ELSE role END", f"CASE WHEN {swap} THEN role ELSE kept END",
                     "CASE WHEN conv_id % 4 = 0 THEN turn % 3 = 1 ELSE turn % 3 = 0 END")
    sides = """d AS (SELECT *, 'source' AS side FROM (SELECT * FROM one EXCEPT ALL SELECT * FROM two)
UNION ALL SELECT *, 'target' AS side FROM (SELECT * FROM two EXCEPT ALL SELECT * FROM one))"""
    sql["nested_rows_diff"] = _with(one, two, sides) + """
SELECT conv_id, array_to_string(list_transform(turns, lambda t: CAST(t.turn AS VARCHAR) || ':' || coalesce(md5(t.a), '-') || ':'
       || coalesce(md5(t.b), '-')), ',') AS turns, CAST(len(turns) AS BIGINT) AS n_turns, side, count(*) AS times
FROM d GROUP BY ALL"""
    sql["nested_rows_diff_narrow"] = _with(one, two, sides) + "SELECT conv_id, side FROM d"
    sql["nested_keyed_diff"] = _with(one, two) + """
SELECT one.conv_id, 'changed' AS status, CAST(1 AS BIGINT) AS source_rows, CAST(1 AS BIGINT) AS target_rows
FROM one JOIN two ON one.conv_id = two.conv_id WHERE one.turns IS DISTINCT FROM two.turns"""
    sql["view_chain"] = """
SELECT 'VIEW_CREATED' AS outcome, CAST(30 AS BIGINT) AS n
UNION ALL SELECT o_orderstatus, count(*) FROM orders GROUP BY o_orderstatus"""
    sql["register_text_partition"] = "SELECT *, lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS line FROM lineitem"
    sql["register_csv"] = "SELECT * FROM customer"
    sql["rewrite_long_literals"] = """
WITH q AS (SELECT doc_id, 'SELECT ' || chr(39) || 'db.a ' || replace(replace(coalesce("text", ''), chr(92), chr(92) || chr(92)),
           chr(39), chr(39) || chr(39)) || ' db.a' || chr(39) || ' AS t FROM x.y' AS t FROM documents)
SELECT doc_id, md5(t) AS new_md5, length(t) AS n_chars FROM q"""
    sql["manifest_yaml_documents"] = _with(MAN) + """
SELECT name AS "key", target_schema AS what, CAST(1 AS BIGINT) AS n FROM man
UNION ALL SELECT name, target_schema || '_2', 1 FROM man WHERE t_no % 5 = 0
UNION ALL SELECT name, 'DUPLICATE_YAML_KEY', 1 FROM man WHERE t_no % 5 = 0
UNION ALL SELECT 'name', 'DUPLICATE_YAML_KEY', sum(CASE WHEN t_no % 5 = 0 THEN 2 ELSE 1 END) FROM man WHERE t_no % 13 = 0"""
    sql["manifest_order"] = _with(MAN) + """
SELECT "database", name, CASE WHEN t_no % 17 <> 0 THEN t_no END AS t_no,
       row_number() OVER (ORDER BY CASE WHEN t_no % 17 <> 0 THEN t_no END NULLS LAST, "database", name) AS place
FROM man"""
    sql["type_changes"] = """
WITH c AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 211 = 0 OR o_orderkey % 223 = 0 OR o_orderkey % 227 = 0 OR o_orderkey % 229 = 0)
SELECT f.form, w.what, k AS "key" FROM c, (VALUES ('exact'), ('narrow')) f(form), (VALUES ('source'), ('target')) w(what)
UNION ALL SELECT 'keyed', 'changed', k FROM c
UNION ALL SELECT DISTINCT 'partitions', 'changed', k % 101 FROM c
UNION ALL SELECT 'schema', x, 1 FROM (VALUES ('customer widened'), ('day type_changed'), ('price widened'), ('small widened'), ('part widened')) v(x)"""
    sql["rows_diff_tree"] = """
WITH v2a AS (
  SELECT * REPLACE (CASE WHEN (l_orderkey * 7 + l_linenumber) % 13 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity)
  FROM lineitem WHERE (l_orderkey * 7 + l_linenumber) % 11 <> 0),
v2 AS (SELECT * FROM v2a UNION ALL SELECT * FROM v2a WHERE (l_orderkey * 7 + l_linenumber) % 29 = 0)
SELECT *, 'source' AS side FROM (SELECT * FROM lineitem EXCEPT ALL SELECT * FROM v2)
UNION ALL SELECT *, 'target' FROM (SELECT * FROM v2 EXCEPT ALL SELECT * FROM lineitem)"""
    sql["hot_repeats_diff"] = """
SELECT o_orderstatus, count(*) AS times FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1"""
    lines = " UNION ALL ".join(
        "SELECT '" + t + "' AS name, strlen(concat_ws('|', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in columns) + f")) + 1 AS b FROM {t}"
        for t, (columns, _) in TEXT_TABLES.items())
    sql["conversion_rates"] = f"""
SELECT name, 'CONVERTED_DROPPED' AS outcome, count(*) AS source_rows, CAST(sum(b) AS BIGINT) / 1e6 AS size_mb,
       TRUE AS rate_agrees, TRUE AS elapsed_agrees
FROM ({lines}) GROUP BY name"""
    sql["table_bytes"] = f"""
WITH s AS (SELECT name, count(*) AS row_count, CAST(sum(b) AS BIGINT) AS bytes FROM ({lines}) GROUP BY name
           UNION ALL SELECT 'nothing', 0, 0),
e AS (SELECT *, bytes / 1e6 AS size_mb, bytes / 1e6 * {RATE} AS seconds FROM s)
SELECT *, printf('%02d:%02d', CAST(floor(seconds / 60) AS BIGINT), CAST(floor(seconds - 60 * floor(seconds / 60)) AS BIGINT)) AS elapsed FROM e"""
    sql["copy_journal"] = """
WITH s AS (SELECT * FROM lineitem WHERE NOT (l_returnflag = 'N' AND l_linestatus = 'F'))
SELECT * FROM s UNION ALL SELECT * FROM s WHERE l_returnflag = 'A'"""
    sql["registered_declarations"] = """
WITH r AS (SELECT CAST(c_custkey AS VARCHAR) AS what, concat_ws('|', c_name, c_mktsegment, CAST(c_nationkey AS VARCHAR), c_name,
                                                              CAST(c_custkey % 3 AS VARCHAR)) AS value FROM customer)
SELECT 'c2' AS t, what, value FROM r UNION ALL SELECT 'c3', what, value FROM r
UNION ALL SELECT * FROM (VALUES ('c3', 'path', 'a\\b'), ('c3', 'q', 'o''neil'), ('c2', 'migration.owner', 'o''neil \\ co'),
    ('c2', 'k', 'bigint it''s'), ('c2', 'name', 'varchar(30)'), ('c2', 'seg', 'char(12)'), ('c2', 'n', 'struct<a-b:int,c:string>')) v(a, b, c)"""
    sql["rewrite_parsed"] = """
WITH s AS (SELECT s_suppkey, 't' || CAST(s_suppkey AS VARCHAR) AS t FROM supplier)
SELECT s_suppkey, CASE s_suppkey % 5
    WHEN 0 THEN 'SELECT seg.x FROM new.n_' || t || ' seg WHERE seg.x > 1'
    WHEN 1 THEN 'SELECT * FROM new.`q-' || t || '` -- old.' || t
    WHEN 2 THEN 'WITH c AS (SELECT new.n_' || t || '.x FROM new.n_' || t || ') SELECT ''old.' || t || ''' FROM c'
    WHEN 3 THEN 'SELECT old.' || t || ' FROM other old WHERE EXISTS (SELECT 1 FROM main.new.n_' || t || ')'
    ELSE 'SELECT new.n_' || t || '.* FROM new.n_' || t || ' JOIN x.y USING (id)' END AS new_text
FROM s"""
    sql["view_graph"] = """
WITH l AS (SELECT s_suppkey AS k FROM supplier WHERE s_suppkey % 20 = 7),
t AS (SELECT s_suppkey AS k, CAST(length(bin(s_suppkey)) - 1 AS INTEGER) AS level FROM supplier WHERE s_suppkey > 0)
SELECT 't.v' || CAST(k AS VARCHAR) AS "view", level, NULL AS cycle FROM t
UNION ALL
SELECT 't.' || x || CAST(k AS VARCHAR), (SELECT max(level) + 1 FROM t),
       't.a' || CAST(k AS VARCHAR) || ' -> t.b' || CAST(k AS VARCHAR) || ' -> t.a' || CAST(k AS VARCHAR)
FROM l, (VALUES ('a'), ('b')) y(x)"""
    sql["manifest_files"] = _with(MAN) + """
SELECT "database", "name", target_schema, target_table, is_pii, t_no, format
FROM man, (VALUES ('json'), ('csv'), ('yaml')) f(format)"""
    sql["view_manifest"] = _with(MAN) + """
SELECT "database" AS source_schema, "name" AS source_view, target_schema, target_table AS target_view FROM man"""
    sql["inventory_two_schemas"] = """
SELECT 'a' AS "schema", 'nation' AS "name", 'MANAGED' AS object_type, count(*) AS row_count FROM nation
UNION ALL SELECT 'b', 'region', 'EXTERNAL', count(*) FROM region
UNION ALL SELECT 'b', 'big', 'VIEW', NULL"""
    sql["migrate_new_schema"] = """
SELECT 'only_in_source' AS item, CAST(0 AS BIGINT) AS n
UNION ALL SELECT 'a_renamed', count(*) FROM orders
UNION ALL SELECT o_orderstatus, count(*) FROM orders GROUP BY o_orderstatus"""
    sql["checkpoint_csv"] = "SELECT * FROM customer"
    return sql
