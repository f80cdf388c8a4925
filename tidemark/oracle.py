"""DuckDB oracle SQL for every query in ``tidemark.workloads`` (same names, same columns).

Views ``region nation customer supplier part orders lineitem events documents
embeddings pages benchmark labels conversations`` are expected to exist.
DuckDB lists are 1-based (``[-1]`` is the last element).
"""

from __future__ import annotations

import datetime as _dt

# The expectations are written out here, apart from the code under test.
EXCLUDED_NAMES = ('DICOMDIR', 'dicomdir')
IMAGING_SUFFIX = ".dcm"
WORKSPACE_PATTERN = "abfss://([^@]+)@"
LAYERS = ('bronze', 'silver', 'platinum', 'gold')
DEFAULT_MAX_ITEMS = 10_000
AS_OF = _dt.datetime(2025, 1, 1)
API_BASE = "https://api.example.com/v1/"
DATE_CUTOFF = "1997-01-01"
EVENTS_HISTORY_CUTOFF = "2024-01-15"
MANIFEST_HISTORY_CUTOFF = "1995-06-01"
PIPELINE_NAME = "imaging_ingestion"
RUN_ID = "run-0001"
ROUTE_PROBE_FOLDER = "Customer#000000002"
ROUTE_PROBE_LAYER = "silver"
SOURCE_DIR = "/lake/Files/External/Imaging/DICOM/input"
TARGET_DIR = "/lake/Files/Ingest/Imaging/DICOM"
STAND_IN_APIS = ("click", "view", "purchase")


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


EXCL = _in(EXCLUDED_NAMES)
APIS = _in(STAND_IN_APIS)
AS_OF_SQL = f"TIMESTAMP '{AS_OF:%Y-%m-%d %H:%M:%S}'"
DATE_CUT = f"TIMESTAMP '{DATE_CUTOFF}'"
EV_CUT = f"TIMESTAMP '{EVENTS_HISTORY_CUTOFF}'"
LAYER_LIST = "[" + ", ".join(_q(x) for x in LAYERS) + "]"

PAGES_MANIFEST = """
  SELECT page_id, url AS path,
         string_split(rtrim(url, '/'), '/')[-1] AS name,
         string_split(regexp_replace(rtrim(url, '/'), '/[^/]*$', ''), '/')[-1] AS folder,
         url LIKE '%/' AS is_dir
  FROM pages"""

LINEITEM_MANIFEST = f"""
  li AS (SELECT strftime(l_shipdate, '%Y%m%d') AS folder,
                'IM' || l_orderkey || '_' || l_linenumber
                || CASE WHEN l_returnflag = 'R' THEN '.dcm' ELSE '' END AS name
         FROM lineitem),
  m AS (SELECT folder, name FROM li
        UNION ALL SELECT DISTINCT folder, 'DICOMDIR' AS name FROM li)"""

EVENT_FOLDERS = f"""
  f AS (SELECT strftime(ts, '%Y%m%d') AS folder, count(*) AS n_files FROM events GROUP BY 1),
  h AS (SELECT DISTINCT strftime(ts, '%Y%m%d') AS source_folder FROM events WHERE ts < {EV_CUT})"""

NATION_MAPPING = f"""
  mp AS (SELECT CAST(n_nationkey AS VARCHAR) AS folder,
                {LAYER_LIST}[n_regionkey + 1] AS layer,
                lower(n_name) AS "table",
                'Files/Ingest/' || lower(n_name) AS source_file_path,
                'Tables/' || lower(n_name) AS full_target_path,
                'Files/Processed/' || lower(n_name) AS processed_file_path,
                'Files/Failed/' || lower(n_name) AS failed_file_path
         FROM nation)"""

ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, {d} AS o_orderdate, o_orderpriority"


def _date_case(fix: str) -> str:
    return f"CASE WHEN o_orderdate < {DATE_CUT} THEN {fix} ELSE o_orderdate END"


def _fp_part(expr: str) -> str:
    return f"coalesce(CAST({expr} AS VARCHAR), 'null')"


PAGE_FILES = """
  SELECT string_split(regexp_replace(rtrim(url, '/'), '/[^/]*$', ''), '/')[-1] AS folder,
         'p' || page_id || '_' || regexp_replace(string_split(rtrim(url, '/'), '/')[-1],
                                                 '[^A-Za-z0-9._-]', '_', 'g') AS name,
         html
  FROM pages"""

STAGED_HISTORY = f"""
WITH f AS ({PAGE_FILES})
SELECT folder AS source_folder,
       count(*) FILTER (WHERE NOT contains(name, '.')) AS total_files_processed,
       CAST(0 AS BIGINT) AS files_failed
FROM f GROUP BY folder"""

# An order date in four ways of writing, by order key; t is what a reader of dates makes of it.
TEXT_ORDERS = """
  SELECT o_orderkey,
         CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
                             WHEN 1 THEN strftime(o_orderdate, '%m/%d/%Y')
                             WHEN 2 THEN strftime(o_orderdate, '%Y%m%d')
                             ELSE 'on day ' || dayofyear(o_orderdate) END AS d,
         CASE o_orderkey % 4 WHEN 0 THEN date_trunc('second', o_orderdate)
                             WHEN 3 THEN NULL ELSE date_trunc('day', o_orderdate) END AS t
  FROM orders"""


def _text_dates(repaired: str) -> str:
    return (f"WITH x AS ({TEXT_ORDERS}) SELECT o_orderkey, {repaired} AS d, "
            "CASE WHEN t IS NULL THEN d END AS d_unparsed FROM x")


# Definitions of the events' tables; the rows of a run in the order of their keys.
DEFINITIONS = f"""
  e AS (SELECT event_type || '_' || user_id AS tableName,
               '{{"' || array_to_string(list_sort(json_keys(props)), ',') || '": "decimal('
                 || length(json_extract_string(props, '$.k')) || ')"}}' AS schemaDefinition,
               {LAYER_LIST}[user_id % 4 + 1] AS layer, event_type AS namespace, ts FROM events),
  k AS (SELECT tableName, schemaDefinition, min(layer) AS layer, min(namespace) AS namespace,
               bool_or(ts < {EV_CUT}) AS early FROM e GROUP BY 1, 2),
  r AS (SELECT row_number() OVER (ORDER BY NOT early, tableName, schemaDefinition) AS id, * FROM k)"""


ORACLE_SQL = {
    "staging_plan": f"""
WITH m AS ({PAGES_MANIFEST})
SELECT page_id, path, name, folder, is_dir,
       CASE WHEN is_dir THEN 'directory' WHEN name IN {EXCL} THEN 'excluded'
            WHEN NOT contains(name, '.') THEN 'copy' ELSE 'has_extension' END AS action,
       CASE WHEN NOT is_dir AND name NOT IN {EXCL} AND NOT contains(name, '.')
            THEN {_q(TARGET_DIR)} || '/' || folder || '/' || name || {_q(IMAGING_SUFFIX)} END AS new_path
FROM m""",

    "staging_counts": f"""
WITH {LINEITEM_MANIFEST},
todo AS (SELECT * FROM m WHERE NOT EXISTS (
           SELECT 1 FROM (SELECT DISTINCT folder AS source_folder FROM m
                          WHERE folder < {_q(MANIFEST_HISTORY_CUTOFF.replace('-', ''))}) h
           WHERE h.source_folder = m.folder))
SELECT folder,
       count(*) FILTER (WHERE name NOT IN {EXCL} AND NOT contains(name, '.')) AS to_copy,
       count(*) FILTER (WHERE name IN {EXCL}) AS excluded,
       count(*) FILTER (WHERE name NOT IN {EXCL} AND contains(name, '.')) AS has_extension
FROM todo GROUP BY folder""",

    "staging_hot_folders": f"""
WITH li AS (SELECT l_returnflag AS folder,
                   'IM' || l_orderkey || '_' || l_linenumber
                   || CASE WHEN l_linestatus = 'F' THEN '.dcm' ELSE '' END AS name
            FROM lineitem),
m AS (SELECT folder, name FROM li UNION ALL SELECT DISTINCT folder, 'DICOMDIR' AS name FROM li),
todo AS (SELECT * FROM m WHERE folder <> 'A' OR folder IS NULL)
SELECT folder,
       count(*) FILTER (WHERE name NOT IN {EXCL} AND NOT contains(name, '.')) AS to_copy,
       count(*) FILTER (WHERE name IN {EXCL}) AS excluded,
       count(*) FILTER (WHERE name NOT IN {EXCL} AND contains(name, '.')) AS has_extension
FROM todo GROUP BY folder""",

    "dirs_with_files": """
SELECT DISTINCT regexp_replace(url, '/[^/]*$', '') AS directory FROM pages WHERE url NOT LIKE '%/'""",

    "path_parts": f"""
SELECT page_id,
       string_split(url, '/')[-1] AS last_part,
       string_split(rtrim(url, '/'), '/')[-1] AS last_folder,
       string_split(url, '/')[4] AS segment_3,
       string_split(url, '/')[10] AS segment_9,
       CASE WHEN regexp_matches(url, {_q(WORKSPACE_PATTERN)})
            THEN regexp_extract(url, {_q(WORKSPACE_PATTERN)}, 1) END AS workspace,
       CASE WHEN regexp_matches(url, '://www\\.([^/]+)')
            THEN regexp_extract(url, '://www\\.([^/]+)', 1) END AS www_host
FROM pages""",

    "unprocessed_folders": f"""
WITH {EVENT_FOLDERS}
SELECT folder, n_files FROM f WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.source_folder = f.folder)""",

    "seen_folders": f"""
WITH {EVENT_FOLDERS}
SELECT folder, n_files, EXISTS (SELECT 1 FROM h WHERE h.source_folder = f.folder) AS processed FROM f""",

    "route_sources": f"""
WITH {NATION_MAPPING},
r AS (SELECT * FROM mp WHERE layer = 'bronze'),
c AS (SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS folder FROM customer)
SELECT c.c_custkey, c.folder, r."table", r.source_file_path, r.full_target_path,
       r.processed_file_path, r.failed_file_path
FROM c LEFT JOIN r ON c.folder = r.folder""",

    "route_first": f"""
SELECT lower(c.c_mktsegment) AS "table", 'Files/Ingest/' || c.c_name AS source_file_path,
       'Tables/' || lower(c.c_mktsegment) AS full_target_path,
       'Files/Processed/' || c.c_name AS processed_file_path,
       'Files/Failed/' || c.c_name AS failed_file_path
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE c.c_name = {_q(ROUTE_PROBE_FOLDER)} AND {LAYER_LIST}[n.n_regionkey + 1] = {_q(ROUTE_PROBE_LAYER)}
LIMIT 1""",

    "row_fingerprint": f"""
SELECT *, sha256('{{' || {_fp_part('c_custkey')} || ', ' || {_fp_part('c_name')} || ', '
                 || {_fp_part('c_nationkey')} || ', ' || {_fp_part('c_acctbal')} || ', '
                 || {_fp_part('c_mktsegment')} || '}}') AS hash
FROM customer""",

    "strict_fingerprint": """
SELECT *, sha256('{"c_custkey":' || coalesce(CAST(c_custkey AS VARCHAR), 'null')
                 || ',"c_name":' || coalesce(CAST(to_json(c_name) AS VARCHAR), 'null')
                 || ',"c_nationkey":' || coalesce(CAST(c_nationkey AS VARCHAR), 'null')
                 || ',"c_acctbal":' || coalesce(CAST(c_acctbal AS VARCHAR), 'null')
                 || ',"c_mktsegment":' || coalesce(CAST(to_json(c_mktsegment) AS VARCHAR), 'null')
                 || '}') AS hash
FROM customer""",

    "dates_sentinel": f"""
SELECT {ORDER_COLS.format(d=_date_case("TIMESTAMP '1900-01-01 00:00:00'"))} FROM orders""",

    "dates_null": f"""
SELECT {ORDER_COLS.format(d=_date_case("NULL"))} FROM orders""",

    "dates_shift": f"""
SELECT {ORDER_COLS.format(d=_date_case(
        f"o_orderdate + to_years(CAST({DATE_CUTOFF[:4]} - year(o_orderdate) AS INTEGER))"))} FROM orders""",

    "dates_quarantine": f"""
SELECT *, coalesce(o_orderdate < {DATE_CUT}, false) AS quarantined FROM orders""",

    "dates_drop": f"""
SELECT * FROM orders WHERE NOT coalesce(o_orderdate < {DATE_CUT}, false)""",

    "hourly_volume": """
SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n FROM events GROUP BY 1""",

    "hourly_volume_by_policy": f"""
SELECT 'sentinel' AS policy,
       CAST(hour(CASE WHEN ts < {EV_CUT} THEN TIMESTAMP '1900-01-01 00:00:00' ELSE ts END) AS INTEGER) AS hour,
       count(*) AS n
FROM events GROUP BY 1, 2
UNION ALL
SELECT 'shift' AS policy,
       CAST(hour(CASE WHEN ts < {EV_CUT}
                      THEN ts + to_years(CAST({EVENTS_HISTORY_CUTOFF[:4]} - year(ts) AS INTEGER))
                      ELSE ts END) AS INTEGER) AS hour,
       count(*) AS n
FROM events GROUP BY 1, 2""",

    "quote_swap": """
SELECT doc_id, replace(text, '''', '"') AS prepared,
       replace(replace(text, '''', '"'), '"', '''') AS restored,
       replace(replace(text, '''', '"'), '"', '''') = text AS roundtrip_ok
FROM documents""",

    "landing_name": f"""
SELECT event_id, event_type AS api, event_type IN {APIS} AS known_api,
       coalesce(CASE WHEN event_type IN {APIS} THEN 'U' || user_id END, 'None')
         || '-' || strftime(ts, '%m-%d-%Y') || '.json' AS landing_name,
       {_q(API_BASE)} || event_type || '?' || 'symbol=U' || user_id AS url
FROM events""",

    "request_stats": f"""
SELECT event_id, ts AS start_time,
       ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) AS end_time,
       CAST(CAST(round(value * 1000000) AS BIGINT) AS DOUBLE) / 1000000.0 AS elapsed_time,
       CAST(strlen(props) AS INTEGER) AS size,
       {_q(API_BASE)} || event_type || '?' || 'id=' || event_id AS url
FROM events""",

    "union_history": f"""
WITH c AS (SELECT strftime(o_orderdate, '%Y%m%d') AS folder, count(*) AS total_files_processed
           FROM orders GROUP BY 1)
SELECT sha256({_q(SOURCE_DIR)} || '|' || folder) AS id, {_q(SOURCE_DIR)} AS source_dir,
       {_q(TARGET_DIR)} AS target_dir, folder AS source_folder, total_files_processed,
       {AS_OF_SQL} AS processed_dttm, CAST(0 AS BIGINT) AS files_failed
FROM c""",

    "merge_schema_append": """
SELECT s_suppkey, s_name, s_nationkey, CAST(NULL AS DOUBLE) AS s_acctbal FROM supplier
UNION ALL
SELECT s_suppkey, s_name, CAST(NULL AS INTEGER) AS s_nationkey, s_acctbal FROM supplier""",

    "json_roundtrip": "SELECT * FROM orders",

    "csv_roundtrip": "SELECT * FROM customer",

    "disposition_plan": """
SELECT page_id,
       CASE WHEN contains(html, '</html>') THEN 'processed' ELSE 'failed' END AS status,
       CASE WHEN contains(html, '</html>') THEN '/lake/Files/Processed/pages'
            ELSE '/lake/Files/Failed/pages' END || '/' || string_split(rtrim(url, '/'), '/')[-1] AS new_path
FROM pages""",

    "audit_columns": f"""
SELECT *, {_q(PIPELINE_NAME)} AS _createdByPipelineName, {_q(RUN_ID)} AS _createdByPipelineRunID,
       {AS_OF_SQL} AS _lastModifieddttm
FROM orders""",

    "tag_extract": """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
       json_extract_string(props, '$.k') AS k_text
FROM events""",

    "nest_documents": """
SELECT o.o_custkey, count(DISTINCT o.o_orderkey) AS n_orders, count(l.l_orderkey) AS n_lines,
       round(coalesce(sum(l.l_quantity), 0.0), 2) AS sum_qty
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
GROUP BY o.o_custkey""",

    "nest_hot_keys": f"""
SELECT l_returnflag,
       CASE WHEN count(*) > {DEFAULT_MAX_ITEMS}
            THEN CAST(ceil(count(*) / {DEFAULT_MAX_ITEMS}.0) AS BIGINT) ELSE CAST(1 AS BIGINT) END AS n_docs,
       count(*) AS n_items, round(sum(l_quantity), 2) AS sum_qty, true AS parts_bounded
FROM lineitem GROUP BY l_returnflag""",

    "flatten_documents": """
SELECT o.o_custkey, o.o_orderkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate, o.o_orderpriority,
       l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity, l.l_extendedprice, l.l_discount,
       l.l_tax, l.l_returnflag, l.l_linestatus, l.l_shipdate
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey""",

    "ingest_documents": f"""
SELECT *, CAST(NULL AS VARCHAR) AS _corrupt_record,
       {_q(PIPELINE_NAME)} AS _createdByPipelineName, {_q(RUN_ID)} AS _createdByPipelineRunID,
       {AS_OF_SQL} AS _lastModifieddttm
FROM orders""",

    "history_run": STAGED_HISTORY,

    "move_and_verify": f"""
WITH f AS ({PAGE_FILES})
SELECT name, true AS ok, CAST(strlen(html) AS BIGINT) AS bytes, sha256(html) AS checksum, true AS arrived FROM f""",

    "ranged_copies": f"""
WITH f AS ({PAGE_FILES})
SELECT name, true AS ok, CAST(strlen(html) AS BIGINT) AS bytes, sha256(html) AS checksum, true AS ok_again,
       sha256(html) AS checksum_again, sha256(html) AS there
FROM f""",

    "incremental_ingest": STAGED_HISTORY,

    "staged_contents": f"""
WITH f AS ({PAGE_FILES})
SELECT folder || '/' || name || {_q(IMAGING_SUFFIX)} AS rel, CAST(strlen(html) AS BIGINT) AS length,
       sha256(html) AS checksum
FROM f WHERE NOT contains(name, '.')""",

    "audit_now": "SELECT o_orderkey, true AS stamped_now FROM orders",

    "dates_text_sentinel": _text_dates(f"CASE WHEN t < {DATE_CUT} THEN TIMESTAMP '1900-01-01 00:00:00' ELSE t END"),
    "dates_text_null": _text_dates(f"CASE WHEN t < {DATE_CUT} THEN NULL ELSE t END"),
    "dates_text_shift": _text_dates(
        f"CASE WHEN t < {DATE_CUT} THEN t + to_years(1997 - CAST(year(t) AS INTEGER)) ELSE t END"),
    "dates_text_drop": f"""
WITH x AS ({TEXT_ORDERS}) SELECT o_orderkey, d FROM x WHERE t IS NULL OR NOT t < {DATE_CUT}""",
    "dates_text_quarantine": f"""
WITH x AS ({TEXT_ORDERS}) SELECT o_orderkey, d, (t IS NULL OR t < {DATE_CUT}) AS quarantined FROM x""",

    "nest_small_bound": """
SELECT o.o_custkey, count(DISTINCT o.o_orderkey) AS n_orders, count(l.l_orderkey) AS n_lines,
       round(coalesce(sum(l.l_quantity), 0.0), 2) AS sum_qty
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
GROUP BY o.o_custkey""",

    "nest_equal_items": """
SELECT event_type, count(*) AS n_items, CAST(sum(hour(ts)) AS BIGINT) AS sum_hours, true AS parts_bounded
FROM events GROUP BY event_type""",

    "bronze_job": """
SELECT event_type AS "table", count(*) AS n_rows, CAST(sum(event_id) AS BIGINT) AS sum_ids,
       count(DISTINCT (event_id, user_id)) AS n_hashes, 'processed' AS first_run, 'refused' AS second_run
FROM events GROUP BY event_type""",

    "registry_lookup": f"""
WITH e AS (SELECT event_type AS tableName, ts,
                  array_to_string(list_sort(json_keys(props)), ',') AS schemaDefinition FROM events)
SELECT tableName, schemaDefinition, count(*) AS n_events, bool_or(ts < {EV_CUT}) AS registered
FROM e GROUP BY 1, 2""",

    "history_exactly_once": STAGED_HISTORY,

    "tree_listing": f"""
WITH f AS ({PAGE_FILES}),
p AS (SELECT CASE WHEN CAST(regexp_extract(name, '^p([0-9]+)_', 1) AS BIGINT) % 10 = 0 THEN 'few/' || folder
                  ELSE 'many/d' || CAST(regexp_extract(name, '^p([0-9]+)_', 1) AS BIGINT) // 10 || '/' || folder END AS dir,
             name, html FROM f)
SELECT dir || '/' || name AS rel, false AS is_dir, CAST(strlen(html) AS BIGINT) AS length FROM p
UNION ALL
SELECT DISTINCT array_to_string(string_split(dir, '/')[1:i], '/') AS rel, true AS is_dir, CAST(NULL AS BIGINT) AS length
FROM p, unnest(range(1, len(string_split(dir, '/')) + 1)) AS u(i)""",

    "landing_files": f"""
SELECT event_id, user_id, value, event_type AS api,
       coalesce(CASE WHEN event_type IN {APIS} THEN 'U' || (user_id % 10) END, 'None')
         || '-' || strftime(ts, '%m-%d-%Y') || '.json' AS file, true AS bounded
FROM events""",

    "registry_runs": f"""
WITH {DEFINITIONS}
SELECT id, tableName, layer, namespace, schemaDefinition,
       CASE WHEN early THEN 'run-0001' ELSE 'run-0002' END AS _createdByPipelineRunID,
       replace(schemaDefinition, '"', '''') AS restored
FROM r""",

    "registry_first": f"""
WITH {DEFINITIONS} SELECT id, tableName, layer, namespace, schemaDefinition FROM r WHERE id = 1""",

    "layer_domain": f"""
WITH c AS (SELECT c_custkey, coalesce({LAYER_LIST}[n_regionkey + 1], lower(c_mktsegment)) AS layer
           FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)
SELECT c_custkey, layer, layer IN {_in(LAYERS)} AS valid FROM c""",

    "epoch_to_utc": "SELECT event_id, epoch_us(ts) AS micros FROM events",

    "typed_appends": """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       CAST(o_totalprice AS DOUBLE) AS o_totalprice, CAST(NULL AS VARCHAR) AS o_orderstatus
FROM orders WHERE o_orderkey % 3 = 0
UNION ALL
SELECT o_orderkey, CAST(o_custkey AS VARCHAR), CAST(floor(o_totalprice) AS DOUBLE), NULL FROM orders WHERE o_orderkey % 3 = 1
UNION ALL
SELECT o_orderkey, 'C' || o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderkey % 3 = 2""",

    "variant_props": """
WITH e AS (SELECT event_id, event_id % 5 AS i, json_extract_string(props, '$.k') AS k FROM events)
SELECT event_id, CASE i WHEN 0 THEN k WHEN 1 THEN 't' || k WHEN 2 THEN '{"v":' || k || '}' END AS k,
       CASE i WHEN 3 THEN CAST(k AS DOUBLE) + 0.5 END AS other, i = 4 AS broken
FROM e""",

    "variant_documents": """
SELECT o.o_custkey, o.o_orderkey, o.o_orderstatus, o.o_totalprice, CAST(l.l_linenumber AS BIGINT) AS l_linenumber, l.l_quantity,
       l.l_returnflag, (SELECT count(*) FROM customer) AS rejects
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey""",

    "late_children": """
SELECT l_orderkey, count(*) AS n_items, string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber) AS line_numbers,
       round(sum(l_quantity), 2) AS sum_qty
FROM lineitem GROUP BY l_orderkey""",

    "bucketed_history": f"""
SELECT 'C' || o_custkey AS folder, count(*) AS n_orders FROM orders
GROUP BY o_custkey HAVING NOT bool_or(o_orderdate < {DATE_CUT})""",

    "canonical_fingerprint": """
WITH l AS (SELECT l_orderkey, string_agg('{"l_linenumber":' || l_linenumber || ',"l_quantity":' || l_quantity
                  || ',"l_returnflag":"' || l_returnflag || '"}', ',' ORDER BY l_linenumber, l_quantity, l_returnflag) AS lines
           FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey, sha256('{"o_orderkey":' || o_orderkey || ',"lines":[' || lines || '],"tags":[{"key":"priority","value":"'
         || o_orderpriority || '"},{"key":"status","value":"' || o_orderstatus || '"}]}') AS hash, true AS same
FROM orders JOIN l ON l_orderkey = o_orderkey""",
}
