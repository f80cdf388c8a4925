"""Registered queries over the driver's test tables, each with a DuckDB oracle.

Every query reads whole tables (or data Spark derives from them); the test
tables stand in for the objects of an ingestion run:

* ``pages.url`` is a file path (a trailing ``/`` marks a directory entry);
* ``lineitem`` becomes a file manifest of dated folders (``yyyyMMdd``), one
  image per line item plus one ``DICOMDIR`` per folder;
* ``events`` days are landing folders, ``event_type`` an API, ``props`` a
  JSON payload, ``ts`` the request clock;
* ``orders`` carry the dates to repair and are the parents of nested
  documents whose children are ``lineitem`` rows;
* ``customer`` x ``nation`` is routing (``n_regionkey`` plays the layer).


Column names and types of each query equal those of its oracle SQL.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import MapType, StringType

from tidemark.functions import paths as P
from tidemark.functions import text as T
from tidemark.functions.fingerprint import add_hash_column, canonical, canonical_fingerprint, strict_fingerprint
from tidemark.operators.audit import add_audit_columns
from tidemark.operators.dates import (flag_quarantine, hourly_volume, hourly_volume_by_policy, read_quarantine,
                                      repair_ancient_dates, write_quarantine)
from tidemark.operators.doctable import DocumentTable
from tidemark.operators.documents import (DEFAULT_MAX_ITEMS, extract_tags, flatten_all, nest,
                                          nest_two_levels)
from tidemark.operators.files import execute_transfers, plan_copy, plan_disposition
from tidemark.operators.lookup import (
    bounded_broadcast, route_all, route_first, rows_of_unprocessed_folders, schema_exists, seen_folders,
    unprocessed_folders)
from tidemark.operators.registry import read_registry, registry_first, registry_merge
from tidemark.plans.bronze import run_bronze_job
from tidemark.plans.imaging import move_and_verify
from tidemark.plans.staging import (create_history, history_records, log_folders, read_history, run_staging,
                                    staging_counts as _staging_counts, union_history)
from tidemark.session import shared_path
from tidemark.sinks.writers import append_bronze, land_files, land_rows, read_bronze, write_ndjson
from tidemark.sources.files import dirs_with_files as _dirs_with_files, list_tree, relative_parts, with_path_parts
from tidemark.sources.readers import load_data, read_documents
from tidemark.sources.typed import read_typed
from tidemark.sources.variants import as_columns, flatten_found, parse_variants, read_variants
from tidemark.streaming.incremental import incremental_staging

# Parameters of the stand-in runs
TARGET_DIR = "/lake/Files/Ingest/Imaging/DICOM"
SOURCE_DIR = "/lake/Files/External/Imaging/DICOM/input"
DATE_CUTOFF = "1997-01-01"          # orders: dates before it are "ancient"
EVENTS_HISTORY_CUTOFF = "2024-01-15"  # events: days before it were processed earlier
MANIFEST_HISTORY_CUTOFF = "1995-06-01"  # lineitem manifest: folders before it were staged earlier
AS_OF = _dt.datetime(2025, 1, 1, 0, 0, 0)
PIPELINE_NAME = "imaging_ingestion"
RUN_ID = "run-0001"
API_BASE = "https://api.example.com/v1/"
STAND_IN_APIS = ("click", "view", "purchase")
ROUTE_PROBE_FOLDER = "Customer#000000002"
ROUTE_PROBE_LAYER = "silver"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- stand-in inputs ---------------------------------------------------------

def pages_manifest(spark, sf_dir) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("path"))
    return with_path_parts(pages)


def lineitem_manifest(spark, sf_dir) -> DataFrame:
    """A file manifest derived from lineitem: one file per line item in its ship
    day's folder, named ``IM<orderkey>_<linenumber>`` (``.dcm`` already for
    returned items), plus one ``DICOMDIR`` per folder."""
    li = table(spark, sf_dir, "lineitem")
    folder = F.date_format("l_shipdate", "yyyyMMdd")
    name = F.concat(F.lit("IM"), F.col("l_orderkey"), F.lit("_"), F.col("l_linenumber"),
                    F.when(F.col("l_returnflag") == "R", F.lit(".dcm")).otherwise(F.lit("")))
    images = li.select(folder.alias("folder"), name.alias("name"))
    dirs = images.select("folder").distinct().withColumn("name", F.lit("DICOMDIR"))
    files = images.unionByName(dirs)
    return files.select(P.join_path(SOURCE_DIR, F.col("folder"), F.col("name")).alias("path"),
                        "name", "folder", F.lit(False).alias("is_dir"))


def event_folders(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.groupBy(F.date_format("ts", "yyyyMMdd").alias("folder")).agg(
        F.count(F.lit(1)).alias("n_files"))


def event_history(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events").filter(
        F.col("ts") < F.lit(EVENTS_HISTORY_CUTOFF).cast("timestamp_ntz"))
    return ev.select(F.date_format("ts", "yyyyMMdd").alias("source_folder")).distinct()


def nation_mapping(spark, sf_dir) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    t = F.lower(F.col("n_name"))
    return n.select(
        F.col("n_nationkey").cast("string").alias("folder"),
        F.get(F.array(*[F.lit(x) for x in T.LAYERS]), F.col("n_regionkey")).alias("layer"),
        t.alias("table"),
        F.concat(F.lit("Files/Ingest/"), t).alias("source_file_path"),
        F.concat(F.lit("Tables/"), t).alias("full_target_path"),
        F.concat(F.lit("Files/Processed/"), t).alias("processed_file_path"),
        F.concat(F.lit("Files/Failed/"), t).alias("failed_file_path"),
    )


def page_file_names(spark, sf_dir) -> DataFrame:
    """``folder`` (language segment), a file-system-safe unique ``name`` and the
    page ``html`` as content, for every page."""
    p = table(spark, sf_dir, "pages")
    trimmed = F.regexp_replace("url", "/+$", "")
    raw = P.last_segment(trimmed)
    return p.select(
        P.last_segment(P.parent_dir(trimmed)).alias("folder"),
        F.concat(F.lit("p"), F.col("page_id"), F.lit("_"),
                 F.regexp_replace(raw, "[^A-Za-z0-9._-]", "_")).alias("name"),
        F.col("html").alias("content"))


def land_pages(spark, sf_dir, root: str, with_dicomdir: bool = True) -> DataFrame:
    """Materialize pages as an imaging drop: ``<root>/<folder>/<name>`` plus,
    optionally, one ``DICOMDIR`` index per folder. Returns the outcomes."""
    files = page_file_names(spark, sf_dir)
    if with_dicomdir:
        index = files.select("folder").distinct().select(
            "folder", F.lit("DICOMDIR").alias("name"), F.lit("DICM").alias("content"))
        files = files.unionByName(index)
    return land_files(files, root, "folder", "name", "content")


# --- queries -------------------------------------------------------------------

def q_staging_plan(spark, sf_dir):
    plan = plan_copy(pages_manifest(spark, sf_dir), TARGET_DIR, "nested")
    return plan.select("page_id", "path", "name", "folder", "is_dir", "action", "new_path")


def q_staging_counts(spark, sf_dir):
    manifest = lineitem_manifest(spark, sf_dir)
    # the day folders shipped before the cutoff were staged by earlier runs
    history = (table(spark, sf_dir, "lineitem")
               .filter(F.col("l_shipdate") < F.lit(MANIFEST_HISTORY_CUTOFF).cast("timestamp_ntz"))
               .select(F.date_format("l_shipdate", "yyyyMMdd").alias("source_folder")).distinct())
    todo = rows_of_unprocessed_folders(manifest, history, "folder", "source_folder")
    return _staging_counts(plan_copy(todo, TARGET_DIR, "nested"))


def q_staging_hot_folders(spark, sf_dir):
    """Staging counts when each folder holds a third of all files: line items
    filed under their return flag (``.dcm`` already for closed lines), one
    ``DICOMDIR`` per folder; folder ``A`` was staged by an earlier run."""
    li = table(spark, sf_dir, "lineitem")
    name = F.concat(F.lit("IM"), F.col("l_orderkey"), F.lit("_"), F.col("l_linenumber"),
                    F.when(F.col("l_linestatus") == "F", F.lit(".dcm")).otherwise(F.lit("")))
    images = li.select(F.col("l_returnflag").alias("folder"), name.alias("name"))
    files = images.unionByName(
        images.select("folder").distinct().withColumn("name", F.lit("DICOMDIR")))
    history = li.filter(F.col("l_returnflag") == "A").select(
        F.col("l_returnflag").alias("source_folder")).distinct()
    todo = rows_of_unprocessed_folders(files, history, "folder", "source_folder")
    return _staging_counts(plan_copy(todo, TARGET_DIR, "nested"))


def q_dirs_with_files(spark, sf_dir):
    return _dirs_with_files(pages_manifest(spark, sf_dir))


def q_path_parts(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        P.last_segment(url).alias("last_part"),
        P.last_segment(url, rtrim_slash=True).alias("last_folder"),
        P.lakehouse_id(url).alias("segment_3"),
        P.nth_segment(url, 9).alias("segment_9"),
        P.workspace_id(url).alias("workspace"),
        P.regex_group(url, r"://www\.([^/]+)", 1).alias("www_host"),
    )


def q_unprocessed_folders(spark, sf_dir):
    return unprocessed_folders(event_folders(spark, sf_dir), event_history(spark, sf_dir))


def q_seen_folders(spark, sf_dir):
    return seen_folders(event_folders(spark, sf_dir), event_history(spark, sf_dir))


def q_route_sources(spark, sf_dir):
    probe = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("string").alias("folder"))
    return route_all(probe, nation_mapping(spark, sf_dir), "folder", "bronze").drop("_routed")


def customer_mapping(spark, sf_dir) -> DataFrame:
    """A routing table that grows with the data: one route per customer folder,
    the layer taken from the customer's nation's region."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    seg = F.lower(F.col("c_mktsegment"))
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        F.col("c_name").alias("folder"),
        F.get(F.array(*[F.lit(x) for x in T.LAYERS]), F.col("n_regionkey")).alias("layer"),
        seg.alias("table"),
        F.concat(F.lit("Files/Ingest/"), F.col("c_name")).alias("source_file_path"),
        F.concat(F.lit("Tables/"), seg).alias("full_target_path"),
        F.concat(F.lit("Files/Processed/"), F.col("c_name")).alias("processed_file_path"),
        F.concat(F.lit("Files/Failed/"), F.col("c_name")).alias("failed_file_path"),
    )


def q_route_first(spark, sf_dir):
    return route_first(customer_mapping(spark, sf_dir), ROUTE_PROBE_FOLDER, ROUTE_PROBE_LAYER)


def q_row_fingerprint(spark, sf_dir):
    return add_hash_column(table(spark, sf_dir, "customer"))


def q_strict_fingerprint(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.withColumn("hash", strict_fingerprint(c))


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders")


def q_dates_sentinel(spark, sf_dir):
    return repair_ancient_dates(_orders(spark, sf_dir), ["o_orderdate"], "sentinel", DATE_CUTOFF)


def q_dates_null(spark, sf_dir):
    return repair_ancient_dates(_orders(spark, sf_dir), ["o_orderdate"], "null", DATE_CUTOFF)


def q_dates_shift(spark, sf_dir):
    return repair_ancient_dates(_orders(spark, sf_dir), ["o_orderdate"], "shift", DATE_CUTOFF)


def q_dates_quarantine(spark, sf_dir):
    """Good and bad rows as the one-pass quarantine table holds them."""
    path = shared_path(spark, "quarantine")
    write_quarantine(_orders(spark, sf_dir), ["o_orderdate"], path, DATE_CUTOFF)
    good, bad = read_quarantine(spark, path)
    return (good.withColumn("quarantined", F.lit(False))
            .unionByName(bad.withColumn("quarantined", F.lit(True))))


def q_dates_drop(spark, sf_dir):
    return repair_ancient_dates(_orders(spark, sf_dir), ["o_orderdate"], "drop", DATE_CUTOFF)


def q_hourly_volume(spark, sf_dir):
    return hourly_volume(table(spark, sf_dir, "events"), "ts")


def q_hourly_volume_by_policy(spark, sf_dir):
    return hourly_volume_by_policy(table(spark, sf_dir, "events"), "ts", ("sentinel", "shift"),
                                   EVENTS_HISTORY_CUTOFF)


def q_quote_swap(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    prepared = T.prepare_schema_text("text")
    return d.select("doc_id", prepared.alias("prepared"),
                    T.restore_schema_text(prepared).alias("restored"),
                    (T.restore_schema_text(prepared) == F.col("text")).alias("roundtrip_ok"))


def q_landing_name(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    symbol = F.concat(F.lit("U"), F.col("user_id"))
    return ev.select(
        "event_id", F.col("event_type").alias("api"),
        F.col("event_type").isin(*STAND_IN_APIS).alias("known_api"),
        T.landing_file_name(F.col("event_type"), symbol, F.col("ts"), STAND_IN_APIS).alias("landing_name"),
        T.request_url(API_BASE, "event_type", F.concat(F.lit("symbol="), symbol)).alias("url"),
    )


def q_request_stats(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    end = T.add_seconds("ts", "value")
    return ev.select(
        "event_id", F.col("ts").alias("start_time"), end.alias("end_time"),
        T.elapsed_seconds(F.col("ts"), end).alias("elapsed_time"),
        T.payload_size("props").alias("size"),
        T.request_url(API_BASE, "event_type", F.concat(F.lit("id="), F.col("event_id"))).alias("url"),
    )


def _order_day_counts(spark, sf_dir):
    o = _orders(spark, sf_dir)
    return o.groupBy(F.date_format("o_orderdate", "yyyyMMdd").alias("folder")).agg(
        F.count(F.lit(1)).alias("total_files_processed"))


def q_union_history(spark, sf_dir):
    counts = _order_day_counts(spark, sf_dir)
    cut = DATE_CUTOFF.replace("-", "")
    existing = history_records(counts.filter(F.col("folder") < cut), SOURCE_DIR, TARGET_DIR, AS_OF)
    new = history_records(counts.filter(F.col("folder") >= cut), SOURCE_DIR, TARGET_DIR, AS_OF)
    return union_history(existing, new)


def q_merge_schema_append(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    path = shared_path(spark, "bronze-supplier")
    append_bronze(s.select("s_suppkey", "s_name", "s_nationkey"), path)
    append_bronze(s.select("s_suppkey", "s_name", "s_acctbal"), path)
    return read_bronze(spark, path)


def q_json_roundtrip(spark, sf_dir):
    o = _orders(spark, sf_dir)
    path = shared_path(spark, "landing-orders-json")
    o.write.mode("overwrite").json(path)
    return load_data(spark, path, "JSON", schema=o.schema)


def q_csv_roundtrip(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    path = shared_path(spark, "landing-customer-csv")
    c.write.mode("overwrite").option("header", "true").csv(path)
    return load_data(spark, path, "Csv", {"header": "true"}, schema=c.schema)


def q_disposition_plan(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    m = with_path_parts(pages.select("page_id", F.col("url").alias("path"),
                                     F.when(F.col("html").contains("</html>"), F.lit("processed"))
                                     .otherwise(F.lit("failed")).alias("status")))
    plan = plan_disposition(m, "status", "/lake/Files/Processed/pages", "/lake/Files/Failed/pages")
    return plan.select("page_id", "status", "new_path")


def q_audit_columns(spark, sf_dir):
    return add_audit_columns(_orders(spark, sf_dir), PIPELINE_NAME, RUN_ID, AS_OF)


def q_tag_extract(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "props")
    return extract_tags(ev, "props", "k int", {"k_text": "$.k"}).drop("props")


def _order_documents(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    lines = table(spark, sf_dir, "lineitem")
    return nest_two_levels(orders, lines, "o_orderkey", "l_orderkey", "o_custkey", "lines", "orders")


def q_nest_documents(spark, sf_dir):
    docs = _order_documents(spark, sf_dir)
    n_lines = F.aggregate("orders", F.lit(0), lambda acc, o: acc + F.size(o["lines"]))
    qty = F.aggregate("orders", F.lit(0.0),
                      lambda acc, o: acc + F.aggregate(o["lines"], F.lit(0.0),
                                                       lambda a, x: a + x["l_quantity"]))
    whole = F.size(F.filter("orders", lambda o: o["lines_part"] == 0))  # a split order counts once
    per_part = docs.select("o_custkey", whole.alias("n"), n_lines.alias("m"), qty.alias("q"))
    return per_part.groupBy("o_custkey").agg(
        F.sum("n").cast("long").alias("n_orders"), F.sum("m").cast("long").alias("n_lines"),
        F.round(F.sum("q"), 2).alias("sum_qty"))


def q_nest_hot_keys(spark, sf_dir):
    """Nest all line items under their return flag: three keys, each holding a
    third of the table. Each key is split into ceil(n / max_items) documents;
    every item is kept and no document grows past twice the bound."""
    li = table(spark, sf_dir, "lineitem")
    docs = nest(li, ["l_returnflag"], [c for c in li.columns if c != "l_returnflag"], "items")
    qty = F.aggregate("items", F.lit(0.0), lambda acc, x: acc + x["l_quantity"])
    return docs.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum(F.size("items")).cast("long").alias("n_items"),
        F.round(F.sum(qty), 2).alias("sum_qty"),
        (F.max(F.size("items")) <= F.lit(2 * DEFAULT_MAX_ITEMS)).alias("parts_bounded"),
    )


def q_nest_small_bound(spark, sf_dir):
    """The same customers' documents with a bound of three items: many orders
    and documents are split, and every count and sum stays what it is, also
    where a quantity is NULL, whichever part holds it."""
    orders, lines = _orders(spark, sf_dir), table(spark, sf_dir, "lineitem")
    docs = nest_two_levels(orders, lines, "o_orderkey", "l_orderkey", "o_custkey", "lines", "orders", max_items=3)
    return docs.groupBy("o_custkey").agg(
        F.sum(F.size(F.filter("orders", lambda o: o["lines_part"] == 0))).cast("long").alias("n_orders"),
        F.sum(F.aggregate("orders", F.lit(0), lambda acc, o: acc + F.size(o["lines"]))).cast("long").alias("n_lines"),
        F.round(F.sum(F.aggregate("orders", F.lit(0.0), lambda acc, o: acc + F.aggregate(
            o["lines"], F.lit(0.0), lambda a, x: a + F.coalesce(x["l_quantity"], F.lit(0.0))))), 2).alias("sum_qty"))


def q_nest_equal_items(spark, sf_dir):
    """Events nested under their type with one field of few values as item:
    equal items spread over the parts, so no part grows past the bound."""
    ev = table(spark, sf_dir, "events").select("event_type", F.hour("ts").alias("hour"))
    docs = nest(ev, ["event_type"], ["hour"], "items", max_items=100)
    return docs.groupBy("event_type").agg(
        F.sum(F.size("items")).cast("long").alias("n_items"),
        F.sum(F.aggregate("items", F.lit(0), lambda a, x: a + x["hour"])).cast("long").alias("sum_hours"),
        (F.max(F.size("items")) <= 200).alias("parts_bounded"))


def q_flatten_documents(spark, sf_dir):
    docs = _order_documents(spark, sf_dir)
    path = shared_path(spark, "documents-ndjson")
    write_ndjson(docs, path)
    loaded = read_documents(spark, path, docs.schema)
    flat = flatten_all(loaded.drop("_corrupt_record"), ["orders", "lines"])
    return flat.drop("part", "lines_part")


def q_ingest_documents(spark, sf_dir):
    o = _orders(spark, sf_dir)
    src = shared_path(spark, "orders-ndjson")
    write_ndjson(o, src)
    docs = add_audit_columns(read_documents(spark, src, o.schema), PIPELINE_NAME, RUN_ID, AS_OF)
    bronze = shared_path(spark, "bronze-orders")
    append_bronze(docs, bronze)
    return read_bronze(spark, bronze)


def q_history_run(spark, sf_dir):
    """Two staging runs over the same drop: the second adds nothing."""
    src, tgt = shared_path(spark, "drop"), shared_path(spark, "ingest")
    hist = shared_path(spark, "history")
    create_history(spark, hist)
    land_pages(spark, sf_dir, src)
    run_staging(spark, src, tgt, hist, as_of=AS_OF)
    run_staging(spark, src, tgt, hist, as_of=AS_OF)
    return read_history(spark, hist).select("source_folder", "total_files_processed", "files_failed")


def q_move_and_verify(spark, sf_dir):
    src, dst = shared_path(spark, "raw"), shared_path(spark, "process")
    land_pages(spark, sf_dir, src, with_dicomdir=False)
    outcomes, missing = move_and_verify(spark, src, dst)
    placed = relative_parts(outcomes, dst, "new_path")
    flagged = placed.join(missing.withColumn("_missing", F.lit(True)), "rel", "left")
    return flagged.select(P.last_segment("new_path").alias("name"), "ok", "bytes", "checksum",
                          F.col("_missing").isNull().alias("arrived"))


#: bytes of a range in the query below: every page is several ranges
RANGE_BYTES = 500


def q_ranged_copies(spark, sf_dir):
    """All pages copied by byte ranges, then copied again (nothing differs):
    what both runs report and what lies at the target."""
    src, dst = shared_path(spark, "raw"), shared_path(spark, "ranged")
    land_pages(spark, sf_dir, src, with_dicomdir=False)
    files = list_tree(spark, src).filter(~F.col("is_dir"))
    plan = files.withColumn("new_path", P.join_path(dst, F.col("folder"), F.col("name")))
    first = execute_transfers(plan, "copy", chunk_bytes=RANGE_BYTES)
    again = execute_transfers(plan, "copy", chunk_bytes=RANGE_BYTES).select(
        "path", F.col("ok").alias("ok_again"), F.col("checksum").alias("checksum_again"))
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(dst)
    there = found.select(P.last_segment("path").alias("name"), F.sha2("content", 256).alias("there"))
    out = first.join(again, "path").withColumn("name", P.last_segment("new_path")).join(there, "name", "left")
    return out.select("name", "ok", "bytes", "checksum", "ok_again", "checksum_again", "there")


def q_staged_contents(spark, sf_dir):
    """What a staging run placed: path below the target, size and checksum of
    the bytes that are there afterwards."""
    src, tgt = shared_path(spark, "drop"), shared_path(spark, "ingest")
    land_pages(spark, sf_dir, src)
    run_staging(spark, src, tgt, shared_path(spark, "history"))
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(tgt)
    return relative_parts(found, tgt).select("rel", "length", F.sha2("content", 256).alias("checksum"))


def q_audit_now(spark, sf_dir):
    """Audit columns by the real clock: every stamp lies between two looks at
    the driver's clock (the first before the plan, the second a day later)."""
    before = _dt.datetime.now(_dt.timezone.utc)
    stamped = add_audit_columns(_orders(spark, sf_dir).select("o_orderkey"), PIPELINE_NAME, RUN_ID)
    low, high = T.clock(before), T.clock(before + _dt.timedelta(days=1))
    stamp = F.col("_lastModifieddttm")
    return stamped.select("o_orderkey", ((stamp >= low) & (stamp <= high)).alias("stamped_now"))


# text dates: by order key, four forms of writing; one of them is no date
TEXT_FORMATS = ("yyyy-MM-dd HH:mm:ss", "MM/dd/yyyy", "yyyyMMdd")


def text_orders(spark, sf_dir) -> DataFrame:
    d = F.col("o_orderdate")
    text = (F.when(F.col("o_orderkey") % 4 == 0, F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
            .when(F.col("o_orderkey") % 4 == 1, F.date_format(d, "MM/dd/yyyy"))
            .when(F.col("o_orderkey") % 4 == 2, F.date_format(d, "yyyyMMdd"))
            .otherwise(F.concat(F.lit("on day "), F.date_format(d, "D"))))
    return _orders(spark, sf_dir).select("o_orderkey", text.alias("d"))


def _text_policy(policy):
    def q(spark, sf_dir):
        return repair_ancient_dates(text_orders(spark, sf_dir), ["d"], policy, DATE_CUTOFF, fmt=TEXT_FORMATS)
    return q


def q_dates_text_quarantine(spark, sf_dir):
    out = flag_quarantine(text_orders(spark, sf_dir), ["d"], DATE_CUTOFF, TEXT_FORMATS)
    return out.withColumnRenamed("_ancient", "quarantined")


#: about so many events in a landed file
FILE_EVENTS = 20_000


def event_files(ev: DataFrame, rows: int = FILE_EVENTS) -> DataFrame:
    """Events as JSON files ``d, n, c`` (folder, name, content): one per type,
    day and hash part, as many parts as keep a file at about ``rows`` events,
    so the number of files grows with the table and their size does not."""
    day = F.coalesce(F.date_format("ts", "yyyyMMdd"), F.lit("none"))
    lines = ev.select(F.col("event_type").alias("d"), day.alias("day"), F.xxhash64("event_id", "user_id", "ts").alias("h"),
                      F.to_json(F.struct("event_id", "user_id", "event_type")).alias("line"))
    parts = lines.groupBy("d", "day").agg(F.ceil(F.count(F.lit(1)) / rows).alias("parts")).select(
        F.col("d").alias("_d"), F.col("day").alias("_day"), "parts")
    dealt = lines.join(bounded_broadcast(parts), F.col("d").eqNullSafe(F.col("_d")) & (F.col("day") == F.col("_day")))
    name = F.concat_ws("-", "day", F.pmod("h", "parts").cast("string"))
    return dealt.groupBy("d", F.concat(name, F.lit(".json")).alias("n")).agg(
        F.array_join(F.sort_array(F.collect_list("line")), "\n").alias("c"))


def q_bronze_job(spark, sf_dir):
    """Events land as JSON files per type, day and part and go through the bronze
    job by a mapping table; then a second drop with a name that is already
    processed arrives, is refused, and the job runs again: nothing doubles."""
    root, out = shared_path(spark, "landing"), shared_path(spark, "lake")
    ev = table(spark, sf_dir, "events")
    drop = event_files(ev)
    land_files(drop, root, "d", "n", "c")
    kinds = ev.select("event_type").distinct()
    at = lambda part: F.concat(F.lit(f"{out}/{part}/"), F.col("event_type"))
    kinds.select(F.col("event_type").alias("folder"), F.lit("bronze").alias("layer"), F.col("event_type").alias("table"),
                 F.lit(root).alias("source_file_path"), at("tables").alias("full_target_path"),
                 at("processed").alias("processed_file_path"), at("failed").alias("failed_file_path")
                 ).write.parquet(f"{out}/mapping")
    mapping = spark.read.parquet(f"{out}/mapping")
    first = run_bronze_job(spark, root, mapping, registry_path=f"{out}/registry")
    taken = drop.groupBy("d").agg(F.min("n").alias("n"))
    again = drop.join(taken, ["d", "n"], "left_semi").withColumn("c", F.concat("c", F.lit("\n")))
    land_files(again, root, "d", "n", "c")
    second = run_bronze_job(spark, root, mapping, registry_path=f"{out}/registry")
    status = first.select("table", F.col("status").alias("first_run")).join(
        second.select("table", F.col("status").alias("second_run")), "table", "left")
    loaded = read_bronze(spark, f"{out}/tables/*")
    sums = loaded.groupBy(F.col("event_type").alias("table")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("event_id").alias("sum_ids"), F.count_distinct("hash").alias("n_hashes"))
    return sums.join(status, "table", "left")


def q_registry_lookup(spark, sf_dir):
    """Which definitions (the sorted JSON keys of ``events.props``, per event
    type) of the whole table are registered by the events before the cutoff."""
    ev = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("tableName"), "ts",
        F.array_join(F.sort_array(F.json_object_keys("props")), ",").alias("schemaDefinition"))
    cut = F.lit(EVENTS_HISTORY_CUTOFF).cast("timestamp_ntz")
    known = ev.filter(F.col("ts") < cut).select("tableName", "schemaDefinition").distinct()
    every = ev.groupBy("tableName", "schemaDefinition").agg(F.count(F.lit(1)).alias("n_events"))
    seen = schema_exists(every, known).select("tableName", "schemaDefinition").withColumn("registered", F.lit(True))
    return every.join(seen, ["tableName", "schemaDefinition"], "left").fillna(False, ["registered"])


def q_incremental_ingest(spark, sf_dir):
    """Streaming staging (available-now trigger) run twice over the same drop."""
    src, tgt = shared_path(spark, "drop"), shared_path(spark, "ingest")
    hist, ckpt = shared_path(spark, "history"), shared_path(spark, "stream-ckpt")
    land_pages(spark, sf_dir, src)
    incremental_staging(spark, src, tgt, hist, ckpt, as_of=AS_OF)
    incremental_staging(spark, src, tgt, hist, ckpt, as_of=AS_OF)
    return read_history(spark, hist).select("source_folder", "total_files_processed", "files_failed")


class _Stop(RuntimeError):
    """The staged crash of :func:`q_history_exactly_once`."""


def q_history_exactly_once(spark, sf_dir):
    """A streaming run of several batches over all pages that dies after its
    first batch is logged and before the stream commits it, then runs again,
    and a third time with nothing new: what the history says per folder. A
    doubled record would double the counts."""
    src, tgt = shared_path(spark, "drop"), shared_path(spark, "ingest")
    hist, ckpt = shared_path(spark, "history"), shared_path(spark, "stream-ckpt")
    outcomes = land_pages(spark, sf_dir, src)
    files = max(1, -(-outcomes.count() // 3))

    def die(epoch: int) -> None:
        raise _Stop(f"after batch {epoch}")

    try:
        incremental_staging(spark, src, tgt, hist, ckpt, as_of=AS_OF, max_files_per_trigger=files, on_logged=die)
        raise AssertionError("the run was to stop")
    except StreamingQueryException as e:
        if "_Stop" not in str(e):
            raise
    for _ in range(2):
        incremental_staging(spark, src, tgt, hist, ckpt, as_of=AS_OF, max_files_per_trigger=files)
    return read_history(spark, hist).groupBy("source_folder").agg(
        F.sum("total_files_processed").alias("total_files_processed"), F.sum("files_failed").alias("files_failed"))


def q_tree_listing(spark, sf_dir):
    """Every page as a file of a tree in which one folder holds nearly all
    sub-folders: all entries that the frontier listing finds."""
    root = shared_path(spark, "tree")
    files = page_file_names(spark, sf_dir)
    page = F.regexp_extract("name", "^p([0-9]+)_", 1).cast("long")
    folder = F.when(page % 10 == 0, F.concat(F.lit("few/"), "folder")).otherwise(
        F.concat(F.lit("many/d"), F.floor(page / 10).cast("string"), F.lit("/"), "folder"))
    land_files(files.withColumn("folder", folder), root, "folder", "name", "content")
    found = relative_parts(list_tree(spark, root), root)
    return found.select("rel", "is_dir", "length")


#: records of a landed file in the query below: files of unknown APIs hold more
LANDED_ROWS = 50


def q_landing_files(spark, sf_dir):
    """All events as landing files ``<api>/<symbol>-<date>.json``, read back:
    the file of every event (parts of a file count as the file), and whether
    all of its parts are bounded."""
    root = shared_path(spark, "landing-rows")
    ev = table(spark, sf_dir, "events")
    symbol = F.concat(F.lit("U"), F.col("user_id") % 10)
    rows = ev.select(F.col("event_type").alias("api"),
                     T.landing_file_name(F.col("event_type"), symbol, F.col("ts"), STAND_IN_APIS).alias("file"),
                     F.to_json(F.struct("event_id", "user_id", "value")).alias("line"))
    land_rows(rows, root, "api", "file", "line", LANDED_ROWS)
    back = spark.read.schema("event_id long, user_id long, value double").option("recursiveFileLookup", "true").json(root)
    path = F.col("_metadata.file_path")
    back = back.select("*", P.last_segment(P.parent_dir(path)).alias("api"), P.last_segment(path).alias("part"))
    back = back.withColumn("file", F.regexp_replace("part", r"\.[0-9]+\.json$", ".json"))
    sizes = back.groupBy("api", "file", "part").agg(F.count(F.lit(1)).alias("n")).groupBy("api", "file").agg(
        (F.max("n") <= 2 * LANDED_ROWS).alias("bounded"))
    return back.join(sizes, ["api", "file"]).select("event_id", "user_id", "value", "api", "file", "bounded")


def _event_definitions(ev: DataFrame) -> DataFrame:
    """A table per event type and user, whose definition names the keys of its
    JSON payload and the digits of their values."""
    digits = F.length(F.get_json_object("props", "$.k")).cast("string")
    keys = F.array_join(F.sort_array(F.json_object_keys("props")), ",")
    return ev.select(F.concat_ws("_", "event_type", "user_id").alias("tableName"),
                     F.concat(F.lit("{'"), keys, F.lit("': 'decimal("), digits, F.lit(")'}")).alias("schemaDefinition"),
                     F.element_at(F.array(*[F.lit(x) for x in T.LAYERS]), (F.col("user_id") % 4 + 1).cast("int")).alias("layer"),
                     F.col("event_type").alias("namespace"))


def event_registry(spark, sf_dir) -> DataFrame:
    """The registry after two overlapping runs over the events' definitions,
    the second of which is repeated as after a crash."""
    path = shared_path(spark, "registry")
    ev = table(spark, sf_dir, "events")
    early = ev.filter(F.col("ts") < F.lit(EVENTS_HISTORY_CUTOFF).cast("timestamp_ntz"))
    registry_merge(_event_definitions(early), path, PIPELINE_NAME, "run-0001", AS_OF, unit="run-0001")
    for _ in range(2):
        registry_merge(_event_definitions(ev), path, PIPELINE_NAME, "run-0002", AS_OF, unit="run-0002")
    return read_registry(spark, path)


def q_registry_runs(spark, sf_dir):
    return event_registry(spark, sf_dir).select(
        "id", "tableName", "layer", "namespace", "schemaDefinition", "_createdByPipelineRunID",
        T.restore_schema_text("schemaDefinition").alias("restored"))


def q_registry_first(spark, sf_dir):
    return registry_first(event_registry(spark, sf_dir))


def q_layer_domain(spark, sf_dir):
    """Each customer's layer by its nation's region (the fifth region has none:
    there the market segment stands, outside the domain)."""
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    layer = F.coalesce(F.get(F.array(*[F.lit(x) for x in T.LAYERS]), F.col("n_regionkey")), F.lower("c_mktsegment"))
    named = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left").select("c_custkey", layer.alias("layer"))
    return named.select("c_custkey", "layer", T.is_valid_layer("layer").alias("valid"))


def q_epoch_to_utc(spark, sf_dir):
    """Event times as epoch seconds and back, as microseconds since the epoch."""
    ev = table(spark, sf_dir, "events")
    epoch = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts")).cast("double") / 1e6
    return ev.select("event_id", F.unix_micros(T.epoch_to_utc(epoch)).alias("micros"))


def q_typed_appends(spark, sf_dir):
    """Orders appended in three batches whose types conflict: an integer key,
    then a long one and prices as whole numbers, then prices and keys as text
    and a column more. All batches read back as one table."""
    o = _orders(spark, sf_dir)
    path = shared_path(spark, "typed-orders")
    append_bronze(o.select(F.col("o_orderkey").cast("int").alias("o_orderkey"), F.col("o_custkey").cast("int").alias("o_custkey"),
                           "o_totalprice").filter("o_orderkey % 3 = 0"), path)
    append_bronze(o.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), F.col("o_custkey").cast("long").alias("o_custkey"),
                           F.floor("o_totalprice").cast("long").alias("o_totalprice")).filter("o_orderkey % 3 = 1"), path)
    append_bronze(o.select("o_orderkey", F.concat(F.lit("C"), "o_custkey").alias("o_custkey"), "o_totalprice",
                           "o_orderstatus").filter("o_orderkey % 3 = 2"), path)
    return read_typed(spark, path).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")


def mixed_props(spark, sf_dir) -> DataFrame:
    """Event payloads whose field changes its kind from event to event (a
    number, text, an object, nothing), and broken ones."""
    ev = table(spark, sf_dir, "events")
    k, i = F.get_json_object("props", "$.k"), F.col("event_id") % 5
    line = (F.when(i == 0, F.col("props")).when(i == 1, F.concat(F.lit('{"k": "t'), k, F.lit('"}')))
            .when(i == 2, F.concat(F.lit('{"k": {"v": '), k, F.lit('}}')))
            .when(i == 3, F.concat(F.lit('{"other": '), k, F.lit('.5}'))).otherwise(F.concat(F.lit('{"k": '), k)))
    return ev.select("event_id", line.alias("line"))


def q_variant_props(spark, sf_dir):
    """Payloads of mixed kinds without a schema; broken lines are rejects."""
    docs, bad = parse_variants(mixed_props(spark, sf_dir), "line")
    good = as_columns(docs).withColumn("broken", F.lit(False))
    none = [F.lit(None).cast(t).alias(c) for c, t in good.dtypes if c not in ("event_id", "broken")]
    return good.unionByName(bad.select("event_id", *none, F.lit(True).alias("broken"))).select("event_id", "k", "other", "broken")


def q_variant_documents(spark, sf_dir):
    """Nested customer documents, written as lines with broken ones between,
    read and flattened along the schema that is found in them."""
    path = shared_path(spark, "documents-variant")
    write_ndjson(_order_documents(spark, sf_dir), path)
    broken = table(spark, sf_dir, "customer").select(F.concat(F.lit('{"o_custkey": '), "c_custkey", F.lit(', "orders": [{')))
    broken.write.mode("append").option("compression", "gzip").text(path)
    docs, bad = read_variants(spark, path)
    lines = flatten_found(as_columns(docs))["orders.lines"]
    lost = bad.agg(F.count(F.lit(1)).alias("rejects"))
    return lines.select("o_custkey", "o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("double").alias("o_totalprice"),
                        "l_linenumber", F.col("l_quantity").cast("double").alias("l_quantity"), "l_returnflag").crossJoin(F.broadcast(lost))


def q_late_children(spark, sf_dir):
    """Line items nested under their orders in two deliveries, the second one
    a tenth of all; what the table holds per order."""
    li = table(spark, sf_dir, "lineitem")
    items = ("l_linenumber", "l_partkey", "l_quantity")
    docs = DocumentTable(shared_path(spark, "late-orders"), ("l_orderkey",), items, "items", buckets=16)
    late = (F.col("l_orderkey") + F.col("l_linenumber")) % 10 == 0
    docs.add(li.where(~late), unit="first")
    docs.add(li.where(late), unit="second")
    return docs.read(spark).groupBy("l_orderkey").agg(
        F.sum(F.size("items")).cast("long").alias("n_items"),
        F.array_join(F.sort_array(F.flatten(F.collect_list("items.l_linenumber"))), ",").alias("line_numbers"),
        F.round(F.sum(F.aggregate("items", F.lit(0.0), lambda a, x: a + x["l_quantity"])), 2).alias("sum_qty"))


def q_bucketed_history(spark, sf_dir):
    """Customers whose folder no earlier order logged, by a history table that
    is bucketed by folder and joined without being shuffled."""
    o = _orders(spark, sf_dir).select(F.concat(F.lit("C"), "o_custkey").alias("folder"), "o_orderdate")
    name = f"tidemark_history_{uuid.uuid4().hex[:12]}"
    create_history(spark, shared_path(spark, "history-table"), name=name,
                   buckets=max(8, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    counts = o.filter(F.col("o_orderdate") < F.lit(DATE_CUTOFF).cast("timestamp_ntz")).groupBy("folder").agg(
        F.count(F.lit(1)).alias("total_files_processed"))
    log_folders(history_records(counts, SOURCE_DIR, TARGET_DIR, AS_OF), name, "table", unit="earlier")
    folders = o.groupBy("folder").agg(F.count(F.lit(1)).alias("n_orders"))
    return unprocessed_folders(folders, read_history(spark, name, "table"), max_broadcast_rows=0)


def q_canonical_fingerprint(spark, sf_dir):
    """Orders with their line items (an array of structs) and two maps of equal
    entries in opposite order: the fingerprints of both, which agree."""
    o, li = _orders(spark, sf_dir), table(spark, sf_dir, "lineitem")
    lines = nest(li, ["l_orderkey"], ["l_linenumber", "l_quantity", "l_returnflag"], "lines")
    pairs = [F.lit("status"), F.col("o_orderstatus"), F.lit("priority"), F.col("o_orderpriority")]
    docs = o.join(lines.drop("part"), o.o_orderkey == lines.l_orderkey).select(
        "o_orderkey", "lines", F.create_map(*pairs).alias("tags"), F.create_map(*pairs[2:], *pairs[:2]).alias("turned"))
    tags = MapType(StringType(), StringType())
    entries = lambda c: F.sha2(F.to_json(F.struct(canonical(F.col(c), tags).alias("m"))), 256)
    return docs.select("o_orderkey", canonical_fingerprint(docs, ["o_orderkey", "lines", "tags"]).alias("hash"),
                       (entries("tags") == entries("turned")).alias("same"))


QUERIES = {
    "staging_plan": q_staging_plan,
    "staging_counts": q_staging_counts,
    "staging_hot_folders": q_staging_hot_folders,
    "dirs_with_files": q_dirs_with_files,
    "path_parts": q_path_parts,
    "unprocessed_folders": q_unprocessed_folders,
    "seen_folders": q_seen_folders,
    "route_sources": q_route_sources,
    "route_first": q_route_first,
    "row_fingerprint": q_row_fingerprint,
    "strict_fingerprint": q_strict_fingerprint,
    "dates_sentinel": q_dates_sentinel,
    "dates_null": q_dates_null,
    "dates_shift": q_dates_shift,
    "dates_quarantine": q_dates_quarantine,
    "dates_drop": q_dates_drop,
    "hourly_volume": q_hourly_volume,
    "hourly_volume_by_policy": q_hourly_volume_by_policy,
    "quote_swap": q_quote_swap,
    "landing_name": q_landing_name,
    "request_stats": q_request_stats,
    "union_history": q_union_history,
    "merge_schema_append": q_merge_schema_append,
    "json_roundtrip": q_json_roundtrip,
    "csv_roundtrip": q_csv_roundtrip,
    "disposition_plan": q_disposition_plan,
    "audit_columns": q_audit_columns,
    "tag_extract": q_tag_extract,
    "nest_documents": q_nest_documents,
    "nest_hot_keys": q_nest_hot_keys,
    "flatten_documents": q_flatten_documents,
    "ingest_documents": q_ingest_documents,
    "history_run": q_history_run,
    "move_and_verify": q_move_and_verify,
    "incremental_ingest": q_incremental_ingest,
    "staged_contents": q_staged_contents,
    "audit_now": q_audit_now,
    "dates_text_sentinel": _text_policy("sentinel"),
    "dates_text_null": _text_policy("null"),
    "dates_text_shift": _text_policy("shift"),
    "dates_text_drop": _text_policy("drop"),
    "dates_text_quarantine": q_dates_text_quarantine,
    "nest_small_bound": q_nest_small_bound,
    "nest_equal_items": q_nest_equal_items,
    "bronze_job": q_bronze_job,
    "registry_lookup": q_registry_lookup,
    "history_exactly_once": q_history_exactly_once,
    "tree_listing": q_tree_listing,
    "landing_files": q_landing_files,
    "registry_runs": q_registry_runs,
    "registry_first": q_registry_first,
    "layer_domain": q_layer_domain,
    "epoch_to_utc": q_epoch_to_utc,
    "typed_appends": q_typed_appends,
    "ranged_copies": q_ranged_copies,
    "variant_props": q_variant_props,
    "variant_documents": q_variant_documents,
    "late_children": q_late_children,
    "bucketed_history": q_bucketed_history,
    "canonical_fingerprint": q_canonical_fingerprint,
}
