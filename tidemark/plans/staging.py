"""Incremental folder staging (H1-H3, A2, J1, K6): list -> anti join -> plan -> copy -> log.

The original walks the folders on the driver: one count job per folder, one
copy call per file, one full rewrite of the history table per folder. Here a
run is a handful of jobs regardless of the number of folders or files:

1. manifest (distributed listing, or a supplied table) restricted to
   ``<source>/<folder>/<file>``;
2. anti join against the folders the history counts as done: a broadcast
   hash lookup on the file rows when the history keys are proven small,
   else distinct folders first, then the files semi-joined back;
3. classification + target path (one Project), written once as the run's plan;
4. copies on executors (``mapInPandas``), outcomes written once;
5. per-folder counts (partial aggregation) logged in the history, as the
   partition of this unit of work.

A unit only ever writes its own partition of the history; a folder with failed
copies is recorded with ``files_failed > 0`` and is picked up again by the next
run.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from tidemark.functions import paths as P
from tidemark.functions.text import clock
from tidemark.operators.audit import stable_id
from tidemark.operators.files import counts_per_folder, execute_transfers, plan_copy
from tidemark.operators.lookup import rows_of_unprocessed_folders, unprocessed_folders
from tidemark.session import materialize, path_exists, qualify, shared_path
from tidemark.sinks.writers import UNIT_COL, create_table, read_units, write_unit
from tidemark.sources.files import folder_files, folders_of, list_tree, require_inside

# Fixed values that must equal the reference's behaviour: history table columns
HISTORY_SCHEMA = StructType([
    StructField("id", StringType(), True),
    StructField("source_dir", StringType(), True),
    StructField("target_dir", StringType(), True),
    StructField("source_folder", StringType(), True),
    StructField("total_files_processed", LongType(), True),
    # zone-free UTC wall-clock time, where the original has an instant
    StructField("processed_dttm", TimestampNTZType(), True),
    # ours: failed copies, so an incomplete folder is retried
    StructField("files_failed", LongType(), True),
])


#: format name of a history that is a table of the session's catalog
TABLE = "table"


def create_history(spark: SparkSession, path: str | None = None, fmt: str = "parquet",
                   name: str | None = None, buckets: int | None = None) -> None:
    """H1: an empty history table at ``path`` or as managed table ``name``
    (fails if one exists). With ``buckets`` the named table (at ``path``, if
    given) has a partition per unit of work and is bucketed and sorted by
    folder, for use with ``fmt="table"``: a history past the broadcast bound
    then meets the folders of a run without being shuffled. Choose at least as
    many buckets as shuffle partitions."""
    empty = spark.createDataFrame([], HISTORY_SCHEMA)
    if not buckets:
        return create_table(empty, path, fmt, name)
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in HISTORY_SCHEMA.fields)
    where = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE {name} ({columns}, {UNIT_COL} string) USING {fmt} PARTITIONED BY ({UNIT_COL}) "
              f"CLUSTERED BY (source_folder) SORTED BY (source_folder) INTO {int(buckets)} BUCKETS{where}")


def read_history(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The history with its declared schema; an absent table reads as empty.
    Any other fault (unknown format, corrupt files) is raised: a history that
    cannot be read must not look empty, or everything is staged again. Rows
    written before ``files_failed`` existed read it as NULL. With
    ``fmt="table"``, ``path`` names a table of the catalog."""
    if fmt == TABLE:
        return spark.table(path).drop(UNIT_COL)
    if not path_exists(path):
        return spark.createDataFrame([], HISTORY_SCHEMA)
    return read_units(spark, path, HISTORY_SCHEMA, fmt)


def history_records(counts: DataFrame, source_dir: str, target_dir: str,
                    as_of: _dt.datetime | None = None, folder_col: str = "folder") -> DataFrame:
    """H2: one history row per folder from per-folder counts.

    ``id`` is a deterministic text key of (source_dir, folder); columns are cast
    to the table's types before any union (no type widening surprises).
    """
    fails = F.col("files_failed") if "files_failed" in counts.columns else F.lit(0)
    return counts.select(
        stable_id(F.lit(source_dir), F.col(folder_col)).alias("id"),
        F.lit(source_dir).alias("source_dir"),
        F.lit(target_dir).alias("target_dir"),
        F.col(folder_col).cast("string").alias("source_folder"),
        F.col("total_files_processed").cast("long").alias("total_files_processed"),
        clock(as_of).alias("processed_dttm"),
        fails.cast("long").alias("files_failed"),
    )


def union_history(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Union by position after casting both sides to the history schema."""
    def conform(df):
        cols = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns
                else F.lit(None).cast(f.dataType).alias(f.name) for f in HISTORY_SCHEMA.fields]
        return df.select(*cols)
    return conform(existing).union(conform(new))


def log_folders(records: DataFrame, history_path: str, fmt: str = "parquet", unit: str | None = None) -> None:
    """Log the records of one unit of work (by default a new one). A unit that
    is logged again replaces its own rows and no others."""
    rows, unit = union_history(records.limit(0), records), unit or uuid.uuid4().hex[:16]
    if fmt == TABLE:
        rows.sparkSession.sql(f"INSERT OVERWRITE TABLE {history_path} PARTITION ({UNIT_COL} = '{unit}') SELECT * FROM {{rows}}",
                              rows=rows)
    else:
        write_unit(rows, history_path, unit, fmt)


def stage_plan(manifest: DataFrame, history: DataFrame, source_dir: str, target_dir: str,
               layout: str = "nested", exclude=P.EXCLUDED_NAMES,
               copy_with_extension: bool = False) -> DataFrame:
    """Lazy plan of one run: files of new folders, classified, with targets."""
    files = folder_files(manifest, source_dir)
    todo = rows_of_unprocessed_folders(files, history, "folder", "source_folder")
    return plan_copy(todo, target_dir, layout, exclude, copy_with_extension)


def staging_counts(plan: DataFrame) -> DataFrame:
    """Per new folder: files by class (copy / excluded / has_extension)."""
    return plan.groupBy("folder").agg(
        F.count_if(F.col("action") == P.COPY).alias("to_copy"),
        F.count_if(F.col("action") == P.EXCLUDED).alias("excluded"),
        F.count_if(F.col("action") == P.HAS_EXTENSION).alias("has_extension"),
    )


def run_staging(spark: SparkSession, source_dir: str, target_dir: str, history_path: str,
                fmt: str = "parquet", layout: str = "nested", as_of: _dt.datetime | None = None,
                manifest: DataFrame | None = None, num_partitions: int | None = None,
                work_dir: str | None = None, history: DataFrame | None = None,
                resume: bool = False, on_exists: str = "error", unit: str | None = None) -> DataFrame:
    """H3: one incremental run. Returns the history rows it logged.

    ``history`` overrides the table read from ``history_path`` for the "already
    processed" test (the streaming run passes the snapshot taken at its start);
    new rows always go to ``history_path``. With ``resume`` and a fixed
    ``work_dir`` (one per unit of work, e.g. a micro-batch epoch), a rerun
    reuses the records it already wrote and logs them as the same ``unit``
    (by default named after ``work_dir``): however often and wherever a run
    stops, the history holds its rows exactly once.
    """
    work = work_dir or shared_path(spark, "staging")
    source_dir, target_dir = qualify(spark, source_dir), qualify(spark, target_dir)
    if resume:
        unit = unit or hashlib.sha256(qualify(spark, work).encode()).hexdigest()[:16]
    if resume and path_exists(f"{work}/records/_SUCCESS"):
        records = spark.read.parquet(f"{work}/records")
        log_folders(records, history_path, fmt, unit)
        return records
    listed = manifest is None
    if listed:  # a written table: the plan and the folder list see the same tree
        manifest = list_tree(spark, source_dir)
    history = history if history is not None else read_history(spark, history_path, fmt)
    plan = materialize(stage_plan(manifest, history, source_dir, target_dir, layout),
                       f"{work}/plan")
    # every new folder gets a row, also one where nothing needed copying or lies
    folders = plan.select("folder").distinct()
    if listed:
        folders = folders.union(unprocessed_folders(folders_of(manifest, source_dir), history)).distinct()
        folders = materialize(folders, f"{work}/folders")
    if folders.isEmpty():  # nothing new: no transfers, nothing to log
        require_inside(manifest, source_dir)
        none = spark.createDataFrame([], HISTORY_SCHEMA)
        return materialize(none, f"{work}/records") if resume else none
    outcomes = execute_transfers(plan, "copy", num_partitions, f"{work}/outcomes", on_exists, stored=True)
    counts = folders.join(counts_per_folder(outcomes), "folder", "left").fillna(
        0, ["total_files_processed", "files_failed"])
    records = materialize(history_records(counts, source_dir, target_dir, as_of), f"{work}/records")
    log_folders(records, history_path, fmt, unit)
    return records
