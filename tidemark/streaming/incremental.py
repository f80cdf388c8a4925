"""Incremental staging as Structured Streaming (H4).

The file stream source remembers which files it has delivered in its
checkpoint, so a second run over the same tree delivers nothing; each
micro-batch goes through the same plan / copy / log steps as a batch run
(``foreachBatch``), and ``trigger(availableNow=True)`` processes whatever has
arrived, then stops: an incremental batch job. Records are logged exactly once:
a batch writes the history partition that bears its number, so a batch that
runs again after a crash replaces its own rows.
A copy that failed is not delivered again by the file source, so every run
first retries the failed copies of earlier runs and logs the ones that arrive.
Folders recorded in the history before a run starts are skipped (a run that
died and the one that takes it up count as one); a folder
whose files arrive during a run may be logged in several rows, one per
micro-batch that carried some of its files.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType, TimestampType

from tidemark.operators.files import OUTCOME_SCHEMA, counts_per_folder, execute_transfers
from tidemark.plans.staging import history_records, log_folders, read_history, run_staging
from tidemark.session import (child_names, default_parallelism, materialize, materialize_once, path_exists, qualify,
                              shared_path, touch)
from tidemark.sources.files import with_path_parts

BINARY_FILE_SCHEMA = StructType([
    StructField("path", StringType(), False),
    StructField("modificationTime", TimestampType(), False),
    StructField("length", LongType(), False),
    StructField("content", BinaryType(), True),
])


LISTING_PARALLELISM = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
#: A file weighs so many bytes when files are dealt to the tasks that read a
#: batch's names and sizes (never contents). Spark's 4 MB makes a task of 32 files.
OPEN_COST = "spark.sql.files.openCostInBytes"
OPEN_COST_BYTES = 256 << 10


OPEN_SCHEMA = "path string, new_path string, folder string"


def stream_id(checkpoint: str) -> str:
    """Names the units that a stream logs, by its checkpoint."""
    return hashlib.sha256(checkpoint.encode()).hexdigest()[:12]


def retry_failed(spark: SparkSession, checkpoint: str, source_dir: str, target_dir: str, history_path: str,
                 fmt: str = "parquet", as_of: _dt.datetime | None = None) -> None:
    """Copy again what earlier batches or retries of this stream failed to copy
    and log the folders that gained files. Their failed counts are what still
    fails.

    What is open is a table of its own, rewritten by every retry under
    ``tidemark-open/<retry>-<last batch it covers>``: a run reads that table
    and the outcomes of the batches since, never those of all time. A retry
    that stops anywhere runs again under the same number, on the same work
    list, and logs the same unit.
    """
    batches, opened = f"{checkpoint}/tidemark-batches", f"{checkpoint}/tidemark-open"
    done = sorted(tuple(map(int, n.split("-"))) for n in child_names(opened) if path_exists(f"{opened}/{n}/_SUCCESS"))
    number, covered = done[-1] if done else (-1, -1)
    tables = [spark.read.schema(OPEN_SCHEMA).parquet(f"{opened}/{number}-{covered}")] if done else []
    last = covered
    while path_exists(f"{batches}/{last + 1}/records/_SUCCESS"):  # a batch under way waits for its rerun
        last += 1
        if path_exists(f"{batches}/{last}/outcomes/_SUCCESS"):
            outcomes = spark.read.schema(OUTCOME_SCHEMA).parquet(f"{batches}/{last}/outcomes")
            tables.append(outcomes.filter(~F.col("ok")).select("path", "new_path", "folder"))
    if not tables:
        return
    here = f"{number + 1}-{last}"
    work = f"{checkpoint}/tidemark-retries/{here}"
    todo = materialize_once(reduce(DataFrame.unionByName, tables).distinct(), f"{work}/todo")
    if todo.isEmpty():
        if last > covered:  # these batches need no second look
            materialize(todo, f"{opened}/{here}")
        return
    if not path_exists(f"{work}/outcomes/_SUCCESS"):
        execute_transfers(todo, "copy", out_path=f"{work}/outcomes")
    outcomes = spark.read.schema(OUTCOME_SCHEMA).parquet(f"{work}/outcomes")
    gained = counts_per_folder(outcomes).filter("total_files_processed > 0")
    records = materialize_once(history_records(gained, source_dir, target_dir, as_of), f"{work}/records")
    log_folders(records, history_path, fmt, f"{stream_id(checkpoint)}-retry-{number + 1}")
    materialize(outcomes.filter(~F.col("ok")).select("path", "new_path", "folder"), f"{opened}/{here}")


def incremental_staging(spark: SparkSession, source_dir: str, target_dir: str, history_path: str,
                        checkpoint: str | None = None, fmt: str = "parquet",
                        layout: str = "nested", as_of: _dt.datetime | None = None,
                        max_files_per_trigger: int | None = None,
                        listing_parallelism: int | None = None,
                        on_logged: Callable[[int], None] | None = None):
    """Stage every file that arrived since the last run; returns the finished query.
    ``on_logged`` is called with the number of each batch once it is logged, before
    the stream commits it.

    Each micro-batch names its new files one by one; above a few dozen paths
    Spark stats them in a distributed listing job with one task per path (up
    to 10,000). ``listing_parallelism`` (default: the cluster's default
    parallelism) bounds that job's task count for this query only.
    """
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    listing = reader.load(source_dir).select("path", "length", "modificationTime")

    # Folders done before this run are skipped, as in a batch run. The test is
    # made against a snapshot taken at its start: the file source already
    # delivers each file once, and a folder whose files span micro-batches must
    # not be cut off by the history rows its own first batch logs. A run that
    # died is taken up by the next one, with its snapshot.
    checkpoint = qualify(spark, checkpoint or shared_path(spark, "stream-checkpoint")).rstrip("/")
    runs = f"{checkpoint}/tidemark-runs"
    run = max([int(n) + path_exists(f"{runs}/{n}/_FINISHED") for n in child_names(runs)], default=0)
    done_before = materialize_once(read_history(spark, history_path, fmt), f"{runs}/{run}/done-before")
    source_dir, target_dir = qualify(spark, source_dir), qualify(spark, target_dir)
    retry_failed(spark, checkpoint, source_dir, target_dir, history_path, fmt, as_of)

    def each_batch(batch: DataFrame, epoch: int) -> None:
        # A batch retried after a failure reruns under the same epoch: its work
        # folder is fixed (inside the stream's checkpoint), copies are
        # idempotent, and its records replace what it logged before.
        manifest = with_path_parts(batch)
        run_staging(batch.sparkSession, source_dir, target_dir, history_path, fmt, layout, as_of,
                    manifest=manifest, history=done_before,
                    work_dir=f"{checkpoint}/tidemark-batches/{epoch}", resume=True,
                    unit=f"{stream_id(checkpoint)}-{epoch}")
        if on_logged:
            on_logged(epoch)

    previous = {k: spark.conf.get(k) for k in (LISTING_PARALLELISM, OPEN_COST)}
    spark.conf.set(LISTING_PARALLELISM,
                   str(listing_parallelism or default_parallelism(spark)))
    spark.conf.set(OPEN_COST, str(OPEN_COST_BYTES))
    try:  # held until the run ends: the stream copies the conf on its own thread
        query = (listing.writeStream.foreachBatch(each_batch)
                 .option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True).start())
        query.awaitTermination()
        touch(f"{runs}/{run}/_FINISHED")
    finally:
        for k, v in previous.items():
            spark.conf.set(k, v)
    return query
