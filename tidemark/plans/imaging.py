"""Imaging stages (section 3.3 of the survey): tags -> nested documents -> ndjson ->
bronze documents -> flat silver rows.

The original declares these stages as separate notebook activities with no
bodies; semantics beyond their one-line descriptions are ours. Each stage
writes its output table to the run's work folder (in the shared checkpoint
location) and a rerun skips stages whose output is complete, so a failed run
resumes from the last finished table instead of starting over.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import paths as P
from tidemark.operators.audit import add_audit_columns
from tidemark.operators.documents import extract_tags, flatten_all, nest_two_levels
from tidemark.operators.files import execute_transfers, verify_arrived
from tidemark.session import materialize, path_exists, qualify, shared_path, touch
from tidemark.sinks.writers import append_bronze, read_bronze, write_ndjson
from tidemark.sources.files import list_tree, relative_parts
from tidemark.sources.readers import read_documents


def _done(path: str) -> bool:
    return path_exists(path.rstrip("/") + "/_SUCCESS")


def stage(spark: SparkSession, path: str, build, fmt: str = "parquet") -> DataFrame:
    """Run ``build()`` and write its result to ``path`` unless a complete output
    is already there; either way return the table read back."""
    if not _done(path):
        build().write.mode("overwrite").format(fmt).save(path)
    return spark.read.format(fmt).load(path)


def move_and_verify(spark: SparkSession, source_dir: str, target_dir: str,
                    out_path: str | None = None, on_exists: str = "error"):
    """K9: move every file of ``source_dir`` (all names and sizes) to the same
    relative path under ``target_dir``, checksum what arrived and list the
    target afterwards. Returns ``(outcomes, missing)``; ``missing`` (relative
    paths that did not arrive with the source's length, refused ones included)
    must be empty."""
    out = (out_path or shared_path(spark, "movement")).rstrip("/")
    source, target = qualify(spark, source_dir), qualify(spark, target_dir)
    listing = relative_parts(list_tree(spark, source), source).filter(~F.col("is_dir"))
    manifest = materialize(listing, out + "__listing")
    plan = manifest.withColumn("new_path", P.join_path(target, F.col("rel")))
    outcomes = execute_transfers(plan, "move", out_path=out, on_exists=on_exists, verify=True)
    if not path_exists(target):  # nothing was placed
        return outcomes, manifest.select("rel")
    arrived = relative_parts(list_tree(spark, target), target).filter(~F.col("is_dir"))
    placed = relative_parts(outcomes.select("path", "new_path"), target, "new_path").select(
        "path", F.col("rel").alias("_placed"))
    expected = manifest.join(placed, "path").select("rel", F.coalesce("_placed", "rel").alias("_placed"), "length")
    refused = outcomes.filter(~F.col("ok")).select("path").join(manifest, "path").select("rel")
    lost = verify_arrived(expected.select(F.col("_placed").alias("rel"), "length"), arrived, "rel")
    return outcomes, lost.union(refused).distinct()


def run_imaging_job(spark: SparkSession, parent: DataFrame, child: DataFrame, parent_key: str,
                    child_fk: str, doc_key: str, work_dir: str, pipeline_name: str, run_id: str,
                    as_of: _dt.datetime | None = None, tags_col: str | None = None,
                    tag_schema=None, child_items: str = "items", parent_items: str = "entries",
                    raw_dir: str | None = None, process_dir: str | None = None):
    """Compose K9 -> C22 -> N1 -> K8 -> N2 -> N3. Returns ``(bronze_docs, silver_rows)``.

    With ``raw_dir`` and ``process_dir``, the raw files are first moved and
    verified (K9); a missing file stops the run before any table is written.
    """
    work = work_dir.rstrip("/")
    if raw_dir and process_dir and not _done(f"{work}/raw_movement"):
        outcomes, missing = move_and_verify(spark, raw_dir, process_dir, f"{work}/raw_outcomes")
        n_missing = missing.count()
        if n_missing:
            raise RuntimeError(f"{n_missing} raw files did not arrive in {process_dir}")
        materialize(outcomes, f"{work}/raw_movement")
    if tags_col:
        child = stage(spark, f"{work}/tags", lambda: extract_tags(child, tags_col, tag_schema).drop(tags_col))
    docs = stage(spark, f"{work}/documents",
                 lambda: nest_two_levels(parent, child, parent_key, child_fk, doc_key,
                                         child_items, parent_items))
    ndjson = f"{work}/ndjson"
    if not _done(ndjson):
        write_ndjson(docs, ndjson)
    bronze_path = f"{work}/bronze"
    if not _done(bronze_path):
        loaded = read_documents(spark, ndjson, docs.schema)
        append_bronze(add_audit_columns(loaded, pipeline_name, run_id, as_of), bronze_path)
        touch(bronze_path + "/_SUCCESS")
    bronze = read_bronze(spark, bronze_path)
    silver = stage(spark, f"{work}/silver",
                   lambda: flatten_all(bronze.filter(F.col("_corrupt_record").isNull())
                                       .drop("_corrupt_record"), [parent_items, child_items]))
    return bronze, silver
