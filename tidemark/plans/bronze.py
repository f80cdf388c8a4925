"""Bronze load (section 3.2 of the survey): landing folders -> routed bronze tables.

find landing directories -> route each through the mapping table -> load ->
fingerprint -> repair ancient dates -> append with schema merge -> move the
landed files to processed/ or failed/ -> register the schema.

Each target table has its own schema and path, so the job runs one Spark
load per target table (a list bounded by the mapping table, one read over all
of the table's landing directories); directories, files, disposition and moves
stay DataFrames.
"""

from __future__ import annotations

import datetime as _dt
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import paths as P
from tidemark.functions.fingerprint import add_hash_column
from tidemark.functions.text import prepare_schema_str
from tidemark.operators.dates import any_ancient, repair_ancient_dates
from tidemark.operators.files import FAILED, PROCESSED, execute_transfers, plan_disposition
from tidemark.operators.lookup import bounded_broadcast, route_sources, schema_exists
from tidemark.operators.registry import read_registry, registry_insert
from tidemark.session import materialize, path_exists, qualify, resolve_path, shared_path, ship_package
from tidemark.sinks.writers import append_bronze
from tidemark.sources.files import dirs_with_files, file_manifest, relative_parts
from tidemark.sources.readers import load_data


VALUE_POLICIES = ("sentinel", "null", "shift", "drop")


def prepare_bronze(df: DataFrame, date_cols=(), policy: str = "sentinel",
                   cutoff: str = "1900-01-01", hash_col: str = "hash") -> DataFrame:
    """Fingerprint, then repair ancient dates (detected by predicate before the
    write, never by catching a write error). ``quarantine`` is not a value
    policy; use ``operators.dates.write_quarantine`` for it."""
    if policy not in VALUE_POLICIES:
        raise ValueError(f"policy {policy!r} gives two tables; a load takes one of {VALUE_POLICIES}")
    out = add_hash_column(df, hash_col)
    if date_cols:
        out = repair_ancient_dates(out, list(date_cols), policy, cutoff)
    return out


TARGET = ("table", "full_target_path", "source_file_path", "processed_file_path", "failed_file_path")


def run_bronze_job(spark: SparkSession, landing_root: str, mapping: DataFrame,
                   file_format: str = "json", options: dict | None = None, layer: str = "bronze",
                   date_cols=(), policy: str = "sentinel", cutoff: str = "1900-01-01",
                   registry_path: str | None = None, pipeline_name: str = "bronze",
                   run_id: str = "run", as_of: _dt.datetime | None = None,
                   on_exists: str = "error") -> DataFrame:
    """Load every routed landing folder. Returns one status row per directory:
    ``folder, table, status, error, files_moved``.

    ``processed``: loaded and every file moved. ``incomplete``: loaded, but some
    files were not moved (see ``error``). ``failed``: the load failed, files are
    in ``failed/``. ``refused``: nothing was loaded or moved, because the
    processed folder already has a file of that name (with ``on_exists='error'``)
    or two of the directories hold one. ``unrouted``: no route. A fault while
    registering the schema is reported in ``error`` and moves nothing to
    ``failed/``, as the data is in the table by then.

    Directories and files stay DataFrames; the driver sees one row per target
    table of the mapping. A load reads exactly the files of the snapshot taken
    at the start, so files that arrive meanwhile wait for the next run.
    """
    if policy not in VALUE_POLICIES:
        raise ValueError(f"policy {policy!r} gives two tables; a load takes one of {VALUE_POLICIES}")
    work = shared_path(spark, "bronze")
    manifest = materialize(file_manifest(spark, landing_root)
                           .withColumn("directory", P.parent_dir(F.col("path"))), f"{work}/manifest")
    dirs = dirs_with_files(manifest).withColumn("folder", P.last_segment(F.col("directory")))
    routed, rejects = route_sources(dirs, mapping, "folder", layer)
    files = materialize(manifest.drop("folder").join(routed, "directory"), f"{work}/routed")
    blocked = materialize(_blocked(spark, files, on_exists), f"{work}/blocked")
    results = []
    # at most one target per mapping row, whatever the number of directories
    for i, t in enumerate(files.select(*TARGET).distinct().collect()):
        mine = files
        for c in TARGET:
            mine = mine.filter(F.col(c).eqNullSafe(F.lit(t[c])))
        free = mine.join(blocked, "directory", "left_anti")
        refused = mine.join(blocked, "directory", "left_semi").select("directory", "folder").distinct()
        results.append(_status(refused, t["table"], "refused", "a file of this name is already processed"))
        free = materialize(free, f"{work}/load-{i}")
        if free.isEmpty():
            continue
        loaded, error = True, None
        try:
            df = prepare_bronze(_load_snapshot(spark, landing_root, free, file_format, options),
                                date_cols, policy, cutoff)
            append_bronze(df, t["full_target_path"])
        except Exception as e:  # the load failed: its files go to failed/, and the status says why
            loaded, error = False, f"{type(e).__name__}: {e}"
        if loaded and registry_path:
            try:
                _register(spark, registry_path, t["table"], t["full_target_path"], t["source_file_path"], df,
                          layer, pipeline_name, run_id, as_of)
            except Exception as e:
                error = f"registration: {type(e).__name__}: {e}"
        processed, failed = (qualify(spark, t[c]) for c in ("processed_file_path", "failed_file_path"))
        plan = plan_disposition(free.withColumn("status", F.lit(PROCESSED if loaded else FAILED)), "status",
                                processed, failed)
        moved = execute_transfers(plan, "move", out_path=f"{work}/moved-{i}", on_exists=on_exists)
        per = moved.withColumn("directory", P.parent_dir(F.col("path"))).groupBy("directory").agg(
            F.count_if("ok").alias("files_moved"), F.count_if(~F.col("ok")).alias("_left"), F.min("error").alias("_why"))
        per = per.withColumn("folder", P.last_segment(F.col("directory")))
        status = (F.when(F.col("_left") > 0, F.lit("incomplete" if loaded else FAILED))
                  .otherwise(F.lit(PROCESSED if loaded else FAILED)))
        results.append(per.select("folder", F.lit(t["table"]).alias("table"), status.alias("status"),
                                  F.coalesce(F.lit(error).cast("string"), "_why").alias("error"),
                                  F.col("files_moved").cast("long").alias("files_moved")))
    results.append(_status(rejects, None, "unrouted", None))
    return materialize(reduce(DataFrame.unionByName, results), f"{work}/status")


def _status(dirs: DataFrame, table: str | None, status: str, error: str | None) -> DataFrame:
    return dirs.select("folder", F.lit(table).cast("string").alias("table"), F.lit(status).alias("status"),
                       F.lit(error).cast("string").alias("error"), F.lit(0).cast("long").alias("files_moved"))


def _blocked(spark: SparkSession, files: DataFrame, on_exists: str) -> DataFrame:
    """Directories with a file whose place in the processed folder is claimed by
    two directories or, unless existing files may be replaced or kept beside,
    taken. They must not be loaded: their files could not be moved, and every
    later run would load them again."""
    place = files.withColumn("_place", P.join_path(F.col("processed_file_path"), F.col("name")))
    claims = place.groupBy("_place").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_place")
    out = place.join(claims, "_place", "left_semi").select("directory")
    if on_exists == "error":
        # one job per processed folder of the mapping; tasks look for the
        # claimed names alone, whatever else the folder holds
        for r in files.select("processed_file_path").distinct().collect():
            folder = qualify(spark, r[0])
            if path_exists(folder):
                mine = files.filter(F.col("processed_file_path") == F.lit(r[0])).select("directory", "name")
                out = out.union(_taken(spark, mine, folder))
    return out.distinct()


def _taken(spark: SparkSession, claims: DataFrame, folder: str) -> DataFrame:
    """``directory`` of the claims ``directory, name`` whose name is in ``folder``."""
    ship_package(spark)

    def look(batches):
        import pyarrow.fs as pafs

        fs, top = resolve_path(folder)
        for pdf in batches:
            found = fs.get_file_info([f"{top.rstrip('/')}/{n}" for n in pdf["name"]])
            yield pdf.loc[[i.type != pafs.FileType.NotFound for i in found], ["directory"]]

    return claims.mapInPandas(look, "directory string")


def _load_snapshot(spark: SparkSession, root: str, files: DataFrame, file_format: str, options) -> DataFrame:
    """The rows of exactly the given files. The directories are named by one
    glob per folder name and depth (bounded by the mapping, however many
    directories match); rows of files outside the snapshot are left out."""
    base = qualify(spark, root).rstrip("/")
    places = relative_parts(files.select("directory", "folder").distinct(), root, "directory")
    globs = ["/".join([base, *["*"] * (r["depth"] - 1), re.sub(r"([\\*?\[\]{}])", r"\\\1", r["folder"])])
             if r["rel"] else base for r in
             places.select("folder", F.when(F.col("rel").isNotNull(), F.col("depth")).alias("depth"),
                           F.col("rel").isNotNull().alias("rel")).distinct().collect()]
    plain = lambda c: F.regexp_replace(c, "^file:/+", "file:/")
    # the reader gives file names in encoded form
    name = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    rows = load_data(spark, globs, file_format, options)
    keep = bounded_broadcast(files.select(plain(F.col("path")).alias("_path")))
    return rows.select("*", plain(name).alias("_path")).join(keep, "_path", "left_semi").drop("_path")


def _register(spark, registry_path, table, target, source, df, layer, pipeline_name, run_id, as_of):
    text = prepare_schema_str(df.schema)
    if path_exists(registry_path):
        cand = spark.createDataFrame([(table, text)], "tableName string, schemaDefinition string")
        if not schema_exists(cand, read_registry(spark, registry_path)).isEmpty():
            return
    registry_insert(spark, registry_path, [{
        "tableName": table, "layer": layer, "fullTablePath": target,
        "namespace": layer, "schemaDefinition": text, "tableSource": source,
    }], pipeline_name, run_id, as_of)


def ancient_report(df: DataFrame, date_cols, cutoff: str = "1900-01-01") -> DataFrame:
    """How many rows a load would repair, per column (one aggregate)."""
    from tidemark.operators.dates import ancient
    return df.agg(*[F.count_if(ancient(df, c, cutoff)).alias(c) for c in date_cols],
                  F.count_if(any_ancient(df, list(date_cols), cutoff)).alias("any"))
