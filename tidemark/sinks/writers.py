"""Sinks (K1, K2, K5, K8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.text import landing_file_name


def append_bronze(df: DataFrame, path: str, fmt: str = "parquet", merge_schema: bool = True,
                  partition_by=None) -> None:
    """Append with schema evolution. Formats with a transaction log merge on
    write (``mergeSchema``); plain Parquet merges on read (:func:`read_bronze`)."""
    w = df.write.format(fmt).mode("append")
    if merge_schema:
        w = w.option("mergeSchema", "true")
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.save(path)


def read_bronze(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """All appended batches, columns united by name (missing ones NULL)."""
    return spark.read.format(fmt).option("mergeSchema", "true").load(path)


#: partition column of tables written by units of work
UNIT_COL = "unit"


def write_unit(df: DataFrame, path: str, unit: str, fmt: str = "parquet") -> None:
    """The rows of one unit of work (a run, a micro-batch) as the partition
    ``unit=<unit>`` of the table at ``path``. Only that partition is replaced,
    so a unit that is written again, after a crash at whatever point, leaves no
    doubled row, and units of several writers never touch each other. A unit
    without rows writes nothing."""
    (df.withColumn(UNIT_COL, F.lit(unit)).write.format(fmt).mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(UNIT_COL).save(path))


def read_units(spark: SparkSession, path: str, schema, fmt: str = "parquet") -> DataFrame:
    """All units of a table with the given columns, and rows written to it
    before it had units."""
    return spark.read.format(fmt).schema(schema).option("recursiveFileLookup", "true").load(path)


def create_table(df: DataFrame, path: str | None = None, fmt: str = "parquet",
                 name: str | None = None) -> None:
    """Create a table at ``path``, or a managed table called ``name`` in the
    session catalog; fails when it already exists."""
    w = df.write.format(fmt).mode("errorifexists")
    if name:
        w.saveAsTable(name)
    elif path:
        w.save(path)
    else:
        raise ValueError("create_table needs a path or a table name")


def land_json(df: DataFrame, directory: str, api_col: str, symbol_col: str, ts_col: str,
              mode: str = "append") -> None:
    """Land raw records as JSON under ``<directory>/api=<api>/``; each record
    carries its landing file name ``<symbol>-MM-dd-yyyy.json``."""
    out = df.withColumn("landing_name", landing_file_name(F.col(api_col), F.col(symbol_col), F.col(ts_col)))
    out.write.mode(mode).partitionBy(api_col).json(directory)


def write_ndjson(df: DataFrame, directory: str, mode: str = "overwrite", compression: str = "gzip") -> None:
    """One JSON document per line, null fields written out. The text repeats
    every field name in every document, so it is written compressed; Spark's
    readers unpack it by the file names."""
    (df.write.mode(mode).option("ignoreNullFields", "false").option("compression", compression)
     .option("zlib.compress.level", "BEST_SPEED").json(directory))


FILE_OUTCOME_SCHEMA = "path string, ok boolean, bytes long, error string"


def _file_writer(root: str, overwrite: bool):
    def run(batches):
        import uuid

        import pandas as pd
        import pyarrow.fs as pafs

        from tidemark.session import TEMP_PREFIX, resolve_path

        base = root.rstrip("/")
        fs, base_path = resolve_path(base)
        made = set()

        def put(folder: str, name: str, data: bytes) -> str | None:
            target = f"{base_path}/{folder}/{name}"
            info = fs.get_file_info(target)
            if info.type != pafs.FileType.NotFound:
                if info.type != pafs.FileType.File:
                    return "target is not a file"
                if info.size == len(data):
                    with fs.open_input_stream(target) as f:
                        if f.read() == data:
                            return None  # the same bytes are there already
                if not overwrite:
                    return "target exists with other content"
            if folder not in made:
                fs.create_dir(f"{base_path}/{folder}", recursive=True)
                made.add(folder)
            tmp = f"{base_path}/{folder}/{TEMP_PREFIX}{uuid.uuid4().hex}"
            try:
                with fs.open_output_stream(tmp) as out:
                    out.write(data)
                fs.move(tmp, target)
            finally:
                if fs.get_file_info(tmp).type == pafs.FileType.File:
                    fs.delete_file(tmp)
            return None

        for pdf in batches:
            paths, oks, sizes, errors = [], [], [], []
            for d, n, content in zip(pdf["_dir"], pdf["_name"], pdf["_content"]):
                data = content.encode("utf-8") if isinstance(content, str) else bytes(content or b"")
                paths.append(f"{base}/{d}/{n}")
                try:
                    error = put(d, n, data)
                except Exception as e:  # reported per file, never fails the job
                    error = f"{type(e).__name__}: {e}"
                oks.append(error is None)
                sizes.append(len(data) if error is None else 0)
                errors.append(error)
            yield pd.DataFrame({"path": paths, "ok": oks, "bytes": sizes, "error": errors})
    return run


# An Arrow batch of file contents handed to Python holds at most this much.
LAND_BATCH_BYTES = 32 << 20


def land_files(df: DataFrame, root: str, dir_col: str, name_col: str, content_col: str,
               num_partitions: int | None = None, out_path: str | None = None,
               overwrite: bool = False) -> DataFrame:
    """Write one file per record at ``<root>/<dir>/<name>`` (text or binary
    content), from executors; retry-safe (temporary name and rename; equal
    bytes count as done, other content is refused unless ``overwrite``).
    Returns the outcome table, written once to the shared folder (an action)."""
    from tidemark.session import materialize, qualify, settings, shared_path, ship_package

    spark = df.sparkSession
    ship_package(spark)
    root = qualify(spark, root)
    rows = df.select(F.col(dir_col).cast("string").alias("_dir"), F.col(name_col).alias("_name"),
                     F.col(content_col).alias("_content"))
    # Rows carry the file contents, so bytes measure the work: let AQE size
    # the tasks (rebalance splits large and merges small partitions), unless
    # a task count is given.
    rows = (rows.repartition(num_partitions, "_dir", "_name") if num_partitions
            else rows.hint("rebalance", "_dir", "_name"))
    outcomes = rows.mapInPandas(_file_writer(root, overwrite), FILE_OUTCOME_SCHEMA)
    with settings(spark, spark__sql__execution__arrow__maxBytesPerBatch=LAND_BATCH_BYTES):
        return materialize(outcomes, out_path or shared_path(spark, "landed"))


#: records of a landed file, beyond which it is cut into numbered parts
LAND_FILE_ROWS = 100_000
ROW_OUTCOME_SCHEMA = "path string, ok boolean, rows long, bytes long, error string"


def _part_name(name, part):
    """``<stem>.json`` for part 0, ``<stem>.<part>.json`` for the others."""
    stem, dot = F.regexp_extract(name, r"^(.*?)(\.[^.]*)?$", 1), F.regexp_extract(name, r"^(.*?)(\.[^.]*)?$", 2)
    return F.when(part == 0, name).otherwise(F.concat(stem, F.lit("."), part.cast("string"), dot))


def _row_writer(root: str, overwrite: bool):
    def run(batches):
        import hashlib
        import uuid

        import pyarrow as pa
        import pyarrow.fs as pafs

        from tidemark.operators.files import _checksum
        from tidemark.session import TEMP_PREFIX, put_in_place, resolve_path

        fs, base = resolve_path(root)
        made, done = set(), []
        key = out = temp = digest = fault = None
        rows = size = 0

        def start(folder, name):
            nonlocal out, temp, digest, fault, rows, size
            rows, size, digest, out, fault = 0, 0, hashlib.sha256(), None, None
            try:
                if folder not in made:
                    fs.create_dir(f"{base}/{folder}", recursive=True)
                    made.add(folder)
                temp = f"{base}/{folder}/{TEMP_PREFIX}{uuid.uuid4().hex}"
                out = fs.open_output_stream(temp)
            except Exception as e:  # reported per file, never fails the job
                fault = f"{type(e).__name__}: {e}"

        def put(line):
            nonlocal rows, size, fault
            data = line.encode() + b"\n"
            try:
                if fault is None:
                    out.write(data)
            except Exception as e:
                fault = f"{type(e).__name__}: {e}"
            digest.update(data)
            rows, size = rows + 1, size + len(data)

        def finish():
            nonlocal fault, out
            target = f"{base}/{key[0]}/{key[1]}"
            try:
                if out is not None:
                    out.close()
                    info = fs.get_file_info(target)
                    if fault is None and info.type != pafs.FileType.NotFound and not (overwrite and info.type == pafs.FileType.File):
                        same = info.type == pafs.FileType.File and info.size == size and _checksum(fs, target) == digest.hexdigest()
                        fault = "" if same else "target exists with other content"
                    if fault is None:
                        put_in_place(fs, temp, target)
                    else:
                        fs.delete_file(temp)
            except Exception as e:
                fault = f"{type(e).__name__}: {e}"
            out = None
            done.append((f"{root}/{key[0]}/{key[1]}", not fault, rows, size, fault or None))

        def outcomes():
            made_rows, done[:] = list(done), []
            kinds = (pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array([d[c] for d in made_rows], t) for c, t in enumerate(kinds)],
                                              ["path", "ok", "rows", "bytes", "error"])

        try:
            for batch in batches:
                for folder, name, line in zip(*[c.to_pylist() for c in batch.columns]):
                    if (folder, name) != key:
                        if key is not None:
                            finish()
                        key = (folder, name)
                        start(folder, name)
                    put("" if line is None else line)
                yield outcomes()
            if key is not None:
                finish()
            yield outcomes()
        finally:
            if out is not None:  # a failed attempt leaves nothing behind
                out.close()
                fs.delete_file(temp)
    return run


def land_rows(df: DataFrame, root: str, dir_col: str, name_col: str, line_col: str,
              max_rows: int = LAND_FILE_ROWS, out_path: str | None = None, overwrite: bool = False) -> DataFrame:
    """K5: records into the files ``<root>/<dir>/<name>`` that they name, one
    record per line, in order of the lines. A file of more than ``max_rows``
    records is cut into parts of about so many, ``<stem>.<part>.<ext>`` beside
    the first.

    Rows reach the writer sorted by file, and it holds one open file and one
    batch of rows: no list of a file's records is ever built, and a file that
    would hold a third of all records is many parts in many tasks. Equal bytes
    that are there already count as done, other content is refused unless
    ``overwrite``. Returns the outcome per file, written once to the shared
    folder (an action). ``df`` is read up to three times: pass a written table.
    """
    from tidemark.operators.lookup import bounded_broadcast
    from tidemark.session import materialize, qualify, shared_path, ship_package

    spark = df.sparkSession
    ship_package(spark)
    root = qualify(spark, root).rstrip("/")
    rows = df.select(F.col(dir_col).cast("string").alias("_dir"), F.col(name_col).alias("_name"), F.col(line_col).alias("_line"))
    heavy = rows.groupBy("_dir", "_name").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > max_rows).select(
        F.col("_dir").alias("_hd"), F.col("_name").alias("_hn"), F.ceil(F.col("_n") / F.lit(max_rows)).cast("int").alias("_parts"))
    heavy = materialize(heavy, shared_path(spark, "land-heavy"))
    if heavy.isEmpty():
        dealt = rows.withColumn("_part", F.lit(0))
    else:
        same = F.col("_dir").eqNullSafe(F.col("_hd")) & F.col("_name").eqNullSafe(F.col("_hn"))
        joined = rows.join(bounded_broadcast(heavy), same, "left").drop("_hd", "_hn")
        # drawn per row, so equal records spread too; written at once and never drawn again
        part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("_parts")).cast("int")
        split = materialize(joined.filter("_parts is not null").withColumn("_part", part).drop("_parts"),
                            shared_path(spark, "land-split"))
        dealt = joined.filter("_parts is null").drop("_parts").withColumn("_part", F.lit(0)).unionByName(split)
    dealt = dealt.select("_dir", _part_name(F.col("_name"), F.col("_part")).alias("_name"), "_line")
    ordered = dealt.repartition("_dir", "_name").sortWithinPartitions("_dir", "_name", "_line")
    outcomes = ordered.mapInArrow(_row_writer(root, overwrite), ROW_OUTCOME_SCHEMA)
    return materialize(outcomes, out_path or shared_path(spark, "landed"))
