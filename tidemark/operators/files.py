"""File effects as Spark jobs.

The plan (which file goes where) is a DataFrame built from a manifest with
built-in column expressions. The effect (copy or move) runs on executors in
``mapInPandas``: only paths travel through Spark, bytes go straight from the
source store to the target store through ``pyarrow.fs`` (local disk, HDFS,
S3, GCS and other object stores alike; the two may differ). Each transfer is
retry-safe and lossless: it writes to a temporary name and renames; a target
that exists counts as done only when its bytes equal the source's, and any
other existing target is refused, overwritten or kept beside the new file, as
the caller says. A refused transfer leaves both files as they were.
The work list and the outcomes are written to the shared checkpoint folder,
so the side effect never runs twice through lineage re-evaluation and a
retried task never depends on the (changing) source listing.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import paths as P
from tidemark.operators.lookup import bounded_broadcast
from tidemark.session import (TEMP_PREFIX, default_parallelism, materialize, put_in_place, resolve_path, shared_path,
                              ship_package)

OUTCOME_SCHEMA = "path string, new_path string, folder string, ok boolean, bytes long, checksum string, error string"

PROCESSED = "processed"
FAILED = "failed"


def plan_copy(manifest: DataFrame, target_dir: str, layout: str = "nested",
              exclude=P.EXCLUDED_NAMES, copy_with_extension: bool = False,
              suffix: str = P.IMAGING_SUFFIX) -> DataFrame:
    """Classify every manifest entry and compute its target path.

    ``layout='nested'`` keeps the folder (``<target>/<folder>/<name>.dcm``), so
    equal names in two folders never collide; ``'flat'`` puts everything in
    ``<target>/`` as the original did (check :func:`collisions`).
    Adds ``action`` and ``new_path`` (NULL unless ``action == 'copy'``).
    """
    is_dir = F.col("is_dir") if "is_dir" in manifest.columns else None
    action = P.classify_entry(F.col("name"), is_dir, exclude, copy_with_extension)
    new_name = P.staged_name(F.col("name"), suffix)
    if layout == "nested":
        target = P.join_path(target_dir, F.col("folder"), new_name)
    elif layout == "flat":
        target = P.join_path(target_dir, new_name)
    else:
        raise ValueError(f"unknown layout {layout!r}")
    return manifest.withColumn("action", action).withColumn(
        "new_path", F.when(F.col("action") == P.COPY, target))


def collisions(plan: DataFrame) -> DataFrame:
    """Target paths claimed by more than one source (partial aggregation)."""
    return (plan.filter(F.col("new_path").isNotNull()).groupBy("new_path")
            .agg(F.count(F.lit(1)).alias("n_sources")).filter(F.col("n_sources") > 1))


def plan_disposition(manifest: DataFrame, status_col: str, processed_dir, failed_dir) -> DataFrame:
    """Target of every landed file after a load: ``processed_dir`` when its
    status is ``processed``, else ``failed_dir`` (routing by status)."""
    processed = F.lit(processed_dir) if isinstance(processed_dir, str) else processed_dir
    failed = F.lit(failed_dir) if isinstance(failed_dir, str) else failed_dir
    base = F.when(F.col(status_col) == F.lit(PROCESSED), processed).otherwise(failed)
    return manifest.withColumn("new_path", P.join_path(base, F.col("name")))


class _Resolver:
    """Resolves URIs to (filesystem, path), one filesystem client per parent
    directory per task: on object stores a client per file would redo the
    connection and credential setup for every file."""

    def __init__(self):
        self._parents = {}
        self._made = set()

    def __call__(self, uri: str):
        parent, _, name = uri.rpartition("/")
        if parent not in self._parents:
            fs, path = resolve_path(uri)
            self._parents[parent] = (fs, path.rpartition("/")[0])
        fs, parent_path = self._parents[parent]
        return fs, f"{parent_path}/{name}"

    def make_parent(self, fs, path: str) -> str:
        """The parent directory of ``path``, created once a task."""
        parent = path.rsplit("/", 1)[0]
        if (id(fs), parent) not in self._made:
            fs.create_dir(parent, recursive=True)
            self._made.add((id(fs), parent))
        return parent


_CHUNK = 1 << 20


def _checksum(fs, path: str) -> str:
    """SHA-256 of a file's bytes, read in chunks."""
    digest = hashlib.sha256()
    with fs.open_input_stream(path) as f:
        while chunk := f.read(_CHUNK):
            digest.update(chunk)
    return digest.hexdigest()


def _place(src_fs, src: str, dst_fs, dst: str, parent: str) -> str:
    """Copy through a temporary name; returns the checksum of what was written.
    The temporary file never stays behind."""
    digest = hashlib.sha256()
    tmp = f"{parent}/{TEMP_PREFIX}{uuid.uuid4().hex}"
    try:
        with src_fs.open_input_stream(src) as f, dst_fs.open_output_stream(tmp) as out:
            while chunk := f.read(_CHUNK):
                digest.update(chunk)
                out.write(chunk)
        dst_fs.move(tmp, dst)
    except BaseException:
        import pyarrow.fs as pafs

        if dst_fs.get_file_info(tmp).type == pafs.FileType.File:
            dst_fs.delete_file(tmp)
        raise
    return digest.hexdigest()


def _transfer(src: str, dst: str, mode: str, on_exists: str, length, resolve=None, verify: bool = False):
    """Copy or move one file, idempotently and without loss. Returns
    ``(ok, target, bytes, checksum, error)``; the checksum is known for copies,
    compared files and, with ``verify``, for moves."""
    import pyarrow.fs as pafs

    resolve = resolve or _Resolver()
    src_fs, src_path = resolve(src)
    dst_fs, dst_path = resolve(dst)
    source, target = src_fs.get_file_info([src_path])[0], dst_fs.get_file_info([dst_path])[0]
    if source.type == pafs.FileType.NotFound:
        # the work list saw the source, and a move onto a foreign file is
        # refused with the source in place: gone means moved by an earlier attempt
        if mode == "move" and target.type == pafs.FileType.File and (length is None or target.size == length):
            return True, dst, target.size, _checksum(dst_fs, dst_path) if verify else None, None
        return False, dst, 0, None, f"source not found: {src}"
    if target.type != pafs.FileType.NotFound:
        if target.type != pafs.FileType.File:
            return False, dst, 0, None, "target is not a file"
        have = _checksum(dst_fs, dst_path)
        if target.size == source.size and have == _checksum(src_fs, src_path):
            if mode == "move":
                src_fs.delete_file(src_path)
            return True, dst, source.size, have, None  # the same bytes are there already
        if on_exists == "error":
            return False, dst, 0, None, "target exists with other content"
        if on_exists == "keep_both":
            mark = _checksum(src_fs, src_path)[:16]
            stem, dot, suffix = dst.rpartition("/")[2].partition(".")
            dst = f"{dst.rpartition('/')[0]}/{stem}~{mark}{dot}{suffix}"
            return _transfer(src, dst, mode, "error", length, resolve, verify)
    parent = resolve.make_parent(dst_fs, dst_path)
    if mode == "move" and src_fs.equals(dst_fs):
        src_fs.move(src_path, dst_path)
        done = _checksum(dst_fs, dst_path) if verify else None
    else:
        done = _place(src_fs, src_path, dst_fs, dst_path, parent)
        if mode == "move":
            if _checksum(dst_fs, dst_path) != done:
                return False, dst, 0, None, "the target's bytes differ after the copy"
            src_fs.delete_file(src_path)
    return True, dst, source.size, done, None


def _runner(mode: str, on_exists: str, verify: bool):
    def run(batches):
        import pandas as pd

        resolve = _Resolver()
        for pdf in batches:
            results = []
            for src, dst, length in zip(pdf["path"], pdf["new_path"], pdf["length"]):
                size = None if pd.isna(length) else int(length)
                try:
                    results.append(_transfer(src, dst, mode, on_exists, size, resolve, verify))
                except Exception as e:  # one bad file never fails the whole job
                    results.append((False, dst, 0, None, f"{type(e).__name__}: {e}"))
            ok, target, size, checksum, error = zip(*results) if results else ((),) * 5
            yield pd.DataFrame({
                "path": pdf["path"], "new_path": list(target), "folder": pdf["folder"],
                "ok": list(ok), "bytes": list(size), "checksum": list(checksum), "error": list(error),
            })
    return run


# -- large files, by byte ranges -----------------------------------------------

CHUNK_SCHEMA = "path string, new_path string, k long, ok boolean, same boolean, sha256 string, mark string, task int, error string"
#: how often a chunk is tried in one run
CHUNK_TRIES = 3
#: Neighbouring chunks of a file share a part up to so many bytes.
PART_BYTES = 1 << 20


def _range_sha(f, start: int, size: int, out=None) -> str:
    """SHA-256 of a byte range of an open file, which also goes to ``out``."""
    digest, left = hashlib.sha256(), size
    f.seek(start)
    while left:
        data = f.read(min(_CHUNK, left))
        if not data:
            raise EOFError(f"the file ends {left} bytes early")
        digest.update(data)
        if out is not None:
            out.write(data)
        left -= len(data)
    return digest.hexdigest()


def _parts_folder(target: str, mark: str) -> str:
    return f"{target.rpartition('/')[0]}/{TEMP_PREFIX}parts-{mark}"


def _part_path(folder: str, k: int, shas: list) -> str:
    """A part's file, named by its first chunk and the checksum of its chunk
    or, where it holds several, of their checksums."""
    return f"{folder}/{k:08d}-{shas[0] if len(shas) == 1 else hashlib.sha256(''.join(shas).encode()).hexdigest()}"


def _copy_part(resolve, src: str, dst: str, length: int, k: int, chunks: list, on_exists: str):
    """Neighbouring byte ranges ``(start, size)`` of a file, of which chunk
    ``k`` is the first, as one part file beside the target; of each ``(ok,
    same, sha256, mark, error)``. ``mark`` names this state of the source, so
    parts of an older one are never taken up. A part that is there already is
    not copied again; where the target exists, its ranges are compared first.
    Creating files is what small ranges cost, so a part holds many of them."""
    import pyarrow.fs as pafs

    src_fs, src_path = resolve(src)
    dst_fs, dst_path = resolve(dst)
    source, target = src_fs.get_file_info([src_path])[0], dst_fs.get_file_info([dst_path])[0]
    if source.type != pafs.FileType.File or source.size != length:
        return [(False, False, None, "", f"source changed or not found: {src}")] * len(chunks)
    mark = hashlib.sha256(f"{src}|{dst}|{length}|{source.mtime_ns}".encode()).hexdigest()[:24]
    if target.type != pafs.FileType.NotFound and (on_exists == "error" or target.type != pafs.FileType.File):
        # compared range by range; where any differs the file is refused as a whole
        if target.type != pafs.FileType.File or target.size != length:
            return [(True, False, None, mark, None)] * len(chunks)
        with src_fs.open_input_file(src_path) as f, dst_fs.open_input_file(dst_path) as g:
            shas = [(_range_sha(f, *c), _range_sha(g, *c)) for c in chunks]
        return [(True, ours == theirs, ours, mark, None) for ours, theirs in shas]
    folder = _parts_folder(dst_path, mark)
    for i in dst_fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True)):
        if i.base_name.startswith(f"{k:08d}-") and i.type == pafs.FileType.File and i.size == sum([size for _, size in chunks]):
            shas = [i.base_name[9:]]  # of one chunk: read when the file is put together
            if len(chunks) > 1:
                with dst_fs.open_input_file(i.path) as f:
                    shas = [_range_sha(f, start - chunks[0][0], size) for start, size in chunks]
            if _part_path(folder, k, shas) == f"{folder}/{i.base_name}":
                return [(True, False, sha, mark, None) for sha in shas]
    resolve.make_parent(dst_fs, f"{folder}/x")
    tmp = f"{folder}/{TEMP_PREFIX}{uuid.uuid4().hex}"
    try:
        with src_fs.open_input_file(src_path) as f, dst_fs.open_output_stream(tmp) as out:
            shas = [_range_sha(f, *c, out) for c in chunks]
        dst_fs.move(tmp, _part_path(folder, k, shas))
    except BaseException:
        if dst_fs.get_file_info(tmp).type == pafs.FileType.File:
            dst_fs.delete_file(tmp)
        raise
    return [(True, False, sha, mark, None) for sha in shas]


#: ledger rows that a task passes on at once
_LEDGER_ROWS = 10_000


def _chunk_runner(on_exists: str, chunk_bytes: int):
    def run(batches):
        import pandas as pd
        from pyspark import TaskContext

        resolve, task = _Resolver(), TaskContext.get().partitionId()
        ledger = lambda rows: pd.DataFrame(rows, columns=[c.split()[0] for c in CHUNK_SCHEMA.split(", ")])
        rows = []
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                starts = [(int(r.k) + i) * chunk_bytes for i in range(int(r.n))]
                chunks = [(start, min(chunk_bytes, int(r.length) - start)) for start in starts]
                try:
                    got = _copy_part(resolve, r.path, r.new_path, int(r.length), int(r.k), chunks, on_exists)
                except Exception as e:  # one bad part never fails the whole job
                    got = [(False, False, None, "", f"{type(e).__name__}: {e}")] * len(chunks)
                for i, (ok, same, sha, mark, error) in enumerate(got):
                    rows.append((r.path, r.new_path, int(r.k) + i, ok, same, sha, mark, task, error))
                if len(rows) >= _LEDGER_ROWS:
                    yield ledger(rows)
                    rows = []
        yield ledger(rows)
    return run


def _put_together(resolve, src: str, dst: str, length: int, mark: str, shas: list, same: bool, on_exists: str,
                  chunk_bytes: int, per: int):
    """The target of a file from its parts: one temporary file, checked chunk
    by chunk, and one rename; a part that is the whole file is checked and
    renamed. A part holds ``per`` chunks. The parts go then."""
    import pyarrow.fs as pafs

    dst_fs, dst_path = resolve(dst)
    target = dst_fs.get_file_info([dst_path])[0]
    if same:
        return True, dst, length, _checksum(dst_fs, dst_path), None
    if target.type != pafs.FileType.NotFound:
        if target.type != pafs.FileType.File:
            return False, dst, 0, None, "target is not a file"
        if on_exists == "error":
            return False, dst, 0, None, "target exists with other content"
    folder, digest = _parts_folder(dst_path, mark), hashlib.sha256()
    if on_exists == "keep_both" and target.type == pafs.FileType.File:
        stem, dot, suffix = dst.rpartition("/")[2].partition(".")
        dst = f"{dst.rpartition('/')[0]}/{stem}~{hashlib.sha256(''.join(shas).encode()).hexdigest()[:16]}{dot}{suffix}"
        dst_fs, dst_path = resolve(dst)
    parts = [(k, shas[k:k + per]) for k in range(0, len(shas), per)]

    def checked(k, own, out=None):
        part = _part_path(folder, k, own)
        with dst_fs.open_input_stream(part) as f:
            for i, sha in enumerate(own):
                found, left = hashlib.sha256(), min(chunk_bytes, length - (k + i) * chunk_bytes)
                while left and (data := f.read(min(_CHUNK, left))):
                    found.update(data)
                    digest.update(data)
                    if out is not None:
                        out.write(data)
                    left -= len(data)
                if found.hexdigest() != sha:
                    dst_fs.delete_file(part)  # the next run copies it again
                    raise OSError(f"part {k} of {src} is damaged")
        return part

    if len(parts) == 1:
        put_in_place(dst_fs, checked(*parts[0]), dst_path)
    else:
        tmp = f"{dst_path.rpartition('/')[0]}/{TEMP_PREFIX}{uuid.uuid4().hex}"
        try:
            with dst_fs.open_output_stream(tmp) as out:
                for k, own in parts:
                    checked(k, own, out)
            put_in_place(dst_fs, tmp, dst_path)
        except BaseException:
            if dst_fs.get_file_info(tmp).type == pafs.FileType.File:
                dst_fs.delete_file(tmp)
            raise
    dst_fs.delete_dir(folder)
    return True, dst, length, digest.hexdigest(), None


def _together_runner(on_exists: str, chunk_bytes: int, per: int):
    def run(batches):
        import pandas as pd

        resolve = _Resolver()
        for pdf in batches:
            results = []
            for r in pdf.itertuples(index=False):
                try:
                    if r.error is not None:
                        results.append((False, r.new_path, 0, None, r.error))
                    else:
                        results.append(_put_together(resolve, r.path, r.new_path, int(r.length), r.mark, list(r.shas), bool(r.same), on_exists, chunk_bytes, per))
                except Exception as e:
                    results.append((False, r.new_path, 0, None, f"{type(e).__name__}: {e}"))
            ok, target, size, checksum, error = zip(*results) if results else ((),) * 5
            yield pd.DataFrame({"path": pdf["path"], "new_path": list(target), "folder": pdf["folder"], "ok": list(ok),
                                "bytes": list(size), "checksum": list(checksum), "error": list(error)})
    return run


def copy_by_ranges(work: DataFrame, chunk_bytes: int, on_exists: str, out_path: str) -> DataFrame:
    """Copies of large files: ``path, new_path, folder, length`` rows become one
    row per byte range, dealt to all tasks (small neighbours together,
    as parts of up to ``PART_BYTES``). What came of every chunk is written
    as a ledger (``<out_path>__chunks-<try>``); chunks that failed are tried
    again, those that succeeded are not, in this run or a later one. A file
    whose chunks are all there is put together at its target's store and
    renamed once; of another one the parts wait for the next run.

    Returns the outcome per file (not yet written).
    """
    size = F.lit(chunk_bytes).cast("long")
    per = max(1, PART_BYTES // chunk_bytes)
    last = F.floor((F.col("length") - 1) / size).cast("long")
    parts = work.withColumn("_last", last).withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_last"), F.lit(per).cast("long"))))
    todo = parts.select("path", "new_path", "length", "k", F.least(F.lit(per), F.col("_last") - F.col("k") + 1).alias("n"))
    ledgers = []
    for attempt in range(CHUNK_TRIES):
        tasks = max(1, min(todo.count(), 16 * default_parallelism(work.sparkSession)))
        tried = materialize(todo.repartition(tasks, "new_path", "k").mapInPandas(_chunk_runner(on_exists, chunk_bytes), CHUNK_SCHEMA),
                            f"{out_path}__chunks-{attempt}")
        ledgers.append(tried.filter("ok"))
        failed = tried.filter(~F.col("ok"))
        if attempt == CHUNK_TRIES - 1 or failed.isEmpty():
            ledgers.append(failed)
            break
        todo = todo.join(failed.select("path", "new_path", "k"), ["path", "new_path", "k"], "left_semi").select(*todo.columns)
    ledger = reduce(DataFrame.unionByName, ledgers)
    files = ledger.groupBy("path", "new_path").agg(  # one row per chunk: length / chunk_bytes
        F.transform(F.array_sort(F.collect_list(F.struct("k", "sha256"))), lambda x: x["sha256"]).alias("shas"),
        F.bool_and("same").alias("same"), F.max("mark").alias("mark"), F.min("error").alias("error"),
        (F.min("mark") != F.max("mark")).alias("changed"))
    files = files.withColumn("error", F.when(F.col("error").isNull() & F.col("changed"), F.lit("source changed while it was copied"))
                             .otherwise(F.col("error"))).drop("changed")
    ready = work.join(files, ["path", "new_path"])
    return ready.repartition(max(1, min(work.count(), 16 * default_parallelism(work.sparkSession))), "new_path").mapInPandas(
        _together_runner(on_exists, chunk_bytes, per), OUTCOME_SCHEMA)


# Work of one transfer task, when the task count is derived from the work list.
FILES_PER_TASK = 256
BYTES_PER_TASK = 1 << 30
#: a copy of a file larger than this goes by byte ranges of this size
CHUNK_BYTES = 256 << 20
ON_EXISTS = ("error", "overwrite", "keep_both")


def execute_transfers(plan: DataFrame, mode: str = "copy", num_partitions: int | None = None,
                      out_path: str | None = None, on_exists: str = "error",
                      verify: bool = False, chunk_bytes: int = CHUNK_BYTES, stored: bool = False) -> DataFrame:
    """Run the copies (or moves) of every planned row with a ``new_path``.
    Copies of files of more than ``chunk_bytes`` (by the plan's ``length``) go
    by byte ranges: see :func:`copy_by_ranges`.

    The work list (paths only) is written to the shared folder first, so a
    retried task (lost executor) re-reads it and never the source listing,
    whose files may already have moved (``stored``: the plan is such a written
    table already). Its rows and bytes (``length``, where
    the plan has it) size the task count, unless ``num_partitions`` is given;
    rows are hash-spread by target path, so a folder holding a third of the
    files is spread over all tasks. The row size says nothing about the work
    (bytes copied), so this is a fixed repartition that AQE never coalesces.

    ``on_exists`` says what happens to a target that holds other bytes:
    ``error`` (refused, both files stay), ``overwrite``, or ``keep_both`` (the
    new file gets its checksum into its name; ``new_path`` tells). ``verify``
    also checksums renamed files. The outcome table is written to the shared
    folder and returned (this is an action).
    """
    if mode not in ("copy", "move"):
        raise ValueError(f"unknown mode {mode!r}")
    if on_exists not in ON_EXISTS:
        raise ValueError(f"unknown policy {on_exists!r}; expected one of {ON_EXISTS}")
    spark = plan.sparkSession
    todo = plan.filter(F.col("new_path").isNotNull())
    for name, kind in (("folder", "string"), ("length", "long")):
        if name not in todo.columns:
            todo = todo.withColumn(name, F.lit(None).cast(kind))
    out = out_path or shared_path(spark, "outcomes")
    work = todo.select("path", "new_path", "folder", F.col("length").cast("long").alias("length"))
    if not stored:
        work = materialize(work, out.rstrip("/") + "__work")
    size = work.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("b"), F.max("length").alias("most"),
                    F.count_distinct("new_path").alias("targets")).first()
    n = num_partitions or max(1, -(-size["n"] // FILES_PER_TASK), -(-(size["b"] or 0) // BYTES_PER_TASK))
    ship_package(spark)
    run = _runner(mode, on_exists, verify)
    clear, outcomes = work, []
    if size["targets"] < size["n"]:
        # two sources for one target: such rows are reported as failed, neither is moved
        contested = materialize(work.groupBy("new_path").agg(F.count(F.lit(1)).alias("_claims"))
                                .filter(F.col("_claims") > 1).select("new_path"), out.rstrip("/") + "__contested")
        contested = bounded_broadcast(contested)
        clear = work.join(contested, "new_path", "left_anti")
        outcomes.append(work.join(contested, "new_path", "left_semi").select(
            "path", "new_path", "folder", F.lit(False).alias("ok"), F.lit(0).cast("long").alias("bytes"),
            F.lit(None).cast("string").alias("checksum"), F.lit("target claimed by more than one source").alias("error")))
    large = F.coalesce(F.col("length") > chunk_bytes, F.lit(False))
    if mode == "copy" and (size["most"] or 0) > chunk_bytes:
        outcomes.append(copy_by_ranges(clear.filter(large), chunk_bytes, on_exists, out.rstrip("/")))
        clear = clear.filter(~large)
    outcomes.append(clear.repartition(n, "new_path").mapInPandas(run, OUTCOME_SCHEMA))
    return materialize(reduce(DataFrame.unionByName, outcomes), out)


def counts_per_folder(outcomes: DataFrame) -> DataFrame:
    """Files done and failed per folder (partial aggregation map-side)."""
    return outcomes.groupBy("folder").agg(
        F.count_if(F.col("ok")).alias("total_files_processed"),
        F.count_if(~F.col("ok")).alias("files_failed"),
    )


def verify_arrived(expected: DataFrame, arrived: DataFrame, key: str = "name") -> DataFrame:
    """Expected rows missing from the arrived listing (must be empty): same
    ``key`` and, where both sides know it, the same length."""
    if "length" in expected.columns and "length" in arrived.columns:
        have = arrived.select(F.col(key).alias("_key"), F.col("length").alias("_length"))
        return expected.join(have, (F.col(key) == F.col("_key")) & F.col("length").eqNullSafe(F.col("_length")),
                             "left_anti").select(key)
    return expected.select(key).join(arrived.select(key), key, "left_anti")
