"""Session and shared-storage helpers.

Nothing in the library holds a global session: every function receives the
DataFrames it works on, and only the few that create data take ``spark``.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: names of files under way; listings leave them out
TEMP_PREFIX = "._tidemark-tmp-"


def get_session(master: str | None = None, app: str = "tidemark",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Session with the settings this library is tuned for.

    On a cluster the master and memory come from the submit command; only
    SQL settings that matter for correctness and plan shape are fixed here.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # nesting (collect_list) keeps hash aggregation for many keys per task
        .config("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "65536")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def default_parallelism(spark: SparkSession) -> int:
    """Task slots of the cluster (falls back to the shuffle partition count
    where no SparkContext is exposed)."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; only when it is unset on a local master (tests) a
    private directory is created and registered as the checkpoint dir. On any
    other master an unset folder is an error: executors could not see it.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # no SparkContext exposed (remote session): conf only
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share") from None
        return base.rstrip("/")
    base = sc.getConf().get("spark.checkpoint.dir", None)
    if base:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(base)
        return base.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir().rstrip("/")


def shared_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A fresh path under the shared checkpoint folder."""
    leaf = list(parts)
    if unique:
        leaf.append(uuid.uuid4().hex[:12])
    made = "/".join([checkpoint_root(spark), "tidemark", *leaf])
    _MADE.add(made)
    return made


_MADE: set = set()


def release(spark: SparkSession) -> int:
    """Remove the intermediate tables that this process has written under the
    shared checkpoint folder; returns how many. To be called once the results
    that read them are stored: they are gone afterwards."""
    gone = 0
    for path in sorted(_MADE):
        fs, p = _hadoop(path)
        gone += bool(fs.exists(p) and fs.delete(p, True))
    _MADE.clear()
    return gone


def materialize(df: DataFrame, path: str | None = None, name: str = "stage",
                compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back; ``compression``
    names another codec than the session's.

    Cuts the lineage: side-effecting stages upstream (file copies) never run
    twice, and a lost executor re-reads the written table instead of
    recomputing the whole plan. Never uses executor-local storage.
    """
    spark = df.sparkSession
    target = path or shared_path(spark, name)
    df.write.mode("overwrite").parquet(target, compression=compression)
    return spark.read.parquet(target)


def materialize_once(df: DataFrame, path: str) -> DataFrame:
    """What is written at ``path``, if an earlier attempt completed it, else
    ``df`` written there: a unit of work that runs again sees the same rows."""
    if path_exists(f"{path}/_SUCCESS"):
        return df.sparkSession.read.schema(df.schema).parquet(path)
    return materialize(df, path)


@contextmanager
def settings(spark: SparkSession, **values):
    """SQL settings (dots written as double underscores) for the actions inside
    the block; the caller's own come back behind it."""
    names = {k.replace("__", "."): str(v) for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def local_fs_path(uri: str) -> str:
    """``file:/x``, ``file:///x`` or ``file://localhost/x`` → ``/x``; other strings unchanged."""
    if uri.startswith("file://"):
        rest = uri[len("file://"):]
        return rest if rest.startswith("/") else "/" + rest.partition("/")[2]
    if uri.startswith("file:"):
        return uri[len("file:"):]
    return uri


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in executor-side Python (once per
    application): zip it and add it with ``addPyFile``, the programmatic form
    of ``--py-files``. Needed by the stages that run Python on executors
    (file landing and transfers); a cluster image with the package installed
    makes it a harmless no-op."""
    import zipfile

    try:
        app = spark.sparkContext.applicationId
    except Exception:  # no SparkContext exposed (remote session)
        app = "remote"
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = checkpoint_root(spark)
    folder = local_fs_path(root) if root.startswith(("/", "file:")) else tempfile.mkdtemp()
    os.makedirs(folder, exist_ok=True)
    archive = os.path.join(folder, f"tidemark-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for base, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    try:
        spark.sparkContext.addPyFile(archive)
    except Exception:
        spark.addArtifacts(archive, pyfile=True)
    _SHIPPED.add(app)


def resolve_path(path: str):
    """``(pyarrow filesystem, path within it)`` for a local path, a ``file:``
    URI or a store URI (hdfs, s3, gs, ...). Paths are taken literally:
    Spark reports file paths unencoded, so spaces, ``%`` or ``#`` in names are
    data, not URI syntax; remote paths are percent-encoded before parsing."""
    import pyarrow.fs as pafs
    from urllib.parse import quote

    if path.startswith("/") or path.startswith("file:"):
        return pafs.LocalFileSystem(), local_fs_path(path)
    scheme, sep, rest = path.partition("://")
    if not sep:
        return pafs.LocalFileSystem(), os.path.abspath(path)
    netloc, _, inner = rest.partition("/")
    return pafs.FileSystem.from_uri(f"{scheme}://{netloc}/{quote(inner, safe='/')}")


def put_in_place(fs, temp: str, target: str) -> None:
    """Rename a finished temporary file onto its target, which an earlier
    attempt of the same work may have left there (some stores refuse to rename
    onto a file)."""
    import pyarrow.fs as pafs

    try:
        fs.move(temp, target)
    except OSError:
        if fs.get_file_info(target).type != pafs.FileType.File:
            raise
        fs.delete_file(target)
        fs.move(temp, target)


def qualify(spark: SparkSession, path: str) -> str:
    """The path with its store spelled out, as the session's file systems
    resolve it: scheme-less and relative paths get the default store, doubled
    and trailing slashes go. Executors then never guess a store."""
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(hadoop).toString()


def _hadoop(path: str):
    spark = SparkSession.active()
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), hadoop


def path_exists(path: str) -> bool:
    """Whether a file or directory exists, in the store Spark resolves."""
    fs, p = _hadoop(path)
    return bool(fs.exists(p))


def child_names(path: str) -> list[str]:
    """Names in a directory; none where it does not exist."""
    fs, p = _hadoop(path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def touch(path: str) -> None:
    """Create an empty marker file (parents included), in the store Spark resolves."""
    fs, p = _hadoop(path)
    fs.create(p, True).close()
