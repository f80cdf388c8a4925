"""File manifests.

A manifest is a DataFrame with one row per file: ``path, name, folder,
is_dir, length, modificationTime``. It comes from Spark's ``binaryFile``
listing (distributed for large trees; the ``content`` column is pruned away,
so no file is read) or from any table that carries a ``path`` column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import paths as P
from tidemark.session import (TEMP_PREFIX, default_parallelism, materialize, qualify, resolve_path, shared_path,
                              ship_package)

MANIFEST_COLUMNS = ("path", "name", "folder", "is_dir", "length", "modificationTime")


def file_manifest(spark: SparkSession, root: str, recursive: bool = True,
                  glob: str | None = None) -> DataFrame:
    """Visible, non-empty files under ``root``, as Spark's readers see them:
    the listing skips names starting with ``_`` or ``.`` and zero-byte files.
    :func:`list_tree` sees everything."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    listing = reader.load(root).select("path", "length", "modificationTime")
    return with_path_parts(listing)


LISTING_SCHEMA = "path string, length long, modificationTime timestamp, is_dir boolean"


#: directories that a task lists beyond the ones it was given
LIST_AHEAD = 64
_FRONTIER_SCHEMA = LISTING_SCHEMA + ", todo boolean"


def _lister(ahead: int):
    """Lists the given directories and up to ``ahead`` of what it finds below;
    directories that it leaves to others come back as ``todo``."""
    def run(batches):
        import pandas as pd
        import pyarrow.fs as pafs

        def table(rows):
            out = pd.DataFrame(rows, columns=["path", "length", "modificationTime", "is_dir", "todo"])
            out["length"] = out["length"].astype("Int64")
            out["modificationTime"] = pd.to_datetime(out["modificationTime"], utc=True)
            return out

        left = ahead
        for pdf in batches:
            for path in pdf["path"]:
                fs, inner = resolve_path(path)
                stack = [(path, inner)]
                while stack:
                    uri, folder = stack.pop()
                    rows = []
                    for i in fs.get_file_info(pafs.FileSelector(folder)):
                        if i.base_name.startswith(TEMP_PREFIX):
                            continue
                        if i.type == pafs.FileType.Directory:
                            own = left > 0
                            left -= own
                            if own:
                                stack.append((f"{uri}/{i.base_name}", i.path))
                            rows.append((f"{uri}/{i.base_name}", None, i.mtime, True, not own))
                        elif i.type == pafs.FileType.File:
                            rows.append((f"{uri}/{i.base_name}", i.size, i.mtime, False, False))
                    for at in range(0, len(rows), 100_000):  # one directory may hold very many entries
                        yield table(rows[at:at + 100_000])
    return run


def list_tree(spark: SparkSession, root: str, num_partitions: int | None = None,
              ahead: int = LIST_AHEAD) -> DataFrame:
    """Every file and directory under ``root``: zero-byte, ``_`` and ``.`` names
    and empty directories too. Only files under way and their parts (temporary
    names of this library) are left out.

    The tree is listed in rounds. A round deals the directories not yet listed
    evenly to tasks; a task lists its share and at most ``ahead`` directories
    that it comes upon, and hands the others back for the next round. So small
    trees take one round, and one folder with nearly all sub-folders is spread
    over all tasks. Each round is written once to the shared folder; the driver
    sees their number of directories only.
    """
    base = qualify(spark, root)
    ship_package(spark)
    frontier = spark.createDataFrame([(base,)], "path string")
    left, rounds = 1, []
    while left:
        tasks = num_partitions or max(1, min(left, 4 * default_parallelism(spark)))
        found = frontier.select("path").repartition(tasks).mapInPandas(_lister(ahead), _FRONTIER_SCHEMA)
        rounds.append(materialize(found, shared_path(spark, "listing")))
        frontier = rounds[-1].filter("todo")
        left = frontier.count()
    return with_path_parts(reduce(DataFrame.unionByName, rounds).drop("todo"))


def with_path_parts(df: DataFrame, path_col: str = "path", is_dir=None) -> DataFrame:
    """Add ``name`` (last segment), ``folder`` (name of the parent directory)
    and ``is_dir`` (given, or: the path ends with ``/``) to a table of paths."""
    p = F.col(path_col)
    dir_flag = is_dir if is_dir is not None else (
        F.col("is_dir") if "is_dir" in df.columns else p.endswith("/"))
    # a directory entry "a/b/" is named "b" and lives in folder "a"
    trimmed = F.regexp_replace(p, "/+$", "")
    return df.withColumns({
        "name": P.last_segment(trimmed),
        "folder": P.last_segment(P.parent_dir(trimmed)),
        "is_dir": dir_flag,
    })


def _store(path: str) -> tuple[str, str]:
    """``(store, path within it)`` of a qualified path."""
    scheme, _, rest = path.partition(":")
    if rest.startswith("//"):
        host, slash, inner = rest[2:].partition("/")
        return f"{scheme}://{host}" if host else f"{scheme}:", slash + inner
    return f"{scheme}:", rest


def relative_parts(df: DataFrame, root: str, path_col: str = "path") -> DataFrame:
    """``rel`` (path below ``root``, NULL outside it) and ``depth`` (its segment count).

    Both sides are compared in qualified form: any spelling of the root
    (scheme-less, relative, doubled slashes) and of the listed paths matches;
    a listed path without a store lies in the root's.
    """
    store, inside = _store(qualify(df.sparkSession, root))
    prefix = store + inside.rstrip("/") + "/"
    p = F.col(path_col)
    scheme = F.regexp_extract(p, "^([A-Za-z][A-Za-z0-9+.-]*:(?://[^/]+)?)", 1)
    body = F.regexp_replace(p.substr(F.length(scheme) + 1, F.length(p)), "/{2,}", "/")
    local = F.concat(F.when(scheme == "", F.lit(store)).otherwise(scheme), body)
    rel = F.when(local.startswith(prefix), local.substr(F.lit(len(prefix) + 1), F.length(local)))
    return df.withColumn("rel", rel).withColumn("depth", F.size(F.split(F.col("rel"), "/")))


def folder_files(manifest: DataFrame, root: str) -> DataFrame:
    """Files directly inside the immediate sub-folders of ``root``
    (``root/<folder>/<name>``), as a per-folder staging run sees them."""
    return (relative_parts(manifest, root).filter(F.col("depth") == 2)
            .filter(~F.col("is_dir")).drop("rel", "depth"))


def folders_of(manifest: DataFrame, root: str) -> DataFrame:
    """Names of the immediate sub-folders of ``root`` that the manifest lists
    as directories, with or without files (column ``folder``)."""
    return (relative_parts(manifest, root).filter((F.col("depth") == 1) & F.col("is_dir"))
            .select(F.col("name").alias("folder")).distinct())


def require_inside(manifest: DataFrame, root: str) -> None:
    """Raise when the manifest has files but none lies under ``root``: the root
    is then spelled for another store or tree, and staging would find nothing."""
    placed = relative_parts(manifest, root)
    if placed.filter(F.col("rel").isNotNull()).isEmpty() and not manifest.isEmpty():
        raise ValueError(f"no listed file lies under {root!r}")


def dirs_with_files(manifest: DataFrame, path_col: str = "path") -> DataFrame:
    """Directories that directly contain at least one file (set semantics)."""
    files = manifest.filter(~F.col("is_dir")) if "is_dir" in manifest.columns else manifest
    return files.select(P.parent_dir(F.col(path_col)).alias("directory")).distinct()
