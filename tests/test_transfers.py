"""Transfers lose nothing: other content, other stores, killed attempts, any path spelling."""

import datetime as dt
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import files as O
from tidemark.operators.audit import add_audit_columns
from tidemark.plans.imaging import move_and_verify
from tidemark.plans.staging import read_history, run_staging
from tidemark.session import TEMP_PREFIX, checkpoint_root, qualify
from tidemark.sinks.writers import land_files
from tidemark.sources.files import file_manifest, folder_files, list_tree
from tidemark.streaming.incremental import incremental_staging


def _put(path, data=b"x"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def _get(path):
    with open(path, "rb") as f:
        return f.read()


def _run(spark, pairs, mode, **more):
    plan = spark.createDataFrame(pairs, "path string, new_path string")
    return {r["path"]: r for r in O.execute_transfers(plan, mode, **more).collect()}


@pytest.mark.parametrize("mode", ["copy", "move"])
@pytest.mark.parametrize("old", [b"OLD1", b"OLD-LONGER"])
def test_other_content_is_refused_and_both_files_stay(spark, scratch, mode, old):
    src, dst = f"{scratch}/a/f", f"{scratch}/b/f"
    _put(src, b"NEW1"), _put(dst, old)
    r = _run(spark, [(src, dst)], mode)[src]
    assert not r["ok"] and "other content" in r["error"]
    assert (_get(src), _get(dst)) == (b"NEW1", old)


@pytest.mark.parametrize("mode", ["copy", "move"])
def test_overwrite_and_keep_both(spark, scratch, mode):
    for policy in ("overwrite", "keep_both"):
        src, dst = f"{scratch}/{policy}/a/f.json", f"{scratch}/{policy}/b/f.json"
        _put(src, b"NEW1"), _put(dst, b"OLD1")
        r = _run(spark, [(src, dst)], mode, on_exists=policy)[src]
        assert r["ok"] and _get(r["new_path"]) == b"NEW1" and os.path.exists(src) == (mode == "copy")
        assert _get(dst) == (b"NEW1" if policy == "overwrite" else b"OLD1")


@pytest.mark.parametrize("mode", ["copy", "move"])
def test_equal_content_counts_as_done(spark, scratch, mode):
    src, dst = f"{scratch}/a/f", f"{scratch}/b/f"
    _put(src, b"same"), _put(dst, b"same")
    r = _run(spark, [(src, dst)], mode)[src]
    assert r["ok"] and r["checksum"] == hashlib.sha256(b"same").hexdigest()
    assert os.path.exists(src) == (mode == "copy")


def test_between_two_stores(tmp_path):
    import pyarrow.fs as pafs

    for d in ("one", "two"):
        os.makedirs(tmp_path / d)
    one, two = (pafs.SubTreeFileSystem(str(tmp_path / d), pafs.LocalFileSystem()) for d in ("one", "two"))
    _put(str(tmp_path / "one/in/f"), b"data")

    class Stores(O._Resolver):
        def __call__(self, uri):
            return (one, uri[4:]) if uri.startswith("one:") else (two, uri[4:])

    for mode in ("copy", "move"):
        ok, *_ = O._transfer("one:in/f", f"two:out/{mode}", mode, "error", 4, Stores())
        assert ok and _get(str(tmp_path / f"two/out/{mode}")) == b"data"
    assert not os.path.exists(tmp_path / "one/in/f") and not os.path.exists(tmp_path / "one/out")


def test_killed_attempt_leaves_nothing_behind_and_is_repeated(tmp_path, monkeypatch):
    src, dst = str(tmp_path / "a/f"), str(tmp_path / "b/f")
    _put(src, b"data")
    real, calls = O._Resolver.make_parent, []

    class Dies:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def move(self, *a):
            raise KeyboardInterrupt

    resolve = O._Resolver()
    fs, path = resolve(dst)
    with pytest.raises(KeyboardInterrupt):
        O._place(*resolve(src), Dies(fs), path, real(resolve, fs, path))
    assert os.listdir(tmp_path / "b") == [] and not calls
    assert O._transfer(src, dst, "copy", "error", 4)[0] and _get(dst) == b"data"


def test_a_gone_source_needs_a_target_of_its_length(tmp_path):
    dst = str(tmp_path / "b/f")
    _put(dst, b"data")
    assert O._transfer(str(tmp_path / "gone"), dst, "move", "error", 4)[0]
    assert not O._transfer(str(tmp_path / "gone"), dst, "move", "error", 5)[0]
    assert not O._transfer(str(tmp_path / "gone"), dst, "copy", "error", 4)[0]


def test_land_files_refuses_other_content(spark, scratch):
    _put(f"{scratch}/d/n", b"OLD")
    df = spark.createDataFrame([("d", "n", "NEW"), ("d", "m", "x")], "d string, n string, c string")
    out = {r["path"].rpartition("/")[2]: r["ok"] for r in land_files(df, scratch, "d", "n", "c").collect()}
    assert out == {"n": False, "m": True} and _get(f"{scratch}/d/n") == b"OLD"
    assert land_files(df, scratch, "d", "n", "c", overwrite=True).filter("ok").count() == 2
    assert _get(f"{scratch}/d/n") == b"NEW"


def test_listing_sees_hidden_empty_and_leaves_temporary_names(spark, scratch):
    for f in ("a/EMPTY", "a/_IM2", "a/.x", "a/b/c", f"a/{TEMP_PREFIX}1", "root"):
        _put(f"{scratch}/{f}", b"" if f.endswith("EMPTY") else b"1")
    os.makedirs(f"{scratch}/void")
    got = {(r["path"].split(os.path.basename(scratch) + "/")[1], r["is_dir"], r["length"]) for r in list_tree(spark, scratch).collect()}
    assert got == {("a", True, None), ("a/b", True, None), ("void", True, None), ("root", False, 1), ("a/EMPTY", False, 0),
                   ("a/_IM2", False, 1), ("a/.x", False, 1), ("a/b/c", False, 1)}


def test_move_and_verify_takes_every_file_to_its_relative_path(spark, scratch):
    src, dst = f"{scratch}/src", f"{scratch}/dst"
    for f in ("a/EMPTY", "a/_IM2", "a/x", "b/x"):
        _put(f"{src}/{f}", f.encode() if "EMPTY" not in f else b"")
    outcomes, missing = move_and_verify(spark, src, dst)
    assert outcomes.filter("ok").count() == 4 and missing.count() == 0
    assert _get(f"{dst}/a/x") == b"a/x" and _get(f"{dst}/b/x") == b"b/x"
    _put(f"{src}/a/x", b"other")  # the same name again: refused, reported, kept
    outcomes, missing = move_and_verify(spark, src, dst)
    assert [r["rel"] for r in missing.collect()] == ["a/x"] and _get(f"{src}/a/x") == b"other"


def test_every_spelling_of_the_root(spark, scratch, monkeypatch):
    _put(f"{scratch}/in/20250101/IM1")
    monkeypatch.chdir(scratch)
    m = file_manifest(spark, f"{scratch}/in")
    spellings = [f"{scratch}/in", f"{scratch}//in/", f"file:{scratch}/in", f"file://{scratch}/in"]
    assert [folder_files(m, s).count() for s in spellings] == [1, 1, 1, 1]
    assert qualify(spark, f"{scratch}//in/") == f"file:{scratch}/in"
    with pytest.raises(ValueError):
        run_staging(spark, f"{scratch}/elsewhere", f"{scratch}/t", f"{scratch}/h", manifest=m)


def test_staging_with_the_default_clock_logs_empty_folders(spark, scratch):
    _put(f"{scratch}/in/20250101/IM1"), _put(f"{scratch}/in/20250101/_IM2"), _put(f"{scratch}/in/20250101/IM0", b"")
    os.makedirs(f"{scratch}/in/20250102")
    before = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rows = run_staging(spark, f"{scratch}/in", f"{scratch}/t", f"{scratch}/h").collect()
    after = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert {r["source_folder"]: r["total_files_processed"] for r in rows} == {"20250101": 3, "20250102": 0}
    assert all(before <= r["processed_dttm"] <= after for r in rows)
    assert run_staging(spark, f"{scratch}/in", f"{scratch}/t", f"{scratch}/h").count() == 0


def test_audit_columns_with_the_default_clock(spark):
    before = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    stamp = add_audit_columns(spark.range(1), "p", "r").first()["_lastModifieddttm"]
    assert before <= stamp <= dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def test_streaming_retries_failed_copies_with_the_default_clock(spark, scratch):
    src, tgt, hist, ck = (f"{scratch}/{x}" for x in ("in", "t", "h", "ck"))
    _put(f"{src}/20250101/IM1"), _put(f"{src}/20250101/IM2", b"two")
    os.makedirs(f"{tgt}/20250101/IM2.dcm")  # blocks one copy
    incremental_staging(spark, src, tgt, hist, ck)
    rows = lambda: sorted((r["total_files_processed"], r["files_failed"]) for r in read_history(spark, hist).collect())
    assert rows() == [(1, 1)]
    incremental_staging(spark, src, tgt, hist, ck)  # still blocked: nothing to log
    assert rows() == [(1, 1)]
    os.rmdir(f"{tgt}/20250101/IM2.dcm")
    incremental_staging(spark, src, tgt, hist, ck)
    assert rows() == [(1, 0), (1, 1)] and _get(f"{tgt}/20250101/IM2.dcm") == b"two"
    incremental_staging(spark, src, tgt, hist, ck)
    assert len(rows()) == 2


def test_unreadable_history_raises(spark, scratch):
    os.makedirs(f"{scratch}/h")
    _put(f"{scratch}/h/part-0.parquet", b"not a table")
    with pytest.raises(Exception):
        read_history(spark, f"{scratch}/h").count()
    with pytest.raises(Exception):
        read_history(spark, f"{scratch}/h", fmt="no-such-format")
    assert read_history(spark, f"{scratch}/none", fmt="no-such-format").count() == 0


def test_unset_shared_folder_raises_off_a_local_master():
    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "spark://cluster:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        checkpoint_root(Session())


def test_contested_targets_with_and_without_others(spark, scratch):
    for d in ("a", "b", "c"):
        _put(f"{scratch}/{d}/x", d.encode())
    got = _run(spark, [(f"{scratch}/a/x", f"{scratch}/o/x"), (f"{scratch}/b/x", f"{scratch}/o/x"),
                       (f"{scratch}/c/x", f"{scratch}/o/y")], "move")
    assert [got[f"{scratch}/{d}/x"]["ok"] for d in "abc"] == [False, False, True]
    assert F is not None and os.listdir(f"{scratch}/o") == ["y"]
