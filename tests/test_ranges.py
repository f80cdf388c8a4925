"""Copies of large files by byte ranges."""

import glob
import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import files
from tidemark.operators.files import execute_transfers
from tidemark.sources.files import list_tree

CHUNK = 1 << 20


def _plan(spark, scratch, sizes):
    os.makedirs(f"{scratch}/in")
    for name, size in sizes.items():
        with open(f"{scratch}/in/{name}", "wb") as f:
            f.write(random.Random(name).randbytes(size))
    listed = list_tree(spark, f"{scratch}/in").filter(~F.col("is_dir"))
    return listed.withColumn("new_path", F.concat(F.lit(f"{scratch}/out/"), "name"))


def _data(path):
    with open(path, "rb") as f:
        return f.read()


def _parts(scratch):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{scratch}/out/._tidemark-tmp-parts-*/*")}


def test_ranges_of_a_file_go_to_several_tasks(spark, scratch):
    sizes = {"big": 10 * CHUNK + 17, "edge": 2 * CHUNK, "at": CHUNK, "small": 5, "empty": 0}
    out = execute_transfers(_plan(spark, scratch, sizes), "copy", out_path=f"{scratch}/o", chunk_bytes=CHUNK)
    rows = {r["path"].rpartition("/")[2]: r for r in out.collect()}
    assert set(rows) == set(sizes) and all(r["ok"] for r in rows.values())
    for name, size in sizes.items():
        data = _data(f"{scratch}/in/{name}")
        assert data == _data(f"{scratch}/out/{name}") and rows[name]["bytes"] == size
        assert rows[name]["checksum"] == hashlib.sha256(data).hexdigest()
    ledger = spark.read.parquet(f"{scratch}/o__chunks-0")
    assert ledger.where("path LIKE '%/big'").count() == 11 and ledger.where("path LIKE '%/big'").select("task").distinct().count() > 3
    assert ledger.where("path LIKE '%/edge'").count() == 2 and ledger.where("path LIKE '%/at'").count() == 0
    assert sorted(os.listdir(f"{scratch}/out")) == sorted(sizes)  # nothing else stays


def test_a_failed_chunk_is_taken_up_by_the_next_run(spark, scratch, monkeypatch):
    monkeypatch.setattr(files, "CHUNK_TRIES", 2)
    plan = _plan(spark, scratch, {"big": 6 * CHUNK})
    source = f"{scratch}/in/big"
    data = _data(source)
    path = list_tree(spark, f"{scratch}/in").filter(~F.col("is_dir")).head()["path"]
    mark = hashlib.sha256(f"{path}|{scratch}/out/big|{len(data)}|{os.stat(source).st_mtime_ns}".encode()).hexdigest()[:24]
    sha = hashlib.sha256(data[3 * CHUNK:4 * CHUNK]).hexdigest()
    blocked = f"{scratch}/out/._tidemark-tmp-parts-{mark}/{3:08d}-{sha}"
    os.makedirs(f"{blocked}/x")  # chunk 3 cannot be put in its place
    first = execute_transfers(plan, "copy", out_path=f"{scratch}/o1", chunk_bytes=CHUNK).head()
    assert not first["ok"] and first["error"] and not os.path.exists(f"{scratch}/out/big")
    assert spark.read.parquet(f"{scratch}/o1__chunks-1").count() == 1  # only the failed one is tried again
    before = {p: t for p, t in _parts(scratch).items() if p != blocked}
    assert len(before) == 5
    assert list_tree(spark, f"{scratch}/out").count() == 0  # parts are no files of the tree
    os.rmdir(f"{blocked}/x"), os.rmdir(blocked)
    # the parts that are there are damaged in one place: found when the file is put together
    seen = []
    monkeypatch.setattr(files, "_together_runner", lambda *a, f=files._together_runner: seen.append(_parts(scratch)) or f(*a))
    second = execute_transfers(plan, "copy", out_path=f"{scratch}/o2", chunk_bytes=CHUNK).head()
    assert second["ok"] and _data(f"{scratch}/out/big") == data
    assert before.items() <= seen[0].items() and len(seen[0]) == 6  # five were not copied again
    assert os.listdir(f"{scratch}/out") == ["big"]


def test_small_ranges_share_a_part(spark, scratch, monkeypatch):
    """Ranges far below PART_BYTES: one part file for many of them, a ledger row
    and a checksum for each; a part that is there is not copied again, and one
    whose bytes changed is."""
    monkeypatch.setattr(files, "PART_BYTES", 1000)
    plan = _plan(spark, scratch, {"a": 7300, "b": 900, "c": 7300})
    seen = []
    monkeypatch.setattr(files, "_together_runner", lambda *a, f=files._together_runner: seen.append(_parts(scratch)) or f(*a))
    path = list_tree(spark, f"{scratch}/in").filter(F.col("path").endswith("/c")).head()["path"]
    mark = hashlib.sha256(f"{path}|{scratch}/out/c|7300|{os.stat(f'{scratch}/in/c').st_mtime_ns}".encode()).hexdigest()[:24]
    for k, data in ((0, _data(f"{scratch}/in/c")[:1000]), (2, bytes(1000))):  # the second one is not what its name says
        shas = [hashlib.sha256(_data(f"{scratch}/in/c")[s:s + 500]).hexdigest() for s in (k * 500, k * 500 + 500)]
        os.makedirs(f"{scratch}/out/._tidemark-tmp-parts-{mark}", exist_ok=True)
        with open(f"{scratch}/out/._tidemark-tmp-parts-{mark}/{k:08d}-{hashlib.sha256(''.join(shas).encode()).hexdigest()}", "wb") as f:
            f.write(data)
    before = _parts(scratch)
    out = {r["path"].rpartition("/")[2]: r for r in execute_transfers(plan, "copy", out_path=f"{scratch}/o", chunk_bytes=500).collect()}
    for name, r in out.items():
        assert r["ok"] and _data(f"{scratch}/out/{name}") == _data(f"{scratch}/in/{name}")
        assert r["checksum"] == hashlib.sha256(_data(f"{scratch}/in/{name}")).hexdigest()
    assert len(seen[0]) == 8 + 1 + 8  # 15, 2 and 15 ranges
    assert [seen[0][p] == t for p, t in sorted(before.items())] == [True, False]
    ledger = spark.read.parquet(f"{scratch}/o__chunks-0")
    assert ledger.count() == ledger.select("path", "k").distinct().count() == 15 + 2 + 15
    data = _data(f"{scratch}/in/a")
    assert {r["k"]: r["sha256"] for r in ledger.where("path LIKE '%/a'").collect()} == {
        k: hashlib.sha256(data[k * 500:k * 500 + 500]).hexdigest() for k in range(15)}
    assert sorted(os.listdir(f"{scratch}/out")) == ["a", "b", "c"]


@pytest.mark.parametrize("policy", files.ON_EXISTS)
def test_existing_targets(spark, scratch, policy):
    plan = _plan(spark, scratch, {"a": 3 * CHUNK, "b": 3 * CHUNK})
    os.makedirs(f"{scratch}/out")
    with open(f"{scratch}/out/a", "wb") as f:
        f.write(_data(f"{scratch}/in/a"))
    with open(f"{scratch}/out/b", "wb") as f:
        f.write(_data(f"{scratch}/in/b")[:-1] + b"x")
    old = _data(f"{scratch}/out/b")
    out = {r["path"].rpartition("/")[2]: r for r in execute_transfers(plan, "copy", on_exists=policy, chunk_bytes=CHUNK).collect()}
    assert out["a"]["ok"]
    assert (out["b"]["ok"], _data(f"{scratch}/out/b") == old) == {"error": (False, True), "overwrite": (True, False), "keep_both": (True, True)}[policy]
    if policy == "keep_both":
        assert _data(out["b"]["new_path"]) == _data(f"{scratch}/in/b")
    if policy == "error":
        assert out["b"]["error"] == "target exists with other content" and not _parts(scratch)


def test_a_finished_file_replaces_what_an_earlier_attempt_left(scratch):
    import pyarrow.fs as pafs

    from tidemark.session import put_in_place

    class Strict:
        """A store that refuses to rename onto a file."""

        fs = pafs.LocalFileSystem()

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def move(self, a, b):
            if os.path.exists(b):
                raise OSError("exists")
            self.fs.move(a, b)

    for fs in (pafs.LocalFileSystem(), Strict()):
        for name, data in (("t", b"old"), ("tmp", b"new")):
            with open(f"{scratch}/{name}", "wb") as f:
                f.write(data)
        put_in_place(fs, f"{scratch}/tmp", f"{scratch}/t")
        assert _data(f"{scratch}/t") == b"new" and not os.path.exists(f"{scratch}/tmp")
    with pytest.raises(OSError):
        put_in_place(Strict(), f"{scratch}/missing", f"{scratch}/nowhere/t")
