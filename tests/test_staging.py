"""Effect tests in a fresh directory: staging run, copy, collisions, failures, rerun (H1-H4, K6, K7, K9)."""

import datetime as dt
import os

from pyspark.sql import functions as F

from tidemark.operators.files import collisions, execute_transfers, plan_copy, plan_disposition
from tidemark.plans.imaging import move_and_verify
from tidemark.plans.staging import (HISTORY_SCHEMA, create_history, log_folders, read_history,
                                    run_staging)
from tidemark.session import materialize
from tidemark.sources.files import dirs_with_files, file_manifest, folder_files
from tidemark.streaming.incremental import incremental_staging

AS_OF = dt.datetime(2025, 3, 28, 12, 0, 0)


def _drop(root):
    files = {
        "20250328/IM0001": b"dicm-1", "20250328/IM0002": b"dicm-22", "20250328/DICOMDIR": b"index",
        "20250328/a.dcm": b"has-ext", "20250328/sub/IM0009": b"nested", "20250401/IM0001": b"dicm-3",
        "20250401/dicomdir": b"index", "20250401/DicomDir": b"odd", "loose.txt": b"root file",
    }
    for rel, data in files.items():
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "wb") as f:
            f.write(data)
    return files


def test_manifest_and_dirs(spark, scratch):
    src = os.path.join(scratch, "src")
    _drop(src)
    m = file_manifest(spark, src)
    assert m.count() == 9
    assert "content" not in m._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1][:200]
    dirs = {r["directory"].split("/src")[-1] for r in dirs_with_files(m).collect()}
    assert dirs == {"", "/20250328", "/20250328/sub", "/20250401"}
    direct = {(r["folder"], r["name"]) for r in folder_files(m, src).collect()}
    assert ("sub", "IM0009") not in direct and ("src", "loose.txt") not in direct
    assert len(direct) == 7


def test_staging_run_copies_logs_and_reruns_as_noop(spark, scratch):
    src, tgt, hist = (os.path.join(scratch, x) for x in ("src", "tgt", "hist"))
    _drop(src)
    create_history(spark, hist)
    first = {r["source_folder"]: (r["total_files_processed"], r["files_failed"])
             for r in run_staging(spark, src, tgt, hist, as_of=AS_OF).collect()}
    assert first == {"20250328": (2, 0), "20250401": (2, 0)}
    # nested layout: equal names in two folders do not collide; DICOMDIR excluded; a.dcm skipped
    assert sorted(os.listdir(os.path.join(tgt, "20250328"))) == ["IM0001.dcm", "IM0002.dcm"]
    assert sorted(os.listdir(os.path.join(tgt, "20250401"))) == ["DicomDir.dcm", "IM0001.dcm"]
    with open(os.path.join(tgt, "20250401", "IM0001.dcm"), "rb") as f:
        assert f.read() == b"dicm-3"
    second = run_staging(spark, src, tgt, hist, as_of=AS_OF)
    assert second.count() == 0
    h = read_history(spark, hist)
    assert h.count() == 2 and h.select("id").distinct().count() == 2
    assert h.filter(F.col("processed_dttm") == F.lit("2025-03-28 12:00:00").cast("timestamp_ntz")).count() == 2


def test_logged_folder_not_selected(spark, scratch):
    src, tgt, hist = (os.path.join(scratch, x) for x in ("src", "tgt", "hist"))
    _drop(src)
    logged = spark.createDataFrame([("x", src, tgt, "20250328", 2, None, 0)], HISTORY_SCHEMA)
    log_folders(logged, hist)
    out = [r["source_folder"] for r in run_staging(spark, src, tgt, hist, as_of=AS_OF).collect()]
    assert out == ["20250401"]


def test_failed_copy_is_counted_and_retried(spark, scratch):
    src, tgt, hist = (os.path.join(scratch, x) for x in ("src", "tgt", "hist"))
    _drop(src)
    # a directory where a target file must go makes that copy fail
    os.makedirs(os.path.join(tgt, "20250328", "IM0002.dcm"))
    rec = {r["source_folder"]: (r["total_files_processed"], r["files_failed"])
           for r in run_staging(spark, src, tgt, hist, as_of=AS_OF).collect()}
    assert rec["20250328"] == (1, 1)
    again = {r["source_folder"]: (r["total_files_processed"], r["files_failed"])
             for r in run_staging(spark, src, tgt, hist, as_of=AS_OF).collect()}
    # only the incomplete folder is picked up again; the done copy counts as done
    assert again == {"20250328": (1, 1)}


def test_flat_layout_reports_collisions(spark, scratch):
    src = os.path.join(scratch, "src")
    _drop(src)
    plan = plan_copy(folder_files(file_manifest(spark, src), src), "/t", layout="flat")
    assert [r["new_path"] for r in collisions(plan).collect()] == ["/t/IM0001.dcm"]


def test_disposition_routes_by_status_and_moves(spark, scratch):
    src = os.path.join(scratch, "ingest")
    os.makedirs(src)
    for n in ("ok.json", "bad.json"):
        with open(os.path.join(src, n), "w") as f:
            f.write("{}")
    # a snapshot of the listing, so the plan can be re-run after the moves
    m = materialize(file_manifest(spark, src).withColumn(
        "status", F.when(F.col("name") == "ok.json", "processed").otherwise("failed")),
        os.path.join(scratch, "manifest"))
    plan = plan_disposition(m, "status", os.path.join(scratch, "Processed"), os.path.join(scratch, "Failed"))
    out = execute_transfers(plan, "move")
    assert out.filter("ok").count() == 2
    assert os.listdir(os.path.join(scratch, "Processed")) == ["ok.json"]
    assert os.listdir(os.path.join(scratch, "Failed")) == ["bad.json"]
    assert os.listdir(src) == []
    again = execute_transfers(plan, "move")  # a retried move is a no-op success
    assert again.filter("ok").count() == 2


def test_move_and_verify(spark, scratch):
    src, dst = os.path.join(scratch, "raw"), os.path.join(scratch, "process")
    os.makedirs(src)
    for n in ("a.dcm", "b.dcm"):
        with open(os.path.join(src, n), "w") as f:
            f.write("x")
    outcomes, missing = move_and_verify(spark, src, dst)
    assert outcomes.filter("ok").count() == 2 and missing.count() == 0


def test_streaming_incremental_second_run_adds_nothing(spark, scratch):
    src, tgt, hist, ck = (os.path.join(scratch, x) for x in ("src", "tgt", "hist", "ckpt"))
    _drop(src)
    incremental_staging(spark, src, tgt, hist, ck, as_of=AS_OF)
    assert read_history(spark, hist).count() == 2
    incremental_staging(spark, src, tgt, hist, ck, as_of=AS_OF)
    assert read_history(spark, hist).count() == 2
    os.makedirs(os.path.join(src, "20250402"))
    with open(os.path.join(src, "20250402", "IM0100"), "wb") as f:
        f.write(b"new")
    incremental_staging(spark, src, tgt, hist, ck, as_of=AS_OF)
    assert sorted(r["source_folder"] for r in read_history(spark, hist).collect()) == \
        ["20250328", "20250401", "20250402"]


def test_streaming_folder_split_across_batches_is_copied_whole(spark, scratch):
    src, tgt, hist, ck = (os.path.join(scratch, x) for x in ("src", "tgt", "hist", "ckpt"))
    _drop(src)
    incremental_staging(spark, src, tgt, hist, ck, as_of=AS_OF, max_files_per_trigger=2)
    assert sorted(os.listdir(os.path.join(tgt, "20250328"))) == ["IM0001.dcm", "IM0002.dcm"]
    assert sorted(os.listdir(os.path.join(tgt, "20250401"))) == ["DicomDir.dcm", "IM0001.dcm"]
    per_folder = {r["source_folder"]: r["n"] for r in read_history(spark, hist)
                  .groupBy("source_folder").agg(F.sum("total_files_processed").alias("n")).collect()}
    assert per_folder == {"20250328": 2, "20250401": 2}


def test_colliding_targets_are_reported_not_transferred(spark, scratch):
    src = os.path.join(scratch, "in")
    for d in ("a", "b"):
        os.makedirs(os.path.join(src, d))
        with open(os.path.join(src, d, "x.json"), "w") as f:
            f.write(d)  # same name, same size, different content
    m = materialize(file_manifest(spark, src), os.path.join(scratch, "m"))
    plan = plan_disposition(m.withColumn("status", F.lit("processed")), "status",
                            os.path.join(scratch, "done"), os.path.join(scratch, "failed"))
    out = execute_transfers(plan, "move")
    assert out.filter("ok").count() == 0 and out.count() == 2
    assert sorted(os.listdir(os.path.join(src, "a")) + os.listdir(os.path.join(src, "b"))) == \
        ["x.json", "x.json"]


def test_resumed_unit_of_work_logs_once(spark, scratch):
    src, tgt, hist = (os.path.join(scratch, x) for x in ("src", "tgt", "hist"))
    _drop(src)
    work = os.path.join(scratch, "work", "batch-7")
    first = run_staging(spark, src, tgt, hist, as_of=AS_OF, work_dir=work, resume=True)
    again = run_staging(spark, src, tgt, hist, as_of=AS_OF, work_dir=work, resume=True)
    assert first.count() == again.count() == 2
    assert read_history(spark, hist).count() == 2


def test_names_with_spaces_percent_and_hash(spark, scratch):
    src, tgt, hist = (os.path.join(scratch, x) for x in ("src", "tgt", "hist"))
    os.makedirs(os.path.join(src, "2025 03 28"))
    for n in ("IM 0001", "IM%41", "IM#1"):
        with open(os.path.join(src, "2025 03 28", n), "w") as f:
            f.write("x")
    rec = run_staging(spark, src, tgt, hist, as_of=AS_OF).collect()
    assert [(r["source_folder"], r["total_files_processed"], r["files_failed"]) for r in rec] == \
        [("2025 03 28", 3, 0)]
    assert sorted(os.listdir(os.path.join(tgt, "2025 03 28"))) == ["IM 0001.dcm", "IM#1.dcm", "IM%41.dcm"]
