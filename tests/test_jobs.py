"""End-to-end jobs: bronze load (section 3.2) and imaging stages (section 3.3), JSON landing (K5)."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from tidemark.operators.registry import read_registry
from tidemark.plans.bronze import run_bronze_job
from tidemark.plans.imaging import run_imaging_job
from tidemark.sinks.writers import land_json

AS_OF = dt.datetime(2025, 1, 29, 8, 0, 0)


def _write(path, records):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        for r in records:
            f.write(json.dumps(r) + "\n")


def test_bronze_job_routes_loads_repairs_moves_and_registers(spark, scratch):
    land = os.path.join(scratch, "Files", "Ingest", "stock")
    _write(f"{land}/insider-sentiment/TSLA-01-29-2025.json",
           [{"symbol": "TSLA", "change": 5, "filed": "1850-03-04 10:11:12"},
            {"symbol": "TSLA", "change": -2, "filed": "2024-05-06 07:08:09"}])
    _write(f"{land}/insider-sentiment/AAPL-01-29-2025.json",
           [{"symbol": "AAPL", "change": 1, "filed": "2023-01-01 00:00:00", "extra": "x"}])
    _write(f"{land}/financials-reported/TSLA-01-29-2025.json", [{"symbol": "TSLA", "q": 1}])
    _write(f"{land}/unknown-api/X-01-29-2025.json", [{"a": 1}])
    blocked = os.path.join(scratch, "Tables", "financials")
    os.makedirs(os.path.dirname(blocked), exist_ok=True)
    with open(blocked, "w") as f:  # a file where the table must go: the load fails
        f.write("not a table")

    def route(folder, table):
        return (folder, "bronze", table, f"{land}/{folder}", os.path.join(scratch, "Tables", table),
                os.path.join(scratch, "Files", "Processed", folder),
                os.path.join(scratch, "Files", "Failed", folder))

    mapping = spark.createDataFrame(
        [route("insider-sentiment", "sentiment"), route("financials-reported", "financials")],
        "folder string, layer string, table string, source_file_path string, full_target_path string, "
        "processed_file_path string, failed_file_path string")
    registry = os.path.join(scratch, "registry")
    status = {r["folder"]: (r["status"], r["files_moved"]) for r in run_bronze_job(
        spark, land, mapping, "JSON", date_cols=["filed"], registry_path=registry,
        pipeline_name="bronze", run_id="r1").collect()}  # the default clock
    assert status["insider-sentiment"] == ("processed", 2)
    assert status["financials-reported"] == ("failed", 1)
    assert status["unknown-api"] == ("unrouted", 0)

    table = spark.read.parquet(os.path.join(scratch, "Tables", "sentiment"))
    assert table.count() == 3 and "hash" in table.columns
    filed = {r["change"]: r["filed"] for r in table.collect()}
    assert filed[5] == dt.datetime(1900, 1, 1)  # sentinel, typed as timestamp
    assert sorted(os.listdir(os.path.join(scratch, "Files", "Processed", "insider-sentiment"))) == \
        ["AAPL-01-29-2025.json", "TSLA-01-29-2025.json"]
    assert os.listdir(os.path.join(scratch, "Files", "Failed", "financials-reported")) == \
        ["TSLA-01-29-2025.json"]
    reg = read_registry(spark, registry).collect()
    assert [(r["tableName"], r["layer"]) for r in reg] == [("sentiment", "bronze")]


def _bronze(spark, scratch, land, mapping, **more):
    return {(r["folder"], r["status"]): (r["files_moved"], r["error"])
            for r in run_bronze_job(spark, land, mapping, "JSON", **more).collect()}


def _one_route(spark, scratch, folder="foo"):
    return spark.createDataFrame(
        [(folder, "bronze", folder, "in", os.path.join(scratch, "Tables", folder), os.path.join(scratch, "done"),
          os.path.join(scratch, "bad"))],
        "folder string, layer string, table string, source_file_path string, full_target_path string, "
        "processed_file_path string, failed_file_path string")


def test_bronze_refuses_what_it_could_not_move_and_never_loads_twice(spark, scratch):
    land, table = os.path.join(scratch, "in"), os.path.join(scratch, "Tables", "foo")
    _write(f"{land}/foo/a.json", [{"v": 1}])
    _write(f"{land}/z/foo/a.json", [{"v": 2}])  # the same name in another directory of the route
    mapping = _one_route(spark, scratch)
    assert set(_bronze(spark, scratch, land, mapping)) == {("foo", "refused")}
    assert not os.path.exists(table)
    os.rename(f"{land}/z/foo/a.json", f"{land}/z/foo/b.json")
    assert set(_bronze(spark, scratch, land, mapping)) == {("foo", "processed")}
    assert sorted(r["v"] for r in spark.read.parquet(table).collect()) == [1, 2]
    # the next day's drop has a processed name: refused, source intact, table unchanged
    _write(f"{land}/foo/a.json", [{"v": 3}])
    for _ in range(2):
        assert set(_bronze(spark, scratch, land, mapping)) == {("foo", "refused")}
    assert os.path.exists(f"{land}/foo/a.json") and spark.read.parquet(table).count() == 2
    # keeping both loads it once
    assert set(_bronze(spark, scratch, land, mapping, on_exists="keep_both")) == {("foo", "processed")}
    assert sorted(r["v"] for r in spark.read.parquet(table).collect()) == [1, 2, 3]
    assert len(os.listdir(os.path.join(scratch, "done"))) == 3 and os.listdir(f"{land}/foo") == []


def test_bronze_looks_for_claimed_names_without_a_listing(spark, scratch, monkeypatch):
    import tidemark.plans.bronze as B

    def listed(*_):
        raise AssertionError("the processed folder was listed")

    monkeypatch.setattr(B, "list_tree", listed, raising=False)
    land, mapping = os.path.join(scratch, "in"), _one_route(spark, scratch)
    for name in ("a b%20.json", "other.json"):
        _write(os.path.join(scratch, "done", name), [{"v": 0}])
    _write(f"{land}/foo/a b%20.json", [{"v": 1}])
    assert set(_bronze(spark, scratch, land, mapping)) == {("foo", "refused")}
    os.rename(f"{land}/foo/a b%20.json", f"{land}/foo/new.json")
    assert set(_bronze(spark, scratch, land, mapping)) == {("foo", "processed")}


def test_landed_event_files_grow_in_number_not_in_size(spark):
    from tidemark.workloads import event_files

    day = F.expr("timestamp'2024-01-01' + make_dt_interval(cast(id % 3 as int))")
    for n in (600, 6_000):
        ev = spark.range(n).select(F.col("id").alias("event_id"), day.alias("ts"), (F.col("id") % 7).alias("user_id"), F.lit("view").alias("event_type"))
        sizes = [r["k"] for r in event_files(ev, 100).select(F.size(F.split("c", "\n")).alias("k")).collect()]
        assert sum(sizes) == n and n / 150 <= len(sizes) <= n / 100 + 3 and max(sizes) < 200


def test_bronze_registration_fault_does_not_fail_the_load(spark, scratch):
    land = os.path.join(scratch, "in")
    _write(f"{land}/foo/a b%1.json", [{"v": 1}])
    registry = os.path.join(scratch, "registry")
    os.makedirs(registry)
    with open(os.path.join(registry, "part-0.parquet"), "w") as f:
        f.write("not a table")
    got = _bronze(spark, scratch, land, _one_route(spark, scratch), registry_path=registry)
    (moved, error), = got.values()
    assert list(got) == [("foo", "processed")] and moved == 1 and error.startswith("registration")
    assert os.listdir(os.path.join(scratch, "done")) == ["a b%1.json"]


def test_bronze_rejects_a_pair_policy(spark, scratch):
    import pytest

    with pytest.raises(ValueError):
        run_bronze_job(spark, scratch, None, policy="quarantine")


def test_imaging_job_stages_and_resume(spark, scratch):
    studies = spark.createDataFrame([(1, 100, "CT"), (2, 100, "MR"), (3, 200, "US")],
                                    "study long, patient long, modality string")
    instances = spark.createDataFrame(
        [(1, 1, '{"rows": 512, "cols": 512}'), (1, 2, '{"rows": 256, "cols": 256}'),
         (2, 1, '{"rows": 128, "cols": 64}')], "study_fk long, n int, tags string")
    work = os.path.join(scratch, "run")
    raw, process = os.path.join(scratch, "raw"), os.path.join(scratch, "process")
    os.makedirs(raw)
    for n in ("IM1", "IM2"):
        with open(os.path.join(raw, n), "w") as f:
            f.write("x")
    bronze, silver = run_imaging_job(spark, studies, instances, "study", "study_fk", "patient", work,
                                     "imaging", "r1", AS_OF, tags_col="tags",
                                     tag_schema="rows int, cols int", raw_dir=raw, process_dir=process)
    assert sorted(os.listdir(process)) == ["IM1", "IM2"] and os.listdir(raw) == []
    assert bronze.count() == 2 and "_createdByPipelineRunID" in bronze.columns
    rows = sorted((r["patient"], r["study"], r["n"], r["rows"]) for r in silver.collect())
    assert rows == [(100, 1, 1, 512), (100, 1, 2, 256), (100, 2, 1, 128), (200, 3, None, None)]
    # a rerun reuses the finished stage tables
    marker = os.path.getmtime(os.path.join(work, "documents", "_SUCCESS"))
    _, silver2 = run_imaging_job(spark, studies, instances, "study", "study_fk", "patient", work,
                                 "imaging", "r1", AS_OF, tags_col="tags", tag_schema="rows int, cols int")
    assert os.path.getmtime(os.path.join(work, "documents", "_SUCCESS")) == marker
    assert silver2.count() == 4


def test_land_json_partitions_by_api(spark, scratch):
    df = spark.createDataFrame([("stock/insider-sentiment", "TSLA", 1), ("foo", "X", 2)],
                               "api string, symbol string, v int") \
        .withColumn("ts", F.lit("2025-01-29 10:00:00").cast("timestamp"))
    land_json(df, os.path.join(scratch, "landing"), "api", "symbol", "ts")
    back = spark.read.json(os.path.join(scratch, "landing"))
    names = {r["v"]: r["landing_name"] for r in back.collect()}
    assert names == {1: "TSLA-01-29-2025.json", 2: "None-01-29-2025.json"}


def test_a_batch_of_small_files_is_read_by_few_tasks(spark, scratch):
    """Only names and sizes are read, so a task takes far more than 32 files."""
    from tidemark.streaming.incremental import incremental_staging

    os.makedirs(f"{scratch}/in/20240101")
    for i in range(200):
        with open(f"{scratch}/in/20240101/f{i}", "w") as f:
            f.write(str(i))
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    incremental_staging(spark, f"{scratch}/in", f"{scratch}/out", f"{scratch}/hist", f"{scratch}/ckpt")
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before
    plan = f"{scratch}/ckpt/tidemark-batches/0/plan"
    assert spark.read.parquet(plan).count() == 200
    assert len([f for f in os.listdir(plan) if f.startswith("part-")]) <= 4
