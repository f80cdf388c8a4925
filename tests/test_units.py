"""Exactly-once logging, the open-failures table, frontier listing, landing
files by key, the registry as a set, typed appends."""

import datetime as dt
import glob
import json
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType,
                               NullType, ShortType, StringType, StructField, StructType, TimestampNTZType)

from tidemark.operators.registry import read_registry, registry_first, registry_insert, registry_merge
from tidemark.plans.staging import HISTORY_SCHEMA, create_history, log_folders, read_history, run_staging
from tidemark.sinks.writers import append_bronze, land_rows, write_unit
from tidemark.sources.files import list_tree
from tidemark.sources.typed import join_types, read_typed
from tidemark.streaming import incremental
from tidemark.streaming.incremental import incremental_staging

AS_OF = dt.datetime(2025, 1, 1)


def _put(path, data=b"x"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def _history(spark, path):
    return sorted((r["source_folder"], r["total_files_processed"], r["files_failed"]) for r in read_history(spark, path).collect())


# -- units ----------------------------------------------------------------------

def test_a_unit_replaces_itself_and_nothing_else(spark, scratch):
    path = f"{scratch}/t"
    rows = lambda *v: spark.createDataFrame([(x,) for x in v], "v int")
    write_unit(rows(1, 2), path, "a")
    write_unit(rows(3), path, "b")
    write_unit(rows(4, 5, 6), path, "a")
    write_unit(rows(), path, "c")
    read = spark.read.option("recursiveFileLookup", "true").schema("v int").parquet(path)
    assert sorted(r.v for r in read.collect()) == [3, 4, 5, 6]


def test_history_of_older_layout_is_still_read(spark, scratch):
    path = f"{scratch}/h"
    create_history(spark, path)
    old = spark.createDataFrame([("i", "s", "t", "f0", 1, AS_OF, 0)], HISTORY_SCHEMA)
    old.write.mode("append").parquet(path)
    log_folders(old.withColumn("source_folder", F.lit("f1")), path)
    assert [r[0] for r in _history(spark, path)] == ["f0", "f1"]


def test_a_batch_run_that_stops_after_logging_logs_once(spark, scratch, monkeypatch):
    from tidemark.plans import staging

    _put(f"{scratch}/in/d1/IM1"), _put(f"{scratch}/in/d2/IM1")
    args = (spark, f"{scratch}/in", f"{scratch}/out", f"{scratch}/h")
    log = staging.log_folders

    def dies(*a, **k):
        log(*a, **k)
        raise RuntimeError("after the log")

    monkeypatch.setattr(staging, "log_folders", dies)
    for _ in range(2):
        with pytest.raises(RuntimeError):
            run_staging(*args, work_dir=f"{scratch}/w", resume=True)
    monkeypatch.setattr(staging, "log_folders", log)
    run_staging(*args, work_dir=f"{scratch}/w", resume=True)
    assert _history(spark, f"{scratch}/h") == [("d1", 1, 0), ("d2", 1, 0)]


def test_a_stream_that_stops_between_log_and_commit(spark, scratch):
    src, tgt, hist, ck = (f"{scratch}/{x}" for x in ("in", "t", "h", "ck"))
    for d in ("d1", "d2", "d3"):
        _put(f"{src}/{d}/IM1"), _put(f"{src}/{d}/IM2")
    calls = []

    def dies(epoch):
        calls.append(epoch)
        if len(calls) < 3:
            raise RuntimeError("after the log")

    for _ in range(2):
        with pytest.raises(StreamingQueryException):
            incremental_staging(spark, src, tgt, hist, ck, max_files_per_trigger=3, on_logged=dies)
    incremental_staging(spark, src, tgt, hist, ck, max_files_per_trigger=3, on_logged=dies)
    assert calls == [0, 0, 0, 1]
    assert sum(r[1] for r in _history(spark, hist)) == 6
    incremental_staging(spark, src, tgt, hist, ck)
    assert sum(r[1] for r in _history(spark, hist)) == 6


def test_retries_read_what_is_open_and_the_batches_since(spark, scratch, monkeypatch):
    src, tgt, hist, ck = (f"{scratch}/{x}" for x in ("in", "t", "h", "ck"))
    for k in range(3):
        _put(f"{src}/d{k}/IM1")
        if k != 1:
            os.makedirs(f"{tgt}/d{k}/IM1.dcm")  # blocks the copy
        incremental_staging(spark, src, tgt, hist, ck)
    assert _history(spark, hist) == [("d0", 0, 1), ("d1", 1, 0), ("d2", 0, 1)]
    read = []
    real = spark.read.__class__.parquet

    def spy(self, *paths, **k):
        read.extend(p for p in paths if "tidemark-batches" in p)
        return real(self, *paths, **k)

    monkeypatch.setattr(spark.read.__class__, "parquet", spy)
    os.rmdir(f"{tgt}/d0/IM1.dcm")
    incremental_staging(spark, src, tgt, hist, ck)
    assert {p.split("tidemark-batches/")[1].split("/")[0] for p in read} == {"2"}  # not those of all time
    assert ("d0", 1, 0) in _history(spark, hist) and os.path.isfile(f"{tgt}/d0/IM1.dcm")
    os.rmdir(f"{tgt}/d2/IM1.dcm")
    # the retry stops after it has logged: it runs again under its number
    monkeypatch.setattr(incremental, "materialize", lambda df, path=None, **k: (_ for _ in ()).throw(RuntimeError())
                        if path and "tidemark-open" in path else _materialize(df, path, **k))
    with pytest.raises(RuntimeError):
        incremental_staging(spark, src, tgt, hist, ck)
    monkeypatch.setattr(incremental, "materialize", _materialize)
    for _ in range(2):
        incremental_staging(spark, src, tgt, hist, ck)
    rows = _history(spark, hist)
    assert rows.count(("d2", 1, 0)) == 1 and rows.count(("d0", 1, 0)) == 1 and len(rows) == 5


from tidemark.session import materialize as _materialize  # noqa: E402


# -- a history table bucketed by folder -------------------------------------------

def _exchanges(df):
    """Names of the tables (or else "rows") below each shuffle of the plan."""
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    out = []
    for i, line in enumerate(plan):
        if " Exchange hashpartitioning" in line:
            depth = len(line) - len(line.lstrip(" :+-"))
            below = []
            for later in plan[i + 1:]:
                if len(later) - len(later.lstrip(" :+-")) <= depth:
                    break
                below.append(later)
            out.append("\n".join(below))
    return out


def test_a_bucketed_history_is_not_shuffled(spark, scratch):
    from tidemark.operators.lookup import unprocessed_folders

    name = "tidemark_test_bucketed_history"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    create_history(spark, f"{scratch}/hist", name=name, buckets=16)
    rows = spark.range(500).select(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name not in ("source_folder", "files_failed")
                                     else (F.concat(F.lit("d"), "id") if f.name == "source_folder" else F.lit(0).cast("long")).alias(f.name)
                                     for f in HISTORY_SCHEMA.fields])
    for _ in range(2):  # the unit is logged again: nothing doubles
        log_folders(rows, name, "table", unit="u1")
    log_folders(rows.limit(1).withColumn("source_folder", F.lit("more")), name, "table", unit="u2")
    history = read_history(spark, name, "table")
    assert history.count() == 501 and history.columns == HISTORY_SCHEMA.fieldNames()
    folders = spark.range(400, 600).select(F.concat(F.lit("d"), "id").alias("folder"))
    todo = unprocessed_folders(folders, history, max_broadcast_rows=0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert todo.count() == 100
        below = _exchanges(unprocessed_folders(folders, history, max_broadcast_rows=0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert below and not any("Scan parquet" in b for b in below)
    _put(f"{scratch}/in/d5/IM1"), _put(f"{scratch}/in/new/IM1")
    run_staging(spark, f"{scratch}/in", f"{scratch}/out", name, fmt="table")
    assert read_history(spark, name, "table").where("source_folder = 'new'").count() == 1
    assert not os.path.exists(f"{scratch}/out/d5")
    spark.sql(f"DROP TABLE {name}")


# -- listing --------------------------------------------------------------------

def _tree(root):
    out = set()
    for base, dirs, files in os.walk(root):
        for d in dirs:
            out.add((os.path.relpath(os.path.join(base, d), root), True))
        out |= {(os.path.relpath(os.path.join(base, f), root), False) for f in files}
    return out


@pytest.mark.parametrize("ahead", [0, 3, 64])
def test_frontier_listing_finds_every_entry(spark, scratch, ahead):
    root = f"{scratch}/tree"
    for i in range(40):
        _put(f"{root}/many/d{i}/e/f{i}")
    _put(f"{root}/top"), _put(f"{root}/_hidden/.x", b""), os.makedirs(f"{root}/empty/more")
    deep = "/".join(f"n{i}" for i in range(12))
    _put(f"{root}/{deep}/leaf")
    got = list_tree(spark, root, ahead=ahead)
    assert {(r["path"].split("/tree/")[1], r["is_dir"]) for r in got.collect()} == _tree(root)
    assert got.count() == len(_tree(root))


def test_a_folder_with_all_sub_folders_is_spread(spark, scratch, monkeypatch):
    root = f"{scratch}/tree"
    for i in range(200):
        _put(f"{root}/one/d{i}/f")
    from tidemark.sources import files

    seen = []
    monkeypatch.setattr(files, "materialize", lambda df, path: seen.append(_materialize(df, path)) or seen[-1])
    list_tree(spark, root, num_partitions=8, ahead=4)
    last = seen[-1].where("NOT is_dir").select(F.col("_metadata.file_path").alias("p")).groupBy("p").count().collect()
    assert len(last) == 8 and max(r["count"] for r in last) <= 40  # 200 folders over 8 tasks


# -- landing files ---------------------------------------------------------------

def test_landing_files_by_key(spark, scratch):
    rows = [("a", "U1-01.json", f'{{"n": {i}}}') for i in range(250)] + [("a", "U2-01.json", '{"n": 1}'), ("b", "U1-01.json", '{"n": "é"}')]
    rows += [("b", "same.json", '{"n": 0}')] * 120 + [("c", "noext", "x")] * 3
    df = spark.createDataFrame(rows, "d string, n string, l string").repartition(5)
    out = land_rows(df, f"{scratch}/land", "d", "n", "l", max_rows=50)
    found = {os.path.relpath(p, f"{scratch}/land"): open(p, encoding="utf-8").read().splitlines()
             for p in glob.glob(f"{scratch}/land/*/*")}
    base = lambda p: p if p.count(".") < 2 else p[:p.index(".")] + ".json"
    merged = {}
    for p, lines in found.items():
        assert 0 < len(lines) <= 100 and lines == sorted(lines)
        merged.setdefault(base(p), []).extend(lines)
    want = {}
    for d, n, line in rows:
        want.setdefault(f"{d}/{n}", []).append(line)
    assert {k: sorted(v) for k, v in merged.items()} == {k: sorted(v) for k, v in want.items()}
    assert out.where("NOT ok").count() == 0 and out.agg(F.sum("rows")).head()[0] == len(rows)
    again = land_rows(df.where("d <> 'a' AND n <> 'same.json'"), f"{scratch}/land", "d", "n", "l")
    assert again.where("ok").count() == 2  # equal bytes are there already
    other = df.where("d = 'c'").withColumn("l", F.lit("y"))
    assert land_rows(other, f"{scratch}/land", "d", "n", "l").head()["error"] == "target exists with other content"
    assert open(f"{scratch}/land/c/noext").read() == "x\nx\nx\n"
    assert land_rows(other, f"{scratch}/land", "d", "n", "l", overwrite=True).where("ok").count() == 1
    assert open(f"{scratch}/land/c/noext").read() == "y\ny\ny\n"
    assert not [p for p in glob.glob(f"{scratch}/land/*/.*")]


# -- registry --------------------------------------------------------------------

def _candidates(spark, *rows):
    return spark.createDataFrame(rows, "tableName string, schemaDefinition string, layer string, extra int")


def test_registry_takes_each_key_once(spark, scratch):
    path = f"{scratch}/reg"
    first = registry_merge(_candidates(spark, ("b", "{'x': 1}", "Silver", 1), ("a", "s", "bronze", 2), ("a", "s", "bronze", 3),
                                       (None, "s", "gold", 4)), path, "p", "r1", AS_OF)
    assert sorted((r["id"], r["tableName"], r["layer"], r["schemaDefinition"]) for r in first.collect()) == \
        [(1, None, "gold", "s"), (2, "a", "bronze", "s"), (3, "b", "silver", '{"x": 1}')]
    second = registry_merge(_candidates(spark, ("a", "s", "bronze", 0), ("c", "t", "bronze", 0), (None, "s", "gold", 0),
                                        ("b", "{'x': 1}", "gold", 0), ("b", None, "gold", 0)), path, "p", "r2", AS_OF)
    assert sorted((r["id"], r["tableName"], r["schemaDefinition"]) for r in second.collect()) == [(4, "b", None), (5, "c", "t")]
    assert sorted(r["id"] for r in read_registry(spark, path).collect()) == [1, 2, 3, 4, 5]
    assert tuple(registry_first(read_registry(spark, path)).head()) == (1, None, "gold", None, "s")
    assert registry_merge(_candidates(spark, ("a", "s", "bronze", 0)), path, "p", "r3", AS_OF).count() == 0
    registry_insert(spark, path, [{"tableName": "z", "schemaDefinition": "q"}], "p", "r4")
    assert read_registry(spark, path).count() == 6


def test_a_repeated_registry_run_replaces_its_own_rows(spark, scratch):
    path = f"{scratch}/reg"
    registry_merge(_candidates(spark, ("a", "s", "bronze", 0)), path, "p", "r1", AS_OF, unit="u1")
    for _ in range(3):
        registry_merge(_candidates(spark, ("a", "s", "bronze", 0), ("b", "s", "bronze", 0)), path, "p", "r2", AS_OF, unit="u2")
    assert sorted((r["id"], r["tableName"]) for r in read_registry(spark, path).collect()) == [(1, "a"), (2, "b")]


def test_registry_refuses_unknown_layers(spark, scratch):
    for layer in ("copper", None):
        with pytest.raises(ValueError):
            registry_merge(_candidates(spark, ("a", "s", "bronze", 0), ("b", "s", layer, 0)), f"{scratch}/reg", "p", "r")
    assert not os.path.exists(f"{scratch}/reg")


def test_ids_follow_the_key_over_many_partitions(spark, scratch):
    rows = spark.range(5_000).select(F.lpad(F.col("id").cast("string"), 5, "0").alias("tableName"), F.lit("s").alias("schemaDefinition"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = registry_merge(rows.orderBy(F.rand(3)), f"{scratch}/reg", "p", "r", AS_OF)
        assert sorted((r["id"], r["tableName"]) for r in got.collect()) == [(i + 1, f"{i:05}") for i in range(5_000)]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


# -- typed appends ---------------------------------------------------------------

def test_types_meet_in_a_lattice():
    i, n, d, f, s, t = IntegerType(), LongType(), DoubleType(), FloatType(), StringType(), TimestampNTZType()
    kinds = [ShortType(), i, n, f, d, s, BooleanType(), DateType(), t, DecimalType(10, 2), NullType(), ArrayType(i),
             StructType([StructField("a", i)])]
    for a in kinds:
        assert join_types(a, a) == a and join_types(a, NullType()) == a
        for b in kinds:
            assert join_types(a, b) == join_types(b, a)
    assert join_types(i, n) == n and join_types(n, d) == d and join_types(i, f) == d and join_types(ShortType(), f) == f
    assert join_types(d, s) == s and join_types(DateType(), t) == t and join_types(BooleanType(), i) == s
    assert join_types(DecimalType(10, 2), i) == DecimalType(12, 2) and join_types(DecimalType(10, 2), d) == d
    assert join_types(DecimalType(38, 2), DecimalType(38, 30)) == s
    assert join_types(ArrayType(i), ArrayType(s)) == ArrayType(s) and join_types(ArrayType(i), i) == s


def test_batches_of_conflicting_types(spark, scratch):
    path = f"{scratch}/t"
    frames = [
        spark.sql("SELECT 1 AS k, 2 AS v, named_struct('a', 1, 'b', 'x') AS s, array(1, 2) AS l, date'2024-01-02' AS d, true AS o"),
        spark.sql("SELECT 9000000000 AS k, 2.5D AS v, named_struct('b', 'y', 'c', 1.5D) AS s, array(7000000000) AS l, "
                  "timestamp_ntz'2024-01-02 03:04:05' AS d, 1 AS o"),
        spark.sql("SELECT 3 AS k, 'text' AS v, CAST(NULL AS struct<a: bigint>) AS s, array(1) AS `new col`, false AS o"),
        spark.sql("SELECT 4 AS k, array(1, 2) AS v").limit(0)]
    for f in frames:
        append_bronze(f, path)
    os.makedirs(f"{path}/sub"), frames[0].coalesce(1).write.mode("append").parquet(f"{path}/sub/batch=7")
    out = read_typed(spark, path)
    assert dict(out.dtypes)["k"] == "bigint" and dict(out.dtypes)["v"] == "string" and dict(out.dtypes)["l"] == "array<bigint>"
    rows = sorted(((r["k"], r["v"], r["s"] and r["s"].asDict(), r["l"], r["d"], r["o"], r["new col"]) for r in out.collect()), key=str)
    one = (1, "2", {"a": 1, "b": "x", "c": None}, [1, 2], dt.datetime(2024, 1, 2), "true", None)
    assert rows == sorted([one, one, (3, "text", None, None, None, "false", [1]),
                           (9000000000, "2.5", {"a": None, "b": "y", "c": 1.5}, [7000000000], dt.datetime(2024, 1, 2, 3, 4, 5), "1", None)], key=str)
    with pytest.raises(FileNotFoundError):
        read_typed(spark, f"{scratch}/t/sub/none") if os.path.exists(f"{scratch}/t/sub/none") else read_typed(spark, _empty(scratch))


def _empty(scratch):
    os.makedirs(f"{scratch}/none")
    return f"{scratch}/none"


def test_files_of_other_writers_have_types_too(spark, scratch):
    import pyarrow as pa
    import pyarrow.parquet as pq

    os.makedirs(f"{scratch}/t")
    pq.write_table(pa.table({"k": pa.array([1], pa.int32()), "j": pa.array([json.dumps({"a": 1})])}), f"{scratch}/t/a.parquet")
    pq.write_table(pa.table({"k": pa.array([2.5])}), f"{scratch}/t/b.parquet")
    assert sorted((r["k"], r["j"]) for r in read_typed(spark, f"{scratch}/t").collect()) == [(1.0, '{"a": 1}'), (2.5, None)]
