"""Set-based lookups: history anti join, routing, schema registry."""

import datetime as dt

from tidemark.operators.lookup import (bounded_broadcast, lookup_route, route_all, route_first,
                                       route_sources, schema_exists, seen_folders,
                                       unprocessed_folders)
from tidemark.operators.registry import (read_registry, registry_first, registry_insert,
                                         schema_candidates)
from tidemark.plans.staging import HISTORY_SCHEMA


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _history(spark, rows):
    full = [(None, "/src", "/tgt", f, n, None, failed) for f, n, failed in rows]
    return spark.createDataFrame(full, HISTORY_SCHEMA)


def test_unprocessed_folders_anti_join(spark):
    folders = spark.createDataFrame([("20250328",), ("20250401",), (None,), ("20250402",)], "folder string")
    hist = _history(spark, [("20250328", 3, 0), ("20250402", 1, 2)])
    got = sorted((r["folder"] or "") for r in unprocessed_folders(folders, hist).collect())
    # logged folder skipped; folder with failed copies retried; NULL folder kept
    assert got == ["", "20250401", "20250402"]


def test_anti_join_broadcast_only_within_bound(spark):
    folders = spark.createDataFrame([("a",), ("b",)], "folder string")
    hist = _history(spark, [("a", 1, 0)])
    assert "BroadcastHashJoin" in _plan(unprocessed_folders(folders, hist))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(unprocessed_folders(folders, hist, max_broadcast_rows=0))
        assert "BroadcastHashJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bounded_broadcast_counts_at_most_bound_plus_one(spark):
    df = spark.range(10)
    assert bounded_broadcast(df, 9) is df
    assert bounded_broadcast(df, 10) is not df
    wide = spark.range(10).selectExpr("repeat('x', 1000) AS s")
    assert bounded_broadcast(wide, 10, max_bytes=5_000) is wide  # few rows, too many bytes
    assert bounded_broadcast(wide, 10, max_bytes=50_000) is not wide


def test_rows_of_unprocessed_folders_both_paths(spark):
    from tidemark.operators.lookup import rows_of_unprocessed_folders
    files = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4)], "folder string, f int")
    hist = _history(spark, [("a", 2, 0), ("c", 1, 1)])
    small = rows_of_unprocessed_folders(files, hist)
    large = rows_of_unprocessed_folders(files, hist, max_broadcast_rows=0)
    assert sorted(r["f"] for r in small.collect()) == sorted(r["f"] for r in large.collect()) == [3, 4]


def test_seen_folders_flag(spark):
    folders = spark.createDataFrame([("a",), ("b",)], "folder string")
    got = {r["folder"]: r["processed"] for r in seen_folders(folders, _history(spark, [("a", 1, 0)])).collect()}
    assert got == {"a": True, "b": False}


def _mapping(spark):
    rows = [("financials", "bronze", "t1", "s1", "f1", "p1", "x1"),
            ("financials", "bronze", "t0", "s0", "f0", "p0", "x0"),  # duplicate key: smallest wins
            ("financials", "silver", "ts", "ss", "fs", "ps", "xs"),
            ("sentiment", "bronze", "t2", "s2", "f2", "p2", "x2")]
    return spark.createDataFrame(rows, "folder string, layer string, table string, source_file_path string, "
                                       "full_target_path string, processed_file_path string, failed_file_path string")


def test_route_sources_and_rejects(spark):
    probe = spark.createDataFrame([("financials",), ("sentiment",), ("unknown",)], "folder string")
    routed, rejects = route_sources(probe, _mapping(spark))
    got = {r["folder"]: r["table"] for r in routed.collect()}
    assert got == {"financials": "t0", "sentiment": "t2"}
    assert [r["folder"] for r in rejects.collect()] == ["unknown"]
    flagged = {r["folder"]: r["_routed"] for r in route_all(probe, _mapping(spark), layer="silver").collect()}
    assert flagged == {"financials": True, "sentiment": False, "unknown": False}


def test_route_first_and_lookup(spark):
    m = _mapping(spark)
    assert route_first(m, "sentiment").count() == 1
    assert lookup_route(m, "financials", "silver") == ("ts", "ss", "fs", "ps", "xs")
    assert lookup_route(m, "nope") is None
    try:
        route_first(m, "sentiment", "copper")
    except ValueError:
        pass
    else:
        raise AssertionError("unknown layer accepted")


def test_registry_insert_first_and_exists(spark, scratch):
    a = spark.createDataFrame([(1, "x")], "id long, name string")
    b = spark.createDataFrame([(1.0,)], "v double")
    path = f"{scratch}/registry"
    when = dt.datetime(2025, 1, 1)
    registry_insert(spark, path, [{"tableName": "a", "layer": "bronze", "schemaDefinition": a.schema}],
                    "pipe", "run-1", when)
    registry_insert(spark, path, [{"tableName": "b", "layer": "silver", "schemaDefinition": b.schema}],
                    "pipe", "run-2", when)
    reg = read_registry(spark, path)
    assert sorted(r["id"] for r in reg.collect()) == [1, 2]
    first = registry_first(reg).first()
    assert (first["id"], first["tableName"], first["layer"]) == (1, "a", "bronze")
    assert "'" not in first["schemaDefinition"] and '"id"' in first["schemaDefinition"]
    c = spark.createDataFrame([(2, "y")], "id long, name string")  # same schema as a
    cands = schema_candidates(spark, {"c": c, "d": spark.range(1)})
    assert [r["tableName"] for r in schema_exists(cands, reg).collect()] == ["c"]
    flags = {r["tableName"]: r["registered"] for r in schema_exists(cands, reg, flag_col="registered").collect()}
    assert flags == {"c": True, "d": False}
