"""Late children of nested documents."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import doctable
from tidemark.operators.doctable import DocumentTable
from tidemark.operators.documents import nest


def _docs(df):
    return sorted((r["k"] or "", r["part"], tuple(sorted(tuple(i) for i in r["items"]))) for r in df.collect())


def _files(table):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{table.path}/documents/bucket=*/*.parquet")}


def test_late_children_equal_nesting_at_once(spark, scratch):
    rows = spark.range(3_000).select(F.when(F.col("id") % 50 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id") % 97)).alias("k"),
                                     "id", (F.col("id") % 7).cast("string").alias("v"))
    table = DocumentTable(f"{scratch}/t", ("k",), ("id", "v"), "items", buckets=8, max_items=40)
    assert len(table.add(rows.where("id < 2700"))) == 8
    table.add(rows.where("id >= 2700"))
    got = table.read(spark)
    whole = nest(rows, ["k"], ["id", "v"], "items", max_items=40)
    per = lambda d: sorted((r["k"] or "", r["n"], tuple(r["ids"])) for r in d.groupBy("k").agg(
        F.sum(F.size("items")).alias("n"), F.sort_array(F.flatten(F.collect_list("items.id"))).alias("ids")).collect())
    assert per(got) == per(whole)
    assert got.groupBy("k").agg(F.count("part").alias("n"), F.max("part").alias("m")).where("n <> m + 1").count() == 0


def test_untouched_buckets_keep_their_files(spark, scratch):
    rows = spark.range(400).select(F.concat(F.lit("k"), F.col("id") % 40).alias("k"), "id")
    table = DocumentTable(f"{scratch}/t", ("k",), ("id",), "items", buckets=16)
    table.add(rows)
    before = _files(table)
    touched = table.add(spark.createDataFrame([("k3", 9_001), ("k3", 9_002), ("new", 9_003)], "k string, id bigint"))
    after = _files(table)
    assert 1 <= len(touched) <= 2
    mine = tuple(f"/bucket={b}/" for b in touched)
    same = {p: t for p, t in before.items() if not any(m in p for m in mine)}
    assert same and same.items() <= after.items() and not {p for p in before if any(m in p for m in mine)} & set(after)
    docs = {r["k"]: [i["id"] for i in r["items"]] for r in table.read(spark).collect()}
    assert len(docs) == 41 and docs["new"] == [9_003] and docs["k3"][-2:] == [9_001, 9_002] and len(docs["k3"]) == 12


def test_a_unit_that_stops_is_nested_once(spark, scratch, monkeypatch):
    table = DocumentTable(f"{scratch}/t", ("k",), ("id",), "items", buckets=4)
    one = spark.createDataFrame([("a", 1), ("b", 2)], "k string, id bigint")
    two = spark.createDataFrame([("a", 3), ("c", 4)], "k string, id bigint")
    table.add(one, unit="u1")
    monkeypatch.setattr(doctable, "touch", lambda p: (_ for _ in ()).throw(RuntimeError("stops before the mark")))
    with pytest.raises(RuntimeError):
        table.add(two, unit="u2")
    monkeypatch.undo()
    table.add(two, unit="u2")
    assert table.add(two, unit="u2") == []
    assert _docs(table.read(spark)) == [("a", 0, ((1,), (3,))), ("b", 0, ((2,),)), ("c", 0, ((4,),))]
