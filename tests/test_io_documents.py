"""Readers, sinks and nested documents."""

import json
import os
import re

from pyspark.sql import functions as F

from tidemark.operators.documents import extract_tags, flatten_all, nest, nest_two_levels
from tidemark.sinks.writers import append_bronze, read_bronze, write_ndjson
from tidemark.sources.readers import load_data, read_documents


def test_load_data_formats(spark, scratch):
    p = os.path.join(scratch, "r.json")
    with open(p, "w") as f:
        f.write(json.dumps([{"a": 1}, {"a": 2}]))
    df = load_data(spark, p, "JSON", {"multiLine": "true"})
    assert sorted(r["a"] for r in df.collect()) == [1, 2]  # top-level array: one row per element
    c = os.path.join(scratch, "r.csv")
    with open(c, "w") as f:
        f.write("x,y\n1,2\n")
    assert load_data(spark, c, "csv").columns == ["_c0", "_c1"]
    assert load_data(spark, c, "csv", {"header": "true"}).columns == ["x", "y"]
    try:
        load_data(spark, c, "xml")
    except ValueError:
        pass
    else:
        raise AssertionError("xml accepted")


def test_corrupt_ndjson(spark, scratch):
    p = os.path.join(scratch, "docs.ndjson")
    with open(p, "w") as f:
        f.write('{"a":1}\n{bad\n{"a":"x"}\n')
    df = read_documents(spark, p, spark.createDataFrame([], "a bigint").schema).cache()
    assert df.filter(F.col("_corrupt_record").isNull()).count() == 1
    assert df.filter(F.col("_corrupt_record").isNotNull()).count() == 2


def test_merge_schema_append(spark, scratch):
    path = f"{scratch}/bronze"
    append_bronze(spark.createDataFrame([(1, "a")], "k long, x string"), path)
    append_bronze(spark.createDataFrame([(2, 2.5)], "k long, y double"), path)
    out = read_bronze(spark, path)
    assert sorted(out.columns) == ["k", "x", "y"] and out.count() == 2


def _family(spark):
    parents = spark.createDataFrame([(1, 10, "a"), (2, 10, "b"), (3, 20, "c"), (4, 30, "d")],
                                    "pk long, doc long, p string")
    children = spark.createDataFrame([(1, 1, 1.5), (1, 2, 2.5), (2, 1, 3.0), (3, 1, 4.0)],
                                     "fk long, n int, q double")
    return parents, children


def test_nest_flatten_roundtrip_through_ndjson(spark, scratch):
    parents, children = _family(spark)
    docs = nest_two_levels(parents, children, "pk", "fk", "doc", "items", "entries")
    assert docs.count() == 3
    write_ndjson(docs, f"{scratch}/nd")
    back = read_documents(spark, f"{scratch}/nd", docs.schema).drop("_corrupt_record")
    flat = flatten_all(back, ["entries", "items"]).drop("part", "items_part")
    got = sorted(tuple(r) for r in flat.select("doc", "pk", "p", "n", "q").collect())
    want = sorted(tuple(r) for r in parents.join(children, parents.pk == children.fk, "left")
                  .select("doc", "pk", "p", "n", "q").collect())
    assert got == want  # parent 4 has no children: one row of NULLs, as a left join


def test_hot_key_is_split_into_parts_without_losing_items(spark):
    child = spark.range(0, 1000).select(F.lit(7).alias("k"), F.col("id").alias("v")) \
        .unionByName(spark.createDataFrame([(8, 1)], "k int, v long"))
    docs = nest(child, ["k"], ["v"], "items", max_items=100)
    parts = {r["k"]: r["n"] for r in docs.groupBy("k").agg(F.count("*").alias("n")).collect()}
    assert parts[8] == 1 and parts[7] == 10
    largest = docs.select(F.max(F.size("items"))).first()[0]
    assert largest < 200
    total = docs.select(F.sum(F.size("items"))).first()[0]
    assert total == 1001


def test_equal_items_and_null_keys_are_split_too(spark):
    child = spark.range(0, 1000).select(F.lit(7).alias("k"), F.lit(1).alias("v")).unionByName(
        spark.range(0, 1000).select(F.lit(None).cast("int").alias("k"), F.col("id").cast("int").alias("v")))
    docs = nest(child, ["k"], ["v"], "items", max_items=100)
    assert docs.select(F.max(F.size("items"))).first()[0] < 200
    assert docs.select(F.sum(F.size("items"))).first()[0] == 2000
    assert {r["k"]: r["n"] for r in docs.groupBy("k").agg(F.count("*").alias("n")).collect()} == {7: 10, None: 10}


def test_two_levels_are_bounded_by_leaf_items_and_count_parents_once(spark):
    parents = spark.range(0, 50).select(F.col("id").alias("pk"), F.lit(1).alias("doc"))
    children = spark.range(0, 2500).select((F.col("id") % 50).alias("fk"), F.col("id").alias("v"))
    for bound in (60, 20, 10_000):
        docs = nest_two_levels(parents, children, "pk", "fk", "doc", "items", "entries", max_items=bound)
        leaves = F.aggregate("entries", F.lit(0), lambda a, e: a + F.size(e["items"]))
        whole = F.size(F.filter("entries", lambda e: e["items_part"] == 0))
        r = docs.agg(F.max(leaves).alias("most"), F.sum(leaves).alias("n"), F.sum(whole).alias("parents")).first()
        assert r["n"] == 2500 and r["parents"] == 50
        assert r["most"] < 5 * bound


def test_ndjson_is_written_compressed(spark, scratch):
    docs = spark.range(2000).select(F.col("id").alias("a_rather_long_name"), F.lit(None).cast("string").alias("nothing"))
    write_ndjson(docs, f"{scratch}/nd")
    files = [f for f in os.listdir(f"{scratch}/nd") if f.startswith("part-")]
    assert files and all(f.endswith(".json.gz") for f in files)
    line = spark.read.text(f"{scratch}/nd").orderBy("value").first()["value"]
    assert json.loads(line) == {"a_rather_long_name": 0, "nothing": None}
    assert read_documents(spark, f"{scratch}/nd", docs.schema).drop("_corrupt_record").exceptAll(docs).isEmpty()


def test_small_keys_are_cut_where_they_meet(spark):
    """Many keys just over the bound: each row is shuffled once, parts are
    numbered without gaps and hold no more than the bound; a key that no task
    should hold goes over several tasks in the same call."""
    child = spark.range(3000).select(F.pmod("id", F.lit(400)).alias("k"), F.col("id").alias("v"))
    plan = nest(child, ["k"], ["v"], "items", max_items=3).groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1, plan
    child = child.unionByName(spark.range(12_000).select(F.lit(-1).cast("long").alias("k"), F.col("id").alias("v")))
    child = child.unionByName(spark.range(7).select(F.lit(None).cast("long").alias("k"), F.col("id").alias("v")))
    docs = nest(child, ["k"], ["v"], "items", max_items=3)
    keys = docs.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("part").alias("last"), F.sum(F.size("items")).alias("items"),
                                 F.max(F.size("items")).alias("most"), F.count_distinct("part").alias("parts")).collect()
    assert len(keys) == 402
    for r in keys:
        assert r["n"] == r["parts"] == r["last"] + 1
        if r["k"] != -1:
            assert r["most"] <= 3 and r["n"] == -(-r["items"] // 3)
    back = docs.select("k", F.explode("items.v").alias("v"))
    assert back.exceptAll(child).isEmpty() and child.exceptAll(back).isEmpty()


def test_extract_tags(spark):
    df = spark.createDataFrame([('{"k": 5, "m": "x"}',), ("not json",)], "t string")
    out = extract_tags(df, "t", "k int, m string", {"k_text": "$.k"}).collect()
    assert (out[0]["k"], out[0]["m"], out[0]["k_text"]) == (5, "x", "5")
    assert out[1]["k"] is None and out[1]["k_text"] is None


from hypothesis import given, settings, strategies as st  # noqa: E402


def _key(t):
    return tuple((x is None, x if x is not None else 0) for x in t)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3), st.one_of(st.none(), st.integers(-5, 5))),
                min_size=0, max_size=40),
       st.integers(1, 4))
def test_flatten_of_nest_is_identity_as_multiset(spark, rows, max_items):
    df = spark.createDataFrame(rows, "k int, a int, b int")
    docs = nest(df, ["k"], ["a", "b"], "items", max_items=max_items)
    back = flatten_all(docs, ["items"]).drop("part")
    got = sorted((tuple(r) for r in back.select("k", "a", "b").collect()), key=_key)
    assert got == sorted(rows, key=_key)
    assert {r["k"] for r in docs.select("k").collect()} == {k for k, _, _ in rows}


def test_create_table_fails_when_present_and_read_table(spark, scratch):
    from tidemark.sinks.writers import create_table
    from tidemark.sources.readers import read_table
    path = f"{scratch}/t"
    df = spark.createDataFrame([(1,)], "a int")
    create_table(df, path)
    try:
        create_table(df, path)
    except Exception:
        pass
    else:
        raise AssertionError("second create succeeded")
    assert read_table(spark, path).count() == 1


def test_create_history_as_managed_table(spark):
    import uuid
    from tidemark.plans.staging import HISTORY_SCHEMA, create_history
    name = f"hist_{uuid.uuid4().hex[:8]}"
    create_history(spark, name=name)
    assert spark.table(name).schema == HISTORY_SCHEMA and spark.table(name).count() == 0
