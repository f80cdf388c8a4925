"""Documents without a given schema."""

import json
import os

from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.sources.variants import as_columns, flatten_found, found_schema, parse_variants, read_variants


def _lines(spark, *values):
    return spark.createDataFrame([(v if isinstance(v, str) else json.dumps(v),) for v in values], "value string")


def test_broken_lines_go_to_the_rejects(spark, scratch):
    good = [{"a": 1}, {"a": "x", "b": None}, [1, 2], "text", 5]
    with open(f"{scratch}/x.json", "w") as f:
        f.write("\n".join([json.dumps(g) for g in good] + ['{"a": 1', "nope", "", "   ", "{\"b\": }"]) + "\n")
    docs, bad = read_variants(spark, f"{scratch}/x.json")
    assert docs.count() == len(good)
    assert sorted(r["line"] for r in bad.collect()) == sorted(["nope", '{"a": 1', '{"b": }'])


def test_types_of_a_field_meet(spark):
    docs, _ = parse_variants(_lines(spark, {"n": 1, "m": 1, "z": None, "o": {"p": 1}, "l": [1]},
                                    {"n": 2.5, "m": "x", "q": {}, "o": {"r": True}, "l": [2, None]}, {"m": {"k": 2}, "a b": 1}), "value")
    assert found_schema(docs).simpleString() == "struct<a b:bigint,l:array<bigint>,m:string,n:double,o:struct<p:bigint,r:boolean>,q:string,z:string>"
    rows = {r["n"]: r for r in as_columns(docs).collect()}
    assert (rows[1.0]["m"], rows[2.5]["m"], rows[None]["m"]) == ("1", "x", '{"k":2}')
    assert rows[1.0]["o"].asDict() == {"p": 1, "r": None} and rows[None]["a b"] == 1 and rows[2.5]["q"] == "{}"
    empty, _ = parse_variants(_lines(spark).limit(0), "value")
    assert found_schema(empty) == StringType() and as_columns(empty).columns == ["value"]
    mixed, _ = parse_variants(_lines(spark, 1, {"a": 2}, '"t"'), "value")
    assert sorted(r["value"] for r in as_columns(mixed).collect()) == ["1", "t", '{"a":2}']


def test_flatten_follows_what_is_there(spark):
    docs, _ = parse_variants(_lines(
        spark, {"id": 1, "who": {"name": "n", "id": 9}, "orders": [{"id": 10, "lines": [{"q": 1}, {"q": 2}]}, {"id": 11, "lines": []}], "tags": ["a", "b"]},
        {"id": 2, "orders": [], "tags": None}, {"id": 3}), "value")
    tables = flatten_found(as_columns(docs))
    assert set(tables) == {"", "orders", "orders.lines", "tags"}
    assert sorted(tuple(r) for r in tables[""].select("id", "who_id").fillna(-1).collect()) == [(1, 9), (2, -1), (3, -1)]
    lines = tables["orders.lines"]
    assert sorted(tuple(r) for r in lines.select("id", F.coalesce("orders_id", F.lit(0)), F.coalesce("q", F.lit(0))).collect()) == \
        [(1, 10, 1), (1, 10, 2), (1, 11, 0), (2, 0, 0), (3, 0, 0)]
    assert sorted((r["id"], r["tags"]) for r in tables["tags"].where("tags IS NOT NULL").collect()) == [(1, "a"), (1, "b")]
    assert tables["tags"].count() == 4  # never the product with the orders


def test_other_columns_stay(spark):
    df = _lines(spark, {"a": 1}).withColumn("source", F.lit("s"))
    docs, _ = parse_variants(df, "value")
    assert as_columns(docs).collect()[0].asDict() == {"source": "s", "a": 1}


def test_broken_lines_beside_compressed_documents(spark, scratch):
    """Documents and broken lines, as the registered query writes them: both
    compressed, both read as lines."""
    from tidemark.sinks.writers import write_ndjson

    docs = spark.range(300).select(F.col("id").alias("a"), F.array(F.struct(F.col("id").alias("b"))).alias("l"))
    write_ndjson(docs, f"{scratch}/x")
    spark.range(7).select(F.concat(F.lit('{"a": '), "id", F.lit(', "l": [{'))).write.mode("append").option("compression", "gzip").text(f"{scratch}/x")
    assert all(f.endswith(".gz") for f in os.listdir(f"{scratch}/x") if f.startswith("part-"))
    found, bad = read_variants(spark, f"{scratch}/x")
    rows = flatten_found(as_columns(found))["l"].select("a", "b").collect()
    assert sorted(map(tuple, rows)) == [(i, i) for i in range(300)]
    assert sorted(r["line"] for r in bad.collect()) == ['{"a": %d, "l": [{' % i for i in range(7)]
