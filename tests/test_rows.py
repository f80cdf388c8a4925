"""Rows that stand for many equal ones."""

from collections import Counter

from pyspark.sql import functions as F

from tidemark.operators.documents import nest
from tidemark.operators.rows import repeat_rows


def test_repeats_are_numbered_and_complete(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3), ("c", 0), ("d", None), (None, 7), ("e", 6)], "k string, n bigint")
    got = sorted((tuple(r) for r in repeat_rows(df, "n", "copy", block=3).collect()), key=repr)
    want = [(k, i) for k, n in (("a", 1), ("b", 3), (None, 7), ("e", 6)) for i in range(1, n + 1)]
    assert got == sorted(want, key=repr)


def test_no_task_brings_back_a_row_that_is_most_of_a_table(spark):
    df = spark.createDataFrame([("hot", 100_000)] + [(f"k{i}", 2) for i in range(20)], "k string, n bigint")
    out = repeat_rows(df, "n", "copy", block=1_000)
    per = {r.p: r.n for r in out.where("k = 'hot'").groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sum(per.values()) == 100_000 and len(per) >= 6
    assert all(n % 1_000 == 0 and n <= 30_000 for n in per.values())


def test_equal_items_with_arrays_spread_over_parts(spark):
    """Parents that are equal up to their arrays are dealt to all parts."""
    rows = spark.range(4_000).select(F.lit("k").alias("key"), F.lit(1).alias("x"), F.array(F.lit(1), F.lit(2)).alias("items"))
    docs = nest(rows, ["key"], ["x", "items"], "all", max_items=500)
    sizes = [r.n for r in docs.select(F.size("all").alias("n")).collect()]
    assert sum(sizes) == 4_000 and len(sizes) == 8 and max(sizes) < 700
    assert Counter(r.part for r in docs.select("part").collect()) == Counter(range(8))
