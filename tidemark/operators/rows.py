"""Rows that stand for many equal ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: copies that one row of a task brings back at most
REPEAT_BLOCK = 100_000


def repeat_rows(df: DataFrame, count_col: str, copy_col: str, block: int = REPEAT_BLOCK) -> DataFrame:
    """Every row ``count_col`` times, numbered from 1 in ``copy_col`` (bigint);
    ``count_col`` goes. A row with more copies than ``block`` is first split
    into that many blocks, which are dealt to all tasks: no task brings back a
    row that stands for a third of a table, and no array is longer than a block.
    A count of 0 or NULL gives no row. ``df`` is read twice: pass a written table."""
    n = F.col(count_col).cast("bigint")
    one, size = F.lit(1).cast("bigint"), F.lit(block).cast("bigint")
    few = df.where((n >= 1) & (n <= size)).withColumn(copy_col, F.explode(F.sequence(one, n)))
    blocks = df.where(n > size).withColumn("__block", F.explode(F.sequence(one * 0, F.floor((n - 1) / size).cast("bigint"))))
    low = F.col("__block") * size
    # a given number of partitions: sizes before the blocks are opened say nothing
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = (blocks.repartition(parts, F.xxhash64("__block", *[c for c in df.columns if c != count_col]))
            .withColumn(copy_col, F.explode(F.sequence(low + 1, F.least(low + size, n)))).drop("__block"))
    return few.drop(count_col).unionByName(many.drop(count_col))
