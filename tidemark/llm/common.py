"""Helpers shared by the training-data operators.

Every operator takes a DataFrame with a document key and a text column (any
other columns are ignored, whatever their names) and selects what it needs
under its own names first, so extra or clashing columns never matter.
"""

from __future__ import annotations

from bisect import bisect_left
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import materialize, ship_package  # noqa: F401  (general helpers)

# the ASCII white space of the contracts: space, tab, LF, VT, FF, CR
ASCII_SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A group that holds at least one row in HOT_SHARE of all rows is hot. There
#: are at most HOT_SHARE such groups, whatever the data: that is the proven
#: size bound under which they are broadcast.
HOT_SHARE = 1000


#: bounds of an Arrow batch
BATCH_ROWS, BATCH_BYTES = 1_000, 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def key_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text)`` with a NULL text as the empty text."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def python_stage(spark: SparkSession) -> None:
    """Ready the session for a stage with Python on the executors: the package
    is shipped, and an Arrow batch is bounded by rows and by bytes, so very
    long texts cannot swell a worker."""
    ship_package(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000") or 0) != BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


class Taken:
    """Whether a span (end exclusive) meets any of the given ones, by bisection."""

    def __init__(self, spans: list[tuple[int, int]]):
        ordered = sorted(spans)
        self.starts = [s for s, _ in ordered]
        self.reach = list(accumulate((e for _, e in ordered), max))

    def meets(self, start: int, end: int) -> bool:
        before = bisect_left(self.starts, end)
        return before > 0 and self.reach[before - 1] > start


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else (ASCII texts the short way)."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def row_key(doc_id: Column, text: Column) -> list[Column]:
    """Two columns that address a row by its content: rows that agree on both
    are repeated rows and share every per-document decision. A NULL id is a
    value of its own."""
    return [F.coalesce(doc_id.cast("string"), F.lit("\u0000null")).alias("__k1"), F.xxhash64(text).alias("__k2")]


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int,
                spread: list[str]) -> DataFrame:
    """Left join of ``rows`` with one row per key of ``groups`` that never
    gathers a hot key in one task.

    Groups of at least ``total / HOT_SHARE`` rows (``size`` is their row count)
    number at most HOT_SHARE, so they are broadcast; their rows then travel
    under a key made from ``spread`` instead of the hot key. All other rows
    meet their group in an ordinary shuffled join, where no key holds more
    than a HOT_SHARE-th of the rows.
    """
    values = [c for c in groups.columns if c not in keys]
    floor = max(1, total // HOT_SHARE)
    hot = F.broadcast(groups.where(F.col(size) > floor)
                      .select(*keys, F.struct(*values).alias("__hot")))
    rest = groups.where(F.col(size) <= floor).select(
        *[F.col(k).alias(f"__r_{k}") for k in keys], F.struct(*values).alias("__rest"))
    # a row of a hot group has no partner in the rest: it keeps a NULL key there,
    # and a second key made from ``spread`` scatters such rows over all tasks
    cold = F.col("__hot").isNull()
    marked = rows.join(hot, keys, "left").withColumn(
        "__j", F.when(cold, F.xxhash64(*keys)).otherwise(F.xxhash64(*spread)))
    rest = rest.withColumn("__rj", F.xxhash64(*[f"__r_{k}" for k in keys]))
    on = [F.col("__j") == F.col("__rj"), *[F.when(cold, F.col(k)) == F.col(f"__r_{k}") for k in keys]]
    joined = marked.join(rest, on, "left")
    pick = F.coalesce(F.col("__hot"), F.col("__rest"))
    return joined.select(*[F.col(c) for c in rows.columns], *[pick[v].alias(v) for v in values])
