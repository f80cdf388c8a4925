"""A table of nested documents that takes late children.

Documents lie in buckets of their key (``bucket=<n>`` folders). Children that
arrive later are nested into the documents of their own buckets alone: those
buckets are read, their items joined by the new ones, nested again and
replaced; all other buckets keep their files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemark.operators.documents import DEFAULT_MAX_ITEMS, PART_COL, nest
from tidemark.session import materialize_once, path_exists, shared_path, touch

BUCKET_COL = "bucket"


@dataclass(frozen=True)
class DocumentTable:
    """Where the documents lie and how they are made. ``buckets`` and the
    columns belong to the table: they must be the same for every writer."""

    path: str
    key_cols: tuple[str, ...]
    item_cols: tuple[str, ...]
    items_name: str
    buckets: int = 64
    max_items: int = DEFAULT_MAX_ITEMS

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.key_cols), F.lit(self.buckets)).cast("int").alias(BUCKET_COL)

    def read(self, spark: SparkSession, schema: StructType | None = None) -> DataFrame:
        """The documents: keys, part and items (and their bucket)."""
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(f"{self.path}/documents")

    def add(self, children: DataFrame, unit: str | None = None) -> list[int]:
        """Nest the children into the table (made on first use); returns the
        buckets that were rewritten.

        The new content of these buckets is written to a work folder first,
        then put in their place. A run that names its ``unit`` and stops
        anywhere is repeated from that work folder, so no child is nested
        twice; a unit that is done does nothing. One writer at a time.
        """
        spark = children.sparkSession
        done = f"{self.path}/units/{unit}" if unit else None
        if done and path_exists(f"{done}/_DONE"):
            return []
        work = done or shared_path(spark, "doctable")
        fresh = children.select(*self.key_cols, *self.item_cols)
        touched = sorted(r[0] for r in fresh.select(self._bucket()).distinct().collect())  # at most ``buckets``
        rows = fresh
        if path_exists(f"{self.path}/documents"):
            old = self.read(spark).where(F.col(BUCKET_COL).isin(touched))
            items = old.select(*self.key_cols, F.explode(self.items_name).alias("_item"))
            rows = items.select(*self.key_cols, *[F.col("_item")[c].alias(c) for c in self.item_cols]).unionByName(fresh)
        docs = nest(rows, list(self.key_cols), list(self.item_cols), self.items_name, self.max_items)
        staged = materialize_once(docs.select(*self.key_cols, PART_COL, self.items_name, self._bucket()), f"{work}/staged")
        # a bucket's rows meet in few tasks (few files); a large one is split by Spark
        (staged.hint("rebalance", BUCKET_COL).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BUCKET_COL).parquet(f"{self.path}/documents"))
        if done:
            touch(f"{done}/_DONE")
        return touched
