"""Sharding by proportional stratified interleaving.

Rows are ranked in seeded-shuffled order within their source, placed by
fractional rank ``(rank + phase) / rows of the source`` and cut into shards of
equal row counts, so that any stretch, and thus every shard, has the
mixture of the whole. The phase, from 0 to 1, is hashed from the source, so
that many sources of a few rows do not all meet at one place. Law: ``rows``
(counts at most one apart).

Ranks are exact without a global sort: rows are dealt to many small buckets
(by the leading bits of the shuffle hash, then by the fraction), ranked
inside a bucket, and shifted by the summed counts of the buckets before it.
A source with a third of all rows is spread over a third of the buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.llm.common import join_groups
from tidemark.operators.rows import repeat_rows
from tidemark.session import materialize

#: rows that a ranking bucket holds on average, and the number of buckets from
#: which on they hold more (bucket counts are summed in one small window)
BUCKET_ROWS, MANY_BUCKETS = 1_000, 50_000
#: largest value of the shuffle hash, exclusive
_HASH_RANGE = 1 << 40


def _ranked(rows: DataFrame, groups: list[str], bucket: str, order: list[Column], to: str) -> DataFrame:
    """Adds ``to``: the row's 0-based rank in its group by ``(bucket, *order)``.
    Buckets are small whatever the data, so no task ranks a whole group."""
    counts = rows.groupBy(*groups, bucket).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*groups, bucket, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(*groups, bucket).orderBy(*order)
    ranked = rows.withColumn("__r", F.row_number().over(inside) - 1)
    return ranked.join(starts, [*groups, bucket]).withColumn(to, F.col("__start") + F.col("__r")).drop("__start", "__r")


def interleave(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source", seed: int = 7) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row.

    ``size`` is the text's UTF-8 bytes plus 16. Shard counts differ by at most
    one, and a source's rows in a shard differ from its exact share only by
    rounding.

    Defined cases: a NULL text counts as empty; NULL sources form one source
    of their own; repeated rows and equal texts are placed row by row (this
    law deals rows, so a group of copies larger than a shard cannot stay
    together); equal hashes are ranked by id and checksum; a text of any length
    is one row of its size; with fewer rows than shards some shards stay empty;
    an empty table gives an empty result; other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("")).alias("__source"),
        (F.octet_length(text) + F.lit(16)).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.pmod(F.xxhash64(F.lit(seed), F.col(id_col).cast("string"), text), F.lit(_HASH_RANGE)).alias("__h"))
    # repeated rows collapse to a count and come back with a hash of their own;
    # written once: ranks must not be taken from two evaluations of the rows
    rows = materialize(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("__c")), name="shard-rows")
    rows = repeat_rows(rows, "__c", "__copy").withColumn("__h", F.when(F.col("__copy") == 1, F.col("__h")).otherwise(
        F.pmod(F.xxhash64("__h", "__copy"), F.lit(_HASH_RANGE))))
    per_source = rows.groupBy("__source").agg(F.count(F.lit(1)).alias("__rows"))
    total = rows.count()
    per_bucket = max(BUCKET_ROWS, -(-total // MANY_BUCKETS))
    buckets = max(1, -(-total // per_bucket))
    order = [F.col("__h"), F.col("doc_id"), F.col("text_crc32"), F.col("__copy")]
    sized = join_groups(rows, per_source, ["__source"], "__rows", total, ["__h"]).withColumn(
        "__bucket", F.floor(F.col("__h") * F.ceil(F.col("__rows") / F.lit(per_bucket)) / F.lit(_HASH_RANGE)))
    ranked = _ranked(sized, ["__source"], "__bucket", order, "__rank")
    phase = (F.pmod(F.xxhash64(F.lit(seed), F.col("__source")), F.lit(1 << 20)) + 0.5) / float(1 << 20)
    fraction = (F.col("__rank") + phase) / F.col("__rows")
    placed = ranked.withColumn("__fraction", fraction).withColumn(
        "__slice", F.least(F.floor(F.col("__fraction") * buckets), F.lit(buckets - 1)).cast("bigint"))
    placed = materialize(placed.drop("__bucket"), name="shard-fractions")
    placed = _ranked(placed.withColumn("__all", F.lit(0)), ["__all"], "__slice",
                     [F.col("__fraction"), F.col("__source"), F.col("__rank")], "__at")
    # the first (total % shards) shards take one row more
    small, extra = divmod(total, shards) if total else (0, 0)
    head = (small + 1) * extra
    at = F.col("__at")
    in_head = at < head
    shard = F.when(in_head, F.floor(at / F.lit(small + 1))).otherwise(
        F.lit(extra) + F.floor((at - head) / F.lit(max(1, small))))
    slot = F.when(in_head, at % F.lit(small + 1)).otherwise((at - head) % F.lit(max(1, small)))
    return placed.select("doc_id", "size", "text_crc32", shard.cast("int").alias("shard"),
                         slot.cast("bigint").alias("slot"))


def op5_sharding(docs: DataFrame) -> DataFrame:
    """The contract's digest of :func:`interleave` over 40 shards."""
    out = interleave(docs, 40)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
