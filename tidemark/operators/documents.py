"""Nested documents.

Nesting is a regroup, so it shuffles; the rest is narrow. A key that owns a
huge share of the rows (one patient with a third of all studies) must not
become one giant row in one task, so :func:`nest` splits such keys into
numbered parts: counts per key are pre-aggregated (map-side partial
aggregation, key columns only), and keys over ``max_items`` get about
``ceil(n / max_items)`` parts. A key of up to ``TASK_ITEMS`` items is numbered
and cut where its rows meet anyway, whatever the number of such keys. The items
of a larger one are dealt to the parts by a hash of the row's number (equal
items spread like any others), so a hot key's parts land in different tasks,
whatever its items; there are at most rows / ``TASK_ITEMS`` such keys. NULL is
a key like any other. Every item is kept; nothing is capped or sampled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from tidemark.operators.lookup import bounded_broadcast
from tidemark.session import materialize, shared_path

PART_COL = "part"
DEFAULT_MAX_ITEMS = 10_000
#: A key of more items than this (and than the bound) is spread over tasks.
TASK_ITEMS = 10_000


def extract_tags(df: DataFrame, json_col: str, schema: StructType | str | None = None,
                 paths: dict | None = None) -> DataFrame:
    """Tags from a JSON text column: either parsed whole with ``schema`` (struct
    columns appended, field by field) or picked by JSON path (``{name: '$.k'}``)."""
    out = df
    if schema is not None:
        parsed = F.from_json(F.col(json_col), schema)
        st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        out = out.withColumns({f.name: parsed[f.name] for f in st.fields})
    if paths:
        out = out.withColumns({name: F.get_json_object(F.col(json_col), p) for name, p in paths.items()})
    return out


def heavy_keys(counts: DataFrame, key_cols, max_items: int = DEFAULT_MAX_ITEMS) -> DataFrame:
    """Keys with more than ``max_items`` items and their part count
    ``ceil(n / max_items)``, from per-key counts (``key_cols..., _n``).

    At most rows / max_items keys; computed once, written to the shared folder,
    and broadcast only when proven small (every later use reads that table).
    """
    spark = counts.sparkSession
    heavy = (counts.filter(F.col("_n") > F.lit(max_items))
             .select(*key_cols, F.ceil(F.col("_n") / F.lit(max_items)).cast("int").alias("_parts")))
    return bounded_broadcast(materialize(heavy, shared_path(spark, "heavy-keys")))


def nest(child: DataFrame, key_cols, item_cols, items_name: str, max_items: int = DEFAULT_MAX_ITEMS,
         sort_items: bool = True, counts: DataFrame | None = None,
         heavy: DataFrame | None = None, weight=None) -> DataFrame:
    """One row per key (per part of a heavy key) with an array of item structs.

    Output: ``key_cols..., part, <items_name>``. ``part`` is 0 for ordinary
    keys; a key with more than ``max_items`` items is split over about
    ``ceil(n / max_items)`` parts, numbered from 0 without gaps (about
    ``max_items`` items each, never twice as many where the key is no larger
    than ``TASK_ITEMS``).
    Per-key item counts (``counts``: ``key_cols..., _n``) or the heavy-key
    table itself (``heavy``, from :func:`heavy_keys`) may be passed when the
    caller knows them more cheaply than a count over ``child``; ``weight`` is
    how many items a row of ``child`` counts for in them (default: one).
    """
    key_cols = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    item_cols = list(item_cols)
    if heavy is None:
        if counts is None:
            counts = child.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("_n"))
        heavy = heavy_keys(counts, key_cols, max_items)
    items = F.collect_list(F.struct(*[F.col(c) for c in item_cols]))
    if sort_items:
        items = F.sort_array(items)
    rows = child.select(*key_cols, *item_cols, (F.lit(1) if weight is None else weight).cast("long").alias("_weight"))
    in_task = (F.col("_parts") - 1) * F.lit(max_items) < F.lit(max(max_items, TASK_ITEMS))
    cut = not heavy.filter(in_task).isEmpty()
    giants = heavy.filter(~in_task)
    if giants.isEmpty():  # the usual case: no join, one scan
        return _nest_in_tasks(rows, key_cols, item_cols, items, items_name, max_items, cut, sort_items)
    named = bounded_broadcast(giants.select(*[F.col(k).alias(f"_h_{k}") for k in key_cols], "_parts"))
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in key_cols])
    joined = rows.join(named, same, "left").drop(*[f"_h_{k}" for k in key_cols])
    light = joined.filter(F.col("_parts").isNull()).drop("_parts")
    hot = joined.filter(F.col("_parts").isNotNull())
    # the slot is drawn per row, so equal items spread too; it is written at once and never drawn again
    part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("_parts")).cast("int")
    hot = materialize(hot.withColumn("_slot", part).select(*key_cols, *item_cols, "_slot"),
                      shared_path(child.sparkSession, "heavy-rows"))
    spread = _number_parts(hot, key_cols).repartition(*[F.col(c) for c in key_cols], F.col(PART_COL))
    return _nest_in_tasks(light, key_cols, item_cols, items, items_name, max_items, cut, sort_items).unionByName(
        spread.groupBy(*key_cols, PART_COL).agg(items.alias(items_name)))


def _nest_in_tasks(rows: DataFrame, key_cols: list[str], item_cols: list[str], items, items_name: str,
                   max_items: int, cut: bool, sort_items: bool) -> DataFrame:
    """:func:`nest` of keys that each fit into a task. With ``cut``, a key of
    more than ``max_items`` items goes over to its next part wherever the rows
    before make up a multiple of the bound."""
    # Shuffle the compact rows once by key alone and build each list in one
    # place: a map-side partial collect_list cannot shrink anything, it only
    # serializes per-task list buffers through the shuffle. The documents stay
    # partitioned by key, so a join or an aggregate by it moves nothing again.
    clustered = rows.repartition(*[F.col(c) for c in key_cols])
    if not cut:
        docs = clustered.groupBy(*key_cols).agg(items.alias(items_name))
        return docs.select(*key_cols, F.lit(0).alias(PART_COL), items_name)
    order = F.xxhash64(*item_cols) if sort_items else F.monotonically_increasing_id()
    before = Window.partitionBy(*key_cols).orderBy("_order").rowsBetween(Window.unboundedPreceding, -1)
    # no row counts for more than the bound, so no part is left out
    sum_before = F.coalesce(F.sum(F.least(F.col("_weight"), F.lit(max_items))).over(before), F.lit(0))
    numbered = clustered.withColumn("_order", order).withColumn(
        PART_COL, F.floor(sum_before / F.lit(max_items)).cast("int"))
    return numbered.groupBy(*key_cols, PART_COL).agg(items.alias(items_name))


def _number_parts(hot: DataFrame, key_cols: list[str]) -> DataFrame:
    """``_slot`` renumbered from 0 without gaps per key, so part 0 always exists
    (a hash may leave slots empty). The slots are few: rows / max_items."""
    order = Window.partitionBy(*key_cols).orderBy("_slot")
    slots = hot.groupBy(*key_cols, "_slot").agg(F.count(F.lit(1)).alias("_n")).select(
        *[F.col(k).alias(f"_s_{k}") for k in key_cols], F.col("_slot").alias("_s"),
        (F.row_number().over(order) - 1).alias(PART_COL))
    slots = bounded_broadcast(materialize(slots, shared_path(hot.sparkSession, "heavy-slots")))
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in key_cols])
    return hot.join(slots, same & (F.col("_slot") == F.col("_s")))


def nest_two_levels(parent: DataFrame, child: DataFrame, parent_key: str, child_fk: str,
                    doc_key: str, child_items: str, parent_items: str,
                    max_items: int = DEFAULT_MAX_ITEMS) -> DataFrame:
    """key -> array<parent struct> -> each with array<child struct>.

    ``child`` rows are nested under their parent (by ``child_fk`` =
    ``parent_key``); parents keep an empty array when they have no children;
    parents are then nested under ``doc_key``. A parent with more than
    ``max_items`` children appears once per part, and its struct says which:
    ``<child_items>_part`` is 0 in exactly one of them, so counting the zeros
    counts parents whatever the bound. A document weighs its leaf items, so
    each of its parts holds about ``max_items`` of them.
    """
    part_name = f"{child_items}_part"
    child_cols = [c for c in child.columns if c != child_fk]
    # children per parent, counted once for both levels (key columns only)
    inner_counts = materialize(child.groupBy(child_fk).agg(F.count(F.lit(1)).alias("_n")),
                               shared_path(child.sparkSession, "child-counts"))
    inner = nest(child, [child_fk], child_cols, child_items, max_items,
                 counts=inner_counts).withColumnRenamed(PART_COL, part_name)
    # An empty (not NULL) array for parents without children, so the shape is uniform.
    with_children = parent.join(inner, parent[parent_key] == inner[child_fk], "left").drop(child_fk)
    elem_type = inner.schema[child_items].dataType
    with_children = with_children.withColumns({
        child_items: F.coalesce(F.col(child_items), F.array().cast(elem_type)),
        part_name: F.coalesce(F.col(part_name), F.lit(0))})
    sizes = inner_counts.withColumnRenamed(child_fk, "_pk")
    outer_counts = (parent.select(parent_key, doc_key).join(sizes, parent[parent_key] == sizes["_pk"], "left")
                    .groupBy(doc_key)
                    .agg(F.sum(F.coalesce(F.col("_n"), F.lit(1))).cast("long").alias("_n")))
    parent_cols = [c for c in with_children.columns if c != doc_key]
    return nest(with_children, [doc_key], parent_cols, parent_items, max_items, counts=outer_counts,
                weight=F.greatest(F.size(child_items), F.lit(1)))


def flatten(docs: DataFrame, array_col: str, keep=None) -> DataFrame:
    """One level down: explode the array (outer: empty arrays give one row of
    NULLs) and lift the struct's fields next to the kept columns."""
    keep = [c for c in (keep if keep is not None else docs.columns) if c != array_col]
    exploded = docs.select(*keep, F.explode_outer(F.col(array_col)).alias("_item"))
    fields = docs.schema[array_col].dataType.elementType.fieldNames()
    return exploded.select(*keep, *[F.col("_item")[f].alias(f) for f in fields])


def flatten_all(docs: DataFrame, path) -> DataFrame:
    """Flatten several levels, e.g. ``['orders', 'lines']``."""
    out = docs
    for level in path:
        out = flatten(out, level)
    return out
