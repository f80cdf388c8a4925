"""Schema registry (K4, S10, C6, J3, L2, F9) as a Spark table.

A registry holds one row per registered table schema. A whole table of
candidates is registered at once (:func:`registry_merge`): what is there
already is left out by an anti join on the key, new rows get consecutive ids
from counts per partition, and a run writes a partition of its own, so it can
be repeated. The existence test is a semi join (see ``lookup.schema_exists``).
"""

from __future__ import annotations

import datetime as _dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from tidemark.functions.text import check_layer, clock, is_valid_layer, prepare_schema_str, prepare_schema_text
from tidemark.operators.lookup import bounded_broadcast
from tidemark.session import materialize, path_exists, shared_path
from tidemark.sinks.writers import UNIT_COL, read_units, write_unit

# Fixed values that must equal the reference's behaviour: registry columns, in insert order
REGISTRY_COLUMNS = (
    "tableName", "layer", "fullTablePath", "namespace", "schemaDefinition", "tableLakehouse",
    "tableSource", "tableLakehouseID", "tableWorkspaceID", "_createdByPipelineName",
    "_createdByPipelineRunID", "_lastModifieddttm",
)

REGISTRY_SCHEMA = StructType(
    [StructField("id", LongType(), True)]
    + [StructField(c, StringType(), True) for c in REGISTRY_COLUMNS[:-1]]
    + [StructField("_lastModifieddttm", TimestampNTZType(), True)]  # UTC wall-clock time
)

FIRST_COLUMNS = ("id", "tableName", "layer", "namespace", "schemaDefinition")


def registry_rows(spark: SparkSession, entries, pipeline_name: str, run_id: str,
                  as_of: _dt.datetime | None = None, first_id: int = 1) -> DataFrame:
    """Registry rows for a list of entries (dicts with the first nine registry
    fields; ``schemaDefinition`` may be a StructType). Ids are consecutive from
    ``first_id`` in the given order; the stamp is UTC now unless injected."""
    stamp = as_of or _dt.datetime.now(_dt.timezone.utc)
    if stamp.tzinfo is not None:  # stored as UTC wall-clock time
        stamp = stamp.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    rows = []
    for i, e in enumerate(entries):
        schema_def = e.get("schemaDefinition")
        if not isinstance(schema_def, str):
            schema_def = prepare_schema_str(schema_def)
        rows.append((
            first_id + i, e.get("tableName"), check_layer(e.get("layer", "bronze")),
            e.get("fullTablePath"), e.get("namespace"), schema_def, e.get("tableLakehouse"),
            e.get("tableSource"), e.get("tableLakehouseID"), e.get("tableWorkspaceID"),
            pipeline_name, run_id, stamp,
        ))
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)


def next_id(registry: DataFrame) -> int:
    """1 + the largest id (a one-row aggregate)."""
    top = registry.agg(F.max("id").alias("m")).first()["m"]
    return 1 if top is None else int(top) + 1


def registry_insert(spark: SparkSession, path: str, entries, pipeline_name: str, run_id: str,
                    as_of: _dt.datetime | None = None, fmt: str = "parquet") -> DataFrame:
    """Append entries to the registry table at ``path`` (created on first use;
    one that cannot be read is an error, or ids would start again)."""
    first = next_id(read_registry(spark, path, fmt)) if path_exists(path) else 1
    rows = registry_rows(spark, entries, pipeline_name, run_id, as_of, first)
    rows.write.mode("append").format(fmt).save(path)
    return rows


def read_registry(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_units(spark, path, REGISTRY_SCHEMA, fmt)


MERGE_KEY = ("tableName", "schemaDefinition")


def _numbered(rows: DataFrame, first_id: int, order: tuple[str, ...]) -> DataFrame:
    """``id`` from ``first_id`` on, without gaps, in the given order: rows are
    sorted within range partitions, written, and numbered by their place in
    the partition and the counts of the partitions before it."""
    spark = rows.sparkSession
    placed = (rows.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("_at", F.monotonically_increasing_id()))
    placed = materialize(placed, shared_path(spark, "registry-rows"))
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n")).select(  # one row per partition
        "_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (placed.join(bounded_broadcast(offsets), part == F.col("_p"))
            .withColumn("id", F.lit(first_id).cast("long") + F.col("_before") + place).drop("_at", "_p", "_before"))


def registry_merge(candidates: DataFrame, path: str, pipeline_name: str, run_id: str,
                   as_of: _dt.datetime | None = None, fmt: str = "parquet", key=MERGE_KEY,
                   unit: str | None = None) -> DataFrame:
    """Register what is not registered yet; returns the new rows.

    ``candidates`` has some of the first nine registry columns (a missing
    layer is ``bronze``, any other missing column NULL); schema texts are
    stored with double quotes. Of candidates with one ``key`` the least row
    counts; NULL is a key value like any other. A candidate with a layer
    outside the domain is an error, and nothing is written. A run that names
    its ``unit`` and runs again replaces what it wrote and no other rows.
    """
    spark = candidates.sparkSession
    fields = REGISTRY_COLUMNS[:-3]
    layer = F.lower("layer") if "layer" in candidates.columns else F.lit("bronze")
    values = {"layer": layer, "schemaDefinition": prepare_schema_text("schemaDefinition")}
    rows = candidates.select(*[values.get(c, F.col(c) if c in candidates.columns else F.lit(None)).cast("string").alias(c)
                               for c in fields])
    wrong = rows.filter(~F.coalesce(is_valid_layer("layer"), F.lit(False))).select("layer").limit(1).collect()
    if wrong:
        check_layer(wrong[0]["layer"])
    others = [c for c in fields if c not in key]
    rows = rows.groupBy(*key).agg(F.min(F.struct(*others)).alias("_row")).select(*key, "_row.*")
    first = 1
    if path_exists(path):
        known = read_registry(spark, path, fmt)
        if unit:  # what an earlier attempt of this unit wrote does not count
            known = known.filter(~F.col("_metadata.file_path").contains(f"/{UNIT_COL}={unit}/"))
        first = next_id(known)
        have = bounded_broadcast(known.select(*[F.col(c).alias(f"_k_{c}") for c in key]).distinct())
        same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in key])
        rows = rows.join(have, same, "left_anti")
    rows = _numbered(rows, first, tuple(key)).select(
        "id", *fields, F.lit(pipeline_name).alias(REGISTRY_COLUMNS[-3]), F.lit(run_id).alias(REGISTRY_COLUMNS[-2]),
        clock(as_of).alias(REGISTRY_COLUMNS[-1]))
    rows = materialize(rows, shared_path(spark, "registry-new"))
    write_unit(rows, path, unit or uuid.uuid4().hex[:16], fmt)
    return rows


def registry_first(registry: DataFrame) -> DataFrame:
    """``(id, tableName, layer, namespace, schemaDefinition)`` of the row with the
    smallest id: by name, not position, and ordered, so "first" is defined."""
    return registry.select(*FIRST_COLUMNS).orderBy(F.col("id").asc_nulls_last()).limit(1)


def schema_candidates(spark: SparkSession, tables: dict) -> DataFrame:
    """``(tableName, schemaDefinition)`` for named DataFrames (schema text only;
    no data is read)."""
    rows = [(name, prepare_schema_str(df.schema)) for name, df in tables.items()]
    return spark.createDataFrame(rows, "tableName string, schemaDefinition string")
