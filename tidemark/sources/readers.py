"""Table and document readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

# Fixed values that must equal the reference's behaviour: accepted raw formats
LOAD_FORMATS = ("json", "csv")

CORRUPT_COL = "_corrupt_record"


def load_data(spark: SparkSession, file_path, file_format: str, options: dict | None = None,
              schema: StructType | str | None = None) -> DataFrame:
    """Raw JSON or CSV into a DataFrame. The format name is case-insensitive;
    anything else raises ``ValueError``. Options pass through; a schema, when
    given, replaces inference (inference costs an extra pass over the data)."""
    fmt = file_format.lower() if isinstance(file_format, str) else None
    if fmt not in LOAD_FORMATS:
        raise ValueError(f"cannot load {file_format!r}: raw files are one of {LOAD_FORMATS}")
    reader = spark.read.options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.format(fmt).load(file_path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: StructType | None = None, merge_schema: bool = False) -> DataFrame:
    """A table by path. One ``fmt`` for writer and reader alike."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.load(path)


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def with_corrupt_column(schema: StructType, corrupt_col: str = CORRUPT_COL) -> StructType:
    if corrupt_col in schema.fieldNames():
        return schema
    return StructType(schema.fields + [StructField(corrupt_col, StringType(), True)])


def read_documents(spark: SparkSession, path, schema: StructType,
                   corrupt_col: str = CORRUPT_COL) -> DataFrame:
    """ndjson documents with an explicit schema. Lines that are not JSON, or
    whose values do not fit the schema, keep their text in ``corrupt_col``
    (every other field NULL) instead of failing the load."""
    return (spark.read.schema(with_corrupt_column(schema, corrupt_col))
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_col)
            .json(path))
