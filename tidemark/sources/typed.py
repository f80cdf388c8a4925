"""Appended batches whose column types changed.

Batches are appended as they come: a column may be an integer in one, a double
in the next and text in a third, and Spark's schema merging refuses to read
such a table. Here every file keeps the schema of its footer. Footers are read
in tasks, the types of a column meet in a small lattice, and each group of
files with one schema is read with it and cast:

    byte < short < int < long < float < double < text
    int, long < decimal;  float, double with decimal: double
    date < timestamp;  structs field by field, arrays and maps by their parts
    anything else meets in text (nested values as JSON)
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (ArrayType, BooleanType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType,
                               IntegerType, LongType, MapType, NullType, ShortType, StringType, StructField, StructType,
                               TimestampNTZType, TimestampType)

from tidemark.session import default_parallelism, materialize, resolve_path, shared_path, ship_package
from tidemark.sources.files import list_tree

_WHOLE = (ByteType, ShortType, IntegerType, LongType)
_NUMBERS = (*_WHOLE, FloatType, DoubleType)
_DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 20}
_TIMES = (DateType, TimestampNTZType, TimestampType)


def join_types(a: DataType, b: DataType) -> DataType:
    """The least type that holds the values of both."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, StructType) and isinstance(b, StructType):
        return join_schemas(a, b)
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(join_types(a.elementType, b.elementType), True)
    if isinstance(a, MapType) and isinstance(b, MapType):
        return MapType(join_types(a.keyType, b.keyType), join_types(a.valueType, b.valueType), True)
    if isinstance(a, _NUMBERS) and isinstance(b, _NUMBERS):
        top = max(a, b, key=lambda t: _NUMBERS.index(type(t)))
        # a float holds the whole numbers of up to two bytes only
        narrow = isinstance(top, FloatType) and any(isinstance(t, (IntegerType, LongType)) for t in (a, b))
        return DoubleType() if narrow else top
    if isinstance(a, DecimalType) or isinstance(b, DecimalType):
        if isinstance(b, DecimalType) and not isinstance(a, DecimalType):
            a, b = b, a
        if isinstance(b, (FloatType, DoubleType)):
            return DoubleType()
        if isinstance(b, (*_WHOLE, DecimalType)):
            whole, scale = (b.precision - b.scale, b.scale) if isinstance(b, DecimalType) else (_DIGITS[type(b)], 0)
            scale = max(a.scale, scale)
            whole = max(a.precision - a.scale, whole)
            return DecimalType(whole + scale, scale) if whole + scale <= 38 else StringType()
    if isinstance(a, _TIMES) and isinstance(b, _TIMES):
        return max(a, b, key=lambda t: _TIMES.index(type(t)))
    return StringType()


def join_schemas(a: StructType, b: StructType) -> StructType:
    """Fields of both by name, in order of appearance, all nullable."""
    other = {f.name: f for f in b.fields}
    fields = [StructField(f.name, join_types(f.dataType, other[f.name].dataType) if f.name in other else f.dataType, True)
              for f in a.fields]
    have = set(a.fieldNames())
    return StructType(fields + [StructField(f.name, f.dataType, True) for f in b.fields if f.name not in have])


def cast_to(c: Column, have: DataType, want: DataType) -> Column:
    """The column as the joined type; nested fields by name, missing ones NULL."""
    if have == want:
        return c
    if isinstance(want, StructType) and isinstance(have, StructType):
        own = {f.name: f.dataType for f in have.fields}
        fields = [(cast_to(c[f.name], own[f.name], f.dataType) if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name)
                  for f in want.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(want, ArrayType) and isinstance(have, ArrayType):
        return F.transform(c, lambda x: cast_to(x, have.elementType, want.elementType))
    if isinstance(want, MapType) and isinstance(have, MapType):
        return F.transform_values(F.transform_keys(c, lambda k, v: cast_to(k, have.keyType, want.keyType)),
                                  lambda k, v: cast_to(v, have.valueType, want.valueType))
    if isinstance(want, StringType) and isinstance(have, (StructType, ArrayType, MapType)):
        return F.to_json(c)
    if isinstance(want, StringType) and isinstance(have, BooleanType):
        return F.when(c, F.lit("true")).when(~c, F.lit("false"))
    return c.cast(want)


def footer_schemas(spark: SparkSession, path: str) -> DataFrame:
    """``path, schema`` (Spark's JSON form where the file has it, else the
    Arrow schema in base64) of every Parquet file below ``path``, from the
    footers alone, read in tasks."""
    files = list_tree(spark, path).filter(~F.col("is_dir") & F.col("name").endswith(".parquet")
                                          & ~F.col("name").rlike("^[._]") & ~F.col("path").contains("/_temporary/"))
    ship_package(spark)

    def read(batches):
        import base64

        import pandas as pd
        import pyarrow.parquet as pq

        for pdf in batches:
            found = []
            for p in pdf["path"]:
                fs, inner = resolve_path(p)
                schema = pq.read_schema(inner, filesystem=fs)
                own = (schema.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
                found.append(own.decode() if own else
                             "arrow:" + base64.b64encode(schema.remove_metadata().serialize().to_pybytes()).decode())
            yield pd.DataFrame({"path": pdf["path"], "schema": found})

    listed = materialize(files.select("path"), shared_path(spark, "footer-files"))
    tasks = max(1, min(listed.count(), 4 * default_parallelism(spark)))
    return materialize(listed.repartition(tasks).mapInPandas(read, "path string, schema string"), shared_path(spark, "footers"))


def _schema_of(text: str) -> StructType:
    if not text.startswith("arrow:"):
        import json

        return StructType.fromJson(json.loads(text))
    import base64

    import pyarrow as pa
    from pyspark.sql.pandas.types import from_arrow_schema

    return from_arrow_schema(pa.ipc.read_schema(pa.py_buffer(base64.b64decode(text[6:]))), prefer_timestamp_ntz=True)


def read_typed(spark: SparkSession, path: str) -> DataFrame:
    """All batches below ``path`` as one table of the joined types; columns a
    batch does not have are NULL. One scan per distinct schema, however many
    files; columns come in the order of the schemas' texts. No files: an error."""
    footers = footer_schemas(spark, path)
    texts = [r["schema"] for r in footers.select("schema").distinct().orderBy("schema").collect()]  # distinct schemas
    if not texts:
        raise FileNotFoundError(f"no Parquet file below {path!r}")
    schemas = {t: _schema_of(t) for t in texts}
    joined = reduce(join_schemas, schemas.values(), StructType([]))
    parts = []
    for text, own in schemas.items():
        # file names, as any file listing of Spark's keeps them on the driver
        files = [r["path"] for r in footers.filter(F.col("schema") == F.lit(text)).select("path").collect()]
        part = spark.read.schema(own).parquet(*files)
        kinds = {f.name: f.dataType for f in own.fields}
        parts.append(part.select(*[
            (cast_to(F.col(f"`{f.name}`"), kinds[f.name], f.dataType) if f.name in kinds else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in joined.fields]))
    return reduce(DataFrame.unionByName, parts)
