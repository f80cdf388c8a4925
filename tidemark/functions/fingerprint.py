"""Row fingerprints (C7, C21): one Project over all columns, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, FloatType, MapType, StructType


def packed_text(df: DataFrame, cols=None) -> Column:
    """All columns, in order, packed into a struct and cast to text: ``{1, abc, null}``."""
    names = list(cols) if cols is not None else df.columns
    return F.struct(*[df[c] for c in names]).cast("string")


def row_fingerprint(df: DataFrame, cols=None) -> Column:
    """SHA-256 of the packed text.

    Ambiguous by construction: ``('a, b', 'c')`` and ``('a', 'b, c')`` hash
    equal, as do NULL and the text ``'null'``. Use :func:`strict_fingerprint`
    when that matters.
    """
    return F.sha2(packed_text(df, cols), 256)


def add_hash_column(df: DataFrame, hash_col_name: str = "hash") -> DataFrame:
    """Append (or replace) ``hash_col_name`` with the fingerprint of all current
    columns; an existing column of that name is hashed too, then replaced."""
    return df.withColumn(hash_col_name, row_fingerprint(df))


def strict_fingerprint(df: DataFrame, cols=None) -> Column:
    """SHA-256 of the JSON text of the row (field names, quoting, explicit nulls)."""
    names = list(cols) if cols is not None else df.columns
    return F.sha2(F.to_json(F.struct(*[df[c] for c in names]), {"ignoreNullFields": "false"}), 256)


def add_strict_hash_column(df: DataFrame, hash_col_name: str = "hash") -> DataFrame:
    return df.withColumn(hash_col_name, strict_fingerprint(df))


def canonical(c: Column, kind: DataType) -> Column:
    """The value in a form in which equal values are equal texts: map entries
    sorted by key, negative zero as zero, all the way down."""
    if isinstance(kind, StructType):
        fields = [canonical(c[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(c.isNotNull(), F.struct(*fields)) if fields else c
    if isinstance(kind, ArrayType):
        return F.transform(c, lambda x: canonical(x, kind.elementType))
    if isinstance(kind, MapType):
        entries = F.transform(F.map_entries(c), lambda e: F.struct(
            canonical(e["key"], kind.keyType).alias("key"), canonical(e["value"], kind.valueType).alias("value")))
        return F.sort_array(entries)
    if isinstance(kind, (FloatType, DoubleType)):
        return F.when(c == 0, F.lit(0.0).cast(kind)).otherwise(c)
    return c


def canonical_fingerprint(df: DataFrame, cols=None) -> Column:
    """SHA-256 of the row's canonical JSON (fields in order, NULLs written).
    Unlike the other two it is defined for nested columns: maps that hold the
    same entries hash equal whatever their order, in structs and arrays too."""
    parts = [canonical(F.col(f"`{c}`"), df.schema[c].dataType).alias(c) for c in (cols or df.columns)]
    return F.sha2(F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}), 256)
