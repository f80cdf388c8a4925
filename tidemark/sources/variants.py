"""Documents without a given schema.

Lines are parsed to VARIANT, which takes every JSON value as it is; lines that
are no JSON go to a rejects table. The schema is found by one aggregate over
all documents (types of a field meet; kinds that have no common type are kept
as text), and the flattening follows that schema, whatever levels it has.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DataType, DecimalType, DoubleType, NullType, StringType, StructField, StructType, VariantType

DOC_COL = "doc"


def read_variants(spark: SparkSession, path) -> tuple[DataFrame, DataFrame]:
    """``(documents, rejects)``: a VARIANT ``doc`` per JSON line, and the text
    (``line``) of the others. Blank lines are neither; what follows a complete
    value on its line is ignored, as by Spark's JSON readers."""
    return parse_variants(spark.read.text(path, wholetext=False), "value")


def parse_variants(df: DataFrame, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The same for a text column; its other columns stay."""
    text = F.col(text_col)
    parsed = df.where(F.trim(text) != "").withColumn(DOC_COL, F.try_parse_json(text))
    good = parsed.where(F.col(DOC_COL).isNotNull()).drop(text_col)
    bad = parsed.where(F.col(DOC_COL).isNull()).drop(DOC_COL).withColumnRenamed(text_col, "line")
    return good, bad


def _plain(t: DataType) -> DataType:
    """Found types as columns: mixed kinds and nothing but null as text,
    decimals (JSON numbers with a point) as doubles."""
    if isinstance(t, StructType):
        # an object of which nothing is known has no columns: its text stands for it
        return StructType([StructField(f.name, _plain(f.dataType), True) for f in t.fields]) if t.fields else StringType()
    if isinstance(t, ArrayType):
        return ArrayType(_plain(t.elementType), True)
    if isinstance(t, DecimalType):
        return DoubleType()
    return StringType() if isinstance(t, (VariantType, NullType)) else t


def found_schema(docs: DataFrame, doc_col: str = DOC_COL) -> DataType:
    """The schema of all documents, from one aggregate. No documents: text."""
    text = docs.agg(F.schema_of_variant_agg(F.col(doc_col)).alias("s")).first()["s"]
    if text is None:
        return StringType()
    # names in back quotes stay as they are
    ddl = "".join([p if p.startswith("`") else re.sub(r"\bOBJECT<", "STRUCT<", p) for p in re.split(r"(`(?:[^`]|``)*`)", text)])
    return _plain(StructType.fromDDL(f"x {ddl}")["x"].dataType)


def _ddl(t: DataType) -> str:
    """The type as text, with names of any characters."""
    if isinstance(t, StructType):
        return "struct<" + ",".join(["`{}`:{}".format(f.name.replace("`", "``"), _ddl(f.dataType)) for f in t.fields]) + ">"
    return f"array<{_ddl(t.elementType)}>" if isinstance(t, ArrayType) else t.simpleString()


def as_columns(docs: DataFrame, schema: DataType | None = None, doc_col: str = DOC_COL) -> DataFrame:
    """The documents with the columns of their (found) schema beside the other
    columns; a document that is no object has its value in ``value``."""
    schema = schema if schema is not None else found_schema(docs, doc_col)
    value = F.try_variant_get(F.col(doc_col), "$", _ddl(schema))
    if not isinstance(schema, StructType):
        return docs.withColumn("value", value).drop(doc_col)
    # read with its schema once; a document of another kind has NULLs
    parsed = docs.withColumn("__doc", value).drop(doc_col)
    return parsed.select(*[c for c in docs.columns if c != doc_col], *[F.col("__doc")[f.name].alias(f.name) for f in schema.fields])


def _free(name: str, taken: list[str]) -> str:
    while name in taken:
        name += "_"
    return name


def _lift(df: DataFrame) -> DataFrame:
    """Struct columns replaced by their fields, named ``<column>_<field>``
    where the field's own name is taken."""
    while structs := [f for f in df.schema.fields if isinstance(f.dataType, StructType)]:
        own = structs[0]
        names = [c for c in df.columns if c != own.name]
        lifted: list[Column] = []
        for f in own.dataType.fields:
            name = f.name if f.name not in names else _free(f"{own.name}_{f.name}", names)
            names.append(name)
            lifted.append(F.col(f"`{own.name}`")[f.name].alias(name))
        df = df.select(*[F.col(f"`{c}`") for c in df.columns if c != own.name], *lifted)
    return df


def flatten_found(df: DataFrame) -> dict[str, DataFrame]:
    """Every table that nested columns hold, by the path of its arrays
    (``""``: none, then ``orders``, ``orders.lines``, ...).

    Each table has the scalars of all levels above its own; a document with an
    empty or absent array keeps one row with NULLs. Arrays side by side give a
    table each, never their product.
    """
    out: dict[str, DataFrame] = {}

    def walk(path: str, rows: DataFrame) -> None:
        rows = _lift(rows)
        arrays = [f for f in rows.schema.fields if isinstance(f.dataType, ArrayType)]
        scalars = [F.col(f"`{f.name}`") for f in rows.schema.fields if not isinstance(f.dataType, ArrayType)]
        out[path] = rows.select(*scalars)
        for f in arrays:
            walk(f"{path}.{f.name}" if path else f.name, rows.select(*scalars, F.explode_outer(F.col(f"`{f.name}`")).alias(f.name)))

    walk("", df)
    return out
