"""Tables whose nested types grow with what is written: fields are added, numbers widened, everything else refused.

The type of a table is kept in a folder beside it, a version for each change. Files are never rewritten for a change: they are read under the
newest type, in which what an old file lacks is null and narrower numbers are widened by the reader.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creaseline.sinks import tables

#: Numbers that fit one into the next without loss, as Parquet readers widen them.
WIDER = {("tinyint", "smallint"), ("tinyint", "int"), ("tinyint", "bigint"), ("smallint", "int"), ("smallint", "bigint"), ("int", "bigint"), ("float", "double"), ("tinyint", "double"), ("smallint", "double"), ("int", "double")}


class RefusedTypeError(ValueError):
    """A change that would lose or reinterpret values."""


def merged_type(old: T.DataType, new: T.DataType, where: str = "row") -> T.DataType:
    """The type that holds both; old fields keep their places, new ones follow."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        theirs = {f.name.lower(): f for f in new.fields}
        if len(theirs) < len(new.fields):
            raise RefusedTypeError(f"{where} has fields that differ in case only")
        fields = [T.StructField(f.name, merged_type(f.dataType, theirs[f.name.lower()].dataType, f"{where}.{f.name}") if f.name.lower() in theirs else f.dataType, True) for f in old.fields]
        known = {f.name.lower() for f in old.fields}
        return T.StructType(fields + [T.StructField(f.name, optional(f.dataType), True) for f in new.fields if f.name.lower() not in known])
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(merged_type(old.elementType, new.elementType, f"{where}[]"), True)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return T.MapType(merged_type(old.keyType, new.keyType, f"{where} keys"), merged_type(old.valueType, new.valueType, f"{where} values"), True)
    a, b = old.simpleString(), new.simpleString()
    if a == b or b == "void" or (b, a) in WIDER:
        return old
    if (a, b) in WIDER:
        return new
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType) and old.scale == new.scale:
        return old if old.precision >= new.precision else new
    raise RefusedTypeError(f"{where} is {a}; {b} is refused")


def optional(kind: T.DataType) -> T.DataType:
    """The type with every part nullable, as files that lack it need."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, optional(f.dataType), True) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(optional(kind.elementType), True)
    return T.MapType(optional(kind.keyType), optional(kind.valueType), True) if isinstance(kind, T.MapType) else kind


def as_type(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value under a merged type of its own: missing fields are null, null stays null."""
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        own = {f.name.lower(): f for f in have.fields}
        parts = [as_type(value[own[f.name.lower()].name], own[f.name.lower()].dataType, f.dataType) if f.name.lower() in own else F.lit(None).cast(f.dataType) for f in want.fields]
        return F.when(value.isNotNull(), F.struct(*[p.alias(f.name) for p, f in zip(parts, want.fields, strict=True)]))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(value, lambda x: as_type(x, have.elementType, want.elementType))
    if isinstance(want, T.MapType) and isinstance(have, T.MapType):
        return F.transform_values(F.transform_keys(value, lambda k, _: as_type(k, have.keyType, want.keyType)), lambda _, v: as_type(v, have.valueType, want.valueType))
    return value.cast(want)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    own = {f.name.lower(): f for f in df.schema.fields}
    return df.select(*[(as_type(F.col(f"`{own[f.name.lower()].name}`"), own[f.name.lower()].dataType, f.dataType) if f.name.lower() in own else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


VERSIONS = "version int, change string, schema string"


def versions(spark: SparkSession, path: str) -> DataFrame:
    """The changes of a table's type: version, change (INITIAL, ADD, TYPE_CHANGE), schema as JSON."""
    return spark.read.schema(VERSIONS).parquet(f"{path.rstrip('/')}.schema")


def current(spark: SparkSession, path: str) -> T.StructType | None:
    """The type of a table; None if there is no table."""
    try:
        row = versions(spark, path).orderBy(F.col("version").desc()).first()
    except Exception as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return None
    return T.StructType.fromJson(json.loads(row["schema"]))


def fields_of(kind: T.DataType, where: str = "") -> set[str]:
    """The paths of all fields, nested ones too."""
    if isinstance(kind, T.StructType):
        return {p for f in kind.fields for p in ({f"{where}.{f.name}"} | fields_of(f.dataType, f"{where}.{f.name}"))}
    if isinstance(kind, T.ArrayType):
        return fields_of(kind.elementType, f"{where}[]")
    return fields_of(kind.valueType, f"{where}{{}}") | fields_of(kind.keyType, f"{where}<>") if isinstance(kind, T.MapType) else set()


def evolve(df: DataFrame, path: str) -> tuple[T.StructType, str]:
    """The type that the table at path has from now on, and the change: a new version is stored before any row of it is written."""
    spark, old = df.sparkSession, current(df.sparkSession, path)
    new = optional(df.schema) if old is None else merged_type(old, df.schema)
    if old is not None and new == old:
        return old, "NO_CHANGE"
    change = "INITIAL" if old is None else "ADD" if fields_of(new) - fields_of(old) else "TYPE_CHANGE"
    number = 0 if old is None else versions(spark, path).agg(F.max("version")).first()[0] + 1
    spark.createDataFrame([(number, change, new.json())], VERSIONS).coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}.schema")
    return new, change


def read(spark: SparkSession, path: str) -> DataFrame:
    """All rows under the newest type."""
    return spark.read.schema(current(spark, path)).parquet(path)


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Append df, whose type may add to the table's or be older; returns the change."""
    schema, change = evolve(df, path)
    tables.append(conform(df, schema), path, partition_by)
    return change


def keyed_replace(df: DataFrame, path: str, keys: list[str], scope: DataFrame | None = None, buckets: int | None = None) -> str:
    """Replace the rows of df's keys in a keyed table (made by the first call); only touched buckets take the new type on disk. Returns the change."""
    spark = df.sparkSession
    schema, change = evolve(df, path)
    rows = conform(df, schema)
    if tables.keyed_exists(spark, path):
        tables.keyed_replace(rows, path, keys, scope, schema=schema)
    else:
        tables.create_keyed(rows, path, keys, buckets)
    return change


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    return tables.read_keyed(spark, path, current(spark, path))
