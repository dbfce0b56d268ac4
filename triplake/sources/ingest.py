"""Reading monthly files whose schemas drift into one frame per category.

The common schema is worked out first, on the driver, from the files' schemas
alone. Each month then needs a single projection onto it, so the plan is one
flat union of scans however many months there are, and no type is widened by
accident.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triplake.sources.files import MonthFile

_SCHEMA_READERS = 16

#: What tagging adds; a file's own columns of these names, in any spelling, are replaced.
_LINEAGE = ("ingested_at", "source_file", "_partition_year", "_partition_month")

_MOST_DIGITS = 38

_INTEGRAL = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """A type that can hold both; text when numbers meet anything else."""
    if a == b:
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    if a in _INTEGRAL and b in _INTEGRAL:
        return max(a, b, key=_INTEGRAL.index)
    exact = [_as_decimal(kind) for kind in (a, b)]
    if all(exact):
        scale = max(kind.scale for kind in exact)
        whole = max(kind.precision - kind.scale for kind in exact)
        if whole + scale <= _MOST_DIGITS:
            return T.DecimalType(whole + scale, scale)
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    clock = (T.TimestampType, T.TimestampNTZType, T.DateType)
    if isinstance(a, clock) and isinstance(b, clock):
        return T.TimestampNTZType()
    return T.StringType()


def _as_decimal(kind: T.DataType) -> T.DecimalType | None:
    """The decimal that holds every value of an exact type."""
    if isinstance(kind, T.DecimalType):
        return kind
    digits = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}.get(type(kind))
    return T.DecimalType(digits, 0) if digits else None


def common_schema(schemas: Iterable[T.StructType]) -> T.StructType:
    """All columns of all schemas, matched without regard to case, each in a type that fits all.

    The first spelling and the first position win. A column that is NULL in
    every file becomes text, because tables cannot store an untyped column.
    """
    names: dict[str, str] = {}
    kinds: dict[str, T.DataType] = {}
    for schema in schemas:
        for field in schema:
            key = field.name.lower()
            names.setdefault(key, field.name)
            kinds[key] = _wider(kinds[key], field.dataType) if key in kinds else field.dataType
    return T.StructType(
        [
            T.StructField(name, T.StringType() if isinstance(kinds[key], T.NullType) else kinds[key])
            for key, name in names.items()
        ]
    )


def _onto(df: DataFrame, schema: T.StructType) -> list[Column]:
    """The frame's columns in the schema's order, names and types; missing ones are NULL."""
    own = {name.lower(): name for name in df.columns}
    return [
        (F.col(f"`{own[f.name.lower()]}`") if f.name.lower() in own else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema
    ]


def onto(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*_onto(df, schema))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union frames of one schema pairwise, which keeps the unoptimised plan shallow."""
    frames = list(frames)
    while len(frames) > 1:
        pairs = [a.union(b) for a, b in zip(frames[::2], frames[1::2])]
        frames = pairs + frames[len(pairs) * 2 :]
    return frames[0]


def without_lineage(months: Sequence[tuple[MonthFile, DataFrame]]) -> list[tuple[MonthFile, DataFrame]]:
    """The months without columns that tagging adds."""
    return [(file, df.drop(*(name for name in df.columns if name.lower() in _LINEAGE))) for file, df in months]


def union_months(months: Sequence[tuple[MonthFile, DataFrame]]) -> DataFrame:
    """Bring the months onto their common schema, tag each row with its file, and union them."""
    months = without_lineage(months)
    schema = common_schema(df.schema for _, df in months)
    return union_all(
        [
            df.select(
                *_onto(df, schema),
                F.current_timestamp().alias("ingested_at"),
                F.lit(file.name).alias("source_file"),
                F.lit(file.year).alias("_partition_year"),
                F.lit(file.month).alias("_partition_month"),
            )
            for file, df in months
        ]
    )


def month_frames(spark: SparkSession, files: Sequence[MonthFile]) -> list[tuple[MonthFile, DataFrame]]:
    """Every month's file, or directory of part files, with its own schema.

    Finding a file's schema is a small job of its own. They run side by side, as
    one after the other they would hold up years of monthly files for minutes.
    """
    reader = spark.read.option("mergeSchema", True)
    with ThreadPoolExecutor(_SCHEMA_READERS) as pool:
        frames = list(pool.map(lambda file: reader.parquet(file.path), files))
    return list(zip(files, frames))


def read_months(spark: SparkSession, files: Sequence[MonthFile]) -> DataFrame:
    """Scan every month into one tagged frame."""
    return union_months(month_frames(spark, files))
