"""How the monthly files of one category differ in schema, and what the common schema does to their values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triplake.sources.files import MonthFile
from triplake.sources.ingest import common_schema, union_all, without_lineage


def _reworded(column: Column, own: T.DataType, common: T.DataType) -> Column:
    """Values that read differently as text once they have the common type, or are lost; hashes of their rows change."""
    if own == common or isinstance(own, T.NullType):
        return F.lit(0).cast("long")
    before, after = column.cast("string"), column.try_cast(common).cast("string")
    return F.count_if(column.isNotNull() & ~before.eqNullSafe(after))


def _status(field: T.StructField | None, common: T.StructField) -> str:
    if field is None:
        return "missing"
    if field.dataType != common.dataType:
        return "retyped"
    return "respelled" if field.name != common.name else "same"


def drift_history(months: Sequence[tuple[MonthFile, DataFrame]]) -> DataFrame:
    """A row per file and column of the common schema: the file's own spelling and type, its values, and those reworded.

    Files that all agree on a column give `same` throughout. Each file is one pass that reads only retyped columns and
    the null counts of the others, aggregated in the tasks; the rest of the result comes from the files' schemas.
    """
    months = without_lineage(months)
    schema = common_schema(df.schema for _, df in months)
    return union_all([_file_rows(file, df, schema) for file, df in months])


def _file_rows(file: MonthFile, df: DataFrame, schema: T.StructType) -> DataFrame:
    own = {field.name.lower(): field for field in df.schema}
    measures, rows = [F.count(F.lit(1)).alias("n_rows")], []
    for at, common in enumerate(schema):
        field = own.get(common.name.lower())
        if field is not None:
            column = F.col(f"`{field.name}`")
            measures += [F.count(column).alias(f"v{at}"), _reworded(column, field.dataType, common.dataType).alias(f"r{at}")]
        none = F.lit(0).cast("long")
        rows.append(
            F.struct(
                F.lit(common.name).alias("column_name"),
                F.lit(field.name if field else None).cast("string").alias("file_column"),
                F.lit(field.dataType.simpleString() if field else None).cast("string").alias("file_type"),
                F.lit(common.dataType.simpleString()).alias("common_type"),
                F.lit(_status(field, common)).alias("status"),
                F.col("n_rows"),
                (F.col(f"v{at}") if field else none).alias("n_values"),
                (F.col(f"r{at}") if field else none).alias("n_reworded"),
            )
        )
    named = (F.lit(file.name).alias("source_file"), F.lit(file.year).alias("file_year"), F.lit(file.month).alias("file_month"))
    return df.agg(*measures).select(*named, F.inline(F.array(*rows)))
