"""Databases, tables and views: writing, listing, checking and removing them."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from triplake.config import RETIRED, RETIRED_OPTIONAL, Settings
from triplake.plans import versions
from triplake.sources.ingest import common_schema, onto, union_all


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def write_table(
    df: DataFrame,
    table: str,
    settings: Settings,
    partition_by: Sequence[str] = (),
    columns: Sequence[str] | None = None,
    where: str | None = None,
    expected: Mapping[str, Column] | None = None,
) -> int:
    """Replace a table, schema included, and return its rows as counted by the write itself.

    A count afterwards would be a second job over everything just written. columns and where: what of df users see under
    the name. expected: counts that must be 0 for the table to be replaced.
    """
    if settings.table_format != "delta":
        return versions.replace(df, table, partition_by, columns, where, expected)
    seen = Observation()
    shown = df.where(where) if where else df
    shown = shown.select(*columns) if columns else shown
    writer = shown.observe(seen, F.count(F.lit(1)).alias("n_rows")).write.format("delta").mode("overwrite")
    kept = [key for key in partition_by if key in shown.columns]
    writer = writer.option("overwriteSchema", True)
    (writer.partitionBy(*kept) if kept else writer).saveAsTable(table)
    return seen.get["n_rows"]


def replace_partitions(
    df: DataFrame,
    table: str,
    settings: Settings,
    partition_by: Sequence[str],
    values: Collection[Sequence[int]],
    columns: Sequence[str] | None = None,
    where: str | None = None,
    expected: Mapping[str, Column] | None = None,
) -> int:
    """Replace the partitions of the given values and leave the others; the rows written. Rows of df belong to these."""
    if settings.table_format != "delta":
        return versions.replace_partitions(df, table, partition_by, values, columns, where, expected)
    spark = df.sparkSession
    named = " OR ".join("(" + " AND ".join(f"{k} <=> {v}" for k, v in zip(partition_by, one)) + ")" for one in values)
    schema = common_schema([spark.table(table).schema, df.schema])
    seen = Observation()
    rows = onto(df, schema).observe(seen, F.count(F.lit(1)).alias("n_rows"))
    writer = rows.write.format("delta").mode("overwrite").option("mergeSchema", True)
    writer.option("replaceWhere", named or "false").saveAsTable(table)
    return seen.get["n_rows"]


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}")


def describe(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE {name}")


def layer_status(spark: SparkSession, tables: Sequence[str]) -> DataFrame:
    """Rows of each table; NULL for one that does not exist yet."""
    reports = []
    for name in tables:
        exists = spark.catalog.tableExists(name)
        source = spark.table(name) if exists else spark.range(1)
        rows = F.count(F.lit(1)) if exists else F.max(F.lit(None).cast("long"))
        reports.append(
            source.agg(rows.alias("n_rows")).select(
                F.lit(name).alias("table_name"), F.lit(exists).alias("table_exists"), "n_rows"
            )
        )
    return union_all(reports)


def drop_retired(
    spark: SparkSession, settings: Settings, include_optional: bool = False, dry_run: bool = True
) -> list[tuple[str, str, bool]]:
    """Remove artefacts of earlier versions; (name, kind, removed) of those that exist.

    The kind comes from the catalog, because dropping a view as a table is an error.
    """
    found = []
    for name in RETIRED + (RETIRED_OPTIONAL if include_optional else ()):
        full = settings.names.gold_table(name)
        if not spark.catalog.tableExists(full):
            continue
        kind = "VIEW" if spark.catalog.getTable(full).tableType == "VIEW" else "TABLE"
        if not dry_run:
            spark.sql(f"DROP {kind} IF EXISTS {full}")
        found.append((full, kind, not dry_run))
    return found
