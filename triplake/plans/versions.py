"""Stored tables that change by one catalog switch.

A name that users query is a view. Behind it, in a database of its own (`<database>__store`), are

* segments `<table>__s<n>`: managed tables, each the rows of one write, written whole and never changed, and
* versions `<table>__v<n>`: external tables without files of their own, whose partitions lie in segments.

A replacement writes a segment and then points the view at it. Replacing some partitions writes a segment of their rows
alone and a version that takes all other partitions from where they are; nothing else is read or written. `CREATE OR REPLACE
VIEW` is one change of one catalog entry, so whatever dies before or after it leaves the old or the new table, never none,
and a reader that has begun keeps the files it began with.

The version before the current one is kept for such readers. Older ones, and what a broken run left behind, go with the next
replacement. A segment stays while any partition of it is in use.

The view may leave out columns and rows: a layer can be partitioned by columns that its contract doesn't have. One writer at
a time is assumed for a table.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from triplake.config import Settings
from triplake.sources.ingest import common_schema, onto

#: Properties of the view and of versions. They hold the ends of names alone (s1, v2): Spark hides values that look secret.
CURRENT, PREVIOUS, SEGMENTS = "triplake.current", "triplake.previous", "triplake.segments"


class Unexpected(ValueError):
    """Rows to be stored break what the caller expects of them."""


def _place(name: str) -> tuple[str, str]:
    database, table = name.split(".")
    return f"{database}__store", table


def _full(name: str, end: str) -> str:
    store, table = _place(name)
    return f"{store}.{table}__{end}"


def _end(stored: str) -> str:
    return stored.rsplit("__", 1)[1]


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def _is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType == "VIEW"


def current(spark: SparkSession, name: str) -> str | None:
    """The stored table behind a name, with all its columns; None if there is none."""
    if not spark.catalog.tableExists(name):
        return None
    told = _properties(spark, name).get(CURRENT) if _is_view(spark, name) else None
    return _full(name, told) if told else name


def stored_tables(spark: SparkSession, name: str) -> dict[str, int]:
    """Segments and versions of a name, with their numbers."""
    store, table = _place(name)
    if not spark.catalog.databaseExists(store):
        return {}
    listed = spark.sql(f"SHOW TABLES IN {store} LIKE '{table}__*'").collect()
    found = ((row.tableName, re.fullmatch(rf"{re.escape(table)}__[sv](\d+)", row.tableName)) for row in listed)
    return {f"{store}.{t}": int(m[1]) for t, m in found if m}


def _next(spark: SparkSession, name: str) -> int:
    return max(stored_tables(spark, name).values(), default=0) + 1


def write_segment(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), where: str | None = None, expected: Mapping[str, Column] | None = None
) -> tuple[str, int]:
    """Write the rows beside the current table: the segment and its number of rows that satisfy where, counted by the write.

    expected: counts of rows that must be 0, taken along by the same write. If one is not, the segment goes again.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_place(name)[0]}")
    segment = _full(name, f"s{_next(spark, name)}")
    seen, expected = Observation(), expected or {}
    counts = [F.coalesce(count, F.lit(0)).alias(f"bad_{i}") for i, count in enumerate(expected.values())]
    shown = F.count_if(F.expr(where)) if where else F.count(F.lit(1))
    writer = df.observe(seen, shown.alias("n_rows"), *counts).write.format("parquet")
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(segment)
    wrong = {what: seen.get[f"bad_{i}"] for i, what in enumerate(expected) if seen.get[f"bad_{i}"]}
    if wrong:
        spark.sql(f"DROP TABLE {segment}")
        raise Unexpected(f"{name}: " + ", ".join(f"{what}: {n} rows" for what, n in wrong.items()))
    return segment, seen.get["n_rows"]


def publish(spark: SparkSession, name: str, stored: str, columns: Sequence[str] | None = None, where: str | None = None) -> None:
    """Point the name at a stored table: the one step that users see."""
    previous = current(spark, name) or ""
    if previous == name:
        # A table of an earlier layout has the name itself; it makes room once, when its successor is written.
        spark.sql(f"DROP TABLE {name}")
        previous = ""
    previous = _end(previous) if previous else ""
    chosen = ", ".join(f"`{c}`" for c in columns) if columns else "*"
    condition = f" WHERE {where}" if where else ""
    told = f"'{CURRENT}' = '{_end(stored)}', '{PREVIOUS}' = '{previous}'"
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({told}) AS SELECT {chosen} FROM {stored}{condition}")


def sweep(spark: SparkSession, name: str) -> None:
    """Drop stored tables that neither the current nor the previous version needs."""
    told = _properties(spark, name)
    live = {_full(name, told[key]) for key in (CURRENT, PREVIOUS) if told.get(key)}
    found = stored_tables(spark, name)
    for version in [v for v in live if v in found]:
        live |= {_full(name, end) for end in filter(None, _properties(spark, version).get(SEGMENTS, "").split(","))}
    for table in found:
        if table not in live:
            spark.sql(f"DROP TABLE {table}")


def _spec(keys: Sequence[str], value: Sequence) -> str:
    return "PARTITION (" + ", ".join(f"`{k}` = {v}" for k, v in zip(keys, value, strict=True)) + ")"


def partitions(spark: SparkSession, stored: str) -> list[tuple[int, ...]]:
    """Values of the partitions of a stored table, from the catalog alone. Partition columns hold integers."""
    rows = spark.sql(f"SHOW PARTITIONS {stored}").collect()
    return [tuple(int(part.split("=", 1)[1]) for part in row.partition.split("/")) for row in rows]


def _location(spark: SparkSession, stored: str, spec: str = "") -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {stored} {spec}").collect()
    return next(row.data_type for row in rows if row.col_name == "Location")


def replace(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), columns: Sequence[str] | None = None, where: str | None = None, expected: Mapping[str, Column] | None = None
) -> int:
    """Replace a table, schema included; the rows written."""
    spark = df.sparkSession
    segment, rows = write_segment(df, name, partition_by, where, expected)
    publish(spark, name, segment, columns, where)
    sweep(spark, name)
    return rows


def replace_partitions(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str],
    values: Collection[Sequence[int]],
    columns: Sequence[str] | None = None,
    where: str | None = None,
    expected: Mapping[str, Column] | None = None,
) -> int:
    """Replace the partitions of the given values and leave the files of all others as they are; the rows written.

    Rows of df belong to these partitions. New columns are NULL in the other partitions. Where df has wider types, all
    partitions are written again, once, with the common schema.
    """
    spark, keys = df.sparkSession, list(partition_by)
    old = current(spark, name)
    stored = spark.table(old)
    schema = common_schema([stored.schema, df.schema])
    kinds = {f.name: f.dataType for f in schema}
    gone = {tuple(value) for value in values}
    if any(kinds[f.name] != f.dataType for f in stored.schema) or not set(keys) <= set(stored.columns) or old == name:
        named = " OR ".join("(" + " AND ".join(f"`{k}` <=> {v}" for k, v in zip(keys, one)) + ")" for one in gone)
        others = stored.where(f"NOT ({named})") if gone else stored
        # Counted apart, as the write holds the other partitions too.
        written = df.count()
        replace(onto(others, schema).unionByName(onto(df, schema)), name, keys, columns, where, expected)
        return written
    segment, rows = write_segment(onto(df, schema), name, keys, where, expected)
    version = _full(name, f"v{_next(spark, name)}")
    made = spark.table(segment).schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in made)
    root = _location(spark, segment)
    places = [(segment, value) for value in partitions(spark, segment)]
    places += [(old, value) for value in partitions(spark, old) if value not in gone]
    at = {value: _location(spark, stored_at, _spec(keys, value)) for stored_at, value in places}
    # A managed table's folder has its name, which tells the segments that partitions lie in.
    table = _place(name)[1]
    found = (re.search(rf"/{re.escape(table)}__(s\d+)/", where_it_lies, re.IGNORECASE) for where_it_lies in at.values())
    used = {_end(segment), *(m[1] for m in found)}
    spark.sql(
        f"CREATE TABLE {version} ({fields}) USING parquet PARTITIONED BY ({', '.join(f'`{k}`' for k in keys)})"
        f" LOCATION '{root}__version' TBLPROPERTIES ('{SEGMENTS}' = '{','.join(sorted(used))}')"
    )
    if at:
        added = " ".join(f"{_spec(keys, value)} LOCATION '{location}'" for value, location in at.items())
        spark.sql(f"ALTER TABLE {version} ADD {added}")
    publish(spark, name, version, columns, where)
    sweep(spark, name)
    return rows
