"""Helpers of several operators: stored intermediate tables, size-checked semi joins, hidden-name guards."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a key list is broadcast; longer lists are joined by a shuffle.
BROADCAST_ROWS = 300_000

#: Stands for a null id inside an operator, so that nulls group and sort like any value.
NULL_ID = -(2**63)

#: Folders of the tables stored within each settled() that this thread is in.
_made = threading.local()


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; one of our own only where that is unset (single-machine tests)."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = tempfile.mkdtemp(prefix="checkpoint-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """df as written to the shared folder and read again: its lineage ends there and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    # Shuffle files of finished jobs are freed only when the driver's garbage is collected. Right after a job Spark still
    # holds on to it, so what the last table left goes before the next one is written.
    spark.sparkContext._jvm.System.gc()
    df.write.option("compression", "zstd").parquet(path)
    for paths in getattr(_made, "scopes", [])[-1:]:
        paths.append(path)
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def settled(make: Callable[[], DataFrame | tuple[DataFrame, ...]]) -> DataFrame | tuple[DataFrame, ...]:
    """make()'s rows, stored; the tables that it stored on the way are deleted then, so nothing else may read them.

    A tuple that make() returns is stored table by table.
    """
    if not hasattr(_made, "scopes"):
        _made.scopes = []
    _made.scopes.append([])
    try:
        df = make()
    finally:
        paths = _made.scopes.pop()
    several = df if isinstance(df, tuple) else (df,)
    out = tuple(map(stored, several))
    context = out[0].sparkSession.sparkContext
    for path in paths:
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
    return out if isinstance(df, tuple) else out[0]


def semi(df: DataFrame, keys: DataFrame, on: list[str] | str, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Rows of df whose key is in keys. keys is broadcast only if it was counted to have at most `limit` rows."""
    keys = keys.select(on).distinct()
    small = keys.limit(limit + 1).count() <= limit
    return df.join(F.broadcast(keys) if small else keys, on, "left_semi")


def known_id(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(NULL_ID))


def public_id(column: str) -> Column:
    return F.when(F.col(column) != NULL_ID, F.col(column))


def let(value: Column, body) -> Column:
    """body(value), with value computed once however often body uses it."""
    return F.transform(F.array(value), body)[0]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
