"""Session settings the pipeline relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A task of a partitioned write meets at most twelve months. It keeps their files
    # open side by side instead of sorting all its rows by month first.
    "spark.sql.maxConcurrentOutputFileWriters": "12",
    # The two digests are most of a stored row and do not shrink under the default codec.
    "spark.sql.parquet.compression.codec": "zstd",
    # The legacy 96-bit timestamps are slower to read and have no statistics to skip by.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

# A shuffle starts with this many partitions per core, adaptive execution then merges
# the small ones. Spark's fixed 200 would make them far too large on a large cluster.
PARTITIONS_PER_CORE = 3
_PARTITION_SETTINGS = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a running session, leaving alone what its owner set."""
    chosen = spark.conf.getAll
    settings = dict(SQL_SETTINGS)
    if not any(key in chosen for key in _PARTITION_SETTINGS):
        cores = spark.sparkContext.defaultParallelism
        settings[_PARTITION_SETTINGS[1]] = str(max(200, PARTITIONS_PER_CORE * cores))
    for key, value in settings.items():
        if key not in chosen:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A one-machine session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("triplake")
    settings = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        **SQL_SETTINGS,
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
