"""Run the pipeline on a cluster: spark-submit … triplake/__main__.py --landing <folder>."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from triplake.config import Settings
from triplake.plans.pipeline import Pipeline


def main() -> None:
    options = argparse.ArgumentParser(description=__doc__)
    options.add_argument("--landing", default=Settings.landing, help="folder with one folder of files per category")
    options.add_argument("--format", default=Settings.table_format, help="table format, parquet or delta")
    chosen = options.parse_args()

    spark = SparkSession.builder.appName("triplake").getOrCreate()
    pipeline = Pipeline(spark, Settings(landing=chosen.landing, table_format=chosen.format))
    for table, rows in pipeline.run().items():
        print(f"{table}: {rows:,} rows")
    pipeline.reconciliation().orderBy("taxi_type").show(truncate=False)
    pipeline.violations().orderBy("taxi_type", "check_name").show(100, truncate=False)
    pipeline.monthly().show(truncate=False)
    pipeline.hourly().show(24, truncate=False)


if __name__ == "__main__":
    main()
