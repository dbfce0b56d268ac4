"""Rows that don't enter the silver layer, whole and with the reason."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triplake.config import Settings
from triplake.operators.audit import DUPLICATE_RULE
from triplake.operators.dedup import numbered_copies
from triplake.operators.rules import first_failed, keep_valid, rules_for
from triplake.sources.ingest import union_all


def removed_copies(df: DataFrame) -> DataFrame:
    """The rows that `one_per_content` removes.

    Copies are numbered among those of their own partition first, and the firsts among all, so that a content that makes
    up a large part of the data never gathers in one task.
    """
    near = numbered_copies(df.withColumn("_part", F.spark_partition_id()), "_near", ("_part",))
    placed = numbered_copies(near, "_copy", ("if(_near = 1, -1, _part)",))
    return placed.where("_near > 1 OR _copy > 1").drop("_part", "_near", "_copy")


def rejected(canonical: Mapping[str, DataFrame], settings: Settings) -> DataFrame:
    """Every rejected row once, with the first rule it fails; a removed copy of a valid fhv row fails the last one.

    Together with silver these are all rows. Counts by category and rule are those of `removed_by_rule`.
    """
    reports = []
    for taxi_type, df in canonical.items():
        rules = rules_for(taxi_type, settings)
        reports.append(df.withColumn("rule", F.expr(first_failed(rules))).where("rule IS NOT NULL"))
        if taxi_type == "fhv":
            reports.append(removed_copies(keep_valid(df, rules)).withColumn("rule", F.lit(DUPLICATE_RULE)))
    return union_all(reports)
