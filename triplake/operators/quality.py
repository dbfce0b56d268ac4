"""Post-write checks and layer reconciliation, each table scanned once."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplake.config import Settings
from triplake.operators.rules import rules_for
from triplake.sources.ingest import union_all

DUPLICATE_CHECK = "record_hash_unique"

#: Categories whose trips have a total.
WITH_TOTAL = ("yellow", "green", "hvfhv")


def duplicate_hashes(df: DataFrame) -> DataFrame:
    """Record hashes that occur more than once, with their number of rows."""
    return df.groupBy("record_hash").agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def rule_expectations(taxi_type: str, settings: Settings) -> dict[str, Column]:
    """Counts of rows that break a rule, by rule; a write can take them along. A comparison with NULL is not a violation."""
    return {rule.name: F.expr(f"count_if(NOT ({rule.holds}))") for rule in rules_for(taxi_type, settings)}


def total_expectations() -> dict[str, Column]:
    """Count of missing totals of the categories that must have one."""
    missing = F.col("taxi_type").isin(*WITH_TOTAL) & F.col("total_amount").isNull()
    return {"null_totals": F.count_if(missing)}


def _broken_rules(df: DataFrame, taxi_type: str, settings: Settings) -> DataFrame:
    """All rules of a table in one aggregation; a comparison with NULL is not a violation."""
    counts = rule_expectations(taxi_type, settings)
    return df.agg(*[count.alias(name) for name, count in counts.items()]).unpivot([], list(counts), "check_name", "n_violations")


def violations(silver: Mapping[str, DataFrame], settings: Settings) -> DataFrame:
    """Rows breaking each rule per table, expected 0, and repeated hashes where duplicates were removed."""
    reports = [
        _broken_rules(df, taxi_type, settings).select(F.lit(taxi_type).alias("taxi_type"), "*")
        for taxi_type, df in silver.items()
    ]
    if "fhv" in silver:
        repeated = duplicate_hashes(silver["fhv"]).agg(F.count(F.lit(1)).alias("n_violations"))
        reports.append(
            repeated.select(F.lit("fhv").alias("taxi_type"), F.lit(DUPLICATE_CHECK).alias("check_name"), "n_violations")
        )
    return union_all(reports)


def null_totals(fact: DataFrame) -> DataFrame:
    """Missing totals of the categories that must have one, expected 0."""
    return (
        fact.where(F.col("taxi_type").isin(*WITH_TOTAL))
        .groupBy("taxi_type")
        .agg(F.count_if(F.col("total_amount").isNull()).alias("n_null_totals"))
    )


def month_coverage(monthly: DataFrame, settings: Settings) -> DataFrame:
    """Does the monthly KPI have one row for every month of the period?"""
    expected = F.lit(settings.months_in_period)
    return monthly.agg(F.count(F.lit(1)).alias("n_months")).select(
        "n_months", expected.cast("long").alias("expected"), (F.col("n_months") == expected).alias("complete")
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
            for name, df in tables.items()
        ]
    )


def reconciliation(bronze: Mapping[str, DataFrame], silver: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per category before and after the rules, and what share was removed."""

    def counted(layer: str, tables: Mapping[str, DataFrame]) -> DataFrame:
        return row_counts(tables).select(F.col("table_name").alias("taxi_type"), F.lit(layer).alias("layer"), "n_rows")

    both = counted("bronze", bronze).union(counted("silver", silver))
    rows_of = {
        layer: F.sum(F.when(F.col("layer") == layer, F.col("n_rows"))).alias(f"{layer}_rows")
        for layer in ("bronze", "silver")
    }
    removed = F.col("bronze_rows") - F.col("silver_rows")
    share = F.when(F.col("bronze_rows") > 0, F.round(removed / F.col("bronze_rows") * 100, 1))
    return (
        both.groupBy("taxi_type")
        .agg(*rows_of.values())
        .select("*", removed.alias("removed_rows"), share.alias("removed_pct"))
    )
