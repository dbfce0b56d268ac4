"""Every query of the library over the stand-in sources, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.config import TAXI_TYPES
from triplake.functions.flags import FLAGS
from triplake.operators import audit, kpi, quality
from triplake.operators.dedup import one_per_content
from triplake.operators.drift import drift_history
from triplake.operators.fact import fact_trips
from triplake.operators.rejects import rejected
from triplake.operators.rules import first_failed, rules_for
from triplake.plans import silver as layer
from triplake.sources import standins
from triplake.sources.canonical import to_canonical
from triplake.sources.standins import SETTINGS

Query = Callable[[SparkSession, str], DataFrame]


class Layers:
    """The layers of the stand-in data, each built when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, taxi_type: str) -> DataFrame:
        return standins.raw(self.spark, self.sf_dir, taxi_type)

    def canonical(self, taxi_type: str) -> DataFrame:
        return to_canonical(self.raw(taxi_type), taxi_type)

    def valid(self, taxi_type: str) -> DataFrame:
        """Rows that satisfy the rules, copies included, with keys and flags."""
        return layer.instrumented(layer.valid(self.raw(taxi_type), taxi_type, SETTINGS), taxi_type)

    def reissued(self, taxi_type: str) -> DataFrame:
        """Valid rows, each reported a second time with corrections, with keys and flags."""
        kept = layer.valid(self.raw(taxi_type), taxi_type, SETTINGS)
        return layer.instrumented(standins.reissued(kept), taxi_type)

    def silver(self, taxi_type: str) -> DataFrame:
        return layer.silver(self.raw(taxi_type), taxi_type, SETTINGS)

    def each(self, build: Callable[[str], DataFrame]) -> dict[str, DataFrame]:
        return {taxi_type: build(taxi_type) for taxi_type in TAXI_TYPES}

    def together(self, build: Callable[[str], DataFrame]) -> DataFrame:
        return audit.all_types(self.each(build))

    def fact(self) -> DataFrame:
        return fact_trips(list(self.each(self.silver).values()))

    def view(self) -> DataFrame:
        return kpi.consumption_view(self.fact())


def _without_clock(df: DataFrame) -> DataFrame:
    """The time of ingestion differs on every run, so it is not part of a comparable result."""
    return df.drop("ingested_at")


def _query(build: Callable[[Layers], DataFrame]) -> Query:
    return lambda spark, sf_dir: _without_clock(build(Layers(spark, sf_dir)))


def _per_type(taxi_type: str) -> dict[str, Query]:
    return {
        f"canonical_{taxi_type}": _query(lambda at: at.canonical(taxi_type)),
        f"silver_{taxi_type}": _query(lambda at: at.silver(taxi_type)),
    }


def copies_by_file(raw: DataFrame) -> DataFrame:
    """Stored fhv rows of each file and how many of them users see, when files share records."""
    rows = layer.fhv_with_copies(layer.fhv_candidates(raw, SETTINGS))
    seen = F.count_if(F.expr(layer.SEEN)).alias("n_seen")
    return rows.groupBy("source_file").agg(F.count(F.lit(1)).alias("n_rows"), seen, F.max(layer.COPY).cast("long").alias("most_copies"))


def shared_tokens(raw: DataFrame) -> DataFrame:
    """fhv rows by the flag read from their token, and those that the rule about pickups removes."""
    rows = to_canonical(raw, "fhv").withColumn("failed", F.expr(first_failed(rules_for("fhv", SETTINGS))))
    no_pickup = F.count_if(F.col("failed") == "pickup_known").alias("n_without_pickup")
    return rows.groupBy("is_shared_ride").agg(audit.n_rows(), no_pickup)


def all_queries() -> dict[str, Query]:
    queries: dict[str, Query] = {
        "bronze_union_months": _query(lambda at: standins.drifting_months(at.spark, at.sf_dir)),
        "drift_history": _query(lambda at: drift_history(standins.drifting_files(at.spark, at.sf_dir))),
    }
    for taxi_type in TAXI_TYPES:
        queries |= _per_type(taxi_type)
    return queries | {
        "record_hash": _query(lambda at: at.together(at.valid).select("taxi_type", "record_hash")),
        "ride_key": _query(lambda at: at.together(at.valid).select("taxi_type", "ride_key")),
        "financial_flags": _query(
            lambda at: at.together(at.valid).groupBy("taxi_type", *FLAGS).agg(audit.n_rows())
        ),
        "dedup_fhv": _query(lambda at: one_per_content(layer.valid(at.raw("fhv"), "fhv", SETTINGS))),
        "fact_trips": _query(lambda at: at.fact()),
        "type_summary": _query(lambda at: kpi.type_summary(at.fact())),
        "kpi_monthly": _query(lambda at: kpi.yellow_totals(at.fact())),
        "kpi_month_only": _query(lambda at: kpi.yellow_totals(at.fact(), kpi.MONTH)),
        "kpi_month_average": _query(lambda at: kpi.yellow_totals(at.fact(), kpi.MONTH, average_only=True)),
        "kpi_hourly": _query(lambda at: kpi.hourly_passengers(at.fact())),
        "kpi_monthly_merged": _query(lambda at: kpi.merged_totals(kpi.partial_states(at.fact()))),
        "kpi_hourly_merged": _query(lambda at: kpi.merged_hourly(kpi.partial_states(at.fact()))),
        "type_summary_merged": _query(lambda at: kpi.merged_summary(kpi.partial_states(at.fact()))),
        "fhv_copies_by_file": _query(lambda at: copies_by_file(standins.fhv_files(at.raw("fhv")))),
        "fhv_shared_tokens": _query(lambda at: shared_tokens(standins.with_gaps(at.raw("fhv")))),
        "kpi_hourly_average": _query(lambda at: kpi.hourly_passengers(at.fact(), average_only=True)),
        "view_projection": _query(lambda at: at.view()),
        "kpi_monthly_view": _query(lambda at: kpi.yellow_totals(at.view(), kpi.MONTH, average_only=True)),
        "kpi_hourly_view": _query(lambda at: kpi.hourly_passengers(at.view(), average_only=True)),
        "contributors": _query(lambda at: kpi.contributors(at.fact())),
        "view_type_counts": _query(lambda at: kpi.trips_per_type(at.view())),
        "hours_present": _query(lambda at: kpi.hours_present(kpi.hourly_passengers(at.fact()))),
        "duplicate_hashes": _query(lambda at: quality.duplicate_hashes(at.valid("fhv"))),
        "reconciliation": _query(lambda at: quality.reconciliation(at.each(at.raw), at.each(at.silver))),
        "violations": _query(lambda at: quality.violations(at.each(at.silver), SETTINGS)),
        "violations_before_rules": _query(
            lambda at: quality.violations(
                at.each(lambda t: layer.instrumented(at.canonical(t), t)), SETTINGS
            )
        ),
        "null_totals": _query(lambda at: quality.null_totals(at.fact())),
        "null_totals_before_rules": _query(lambda at: quality.null_totals(at.together(at.canonical))),
        "month_coverage": _query(lambda at: quality.month_coverage(kpi.yellow_totals(at.fact()), SETTINGS)),
        "month_coverage_whole": _query(lambda at: quality.month_coverage(kpi.yellow_totals(at.fact()), standins.WHOLE)),
        "sample_limit": _query(
            lambda at: at.view().orderBy("tpep_pickup_datetime", *kpi.VIEW_COLUMNS.values()).limit(10)
        ),
        "duration_p99": _query(lambda at: audit.duration_p99(at.together(at.silver))),
        "distance_outliers": _query(lambda at: audit.distance_outliers(at.together(at.canonical), SETTINGS)),
        "null_ratio": _query(lambda at: audit.null_ratio(at.together(at.canonical))),
        "provider_share": _query(lambda at: audit.provider_share(at.together(at.silver))),
        "varying_fields": _query(lambda at: audit.varying_fields(at.together(at.valid))),
        "fare_conflicts": _query(lambda at: audit.fare_conflicts(at.together(at.valid))),
        "ride_repeats": _query(lambda at: audit.ride_repeats(at.together(at.valid))),
        "varying_fields_reissued": _query(lambda at: audit.varying_fields(at.together(at.reissued))),
        "fare_conflicts_reissued": _query(lambda at: audit.fare_conflicts(at.together(at.reissued))),
        "ride_repeats_reissued": _query(lambda at: audit.ride_repeats(at.together(at.reissued))),
        "cast_losses": _query(lambda at: audit.cast_losses(standins.unreadable(at.raw("yellow")), "yellow")),
        "removed_by_rule": _query(lambda at: audit.removed_by_rule(at.each(at.canonical), SETTINGS)),
        "rejected_rows": _query(lambda at: rejected(at.each(at.canonical), SETTINGS)),
        "flag_overlap": _query(lambda at: audit.flag_overlap(at.together(at.silver))),
        "mom_change": _query(lambda at: audit.month_over_month(kpi.yellow_totals(at.fact()))),
        "hour_extremes": _query(lambda at: audit.hour_extremes(kpi.hourly_passengers(at.fact()))),
    }
