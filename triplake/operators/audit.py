"""Exploratory measures behind the thresholds and policies of the pipeline."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triplake.config import Settings
from triplake.functions.columns import seconds_between
from triplake.functions.flags import NEGATIVE_TIP, TOTAL_BELOW_FARE
from triplake.functions.keys import RECORD_FIELDS, content_identity
from triplake.operators.rules import first_failed, keep_valid, rules_for
from triplake.schema import CANONICAL
from triplake.sources.canonical import expressions, in_utc
from triplake.sources.ingest import union_all

DUPLICATE_RULE = "not_a_duplicate"

# Columns that depend on the run, or are the same for a whole category.
_TECHNICAL = ("taxi_type", "ingested_at")
MEASURED = [name for name in CANONICAL.fieldNames() if name not in _TECHNICAL]
OUTSIDE_HASH = [name for name in MEASURED if name not in RECORD_FIELDS]


#: Rows that a task of the comparison of copies reads, whatever the input and the session's number of partitions.
ROWS_PER_TASK = 250_000


def n_rows(name: str = "n_trips") -> Column:
    return F.count(F.lit(1)).alias(name)


def duration_p99(trips: DataFrame) -> DataFrame:
    """Exact 99th percentile of trip duration per category.

    Durations are whole seconds up to a day, so counting them first leaves at
    most 86,401 weighted rows per category for the percentile itself.
    """
    seconds = seconds_between("pickup_datetime", "dropoff_datetime")
    durations = trips.selectExpr("taxi_type", f"{seconds} AS seconds")
    counted = durations.groupBy("taxi_type", "seconds").agg(n_rows("weight"))
    return counted.groupBy("taxi_type").agg(
        F.percentile("seconds", F.lit(0.99), F.col("weight")).alias("p99_seconds"),
        F.max("seconds").alias("max_seconds"),
    )


def distance_outliers(trips: DataFrame, settings: Settings) -> DataFrame:
    """Largest distance per category, who reported it, and how many lie beyond the bound."""
    distance = F.col("trip_distance")
    by_provider = (
        trips.where(distance.isNotNull())
        .groupBy("taxi_type", "provider_id")
        .agg(F.max(distance).alias("furthest"), F.count_if(distance > settings.max_distance).alias("n_over"))
    )
    return by_provider.groupBy("taxi_type").agg(
        F.max("furthest").alias("max_distance"),
        F.max_by("provider_id", F.struct("furthest", "provider_id")).alias("max_provider_id"),
        F.sum("n_over").alias("n_over_bound"),
    )


def null_ratio(trips: DataFrame) -> DataFrame:
    """Share of NULLs of every column per category, in one pass."""
    shares = trips.groupBy("taxi_type").agg(
        *[(F.count_if(F.col(name).isNull()) / F.count(F.lit(1))).alias(name) for name in MEASURED]
    )
    return shares.unpivot(["taxi_type"], MEASURED, "column_name", "null_ratio")


def provider_share(trips: DataFrame) -> DataFrame:
    """Trips of each provider and their share of the category."""
    counts = trips.groupBy("taxi_type", "provider_id").agg(n_rows())
    # One row per category, so always small enough to broadcast.
    totals = counts.groupBy("taxi_type").agg(F.sum("n_trips").alias("category_trips"))
    return counts.join(F.broadcast(totals), "taxi_type").select(
        "taxi_type", "provider_id", "n_trips", (F.col("n_trips") / F.col("category_trips")).alias("share")
    )


def varying_fields(trips: DataFrame, fields: Sequence[str] = tuple(OUTSIDE_HASH)) -> DataFrame:
    """For records sharing a hash: in how many such groups does each remaining field differ?

    Smallest against largest value answers the question without a distinct count
    per field, which would copy every row once per field. Rows are exchanged once,
    by hash, to as many tasks as the rows need: the session's number of partitions
    is fixed, and a task's share would grow with the input. Found first, repeated
    hashes would cost a second pass, and a join that Spark moves into every part
    of the union.
    """
    tasks = trips.count() // ROWS_PER_TASK + 1
    groups = (
        trips.select("taxi_type", *fields, F.unhex("record_hash").alias("_digest"))
        .where("_digest IS NOT NULL")
        .repartition(tasks, "_digest")
        # The hash first: sorting by it compares eight bytes, by category everything ties.
        .groupBy("_digest", "taxi_type")
        .agg(
            n_rows("n_rows"),
            *[F.min(name).alias(f"lo_{name}") for name in fields],
            *[F.max(name).alias(f"hi_{name}") for name in fields],
            *[F.count(name).alias(f"n_{name}") for name in fields],
        )
        .where(F.col("n_rows") > 1)
    )

    def differs(name: str) -> Column:
        some_null = F.col(f"n_{name}").between(1, F.col("n_rows") - 1)
        return some_null | F.coalesce(F.col(f"lo_{name}") != F.col(f"hi_{name}"), F.lit(False))

    varying = [F.count_if(differs(name)).alias(name) for name in fields]
    summary = groups.groupBy("taxi_type").agg(n_rows("n_groups"), *varying)
    return summary.unpivot(["taxi_type", "n_groups"], list(fields), "column_name", "n_varying")


def _rides(trips: DataFrame) -> DataFrame:
    fare = F.coalesce(F.col("base_passenger_fare"), F.col("fare_amount"))
    return trips.groupBy("taxi_type", "ride_key").agg(
        n_rows("n_rows"), F.min(fare).alias("lowest_fare"), F.max(fare).alias("highest_fare")
    )


def fare_conflicts(trips: DataFrame) -> DataFrame:
    """Rides recorded with more than one base fare."""
    return _rides(trips).where("lowest_fare <> highest_fare")


def ride_repeats(trips: DataFrame) -> DataFrame:
    """Per category: rides, those recorded more than once, and those with conflicting fares."""
    return (
        _rides(trips)
        .groupBy("taxi_type")
        .agg(
            n_rows("n_rides"),
            F.count_if(F.col("n_rows") > 1).alias("n_repeated"),
            F.count_if(F.col("lowest_fare") != F.col("highest_fare")).alias("n_conflicting"),
        )
    )


def removed_by_rule(canonical: Mapping[str, DataFrame], settings: Settings) -> DataFrame:
    """Rows each rule removes, a row counting for the first rule it fails, and removed duplicates."""
    reports = []
    for taxi_type, df in canonical.items():
        rules = rules_for(taxi_type, settings)
        failed = df.selectExpr("taxi_type", f"{first_failed(rules)} AS rule")
        reports.append(failed.where(F.col("rule").isNotNull()).groupBy("taxi_type", "rule").agg(n_rows("n_removed")))
        if taxi_type == "fhv":
            contents = keep_valid(df, rules).groupBy(*map(F.expr, content_identity())).agg(n_rows("n_copies"))
            extra = contents.agg(F.coalesce(F.sum(F.col("n_copies") - 1), F.lit(0)).alias("n_removed"))
            reports.append(
                extra.select(F.lit(taxi_type).alias("taxi_type"), F.lit(DUPLICATE_RULE).alias("rule"), "n_removed")
            )
    return union_all(reports)


def flag_overlap(trips: DataFrame) -> DataFrame:
    """How often the two signs of inconsistent money meet, and trips free of fare but not of charge."""
    fare = "coalesce(base_passenger_fare, fare_amount)"
    charged = "CASE WHEN taxi_type = 'hvfhv' THEN tip_amount ELSE total_amount END"
    conditions = {
        "n_negative_tip": NEGATIVE_TIP,
        "n_total_below_fare": TOTAL_BELOW_FARE,
        "n_both": f"{NEGATIVE_TIP} AND {TOTAL_BELOW_FARE}",
        "n_zero_fare_charged": f"trip_distance > 0 AND {fare} = 0 AND {charged} > 0",
    }
    return trips.groupBy("taxi_type").agg(
        *[F.expr(f"count_if({condition})").alias(name) for name, condition in conditions.items()]
    )


def month_over_month(monthly: DataFrame) -> DataFrame:
    """Change of the monthly average against the month before and against the first month, in percent.

    The window is unpartitioned but runs over the KPI, one row per month.
    """
    in_order = Window.orderBy("pickup_year", "pickup_month")
    average = F.col("avg_total_amount")
    before, start = F.lag(average).over(in_order), F.first_value(average).over(in_order)
    return monthly.select(
        "pickup_year",
        "pickup_month",
        "avg_total_amount",
        F.round((average / before - 1) * 100, 1).alias("change_pct"),
        F.round((average / start - 1) * 100, 1).alias("growth_pct"),
    )


def hour_extremes(hourly: DataFrame) -> DataFrame:
    """Hours with the lowest and highest average and with most trips; the earlier hour wins a tie."""
    hour, average, trips = F.col("pickup_hour"), F.col("avg_passenger_count"), F.col("n_trips")
    return hourly.agg(
        F.min_by(hour, F.struct(average, hour)).alias("lowest_hour"),
        F.min(average).alias("lowest_avg"),
        F.max_by(hour, F.struct(average, -hour)).alias("highest_hour"),
        F.max(average).alias("highest_avg"),
        F.max_by(hour, F.struct(trips, -hour)).alias("busiest_hour"),
        F.max(trips).alias("busiest_trips"),
    )


def all_types(frames: Mapping[str, DataFrame]) -> DataFrame:
    """The categories of one layer as one frame, for measures taken per category."""
    return union_all(list(frames.values()))


def cast_losses(raw: DataFrame, taxi_type: str) -> DataFrame:
    """Canonical columns that lose values: present in the source, and NULL because their type cannot hold them.

    The rules count such a row as one with a bad amount; this tells the two apart.
    """
    kinds = {f.name: f.dataType.simpleString() for f in CANONICAL}
    lost = {
        name: F.expr(f"count_if(({value}) IS NOT NULL AND try_cast({value} AS {kinds[name]}) IS NULL)")
        for name, value in expressions(raw, taxi_type).items()
    }
    counts = in_utc(raw).agg(F.lit(taxi_type).alias("taxi_type"), *[count.alias(name + "_") for name, count in lost.items()])
    found = counts.unpivot(["taxi_type"], [name + "_" for name in lost], "column_name", "n_lost").where("n_lost > 0")
    return found.withColumn("column_name", F.expr("left(column_name, length(column_name) - 1)"))
