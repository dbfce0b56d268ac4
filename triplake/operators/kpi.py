"""KPI tables, summaries and the consumption views over the fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplake.config import HOURLY_KPI_MONTH

# The column names the consumption view promises to its users.
VIEW_COLUMNS = {
    "taxi_type": "taxi_type",
    "provider_id": "VendorID",
    "passenger_count": "passenger_count",
    "total_amount": "total_amount",
    "pickup_datetime": "tpep_pickup_datetime",
    "dropoff_datetime": "tpep_dropoff_datetime",
}
# The view alone hides the partition column; with it, a month filter skips directories.
PERIOD_COLUMNS = ("pickup_year", "pickup_month", "pickup_hour")

YEAR = {"pickup_year": F.year}
MONTH = {"pickup_month": F.month}
HOUR = {"pickup_hour": F.hour}


def _n_trips() -> Column:
    return F.count(F.lit(1)).alias("n_trips")


def _average(name: str, digits: int) -> Column:
    return F.round(F.avg(name), digits).alias(f"avg_{name}")


def _period_keys(trips: DataFrame, parts: dict) -> list[Column]:
    """Date parts as grouping keys: stored ones where the frame has them, else from the view's clock."""
    return [
        (F.col(name) if name in trips.columns else part(F.col("tpep_pickup_datetime"))).alias(name)
        for name, part in parts.items()
    ]


def _by_period(trips: DataFrame, parts: dict, measures: list[Column], ordered: bool) -> DataFrame:
    totals = trips.groupBy(*_period_keys(trips, parts)).agg(*measures)
    return totals.orderBy(*parts) if ordered else totals


def yellow_totals(
    trips: DataFrame, parts: dict = YEAR | MONTH, average_only: bool = False, ordered: bool = True
) -> DataFrame:
    """Average, number and sum of yellow totals per period, over the fact table or a view of it.

    Grouping by MONTH alone merges the same month of different years.
    """
    measures = [_average("total_amount", 2)]
    if not average_only:
        measures += [_n_trips(), F.round(F.sum("total_amount"), 2).alias("total_revenue")]
    return _by_period(trips.where(F.col("taxi_type") == "yellow"), parts, measures, ordered)


def with_passengers(trips: DataFrame, month: int = HOURLY_KPI_MONTH) -> DataFrame:
    """Trips of the month that say how many rode. Sources without the count drop out by themselves."""
    in_month = _period_keys(trips, MONTH)[0] == month
    return trips.where(in_month & (F.col("passenger_count") > 0))


def hourly_passengers(
    trips: DataFrame, month: int = HOURLY_KPI_MONTH, average_only: bool = False, ordered: bool = True
) -> DataFrame:
    """Average passengers and number of trips per hour of day, over the fact table or a view of it."""
    measures = [_average("passenger_count", 4)] + ([] if average_only else [_n_trips()])
    return _by_period(with_passengers(trips, month), HOUR, measures, ordered)


def monthly_preview(kpi: DataFrame) -> DataFrame:
    return kpi.select("pickup_month", "avg_total_amount", "n_trips", "total_revenue")


def contributors(fact: DataFrame, month: int = HOURLY_KPI_MONTH) -> DataFrame:
    """How many trips of each category the hourly KPI rests on."""
    return trips_per_type(with_passengers(fact, month))


def hours_present(hourly: DataFrame) -> DataFrame:
    return hourly.agg(F.count_distinct("pickup_hour").alias("hours_present"))


def type_summary(fact: DataFrame) -> DataFrame:
    measures = [_n_trips(), _average("total_amount", 2), F.count("total_amount").alias("with_total_amount")]
    return fact.groupBy("taxi_type").agg(*measures).orderBy("taxi_type")


def trips_per_type(trips: DataFrame) -> DataFrame:
    return trips.groupBy("taxi_type").agg(_n_trips()).orderBy("taxi_type")


def consumption_view(fact: DataFrame, extended: bool = False) -> DataFrame:
    columns = [F.col(own).alias(public) for own, public in VIEW_COLUMNS.items()]
    return fact.select(*columns, *(PERIOD_COLUMNS if extended else ()))


def view_sql(view: str, fact_table: str, extended: bool = False) -> str:
    columns = [f"{own} AS {public}" for own, public in VIEW_COLUMNS.items()]
    columns += PERIOD_COLUMNS if extended else ()
    return f"CREATE OR REPLACE VIEW {view} AS SELECT {', '.join(columns)} FROM {fact_table}"


# Mergeable states: sums and counts that add up over any division of the trips into parts. Amounts are added up as decimals,
# whose sum doesn't depend on the order of the parts, unlike that of doubles. An amount without a decimal (not a number, or
# beyond 32 digits) is added apart.
EXACT = "decimal(38,6)"

STATE_KEYS = ("taxi_type", "pickup_year", "pickup_month", "pickup_hour")


def partial_states(trips: DataFrame) -> DataFrame:
    """What the KPIs and the summary need of the trips, per category, month and hour of day."""
    riding = F.when(F.col("passenger_count") > 0, F.col("passenger_count"))
    exact = F.col("total_amount").try_cast(EXACT)
    return trips.groupBy(*STATE_KEYS).agg(
        _n_trips(),
        F.sum(exact).alias("sum_total_amount"),
        F.sum(F.when(exact.isNull(), F.col("total_amount"))).alias("odd_total_amount"),
        F.count("total_amount").alias("n_total_amount"),
        F.sum(riding).alias("sum_passenger_count"),
        F.count(riding).alias("n_passenger_count"),
    )


def _merged_total(per: Column | None = None, digits: int = 2) -> Column:
    """The rounded sum of the totals, or the sum divided by `per`; NULL where no part has a total.

    A decimal is rounded before it becomes a double, so that halves of a cent are those of the amounts.
    """
    exact, odd = F.sum("sum_total_amount"), F.sum("odd_total_amount")
    share = lambda total: total if per is None else total / F.nullif(per, F.lit(0))
    inexact = F.round(share(F.coalesce(exact.cast("double"), F.lit(0.0)) + odd), digits)
    return F.when(odd.isNull(), F.round(share(exact), digits).cast("double")).otherwise(inexact)


def _merged_average() -> Column:
    return _merged_total(F.sum("n_total_amount")).alias("avg_total_amount")


def merged_totals(states: DataFrame) -> DataFrame:
    """yellow_totals() from partial states."""
    yellow = states.where(F.col("taxi_type") == "yellow").groupBy("pickup_year", "pickup_month")
    return yellow.agg(_merged_average(), F.sum("n_trips").alias("n_trips"), _merged_total().alias("total_revenue"))


def merged_hourly(states: DataFrame, month: int = HOURLY_KPI_MONTH) -> DataFrame:
    """hourly_passengers() from partial states."""
    riding = states.where((F.col("pickup_month") == month) & (F.col("n_passenger_count") > 0))
    passengers = F.round(F.sum("sum_passenger_count") / F.sum("n_passenger_count"), 4).alias("avg_passenger_count")
    return riding.groupBy("pickup_hour").agg(passengers, F.sum("n_passenger_count").alias("n_trips"))


def merged_summary(states: DataFrame) -> DataFrame:
    """type_summary() from partial states."""
    measures = [F.sum("n_trips").alias("n_trips"), _merged_average(), F.sum("n_total_amount").alias("with_total_amount")]
    return states.groupBy("taxi_type").agg(*measures).orderBy("taxi_type")
