"""Settings of the pipeline: period, thresholds, file layout and table names."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

# The four trip categories, in publication order.
TAXI_TYPES = ("yellow", "green", "hvfhv", "fhv")

# File name prefix of each category.
FILE_PREFIXES = {
    "yellow": "yellow_tripdata",
    "green": "green_tripdata",
    "hvfhv": "fhvhv_tripdata",
    "fhv": "fhv_tripdata",
}

# The period, the thresholds and the month of the hourly KPI.
PERIOD_START = datetime(2023, 1, 1)
PERIOD_END = datetime(2023, 6, 1)
MAX_TRIP_DISTANCE = 200
MAX_DURATION_SECONDS = 86400
HOURLY_KPI_MONTH = 5

# Column names of the stored KPI tables that differ from ours.
STORED_KPI_NAMES = {"n_trips": "n_corridas", "total_revenue": "total_receita"}

# Artefacts of earlier versions that the clean-up removes.
RETIRED = ("fact_trip", "vw_fact_trip")
RETIRED_OPTIONAL = (
    "avg_passengers_by_hour_may",
    "avg_total_amount_by_month",
    "market_share_may",
    "revenue_by_hour_may",
    "weekday_vs_weekend_may",
)


@dataclass(frozen=True)
class Names:
    """Databases, tables and views that users query by name."""

    bronze: str = "case_bronze"
    silver: str = "case_silver"
    gold: str = "case_gold"
    fact: str = "fact_trips"
    kpi_monthly: str = "kpi_monthly_total_amount"
    kpi_hourly: str = "kpi_hourly_passenger_count"
    view: str = "vw_taxi_consumo"
    extended_view: str = "vw_trips_by_period"
    kpi_states: str = "kpi_partial_states"

    def bronze_table(self, taxi_type: str) -> str:
        return f"{self.bronze}.{taxi_type}_taxi"

    def silver_table(self, taxi_type: str) -> str:
        return f"{self.silver}.{taxi_type}_taxi"

    def gold_table(self, name: str) -> str:
        return f"{self.gold}.{name}"


@dataclass(frozen=True)
class Settings:
    """Everything a run can vary. Defaults give the published January-May 2023 run."""

    landing: str = "raw_files"
    year_months: tuple[tuple[int, int], ...] = tuple((2023, m) for m in range(1, 6))
    period_start: datetime = PERIOD_START
    period_end: datetime = PERIOD_END
    max_distance: float = MAX_TRIP_DISTANCE
    max_duration_seconds: int = MAX_DURATION_SECONDS
    hourly_month: int = HOURLY_KPI_MONTH
    table_format: str = "parquet"
    names: Names = field(default_factory=Names)

    @property
    def months_in_period(self) -> int:
        """Calendar months the half-open period touches."""
        start, end = self.period_start, self.period_end
        whole = (end.year - start.year) * 12 + end.month - start.month
        ends_at_month_start = end == datetime(end.year, end.month, 1)
        return whole if ends_at_month_start else whole + 1
