"""The fact table: all categories together, comparable totals, date parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from triplake.schema import FACT, SILVER, require
from triplake.sources.ingest import union_all

# The parts of an hvfhv total. The order matters to the last bit of the sum.
TOTAL_PARTS = (
    "base_passenger_fare",
    "tip_amount",
    "tolls",
    "bcf",
    "sales_tax",
    "congestion_surcharge",
    "airport_fee",
)

# hvfhv reports no total: add its parts up, a missing part counting as nothing charged.
_SUM_OF_PARTS = " + ".join(f"coalesce({name}, 0D)" for name in TOTAL_PARTS)

DERIVED = {
    "total_amount": f"CASE WHEN taxi_type = 'hvfhv' THEN {_SUM_OF_PARTS} ELSE total_amount END",
    "pickup_date": "to_date(pickup_datetime)",
    "pickup_year": "year(pickup_datetime)",
    "pickup_month": "month(pickup_datetime)",
    "pickup_hour": "hour(pickup_datetime)",
}


def fact_trips(silver: Sequence[DataFrame]) -> DataFrame:
    """Union the silver frames (duplicates across them stay) and derive the fact columns."""
    checked = [require(df, SILVER, "a silver table").select(*SILVER.fieldNames()) for df in silver]
    columns = [f"{DERIVED[name]} AS {name}" if name in DERIVED else name for name in FACT.fieldNames()]
    return union_all(checked).selectExpr(*columns)
