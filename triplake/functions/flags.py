"""Observability flags. They mark rows and never remove any; NULL means unknown."""

from __future__ import annotations

FLAGS = ("financial_inconsistency_flag", "zero_fare_with_distance_flag")

NEGATIVE_TIP = "tip_amount < 0"
TOTAL_BELOW_FARE = "total_amount < fare_amount"

_METERED = (
    f"{NEGATIVE_TIP} OR {TOTAL_BELOW_FARE}",
    "trip_distance > 0 AND fare_amount = 0 AND total_amount = 0",
)
_CONDITIONS = {
    "yellow": _METERED,
    "green": _METERED,
    "hvfhv": (NEGATIVE_TIP, "trip_distance > 0 AND base_passenger_fare = 0 AND tip_amount = 0"),
    # fhv reports no money at all.
    "fhv": ("false", "false"),
}


def flag_expressions(taxi_type: str) -> dict[str, str]:
    return dict(zip(FLAGS, _CONDITIONS[taxi_type]))
