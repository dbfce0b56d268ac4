"""Plausibility rules: what a canonical row must satisfy to enter the silver layer."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from triplake.config import Settings
from triplake.functions.columns import lasts_at_most

# Amounts that cannot be negative, in the order in which they are checked.
_MONEY = {
    "yellow": ("fare_amount", "total_amount"),
    "green": ("fare_amount", "total_amount"),
    "hvfhv": ("base_passenger_fare",),
    "fhv": (),
}
_WITHOUT_DISTANCE = ("fhv",)


@dataclass(frozen=True)
class Rule:
    """A named condition. A row is kept when it is true; false and NULL remove the row."""

    name: str
    holds: str


def rules_for(taxi_type: str, settings: Settings) -> list[Rule]:
    """The rules of a category, in the order in which a removal is attributed to one."""
    start, end = (f"TIMESTAMP_NTZ '{bound}'" for bound in (settings.period_start, settings.period_end))
    rules = [Rule(f"{name}_not_negative", f"{name} >= 0") for name in _MONEY[taxi_type]]
    rules += [
        Rule("pickup_known", "pickup_datetime IS NOT NULL"),
        Rule("pickup_in_period", f"pickup_datetime >= {start} AND pickup_datetime < {end}"),
        Rule("pickup_before_dropoff", "pickup_datetime <= dropoff_datetime"),
        Rule(
            "duration_plausible",
            lasts_at_most("pickup_datetime", "dropoff_datetime", settings.max_duration_seconds),
        ),
    ]
    if taxi_type not in _WITHOUT_DISTANCE:
        rules.append(Rule("distance_plausible", f"trip_distance BETWEEN 0 AND {settings.max_distance}"))
    return rules


def keep_valid(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.where(" AND ".join(f"({rule.holds})" for rule in rules))


def first_failed(rules: Sequence[Rule]) -> str:
    """Name of the first rule a row fails, NULL for a row that passes all."""
    cases = [f"WHEN NOT coalesce({rule.holds}, false) THEN '{rule.name}'" for rule in rules]
    return f"CASE {' '.join(cases)} END"
