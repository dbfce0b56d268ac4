"""Thousands of random edge-value trips against the rules, keys and de-duplication written in plain Python."""

import hashlib
import math
import random
from datetime import datetime, timedelta

import pytest

from tests.rows import trip, trips
from triplake.config import Settings
from triplake.operators.dedup import one_per_content
from triplake.operators.rules import first_failed, keep_valid, rules_for
from triplake.plans.silver import instrumented

SETTINGS = Settings()
START, END = datetime(2023, 1, 1), datetime(2023, 6, 1)
PICKUPS = [None, START, START - timedelta(microseconds=1), END, END - timedelta(seconds=1), datetime(2023, 3, 12, 1, 30)]
RIDES = [None, -1, 0, 0.5, 1800, 86399.5, 86400, 86400.25, 86400.75, 86401, 200000]
AMOUNTS = [None, -1.0, 0.0, 2.5, 10.0, math.nan]
DISTANCES = [None, -0.5, 0.0, 2.5, 200.0, 200.5, math.nan]


def random_trip(rng, taxi_type, number):
    pickup = rng.choice(PICKUPS + [datetime(2023, 2, 3, 4, 5, 6, 700_000)] * 6)
    ride = rng.choice(RIDES + [1800] * 6)
    fields = {
        "pickup_datetime": pickup,
        "dropoff_datetime": None if ride is None else (pickup or START) + timedelta(seconds=ride),
        "provider_id": rng.choice([None, "null", "1", "2"]),
        "pickup_location_id": rng.choice([None, 1, 2]),
        "source_file": f"{number:06d}",
    }
    if taxi_type != "fhv":
        fields["trip_distance"] = rng.choice(DISTANCES + [2.5] * 6)
    if taxi_type == "hvfhv":
        fields["base_passenger_fare"] = rng.choice(AMOUNTS + [10.0] * 6)
    if taxi_type in ("yellow", "green"):
        fields["fare_amount"] = rng.choice(AMOUNTS + [10.0] * 6)
        fields["total_amount"] = rng.choice(AMOUNTS + [10.0] * 6)
    return trip(taxi_type, **fields)


def not_negative(x):
    return x is not None and (math.isnan(x) or x >= 0)


def expected_failure(row):
    kind, pickup, dropoff = row["taxi_type"], row["pickup_datetime"], row["dropoff_datetime"]
    money = {"hvfhv": ["base_passenger_fare"], "fhv": []}.get(kind, ["fare_amount", "total_amount"])
    for name in money:
        if not not_negative(row[name]):
            return f"{name}_not_negative"
    if pickup is None:
        return "pickup_known"
    if not START <= pickup < END:
        return "pickup_in_period"
    if dropoff is None or pickup > dropoff:
        return "pickup_before_dropoff"
    if dropoff.replace(microsecond=0) - pickup.replace(microsecond=0) > timedelta(days=1):
        return "duration_plausible"
    distance = row["trip_distance"]
    if kind != "fhv" and not (distance is not None and 0 <= distance <= 200):
        return "distance_plausible"
    return None


def as_text(value):
    if value is None:
        return "null"
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, datetime):
        whole, _, fraction = str(value).partition(".")
        return f"{whole}.{fraction.rstrip('0')}" if fraction else whole
    return str(value)


def record_hash(row):
    names = (
        "taxi_type pickup_datetime dropoff_datetime pickup_location_id dropoff_location_id provider_id"
        " trip_distance fare_amount"
    ).split()
    return hashlib.sha256("|".join(as_text(row[name]) for name in names).encode()).hexdigest()


@pytest.mark.parametrize("taxi_type", ["yellow", "hvfhv", "fhv"])
def test_random_trips(spark, taxi_type):
    rng = random.Random(42)
    rows = [random_trip(rng, taxi_type, number) for number in range(3000)]
    rng.shuffle(rows)
    df = trips(spark, *rows).repartition(4).cache()
    rules = rules_for(taxi_type, SETTINGS)

    failures = {r.source_file: r.rule for r in df.selectExpr("source_file", f"{first_failed(rules)} AS rule").collect()}
    assert failures == {row["source_file"]: expected_failure(row) for row in rows}

    valid = keep_valid(df, rules)
    good = [row for row in rows if expected_failure(row) is None]
    hashes = {r.source_file: r.record_hash for r in instrumented(valid, taxi_type).collect()}
    assert hashes == {row["source_file"]: record_hash(row) for row in good}

    survivors = {r.source_file for r in one_per_content(valid).select("source_file").collect()}
    first = {}
    for row in sorted(good, key=lambda row: row["source_file"]):
        first.setdefault(record_hash(row), row["source_file"])
    assert survivors == set(first.values()) and len(survivors) < len(good)
