from datetime import datetime, timedelta
from itertools import permutations

import pytest

from tests.rows import NOON, trip, trips
from triplake.config import Settings
from triplake.functions.columns import lasts_at_most, seconds_between
from triplake.operators.rules import first_failed, keep_valid, rules_for

SETTINGS = Settings()
NAN = float("nan")
DAY = timedelta(seconds=86400)


def after(start, **delta):
    return {"pickup_datetime": start, "dropoff_datetime": start + timedelta(**delta)}


CASES = [
    # (category, changed fields, rule that removes the row, None where it stays)
    ("yellow", {}, None),
    ("yellow", {"fare_amount": 0.0}, None),
    ("yellow", {"fare_amount": -0.01}, "fare_amount_not_negative"),
    ("yellow", {"fare_amount": None}, "fare_amount_not_negative"),
    ("yellow", {"fare_amount": NAN}, None),
    ("yellow", {"total_amount": -1.0}, "total_amount_not_negative"),
    ("green", {"total_amount": None}, "total_amount_not_negative"),
    ("yellow", {"passenger_count": 0}, None),
    ("yellow", {"pickup_datetime": None}, "pickup_known"),
    ("yellow", after(datetime(2023, 1, 1), hours=1), None),
    ("yellow", after(datetime(2022, 12, 31, 23, 59, 59), hours=1), "pickup_in_period"),
    ("yellow", after(datetime(2023, 5, 31, 23, 59, 59), hours=1), None),
    ("yellow", after(datetime(2023, 6, 1), hours=1), "pickup_in_period"),
    ("yellow", {"dropoff_datetime": None}, "pickup_before_dropoff"),
    ("yellow", {"dropoff_datetime": NOON}, None),
    ("yellow", {"dropoff_datetime": NOON - timedelta(seconds=1)}, "pickup_before_dropoff"),
    ("fhv", {"dropoff_datetime": datetime(1917, 1, 1)}, "pickup_before_dropoff"),
    ("hvfhv", {"dropoff_datetime": NOON + DAY}, None),
    ("hvfhv", {"dropoff_datetime": NOON + DAY + timedelta(seconds=1)}, "duration_plausible"),
    ("hvfhv", {"dropoff_datetime": NOON + DAY + timedelta(milliseconds=900)}, None),
    ("fhv", {"dropoff_datetime": NOON + 2 * DAY}, "duration_plausible"),
    ("yellow", {"trip_distance": 0.0}, None),
    ("yellow", {"trip_distance": 200.0}, None),
    ("yellow", {"trip_distance": 200.01}, "distance_plausible"),
    ("yellow", {"trip_distance": -0.01}, "distance_plausible"),
    ("yellow", {"trip_distance": NAN}, "distance_plausible"),
    ("hvfhv", {"trip_distance": None}, "distance_plausible"),
    ("fhv", {"trip_distance": None}, None),
    ("hvfhv", {"base_passenger_fare": -1.0}, "base_passenger_fare_not_negative"),
    ("hvfhv", {"base_passenger_fare": None}, "base_passenger_fare_not_negative"),
    ("yellow", {"fare_amount": -1.0, "trip_distance": 999.0}, "fare_amount_not_negative"),
]


@pytest.mark.parametrize("taxi_type", ["yellow", "green", "hvfhv", "fhv"])
def test_rules_keep_and_attribute(spark, taxi_type):
    cases = [(fields, rule) for kind, fields, rule in CASES if kind == taxi_type]
    df = trips(spark, *[trip(taxi_type, **fields, source_file=str(i)) for i, (fields, _) in enumerate(cases)])
    rules = rules_for(taxi_type, SETTINGS)
    attributed = df.selectExpr("int(source_file) AS i", f"{first_failed(rules)} AS rule")
    failed = {r.i: r.rule for r in attributed.collect()}
    assert failed == {i: rule for i, (_, rule) in enumerate(cases)}
    kept = {int(r.source_file) for r in keep_valid(df, rules).collect()}
    assert kept == {i for i, (_, rule) in enumerate(cases) if rule is None}


def test_order_of_rules_does_not_change_what_is_kept(spark):
    fields = [f for kind, f, _ in CASES if kind == "yellow"]
    df = trips(spark, *[trip("yellow", **f, source_file=str(i)) for i, f in enumerate(fields)]).cache()
    rules = rules_for("yellow", SETTINGS)
    expected = {r.source_file for r in keep_valid(df, rules).collect()}
    for order in list(permutations(rules))[:: 720]:
        assert {r.source_file for r in keep_valid(df, order).collect()} == expected


@pytest.mark.parametrize("name", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_duration_is_zone_free_and_in_whole_seconds(spark, zone, name):
    zone(name)
    fractions = [0, 1, 400_000, 999_999]
    start = datetime(2023, 3, 12, 1, 30)
    pairs = [
        (start + timedelta(microseconds=a), start + timedelta(seconds=s, microseconds=b))
        for a in fractions
        for b in fractions
        for s in (-1, 0, 7199, 7200, 7201)
    ]
    pairs += [(datetime(1969, 12, 31, 23, 59, 59, 500_000), datetime(1970, 1, 1, 0, 0, 1))]
    df = spark.createDataFrame(pairs, "p timestamp_ntz, d timestamp_ntz")

    def whole(ts):
        return (ts - datetime(1970, 1, 1)) // timedelta(seconds=1)

    measured = df.selectExpr("*", f"{seconds_between('p', 'd')} AS s", f"{lasts_at_most('p', 'd', 7200)} AS ok")
    for r in measured.collect():
        assert r.s == whole(r.d) - whole(r.p)
        assert r.ok == (r.s <= 7200)
