import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.rows import trip, trips
from triplake.functions.keys import content_identity
from triplake.operators.dedup import one_per_content
from triplake.plans.silver import instrumented


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_keys_hash_the_agreed_text(spark):
    row = instrumented(trips(spark, trip("yellow")), "yellow").first()
    assert row.record_hash == sha("yellow|2023-03-10 12:00:00|2023-03-10 12:30:00|10|20|1|2.5|10.0")
    assert row.ride_key == sha("yellow|1|2023-03-10 12:00:00|2023-03-10 12:30:00|10|20")


def test_keys_write_null_as_text(spark):
    empty = trip("fhv", provider_id=None, pickup_location_id=None, dropoff_location_id=None)
    row = instrumented(trips(spark, empty), "fhv").first()
    assert row.record_hash == sha("fhv|2023-03-10 12:00:00|2023-03-10 12:30:00|null|null|null|null|null")
    assert row.ride_key == sha("fhv|null|2023-03-10 12:00:00|2023-03-10 12:30:00|null|null")


def test_keys_do_not_depend_on_the_session_zone(spark, zone):
    gap = datetime(2023, 3, 12, 2, 30)
    df = trips(spark, trip("yellow", pickup_datetime=gap))
    utc = instrumented(df, "yellow").first()
    zone("America/New_York")
    assert instrumented(df, "yellow").first().record_hash == utc.record_hash


def test_distance_and_fare_change_the_record_but_not_the_ride(spark):
    df = trips(spark, trip("yellow"), trip("yellow", trip_distance=2.6), trip("yellow", fare_amount=11.0))
    rows = instrumented(df, "yellow").collect()
    assert len({r.record_hash for r in rows}) == 3
    assert len({r.ride_key for r in rows}) == 1


@pytest.mark.parametrize(
    "taxi_type, fields, inconsistent, free",
    [
        ("yellow", {}, False, False),
        ("yellow", {"tip_amount": -1.0}, True, False),
        ("yellow", {"total_amount": 9.0}, True, False),
        ("green", {"tip_amount": None}, None, False),
        ("green", {"tip_amount": None, "total_amount": 9.0}, True, False),
        ("green", {"fare_amount": 0.0, "total_amount": 0.0}, False, True),
        ("yellow", {"fare_amount": 0.0, "total_amount": 3.0}, False, False),
        ("yellow", {"fare_amount": -0.0, "total_amount": 0.0, "trip_distance": 0.0}, False, False),
        ("hvfhv", {}, False, False),
        ("hvfhv", {"tip_amount": None}, None, False),
        ("hvfhv", {"tip_amount": None, "base_passenger_fare": 0.0}, None, None),
        ("hvfhv", {"tip_amount": 0.0, "base_passenger_fare": 0.0}, False, True),
        ("fhv", {}, False, False),
    ],
)
def test_flags_are_three_valued(spark, taxi_type, fields, inconsistent, free):
    row = instrumented(trips(spark, trip(taxi_type, **fields)), taxi_type).first()
    assert row.financial_inconsistency_flag is inconsistent
    assert row.zero_fare_with_distance_flag is free


def copies(spark):
    """Four records; two come in copies that differ only outside the fingerprint."""
    return trips(
        spark,
        *[trip("fhv", source_file=f"{name}.parquet") for name in "cab"],
        trip("fhv", source_file="a.parquet", is_shared_ride=True),
        trip("fhv", source_file="a.parquet", ingested_at=datetime(2023, 12, 31), is_shared_ride=False),
        trip("fhv", provider_id=None, source_file="z.parquet"),
        trip("fhv", provider_id="null", source_file="y.parquet"),
        trip("fhv", pickup_location_id=None),
        trip("fhv", dropoff_location_id=None),
    )


def test_dedup_keeps_the_same_row_whatever_the_partitions(spark):
    expected = None
    for parts in (1, 2, 5):
        rows = sorted(map(str, one_per_content(copies(spark).repartition(parts)).collect()))
        expected = expected or rows
        assert rows == expected
    copied = "provider_id = '1' AND pickup_location_id = 10 AND dropoff_location_id = 20"
    row = one_per_content(copies(spark)).where(copied).first()
    assert (row.source_file, row.ingested_at, row.is_shared_ride) == ("a.parquet", datetime(2023, 12, 31), False)
    # A missing provider and one called "null" have the same fingerprint.
    assert one_per_content(copies(spark)).where("source_file IN ('y.parquet', 'z.parquet')").count() == 1


def test_identity_falls_together_with_the_hash(spark):
    distances, fares = (0.0, -0.0, None), (0.0, float("nan"), None)
    zeros = [trip("yellow", trip_distance=d, fare_amount=f) for d in distances for f in fares]
    df = instrumented(trips(spark, *zeros, *zeros), "yellow")
    by_fields = df.groupBy(*map(F.expr, content_identity())).agg(F.count_distinct("record_hash").alias("n"))
    assert [r.n for r in by_fields.select("n").collect()] == [1] * 9
    assert one_per_content(df).count() == df.select("record_hash").distinct().count() == 9


def test_a_hot_content_is_cut_before_the_shuffle(spark):
    """Half of all rows are one record, yet at most one row of it per task is shuffled."""
    others = spark.range(2000).selectExpr("id AS n")
    df = trips(spark, trip("fhv")).crossJoin(others.repartition(8)).selectExpr(
        "*", "if(n % 2 = 0, 'same', string(n)) AS base"
    )
    df = df.drop("provider_id", "n").withColumnRenamed("base", "provider_id")
    result = one_per_content(df)
    assert result.count() == 1001
    plan = result._jdf.queryExecution().executedPlan().toString()
    last_exchange = plan.rindex("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[last_exchange:] and "Partial" in plan[last_exchange:]
