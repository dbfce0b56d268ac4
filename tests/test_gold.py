from datetime import datetime

import pytest

from tests.rows import trip, trips
from triplake.config import Settings
from triplake.operators import audit, kpi, quality
from triplake.operators.fact import fact_trips
from triplake.plans.silver import instrumented
from triplake.schema import FACT, differences


def silver(spark, taxi_type, *rows):
    return instrumented(trips(spark, *rows), taxi_type)


def at(year, month, day=1, hour=0):
    return {
        "pickup_datetime": datetime(year, month, day, hour),
        "dropoff_datetime": datetime(year, month, day, hour, 30),
    }


def test_fact_rebuilds_only_hvfhv_totals(spark):
    nothing = dict.fromkeys(("base_passenger_fare", "tip_amount", "tolls", "bcf"))
    parts = {"sales_tax": None, "congestion_surcharge": 2.75, "airport_fee": None, "tip_amount": None}
    fact = fact_trips(
        [
            silver(spark, "yellow", trip("yellow"), trip("yellow")),
            silver(spark, "green", trip("green", total_amount=3.0)),
            silver(spark, "hvfhv", trip("hvfhv", **parts), trip("hvfhv", **nothing)),
            silver(spark, "fhv", trip("fhv")),
        ]
    )
    assert not differences(fact.schema, FACT) and fact.columns == FACT.fieldNames()
    rows = fact.collect()
    totals = [(r.taxi_type, r.total_amount) for r in rows]
    kept = [("yellow", 12.0), ("yellow", 12.0), ("green", 3.0)]
    assert totals == kept + [("hvfhv", 10.0 + 0.5 + 0.25 + 2.75), ("hvfhv", 0.0), ("fhv", None)]
    first = rows[0]
    assert str(first.pickup_date) == "2023-03-10"
    assert (first.pickup_year, first.pickup_month, first.pickup_hour) == (2023, 3, 12)


def test_fact_refuses_a_widened_clock(spark):
    zoned = "timestamp(pickup_datetime) AS pickup_datetime"
    wrong = silver(spark, "yellow", trip()).selectExpr("* EXCEPT (pickup_datetime)", zoned)
    with pytest.raises(TypeError, match="pickup_datetime"):
        fact_trips([silver(spark, "green", trip("green")), wrong])


@pytest.fixture
def fact(spark):
    rows = [
        trip("yellow", **at(2022, 5, hour=3), total_amount=10.0, passenger_count=1),
        trip("yellow", **at(2023, 5, hour=3), total_amount=20.0, passenger_count=2),
        trip("yellow", **at(2023, 5, hour=4), total_amount=25.0, passenger_count=0),
        trip("yellow", **at(2023, 4, hour=3), total_amount=30.0, passenger_count=6),
    ]
    green = [trip("green", **at(2023, 5, hour=4), passenger_count=n) for n in (None, 5)]
    hvfhv = [trip("hvfhv", **at(2023, 5))]
    return fact_trips([silver(spark, t, *some) for t, some in (("yellow", rows), ("green", green), ("hvfhv", hvfhv))])


def values(df):
    return [tuple(r) for r in df.collect()]


def test_monthly_kpi_keeps_years_apart_and_month_only_merges_them(fact):
    apart = [(2022, 5, 10.0, 1, 10.0), (2023, 4, 30.0, 1, 30.0), (2023, 5, 22.5, 2, 45.0)]
    assert values(kpi.yellow_totals(fact)) == apart
    merged = [(4, 30.0, 1, 30.0), (5, 18.33, 3, 55.0)]
    assert values(kpi.yellow_totals(fact, kpi.MONTH)) == merged
    view = kpi.consumption_view(fact)
    assert values(kpi.yellow_totals(view, kpi.MONTH)) == merged
    assert values(kpi.yellow_totals(view, kpi.MONTH, average_only=True)) == [(4, 30.0), (5, 18.33)]


def test_hourly_kpi_counts_known_passengers_only(fact):
    assert values(kpi.hourly_passengers(fact)) == [(3, 1.5, 2), (4, 5.0, 1)]
    assert values(kpi.hourly_passengers(kpi.consumption_view(fact))) == [(3, 1.5, 2), (4, 5.0, 1)]
    assert values(kpi.contributors(fact)) == [("green", 1), ("yellow", 2)]
    assert values(kpi.hours_present(kpi.hourly_passengers(fact))) == [(2,)]


def test_quality_reports_find_what_is_wrong(spark, fact):
    bad = [trip("yellow", fare_amount=-1.0), trip("yellow", trip_distance=500.0, fare_amount=None), trip("yellow")]
    twice = [trip("fhv"), trip("fhv"), trip("fhv", provider_id="9")]
    tables = {"yellow": silver(spark, "yellow", *bad), "fhv": silver(spark, "fhv", *twice)}
    report = quality.violations(tables, Settings())
    found = {(r.taxi_type, r.check_name): r.n_violations for r in report.collect() if r.n_violations}
    assert found == {
        ("yellow", "fare_amount_not_negative"): 1,
        ("yellow", "distance_plausible"): 1,
        ("fhv", "record_hash_unique"): 1,
    }
    assert sorted(values(quality.null_totals(fact))) == [("green", 0), ("hvfhv", 0), ("yellow", 0)]
    assert values(quality.month_coverage(kpi.yellow_totals(fact), Settings())) == [(3, 5, False)]


def test_audit_of_equal_hashes_and_equal_rides(spark):
    same = [trip("yellow", tip_amount=t, passenger_count=p) for t, p in ((1.0, 1), (2.0, 1), (2.0, None))]
    alone = trip("yellow", provider_id="7", tip_amount=9.0)
    rows = audit.varying_fields(silver(spark, "yellow", *same, alone)).collect()
    assert {r.column_name: r.n_varying for r in rows if r.n_varying} == {"tip_amount": 1, "passenger_count": 1}
    assert {r.n_groups for r in rows} == {1}
    fares = [trip("hvfhv", base_passenger_fare=f) for f in (10.0, 12.5, None)]
    fares += [trip("hvfhv", provider_id="x")] * 2
    assert values(audit.ride_repeats(silver(spark, "hvfhv", *fares))) == [("hvfhv", 2, 2, 1)]
    (conflict,) = audit.fare_conflicts(silver(spark, "hvfhv", *fares)).collect()
    assert (conflict.n_rows, conflict.lowest_fare, conflict.highest_fare) == (3, 10.0, 12.5)


def test_audit_percentile_is_exact(spark):
    ends = [datetime(2023, 3, 10, 12, 0, s) for s in range(60)]
    df = silver(spark, "fhv", *[trip("fhv", dropoff_datetime=e, provider_id=str(i)) for i, e in enumerate(ends)])
    (row,) = audit.duration_p99(df).collect()
    assert row.p99_seconds == pytest.approx(58.41) and row.max_seconds == 59


def test_month_over_month_and_extremes(fact):
    change = values(audit.month_over_month(kpi.yellow_totals(fact)))
    assert change == [(2022, 5, 10.0, None, 0.0), (2023, 4, 30.0, 200.0, 200.0), (2023, 5, 22.5, -25.0, 125.0)]
    (row,) = audit.hour_extremes(kpi.hourly_passengers(fact)).collect()
    assert tuple(row) == (3, 1.5, 4, 5.0, 3, 2)


def test_published_growth_is_reproduced(spark):
    # The published monthly averages, and the growth published for them.
    published = [(2023, m, avg) for m, avg in enumerate((27.44, 27.33, 28.26, 28.76, 29.46), 1)]
    kpi_rows = spark.createDataFrame(published, "pickup_year int, pickup_month int, avg_total_amount double")
    assert values(audit.month_over_month(kpi_rows))[-1][4] == 7.4
