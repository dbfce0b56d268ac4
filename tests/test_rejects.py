"""Rejected rows: silver and they are all rows, and their reasons are those that are counted."""

from collections import Counter

from tests.conftest import SF_DIR
from tests.rows import NOON, trip, trips
from triplake.config import TAXI_TYPES, Settings
from triplake.operators.dedup import one_per_content
from triplake.operators.rejects import rejected, removed_copies
from triplake.plans.registry import all_queries


def test_reasons_are_those_counted(spark):
    queries = all_queries()
    found = queries["rejected_rows"](spark, SF_DIR).groupBy("taxi_type", "rule").count().collect()
    counted = queries["removed_by_rule"](spark, SF_DIR).where("n_removed > 0").collect()
    assert {tuple(r) for r in found} == {(r.taxi_type, r.rule, r.n_removed) for r in counted}


def test_survivors_and_removed_copies_are_all_rows(spark):
    """One content on most rows, spread over many partitions, told apart by file and shared flag alone."""
    rows = [trip("fhv", source_file=f"{n % 7}.parquet", is_shared_ride=(None, True, False)[n % 3]) for n in range(200)]
    rows += [trip("fhv", provider_id=str(n % 20), source_file=f"{n}.parquet") for n in range(100)]
    for parts in (1, 16):
        df = trips(spark, *rows).repartition(parts)
        kept, gone = one_per_content(df).collect(), removed_copies(df).collect()
        assert Counter(kept) + Counter(gone) == Counter(df.collect()) and len(kept) == 20


def test_a_row_is_rejected_once_by_the_first_rule_it_fails(spark):
    bad = [trip(t, dropoff_datetime=None, pickup_datetime=None) for t in TAXI_TYPES]
    bad += [trip("yellow", fare_amount=-1.0, trip_distance=-1.0), trip("fhv", dropoff_datetime=NOON.replace(year=2024))]
    good = [trip(t) for t in TAXI_TYPES] + [trip("fhv")]
    all_rows = trips(spark, *bad, *good)
    out = rejected({t: all_rows.where(f"taxi_type = '{t}'") for t in TAXI_TYPES}, Settings())
    assert Counter((r.taxi_type, r.rule) for r in out.collect()) == Counter(
        [(t, "pickup_known") for t in TAXI_TYPES]
        + [("yellow", "fare_amount_not_negative"), ("fhv", "duration_plausible"), ("fhv", "not_a_duplicate")]
    )
    none = rejected({t: all_rows.where("false") for t in TAXI_TYPES}, Settings())
    assert none.count() == 0 and none.columns == [*all_rows.columns, "rule"]
