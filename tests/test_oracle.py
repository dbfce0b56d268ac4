"""Every registered query against its SQL oracle, and the golden counts of FIXTURES.md."""

import pytest

from __spark_entry__ import entry
from oracle.compare import connect, mismatch
from oracle.sql import all_sql
from tests.conftest import SF_DIR
from triplake.plans.registry import all_queries

QUERIES, ORACLES = all_queries(), all_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    assert mismatch(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) is None


def test_golden_row_counts(spark):
    expected = {"yellow": (6000, 3927), "green": (1500, 953), "hvfhv": (1000, 734), "fhv": (6000, 4942)}
    rows = QUERIES["reconciliation"](spark, SF_DIR).collect()
    assert {r.taxi_type: (r.bronze_rows, r.silver_rows) for r in rows} == expected


def test_golden_rows_removed_per_rule(spark):
    removed = {(r.taxi_type, r.rule): r.n_removed for r in QUERIES["removed_by_rule"](spark, SF_DIR).collect()}
    yellow = [6000, 5928, 5924, 5094, 4974, 4783, 3927]
    names = [
        "fare_amount_not_negative",
        "total_amount_not_negative",
        "pickup_in_period",
        "pickup_before_dropoff",
        "duration_plausible",
        "distance_plausible",
    ]
    assert [removed["yellow", n] for n in names] == [a - b for a, b in zip(yellow, yellow[1:])]
    assert removed["fhv", "not_a_duplicate"] == 5020 - 4942


def test_golden_flags_and_hash(spark):
    flags = QUERIES["financial_flags"](spark, SF_DIR).collect()
    marked = {}
    for r in flags:
        marked[r.taxi_type] = marked.get(r.taxi_type, 0) + (r.n_trips if r.financial_inconsistency_flag else 0)
    assert marked == {"yellow": 2298, "green": 236, "hvfhv": 60, "fhv": 0}
    hashes = QUERIES["record_hash"](spark, SF_DIR).where("taxi_type = 'yellow'")
    assert hashes.agg({"record_hash": "min"}).first()[0].startswith("002e6eed599fcc96")


def test_entry_is_the_monthly_kpi(spark):
    result = entry(spark)
    assert result.columns == ["pickup_year", "pickup_month", "avg_total_amount", "n_trips", "total_revenue"]
    rows = result.collect()
    assert len(rows) == 71
    assert tuple(rows[0]) == (1996, 1, 57464.11, 59, 3390382.37)


def test_audits_see_what_they_look_for(spark):
    """Over corrected records none of the audits may come out as zeros only."""
    rows = {name: QUERIES[name](spark, SF_DIR).collect() for name in QUERIES if name.endswith(("_reissued", "null_totals_before_rules"))}
    assert {r.taxi_type: r.n_null_totals > 0 for r in rows["null_totals_before_rules"]} == {"yellow": False, "green": False, "hvfhv": True}
    varying = {(r.taxi_type, r.column_name) for r in rows["varying_fields_reissued"] if r.n_varying}
    assert {("hvfhv", "base_passenger_fare"), ("fhv", "is_shared_ride"), ("yellow", "total_amount")} <= varying
    assert rows["fare_conflicts_reissued"] and {r.taxi_type for r in rows["fare_conflicts_reissued"]} == {"hvfhv"}
    assert any(r.n_conflicting for r in rows["ride_repeats_reissued"])
