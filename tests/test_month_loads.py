"""Loads of single months against full runs: silver by file month, copies across files in any order, merged KPIs."""

import random
from dataclasses import replace
from itertools import permutations

import pytest

from tests.test_pipeline import FHV, METERED, clock, reloadable, shown
from triplake.config import Names, Settings
from triplake.operators import kpi
from triplake.plans import silver as layer
from triplake.plans import versions
from triplake.plans.pipeline import Pipeline


def settings(tmp_path, name, months):
    names = Names(*(f"{name}_{part}" for part in ("bronze", "silver", "gold")))
    return Settings(landing=str(tmp_path), year_months=tuple((2023, m) for m in months), names=names)


def silver_files(pipeline, taxi_type):
    stored = pipeline.spark.table(versions.current(pipeline.spark, pipeline.names.silver_table(taxi_type)))
    found = stored.selectExpr(f"{layer.SOURCE_MONTH} AS m", "input_file_name() AS f").distinct().collect()
    return {m: {r.f for r in found if r.m == m} for m in {r.m for r in found}}


def test_a_load_rewrites_silver_of_its_month_alone(spark, tmp_path):
    reloadable(spark, tmp_path)
    five = settings(tmp_path, "ms", range(1, 6))
    whole = Pipeline(spark, five)
    whole.run()
    before = {t: silver_files(whole, t) for t in ("yellow", "green", "hvfhv")}
    reloadable(spark, tmp_path, (3,), bump=5.0)
    march = Pipeline(spark, replace(five, year_months=((2023, 3),)))
    written = march.load()
    assert written[five.names.silver_table("yellow")] == 2 and written[five.names.silver_table("green")] == 1
    for taxi_type, old in before.items():
        new = silver_files(whole, taxi_type)
        assert {m: new[m] for m in new if m != 202303} == {m: old[m] for m in old if m != 202303}
        assert not new[202303] & old[202303]
    after = {t: shown(whole.silver(t)) for t in ("yellow", "green", "hvfhv", "fhv")}
    kpis = shown(whole.monthly()), shown(whole.hourly()), shown(whole.type_summary())
    # The whole aggregates, and a full run over the files as they are now.
    assert kpis == (shown(kpi.yellow_totals(whole.fact())), shown(kpi.hourly_passengers(whole.fact())), shown(kpi.type_summary(whole.fact())))
    whole.run()
    assert {t: shown(whole.silver(t)) for t in after} == after
    assert kpis == (shown(whole.monthly()), shown(whole.hourly()), shown(whole.type_summary()))


def test_kpis_do_not_read_the_fact(spark, tmp_path):
    reloadable(spark, tmp_path, (1, 2))
    pipeline = Pipeline(spark, settings(tmp_path, "ks", (1, 2)))
    pipeline.run()
    for report in (pipeline.type_summary(), pipeline.monthly(), pipeline.hourly()):
        assert not [f for f in report.inputFiles() if "fact_trips" in f]


def land_fhv(spark, folder, month, rows):
    path = f"{folder}/fhv/fhv_tripdata_2023-{month:02d}.parquet"
    spark.createDataFrame(rows, FHV.format(drop="dropOff_datetime")).coalesce(1).write.mode("overwrite").parquet(path)


def other_files(spark, folder, months):
    for m in months:
        for taxi_type, p in (("yellow", "tpep"), ("green", "lpep")):
            path = f"{folder}/{taxi_type}/{taxi_type}_tripdata_2023-{m:02d}.parquet"
            spark.createDataFrame([(1, *clock(m), 1.0, 2.0, 1, 2, 10.0, 1.0, 12.0)], METERED.format(id="int", p=p)).coalesce(1).write.mode("overwrite").parquet(path)


def drawn(rng, n):
    """fhv rows of few different contents, of three months of pickup, so that files share many of them."""
    return [(f"B{rng.randrange(3)}", *clock(rng.randrange(1, 4), rng.randrange(6, 9)), rng.choice([None, 7.0]), None) for _ in range(n)]


def brute(files):
    """(content, file) of the survivors: the first file that has a content keeps it."""
    first = {}
    for month in sorted(files):
        for row in files[month]:
            first.setdefault(row, month)
    return sorted((*map(str, row), f"fhv_tripdata_2023-{month:02d}.parquet") for row, month in first.items())


def survivors(pipeline):
    rows = pipeline.silver("fhv").select("provider_id", "pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id", "source_file").collect()
    return sorted((r[0], str(r[1]), str(r[2]), str(None if r[3] is None else float(r[3])), str(r[4]), r[5]) for r in rows)


@pytest.mark.parametrize("order", list(permutations((1, 2, 3)))[::2])
def test_copies_across_files_survive_as_in_a_full_run_in_any_order(spark, tmp_path, order):
    rng = random.Random("-".join(map(str, order)))
    files = {m: drawn(rng, 25) for m in order}
    for m, rows in files.items():
        land_fhv(spark, tmp_path, m, rows)
    name = "fo" + "".join(map(str, order))
    at = lambda *months: Pipeline(spark, settings(tmp_path, name, months))
    at(order[0]).ingest("fhv")
    at(order[0]).build_silver("fhv")
    for m in order[1:]:
        at(m).ingest("fhv")
        at(m).build_silver("fhv", months_only=True)
    assert survivors(at(1)) == brute(files)
    # A file that comes again with other rows gives back what it had hidden.
    again = order[0]
    files[again] = drawn(rng, 6)
    land_fhv(spark, tmp_path, again, files[again])
    at(again).ingest("fhv")
    at(again).build_silver("fhv", months_only=True)
    assert survivors(at(1)) == brute(files)
    # And one that has become empty.
    files[again] = []
    land_fhv(spark, tmp_path, again, [])
    at(again).ingest("fhv")
    at(again).build_silver("fhv", months_only=True)
    assert survivors(at(1)) == brute(files)


def test_a_load_of_fhv_leaves_months_of_pickup_that_it_does_not_touch(spark, tmp_path):
    name = "fp"
    at = lambda *months: Pipeline(spark, settings(tmp_path, name, months))
    for m in (1, 2, 3):
        land_fhv(spark, tmp_path, m, [("B1", *clock(m, h), None, None) for h in (8, 9)])
    at(1, 2, 3).ingest("fhv")
    at(1, 2, 3).build_silver("fhv")
    before = silver_files(at(1), "fhv")
    land_fhv(spark, tmp_path, 3, [("B1", *clock(3, 8), None, None), ("B1", *clock(2, 8), None, None)])
    at(3).ingest("fhv")
    assert at(3).build_silver("fhv", months_only=True) == 3
    after = silver_files(at(1), "fhv")
    assert after[202301] == before[202301] and after[202302] != before[202302]
    assert at(1).silver("fhv").count() == 5
