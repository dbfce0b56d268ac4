"""Files to views through the catalog, with drifting months and a second run."""

from dataclasses import replace
from datetime import datetime

import pytest

from triplake.config import TAXI_TYPES, Names, Settings
from triplake.operators import kpi
from triplake.plans import catalog
from triplake.plans.pipeline import Pipeline
from triplake.schema import FACT, SILVER, differences

METERED = (
    "VendorID {id}, {p}_pickup_datetime timestamp_ntz, {p}_dropoff_datetime timestamp_ntz, passenger_count double,"
    " trip_distance double, PULocationID int, DOLocationID int, fare_amount double, tip_amount double,"
    " total_amount double"
)
HVFHV = (
    "hvfhs_license_num string, dispatching_base_num string, pickup_datetime timestamp_ntz,"
    " dropoff_datetime timestamp_ntz, PULocationID int, DOLocationID int, trip_miles double, base_passenger_fare double, tips double, tolls double,"
    " bcf double, sales_tax double, shared_match_flag string"
)
FHV = (
    "dispatching_base_num string, pickup_datetime timestamp_ntz, {drop} timestamp_ntz, PUlocationID double,"
    " DOlocationID double"
)
NAMES = Names(bronze="t_bronze", silver="t_silver", gold="t_gold")


def clock(month, hour=8):
    return datetime(2023, month, 2, hour), datetime(2023, month, 2, hour, 20)


def land(spark, folder):
    files = {
        ("yellow", 4): (
            METERED.format(id="int", p="tpep"),
            [(1, *clock(4), 1.0, 2.0, 1, 2, fare, 1.0, 12.0) for fare in (10.0, -3.0)],
        ),
        ("yellow", 5): (
            METERED.format(id="bigint", p="tpep"),
            [(2, *clock(5), 3.0, 2.0, 1, 2, 10.0, 1.0, 14.0), (2, *clock(1), 0.0, 2.0, 1, 2, 10.0, 1.0, 16.0)],
        ),
        ("green", 4): (METERED.format(id="int", p="lpep"), [(1, *clock(4), 1.0, 2.0, 1, 2, 10.0, 1.0, 12.0)]),
        ("green", 5): (METERED.format(id="int", p="lpep"), [(1, *clock(5), 2.0, 2.0, 1, 2, 10.0, 1.0, 12.0)]),
        ("hvfhv", 4): (HVFHV, [("HV1", "B1", *clock(4), 1, 2, 3.0, 10.0, 1.0, 0.5, 0.25, None, "Y")]),
        ("hvfhv", 5): (HVFHV, [("HV2", "B1", *clock(5), 1, 2, 3.0, 20.0, 1.0, 0.5, 0.25, 1.0, "N")]),
        ("fhv", 4): (FHV.format(drop="dropOff_datetime"), [("B1", *clock(4), None, None)] * 2),
        ("fhv", 5): (FHV.format(drop="dropoff_datetime"), [("B2", *clock(5), 7.0, None)]),
    }
    prefix = {"yellow": "yellow", "green": "green", "hvfhv": "fhvhv", "fhv": "fhv"}
    for (taxi_type, month), (ddl, rows) in files.items():
        path = f"{folder}/{taxi_type}/{prefix[taxi_type]}_tripdata_2023-{month:02d}.parquet"
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(path)


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("landing")
    land(spark, folder)
    pipeline = Pipeline(spark, Settings(landing=str(folder), year_months=((2023, 4), (2023, 5)), names=NAMES))
    return pipeline, pipeline.run()


def test_rows_written_are_those_stored(done):
    pipeline, written = done
    stored = {name: pipeline.spark.table(name).count() for name in written}
    assert written == stored
    assert written["t_bronze.yellow_taxi"] == 4 and written["t_silver.yellow_taxi"] == 3
    assert written["t_silver.fhv_taxi"] == 2 and written["t_gold.fact_trips"] == 9
    assert {r.table_name: r.n_rows for r in pipeline.gold_counts().collect()} == {
        "fact_trips": 9, "kpi_monthly_total_amount": 3, "kpi_hourly_passenger_count": 1,
    }


def test_bronze_keeps_source_columns_and_is_partitioned(done):
    pipeline, _ = done
    bronze = pipeline.bronze("yellow")
    assert bronze.columns[-2:] == ["_partition_year", "_partition_month"]
    assert bronze.schema["VendorID"].dataType.simpleString() == "bigint"
    assert {(r.source_file, r._partition_month) for r in bronze.collect()} == {
        ("yellow_tripdata_2023-04.parquet", 4), ("yellow_tripdata_2023-05.parquet", 5),
    }
    assert "dropOff_datetime" in pipeline.bronze("fhv").columns


def test_stored_tables_have_the_agreed_schemas(done):
    pipeline, _ = done
    for taxi_type in TAXI_TYPES:
        assert not differences(pipeline.silver(taxi_type).schema, SILVER)
    assert not differences(pipeline.fact().schema, FACT)
    report = pipeline.conformance()
    assert report.count() == 100 and report.where("NOT conforms").count() == 0


def test_kpi_tables_and_their_stored_names(done):
    pipeline, _ = done
    stored = pipeline.gold(NAMES.kpi_monthly).columns
    assert stored == ["pickup_year", "pickup_month", "avg_total_amount", "n_corridas", "total_receita"]
    rows = [tuple(r) for r in pipeline.monthly().collect()]
    assert rows == [(2023, 1, 16.0, 1, 16.0), (2023, 4, 12.0, 1, 12.0), (2023, 5, 14.0, 1, 14.0)]
    assert [tuple(r) for r in pipeline.hourly().collect()] == [(8, 2.5, 2)]
    assert pipeline.hourly().columns == ["pickup_hour", "avg_passenger_count", "n_trips"]
    assert kpi.monthly_preview(pipeline.monthly()).columns[0] == "pickup_month"


def test_views_serve_sql_users(done):
    pipeline, _ = done
    spark = pipeline.spark
    names = [r.col_name for r in catalog.describe(spark, "t_gold.vw_taxi_consumo").collect()]
    assert names == list(kpi.VIEW_COLUMNS.values())
    asked = spark.sql(
        "SELECT hour(tpep_pickup_datetime) AS h, avg(passenger_count) AS a FROM t_gold.vw_taxi_consumo"
        " WHERE month(tpep_pickup_datetime) = 5 AND passenger_count > 0 GROUP BY ALL"
    )
    assert [tuple(r) for r in asked.collect()] == [(8, 2.5)]
    totals = spark.sql("SELECT VendorID, total_amount FROM t_gold.vw_taxi_consumo WHERE taxi_type = 'hvfhv'")
    assert dict(totals.collect()) == {"HV1": 11.75, "HV2": 22.75}


def test_month_filters_read_one_partition(done):
    pipeline, _ = done

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    assert "PartitionFilters: [isnotnull(pickup_month" in plan(kpi.hourly_passengers(pipeline.fact()))
    extended = pipeline.gold(NAMES.extended_view)
    assert "PartitionFilters: [isnotnull(pickup_month" in plan(kpi.hourly_passengers(extended))
    # The contract view has no partition column to filter by.
    assert "PartitionFilters: []" in plan(kpi.hourly_passengers(pipeline.gold(NAMES.view)))


def test_reports(done):
    pipeline, _ = done
    columns = ("taxi_type", "bronze_rows", "silver_rows", "removed_rows", "removed_pct")
    counts = {tuple(r) for r in pipeline.reconciliation().select(*columns).collect()}
    assert counts == {("yellow", 4, 3, 1, 25.0), ("green", 2, 2, 0, 0.0), ("hvfhv", 2, 2, 0, 0.0), ("fhv", 3, 2, 1, 33.3)}
    assert pipeline.violations().where("n_violations > 0").count() == 0
    status = catalog.layer_status(pipeline.spark, ["t_gold.fact_trips", "t_gold.nothing"])
    assert [tuple(r) for r in status.collect()] == [("t_gold.fact_trips", True, 9), ("t_gold.nothing", False, None)]


def test_a_second_run_changes_nothing(done):
    pipeline, written = done
    before = sorted(map(str, pipeline.fact().drop("ingested_at").collect()))
    assert pipeline.run() == written
    assert sorted(map(str, pipeline.fact().drop("ingested_at").collect())) == before


def test_a_single_month_can_be_run_and_replaces_the_schema(done):
    pipeline, _ = done
    spark = pipeline.spark
    apart = Names("o_bronze", "o_silver", "o_gold")
    other = Pipeline(spark, replace(pipeline.settings, year_months=((2023, 4),), names=apart))
    assert other.ingest("yellow") == 2
    assert other.bronze("yellow").schema["VendorID"].dataType.simpleString() == "int"


def test_an_empty_result_is_counted_and_stored(done):
    pipeline, _ = done
    nothing = pipeline.fact().where("false")
    assert catalog.write_table(nothing, "t_gold.nothing_left", pipeline.settings, ["pickup_month"]) == 0
    assert pipeline.gold("nothing_left").count() == 0


def test_retired_artefacts_are_dropped_by_kind(done):
    pipeline, _ = done
    spark, settings = pipeline.spark, pipeline.settings
    spark.sql("CREATE TABLE t_gold.fact_trip USING parquet AS SELECT 1 AS a")
    spark.sql("CREATE VIEW t_gold.vw_fact_trip AS SELECT 1 AS a")
    spark.sql("CREATE TABLE t_gold.market_share_may USING parquet AS SELECT 1 AS a")
    both = {("fact_trip", "TABLE"), ("vw_fact_trip", "VIEW")}

    def listed():
        return {r.tableName for r in catalog.list_tables(spark, "t_gold").collect()}

    dry = catalog.drop_retired(spark, settings)
    assert {(n.split(".")[-1], k) for n, k, _ in dry} == both and not any(gone for *_, gone in dry)
    assert {"fact_trip", "vw_fact_trip"} <= listed()
    assert all(gone for *_, gone in catalog.drop_retired(spark, settings, dry_run=False))
    assert not {"fact_trip", "vw_fact_trip"} & listed() and "market_share_may" in listed()
    catalog.drop_retired(spark, settings, include_optional=True, dry_run=False)
    assert "market_share_may" not in listed() and "fact_trips" in listed()


def reloadable(spark, folder, months=(1, 2, 3, 4, 5), bump=0.0, widen=False):
    """Five months of each category; bump changes the yellow fares."""
    prefix = {"yellow": "yellow", "green": "green", "hvfhv": "fhvhv", "fhv": "fhv"}
    for m in months:
        rows = {
            "yellow": (METERED.format(id="bigint" if widen else "int", p="tpep"), [(1, *clock(m), 1.0, 2.0, 1, 2, 10.0 + bump, 1.0, 12.0 + bump), (1, *clock(m % 5 + 1, 9), 1.0, 2.0, 1, 2, 10.0, 1.0, 13.0)]),
            "green": (METERED.format(id="int", p="lpep"), [(1, *clock(m), 1.0, 2.0, 1, 2, 10.0, 1.0, 12.0)]),
            "hvfhv": (HVFHV, [("HV1", "B1", *clock(m), 1, 2, 3.0, 10.0, 1.0, 0.5, 0.25, None, "Y")]),
            "fhv": (FHV.format(drop="dropOff_datetime"), [("B1", *clock(m, h), None, None) for h in (8, 9, 9)]),
        }
        for taxi_type, (ddl, data) in rows.items():
            path = f"{folder}/{taxi_type}/{prefix[taxi_type]}_tripdata_2023-{m:02d}.parquet"
            spark.createDataFrame(data, ddl).coalesce(1).write.mode("overwrite").parquet(path)


def shown(df):
    return sorted(map(str, df.drop("ingested_at").collect()))


@pytest.mark.parametrize("widen", [False, True])
def test_a_month_is_loaded_without_touching_the_others(spark, tmp_path, widen):
    names = Names(*(f"m{int(widen)}_{layer}" for layer in ("bronze", "silver", "gold")))
    reloadable(spark, tmp_path)
    five = Settings(landing=str(tmp_path), year_months=tuple((2023, m) for m in range(1, 6)), names=names)
    whole = Pipeline(spark, five)
    whole.run()
    before = {m: shown(whole.bronze("yellow").where(f"_partition_month = {m}")) for m in range(1, 6)}
    fact_before = {m: shown(whole.fact().where(f"pickup_month = {m}")) for m in range(1, 6)}
    reloadable(spark, tmp_path, (3,), bump=5.0, widen=widen)
    march = Pipeline(spark, replace(five, year_months=((2023, 3),)))
    written = march.load()
    assert written[names.bronze_table("yellow")] == 2
    # The March file has trips of March and of April.
    assert march.pickup_months("yellow") == {3, 4}
    for m in (1, 2, 4, 5):
        assert shown(whole.bronze("yellow").where(f"_partition_month = {m}")) == before[m]
    for m in (1, 2, 5):
        assert shown(whole.fact().where(f"pickup_month = {m}")) == fact_before[m]
    changed = whole.fact().where("pickup_month = 3 AND taxi_type = 'yellow'")
    assert sorted(r.total_amount for r in changed.collect()) == [13.0, 17.0]
    assert whole.bronze("yellow").count() == 10 and whole.fact().count() == 30
    after = shown(whole.fact())
    assert march.load() == written and shown(whole.fact()) == after
    # The same tables as from a full run over the files as they are now.
    whole.run()
    assert shown(whole.fact()) == after


def test_a_month_without_rows_leaves_no_partition(spark, tmp_path):
    names = Names("e_bronze", "e_silver", "e_gold")
    reloadable(spark, tmp_path, (1, 2))
    two = Settings(landing=str(tmp_path), year_months=((2023, 1), (2023, 2)), names=names)
    Pipeline(spark, two).ingest("green")
    path = f"{tmp_path}/green/green_tripdata_2023-02.parquet"
    spark.createDataFrame([], METERED.format(id="int", p="lpep")).write.mode("overwrite").parquet(path)
    later = Pipeline(spark, replace(two, year_months=((2023, 2),)))
    assert later.ingest("green") == 0
    assert {r._partition_month for r in later.bronze("green").collect()} == {1}


def test_stored_fhv_months_lie_together(spark, tmp_path):
    names = Names("l_bronze", "l_silver", "l_gold")
    reloadable(spark, tmp_path)
    pipeline = Pipeline(spark, Settings(landing=str(tmp_path), names=names))
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")
    try:
        pipeline.run()
    finally:
        spark.conf.set(merging, "true")
    files = pipeline.silver("fhv").selectExpr("input_file_name() AS f", "month(pickup_datetime) AS m").distinct()
    assert files.count() == 5 and files.select("m").distinct().count() == 5
    # So the fact table gets a file a month, and not one for each task and month.
    stored = pipeline.fact().where("taxi_type = 'fhv'").selectExpr("input_file_name() AS f").distinct()
    assert stored.count() == 5


def test_kpi_tables_are_written_without_a_sort(done):
    pipeline, _ = done
    plan = kpi.yellow_totals(pipeline.fact(), ordered=False)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
