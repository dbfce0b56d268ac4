from datetime import datetime
from itertools import combinations, permutations

import pytest
from pyspark.sql import types as T

from triplake.config import Settings
from triplake.plans import silver as layer
from triplake.schema import CANONICAL, differences, require
from triplake.sources.canonical import to_canonical
from triplake.sources.files import MonthFile, month_files
from triplake.sources.ingest import common_schema, read_months, union_months

START, END = datetime(2023, 1, 5, 8), datetime(2023, 1, 5, 9)


def test_month_files_follow_the_naming_pattern():
    files = month_files(Settings(landing="/in"), "hvfhv")
    assert [f.month for f in files] == [1, 2, 3, 4, 5]
    assert files[0] == MonthFile("/in/hvfhv/fhvhv_tripdata_2023-01.parquet", "fhvhv_tripdata_2023-01.parquet", 2023, 1)


def test_common_schema_widens_and_ignores_case(spark):
    a = T.StructType.fromDDL("VendorID int, fare double, when timestamp, fee void, kind int, only_a string, gone void")
    b = T.StructType.fromDDL("vendorid bigint, FARE int, when timestamp_ntz, fee double, kind string")
    merged = common_schema([a, b])
    assert [(f.name, f.dataType.simpleString()) for f in merged] == [
        ("VendorID", "bigint"),
        ("fare", "double"),
        ("when", "timestamp_ntz"),
        ("fee", "double"),
        ("kind", "string"),
        ("only_a", "string"),
        ("gone", "string"),
    ]
    assert common_schema([b, a])["VENDORID".lower()].dataType == T.LongType()


def test_order_of_months_does_not_change_types(spark):
    kinds = ("int", "bigint", "double", "string", "void", "timestamp", "timestamp_ntz", "date", "decimal(10,2)")
    for some in combinations(kinds, 3):
        months = [T.StructType.fromDDL(f"a {kind}") for kind in some]
        assert len({common_schema(order)["a"].dataType for order in permutations(months)}) == 1


def test_drifting_files_are_read_into_one_frame(spark, tmp_path):
    months = {
        1: spark.createDataFrame([(1, 2.0, "x")], "VendorID int, fee double, extra string"),
        2: spark.createDataFrame([(2**40, 5)], "VendorID bigint, fee int"),
        3: spark.createDataFrame([("7", None)], "vendorid string, FEE double"),
    }
    files = []
    for month, df in months.items():
        name = f"t_2023-{month:02d}.parquet"
        df.write.parquet(f"{tmp_path}/{name}")
        files.append(MonthFile(f"{tmp_path}/{name}", name, 2023, month))
    result = read_months(spark, files)
    assert result.columns == [
        "VendorID", "fee", "extra", "ingested_at", "source_file", "_partition_year", "_partition_month",
    ]
    rows = sorted((r.VendorID, r.fee, r.extra, r.source_file, r._partition_month) for r in result.collect())
    assert rows == [
        ("1", 2.0, "x", "t_2023-01.parquet", 1),
        (str(2**40), 5.0, None, "t_2023-02.parquet", 2),
        ("7", None, None, "t_2023-03.parquet", 3),
    ]
    assert len({r.ingested_at for r in result.collect()}) == 1


def test_many_months_stay_one_flat_union(spark):
    one = spark.range(1).selectExpr("id AS VendorID")
    result = union_months([(MonthFile("", f"{m}", 2023, m), one) for m in range(1, 41)])
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert result.count() == 40 and plan.count("Union") == 1


def canonical(spark, taxi_type, ddl, *rows):
    df = to_canonical(spark.createDataFrame(list(rows), ddl), taxi_type)
    assert not differences(df.schema, CANONICAL) and df.columns == CANONICAL.fieldNames()
    return df.collect()


def test_yellow_casts_dirty_numbers(spark):
    ddl = (
        "VendorID bigint, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz,"
        " passenger_count double, trip_distance double, PULocationID int, DOLocationID int, fare_amount double, tip_amount double,"
        " total_amount double, congestion_surcharge double, airport_fee double"
    )
    rest = (1.5, 3, 4, 5.0, 6.0, 7.0, 2.5, 1.25)
    rows = canonical(
        spark, "yellow", ddl, *[(2, START, END, p, *rest) for p in (2.9, float("nan"), None, 0.0, 1e12)]
    )
    assert [r.passenger_count for r in rows] == [2, None, None, 0, None]
    first = rows[0]
    assert (first.provider_id, first.pickup_location_id, first.dropoff_location_id) == ("2", 3, 4)
    assert (first.congestion_surcharge, first.airport_fee, first.dispatch_base_id) == (None, None, None)
    assert first.source_file == "unknown" and first.ingested_at is not None


def test_columns_that_drifted_to_text_are_read_back(spark):
    ddl = (
        "VendorID string, lpep_pickup_datetime string, lpep_dropoff_datetime timestamp_ntz, passenger_count string,"
        " trip_distance string, PULocationID double, DOLocationID bigint, fare_amount int, tip_amount string,"
        " total_amount float, ehail_fee string"
    )
    (row,) = canonical(spark, "green", ddl, ("2", "2023-01-05 08:00:00", END, "x", "1.5", 3.0, 4, 5, "none", 2.5, "0"))
    assert (row.provider_id, row.pickup_datetime, row.passenger_count, row.trip_distance) == ("2", START, None, 1.5)
    assert (row.pickup_location_id, row.fare_amount, row.tip_amount, row.total_amount) == (3, 5.0, None, 2.5)


def test_hvfhv_flags_and_absent_columns(spark):
    ddl = (
        "hvfhs_license_num string, dispatching_base_num string, pickup_datetime timestamp_ntz,"
        " dropoff_datetime timestamp_ntz, PULocationID int, DOLocationID int, trip_miles double,"
        " base_passenger_fare double, tips double, tolls double, BCF double, shared_match_flag string,"
        " source_file string, ingested_at timestamp"
    )
    tokens = ("Y", "N", "y", " ", None)
    rows = canonical(
        spark, "hvfhv", ddl, *[("HV0003", "B1", START, END, 1, 2, 3.0, 4.0, 5.0, 6.0, 7.0, t, "f", END) for t in tokens]
    )
    assert [r.is_shared_ride for r in rows] == [True, False, None, None, None]
    first = rows[0]
    assert (first.bcf, first.sales_tax, first.airport_fee) == (7.0, None, None)
    assert (first.fare_amount, first.total_amount) == (None, None)
    assert (first.source_file, first.ingested_at) == ("f", END)


@pytest.mark.parametrize("spelling", ["dropOff_datetime", "dropoff_datetime", "DROPOFF_DATETIME"])
def test_fhv_spellings_and_tokens(spark, spelling):
    ddl = (
        f"dispatching_base_num string, Affiliated_base_number string, pickup_datetime timestamp_ntz,"
        f" {spelling} timestamp_ntz, PUlocationid double, DOLOCATIONID double, SR_Flag string"
    )
    tokens = ("1", "Y", "True", "0", "N", "False", "true", "2", None)
    rows = canonical(spark, "fhv", ddl, *[("B1", "B2", START, END, 12.0, None, t) for t in tokens])
    assert [r.is_shared_ride for r in rows] == [True] * 3 + [False] * 3 + [None] * 3
    assert (rows[0].dropoff_datetime, rows[0].pickup_location_id, rows[0].dropoff_location_id) == (END, 12, None)


def test_fhv_merges_two_spellings(spark):
    spark.conf.set("spark.sql.caseSensitive", True)
    try:
        ddl = (
            "dispatching_base_num string, pickup_datetime timestamp_ntz, dropOff_datetime timestamp_ntz,"
            " dropoff_datetime timestamp_ntz"
        )
        rows = canonical(spark, "fhv", ddl, ("B", START, None, END), ("B", START, START, END))
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
    assert [r.dropoff_datetime for r in rows] == [END, START]


def test_fhv_clock_gap_survives_any_zone(spark, zone):
    zone("America/New_York")
    gap = datetime(2023, 3, 12, 2, 30)
    ddl = "dispatching_base_num string, pickup_datetime timestamp_ntz, dropOff_datetime timestamp_ntz"
    assert canonical(spark, "fhv", ddl, ("B", START, gap))[0].dropoff_datetime == gap


def test_require_names_every_difference(spark):
    df = spark.range(1).selectExpr("string(id) AS taxi_type", "current_timestamp() AS pickup_datetime", "1 AS other")
    wrong_type_and_extra = "pickup_datetime: expected timestamp_ntz, found timestamp; .*other: expected absent"
    with pytest.raises(TypeError, match=wrong_type_and_extra):
        require(df, CANONICAL, "frame")


@pytest.mark.parametrize("name", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_zoned_trip_times_are_utc_wall_time_in_any_session(spark, zone, name):
    made = spark.sql(
        "SELECT 'B1' AS dispatching_base_num, timestamp_micros(1672884000123456L) AS pickup_datetime,"
        " timestamp_micros(1672885000000000L) AS dropOff_datetime, 1.0D AS PUlocationID, NULL AS DOlocationID"
    )
    zone(name)
    row = layer.instrumented(to_canonical(made, "fhv"), "fhv").first()
    assert str(row.pickup_datetime) == "2023-01-05 02:00:00.123456"
    assert row.record_hash[:8] == layer.instrumented(to_canonical(made, "fhv"), "fhv").first().record_hash[:8]


def test_months_widen_exactly_and_lineage_is_replaced(spark):
    a = spark.sql("SELECT 12345678901234567.89BD AS d, DATE'2023-01-01' AS t, 'old' AS Source_File, 1 AS n")
    b = spark.sql("SELECT 1.5BD AS d, TIMESTAMP_NTZ'2023-01-01 10:00:00' AS t, 'old' AS Source_File, 2.25BD AS n")
    files = [MonthFile("", f"{k}.parquet", 2023, k) for k in (1, 2)]
    got = union_months(list(zip(files, (a, b))))
    plain = a.drop("Source_File").union(b.drop("Source_File"))
    assert [got.schema[c].dataType for c in ("d", "t", "n")] == [plain.schema[c].dataType for c in ("d", "t", "n")]
    rows = sorted(got.collect(), key=lambda r: r.source_file)
    assert str(rows[0].d) == "12345678901234567.89" and [r.source_file for r in rows] == ["1.parquet", "2.parquet"]
