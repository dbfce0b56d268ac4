"""Typed schemas of the layers and the checks that hold data to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_STRING = T.StringType()
_INT = T.IntegerType()
_DOUBLE = T.DoubleType()
_BOOLEAN = T.BooleanType()
_NTZ = T.TimestampNTZType()

# Names, order and types of the canonical columns.
CANONICAL = T.StructType(
    [
        T.StructField("taxi_type", _STRING),
        T.StructField("pickup_datetime", _NTZ),
        T.StructField("dropoff_datetime", _NTZ),
        T.StructField("provider_id", _STRING),
        T.StructField("dispatch_base_id", _STRING),
        T.StructField("pickup_location_id", _INT),
        T.StructField("dropoff_location_id", _INT),
        T.StructField("passenger_count", _INT),
        T.StructField("trip_distance", _DOUBLE),
        T.StructField("fare_amount", _DOUBLE),
        T.StructField("tip_amount", _DOUBLE),
        T.StructField("total_amount", _DOUBLE),
        T.StructField("is_shared_ride", _BOOLEAN),
        T.StructField("base_passenger_fare", _DOUBLE),
        T.StructField("tolls", _DOUBLE),
        T.StructField("bcf", _DOUBLE),
        T.StructField("sales_tax", _DOUBLE),
        T.StructField("congestion_surcharge", _DOUBLE),
        T.StructField("airport_fee", _DOUBLE),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("source_file", _STRING),
    ]
)

SILVER = T.StructType(
    CANONICAL.fields
    + [
        T.StructField("record_hash", _STRING),
        T.StructField("ride_key", _STRING),
        T.StructField("financial_inconsistency_flag", _BOOLEAN),
        T.StructField("zero_fare_with_distance_flag", _BOOLEAN),
    ]
)

FACT = T.StructType(
    SILVER.fields
    + [
        T.StructField("pickup_date", T.DateType()),
        T.StructField("pickup_year", _INT),
        T.StructField("pickup_month", _INT),
        T.StructField("pickup_hour", _INT),
    ]
)


def differences(actual: T.StructType, expected: T.StructType) -> list[tuple[str, str, str]]:
    """(column, expected type, actual type) wherever the two disagree, by name.

    Nullability is left out: tables read back are always nullable.
    """
    have = {f.name: f.dataType.simpleString() for f in actual}
    want = {f.name: f.dataType.simpleString() for f in expected}
    wrong = [(name, kind, have.get(name, "missing")) for name, kind in want.items() if have.get(name) != kind]
    extra = [(name, "absent", have[name]) for name in have if name not in want]
    return wrong + extra


def require(df: DataFrame, expected: T.StructType, what: str) -> DataFrame:
    """Fail before a union or a write can widen a type without notice."""
    wrong = differences(df.schema, expected)
    if wrong:
        detail = "; ".join(f"{name}: expected {want}, found {got}" for name, want, got in wrong)
        raise TypeError(f"{what} does not have the agreed schema: {detail}")
    return df


def conformance(spark: SparkSession, tables: dict[str, T.StructType], expected: T.StructType) -> DataFrame:
    """One row per (table, expected column) with the type found, for a quality report."""
    rows = []
    for table, actual in tables.items():
        have = {f.name: f.dataType.simpleString() for f in actual}
        for field in expected:
            want, got = field.dataType.simpleString(), have.get(field.name, "missing")
            rows.append((table, field.name, want, got, want == got))
    return spark.createDataFrame(
        rows, "table_name string, column_name string, expected string, actual string, conforms boolean"
    )
