"""One projection per category from its raw columns onto the canonical schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triplake.functions.columns import optional_col, token_flag
from triplake.schema import CANONICAL

# The texts that sources write for a shared ride.
MATCH_TOKENS = (("Y",), ("N",))
SR_FLAG_TOKENS = (("1", "Y", "True"), ("0", "N", "False"))

UNKNOWN_FILE = "unknown"


def _metered(prefix: str) -> dict[str, str]:
    """Yellow and green differ only in the prefix of their clock columns.

    Their surcharges stay out on purpose: total_amount already holds them.
    """
    same_name = ("passenger_count", "trip_distance", "fare_amount", "tip_amount", "total_amount")
    return {
        "pickup_datetime": f"{prefix}_pickup_datetime",
        "dropoff_datetime": f"{prefix}_dropoff_datetime",
        "provider_id": "VendorID",
        "pickup_location_id": "PULocationID",
        "dropoff_location_id": "DOLocationID",
        **{name: name for name in same_name},
    }


def _hvfhv(raw: DataFrame) -> dict[str, str]:
    may_be_absent = ("bcf", "sales_tax", "congestion_surcharge", "airport_fee")
    return {
        "pickup_datetime": "pickup_datetime",
        "dropoff_datetime": "dropoff_datetime",
        "provider_id": "hvfhs_license_num",
        "dispatch_base_id": "dispatching_base_num",
        "pickup_location_id": "PULocationID",
        "dropoff_location_id": "DOLocationID",
        "trip_distance": "trip_miles",
        "tip_amount": "tips",
        "is_shared_ride": token_flag("shared_match_flag", *MATCH_TOKENS),
        "base_passenger_fare": "base_passenger_fare",
        "tolls": "tolls",
        **{name: optional_col(raw, name) for name in may_be_absent},
    }


def _fhv(raw: DataFrame) -> dict[str, str]:
    return {
        "pickup_datetime": "pickup_datetime",
        "dropoff_datetime": optional_col(raw, "dropOff_datetime"),
        "provider_id": "dispatching_base_num",
        "pickup_location_id": optional_col(raw, "PUlocationID"),
        "dropoff_location_id": optional_col(raw, "DOlocationID"),
        "is_shared_ride": token_flag(optional_col(raw, "SR_Flag"), *SR_FLAG_TOKENS),
    }


_MAPPINGS = {
    "yellow": lambda raw: _metered("tpep"),
    "green": lambda raw: _metered("lpep"),
    "hvfhv": _hvfhv,
    "fhv": _fhv,
}


def in_utc(raw: DataFrame) -> DataFrame:
    """Zoned trip times as UTC wall time, whatever zone the session has; the time of ingestion stays an instant."""
    zoned = [f.name for f in raw.schema if isinstance(f.dataType, T.TimestampType) and f.name.lower() != "ingested_at"]
    seconds = "CAST(CAST(unix_micros(`{0}`) AS DECIMAL(20, 0)) / 1000000 AS DECIMAL(18, 6))"
    wall = "timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, " + seconds + ")"
    return raw.withColumns({name: F.expr(wall.format(name)) for name in zoned}) if zoned else raw


def expressions(raw: DataFrame, taxi_type: str) -> dict[str, str]:
    """The SQL expression of each canonical column that a source has, before its cast."""
    return {
        **_MAPPINGS[taxi_type](raw),
        "taxi_type": f"'{taxi_type}'",
        "ingested_at": f"coalesce({optional_col(raw, 'ingested_at')}, current_timestamp())",
        "source_file": f"coalesce({optional_col(raw, 'source_file')}, '{UNKNOWN_FILE}')",
    }


def to_canonical(raw: DataFrame, taxi_type: str, keep: Sequence[str] = ()) -> DataFrame:
    """Raw rows of a category as the canonical columns, and the columns `keep`; what a source lacks is a typed NULL.

    A value its type cannot hold, such as a NaN count or malformed text in a
    column that drifted to text, becomes NULL and is left to the rules.
    """
    values = expressions(raw, taxi_type)
    raw = in_utc(raw)
    return raw.selectExpr(
        *[f"try_cast({values.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}" for f in CANONICAL],
        *keep,
    )
