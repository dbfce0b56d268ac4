"""Raw frames with the columns of each category, derived from the driver's tables.

The real trip files are not part of the repository. FIXTURES.md defines the
derivation; every table is read whole. The frames have the source's own column
names and types, so they pass through the same code as files do.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.config import Settings
from triplake.sources.files import MonthFile
from triplake.sources.ingest import union_months

SETTINGS = Settings(period_start=datetime(1996, 1, 1), period_end=datetime(2024, 1, 25))

#: The period whose every month has yellow trips.
WHOLE = Settings(period_start=datetime(1996, 1, 1), period_end=datetime(2001, 12, 1))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _later(ts: str, seconds: str) -> str:
    return f"{ts} + cast({seconds} AS bigint) * INTERVAL '1' SECOND"


def _zone(key: str) -> str:
    return f"cast({key} % 263 + 1 AS int)"


_YELLOW_PICKUP = _later("l_shipdate", "l_partkey % 24 * 3600")
_YELLOW = {
    "VendorID": "l_suppkey",
    "tpep_pickup_datetime": _YELLOW_PICKUP,
    "tpep_dropoff_datetime": _later(f"({_YELLOW_PICKUP})", "(l_quantity * 60 - 120) * if(l_linenumber = 7, 40, 1)"),
    "passenger_count": "cast(l_linenumber - 1 AS double)",
    "trip_distance": "l_quantity * 5",
    "PULocationID": _zone("l_partkey"),
    "DOLocationID": _zone("l_suppkey"),
    "fare_amount": "if(l_quantity = 10, 0D, l_extendedprice - 2000)",
    "tip_amount": "l_discount * 100 - 1",
    "total_amount": "if(l_quantity = 10, 0D, l_extendedprice - 2000 + l_quantity * 10 - 250)",
}

_GREEN_PICKUP = _later("o_orderdate", "o_orderkey % 24 * 3600")
_GREEN = {
    "VendorID": "o_custkey % 2 + 1",
    "lpep_pickup_datetime": _GREEN_PICKUP,
    "lpep_dropoff_datetime": _later(f"({_GREEN_PICKUP})", "(o_custkey % 60 - 2) * 60 * if(o_orderkey % 50 = 0, 40, 1)"),
    "passenger_count": "if(o_orderstatus = 'P', NULL, cast(o_orderkey % 7 AS double))",
    "trip_distance": "cast(o_orderkey % 250 AS double)",
    "PULocationID": _zone("o_custkey"),
    "DOLocationID": _zone("o_orderkey"),
    "fare_amount": "o_totalprice - 5000",
    "tip_amount": "cast(o_orderkey % 21 - 1 AS double)",
    "total_amount": "o_totalprice - if(o_orderpriority = '5-LOW', 6000, 4000)",
    "ehail_fee": "NULL",
}

_HVFHV = {
    "hvfhs_license_num": "event_type",
    "dispatching_base_num": "concat('B', user_id)",
    "pickup_datetime": "ts",
    "dropoff_datetime": _later("ts", "floor(value) * 30 - 60"),
    "PULocationID": _zone("user_id"),
    "DOLocationID": _zone("event_id"),
    "trip_miles": "value",
    "base_passenger_fare": "if(event_id % 11 = 0, 0D, value - 5)",
    "tips": "if(event_id % 7 = 0, 0D, value / 10 - 1)",
    "tolls": "cast(event_id % 10 AS double)",
    "bcf": "0.5D",
    "sales_tax": "if(event_id % 5 = 0, NULL, value / 8)",
    "congestion_surcharge": "2.75D",
    "airport_fee": "if(event_id % 2 = 0, 2.5D, NULL)",
    "shared_request_flag": "'N'",
    "shared_match_flag": "CASE event_id % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' END",
}

_FHV = {
    "dispatching_base_num": "concat('B', l_suppkey)",
    "Affiliated_base_number": "concat('B', l_suppkey)",
    "pickup_datetime": "l_shipdate",
    "dropOff_datetime": _later("l_shipdate", "(l_linenumber - 1) * 3600 * if(l_suppkey % 10 = 0, 5, 1)"),
    "PUlocationID": "if(l_suppkey % 5 = 0, cast(l_suppkey AS double), NULL)",
    "DOlocationID": "if(l_suppkey % 4 = 0, cast(l_linenumber AS double), NULL)",
    "SR_Flag": "NULL",
}

# The driver table behind each category and the columns derived from it.
_DERIVED = {
    "yellow": ("lineitem", _YELLOW),
    "green": ("orders", _GREEN),
    "hvfhv": ("events", _HVFHV),
    "fhv": ("lineitem", _FHV),
}


def raw(spark: SparkSession, sf_dir: str, taxi_type: str) -> DataFrame:
    """The category's stand-in rows, tagged with the table they come from."""
    table, columns = _DERIVED[taxi_type]
    return _table(spark, sf_dir, table).selectExpr(
        *[f"{value} AS {name}" for name, value in columns.items()],
        "current_timestamp() AS ingested_at",
        f"'{table}.parquet' AS source_file",
    )


def drifting_files(spark: SparkSession, sf_dir: str) -> list[tuple[MonthFile, DataFrame]]:
    """Three months of one category whose files disagree on types, columns and letter case.

    Against January, February narrows VendorID, widens payment_type to text, lacks
    the tip and has an untyped ehail_fee; March changes the spelling of its names.
    """
    months = {
        1: _table(spark, sf_dir, "lineitem").selectExpr(
            "l_suppkey AS VendorID",
            "l_shipdate AS pickup_datetime",
            "l_quantity AS trip_distance",
            "l_extendedprice AS total_amount",
            "l_discount AS tip_amount",
            "l_linenumber AS payment_type",
        ),
        2: _table(spark, sf_dir, "orders").selectExpr(
            "cast(o_custkey AS int) AS VendorID",
            "o_orderdate AS pickup_datetime",
            "o_orderkey AS trip_distance",
            "o_totalprice AS total_amount",
            "NULL AS ehail_fee",
            "o_orderpriority AS payment_type",
        ),
        3: _table(spark, sf_dir, "events").selectExpr(
            "user_id AS vendorid",
            "ts AS PICKUP_DATETIME",
            "value AS Trip_Distance",
            "value AS ehail_fee",
            "event_type AS payment_type",
        ),
    }
    return [(MonthFile("", f"drift_2023-{month:02d}.parquet", 2023, month), df) for month, df in months.items()]


def drifting_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_months(drifting_files(spark, sf_dir))


def reissued(trips: DataFrame) -> DataFrame:
    """Every trip twice: as it is, and as a correction with another total, base fare and shared flag."""
    corrected = trips.withColumns(
        {
            "total_amount": F.col("total_amount") + 2,
            "base_passenger_fare": F.col("base_passenger_fare") + 1,
            "is_shared_ride": F.coalesce(~F.col("is_shared_ride"), F.lit(True)),
        }
    )
    return trips.unionByName(corrected)


def unreadable(trips: DataFrame) -> DataFrame:
    """Yellow rows whose fares and distances have become text, some of it no number."""
    text = lambda name, when, said: F.when(when, said).otherwise(F.col(name).cast("string"))
    return trips.withColumns(
        {
            "fare_amount": text("fare_amount", F.col("passenger_count") == 6, "n/a"),
            "trip_distance": text("trip_distance", F.col("passenger_count") == 0, "far"),
        }
    )


def fhv_files(trips: DataFrame) -> DataFrame:
    """fhv rows as three monthly files that repeat some of each other's records: every third, and every fifth of the rest."""
    number = F.expr("cast(substr(dispatching_base_num, 2) AS bigint)")
    here = F.array(F.lit(1), F.when(number % 3 == 0, 2), F.when(number % 5 == 0, 3))
    dealt = trips.withColumn("_partition_month", F.explode(F.array_compact(here))).withColumn("_partition_year", F.lit(2023))
    return dealt.withColumn("source_file", F.concat(F.lit("fhv_tripdata_2023-0"), F.col("_partition_month").cast("string"), F.lit(".parquet")))


def with_gaps(trips: DataFrame) -> DataFrame:
    """fhv rows whose flag says each of the tokens that sources use, and others, and some of whose pickups are missing."""
    number = F.expr("cast(substr(dispatching_base_num, 2) AS bigint)")
    tokens = F.array(*(F.lit(token) for token in ("1", "Y", "True", "0", "N", "False", "maybe", "", "y")), F.lit(None))
    return trips.withColumns(
        {
            "SR_Flag": F.element_at(tokens, (number % 10 + 1).cast("int")),
            "pickup_datetime": F.when(number % 7 != 0, F.col("pickup_datetime")),
        }
    )
