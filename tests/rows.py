"""Hand-made rows: a valid canonical trip per category, to be varied one field at a time."""

from datetime import datetime

from triplake.schema import CANONICAL

NOON = datetime(2023, 3, 10, 12)


def trip(taxi_type="yellow", **fields):
    row = dict.fromkeys(CANONICAL.fieldNames())
    row.update(
        taxi_type=taxi_type,
        pickup_datetime=NOON,
        dropoff_datetime=datetime(2023, 3, 10, 12, 30),
        provider_id="1",
        pickup_location_id=10,
        dropoff_location_id=20,
        ingested_at=datetime(2024, 1, 1),
        source_file="a.parquet",
    )
    if taxi_type in ("yellow", "green"):
        row.update(passenger_count=1, trip_distance=2.5, fare_amount=10.0, tip_amount=1.0, total_amount=12.0)
    elif taxi_type == "hvfhv":
        row.update(trip_distance=2.5, base_passenger_fare=10.0, tip_amount=1.0, tolls=0.5, bcf=0.25)
    row.update(fields)
    return row


def trips(spark, *rows):
    return spark.createDataFrame([tuple(row[name] for name in CANONICAL.fieldNames()) for row in rows], CANONICAL)
