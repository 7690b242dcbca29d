"""Declared schemas of the two raw tables and the keys that link them."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Column names and types of the raw files, in file order.
FARE_FIELDS = (
    ("medallion", StringType()),
    ("hack_license", StringType()),
    ("vendor_id", StringType()),
    ("pickup_datetime", TimestampType()),
    ("payment_type", StringType()),
    ("fare_amount", DoubleType()),
    ("surcharge", DoubleType()),
    ("mta_tax", DoubleType()),
    ("tip_amount", DoubleType()),
    ("tolls_amount", DoubleType()),
    ("total_amount", DoubleType()),
)
TRIP_FIELDS = (
    ("medallion", StringType()),
    ("hack_license", StringType()),
    ("vendor_id", StringType()),
    ("rate_code", IntegerType()),
    ("store_and_fwd_flag", StringType()),
    ("pickup_datetime", TimestampType()),
    ("dropoff_datetime", TimestampType()),
    ("passenger_count", IntegerType()),
    ("trip_time_in_secs", DoubleType()),
    ("trip_distance", DoubleType()),
    ("pickup_longitude", DoubleType()),
    ("pickup_latitude", DoubleType()),
    ("dropoff_longitude", DoubleType()),
    ("dropoff_latitude", DoubleType()),
)

FARE_COLUMNS = [name for name, _ in FARE_FIELDS]
TRIP_COLUMNS = [name for name, _ in TRIP_FIELDS]

FARE_SCHEMA = StructType([StructField(name, kind, True) for name, kind in FARE_FIELDS])
TRIP_SCHEMA = StructType([StructField(name, kind, True) for name, kind in TRIP_FIELDS])

# The raw fare files pad every header but the first with a blank.
PADDED_FARE_SCHEMA = StructType(
    [StructField(name if i == 0 else f" {name}", kind, True) for i, (name, kind) in enumerate(FARE_FIELDS)]
)

# A ride is the same row of both tables when these agree.
RIDE_KEYS = ["medallion", "hack_license", "vendor_id", "pickup_datetime"]
