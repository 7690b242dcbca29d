"""Ride tables derived from an order-line table, for test data without rides.

Each order line becomes one ride; both tables are projections of the same lines, so they match on
the ride keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger.schema import FARE_COLUMNS, TRIP_COLUMNS

_SECOND_OF_DAY = "(l_orderkey * 7919 + l_linenumber * 613) % 86400"

_SHARED = {
    "medallion": "cast(l_partkey as string)",
    "hack_license": "cast(l_suppkey as string)",
    "vendor_id": "case l_returnflag when 'A' then 'CMT' when 'N' then 'VTS' else 'DDS' end",
    "pickup_datetime": f"l_shipdate + make_dt_interval(0, 0, 0, {_SECOND_OF_DAY})",
}
_FARE = {
    "payment_type": (
        "case l_orderkey % 5 when 0 then 'CSH' when 1 then 'CRD' when 2 then 'NOC' when 3 then 'DIS' else 'UNK' end"
    ),
    "fare_amount": "l_extendedprice",
    "surcharge": "round(l_tax * 100)",
    "mta_tax": "0.5D",
    "tip_amount": "(l_quantity * round(l_discount * 100) * 1000 + (l_orderkey * 31 + l_linenumber * 7) % 100) / 100",
    "tolls_amount": "0.0D",
}
_TRIP = {
    "rate_code": "l_linenumber",
    "store_and_fwd_flag": "'N'",
    "dropoff_datetime": f"l_shipdate + make_dt_interval(0, 0, 0, {_SECOND_OF_DAY} + l_quantity * 60)",
    "passenger_count": "cast(l_partkey % 6 + 1 as int)",
    "trip_time_in_secs": "l_quantity * 60",
    "trip_distance": "l_quantity * 0.25D",
    "pickup_longitude": "cast(null as double)",
    "pickup_latitude": "cast(null as double)",
    "dropoff_longitude": "cast(null as double)",
    "dropoff_latitude": "cast(null as double)",
}


def _project(lines: DataFrame, columns: dict[str, str]) -> DataFrame:
    return lines.select(*[F.expr(expression).alias(name) for name, expression in columns.items()])


def fare_table(spark: SparkSession, directory: str) -> DataFrame:
    amounts = _project(spark.read.parquet(f"{directory}/lineitem.parquet"), _SHARED | _FARE)
    total = F.expr("rint((fare_amount + surcharge + mta_tax + tip_amount + tolls_amount) * 100) / 100")
    return amounts.withColumn("total_amount", total).select(*FARE_COLUMNS)


def trip_table(spark: SparkSession, directory: str) -> DataFrame:
    return _project(spark.read.parquet(f"{directory}/lineitem.parquet"), _SHARED | _TRIP).select(*TRIP_COLUMNS)
