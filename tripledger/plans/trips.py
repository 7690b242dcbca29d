"""Questions about the trip table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripledger.functions import weekday_name, weekday_number
from tripledger.operators import concurrency
from tripledger.operators.extremes import max_per_group, top_rows
from tripledger.operators.grouping import share_of_group

# The vendor text that means "none" and the seconds beyond which a trip is long.
NO_VENDOR = "None"
LONG_TRIP_SECONDS = 1800


def busiest_weekdays(trip: DataFrame, moment: str = "pickup_datetime") -> DataFrame:
    """The weekday(s) with the most rides, per known vendor."""
    counts = (
        trip.where(F.col("vendor_id").isNotNull())
        .groupBy("vendor_id", weekday_number(moment).alias("_weekday"))
        .agg(F.count(F.lit(1)).alias("count"))
        .select("vendor_id", weekday_name("_weekday").alias("dayofweek"), "count")
    )
    return max_per_group(counts, ["vendor_id"], "count")


def mean_distance_by_passengers(trip: DataFrame) -> DataFrame:
    """Mean distance per vendor and known number of passengers."""
    return (
        trip.where(F.col("passenger_count").isNotNull())
        .groupBy("vendor_id", "passenger_count")
        .agg(F.avg("trip_distance").alias("avg_trip_distance"))
        .orderBy(F.desc("passenger_count"))
    )


def simultaneous_trips(trip: DataFrame, k: int = 5) -> DataFrame:
    """The k days with the largest surplus of pickups over dropoffs at one instant."""
    peaks = concurrency.peak_net_change(trip, "pickup_datetime", "dropoff_datetime", "simultaneous_trips")
    return top_rows(peaks, [F.desc("simultaneous_trips"), F.asc("day")], k)


def peak_concurrency(trip: DataFrame, k: int = 5) -> DataFrame:
    """The k days with the most trips under way at once."""
    peaks = concurrency.peak_concurrency(trip, "pickup_datetime", "dropoff_datetime", "simultaneous_trips")
    return top_rows(peaks, [F.desc("simultaneous_trips"), F.asc("day")], k)


def long_trip_share(trip: DataFrame, seconds: float = LONG_TRIP_SECONDS, no_vendor: str = NO_VENDOR) -> DataFrame:
    """Trips, long trips and their share, per vendor."""
    return share_of_group(
        trip.where(F.col("vendor_id") != no_vendor),
        ["vendor_id"],
        F.col("trip_time_in_secs") > seconds,
        "total_trips",
        "long_trips",
        "percentage_long_trips",
    )


def top_drivers_by_time(trip: DataFrame, k: int = 5) -> DataFrame:
    """The k drivers (per vendor they drive for) with the most time in trips."""
    times = trip.groupBy("vendor_id", "hack_license").agg(F.sum("trip_time_in_secs").alias("sum_trip_time_in_secs"))
    return top_rows(times, [F.desc("sum_trip_time_in_secs"), F.asc("vendor_id"), F.asc("hack_license")], k)


def mean_duration_by_rate_code(trip: DataFrame) -> DataFrame:
    """Mean trip time of each known rate code."""
    return (
        trip.where(F.col("rate_code").isNotNull())
        .groupBy("rate_code")
        .agg(F.avg("trip_time_in_secs").alias("avg_trip_duration"))
        .orderBy(F.asc("rate_code"))
    )
