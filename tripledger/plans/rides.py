"""Questions about fares and trips together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripledger.functions import day_string, money_text, total, weight
from tripledger.operators.extremes import max_per_group, ranked_in_group, top_rows
from tripledger.operators.grouping import above_group_mean
from tripledger.operators.matching import fold, join_folded, ratio_of_sums
from tripledger.schema import RIDE_KEYS

# Keys of the looser matches: without the vendor, and by driver and pickup alone.
VEHICLE_DRIVER_PICKUP = ["medallion", "hack_license", "pickup_datetime"]
DRIVER_PICKUP = ["hack_license", "pickup_datetime"]

# Fixed value: a ride with more passengers than this is a large party.
LARGE_PARTY = 5


def ride_totals(fare: DataFrame, trip: DataFrame) -> DataFrame:
    """Matched rides, folded: one row per ride keys, rate code and dropoff day.

    ``fares`` and ``trips`` count the rows behind each side; ``tips``, ``amount`` and ``seconds`` are
    the sums of one side. Three questions need only these columns, so when more than one of them is
    asked, store this table once and pass it to them.
    """
    fares = fold(fare, RIDE_KEYS, "fares", total("tip_amount").alias("tips"), total("fare_amount").alias("amount"))
    trips = fold(
        trip,
        [*RIDE_KEYS, "rate_code", F.to_date("dropoff_datetime").alias("day")],
        "trips",
        total("trip_time_in_secs").alias("seconds"),
    )
    return join_folded(fares, trips)


def rides_by_rate_code(fare: DataFrame, trip: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Matched rides of each known rate code, most frequent first."""
    if totals is None:
        known = trip.where(F.col("rate_code").isNotNull())
        totals = join_folded(fold(fare, RIDE_KEYS, "fares"), fold(known, [*RIDE_KEYS, "rate_code"], "trips"))
    return (
        totals.where(F.col("rate_code").isNotNull())
        .groupBy("rate_code")
        .agg(F.sum(weight("fares") * weight("trips")).cast("long").alias("trip_count"))
        .orderBy(F.desc("trip_count"))
    )


def trips_above_mean_tip(fare: DataFrame, trip: DataFrame) -> DataFrame:
    """Matched rides tipped above the mean of their rate code, most frequent first."""
    fares = fold(fare, [*RIDE_KEYS, "tip_amount"], "_fares")
    trips = fold(trip.where(F.col("rate_code").isNotNull()), [*RIDE_KEYS, "rate_code"], "_trips")
    matched = join_folded(fares, trips).select(
        "rate_code", "tip_amount", (weight("_fares") * weight("_trips")).alias("_rides")
    )
    return above_group_mean(matched, "rate_code", "tip_amount", "_rides", "trip_count").orderBy(F.desc("trip_count"))


def _driver_totals(fare: DataFrame, trip: DataFrame) -> DataFrame:
    """Mean distance and tip total per (vendor of the trip, driver), as numbers and as text."""
    fares = fold(fare, DRIVER_PICKUP, "_fares", total("tip_amount").alias("_tips"))
    trips = fold(
        trip,
        [*DRIVER_PICKUP, "vendor_id"],
        "_trips",
        total("trip_distance").alias("_distance"),
        F.count("trip_distance").alias("_measured"),
    )
    return (
        join_folded(fares, trips, DRIVER_PICKUP)
        .groupBy(F.col("vendor_id").alias("vendor"), "hack_license")
        .agg(
            total(F.col("_distance") * F.col("_fares")).alias("_distance"),
            F.sum(weight("_measured") * weight("_fares")).cast("double").alias("_measured"),
            total(F.col("_tips") * F.col("_trips")).alias("_tips"),
        )
        .withColumn("_mileage", F.try_divide("_distance", "_measured"))
        .select(
            "vendor",
            "hack_license",
            money_text("_mileage").alias("average_mileage"),
            money_text("_tips").alias("total_tip_amount"),
            "_mileage",
            "_tips",
        )
    )


def top_drivers_by_vendor(fare: DataFrame, trip: DataFrame, k: int = 10) -> DataFrame:
    """Drivers ranked per vendor by mean distance, then tips, both *compared as text*; ranks 1 … k."""
    order = ["average_mileage", "total_tip_amount"]
    return ranked_in_group(_driver_totals(fare, trip).drop("_mileage", "_tips"), ["vendor"], order, k)


def top_drivers_by_vendor_numeric(fare: DataFrame, trip: DataFrame, k: int = 10) -> DataFrame:
    """Drivers ranked per vendor by mean distance, then tips; ranks 1 … k."""
    order = ["_mileage", "_tips"]
    return ranked_in_group(_driver_totals(fare, trip), ["vendor"], order, k).drop("_mileage", "_tips")


def driver_of_each_day(fare: DataFrame, trip: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """The driver(s) with the largest tip total of each day on which trips ended."""
    if totals is None:
        fares = fold(fare, RIDE_KEYS, "fares", total("tip_amount").alias("tips"))
        trips = fold(trip, [*RIDE_KEYS, F.to_date("dropoff_datetime").alias("day")], "trips")
        totals = join_folded(fares, trips)
    tips = totals.groupBy("day", "hack_license", "vendor_id").agg(
        total(F.col("tips") * F.col("trips")).alias("tips_sum")
    )
    return max_per_group(tips, ["day"], "tips_sum").select(
        day_string("day").alias("date"), "hack_license", "vendor_id", "tips_sum"
    )


def fare_per_second_by_vendor(fare: DataFrame, trip: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Fares divided by seconds driven, per vendor; null for a vendor without driving time."""
    if totals is None:
        fares = fold(fare, RIDE_KEYS, "fares", total("fare_amount").alias("amount"))
        trips = fold(trip, RIDE_KEYS, "trips", total("trip_time_in_secs").alias("seconds"))
        totals = join_folded(fares, trips)
    return ratio_of_sums(
        totals,
        ["vendor_id"],
        F.col("amount") * F.col("trips"),
        F.col("seconds") * F.col("fares"),
        "average_fare_per_second",
    )


def top_totals_of_large_parties(fare: DataFrame, trip: DataFrame, passengers: int = LARGE_PARTY, k: int = 10) -> DataFrame:
    """The k highest totals per vehicle, driver and party size, for parties above ``passengers``."""
    fares = fold(fare, VEHICLE_DRIVER_PICKUP, "_fares", F.max("total_amount").alias("_total"))
    large = trip.where(F.col("passenger_count") > passengers)
    trips = fold(large, [*VEHICLE_DRIVER_PICKUP, "passenger_count"], "_trips")
    totals = (
        join_folded(fares, trips, VEHICLE_DRIVER_PICKUP)
        .groupBy("medallion", "hack_license", "passenger_count")
        .agg(F.max("_total").alias("max_total_amount"))
    )
    order = [F.desc("max_total_amount"), F.asc("medallion"), F.asc("hack_license"), F.asc("passenger_count")]
    return top_rows(totals, order, k)
