"""Questions about the fare table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripledger.functions import day_type, money_text, total, weekday_name, weekday_number
from tripledger.functions.calendar import WORKING_DAYS
from tripledger.operators.extremes import first_per_group, max_per_group, top_rows, top_values_per_group
from tripledger.operators.grouping import sum_by_day
from tripledger.operators.totals import attach_group_ratio, attach_group_total

# Codes and days the questions ask about unless told otherwise.
CASH = "CSH"
LARGE_VENDOR = "VTS"
FIRST_DAY = dt.date(2013, 1, 1)
LAST_DAY = dt.date(2013, 1, 7)


def revenue_by_vendor(fare: DataFrame) -> DataFrame:
    """Total revenue of each known vendor, as text."""
    return (
        fare.where(F.col("vendor_id").isNotNull())
        .groupBy("vendor_id")
        .agg(money_text(total("total_amount")).alias("total_revenue"))
    )


def highest_total_by_vendor(fare: DataFrame) -> DataFrame:
    """The highest total paid for one ride, per known vendor."""
    return (
        fare.where(F.col("vendor_id").isNotNull())
        .groupBy("vendor_id")
        .agg(F.max("total_amount").alias("total_amount"))
    )


def _tips_by_weekday(fare: DataFrame) -> DataFrame:
    return (
        fare.groupBy("vendor_id", weekday_number("pickup_datetime").alias("_weekday"))
        .agg(total("tip_amount").alias("_tips"))
        .select(
            "vendor_id",
            weekday_name("_weekday").alias("day_of_week"),
            money_text("_tips").alias("total_tips"),
            "_tips",
        )
    )


def best_tip_weekday(fare: DataFrame) -> DataFrame:
    """Per vendor the weekday whose tip total, *compared as text*, is the greatest ('9.00' > '10.00')."""
    order = [F.desc("total_tips"), F.asc("day_of_week")]
    return first_per_group(_tips_by_weekday(fare).drop("_tips"), ["vendor_id"], order)


def best_tip_weekday_numeric(fare: DataFrame) -> DataFrame:
    """Per vendor the weekday with the greatest tip total."""
    order = [F.desc("_tips"), F.asc("day_of_week")]
    return first_per_group(_tips_by_weekday(fare), ["vendor_id"], order).drop("_tips")


def mean_fare_by_payment_type(fare: DataFrame) -> DataFrame:
    """Mean fare of each payment type as text, in descending order of that text."""
    return (
        fare.groupBy("payment_type")
        .agg(money_text(F.try_divide(total("fare_amount"), F.count("fare_amount"))).alias("average_fare_amount"))
        .orderBy(F.desc("average_fare_amount"))
    )


def top_cash_tips(fare: DataFrame, payment_type: str = CASH, k: int = 5) -> DataFrame:
    """One row per cash ride whose tip is among the k largest distinct tips of its vendor."""
    cash = fare.where(F.col("payment_type") == payment_type)
    return top_values_per_group(cash, ["vendor_id"], "tip_amount", k)


def rides_by_day_type(fare: DataFrame, working_days: Sequence[int] = WORKING_DAYS) -> DataFrame:
    """Rides of each vendor on weekdays and on weekends (an unknown day is a weekend)."""
    return (
        fare.groupBy("vendor_id", day_type("pickup_datetime", working_days).alias("day_type"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("vendor_id", "day_type")
    )


def tips_above_fare(fare: DataFrame) -> DataFrame:
    """Rides with a tip larger than the fare."""
    return fare.where(F.col("fare_amount") < F.col("tip_amount")).select(
        "medallion", "hack_license", "vendor_id", "pickup_datetime", "payment_type", "fare_amount", "tip_amount"
    )


def earnings_by_day(fare: DataFrame, first: dt.date = FIRST_DAY, last: dt.date = LAST_DAY) -> DataFrame:
    """Earnings of each vendor on each day first … last."""
    return sum_by_day(fare, ["vendor_id"], "pickup_datetime", "total_amount", first, last, "total_earnings")


def top_vendor_by_payment_type(fare: DataFrame) -> DataFrame:
    """The vendor(s) with the largest revenue, per payment type."""
    revenue = fare.groupBy("payment_type", "vendor_id").agg(total("total_amount").alias("sum_total_amount"))
    return max_per_group(revenue, ["payment_type"], "sum_total_amount")


def most_popular_payment_type(fare: DataFrame) -> DataFrame:
    """The most frequent payment type; unknown is one of them."""
    counts = fare.groupBy("payment_type").agg(F.count(F.lit(1)).alias("count"))
    return top_rows(counts, [F.desc("count"), F.asc("payment_type")], 1)


def highest_fare(fare: DataFrame, vendor: str = LARGE_VENDOR) -> DataFrame:
    """The whole ride with the vendor's highest fare."""
    others = [F.asc(column) for column in fare.columns if column not in ("fare_amount", "vendor_id")]
    return top_rows(fare.where(F.col("vendor_id") == vendor), [F.desc("fare_amount"), *others], 1)


def rides_with_weekday_revenue(fare: DataFrame) -> DataFrame:
    """Every ride with its weekday number and the revenue of that weekday and payment type."""
    numbered = fare.withColumn("day_num", weekday_number("pickup_datetime"))
    return attach_group_total(numbered, ["day_num", "payment_type"], "total_amount", "total_revenue_per_day")


def tip_percentages(fare: DataFrame, payment_type: str = CASH) -> DataFrame:
    """Rides not paid in cash with their tip in percent of the total, per vehicle, driver and pickup."""
    return attach_group_ratio(
        fare.where(F.col("payment_type") != payment_type),
        ["medallion", "hack_license", "pickup_datetime"],
        "tip_amount",
        "total_amount",
        "tips_percentage",
        scale=100.0,
    )
