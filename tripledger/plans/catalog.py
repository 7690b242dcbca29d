"""All questions by name."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tripledger.plans import fares, rides, trips


@dataclass(frozen=True)
class Question:
    """A function from the named input tables (``fare``, ``trip`` or both, in this order) to a result."""

    inputs: tuple[str, ...]
    answer: Callable[..., DataFrame]

    def __call__(self, fare: DataFrame, trip: DataFrame, **options: object) -> DataFrame:
        tables = {"fare": fare, "trip": trip}
        return self.answer(*[tables[name] for name in self.inputs], **options)


def _on(*inputs: str) -> Callable[[Callable[..., DataFrame]], Question]:
    return lambda answer: Question(inputs, answer)


_fare, _trip, _both = _on("fare"), _on("trip"), _on("fare", "trip")

QUESTIONS: dict[str, Question] = {
    "busiest_weekdays": _trip(trips.busiest_weekdays),
    "revenue_by_vendor": _fare(fares.revenue_by_vendor),
    "mean_distance_by_passengers": _trip(trips.mean_distance_by_passengers),
    "simultaneous_trips": _trip(trips.simultaneous_trips),
    "highest_total_by_vendor": _fare(fares.highest_total_by_vendor),
    "rides_by_rate_code": _both(rides.rides_by_rate_code),
    "best_tip_weekday": _fare(fares.best_tip_weekday),
    "mean_fare_by_payment_type": _fare(fares.mean_fare_by_payment_type),
    "top_drivers_by_vendor": _both(rides.top_drivers_by_vendor),
    "long_trip_share": _trip(trips.long_trip_share),
    "top_cash_tips": _fare(fares.top_cash_tips),
    "rides_by_day_type": _fare(fares.rides_by_day_type),
    "tips_above_fare": _fare(fares.tips_above_fare),
    "earnings_by_day": _fare(fares.earnings_by_day),
    "driver_of_each_day": _both(rides.driver_of_each_day),
    "fare_per_second_by_vendor": _both(rides.fare_per_second_by_vendor),
    "top_vendor_by_payment_type": _fare(fares.top_vendor_by_payment_type),
    "top_drivers_by_time": _trip(trips.top_drivers_by_time),
    "most_popular_payment_type": _fare(fares.most_popular_payment_type),
    "highest_fare": _fare(fares.highest_fare),
    "top_totals_of_large_parties": _both(rides.top_totals_of_large_parties),
    "rides_with_weekday_revenue": _fare(fares.rides_with_weekday_revenue),
    "tip_percentages": _fare(fares.tip_percentages),
    "mean_duration_by_rate_code": _trip(trips.mean_duration_by_rate_code),
}

# What the titles of four of the questions promise, where the question itself computes something else.
VARIANTS: dict[str, Question] = {
    "peak_concurrency": _trip(trips.peak_concurrency),
    "trips_above_mean_tip": _both(rides.trips_above_mean_tip),
    "best_tip_weekday_numeric": _fare(fares.best_tip_weekday_numeric),
    "top_drivers_by_vendor_numeric": _both(rides.top_drivers_by_vendor_numeric),
}

# Questions that also work on a stored `rides.ride_totals` table, given as ``totals``.
ON_RIDE_TOTALS = ("rides_by_rate_code", "driver_of_each_day", "fare_per_second_by_vendor")
