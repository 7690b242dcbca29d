"""Calendar expressions. All accept ``timestamp`` and ``timestamp_ntz`` columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spark numbers weekdays from 1 = Sunday.
WEEKDAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
WORKING_DAYS = (2, 3, 4, 5, 6)


def weekday_number(moment: Column | str) -> Column:
    """1 = Sunday … 7 = Saturday."""
    return F.dayofweek(moment)


def weekday_name(number: Column | str) -> Column:
    """English name of a weekday number; null stays null.

    Group on the number and name the few groups afterwards: no text is then made per ride.
    """
    number = F.col(number) if isinstance(number, str) else number
    # Not element_at: on an array without nulls it takes its result for never null, even for a null index.
    return F.get(F.array(*[F.lit(name) for name in WEEKDAY_NAMES]), number - 1)


def day_string(day: Column | str) -> Column:
    """``yyyy-MM-dd``. Like :func:`weekday_name`, best applied to grouped dates."""
    return F.date_format(day, "yyyy-MM-dd")


def day_type(moment: Column | str, working_days: Sequence[int] = WORKING_DAYS) -> Column:
    """``weekday`` or ``weekend``; a null moment counts as ``weekend``."""
    return F.when(F.dayofweek(moment).isin(*working_days), "weekday").otherwise("weekend")


def in_days(df: DataFrame, moment: str, first: dt.date, last: dt.date) -> Column:
    """Moment falls on one of the days first … last, both included.

    A half-open range on the bare column, with bounds in the column's own type, so that the filter
    reaches the Parquet scan.
    """
    kind = df.schema[moment].dataType
    start = F.lit(f"{first.isoformat()} 00:00:00").cast(kind)
    stop = F.lit(f"{(last + dt.timedelta(days=1)).isoformat()} 00:00:00").cast(kind)
    return (F.col(moment) >= start) & (F.col(moment) < stop)
