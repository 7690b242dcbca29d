"""Matching the fare and the trip side of a ride.

``match_rides`` gives the matched rows. The questions only need sums and counts over them, so they
use ``fold``: each side is first reduced to one row per key (and per column it is grouped by later)
with a count of the rows behind it, then the reduced sides are joined. A total over the matched rows
is the total of one side times the row count of the other. Repeated keys thus never multiply, and a
key repeated millions of times already shrinks in the map-side half of the aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripledger.functions import total
from tripledger.schema import RIDE_KEYS


def match_rides(
    fare: DataFrame,
    trip: DataFrame,
    keys: Sequence[str] = RIDE_KEYS,
    fare_columns: Sequence[str] | None = None,
    trip_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Inner join on equal, non-null keys; the keys appear once, repeated keys match each other all.

    Both sides are cut to the wanted columns first. By default the trip side gives only columns the
    fare side lacks, so no name is ambiguous afterwards.
    """
    if fare_columns is None:
        fare_columns = [c for c in fare.columns if c not in keys]
    if trip_columns is None:
        trip_columns = [c for c in trip.columns if c not in keys and c not in fare_columns]
    return fare.select(*keys, *fare_columns).join(trip.select(*keys, *trip_columns), list(keys), "inner")


def fold(df: DataFrame, by: Sequence[str], rows: str, *aggregates: Column) -> DataFrame:
    """One row per key with its aggregates and, as ``rows``, the number of rows behind it."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(rows), *aggregates)


def join_folded(fare: DataFrame, trip: DataFrame, keys: Sequence[str] = RIDE_KEYS) -> DataFrame:
    """Join two folded sides on equal, non-null keys."""
    return fare.join(trip, list(keys), "inner")


def ratio_of_sums(df: DataFrame, by: Sequence[str], part: Column, whole: Column, name: str) -> DataFrame:
    """sum(part) / sum(whole) per group; null where the divisor is 0."""
    return df.groupBy(*by).agg(F.try_divide(total(part), total(whole)).alias(name))
