"""Cleaning of raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def strip_column_names(df: DataFrame) -> DataFrame:
    """Remove blanks around the column names, in one projection."""
    return df.toDF(*[name.strip() for name in df.columns])


def clean(df: DataFrame, how: str = "all") -> DataFrame:
    """Remove exact duplicates (nulls count as equal) and empty rows.

    ``how='all'`` drops a row only when every column is null, ``'any'`` when at least one is. The row
    filter goes first and copies collapse in the map-side half of the aggregation, so a heavily
    repeated row costs one row per task in the shuffle.
    """
    return df.na.drop(how).dropDuplicates()
