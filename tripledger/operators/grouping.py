"""Per-group summaries. All shrink map-side before their only shuffle."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripledger.functions import day_string, in_days, percent_text, whole_units
from tripledger.functions import total as sum_of
from tripledger.functions import weight as factor
from tripledger.sources.scratch import store


def share_of_group(
    df: DataFrame, by: Sequence[str], condition: Column, total: str, selected: str, percentage: str
) -> DataFrame:
    """Rows per group, rows meeting the condition, and their share in percent as text."""
    counted = df.groupBy(*by).agg(F.count(F.lit(1)).alias(total), F.count_if(condition).alias(selected))
    return counted.withColumn(percentage, percent_text(selected, total))


def sum_by_day(
    df: DataFrame,
    by: Sequence[str],
    moment: str,
    value: str,
    first: dt.date,
    last: dt.date,
    name: str,
    day: str = "date",
) -> DataFrame:
    """Sum per group and day over the days first … last, both included."""
    return (
        df.where(in_days(df, moment, first, last))
        .groupBy(*by, F.to_date(moment).alias(day))
        .agg(sum_of(value).alias(name))
        .withColumn(day, day_string(day))
    )


def above_group_mean(df: DataFrame, group: str, value: str, weight: str, name: str) -> DataFrame:
    """Per group, the summed weight of rows whose value exceeds the group's weighted mean.

    Rows are first added up to one per distinct (group, value). This small table is needed twice, for
    the means and for the comparison, so one job stores it in the shared scratch folder, when the frame
    is made: what lies below, usually a large join, then runs once. Values of whole units are compared as
    whole numbers and without a division, so a value equal to the mean is never above it; in a group with
    any other value (long fractions, NaN) doubles are compared, with a total that doesn't depend on the
    order of rows. Null groups are dropped; a group without any value above its mean gives no row.
    """
    counted = df.where(F.col(group).isNotNull()).groupBy(group, value).agg(F.sum(factor(weight)).alias("_weight"))
    histogram = store(counted.withColumn("_units", whole_units(value).cast("decimal(18,0)")), "histogram")
    known = histogram.where(F.col(value).isNotNull())
    totals = known.groupBy(group).agg(
        F.sum(F.col("_units") * F.col("_weight")).alias("_whole"),
        sum_of(F.col(value) * F.col("_weight").cast("double")).alias("_total"),
        F.sum("_weight").alias("_all"),
        F.count("_units").alias("_n_units"),
        F.count(F.lit(1)).alias("_n"),
    )
    above = F.when(F.col("_n_units") == F.col("_n"), F.col("_units") * F.col("_all") > F.col("_whole")).otherwise(
        F.col(value) * F.col("_all").cast("double") > F.col("_total")
    )
    return (
        known.join(totals, group, "inner")
        .where(above)
        .groupBy(group)
        .agg(F.sum("_weight").cast("long").alias(name))
    )
