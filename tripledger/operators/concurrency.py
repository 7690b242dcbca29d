"""How many intervals run at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tripledger.functions import day_string

# Rows whose starts and ends are chained in one task; tasks at least.
TASK_ROWS, LEAST_TASKS = 500_000, 8


def net_change_per_instant(df: DataFrame, start: str, end: str) -> DataFrame:
    """(instant, net): starts minus ends at each instant. Null starts and ends are left out.

    Both columns of a row are unfolded in one pass over the table.
    """
    step = F.when(F.col("_event") == start, 1).otherwise(-1)
    return (
        df.unpivot([], [start, end], "_event", "instant")
        .where(F.col("instant").isNotNull())
        .groupBy("instant")
        .agg(F.sum(step).alias("net"))
    )


def peak_net_change(df: DataFrame, start: str, end: str, name: str) -> DataFrame:
    """Per day, the largest net change at any single instant."""
    return (
        net_change_per_instant(df, start, end)
        .groupBy(F.to_date("instant").alias("day"))
        .agg(F.max("net").alias(name))
        .withColumn("day", day_string("day"))
    )


def peak_concurrency(df: DataFrame, start: str, end: str, name: str) -> DataFrame:
    """Per day, the largest number of intervals running just after any start or end of that day.

    Intervals are half-open; an end before its start is taken as it is. A running count over all
    instants would need them in one task. Instead each stretch of time is reduced to its net change
    and its peak counted from its own beginning, and stretches are chained: instants within a second
    (at most 1,000,000, timestamps being in microseconds), seconds within a day (at most 86,400), and
    days (at most the length of the calendar) in the only unpartitioned window. A day holding a third
    of all rides is hence still worked on by many tasks.

    Rows are counted first, by a job of its own: seconds and days are dealt to as many tasks as the rows
    ask for, whatever the session's partitions and however well their shuffles compress.
    """
    tasks = max(LEAST_TASKS, -(-df.count() // TASK_ROWS))
    # date_trunc would turn timestamp_ntz into timestamp, so the fraction is taken off instead.
    fraction = F.extract(F.lit("SECOND"), "instant") - F.second("instant")
    second = F.col("instant") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), fraction)
    instants = net_change_per_instant(df, start, end).withColumn("_second", second).repartition(tasks, "_second")
    within_second = Window.partitionBy("_second").orderBy("instant")
    seconds = (
        instants.withColumn("_level", F.sum("net").over(within_second.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("_second")
        .agg(F.sum("net").alias("_net"), F.max("_level").alias("_peak"))
    )
    days = _chain(
        seconds.withColumn("day", F.to_date("_second")).repartition(tasks, "day"), Window.partitionBy("day").orderBy("_second")
    ).groupBy("day").agg(F.sum("_net").alias("_net"), F.max("_peak").alias("_peak"))
    return _chain(days, Window.orderBy("day")).select(day_string("day").alias("day"), F.col("_peak").alias(name))


def _chain(stretches: DataFrame, order: WindowSpec) -> DataFrame:
    """Raise each stretch's peak by the net change of all stretches before it."""
    before = F.sum("_net").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return stretches.withColumn("_peak", F.coalesce(before, F.lit(0)) + F.col("_peak"))
