"""Best rows of a table or of each group.

A filter directly on a rank lets Spark keep only each task's own best rows per group *before* the
shuffle (``WindowGroupLimit`` in the plan), so a group that holds a third of the table sends a few
rows per task and not its whole content.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripledger.operators.totals import same_group
from tripledger.sources.scratch import store

# Rows that one source row may expand to in one step of `top_values_per_group`.
COPIES_PER_CHUNK = 100_000
# Tasks that unfold copies, at most; each then takes several chunks.
MAX_TASKS = 100_000


def max_per_group(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Rows holding the largest non-null value of their group, all ties kept.

    The maximum is taken map-side and joined back on group and value, so tied rows stay where they are
    spread. The value must be the same in every evaluation: a count or an exact sum, not a sum of doubles.
    """
    own = {name: f"_best_{name}" for name in (*group, value)}
    best = df.where(F.col(value).isNotNull()).groupBy(*group).agg(F.max(value).alias(value)).withColumnsRenamed(own)
    return df.join(best, same_group([*group, value], own), "inner").drop(*own.values())


def first_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per group: the first in the given order, which should be total to be repeatable."""
    return (
        df.withColumn("_place", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
        .where(F.col("_place") == 1)
        .drop("_place")
    )


def ranked_in_group(df: DataFrame, group: Sequence[str], by: Sequence[str], k: int, name: str = "rank") -> DataFrame:
    """Rows of rank 1 … k per group, largest first; equal rows share a rank and the next one skips (1, 1, 3).

    Rows are counted per distinct value first and only the k largest values of a group are ranked, by
    the rows above them. The ranks are then joined back, so tied rows are never brought together. The
    values must be the same in every evaluation.
    """
    own = {column: f"_level_{column}" for column in (*group, *by)}
    largest_first = Window.partitionBy(*group).orderBy(*[F.desc(column) for column in by])
    above = F.sum("_rows").over(largest_first.rowsBetween(Window.unboundedPreceding, -1))
    levels = (
        df.groupBy(*group, *by)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_place", F.row_number().over(largest_first))
        .where(F.col("_place") <= k)
        .withColumn(name, (F.coalesce(above, F.lit(0)) + 1).cast("int"))
        .where(F.col(name) <= k)
        .drop("_rows", "_place")
        .withColumnsRenamed(own)
    )
    return df.join(levels, same_group([*group, *by], own), "inner").drop(*own.values())


def top_values_per_group(
    df: DataFrame, group: Sequence[str], value: str, k: int, name: str = "rank"
) -> DataFrame:
    """Every row's (group, value) whose value is among the k largest *distinct* ones of its group.

    Ranks are dense (1, 1, 2) and each input row gives one output row, so a value shared by most rows
    of a group, such as a tip of 0, gives most rows of that group. Such rows are never brought
    together: equal ones are counted first (map-side), only distinct values are ranked, and the
    counts are unfolded again chunk by chunk, in as many tasks as there are chunks (within reason). The
    counts of the k values of each group are stored in the shared scratch folder, to know how many.
    """
    largest_first = Window.partitionBy(*group).orderBy(F.col(value).desc())
    counted = df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("_copies"))
    levels = store(counted.withColumn(name, F.dense_rank().over(largest_first)).where(F.col(name) <= k), "levels")
    n_chunks = levels.agg(F.sum(F.expr(f"(_copies - 1) div {COPIES_PER_CHUNK} + 1"))).first()[0] or 1
    size = F.lit(COPIES_PER_CHUNK)
    chunks = levels.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.expr(f"(_copies - 1) div {COPIES_PER_CHUNK}"))))
    return (
        chunks.withColumn("_rows", F.least(size, F.col("_copies") - F.col("_chunk") * size))
        .repartition(min(int(n_chunks), MAX_TASKS))
        .withColumn("_row", F.explode(F.sequence(F.lit(1), F.col("_rows"))))
        .select(*group, value, name)
    )


def top_rows(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows in the given order: each task keeps k rows, the driver merges those."""
    return df.orderBy(*order).limit(k)
