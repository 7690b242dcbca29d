"""Totals of a group written onto each of its rows, without gathering a large group in one task.

Groups are summed first, which shrinks map-side, and the sums are joined back on the group's keys,
where null equals null. Null-safe keys are expressions of their own, so the join shuffles both sides
by them and can split a large group's rows over many tasks at run time; and where the sums turn out
small, Spark broadcasts them instead.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripledger.functions import ratio, total
from tripledger.sources.scratch import store


def same_group(keys: Sequence[str], other: Mapping[str, str]) -> Column:
    """Equality of each key with its other name, where null equals null."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(other[key]))
    return condition


def attach_group_total(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Each row with the total of ``value`` over its group, as double; null keys form groups too.

    For keys with few groups. The totals are stored in the shared scratch folder by one job, run when
    the frame is made (see ``scratch_owner`` for their lifetime). Spark thus knows their size when it
    plans the join: small ones are broadcast and no row of ``df`` is moved; beyond Spark's broadcast
    threshold both sides are shuffled, and large groups split at run time.
    """
    own = {key: f"_total_{key}" for key in keys}
    totals = df.groupBy(*keys).agg(total(value).alias(name)).withColumnsRenamed(own)
    return df.join(store(totals, "totals"), same_group(keys, own), "left").drop(*own.values())


def attach_group_sums(df: DataFrame, keys: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    """Add ``{new column: summed column}`` totals over the row's group; null keys form groups too.

    One way for groups of any number and size: see the module's description.
    """
    own = {key: f"_group_{key}" for key in keys}
    totals = df.groupBy(*keys).agg(*[total(column).alias(name) for name, column in sums.items()])
    return df.join(totals.withColumnsRenamed(own), same_group(keys, own), "left").drop(*own.values())


def attach_group_ratio(
    df: DataFrame, keys: Sequence[str], part: str, whole: str, name: str, scale: float = 1
) -> DataFrame:
    """Each row with scale · sum(part) / sum(whole) over its group; null where the divisor is 0."""
    summed = attach_group_sums(df, keys, {"_part": part, "_whole": whole})
    share = ratio("_part", "_whole")
    return summed.withColumn(name, share * F.lit(scale)).drop("_part", "_whole")
