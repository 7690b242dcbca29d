"""Cleaning of arrivals: new rows are added to a clean copy without cleaning it again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripledger.sources.parquet_tables import write_parquet


def add_arrivals(df: DataFrame, path: str, cluster_by: Sequence[str], how: str = "all") -> DataFrame:
    """Adds the cleaned rows of ``df`` that the copy at ``path`` lacks, and returns the whole copy.

    The copy is one that ``materialize`` made with the same first ``cluster_by`` column and columns. Only
    its rows in the range of the arrivals' values of that column are read (nulls too if arrivals have
    them), which the copy's order lets the scan skip to. Rows are the same if all columns are, null
    equal to null. Arrivals are grouped by all columns together with those rows, so repeated and known ones
    go in one shuffle, to whose map side copies collapse. A call that is repeated adds nothing, so one
    that failed can be made again. Several calls leave what one call of ``materialize`` over all rows does.
    """
    spark, names = df.sparkSession, df.columns
    arrived = df.na.drop(how)
    first = cluster_by[0]
    low, high, nulls = arrived.agg(F.min(first), F.max(first), F.count_if(F.col(first).isNull())).first()
    stored = spark.read.schema(arrived.schema).parquet(path)
    within: Column = F.col(first).between(F.lit(low), F.lit(high)) if low is not None else F.lit(False)
    within = within | F.col(first).isNull() if nulls else within
    met = stored.where(within)
    # The frame is read for its range and for its rows: it must be the same both times.
    same = F.assert_true(F.coalesce(within, F.lit(False)), "the arrivals changed while they were read").isNull()
    both = arrived.where(same).select(*names, F.lit(False).alias("_stored")).unionAll(met.select(*names, F.lit(True)))
    fresh = both.groupBy(*names).agg(F.max("_stored").alias("_stored")).where("not _stored").drop("_stored")
    ordered = fresh.repartitionByRange(*cluster_by, F.xxhash64(*names)).sortWithinPartitions(*cluster_by)
    write_parquet(ordered, path, mode="append")
    return spark.read.schema(arrived.schema).parquet(path)
