"""Group totals kept up: partial sums of each load are stored, and totals are made of them.

A load's partial sums are one row per group. They hold whole units and decimals (see ``functions.total``),
whose sums don't depend on order, so totals over loads are what one pass over all rows gives, to the bit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger.functions.numbers import total_of, total_parts


def add_load(df: DataFrame, path: str, load: str, by: Sequence[str], sums: Mapping[str, str]) -> None:
    """Stores the partial sums of one load below ``path``: rows per group, and the parts of each ``{name: column}``.

    A load that is given again replaces what it left before, so a failed call can be made again.
    """
    parts = [part.alias(f"{name}__{i}") for name, column in sums.items() for i, part in enumerate(total_parts(column))]
    counted = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"), *parts)
    counted.write.mode("overwrite").parquet(f"{path}/load={load}")


def kept_totals(spark: SparkSession, path: str, by: Sequence[str], sums: Sequence[str], rows: str | None = None) -> DataFrame:
    """Total of each name per group over all loads, as ``functions.total`` over their rows; the rows as ``rows`` if named.

    Only partial sums are read. Null keys are a group.
    """
    stored = spark.read.parquet(path)
    merged = [
        F.sum(f"{name}__{i}").alias(f"{name}__{i}") for name in sums for i in range(len(total_parts(name)))
    ]
    added = stored.groupBy(*by).agg(F.sum("_rows").alias("_rows"), *merged)
    totals = [total_of([F.col(f"{name}__{i}") for i in range(len(total_parts(name)))]).alias(name) for name in sums]
    return added.select(*by, *([F.col("_rows").alias(rows)] if rows else []), *totals)
