"""Column profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType, TimestampNTZType, TimestampType

from tripledger.sources.scratch import store

QUARTILES = (0.25, 0.5, 0.75)
QUARTILE_NAMES = ("p25", "p50", "p75")


def profile(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    exact_distinct: bool = True,
    quartiles: bool = True,
    accuracy: int | None = None,
) -> DataFrame:
    """One row per column: type, rows, nulls, distinct, min, max, mean, stddev, p25, p50, p75.

    ``min`` and ``max`` are text; mean, deviation and quartiles are null for columns that are not
    numbers. Null counts as one distinct value. ``quartiles=False`` leaves the three quartile columns
    out.

    Everything but exact distinct counts and exact quartiles comes from one aggregation without a
    shuffle of rows. Exact distinct counts take one more pass for all columns, exact quartiles another
    for all numeric ones; ``exact_distinct=False`` and an ``accuracy`` ask for estimates from the first
    pass instead (HyperLogLog; quartiles off by at most rows / accuracy ranks).
    """
    columns = list(columns or df.columns)
    kinds = {name: df.schema[name].dataType for name in columns}
    estimated = accuracy if quartiles and accuracy else 0
    wanted = [
        part.alias(f"{i}_{label}")
        for i, name in enumerate(columns)
        for label, part in _statistics(name, kinds[name], exact_distinct, estimated).items()
    ]
    # One row with a struct per column, turned into one row per column.
    entries = [_entry(i, name, kinds[name], exact_distinct, bool(estimated)) for i, name in enumerate(columns)]
    found = (
        df.agg(F.count(F.lit(1)).alias("rows"), *wanted)
        .select(F.explode(F.array(*entries)).alias("entry"))
        .select("entry.*")
    )
    # One row per profiled column on both sides of either join.
    if not exact_distinct:
        joined = found
    else:
        head = ["column", "type", "rows", "nulls"]
        joined = found.join(F.broadcast(distinct_counts(df, columns)), "column", "left").select(
            *head,
            F.coalesce("distinct", F.lit(0)).alias("distinct"),
            *[name for name in found.columns if name not in head],
        )
    if not quartiles or estimated:
        return joined
    numeric = [name for name in columns if isinstance(kinds[name], NumericType)]
    if not numeric:
        return joined.select("*", *[F.lit(None).cast("double").alias(name) for name in QUARTILE_NAMES])
    return joined.join(F.broadcast(exact_quartiles(df, numeric)), "column", "left")


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, distinct): exact number of different values, null being one; in one pass over the table.

    Every value becomes a row with its column's name and one slot per type, all but its own empty. No
    row for any column of an empty table.
    """
    names = list(columns or df.columns)
    types: list[DataType] = []
    for name in names:
        if df.schema[name].dataType not in types:
            types.append(df.schema[name].dataType)
    slots = [f"_{i}" for i in range(len(types))]

    def entry(name: str) -> Column:
        own = df.schema[name].dataType
        values = [F.col(f"`{name}`") if kind == own else F.lit(None).cast(kind) for kind in types]
        return F.struct(F.lit(name).alias("column"), *[v.alias(s) for v, s in zip(values, slots, strict=True)])

    values = df.select(F.explode(F.array(*[entry(name) for name in names])).alias("_value")).select("_value.*")
    return values.groupBy("column", *slots).agg(F.lit(1)).groupBy("column").agg(F.count(F.lit(1)).alias("distinct"))


def exact_quartiles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, p25, p50, p75) of numeric columns, as doubles: the value at rank ceil(share · values); null without values.

    Equal values are counted, and the distinct ones range-partitioned by column and value and stored.
    Totals by partition tell in which one a rank lies; only there values are counted through in order.
    No task holds more than one range of distinct values, and the totals are one row per range.
    """
    numbers = df.select(*[F.col(f"`{name}`").cast("double").alias(name) for name in columns])
    values = numbers.unpivot([], list(columns), "column", "value").where(F.col("value").isNotNull())
    counts = values.groupBy("column", "value").agg(F.count(F.lit(1)).alias("_rows"))
    ranged = counts.repartitionByRange("column", "value").withColumn("_range", F.spark_partition_id())
    kept = store(ranged, "value-counts")
    in_order = Window.partitionBy("column").orderBy("_range")
    totals = kept.groupBy("column", "_range").agg(F.sum("_rows").alias("_in_range"))
    placed = totals.select(
        "column",
        "_range",
        (F.sum("_in_range").over(in_order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_in_range")).alias("_before"),
        F.sum("_in_range").over(in_order.rowsBetween(Window.unboundedPreceding, 0)).alias("_until"),
        F.sum("_in_range").over(Window.partitionBy("column")).alias("_all"),
    )
    ranks = F.array(*[F.struct(F.lit(n).alias("name"), F.greatest(F.lit(1), F.ceil(F.lit(q) * F.col("_all"))).alias("rank")) for n, q in zip(QUARTILE_NAMES, QUARTILES, strict=True)])
    wanted = (
        placed.withColumn("_rank", F.explode(ranks))
        .where((F.col("_rank.rank") > F.col("_before")) & (F.col("_rank.rank") <= F.col("_until")))
        .select("column", "_range", "_before", "_rank")
    )
    # Three rows per column.
    inside = kept.join(F.broadcast(wanted), ["column", "_range"])
    through = F.sum("_rows").over(
        Window.partitionBy("column", "_range", "_rank.name").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    )
    reached = inside.withColumn("_through", F.col("_before") + through).where(F.col("_through") >= F.col("_rank.rank"))
    least = {name: F.min(F.when(F.col("_rank.name") == name, F.col("value"))).alias(name) for name in QUARTILE_NAMES}
    return reached.groupBy("column").agg(*least.values())


def _statistics(name: str, kind: DataType, exact_distinct: bool, accuracy: int) -> dict[str, Column]:
    column = F.col(f"`{name}`")
    found = {"nulls": F.count_if(column.isNull()), "min": F.min(column), "max": F.max(column)}
    if not exact_distinct:
        found["distinct"] = F.approx_count_distinct(column) + F.coalesce(F.max(column.isNull().cast("int")), F.lit(0))
    if isinstance(kind, NumericType):
        found |= {"mean": F.avg(column), "stddev": F.stddev(column)}
        if accuracy:
            found["quartiles"] = F.percentile_approx(column, list(QUARTILES), accuracy)
    return found


def _entry(i: int, name: str, kind: DataType, exact_distinct: bool, quartiles: bool) -> Column:
    def value(label: str) -> Column:
        return F.col(f"{i}_{label}")

    numeric = isinstance(kind, NumericType)
    nothing = F.lit(None).cast("double")
    fields = [
        F.lit(name).alias("column"),
        F.lit(kind.simpleString()).alias("type"),
        F.col("rows"),
        value("nulls").alias("nulls"),
        *([] if exact_distinct else [value("distinct").alias("distinct")]),
        _text(value("min"), kind).alias("min"),
        _text(value("max"), kind).alias("max"),
        (value("mean").cast("double") if numeric else nothing).alias("mean"),
        (value("stddev") if numeric else nothing).alias("stddev"),
    ]
    if quartiles:
        for j, label in enumerate(QUARTILE_NAMES):
            fields.append((value("quartiles")[j].cast("double") if numeric else nothing).alias(label))
    return F.struct(*fields)


def _text(value: Column, kind: DataType) -> Column:
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.date_format(value, "yyyy-MM-dd HH:mm:ss")
    return value.cast("string")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value; null is a value."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def null_rows(df: DataFrame, column: str) -> DataFrame:
    """Whole rows whose column is null."""
    return df.where(F.col(column).isNull())
