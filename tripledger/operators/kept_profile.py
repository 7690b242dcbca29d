"""Profiles kept up: sketches of each load are stored, and estimates are made of them united.

Distinct values are estimated by HyperLogLog (standard error 1.6 %), quartiles by KLL sketches: an estimate's
rank is off by at most RANK_ERROR of the rows, with a probability of 99 %. Exact forms are in ``profiling``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

# Size of a KLL sketch, and its rank error as a share of the rows.
KLL_SIZE, RANK_ERROR = 800, 0.005
HLL_BITS = 12


def add_load_profile(df: DataFrame, path: str, load: str, columns: Sequence[str] | None = None) -> None:
    """Stores one row per column for a load below ``path``: rows, nulls and the sketches; a load given again is replaced.

    All columns are read in one pass, and only sketches are shuffled. NaN is the largest number and counts as one value.
    """
    columns = list(columns or df.columns)
    wanted = [F.count(F.lit(1)).alias("rows")]
    for i, name in enumerate(columns):
        column = F.col(f"`{name}`")
        number = column.cast("double") if isinstance(df.schema[name].dataType, NumericType) else F.lit(None).cast("double")
        wanted += [
            F.count_if(column.isNull()).alias(f"{i}_nulls"),
            F.hll_sketch_agg(column.cast("string"), HLL_BITS).alias(f"{i}_distinct"),
            F.kll_sketch_agg_double(F.when(F.isnan(number), F.lit(float("inf"))).otherwise(number), KLL_SIZE).alias(f"{i}_ranks"),
            F.count_if(F.isnan(number)).alias(f"{i}_nans"),
        ]
    entries = [
        F.struct(F.lit(name).alias("column"), F.lit(isinstance(df.schema[name].dataType, NumericType)).alias("numeric"), "rows",
                 *[F.col(f"{i}_{part}").alias(part) for part in ("nulls", "nans", "distinct", "ranks")])
        for i, name in enumerate(columns)
    ]
    one = df.agg(*wanted).select(F.explode(F.array(*entries)).alias("x")).select("x.*")
    one.coalesce(1).write.mode("overwrite").parquet(f"{path}/load={load}")


def kept_profile(spark: SparkSession, path: str) -> DataFrame:
    """(column, rows, nulls, distinct, p25, p50, p75) over all loads; only sketches are read.

    Null counts as one distinct value; quartiles are null for columns that are not numbers, or have none.
    """
    united = spark.read.parquet(path).groupBy("column", "numeric").agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        F.sum("nans").alias("nans"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct"),
        F.kll_merge_agg_double("ranks").alias("ranks"),
    )
    counted = F.col("numeric") & (F.col("rows") > F.col("nulls"))

    def quartile(share: float):
        found = F.kll_sketch_get_quantile_double(F.when(counted, F.col("ranks")), F.lit(share))
        # NaN stands behind all numbers, in the place of infinity.
        return F.when((F.col("nans") > 0) & (found == float("inf")), F.lit(float("nan"))).otherwise(found)

    return united.select(
        "column",
        "rows",
        "nulls",
        (F.col("distinct") + (F.col("nulls") > 0).cast("long")).alias("distinct"),
        *[quartile(share).alias(name) for name, share in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))],
    )
