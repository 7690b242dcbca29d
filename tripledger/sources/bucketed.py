"""Clean copies that lie together: tables in buckets of the ride keys, joined without a shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger.sources.parquet_tables import read_parquet
from tripledger.sources.settings import with_settings

# Keys that all joins of fares and trips have: what is dealt out by these is dealt out by all of them.
DRIVER_PICKUP = ("hack_license", "pickup_datetime")
# Rows of one key, in units of a bucket's share, above which buckets would leave it to one task.
LARGEST = 4.0
# Rows of a bucket; a join takes a bucket of either table in one task.
BUCKET_ROWS = 250_000
# The most that Spark takes by default.
MAX_BUCKETS = 100_000


def _largest_key(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """The rows of the most frequent key (null included), and all rows."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("most"), F.sum("n").alias("rows")).first()
    return counts["most"] or 0, counts["rows"] or 0


def _even(most: int, rows: int, buckets: int, largest: float = LARGEST) -> bool:
    return not rows or most <= max(1.0, largest * rows / buckets)


def even_keys(df: DataFrame, keys: Sequence[str], buckets: int, largest: float = LARGEST) -> bool:
    """Whether no key (null included) has more than ``largest`` times the rows of an even bucket."""
    return _even(*_largest_key(df, keys), buckets, largest)


def enough_buckets(rows: int, least: int) -> int:
    """As many buckets as leave each about BUCKET_ROWS rows at most, and no fewer than ``least``."""
    return max(least, min(-(-rows // BUCKET_ROWS), MAX_BUCKETS))


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int, mode: str = "errorifexists") -> DataFrame:
    """Store the frame at ``path`` as a table of the catalog, one sorted file per bucket of the keys."""
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode(mode).option("path", path).bucketBy(buckets, *keys).sortBy(*keys).format("parquet").saveAsTable(table)
    return df.sparkSession.table(table)


def open_bucketed(spark: SparkSession, table: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """A table stored by :func:`write_bucketed`, made known to another session's catalog."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read_parquet(spark, path).schema.fields)
    names = ", ".join(f"`{key}`" for key in keys)
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({names}) SORTED BY ({names}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(table)


def co_locate(
    fare: DataFrame, trip: DataFrame, folder: str, name: str, buckets: int, keys: Sequence[str] = DRIVER_PICKUP
) -> tuple[DataFrame, DataFrame]:
    """Copies of both tables in equal buckets, as tables ``<name>_fare`` and ``<name>_trip`` below the folder.

    ``buckets`` is their least number: as a bucket is one task's, there are more where the larger table would
    have more than BUCKET_ROWS rows in each. A key with very many rows can't be split within a bucket; where a
    table has one, both are returned as they are, and joins shuffle and split it at run time. Ask questions of
    the copies within :func:`co_located`.
    """
    known = [_largest_key(df, keys) for df in (fare, trip)]
    larger = max(rows for _, rows in known)
    enough = enough_buckets(larger, buckets)
    if not all(_even(most, rows, buckets) and _even(most, larger, enough) for most, rows in known):
        return fare, trip
    buckets = enough
    return tuple(write_bucketed(df, f"{name}_{side}", f"{folder}/{side}", keys, buckets) for df, side in ((fare, "fare"), (trip, "trip")))


def co_located(spark: SparkSession):
    """Within it, joins on more than the bucket keys keep the buckets: plan and run the questions inside."""
    return with_settings(
        spark,
        {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"},
    )
