"""Parquet source and sink, and the cleaned copy the questions run on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger.operators.cleaning import clean


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists", rows_per_file: int | None = None) -> None:
    writer = df.write.mode(mode)
    (writer.option("maxRecordsPerFile", rows_per_file) if rows_per_file else writer).parquet(path)


def materialize(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    how: str = "all",
    cluster_by: Sequence[str] = (),
    partitions: int | None = None,
    rows_per_file: int | None = None,
) -> DataFrame:
    """Clean a raw table once, store it as Parquet and return the stored table.

    Removing duplicates needs every column of every row. Done in front of each question it would also
    stop column pruning, so it is done once here; questions on the copy then read only their columns.

    ``cluster_by`` range-partitions and sorts the copy, so that row-group statistics let range filters
    skip files. A hash of the row is the last range column: cleaned rows all differ, so even a value
    (or null) that fills a third of the table is split over many tasks.

    ``partitions`` is the number of ranges, and of files at least (default: Spark's shuffle partitions,
    merged where small); a task begins another file after ``rows_per_file`` rows.
    """
    cleaned = clean(df, how=how)
    if cluster_by:
        row_hash = F.xxhash64(*cleaned.columns)
        ranges = [partitions] if partitions else []
        cleaned = cleaned.repartitionByRange(*ranges, *cluster_by, row_hash).sortWithinPartitions(*cluster_by)
    elif partitions:
        cleaned = cleaned.repartition(partitions)
    write_parquet(cleaned, path, mode=mode, rows_per_file=rows_per_file)
    return df.sparkSession.read.schema(cleaned.schema).parquet(path)
