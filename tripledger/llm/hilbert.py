"""Shards as runs of a Hilbert curve through several metadata dimensions.

Each dimension is quantised to ``BITS`` bits: numbers by quantiles, so that cells hold like numbers of
rows, other values by a hash. The curve index of a cell brings rows that are near in all dimensions
near in one order. Rows are sorted by it and cut into runs of equal count, so a shard covers a small
box in every dimension, and a reader that filters on any of them skips most shards by their ranges.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, NumericType, StructField, StructType

from tripledger.llm.tables import free_name, global_positions, quoted, table

SHARDS = 24
BITS = 8
# Relative rank error of the quantiles at which numbers are cut.
QUANTILE_ERROR = 1e-3


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of cells (rows × dimensions) on the curve, by Skilling's transform."""
    x = cells.T.astype(np.uint64).copy()
    n, one = len(x), np.uint64(1)
    q = one << np.uint64(bits - 1)
    while q > one:
        p = q - one
        for i in range(n):
            set_bit = (x[i] & q) != 0
            swap = np.where(set_bit, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] ^= np.where(set_bit, p, swap)
            x[i] ^= swap
        q >>= one
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = np.zeros_like(x[0]), one << np.uint64(bits - 1)
    while q > one:
        t ^= np.where((x[n - 1] & q) != 0, q - one, np.uint64(0))
        q >>= one
    x ^= t
    index = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            index = (index << one) | ((x[i] >> np.uint64(bit)) & one)
    return index.astype(np.int64)


def _cell(df: DataFrame, name: str, bits: int) -> Column:
    """The cell of a value: 0 for null, then quantiles of numbers or a hash of anything else."""
    column = F.col(f"`{name}`")
    top = (1 << bits) - 1
    if isinstance(df.schema[name].dataType, NumericType):
        # Summaries of a fixed size are merged, whatever the table holds.
        steps = [i / top for i in range(1, top)]
        cuts = sorted(set(df.approxQuantile(name, steps, QUANTILE_ERROR) or []))
        if not cuts:
            return F.when(column.isNull(), 0).otherwise(1)
        above = F.aggregate(
            F.array(*[F.lit(float(c)) for c in cuts]), F.lit(0), lambda n, c: n + (column.cast("double") > c).cast("int")
        )
        return F.when(column.isNull(), 0).otherwise(1 + above)
    return F.when(column.isNull(), 0).otherwise(1 + F.pmod(F.xxhash64(column.cast("string")), F.lit(top)).cast("int"))


def with_curve(df: DataFrame, dimensions: Sequence[str], bits: int = BITS, name: str = "curve") -> DataFrame:
    """The rows with their place on the curve through the dimensions."""
    if bits * len(dimensions) > 62:
        raise ValueError("the curve index must fit 62 bits")
    # The row travels as one column, whatever the names in it.
    cells = df.select(F.struct(*map(quoted, df.columns)).alias("row"), F.array(*[_cell(df, d, bits).cast("long") for d in dimensions]).alias("cells"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("cells").flatten().to_numpy(zero_copy_only=False)
            index = hilbert_index(flat.reshape(-1, len(dimensions)), bits)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(index, pa.int64())], ["row", "index"])

    placed = cells.mapInArrow(place, StructType([StructField("row", df.schema), StructField("index", LongType())]))
    return placed.select("row.*", F.col("index").alias(name))


def shard_rows(df: DataFrame, dimensions: Sequence[str], order: Sequence[str], shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """The rows with ``curve``, ``shard`` and ``slot``: runs of the curve whose counts are at most one apart.

    Columns of the rows keep their names and values: one of these three that they have already is named
    ``curve_1`` and so on. ``order`` breaks ties of the curve; null values have a cell of their own. Rows that are equal in all
    of these are interchangeable. Fewer rows than shards leave shards empty. Keep ``df`` narrow.
    """
    curve, shard, slot, position = (free_name(name, df.columns) for name in ("curve", "shard", "slot", "_position"))
    placed = global_positions(with_curve(df, dimensions, bits, curve), [curve, *map(quoted, order)], position)
    n = placed.agg(F.count(F.lit(1))).first()[0]
    own = F.expr(f"{position} * {shards} div {max(1, n)}").cast("int")
    return placed.withColumn(shard, own).withColumn(slot, F.col(position) - _first(n, shards, shard)).drop(position)


def _first(n: int, shards: int, shard: str = "shard") -> Column:
    """The position of the first of n rows in the column ``shard``; the product is beyond an int for many rows."""
    return F.expr(f"(cast({shard} AS bigint) * {n} + {shards - 1}) div {shards}")


def shard_ranges(sharded: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """(shard, rows, and the least and greatest value of each dimension): what a reader prunes by."""
    ends = [f(F.col(f"`{d}`")).alias(f"{f.__name__}_{d}") for d in dimensions for f in (F.min, F.max)]
    return sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), *ends)


def write_shards(sharded: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """One folder per shard with files sorted along the curve; a shard is split over files, not a task's memory."""
    chunk = F.floor(F.col("slot") / rows_per_file)
    (
        sharded.withColumn("_chunk", chunk)
        .repartition("shard", "_chunk")
        .sortWithinPartitions("shard", "slot")
        .drop("_chunk")
        .write.partitionBy("shard")
        .parquet(path)
    )


ORACLE = {}


def op4_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of equal counts, along a curve through source, language and size."""
    text = F.col("text").cast("binary")
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit(b""))).alias("text_crc32"),
        "source",
        "lang",
    )
    sharded = shard_rows(docs, ["source", "lang", "size"], ["size", "text_crc32", "doc_id"])
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
