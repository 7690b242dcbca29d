"""Small helpers of the operators: row identity, global positions, files in the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripledger.sources.scratch import scratch_path, store, stored_within
from tripledger.sources.settings import with_settings

__all__ = ["free_name", "global_positions", "landed", "open_folder", "quoted", "rows_at", "scratch_path", "small_batches", "store", "stored_within", "table", "with_locator"]


# Rows and bytes that a Python worker gets at once; a longer text is a batch of its own.
BATCH_ROWS, BATCH_BYTES = 1000, "4m"
# Keys for which Spark's default Bloom filter has a byte each, and those for which the largest one has.
BLOOM_KEYS = (1 << 20, 1 << 23)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Nodes of a plan that give each row of a file at most once.
_PASSING = {"Project", "Filter", "SubqueryAlias"}


def _reads_files_once(docs: DataFrame) -> bool:
    """Whether each row is one row of one Parquet file, and ``text`` is what the file has under that name."""
    plan = docs._jdf.queryExecution().analyzed()
    texts = [a for a in _items(plan.output()) if a.name() == "text"]
    while plan.nodeName() in _PASSING and plan.deterministic():
        plan = plan.children().head()
    if plan.nodeName() != "LogicalRelation" or not texts:
        return False
    stored = [a for a in _items(plan.output()) if a.name() == "text" and a.exprId().equals(texts[0].exprId())]
    try:
        docs.select(*_place(docs)).schema  # noqa: B018 - resolves the names
        paths = [path.toString() for path in _items(plan.relation().location().rootPaths())]
    except (AnalysisException, Py4JError):
        return False
    return bool(stored) and len(paths) == len(set(paths))


def _items(sequence) -> list:
    return [sequence.apply(i) for i in range(sequence.size())]


def _place(docs: DataFrame) -> list[Column]:
    metadata = docs.metadataColumn("_metadata")
    return [metadata.getField("file_path").alias("_file"), metadata.getField("row_index").alias("_row")]


def landed(docs: DataFrame) -> DataFrame:
    """The frame if it reads rows of Parquet files as they are, at most filtered, else a copy in the shared folder.

    Rows of such a frame have a place that stays: file and row in the file. Where rows may be repeated
    (explode, joins, unions), drawn, or have another text than the file, their place names no row: a copy it is.
    """
    return docs if _reads_files_once(docs) else store(docs, "landed")


def quoted(name: str) -> Column:
    """The column of that name, whatever is in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(name: str, taken: Sequence[str]) -> str:
    """The name, or the first of name_1, name_2, … that isn't taken, whatever the case."""
    lower = {other.lower() for other in taken}
    names = [name, *(f"{name}_{i}" for i in range(1, len(lower) + 2))]
    return next(other for other in names if other.lower() not in lower)


def with_locator(docs: DataFrame, columns: Sequence[Column | str]) -> DataFrame:
    """The columns and ``_file``, ``_row``, the place of the row's content; for a :func:`landed` frame."""
    return docs.select(*columns, *_place(docs))


def rows_at(docs: DataFrame, places: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows of a :func:`landed` frame whose place is, or with ``left_anti`` isn't, among (_file, _row).

    All columns are kept, whatever their names: they travel as one.
    """
    whole = with_locator(docs, [F.struct(*map(quoted, docs.columns)).alias("_whole")])
    return whole.join(places, ["_file", "_row"], how).select("_whole.*")


def joined_at(docs: DataFrame, columns: Sequence[Column | str], places: DataFrame, name: str) -> DataFrame:
    """The columns of the rows of a :func:`landed` frame at the given (_file, _row), with what else ``places`` has; stored.

    For places that are few beside the rows: Spark's runtime Bloom filter keeps most other rows out of the shuffle.
    It is asked for whatever the size of the scan, with room for all ``places``, which are counted: keep them stored.
    """
    key = F.xxhash64("_file", "_row").alias("_place")
    rows = with_locator(docs, columns).withColumn("_place", key)
    # The filter is made of a side that is itself filtered.
    few = places.withColumn("_place", key).where("_row >= 0").withColumnsRenamed({"_file": "_file_of", "_row": "_row_of"})
    same = (F.col("_file") == F.col("_file_of")) & (F.col("_row") == F.col("_row_of"))
    found = rows.join(few, "_place").where(same).drop("_place", "_file_of", "_row_of")
    with bloom_filtered(docs.sparkSession, places.count()):
        return store(found, name)


def bloom_filtered(spark: SparkSession, keys: int = 0):
    """Joins planned within get Spark's runtime Bloom filter where one side is filtered and below 1 GB.

    It has 1 MB by Spark's defaults, and a byte for each of ``keys`` beyond a million: 1 of 40 other rows then passes.
    From 8 MB on (Spark's bound is as much) it fills up: more other rows pass, and results stay right.
    """
    wanted = {"enabled": "true", "applicationSideScanSizeThreshold": "0", "creationSideThreshold": "1g"}
    if keys > BLOOM_KEYS[0]:
        keys = min(keys, BLOOM_KEYS[1])
        wanted |= {"expectedNumItems": str(keys), "maxNumItems": str(keys), "numBits": str(8 * keys), "maxNumBits": str(8 * keys)}
    return with_settings(spark, {f"spark.sql.optimizer.runtime.bloomFilter.{key}": value for key, value in wanted.items()})


def small_batches(spark: SparkSession):
    """Within it, Python workers get texts in batches of some MB instead of 10,000 rows: plan and run the work inside.

    A worker and its task hold a batch several times over, as rows, Arrow buffers, strings and results.
    """
    return with_settings(
        spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS), "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES}
    )


def global_positions(df: DataFrame, order: Sequence[Column | str], name: str = "position") -> DataFrame:
    """The rows with their place 0, 1, … in the given order, which should be total.

    Rows are range-partitioned and sorted, counted by partition, and shifted by the rows before their
    partition: the only window without keys works on one row per partition. Keep ``df`` narrow: it is
    stored once.
    """
    low = F.lit((1 << 33) - 1)
    part, at, shift = (free_name(own, df.columns) for own in ("_part", "_at", "_shift"))
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias(part), F.monotonically_increasing_id().bitwiseAND(low).alias(at))
    )
    kept = store(placed, "positions")
    counts = kept.groupBy(part).agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(part, F.coalesce(F.sum("rows").over(before), F.lit(0)).alias(shift))
    # One row per partition.
    return kept.join(F.broadcast(shifts), part).withColumn(name, F.col(at) + F.col(shift)).drop(part, at, shift)


def open_folder(uri: str):
    """(filesystem, path) of a folder that all executors reach; made if missing."""
    from pyarrow import fs

    filesystem, path = fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")
    filesystem.create_dir(path, recursive=True)
    return filesystem, path


def temporary_name(name: str) -> str:
    return f".{name}.{uuid.uuid4().hex}"
