"""Exact duplicates by a stream whose keyed state never expires.

Arrivals are narrow records of documents: the digest of the normalised text, its length, the stable
identifier and the locator of the content (Parquet file and row). A streaming aggregation keeps, per
digest, how many arrived and the best of them; its state lies on disk (RocksDB) and in the shared
checkpoint folder, so a later run goes on where this one stopped. Spark adds up records of one digest
before they are shuffled, so a text that makes up a third of the table is no burden.

A digest seen before is only a hit. The contents of hits are read again by their locators and compared
byte by byte, those kept from earlier runs too; different texts under one digest are told apart.
"""

from __future__ import annotations

import re
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger.llm.tables import landed, rows_at, scratch_path, store, table, with_locator

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Native memory of all state stores of one executor.
STATE_MEMORY_MB = 256


def normalised(text: str = "text") -> Column:
    """The text without ASCII white space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[ \\t-\\r]+", "")


@contextmanager
def _disk_state(spark: SparkSession):
    prefix = "spark.sql.streaming.stateStore"
    wanted = {
        f"{prefix}.providerClass": PROVIDER,
        f"{prefix}.rocksdb.boundedMemoryUsage": "true",
        f"{prefix}.rocksdb.maxMemoryUsageMB": str(STATE_MEMORY_MB),
        # Many small stores: no disk space is set aside before it is used.
        f"{prefix}.rocksdb.allowFAllocate": "false",
        "spark.sql.streaming.numRecentProgressUpdates": "1",
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def records(docs: DataFrame, digest: Column | None = None) -> DataFrame:
    """One narrow record per document: digest, length in code points, doc_id, locator."""
    located = with_locator(docs, ["doc_id", "text"])
    return located.select(
        (digest if digest is not None else F.sha2(normalised(), 256)).alias("digest"),
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"),
        F.col("doc_id").cast("long").alias("doc_id"),
        "_file",
        "_row",
    )


def _rank() -> Column:
    """Smallest is best: most code points, then the smallest doc_id (none comes last), then the place."""
    return F.struct(
        (-F.col("n_chars")).alias("shorter"), F.col("doc_id").isNull().alias("unknown"), "doc_id", "_file", "_row"
    )


def absorb(spark: SparkSession, inbox: str, state: str, schema, files_per_batch: int | None = None) -> None:
    """Adds the records that came into the inbox since the last call to the state."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    seen = reader.parquet(inbox).groupBy("digest").agg(F.count(F.lit(1)).alias("copies"), F.min(_rank()).alias("best"))
    with _disk_state(spark):
        query = (
            seen.writeStream.outputMode("update")
            .option("checkpointLocation", state)
            .trigger(availableNow=True)
            .foreachBatch(lambda batch, _: batch.write.format("noop").mode("overwrite").save())
            .start()
        )
        query.awaitTermination()


def state_table(spark: SparkSession, state: str) -> DataFrame:
    """(digest, copies, best) of all digests ever seen, read from the state's files."""
    with _disk_state(spark):
        found = spark.read.format("statestore").load(state)
        return found.select("key.digest", F.col("value.count").alias("copies"), F.col("value.min").alias("best"))


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _earlier(spark: SparkSession, state: str, arrived: DataFrame) -> DataFrame | None:
    """(digest, size, best) of the classes that earlier runs left in the state, for digests that arrive again.

    The state has one entry per digest. Where several texts share it, the latest run that met the digest
    left its classes beside the state (see :func:`_remember`).
    """
    if not _exists(spark, f"{state}/commits"):
        return None
    seen = state_table(spark, state).join(arrived, "digest", "left_semi")
    seen = seen.select("digest", F.col("copies").alias("size"), "best")
    if _exists(spark, f"{state}/classes"):
        saved = spark.read.parquet(f"{state}/classes")
        latest = saved.groupBy("digest").agg(F.max("run").alias("run"))
        split = saved.join(latest, ["digest", "run"]).join(arrived, "digest", "left_semi").drop("run")
        seen = seen.join(latest, "digest", "left_anti").unionByName(split)
    return store(seen, "dedup-earlier")


def _remember(spark: SparkSession, state: str, told_apart: DataFrame) -> None:
    """Leaves the classes of digests that stand for several texts beside the state."""
    path = f"{state}/classes"
    run = spark.read.parquet(path).agg(F.max("run")).first()[0] + 1 if _exists(spark, path) else 0
    told_apart.select("digest", "size", "best", F.lit(run).alias("run")).write.mode("append").parquet(path)


def _retained(spark: SparkSession, earlier: DataFrame) -> DataFrame:
    """(digest, content, size, best): the classes of earlier runs with the texts kept for them, read by their locators."""
    files = [row[0] for row in earlier.select("best._file").distinct().collect()]
    if not files:
        return earlier.select("digest", F.lit("").alias("content"), "size", "best")
    # Names are meant as they are, not as patterns.
    kept = spark.read.schema("text string").parquet(*[re.sub(r"([][{}*?\\])", r"\\\1", file) for file in files])
    texts = with_locator(kept, [normalised().alias("content")])
    found = earlier.withColumns({"_file": F.col("best._file"), "_row": F.col("best._row")}).join(texts, ["_file", "_row"], "left")
    gone = F.raise_error(F.concat(F.lit("the text of an earlier run is gone: "), F.col("_file"), F.lit(" row "), F.col("_row")))
    return found.select("digest", F.coalesce("content", gone).alias("content"), "size", "best")


def classes_of(docs: DataFrame, arrived: DataFrame, known: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """(digest, content, size, best): texts as bytes tell classes apart where a digest has several arrivals.

    ``content`` is null where one class has the digest; only if texts differ under one digest, which a
    good digest never shows, does it hold the text to tell them apart. ``earlier`` are the classes of
    earlier runs, each of which counts with its size and its best.
    """
    hits = known.where("copies > 1").select("digest")
    hit_rows = arrived.join(hits, "digest", "left_semi")
    # Each content is fetched once by its place, whatever the size of its group.
    texts = with_locator(docs, ["text"]).select("_file", "_row", normalised().alias("content"))
    fetched = hit_rows.join(texts, ["_file", "_row"]).select("digest", "content", F.lit(1).cast("long").alias("size"), _rank().alias("best"))
    if earlier is not None:
        fetched = fetched.unionByName(_retained(docs.sparkSession, earlier))
    by_content = fetched.groupBy("digest", "content").agg(F.sum("size").alias("size"), F.min("best").alias("best"))
    compared = store(by_content.withColumn("bytes", F.sha2("content", 512)).drop("content"), "compared")
    several = compared.groupBy("digest").agg(F.count(F.lit(1)).alias("_texts"))
    marked = compared.join(several, "digest").withColumn("content", F.when(F.col("_texts") > 1, F.col("bytes")))
    single = known.where("copies = 1").select("digest", F.lit(None).cast("string").alias("content"), F.col("copies").alias("size"), "best")
    return single.unionByName(marked.select("digest", "content", "size", "best"))


def exact_dedup(
    docs: DataFrame, state: str | None = None, digest: Column | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, and its locator.

    Equal texts are identical without ASCII white space. The row with most code points stays, then the
    smallest doc_id, then the first place; a null doc_id is behind all others. Null text is empty, and
    empty texts equal each other. Rows that are repeated whole are copies. An empty table gives no row.

    With the ``state`` of earlier runs, their documents count as well: ``keep_id`` is the best of all runs,
    ``group_size`` counts all arrivals, and a row is kept only if it is better than all before it. The
    files of rows kept earlier must still be there. A row that is given again is one more arrival.
    """
    spark = docs.sparkSession
    state = state or scratch_path(spark, "dedup-state")
    # The stream goes on only with the folder that its checkpoint knows, so the inbox stays with the state.
    inbox = f"{state}/inbox"
    docs = landed(docs)
    if _exists(spark, inbox):
        arrived = store(records(docs, digest), "dedup-arrived")
        arrived.write.mode("append").parquet(inbox)
    else:
        records(docs, digest).write.parquet(inbox)
        # Its files are listed now: later runs add to the folder.
        arrived = spark.read.parquet(inbox)
    earlier = _earlier(spark, state, arrived)
    absorb(spark, inbox, state, arrived.schema, files_per_batch)
    known = state_table(spark, state)
    if earlier is not None:
        known = known.join(arrived, "digest", "left_semi")
    known = store(known, "dedup-known")
    classes = store(classes_of(docs, arrived, known, earlier), "dedup-classes")
    matched = arrived.join(classes.where("content is null").drop("content"), "digest")
    told_apart = classes.where("content is not null")
    if not told_apart.isEmpty():
        _remember(spark, state, told_apart)
        # Some digest stands for several texts: their rows are matched by their bytes too.
        doubtful = arrived.join(told_apart.select("digest").distinct(), "digest", "left_semi")
        texts = with_locator(docs, [F.sha2(normalised(), 512).alias("content")])
        found = doubtful.join(texts, ["_file", "_row"]).join(told_apart, ["digest", "content"])
        matched = matched.unionByName(found.drop("content"))
    return matched.select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("size").alias("group_size"),
        ((F.col("_file") == F.col("best._file")) & (F.col("_row") == F.col("best._row"))).alias("kept"),
        F.col("digest").alias("text_sha256"),
        "_file",
        "_row",
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """The documents without exact copies, all their columns, whatever their names. Rows: see exact_dedup."""
    docs = landed(docs)
    return rows_at(docs, exact_dedup(docs).where("kept").select("_file", "_row"))


ORACLE = {
    "op2_streaming_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents
        ), k AS (
            SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
                   count(*) OVER (PARTITION BY text_sha256) AS group_size
            FROM d
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM k
    """
}


def op2_streaming_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).drop("_file", "_row")
