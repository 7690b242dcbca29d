"""Importance resampling towards a target text.

Two bag-of-n-grams models over hashed words and word pairs are counted: one from target texts, one
from all raw texts. A document's log weight is the sum, over its n-grams, of the log ratio of the two.
Adding independent Gumbel noise and taking the k largest draws k documents without replacement in
proportion to their weights. The noise is a hash of the document, so a lost task draws it again alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger.llm.shingles import mix, word_hashes, windows
from tripledger.llm.tables import bloom_filtered, landed, store, table, with_locator

# Hash buckets of a model: the size of all that is sent to tasks and the driver.
BUCKETS = 10_000
SMOOTHING = 1.0
SEED = 17


def ngram_buckets(words: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """Buckets of a text's words and word pairs, one for each occurrence."""
    if not len(words):
        return np.zeros(0, np.int64)
    pairs = windows(words, 2) if len(words) > 1 else np.zeros(0, np.uint64)
    return (np.concatenate([mix(words), pairs]) % np.uint64(buckets)).astype(np.int64)


def model_counts(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(target, bucket, n): occurrences in all rows, by the flag ``target``; one row of each per task is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, buckets), np.int64)
        for batch in batches:
            flags = batch.column("target").to_pylist()
            for flag, words in zip(flags, word_hashes(batch.column("text").to_pylist()), strict=True):
                totals[int(bool(flag))] += np.bincount(ngram_buckets(words, buckets), minlength=buckets)
        flag, bucket = np.nonzero(totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array(flag == 1), pa.array(bucket, pa.int64()), pa.array(totals[flag, bucket])], ["target", "bucket", "n"]
        )

    parts = docs.select("target", "text").mapInArrow(count, "target boolean, bucket long, n long")
    return parts.groupBy("target", "bucket").agg(F.sum("n").alias("n"))


def log_ratios(counts: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> np.ndarray:
    """log p_target - log p_raw of each bucket, smoothed; raw counts include the target's. At most 2 × buckets rows."""
    totals = np.zeros((2, buckets))
    for row in counts.collect():
        totals[int(row["target"]), row["bucket"]] = row["n"]
    return _ratios(totals[1], totals.sum(0), smoothing)


def _ratios(target: np.ndarray, raw: np.ndarray, smoothing: float) -> np.ndarray:
    target, raw = target + smoothing, raw + smoothing
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def marked_ratios(docs: DataFrame, marks: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> np.ndarray:
    """As :func:`log_ratios`, with targets named by id in (doc_id, target), one row of each: texts are not joined.

    Raw counts take all texts as they are read; target counts only those that a Bloom filter of the ids lets through.
    """
    wanted = store(marks.where("target").select("doc_id", F.lit(1).alias("one")), "targets").where("one >= 1")
    totals = np.zeros((2, buckets))
    raw = model_counts(docs.select(F.lit(False).alias("target"), "text"), buckets)
    with bloom_filtered(docs.sparkSession):
        targets = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(True).alias("target"), "text").join(wanted, "doc_id", "left_semi")
        for counts in (raw, model_counts(targets, buckets)):
            for row in counts.collect():
                totals[int(row["target"]), row["bucket"]] = row["n"]
    return _ratios(totals[1], totals[0], smoothing)


def resample(
    docs: DataFrame,
    share: float | None = None,
    k: int | None = None,
    buckets: int = BUCKETS,
    seed: int = SEED,
    marks: DataFrame | None = None,
) -> DataFrame:
    """(doc_id, n_ngrams, log_weight, gumbel_key, selected) and the locator of every document.

    ``docs`` has doc_id, text and ``target``: true for texts like those wanted; null counts as false. Or
    ``marks`` has (doc_id, target), one row for each id that is known.
    ``k`` documents are drawn, or the given share of all, or as many as the targets' share of the rows
    whose target is known. Null text is empty: weight 0, one way or the other by its noise. Repeated
    rows get noise of their own, by their place. Ties at the cut go by place, so exactly k are drawn.
    """
    docs = landed(docs)
    ratios = log_ratios(model_counts(docs, buckets), buckets) if marks is None else marked_ratios(docs, marks, buckets)
    located = with_locator(docs, [F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, weights = [], []
            for words in word_hashes(batch.column("text").to_pylist()):
                found = ngram_buckets(words, buckets)
                sizes.append(len(found))
                weights.append(float(ratios[found].sum()))
            kept = [batch.column(name) for name in ("doc_id", "_file", "_row")]
            made = [pa.array(sizes, pa.int64()), pa.array(weights, pa.float64())]
            yield pa.RecordBatch.from_arrays([*kept, *made], ["doc_id", "_file", "_row", "n_ngrams", "log_weight"])

    schema = "doc_id long, _file string, _row long, n_ngrams long, log_weight double"
    # Uniform in (0, 1) from 52 bits of a hash; the noise is -log(-log(u)).
    name = F.regexp_extract("_file", "[^/]*$", 0)
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", name, "_row"), 12) + 0.5) / float(1 << 52)
    keyed = located.mapInArrow(weigh, schema).withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(uniform)))
    weighed = store(keyed, "weighed")
    if k is None:
        n = weighed.count()
        if share is None:
            flags = docs if marks is None else docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(marks, "doc_id")
            known = flags.where("target is not null").agg(F.avg(F.col("target").cast("int"))).first()[0]
            share = known if known is not None else 1.0
        k = round(n * share)
    return _largest(weighed, "gumbel_key", ["_file", "_row"], k)


def _largest(df: DataFrame, value: str, ties: list[str], k: int, cells: int = 4096) -> DataFrame:
    """All rows with ``selected``: the k largest values, ties by the given columns.

    The k-th place is narrowed down by counts of equal cells between two bounds, so no task sorts the
    table and the driver sees one row per cell. What is left is one value, or a handful of rows.
    """
    low, high = df.agg(F.min(value), F.max(value)).first()
    wanted, rest = k, df
    if low is None or k <= 0:
        return df.withColumn("selected", F.lit(False))
    bounds = (F.col(value) >= low) & (F.col(value) <= high)
    while low < high:
        width = (high - low) / cells
        cell = F.least(F.floor((F.col(value) - low) / width), F.lit(cells - 1))
        counts = rest.where(bounds).groupBy(cell.alias("c")).agg(
            F.count(F.lit(1)).alias("n"), F.min(value).alias("low"), F.max(value).alias("high")
        )
        for row in sorted(counts.collect(), key=lambda r: -r["c"]):
            if row["n"] >= wanted:
                break
            wanted -= row["n"]
        else:
            return df.withColumn("selected", F.lit(True))
        if (row["low"], row["high"]) == (low, high):
            break
        low, high = row["low"], row["high"]
        bounds = (F.col(value) >= low) & (F.col(value) <= high)
    above = F.col(value) > high
    tied = df.where(bounds).orderBy(F.desc(value), *ties).limit(wanted).select(*ties).withColumn("_drawn", F.lit(True))
    marked = df.join(tied, ties, "left")
    return marked.withColumn("selected", above | F.coalesce("_drawn", F.lit(False))).drop("_drawn")


def marked(labels: DataFrame) -> DataFrame:
    """(doc_id, target): whether its labels say good and not toxic. Repeated labels must all agree; null ids have none."""
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    ids = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    return ids.agg(F.every(good).alias("target"))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs with ``target``, null without labels."""
    return docs.select("doc_id", "text").join(marked(labels), "doc_id", "left")


def op3_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resamples documents towards those labelled good: as many as the good share of the labels."""
    marks = store(marked(table(spark, sf_dir, "labels")), "marks")
    return resample(table(spark, sf_dir, "documents"), marks=marks).drop("_file", "_row")
