"""Language by a string kernel.

Two texts are compared by the n-grams (1 to ``ORDER`` code points, hashed into buckets) that are present in
both, divided by the geometric mean of the numbers present in each: a blended-spectrum presence kernel,
normalised. A
bounded sample of labelled texts is the training set, some of it the landmarks: by Nyström's method a
text is its kernel values with the landmarks, whitened by their own kernel matrix. One ridge regression
per language, one against the rest, gives the scores. Scoring is a product of matrices per batch.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripledger.llm.tables import landed, rows_at, table, with_locator

ORDER = 3
# Hash buckets of n-grams, of any script: the size of a text's presence set, and what bounds a model's.
BUCKETS = 1 << 16
# Labelled texts to learn from: at most so many of each language, and of all. Texts are read whole.
TRAIN_PER_LANGUAGE, TRAIN_TEXTS = 400, 3200
# Landmarks among them, dealt out evenly; every language has one at least.
LANDMARKS_PER_LANGUAGE, LANDMARKS = 40, 160
RIDGE = 1e-2
UNKNOWN = "und"
# Texts scored together.
TOGETHER = 128
_LETTER = r"\p{L}"
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def present(text: str) -> np.ndarray:
    """Presence, by bucket, of the 1- to 3-grams of the text's code points in lower case."""
    space = np.zeros(BUCKETS, bool)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    code = points
    for n in range(1, ORDER + 1):
        if n > 1:
            # Three code points of 21 bits fit one number.
            code = code[:-1] << np.uint64(21) | points[n - 1 :]
        if not len(code):
            break
        mixed = code * _FACTORS[n - 1]
        mixed = (mixed ^ (mixed >> np.uint64(32))) * _FACTORS[0]
        space[(mixed >> np.uint64(48)).astype(np.int64)] = True
    return space


@dataclass
class Model:
    """What a task needs to classify: at most buckets times landmarks, however many texts and n-grams there are."""

    languages: list[str]
    grams: np.ndarray  # buckets that occur in a landmark
    landmarks: np.ndarray  # grams x landmarks, presence over the root of the number present
    weights: np.ndarray  # landmarks x languages
    intercept: np.ndarray

    def compare(self, spaces: Iterable[np.ndarray], n: int) -> np.ndarray:
        """Kernel values of n presence sets with the landmarks."""
        rows, norms = np.zeros((n, len(self.grams)), np.float32), np.ones(n, np.float32)
        for i, space in enumerate(spaces):
            rows[i] = space[self.grams]
            norms[i] = np.sqrt(max(1, np.count_nonzero(space)))
        return rows @ self.landmarks / norms[:, None]

    def kernel(self, texts: Sequence[str]) -> np.ndarray:
        return self.compare(map(present, texts), len(texts))

    def scores(self, texts: Sequence[str]) -> np.ndarray:
        return self.kernel(texts) @ self.weights + self.intercept


def fit(texts: Sequence[str], languages: Sequence[str], landmarks: int = LANDMARKS_PER_LANGUAGE, ridge: float = RIDGE) -> Model:
    """Learns from labelled whole texts; the first ``landmarks`` of each language are the landmarks."""
    return fit_present([np.packbits(present(text)) for text in texts], languages, landmarks, ridge)


def fit_present(sets: Sequence[np.ndarray], languages: Sequence[str], landmarks: int, ridge: float = RIDGE) -> Model:
    """As :func:`fit`, from presence sets as packed bits."""
    names = sorted(set(languages))
    chosen = [i for name in names for i in [k for k, lang in enumerate(languages) if lang == name][:landmarks]]
    spaces = np.unpackbits(np.stack([sets[i] for i in chosen]), axis=1).astype(bool)
    grams = np.flatnonzero(spaces.any(0))
    basis = (spaces[:, grams] / np.sqrt(np.maximum(1, spaces.sum(1)))[:, None]).T.astype(np.float32)
    model = Model(names, grams, np.ascontiguousarray(basis), np.zeros((len(chosen), len(names)), np.float32), np.zeros(len(names)))
    # Nyström: whiten by the landmarks' own kernel, then ridge regression in that space.
    values, vectors = np.linalg.eigh(model.compare(spaces, len(spaces)).astype(float))
    good = values > 1e-6 * values.max()
    whiten = vectors[:, good] / np.sqrt(values[good])
    parts = [sets[i : i + TOGETHER] for i in range(0, len(sets), TOGETHER)]
    kernels = [model.compare((np.unpackbits(one).astype(bool) for one in part), len(part)) for part in parts]
    features = np.concatenate(kernels).astype(float) @ whiten
    target = np.array([[1.0 if lang == name else -1.0 for name in names] for lang in languages])
    # Languages weigh alike however many texts they have.
    share = np.array([1 / list(languages).count(lang) for lang in languages])
    share /= share.sum()
    middle, center = share @ features, share @ target
    x, y = features - middle, target - center
    solved = np.linalg.solve((x * share[:, None]).T @ x + ridge * np.eye(x.shape[1]) / len(sets), (x * share[:, None]).T @ y)
    model.weights = (whiten @ solved).astype(np.float32)
    model.intercept = center - middle @ solved
    return model


def held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def train(docs: DataFrame, per_language: int = TRAIN_PER_LANGUAGE) -> Model | None:
    """A model from at most ``per_language`` labelled texts of each language, drawn by a hash of their ids.

    Of many languages fewer texts each, so that all are TRAIN_TEXTS at most, or one of each language. Texts
    are read whole in tasks; the driver gets the presence bits of those drawn. Rows without lang or with an id in the held-out quarter are never used. None without any label.
    """
    letters = F.col("text").rlike(_LETTER)
    shown = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) != 2
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & shown & letters)
    counts = {row["lang"]: row["n"] for row in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    per_language = max(1, min(per_language, TRAIN_TEXTS // len(counts)))
    # Texts of the smallest hashes, of which enough lie below a bound that follows from their number.
    bounds = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, 8 * per_language / n))])
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / float(1 << 53)
    drawn = known.where(place <= bounds[F.col("lang")]).select(
        "lang", place.alias("_at"), "text"
    )
    first = Window.partitionBy("lang").orderBy("_at", "text")
    sample = drawn.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= per_language).select("lang", "_at", "text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [np.packbits(present(text)).tobytes() for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("_at"), pa.array(bits, pa.binary())], ["lang", "_at", "bits"])

    rows = sorted(map(tuple, sample.mapInArrow(read, "lang string, _at double, bits binary").collect()), key=lambda r: (r[1], bytes(r[2]), r[0]))
    landmarks = max(1, min(LANDMARKS_PER_LANGUAGE, LANDMARKS // len(counts)))
    return fit_present([np.frombuffer(bits, np.uint8) for _, _, bits in rows], [lang for lang, _, _ in rows], landmarks)


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) and the locator for every document.

    Only the text is looked at. ``und`` with score 0 where it is null or has no letter, or where nothing
    could be learned. The score is the share of the best language in the exponentials of all scores.
    """
    docs = landed(docs)
    model = model or train(docs)

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            named, sure = [UNKNOWN] * len(texts), np.zeros(len(texts))
            written = [i for i, letters in enumerate(batch.column("letters").to_pylist()) if letters and model]
            for low in range(0, len(written), TOGETHER):
                part = written[low : low + TOGETHER]
                scores = model.scores([texts[i] for i in part])
                odds = np.exp(4 * (scores - scores.max(1, keepdims=True)))
                for i, k, p in zip(part, scores.argmax(1), odds.max(1) / odds.sum(1), strict=True):
                    named[i], sure[i] = model.languages[k], p
            kept = [batch.column(name) for name in ("doc_id", "held_out", "_file", "_row")]
            made = [pa.array(named, pa.string()), pa.array(sure, pa.float64())]
            yield pa.RecordBatch.from_arrays([*kept, *made], ["doc_id", "held_out", "_file", "_row", "lang_pred", "score"])

    ids = F.col("doc_id").cast("long")
    remainder = F.pmod(F.crc32(ids.cast("string").cast("binary")), F.lit(4))
    located = with_locator(
        docs,
        [
            ids.alias("doc_id"),
            F.coalesce(remainder == 2, F.lit(False)).alias("held_out"),
            "text",
            F.coalesce(F.col("text").rlike(_LETTER), F.lit(False)).alias("letters"),
        ],
    )
    schema = "doc_id long, held_out boolean, _file string, _row long, lang_pred string, score double"
    return located.mapInArrow(classify, schema)


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents with a language, all their columns; where none can be learned, those with a letter."""
    docs = landed(docs)
    model = train(docs)
    if model is None:
        return docs.where(F.col("text").rlike(_LETTER))
    known = identify(docs, model).where(F.col("lang_pred") != UNKNOWN).select("_file", "_row")
    return rows_at(docs, known)


def op7_string_kernel_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from those not held out. Nulls and other cases: see identify."""
    return identify(table(spark, sf_dir, "documents")).drop("_file", "_row")
