"""Alignment of two tokenizers: which tokens of one cover the bytes of which tokens of the other.

Both token sequences of a text cut the same bytes. Tokens that overlap belong together, directly or through
others. Every token points to the farthest-right token of the other sequence that overlaps it: the one with
its last byte. Where both sequences end a token, the second one's points to itself. Successors are doubled,
for all tokens of many texts at once, until nothing moves: each token then points to the last token of its
group, which labels the group.

Linked are all pairs of tokens, one of each sequence, of one group; a pair of ids counts the documents that
hold it. Tasks read documents in chunks and write, for each chunk, its distinct pairs once with their
document counts, and for each document places in that list. Counts are added up over chunks, and go back to
each chunk before its documents. So what is shuffled are distinct pairs of chunks, never links of documents.
The documents of a chunk are in several rows, so that no task or worker holds a whole chunk of them, let alone
all chunks of a partition.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger.llm.tables import small_batches, store, table
from tripledger.llm.tokens import default_path, encoder
from tripledger.sources.settings import with_settings

# Documents and characters of a chunk, and characters aligned at once and kept in a row; a longer document is one of its own.
CHUNK_DOCS, CHUNK_CHARS, BATCH_CHARS = 4000, 4_000_000, 250_000
# Rows that Spark's Parquet reader holds at once, of texts or of aligned documents; pairs of a chunk whose counts are in a row.
READ_ROWS, COUNTED_PAIRS = 64, 32_768
# Words whose ids a worker keeps, for each tokenizer.
KEPT = 200_000
# Links of a group that are spelled out one by one; larger groups go by their distinct ids.
GROUP_LINKS = 4096
SPACE = "▁"


def byte_level() -> dict[str, int]:
    """The byte of each character of byte-level vocabularies: printable Latin-1 stands for itself, others follow from 256."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Bytes:
    """A byte-level tokenizer from a tokenizers file; special strings in texts are plain text."""

    def __init__(self, path: str):
        self.encode = encoder(path, special_as_text=True, kept_words=KEPT)
        level = byte_level()
        vocabulary = self.encode.tokenizer.get_vocab()
        self.tokens = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.tokens[number] = bytes(map(level.__getitem__, token)) if all(c in level for c in token) else token.encode()

    def __call__(self, texts: Sequence[str]) -> list[np.ndarray | None]:
        """Ids of each text; None where its tokens don't give back its bytes, which byte-level ones always do."""
        found = [np.frombuffer(ids, "<u4") for ids in self.encode(texts)]
        if self.encode.kind == "spaces":
            return found
        return [ids if _joined(ids, self.tokens) == text.encode() else None for text, ids in zip(texts, found, strict=True)]


def _joined(ids: np.ndarray, tokens: list[bytes]) -> bytes:
    return b"".join(map(tokens.__getitem__, ids.tolist()))


class Pieces:
    """A sentencepiece model. Ids of words it has seen are kept where no piece goes on beyond the end of a word."""

    def __init__(self, path: str, kept_words: int = KEPT):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        self.model = SentencePieceProcessor(model_file=path)
        rules = sentencepiece_model_pb2.ModelProto.FromString(self.model.serialized_model_proto())
        normal = rules.normalizer_spec
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.tokens = [
            bytes([int(name[3:5], 16)]) if self.model.is_byte(i) else name.replace(SPACE, " ").encode() for i, name in enumerate(names)
        ]
        plain = normal.name == "identity" and not normal.precompiled_charsmap and normal.add_dummy_prefix and not normal.remove_extra_whitespaces
        kinds = rules.trainer_spec
        bpe = kinds.model_type == kinds.BPE and not kinds.treat_whitespace_as_suffix
        defined = any(piece.type == piece.USER_DEFINED for piece in rules.pieces)
        whole = sum(map(self.model.is_byte, range(len(names)))) == 256
        self.by_words = plain and bpe and whole and not defined and not any(SPACE in name.lstrip(SPACE) for name in names)
        self.kept_words = kept_words
        self.known: dict[str, bytes] = {}

    def __call__(self, texts: Sequence[str]) -> list[np.ndarray | None]:
        """Ids of each text; None where its tokens don't give back the bytes of space and text."""
        parts: list[list[str] | None] = []
        for text in texts:
            if not self.by_words or not text or text[-1] == " " or SPACE in text:
                parts.append(None)
            elif text[0] == " " or "  " in text:
                # A run of spaces belongs to the word after it.
                parts.append([run[1:] for run in re.findall(" +[^ ]+", f" {text}")])
            else:
                parts.append(text.split(" "))
        new = [word for word in set().union(*filter(None, parts)) if word not in self.known]
        for word, ids in zip(new, self.model.encode(new, num_threads=1), strict=True):
            self.known[word] = np.asarray(ids, "<u4").tobytes()
        whole = iter(self.model.encode([text for text, words in zip(texts, parts, strict=True) if words is None], num_threads=1))
        found = []
        for text, words in zip(texts, parts, strict=True):
            ids = np.asarray(next(whole), "<u4") if words is None else np.frombuffer(b"".join(map(self.known.__getitem__, words)), "<u4")
            # Words without the space mark always come back, as their bytes are pieces where nothing else is.
            same = words is not None or _joined(ids, self.tokens) == f" {text}".encode()
            found.append(ids if same else None)
        if len(self.known) > self.kept_words:
            for word in new:
                del self.known[word]
        return found


def group_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """The token that ends each token's group, for all tokens of a and then of b, numbered in that order.

    ``ends`` are the byte offsets where tokens end, ascending; both sequences end alike.
    """
    n = len(ends_a)
    after = np.empty(n + len(ends_b), np.int64)
    after[:n] = n + np.searchsorted(ends_b, ends_a)
    over = np.searchsorted(ends_a, ends_b)
    after[n:] = np.where(ends_a[over] > ends_b, over, np.arange(n, len(after))) if n else np.arange(len(after))
    while True:
        further = after[after]
        if np.array_equal(further, after):
            return after
        after = further


@dataclass
class Aligned:
    """Texts of one batch: sizes, digests, and the distinct id pairs of each with their numbers of links."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    digests: list[str]
    doc: np.ndarray  # of each pair
    pair: np.ndarray  # a << 32 | b
    times: np.ndarray


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = Bytes(path_a), Pieces(path_b)
        self.size_a, self.size_b = (np.array([len(t) for t in side.tokens], np.int64) for side in (self.a, self.b))
        # What a token is written as within a group, and at the end of its side of the group.
        self.written = [f"{i}{end}".encode() for tokens, ends in ((self.a.tokens, ",|"), (self.b.tokens, ",;")) for end in ends for i in range(len(tokens))]

    def __call__(self, texts: Sequence[str | None]) -> Aligned:
        """Aligns space and text for each; texts that either side doesn't give back have no tokens."""
        filled = [i for i, text in enumerate(texts) if text]
        wanted = [f" {texts[i]}" for i in filled]
        ids_a, ids_b = self.a(wanted), self.b([texts[i] for i in filled])
        empty = np.zeros(0, "<u4")
        all_a, all_b = [empty] * len(texts), [empty] * len(texts)
        for i, one, two in zip(filled, ids_a, ids_b, strict=True):
            if one is not None and two is not None:
                all_a[i], all_b[i] = one, two
        return self._align(all_a, all_b)

    def _align(self, all_a: list[np.ndarray], all_b: list[np.ndarray]) -> Aligned:
        docs = len(all_a)
        n_a, n_b = (np.array([len(ids) for ids in side], np.int64) for side in (all_a, all_b))
        a, b = (np.concatenate(side).astype(np.int64) if side else np.zeros(0, np.int64) for side in (all_a, all_b))
        # Texts stand one after the other; where a text ends, both sides end.
        last = group_ends(np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b]))
        is_end = last[len(a) :] == np.arange(len(a), len(last))
        number = np.cumsum(is_end) - 1
        group_a, group_b = (number[part - len(a)] for part in (last[: len(a)], last[len(a) :]))
        groups = int(is_end.sum())
        count_a, count_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
        before_a, before_b = (np.concatenate([[0], np.cumsum(c)]) for c in (count_a, count_b))
        doc_b = np.repeat(np.arange(docs), n_b)
        doc = doc_b[is_end]
        links = count_a * count_b
        return Aligned(
            n_a,
            n_b,
            np.bincount(doc, minlength=docs),
            np.bincount(doc, links, minlength=docs).astype(np.int64) if groups else np.zeros(docs, np.int64),
            self._digests(a, b, group_a, group_b, before_a, before_b, n_a, n_b),
            *self._pairs(a, b, count_a, count_b, before_a, before_b, doc, links),
        )

    def _digests(self, a, b, group_a, group_b, before_a, before_b, n_a, n_b) -> list[str]:
        """Of the groups of each text, written out."""
        order = np.empty(len(a) + len(b), np.int64)
        at_a, at_b = np.arange(len(a)), np.arange(len(b))
        order[at_a + before_b[group_a]] = a + len(self.size_a) * (at_a + 1 == before_a[group_a + 1])
        order[at_b + before_a[group_b + 1]] = 2 * len(self.size_a) + b + len(self.size_b) * (at_b + 1 == before_b[group_b + 1])
        ends = np.cumsum(n_a + n_b)
        digests = []
        for low, high in zip((ends - n_a - n_b).tolist(), ends.tolist(), strict=True):
            text = b"".join(map(self.written.__getitem__, order[low:high].tolist()))
            digests.append(hashlib.sha256(text[:-1]).hexdigest() if text else "")
        return digests

    def _pairs(self, a, b, count_a, count_b, before_a, before_b, doc, links) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair, links) of the distinct pairs of each text."""
        few = links <= GROUP_LINKS
        # Each a-token of a group meets the group's b-tokens in turn.
        own = np.repeat(np.arange(len(count_a)), count_a)
        own_few = few[own]
        first, group = np.flatnonzero(own_few), own[own_few]
        repeats = count_b[group]
        starts = np.repeat(before_b[group] - (np.cumsum(repeats) - repeats), repeats)
        second = starts + np.arange(len(starts))
        found = [(np.repeat(doc[group], repeats), np.repeat(a[first], repeats) << 32 | b[second], np.ones(len(second), np.int64))]
        for k in np.flatnonzero(~few).tolist():
            (ids_a, times_a), (ids_b, times_b) = (
                np.unique(ids[before[k] : before[k + 1]], return_counts=True) for ids, before in ((a, before_a), (b, before_b))
            )
            pairs = (ids_a[:, None] << 32 | ids_b).ravel()
            found.append((np.full(len(pairs), doc[k]), pairs, np.outer(times_a, times_b).ravel()))
        text, pair, times = (np.concatenate(parts) for parts in zip(*found, strict=True))
        if not len(text):
            return text, pair, times
        order = np.lexsort((pair, text))
        text, pair, times = text[order], pair[order], times[order]
        new = np.concatenate([[True], (np.diff(text) != 0) | (np.diff(pair) != 0)])
        return text[new], pair[new], np.add.reduceat(times, np.flatnonzero(new))


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """The worker's aligner of two files, made once."""
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    return _aligners[path_a, path_b]


# Of one row's documents; places in the chunk's list of pairs, and links, are packed.
_DOCUMENTS = {
    "doc_ids": "array<long>",
    "n_a": "array<long>",
    "n_b": "array<long>",
    "n_groups": "array<long>",
    "n_links": "array<long>",
    "digests": "array<string>",
    "ends": "array<long>",
    "places": "binary",
    "times": "binary",
}
_PARTS = {
    "chunk": "long",
    "pairs": "array<long>",
    "documents": "array<long>",
    "docs": f"struct<{', '.join(f'{name}: {kind}' for name, kind in _DOCUMENTS.items())}>",
}
_ARROW = {"long": pa.int64(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()), "binary": pa.binary()}


def packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on, each in as few bytes as the largest needs: 1, 2, 4 or 8."""
    return values.astype(np.min_scalar_type(values.max(initial=0)).newbyteorder("<")).tobytes()


def unpacked(data: bytes | pa.Buffer, n: int) -> np.ndarray:
    """The n numbers of :func:`packed`."""
    return np.frombuffer(data, f"<u{len(data) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


def _batches(rows: Iterator[tuple[int | None, str | None]], docs: int, chars: int) -> Iterator[list[tuple[int | None, str | None]]]:
    part, size = [], 0
    for row in rows:
        part.append(row)
        size += len(row[1] or "")
        if len(part) >= docs or size >= chars:
            yield part
            part, size = [], 0
    if part:
        yield part


def chunks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Rows of chunks of documents. Each has some documents: in their order ids, sizes and digests, and where each one's
    pairs stand in the list of the chunk, with links. A chunk's first row has that list: its distinct pairs with the
    number of documents that hold each."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align_texts, part = aligner(path_a, path_b), TaskContext.get().partitionId()
        rows = ((i, t) for batch in batches for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True))
        for number, chunk in enumerate(_batches(rows, CHUNK_DOCS, CHUNK_CHARS)):
            found = [([i for i, _ in some], align_texts([text for _, text in some])) for some in _batches(iter(chunk), CHUNK_DOCS, BATCH_CHARS)]
            pairs, documents = np.unique(np.concatenate([one.pair for _, one in found]), return_counts=True)
            for at, (doc_ids, one) in enumerate(found):
                values = [
                    doc_ids,
                    *(getattr(one, name) for name in ("n_a", "n_b", "n_groups", "n_links")),
                    one.digests,
                    np.cumsum(np.bincount(one.doc, minlength=len(one.n_a))),
                    packed(np.searchsorted(pairs, one.pair)),
                    packed(one.times),
                ]
                some = pa.StructArray.from_arrays([pa.array([v], _ARROW[kind]) for v, kind in zip(values, _DOCUMENTS.values(), strict=True)], list(_DOCUMENTS))
                listed = [None, None] if at else [pairs, documents]
                columns = [pa.array([part << 33 | number], pa.int64()), *(pa.array([v], pa.list_(pa.int64())) for v in listed), some]
                yield pa.RecordBatch.from_arrays(columns, list(_PARTS))

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return narrow.mapInArrow(align, ", ".join(f"{name} {kind}" for name, kind in _PARTS.items()))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): documents of each pair of ids, and whether none of its first id has more."""
    each = aligned.select(F.explode(F.arrays_zip("pairs", "documents")).alias("x"))
    totals = store(each.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.documents").alias("n")), "pair-counts")
    first = F.shiftright("pair", 32).alias("first")
    most = totals.groupBy(first).agg(F.max("n").alias("most"))
    return totals.withColumn("first", first).join(most, "first").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def aligned_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document.

    Null and empty texts, and texts that either tokenizer doesn't give back byte by byte, have no tokens:
    zeros and an empty digest. Repeated rows are documents of their own; null doc_ids are kept; an empty
    table gives no row.
    """
    spark = docs.sparkSession
    with small_batches(spark), with_settings(spark, {"spark.sql.parquet.columnarReaderBatchSize": str(READ_ROWS)}):
        aligned = store(chunks(docs, path_a, path_b), "aligned")
        counts = store(pair_counts(aligned), "pair-counts")
        # Stored, as whoever uses the result may have other settings.
        return store(_counted(aligned, counts), "aligned-documents")


def _counted(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """The documents with the counts of their pairs. A task gets the counts of a chunk's pairs, then its documents."""
    places = aligned.select("chunk", F.posexplode("pairs").alias("place", "pair"))
    lists = places.join(counts, "pair").groupBy("chunk", F.expr(f"place div {COUNTED_PAIRS}")).agg(F.collect_list(F.struct("place", "n", "best")).alias("known"))
    known = lists.select("chunk", "known", F.lit(None).cast(aligned.schema["docs"].dataType).alias("docs"))
    rows = aligned.select("chunk", F.lit(None).cast(lists.schema["known"].dataType).alias("known"), "docs")
    together = known.unionAll(rows).repartition("chunk").sortWithinPartitions("chunk", F.col("docs").isNotNull())

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, parts, counted = None, [], None
        for batch in batches:
            numbers, known, docs = (batch.column(name) for name in ("chunk", "known", "docs"))
            for k, number in enumerate(numbers.to_pylist()):
                if number != chunk:
                    chunk, parts, counted = number, [], None
                if known[k].is_valid:
                    parts.append([known[k].values.field(i).to_numpy(zero_copy_only=False) for i in range(3)])
                    continue
                if counted is None:
                    place, n, best = (np.concatenate(part) for part in zip(*parts, strict=True)) if parts else [np.zeros(0, np.int64)] * 3
                    counted, parts = np.zeros((2, len(place)), np.int64), []
                    counted[0, place], counted[1, place] = n, best
                yield _totals(docs[k], counted)

    return together.mapInArrow(total, ", ".join(f"{name} {'string' if name == 'groups_sha256' else 'long'}" for name in _TOTALS))


_TOTALS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def _totals(docs: pa.StructScalar, counted: np.ndarray) -> pa.RecordBatch:
    """Of one row's documents; ``counted`` has documents and best of each place of the chunk's list."""
    ends = docs["ends"].values.to_numpy()
    places, times = (unpacked(docs[name].as_buffer(), int(ends[-1])) for name in ("places", "times"))
    # Running sums, read where documents end.
    sums = [np.concatenate([[0], np.cumsum(row[places] * times)]) for row in counted]
    starts = np.concatenate([[0], ends[:-1]])
    made = [pa.array(s[ends] - s[starts], pa.int64()) for s in sums]
    kept = [docs[name].values for name in ("doc_ids", "n_a", "n_b", "n_groups", "n_links")]
    return pa.RecordBatch.from_arrays([*kept, made[1], made[0], docs["digests"].values], _TOTALS)


def op13_pointer_jumping_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligns byte-level and piece ids of all documents. Nulls and other cases: see aligned_documents."""
    paths = default_path("byte_bpe_50k.json"), default_path("piece_bpe_32k.model")
    return aligned_documents(table(spark, sf_dir, "documents"), *paths)
