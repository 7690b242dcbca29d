"""Token ids in files of fixed-width bits.

A file holds the ids of consecutive documents, each with an end id, in the fewest bits that hold any
id of the vocabulary. Ids are cut into blocks of equal length; each block starts at a byte, so a block
is unpacked by one numpy expression and any range of ids is read from the blocks it touches.

Layout, integers little-endian: ``BITS`` magic, version, bits, block length; the packed blocks; then
the footer: block offsets (u64), first id of each document and the end (u64), doc_ids (i64) and their
null flags (u8); and last the number of blocks, documents and ids, the start of the footer and magic.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripledger.llm.tables import open_folder, scratch_path, table, temporary_name
from tripledger.llm.tokens import crc32, default_path, encoder

MAGIC = b"BITS"
HEAD = struct.Struct("<4sHHI")
TAIL = struct.Struct("<QQQQ4s")
BLOCK_IDS = 8192
# Ids after which a task goes on in another file.
FILE_IDS = 1 << 26


def bits_for(vocabulary: int) -> int:
    """Bits of the largest id of a vocabulary."""
    return max(1, (max(vocabulary, 1) - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids in ``bits`` bits each, lowest bit first, filled up to a whole byte."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    spread = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(spread[:, :bits].ravel(), bitorder="little").tobytes()


def unpack(data: bytes, count: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype("<u4")
    padded = np.frombuffer(data + b"\0" * 8, np.uint8)
    at = np.arange(count, dtype=np.int64) * bits
    first = at >> 3
    word = np.zeros(count, np.uint64)
    for i in range((bits + 7) // 8 + 1):
        word |= padded[first + i].astype(np.uint64) << np.uint64(8 * i)
    return ((word >> (at & 7).astype(np.uint64)) & np.uint64((1 << bits) - 1)).astype("<u4")


class TokenFileWriter:
    """One file, written block by block under another name and moved into place when complete."""

    def __init__(self, folder: str, name: str, bits: int, block_ids: int = BLOCK_IDS):
        self.fs, path = open_folder(folder)
        self.final, self.draft = f"{path}/{name}", f"{path}/{temporary_name(name)}"
        self.out = self.fs.open_output_stream(self.draft)
        self.bits, self.block_ids = bits, block_ids
        self.out.write(HEAD.pack(MAGIC, 1, bits, block_ids))
        self.offsets, self.at, self.count = [], HEAD.size, 0
        self.starts, self.doc_ids, self.nulls = [], [], []
        self.waiting: list[bytes] = []
        self.waiting_ids = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.starts.append(self.count)
        self.doc_ids.append(0 if doc_id is None else doc_id)
        self.nulls.append(doc_id is None)
        self.waiting.append(ids)
        self.count += len(ids) // 4
        self.waiting_ids += len(ids) // 4
        if self.waiting_ids >= 16 * self.block_ids:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        data = b"".join(self.waiting)
        step = 4 * self.block_ids
        whole = len(data) if last else len(data) // step * step
        for i in range(0, whole, step):
            block = pack(np.frombuffer(data[i : min(i + step, whole)], "<u4"), self.bits)
            self.offsets.append(self.at)
            self.out.write(block)
            self.at += len(block)
        self.waiting, self.waiting_ids = [data[whole:]], (len(data) - whole) // 4

    def close(self) -> None:
        self._flush(True)
        for values, kind in (
            (self.offsets, "<u8"),
            ([*self.starts, self.count], "<u8"),
            (self.doc_ids, "<i8"),
            (self.nulls, "u1"),
        ):
            self.out.write(np.asarray(values, kind).tobytes())
        self.out.write(TAIL.pack(len(self.offsets), len(self.doc_ids), self.count, self.at, MAGIC))
        self.out.close()
        self.fs.move(self.draft, self.final)


class TokenFile:
    """Reads a file: a document, or any range of ids, without the rest."""

    def __init__(self, folder: str, name: str):
        self.fs, path = open_folder(folder)
        self.file = self.fs.open_input_file(f"{path}/{name}")
        magic, _, self.bits, self.block_ids = HEAD.unpack(self.file.read_at(HEAD.size, 0))
        blocks, docs, self.count, self.footer, end = TAIL.unpack(
            self.file.read_at(TAIL.size, self.file.size() - TAIL.size)
        )
        if magic != MAGIC or end != MAGIC:
            raise ValueError(f"{name} is not a complete token file")
        rest = self.file.read_at(self.file.size() - TAIL.size - self.footer, self.footer)
        self.offsets = np.frombuffer(rest, "<u8", blocks)
        self.starts = np.frombuffer(rest, "<u8", docs + 1, 8 * blocks).astype(np.int64)
        self.doc_ids = np.frombuffer(rest, "<i8", docs, 8 * (blocks + docs + 1))
        self.nulls = np.frombuffer(rest, "u1", docs, 8 * (blocks + 2 * docs + 1)).astype(bool)

    def ids(self, start: int, end: int) -> np.ndarray:
        if end <= start:
            return np.zeros(0, "<u4")
        first, last = start // self.block_ids, (end - 1) // self.block_ids
        begin = int(self.offsets[first])
        stop = int(self.offsets[last + 1]) if last + 1 < len(self.offsets) else self.footer
        data = self.file.read_at(stop - begin, begin)
        parts = []
        for block in range(first, last + 1):
            own = int(self.offsets[block]) - begin
            until = int(self.offsets[block + 1]) - begin if block + 1 < len(self.offsets) else len(data)
            parts.append(unpack(data[own:until], min(self.block_ids, self.count - block * self.block_ids), self.bits))
        return np.concatenate(parts)[start - first * self.block_ids : end - first * self.block_ids]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.starts[i]), int(self.starts[i + 1]))

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, start, ids) of each document, read in runs of blocks."""
        low = 0
        while low < len(self.doc_ids):
            reach = self.starts[low] + 64 * self.block_ids
            high = max(low + 1, int(np.searchsorted(self.starts, reach, "right")) - 1)
            base, run = int(self.starts[low]), self.ids(int(self.starts[low]), int(self.starts[high]))
            for i in range(low, high):
                doc_id = None if self.nulls[i] else int(self.doc_ids[i])
                yield doc_id, int(self.starts[i]), run[int(self.starts[i]) - base : int(self.starts[i + 1]) - base]
            low = high


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    block_ids: int = BLOCK_IDS,
    file_ids: int = FILE_IDS,
) -> DataFrame:
    """Writes all documents in ascending doc_id order; returns the manifest (name, part, piece, docs, ids).

    Null text is an empty document, null doc_ids come first, and rows of one doc_id are ordered by text.
    Only files in the manifest count: a task that ran twice leaves the same file under the same name.
    An empty table gives an empty manifest.
    """
    with open(tokenizer, encoding="utf-8") as file:
        rules = json.load(file)
    top = max([*rules["model"]["vocab"].values(), *(t["id"] for t in rules.get("added_tokens", [])), end_id])
    bits = bits_for(top + 1)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, part = encoder(tokenizer), TaskContext.get().partitionId()
        end = np.asarray([end_id], "<u4").tobytes()
        writer, piece, done = None, 0, []
        for batch in batches:
            texts = batch["text"].tolist()
            for low in range(0, len(texts), 500):
                for doc_id, null, ids in zip(
                    batch["doc_id"].tolist()[low : low + 500],
                    batch["_null"].tolist()[low : low + 500],
                    encode(texts[low : low + 500]),
                    strict=True,
                ):
                    writer = writer or TokenFileWriter(folder, f"tokens-{part:06d}-{piece:04d}.bits", bits, block_ids)
                    writer.add(None if null else int(doc_id), ids + end)
                    if writer.count >= file_ids:
                        writer.close()
                        done.append((writer.final.rpartition("/")[2], part, piece, len(writer.doc_ids), writer.count))
                        writer, piece = None, piece + 1
        if writer:
            writer.close()
            done.append((writer.final.rpartition("/")[2], part, piece, len(writer.doc_ids), writer.count))
        yield pd.DataFrame(done, columns=["name", "part", "piece", "docs", "ids"])

    tie = F.xxhash64("text")
    ordered = (
        docs.select(
            F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"),
            F.col("doc_id").isNull().alias("_null"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .repartitionByRange(F.desc("_null"), "doc_id", tie)
        .sortWithinPartitions(F.desc("_null"), "doc_id", tie, "text")
    )
    manifest = ordered.mapInPandas(write, "name string, part int, piece int, docs long, ids long")
    path = f"{folder}/manifest"
    manifest.write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files of the manifest alone.

    ``start`` counts the ids of all documents before it in all files. The window without keys works on
    one row per file.
    """
    before = Window.orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1)
    manifest = spark.read.parquet(f"{folder}/manifest")
    placed = manifest.select("name", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    files = placed.repartition(max(1, spark.sparkContext.defaultParallelism * 2), F.xxhash64("name"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, base in zip(batch["name"], batch["base"], strict=True):
                found = [
                    (doc_id, base + start, len(ids), crc32(ids.tobytes()))
                    for doc_id, start, ids in TokenFile(folder, name).documents()
                ]
                out = pd.DataFrame(found, columns=["doc_id", "start", "n_tokens", "ids_crc32"])
                yield out.astype({"doc_id": "Int64"})

    return files.mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes every whole document as 16-bit ids and reads the files back."""
    folder = scratch_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), folder, default_path("byte_bpe_50k.json"), end_id=0)
    return read_token_files(spark, folder)
