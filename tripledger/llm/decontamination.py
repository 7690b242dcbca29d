"""Benchmark items in documents, by greedy string tiling.

Texts are words in lower case without marks. Where an item and a document share a seed, a run of
``MIN_MATCH`` words, they are tiled: the longest common run of unmarked words is marked on both sides,
then the next longest, down to ``MIN_MATCH``, so that no word counts twice and passages may come in
another order. Runs are found by running Karp-Rabin hashes. The share of an item's words that tiles
cover decides.

Every document is read whole, and once per block of the benchmark. A block has a bounded size, so what
each task is sent is bounded for any benchmark; an ordinary benchmark is one block.
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger.llm.shingles import mix
from tripledger.llm.tables import landed, rows_at, store, table, with_locator

# Words of a seed and of the shortest tile.
MIN_MATCH = 5
# Covered share of an item's words from which a document counts as contaminated.
COVERAGE = 0.5
# Items and characters of a block of the benchmark.
BLOCK_ITEMS, BLOCK_CHARS = 20_000, 8_000_000

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    """Words of letters, digits and underscores, in lower case."""
    return _WORD.findall((text or "").lower())


def running_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Karp-Rabin hashes of all runs of n words."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        total = total * _FACTOR + words[i : len(words) - n + 1 + i]
    return mix(total)


def greedy_tiles(item: list, text: list, min_match: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """[(place in item, place in text, length)]: longest unmarked common runs first, never overlapping.

    Equal lengths go by place in the item, then in the text. All common runs are found from their
    seeds once; a run that a tile has cut into is searched again for what is left of it.
    """
    if len(item) < min_match or len(text) < min_match:
        return []
    code: dict = {}
    a = np.array([code.setdefault(w, len(code)) for w in item], np.uint64)
    b = np.array([code.setdefault(w, len(code)) for w in text], np.uint64)
    seeds = defaultdict(list)
    for i, h in enumerate(running_hashes(mix(a + np.uint64(1)), min_match).tolist()):
        seeds[h].append(i)
    hashes = running_hashes(mix(b + np.uint64(1)), min_match)
    hits = np.flatnonzero(np.isin(hashes, np.array(list(seeds), np.uint64)))
    places = {h: np.array(own) for h, own in seeds.items()}
    runs = []
    for j in hits.tolist():
        own = places[int(hashes[j])]
        # A seed that continues the one before it on both sides lies within that run: only starts are kept.
        for i in (own[(own == 0) | (a[own - 1] != b[j - 1])] if j else own).tolist():
            most = min(len(a) - i, len(b) - j)
            apart = a[i : i + most] != b[j : j + most]
            n = int(apart.argmax()) if apart.any() else most
            if n >= min_match:
                runs.append((-n, i, j))
    heapq.heapify(runs)
    marked_a, marked_b, tiles = np.zeros(len(a), bool), np.zeros(len(b), bool), []
    while runs and not marked_a.all():
        size, i, j = heapq.heappop(runs)
        n = -size
        free = ~(marked_a[i : i + n] | marked_b[j : j + n])
        if free.all():
            marked_a[i : i + n] = marked_b[j : j + n] = True
            tiles.append((i, j, n))
            continue
        edges = np.diff(np.concatenate([[0], free.view(np.int8), [0]]))
        for low, high in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist(), strict=True):
            if high - low >= min_match:
                heapq.heappush(runs, (low - high, i + low, j + low))
    return tiles


class Items:
    """A block of the benchmark, as tasks hold it: words of items and the items of each seed."""

    def __init__(self, items: list[tuple[int | None, str | None]], min_match: int):
        self.min_match = min_match
        self.ids = [item_id for item_id, _ in items]
        self.texts = [text for _, text in items]
        self.words = [words_of(text) for _, text in items]
        self.seeds: dict[tuple, set[int]] = defaultdict(set)
        for k, words in enumerate(self.words):
            # An item shorter than a seed is sought as a whole.
            n = min(min_match, len(words))
            for i in range(len(words) - n + 1 if n else 0):
                self.seeds[tuple(words[i : i + n])].add(k)
        self.short = sorted({len(seed) for seed in self.seeds if len(seed) < min_match})
        self.vocabulary = {word for seed in self.seeds for word in seed}

    def candidates(self, words: list[str]) -> set[int]:
        """Items that share a seed with the words."""
        known = self.vocabulary
        found: set[int] = set()
        inside = [word in known for word in words]
        for n in (*self.short, self.min_match):
            streak = 0
            for at, here in enumerate(inside):
                streak = streak + 1 if here else 0
                if streak >= n and (owners := self.seeds.get(tuple(words[at - n + 1 : at + 1]))):
                    found |= owners
        return found


def _blocks(items: DataFrame) -> Iterator[list[tuple[int | None, str | None]]]:
    """The items in blocks of at most BLOCK_ITEMS and BLOCK_CHARS, or one longer item; at least one block.

    Each goes through the driver alone: rows are read part by part and cut as they come.
    """
    block, chars = [], 0
    for row in items.toLocalIterator():
        size = len(row["text"] or "")
        if block and (len(block) == BLOCK_ITEMS or chars + size > BLOCK_CHARS):
            yield block
            block, chars = [], 0
        block.append((row["item_id"], row["text"]))
        chars += size
    yield block


def _distinct(benchmark: DataFrame) -> DataFrame:
    """(item_id, text, times): rows of the benchmark and how often each is there, stored in parts of about half a block."""
    named = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    items = store(named.groupBy("item_id", "text").agg(F.count(F.lit(1)).alias("times")), "items")
    total = items.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")).first()
    parts = max(1, -(-total["n"] // (BLOCK_ITEMS // 2)), -(-(total["chars"] or 0) // (BLOCK_CHARS // 2)))
    return items if parts == 1 else store(items.repartition(parts), "items")


def tiled_items(
    docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, coverage: float = COVERAGE
) -> DataFrame:
    """(doc_id, item_id, item_words, covered_words, n_tiles, longest, coverage) and the locator: contaminated pairs.

    One row per document and item of which tiles cover at least the given share. Null and empty texts,
    on either side, match nothing; an item shorter than a seed must occur whole. Null ids are kept;
    repeated documents give rows each, repeated items one row each. No document or no item: no row.
    """
    located = with_locator(docs, [F.col("doc_id").cast("long").alias("doc_id"), "text"])
    schema = (
        "doc_id long, _file string, _row long, item_id long, item_words int, covered_words int, "
        "n_tiles int, longest int, coverage double"
    )
    items, found = _distinct(benchmark), None
    for block in _blocks(items.select("item_id", "text")):
        # Stored before the next block is made, so that one block at a time is held.
        part = store(located.mapInArrow(_tiler(Items(block, min_match), coverage), f"{schema}, text string"), "tiled")
        found = part if found is None else found.unionAll(part)
    repeated = items.where("times > 1").select(F.col("item_id").alias("_id"), F.col("text").alias("_text"), "times")
    same = F.col("item_id").eqNullSafe(F.col("_id")) & (F.col("text") == F.col("_text"))
    counted = found.join(repeated, same, "left").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.coalesce("times", F.lit(1)).cast("int"))))
    return counted.drop("text", "_id", "_text", "times", "_copy")


def _tiler(items: Items, coverage: float):
    fields = [
        ("item_id", pa.int64()), ("item_words", pa.int32()), ("covered_words", pa.int32()),
        ("n_tiles", pa.int32()), ("longest", pa.int32()), ("coverage", pa.float64()), ("text", pa.string()),
    ]

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, source = [], []
            for at, text in enumerate(batch.column("text").to_pylist()):
                words = words_of(text)
                for k in sorted(items.candidates(words)):
                    own = items.words[k]
                    tiles = greedy_tiles(own, words, min(items.min_match, len(own)))
                    covered = sum(n for _, _, n in tiles)
                    if covered >= coverage * len(own):
                        source.append(at)
                        longest = max(n for _, _, n in tiles)
                        rows.append((items.ids[k], len(own), covered, len(tiles), longest, covered / len(own), items.texts[k]))
            kept = batch.select(["doc_id", "_file", "_row"]).take(pa.array(source, pa.int64()))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(fields)
            made = [pa.array(values, kind) for values, (_, kind) in zip(columns, fields, strict=True)]
            yield pa.RecordBatch.from_arrays([*kept.columns, *made], ["doc_id", "_file", "_row", *(n for n, _ in fields)])

    return tile


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, all their columns, whatever their names. Rows: see tiled_items."""
    docs = landed(docs)
    return rows_at(docs, tiled_items(docs, benchmark).select("_file", "_row").distinct(), "left_anti")


def op10_greedy_tiling_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in all documents. Nulls and other cases: see tiled_items."""
    docs = landed(table(spark, sf_dir, "documents"))
    return tiled_items(docs, table(spark, sf_dir, "benchmark")).drop("_file", "_row")
