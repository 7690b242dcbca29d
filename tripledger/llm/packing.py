"""Packing documents into as few sequences of a fixed length as the method can.

Linear grouping. Lengths above ``capacity / SMALL`` are large. They are ranked by length and dealt to
``groups`` groups of equal cardinality, and every length of a group is rounded up to the group's
largest. The few sizes and their counts are all that the driver sees: it packs them by configuration
patterns (column generation over a small linear program, rounded down, the rest first-fit). Then every
real document takes, by its rank within its group, a place in a pattern, which is arithmetic on each
row. Small lengths are best-fit into the room that is left, and into new sequences, in parallel parts
that hold a share of the sequences and of the small pieces each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripledger.llm.tables import global_positions, store, table
from tripledger.llm.tokens import crc32, default_path, encoder

CAPACITY = 4096
# Large: longer than capacity / SMALL.
SMALL = 8
GROUPS = 48
# Small pieces of one parallel part, on average; a part has that many at any size of the table.
PART_PIECES = 50_000


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): ids of each whole text with an end id, cut at the capacity.

    Null text is empty: one piece of the end id alone.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer)
        end = np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            doc_ids, texts = batch["doc_id"].astype("Int64"), batch["text"].tolist()
            rows = []
            for low in range(0, len(texts), 500):
                for i, ids in enumerate(encode(texts[low : low + 500]), low):
                    ids += end
                    for piece, start in enumerate(range(0, len(ids) // 4, capacity)):
                        part = ids[4 * start : 4 * (start + capacity)]
                        rows.append((i, piece, start, len(part) // 4, crc32(part)))
            found = pd.DataFrame(rows, columns=["row", "piece", "start", "length", "ids_crc32"])
            found.insert(0, "doc_id", doc_ids.take(found.pop("row").to_numpy()).to_numpy(dtype=object, na_value=None))
            yield found.astype({"doc_id": "Int64"})

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return narrow.mapInPandas(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def _best_pattern(sizes: np.ndarray, values: np.ndarray, capacity: int) -> np.ndarray:
    """The most valuable multiset of sizes within the capacity, found piece by piece over all rooms at once."""
    best, choices = np.zeros(capacity + 1), []
    for _ in range(capacity // int(sizes.min())):
        more, choice = best.copy(), np.full(capacity + 1, -1)
        for j in np.flatnonzero(values > 1e-12):
            gain = best[: capacity + 1 - sizes[j]] + values[j]
            better = gain > more[sizes[j] :] + 1e-12
            more[sizes[j] :][better], choice[sizes[j] :][better] = gain[better], j
        best = more
        choices.append(choice)
    pattern, room = np.zeros(len(sizes), int), int(best.argmax())
    for choice in reversed(choices):
        if (j := int(choice[room])) >= 0:
            pattern[j] += 1
            room -= int(sizes[j])
    return pattern


def pack_sizes(sizes: np.ndarray, counts: np.ndarray, capacity: int, rounds: int = 200) -> list[tuple[np.ndarray, int]]:
    """[(pattern, times)]: how often each pattern of sizes is used, so that all counts are covered exactly.

    Column generation for the covering program from single-size patterns: prices of the sizes by a
    revised simplex basis of as many patterns as sizes, a new pattern by a knapsack at those prices,
    until none pays. The basis is rounded down and what is left goes first-fit decreasing.
    """
    n = len(sizes)
    left = counts.astype(int).copy()
    basis = np.diag(np.maximum(1, capacity // sizes)).astype(float)
    for _ in range(rounds):
        try:
            inverse = np.linalg.inv(basis)
        except np.linalg.LinAlgError:
            break
        prices = np.ones(n) @ inverse
        pattern = _best_pattern(sizes, np.maximum(prices, 0), capacity)
        if pattern @ np.maximum(prices, 0) <= 1 + 1e-7:
            break
        amounts, direction = inverse @ counts, inverse @ pattern
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(direction > 1e-9, amounts / direction, np.inf)
        if not np.isfinite(ratio).any():
            break
        basis[:, int(ratio.argmin())] = pattern
    plan: list[tuple[np.ndarray, int]] = []
    try:
        amounts = np.linalg.inv(basis) @ counts
    except np.linalg.LinAlgError:
        amounts = np.zeros(n)
    for k in np.argsort(-amounts):
        pattern = np.round(basis[:, k]).astype(int)
        held = pattern > 0
        if not held.any() or (pattern * sizes).sum() > capacity:
            continue
        times = min(int(amounts[k] + 1e-9), int((left[held] // pattern[held]).min()))
        if times > 0:
            plan.append((pattern, times))
            left -= pattern * times
    order = np.argsort(-sizes)
    while left.any():
        room, pattern = capacity, np.zeros(n, int)
        for j in order:
            take = min(int(left[j]), room // int(sizes[j]))
            pattern[j] += take
            room -= take * int(sizes[j])
        held = pattern > 0
        times = int((left[held] // pattern[held]).min())
        plan.append((pattern, times))
        left -= pattern * times
    return plan


def _places(plan: list[tuple[np.ndarray, int]], n: int) -> list[tuple[int, int, int, int, int]]:
    """(group, first rank, end rank, first sequence, pieces a sequence) of each group in each pattern."""
    taken, sequence, found = np.zeros(n, int), 0, []
    for pattern, times in plan:
        for j in np.flatnonzero(pattern):
            amount = int(pattern[j]) * times
            found.append((int(j), int(taken[j]), int(taken[j]) + amount, sequence, int(pattern[j])))
            taken[j] += amount
        sequence += times
    return found


def best_fit(rooms: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Bin of each length, longest first, each in the fullest bin that holds it; (bins, number of bins).

    Bins below ``len(rooms)`` are the given ones; new bins are opened only where none fits.
    """
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    for i, room in enumerate(rooms.tolist()):
        by_room[room].append(i)
    present = [bool(x) for x in by_room]
    # A two-level index of the rooms that occur: words of 64 rooms as integers.
    words = [0] * (capacity // 64 + 1)
    for room, there in enumerate(present):
        if there:
            words[room >> 6] |= 1 << (room & 63)
    found, bins = np.zeros(len(lengths), np.int64), len(rooms)
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        at = need >> 6
        word = words[at] >> (need & 63) << (need & 63)
        while not word and at + 1 < len(words):
            at += 1
            word = words[at]
        if word:
            room = (at << 6) + (word & -word).bit_length() - 1
            own = by_room[room].pop()
            if not by_room[room]:
                words[room >> 6] &= ~(1 << (room & 63))
        else:
            room, own, bins = capacity, bins, bins + 1
        found[i] = own
        rest = room - need
        if not by_room[rest]:
            words[rest >> 6] |= 1 << (rest & 63)
        by_room[rest].append(own)
    return found, bins


def pack_pieces(
    pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS, small: int = SMALL, part_pieces: int = PART_PIECES
) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; every piece once, offsets gapless from 0.

    Pieces of the full capacity fill a sequence each. A null doc_id is kept; repeated rows are pieces
    of their own. Lengths must lie between 1 and the capacity. An empty table gives no row.
    """
    spark = pieces.sparkSession
    threshold = capacity // small
    order = [F.desc("length"), "doc_id", "piece", "ids_crc32"]
    placed = store(global_positions(pieces, order, "_rank"), "ranked-pieces")
    sums = placed.agg(
        F.count_if(F.col("length") == capacity).alias("full"),
        F.count_if(F.col("length") > threshold).alias("large"),
        F.count(F.lit(1)).alias("all"),
    ).first()
    n_full, n_mid = sums["full"], sums["large"] - sums["full"]
    k = max(1, min(groups, n_mid))
    # Ranks go down by length, so equal cut points of the rank are groups of equal cardinality.
    mid_rank = F.col("_rank") - n_full
    group = F.least(F.floor(mid_rank * k / F.lit(max(1, n_mid))), F.lit(k - 1)).cast("int")
    large = placed.where(f"length > {threshold} and length < {capacity}").withColumn("_group", group)
    # One row per group: its rounded size, its count and its first rank.
    sizes = sorted(
        large.groupBy("_group")
        .agg(F.max("length").alias("size"), F.count(F.lit(1)).alias("n"), F.min("_rank").alias("first"))
        .collect(),
        key=lambda row: row["_group"],
    )
    known = {row["_group"]: row for row in sizes}
    plan = pack_sizes(np.array([r["size"] for r in sizes]), np.array([r["n"] for r in sizes]), capacity) if sizes else []
    places = [
        (sizes[j]["_group"], low + known[sizes[j]["_group"]]["first"], high + known[sizes[j]["_group"]]["first"], first, each)
        for j, low, high, first, each in _places(plan, len(sizes))
    ]
    n_patterned = sum(times for _, times in plan)
    rules = spark.createDataFrame(places or [(-1, 0, 0, 0, 1)], "g int, low long, high long, first long, each int")
    # At most `groups` rows for each of the patterns, of which there are about as many as groups.
    seated = large.join(
        F.broadcast(rules), (F.col("_group") == F.col("g")) & (F.col("_rank") >= F.col("low")) & (F.col("_rank") < F.col("high"))
    ).withColumn("sequence_id", F.col("first") + F.floor((F.col("_rank") - F.col("low")) / F.col("each")))
    names = [*pieces.columns, "_rank"]
    whole = placed.where(F.col("length") == capacity).select(*names, (F.col("_rank") + n_patterned).alias("sequence_id"))
    n_taken = n_patterned + n_full
    seated = store(seated.select(*names, "sequence_id"), "seated-pieces")
    n_small = sums["all"] - sums["large"]
    rooms = seated.groupBy("sequence_id").agg((F.lit(capacity) - F.sum("length")).alias("room"))
    # A part holds a share of the small pieces and of the sequences with room: neither may outgrow it.
    n_rooms = rooms.where("room > 0").count()
    parts = max(1, -(-max(n_small, n_rooms) // part_pieces))
    kept = [F.lit(None).cast(pieces.schema[c].dataType).alias(c) for c in pieces.columns]
    bins = rooms.where("room > 0").select(
        *kept, F.lit(None).cast("long").alias("_rank"), "sequence_id", "room", F.pmod(F.xxhash64("sequence_id"), F.lit(parts)).alias("_part")
    )
    items = placed.where(F.col("length") <= threshold).select(
        *names, F.lit(None).cast("long").alias("sequence_id"), F.lit(None).cast("long").alias("room"),
        F.pmod(F.col("_rank"), F.lit(parts)).alias("_part"),
    )
    stride = parts

    def fill(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        (part,) = key
        own = group[group["room"].notna()].sort_values(["room", "sequence_id"])
        loose = group[group["room"].isna()].sort_values("_rank")
        given = own["sequence_id"].to_numpy(np.int64)
        where, _ = best_fit(own["room"].to_numpy(np.int64), loose["length"].to_numpy(np.int64), capacity)
        new = where - len(given)
        fresh = n_taken + part + new * stride
        ids = np.where(new < 0, given[np.minimum(where, len(given) - 1)] if len(given) else 0, fresh)
        return loose[names].assign(sequence_id=ids)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields)
    filled = bins.unionByName(items).groupBy("_part").applyInPandas(fill, f"{schema}, _rank long, sequence_id long")
    in_sequence = Window.partitionBy("sequence_id").orderBy("_rank").rowsBetween(Window.unboundedPreceding, -1)
    return (
        seated.unionByName(whole)
        .unionByName(filled)
        .withColumn("offset", F.coalesce(F.sum("length").over(in_sequence), F.lit(0)))
        .drop("_rank")
    )


def pack_documents(docs: DataFrame, tokenizer: str | None = None, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their places; the pieces are stored once in the shared folder."""
    path = tokenizer or default_path("word_bpe_49k.json")
    return pack_pieces(store(token_pieces(docs, path, end_id, capacity), "pieces"), capacity)


def assemble(docs: DataFrame, packed: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """(sequence_id, ids): the token ids of each sequence; a sequence holds at most the capacity.

    Needs unique doc_ids.
    """

    def slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer)
        for batch in batches:
            rows = []
            for ids, places in zip(encode(batch["text"].tolist()), batch["places"], strict=True):
                full = np.append(np.frombuffer(ids, "<u4"), end_id).astype(int)
                for at in places:
                    rows.append((at["sequence_id"], at["offset"], full[at["start"] : at["start"] + at["length"]]))
            yield pd.DataFrame(rows, columns=["sequence_id", "offset", "ids"])

    places = packed.groupBy("doc_id").agg(F.collect_list(F.struct("sequence_id", "offset", "start", "length")).alias("places"))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(places, "doc_id")
    cut = texts.mapInPandas(slices, "sequence_id long, offset long, ids array<int>")
    pieces = cut.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("_parts"))
    return pieces.select("sequence_id", F.flatten("_parts.ids").alias("ids"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
