"""Near duplicates by SetSketch registers, then confirmed on full shingle sets.

A document's set is its distinct shingles of five words. A register keeps the minimum of one
exponentially distributed hash over the set, on an exponential scale of base ``BASE`` and truncated to
16 bits: sketches of parts merge by the larger register, and registers of two sets agree about as
often as their elements. Registers are cut into bands; sets that agree in a whole band are candidates.

Equal sets are one node. Nodes that share bands form clusters, found as connected components. A
cluster of ordinary size is compared in one task; a larger one is cut into blocks, and pairs of blocks
are compared in tasks of their own, so that no task holds more than two blocks. A pair is first
estimated from both sketches by maximum likelihood, and far ones are left out; the others are
intersected in full. Tasks give a spanning forest of the links they find, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger.llm.components import connected_components
from tripledger.llm.shingles import WORDS, groups_sql, shingle_sets
from tripledger.llm.tables import landed, rows_at, small_batches, store, table, with_locator

# 100 * intersection >= THRESHOLD * union.
THRESHOLD = 85
# Bands of registers: (1 - 0.8^6)^42, at a similarity of 0.8 about 3 in a million pairs share no band.
BANDS, BAND_REGISTERS = 42, 6
REGISTERS = BANDS * BAND_REGISTERS
# SetSketch scale: registers floor(1 - log_BASE(minimum)) within 0 ... 2^16 - 1.
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 1
# Documents of one block; a task compares at most two blocks.
BLOCK = 1024
BLOCK_SHINGLES = 1 << 21
# Standard errors below the threshold at which an estimated pair is left out.
MARGIN = 6.0


def _seeds() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.Generator(np.random.PCG64(20))
    return (
        random.integers(0, 1 << 32, REGISTERS, dtype=np.uint64).astype(np.uint32) | np.uint32(1),
        random.integers(0, 1 << 32, REGISTERS, dtype=np.uint64).astype(np.uint32),
    )


FACTORS, SHIFTS = _seeds()


def registers(hashes: np.ndarray) -> np.ndarray:
    """The sketch of a non-empty set of 64-bit hashes: REGISTERS values of 16 bits."""
    keys = (hashes >> np.uint64(32)).astype(np.uint32) ^ hashes.astype(np.uint32)
    least = np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(keys), 512):
        mixed = keys[start : start + 512, None] * FACTORS + SHIFTS
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x85EBCA77)
        mixed ^= mixed >> np.uint32(13)
        np.minimum(least, mixed.min(axis=0), out=least)
    minimum = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(minimum) / np.log(BASE)), 0, TOP).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union."""
    return np.maximum(a, b)


def estimated_above(similarity, higher, lower, same, size_a, size_b) -> np.ndarray:
    """Whether the most likely similarity of two sets lies above the given one; for arrays of pairs.

    ``higher``, ``lower`` and ``same`` count the registers where the first sketch is larger, smaller,
    equal. With u, v the sets' shares of all elements and p(x) = -log_b(1 - x (b - 1) / b), a register
    is larger with probability p(u - v J) and smaller with p(v - u J). The logarithm of the joint
    likelihood has one maximum in J, which lies above a value where it still rises there.
    """
    u = size_a / (size_a + size_b)
    v = 1 - u
    scale = (BASE - 1) / BASE
    # Sets whose sizes rule the similarity out have no rising likelihood there.
    possible = np.minimum(size_a, size_b) >= similarity * np.maximum(size_a, size_b)
    x, y = np.clip(u - v * similarity, 1e-9, 1), np.clip(v - u * similarity, 1e-9, 1)
    p, q = -np.log1p(-x * scale) / np.log(BASE), -np.log1p(-y * scale) / np.log(BASE)
    dp, dq = (scale / (np.log(BASE) * (1 - z * scale)) for z in (x, y))
    slope = -higher * v * dp / p - lower * u * dq / q + same * (v * dp + u * dq) / np.maximum(1 - p - q, 1e-9)
    return possible & (slope >= 0)


def _bands(sketch: np.ndarray) -> np.ndarray:
    import xxhash

    rows = sketch.reshape(BANDS, BAND_REGISTERS)
    return np.array([xxhash.xxh3_64_intdigest(row.tobytes(), i) for i, row in enumerate(rows)], np.uint64).view(np.int64)


def sketched(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, node, bands) and the locator of every document; no node for an empty set.

    A node is the 128-bit digest of the sorted set, so documents of equal sets share it.
    """

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            sizes, nodes, bands = [], [], []
            for hashes in shingle_sets(batch.column("text").to_pylist(), WORDS):
                sizes.append(len(hashes))
                nodes.append(xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None)
                bands.append(_bands(registers(hashes)) if len(hashes) else None)
            made = [pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
            kept = [batch.column(name) for name in ("doc_id", "_file", "_row")]
            yield pa.RecordBatch.from_arrays([*kept, *made], names)

    names = ["doc_id", "_file", "_row", "n_shingles", "node", "bands"]
    located = with_locator(docs, [F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")])
    schema = "doc_id long, _file string, _row long, n_shingles long, node binary, bands array<long>"
    return located.mapInArrow(sketch, schema)


def _clusters(sketches: DataFrame) -> DataFrame:
    """(node, component): nodes that share a band with another, by cluster."""
    nodes = sketches.where("node is not null").groupBy("node").agg(F.min("bands").alias("bands"))
    banded = store(nodes.select("node", F.posexplode("bands").alias("band", "value")), "bands")
    keys = [F.col("band").alias("_band"), F.col("value").alias("_value")]
    firsts = banded.groupBy(*keys).agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # Null-safe keys have a shuffle of their own on either side, so a frequent band is split at run time.
    same = F.col("band").eqNullSafe(F.col("_band")) & F.col("value").eqNullSafe(F.col("_value"))
    edges = banded.join(firsts, same).where("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    return connected_components(edges)


def _blocks(clusters: DataFrame, sizes: DataFrame, block: int, block_shingles: int) -> DataFrame:
    """(node, cluster, x, y): the pairs of blocks in which a node is compared; (0, 0) in a small cluster.

    A cluster is cut by a hash into as many blocks as its nodes or their shingles ask for.
    """
    known = clusters.join(sizes, "node")
    totals = known.groupBy("component").agg(F.count(F.lit(1)).alias("_nodes"), F.sum("n_shingles").alias("_shingles"))
    n = F.ceil(F.greatest(F.col("_nodes") / block, F.col("_shingles") / block_shingles)).cast("int")
    # Null-safe keys have a shuffle of their own on either side, so a large cluster is split at run time.
    totals = totals.withColumnRenamed("component", "_cluster")
    cut = known.join(totals, F.col("component").eqNullSafe(F.col("_cluster"))).withColumn("_n", n)
    dealt = cut.select(
        "node",
        F.col("component").alias("cluster"),
        F.pmod(F.xxhash64("node"), F.col("_n")).cast("int").alias("_own"),
        "_n",
        F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_other"),
    )
    # A pair of two blocks also compares each with itself.
    return dealt.where("_n = 1 or _own <> _other").select(
        "node", "cluster", F.least("_own", "_other").alias("x"), F.greatest("_own", "_other").alias("y")
    )


def link_forest(sets: list[np.ndarray], threshold: int = THRESHOLD) -> np.ndarray:
    """For each set the first of its linked group, among the given non-empty sets.

    Candidates share a band and are estimated from both sketches not to lie far below the threshold.
    They are confirmed by counting all shared elements, unless already in one group.
    """
    n = len(sets)
    parent = np.arange(n)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return int(i)

    if n < 2:
        return parent
    limit = threshold / 100
    far = limit - MARGIN * np.sqrt(limit * (1 - limit) / REGISTERS)
    sketches = np.stack([registers(s) for s in sets])
    sizes = np.array([len(s) for s in sets])
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    lists = np.repeat(np.arange(n), sizes)[np.argsort(code, kind="stable")]
    lengths = np.bincount(code)
    starts = np.cumsum(lengths) - lengths
    at = np.concatenate([[0], np.cumsum(sizes)])
    for i in range(1, n):
        other = sketches[:i]
        same = other == sketches[i]
        near = np.flatnonzero(same.reshape(i, BANDS, BAND_REGISTERS).all(2).any(1))
        if not len(near):
            continue
        alike, above = same[near].sum(1), (other[near] > sketches[i]).sum(1)
        near = near[estimated_above(far, above, REGISTERS - alike - above, alike, sizes[near], sizes[i])]
        mine = root(i)
        near = np.array([j for j in near if root(j) != mine], int)
        if not len(near):
            continue
        own = code[at[i] : at[i + 1]]
        counts = lengths[own]
        base = np.repeat(starts[own] - (np.cumsum(counts) - counts), counts)
        shared = np.bincount(lists[base + np.arange(counts.sum())], minlength=n)[near]
        for j in near[100 * shared >= threshold * (sizes[i] + sizes[near] - shared)]:
            a, b = root(i), root(j)
            parent[max(a, b)] = min(a, b)
    return np.array([root(i) for i in range(n)])


def _linked(docs: DataFrame, sketches: DataFrame, blocks: DataFrame, threshold: int) -> DataFrame:
    """(a, b): a spanning forest of the links within each pair of blocks."""
    rows = sketches.where("node is not null").groupBy("node").agg(F.min(F.struct("_file", "_row")).alias("_at"))
    places = blocks.join(rows, "node").select("node", "cluster", "x", "y", "_at._file", "_at._row")
    wanted = places.groupBy("_file", "_row").agg(
        F.first("node").alias("node"), F.collect_list(F.struct("cluster", "x", "y")).alias("places")
    )
    texts = with_locator(docs, ["text"]).join(wanted, ["_file", "_row"])
    work = texts.select("node", "text", F.explode("places").alias("p")).select("node", "text", "p.cluster", "p.x", "p.y")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node")
        first = link_forest(list(shingle_sets(group["text"].tolist(), WORDS)), threshold)
        nodes = group["node"].to_numpy()
        rest = np.flatnonzero(first != np.arange(len(first)))
        return pd.DataFrame({"a": nodes[rest], "b": nodes[first[rest]]})

    return work.groupBy("cluster", "x", "y").applyInPandas(compare, "a binary, b binary")


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, and the locator.

    Documents are linked if 100 · |A ∩ B| ≥ threshold · |A ∪ B|; ``component_id`` is the smallest doc_id
    reachable. Null text is empty; a document without words has no shingles and no links. Rows with
    equal sets are linked whatever their doc_id, repeated rows included. A null doc_id names no
    component: a component with no other doc_id has none, and its rows are kept.
    """
    docs = landed(docs)
    with small_batches(docs.sparkSession):
        sketches = store(sketched(docs), "sketches")
    clusters = store(_clusters(sketches), "clusters")
    sizes = sketches.where("node is not null").groupBy("node").agg(F.min("n_shingles").alias("n_shingles"))
    blocks = store(_blocks(clusters, sizes, block, BLOCK_SHINGLES), "blocks")
    with small_batches(docs.sparkSession):
        links = store(_linked(docs, sketches, blocks, threshold), "links")
    groups = connected_components(links)
    named = (
        sketches.where("node is not null")
        .groupBy("node")
        .agg(F.min("doc_id").alias("least"))
        .join(groups, "node", "left")
        .select("node", "least", F.coalesce("component", "node").alias("component"))
    )
    least = named.groupBy(F.col("component").alias("_component")).agg(F.min("least").alias("component_id"))
    ids = named.join(least, F.col("component").eqNullSafe(F.col("_component"))).select("node", "component_id")
    found = sketches.drop("bands").join(ids, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        (component.isNull() | F.coalesce(F.col("doc_id") == component, F.lit(False))).alias("kept"),
        "_file",
        "_row",
    )


def keep_one(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The kept documents, all their columns, whatever their names. Rows: see near_duplicates."""
    docs = landed(docs)
    return rows_at(docs, near_duplicates(docs, threshold).where("not kept").select("_file", "_row"), "left_anti")


ORACLE = {
    "op8_setsketch_near_dedup": f"""
        WITH RECURSIVE {groups_sql(WORDS, THRESHOLD)}
        SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM grouped"""
}


def op8_setsketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of all documents whose 5-word shingles overlap by 85 of 100. Nulls and ties: see near_duplicates."""
    return near_duplicates(table(spark, sf_dir, "documents")).drop("_file", "_row")
