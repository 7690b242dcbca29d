"""Jaccard join of word shingles by signature trees.

A document's set is its distinct shingles of four words. Every set has a bitmap with a bit for each
shingle's hash; a node of a tree holds the OR of the bitmaps below it, the range of their set sizes, and
the largest excess of a set's size over its bits. Two nodes can hold a linked pair only if their size
ranges allow it and the bits they share, plus the smaller excess, reach the least overlap of such a pair.
Trees are traversed two nodes at a time from the roots, and a pair of nodes is left as soon as it can't.

The top of the forest are shared shingles. In a global order, rarest first, linked sets share a shingle
among their first few, so sets that meet in none of these belong to different trees. A tree's sets are
sorted by size and first shingle and cut into pages of bounded size. Above the pages, nodes are rows of a
table, and the traversal is a join of node pairs with the children of both, level by level; below them a
task traverses the small trees of two pages in numpy. Pairs of sets that are left are intersected in full.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger.llm.components import connected_components
from tripledger.llm.shingles import groups_sql, shingle_sets
from tripledger.llm.tables import global_positions, joined_at, landed, small_batches, store, stored_within, table, with_locator

# Words of a shingle; 100 * intersection >= THRESHOLD * union.
WORDS, THRESHOLD = 4, 85
# Bits of a bitmap, as bitmap_or_agg has them.
BITS = 32_768
# The order of shingles begins with those of small hashes, this share of all, rarest first; then the others.
POOL = 0.25
# Sets and shingles of a page; a task holds two. Children of a node, above the pages and within them.
PAGE_SETS, PAGE_SHINGLES = 1024, 1 << 20
FANOUT_BITS, TREE_FANOUT = 4, 8


def prefix_length(n, threshold: int):
    """So many shingles of a set of n, in a global order, hold one of any linked set's first."""
    return n - -(-threshold * n // 100) + 1


def least_overlap(a, b, threshold: int):
    """Shingles that linked sets of sizes a and b share, at least."""
    return -(-threshold * (a + b) // (100 + threshold))


def bitmap(hashes: np.ndarray) -> np.ndarray:
    """The bitmap of a set, as bytes."""
    bits = np.zeros(BITS, bool)
    bits[(hashes & np.uint64(BITS - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little")


def _size_class(n: Column, threshold: int) -> Column:
    """Sizes of linked sets lie in one class or in neighbouring ones."""
    return F.floor(F.log(n.cast("double")) / float(np.log(100 / threshold))).cast("int")


def described(docs: DataFrame, threshold: int, words: int) -> DataFrame:
    """(doc_id, n_shingles, set_id, tokens) and the locator of every document; no set_id for an empty set.

    ``tokens`` are the set's hashes below POOL of all, or as many of the smallest as a prefix has if these
    are more; hashes are in unsigned order, given as signed numbers.
    """
    top = np.uint64(int(POOL * 2**64))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            sizes, ids, tokens = [], [], []
            for hashes in shingle_sets(batch.column("text").to_pylist(), words):
                n = len(hashes)
                sizes.append(n)
                ids.append(xxhash.xxh3_128_digest(hashes.tobytes()) if n else None)
                few = max(int(np.searchsorted(hashes, top)), prefix_length(n, threshold)) if n else 0
                tokens.append(hashes[:few].view(np.int64))
            kept = [batch.column(name) for name in ("doc_id", "_file", "_row")]
            made = [pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), pa.array(tokens, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*kept, *made], names)

    names = ["doc_id", "_file", "_row", "n_shingles", "set_id", "tokens"]
    located = with_locator(docs, [F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")])
    return located.mapInArrow(describe, "doc_id long, _file string, _row long, n_shingles long, set_id binary, tokens array<long>")


def _trees(sets: DataFrame, threshold: int) -> DataFrame:
    """(s, tree): sets that may be linked with another, by the tree they belong to."""
    tokens = sets.select("s", F.explode("tokens").alias("token"))
    shared = store(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "shared-tokens")
    late = (F.col("token") < 0) | (F.col("token") >= F.lit(int(POOL * 2**64)))
    # Shuffled as plain rows: lists of the few that meet in one task take twice the room.
    met = tokens.join(shared, "token").select("s", "token", "df").repartition("s")
    by_set = met.groupBy("s").agg(F.array_sort(F.collect_list(F.struct(late.alias("late"), "df", "token"))).alias("shared"))
    # What is not shared comes first in the order, but links nothing.
    pooled = F.expr("size(filter(tokens, t -> t >= 0 and t < pool))")
    known = sets.withColumn("pool", F.lit(int(POOL * 2**64))).select("s", F.col("n_shingles").alias("n"), pooled.alias("n_pool"))
    n_first = F.col("n") - F.ceil(F.lit(threshold) * F.col("n") / 100) + 1
    own = F.col("n_pool") - F.expr("size(filter(shared, x -> not x.late))")
    first = by_set.join(known, "s").withColumn("_take", F.greatest(n_first - own, F.lit(0)).cast("int"))
    prefix = store(first.select("s", F.explode(F.expr("slice(shared, 1, _take)")).alias("x")).select("s", "x.token"), "prefixes")
    roots = prefix.groupBy(F.col("token").alias("_token")).agg(F.min("s").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # Null-safe keys have a shuffle of their own on either side, so a frequent shingle is split at run time.
    met = prefix.join(roots, F.col("token").eqNullSafe(F.col("_token"))).where("s <> least")
    # A set and all it meets are tied to the smallest of them: few edges, as sets that are alike meet the same ones.
    around = met.groupBy("s").agg(F.min("least").alias("b"), F.collect_set("least").alias("others"))
    edges = around.select(F.explode(F.array_union(F.array("s"), "others")).alias("a"), "b")
    return connected_components(edges).select(F.col("node").alias("s"), F.col("component").alias("tree"))


def _paged(docs: DataFrame, sets: DataFrame, trees: DataFrame, threshold: int, page_sets: int) -> DataFrame:
    """(tree, at, page, alone, set_id, n, text): the sets in the order of their trees, cut into pages, with their texts.

    Of ``sets`` what is read here is narrow, without ``tokens``: all of it may be shuffled to meet the trees. A page is a run of equal size class, so that its bound in shingles bounds its sets; its number is the
    class and the run's. ``at`` is the place of the set in units of ``page_sets``. ``alone``: its tree has one page.
    """
    n = F.col("n_shingles")
    narrow = sets.select("s", "set_id", n.alias("n"), _size_class(n, threshold).alias("class"), "first", "at.*")
    members = narrow.join(trees, "s")
    placed = global_positions(members, ["tree", "class", "first", "s"], "place")
    largest = F.pow(F.lit(100 / threshold), F.col("class") + 1)
    room = F.greatest(F.lit(1), F.least(F.lit(page_sets), F.floor(F.lit(PAGE_SHINGLES) / largest)))
    page = F.shiftleft(F.col("class").cast("long"), 40) + F.floor(F.col("place") / room)
    at = F.floor(F.col("place") / page_sets)
    cut = store(placed.select("tree", at.alias("at"), page.alias("page"), "set_id", "n", "_file", "_row"), "pages")
    single = cut.groupBy(F.col("tree").alias("_tree")).agg((F.min("page") == F.max("page")).alias("alone"))
    paged = store(cut.join(single, F.col("tree").eqNullSafe(F.col("_tree"))).drop("_tree"), "paged")
    return joined_at(docs, ["text"], paged, "paged-texts").drop("_file", "_row")


def _signed(paged: DataFrame, words: int) -> DataFrame:
    """(tree, at, page, n, bits, excess) of the given sets, from their texts."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits, excess = [], []
            for hashes in shingle_sets(batch.column("text").to_pylist(), words):
                own = bitmap(hashes)
                bits.append(own.tobytes())
                excess.append(len(hashes) - int(np.bitwise_count(own).sum()))
            kept = [batch.column(name) for name in ("tree", "at", "page", "n")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(bits, pa.binary()), pa.array(excess, pa.int64())], names)

    names = ["tree", "at", "page", "n", "bits", "excess"]
    return paged.select("tree", "at", "page", "n", "text").mapInArrow(sign, "tree long, at long, page long, n long, bits binary, excess long")


def _shared_bits(a: pd.Series, b: pd.Series) -> pd.Series:
    pairs = zip(a, b, strict=True)
    return pd.Series([int(np.bitwise_count(np.frombuffer(x, "<u8") & np.frombuffer(y, "<u8")).sum()) for x, y in pairs], dtype="int64")


def _possible(pairs: DataFrame, threshold: int) -> DataFrame:
    """The pairs of nodes x and y that may hold linked sets."""
    sizes = (F.col("x.most") * 100 >= F.col("y.least") * threshold) & (F.col("y.most") * 100 >= F.col("x.least") * threshold)
    shared = F.pandas_udf(_shared_bits, "long")("x.bits", "y.bits") + F.least("x.excess", "y.excess")
    needed = F.ceil((F.col("x.least") + F.col("y.least")) * threshold / F.lit(100 + threshold))
    bounded = pairs.where(sizes).withColumn("overlap", F.least(shared, "x.most", "y.most"))
    return bounded.where((F.col("x.id") == F.col("y.id")) | (F.col("overlap") >= needed)).select("tree", F.col("x.id").alias("x"), F.col("y.id").alias("y"))


def _page_pairs(paged: DataFrame, threshold: int, words: int) -> DataFrame:
    """(tree, x, y): pairs of pages that may hold linked sets, by traversing the nodes above the pages of ``paged``.

    All of its trees have several pages. A node's children are those whose place, in units of its own, it has; there are at most a few roots.
    """
    most = paged.groupBy("tree").agg(F.countDistinct("page").alias("pages")).agg(F.max("pages")).first()[0]
    if most is None:
        return paged.select("tree", F.col("page").alias("x"), F.col("page").alias("y"))
    summed = [F.expr("bitmap_or_agg(bits)").alias("bits"), F.min("least").alias("least"), F.max("most").alias("most"), F.max("excess").alias("excess")]
    up = F.shiftright("at", FANOUT_BITS)
    signed = _signed(paged, words).withColumns({"least": F.col("n"), "most": F.col("n")})
    leaves = signed.groupBy("tree", F.col("page").alias("id")).agg(*summed, F.min("at").alias("at"))
    nodes = [store(leaves.withColumn("up", up), "tree-nodes")]
    for _ in range(int(np.ceil(np.log2(most) / FANOUT_BITS)) - 1):
        above = nodes[-1].groupBy("tree", F.col("up").alias("id")).agg(*summed).withColumn("at", F.col("id"))
        nodes.append(store(above.withColumn("up", up), "tree-nodes"))
    node = F.struct("id", "bits", "least", "most", "excess")
    sides = [[level.select("tree", node.alias(side), F.col("up").alias(f"{side}_up")) for side in "xy"] for level in nodes]
    x, y = sides.pop()
    frontier = store(_possible(x.join(y, "tree").where("x.id <= y.id"), threshold), "frontier")
    for x, y in reversed(sides):
        parents = frontier.select("tree", F.col("x").alias("x_up"), F.col("y").alias("y_up"))
        met = parents.join(x, ["tree", "x_up"]).join(y, ["tree", "y_up"]).where("x_up <> y_up or x.id <= y.id")
        frontier = store(_possible(met, threshold), "frontier")
    return frontier


def _levels(sets: Sequence[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The nodes (bitmaps, least, most, excess) of each level of a tree, the sets first."""
    sizes = np.array([len(s) for s in sets])
    bits = np.stack([bitmap(s).view("<u8") for s in sets])
    levels = [(bits, sizes, sizes, sizes - np.bitwise_count(bits).sum(1).astype(np.int64))]
    while len(levels[-1][1]) > TREE_FANOUT:
        bits, least, most, excess = levels[-1]
        cuts = np.arange(0, len(least), TREE_FANOUT)
        levels.append((np.bitwise_or.reduceat(bits, cuts), np.minimum.reduceat(least, cuts), np.maximum.reduceat(most, cuts), np.maximum.reduceat(excess, cuts)))
    return levels


def candidates(left: Sequence[np.ndarray], right: Sequence[np.ndarray] | None, threshold: int) -> np.ndarray:
    """Pairs (i, j) of sets that the bounds let through, by traversing two trees, or one with itself (i < j)."""
    a = _levels(left)
    b = a if right is None else _levels(right)
    # Trees of different heights meet at the lower one's roots.
    height = min(len(a), len(b))
    pairs = np.stack(np.meshgrid(np.arange(len(a[height - 1][1])), np.arange(len(b[height - 1][1])), indexing="ij"), -1).reshape(-1, 2)
    for level in range(height - 1, -1, -1):
        if right is None:
            pairs = pairs[pairs[:, 0] <= pairs[:, 1]] if level else pairs[pairs[:, 0] < pairs[:, 1]]
        (bits_a, least_a, most_a, excess_a), (bits_b, least_b, most_b, excess_b) = a[level], b[level]
        i, j = pairs.T
        pairs = pairs[(100 * most_a[i] >= threshold * least_b[j]) & (100 * most_b[j] >= threshold * least_a[i])]
        kept = []
        for low in range(0, len(pairs), 1024):
            part = pairs[low : low + 1024]
            i, j = part.T
            shared = np.bitwise_count(bits_a[i] & bits_b[j]).sum(1, dtype=np.int64) + np.minimum(excess_a[i], excess_b[j])
            reach = np.minimum(shared, np.minimum(most_a[i], most_b[j]))
            kept.append(part[reach >= least_overlap(least_a[i], least_b[j], threshold)])
        pairs = np.concatenate(kept) if kept else pairs
        if level:
            below = np.arange(TREE_FANOUT)
            i, j = np.broadcast_arrays(pairs[:, 0, None, None] * TREE_FANOUT + below[:, None], pairs[:, 1, None, None] * TREE_FANOUT + below)
            inside = (i < len(a[level - 1][1])) & (j < len(b[level - 1][1]))
            pairs = np.stack([i[inside], j[inside]], -1)
    return pairs


def linked(left: Sequence[np.ndarray], right: Sequence[np.ndarray] | None, threshold: int, forest: bool) -> list[tuple[int, int]]:
    """Pairs (i, j) with enough shared elements; as a forest, none whose sets other pairs tie together already."""
    parent = list(range(len(left) + len(right or ())))
    shift = 0 if right is None else len(left)
    other = left if right is None else right

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    found = []
    for i, j in candidates(left, right, threshold).tolist():
        x, y = root(i), root(j + shift)
        if forest and x == y:
            continue
        a, b = left[i], other[j]
        at = np.searchsorted(b, a)
        shared = int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a))
        if 100 * shared >= threshold * (len(a) + len(b) - shared):
            parent[max(x, y)] = min(x, y)
            found.append((i, j))
    return found


def _links(paged: DataFrame, pairs: DataFrame, threshold: int, words: int, forest: bool) -> DataFrame:
    """(a, b): linked sets of each pair of pages, or a forest of them. Trees of one page share tasks by page."""
    columns = ["tree", "page", "set_id", "text", "x", "y", "task"]
    single = paged.where("alone").withColumns({"x": F.col("page"), "y": F.col("page"), "task": F.lit(-1).cast("long")})
    sides = pairs.select("tree", "x", "y", F.explode(F.array_distinct(F.array("x", "y"))).alias("page"))
    several = paged.where("not alone").join(sides, ["tree", "page"]).withColumn("task", F.col("tree"))
    dealt = single.select(*columns).unionAll(several.select(*columns))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["tree", "page", "set_id"], ignore_index=True)
        sets = list(shingle_sets(group["text"].tolist(), words))
        trees, pages, ids = group["tree"].to_numpy(), group["page"].to_numpy(), group["set_id"].to_numpy()
        x, y = group["x"].iloc[0], group["y"].iloc[0]
        found = []
        for own in np.split(np.arange(len(sets)), np.flatnonzero(np.diff(trees)) + 1):
            # Similar sets stand together if they begin with the same smallest hash.
            own = own[np.argsort([sets[k][0] for k in own], kind="stable")]
            i, j = (own, None) if x == y else (own[pages[own] == x], own[pages[own] == y])
            if len(own) < 2 or j is not None and not (len(i) and len(j)):
                continue
            links = linked([sets[k] for k in i], j if j is None else [sets[k] for k in j], threshold, forest)
            found += [(ids[i[a]], ids[(i if j is None else j)[b]]) for a, b in links]
        return pd.DataFrame(found, columns=["a", "b"])

    return dealt.groupBy("task", "x", "y").applyInPandas(compare, "a binary, b binary")


def _joined(docs: DataFrame, threshold: int, words: int, page_sets: int, forest: bool) -> tuple[DataFrame, DataFrame]:
    """The described documents, and the linked sets (a, b)."""
    with small_batches(docs.sparkSession):
        with stored_within(described(docs, threshold, words), "described-tokens") as full:
            sets = full.where("set_id is not null").groupBy("set_id").agg(
                F.min(F.struct("_file", "_row")).alias("at"), F.min("n_shingles").alias("n_shingles"), F.min("tokens").alias("tokens")
            )
            # Numbers of a stored table stay. From here on tokens are kept once, by set.
            sets = store(sets.withColumns({"s": F.monotonically_increasing_id(), "first": F.element_at("tokens", 1)}), "sets")
            known = store(full.drop("tokens"), "described")
        paged = _paged(docs, sets, store(_trees(sets, threshold), "trees"), threshold, page_sets)
        pairs = store(_page_pairs(paged.where("not alone"), threshold, words), "page-pairs")
        return known, store(_links(paged, pairs, threshold, words, forest), "links")


def similar_sets(docs: DataFrame, threshold: int = THRESHOLD, words: int = WORDS, page_sets: int = PAGE_SETS) -> tuple[DataFrame, DataFrame]:
    """All links between different sets as (a, b) of set ids, and the documents' set ids (doc_id, n_shingles, set_id, locator).

    Documents of equal sets share the id and are linked too. See :func:`similar_groups` for what counts.
    """
    known, links = _joined(landed(docs), threshold, words, page_sets, forest=False)
    return links, known


def similar_groups(docs: DataFrame, threshold: int = THRESHOLD, words: int = WORDS, page_sets: int = PAGE_SETS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, and the locator.

    Documents are linked if 100 · |A ∩ B| ≥ threshold · |A ∪ B|, and ``component_id`` is the smallest doc_id
    reachable. A text of fewer words than a shingle is one shingle; null, empty and blank texts have none and
    no links. Rows with equal sets are linked whatever their doc_id, repeated rows included. A null doc_id
    names no component; a component without another doc_id has none. An empty table gives no row.
    """
    known, links = _joined(landed(docs), threshold, words, page_sets, forest=True)
    groups = connected_components(links)
    named = (
        known.where("set_id is not null")
        .groupBy("set_id")
        .agg(F.min("doc_id").alias("least"))
        .join(groups.withColumnRenamed("node", "set_id"), "set_id", "left")
        .select("set_id", "least", F.coalesce("component", "set_id").alias("component"))
    )
    named = store(named, "named-sets")
    least = store(named.groupBy("component").agg(F.min("least").alias("component_id")), "components")
    ids = named.join(least, "component").select("set_id", "component_id")
    component = F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return known.join(ids, "set_id", "left").select("doc_id", "n_shingles", component.alias("component_id"), "_file", "_row")


def op12_signature_tree_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of all documents whose 4-word shingles overlap by 85 of 100. Nulls and ties: see similar_groups."""
    return similar_groups(table(spark, sf_dir, "documents")).drop("_file", "_row")


ORACLE = {
    "op12_signature_tree_join": f"WITH RECURSIVE {groups_sql(WORDS, THRESHOLD)} SELECT doc_id, n_shingles, component_id FROM grouped"
}
