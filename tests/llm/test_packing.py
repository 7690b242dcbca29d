from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripledger.llm.packing import assemble, best_fit, op6_best_fit_packing, pack_documents, pack_pieces, pack_sizes
from tripledger.llm.tokens import Encoder, crc32, default_path


def check(rows, capacity):
    by = {}
    for row in rows:
        by.setdefault(row["sequence_id"], []).append(row)
    for members in by.values():
        at = 0
        for row in sorted(members, key=lambda r: r["offset"]):
            assert row["offset"] == at
            at += row["length"]
        assert at <= capacity
    return len(by)


def test_best_fit_takes_the_fullest_bin():
    bins, n = best_fit(np.array([10, 3, 5]), np.array([3, 5, 9, 2, 10]), 10)
    assert bins.tolist() == [1, 2, 3, 4, 0] and n == 5
    assert best_fit(np.zeros(0, int), np.zeros(0, int), 10)[1] == 0


def test_patterns_cover_all_counts():
    random = np.random.default_rng(3)
    for _ in range(20):
        sizes = np.sort(random.choice(np.arange(13, 100), 8, replace=False))
        counts = random.integers(1, 60, 8)
        plan = pack_sizes(sizes, counts, 100)
        assert (sum(p * t for p, t in plan) == counts).all()
        assert all((p * sizes).sum() <= 100 and t > 0 for p, t in plan)
        assert sum(t for _, t in plan) <= np.ceil((sizes * counts).sum() / 100) * 1.6 + 8


@pytest.mark.parametrize("kind", ["mixed", "equal", "small", "full"])
def test_packing_of_lengths(spark, kind):
    random = np.random.default_rng(4)
    n, capacity = 3000, 512
    lengths = {
        "mixed": np.minimum(capacity, random.lognormal(4.6, 0.9, n).astype(int) + 1),
        "equal": np.full(n, 171),
        "small": random.integers(1, 20, n),
        "full": np.full(n, capacity),
    }[kind]
    rows = [(i, 0, 0, int(x), i) for i, x in enumerate(lengths)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    packed = pack_pieces(pieces, capacity, part_pieces=1000).collect()
    assert sorted((r["doc_id"], r["length"]) for r in packed) == [(i, int(x)) for i, x in enumerate(lengths)]
    used = check(packed, capacity)
    least = 1500 if kind == "equal" else -(-int(lengths.sum()) // capacity)
    assert used <= least * 1.02 + 4


def test_edge_rows(spark, documents):
    path = default_path("word_bpe_49k.json")
    packed = pack_documents(documents, capacity=1000).collect()
    check(packed, 1000)
    encode = Encoder(path)
    expected = []
    for row in documents.collect():
        ids = np.append(np.frombuffer(encode([row["text"]])[0], "<u4"), 1).astype("<u4")
        expected += [(row["doc_id"], k, s, len(ids[s : s + 1000]), crc32(ids[s : s + 1000].tobytes())) for k, s in enumerate(range(0, len(ids), 1000))]
    order = lambda row: tuple(-1 if v is None else v for v in row)
    found = [tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in packed]
    assert sorted(found, key=order) == sorted(expected, key=order)
    assert pack_documents(documents.limit(0)).count() == 0


def test_query(spark):
    packed = op6_best_fit_packing(spark, "/root/testdata/sf0.001")
    rows = packed.collect()
    used = check(rows, 4096)
    assert used <= -(-sum(r["length"] for r in rows) // 4096) * 1.03 + 2
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in docs.select("doc_id").collect()}
    ids = assemble(docs, packed, default_path("word_bpe_49k.json"))
    totals = {r["sequence_id"]: r["n"] for r in ids.select("sequence_id", F.size("ids").alias("n")).collect()}
    assert sum(totals.values()) == sum(r["length"] for r in rows) and len(totals) == used


def test_parts_follow_the_sequences_with_room(spark):
    rows = [(i, 0, 0, 300 if i < 1000 else 10, i) for i in range(1020)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    packed = pack_pieces(pieces, 512, part_pieces=100).collect()
    assert len(packed) == 1020 and check(packed, 512) == 1000
    # Ten parts, each of which fills a sequence of its own first.
    assert len({r["sequence_id"] for r in packed if r["length"] == 10}) == 10
