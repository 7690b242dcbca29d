from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from tripledger.llm.components import connected_components
from tripledger.llm.near_dedup import BAND_REGISTERS, BANDS, REGISTERS, estimated_above, keep_one, link_forest, merge, near_duplicates, registers
from tripledger.llm.shingles import shingle_sets, word_hashes


def plain_set(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_components(rows, threshold=85):
    sets = [plain_set(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    lists = defaultdict(list)
    for i, own in enumerate(sets):
        shared = defaultdict(int)
        for s in own:
            for j in lists[s]:
                shared[j] += 1
            lists[s].append(i)
        for j, n in shared.items():
            if 100 * n >= threshold * (len(own) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return [(doc_id, len(sets[i]), least.get(root(i))) for i, (doc_id, _) in enumerate(rows)]


def planted(n_groups=12, seed=1):
    """Groups of texts with ever more words changed, around and below the threshold."""
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    rows = []
    for _ in range(n_groups):
        base = [draw.choice(words) for _ in range(draw.randint(3, 160))]
        for _ in range(draw.randint(1, 12)):
            copy = list(base)
            for _ in range(draw.randint(0, 4)):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            rows.append(" ".join(copy))
    return [(i * 3, text) for i, text in enumerate(rows)]


def test_word_hashes():
    a, b, c = word_hashes(["The fox\nthe\tFOX", "fox", ""])
    assert a[0] == a[2] and a[1] == a[3] == b[0] and len(c) == 0
    assert [len(s) for s in shingle_sets(["a b c", "a b c d e f", None, " \n", "É é"])] == [1, 2, 0, 0, 1]
    big = " ".join(f"x{i}" for i in range(400_000))
    (whole,) = word_hashes([big])
    assert len(np.unique(whole)) == 400_000


def test_sketches():
    draw = np.random.default_rng(1)
    for similarity in (0.3, 0.7, 0.85, 0.95):
        shared = int(2000 * similarity)
        pool = draw.integers(0, 1 << 63, 4000 - shared, dtype=np.uint64)
        a, b = pool[:2000], pool[2000 - shared :]
        true = shared / len(pool)
        x, y = registers(a), registers(b)
        assert (merge(x, y) == registers(pool)).all()
        same, higher = (x == y).sum(), (x > y).sum()
        error = 4 * np.sqrt(true * (1 - true) / REGISTERS)
        counts = (higher, REGISTERS - higher - same, same, 2000.0, 2000.0)
        assert estimated_above(true - error, *counts) and not estimated_above(true + error, *counts)


@pytest.mark.parametrize("block", [1024, 7])
def test_against_plain_sets(spark, block):
    rows = planted()
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block=block)
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.orderBy("doc_id").collect()]
    assert got == plain_components(rows)


def test_forest_of_equal_and_distant_sets():
    a, b = np.arange(100, dtype=np.uint64) * np.uint64(977), np.arange(5, 105, dtype=np.uint64) * np.uint64(977)
    assert link_forest([a, a, b, b + np.uint64(1)]).tolist() == [0, 0, 0, 3]
    assert link_forest([a]).tolist() == [0] and link_forest([]).tolist() == []


def test_edge_rows(spark, documents):
    found = near_duplicates(documents)
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    expected = [(i, n, i if n == 0 else c) for i, n, c in plain_components(rows)]
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect()), key=str) == sorted(expected, key=str)
    kept = keep_one(documents)
    assert kept.columns == documents.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([1, 3, 4, 5, 5, None, 7, 8, 9], key=str)
    assert near_duplicates(documents.limit(0)).count() == 0


def test_keep_one_from_a_similarity_of_four_fifths(spark):
    # 100 words have 96 shingles; other words at the last k places leave 96 - k in both: (96 - k) / (96 + k).
    rows = []
    for base in (0, 100, 200):
        words = [f"w{base}x{j}" for j in range(100)]
        rows += [(base + k, " ".join([*words[: 100 - k], *(f"new{base}x{k}x{j}" for j in range(k))])) for k in (0, 9, 10, 11)]
    kept = {t: sorted(i for i, _, c in plain_components(rows, t) if i == c) for t in (80, 85)}
    assert kept[80] != kept[85]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in keep_one(docs, 80).collect()) == kept[80]
    assert all((1 - (t / 100) ** BAND_REGISTERS) ** BANDS < 5e-6 for t in (80, 85))


def test_components(spark):
    draw = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(200, 200 + draw.randint(1, 90)) for _ in range(80)] + [(500, 501), (501, 500), (7, 7)]
    frame = spark.createDataFrame([(str(a).zfill(4).encode(), str(b).zfill(4).encode()) for a, b in edges], "a binary, b binary")
    got = {int(r["node"]): int(r["component"]) for r in connected_components(frame).collect()}
    assert all(got[i] == 0 for i in range(61)) and got[501] == 500
    assert all(got[b] == 200 for a, b in edges if a == 200)
    assert connected_components(frame.limit(0)).count() == 0
