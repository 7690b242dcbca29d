from __future__ import annotations

import random
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tripledger.llm import signature_tree
from tripledger.llm.shingles import shingle_sets
from tripledger.llm.signature_tree import candidates, least_overlap, linked, prefix_length, similar_groups, similar_sets
from tripledger.llm.tables import global_positions, store


def planted(n_groups, seed):
    """Groups of texts with ever more words changed, around and below the threshold."""
    draw = random.Random(seed)
    words, rows = [f"w{i}" for i in range(3000)], []
    for _ in range(n_groups):
        base = [draw.choice(words) for _ in range(draw.randint(3, 160))]
        for _ in range(draw.randint(1, 12)):
            copy = list(base)
            for _ in range(draw.randint(0, 4)):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            rows.append(" ".join(copy))
    return [(i * 3, text) for i, text in enumerate(rows)]


def plain_set(text, words=4):
    text = "".join(c.lower() if c.isascii() else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        text = text.replace(blank, " ")
    found = [w for w in text.split(" ") if w]
    return {tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))} if found else set()


def plain_links(sets, threshold=85):
    lists, links = defaultdict(list), set()
    for i, own in enumerate(sets):
        shared = defaultdict(int)
        for s in own:
            for j in lists[s]:
                shared[j] += 1
            lists[s].append(i)
        links |= {(j, i) for j, n in shared.items() if 100 * n >= threshold * (len(own) + len(sets[j]) - n)}
    return links


def plain_groups(rows, threshold=85):
    sets = [plain_set(text) for _, text in rows]
    group = list(range(len(rows)))
    for i, j in plain_links(sets, threshold):
        old, new = max(group[i], group[j]), min(group[i], group[j])
        group = [new if g == old else g for g in group]
    least = {}
    for g, (doc_id, _) in zip(group, rows, strict=True):
        if doc_id is not None:
            least[g] = min(least.get(g, doc_id), doc_id)
    return sorted(((i, len(s), least.get(g) if s else i) for (i, _), s, g in zip(rows, sets, group, strict=True)), key=str)


def groups(frame, **options):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in similar_groups(frame, **options).collect()), key=str)


def test_bounds():
    for n in range(1, 300):
        for m in range(n, 300):
            need = least_overlap(n, m, 85)
            assert 100 * need >= 85 * (n + m - need) and (need == 0 or 100 * (need - 1) < 85 * (n + m - need + 1))
            if need <= n:
                # A linked set of size m misses at most all but that many: the prefix is too long to be missed.
                assert prefix_length(m, 85) > m - need and prefix_length(n, 85) > n - need


@pytest.mark.parametrize("threshold", [60, 85])
def test_tree_pairs_against_all_pairs(threshold):
    sets = [np.unique(np.array([hash(x) & 0xFFFFFFFFFFFF for x in plain_set(text)], np.uint64)) for _, text in planted(40, 7)]
    draw = random.Random(1)
    sets += [sets[0][: max(1, k)] for k in range(0, len(sets[0]), 3)]
    draw.shuffle(sets)
    plain = [set(s.tolist()) for s in sets]
    links = plain_links(plain, threshold)
    assert links and links <= {tuple(p) for p in candidates(sets, None, threshold).tolist()}
    assert set(linked(sets, None, threshold, forest=False)) == links
    left, right = sets[:150], sets[150:]
    assert {(i, j + 150) for i, j in linked(left, right, threshold, forest=False)} == {(i, j) for i, j in links if i < 150 <= j}
    assert len(candidates(sets, None, threshold)) < len(sets) ** 2 / 8


@pytest.mark.parametrize("page_sets", [1024, 16, 3])
def test_against_plain_groups(spark, page_sets):
    rows = planted(30, 3)
    common = " ".join(f"all{i}" for i in range(25))
    rows += [(5000 + i, f"{common} " + " ".join(f"own{i}x{j}" for j in range(30))) for i in range(60)]
    base = [f"b{j}" for j in range(140)]
    rows += [(6000 + i, " ".join(base[:i] + [f"new{i}"] + base[i + 1 :])) for i in range(100)]
    assert groups(spark.createDataFrame(rows, "doc_id long, text string"), page_sets=page_sets) == plain_groups(rows)


def test_all_links(spark):
    rows = planted(25, 9)
    links, known = similar_sets(spark.createDataFrame(rows, "doc_id long, text string"), page_sets=8)
    of = {bytes(r["set_id"]): r["doc_id"] for r in known.orderBy(F.desc("doc_id")).collect() if r["set_id"]}
    place = {doc_id: i for i, (doc_id, _) in enumerate(rows)}
    found = [tuple(sorted((place[of[bytes(r["a"])]], place[of[bytes(r["b"])]]))) for r in links.collect()]
    sets = [plain_set(text) for _, text in rows]
    texts = {frozenset(s): i for i, s in reversed([*enumerate(sets)])}
    expected = {(i, j) for i, j in plain_links(sets) if texts[frozenset(sets[i])] == i and texts[frozenset(sets[j])] == j}
    assert len(found) == len(set(found)) and set(found) == expected


def test_edge_rows(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert groups(documents) == plain_groups(rows)
    odd = documents.withColumnsRenamed({"component": "tree", "lang": "set_id", "source": "a.b"})
    assert groups(odd) == plain_groups(rows)
    assert similar_groups(documents.limit(0)).count() == 0
    one = spark.createDataFrame([(1, "one word"), (None, "one  word"), (3, "two")], "doc_id long, text string")
    assert groups(one) == [(1, 1, 1), (3, 1, 3), (None, 1, 1)]


def test_shingles_of_four_words():
    assert [len(s) for s in shingle_sets(["a b c", "a b c d", "a b c d e", " "], signature_tree.WORDS)] == [1, 1, 2, 0]


def test_workers_get_few_texts_at_once(spark, monkeypatch):
    """Texts are hashed as they are asked for, and reach Python some MB at a time in every step that runs there."""
    asked = []
    next(shingle_sets(asked.append(i) or "word " * 1000 for i in range(1000)))
    assert len(asked) < 100

    batches = {}
    long_texts = spark.range(0, 20_000, 1, 1).selectExpr("repeat('x', 500) AS text")

    def largest(df, name):
        sizes = long_texts.mapInArrow(lambda found: (pa.RecordBatch.from_pylist([{"n": b.num_rows, "size": b.nbytes}]) for b in found), "n long, size long")
        batches[name] = tuple(sizes.agg(F.max("n"), F.max("size")).first())
        return store(df, name)

    docs = store(spark.createDataFrame([(i, f"a b c d e f g h i j {i // 2}") for i in range(20)], "doc_id long, text string"), "docs")
    monkeypatch.setattr(signature_tree, "store", largest)
    similar_sets(docs, page_sets=4)
    for step in ("described", "page-pairs", "links"):
        n, size = batches[step]
        assert n <= 1000 and size < 5e6


def test_tokens_stay_out_of_the_join_with_trees(spark, monkeypatch):
    """Where sets meet their trees, no side of a join has a list: shuffled, it would be the largest thing there."""
    joined = []

    def lists(plan):
        children = [plan.children().apply(i) for i in range(plan.children().size())]
        if plan.nodeName() == "Join":
            joined.append([f"{a.name()} {a.dataType().simpleString()}" for c in children for a in (c.output().apply(i) for i in range(c.output().size()))])
        for child in children:
            lists(child)

    def placed(df, order, name):
        lists(df._jdf.queryExecution().optimizedPlan())
        return global_positions(df, order, name)

    docs = store(spark.createDataFrame(planted(10, 5), "doc_id long, text string"), "docs")
    monkeypatch.setattr(signature_tree, "global_positions", placed)
    similar_sets(docs)
    assert joined and not [column for columns in joined for column in columns if "array" in column]


def test_tokens_are_kept_once(spark):
    """The token lists of documents go when those of sets are stored, and the result doesn't need them."""
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    docs = store(spark.createDataFrame(planted(5, 2), "doc_id long, text string"), "docs")
    before = set(shared.iterdir())
    result = similar_groups(docs)
    made = [spark.read.parquet(str(folder)) for folder in set(shared.iterdir()) - before]
    assert sum("tokens" in table.columns for table in made) == 1
    assert result.count() == docs.count()
