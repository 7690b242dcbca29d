from __future__ import annotations

import random

from tripledger.llm.decontamination import COVERAGE, MIN_MATCH, greedy_tiles, keep_clean, op10_greedy_tiling_decontamination, tiled_items, words_of


def plain_tiles(item, text, min_match):
    """Greedy string tiling by trying all places, round by round."""
    marked_a, marked_b, tiles = set(), set(), []
    while True:
        best = []
        longest = min_match - 1
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while i + n < len(item) and j + n < len(text) and item[i + n] == text[j + n] and i + n not in marked_a and j + n not in marked_b:
                    n += 1
                if n > longest:
                    longest, best = n, [(i, j)]
                elif n == longest and n >= min_match:
                    best.append((i, j))
        if not best:
            return tiles
        for i, j in best:
            if all(i + k not in marked_a and j + k not in marked_b for k in range(longest)):
                marked_a.update(range(i, i + longest))
                marked_b.update(range(j, j + longest))
                tiles.append((i, j, longest))


def test_tiles_equal_the_plain_form():
    draw = random.Random(3)
    for _ in range(300):
        letters = "abcdefgh"[: draw.randint(2, 8)]
        item = [draw.choice(letters) for _ in range(draw.randint(0, 25))]
        text = [draw.choice(letters) for _ in range(draw.randint(0, 40))]
        for _ in range(draw.randint(0, 3)):
            if item:
                at = draw.randrange(len(item))
                text[draw.randint(0, len(text)) : 0] = item[at : at + draw.randint(1, 12)]
        for least in (2, 5):
            assert greedy_tiles(item, text, least) == plain_tiles(item, text, least)


ITEM = "one two three four five six seven eight nine ten eleven twelve"


def test_edge_rows(spark, documents):
    swapped = "seven EIGHT nine, ten eleven twelve - and then: one two three four five six."
    rows = [(20, f"before {ITEM} after"), (21, swapped), (22, "one two three four five and no more"), (23, "tiny"), (24, ITEM), (24, ITEM)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(documents.select("doc_id", "text"))
    items = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (None, "tiny"), (5, "!?")], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"], r["covered_words"], r["n_tiles"], r["longest"]) for r in tiled_items_of(docs, items).collect()}
    assert found == {(20, 1, 12, 1, 12), (21, 1, 12, 2, 6), (23, None, 1, 1, 1), (24, 1, 12, 1, 12)}
    assert tiled_items_of(docs, items).count() == 5
    kept = keep_clean(documents.withColumnRenamed("component", "coverage"), items)
    assert kept.columns[-1] == "coverage" and kept.count() == documents.count()
    assert tiled_items_of(docs, items.limit(0)).count() == 0
    assert tiled_items_of(docs.limit(0), items).count() == 0


def tiled_items_of(docs, items):
    from tripledger.llm.tables import landed

    return tiled_items(landed(docs), items)


def test_query_against_the_plain_form(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    items = [(r["item_id"], words_of(r["text"])) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    expected = set()
    for doc in docs:
        words = words_of(doc["text"])
        seeds = {tuple(words[i : i + MIN_MATCH]) for i in range(len(words) - MIN_MATCH + 1)}
        for item_id, own in items:
            if any(tuple(own[i : i + MIN_MATCH]) in seeds for i in range(len(own) - MIN_MATCH + 1)):
                covered = sum(n for _, _, n in plain_tiles(own, words, MIN_MATCH))
                if covered >= COVERAGE * len(own):
                    expected.add((doc["doc_id"], item_id, covered))
    found = op10_greedy_tiling_decontamination(spark, folder).collect()
    assert {(r["doc_id"], r["item_id"], r["covered_words"]) for r in found} == expected and expected


def test_repeated_items_and_bounded_blocks(spark, monkeypatch):
    import tripledger.llm.decontamination as module

    monkeypatch.setattr(module, "BLOCK_ITEMS", 3)
    monkeypatch.setattr(module, "BLOCK_CHARS", 150)
    made, items = [], module.Items
    monkeypatch.setattr(module, "Items", lambda block, least: made.append(block) or items(block, least))
    docs = spark.createDataFrame([(1, ITEM), (2, "tiny"), (2, "tiny")], "doc_id long, text string")
    rows = [(1, ITEM)] * 40 + [(None, "tiny")] * 2 + [(2, ITEM)] + [(i, f"other {i}") for i in range(10, 15)] + [(3, "y" * 400)]
    found = tiled_items_of(docs, spark.createDataFrame(rows, "item_id long, text string"))
    assert sorted(((r["doc_id"], r["item_id"]) for r in found.collect()), key=str) == sorted([(1, 1)] * 40 + [(1, 2)] + [(2, None)] * 4, key=str)
    assert sorted((x for block in made for x in block), key=str) == sorted(set(rows), key=str)
    assert all(len(block) <= 3 and (len(block) == 1 or sum(len(text) for _, text in block) <= 150) for block in made)


def test_repetitive_texts_in_linear_memory():
    import tracemalloc

    tracemalloc.start()
    tiles = greedy_tiles(["a"] * 200, ["a"] * 60_000)
    small = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert tiles == [(0, 0, 200)] and small < 60e6
    for item, text in ((["a", "b"] * 10, ["b", "a"] * 30), (["a"] * 17, ["a"] * 23 + ["b"] + ["a"] * 9), (list("abcabcabcd"), list("cabcabcabcdabc"))):
        assert sorted(greedy_tiles(item, text)) == sorted(plain_tiles(item, text, MIN_MATCH))
