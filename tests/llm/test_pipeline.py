"""The pipeline against stages written out plainly, on whole small tables."""

from __future__ import annotations

import re

from test_decontamination import plain_tiles
from test_near_dedup import plain_components
from test_packing import check

import corpus_pipeline
from tripledger.llm.decontamination import COVERAGE, MIN_MATCH, words_of

SF = "/root/testdata/sf0.001"


def test_stages_have_the_columns_of_documents(spark, documents, tmp_path):
    docs = documents.drop("component")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs.write.parquet(str(tmp_path / name))
        docs = stage(spark, spark.read.parquet(str(tmp_path / name)), SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert corpus_pipeline.STAGES[0][0] == "language"
    # No letter: 3, 4, 7, 8; a copy: 1 (2 is longer) and one of the two rows 5.
    assert sorted((r["doc_id"] for r in docs.collect()), key=str) == sorted([2, 5, None, 9], key=str)


def test_run_against_plain_stages(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs = [(i, t) for i, t in docs if t and re.search(r"[^\W\d_]", t)]
    best = {}
    for i, text in docs:
        key = re.sub(r"[ \t-\r]", "", text)
        best[key] = min(best.get(key, (0, 1 << 60)), (-len(text), i))
    kept = {i for _, i in best.values()}
    docs = [(i, t) for i, t in docs if i in kept]
    kept = {i for i, n, c in plain_components(docs, 80) if n == 0 or i == c}
    docs = [(i, t) for i, t in docs if i in kept]
    items = [words_of(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = set()
    for i, text in docs:
        words = words_of(text)
        seeds = {tuple(words[k : k + MIN_MATCH]) for k in range(len(words) - MIN_MATCH + 1)}
        near = [own for own in items if any(tuple(own[k : k + MIN_MATCH]) in seeds for k in range(len(own) - MIN_MATCH + 1))]
        if not any(sum(n for _, _, n in plain_tiles(own, words, MIN_MATCH)) >= COVERAGE * len(own) for own in near):
            clean.add(i)
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in rows} == clean
    check(rows, 4096)
