"""Hilbert shards, importance resampling, chat formatting, Merkle fixity."""

from __future__ import annotations

import hashlib
import json
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripledger.llm import chat, fixity, hilbert, resampling
from tripledger.llm.tables import landed, scratch_path

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_neighbours_on_the_curve_are_neighbours_in_space(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
    index = hilbert.hilbert_index(cells, bits)
    assert sorted(index.tolist()) == list(range(len(cells)))
    path = cells[np.argsort(index)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_shards_of_edge_rows(spark, documents):
    for shards in (3, 24):
        rows = hilbert.shard_rows(documents.drop("text"), ["source", "lang", "n_chars"], ["doc_id", "component"], shards).collect()
        counts = Counter(r["shard"] for r in rows)
        assert len(rows) == 10 and max(counts.values()) - min(counts.get(s, 0) for s in range(shards)) <= 1
        for shard, n in counts.items():
            assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))
    assert hilbert.shard_rows(documents.limit(0).drop("text"), ["source"], ["doc_id"]).count() == 0


def test_shard_query_and_pruning(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = hilbert.op4_hilbert_shards(spark, SF).collect()
    assert {r["doc_id"] for r in rows} == set(docs) and len(rows) == len(docs)
    for r in rows:
        data = (docs[r["doc_id"]]["text"] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 8, zlib.crc32(data), "rows", None)
    counts = Counter(r["shard"] for r in rows)
    assert set(counts) == set(range(24)) and max(counts.values()) - min(counts.values()) <= 1
    wide = spark.range(20_000).select(F.col("id"), (F.col("id") * 7919 % 1000).alias("a"), (F.col("id") * 104729 % 997).alias("b"))
    sharded = hilbert.shard_rows(wide, ["a", "b"], ["id"], 64)
    ranges = hilbert.shard_ranges(sharded, ["a", "b"]).collect()
    # A box of a tenth in either dimension touches few shards.
    assert sum(r["min_a"] < 100 for r in ranges) <= 20 and sum(r["min_b"] < 100 for r in ranges) <= 20
    path = scratch_path(spark, "shards")
    hilbert.write_shards(sharded, path)
    assert spark.read.parquet(path).groupBy("shard").count().count() == 64


def test_resampling_draws_by_weight(spark, documents):
    labelled = documents.withColumn("target", F.when(F.col("lang") == "en", True).when(F.col("lang").isNotNull(), False))
    for k in (0, 1, 4, 10, 99):
        rows = resampling.resample(landed(labelled), k=k).collect()
        assert sum(r["selected"] for r in rows) == min(k, 10) and len(rows) == 10
        if 0 < k < 10:
            assert min(r["gumbel_key"] for r in rows if r["selected"]) >= max(r["gumbel_key"] for r in rows if not r["selected"])
    assert all(r["log_weight"] == 0 for r in rows if r["n_ngrams"] == 0)
    assert resampling.resample(landed(labelled.limit(0))).count() == 0
    tied = spark.range(500).select(F.lit(1.5).alias("v"), F.col("id").alias("t"))
    drawn = resampling._largest(tied, "v", ["t"], 77).where("selected").collect()
    assert sorted(r["t"] for r in drawn) == list(range(77))
    mixed = spark.range(3000).select((F.col("id") * 7919 % 1500).cast("double").alias("v"), F.col("id").alias("t"))
    drawn = resampling._largest(mixed, "v", ["t"], 1001).where("selected").collect()
    expected = sorted(((i * 7919 % 1500, i) for i in range(3000)), key=lambda x: (-x[0], x[1]))[:1001]
    assert sorted(r["t"] for r in drawn) == sorted(i for _, i in expected)


def test_resampling_query(spark):
    rows = {r["doc_id"]: r for r in resampling.op3_importance_resampling(spark, SF).collect()}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    labels = {r["doc_id"]: r["quality"] == 1 and not r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    (target, raw) = np.zeros(resampling.BUCKETS), np.zeros(resampling.BUCKETS)
    grams = {i: resampling.ngram_buckets(next(resampling.word_hashes([t]))) for i, t in texts.items()}
    for i, own in grams.items():
        np.add.at(raw, own, 1)
        if labels.get(i):
            np.add.at(target, own, 1)
    ratio = np.log((target + 1) / (target + 1).sum()) - np.log((raw + 1) / (raw + 1).sum())
    assert all(np.isclose(rows[i]["log_weight"], ratio[own].sum(), atol=1e-6) for i, own in grams.items())
    known = [v for i, v in labels.items() if i in texts]
    assert sum(r["selected"] for r in rows.values()) == round(len(texts) * sum(known) / len(known))


@given(st.text(alphabet="<|>\\ aturnseyd/[]", max_size=60))
@settings(max_examples=300, deadline=None)
def test_escapes_are_reversible_and_hide_control_strings(text):
    hidden = chat.escape(text)
    assert chat.unescape(hidden) == text
    assert not any(mark in hidden for mark in (chat.OPEN, chat.MIDDLE, chat.CLOSE))
    formatted, low, high = chat.formatted_turn("assistant", text)
    assert list(chat.read_turns(formatted * 2)) == [("assistant", text)] * 2
    assert chat.unescape(formatted[low:high]) == text


def digests(turns):
    said = "".join(f"{role}\n{text}\n" for role, text in turns)
    learned = "".join(text for role, text in turns if role == "assistant")
    return len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest()


def read_back(spark, turns):
    path = scratch_path(spark, "chats")
    chat.write_chats(turns, path)
    names = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    return {r["conv_id"]: tuple(r[n] for n in names) for r in chat.read_chats(spark, path).collect()}


def test_chats_of_edge_rows(spark, monkeypatch):
    rows = [
        (1, 1, "assistant", "b<|end|>"), (1, 0, "user", "a"), (1, 2, None, None), (1, None, "system", "\\<"),
        (2, 0, "assistant", "x" * 3000), (2, 1, "assistant", ""), (2, 2, "assistant", "é</s>[INST]"),
        (None, 0, "assistant", "no number"), (3, 0, "user", "q"), (3, 0, "user", "q"), (3, 0, "assistant", "q"),
    ]
    turns = chat.canonical_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    expected = {}
    for row in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        expected.setdefault(row[0], []).append((row[2] or "", row[3] or ""))
    assert read_back(spark, turns) == {k: digests(v) for k, v in expected.items()}
    assert read_back(spark, turns.limit(0)) == {}


def test_layouts_are_known_by_their_fingerprints(spark):
    layouts = {
        "prompt": "conv_id long, prompt string, response string",
        "instruction": "conv_id long, instruction string, input string, output string",
        "messages": "conv_id long, messages array<struct<role: string, content: string>>",
    }
    records = [
        {"conv_id": 1, "response": "r", "prompt": "p"},
        {"conv_id": 2, "instruction": "do", "input": "", "output": "done"},
        {"conv_id": 3, "messages": [{"role": "user", "content": "a"}, {"content": "b", "role": "assistant"}]},
        {"conv_id": 4, "question": "?"},
    ]
    frame = spark.createDataFrame([(json.dumps(r),) for r in records] + [("no json",), (None,)], "record string")
    got = read_back(spark, chat.by_layout(frame, "record", layouts))
    assert got == {
        1: digests([("user", "p"), ("assistant", "r")]),
        2: digests([("user", "do"), ("assistant", "done")]),
        3: digests([("user", "a"), ("assistant", "b")]),
    }
    assert sum(r["n"] for r in chat.unknown_layouts(frame, "record", layouts).collect()) == 3
    with pytest.raises(ValueError, match="no mapping"):
        chat.canonical_turns(frame)


def test_chat_query(spark):
    rows = {r["conv_id"]: r for r in chat.op5_chat_formatting(spark, SF).collect()}
    turns = {}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    said = "</s>[INST] ok [/INST]"
    turns[-1] = [("user", said), ("assistant", said)]
    assert {k: tuple(r)[1:5] for k, r in rows.items()} == {k: digests(v) for k, v in turns.items()}
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    expected = duck.execute(chat.ORACLE["op5_chat_formatting"])
    names = [c[0] for c in expected.description]
    assert sorted(expected.fetchall()) == sorted(tuple(r[n] for n in names) for r in rows.values())


def test_fixity_finds_all_kinds_of_damage(spark):
    pages = [(i, f"http://x/{i}", f"<p>page {i}</p>") for i in range(300)] + [(None, None, None), (7, "http://x/7", "<p>page 7</p>")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    sound = fixity.tree(fixity.replica(frame, F.col("html")))
    assert fixity.audit(sound, fixity.tree(fixity.replica(frame, F.col("html")))).count() == 0
    bitten = F.when(F.col("page_id") == 100, "<p>pXge 100</p>").otherwise(F.col("html"))
    found = fixity.audit(sound, fixity.tree(fixity.replica(frame, bitten))).collect()
    assert [(r["file"], r["seq"], r["kind"]) for r in found] == [(0, 102, "changed")]
    longer = F.when(F.col("page_id") == 298, "<p>page 298!</p>").otherwise(F.col("html"))
    found = fixity.audit(sound, fixity.tree(fixity.replica(frame, longer))).collect()
    assert sorted((r["seq"], r["kind"]) for r in found) == [(300, "changed"), (301, "moved")]
    less = fixity.tree(fixity.replica(frame.where("page_id is null or page_id < 299"), F.col("html")))
    assert [(r["seq"], r["kind"]) for r in fixity.audit(sound, less).collect()] == [(301, "missing")]
    assert [(r["seq"], r["kind"]) for r in fixity.audit(less, sound).collect()] == [(301, "extra")]
    empty = fixity.tree(fixity.replica(frame.limit(0), F.col("html")))
    assert fixity.audit(empty, empty).count() == 0


def test_fixity_query(spark):
    duck = duckdb.connect()
    duck.execute("CREATE VIEW pages AS SELECT * FROM '/root/testdata/sf0.01/pages.parquet'")
    expected = duck.execute(fixity.ORACLE["op9_merkle_fixity"])
    names = [c[0] for c in expected.description]
    rows = fixity.op9_merkle_fixity(spark, "/root/testdata/sf0.01").select(*names).collect()
    assert sorted(tuple(r) for r in rows) == sorted(expected.fetchall()) and rows


def test_fixity_of_records_lost_added_and_lengthened_in_the_middle(spark):
    pages = [(i, f"http://x/{i}", f"<p>page {i}</p>") for i in range(300)] + [(7, "http://x/7", "<p>page 7</p>")] * 2
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(2)
    longer = F.when(F.col("page_id") == 150, "<p>longer</p>" * 3).otherwise(F.col("html"))
    filed = fixity.store(fixity.records(frame, 100, sound=F.col("html"), damaged=longer), "filed")
    sound = fixity.tree(fixity.holding(filed, "sound"))
    added = filed.where("page_id = 60").withColumn("page_id", F.lit(1000).cast("long"))
    damaged = filed.where("page_id not in (5, 7) or place = 8").unionByName(added)
    found = fixity.audit(sound, fixity.tree(fixity.holding(damaged, "damaged"))).collect()
    kinds = {kind: sorted(r["page_id"] for r in found if r["kind"] == kind) for kind in ("missing", "extra", "changed", "moved")}
    assert (kinds["missing"], kinds["extra"], kinds["changed"]) == ([5, 7, 7], [1000], [150])
    # Only the rest of the two files with another length before it has moved; the last file is sound.
    assert {r["file"] for r in found} == {0, 1} and set(kinds["moved"]) <= {*range(6, 198)}
    # A replica filed by itself has other boundaries, yet each record is known by its id.
    less = fixity.tree(fixity.holding(fixity.records(frame.where("page_id <> 5"), 100, html=F.col("html")), "html"))
    assert [r["page_id"] for r in fixity.audit(sound, less).where("kind <> 'moved'").collect()] == [5]


def test_first_rows_of_shards_of_very_many_rows(spark):
    for n in (10, 100_000_000, 2_147_483_647, 10**12):
        shards = spark.range(24).select(F.col("id").cast("int").alias("shard"))
        assert [r[0] for r in shards.select(hilbert._first(n, 24)).collect()] == [-(-k * n // 24) for k in range(24)]


def test_marked_targets_weigh_like_joined_ones(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet") for name in ("documents", "labels"))
    joined = resampling.resample(landed(resampling.labelled(docs, labels)))
    marked = resampling.resample(docs, marks=resampling.marked(labels))
    one, two = ({r["doc_id"]: (r["n_ngrams"], r["log_weight"]) for r in found.collect()} for found in (joined, marked))
    assert one == two and len(one) == docs.count()
    assert marked.where("selected").count() == joined.where("selected").count() > 0
