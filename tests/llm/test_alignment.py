from __future__ import annotations

import hashlib
import json
import random
from bisect import bisect_left
from collections import defaultdict
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tripledger.llm import alignment, tables
from tripledger.llm.alignment import Pieces, aligned_documents, group_ends, packed, unpacked
from tripledger.llm.tables import store
from tripledger.llm.tokens import default_path
from tripledger.sources.settings import with_settings

BYTE, PIECE = default_path("byte_bpe_50k.json"), default_path("piece_bpe_32k.model")
TEXTS = [
    "The quick brown fox jumps over the lazy dog, unbelievably tokenised!",
    "Straße, élève, garçon – naïve façade. Größe   mit  Lücken ",
    " leading and\ttabs\nand lines\r\n\n",
    "日本語のテキスト и русский текст, ελληνικά 😀👍🏽",
    "a <|endoftext|> b </s>[INST] <s> <unk> <0x41> ok",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 30,
    "mark ▁ inside",
    "x",
    " ",
    "   ",
    "\n",
    "",
    None,
    "=" * 500 + "-" * 300,
    "1234567890 3.14159 0x7fff __init__ fooBarBaz",
]


def plain_tokens():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(BYTE), SentencePieceProcessor(model_file=PIECE)
    a.encode_special_tokens = True
    # The byte-level alphabet by its rule, found again: printable bytes stand for themselves.
    code, level = 256, {}
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or 174 <= byte <= 255:
            level[chr(byte)] = byte
        else:
            level[chr(code)] = byte
            code += 1

    def tokens_of(text):
        ids = a.encode(f" {text}", add_special_tokens=False).ids
        one = [(i, bytes(level[c] for c in a.id_to_token(i))) for i in ids]
        two = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            two.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
        return one, two

    return tokens_of


def plain_rows(rows):
    tokens_of, aligned, holders = plain_tokens(), [], defaultdict(set)
    for at, (doc_id, text) in enumerate(rows):
        one, two = tokens_of(text) if text else ([], [])
        raw = f" {text}".encode()
        if not text or b"".join(t for _, t in one) != raw or b"".join(t for _, t in two) != raw:
            one = two = []
        ends = [list(accumulate(len(token) for _, token in side)) for side in (one, two)]
        cuts = sorted({*ends[0]} & {*ends[1]})
        groups = [([], []) for _ in cuts]
        for k, side in enumerate((one, two)):
            for (i, _), end in zip(side, ends[k], strict=True):
                groups[bisect_left(cuts, end)][k].append(i)
        links = [(x, y) for p, q in groups for x in p for y in q]
        for link in links:
            holders[link].add(at)
        aligned.append((doc_id, len(one), len(two), groups, links))
    best = defaultdict(int)
    for (x, _), docs in holders.items():
        best[x] = max(best[x], len(docs))
    result = []
    for doc_id, n_a, n_b, groups, links in aligned:
        written = ";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in groups)
        counts = [len(holders[link]) for link in links]
        n_best = sum(n == best[x] for (x, _), n in zip(links, counts, strict=True))
        digest = hashlib.sha256(written.encode()).hexdigest() if written else ""
        result.append((doc_id, n_a, n_b, len(groups), len(links), n_best, sum(counts), digest))
    return sorted(result, key=str)


def found_rows(frame):
    return sorted((tuple(r) for r in aligned_documents(frame, BYTE, PIECE).collect()), key=str)


def test_successors_end_groups():
    draw = random.Random(3)
    for _ in range(200):
        size = draw.randint(1, 60)
        ends = [sorted({*draw.sample(range(1, size + 1), draw.randint(0, size)), size}) for _ in range(2)]
        last = group_ends(*map(np.array, ends)).tolist()
        cuts = sorted(set(ends[0]) & set(ends[1]))
        expected = [len(ends[0]) + ends[1].index(min(c for c in cuts if c >= e)) for side in ends for e in side]
        assert last == expected
    assert len(group_ends(np.zeros(0, int), np.zeros(0, int))) == 0


def test_pieces_by_words_are_those_of_whole_texts():
    pieces = Pieces(PIECE)
    assert pieces.by_words
    draw = random.Random(8)
    marks = ["a", "the", "of", " ", "  ", "\n", "é", "ß", "日", "▁", "1", "<s>", ".", "token", "isation", "\t"]
    texts = ["".join(draw.choice(marks) for _ in range(draw.randint(0, 30))) for _ in range(3000)]
    for again in range(2):
        for text, ids, whole in zip(texts, pieces(texts), pieces.model.encode(texts), strict=True):
            if ids is None:
                assert not text or "▁" in text, again
            else:
                assert ids.tolist() == whole and "▁" not in text, again


@pytest.mark.parametrize("limits", [(4000, 8_000_000, 500_000, 4096), (3, 400, 100, 2)])
def test_against_plain_alignment(spark, limits, monkeypatch):
    for name, value in zip(("CHUNK_DOCS", "CHUNK_CHARS", "BATCH_CHARS", "GROUP_LINKS"), limits, strict=True):
        monkeypatch.setattr(alignment, name, value)
    words = " ".join(t for t in TEXTS if t).split()
    draw = random.Random(4)
    rows = [*enumerate(TEXTS), (None, TEXTS[0]), (3, TEXTS[0])]
    rows += [(100 + i, " ".join(draw.choice(words[:40]) for _ in range(draw.randint(1, 60)))) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found_rows(frame) == plain_rows(rows)


def test_a_group_of_many_links_by_its_ids(monkeypatch):
    texts = [t for t in TEXTS if t]
    aligner = alignment.Aligner(BYTE, PIECE)
    whole = aligner(texts)
    monkeypatch.setattr(alignment, "GROUP_LINKS", 1)
    few = aligner(texts)
    for name in ("doc", "pair", "times", "n_links"):
        assert np.array_equal(getattr(whole, name), getattr(few, name))
    assert json.dumps(whole.digests) == json.dumps(few.digests)


def test_edge_rows(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    expected = plain_rows(rows)
    assert found_rows(documents) == expected
    assert found_rows(documents.withColumnsRenamed({"component": "pairs", "lang": "chunk", "source": "a.b"})) == expected
    assert found_rows(documents.limit(0)) == []


def test_query_against_plain_alignment(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    found = sorted((tuple(r) for r in alignment.op13_pointer_jumping_alignment(spark, "/root/testdata/sf0.001").collect()), key=str)
    assert found == plain_rows([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_no_row_has_a_whole_chunk(spark, monkeypatch):
    """400 documents make one chunk; tasks and workers get them some at a time."""
    largest, chunks = {}, {}

    def measured(df, name):
        kept = store(df, name)
        if name == "aligned":
            chunks[name] = kept.agg(F.countDistinct("chunk")).first()[0]
            with with_settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "1"}):
                sizes = kept.mapInArrow(lambda found: (pa.RecordBatch.from_pylist([{"n": b.num_rows, "size": b.nbytes}]) for b in found), "n long, size long")
                largest[name] = tuple(sizes.agg(F.max("n"), F.max("size")).first())
        return kept

    monkeypatch.setattr(alignment, "store", measured)
    monkeypatch.setattr(alignment, "BATCH_CHARS", 10_000)
    draw, words = random.Random(6), [word for t in TEXTS if t for word in t.split() if len(word) < 20 and word != "▁"]
    rows = [(i, " ".join(draw.choice(words) for _ in range(200))) for i in range(400)]
    found = found_rows(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    assert chunks["aligned"] == 1 and largest["aligned"][0] == 1
    assert largest["aligned"][1] < 100_000
    assert found == plain_rows(rows)


@pytest.mark.parametrize("rows_at_once", [1, 3])
def test_chunks_that_share_or_leave_a_batch(spark, rows_at_once, monkeypatch):
    for name, value in {"CHUNK_DOCS": 5, "CHUNK_CHARS": 600, "BATCH_CHARS": 200, "COUNTED_PAIRS": 7}.items():
        monkeypatch.setattr(alignment, name, value)
    monkeypatch.setattr(tables, "BATCH_ROWS", rows_at_once)
    rows = [*enumerate(TEXTS), (None, None), (None, ""), *((i, None) for i in range(50, 60)), *((i, f"{i} {i % 7} brown") for i in range(60, 90))]
    with with_settings(spark, {"spark.sql.shuffle.partitions": "2"}):
        assert found_rows(spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)) == plain_rows(rows)


def test_packed_numbers_come_back():
    for most in (0, 1, 255, 256, 65_535, 65_536, 2**32 - 1, 2**32, 2**62):
        values = np.array([0, most, most // 2, 1 if most else 0], np.int64)
        assert np.array_equal(unpacked(packed(values), 4), values)
        assert unpacked(packed(values), 4).dtype == np.int64
    assert len(packed(np.array([3, 255]))) == 2 and len(packed(np.array([3, 256]))) == 4
    assert len(unpacked(packed(np.zeros(0, np.int64)), 0)) == 0
