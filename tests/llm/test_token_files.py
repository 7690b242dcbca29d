from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tripledger.llm.tables import scratch_path
from tripledger.llm.token_files import TokenFile, bits_for, op1_token_files, pack, read_token_files, unpack, write_token_files
from tripledger.llm.tokens import Encoder, crc32, default_path

VOCABULARIES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


def plain_ids(path, text):
    tokenizer = Tokenizer.from_file(path)
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=200))
@settings(max_examples=150, deadline=None)
def test_bits_round_trip(bits, values):
    ids = np.array(values, np.uint64) & np.uint64((1 << bits) - 1)
    ids = ids.astype("<u4")
    packed = pack(ids, bits)
    assert len(packed) == -(-len(ids) * bits // 8)
    assert (unpack(packed, len(ids), bits) == ids).all()


def test_bits():
    assert [bits_for(n) for n in (0, 1, 2, 3, 50257, 65536, 65537)] == [1, 1, 1, 2, 16, 16, 17]
    with pytest.raises(ValueError):
        pack(np.array([8], "<u4"), 3)


@pytest.mark.parametrize("name", VOCABULARIES)
def test_words_give_the_ids_of_whole_texts(name):
    encode = Encoder(default_path(name), kept_words=50)
    random.seed(5)
    signs = " \n\tab.,'s1é 　ß|<$"
    texts = ["".join(random.choice(signs) for _ in range(random.randint(0, 40))) for _ in range(1500)]
    texts += ["<|endoftext|> a  <|endoftext|>", None, "ab\n\n c", "é́ ́x", "Ünïcödé, wörds.\nNext $$$ line ***"]
    for _ in range(2):
        assert encode(texts) == [np.array(encode.tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_read_back(spark, documents):
    path, folder = default_path("byte_bpe_50k.json"), scratch_path(spark, "tokens")
    manifest = write_token_files(documents, folder, path, 0, block_ids=64, file_ids=5000).collect()
    rows = read_token_files(spark, folder).orderBy("start").collect()
    texts = sorted(documents.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    at = 0
    for row, source in zip(rows, texts, strict=True):
        ids = np.array([*plain_ids(path, source["text"]), 0], "<u4")
        assert (row["doc_id"], row["start"], row["n_tokens"], row["ids_crc32"]) == (source["doc_id"], at, len(ids), crc32(ids.tobytes()))
        at += len(ids)
    # Any range of a file equals the same range of all its ids.
    for name in [m["name"] for m in manifest]:
        file = TokenFile(folder, name)
        whole = file.ids(0, file.count)
        for low, high in ((0, 1), (63, 65), (0, file.count), (file.count - 1, file.count), (5, 5)):
            low, high = min(low, file.count), min(high, file.count)
            assert (file.ids(low, high) == whole[low:high]).all()
        assert all((file.document(i) == ids).all() for i, (_, _, ids) in enumerate(file.documents()))


def test_empty_table(spark, documents):
    folder = scratch_path(spark, "tokens")
    write_token_files(documents.limit(0), folder, default_path("byte_bpe_50k.json"), 0)
    assert read_token_files(spark, folder).count() == 0


def test_query_against_whole_texts(spark):
    path = default_path("byte_bpe_50k.json")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    rows = op1_token_files(spark, "/root/testdata/sf0.001").orderBy("doc_id").collect()
    at = 0
    for row, doc in zip(rows, docs, strict=True):
        ids = np.array([*plain_ids(path, doc["text"]), 0], "<u4")
        assert (row["doc_id"], row["start"], row["n_tokens"], row["ids_crc32"]) == (doc["doc_id"], at, len(ids), crc32(ids.tobytes()))
        at += len(ids)


@pytest.mark.parametrize("name", VOCABULARIES)
def test_ids_are_those_of_the_library_without_any_flag(name):
    path = default_path(name)
    draw = random.Random(11)
    signs = [" ", "\n", "\n\n", "\t", "a", "B", "the", "é", "ÿ", "÷", ",", ".", "'s", "1", "23", "<|endoftext|>", "<|ENDOFTEXT|>", "_", "日", "  ", "$", "~", "İ", "ª"]
    texts = ["".join(draw.choice(signs) for _ in range(draw.randint(0, 12))) for _ in range(6000)]
    encode = Encoder(path, kept_words=300)
    plain = Tokenizer.from_file(path)
    for low in range(0, len(texts), 700):
        some = texts[low : low + 700]
        assert encode(some) == [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in some]


def test_special_strings_as_text():
    path = default_path("byte_bpe_50k.json")
    assert len(np.frombuffer(Encoder(path)(["a <|endoftext|> b"])[0], "<u4")) == 4
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    ids = plain.encode("a <|endoftext|> b", add_special_tokens=False).ids
    assert np.frombuffer(Encoder(path, special_as_text=True)(["a <|endoftext|> b"])[0], "<u4").tolist() == ids and len(ids) > 4
