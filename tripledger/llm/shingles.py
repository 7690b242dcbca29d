"""Words and shingles of whole texts as 64-bit hashes, by numpy over the bytes of many texts at once."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

# Words of a shingle.
WORDS = 5
# Odd factors of the polynomial hashes.
BYTE_FACTOR, WORD_FACTOR = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_CHUNK = 1 << 18
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_powers: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the byte factor and of its inverse modulo 2^64."""
    if not _powers or len(_powers["up"]) < n:
        size = max(n, 2 * _CHUNK)
        for name, factor in (("up", BYTE_FACTOR), ("down", pow(BYTE_FACTOR, -1, 1 << 64))):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x9FB21C651E98DF25)
    return h ^ (h >> np.uint64(32))


def word_hashes(texts: Iterable[str | None]) -> Iterator[np.ndarray]:
    """Per text, the hashes of its words: runs of bytes other than ASCII white space, A-Z in lower case.

    Texts are encoded and hashed some at a time, as they are asked for.
    """
    data: list[bytes] = []
    size = 0
    for text in texts:
        one = (text or "").encode("utf-8", "surrogatepass")
        if data and size + len(one) >= _CHUNK:
            yield from _hashed(data)
            data, size = [], 0
        data.append(one)
        size += len(one) + 1
    if data:
        yield from _hashed(data)


def _hashed(data: list[bytes]) -> Iterator[np.ndarray]:
    raw = np.frombuffer(b" ".join(data) + b" ", np.uint8)
    up, down = _tables(len(raw) + 1)
    blank = _BLANK[raw]
    edges = np.diff(np.concatenate([[1], blank.view(np.int8)]))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((_LOWER[raw].astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(WORD_FACTOR))
    bounds = np.cumsum([0, *(len(one) + 1 for one in data)])
    cuts = np.searchsorted(starts, bounds)
    for i in range(len(data)):
        yield hashes[cuts[i] : cuts[i + 1]]


def windows(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of each n consecutive words; with fewer words, of all of them together; none without words."""
    if not len(words):
        return words
    n = min(n, len(words))
    total = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        total = total * np.uint64(WORD_FACTOR) + words[i : len(words) - n + 1 + i]
    return mix(total)


def shingle_sets(texts: Iterable[str | None], n: int = WORDS) -> Iterator[np.ndarray]:
    """Per text, the sorted hashes of its distinct shingles."""
    for words in word_hashes(texts):
        yield np.unique(windows(words, n))


def groups_sql(words: int, threshold: int) -> str:
    """SQL of a table ``grouped`` (doc_id, n_shingles, component_id): what linked sets of word shingles give, in its plainest form."""
    return rf"""
        split AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), sets AS (
            SELECT doc_id, unnest(list_distinct(CASE
                WHEN len(w) >= {words} THEN list_transform(range(1, len(w) - {words - 2}), lambda i: array_to_string(w[i:i + {words - 1}], ' '))
                WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END)) AS shingle
            FROM split
        ), sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY 1
        ), met AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
            FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
        ), links AS (
            SELECT a, b FROM met JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * shared >= {threshold} * (x.n + y.n - shared)
        ), reached(doc_id, other) AS (
            SELECT doc_id, doc_id FROM documents
            UNION SELECT reached.doc_id, links.b FROM reached JOIN links ON links.a = reached.other
        ), grouped AS (
            SELECT doc_id, coalesce(max(n), 0) AS n_shingles, min(other) AS component_id
            FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
        )"""
