"""Whole texts to token ids with a public tokenizer, word by word where that gives the same ids.

Both public word-splitting tokenizers cut a text at spaces before any merge, so the ids of a text are
the ids of its words in order. Words repeat, so each worker keeps the ids of words it has seen; the
store is bounded. A tokenizer of another kind encodes whole texts.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one task thread, one CPU

# Words whose ids a worker keeps, in each of two stores: about 100 MB.
KEPT_WORDS = 500_000
# Words of Latin letters and common marks, with line ends between them, and the parts they are cut into.
_LETTERS, _MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", r".,;:!?#$%&*|"
PLAIN = re.compile(rf"(?:[{_LETTERS}{_MARKS}]+)(?:\n[{_LETTERS}{_MARKS}]+)*")
PARTS = re.compile(rf"[{_LETTERS}]+|[{_MARKS}]+|\n")
# Parts of plain texts that both tokenizers always cut: letters, digits, ASCII marks but the apostrophe, single line
# ends. Byte-level ones keep a space before a part with it; the others drop white space and take digits one by one.
_SIGNS = r"[!-&(-/:-@\[-`{-~]+"
PLAIN_PARTS = {
    "spaces": re.compile(rf" ?[{_LETTERS}]+| ?{_SIGNS}| ?[0-9]+|\n(?!\n)"),
    "words": re.compile(rf"[{_LETTERS}]+|{_SIGNS}|[0-9]"),
}
# Texts encoded together, so that what a few texts share is soon known.
TOGETHER = 500


def default_path(name: str) -> str:
    """Place of an installed public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes; null counts as empty.

    Strings of special tokens inside a text give their ids, as the tokenizer has it, or are ordinary text
    with ``special_as_text``: then a document can't forge a control id.
    """

    def __init__(self, path: str, kept_words: int = KEPT_WORDS, special_as_text: bool = False):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        # A text with a special token's string is encoded whole, whatever its case and the token's flags.
        special = [] if special_as_text else [re.escape(t["content"]) for t in rules.get("added_tokens", [])]
        self.special = re.compile("|".join(special), re.IGNORECASE) if special else None
        self.kept_words = kept_words
        self.first: dict[str, bytes] = {}
        self.later: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.kind = _kind(rules)
        # Tokens that begin a word with its space, or end a word.
        vocabulary = self.tokenizer.get_vocab()
        self.edges = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.edges[number] = token.startswith("Ġ") if self.kind == "spaces" else token.endswith("</w>")

    @property
    def vocabulary(self) -> int:
        return self.tokenizer.get_vocab_size()

    def __call__(self, texts: Sequence[str | None]) -> list[bytes]:
        filled = [text or "" for text in texts]
        if len(filled) > TOGETHER:
            return [ids for i in range(0, len(filled), TOGETHER) for ids in self(filled[i : i + TOGETHER])]
        if self.kind == "whole":
            return self._encode(filled)
        if self.special and (odd := [i for i, text in enumerate(filled) if self.special.search(text)]):
            marked = dict(zip(odd, self._encode([filled[i] for i in odd]), strict=True))
            plain = iter(self([text for i, text in enumerate(filled) if i not in marked]))
            return [marked[i] if i in marked else next(plain) for i in range(len(filled))]
        cut = [self._cut(text) for text in filled]
        if any(parts is not None for parts in cut):
            ids = self._plain([parts for parts in cut if parts is not None])
            others = iter(self._by_words([text for text, parts in zip(filled, cut, strict=True) if parts is None]))
            return [next(others) if parts is None else next(ids) for parts in cut]
        return self._by_words(filled)

    def _cut(self, text: str) -> list[str] | None:
        """The parts of a plain text; None if it has anything else."""
        parts = PLAIN_PARTS[self.kind].findall(text)
        whole = text if self.kind == "spaces" else text.replace(" ", "").replace("\n", "")
        return parts if "".join(parts) == whole else None

    def _plain(self, texts: list[list[str]]) -> Iterator[bytes]:
        """Ids of plain texts given as parts."""
        new = {part for part in set().union(*texts) if part not in self.parts}
        led = [part for part in new if part[0] == " "] if self.kind == "spaces" else [*new]
        for start in range(0, len(led), 2000):
            some = led[start : start + 2000]
            # Encoded as one text, then cut where a part begins or ends.
            one = self.tokenizer.encode_batch_fast(["".join(some) if self.kind == "spaces" else " ".join(some)], add_special_tokens=False)[0]
            ids = np.asarray(one.ids, "<u4")
            edge = np.flatnonzero(self.edges[ids])
            cuts = [*edge.tolist(), len(ids)] if self.kind == "spaces" else [0, *(edge + 1).tolist()]
            if len(cuts) - 1 == len(some):
                data = ids.tobytes()
                self.parts.update((part, data[4 * i : 4 * j]) for part, i, j in zip(some, cuts, cuts[1:]))
            else:
                self.parts.update(zip(some, self._encode(some), strict=True))
        bare = [part for part in new if part not in self.parts]
        self.parts.update(zip(bare, self._encode(bare), strict=True))
        found = [b"".join(map(self.parts.__getitem__, parts)) for parts in texts]
        if len(self.parts) > self.kept_words:
            for part in new:
                del self.parts[part]
        return iter(found)

    def _by_words(self, filled: list[str]) -> list[bytes]:
        if self.kind == "words":
            return self._join([(text.replace("\n", " ").split(" "), False) for text in filled], self.later, "")
        return self._join([(text.split(" "), True) for text in filled], self.later, " ")

    def _encode(self, texts: Sequence[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)
        return [np.asarray(one.ids, "<u4").tobytes() for one in found]

    def _learn(self, words: Iterable[str], known: dict[str, bytes], lead: str) -> list[str]:
        """Adds words to the store and returns the new ones. Plain words are cut into letters and marks first.

        Between letters and marks both tokenizers always cut, so such parts have ids of their own.
        """
        new = [word for word in words if word not in known]
        # Letters alone, of any script, are never cut.
        starts = {word for word in new if word.isalpha()}
        mixed = [word for word in new if word not in starts]
        plain = [word for word in mixed if PLAIN.fullmatch(word)]
        cut = [PARTS.findall(word) for word in plain]
        rest = {part for parts in cut for part in parts[1:]}
        starts.update(parts[0] for parts in cut)
        odd = [*set(mixed).difference(plain)]
        fresh = [part for part in starts if part not in known]
        self._encode_words(fresh, known, lead)
        self._encode_words([part for part in rest if part not in self.first], self.first, "")
        known.update(zip(odd, self._encode([lead + word for word in odd]), strict=True))
        for word, parts in zip(plain, cut, strict=True):
            if len(parts) > 1:
                known[word] = known[parts[0]] + b"".join(map(self.first.__getitem__, parts[1:]))
        return [word for word in new if word not in starts] + (fresh if len(known) > self.kept_words else [])

    def _encode_words(self, words: list[str], known: dict[str, bytes], lead: str) -> None:
        """Ids of words of letters only or marks only: encoded as one text, then cut at the words."""
        by = (" ", True) if lead else (" ", False) if self.kind == "words" else None
        for start in range(0, len(words), 2000):
            part = words[start : start + 2000]
            if by:
                one = self.tokenizer.encode_batch_fast([lead + " ".join(part)], add_special_tokens=False)[0]
                ids = np.asarray(one.ids, "<u4")
                edge = np.flatnonzero(self.edges[ids])
                cuts = [*edge.tolist(), len(ids)] if by[1] else [0, *(edge + 1).tolist()]
                if len(cuts) - 1 == len(part):
                    data = ids.tobytes()
                    known.update((word, data[4 * i : 4 * j]) for word, i, j in zip(part, cuts, cuts[1:]))
                    continue
            known.update(zip(part, self._encode([lead + word for word in part]), strict=True))

    def _join(self, split: list[tuple[list[str], bool]], known: dict[str, bytes], lead: str) -> list[bytes]:
        """Ids of texts given as words. With a head, the first word has no space before it."""
        heads: set[str] = set()
        words: set[str] = set()
        for parts, head in split:
            if head:
                heads.add(parts[0])
                words.update(parts[1:])
            else:
                words.update(parts)
        # A space before another white space belongs to its run, so such texts are encoded whole.
        runs = {word for word in words if not word or word[0].isspace()} if lead else set()
        new = self._learn(words - runs, known, lead)
        new_heads = self._learn(heads, self.first, "")
        result: list[bytes | None] = []
        whole: list[int] = []
        for parts, head in split:
            if not head:
                result.append(b"".join(map(known.__getitem__, parts)))
            elif runs and not runs.isdisjoint(parts[1:]):
                whole.append(len(result))
                result.append(None)
            else:
                result.append(self.first[parts[0]] + b"".join(map(known.__getitem__, parts[1:])))
        for place, ids in zip(whole, self._encode([" ".join(split[i][0]) for i in whole]), strict=True):
            result[place] = ids
        for store, added in ((known, new), (self.first, new_heads)):
            if len(store) > self.kept_words:
                for word in added:
                    store.pop(word, None)
        return result


def _kind(rules: dict) -> str:
    """``spaces``: words keep the space before them; ``words``: white space is dropped; else ``whole``."""
    before = rules.get("pre_tokenizer") or {}
    if before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space"):
        return "spaces" if not rules.get("normalizer") else "whole"
    steps = before.get("pretokenizers") or [{}]
    split = steps[0]
    pattern = (split.get("pattern") or {}).get("Regex", "")
    drops = split.get("type") == "Split" and split.get("behavior") == "Removed" and split.get("invert")
    local = {"NFC", "Replace", "Lowercase"}
    normal = {step["type"] for step in (rules.get("normalizer") or {}).get("normalizers", [])}
    if drops and r"[^\s\p{L}\p{N}]+" in pattern and "\\s+|" not in pattern and normal <= local:
        return "words"
    return "whole"


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, special_as_text: bool = False, kept_words: int = KEPT_WORDS) -> Encoder:
    """The worker's encoder for a vocabulary file, made once."""
    key = (path, special_as_text)
    if key not in _encoders:
        _encoders[key] = Encoder(path, kept_words, special_as_text)
    return _encoders[key]


def crc32(ids: bytes) -> int:
    return zlib.crc32(ids) & 0xFFFFFFFF
