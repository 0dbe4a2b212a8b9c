"""Token ids of whole texts, computed once per distinct pre-token.

``WordEncoder`` keeps a bounded cache of pre-token → ids inside a Python
worker; a block of texts costs one dictionary encoding, a lookup of its
distinct pre-tokens, the encoding of those not seen before, and one gather.
``LibraryEncoder`` gets the ids of a pre-token from the ``tokenizers``
library's own model, and cuts texts at the file's added tokens first.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from postlake.llm.pretokens import ragged, split_block

#: Distinct pre-tokens remembered by one Python worker before it starts anew.
MAX_CACHED_WORDS = 200_000


class WordEncoder:
    """Base: subclasses give the ids of distinct pre-tokens."""

    def __init__(self, max_cached: int = MAX_CACHED_WORDS):
        self.max_cached = max_cached
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[bytes, int] = {}
        self.flat = array("i")
        self.ends = array("q", [0])

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after the other, ends of each word's ids)."""
        raise NotImplementedError

    def encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, text bounds, n + 1)."""
        block = split_block(texts)
        if not len(block.words):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        if len(self.slots) > self.max_cached:
            self._forget()
        words = block.words.to_pylist()
        slots = self.slots
        missing = [w for w in words if w not in slots]
        if missing:
            ids, ends = self.encode_words(missing)
            base_slot, base = len(slots), len(self.flat)
            self.flat.frombytes(np.ascontiguousarray(ids, dtype=np.int32).tobytes())
            self.ends.frombytes((np.asarray(ends, dtype=np.int64) + base).tobytes())
            slots.update(zip(missing, range(base_slot, base_slot + len(missing))))
        picks = np.fromiter(map(slots.__getitem__, words), np.int64, len(words))
        # a copy, so that the arrays may grow again while views exist
        values = np.frombuffer(self.flat, dtype=np.int32)
        offsets = np.frombuffer(self.ends, dtype=np.int64)
        ids, ends = ragged(values, offsets, picks[block.index])
        del values, offsets
        return ids, ends[block.bounds]


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level BPE
    vocabularies: printable bytes stand for themselves, the others follow
    from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(others)}


class LibraryEncoder(WordEncoder):
    """Ids by the ``tokenizers`` library's model of a byte-level vocabulary file.

    With ``added_tokens`` the ids are those of the library's own ``encode``
    without the post-processor: the file's added tokens (the special ones
    too) are found in a text first, leftmost and longest, and the text between
    them is cut into pre-tokens. Without, such a string is ordinary text."""

    def __init__(self, path: str, max_cached: int = MAX_CACHED_WORDS, added_tokens: bool = False):
        super().__init__(max_cached)
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.letters = str.maketrans({chr(b): c for b, c in _byte_letters().items()})
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        tokens = [t for t in spec.get("added_tokens") or [] if t["content"]] if added_tokens else []
        self.added = {t["content"]: t["id"] for t in tokens}
        #: Whether a token is its content alone, whatever stands around it.
        self.plain = not any(t[k] for t in tokens for k in ("single_word", "lstrip", "rstrip")) and (
            spec.get("normalizer") is None)
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")

    def encode_words(self, words):
        tokenize, letters = self.model.tokenize, self.letters
        ids: list[int] = []
        ends = np.empty(len(words), dtype=np.int64)
        for i, word in enumerate(words):
            ids.extend(t.id for t in tokenize(word.decode("latin-1").translate(letters)))
            ends[i] = len(ids)
        return np.array(ids, dtype=np.int32), ends

    def encode_texts(self, texts):
        if self.added and not self.plain:
            out = [self.library.encode(t or "", add_special_tokens=False).ids for t in texts.to_pylist()]
            bounds = np.concatenate(([0], np.cumsum([len(x) for x in out], dtype=np.int64)))
            return np.array([i for x in out for i in x], dtype=np.int32), bounds
        if not any(pc.any(pc.match_substring(texts, t)).as_py() for t in self.added):
            return super().encode_texts(texts)
        # sections between added tokens; after[j] is the id that follows section j (-1: its text ends)
        sections: list[str] = []
        after: list[int] = []
        for text in texts.to_pylist():
            parts = self.cut.split(text or "")
            sections += parts[::2]
            after += [*(self.added[t] for t in parts[1::2]), -1]
        ids, bounds = super().encode_texts(pa.array(sections, pa.large_string()))
        follows = np.array(after, dtype=np.int32)
        put = follows >= 0
        ends = bounds[1:] + np.cumsum(put)
        return np.insert(ids, bounds[1:][put], follows[put]), np.concatenate(([0], ends[~put]))


_LIBRARY: dict[tuple[str, bool], LibraryEncoder] = {}


def library_encoder(path: str, added_tokens: bool = False) -> LibraryEncoder:
    """One encoder per file and kind in a Python worker process."""
    key = (path, added_tokens)
    if key not in _LIBRARY:
        _LIBRARY[key] = LibraryEncoder(path, added_tokens=added_tokens)
    return _LIBRARY[key]
