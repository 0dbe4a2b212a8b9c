"""Split whole texts into byte-level BPE pre-tokens with numpy.

The rule is the public byte-level BPE pattern

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

Every code point belongs to exactly one pre-token, so a block of texts is cut
by token starts alone: class runs (letter, number, white space, other), a
space that joins the run after it, white space before a word giving up its
last character, and the contractions. The pre-tokens are then an Arrow
binary array over the block's own bytes, dictionary-encoded in one call, so
everything that follows works on the block's *distinct* pre-tokens.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
_N_CODE_POINTS = 0x110000
_CLASSES: np.ndarray | None = None

#: Text bytes handled at once inside a task (a longer single text is one block).
BLOCK_BYTES = 1 << 20


def char_classes() -> np.ndarray:
    """Class of each code point, built once per Python process."""
    global _CLASSES
    if _CLASSES is None:
        import regex

        table = np.zeros(_N_CODE_POINTS, dtype=np.uint8)
        for first, last in ((0, 0xD800), (0xE000, _N_CODE_POINTS)):
            span = "".join(map(chr, range(first, last)))
            for cls, prop in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
                for m in regex.finditer(prop, span):
                    table[first + m.start():first + m.end()] = cls
        _CLASSES = table
    return _CLASSES


def code_points(data: bytes) -> np.ndarray:
    """UTF-8 bytes as an array of code points."""
    return np.frombuffer(data.decode("utf-8").encode("utf-32-le"), dtype=np.uint32)


def utf8_widths(cps: np.ndarray) -> np.ndarray:
    return 1 + (cps >= 0x80).astype(np.int8) + (cps >= 0x800) + (cps >= 0x10000)


def token_starts(cps: np.ndarray, doc_starts: np.ndarray) -> np.ndarray:
    """True where a pre-token starts; ``doc_starts`` are code-point positions
    (repeats of a position are empty texts)."""
    n = cps.size
    if n == 0:
        return np.zeros(0, dtype=bool)
    cls = char_classes()[cps]
    first = np.zeros(n, dtype=bool)
    first[doc_starts[doc_starts < n]] = True
    first[0] = True
    run = first.copy()
    run[1:] |= cls[1:] != cls[:-1]
    starts = run.copy()
    # a space (U+0020) joins the word, number or sign run right after it
    blank = cps == 0x20
    starts[1:] &= ~(blank[:-1] & run[1:] & ~first[1:] & (cls[1:] != SPACE))
    # white space of two or more before anything else gives up its last one
    last_space = np.zeros(n, dtype=bool)
    last_space[:-1] = (cls[:-1] == SPACE) & (cls[1:] != SPACE) & ~first[1:]
    starts |= last_space
    # contractions: a lone apostrophe that starts a token, then s t m d re ve ll
    at = np.flatnonzero((cps == 0x27) & starts)
    at = at[at + 1 < n]
    if at.size:
        at = at[(cls[at + 1] == LETTER) & ~first[at + 1]]
    if at.size:
        one = cps[at + 1]
        has_two = at + 2 < n
        two = np.where(has_two, cps[np.minimum(at + 2, n - 1)], 0)
        two = np.where(has_two & ~first[np.minimum(at + 2, n - 1)], two, 0)
        size = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, 0)
        pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))
        pair |= (one == ord("l")) & (two == ord("l"))
        size = np.where(pair, 2, size)
        at, size = at[size > 0], size[size > 0]
        starts[at + 1] = False
        rest = at + 1 + size
        starts[rest[rest < n]] = True
    return starts


@dataclass
class Block:
    """Some whole texts: distinct pre-tokens and, per text, which it holds."""

    words: pa.Array          # distinct pre-tokens (binary)
    index: np.ndarray        # pre-token numbers, texts one after the other
    bounds: np.ndarray       # index[bounds[i]:bounds[i + 1]] is text i
    sizes: np.ndarray        # UTF-8 bytes of each text


def split_block(texts: pa.Array) -> Block:
    """Pre-tokens of an Arrow string array; a null text counts as empty."""
    texts = pa.array(texts.to_pylist(), pa.large_string()) if texts.null_count else texts.cast(pa.large_string())
    raw = texts.cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], dtype=np.int64)[raw.offset:raw.offset + len(raw) + 1]
    if texts.null_count:
        # null slots keep zero bytes between their offsets
        offsets = np.asarray(offsets)
    lo, hi = int(offsets[0]), int(offsets[-1])
    data = raw.buffers()[2].slice(lo, hi - lo).to_pybytes() if hi > lo else b""
    byte_bounds = offsets - lo
    cps = code_points(data)
    if cps.size == len(data):
        starts = np.flatnonzero(token_starts(cps, byte_bounds[:-1]))
    else:
        place = np.zeros(cps.size + 1, dtype=np.int64)
        np.cumsum(utf8_widths(cps), out=place[1:])
        docs = np.searchsorted(place, byte_bounds[:-1])
        starts = place[np.flatnonzero(token_starts(cps, docs))]
    ends = np.append(starts, len(data)).astype(np.int32)
    tokens = pa.Array.from_buffers(pa.binary(), starts.size,
                                   [None, pa.py_buffer(ends), pa.py_buffer(data)])
    coded = tokens.dictionary_encode()
    return Block(coded.dictionary, coded.indices.to_numpy(),
                 np.searchsorted(starts, byte_bounds), np.diff(byte_bounds))


def row_blocks(batch: pa.RecordBatch, column: str = "text",
               block_bytes: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a record batch holding about ``block_bytes`` of text each."""
    sizes = np.array([0 if s is None else s for s in
                      pc.binary_length(batch.column(column)).to_pylist()], dtype=np.int64)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > block_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(size)
    if start < len(sizes):
        yield batch.slice(start)
    pa.default_memory_pool().release_unused()    # the worker lives on in later stages


def ragged(values: np.ndarray, offsets: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate ``values[offsets[p]:offsets[p + 1]]`` for each pick; also
    returns where each pick's run starts (with the total at the end)."""
    sizes = (offsets[1:] - offsets[:-1])[picks]
    ends = np.zeros(picks.size + 1, dtype=np.int64)
    np.cumsum(sizes, out=ends[1:])
    shift = np.repeat(offsets[:-1][picks] - ends[:-1], sizes)
    return values[shift + np.arange(ends[-1])], ends
