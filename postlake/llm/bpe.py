"""Byte-level BPE encoding and decoding with numpy.

Distinct pre-tokens of a block are put in matrices of token ids, one matrix
per length bucket, padded with -1. Each round every row merges its leftmost
pair of minimum rank: the pair's rank comes from a hashed pair table, the
row closes the gap, the two pairs next to the merge are looked up again, and
rows without a known pair leave the matrix. Pre-tokens longer than the
widest bucket merge in the same order with a heap, so their time grows as
n log n.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.llm.pretokens import ragged, row_blocks
from postlake.llm.token_ids import WordEncoder

_NO_RANK = np.int32(2**31 - 1)
_WIDTHS = (2, 3, 4, 5, 6, 7, 8, 9, 10, 12, 14, 16, 20, 24, 32, 48, 64, 96, 128, 256)
_HASH = np.uint64(0x9E3779B97F4A7C15)
#: Cells of one matrix; larger buckets are handled in row slices.
_MAX_CELLS = 1 << 20


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank from a rank file (base64 token, rank per line)."""
    with open(path, "rb") as f:
        found = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, f)}
    if sorted(found) != list(range(len(found))):
        raise ValueError(f"ranks are not 0..n-1: {path}")
    return [found[i] for i in range(len(found))]


class PairTable:
    """(left id, right id) → merged id, with open addressing."""

    def __init__(self, tokens: list[bytes]):
        rank = {t: i for i, t in enumerate(tokens)}
        pairs: dict[int, int] = {}
        for merged, token in enumerate(tokens):
            for cut in range(1, len(token)):
                left, right = rank.get(token[:cut]), rank.get(token[cut:])
                if left is not None and right is not None:
                    pairs[(left << 32) | right] = merged
        keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        values = np.fromiter(pairs.values(), np.int32, len(pairs))
        bits = max(4, int(np.ceil(np.log2(max(1, len(pairs)) * 4))))
        self.shift = np.uint64(64 - bits)
        self.mask = np.int64((1 << bits) - 1)
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.values = np.full(1 << bits, _NO_RANK, dtype=np.int32)
        waiting, step = np.arange(keys.size), 0
        while waiting.size:                     # place all keys of this step at once
            at = self._slot(keys[waiting], step)
            free = np.flatnonzero(self.keys[at] == -1)
            _, firsts = np.unique(at[free], return_index=True)
            placed = free[firsts]
            self.keys[at[placed]] = keys[waiting[placed]]
            self.values[at[placed]] = values[waiting[placed]]
            waiting = np.delete(waiting, placed)
            step += 1
        self.steps = step

    def _slot(self, keys: np.ndarray, step: int) -> np.ndarray:
        mixed = (keys.view(np.uint64) * _HASH) >> self.shift
        return (mixed.astype(np.int64) + step) & self.mask

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids of the pairs; ``_NO_RANK`` where there is none."""
        shape = left.shape
        keys = ((left.astype(np.int64) << 32) | right.astype(np.int64)).ravel()
        out = np.full(keys.size, _NO_RANK, dtype=np.int32)
        waiting = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        for step in range(self.steps):
            at = self._slot(keys[waiting], step)
            there = self.keys[at]
            hit = there == keys[waiting]
            out[waiting[hit]] = self.values[at[hit]]
            waiting = waiting[~hit & (there != -1)]
            if not waiting.size:
                break
        return out.reshape(shape)


class MatrixBpe(WordEncoder):
    """Ids of pre-tokens by merging padded matrices, as a rank file orders."""

    def __init__(self, path: str, **kw):
        super().__init__(**kw)
        self.tokens = read_ranks(path)
        self.rank = {t: i for i, t in enumerate(self.tokens)}
        missing = [b for b in range(256) if bytes([b]) not in self.rank]
        if missing:
            raise ValueError(f"no token for the bytes {missing}")
        self.byte_ids = np.array([self.rank[bytes([b])] for b in range(256)], dtype=np.int32)
        self.pairs = PairTable(self.tokens)
        self.token_bytes = np.frombuffer(b"".join(self.tokens), dtype=np.uint8)
        self.token_ends = np.concatenate(([0], np.cumsum([len(t) for t in self.tokens]))).astype(np.int64)

    def encode_words(self, words):
        found: list[np.ndarray | None] = [None] * len(words)
        by_width: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            whole = self.rank.get(word)
            if whole is not None:               # a pre-token that is a token
                found[i] = np.array([whole], dtype=np.int32)
            elif len(word) > _WIDTHS[-1]:
                found[i] = self._merge_long(word)
            else:
                by_width.setdefault(int(np.searchsorted(_WIDTHS, len(word))), []).append(i)
        for bucket, rows in by_width.items():
            width = _WIDTHS[bucket]
            step = max(1, _MAX_CELLS // width)
            for k in range(0, len(rows), step):
                part = rows[k:k + step]
                for i, ids in zip(part, self._merge_matrix([words[i] for i in part], width)):
                    found[i] = ids
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return (np.concatenate(found) if found else np.zeros(0, np.int32)), np.cumsum(sizes)

    def _merge_matrix(self, words: list[bytes], width: int) -> list[np.ndarray]:
        n = len(words)
        padded = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), dtype=np.uint8)
        sizes = np.fromiter(map(len, words), np.int64, n)
        columns = np.arange(width)
        ids = self.byte_ids[padded.reshape(n, width)]
        ids[columns[None, :] >= sizes[:, None]] = -1
        ranks = self.pairs.ranks(ids[:, :-1], ids[:, 1:])
        rows = np.arange(n)
        out: list[np.ndarray] = [None] * n  # type: ignore[list-item]
        while rows.size:
            at = ranks.argmin(axis=1)           # the leftmost of the least rank
            here = np.arange(rows.size)
            best = ranks[here, at]
            done = best == _NO_RANK
            if done.any():                      # finished rows leave the matrix
                for row, line, size in zip(rows[done], ids[done], sizes[rows[done]]):
                    out[row] = line[:size].copy()
                keep = ~done
                rows, ids, ranks, at, best = rows[keep], ids[keep], ranks[keep], at[keep], best[keep]
                if not rows.size:
                    break
                here = np.arange(rows.size)
            ids[here, at] = best
            after = columns[None, 1:-1] > at[:, None]
            ids[:, 1:-1] = np.where(after, ids[:, 2:], ids[:, 1:-1])
            ids[here[at == width - 2], -1] = -1
            ids[:, -1] = -1
            ranks[:, 1:] = np.concatenate(
                [np.where(after[:, :ranks.shape[1] - 2], ranks[:, 2:], ranks[:, 1:-1]),
                 np.full((rows.size, 1), _NO_RANK)], axis=1) if width > 2 else _NO_RANK
            sizes[rows] -= 1
            # the pair that starts at the merge and the one that ends there
            right = np.where(at + 1 < width, ids[here, np.minimum(at + 1, width - 1)], -1)
            ranks[here, np.minimum(at, width - 2)] = self.pairs.ranks(best, right)
            inner = np.flatnonzero(at > 0)
            if inner.size:
                left = at[inner] - 1
                ranks[inner, left] = self.pairs.ranks(ids[inner, left], best[inner])
        return out

    def _merge_long(self, word: bytes) -> np.ndarray:
        """One long row: the same merge order with a heap and linked cells."""
        ids = self.byte_ids[np.frombuffer(word, dtype=np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self.pairs.ranks(np.array(ids[:-1]), np.array(ids[1:])).tolist()
        no = int(_NO_RANK)
        rank = [*first, no]
        heap = [(r, i) for i, r in enumerate(rank) if r != no]
        heapq.heapify(heap)
        lookup = self._lookup_one

        while heap:
            r, i = heapq.heappop(heap)
            if rank[i] != r or ids[i] < 0:
                continue
            j = after[i]
            ids[i], ids[j] = r, -1
            rank[j] = no
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0:
                    rank[k] = lookup(ids[k], ids[after[k]]) if after[k] < n else no
                    if rank[k] != no:
                        heapq.heappush(heap, (rank[k], k))
        return np.array([t for t in ids if t >= 0], dtype=np.int32)

    def _lookup_one(self, left: int, right: int) -> int:
        return self.rank.get(self.tokens[left] + self.tokens[right], int(_NO_RANK))

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all texts one after the other, text bounds in bytes)."""
        if ids.size and (ids.min() < 0 or ids.max() >= len(self.tokens)):
            raise ValueError("an id is not in the vocabulary")
        data, ends = ragged(self.token_bytes, self.token_ends, ids)
        return data, ends[bounds]


_ENCODERS: dict[str, MatrixBpe] = {}


def matrix_bpe(path: str) -> MatrixBpe:
    """One encoder per rank file and Python worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = MatrixBpe(path)
    return _ENCODERS[path]


def encode(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text",
           decoded: bool = False) -> DataFrame:
    """``(doc_id, ids array<int>)`` of every row, in one narrow pass.

    With ``decoded`` the ids are decoded again in the same task and their
    bytes returned as a third column. A null or empty text has no ids; a
    null ``doc_id`` stays null; repeated rows are encoded each; other columns
    (whatever their names) are not read. Very long texts are encoded whole.
    """
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType(), False))]
    if decoded:
        fields.append(T.StructField("decoded", T.BinaryType()))
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = matrix_bpe(ranks_path)
        for batch in batches:
            for part in row_blocks(batch):
                ids, bounds = bpe.encode_texts(part.column("text"))
                columns = [part.column("doc_id"),
                           pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))]
                if decoded:
                    columns.append(_binary(*bpe.decode(ids, bounds)))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def _binary(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(
        pa.large_binary(), bounds.size - 1,
        [None, pa.py_buffer(np.ascontiguousarray(bounds, np.int64)), pa.py_buffer(np.ascontiguousarray(data))],
    ).cast(pa.binary())


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``(doc_id, ids, decoded binary)``: the bytes of each row's ids.

    Null ids decode to no bytes; an id outside the vocabulary is an error.
    """
    schema = T.StructType([T.StructField("doc_id", T.LongType()),
                           T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
                           T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = matrix_bpe(ranks_path)
        for batch in batches:
            lists = batch.column("ids")
            sizes = pc.fill_null(pa.compute.list_value_length(lists), 0).to_numpy()
            ids = lists.flatten().to_numpy()
            bounds = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, _binary(*bpe.decode(ids, bounds))],
                                             names=schema.names)

    return encoded.select("doc_id", "ids").mapInArrow(run, schema)

