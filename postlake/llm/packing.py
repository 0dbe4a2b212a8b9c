"""Best-fit packing of token sequences after Martello-Toth reduction.

Documents become pieces of at most ``capacity`` tokens. Only the number of
pieces of each length matters to a packing, so the plan is made on a
histogram of ``capacity`` numbers, whatever the corpus:

1. *Reduction.* For a piece of length j, a set of one, two or three pieces
   that contains it and dominates every other feasible set with it can be
   fixed in some optimal packing: j alone if nothing fits beside it; j with
   the largest piece that fits, if that fills the sequence, if no second
   companion fits, or if no set of companions has a larger sum; j with two
   companions, if at most two fit and each other pair is no larger, piece
   by piece. Fixed sets leave the instance, in bulk per length.
2. *Best-fit decreasing* on the rest: the longest pieces first, each into
   the fullest sequence that has room, again in bulk for sequences alike.

Pieces get the plan's places by their rank among pieces of their length:
counted inside each task, shifted by the counts of earlier tasks.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlake.llm import scratch
from postlake.llm.pretokens import row_blocks
from postlake.llm.token_ids import library_encoder

CAPACITY = 1024
_RANK_SPAN = 1 << 48

#: A filled kind of sequence: how many there are, and (length, count) in order.
Pattern = tuple[int, list[tuple[int, int]]]


def piece_sizes(n: int, capacity: int) -> list[int]:
    """A document of up to ``capacity`` tokens is one piece; of a longer one
    only the first piece may be shorter than the capacity."""
    full, first = divmod(n, capacity)
    return ([first] if first else []) + [capacity] * full


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = CAPACITY,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, piece, start, length, ids, ids_crc32, part, place)`` of every
    whole text: ``ids`` are unsigned 32-bit little-endian, ``place`` is the
    piece's rank among those of its length in task ``part``."""
    names = ["doc_id", "piece", "start", "length", "ids", "ids_crc32", "part", "place"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(tokenizer_path, added_tokens=True)
        part = TaskContext.get().partitionId()
        places = [0] * (capacity + 1)
        for batch in batches:
            for rows in row_blocks(batch):
                ids, bounds = encoder.encode_texts(rows.column("text"))
                out = []
                for i, doc_id in enumerate(rows.column("doc_id").to_pylist()):
                    data = np.append(ids[bounds[i]:bounds[i + 1]], end_id).astype("<u4").tobytes()
                    start = 0
                    for number, size in enumerate(piece_sizes(len(data) // 4, capacity)):
                        cut = data[4 * start:4 * (start + size)]
                        out.append((doc_id, number, start, size, cut, zlib.crc32(cut), part, places[size]))
                        places[size] += 1
                        start += size
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary, ids_crc32 long, "
                                "part int, place long")


def _largest_within(counts: np.ndarray, limit: int) -> int:
    """The largest present length of at most ``limit`` (0: none)."""
    present = np.flatnonzero(counts[:max(0, limit) + 1])
    return int(present[-1]) if present.size else 0


def _smallest(counts: np.ndarray, n: int) -> list[int]:
    """The ``n`` smallest pieces there are (with repeats)."""
    out: list[int] = []
    for length in np.flatnonzero(counts)[:n].tolist():
        out += [length] * min(n - len(out), int(counts[length]))
    return out


def _sums_between(counts: np.ndarray, low: int, high: int) -> bool:
    """Whether two or more pieces may sum to a value in (low, high]."""
    lengths = np.flatnonzero(counts[:high + 1]).tolist()
    window = ((1 << (high + 1)) - 1) & ~((1 << (low + 1)) - 1)
    mask = (1 << (high + 1)) - 1
    single = 0
    several = 0                                  # sums of at least two pieces, any multiplicity
    for length in lengths:
        single |= 1 << length
    frontier = single
    while frontier:
        reached = 0
        for length in lengths:
            reached |= frontier << length
        reached &= mask & ~several
        several |= reached
        if several & window:
            return True
        frontier = reached
    return False


def _dominant(counts: np.ndarray, j: int, capacity: int) -> list[int] | None:
    """The companions of one piece of length j in a dominating set; None if
    none is proved. ``counts`` are without that piece."""
    room = capacity - j
    least = _smallest(counts, 3)
    if not least or least[0] > room:
        return []
    best = _largest_within(counts, room)
    if best == room or len(least) < 2 or least[0] + least[1] > room:
        return [best]
    if not _sums_between(counts, best, room):
        return [best]
    if len(least) < 3 or sum(least) > room:      # at most two companions
        rest = counts.copy()
        rest[best] -= 1
        second = _largest_within(rest, room - best)
        if second:
            inner = 0                            # the largest lesser piece of any feasible pair
            for y in np.flatnonzero(counts[:room // 2 + 1])[::-1].tolist():
                others = counts.copy()
                others[y] -= 1
                larger = np.flatnonzero(others[y:])
                if larger.size and y + y + int(larger[0]) <= room:
                    inner = y
                    break
            if inner <= second:
                return [best, second]
    return None


def reduce_instance(counts: np.ndarray, capacity: int) -> tuple[list[Pattern], np.ndarray]:
    """(fixed sequences, pieces left): Martello-Toth dominance, until a pass
    over the lengths fixes nothing."""
    counts = counts.astype(np.int64).copy()
    fixed: list[Pattern] = []
    again = True
    while again:
        again = False
        for j in range(capacity, 0, -1):
            while counts[j]:
                counts[j] -= 1
                companions = _dominant(counts, j, capacity)
                counts[j] += 1
                if companions is None:
                    break
                items = sorted([j, *companions], reverse=True)
                need = {x: items.count(x) for x in set(items)}
                times = min(int(counts[x]) // c for x, c in need.items())
                # bulk, as long as every length of the set stays plentiful
                if len(items) > 1 and sum(items) < capacity:
                    times = max(1, times - 3)
                for x, c in need.items():
                    counts[x] -= c * times
                fixed.append((times, sorted(need.items(), reverse=True)))
                again = True
    return fixed, counts


def best_fit(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Best-fit decreasing, in bulk over sequences with the same content."""
    open_by_room: dict[int, list[Pattern]] = defaultdict(list)
    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            room = next((r for r in range(length, capacity) if open_by_room.get(r)), None)
            if room is None:
                room, group = capacity, (-(-left // (capacity // length)), [])
            else:
                group = open_by_room[room].pop()
            sequences, content = group
            each = room // length
            full = min(sequences, left // each)
            if full:
                open_by_room[room - each * length].append((full, [*content, (length, each)]))
                left -= full * each
            rest = sequences - full
            if rest and left:                    # the last ones go into one more sequence
                open_by_room[room - left * length].append((1, [*content, (length, left)]))
                rest, left = rest - 1, 0
            if rest:
                open_by_room[room].append((rest, content))
    return [group for groups in open_by_room.values() for group in groups if group[1]]


def make_plan(counts: np.ndarray, capacity: int) -> np.ndarray:
    """Rows (key, per sequence, first sequence, offset) sorted by key: pieces of
    a length from rank ``key % span`` on lie that many to a sequence."""
    fixed, left = reduce_instance(counts, capacity)
    used = np.zeros(capacity + 1, dtype=np.int64)
    rows, sequence = [], 0
    for times, content in [*fixed, *best_fit(left, capacity)]:
        offset = 0
        for length, each in content:
            rows.append((length * _RANK_SPAN + int(used[length]), each, sequence, offset))
            used[length] += times * each
            offset += length * each
        sequence += times
    if (used != counts).any():
        raise AssertionError("the plan does not place every piece once")
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = CAPACITY,
         with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Place every document's pieces into sequences of at most ``capacity`` tokens.

    Returns per piece ``(doc_id, piece, start, length, ids_crc32, sequence_id,
    offset)``, and its ids (unsigned 32-bit, little-endian) if asked for. A
    text's ids end with ``end_id``; a null or empty text is the end id alone;
    repeated rows are packed each; a null ``doc_id`` stays null; other columns
    are not read. Whole texts are packed and no piece exceeds the capacity. An
    empty table gives an empty table.
    """
    spark = docs.sparkSession
    cut = pieces(docs, tokenizer_path, end_id, capacity, id_col, text_col)
    cut = scratch.stored(cut if with_ids else cut.drop("ids"), "pieces")
    per_part = cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = scratch.stored(per_part.withColumn("shift", F.coalesce(F.sum("n").over(before), F.lit(0))), "piece-counts")
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in shifts.groupBy("length").agg(F.sum("n").alias("n")).collect():    # at most ``capacity`` rows
        counts[row.length] = row.n
    plan = spark.sparkContext.broadcast(make_plan(counts, capacity))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, each, first, offset = plan.value.T
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("shift").to_numpy() + batch.column("place").to_numpy()
            at = np.searchsorted(keys, length * _RANK_SPAN + rank, side="right") - 1
            nth = rank - keys[at] % _RANK_SPAN
            out = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays(
                [*out, pa.array(first[at] + nth // each[at]), pa.array(offset[at] + nth % each[at] * length)],
                names=[*kept, "sequence_id", "offset"])

    kept = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    schema = ("doc_id long, piece int, start long, length long, ids_crc32 long, "
              + ("ids binary, " if with_ids else "") + "sequence_id long, offset long")
    return cut.join(shifts.drop("n"), ["length", "part"]).select(*kept, "place", "shift").mapInArrow(run, schema)
