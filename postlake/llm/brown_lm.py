"""Brown class-based n-gram scoring.

Words belong to classes; a word's probability given the word before it is

    P(class | class before) * P(word | class).

Exchange clustering assigns the classes: a word moves to the class that most
raises the likelihood of the class bigrams. It starts from classes of a fixed
number of slots (a short word by itself, a longer one by its ending, hashed),
exchanged on the slots' bigrams. Then the vocabulary's words move by
themselves: the ``VOCABULARY`` most frequent words of training (fewer where
counts tie at the limit). A pass over the corpus sums, for every such word of
a part of the vocabulary, the classes before and after it; a task adds up its
blocks before it sends anything, and sums by word range are added in Spark.
Each word takes its best class given the others'. All words of a part move at
once; if that lowers the likelihood, half of them (by hash) move back, and
again, until it does not. Rarer words, with little to tell by, and words never
seen have their slot's class. Word classes are one byte for each word of the
vocabulary, so they are broadcast, and the corpus stays where it is. The end
of a text is a word with a slot and class of its own, and is what stands
before a text's first word.

* Transition: add-one smoothed class bigrams.
* Emission: a known word has (count - d) / N(class) with absolute discount
  d = n1 / (n1 + 2 n2) from the numbers of words seen once and twice. What the
  discount frees, d * V(class) / N(class), is spread over the class's unseen
  words, of which there are about n1^2 / (2 (n2 + 1)) + 1 by its own words seen
  once and twice (Chao's estimate).

The corpus is read once into blocks (word numbers of some whole texts and
the block's own distinct words), kept in the shared checkpoint folder. One
pass over the blocks sums the slot bigrams; the first exchange runs on that
table of at most ``(SLOTS + 1) ** 2`` counts.
Word counts are summed by word over the blocks' distinct words and return to
the blocks by block number, so what is shuffled are distinct words per block,
never tokens, and every word is counted, however rare.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.llm import scratch
from postlake.llm.pretokens import row_blocks

SLOTS = 4096
CLASSES = 48
ROUNDS = 3
#: Words of up to so many bytes have a slot by themselves, others by their last bytes.
SHORT_WORD, ENDING = 4, 3
#: Text bytes of a block (one longer text is a block of its own).
BLOCK_TEXT = 6 << 20
_RANGES = 64                   # slot ranges in which partial counts travel
#: Words with a class of their own: 9 bytes each are broadcast.
VOCABULARY = 1 << 18
#: Disjoint parts of the vocabulary that move in turn, and the times that a
#: part's moves are halved before it stays.
WORD_PARTS, HALVINGS = 2, 3
#: Words whose counts travel together, and counts that a task holds before it sends them.
_WORD_RANGE, _HELD_COUNTS = 8192, 1 << 22

_BLOCK = T.StructType([
    T.StructField("block", T.LongType(), False),
    T.StructField("doc_ids", T.ArrayType(T.LongType(), True), False),
    T.StructField("held_out", T.ArrayType(T.BooleanType(), False), False),
    T.StructField("sizes", T.BinaryType(), False),       # <u4, tokens of each text
    T.StructField("index", T.BinaryType(), False),       # packed word numbers of all tokens
    T.StructField("slots", T.BinaryType(), False),       # <u2, slot of each word
    T.StructField("words", T.ArrayType(T.BinaryType(), False), False),
    T.StructField("n_train", T.ArrayType(T.LongType(), False), False),
])


def pack_index(index: np.ndarray) -> bytes:
    """Word numbers as zstd-compressed byte planes (frequent words appear early
    in a block, so the higher planes are nearly empty)."""
    import zstandard

    planes = np.ascontiguousarray(index.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_index(data: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


@dataclass(frozen=True)
class Model:
    """What scoring needs besides a word's count; bounded by slots and classes."""

    classes: np.ndarray        # slot -> class (the end's slot is the last)
    vocabulary: np.ndarray     # hashes of the words with own classes, ascending
    word_classes: np.ndarray   # and their classes
    log_transition: np.ndarray  # [class before, class]
    class_tokens: np.ndarray
    class_words: np.ndarray
    class_unseen: np.ndarray   # estimated unseen words
    discount: float
    tokens: int
    words: int
    moved: int                 # words that left their slot's class


def split_words(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(distinct words, word numbers of all tokens, tokens of each text).

    A-Z are lower-cased, words are runs without white space (space, tab to
    carriage return), and word number 0, the empty word, ends every text."""
    raw = texts.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], dtype=np.int64)[raw.offset:raw.offset + len(raw) + 1]
    lo, hi = int(offsets[0]), int(offsets[-1])
    data = raw.buffers()[2].slice(lo, hi - lo).to_pybytes().lower() if hi > lo else b""
    chars = np.frombuffer(data, dtype=np.uint8)
    bounds = offsets - lo
    inside = (chars != 0x20) & ((chars < 0x09) | (chars > 0x0D))
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    edges = bounds[:-1][bounds[:-1] < chars.size]
    starts[edges] = inside[edges]                # a text's first word starts with it
    letters = chars[inside]
    at = np.flatnonzero(starts)
    place = np.cumsum(inside) - 1
    cuts = np.append(place[at], letters.size).astype(np.int32)
    coded = pa.Array.from_buffers(pa.binary(), at.size, [None, pa.py_buffer(cuts), pa.py_buffer(letters.tobytes())]
                                  ).dictionary_encode()
    per_text = np.diff(np.searchsorted(at, bounds))
    ends = np.cumsum(per_text)
    index = np.insert(coded.indices.to_numpy().astype(np.int64) + 1, ends, 0)
    return [b"", *coded.dictionary.to_pylist()], index, per_text + 1


def word_slots(words: list[bytes], slots: int) -> np.ndarray:
    """Slot of each word; the end of a text has slot ``slots``."""
    import xxhash

    keys = (w if len(w) <= SHORT_WORD else b" " + w[-ENDING:] for w in words)
    out = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(words)) % np.uint64(slots)
    out[[i for i, w in enumerate(words[:1]) if not w]] = slots
    return out.astype("<u2")


def make_blocks(docs: DataFrame, slots: int) -> DataFrame:
    """Blocks of ``docs (doc_id, text, held_out)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for rows in row_blocks(batch, block_bytes=BLOCK_TEXT):
                words, index, sizes = split_words(rows.column("text"))
                held = rows.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
                train = np.bincount(index[np.repeat(~held, sizes)], minlength=len(words))
                yield pa.RecordBatch.from_arrays([
                    pa.array([base + number], pa.int64()),
                    pa.array([rows.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                    pa.array([held.tolist()], pa.list_(pa.bool_())),
                    pa.array([sizes.astype("<u4").tobytes()], pa.binary()),
                    pa.array([pack_index(index)], pa.binary()),
                    pa.array([word_slots(words, slots).tobytes()], pa.binary()),
                    pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pa.array(words, pa.binary())),
                    pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pa.array(train, pa.int64())),
                ], names=_BLOCK.names)
                number += 1

    return docs.mapInArrow(run, _BLOCK)


def block_words(blocks: DataFrame) -> DataFrame:
    """``(block, number, word, slot, n)`` for each word of each block, with its
    count in the block's training texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                words = row.column("words").flatten()
                n = len(words)
                for i in range(0, n, 50_000):
                    m = min(50_000, n - i)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(m, row.column("block")[0].as_py())),
                        pa.array(np.arange(i, i + m, dtype=np.int32)), words.slice(i, m),
                        pa.array(np.frombuffer(row.column("slots")[0].as_py(), "<u2")[i:i + m].astype(np.int32)),
                        row.column("n_train").flatten().slice(i, m)],
                        names=["block", "number", "word", "slot", "n"])

    return blocks.select("block", "words", "slots", "n_train").mapInArrow(
        run, "block long, number int, word binary, slot int, n long")


def word_totals(rows: DataFrame) -> DataFrame:
    """``(word, slot, count)`` of every word, summed per task first."""
    return rows.groupBy("word", "slot").agg(F.sum("n").alias("count"))


def counts_of_blocks(rows: DataFrame, totals: DataFrame) -> DataFrame:
    """``(block, number, count)``: each word's count in all training texts,
    back at its blocks (a join that adaptive execution may split)."""
    return rows.select("block", "number", "word").join(totals.select("word", "count"), "word").drop("word")


def slot_bigrams(blocks: DataFrame, slots: int) -> np.ndarray:
    """``[slot before, slot]`` counts over training texts.

    A task sends its non-zero counts, zstd-compressed, by range of the first
    slot; ranges are summed as streams. The driver gets ``(slots + 1) ** 2``
    numbers, whatever the corpus."""
    n, span = slots + 1, -(-(slots + 1) // _RANGES)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                sizes = np.frombuffer(row["sizes"], "<u4").astype(np.int64)
                train = np.repeat(~np.array(row["held_out"], dtype=bool), sizes)
                slot = np.frombuffer(row["slots"], "<u2")[unpack_index(row["index"])][train].astype(np.int64)
                if not slot.size:
                    continue
                before = np.empty_like(slot)     # texts end with the end's slot
                before[1:], before[0] = slot[:-1], slots
                new, times = np.unique(before * n + slot, return_counts=True)
                codes, where = np.unique(np.concatenate([codes, new]), return_inverse=True)
                counts = np.bincount(where, np.concatenate([counts, times])).astype(np.int64)
        edges = np.searchsorted(codes, np.arange(_RANGES + 1) * span * n)
        pack = zstandard.ZstdCompressor(level=1).compress
        for r in np.flatnonzero(np.diff(edges)):
            i, j = edges[r], edges[r + 1]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r], pa.int32()),
                 pa.array([pack(np.diff(codes[i:j], prepend=r * span * n).tobytes() + counts[i:j].tobytes())],
                          pa.binary())], names=["part", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        sums: dict[int, np.ndarray] = {}
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for r, counts in zip(*(c.to_pylist() for c in batch.columns)):
                steps, times = np.frombuffer(unpack(counts), np.int64).reshape(2, -1)
                if r not in sums:
                    sums[r] = np.zeros(span * n, dtype=np.int64)
                sums[r][np.cumsum(steps)] += times
        for r, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([r], pa.int32()),
                 pa.array([zstandard.ZstdCompressor(level=1).compress(total.tobytes())], pa.binary())],
                names=["part", "counts"])

    import zstandard

    schema = "part int, counts binary"
    merged = (blocks.select("held_out", "sizes", "index", "slots").mapInArrow(count, schema)
              .repartition("part").mapInArrow(add, schema))
    out = np.zeros(_RANGES * span * n, dtype=np.float64)
    for row in merged.toLocalIterator():
        out[row.part * span * n:(row.part + 1) * span * n] = np.frombuffer(
            zstandard.ZstdDecompressor().decompress(row.counts), np.int64)
    return out[:n * n].reshape(n, n)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(class_bigrams: np.ndarray) -> float:
    """Log-likelihood of the classes, up to a constant of the words alone."""
    return float(_xlogx(class_bigrams).sum() - _xlogx(class_bigrams.sum(0)).sum()
                 - _xlogx(class_bigrams.sum(1)).sum())


def first_classes(bigrams: np.ndarray, n_classes: int) -> np.ndarray:
    """Slots dealt over the classes by frequency; the end has the last class."""
    classes = np.empty(len(bigrams), dtype=np.int64)
    order = np.argsort(-bigrams[:, :-1].sum(0), kind="stable")
    classes[order] = np.arange(order.size) % n_classes
    classes[-1] = n_classes
    return classes


def exchange(bigrams: np.ndarray, classes: np.ndarray, n_classes: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(classes, class bigrams) after moving slots, most frequent first, to the
    class of largest gain, until ``rounds`` are over or none moves."""
    total = n_classes + 1
    classes = classes.copy()
    one_hot = np.eye(total)[classes]
    to_class, from_class = bigrams @ one_hot, bigrams.T @ one_hot   # [slot, class]
    n = one_hot.T @ to_class
    order = np.argsort(-bigrams[:, :-1].sum(0), kind="stable")
    order = order[(bigrams[:, order].sum(0) > 0)]
    for _ in range(rounds):
        moved = 0
        for s in order:
            own, twin = classes[s], bigrams[s, s]
            after, before = to_class[s].copy(), from_class[s].copy()
            after[own] -= twin
            before[own] -= twin
            n[own] -= after
            n[:, own] -= before
            n[own, own] -= twin                  # the slot is in no class now
            gain = (_xlogx(n + after) - _xlogx(n)).sum(1) + (_xlogx(n + before[:, None]) - _xlogx(n)).sum(0)
            d = np.diag(n)                       # the cell that gets both, and the slot's own pairs
            gain += _xlogx(d + after + before + twin) - _xlogx(d + after) - _xlogx(d + before) + _xlogx(d)
            rows, columns = n.sum(1) + before, n.sum(0) + after
            gain -= _xlogx(rows + after.sum() + twin) - _xlogx(rows)
            gain -= _xlogx(columns + before.sum() + twin) - _xlogx(columns)
            gain[n_classes] = -np.inf
            best = int(gain.argmax())
            if gain[best] <= gain[own] + 1e-9:
                best = own
            n[best] += after
            n[:, best] += before
            n[best, best] += twin
            if best != own:
                moved += 1
                classes[s] = best
                to_class[:, own] -= bigrams[:, s]
                to_class[:, best] += bigrams[:, s]
                from_class[:, own] -= bigrams[s]
                from_class[:, best] += bigrams[s]
        if not moved:
            break
    return classes, n


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


@dataclass
class Classes:
    """Classes of slots and of the vocabulary's words."""

    slots: np.ndarray
    vocabulary: np.ndarray
    words: np.ndarray

    def of(self, hashes: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(class, place in the vocabulary or -1) of each word."""
        out = self.slots[slots].astype(np.int64)
        place = np.full(hashes.size, -1)
        if self.vocabulary.size:
            at = np.minimum(np.searchsorted(self.vocabulary, hashes), self.vocabulary.size - 1)
            there = (self.vocabulary[at] == hashes) & (slots != self.slots.size - 1)
            place[there] = at[there]
            out[there] = self.words[at[there]]
        return out, place


def vocabulary(totals: DataFrame, slot_classes: np.ndarray, limit: int = VOCABULARY) -> Classes:
    """The most frequent words, at most ``limit``, all of them or none at any
    count; each with its slot's class."""
    slots = len(slot_classes) - 1
    seen = totals.where(F.col("count") > 0).where(F.col("slot") != slots)
    # (count, words with it): the number of distinct counts grows as the root of the corpus
    least, left = None, limit
    for row in seen.groupBy("count").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("count")).toLocalIterator():
        left -= row.n
        if left < 0:
            break
        least = row["count"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(word_hashes(batch.column("word").to_pylist()).astype("<i8")), batch.column("slot")], names=["h", "slot"])

    if least is None:
        return Classes(slot_classes, np.zeros(0, np.uint64), np.zeros(0, np.uint8))
    found = seen.where(F.col("count") >= least).select("word", "slot").mapInArrow(run, "h long, slot int").toArrow()
    hashes = found.column("h").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return Classes(slot_classes, hashes[order], slot_classes[found.column("slot").to_numpy()][order].astype(np.uint8))


def _train_tokens(row: dict) -> np.ndarray:
    """Word numbers of a block's training tokens."""
    sizes = np.frombuffer(row["sizes"], "<u4").astype(np.int64)
    return unpack_index(row["index"])[np.repeat(~np.array(row["held_out"], dtype=bool), sizes)].astype(np.int64)


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            out = {c: row.column(c)[0].as_py() for c in row.schema.names if c != "words"}
            out["hashes"] = word_hashes(row.column("words").flatten().to_pylist())
            yield out


_TOKENS = ["held_out", "sizes", "index", "slots", "words"]


def class_bigrams(blocks: DataFrame, classes: Classes, total: int) -> np.ndarray:
    """``[class before, class]`` counts of training texts."""
    shared = blocks.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(total * total, dtype=np.int64)
        for row in _rows_of(batches):
            kinds = shared.value.of(row["hashes"], np.frombuffer(row["slots"], "<u2"))[0][_train_tokens(row)]
            sums += np.bincount(np.append(total - 1, kinds)[:-1] * total + kinds, minlength=total * total)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(sums[at])], names=["cell", "n"])

    out = np.zeros(total * total)
    for r in blocks.select(*_TOKENS).mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[r.cell] = r.n
    return out.reshape(total, total)


def best_classes(n: np.ndarray, own: np.ndarray, before: np.ndarray, after: np.ndarray, twin: np.ndarray) -> np.ndarray:
    """Best class of each word given the class bigrams ``n``, all others fixed.

    ``before`` and ``after`` are a word's counts [word, class] without its
    ``twin`` pairs with itself; the last class, the end's, is none of them."""
    gain = class_gains(n, own, before, after, twin)
    best = gain.argmax(axis=1)
    at = np.arange(own.size)
    return np.where(gain[at, best] > gain[at, own] + 1e-9, best, own)


def class_gains(n: np.ndarray, own: np.ndarray, before: np.ndarray, after: np.ndarray, twin: np.ndarray) -> np.ndarray:
    """``[word, class]``: the log-likelihood of the class bigrams with each
    word in each class, against the word in no class."""
    total = len(n)
    out = np.empty((own.size, total))
    sums, below = n.sum(1), n.sum(0)
    logs = _xlogx(n)
    for w in range(own.size):
        a, b, t, c = after[w], before[w], twin[w], own[w]
        at, bt = np.flatnonzero(a), np.flatnonzero(b)
        # the word leaves its class c: row c loses what follows it, column c what stands before it
        m_at, m_bt = n[:, at], n[bt]
        m_at[c] -= a[at]
        m_at[:, at == c] -= (b + t * (np.arange(total) == c))[:, None]
        m_bt[:, c] -= b[bt]
        m_bt[bt == c] -= a + t * (np.arange(total) == c)
        d = np.diag(n).copy()
        d[c] -= a[c] + b[c] + t
        changed = c in at or c in bt
        base_at = logs[:, at].copy() if not changed else _xlogx(m_at)
        base_at[c] = _xlogx(m_at[c])
        base_bt = logs[bt].copy() if not changed else _xlogx(m_bt)
        base_bt[:, c] = _xlogx(m_bt[:, c])
        gain = (_xlogx(m_at + a[at]) - base_at).sum(1) + (_xlogx(m_bt + b[bt, None]) - base_bt).sum(0)
        gain += _xlogx(d + a + b + t) - _xlogx(d + a) - _xlogx(d + b) + _xlogx(d)
        rows, columns = sums - b, below - a
        rows[c] -= a.sum() + t
        columns[c] -= b.sum() + t
        rows, columns = rows + b, columns + a
        gain -= _xlogx(rows + a.sum() + t) - _xlogx(rows)
        gain -= _xlogx(columns + b.sum() + t) - _xlogx(columns)
        out[w] = gain
    out[:, total - 1] = -np.inf
    return out


def word_contexts(blocks: DataFrame, classes: Classes, total: int, part: int, parts: int) -> DataFrame:
    """``(range, places, cells, times)``: for the vocabulary's words of ``part``
    the counts of the classes before them, after them, and of themselves."""
    shared = blocks.sparkSession.sparkContext.broadcast(classes)
    width = 2 * total + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        codes, times, held = [], [], 0

        def send() -> Iterator[pa.RecordBatch]:
            nonlocal held
            both, where = np.unique(np.concatenate(codes), return_inverse=True)
            sums = np.bincount(where, np.concatenate(times)).astype(np.int64)
            codes.clear()
            times.clear()
            held = 0
            ranges = both // width // _WORD_RANGE
            edges = np.flatnonzero(np.diff(ranges, prepend=-1))
            for i, j in zip(edges, np.append(edges[1:], both.size)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(ranges[i])], pa.int32()),
                     pa.array([pack(np.diff(both[i:j], prepend=ranges[i] * _WORD_RANGE * width).astype("<u4").tobytes())], pa.binary()),
                     pa.array([pack(sums[i:j].astype("<u4").tobytes())], pa.binary())], names=["range", "steps", "times"])

        for row in _rows_of(batches):
            slots = np.frombuffer(row["slots"], "<u2")
            kind_of, place = shared.value.of(row["hashes"], slots)
            chosen = (place >= 0) & (row["hashes"] % np.uint64(parts) == part)
            index = _train_tokens(row)
            prior, kinds = np.append(0, index)[:-1], kind_of[index]        # texts end with word 0
            twins = prior == index
            follow, lead, same = chosen[index] & ~twins, chosen[prior] & ~twins, chosen[index] & twins
            code, n = np.unique(np.concatenate([
                place[index[follow]] * width + kind_of[prior[follow]],
                place[prior[lead]] * width + total + kinds[lead], place[index[same]] * width + 2 * total]), return_counts=True)
            codes.append(code)
            times.append(n)
            held += code.size
            if held > _HELD_COUNTS:
                yield from send()
        if held:
            yield from send()

    return blocks.select(*_TOKENS).mapInArrow(run, "range int, steps binary, times binary")


def word_moves(contexts: DataFrame, classes: Classes, between: np.ndarray) -> np.ndarray:
    """Class of every vocabulary word, moved where ``contexts`` has counts."""
    total = len(between)
    width = 2 * total + 1
    shared = contexts.sparkSession.sparkContext.broadcast((classes.words, between))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        sums: dict[int, np.ndarray] = {}
        own, n = shared.value
        for batch in batches:
            for r, steps, times in zip(*(c.to_pylist() for c in batch.columns)):
                if r not in sums:
                    sums[r] = np.zeros(_WORD_RANGE * width, dtype=np.int64)
                sums[r][np.cumsum(np.frombuffer(unpack(steps), "<u4").astype(np.int64))] += np.frombuffer(unpack(times), "<u4")
        for r, flat in sums.items():
            dense = flat.reshape(_WORD_RANGE, width)
            met = np.flatnonzero(dense.any(axis=1))
            places = met + r * _WORD_RANGE
            counts = dense[met].astype(np.float64)
            best = best_classes(n, own[places].astype(np.int64), counts[:, :total], counts[:, total:-1], counts[:, -1])
            at = np.flatnonzero(best != own[places])
            yield pa.RecordBatch.from_arrays(
                [pa.array(places[at], pa.int32()), pa.array(best[at], pa.int32())], names=["place", "cls"])

    out = classes.words.copy()
    moved = contexts.repartition("range").mapInArrow(add, "place int, cls int").toArrow()   # at most the vocabulary
    out[moved.column("place").to_numpy()] = moved.column("cls").to_numpy().astype(np.uint8)
    return out


def exchange_words(blocks: DataFrame, classes: Classes, between: np.ndarray, parts: int = WORD_PARTS) -> tuple[Classes, np.ndarray]:
    """(classes, class bigrams) after moving the vocabulary's words, part by part."""
    total = len(between)
    for part in range(parts if classes.vocabulary.size else 0):
        contexts = word_contexts(blocks, classes, total, part, parts)
        words = word_moves(contexts, classes, between)
        for halved in range(HALVINGS + 1):
            if (words == classes.words).all():
                break
            tried = Classes(classes.slots, classes.vocabulary, words)
            now = class_bigrams(blocks, tried, total)
            if likelihood(now) >= likelihood(between):
                classes, between = tried, now
                break
            stay = (classes.vocabulary >> np.uint64(40 + halved)) & np.uint64(1) == 1
            words = np.where(stay, classes.words, words)
    return classes, between


def fit(blocks: DataFrame, totals: DataFrame, slots: int = SLOTS, n_classes: int = CLASSES,
        rounds: int = ROUNDS, limit: int = VOCABULARY) -> Model:
    """Exchange clustering and the model's bounded parameters."""
    total = n_classes + 1                        # the end's class is the last
    bigrams = slot_bigrams(blocks, slots)
    slot_classes, between = exchange(bigrams, first_classes(bigrams, n_classes), n_classes, rounds)
    start = vocabulary(totals, slot_classes, limit)
    classes, between = exchange_words(blocks, start, between)
    shared = blocks.sparkSession.sparkContext.broadcast(classes)

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((4, total), dtype=np.int64)      # tokens, words, seen once, seen twice
        for batch in batches:
            kind = shared.value.of(word_hashes(batch.column("word").to_pylist()), batch.column("slot").to_numpy())[0]
            n = batch.column("count").to_numpy()
            for row, weights in zip(sums, (n, n > 0, n == 1, n == 2)):
                row += np.bincount(kind, weights, total).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total), pa.int32()), *map(pa.array, sums)],
                                         names=["cls", "tokens", "words", "once", "twice"])

    counted = np.zeros((4, total), dtype=np.int64)
    for r in totals.where(F.col("count") > 0).mapInArrow(sizes, "cls int, tokens long, words long, once long, twice long").groupBy(
            "cls").agg(*[F.sum(c).alias(c) for c in ("tokens", "words", "once", "twice")]).collect():
        counted[:, r.cls] = r.tokens, r.words, r.once, r.twice
    tokens, words, once, twice = counted
    discount = min(0.95, max(0.05, once.sum() / (once.sum() + 2 * twice.sum()))) if once.sum() else 0.5
    unseen = 1 + once.astype(float) ** 2 / (2 * (twice + 1))
    transition = (between + 1) / (between.sum(1, keepdims=True) + total)
    return Model(slot_classes, classes.vocabulary, classes.words, np.log10(transition), tokens, words, unseen, discount,
                 int(tokens.sum()), int(words.sum()), int((classes.words != start.words).sum()))


def _score_block(model: Model, row: dict, numbers: np.ndarray, found: np.ndarray) -> pa.Table:
    kind = np.frombuffer(row["kinds"], np.uint8).astype(np.int64)
    sizes = np.frombuffer(row["sizes"], "<u4").astype(np.int64)
    index = unpack_index(row["index"])
    count = np.zeros(kind.size)
    count[numbers] = found
    in_class = np.maximum(model.class_tokens[kind], 1)
    unknown = np.where(model.class_words[kind] > 0, model.discount * model.class_words[kind] / in_class, 1.0)
    unknown = unknown / model.class_unseen[kind]
    emission = np.log10(np.where(count > 0, (count - model.discount) / in_class, unknown))
    base = np.log10((count + 1) / (model.tokens + model.words + 1))
    kinds = kind[index]
    before = np.append(model.classes[-1], kinds[:-1])
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    add = lambda x: np.add.reduceat(x, starts)  # noqa: E731 - every text has its end token
    return pa.table({
        "doc_id": pa.array(row["doc_ids"], pa.int64()), "held_out": pa.array(row["held_out"], pa.bool_()),
        "n_tokens": sizes, "n_known": add((count[index] > 0).astype(np.int64)),
        "train_tokens": np.full(sizes.size, model.tokens),
        "base_score": add(base[index]),
        "score": add(emission[index] + model.log_transition[before, kinds])})


def with_kinds(blocks: DataFrame, model: Model) -> DataFrame:
    """Blocks with a class byte for each word instead of the words."""
    shared = blocks.sparkSession.sparkContext.broadcast(Classes(model.classes, model.vocabulary, model.word_classes))
    kept = ["block", "doc_ids", "held_out", "sizes", "index"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                hashes = word_hashes(row.column("words").flatten().to_pylist())
                kinds = shared.value.of(hashes, np.frombuffer(row.column("slots")[0].as_py(), "<u2"))[0]
                yield pa.RecordBatch.from_arrays([*row.select(kept).columns, pa.array([kinds.astype(np.uint8).tobytes()], pa.binary())],
                                                 names=[*kept, "kinds"])

    schema = T.StructType([*[_BLOCK[c] for c in kept], T.StructField("kinds", T.BinaryType(), False)])
    return blocks.select(*kept, "slots", "words").mapInArrow(run, schema)


def score(blocks: DataFrame, counts: DataFrame, model: Model) -> DataFrame:
    """Base and model scores of every text of the blocks."""
    model_only = replace(model, vocabulary=np.zeros(0, np.uint64), word_classes=np.zeros(0, np.uint8))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        number, count = right.column("number").to_numpy(), right.column("count").to_numpy()
        tables = [_score_block(model_only, row, number, count) for row in left.to_pylist()]
        return pa.concat_tables(tables) if tables else schema_table

    schema = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
              "base_score double, score double")
    schema_table = pa.table({
        "doc_id": pa.array([], pa.int64()), "held_out": pa.array([], pa.bool_()),
        **{c: pa.array([], pa.int64()) for c in ("n_tokens", "n_known", "train_tokens")},
        **{c: pa.array([], pa.float64()) for c in ("base_score", "score")}})
    texts = with_kinds(blocks, model)
    return texts.groupBy("block").cogroup(counts.select("block", "number", "count").groupBy("block")).applyInArrow(
        run, schema)


def brown_scores(docs: DataFrame, held_out=None, slots: int = SLOTS, n_classes: int = CLASSES, rounds: int = ROUNDS,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learn from the rows where ``held_out`` is not true; score every row.

    Returns ``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score)``, scores in log10. A null or empty text is its end alone; a null
    ``held_out`` counts as false; repeated rows count and are scored each;
    other columns are not read. Without training text every word is unknown.
    An empty table gives an empty table.
    """
    held = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       held.alias("held_out"))
    blocks = scratch.stored(make_blocks(rows, slots), "word-blocks")
    words = block_words(blocks)
    totals = scratch.stored(word_totals(words), "word-totals")
    return score(blocks, counts_of_blocks(words, totals), fit(blocks, totals, slots, n_classes, rounds))
