"""Drop lines that repeat across documents, with two Bloom filters.

Pass 1 hashes every document's distinct line keys and sets bits in two
filters, *seen once* and *seen twice*: a bit that a second document (or a
second task) sets again moves to the second filter. Tasks send only the bit
positions, grouped by filter segment, and each segment is merged as a
stream. A key found in two documents always has all its bits in the second
filter, so a key that misses there is unique and never leaves its task.

Pass 2 probes the second filter; only suspected repeats are shuffled, with
their text, for the exact document counts and the first occurrence. Counts
are summed per task first, and the decisions return to the rows by a join
that adaptive execution may broadcast or split at hot keys.

The filters have a fixed size (``filter_bits``), whatever the input: that
bounds what is collected and broadcast. On inputs with many more distinct
lines than bits the filter admits more (in the end all) lines as suspects;
the result stays exact and the cost becomes that of the plain shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.llm import scratch

WHITE = b" \t\n\x0b\x0c\r"
FILTER_BITS = 1 << 27          # per filter: 16 MB
_SEGMENT_BITS = 1 << 21        # merged, sent and collected in pieces of 256 KB
_FLUSH = 1 << 21               # hashes held by a task before it sends positions

_POSITIONS = T.StructType([T.StructField("segment", T.IntegerType(), False),
                           T.StructField("once", T.BinaryType(), False),
                           T.StructField("twice", T.BinaryType(), False)])
_SEGMENT = T.StructType([T.StructField("segment", T.IntegerType(), False),
                         T.StructField("bits", T.BinaryType(), False)])
_SUSPECT = T.StructType([T.StructField("doc", T.LongType()),
                         T.StructField("content", T.LongType(), False),
                         T.StructField("key", T.BinaryType(), False),
                         T.StructField("lines", T.ArrayType(T.IntegerType(), False), False)])


def line_key(line: bytes) -> bytes:
    """The line without white space at both ends, A-Z lower-cased."""
    return line.strip(WHITE).lower()


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (min_chars <= 1 or len(key.decode("utf-8")) >= min_chars)


def _document_keys(text: bytes, min_chars: int) -> dict[bytes, list[int]]:
    """Line numbers of each key that may be dropped."""
    found: dict[bytes, list[int]] = {}
    for number, line in enumerate(text.split(b"\n")):
        key = line_key(line)
        if key and _long_enough(key, min_chars):
            found.setdefault(key, []).append(number)
    return found


def _bits(hashes: np.ndarray, filter_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bit positions of each hash."""
    mask = np.uint64(filter_bits - 1)
    return ((hashes & mask).astype(np.int64),
            (((hashes >> np.uint64(32)) * np.uint64(0x9E3779B1) >> np.uint64(7)) & mask).astype(np.int64))


def _positions(hashes: np.ndarray, filter_bits: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(segment, once, twice) bit positions of a task's document-wise hashes."""
    distinct, counts = np.unique(hashes, return_counts=True)
    once = np.unique(np.concatenate(_bits(distinct, filter_bits)))
    twice = np.unique(np.concatenate(_bits(distinct[counts > 1], filter_bits)))
    edges = np.arange(0, filter_bits + _SEGMENT_BITS, _SEGMENT_BITS)
    o, t = np.searchsorted(once, edges), np.searchsorted(twice, edges)
    for s in range(len(edges) - 1):
        if o[s] < o[s + 1]:
            yield (s, (once[o[s]:o[s + 1]] - edges[s]).astype("<u4").tobytes(),
                   (twice[t[s]:t[s + 1]] - edges[s]).astype("<u4").tobytes())


def seen_twice(lines: DataFrame, filter_bits: int, min_chars: int) -> np.ndarray:
    """The merged *seen twice* filter, as packed bits (``filter_bits / 8`` bytes)."""
    if filter_bits % _SEGMENT_BITS or filter_bits & (filter_bits - 1):
        raise ValueError(f"filter_bits must be a power of two of at least {_SEGMENT_BITS}")

    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest, held = xxhash.xxh3_64_intdigest, []

        def send():
            rows = list(_positions(np.array(held, dtype=np.uint64), filter_bits))
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()),
                 pa.array([r[2] for r in rows], pa.binary())], names=_POSITIONS.names)

        for batch in batches:
            for text in batch.column("text").to_pylist():
                if text:
                    held.extend(map(digest, _document_keys(text, min_chars)))
                    if len(held) >= _FLUSH:
                        yield send()
        if held:
            yield send()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for s, once, twice in zip(*(c.to_pylist() for c in batch.columns)):
                if s not in state:
                    state[s] = (np.zeros(_SEGMENT_BITS, bool), np.zeros(_SEGMENT_BITS, bool))
                seen, again = state[s]
                new = np.frombuffer(once, "<u4")
                again[new[seen[new]]] = True
                seen[new] = True
                again[np.frombuffer(twice, "<u4")] = True
        for s, (_, again) in state.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([s], pa.int32()), pa.array([np.packbits(again, bitorder="little").tobytes()], pa.binary())],
                names=_SEGMENT.names)

    merged = lines.select("text").mapInArrow(positions, _POSITIONS).repartition("segment").mapInArrow(merge, _SEGMENT)
    out = np.zeros(filter_bits // 8, dtype=np.uint8)
    size = _SEGMENT_BITS // 8
    for row in merged.toLocalIterator():        # at most filter_bits / 8 bytes in all
        out[row.segment * size:(row.segment + 1) * size] = np.frombuffer(row.bits, np.uint8)
    return out


def _suspects(lines: DataFrame, repeated: np.ndarray, filter_bits: int, min_chars: int) -> DataFrame:
    shared = lines.sparkSession.sparkContext.broadcast(repeated)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest, bits = xxhash.xxh3_64_intdigest, shared.value

        def is_set(at):
            return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1

        for batch in batches:
            docs, contents = batch.column("doc").to_pylist(), batch.column("content").to_pylist()
            rows: list[tuple] = []
            for i, text in enumerate(batch.column("text").to_pylist()):
                if text:
                    rows.extend((i, key, at) for key, at in _document_keys(text, min_chars).items())
            if not rows:
                continue
            hashes = np.fromiter((digest(r[1]) for r in rows), np.uint64, len(rows))
            first, second = _bits(hashes, filter_bits)
            hits = [rows[j] for j in np.flatnonzero(is_set(first) & is_set(second))]
            for k in range(0, len(hits), 50_000):
                part = hits[k:k + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([docs[i] for i, _, _ in part], pa.int64()),
                     pa.array([contents[i] for i, _, _ in part], pa.int64()),
                     pa.array([key for _, key, _ in part], pa.binary()),
                     pa.array([at for _, _, at in part], pa.list_(pa.int32()))], names=_SUSPECT.names)

    return lines.mapInArrow(run, _SUSPECT)


def line_dedup(docs: DataFrame, min_docs: int = 2, min_chars: int = 1, keep: str = "first",
               filter_bits: int = FILTER_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove the lines whose key at least ``min_docs`` documents hold.

    A text is split at ``\\n``; a line's key is the line without white space
    (space, tab to carriage return) at both ends, A-Z lower-cased; keys with
    fewer than ``min_chars`` code points (and empty ones) always stay.
    ``keep="none"`` drops every such line, ``keep="first"`` keeps the first:
    least ``doc_id`` (null first), then text hash, then line number; of rows
    equal in both, one (by a hash of the row). With ``keep="first"`` the rows of
    equal id and text that hold first occurrences are numbered by one task.

    Returns all columns, the text rebuilt from its other lines, and
    ``n_lines`` (before dropping) and ``n_dropped``; input columns of these
    two names are replaced. A null text stays null and counts as one empty
    line. Every row is a document, repeated rows and repeated ids included.
    An empty table gives an empty table.
    """
    if keep not in ("none", "first"):
        raise ValueError("keep must be 'none' or 'first'")
    content = F.xxhash64(F.col(text_col))
    lines = docs.select(F.col(id_col).cast("long").alias("doc"), content.alias("content"),
                        F.col(text_col).cast("binary").alias("text"))
    repeated = seen_twice(lines, filter_bits, min_chars) if min_docs > 1 \
        else np.full(filter_bits // 8, 255, np.uint8)
    suspects = scratch.stored(_suspects(lines, repeated, filter_bits, min_chars), "suspect-lines")

    counted = suspects.groupBy("key").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.min(F.struct("doc", "content", F.col("lines")[0].alias("line"))).alias("first"))
    # stored, so that both sides of the join are read and dealt for it alone:
    # the frequent keys are broadcast if small, and else a hot key is split
    frequent = scratch.stored(counted.where(F.col("n_docs") >= min_docs).select("key", "first"), "frequent-lines")
    drops = suspects.join(frequent, "key")
    sums = [F.array_distinct(F.flatten(F.collect_list("lines"))).alias("_ld_lines")]
    if keep == "first":
        is_first = F.col("doc").eqNullSafe(F.col("first.doc")) & (F.col("content") == F.col("first.content"))
        drops = drops.withColumn("head", F.when(is_first, F.col("lines")[0])).withColumn(
            "lines", F.when(is_first, F.slice("lines", 2, 1 << 30)).otherwise(F.col("lines")))
        sums.append(F.collect_set("head").alias("_ld_heads"))        # at most the lines of a text
    dropped = drops.groupBy("doc", "content").agg(*sums)

    kept = docs.drop("n_lines", "n_dropped")
    joined = kept.withColumns({"_ld_doc": F.col(id_col).cast("long"), "_ld_content": content}).join(
        dropped.withColumnsRenamed({"doc": "_ld_doc2", "content": "_ld_content2"}),
        F.col("_ld_doc").eqNullSafe(F.col("_ld_doc2")) & (F.col("_ld_content") == F.col("_ld_content2")), "left")
    if keep == "first":
        # of equal rows (id and text) that hold first occurrences one keeps them
        holds = F.coalesce(F.size("_ld_heads") > 0, F.lit(False))
        alone = joined.withColumn("_ld_alone", F.when(~holds, F.monotonically_increasing_id()))
        copies = Window.partitionBy("_ld_alone", "_ld_doc", "_ld_content").orderBy(F.xxhash64(*kept.columns))
        joined = alone.withColumn("_ld_copy", F.row_number().over(copies)).withColumn("_ld_lines", F.when(
            holds & (F.col("_ld_copy") > 1), F.array_union("_ld_lines", "_ld_heads")).otherwise(F.col("_ld_lines")))
    all_lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)
    staying = F.array_except(F.sequence(F.lit(0), F.size("_ld_all") - 1), F.col("_ld_lines"))
    rebuilt = F.array_join(F.transform(staying, lambda i: F.get(F.col("_ld_all"), i)), "\n")
    return (joined.withColumn("_ld_all", all_lines)
            .withColumns({
                "n_lines": F.size("_ld_all").cast("long"),
                "n_dropped": F.when(F.col("_ld_lines").isNull(), 0).otherwise(F.size("_ld_lines")).cast("long"),
                text_col: F.when(F.col("_ld_lines").isNull(), F.col(text_col)).otherwise(rebuilt)})
            .select(*kept.columns, "n_lines", "n_dropped"))
