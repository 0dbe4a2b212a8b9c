"""Bottom-k sketches of shingle hashes as document fingerprints.

A text's sketch holds the ``k`` least 48-bit hashes of its distinct word
shingles (all of them if there are fewer). Sketches of parts merge into the
sketch of the whole, and two of them estimate resemblance, containment and
distinct shingle counts. As a string a sketch is the base64 of its hashes in
ascending order, six bytes each, so equal texts have equal strings.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K = 128
WORDS = 5
_BITS = 48
_LEAST = -(2**63)
_BINS_PER_PARTITION = 4


def sketch(text: str, k: int = K, words: int = WORDS) -> np.ndarray:
    """Ascending least hashes of a text's shingles of ``words`` words (A-Z
    lower-cased; fewer words are one shingle; no words give an empty sketch)."""
    import xxhash

    parts = text.encode("utf-8").lower().split()
    if not parts:
        return np.zeros(0, dtype=np.uint64)
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    width = min(words, len(parts))
    h = np.full(len(parts) - width + 1, np.uint64(width), dtype=np.uint64)
    for i in range(width):
        h = (h ^ one[i:i + h.size]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    h = (h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - _BITS)
    return np.unique(h)[:k]


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of two texts' shingles together."""
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of common shingles; exact if both sketches are whole sets.
    Two empty sketches are alike (1), an empty and another are not (0)."""
    least = merge(a, b, k)
    if not least.size:
        return 1.0
    return float(np.isin(least, np.intersect1d(a, b)).sum() / least.size)


def distinct_count(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact below ``k``."""
    return float(a.size) if a.size < k else (k - 1) * float(1 << _BITS) / float(a[k - 1] + np.uint64(1))


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of ``a``'s shingles that ``b`` has (1 if ``a`` has none)."""
    if not a.size:
        return 1.0
    r = resemblance(a, b, k)
    return min(1.0, r / (1 + r) * (1 + distinct_count(b, k) / distinct_count(a, k)))


def to_string(a: np.ndarray) -> str:
    return base64.b64encode(a.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode("ascii")


def from_string(s: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(s), np.uint8).reshape(-1, 6)
    return np.pad(raw, ((0, 0), (2, 0))).copy().view(">u8").ravel().astype(np.uint64)


def fingerprints(docs: DataFrame, k: int = K, words: int = WORDS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(doc_id, hashes array<long>, n_shingles double)`` of every row; a null
    text counts as empty. One narrow pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sketch(t.as_py() or "", k, words) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([s.astype(np.int64).tolist() for s in found], pa.list_(pa.int64())),
                 pa.array([distinct_count(s, k) for s in found])], names=["doc_id", "hashes", "n_shingles"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, hashes array<long>, n_shingles double")


def merge_groups(sketches: DataFrame, group_col: str, hashes_col: str = "hashes", k: int = K) -> DataFrame:
    """``(group, hashes)``: the merged sketch of each group's rows. Hashes are
    made distinct and cut to ``k`` per task before they move, so a group of any
    size costs its reducer ``k`` rows a task."""
    flat = sketches.select(group_col, F.explode(hashes_col).alias("h")).distinct()
    least = flat.withColumn("n", F.row_number().over(Window.partitionBy(group_col).orderBy("h"))).where(F.col("n") <= k)
    return least.groupBy(group_col).agg(F.array_sort(F.collect_list("h")).alias("hashes"))


def _bins(keys: DataFrame, n_bins: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(cuts, first key of each bin, bin that needs each bin's first row).

    Bins are ranges of the key; in descending order a bin's first row follows
    the last row of the next higher bin that has rows, and the highest bin's
    follows the lowest's. One row per bin reaches the driver."""
    at = [i / n_bins for i in range(1, n_bins)]
    cuts = keys.agg(F.percentile_approx("key", at, 10 * n_bins).alias("cuts")).first().cuts
    if not cuts:
        return None
    cuts = np.unique(np.array(cuts, dtype=np.int64))
    place = _placer(cuts, None, None)
    tops = {r.bin: r.top for r in keys.select(place("key")["bin"].alias("bin"), "key").groupBy("bin").agg(
        F.max("key").alias("top")).collect()}
    first = np.full(cuts.size + 1, _LEAST, dtype=np.int64)
    after = np.full(cuts.size + 1, -1, dtype=np.int32)
    filled = sorted(tops)
    for i, b in enumerate(filled):
        first[b] = tops[b]
        after[b] = filled[(i + 1) % len(filled)]
    return cuts, first, after


def _placer(cuts: np.ndarray, first: np.ndarray | None, after: np.ndarray | None):
    @F.pandas_udf("bin int, copy int")
    def place(key):
        import pandas as pd

        keys = key.to_numpy()
        bins = np.searchsorted(cuts, keys, side="right")
        copy = np.full(keys.size, -1) if first is None else np.where(keys == first[bins], after[bins], -1)
        return pd.DataFrame({"bin": bins.astype(np.int32), "copy": copy.astype(np.int32)})

    return place


def compare_edits(docs: DataFrame, k: int = K, words: int = WORDS, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Each text's fingerprint, and how alike it finds an edited text and the
    next document.

    Documents are in descending ``doc_id`` order (null last; equal ids by text
    hash), the first follows the last. The edited text replaces the last
    floor(n / 2) code points by the first as many (or all) of the next one's.
    Returns ``(doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next)``, one row per input row; null
    texts count as empty, a single document follows itself, other columns are
    not read, an empty table gives an empty table.

    Rows move once, by range of the id: ranges come from the ids alone, and
    the first row of each range is copied to the range before it, so every
    task holds the next document of each of its own.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(_LEAST)).alias("key"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    bins = _bins(rows.select("key"), _BINS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")))
    if bins is None:
        return spark.createDataFrame([], schema)
    place = _placer(*bins)
    placed = rows.withColumn("at", place("key")).select(
        "doc_id", "key", "text", F.xxhash64("text").alias("content"),
        F.explode(F.array_compact(F.array(
            F.struct(F.col("at.bin").alias("bin"), F.lit(False).alias("copy")),
            F.when(F.col("at.copy") >= 0, F.struct(F.col("at.copy").alias("bin"), F.lit(True).alias("copy")))))).alias("to"))
    placed = (placed.select("doc_id", "key", "text", "content", "to.bin", "to.copy").repartition("bin")
              .sortWithinPartitions("bin", "copy", F.desc("key"), "content"))

    def row(own, following) -> tuple:
        doc_id, text, mine = own
        _, next_text, theirs = following
        half = len(text) // 2
        edited = text[:len(text) - half] + next_text[:half]
        changed = mine if edited == text else sketch(edited, k, words)
        return (doc_id, len(text), hashlib.sha256(edited.encode("utf-8")).hexdigest(), to_string(mine),
                to_string(changed), resemblance(mine, changed, k), resemblance(mine, theirs, k))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        names = [f.strip().split()[0] for f in schema.split(",")]
        waiting, bin_before = None, None
        for batch in batches:
            out = []
            for doc_id, text, number, copy in zip(*(batch.column(c) for c in ("doc_id", "text", "bin", "copy"))):
                number, copy = number.as_py(), copy.as_py()
                if copy and waiting is None:
                    continue                     # a further row with the same id
                own = (doc_id.as_py(), text.as_py(), None)
                own = (*own[:2], sketch(own[1], k, words))
                if waiting is not None:
                    if number != bin_before:
                        raise RuntimeError("a range of documents lacks its next row")
                    out.append(row(waiting, own))
                waiting, bin_before = (None if copy else own), number
                if len(out) >= 500:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
        if waiting is not None:
            raise RuntimeError("a range of documents lacks its next row")

    return placed.drop("key", "content").mapInArrow(run, schema)
