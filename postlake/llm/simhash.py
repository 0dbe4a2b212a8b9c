"""SimHash fingerprints and the groups they link.

Fingerprints that differ in at most ``radius`` bits agree on at least one of
``radius + 1`` bit bands, so distinct fingerprints meet by band value. The
rows of a band value form tiles (a value with many rows is dealt over
several, each pair of them a task's work); inside, rows are ordered by
population count and compared tile by tile with exclusive-or and bit counts,
skipping tile pairs whose counts differ by more than the radius. The
comparison is exact: every linked pair is found. A tile sends a spanning
forest of its links, at most one edge per row, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.llm import scratch
from postlake.llm.components import components

SEED = 42
_PIECE = 1 << 15               # shingle hashes whose bits are counted at once
_SMALL = 32                    # groups up to this size are compared by row offset
_TILE = 512                    # rows of a tile of a larger group
_SPLIT = 1 << 13               # rows of a band value dealt to one task's tile pair


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 (seed 42) of each space-joined run of ``words`` words."""
    import xxhash

    digest = partial(xxhash.xxh64_intdigest, seed=SEED)
    parts = text.encode("utf-8").lower().split()
    if not parts:
        return np.zeros(0, dtype=np.uint64)
    if len(parts) <= words:
        return np.array([digest(b" ".join(parts))], dtype=np.uint64)
    runs = zip(*(parts[i:] for i in range(words)))
    return np.fromiter(map(digest, map(b" ".join, runs)), np.uint64, len(parts) - words + 1)


def fingerprint(text: str | None, words: int = 3) -> int:
    """The 64-bit SimHash of a text; zero without words."""
    hashes = shingle_hashes(text or "", words)
    if not hashes.size:
        return 0
    counts = np.zeros(64, dtype=np.int64)
    for k in range(0, hashes.size, _PIECE):
        piece = hashes[k:k + _PIECE].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(piece, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    bits = np.packbits(counts * 2 > hashes.size, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, content, fp)`` of every row: ``content`` is a hash of the
    text, ``fp`` the fingerprint as a signed 64-bit integer."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("content", T.LongType(), False),
                           T.StructField("fp", T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter((fingerprint(t.as_py(), words) for t in batch.column("text")),
                                 np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("content"), pa.array(prints.view(np.int64))],
                names=schema.names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("content"),
                       F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, schema)


class _Forest:
    """Least-label union of row numbers."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while a.size:
            x, y = label[a], label[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label[:] = up


def link_group(prints: np.ndarray, side: np.ndarray, radius: int, forest: _Forest, base: int) -> None:
    """Union all linked rows of one group, ordered by population count.

    ``side`` is 0 where all pairs count; a group of two parts has 1 and 2
    there and only pairs across them count."""
    counts = np.bitwise_count(prints).astype(np.int16)
    for i in range(0, prints.size, _TILE):
        a, ca, sa = prints[i:i + _TILE], counts[i:i + _TILE], side[i:i + _TILE]
        for j in range(i, prints.size, _TILE):
            if int(counts[j]) - int(ca[-1]) > radius:
                break                            # later tiles differ by more still
            b, sb = prints[j:j + _TILE], side[j:j + _TILE]
            near = np.bitwise_count(a[:, None] ^ b[None, :]) <= radius
            if sa[0] or sa[-1]:
                near &= sa[:, None] != sb[None, :]
            x, y = np.nonzero(near)
            forest.join(base + i + x, base + j + y)


def _tile_links(radius: int):
    key = ("band", "value", "low", "high")

    def link(rows: dict[str, np.ndarray]) -> pa.RecordBatch | None:
        prints, side = rows["fp"].view(np.uint64), rows["side"]
        n = prints.size
        new = np.ones(n, dtype=bool)
        new[1:] = np.any([rows[k][1:] != rows[k][:-1] for k in key], axis=0)
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], n)
        forest = _Forest(n)
        last = np.repeat(ends, ends - starts)    # end of each row's group
        small = np.repeat(ends - starts <= _SMALL, ends - starts)
        counts = np.bitwise_count(prints).astype(np.int16)
        at = np.flatnonzero(small)
        for gap in range(1, _SMALL):
            at = at[at + gap < last[at]]
            at = at[counts[at + gap] - counts[at] <= radius]
            if not at.size:
                break
            near = np.bitwise_count(prints[at] ^ prints[at + gap]) <= radius
            near &= (side[at] == 0) | (side[at] != side[at + gap])
            forest.join(at[near], at[near] + gap)
        for k in np.flatnonzero(ends - starts > _SMALL):
            s, e = int(starts[k]), int(ends[k])
            link_group(prints[s:e], side[s:e], radius, forest, s)
        moved = np.flatnonzero(forest.label != np.arange(n))
        if not moved.size:
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array(rows["fp"][moved]), pa.array(rows["fp"][forest.label[moved]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {c: batch.column(c).to_numpy() for c in batch.schema.names}
            if held is not None:
                rows = {c: np.concatenate([held[c], rows[c]]) for c in rows}
            # the last group may go on in the next batch
            cut = rows["fp"].size
            differs = np.any([rows[k] != rows[k][-1] for k in key], axis=0)
            cut = int(np.flatnonzero(differs)[-1]) + 1 if differs.any() else 0
            held = {c: v[cut:] for c, v in rows.items()}
            if cut:
                out = link({c: v[:cut] for c, v in rows.items()})
                if out is not None:
                    yield out
        if held is not None and held["fp"].size:
            out = link(held)
            if out is not None:
                yield out

    return run


def links(distinct: DataFrame, radius: int, split: int = _SPLIT) -> DataFrame:
    """Edges ``(a, b)`` that connect exactly the distinct fingerprints ``fp``
    linked directly or through others (a forest per tile of each band value)."""
    bands = radius + 1
    edges = [64 * i // bands for i in range(bands + 1)]
    cut = [F.struct(F.lit(i).alias("band"),
                    F.shiftrightunsigned("fp", edges[i]).bitwiseAND((1 << (edges[i + 1] - edges[i])) - 1)
                    .alias("value")) if bands > 1 else F.struct(F.lit(0).alias("band"), F.col("fp").alias("value"))
           for i in range(bands)]
    banded = distinct.select("fp", F.inline(F.array(*cut)))
    sizes = banded.groupBy("band", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        "band", "value", F.ceil(F.col("n") / split).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("fp", "band"), F.col("parts")).cast("int")
    tiles = (banded.join(sizes, ["band", "value"])
             .withColumn("part", part)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("fp", "band", F.col("value").cast("long").alias("value"),
                     F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
                     F.when(F.col("part") == F.col("other"), 0).when(F.col("part") < F.col("other"), 1)
                     .otherwise(2).alias("side"), F.bit_count("fp").alias("ones")))
    key = ["band", "value", "low", "high"]
    return (tiles.repartition(*key).sortWithinPartitions(*key, "ones", "fp")
            .drop("ones").mapInArrow(_tile_links(radius), "a long, b long"))


def _roots(prints: DataFrame, radius: int) -> DataFrame:
    """``(fp, root)`` for every fingerprint linked to another."""
    distinct = prints.select("fp").distinct()
    return components(links(distinct, radius)).withColumnsRenamed({"node": "fp"})


def simhash_groups(docs: DataFrame, words: int = 3, radius: int = 3,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per input row.

    A-Z are lower-cased, words are runs without white space, shingles are
    ``words`` words (the whole sequence if there are fewer); a null or
    wordless text has fingerprint zero and links like any other. The
    component id is the least ``doc_id`` reachable over links of at most
    ``radius`` differing bits (null only if all of them are null). Repeated
    rows and ids each keep their row; other columns are not read.
    """
    prints = scratch.stored(fingerprints(docs, words, id_col, text_col), "fingerprints")
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    linked = scratch.stored(_roots(prints, radius), "roots")
    by_root = linked.join(least, "fp").groupBy("root").agg(F.min("least").alias("group_least"))
    # stored, so that the fingerprint of many exact copies can be split in the join
    groups = scratch.stored(least.join(linked.join(by_root, "root"), "fp", "left").select(
        "fp", F.coalesce("group_least", "least").alias("component_id")), "groups")
    return prints.join(groups, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_dedup(docs: DataFrame, words: int = 3, radius: int = 3,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group: the least ``doc_id`` (null last), then the
    least text hash; of rows equal in both, one. All columns are kept."""
    prints = scratch.stored(fingerprints(docs, words, id_col, text_col), "fingerprints")
    linked = scratch.stored(_roots(prints, radius), "roots")
    grouped = prints.join(linked, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    first = grouped.groupBy("root").agg(
        F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "content")).alias("first"))
    names = ["_nd_a", "_nd_b"]
    keys = [F.xxhash64("doc_id", "content"), F.hash("content", "doc_id")]
    stay = first.select(F.col("first.doc_id").alias("doc_id"), F.col("first.content").alias("content")).select(
        *(k.alias(n) for k, n in zip(keys, names)))
    own_id, own_content = F.col(id_col).cast("long"), F.xxhash64(F.col(text_col))
    marked = docs.withColumns({names[0]: F.xxhash64(own_id, own_content), names[1]: F.hash(own_content, own_id)})
    order = Window.partitionBy(*names).orderBy(*[c for c, kind in docs.dtypes
                                                 if kind in ("string", "bigint", "int", "double", "boolean")
                                                 and c != text_col] or [F.lit(1)])
    return (marked.join(stay, names, "left_semi").withColumn("_nd_row", F.row_number().over(order))
            .where("_nd_row = 1").select(*docs.columns))
