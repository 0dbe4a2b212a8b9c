"""Binary output of token ids: bit- or byte-plane shuffled, zstd-compressed.

The id stream of all documents, in ascending ``doc_id`` order, is cut into
shards of whole documents. A shard image holds fixed-size blocks of ids;
each block is transposed into planes (the k-th byte, or k-th bit, of every
id), each plane is compressed on its own (an all-zero plane takes no bytes),
and a chunk index says where each plane of each block lies:

    magic 'TIDP' | version u16 | planes u16 | block_ids u32 | n_ids u64 | n_blocks u32
    index: n_blocks x planes x (offset u64, size u32)     (offsets in the image)
    plane payloads

All numbers are little-endian. ``planes`` is 4 (bytes) or 32 (bits).
Shard images are stored through Spark's own writer (a Parquet folder with
the image as a binary column), so output is committed once per task,
whatever store the path names and whichever executors are lost.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.llm.pretokens import row_blocks
from postlake.llm.token_ids import library_encoder

MAGIC, VERSION = b"TIDP", 1
_HEAD = struct.Struct("<4sHHIQI")
_CHUNK = np.dtype([("offset", "<u8"), ("size", "<u4")])
BLOCK_IDS = 1 << 16
SHARD_IDS = 1 << 20
ZSTD_LEVEL = 3

SHARD_SCHEMA = T.StructType([
    T.StructField("part", T.IntegerType(), False),       # range partition, ascending doc_id
    T.StructField("seq", T.IntegerType(), False),        # shard within the part
    T.StructField("ids_before", T.LongType(), False),    # ids of the part's earlier shards
    T.StructField("n_ids", T.LongType(), False),
    T.StructField("doc_ids", T.ArrayType(T.LongType(), True), False),
    T.StructField("doc_sizes", T.ArrayType(T.LongType(), False), False),
    T.StructField("image", T.BinaryType(), False),
])

READ_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("start", T.LongType(), False),
    T.StructField("n_tokens", T.LongType(), False),
    T.StructField("ids", T.BinaryType(), False),          # unsigned 32-bit, little-endian
])


def pack_image(ids: np.ndarray, planes: int = 4, block_ids: int = BLOCK_IDS) -> bytes:
    """One shard image of an id array."""
    import zstandard

    if planes not in (4, 32):
        raise ValueError("planes must be 4 (bytes) or 32 (bits)")
    compress = zstandard.ZstdCompressor(level=ZSTD_LEVEL).compress
    ids = np.ascontiguousarray(ids, dtype="<u4")
    n_blocks = -(-ids.size // block_ids)
    index = np.zeros((n_blocks, planes), dtype=_CHUNK)
    at = _HEAD.size + index.nbytes
    payload = []
    for b in range(n_blocks):
        cells = ids[b * block_ids:(b + 1) * block_ids].view(np.uint8).reshape(-1, 4)
        if planes == 32:
            bits = np.unpackbits(cells, axis=1, bitorder="little")
            rows = np.packbits(bits.T, axis=1, bitorder="little")
        else:
            rows = np.ascontiguousarray(cells.T)
        for p in range(planes):
            data = compress(rows[p].tobytes()) if rows[p].any() else b""
            index[b, p] = (at, len(data))
            at += len(data)
            payload.append(data)
    head = _HEAD.pack(MAGIC, VERSION, planes, block_ids, ids.size, n_blocks)
    return b"".join([head, index.tobytes(), *payload])


def unpack_image(image: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids ``first`` to ``last`` of an image, reading only the blocks they lie in."""
    import zstandard

    magic, version, planes, block_ids, n_ids, n_blocks = _HEAD.unpack_from(image)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a token-id image of this version")
    last = n_ids if last is None else min(last, n_ids)
    if first >= last:
        return np.zeros(0, dtype="<u4")
    index = np.frombuffer(image, _CHUNK, n_blocks * planes, _HEAD.size).reshape(n_blocks, planes)
    expand = zstandard.ZstdDecompressor().decompress
    blocks = range(first // block_ids, (last - 1) // block_ids + 1)
    out = []
    for b in blocks:
        size = min(block_ids, n_ids - b * block_ids)
        width = size if planes == 4 else -(-size // 8)
        rows = np.zeros((planes, width), dtype=np.uint8)
        for p in range(planes):
            offset, length = int(index[b, p]["offset"]), int(index[b, p]["size"])
            if length:
                rows[p] = np.frombuffer(expand(image[offset:offset + length], max_output_size=width), np.uint8)
        if planes == 32:
            bits = np.unpackbits(rows, axis=1, bitorder="little")[:, :size]
            cells = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
        else:
            cells = np.ascontiguousarray(rows.T)
        out.append(cells.reshape(-1).view("<u4"))
    base = blocks[0] * block_ids
    return np.concatenate(out)[first - base:last - base]


def write_ids(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, planes: int = 4,
              block_ids: int = BLOCK_IDS, shard_ids: int = SHARD_IDS,
              id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text and write the shards to ``path``.

    Each document's ids end with ``end_id``; a null or empty text is the end
    id alone. Null ``doc_id``s come first; rows of one ``doc_id`` follow by
    text. Rows are range-partitioned by ``doc_id`` (one shuffle of the texts)
    and a task keeps one shard in memory. Other columns are not read. An
    empty table writes no shard.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(tokenizer_path, added_tokens=True)
        part = TaskContext.get().partitionId()
        before = seq = 0
        names: list = []
        held: list[np.ndarray] = []
        total = 0

        def shard():
            ids = np.concatenate(held)
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([seq], pa.int32()),
                pa.array([before], pa.int64()), pa.array([ids.size], pa.int64()),
                pa.array([names], pa.list_(pa.int64())),
                pa.array([[x.size for x in held]], pa.list_(pa.int64())),
                pa.array([pack_image(ids, planes, block_ids)], pa.binary()),
            ], names=SHARD_SCHEMA.names)

        for batch in batches:
            for rows in row_blocks(batch):
                ids, bounds = encoder.encode_texts(rows.column("text"))
                for i, doc_id in enumerate(rows.column("doc_id").to_pylist()):
                    size = int(bounds[i + 1] - bounds[i]) + 1
                    if held and total + size > shard_ids:
                        yield shard()
                        before, seq, names, held, total = before + total, seq + 1, [], [], 0
                    names.append(doc_id)
                    held.append(np.append(ids[bounds[i]:bounds[i + 1]], end_id).astype("<u4"))
                    total += size
        if held:
            yield shard()

    ordered = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
               .repartitionByRange(F.col("doc_id").asc_nulls_first())
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()))
    ordered.mapInArrow(run, SHARD_SCHEMA).write.parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of every document of the files.

    ``start`` counts the ids of all documents before it: the shard's place in
    its part, plus the totals of earlier parts (one row per part)."""
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    totals = shards.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    earlier = totals.select(
        "part", (F.sum("part_ids").over(Window.orderBy("part")) - F.col("part_ids")).alias("base"))
    # one row per range partition, a number the session sets: small enough to
    # broadcast, so the images themselves are not shuffled
    placed = shards.join(F.broadcast(earlier), "part").select(
        (F.col("base") + F.col("ids_before")).alias("base"), "doc_ids", "doc_sizes", "image")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                base = row.column("base")[0].as_py()
                sizes = np.asarray(row.column("doc_sizes").flatten(), dtype=np.int64)
                ends = np.cumsum(sizes)
                ids = unpack_image(row.column("image")[0].as_py())
                data = pa.Array.from_buffers(
                    pa.large_binary(), sizes.size,
                    [None, pa.py_buffer(np.concatenate(([0], ends * 4)).astype(np.int64)),
                     pa.py_buffer(ids.tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [row.column("doc_ids").flatten(), pa.array(base + ends - sizes), pa.array(sizes), data],
                    names=READ_SCHEMA.names)

    return placed.mapInArrow(run, READ_SCHEMA)
