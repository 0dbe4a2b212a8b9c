"""Ranked lexical search with per-term geometric blocking.

The documents are divided into segments of bounded size (some rows of one
task). Within a segment every term's posting list is clustered by document
similarity: some of its documents are centroids, and each document joins the
centroid of largest cosine similarity. A cluster is a block; stored with it is
its summary, the coordinatewise maximum of its documents' impacts. A summary
has the coordinates that the queries holding the list's term may ask for, so
its product with a query bounds every document of the block, exactly.

A query takes a segment's lists by falling largest contribution. It stops when
the lists left cannot together reach its k-th score, skips a block only if the
block's summary bound is below that score, and scores the documents of the
other blocks from the segment's forward rows. The k-th score is kept from one
segment of a task to the next. So results are exact, ties included.

The index is built for the terms of a block of queries (at most
``QUERY_TERMS`` term occurrences; that bounds what is collected and
broadcast): postings of other terms are never kept, as no query asks for them.
Segments need no shuffle, and a term of every document is one list per
segment, not one task. What is shuffled are document counts and the k best
documents of each query and task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.llm import scratch
from postlake.llm.pretokens import row_blocks

#: A term, in Java's and Python's notation; A-Z are lower-cased before.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Term occurrences of the queries that are answered together.
QUERY_TERMS = 1 << 16
#: Documents of a segment, and cells of its documents by terms.
SEGMENT_DOCS, SEGMENT_CELLS = 2048, 1 << 23
#: Documents of a block on average, and of the pool that centroids come from.
BLOCK_DOCS, POOL_DOCS = 96, 256
_SALTS = 32

_SEGMENT = T.StructType([
    T.StructField("segment", T.LongType(), False),
    T.StructField("n_docs", T.LongType(), False),        # documents with a term, kept or not
    T.StructField("n_terms", T.LongType(), False),       # all their terms
    T.StructField("doc_ids", T.ArrayType(T.LongType(), True), False),
    T.StructField("sizes", T.BinaryType(), False),       # <i8, all terms of each kept document
    T.StructField("held", T.BinaryType(), False),        # <u4, distinct query terms of each
    T.StructField("terms", T.BinaryType(), False),       # <u4, zstandard
    T.StructField("tfs", T.BinaryType(), False),         # <u4, zstandard
])
_INDEX = T.StructType([
    T.StructField("segment", T.LongType(), False),
    T.StructField("doc_ids", T.ArrayType(T.LongType(), True), False),
    *[T.StructField(c, T.BinaryType(), False) for c in (
        "held", "terms", "impacts",                      # forward rows
        "lists", "list_blocks", "block_docs", "members",  # term of each list, its blocks, their documents
        "maxima")],                                      # summaries, list after list
])


def _pack(values: np.ndarray) -> bytes:
    import zstandard

    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(data: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _term_bytes() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[0x80:] = True                                  # every byte of a code point above 0x7F
    for first, last in (b"09", b"AZ", b"az"):
        table[first:last + 1] = True
    return table


def split_terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct terms, term numbers of all occurrences, occurrences of each text)."""
    raw = texts.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], dtype=np.int64)[raw.offset:raw.offset + len(raw) + 1]
    lo, hi = int(offsets[0]), int(offsets[-1])
    data = raw.buffers()[2].slice(lo, hi - lo).to_pybytes().lower() if hi > lo else b""
    chars = np.frombuffer(data, dtype=np.uint8)
    bounds = offsets - lo
    inside = _term_bytes()[chars]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    edges = bounds[:-1][bounds[:-1] < chars.size]
    starts[edges] = inside[edges]                        # a text's first term starts with it
    at = np.flatnonzero(starts)
    kept = chars[inside]
    cuts = np.append((np.cumsum(inside) - 1)[at], kept.size).astype(np.int32)
    coded = pa.Array.from_buffers(pa.binary(), at.size, [None, pa.py_buffer(cuts), pa.py_buffer(kept.tobytes())]
                                  ).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), np.diff(np.searchsorted(at, bounds))


@dataclass(frozen=True)
class QueryBlock:
    """Some queries; bounded by ``QUERY_TERMS`` (or one longer query)."""

    keys: list[str]
    vocabulary: list[bytes]
    terms: list[np.ndarray]         # of each query: distinct term numbers, ascending
    counts: list[np.ndarray]        # and their occurrences
    columns: list[np.ndarray] = field(default_factory=list)   # of each term: terms of the queries that hold it

    @staticmethod
    def of(rows: list[tuple[str, list[str]]]) -> QueryBlock:
        vocabulary = sorted({t.encode() for _, terms in rows for t in terms})
        number = {t: i for i, t in enumerate(vocabulary)}
        found = [sorted(Counter(number[t.encode()] for t in terms).items()) for _, terms in rows]
        numbers = [np.array([t for t, _ in f], dtype=np.int64) for f in found]
        with_term: list[set] = [set() for _ in vocabulary]
        for own in numbers:
            for t in own:
                with_term[t].update(own.tolist())
        return QueryBlock([k for k, _ in rows], vocabulary, numbers,
                          [np.array([c for _, c in f], dtype=np.int64) for f in found],
                          [np.array(sorted(s), dtype=np.int64) for s in with_term])


def segments(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """Forward rows of ``docs (doc_id, text)`` over the vocabulary, packed by segment."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    room = int(max(64, min(SEGMENT_DOCS, SEGMENT_CELLS // max(1, len(vocabulary)))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        wanted = pa.array(shared.value, pa.binary())
        number = TaskContext.get().partitionId() << 32
        ids, sizes, held, terms, tfs, n_docs, n_terms = [], [], [], [], [], 0, 0

        def close():
            nonlocal number, n_docs, n_terms
            row = pa.RecordBatch.from_arrays([
                pa.array([number]), pa.array([n_docs]), pa.array([n_terms]), pa.array([ids], pa.list_(pa.int64())),
                pa.array([np.array(sizes, "<i8").tobytes()], pa.binary()),
                pa.array([np.array(held, "<u4").tobytes()], pa.binary()),
                pa.array([_pack(np.concatenate(terms) if terms else np.zeros(0, np.int64))], pa.binary()),
                pa.array([_pack(np.concatenate(tfs) if tfs else np.zeros(0, np.int64))], pa.binary())],
                names=_SEGMENT.names)
            number, n_docs, n_terms = number + 1, 0, 0
            for x in (ids, sizes, held, terms, tfs):
                x.clear()
            return row

        for batch in batches:
            for rows in row_blocks(batch):
                words, index, per_text = split_terms(rows.column("text"))
                known = pc.index_in(words, value_set=wanted).to_numpy(zero_copy_only=False)
                known = np.where(np.isnan(known.astype(float)), -1, known).astype(np.int64) if len(words) else np.zeros(0, np.int64)
                term, doc = known[index], np.repeat(np.arange(len(per_text)), per_text)
                codes, times = np.unique(doc[term >= 0] * max(1, len(wanted)) + term[term >= 0], return_counts=True)
                owner, code = codes // max(1, len(wanted)), codes % max(1, len(wanted))
                at = np.searchsorted(owner, np.arange(len(per_text) + 1))
                for i, doc_id in enumerate(rows.column("doc_id").to_pylist()):
                    n_docs, n_terms = n_docs + int(per_text[i] > 0), n_terms + int(per_text[i])
                    if at[i] < at[i + 1]:
                        ids.append(doc_id)
                        sizes.append(int(per_text[i]))
                        held.append(int(at[i + 1] - at[i]))
                        terms.append(code[at[i]:at[i + 1]])
                        tfs.append(times[at[i]:at[i + 1]])
                        if len(ids) >= room:
                            yield close()
        if n_docs:
            yield close()

    return docs.mapInArrow(run, _SEGMENT)


@dataclass(frozen=True)
class Statistics:
    n_docs: int
    n_terms: int
    weights: np.ndarray             # of each vocabulary term


def statistics(stored: DataFrame, n_vocabulary: int) -> Statistics:
    """Counts over all documents: at most vocabulary + 2 numbers come back."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(n_vocabulary + 2, dtype=np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                sums[:n_vocabulary] += np.bincount(_unpack(row["terms"]), minlength=n_vocabulary)
                sums[-2:] += row["n_docs"], row["n_terms"]
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(sums[at])], names=["term", "n"])

    sums = np.zeros(n_vocabulary + 2, dtype=np.int64)
    for r in stored.select("n_docs", "n_terms", "terms").mapInArrow(run, "term int, n long").groupBy("term").agg(
            F.sum("n").alias("n")).collect():
        sums[r.term] = r.n
    n = int(sums[-2])
    weights = np.floor(1000 * np.log((2 * n + 2) / (2 * sums[:n_vocabulary] + 1))).astype(np.int64)
    return Statistics(n, int(sums[-1]), weights)


def impacts(tfs: np.ndarray, sizes: list[int], held: np.ndarray, known: Statistics) -> np.ndarray:
    """``(10^9 tf) div (1000 tf + 8 m)`` of each posting, without the weight."""
    m = np.array([25 + 75 * n * known.n_docs // known.n_terms for n in sizes], dtype=np.int64)
    return 1_000_000_000 * tfs // (1000 * tfs + 8 * np.repeat(m, held))


def dense(held: np.ndarray, terms: np.ndarray, values: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((held.size, width), dtype=np.uint32)
    out[np.repeat(np.arange(held.size), held), terms] = values
    return out


def cluster_lists(x: np.ndarray, weights: np.ndarray, seed: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """``(term, blocks)`` of each posting list: document rows of each block."""
    n = len(x)
    pool = np.sort(np.random.default_rng(seed).permutation(n)[:POOL_DOCS])
    v = x.astype(np.float32) * weights.astype(np.float32)
    v /= np.maximum(np.sqrt((v * v).sum(axis=1, keepdims=True)), 1e-9)
    near = v @ v[pool].T                                 # [document, pool]
    del v
    in_pool = np.full(n, -1)
    in_pool[pool] = np.arange(pool.size)
    row, term = np.nonzero(x.T)[::-1]                    # by term, then document
    at = np.searchsorted(term, np.arange(x.shape[1] + 1))
    for t in np.flatnonzero(np.diff(at)):
        members = row[at[t]:at[t + 1]]
        centroids = in_pool[members]
        centroids = centroids[centroids >= 0][:-(-members.size // BLOCK_DOCS)]
        if centroids.size < 2:
            yield int(t), [members]
            continue
        nearest = near[np.ix_(members, centroids)].argmax(axis=1)
        order = np.argsort(nearest, kind="stable")
        yield int(t), np.split(members[order], np.flatnonzero(np.diff(nearest[order])) + 1)


def build_index(stored: DataFrame, known: Statistics, block: QueryBlock) -> DataFrame:
    """The blocked lists and summaries of every segment, and its forward impacts."""
    shared = stored.sparkSession.sparkContext.broadcast((known, block.columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, columns = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                held = np.frombuffer(row["held"], "<u4").astype(np.int64)
                terms = _unpack(row["terms"])
                impact = impacts(_unpack(row["tfs"]), np.frombuffer(row["sizes"], "<i8").tolist(), held, known)
                x = dense(held, terms, impact, len(columns))
                lists, list_blocks, block_docs, members, maxima = [], [], [], [], []
                for t, blocks in cluster_lists(x, known.weights, row["segment"] % (1 << 31)) if held.size else ():
                    lists.append(t)
                    list_blocks.append(len(blocks))
                    sizes = [b.size for b in blocks]
                    block_docs += sizes
                    inside = np.concatenate(blocks)
                    members.append(inside)
                    maxima.append(np.maximum.reduceat(
                        x[np.ix_(inside, columns[t])], np.concatenate(([0], np.cumsum(sizes)[:-1])), axis=0).ravel())
                flat = lambda a: np.concatenate(a) if a else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["segment"]]), pa.array([row["doc_ids"]], pa.list_(pa.int64())),
                    *[pa.array([_pack(np.asarray(a))], pa.binary()) for a in (
                        held, terms, impact, np.array(lists, np.int64), np.array(list_blocks, np.int64),
                        np.array(block_docs, np.int64), flat(members), flat(maxima))]], names=_INDEX.names)

    return stored.select(*[c for c in _SEGMENT.names if c not in ("n_docs", "n_terms")]).mapInArrow(run, _INDEX)


@dataclass
class Best:
    """The k best documents of one query so far, best first."""

    k: int
    score: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    doc: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    null: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))

    @property
    def threshold(self) -> int:
        """A document below this score is not among the best."""
        return int(self.score[-1]) if self.score.size == self.k else 1

    def add(self, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        good = score >= self.threshold
        score = np.concatenate([self.score, score[good]])
        doc, null = np.concatenate([self.doc, doc[good]]), np.concatenate([self.null, null[good]])
        order = np.lexsort((doc, ~null, -score))[:self.k]      # null ids first among equals
        self.score, self.doc, self.null = score[order], doc[order], null[order]


class Segment:
    """One row of the index, opened for searching."""

    def __init__(self, row: dict, columns: list[np.ndarray]):
        self.columns = columns
        ids = row["doc_ids"]
        self.null = np.array([i is None for i in ids], dtype=bool)
        self.ids = np.array([0 if i is None else i for i in ids], dtype=np.int64)
        held = _unpack(row["held"])
        self.x = dense(held, _unpack(row["terms"]), _unpack(row["impacts"]), len(columns))
        lists, list_blocks = _unpack(row["lists"]), _unpack(row["list_blocks"])
        block_docs, self.members = _unpack(row["block_docs"]), _unpack(row["members"])
        maxima = _unpack(row["maxima"])
        self.top = self.x.max(axis=0).astype(np.int64) if len(self.x) else np.zeros(len(columns), np.int64)
        self.block_at = np.concatenate(([0], np.cumsum(block_docs)))
        first = np.concatenate(([0], np.cumsum(list_blocks)))
        width = np.array([columns[t].size for t in lists], dtype=np.int64)
        cells = np.concatenate(([0], np.cumsum(list_blocks * width)))
        self.lists = {int(t): (int(first[i]), maxima[cells[i]:cells[i + 1]].reshape(-1, int(width[i])))
                      for i, t in enumerate(lists)}

    def search(self, terms: np.ndarray, weights: np.ndarray, best: Best) -> tuple[int, int, int]:
        """Add the segment's documents to ``best``; returns how many blocks of
        the query's lists there are, were opened, and the documents scored."""
        there = self.top[terms] * weights
        order = np.argsort(-there, kind="stable")
        order = order[there[order] > 0]
        left = np.cumsum(there[order][::-1])[::-1]           # what the lists from here on can give
        seen = np.zeros(len(self.x), dtype=bool)
        total, opened = sum(len(self.lists[int(terms[i])][1]) for i in order), 0
        for j, i in enumerate(order):
            if left[j] < best.threshold:
                break
            t = int(terms[i])
            first, maxima = self.lists[t]
            bound = maxima[:, np.searchsorted(self.columns[t], terms)] @ weights
            chosen = np.flatnonzero(bound >= best.threshold)
            chosen = chosen[np.argsort(-bound[chosen], kind="stable")]
            opened += chosen.size
            if not chosen.size:
                continue
            docs = np.concatenate([self.members[self.block_at[first + b]:self.block_at[first + b + 1]] for b in chosen])
            docs = docs[~seen[docs]]
            seen[docs] = True
            if docs.size:
                best.add(self.x[np.ix_(docs, terms)].astype(np.int64) @ weights, self.ids[docs], self.null[docs])
        return total, opened, int(seen.sum())


def search_index(index: DataFrame, known: Statistics, block: QueryBlock, k: int) -> DataFrame:
    """``(query, doc_id, score)``: the k best documents of each query and task."""
    shared = index.sparkSession.sparkContext.broadcast((known.weights, block))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, queries = shared.value
        asked = [weights[t] * c for t, c in zip(queries.terms, queries.counts)]
        best = [Best(k) for _ in queries.keys]
        for batch in batches:
            for i in range(batch.num_rows):
                (row,) = batch.slice(i, 1).to_pylist()
                segment = Segment(row, queries.columns)
                for q, own in enumerate(best):
                    segment.search(queries.terms[q], asked[q], own)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(np.arange(len(best)), [b.score.size for b in best]), pa.int64()),
            pa.array(np.concatenate([np.zeros(0, np.int64), *[b.doc for b in best]]),
                     mask=np.concatenate([np.zeros(0, bool), *[b.null for b in best]])),
            pa.array(np.concatenate([np.zeros(0, np.int64), *[b.score for b in best]]))],
            names=["query", "doc_id", "score"])

    return index.mapInArrow(run, "query long, doc_id long, score long")


def search(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           query_id_col: str = "item_id", query_text_col: str = "text") -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` documents of highest score
    above 0 for each row of ``queries``, equal scores by ascending ``doc_id``
    (null first).

    Terms are runs of digits, letters and code points above 0x7F, A-Z
    lower-cased. N is the number of documents with a term, L of all their
    terms, n of a document's; a term in df documents weighs
    ``floor(1000 ln((2N+2)/(2df+1)))``; with ``m = 25 + (75 n N) div L`` a
    document scores the sum over the query's terms, repeats included, of
    ``weight * ((10^9 tf) div (1000 tf + 8 m))``.

    A null text has no terms; a query without terms, or with terms that no
    document holds, has no result. Repeated documents are documents each,
    repeated queries are answered each. Whole texts are read, other columns
    are not; empty tables give an empty table.
    """
    spark = docs.sparkSession
    lowered = F.translate(F.col(query_text_col).cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    asked = queries.select(F.col(query_id_col).alias("item_id"),
                           F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0)).alias("terms")).where(F.size("terms") > 0)
    asked = scratch.stored(asked.withColumn("key", F.sha2(F.concat_ws(" ", "terms"), 256)), "lexical-queries")
    texts = asked.groupBy("key").agg(F.first("terms").alias("terms"))    # equal queries are searched once
    total = texts.agg(F.sum(F.size("terms"))).first()[0] or 0
    parts = max(1, -(-total // QUERY_TERMS))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = []
    for part in range(parts):                            # queries in blocks of bounded size
        block = QueryBlock.of(sorted((r.key, list(r.terms)) for r in texts.where(
            F.pmod(F.xxhash64("key"), F.lit(parts)) == part).collect()))
        forward = scratch.stored(segments(rows, block.vocabulary), "lexical-segments")
        known = statistics(forward, len(block.vocabulary))
        index = scratch.stored(build_index(forward, known, block), "lexical-index")
        keys = spark.createDataFrame(list(enumerate(block.keys)), "query long, key string")
        found.append(scratch.stored(_best_of(search_index(index, known, block, k), k).join(keys, "query"), "lexical-best"))
    best = found[0]
    for more in found[1:]:
        best = best.unionByName(more)
    return asked.select("item_id", "key").join(best, "key").select("item_id", "rank", "doc_id", "score")


def _best_of(found: DataFrame, k: int) -> DataFrame:
    """Ranks over all tasks, cut twice so that no query's rows meet before they are few."""
    order = [F.desc("score"), F.asc_nulls_first("doc_id")]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(_SALTS)))
    few = salted.withColumn("n", F.row_number().over(Window.partitionBy("query", "salt").orderBy(*order))).where(
        F.col("n") <= k)
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(
        F.col("rank") <= k).select("query", "rank", "doc_id", "score")
