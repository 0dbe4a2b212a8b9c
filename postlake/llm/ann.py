"""Approximate nearest neighbours by inner product, with an adaptive
dimension scan of probed lists.

Equal rows (id and vector) are made one first, with one shuffle of the
vectors, and a query's candidates are counted by id. Vectors get one more coordinate, sqrt(M^2 - |x|^2) for the largest norm M,
which turns the largest inner product into the least distance, and a random
rotation. k-means centroids (fitted on a bounded sample) divide all rows
into lists; a query probes its nearest lists. In a probed list distances
grow block of columns by block: after d of D coordinates a candidate is
abandoned when its partial distance, scaled by D / d, exceeds the query's
current k-th distance by more than a factor (1 + epsilon / sqrt(d))^2, the
hypothesis test of a random rotation. Survivors get their exact inner
product on the original vectors in double precision.

How many lists a query probes is measured on the fitting sample: the least
number with which its own rows would find ``target_recall`` of their
neighbours. The sample's own nearest rows are the first candidates of every
query and give it a first k-th distance.

Lists are dealt over *groups* of bounded size (a hot list is split by row),
queries over *blocks*; one task scans one block of queries against one group
and returns at most ``k`` rows a query, so no list, however long, is one
task's work.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlake.llm import scratch

SAMPLE_ROWS = 8192             # fitting sample (k-means, probe count, first distances)
COLUMNS = 16                   # coordinates of a block
EPSILON = 2.1
GROUP_ROWS = 8192              # candidates of a task
BLOCK_ROWS = 4096              # queries of a task
MAX_LISTS = 1024


@dataclass(frozen=True)
class Index:
    """Bounded parameters of the search, the same in every task."""

    bound: float               # the largest norm
    rotation: np.ndarray       # [D + 1, D + 1]
    centroids: np.ndarray      # rotated
    probes: int
    sample: np.ndarray         # rotated sample
    sample_ids: np.ndarray
    sample_rows: np.ndarray    # the sample's original vectors
    list_groups: list          # list -> its groups (one, or several for a split list)
    blocks: int                # query blocks

    def place(self, vectors: np.ndarray) -> np.ndarray:
        """Rotated data vectors with their extra coordinate."""
        extra = np.sqrt(np.maximum(self.bound ** 2 - (vectors ** 2).sum(1), 0))
        return np.column_stack([vectors, extra]) @ self.rotation

    def place_queries(self, vectors: np.ndarray) -> np.ndarray:
        return np.column_stack([vectors, np.zeros(len(vectors))]) @ self.rotation


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a ** 2).sum(1)[:, None] + (b ** 2).sum(1)[None] - 2 * a @ b.T, 0)


def kmeans(rows: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 10) -> np.ndarray:
    centroids = rows[rng.choice(len(rows), k, replace=False)].copy()
    for _ in range(rounds):
        nearest = distances(rows, centroids).argmin(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, rows)
        counts = np.bincount(nearest, minlength=k)
        centroids[counts > 0] = sums[counts > 0] / counts[counts > 0][:, None]
    return centroids


def nearest_ids(d: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Columns of each row's k least distances to different ids (of an id its
    nearest column); fewer columns if there are fewer ids."""
    order = np.argsort(d, axis=1, kind="stable")
    distinct = np.unique(ids).size
    if distinct == ids.size:
        return order[:, :k]
    out = np.empty((len(d), min(k, distinct)), dtype=np.int64)
    for i, row in enumerate(order):
        first = np.sort(np.unique(ids[row], return_index=True)[1])
        out[i] = row[first[:k]]
    return out


def probe_count(sample: np.ndarray, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, centroids: np.ndarray,
                k: int, target: float) -> int:
    """Lists to probe so that sample rows would find ``target`` of their k nearest ids."""
    lists = distances(sample, centroids).argmin(axis=1)
    d = distances(queries, sample)
    d[ids[own][:, None] == ids[None]] = np.inf
    near = nearest_ids(d, ids, k)
    order = np.argsort(distances(queries, centroids), axis=1)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(order.shape[1])[None], axis=1)
    needed = np.sort(np.take_along_axis(rank, lists[near], axis=1).ravel())
    return int(needed[min(needed.size - 1, int(np.ceil(target * needed.size)) - 1)]) + 1


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, v array<double>)`` of the rows that take part: an id, and a
    vector that is neither null, empty nor zero and has no null or non-finite
    component. Equal rows (id and vector) are one."""
    v = F.col(vector_col).cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", bad) & F.exists("v", lambda x: x != 0)).distinct()


def build(rows: DataFrame, n_queries: int, k: int, target_recall: float, seed: int = 11) -> tuple[Index, int] | None:
    """Fit the index; None without rows. Rows whose dimension is not the most
    frequent one (ties: the smaller) take no part."""
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    kinds = rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("top"))
    kind = kinds.orderBy(F.desc("n"), "dim").first()
    if kind is None:
        return None
    dim, n = kind.dim, kind.n
    rows = rows.where(F.size("v") == dim)
    taken = rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id", "v").limit(SAMPLE_ROWS).toArrow()
    rng = np.random.default_rng(seed)
    rotation = np.linalg.qr(rng.normal(size=(dim + 1, dim + 1)))[0]
    ids = taken.column("vec_id").to_numpy()
    original = _matrix(taken.column("v").combine_chunks(), dim)
    draft = Index(float(np.sqrt(kind.top)), rotation, np.zeros(0), 0, np.zeros(0), ids, original, [], 1)
    sample = draft.place(original)
    lists = int(min(MAX_LISTS, max(1, np.sqrt(n) // 2), max(1, len(sample) // 16)))
    centroids = kmeans(sample, lists, rng)
    trial = np.arange(min(256, len(sample)))
    probes = lists
    if np.unique(ids).size > k + 1:
        probes = probe_count(sample, ids, draft.place_queries(original[trial]), trial, centroids, k, target_recall)
    # rows per list, to deal lists (or parts of a long one) over groups
    sizes = np.zeros(lists, dtype=np.int64)
    empty = Index(draft.bound, rotation, centroids, probes, sample, ids, original, [[0]] * lists, 1)
    for row in _with_lists(rows, empty, dim).groupBy("list").count().collect():
        sizes[row["list"]] = row["count"]
    groups, room, current = [], GROUP_ROWS, 0
    for size in sizes.tolist():
        own = []
        while True:
            take = min(size, room)
            own.append(current)
            size, room = size - take, room - take
            if room == 0:
                current, room = current + 1, GROUP_ROWS
            if size == 0:
                break
        groups.append(own)
    return Index(draft.bound, rotation, centroids, probes, sample, ids, original, groups,
                 max(1, -(-n_queries // BLOCK_ROWS))), dim


def _with_lists(rows: DataFrame, index: Index, dim: int) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = _matrix(batch.column("v"), dim)
                nearest = distances(shared.value.place(v), shared.value.centroids).argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest.astype(np.int32))],
                                                 names=["vec_id", "v", "list"])

    return rows.mapInArrow(run, "vec_id long, v array<double>, list int")


def _probing(queries: DataFrame, index: Index, dim: int, k: int) -> DataFrame:
    """Each query once per group that holds a list it probes, with those lists
    and the k-th distance within the sample; and once with group -1 and its
    nearest rows of the sample (ids and scores)."""
    shared = queries.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids = part.column("vec_id").to_numpy()
                placed = ix.place_queries(_matrix(part.column("v"), dim))
                probed = np.argsort(distances(placed, ix.centroids), axis=1, kind="stable")[:, :ix.probes]
                d = distances(placed, ix.sample)
                d[ids[:, None] == ix.sample_ids[None]] = np.inf
                near = nearest_ids(d, ix.sample_ids, k)
                first = np.take_along_axis(d, near, axis=1)
                kth = first[:, -1] if near.shape[1] == k else np.full(len(ids), np.inf)
                rows, groups, lists = [], [], []
                for i, own in enumerate(probed.tolist()):
                    per_group: dict[int, list[int]] = {}
                    for number in own:
                        for g in ix.list_groups[number]:
                            per_group.setdefault(g, []).append(number)
                    for g, numbers in per_group.items():
                        rows.append(i)
                        groups.append(g)
                        lists.append(numbers)
                asked = _matrix(part.column("v"), dim)
                best = [c[np.isfinite(f)] for c, f in zip(near, first)]
                scores = [(ix.sample_rows[c] * asked[i]).sum(axis=1) for i, c in enumerate(best)]
                at_rows = pa.array([*rows, *range(len(ids))], pa.int64())
                none = [None] * len(rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id").take(at_rows), part.column("v").take(at_rows),
                     pa.array([*groups, *[-1] * len(ids)], pa.int32()),
                     pa.array([*lists, *[None] * len(ids)], pa.list_(pa.int32())),
                     pa.array(kth[at_rows.to_numpy()]),
                     pa.array([*none, *[ix.sample_ids[c].tolist() for c in best]], pa.list_(pa.int64())),
                     pa.array([*none, *[x.tolist() for x in scores]], pa.list_(pa.float64()))],
                    names=["vec_id", "v", "grp", "lists", "kth", "near", "scores"])

    return queries.mapInArrow(run, "vec_id long, v array<double>, grp int, lists array<int>, kth double, "
                                   "near array<long>, scores array<double>")


class _Best:
    """The k best candidates of each query so far, one of each id."""

    def __init__(self, queries: int, k: int, kth: np.ndarray, bound: float, square: np.ndarray):
        self.k, self.kth, self.bound, self.square = k, kth.copy(), bound, square
        self.query = np.zeros(0, np.int64)
        self.id = np.zeros(0, np.int64)
        self.score = np.zeros(0)
        self.n = queries

    def add(self, query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        query = np.concatenate([self.query, query])
        ids, score = np.concatenate([self.id, ids]), np.concatenate([self.score, score])
        order = np.lexsort((-score, ids, query))         # of an id its best row
        query, ids, score = query[order], ids[order], score[order]
        best = np.ones(query.size, dtype=bool)
        best[1:] = (query[1:] != query[:-1]) | (ids[1:] != ids[:-1])
        query, ids, score = query[best], ids[best], score[best]
        order = np.lexsort((ids, -score, query))
        query = query[order]
        heads = np.searchsorted(query, np.arange(self.n + 1))
        keep = np.arange(query.size) - heads[query] < self.k
        self.query, self.id, self.score = query[keep], ids[order][keep], score[order][keep]
        full = np.flatnonzero(np.diff(heads) >= self.k)
        worst = score[order][heads[full] + self.k - 1]
        d = self.square[full] + self.bound ** 2 - 2 * worst
        self.kth[full] = np.minimum(self.kth[full], d)


def scan(queries: np.ndarray, candidates: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, candidate) pairs not abandoned: partial distances grow by column
    blocks, and a pair goes when the scaled partial distance is too large."""
    dims = queries.shape[1]
    partial = np.zeros((len(queries), len(candidates)))
    pairs = None
    for lo in range(0, dims, COLUMNS):
        hi = min(dims, lo + COLUMNS)
        a, b = queries[:, lo:hi], candidates[:, lo:hi]
        factor = (1 + EPSILON / np.sqrt(hi)) ** 2 * hi / dims if hi < dims else 1 + 1e-9
        if pairs is None:
            partial += distances(a, b)
            alive = partial <= limit[:, None] * factor + 1e-12
            if hi == dims or alive.sum() * 8 < alive.size:
                pairs = np.nonzero(alive)            # few left: only these go on
                rest = partial[pairs]
        else:
            rest = rest + ((a[pairs[0]] - b[pairs[1]]) ** 2).sum(axis=1)
            stay = rest <= limit[pairs[0]] * factor + 1e-12
            pairs, rest = (pairs[0][stay], pairs[1][stay]), rest[stay]
    return pairs


def nearest(vectors: DataFrame, queries=None, k: int = 20, target_recall: float = 0.97,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` rows of largest inner
    product found for each query row, ties to the smaller ``vec_id``.

    ``queries`` is a condition on ``vec_id`` (default: all rows). A query's
    own id is no candidate of it. Rows without an id, and null, empty, zero or
    non-finite vectors, take no part, nor do vectors of another dimension than
    the most frequent one. Rows of one id count once (the best of them as a
    candidate, any of them as a query). With fewer candidates than ``k`` all are returned; an empty
    table gives no rows. Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = scratch.stored(usable(vectors, id_col, vector_col), "vectors")
    asked = rows if queries is None else rows.where(queries)
    built = build(rows, asked.count(), k, target_recall)
    if built is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index, dim = built
    rows, asked = (x.where(F.size("v") == dim) for x in (rows, asked))
    asked = asked.dropDuplicates(["vec_id"])
    shared = spark.sparkContext.broadcast(index)
    groups = F.array(*[F.array(*map(F.lit, g)) for g in index.list_groups])
    own = F.element_at(groups, F.col("list") + 1)
    placed = _with_lists(rows, index, dim).withColumn(
        "grp", F.element_at(own, (F.pmod(F.xxhash64("vec_id", "v"), F.size(own)) + 1).cast("int")))
    placed = placed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(index.blocks - 1))))
    probing = _probing(asked, index, dim, k).withColumn(
        "block", F.pmod(F.xxhash64("vec_id"), F.lit(index.blocks)).cast("int"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        ix = shared.value
        out = {"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
               "score": pa.array([], pa.float64())}
        if not left.num_rows or not right.num_rows:
            if right.num_rows and right.column("grp")[0].as_py() < 0:   # nearest of the sample
                near = right.column("near").combine_chunks()
                sizes = np.diff(near.offsets.to_numpy())
                return pa.table({"query_id": np.repeat(right.column("vec_id").to_numpy(), sizes),
                                 "vec_id": near.flatten(),
                                 "score": right.column("scores").combine_chunks().flatten()})
            return pa.table(out)
        ids, lists = left.column("vec_id").to_numpy(), left.column("list").to_numpy()
        originals = _matrix(left.column("v").combine_chunks(), dim)
        placed_rows = ix.place(originals)
        query_ids = right.column("vec_id").to_numpy()
        query_rows = _matrix(right.column("v").combine_chunks(), dim)
        placed_queries = ix.place_queries(query_rows)
        probed = right.column("lists").combine_chunks()
        owner = np.repeat(np.arange(len(query_ids)), np.diff(probed.offsets.to_numpy()))
        numbers = probed.flatten().to_numpy()
        best = _Best(len(query_ids), k, right.column("kth").to_numpy(), ix.bound, (query_rows ** 2).sum(1))
        for number in np.unique(lists):
            members = np.flatnonzero(lists == number)
            asking = owner[numbers == number]
            if not asking.size:
                continue
            for at in range(0, asking.size, 1024):
                some = asking[at:at + 1024]
                q, c = scan(placed_queries[some], placed_rows[members], best.kth[some])
                q, c = some[q], members[c]
                other = query_ids[q] != ids[c]
                q, c = q[other], c[other]
                if q.size:
                    score = np.concatenate([
                        (query_rows[q[i:i + 65536]] * originals[c[i:i + 65536]]).sum(axis=1)
                        for i in range(0, q.size, 65536)])
                    best.add(q, ids[c], score)
        return pa.table({"query_id": query_ids[best.query], "vec_id": best.id, "score": best.score})

    found = placed.groupBy("grp", "block").cogroup(probing.groupBy("grp", "block")).applyInArrow(
        run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
