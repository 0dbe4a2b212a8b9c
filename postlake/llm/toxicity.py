"""Toxicity by multiple-instance learning over sentences.

Only documents are labelled; what makes a document toxic is some sentence of
it. A sentence's probability is logistic in its words, and a document's is the
noisy-or of its sentences,

    P(toxic) = 1 - prod(1 - p(sentence)),

so the likelihood of the document labels trains the sentence scores, and the
sentences of large probability are where a document offends. A word counts
with the sum of its hashed parts: the whole word and some of its beginnings and
endings, so inflected and unseen forms share weights.

Training takes a bounded sample (``docs_per_label`` documents of each label,
by least hash, texts up to ``MAX_TRAIN_BYTES``); where a label has more, its
documents weigh more. The sample is dealt over shards of about ``SHARD_DOCS``
documents by hash. Weights start from each part's smoothed log-odds between
toxic and clean sample documents, if positive. In each round Spark runs some epochs of AdaGrad on every
shard from the same weights, and the driver averages what the shards changed,
per weight over the shards that touched it: vectors of ``2 ** HASH_BITS``
numbers, whatever the corpus. Prediction is one narrow pass over whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.llm import scratch
from postlake.llm.pretokens import ragged, row_blocks

HASH_BITS = 18
#: Parts of a word besides the whole: bytes, with its boundary, at the start or (true) the end.
AFFIXES = ((4, False), (5, False), (6, False), (7, False), (5, True))
DOCS_PER_LABEL = 8192
MAX_TRAIN_BYTES = 1 << 20
SHARD_DOCS = 2048
ROUNDS, EPOCHS, BATCH_DOCS = 3, 3, 32
RATE, FIRST_SUM, DECAY, FIRST_BIAS = 0.3, 1.0, 1e-4, -6.0
#: Documents by which a part's log-odds are smoothed, and their share in its first weight.
SMOOTHING, FIRST_SHARE = 10.0, 0.5
#: Sentences of at least this probability are reported as offending.
OFFENDING = 0.5
_FIRST, _LAST = 1, 2                   # stand for a word's two boundaries


@dataclass(frozen=True)
class Model:
    weights: np.ndarray                # [2 ** HASH_BITS], float64
    bias: float


@dataclass
class Sentences:
    """Words of some texts, by sentence. A text without words is one empty
    sentence; sentences without words are none otherwise."""

    words: pa.Array                    # distinct, lower case
    index: np.ndarray                  # word number of each occurrence
    sentence: np.ndarray               # its sentence, ascending
    doc: np.ndarray                    # text of each sentence, ascending
    span: np.ndarray                   # [sentence, 2]: bytes from its first word to its last, within its text


def _byte_tables() -> tuple[np.ndarray, np.ndarray]:
    word, stop = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
    word[0x80:] = True                 # every byte of a code point above 0x7F
    for first, last in (b"09", b"AZ", b"az"):
        word[first:last + 1] = True
    stop[list(b".!?\n\r")] = True
    return word, stop


def split_sentences(texts: pa.Array) -> Sentences:
    """Words are runs of letters, digits and code points above 0x7F (A-Z
    lower-cased); sentences end at ``. ! ?`` and line ends."""
    raw = texts.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], dtype=np.int64)[raw.offset:raw.offset + len(raw) + 1]
    lo, hi = int(offsets[0]), int(offsets[-1])
    data = raw.buffers()[2].slice(lo, hi - lo).to_pybytes().lower() if hi > lo else b""
    chars, bounds = np.frombuffer(data, dtype=np.uint8), offsets - lo
    word, stop = _byte_tables()
    inside = word[chars]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    edges = bounds[:-1][bounds[:-1] < chars.size]
    starts[edges] = inside[edges]      # a text's first word starts with it
    at = np.flatnonzero(starts)
    kept = chars[inside]
    before = np.concatenate(([0], np.cumsum(inside)))
    cuts = np.append(before[at], kept.size).astype(np.int32)
    coded = pa.Array.from_buffers(pa.binary(), at.size, [None, pa.py_buffer(cuts), pa.py_buffer(kept.tobytes())]
                                  ).dictionary_encode()
    doc = np.searchsorted(bounds, at, side="right") - 1
    mark = np.cumsum(stop[chars])[at] + doc if at.size else np.zeros(0, np.int64)
    first = np.flatnonzero(np.diff(mark, prepend=-1))
    last = np.append(first[1:], at.size) - 1 if first.size else first
    ends = at + np.diff(cuts)
    owner = doc[first]
    span = np.column_stack([at[first] - bounds[owner], ends[last] - bounds[owner]]) if first.size else np.zeros((0, 2), np.int64)
    bare = np.setdiff1d(np.arange(len(texts)), owner)
    order = np.argsort(np.concatenate([owner, bare]), kind="stable")
    place = np.empty(order.size, dtype=np.int64)
    place[order] = np.arange(order.size)
    number = np.cumsum(np.isin(np.arange(at.size), first)) - 1
    return Sentences(coded.dictionary, coded.indices.to_numpy().astype(np.int64), place[number] if at.size else number,
                     np.concatenate([owner, bare])[order], np.concatenate([span, np.zeros((bare.size, 2), np.int64)])[order])


def word_parts(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashed parts of distinct words, where each word's begin)."""
    n = len(words)
    raw = words.cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], dtype=np.int64)[raw.offset:raw.offset + n + 1]
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[int(offsets[0]):int(offsets[-1])] if n else np.zeros(0, np.uint8)
    sizes = np.diff(offsets) + 2
    ends = np.cumsum(sizes)
    starts = ends - sizes
    x = np.full(int(ends[-1]) if n else 0, _LAST, dtype=np.uint64)
    x[starts] = _FIRST
    x[np.arange(data.size) + np.repeat(2 * np.arange(n) + 1, sizes - 2)] = data
    found, owners = [], []
    for kind, (size, from_end) in enumerate(AFFIXES):
        own = np.flatnonzero(sizes > size)               # shorter words have their whole form
        at = ends[own] - size if from_end else starts[own]
        h = np.full(own.size, kind + 1, dtype=np.uint64)
        for k in range(size):
            h = (h ^ x[at + k]) * np.uint64(0x100000001B3)
        found.append(h)
        owners.append(own)
    place = np.arange(x.size, dtype=np.uint64) - np.repeat(starts, sizes).astype(np.uint64)
    found.append(np.add.reduceat((x + np.uint64(7)) * (place * place + np.uint64(3)) * np.uint64(0x9E3779B1), starts)
                 if n else np.zeros(0, np.uint64))       # the whole word
    owners.append(np.arange(n))
    h, owner = np.concatenate(found), np.concatenate(owners).astype(np.int64)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - HASH_BITS)
    order = np.argsort(owner, kind="stable")
    return h[order].astype(np.int64), np.searchsorted(owner[order], np.arange(n + 1))


def word_scores(weights: np.ndarray, parts: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.add.reduceat(weights[parts], at[:-1]) if at.size > 1 else np.zeros(0)


def sentence_scores(model: Model, found: Sentences) -> np.ndarray:
    """Log-odds of every sentence."""
    per_word = word_scores(model.weights, *word_parts(found.words))
    return model.bias + np.bincount(found.sentence, per_word[found.index], minlength=found.doc.size)


def noisy_or(z: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """``log prod(1 - p)`` of each text; p is the logistic of z."""
    return -np.bincount(doc, np.logaddexp(0, z), minlength=n)


def train_shard(model: Model, texts: pa.Array, labels: np.ndarray, weights: np.ndarray) -> Model:
    """AdaGrad over the shard's documents, in their order."""
    w, bias = model.weights.copy(), model.bias
    sums, bias_sum = np.full(w.size, FIRST_SUM), FIRST_SUM
    batches = []
    for lo in range(0, len(texts), BATCH_DOCS):
        found = split_sentences(texts.slice(lo, BATCH_DOCS))
        parts, at = word_parts(found.words)
        touched, slot = np.unique(parts, return_inverse=True)
        batches.append((found, touched, slot, at, labels[lo:lo + BATCH_DOCS], weights[lo:lo + BATCH_DOCS]))
    for _ in range(EPOCHS):
        for found, touched, slot, at, y, weight in batches:
            z = bias + np.bincount(found.sentence, word_scores(w[touched], slot, at)[found.index], minlength=found.doc.size)
            lq = np.minimum(noisy_or(z, found.doc, y.size), -1e-12)
            pull = np.where(y, np.exp(lq) / -np.expm1(lq), -1.0) * weight      # of p(sentence), by document
            g = pull[found.doc] / (1 + np.exp(-np.clip(z, -500, 500)))
            by_word = np.bincount(found.index, g[found.sentence], minlength=len(found.words))
            grad = np.bincount(slot, np.repeat(by_word, np.diff(at)), minlength=touched.size) - DECAY * w[touched]
            sums[touched] += grad * grad
            w[touched] += RATE * grad / np.sqrt(sums[touched])
            bias_sum += g.sum() ** 2
            bias += RATE * g.sum() / np.sqrt(bias_sum)
    return Model(w, float(bias))


def sample(docs: DataFrame, labels: DataFrame, docs_per_label: int = DOCS_PER_LABEL, id_col: str = "doc_id",
           text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """``(h, text, toxic, weight)``: about ``docs_per_label`` documents of each
    label, those of least hash, stored. A document with several label rows is
    toxic if one says so; equal rows are one; null texts, ids and labels take
    no part."""
    told = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).cast("long").alias("id")).agg(F.max(F.col(label_col).cast("int") != 0).alias("toxic"))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = texts.where(F.octet_length("text") <= MAX_TRAIN_BYTES).select("id", F.xxhash64("id", "text").alias("h"))
    both = scratch.stored(found.join(told, "id").select("h", "toxic").distinct(), "toxic-labels")   # ids and hashes only
    n = {r.toxic: r.n for r in both.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = {k: min(1.0, docs_per_label / v) for k, v in n.items()}
    limit = lambda k: F.lit(min(2 ** 63 - 1, int(share.get(k, 0.0) * 2 ** 64) - 2 ** 63))  # noqa: E731 - least hashes, signed
    least = both.where(F.col("h") <= F.when(F.col("toxic"), limit(True)).otherwise(limit(False)))
    chosen = texts.withColumn("h", F.xxhash64("id", "text")).join(F.broadcast(least), "h")   # 2 docs_per_label rows
    weight = F.when(F.col("toxic"), 1 / share.get(True, 1.0)).otherwise(1 / share.get(False, 1.0))
    return scratch.stored(chosen.dropDuplicates(["h"]).select("h", "text", "toxic", weight.alias("weight")), "toxic-sample")


def part_documents(texts: pa.Array) -> np.ndarray:
    """In how many of the texts each part occurs."""
    out = np.zeros(1 << HASH_BITS)
    for lo in range(0, len(texts), BATCH_DOCS):
        found = split_sentences(texts.slice(lo, BATCH_DOCS))
        parts, at = word_parts(found.words)
        n = max(1, len(found.words))
        pairs = np.unique(found.doc[found.sentence] * n + found.index)
        flat, ends = ragged(parts, at, pairs % n)
        owner = np.repeat(pairs // n, np.diff(ends))
        out += np.bincount(np.unique((owner << HASH_BITS) + flat) & ((1 << HASH_BITS) - 1), minlength=out.size)
    return out


def _sum_sparse(rows: DataFrame, run, width: int) -> tuple[np.ndarray, np.ndarray, list]:
    """Sums of the shards' sparse vectors, how many touched each place, and their ``extra``."""
    sums, times, extra = np.zeros(width), np.zeros(width), []
    made = rows.groupBy("shard").applyInArrow(run, "shard long, at binary, value binary, extra double")
    for r in sorted(made.collect(), key=lambda r: r.shard):      # 2 docs_per_label / SHARD_DOCS vectors
        at = np.frombuffer(r.at, "<u4")
        sums[at] += np.frombuffer(r.value)
        times[at] += 1
        extra.append(r.extra)
    return sums, times, extra


def _sparse(shard: int, values: np.ndarray, extra: float = 0.0) -> pa.Table:
    at = np.flatnonzero(values)
    return pa.table({"shard": pa.array([shard], pa.int64()), "at": pa.array([at.astype("<u4").tobytes()], pa.binary()),
                     "value": pa.array([values[at].tobytes()], pa.binary()), "extra": [extra]})


def fit(rows: DataFrame, rounds: int = ROUNDS) -> Model:
    """First weights from counts, then the average of the shards' training, round after round."""
    spark, width = rows.sparkSession, 1 << HASH_BITS
    n = {r.toxic: (r.n, r.weight) for r in rows.groupBy("toxic").agg(
        F.count(F.lit(1)).alias("n"), F.sum("weight").alias("weight")).collect()}
    total = sum(w for _, w in n.values())
    shards = max(1, -(-sum(k for k, _ in n.values()) // SHARD_DOCS))
    rows = rows.withColumn("shard", F.pmod(F.col("h"), F.lit(shards)))
    model = Model(np.zeros(width), FIRST_BIAS)
    if len(n) == 2:
        def count(table: pa.Table) -> pa.Table:
            toxic = table.column("toxic").combine_chunks()
            texts, weight = table.column("text").combine_chunks(), table.column("weight").to_numpy()
            both = [part_documents(texts.filter(toxic)), part_documents(texts.filter(pc.invert(toxic)))]
            labels = toxic.to_numpy(zero_copy_only=False)
            scale = [weight[labels][:1].sum(), weight[~labels][:1].sum()]          # one weight a label
            return _sparse(table.column("shard")[0].as_py(), np.concatenate([b * w for b, w in zip(both, scale)]))

        counts = _sum_sparse(rows, count, 2 * width)[0].reshape(2, width)
        share = n[True][1] / total
        odds = np.log((counts[0] + SMOOTHING * share) / (counts[1] + SMOOTHING * (1 - share))) - np.log(share / (1 - share))
        model = Model(FIRST_SHARE * np.maximum(odds, 0), FIRST_BIAS)
    for _ in range(rounds if total else 0):
        shared = spark.sparkContext.broadcast(model)

        def run(table: pa.Table) -> pa.Table:
            table, start = table.sort_by("h"), shared.value
            toxic = table.column("toxic").to_numpy().astype(bool)
            out = train_shard(start, table.column("text").combine_chunks(), toxic, table.column("weight").to_numpy())
            return _sparse(table.column("shard")[0].as_py(), out.weights - start.weights, out.bias)

        change, times, biases = _sum_sparse(rows, run, width)
        model = Model(model.weights + change / np.maximum(times, 1), float(np.mean(biases)))
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns, and ``score``, ``predicted``, ``n_sentences`` and
    ``offending`` (start and length in code points, and probability, of each
    offending sentence, in order)."""
    new = ["score", "predicted", "n_sentences", "offending"]
    kept = docs.drop(*new)
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                         T.StructField("score", T.DoubleType())])
    schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType()), T.StructField("n_sentences", T.LongType()),
                           T.StructField("offending", T.ArrayType(span))])
    position = kept.columns.index(next(c for c in kept.columns if c.lower() == text_col.lower()))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in row_blocks(batch, batch.schema.names[position]):
                texts = rows.column(position).cast(pa.string())
                found = split_sentences(texts)
                z = sentence_scores(shared.value, found)
                p = -np.expm1(noisy_or(z, found.doc, rows.num_rows))
                own = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
                spans: list[list] = [[] for _ in range(rows.num_rows)]
                for s in np.flatnonzero((own >= OFFENDING) & (found.span[:, 1] > 0)):
                    lo, hi = found.span[s].tolist()
                    raw = texts[int(found.doc[s])].as_py().encode()
                    spans[found.doc[s]].append({"start": len(raw[:lo].decode()), "length": len(raw[lo:hi].decode()),
                                                "score": float(own[s])})
                yield pa.RecordBatch.from_arrays([
                    *rows.columns, pa.array(p), pa.array((p >= 0.5).astype(np.int32)),
                    pa.array(np.bincount(found.doc, minlength=rows.num_rows)),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("score", pa.float64())])))],
                    names=schema.names)

    return kept.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, train_on=None, docs_per_label: int = DOCS_PER_LABEL,
             id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """:func:`score` of every row, learnt from the labelled rows of ``docs``
    where ``train_on`` (a condition on the id; default: all) is true.

    A null or empty text, or one without words, is one empty sentence and gets
    its probability. Without labels the score is that of the first bias. Rows
    of one id are scored each; an empty table gives an empty table. Columns of
    the names that are added are replaced.
    """
    learn = labels if train_on is None else labels.where(F.coalesce(train_on, F.lit(False)))
    return score(docs, fit(sample(docs, learn, docs_per_label, id_col, text_col, label_col)), text_col)
