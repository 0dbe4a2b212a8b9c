"""Language identification with a linear-chain conditional random field.

Every word of a text gets a language label. A word's features are its
character n-grams (with word boundaries, so they include the one- to
three-letter affixes), its three-letter affixes, and membership in the
lexicon of words met in training; a weight per feature and language, a start
weight and learned transitions between neighbouring words score a labelling.
Marginals come from the forward-backward algorithm over each line of a text,
so words of a second language inside a text keep their own label.

Training takes a bounded sample of every language (``docs_per_label``
documents, the least hashes of their ids) and maximises the conditional likelihood with
AdaGrad on runs of words, half of them code-switched: joined from documents
of different languages. The model (bounded by hash size, sample and labels)
is broadcast; prediction is one narrow pass over whole texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.llm.pretokens import LETTER, char_classes, code_points, row_blocks, utf8_widths

UNDETERMINED = "und"
DOCS_PER_LABEL = 150
#: Groups in which a language's sample is cut before it is cut as a whole.
SAMPLE_GROUPS = 32
#: One sampled document of a language in so many is held out to learn how
#: familiar clean texts are.
HELD_OUT = 5
#: Words of full familiarity that every text is credited with, so that a word
#: or two decide nothing.
PRIOR_WORDS = 2
HASH_BITS = 16
STEPS, RUNS, RUN_WORDS = 260, 48, 40
#: Text bytes predicted at once, with up to so many labels; fewer with more.
BLOCK_TEXT, BLOCK_LABELS = 1 << 20, 64
_FIRST, _LAST = 1, 2           # stand for a word's two boundaries (below any letter)


@dataclass(frozen=True)
class Crf:
    labels: list[str]
    weights: np.ndarray         # [hashed features + lexicon, label]
    start: np.ndarray           # [label]
    transition: np.ndarray      # [label before, label]
    lexicon: dict[bytes, int]


@dataclass
class Words:
    """Letter runs of some texts: distinct ones, and where they stand."""

    words: pa.Array             # distinct, lower case
    index: np.ndarray           # word number of each occurrence
    doc: np.ndarray             # text of each occurrence
    line: np.ndarray            # line (over all texts) of each occurrence


def find_words(texts: pa.Array) -> Words:
    lowered = pc.utf8_lower(texts.fill_null("").cast(pa.large_string())).cast(pa.large_binary())
    offsets = np.frombuffer(lowered.buffers()[1], dtype=np.int64)[lowered.offset:lowered.offset + len(lowered) + 1]
    lo, hi = int(offsets[0]), int(offsets[-1])
    data = lowered.buffers()[2].slice(lo, hi - lo).to_pybytes() if hi > lo else b""
    cps = code_points(data)
    widths = utf8_widths(cps)
    place = np.zeros(cps.size + 1, dtype=np.int64)
    np.cumsum(widths, out=place[1:])
    docs = np.searchsorted(place, offsets - lo)             # text bounds in code points
    letter = char_classes()[cps] == LETTER
    starts = letter.copy()
    starts[1:] &= ~letter[:-1]
    edges = docs[:-1][docs[:-1] < cps.size]
    starts[edges] = letter[edges]
    at = np.flatnonzero(starts)
    kept = np.frombuffer(data, dtype=np.uint8)[np.repeat(letter, widths)]
    before = np.zeros(cps.size + 1, dtype=np.int64)
    np.cumsum(widths * letter, out=before[1:])
    cuts = np.append(before[at], kept.size).astype(np.int32)
    coded = pa.Array.from_buffers(pa.binary(), at.size,
                                  [None, pa.py_buffer(cuts), pa.py_buffer(kept.tobytes())]).dictionary_encode()
    doc = np.searchsorted(docs, at, side="right") - 1
    breaks = np.cumsum(cps == 0x0A)
    line = (breaks[at] if at.size else np.zeros(0, np.int64)) + doc   # a text ends its last line
    return Words(coded.dictionary, coded.indices.to_numpy().astype(np.int64), doc, line)


def _mix(*parts: np.ndarray) -> np.ndarray:
    h = np.full(parts[0].shape, len(parts) * 0x9E3779B1 & 0xFFFFFFFF, dtype=np.uint64)
    for p in parts:
        h = (h ^ p) * np.uint64(0x100000001B3)
        h ^= h >> np.uint64(29)
    return (h >> np.uint64(7)) & np.uint64((1 << HASH_BITS) - 1)


def features(words: pa.Array, lexicon: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers, word of each) of distinct words, grouped by word."""
    raw = words.cast(pa.large_binary())
    n = len(raw)
    offsets = np.frombuffer(raw.buffers()[1], dtype=np.int64)[raw.offset:raw.offset + n + 1]
    data = raw.buffers()[2].slice(int(offsets[0]), int(offsets[-1] - offsets[0])).to_pybytes() if n else b""
    cps = code_points(data).astype(np.uint64)
    place = np.zeros(cps.size + 1, dtype=np.int64)
    np.cumsum(utf8_widths(cps), out=place[1:])
    cuts = np.searchsorted(place, offsets - offsets[0])
    sizes = np.diff(cuts) + 2                                # with both boundaries
    ends = np.cumsum(sizes)
    starts = ends - sizes
    x = np.full(int(ends[-1]) if n else 0, _LAST, dtype=np.uint64)
    x[starts] = _FIRST
    x[np.arange(cps.size) + np.repeat(2 * np.arange(n) + 1, sizes - 2)] = cps
    owner = np.repeat(np.arange(n), sizes)
    found, owners = [], []
    for size in (2, 3):
        at = np.flatnonzero(owner[:x.size - size + 1] == owner[size - 1:])
        found.append(_mix(*(x[at + k] for k in range(size))))
        owners.append(owner[at])
    long = np.flatnonzero(sizes >= 5)                        # three-letter prefix and suffix
    found += [_mix(*(x[starts[long] + k] for k in range(4))), _mix(*(x[ends[long] - 4 + k] for k in range(4)))]
    owners += [long, long]
    known = [(i, lexicon[w]) for i, w in enumerate(words.to_pylist()) if w in lexicon]
    found.append(np.array([k for _, k in known], dtype=np.uint64) + np.uint64(1 << HASH_BITS))
    owners.append(np.array([i for i, _ in known], dtype=np.int64))
    feature, owner = np.concatenate(found).astype(np.int64), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return feature[order], owner[order]


def emissions(words: pa.Array, model: Crf) -> np.ndarray:
    """Score of each label for each distinct word."""
    out = np.zeros((len(words), len(model.labels)))
    if len(words):
        feature, owner = features(words, model.lexicon)
        starts = np.flatnonzero(np.diff(owner, prepend=-1))  # every word has its n-grams
        out[owner[starts]] = np.add.reduceat(model.weights[feature], starts, axis=0)
    return out


def familiarity(found: Words, texts: int, model: Crf) -> np.ndarray:
    """How much of each text's letter n-grams training met: the mean over its
    words (and ``PRIOR_WORDS`` known ones) of the share of features with a
    weight. Junk and languages that were not learnt are low, mixtures are not."""
    met = (model.weights != 0).any(axis=1)
    feature, owner = features(found.words, {})
    words = len(found.words)
    share = np.bincount(owner, weights=met[feature], minlength=words) / np.maximum(np.bincount(owner, minlength=words), 1)
    sums = np.bincount(found.doc, weights=share[found.index], minlength=texts)
    return (sums + PRIOR_WORDS) / (np.bincount(found.doc, minlength=texts) + PRIOR_WORDS)


def usual_familiarity(texts: list[str], langs: list[str], model: Crf) -> float:
    """The familiarity that nine in ten of the given (not trained on) documents of
    every language reach; 0 without documents."""
    found = find_words(pa.array(texts, pa.string()))
    each = familiarity(found, len(texts), model)
    by_lang: dict[str, list[float]] = {}
    for value, lang in zip(each, langs):
        by_lang.setdefault(lang, []).append(float(value))
    return min((float(np.quantile(v, 0.1)) for v in by_lang.values()), default=0.0)


def marginals(scores: np.ndarray, chain: np.ndarray, start: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """Label probabilities of each word by forward-backward over its chain.

    ``scores`` are in reading order and ``chain`` numbers ascend with it. All
    chains advance together, one word a step."""
    n, k = scores.shape
    if not n:
        return np.zeros((0, k))
    first = np.flatnonzero(np.diff(chain, prepend=-1))
    sizes = np.diff(np.append(first, n))
    order = np.argsort(-sizes, kind="stable")
    sizes = sizes[order]
    # words by step: step t has the t-th word of every chain longer than t
    step = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
    rank = np.empty(order.size, dtype=np.int64)
    rank[order] = np.arange(order.size)
    active = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")
    begin = np.concatenate(([0], np.cumsum(active)))
    where = begin[step] + np.repeat(rank, np.diff(np.append(first, n)))
    e = np.empty_like(scores)
    e[where] = np.exp(scores - scores.max(axis=1, keepdims=True))
    t = np.exp(transition - transition.max())
    forward, backward = np.empty_like(e), np.ones_like(e)
    a = e[:active[0]] * np.exp(start - start.max())
    for i in range(len(active)):
        if i:
            a = (a[:active[i]] @ t) * e[begin[i]:begin[i + 1]]
        a /= a.sum(axis=1, keepdims=True)
        forward[begin[i]:begin[i + 1]] = a
    back = t.T
    for i in range(len(active) - 2, -1, -1):
        m = active[i + 1]
        b = (e[begin[i + 1]:begin[i + 2]] * backward[begin[i + 1]:begin[i + 2]]) @ back
        b /= b.sum(axis=1, keepdims=True)
        backward[begin[i]:begin[i] + m] = b
    both = forward * backward
    return (both / both.sum(axis=1, keepdims=True))[where]


def train(texts: list[str], langs: list[str], seed: int = 7) -> Crf:
    """Fit on whole documents, each word labelled with its document's language."""
    labels = sorted(set(langs))
    if not labels:
        return Crf([], np.zeros((1 << HASH_BITS, 0)), np.zeros(0), np.zeros((0, 0)), {})
    found = find_words(pa.array(texts, pa.string()))
    number = {lang: i for i, lang in enumerate(labels)}
    gold = np.array([number[lang] for lang in langs])
    vocabulary = found.words.to_pylist()
    often = Counter(dict(enumerate(np.bincount(found.index, minlength=len(vocabulary)).tolist())))
    lexicon = {vocabulary[i]: j for j, i in enumerate(sorted(i for i, c in often.items() if c >= 3))}
    k, size = len(labels), (1 << HASH_BITS) + len(lexicon)
    feature, owner = features(found.words, lexicon)
    lengths = np.bincount(owner, minlength=len(vocabulary))
    at = np.concatenate(([0], np.cumsum(lengths)))
    bounds = np.searchsorted(found.doc, np.arange(len(texts) + 1))
    by_label = [[d for d in np.flatnonzero(gold == c) if bounds[d + 1] > bounds[d]] for c in range(k)]
    by_label = [d for d in by_label if d]
    w, start, trans = np.zeros((size, k)), np.zeros(k), np.zeros((k, k))
    if not by_label:
        return Crf(labels, w, start, trans, lexicon)
    sums = [np.full(x.shape, 1e-3) for x in (w, start, trans)]
    rng = np.random.default_rng(seed)

    def piece(words: int) -> tuple[np.ndarray, np.ndarray]:
        docs = by_label[rng.integers(len(by_label))]
        d = docs[rng.integers(len(docs))]
        lo, hi = bounds[d], bounds[d + 1]
        i = lo + rng.integers(max(1, hi - lo - words + 1))
        part = found.index[i:min(hi, i + words)]
        return part, np.full(part.size, gold[d])

    for _ in range(STEPS):
        words, truth, chain = [], [], []
        for r in range(RUNS):
            pieces = [piece(RUN_WORDS)] if r % 2 else [piece(int(rng.integers(4, 16))) for _ in range(4)]
            words += [p for p, _ in pieces]
            truth += [g for _, g in pieces]
            chain.append(np.full(sum(p.size for p, _ in pieces), r))
        word, label, run = np.concatenate(words), np.concatenate(truth), np.concatenate(chain)
        used, local = np.unique(word, return_inverse=True)
        rows = np.concatenate([feature[at[u]:at[u + 1]] for u in used])
        owners = np.repeat(np.arange(used.size), lengths[used])
        e = np.add.reduceat(w[rows], np.concatenate(([0], np.cumsum(lengths[used])[:-1])), axis=0)[local]
        p = marginals(e, run, start, trans)
        wrong = -p
        wrong[np.arange(label.size), label] += 1
        gains = np.zeros((used.size, k))
        np.add.at(gains, local, wrong)
        touched, slot = np.unique(rows, return_inverse=True)
        g = np.zeros((touched.size, k))
        np.add.at(g, slot, gains[owners])
        g -= 1e-3 * w[touched]
        sums[0][touched] += g * g
        w[touched] += 0.2 * g / np.sqrt(sums[0][touched])
        heads = np.flatnonzero(np.diff(run, prepend=-1))
        g = wrong[heads].sum(axis=0)
        sums[1] += g * g
        start += 0.2 * g / np.sqrt(sums[1])
        # neighbouring pairs: expected counts from the pairwise marginals
        inner = np.flatnonzero(np.diff(run) == 0)
        pair = _pair_counts(e, run, inner, start, trans)
        g = -pair
        np.add.at(g, (label[inner], label[inner + 1]), 1.0)
        sums[2] += g * g
        trans += 0.2 * g / np.sqrt(sums[2])
    return Crf(labels, w.astype(np.float32), start, trans, lexicon)


def _pair_counts(scores: np.ndarray, chain: np.ndarray, inner: np.ndarray, start: np.ndarray,
                 transition: np.ndarray) -> np.ndarray:
    """Expected label pairs of neighbouring words. With the marginals p and the
    chain's Markov form, P(a, b) of a pair is proportional to
    forward(a) * T(a, b) * e(b) * backward(b)."""
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    t = np.exp(transition - transition.max())
    p = marginals(scores, chain, start, transition)
    # forward messages only, recovered by running the chains without what follows
    f = _forward(e, chain, start, t)
    beta = p / np.maximum(f, 1e-300)
    left, right = f[inner], e[inner + 1] * beta[inner + 1]
    whole = ((left @ t) * right).sum(axis=1, keepdims=True)
    return t * ((left / whole).T @ right)        # no array of pairs by labels squared


def _forward(e: np.ndarray, chain: np.ndarray, start: np.ndarray, t: np.ndarray) -> np.ndarray:
    out = np.empty_like(e)
    heads = np.flatnonzero(np.diff(chain, prepend=-1))
    sizes = np.diff(np.append(heads, chain.size))
    a = e[heads] * np.exp(start - start.max())
    for i in range(int(sizes.max())):
        live = np.flatnonzero(sizes > i)
        if i:
            a[live] = (a[live] @ t) * e[heads[live] + i]
        a[live] /= a[live].sum(axis=1, keepdims=True)
        out[heads[live] + i] = a[live]
    return out


def word_labels(text: str, model: Crf) -> list[tuple[str, str]]:
    """(word, most probable language) of each word of a text."""
    found = find_words(pa.array([text]))
    p = marginals(emissions(found.words, model)[found.index], found.line, model.start, model.transition)
    words = found.words.to_pylist()
    return [(words[i].decode(), model.labels[j]) for i, j in zip(found.index, p.argmax(axis=1))]


def sample(docs: DataFrame, docs_per_label: int = DOCS_PER_LABEL, id_col: str = "doc_id",
           text_col: str = "text", lang_col: str = "lang") -> list:
    """The training rows ``(text, lang)``: of every language the documents with
    the least (id hash, text hash), at most ``docs_per_label``; rows of equal
    id, text and language are one document. The hashes alone are ranked; texts
    are read for the chosen rows only."""
    rows = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"),
        F.xxhash64(F.col(id_col).cast("long")).alias("h")).withColumn("t", F.xxhash64("text"))
    least = rows.select("lang", "h", "t").distinct().withColumn("group", F.spark_partition_id() % SAMPLE_GROUPS)
    for keys in (["lang", "group"], ["lang"]):       # cut twice: no task gets a language's rows of all tasks
        order = Window.partitionBy(*keys).orderBy("h", "t")
        least = least.withColumn("n", F.row_number().over(order)).where(F.col("n") <= docs_per_label).drop("n")
    least = least.drop("group")
    chosen = rows.join(F.broadcast(least), ["lang", "h", "t"])     # docs_per_label rows a language broadcast
    return sorted(chosen.distinct().collect(), key=lambda r: (r.h, r.lang, r.t))


def identify(docs: DataFrame, train_on=None, docs_per_label: int = DOCS_PER_LABEL, id_col: str = "doc_id",
             text_col: str = "text", lang_col: str = "lang", least_familiar: float | None = None) -> DataFrame:
    """All input columns, with ``lang_pred`` and ``score`` (replaced if present).

    Learns from rows where ``train_on`` is true (default: all) and text and
    language are not null. A text's language is the one with the largest mean
    word probability (ties: the first in order), its score that mean;
    ``und`` with score 0 if the text is null or has no letter, or if there was
    nothing to learn from. Whole texts are read; repeated rows are labelled
    each; an empty table gives an empty table.

    With ``least_familiar`` a text in no learnt language is ``und`` with score 0
    too: one whose :func:`familiarity` is below that part of what held-out
    documents usually have. A fifth of a larger sample is held out for it;
    languages with fewer than five sampled documents hold out none, and without
    held-out documents nothing is rejected so.
    """
    learn = docs if train_on is None else docs.where(F.coalesce(train_on, F.lit(False)))
    if least_familiar is None:
        rows = sample(learn, docs_per_label, id_col, text_col, lang_col)
        crf, bound = train([r.text for r in rows], [r.lang for r in rows]), 0.0
    else:
        rows = sample(learn, docs_per_label * HELD_OUT // (HELD_OUT - 1), id_col, text_col, lang_col)
        met: Counter = Counter()
        parts: tuple[list, list] = ([], [])
        for r in rows:
            met[r.lang] += 1
            parts[met[r.lang] % HELD_OUT == 0].append(r)
        crf = train([r.text for r in parts[0]], [r.lang for r in parts[0]])
        bound = least_familiar * usual_familiarity([r.text for r in parts[1]], [r.lang for r in parts[1]], crf)
    model = docs.sparkSession.sparkContext.broadcast(crf)
    kept = docs.drop("lang_pred", "score")
    schema = T.StructType([*kept.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    position = kept.columns.index(next(c for c in kept.columns if c.lower() == text_col.lower()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = model.value
        names = [*crf.labels, UNDETERMINED]
        block_bytes = BLOCK_TEXT * BLOCK_LABELS // max(BLOCK_LABELS, len(crf.labels))
        for batch in batches:
            for rows in row_blocks(batch, batch.schema.names[position], block_bytes=block_bytes):
                found = find_words(rows.column(position))
                n, k = rows.num_rows, len(crf.labels)
                best, score = np.full(n, k), np.zeros(n)
                if k and found.index.size:
                    p = marginals(emissions(found.words, crf)[found.index], found.line, crf.start, crf.transition)
                    docs_with, first = np.unique(found.doc, return_index=True)
                    mean = np.add.reduceat(p, first, axis=0) / np.diff(np.append(first, len(p)))[:, None]
                    best[docs_with] = mean.argmax(axis=1)
                    score[docs_with] = np.minimum(mean.max(axis=1), 1.0)
                    if bound:
                        strange = familiarity(found, n, crf) < bound
                        best[strange], score[strange] = k, 0.0
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array([names[b] for b in best]), pa.array(score)], names=schema.names)

    return kept.mapInArrow(run, schema)
