"""Line dedup, SimHash, bottom-k sketches, scoring, language ID and the pipeline
against brute force on small inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from postlake.llm import brown_lm, components, crf_lang, queries, scratch, simhash, sketch
from postlake.llm import line_dedup as ld
from tests.conftest import SF_ORACLE, SF_SMALL, rows

SMALL_FILTER = 1 << 21


def _ascii_lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def _words(s):
    return re.findall(r"[^\x20\x09-\x0D]+", _ascii_lower(s or ""))


def _docs(spark, texts, first=1):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts, first)], "doc_id long, text string")


def _odd(spark):
    data = [(1, "A line\nsame words here now ok"), (1, "A line\nsame words here now ok"), (2, None), (3, ""),
            (None, "a LINE \nanother"), (5, "word " * 3000), (6, "..!\n\n12"), (7, "\n\n\n")]
    return spark.createDataFrame(data, "doc_id long, text string").withColumns({
        "n_lines": F.lit("x"), "score": F.lit("y"), "lang_pred": F.lit(3), "lang": F.lit(None).cast("string"),
        "fp": F.lit(1), "content": F.lit("c"), "bin": F.lit(2), "key": F.lit("k"), "held_out": F.lit(9)})


# --- line dedup -----------------------------------------------------------------

def _dedup_by_hand(docs, min_docs, keep):
    lines = [(i, d or "").__getitem__(1).split("\n") for i, d in docs]
    key = lambda x: _ascii_lower(x.strip(" \t\n\x0b\x0c\r"))
    seen = Counter(k for ls in lines for k in {key(x) for x in ls} if k)
    first, out = {}, []
    for (i, _), ls in sorted(zip(docs, lines), key=lambda x: x[0][0]):
        for n, x in enumerate(ls):
            first.setdefault(key(x), (i, n))
    for (i, _), ls in zip(docs, lines):
        stay = [x for n, x in enumerate(ls) if not (seen[key(x)] >= min_docs and key(x)
                                                   and not (keep == "first" and first[key(x)] == (i, n)))]
        out.append((i, "\n".join(stay), len(ls), len(ls) - len(stay)))
    return sorted(out)


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("filter_bits", [SMALL_FILTER, 1 << 22])
def test_line_dedup_equals_brute_force(spark, keep, filter_bits):
    rnd = random.Random(3)
    pool = ["Alpha", "beta ", "\tGAMMA", "é", "É", "", " ", "delta\r", "alpha"] + [f"line {i}" for i in range(40)]
    docs = [(i, "\n".join(rnd.choice(pool) for _ in range(rnd.randint(1, 12)))) for i in range(120)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    got = ld.line_dedup(df, min_docs=8, keep=keep, filter_bits=filter_bits)
    assert rows(got.select("doc_id", "text", "n_lines", "n_dropped")) == sorted(_dedup_by_hand(docs, 8, keep), key=repr)


def test_line_dedup_with_a_saturated_filter_is_still_exact(spark, monkeypatch):
    monkeypatch.setattr(ld, "seen_twice", lambda lines, bits, chars: np.full(bits // 8, 255, np.uint8))
    docs = [(i, f"shared\nown {i}") for i in range(12)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = ld.line_dedup(df, min_docs=12, keep="none", filter_bits=SMALL_FILTER)
    assert rows(got.select("doc_id", "text")) == sorted([(i, f"own {i}") for i in range(12)], key=repr)


def test_one_copy_of_a_repeated_row_keeps_the_first_occurrence(spark):
    data = [(1, "same line", "x")] * 3 + [(2, "same line\nown", "y"), (None, "null line", "z"), (None, "null line", "w"),
            (None, "null line", "z"), (5, "", "e"), (5, "", "e"), (6, "twice\ntwice\nSAME line", "t")]
    docs = spark.createDataFrame(data, "doc_id long, text string, other string").repartition(3)
    got = sorted((str(r.doc_id), r.text, r.n_dropped) for r in ld.line_dedup(
        docs, min_docs=2, keep="first", filter_bits=SMALL_FILTER).collect())
    assert got == sorted([("1", "same line", 0), ("1", "", 1), ("1", "", 1), ("2", "own", 1), ("None", "null line", 0),
                          ("None", "", 1), ("None", "", 1), ("5", "", 0), ("5", "", 0), ("6", "twice\ntwice", 1)])
    every = ld.line_dedup(docs.where("doc_id = 1"), min_docs=1, keep="first", filter_bits=SMALL_FILTER).collect()
    assert sorted(r.n_dropped for r in every) == [0, 1, 1]


def test_second_filter_has_every_repeated_key_and_few_others(spark):
    texts = [f"common {i % 50}\nunique {i}" for i in range(2000)]
    bits = ld.seen_twice(_docs(spark, texts).repartition(7).select("text").withColumn(
        "text", F.col("text").cast("binary")), SMALL_FILTER, 1)

    def suspected(line):
        h = np.array([xxhash.xxh3_64_intdigest(line.encode())], dtype=np.uint64)
        return all(bits[p[0] >> 3] >> (p[0] & 7) & 1 for p in ld._bits(h, SMALL_FILTER))

    assert all(suspected(f"common {i}") for i in range(50))
    assert sum(suspected(f"unique {i}") for i in range(2000)) < 40


def test_line_dedup_of_odd_rows(spark):
    out = ld.line_dedup(_odd(spark), min_docs=3, keep="none", filter_bits=SMALL_FILTER)
    got = {(str(r.doc_id), r.text, r.n_lines, r.n_dropped) for r in out.collect()}
    assert ("1", "same words here now ok", 2, 1) in got and ("None", "another", 2, 1) in got
    assert ("2", None, 1, 0) in got and ("7", "\n\n\n", 4, 0) in got and out.count() == 8
    assert ld.line_dedup(_odd(spark).limit(0), filter_bits=SMALL_FILTER).count() == 0
    long_keys = ld.line_dedup(_docs(spark, ["éé\nabcd", "éé\nabcd"]), min_docs=2, min_chars=3, keep="none",
                              filter_bits=SMALL_FILTER)
    assert {r.text for r in long_keys.collect()} == {"éé"}


# --- SimHash --------------------------------------------------------------------

def _fingerprint_by_hand(text):
    w = _words(text)
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components_by_hand(prints, ids, radius):
    a, label = np.array(prints, dtype=np.uint64), list(range(len(ids)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for x, y in zip(*np.nonzero(np.triu(np.bitwise_count(a[:, None] ^ a[None]) <= radius, 1))):
        label[find(x)] = find(y)
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(d, least.get(find(i), d))
    return [least[find(i)] for i in range(len(ids))]


def test_simhash_query_equals_brute_force(spark):
    out = queries.op4_simhash_near_dedup(spark, SF_SMALL).toPandas()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    prints = [int(x, 16) for x in out.fingerprint]
    assert prints == [_fingerprint_by_hand(texts[d]) for d in out.doc_id]
    assert _components_by_hand(prints, out.doc_id.tolist(), 3) == out.component_id.tolist()


@pytest.mark.parametrize("radius", [0, 1, 3])
@pytest.mark.parametrize("split", [8192, 16])
def test_links_give_the_components_of_all_pairs(spark, radius, split):
    rnd = random.Random(radius)
    values = {0, 1, 3, 7, 15, 31, 2**64 - 1}
    for _ in range(8):
        base = rnd.getrandbits(64)
        for _ in range(50):
            v = base
            for _ in range(rnd.randint(0, 8)):
                v ^= 1 << rnd.randrange(64)
            values.add(v)
    prints = sorted(values)
    signed = np.array(prints, dtype=np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    edges = simhash.links(df, radius, split=split)
    assert edges.count() <= 2 * (radius + 1) * len(prints) * (1 if split > 1000 else len(prints))
    found = {r.node: r.root for r in components.components(edges).collect()}
    assert [found.get(v, v) for v in signed] == _components_by_hand(prints, signed, radius)


def test_components_of_a_chain_a_star_and_nothing(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(5, 5), (1, 0)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 160)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_dedup_keeps_one_of_each_group(spark):
    kept = simhash.near_dedup(_odd(spark)).collect()
    # 2, 3 and 7 have no words; the two rows of id 1 are one document
    assert sorted(str(r.doc_id) for r in kept) == ["1", "2", "5", "6", "None"]
    assert kept[0].__fields__ == _odd(spark).columns
    groups = {(str(r.doc_id), r.component_id) for r in simhash.simhash_groups(_odd(spark)).collect()}
    assert {("2", 2), ("3", 2), ("7", 2), ("None", None), ("1", 1)} <= groups
    assert simhash.simhash_groups(_odd(spark).limit(0)).count() == 0
    assert simhash.near_dedup(_odd(spark).limit(0)).count() == 0


# --- bottom-k sketches -----------------------------------------------------------

def _shingles(text, n=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def test_sketch_estimates_and_merge():
    rnd = random.Random(2)
    a = " ".join(str(rnd.randrange(10**6)) for _ in range(4000))
    b = a[:len(a) // 2] + " " + " ".join(str(rnd.randrange(10**6)) for _ in range(1000))
    x, y = sketch.sketch(a, 512), sketch.sketch(b, 512)
    sa, sb = _shingles(a), _shingles(b)
    assert abs(sketch.resemblance(x, y, 512) - len(sa & sb) / len(sa | sb)) < 0.08
    assert abs(sketch.containment(y, x, 512) - len(sa & sb) / len(sb)) < 0.12
    assert abs(sketch.distinct_count(x, 512) / len(sa) - 1) < 0.15
    whole = sketch.sketch(a, 512)
    assert (sketch.merge(whole, whole, 512) == whole).all()
    assert (sketch.from_string(sketch.to_string(x)) == x).all()
    assert sketch.resemblance(sketch.sketch(""), sketch.sketch(" \n")) == 1.0
    assert sketch.resemblance(sketch.sketch(""), x, 512) == 0.0 and sketch.distinct_count(sketch.sketch("one")) == 1.0


def test_merged_sketches_of_groups_equal_the_union(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    prints = sketch.fingerprints(docs, k=32).join(docs.select("doc_id", "source"), "doc_id")
    got = {r.source: r.hashes for r in sketch.merge_groups(prints, "source", k=32).collect()}
    want = {}
    for r in docs.collect():
        want[r.source] = sketch.merge(want.get(r.source, np.zeros(0, np.uint64)), sketch.sketch(r.text, 32), 32)
    assert got == {s: h.astype(np.int64).tolist() for s, h in want.items()}


def test_edited_texts_equal_brute_force(spark):
    out = {r.doc_id: r for r in queries.op10_bottom_k_sketch(spark, SF_SMALL).collect()}
    docs = sorted(spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect(), key=lambda r: -r.doc_id)
    gaps = []
    for i, d in enumerate(docs):
        following, half = docs[(i + 1) % len(docs)].text, len(d.text) // 2
        edited = d.text[:len(d.text) - half] + following[:half]
        r = out[d.doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(d.text), hashlib.sha256(edited.encode()).hexdigest())
        assert (sketch.from_string(r.edited_fingerprint) == sketch.sketch(edited)).all()
        for got, other in ((r.near_edited, edited), (r.near_next, following)):
            a, b = _shingles(d.text), _shingles(other)
            gaps.append(abs(got - (len(a & b) / len(a | b) if a | b else 1.0)))
    assert len(out) == len(docs) and np.mean(gaps) < 0.03 and max(gaps) < 0.25


def test_edits_of_odd_rows(spark):
    out = sketch.compare_edits(_odd(spark)).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(r.doc_id) for r in _odd(spark).collect())
    one = sketch.compare_edits(_docs(spark, ["abcd"])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one.near_next == 1.0
    assert sketch.compare_edits(_docs(spark, [])).count() == 0


# --- scoring --------------------------------------------------------------------

def test_base_scores_equal_brute_force_and_the_model_beats_them(spark):
    out = queries.op5_brown_lm(spark, SF_SMALL).toPandas().set_index("doc_id")
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    tokens = {d: [*_words(t), ""] for d, t in texts.items()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in texts}
    count = Counter(w for d, ws in tokens.items() if not held[d] for w in ws)
    n, v = sum(count.values()), len(count)
    for d, r in out.iterrows():
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[d], len(tokens[d]), n)
        assert r.n_known == sum(count[w] > 0 for w in tokens[d])
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in tokens[d]))
    for _, part in out.groupby("held_out"):
        assert part.score.sum() > part.base_score.sum()


def _fitted(spark, docs, slots, n_classes, **kw):
    blocks = scratch.stored(brown_lm.make_blocks(docs.select("doc_id", "text", "held_out"), slots), "b")
    totals = scratch.stored(brown_lm.word_totals(brown_lm.block_words(blocks)), "t")
    return blocks, totals, brown_lm.fit(blocks, totals, slots=slots, n_classes=n_classes, **kw)


def _class_of(model, word):
    kind = brown_lm.Classes(model.classes, model.vocabulary, model.word_classes)
    return int(kind.of(brown_lm.word_hashes([word]), brown_lm.word_slots([word], len(model.classes) - 1))[0][0])


@pytest.mark.parametrize("limit", [0, 4, 1 << 18])
def test_model_probabilities_sum_to_one(spark, limit):
    docs = _docs(spark, ["a b a c", "b a c c d", "the cat sat", "a cat b"]).withColumn("held_out", F.lit(False))
    _, totals, model = _fitted(spark, docs, 64, 3, limit=limit)
    assert len(model.vocabulary) <= limit and np.allclose((10 ** model.log_transition).sum(axis=1), 1)
    mass, words = Counter(), Counter()
    for r in totals.collect():
        c = _class_of(model, bytes(r.word))
        mass[c] += (r["count"] - model.discount) / model.class_tokens[c]
        words[c] += 1
    for c, known in mass.items():
        assert model.class_words[c] == words[c]
        assert known + model.discount * model.class_words[c] / model.class_tokens[c] == pytest.approx(1)


def test_counts_return_to_every_block(spark):
    docs = _docs(spark, ["a b a", "b a c", None, "d d"]).repartition(3).withColumn("held_out", F.col("doc_id") == 4)
    blocks, totals, _ = _fitted(spark, docs, 64, 2)
    words = {(r.block, r.i): bytes(r.w) for r in blocks.select("block", F.posexplode("words").alias("i", "w")).collect()}
    got = {(r.block, r.number): r["count"] for r in brown_lm.counts_of_blocks(brown_lm.block_words(blocks), totals).collect()}
    assert got == {k: {b"a": 3, b"b": 2, b"c": 1, b"d": 0, b"": 3}[w] for k, w in words.items()}


def test_gain_of_a_word_equals_the_likelihood_computed_anew():
    rng = np.random.default_rng(5)
    text, n_words, total = rng.integers(0, 12, 400), 12, 5
    classes = rng.integers(0, total - 1, n_words)
    seen = np.concatenate(([n_words], text, [n_words]))          # the end before and after

    def bigrams(kinds):
        k = np.append(kinds, total - 1)[seen]
        out = np.zeros((total, total))
        np.add.at(out, (k[:-1], k[1:]), 1)
        return out

    n, kinds = bigrams(classes), np.append(classes, total - 1)
    before, after, twin = np.zeros((n_words, total)), np.zeros((n_words, total)), np.zeros(n_words)
    for x, y in zip(seen[:-1], seen[1:]):
        if x == y and x < n_words:
            twin[x] += 1
        else:
            if y < n_words:
                before[y, kinds[x]] += 1
            if x < n_words:
                after[x, kinds[y]] += 1
    gains = brown_lm.class_gains(n, classes, before, after, twin)
    for w in range(n_words):
        here = []
        for c in range(total - 1):
            moved = classes.copy()
            moved[w] = c
            here.append(brown_lm.likelihood(bigrams(moved)) - brown_lm.likelihood(n))
        assert np.allclose(gains[w, :-1] - gains[w, classes[w]], here) and gains[w, -1] == -np.inf
        assert brown_lm.best_classes(n, classes, before, after, twin)[w] == (
            int(np.argmax(here)) if max(here) > 1e-9 else classes[w])


def test_slot_bigrams_equal_brute_force_and_exchange_raises_the_likelihood(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").repartition(4).withColumn("held_out", F.col("doc_id") % 5 == 0)
    blocks = scratch.stored(brown_lm.make_blocks(docs.select("doc_id", "text", "held_out"), 256), "b")
    got = brown_lm.slot_bigrams(blocks, 256)
    want = np.zeros((257, 257))
    for r in docs.where("doc_id % 5 <> 0").collect():
        s = [256, *brown_lm.word_slots([w.encode() for w in _words(r.text)], 256).tolist(), 256]
        np.add.at(want, (s[:-1], s[1:]), 1)
    assert (got == want).all()
    start = brown_lm.first_classes(got, 8)
    one = np.eye(9)[start]
    before = brown_lm.likelihood(one.T @ got @ one)
    classes, between = brown_lm.exchange(got, start, 8, 2)
    one = np.eye(9)[classes]
    assert np.allclose(between, one.T @ got @ one)          # kept up to date move by move
    assert brown_lm.likelihood(between) > before and classes[-1] == 8 and (classes[:-1] < 8).all()


@pytest.mark.parametrize("ranges", [8, 8192])
def test_words_of_one_slot_move_by_themselves(spark, monkeypatch, ranges):
    monkeypatch.setattr(brown_lm, "_WORD_RANGE", ranges)
    monkeypatch.setattr(brown_lm, "_HELD_COUNTS", 100 * ranges)
    monkeypatch.setattr(brown_lm, "BLOCK_TEXT", 20_000)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").repartition(4).withColumn("held_out", F.col("doc_id") % 5 == 0)
    blocks, totals, model = _fitted(spark, docs, 64, 8, limit=3000)
    count = {bytes(r.word): r["count"] for r in totals.collect() if r["count"] and r.word}
    own = {w: int(k) for w, k in zip(model.vocabulary.tolist(), model.word_classes)}
    ranked = sorted(count.values(), reverse=True)
    least = min(c for c in set(ranked) if sum(x >= c for x in ranked) <= 3000)
    assert set(own) == {int(brown_lm.word_hashes([w])[0]) for w, c in count.items() if c >= least}
    kinds = {w: _class_of(model, w) for w in count}
    by_slot = {}
    for w in count:
        by_slot.setdefault(int(brown_lm.word_slots([w], 64)[0]), set()).add(kinds[w])
    assert model.moved > 100 and sum(len(k) > 1 for k in by_slot.values()) > 32
    want = np.zeros((9, 9))
    for r in docs.where("doc_id % 5 <> 0").collect():
        k = [8, *(kinds[w.encode()] for w in _words(r.text)), 8]
        np.add.at(want, (k[:-1], k[1:]), 1)
    classes = brown_lm.Classes(model.classes, model.vocabulary, model.word_classes)
    assert (brown_lm.class_bigrams(blocks, classes, 9) == want).all()
    assert np.allclose(10 ** model.log_transition, (want + 1) / (want.sum(1, keepdims=True) + 9))
    one = np.eye(9)[model.classes]
    assert brown_lm.likelihood(want) > brown_lm.likelihood(one.T @ brown_lm.slot_bigrams(blocks, 64) @ one)
    sizes = np.zeros(9)
    for w, n in count.items():
        sizes[kinds[w]] += n
    assert (model.class_tokens[:-1] == sizes[:-1]).all() and model.class_words[:-1].sum() == len(count)


def test_moves_that_lower_the_likelihood_are_halved(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").withColumn("held_out", F.lit(False))
    monkeypatch.setattr(brown_lm, "word_moves", lambda contexts, classes, between: np.where(
        np.arange(classes.words.size) % 2 == 0, (classes.words + 1) % 7, classes.words).astype(np.uint8))
    _, _, model = _fitted(spark, docs, 64, 8, limit=500)         # bad moves: few or none stay
    assert model.moved < 60


def test_scores_of_odd_rows(spark):
    out = brown_lm.brown_scores(_odd(spark), slots=64, n_classes=4)
    assert out.count() == 8 and all(math.isfinite(r.score) and r.score <= 0 for r in out.collect())
    assert {r.n_tokens for r in out.where("doc_id IN (2, 3, 7)").collect()} == {1}
    unseen = brown_lm.brown_scores(_odd(spark), held_out=F.lit(True), slots=64, n_classes=4).collect()
    assert {(r.train_tokens, r.n_known) for r in unseen} == {(0, 0)}
    assert brown_lm.brown_scores(_odd(spark).limit(0), slots=64, n_classes=4).count() == 0


# --- language ID -----------------------------------------------------------------

def test_held_out_languages(spark):
    out = queries.op6_crf_language(spark, SF_ORACLE)
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "lang")
    held = out.where("held_out").join(docs, "doc_id").toPandas()
    assert len(held) > 100 and (held.lang_pred == held.lang).mean() > 0.95
    assert out.where("score < 0 OR score > 1").count() == 0


def _toy():
    en = ["the house and the tree with wings", "that thing with the other thing", "when they think that"]
    de = ["das haus und der baum schicht", "ich dachte nicht an dich", "durch die nacht schlich ich"]
    return crf_lang.train(en * 4 + de * 4, ["en"] * 12 + ["de"] * 12)


def test_words_of_a_code_switched_text_keep_their_language():
    labels = dict(crf_lang.word_labels("the thing with the other ich dachte nicht durch die nacht", _toy()))
    assert labels["thing"] == labels["other"] == "en" and labels["dachte"] == labels["nacht"] == "de"


def test_marginals_equal_all_labellings():
    rng = np.random.default_rng(1)
    chains = np.repeat([0, 1, 2], [4, 1, 3])
    scores, start, trans = rng.normal(size=(8, 3)), rng.normal(size=3), rng.normal(size=(3, 3))
    got = crf_lang.marginals(scores, chains, start, trans)
    pairs = np.zeros((3, 3))
    for c in range(3):
        at = np.flatnonzero(chains == c)
        want, total, pair = np.zeros((at.size, 3)), 0.0, np.zeros((3, 3))
        for y in np.ndindex(*[3] * at.size):
            w = math.exp(start[y[0]] + sum(scores[t, k] for t, k in zip(at, y)) + sum(trans[a, b] for a, b in zip(y, y[1:])))
            total += w
            for i, k in enumerate(y):
                want[i, k] += w
            for a, b in zip(y, y[1:]):
                pair[a, b] += w
        assert np.allclose(got[at], want / total)
        pairs += pair / total
    inner = np.flatnonzero(np.diff(chains) == 0)
    assert np.allclose(crf_lang._pair_counts(scores, chains, inner, start, trans), pairs)


def test_language_of_odd_rows(spark):
    docs = _odd(spark).withColumn("lang", F.when(F.col("doc_id") == 1, "xx"))
    out = {(str(r.doc_id), r.lang_pred, r.score) for r in crf_lang.identify(docs).collect()}
    assert {("2", "und", 0.0), ("3", "und", 0.0), ("6", "und", 0.0), ("7", "und", 0.0)} <= out
    assert {d for d, lang, _ in out if lang == "xx"} == {"1", "5", "None"}
    nothing = crf_lang.identify(_odd(spark))
    assert {r.lang_pred for r in nothing.collect()} == {"und"} and nothing.columns[-2:] == ["lang_pred", "score"]
    assert crf_lang.identify(_odd(spark).limit(0)).count() == 0


def test_training_sample_is_bounded_per_language(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    found = Counter(r.lang for r in crf_lang.sample(docs, docs_per_label=20))
    assert set(found) == {"en", "de", "fr", "es"} and set(found.values()) == {20}


def test_every_language_is_learnt_however_many_there_are(spark):
    data = [(100 * k + i, f"l{k:02}", f"word{k} text{i}") for k in range(70) for i in range(3)]
    docs = spark.createDataFrame(data, "doc_id long, lang string, text string")
    found = Counter(r.lang for r in crf_lang.sample(docs, docs_per_label=2))
    assert set(found) == {f"l{k:02}" for k in range(70)} and set(found.values()) == {2}


def test_rows_of_one_id_do_not_take_other_languages_places(spark):
    data = [(None, "aa", f"text {i}") for i in range(300)] + [(7, "bb", "copy")] * 50 + [
        (i, "bb", f"other {i}") for i in range(100, 130)] + [(None, "cc", f"third {i}") for i in range(40)]
    docs = spark.createDataFrame(data, "doc_id long, lang string, text string")
    found = crf_lang.sample(docs, docs_per_label=10)
    assert Counter(r.lang for r in found) == {"aa": 10, "bb": 10, "cc": 10}
    assert len({(r.lang, r.text) for r in found}) == 30


# --- pipeline -------------------------------------------------------------------

def test_stages_keep_the_columns_and_decide_as_the_operators_do(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    junk = spark.createDataFrame([(10**6, "... 12 !", None, "s", 8), (10**6 + 1, None, None, "s", 0)], docs.schema)
    before = docs.unionByName(junk)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = scratch.stored(stage(spark, before, SF_SMALL), name)
        assert after.columns == docs.columns
        ids = [r.doc_id for r in after.select("doc_id").collect()]
        if name == "language":
            assert sorted(ids) == sorted(r.doc_id for r in docs.select("doc_id").collect())
        elif name == "line_dedup":
            want = _dedup_by_hand([(r.doc_id, r.text) for r in before.collect()], 10, "none")
            assert sorted((r.doc_id, r.text) for r in after.collect()) == [w[:2] for w in want]
            assert after.where("n_chars <> length(text)").count() == 0
        else:
            prints = [_fingerprint_by_hand(r.text) for r in before.collect()]
            own = [r.doc_id for r in before.collect()]
            assert sorted(ids) == sorted(set(_components_by_hand(prints, own, 3)))
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, before, SF_SMALL)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in before.select("doc_id").collect()}


def test_language_stage_rejects_junk_and_unlearnt_languages_and_keeps_mixtures(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    clean = [r.text for r in docs.where("length(text) > 200").orderBy("doc_id").limit(40).collect()]
    half = [a[:len(a) // 2] + "\n" + b[len(b) // 2:] for a, b in zip(clean[::2], clean[1::2])]
    junk = ["xqzt kjw vvbz qqpl zzxw kqj wvx", "Это русское предложение о погоде и природе", "zxcvb qwrtp lkjhg mnbvc " * 50,
            "中文 句子 测试 文本 语言", "qqq", "Ωμέγα άλφα βήτα γάμμα"]
    odd = [(10**6 + i, t, None, "s", len(t)) for i, t in enumerate(half + junk)]
    kept = corpus_pipeline.language(spark, docs.unionByName(spark.createDataFrame(odd, docs.schema)), SF_SMALL)
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert ids >= {r.doc_id for r in docs.select("doc_id").collect()}
    assert ids >= {10**6 + i for i in range(len(half))}
    short = 10**6 + len(half) + junk.index("qqq")           # one word decides nothing
    assert {i for i in ids if i >= 10**6 + len(half)} <= {short}


def test_language_without_held_out_documents_rejects_letterless_texts_only(spark):
    docs = _docs(spark, ["one two", "xq zz", "...", None]).withColumn("lang", F.when(F.col("doc_id") == 1, "en"))
    got = {r.doc_id: r.lang_pred for r in crf_lang.identify(docs, least_familiar=0.7).collect()}
    assert got == {1: "en", 2: "en", 3: "und", 4: "und"}
    assert crf_lang.identify(docs.limit(0), least_familiar=0.7).count() == 0


def test_run_gives_the_rows_of_its_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.stored(stage(spark, docs, SF_SMALL), name)
    cols = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert rows(corpus_pipeline.run(spark, SF_SMALL), *cols) == rows(docs, *cols)


def test_scratch_tables_can_be_cleared(spark):
    before = scratch.stored(_docs(spark, ["a"]), "x")
    assert before.count() == 1 and scratch.clear() >= 1
    assert isinstance(pa.array([1]), pa.Array)
