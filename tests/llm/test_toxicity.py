"""Multiple-instance toxicity: parts against brute force, held-out accuracy."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from postlake.llm import queries
from postlake.llm import toxicity as tx
from tests.conftest import SF_ORACLE, SF_SMALL

WORD = r"[0-9A-Za-z\u0080-\U0010FFFF]+"


def _sentences(text):
    found = [re.findall(WORD, "".join(c.lower() if c < "\x80" else c for c in s)) for s in re.split(r"[.!?\n\r]", text or "")]
    return [s for s in found if s] or [[]]


TEXTS = ["One two. Three!four\nfive", None, "", "...", "a.b?c", "no end", "É é. 日本!x", "a b\n\n c", "last."]


def test_sentences_equal_the_pattern():
    found = tx.split_sentences(pa.array(TEXTS))
    words = [w.decode() for w in found.words.to_pylist()]
    got = [[] for _ in range(found.doc.size)]
    for w, s in zip(found.index, found.sentence):
        got[s].append(words[w])
    want = [(i, s) for i, t in enumerate(TEXTS) for s in _sentences(t)]
    assert list(zip(found.doc.tolist(), got)) == want
    for (lo, hi), i, own in zip(found.span.tolist(), found.doc, got):
        piece = (TEXTS[i] or "").encode()[lo:hi].decode()
        assert [w for s in _sentences(piece) for w in s] == own


def test_parts_of_a_word_depend_on_the_word_alone():
    words = ["a", "idiots", "idiotic", "é", "stupid", "stupidity", "x" * 40]
    alone = [np.sort(tx.word_parts(pa.array([w.encode()]))[0]) for w in words]
    parts, at = tx.word_parts(pa.array([w.encode() for w in words]))
    for i, own in enumerate(alone):
        assert np.sort(parts[at[i]:at[i + 1]]).tolist() == own.tolist()
    assert len(set(alone[1]) & set(alone[2])) >= 3 and len(alone[0]) == 1
    texts = pa.array(["idiots x idiots", "idiots", "x"])
    counts = tx.part_documents(texts)
    assert counts[alone[1]].min() >= 2 and counts.sum() == 2 * len(alone[1]) + 2


def test_score_is_the_noisy_or_of_sentence_probabilities(spark):
    rng = np.random.default_rng(3)
    model = tx.Model(rng.normal(size=1 << tx.HASH_BITS), -1.0)
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for row in tx.score(docs, model).collect():
        clean, spans = 1.0, []
        for words in _sentences(row.text):
            z = model.bias + sum(model.weights[tx.word_parts(pa.array([w.encode()]))[0]].sum() for w in words)
            clean *= 1 - 1 / (1 + np.exp(-z))
            spans += [words] if words and z >= 0 else []
        assert row.score == pytest.approx(1 - clean, abs=1e-9) and row.predicted == int(row.score >= .5)
        assert row.n_sentences == len(_sentences(row.text))
        assert [[w for s in _sentences(row.text[o.start:o.start + o.length]) for w in s] for o in row.offending] == spans


def test_one_step_follows_the_gradient_of_the_likelihood(monkeypatch):
    monkeypatch.setattr(tx, "EPOCHS", 1)
    monkeypatch.setattr(tx, "DECAY", 0.0)
    texts, labels, weights = pa.array(["bad one. fine two", "fine two", "bad bad"]), np.array([True, False, True]), np.array([1., 2., .5])
    model = tx.Model(np.zeros(1 << tx.HASH_BITS), -1.0)

    def likelihood(m):
        found = tx.split_sentences(texts)
        lq = tx.noisy_or(tx.sentence_scores(m, found), found.doc, 3)
        return (weights * np.where(labels, np.log(-np.expm1(lq)), lq)).sum()

    out = tx.train_shard(model, texts, labels, weights)
    for part in np.unique(tx.word_parts(pa.array([b"bad", b"fine", b"one"]))[0]):
        moved = model.weights.copy()
        moved[part] += 1e-6
        slope = (likelihood(tx.Model(moved, -1.0)) - likelihood(model)) / 1e-6
        step = out.weights[part]
        assert step == pytest.approx(tx.RATE * slope / np.sqrt(tx.FIRST_SUM + slope ** 2), abs=1e-4)
    assert likelihood(out) > likelihood(model)


def _planted(n, seed):
    rnd = random.Random(seed)
    plain = [f"{a}{b}" for a in ("tor", "mel", "san", "kip", "ru") for b in ("an", "eth", "ol", "is", "um", "ade")]
    bad = ["grobian" + e for e in ("", "s", "en", "ish")] + ["nitwit", "nitwits"]
    rows = []
    for i in range(n):
        sentences = [" ".join(rnd.choices(plain, k=rnd.randint(4, 9))) for _ in range(rnd.randint(1, 12))]
        toxic, at = i % 4 == 0, None
        if toxic:
            at = rnd.randrange(len(sentences))
            words = sentences[at].split()
            words.insert(rnd.randrange(len(words)), rnd.choice(bad))
            sentences[at] = " ".join(words)
        rows.append((i, ". ".join(sentences) + ".", int(toxic), at))
    return rows


@pytest.fixture(scope="module")
def planted(spark):
    rows = _planted(1200, 7)
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int, place int").repartition(5)


def test_sentences_are_found_from_document_labels_alone(spark, planted):
    labels = planted.select("doc_id", "toxic")
    out = tx.toxicity(planted.select("doc_id", "text", "toxic", "place"), labels, train_on=F.col("doc_id") % 3 != 0).where("doc_id % 3 = 0").collect()
    right = [r.predicted == r.toxic for r in out]
    assert sum(right) >= 0.97 * len(out)
    hit = miss = 0
    for r in out:
        at = [len(re.split(r"\.", r.text[:o.start])) - 1 for o in r.offending]
        if r.toxic:
            hit += at == [r.place]
            miss += at != [r.place]
        else:
            assert len(at) <= 1
    assert hit >= 0.95 * (hit + miss)


def test_shards_and_a_small_sample_learn_too(spark, planted, monkeypatch):
    monkeypatch.setattr(tx, "SHARD_DOCS", 100)
    labels = planted.select("doc_id", "toxic")
    docs = planted.select("doc_id", "text")
    chosen = tx.sample(docs.unionByName(docs), labels, docs_per_label=200)
    counts = {r.toxic: r for r in chosen.groupBy("toxic").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w")).collect()}
    assert 140 <= counts[True].n <= 260 and 140 <= counts[False].n <= 260
    assert counts[False].w == pytest.approx(900, rel=.3) and counts[True].w == pytest.approx(300, rel=.3)
    first = tx.toxicity(docs, labels, docs_per_label=200).select("doc_id", "score")
    again = tx.toxicity(docs.repartition(2), labels.repartition(7), docs_per_label=200).select("doc_id", "score")
    assert sorted(first.collect()) == sorted(again.collect())         # whatever the partitions
    told = {r.doc_id: r.toxic for r in labels.collect()}
    assert sum((r.score >= .5) == told[r.doc_id] for r in first.collect()) >= 0.97 * 1200


def test_op12_on_the_tables(spark):
    out = queries.op12_toxicity_mil(spark, SF_ORACLE)
    n = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").count()
    got = out.collect()
    assert len(got) == n and all(0 <= r.score <= 1 and r.predicted == int(r.score >= .5) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    told = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_ORACLE}/labels.parquet").collect()}
    held = [(r.score, told[r.doc_id]) for r in got if r.held_out and r.doc_id in told]
    bad, good = [s for s, t in held if t], [s for s, t in held if not t]
    assert np.mean([b > g for b in bad for g in good]) >= 0.9         # few labels: the ranking
    assert np.mean([g < .5 for g in good]) >= 0.97


def test_odd_rows_and_no_labels(spark):
    data = [(1, None), (1, "same."), (1, "same."), (None, "x"), (3, ""), (4, "w " * 200_000), (5, "..!")]
    docs = spark.createDataFrame(data, "doc_id long, text string").withColumns(
        {c: F.lit("z") for c in ("score", "predicted", "offending", "h", "id", "weight")})
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, 0), (None, 1), (3, None), (9, 1)], "doc_id long, toxic int")
    out = tx.toxicity(docs, labels)
    assert out.columns == ["doc_id", "text", "h", "id", "weight", "score", "predicted", "n_sentences", "offending"]
    got = out.collect()
    assert len(got) == 7 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if not r.text or r.text == "..!"}) == 1
    none = tx.toxicity(docs, labels.limit(0)).collect()
    assert {round(r.score, 6) for r in none} == {round(1 / (1 + np.exp(-tx.FIRST_BIAS)), 6)}
    assert tx.toxicity(docs.limit(0), labels).count() == 0
