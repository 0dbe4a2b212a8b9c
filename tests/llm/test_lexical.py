"""Ranked lexical search against scores of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from postlake.llm import lexical as lx
from postlake.llm import queries
from tests.conftest import SF_SMALL, rows


def _terms(s):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s or "")
    return re.findall(lx.TERM, lowered)


def _by_hand(docs, items, k):
    held = [(i, Counter(_terms(t)), len(_terms(t))) for i, t in docs]
    held = [h for h in held if h[2]]
    n, total = len(held), sum(h[2] for h in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, tfs, size in held:
            m = 100 - 75 + (75 * size * n) // total
            score = 0
            for t in _terms(text):
                if t in tfs:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * tfs[t]) // (1000 * tfs[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc is not None, doc or 0, doc))
        scored.sort(key=lambda x: x[:3])
        out += [(item, rank, doc, -s) for rank, (s, _, _, doc) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


def _frames(spark, docs, items):
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(items, "item_id long, text string"))


def _corpus(seed, n):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["the", "of", "Éa", "É", "x1"]
    weights = [1 / (i + 1) for i in range(60)] + [3, 2, .2, .1, .1]
    text = lambda lo, hi: " ".join(rnd.choices(words, weights, k=rnd.randint(lo, hi)))
    docs = [(i, text(0, 40)) for i in range(n)]
    docs += [(n + i, docs[3][1]) for i in range(15)]              # ties
    items = [(i, text(1, 12)) for i in range(12)] + [(50, docs[3][1]), (51, docs[3][1])]
    return docs, items


def test_op11_equals_brute_force_on_the_tables(spark):
    docs, items = ([tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/{t}.parquet").select(c, "text").collect()]
                   for t, c in (("documents", "doc_id"), ("benchmark", "item_id")))
    got = rows(queries.op11_lexical_search(spark, SF_SMALL))
    assert got == _by_hand(docs, items, 10) and len(got) > 100


@pytest.mark.parametrize("query_terms", [1 << 16, 20])
def test_small_segments_blocks_and_query_blocks(spark, monkeypatch, query_terms):
    monkeypatch.setattr(lx, "SEGMENT_CELLS", 1)                  # 64 documents a segment
    monkeypatch.setattr(lx, "QUERY_TERMS", query_terms)
    monkeypatch.setattr(lx, "BLOCK_DOCS", 4)
    docs, items = _corpus(5, 700)
    d, q = _frames(spark, docs, items)
    assert rows(lx.search(d.repartition(3), q, k=7)) == _by_hand(docs, items, 7)


def test_summaries_bound_every_document_and_skip_blocks():
    docs, items = _corpus(8, 1500)
    block = lx.QueryBlock.of([(str(i), _terms(t)) for i, t in items])
    tfs = [Counter(t for t in _terms(x) if t.encode() in set(block.vocabulary)) for _, x in docs]
    x = np.zeros((len(docs), len(block.vocabulary)), dtype=np.uint32)
    for i, c in enumerate(tfs):
        for t, n in c.items():
            x[i, block.vocabulary.index(t.encode())] = 1000 * n // (n + len(c))
    weights = 1 + np.arange(x.shape[1])
    lists, list_blocks, block_docs, members, maxima = [], [], [], [], []
    for t, blocks in lx.cluster_lists(x, weights, 1):
        assert sorted(np.concatenate(blocks)) == np.flatnonzero(x[:, t]).tolist()
        lists.append(t)
        list_blocks.append(len(blocks))
        for b in blocks:
            top = x[np.ix_(b, block.columns[t])].max(axis=0)
            assert (x[np.ix_(b, block.columns[t])] <= top).all()
            block_docs.append(len(b))
            members.append(b)
            maxima.append(top)
    held = (x > 0).sum(axis=1)
    doc, term = np.nonzero(x)
    pack = lambda a: lx._pack(np.asarray(a))
    row = {"doc_ids": [i for i, _ in docs], "held": pack(held), "terms": pack(term), "impacts": pack(x[doc, term]),
           "lists": pack(lists), "list_blocks": pack(list_blocks), "block_docs": pack(block_docs),
           "members": pack(np.concatenate(members)), "maxima": pack(np.concatenate(maxima))}
    segment = lx.Segment(row, block.columns)
    skipped = 0
    for terms, counts in zip(block.terms, block.counts):
        asked, best = weights[terms] * counts, lx.Best(5)
        total, opened, scored = segment.search(terms, asked, best)
        skipped += total - opened
        every = x[:, terms].astype(np.int64) @ asked
        want = sorted((-s, i) for s, (i, _) in zip(every.tolist(), docs) if s > 0)[:5]
        assert list(zip((-best.score).tolist(), best.doc.tolist())) == want
    assert skipped > 0


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "...!"), (4, "Alpha beta"), (4, "alpha BETA"), (None, "alpha beta"), (5, "É éa a" * 9),
            (6, "long " * 40_000 + "alpha"), (7, "a0b\x00c")]
    items = [(1, "ALPHA"), (1, "alpha"), (2, None), (3, "!!"), (4, "nowhere"), (5, "É"), (None, "long long c"), (8, "beta alpha " * 50)]
    d, q = _frames(spark, docs, items)
    clash = {c: F.lit("x") for c in ("score", "rank", "key", "segment", "item_id")}
    d, q = d.withColumns(clash), q.withColumns({c: F.lit(1) for c in ("doc_id", "score", "rank", "terms", "key", "query")})
    assert rows(lx.search(d, q, k=3)) == _by_hand(docs, items, 3)
    assert lx.search(d.limit(0), q).count() == 0 and lx.search(d, q.limit(0)).count() == 0
    assert lx.search(d, q, k=3).columns == ["item_id", "rank", "doc_id", "score"]


def test_terms_of_bytes_equal_the_pattern():
    texts = ["aB1 c-d", None, "", "é.É x", "\x7fz", "日本 a\nb"]
    words, index, sizes = lx.split_terms(pa.array(texts))
    found = [words[i].as_py().decode() for i in index]
    assert found == [t for x in texts for t in _terms(x)] and sizes.tolist() == [len(_terms(x)) for x in texts]
