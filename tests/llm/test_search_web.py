"""Nearest neighbours and revisit resolution against brute force."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlake.llm import ann, queries, warc
from tests.conftest import SF_SMALL, rows

# --- nearest neighbours ----------------------------------------------------------


def _exact(ids, x, queries_at, k):
    out = {}
    for i in queries_at:
        s = (x * x[i]).sum(axis=1)
        others = ids != ids[i]
        order = np.lexsort((ids[others], -s[others]))[:k]
        out[int(ids[i])] = list(zip(ids[others][order].tolist(), s[others][order].tolist()))
    return out


def _frame(spark, ids, x):
    return spark.createDataFrame([(int(i), [float(c) for c in v]) for i, v in zip(ids, x)],
                                 "vec_id long, embedding array<double>")


def _recall(out, want):
    got = {}
    for r in out.collect():
        got.setdefault(r.query_id, []).append(r)
    hits = total = 0
    for q, near in want.items():
        mine = sorted(got[q], key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, len(near) + 1))
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
        hits += len({v for v, _ in near} & {r.vec_id for r in mine})
        total += len(near)
    assert set(got) == set(want)
    return hits / total


def test_recall_and_exact_scores_on_the_table(spark):
    t = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").orderBy("vec_id").toPandas()
    ids, x = t.vec_id.to_numpy(), np.stack(t.embedding.to_numpy()).astype(float)
    out = queries.op9_adaptive_scan(spark, SF_SMALL)
    assert _recall(out, _exact(ids, x, np.flatnonzero(ids % 20 == 0), 20)) >= 0.9
    place = {int(i): n for n, i in enumerate(ids)}
    for r in out.collect():
        assert r.score == pytest.approx(float(x[place[r.query_id]] @ x[place[r.vec_id]]), abs=1e-12)


@pytest.mark.parametrize("norms", ["equal", "varied"])
def test_recall_with_many_groups_blocks_and_lists(spark, norms, monkeypatch):
    monkeypatch.setattr(ann, "GROUP_ROWS", 300)
    monkeypatch.setattr(ann, "BLOCK_ROWS", 40)
    monkeypatch.setattr(ann, "SAMPLE_ROWS", 700)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(2500, 24)) + 2 * rng.normal(size=(20, 24))[rng.integers(0, 20, 2500)]
    if norms == "equal":
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[500:1400] = x[500]                           # one very common vector: its list is split
    ids = rng.permutation(2500)
    out = ann.nearest(_frame(spark, ids, x).repartition(5), F.col("vec_id") % 25 == 0, k=10)
    assert _recall(out, _exact(ids, x, np.flatnonzero(ids % 25 == 0), 10)) >= 0.9


def test_scan_abandons_pairs_but_keeps_the_near_ones():
    rng = np.random.default_rng(6)
    q, c = rng.normal(size=(30, 64)), rng.normal(size=(400, 64))
    d = ann.distances(q, c)
    limit = np.sort(d, axis=1)[:, 9]
    found = set(zip(*(a.tolist() for a in ann.scan(q, c, limit))))
    near = set(zip(*(a.tolist() for a in np.nonzero(d <= limit[:, None]))))
    assert found <= near and len(found) >= 0.97 * len(near)


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    data = [(1, [1.0, 0.0]), (2, [0.5, 0.5]), (2, [0.9, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (8, []), (None, [1.0, 1.0]), (9, [1.0, 0.0]), (10, [1.0, 2.0, 3.0]), (11, [-1.0, 0.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").withColumns(
        {"rank": F.lit("a"), "score": F.lit("b"), "list": F.lit(1), "v": F.lit(2)})
    out = ann.nearest(df, F.col("vec_id").isin(1, 3, 4, 10), k=20)
    assert rows(out) == sorted([(1, 1, 9, 1.0), (1, 2, 2, 0.9), (1, 3, 11, -1.0)], key=repr)
    assert ann.nearest(df.limit(0)).count() == 0
    assert ann.nearest(df.where("vec_id IN (3, 4)")).count() == 0


@pytest.mark.parametrize("copies", [2, 30])
def test_copies_of_rows_take_no_neighbours_place(spark, copies):
    rng = np.random.default_rng(8)
    ids, x = np.arange(400), rng.normal(size=(400, 12))
    want = _exact(ids, x, range(0, 400, 20), 20)
    out = ann.nearest(_frame(spark, np.tile(ids, copies), np.tile(x, (copies, 1))), F.col("vec_id") % 20 == 0, k=20)
    assert _recall(out, want) >= 0.95 and out.count() == 20 * 20


def test_an_id_with_many_vectors_is_one_neighbour(spark, monkeypatch):
    monkeypatch.setattr(ann, "SAMPLE_ROWS", 200)
    rng = np.random.default_rng(9)
    ids, x = np.arange(300), rng.normal(size=(300, 12))
    near = x[0] * 3 + rng.normal(size=(60, 12)) / 100        # one id, 60 vectors, the best of query 0
    out = ann.nearest(_frame(spark, [*ids, *[999] * 60], np.vstack([x, near])), F.col("vec_id") == 0, k=20).collect()
    best = sorted(((x[1:] @ x[0]).tolist()), reverse=True)[:19]
    assert len(out) == 20 and [r.vec_id for r in out].count(999) == 1
    assert out[[r.rank for r in out].index(1)].vec_id == 999
    assert len({round(b, 9) for b in best} & {round(r.score, 9) for r in out}) >= 17


# --- revisits --------------------------------------------------------------------

T0 = dt.datetime(2024, 1, 1)


def _records(spark, data):
    return spark.createDataFrame(
        [(i, kind, uri, T0 + dt.timedelta(seconds=at) if at is not None else None, status, headers, body)
         for i, kind, uri, at, status, headers, body in data],
        "record_id string, record_type string, uri string, date timestamp, status int, "
        "headers map<string,string>, payload string")


def test_canonical_urls(spark):
    cases = {
        "HTTP://WWW.Example.com:80": "example.com/", "https://example.com:443/a?b=2&a=1#x": "example.com/a?a=1&b=2",
        "http://example.com:443/": "example.com:443/", "http://u:p@example.com/A/?": "example.com/A/",
        " https://example.com/?&&z ": "example.com/?z", "not a url": "not a url", "": "",
    }
    df = spark.createDataFrame([(u,) for u in cases], "u string").select("u", warc.canonical_url(F.col("u")).alias("c"))
    assert {r.u: r.c for r in df.collect()} == cases
    assert spark.sql("SELECT CAST(NULL AS STRING) AS u").select(warc.canonical_url(F.col("u"))).first()[0] is None


def test_validators_ties_and_merged_headers(spark):
    page = "http://a.example/p"
    out = warc.resolve_revisits(_records(spark, [
        ("r1", "response", page, 10, 200, {"ETag": '"1"', "Server": "s", "Content-Length": "5", "etag": '"2"'}, "old"),
        ("r2", "response", page, 20, 200, {"ETag": '"3"', "Last-Modified": "L"}, "new"),
        ("r3", "response", page, 25, 404, {"ETag": '"9"'}, "gone"),
        ("r4", "response", page, 20, 200, {"ETag": '"4"'}, "tie"),
        ("v1", "revisit", "HTTP://A.EXAMPLE:80/p#x", 15, 304,
         {"Etag": 'W/"2"', "Content-Length": "0", "Cache-Control": "c", "X-Cache": "h"}, None),
        ("v2", "revisit", page, 30, 304, {"ETag": '"3"'}, None),
        ("v3", "revisit", page, 20, 304, {"ETag": '"2"'}, None),       # strictly earlier only
        ("v4", "revisit", page, 10, 304, {"ETag": '"2"'}, None),
        ("v5", "revisit", page, 30, 304, {}, None),
        ("v6", "revisit", None, 30, 304, {"ETag": '"3"'}, None),
        ("v7", "revisit", page, None, 304, None, None),
        ("v2", "revisit", page, 30, 304, {"ETag": '"4"'}, None),
        ("m", "metadata", page, 30, None, None, None),
    ]).withColumn("bucket", F.lit("clash")))
    got = {(r.record_id, r.outcome, r.response_id, r.payload) for r in out.collect()}
    assert got == {("v1", "resolved", "r1", "old"), ("v2", "mismatch", "r4", None), ("v2", "resolved", "r4", "tie"),
                   ("v3", "resolved", "r1", "old"), ("v4", "no_response", None, None),
                   ("v5", "no_validator", "r4", None), ("v6", "no_response", None, None),
                   ("v7", "no_response", None, None)}
    merged = out.where("record_id = 'v1'").first().headers
    assert merged == {"etag": 'W/"2"', "server": "s", "content-length": "5", "cache-control": "c"}


@pytest.mark.parametrize("bucket_seconds", [7, 100, 10**6])
def test_as_of_join_equals_brute_force_for_any_bucket(spark, bucket_seconds):
    rng = np.random.default_rng(bucket_seconds)
    data = []
    for i in range(400):
        url = f"http://x.example/{0 if rng.random() < 0.5 else rng.integers(20)}"      # one hot URL
        at = int(rng.integers(0, 300))
        if rng.random() < 0.4:
            data.append((f"r{i}", "response", url, at, 200, {"ETag": f'"{i % 3}"'}, f"body {i}"))
        else:
            data.append((f"v{i}", "revisit", url, at, 304, {"ETag": f'"{i % 3}"'}, None))
    want = []
    for i, kind, url, at, _, head, _ in data:
        if kind == "revisit":
            earlier = [(a, r, h["ETag"]) for r, k, u, a, _, h, _ in data if k == "response" and u == url and a < at]
            last = max(earlier, default=None)
            want.append((i, last[1] if last else None,
                         "no_response" if not last else "resolved" if last[2] == head["ETag"] else "mismatch"))
    out = warc.resolve_revisits(_records(spark, data), bucket_seconds=bucket_seconds)
    assert rows(out, "record_id", "response_id", "outcome") == sorted(want, key=repr)
    assert warc.resolve_revisits(_records(spark, [])).count() == 0


def test_query_matches_its_sql(spark):
    from postlake.oracle.compare import duck_connection, duck_rows, spark_rows
    con = duck_connection(SF_SMALL, ["documents", "pages"])
    for name in ("op2_line_dedup", "op7_warc_revisits"):
        assert spark_rows(queries.QUERIES[name](spark, SF_SMALL)) == duck_rows(con, queries.ORACLE[name])
