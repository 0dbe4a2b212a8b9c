"""The state of latest versions, lexicon tables and sketches."""

import datetime as dt

from pyspark.sql import functions as F

from postlake.functions import text_ai as AI
from postlake.operators import gold as G
from postlake.plans import versions as V
from postlake.schemas import RAW_SUBMISSIONS
from postlake.sinks import tables as ST

DAYS = [dt.date(2025, 6, 29) + dt.timedelta(days=i) for i in range(4)]


def _raw(spark, rows):
    """``(id, day number, load second)`` as raw rows."""
    base = {f.name: None for f in RAW_SUBMISSIONS.fields}
    data = [dict(base, submission_id=i, ds=DAYS[d], created_utc_unix=5, score=1, title=f"t{t}",
                 _loaded_at_timestamp_utc=dt.datetime(2025, 6, 29) + dt.timedelta(seconds=t)) for i, d, t in rows]
    return spark.createDataFrame([tuple(r[f.name] for f in RAW_SUBMISSIONS.fields) for r in data], RAW_SUBMISSIONS)


def _land(spark, path, day, rows):
    ST.replace_partition(_raw(spark, [r for r in rows if r[1] == day]), path, DAYS[day])


def _winners(change):
    return {(r.submission_id, DAYS.index(r.ds)) for r in change.winners.collect()}


def test_days_merge_replace_and_empty(spark, tmp_path):
    raw, state = str(tmp_path / "raw"), str(tmp_path / "state")
    rows = [("a", 0, 1), ("b", 0, 1), ("c", 0, 9), ("a", 1, 2), ("c", 1, 3), (None, 1, 3), ("d", 2, 1), ("a", 2, 1)]
    built = []
    for day, moved in ((0, []), (1, [0]), (2, [])):
        _land(spark, raw, day, rows)
        change = V.change(spark, raw, state, [DAYS[day]], built)
        assert change.days == [DAYS[d] for d in sorted({day, *moved})]
        change.commit()
        built.append(DAYS[day])
    assert _winners(change) == {("d", 2)}                       # a's version of day 1 is later
    _land(spark, raw, 1, [("c", 1, 99)])                        # a leaves day 1, c moves to it
    change = V.change(spark, raw, state, [DAYS[1]], built)
    assert change.days == DAYS[:3] and _winners(change) == {("b", 0), ("c", 1), ("d", 2), ("a", 2)}   # equal: the later day
    again = V.change(spark, raw, state, [DAYS[1]], built)       # not committed: found again
    assert again.days == change.days
    again.commit()
    _land(spark, raw, 1, [])
    change = V.change(spark, raw, state, [DAYS[1]], built)
    assert ("c", 0) in _winners(change) and DAYS[0] in change.days
    change.commit()
    kept = spark.read.parquet(state)
    assert kept.where(F.col("ds") == F.lit(DAYS[1])).count() == 0 and kept.count() == 5


def test_a_day_reads_its_own_raw_rows_and_touched_buckets_only(spark, tmp_path):
    raw, state = str(tmp_path / "raw"), str(tmp_path / "state")
    first = [(f"id{i}", i % 3, i) for i in range(60)]
    for day in range(3):
        _land(spark, raw, day, first)
    V.change(spark, raw, state, DAYS[:3], []).commit()
    _land(spark, raw, 3, [("new", 3, 100)])
    bucket = V.day_versions(_raw(spark, [("new", 3, 1)])).first().bucket
    for path in [p for d in DAYS[:3] for p in (tmp_path / "raw" / f"ds={d}").glob("*.parquet")]:
        path.write_bytes(b"unreadable")
    for path in (tmp_path / "state").glob("bucket=*/*.parquet"):
        if path.parent.name != f"bucket={bucket}":
            path.write_bytes(b"unreadable")
    change = V.change(spark, raw, state, [DAYS[3]], DAYS[:3])
    assert change.buckets == [bucket] and change.days == [DAYS[3]] and _winners(change) == {("new", 3)}
    change.commit()


def test_lexicon_table_equals_the_rule_and_takes_odd_words(spark):
    texts = ["I love this bad game", "GREAT fun", "hate", "nothing here", "", None, "lovely", "good-bad"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    want = {r.k: r.s for r in df.select("k", AI.ai_sentiment("t").alias("s")).collect()}
    got = AI.lexicon_sentiment(df, ["k"], "t", AI.default_lexicon(spark))
    assert {r.k: r.ai_sentiment for r in got.collect()} == want
    odd = spark.createDataFrame([("Love", 2.5), ("love", -0.5), ("fun", 0.0), (None, 1.0), ("hate", None), ("bad", -4.0)],
                                "word string, weight double")
    by = {r.k: (r.ai_sentiment, r.positive, r.negative) for r in AI.lexicon_sentiment(df, ["k"], "t", odd).collect()}
    assert by[0] == ("mixed", 2.0, 4.0) and by[1][0] == "neutral" and by[2][0] == "neutral" and by[5][0] is None
    assert AI.lexicon_sentiment(df.limit(0), ["k"], "t", odd).count() == 0
    assert {r.ai_sentiment for r in AI.lexicon_sentiment(df, ["k"], "t", odd.limit(0)).collect()} == {"neutral", None}


def test_sketches_merge_and_stay_within_their_error(spark):
    df = spark.range(60_000).selectExpr("id % 6 AS day", "concat('u', id % 25000) AS author", "id % 9 AS topic")
    names = {"authors": "author", "topics": "topic"}
    daily = G.distinct_sketches(df, ["day"], names)
    merged = G.distinct_estimates(G.merge_sketches(daily, [], names), [], names).first()
    at_once = G.distinct_estimates(G.distinct_sketches(df, [], names), [], names).first()
    assert merged == at_once and merged.topics == 9
    assert abs(merged.authors - 25_000) <= G.SKETCH_ERROR * 25_000


def test_built_in_lexicon_is_local_and_finds_whole_words_only(spark):
    lexicon = AI.default_lexicon(spark)
    assert lexicon.isLocal()                      # its size is known: a join with it is planned as a broadcast
    texts = ["love, LOVE lovely", "good-bad", "goodbad", "xgood good", "éfun", None, "", "bad"]
    df = spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts)], "k int, t string")
    words = [r.word for r in lexicon.collect()]
    want = df.select("t", F.array_sort(F.array_intersect(F.array_distinct(AI.tokens("t")), F.lit(words))).alias("w"))
    got = df.select("t", F.array_sort(AI.found_words("t", words)).alias("w"))
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]
    shuffled = AI.lexicon_sentiment(df, ["k"], "t", spark.createDataFrame(lexicon.collect(), lexicon.schema))
    scored = AI.lexicon_sentiment(df, ["k"], "t", lexicon)
    assert sorted(map(tuple, scored.collect()), key=repr) == sorted(map(tuple, shuffled.collect()), key=repr)
