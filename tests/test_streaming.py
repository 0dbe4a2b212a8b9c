from postlake.schemas import RAW_SUBMISSIONS, TABLES
from postlake.sinks import tables as ST
from postlake.sources.fixtures import submission_records_fx
from postlake.sources.landing import land_submissions
from postlake.streaming import landing_stream as LS
from tests.conftest import SF_SMALL, rows


def test_stream_landing_equals_batch_landing(spark, tmp_path):
    src = str(tmp_path / "incoming")
    records = submission_records_fx(spark, SF_SMALL)
    records.repartition(3).write.json(src)
    q = LS.start_landing(spark, src, str(tmp_path / "raw"), str(tmp_path / "ckpt"))
    q.awaitTermination(300)
    got = ST.scan_full(spark, str(tmp_path / "raw"), RAW_SUBMISSIONS)   # without the batch id
    want = land_submissions(spark.read.schema(records.schema).json(src))
    assert rows(got) == rows(want)
    # a second run finds nothing new: still exactly once
    q2 = LS.start_landing(spark, src, str(tmp_path / "raw"), str(tmp_path / "ckpt"))
    q2.awaitTermination(300)
    assert ST.scan_full(spark, str(tmp_path / "raw"), RAW_SUBMISSIONS).count() == len(rows(want))


def test_stream_landing_with_refresh_builds_gold(spark, tmp_path):
    src = str(tmp_path / "incoming")
    submission_records_fx(spark, SF_SMALL).write.json(src)
    raw, out = str(tmp_path / "raw"), str(tmp_path / "lake")
    q = LS.start_landing_with_refresh(spark, src, raw, out, str(tmp_path / "ckpt"))
    q.awaitTermination(600)
    trends = ST.scan_full(spark, f"{out}/gold_topic_trends", TABLES["gold_topic_trends"][0])
    assert trends.count() > 0


def test_stream_lands_comments_and_rejects_of_each_batch(spark, tmp_path):
    src = tmp_path / "incoming"
    src.mkdir()
    line = ('{"id":"%s","created_utc":1.0,"retrieved_utc":%d,"comments":[{"id":"%s-c","replies":[{"id":"%s-r"}]},{"id":null}]}')
    args = (str(src), str(tmp_path / "raw"), str(tmp_path / "ckpt"))
    extra = {"comments_path": str(tmp_path / "comments"), "rejects_path": str(tmp_path / "rejects")}
    days = []
    for n, name in enumerate("ab"):
        (src / f"{name}.json").write_text(line % (name, 86400 * (n + 1), name, name) + '\n{"id":\n')
        LS.start_landing(spark, *args, **extra, on_days=days.append).awaitTermination(300)
    assert sorted(r.submission_id for r in spark.read.parquet(args[1]).collect()) == ["a", "b"]
    assert sorted(r.comment_id for r in spark.read.parquet(extra["comments_path"]).collect()) == ["a-c", "a-r", "b-c", "b-r"]
    reasons = sorted(r._reject_reason for r in spark.read.parquet(extra["rejects_path"]).collect())
    assert reasons == ["bad_comment:missing:id"] * 2 + ["malformed_json"] * 2
    assert [[str(d) for d in x] for x in days] == [["1970-01-02"], ["1970-01-03"]]


def test_a_batch_that_runs_again_replaces_itself(spark, tmp_path):
    from postlake.sources.landing import parse_submission_json
    raw, rejects = str(tmp_path / "raw"), str(tmp_path / "rejects")
    lines = ['{"id":"a","created_utc":1.0,"retrieved_utc":86400}', '{"id":"b","created_utc":1.0,"retrieved_utc":172800}']
    parse = lambda x: parse_submission_json(spark.createDataFrame([(v,) for v in x], "value string"))
    LS._land_batch(parse([*lines, "broken"]), 4, raw, None, rejects, None)
    LS._land_batch(parse(lines[:1]), 4, raw, None, rejects, None)
    assert [r.submission_id for r in spark.read.parquet(raw).collect()] == ["a"]
