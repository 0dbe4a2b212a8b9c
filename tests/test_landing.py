from pyspark.sql import functions as F

from postlake.sources import landing as L
from postlake.sources.fixtures import nested_submissions_fx
from postlake.schemas import RAW_SUBMISSIONS, check_schema
from tests.conftest import SF_SMALL


def test_land_submissions_defaults(spark):
    rec = {f.name: None for f in L.SUBMISSION_RECORD.fields}
    rec.update(id="x1", created_utc=1751155200.9, retrieved_utc=1751158800)
    df = spark.createDataFrame([rec], L.SUBMISSION_RECORD)
    out = L.land_submissions(df)
    check_schema(out, RAW_SUBMISSIONS)
    r = out.first()
    assert (r.author_name, r.score, r.num_comments, r.upvote_ratio, r.selftext, r.edited,
            r.stickied, r.flair, r.permalink) == ("[deleted]", 0, 0, 0.0, "", "false", False, None, "")
    assert r.created_utc_unix == 1751155200 and r.created_utc == "2025-06-29T00:00:00"
    assert str(r.ds) == "2025-06-29"


def test_land_comments_keeps_latest_fetch(spark):
    base = {f.name: None for f in L.COMMENT_RECORD.fields}
    a = dict(base, id="c1", body="old", created_utc=1.0, retrieved_utc=10)
    b = dict(base, id="c1", body="new", created_utc=1.0, retrieved_utc=20)
    out = L.land_comments(spark.createDataFrame([a, b], L.COMMENT_RECORD)).collect()
    assert [(r.comment_id, r.body) for r in out] == [("c1", "new")]


def test_flatten_drops_more_stubs_and_keeps_parents(spark):
    nested = nested_submissions_fx(spark, SF_SMALL)
    flat = L.flatten_comments(nested)
    n_lines = nested.select(F.sum(F.size("comments"))).first()[0]
    n_more = nested.select(F.explode("comments").alias("c")).filter("c.kind = 'more'").count()
    assert flat.count() == n_lines - n_more
    assert flat.filter(F.col("parent_id").isNull() | F.col("submission_id").isNull()).count() == 0


def test_reject_reasons(spark):
    lines = spark.createDataFrame(
        [('{"id":"1","created_utc":1.0,"retrieved_utc":2,"score":"x"}',),
         ('{"id":"2","created_utc":1.0',),
         ('{"created_utc":1.0,"retrieved_utc":2}',),
         ('{"id":"3","created_utc":1.0,"retrieved_utc":2,"score":7}',)], "value string")
    good, bad = L.reject_bad_rows(L.parse_submission_json(lines))
    assert sorted(r._reject_reason for r in bad.collect()) == ["bad_type:score", "malformed_json",
                                                               "missing:id"]
    assert [(r.id, r.score) for r in good.collect()] == [("3", 7)]


def test_read_records_multi_path_and_land(spark, tmp_path):
    from postlake.sources.fixtures import submission_records_fx
    from tests.conftest import rows
    recs = submission_records_fx(spark, SF_SMALL)
    a, b = str(tmp_path / "sub_a"), str(tmp_path / "sub_b")
    recs.filter("subreddit = 'valorant'").write.json(a)
    recs.filter("subreddit <> 'valorant' OR subreddit IS NULL").write.json(b)
    back, bad = L.reject_bad_rows(L.read_records(spark, [a, b]))
    assert bad.count() == 0
    assert rows(L.land_submissions(back)) == rows(L.land_submissions(recs))


def test_flattened_comments_land_as_raw_comments(spark):
    from postlake.schemas import RAW_COMMENTS
    flat = L.flatten_comments(nested_submissions_fx(spark, SF_SMALL))
    landed = L.land_comments(flat.drop("position"))
    check_schema(landed, RAW_COMMENTS)
    assert landed.count() == flat.select("id").distinct().count()


def test_comment_limit_none_or_zero_keeps_all_and_run_date_is_applied(spark):
    import datetime as dt

    from postlake.operators.topk import limit_comments_per_submission
    from postlake.sources.fixtures import comment_records_fx
    landed = L.land_comments(comment_records_fx(spark, SF_SMALL), ds="2025-07-01")
    assert {r.ds for r in landed.select("ds").distinct().collect()} == {dt.date(2025, 7, 1)}
    n = landed.count()
    assert limit_comments_per_submission(landed, None).count() == n
    assert limit_comments_per_submission(landed, 0).count() == n
    per_sub = limit_comments_per_submission(landed, 2).groupBy("submission_id").count()
    assert per_sub.agg(F.max("count")).first()[0] == 2


GOOD = ('{"id":"%s","subreddit":"valorant","created_utc":1751155200.0,"retrieved_utc":1751158800,"score":7,'
        '"edited":%s,"comments":[{"id":"%s-c","body":"hi","created_utc":1.0},{"kind":"more"}]}')


def test_dirty_file_keeps_existing_days_and_counts_rejects(spark, tmp_path):
    from postlake.__main__ import main
    raw, comments = str(tmp_path / "raw"), str(tmp_path / "comments")
    first, second = tmp_path / "a", tmp_path / "b"
    first.mkdir()
    second.mkdir()
    (first / "x.json").write_text(GOOD % ("1", "false", "1") + "\n")
    (second / "y.json").write_text('{"id":"2","created_utc":17511\n' + '{"id":"3","created_utc":1.0,"score":"n/a"}\n')
    assert main(["land", "--records", str(first), "--raw", raw, "--comments", comments])["rows"] == 1
    res = main(["land", "--records", str(second), "--raw", raw, "--comments", comments])
    assert (res["read"], res["rows"], res["rejected"]) == (2, 0, 2)
    assert [(r.submission_id, r.edited, str(r.ds)) for r in spark.read.parquet(raw).collect()] == [
        ("1", "False", "2025-06-29")]
    assert [r.comment_id for r in spark.read.parquet(comments).collect()] == ["1-c"]
    assert sorted(r._reject_reason for r in spark.read.parquet(raw + "_rejects").collect()) == [
        "bad_type:score", "malformed_json"]


def test_edited_boolean_number_and_missing(spark):
    from postlake.operators.bronze import bronze_project
    from postlake.functions.rules import flag_edited
    lines = spark.createDataFrame([(GOOD % (str(i), e, str(i)),) for i, e in enumerate(
        ["false", "true", "1751155999.0", "null", "1751155999"])], "value string")
    good, bad = L.reject_bad_rows(L.parse_submission_json(lines))
    assert bad.count() == 0
    out = bronze_project(L.land_submissions(good)).select("submission_id", "edited", flag_edited("edited").alias("f"))
    assert rows_by_id(out) == {"0": ("False", False), "1": ("True", True), "2": ("1751155999.0", True),
                               "3": ("false", True), "4": ("1751155999", True)}


def rows_by_id(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


def test_comment_limit_goes_by_position_without_a_shuffle(spark):
    nested = nested_submissions_fx(spark, SF_SMALL)
    flat = L.flatten_comments(nested, limit=3)
    assert "Exchange" not in flat._jdf.queryExecution().executedPlan().toString()
    kept = {r.submission_id: r.n for r in flat.groupBy("submission_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    every = {r.submission_id: r.n for r in L.flatten_comments(nested).groupBy("submission_id").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    assert kept == {k: min(3, n) for k, n in every.items()}


def test_comments_of_two_days_land_together_as_one_by_one(spark):
    base = {f.name: None for f in L.COMMENT_RECORD.fields}
    recs = [dict(base, id="c1", body=b, created_utc=1.0, retrieved_utc=t) for b, t in (("a", 10), ("b", 20), ("c", 90000))]
    out = L.land_comments(spark.createDataFrame(recs, L.COMMENT_RECORD)).collect()
    assert sorted((str(r.ds), r.body) for r in out) == [("1970-01-01", "b"), ("1970-01-02", "c")]


def test_fetch_limits_per_subreddit(spark):
    from postlake.plans.landing import limit_records
    from postlake.sources.fixtures import submission_records_fx
    recs = submission_records_fx(spark, SF_SMALL)
    for kw in ({"newest": 4}, {"top": 4}):
        out = limit_records(recs, **kw)
        assert out.groupBy("subreddit").count().agg(F.max("count")).first()[0] <= 4


def test_a_bad_comment_leaves_its_record_and_landing_again_changes_nothing(spark, tmp_path):
    from postlake.plans.landing import land_files
    src = tmp_path / "in"
    src.mkdir()
    one = ('{"id":"x1","subreddit":"valorant","created_utc":1751155200.0,"retrieved_utc":1751158800,"comments":['
           '{"id":"c1","body":"good","created_utc":1.0,"score":3},{"id":"c2","score":"many","replies":[{"id":"c3","body":"under"}]},'
           'null,{"kind":"more"},{"id":"c4"}]}')
    two = '{"id":"x2","created_utc":1.0,"retrieved_utc":1751158800,"comments":"none"}'
    (src / "a.json").write_text(one + "\n" + two + "\n" + '{"broken\n')
    raw, comments, rejects = (str(tmp_path / n) for n in ("raw", "comments", "rejects"))
    for _ in range(2):
        done = land_files(spark, str(src), raw, comments, rejects)
        assert (done.read, done.landed, done.rejected, done.rejected_comments) == (3, 2, 1, 3)
    assert sorted(r.submission_id for r in spark.read.parquet(raw).collect()) == ["x1", "x2"]
    assert sorted(r.comment_id for r in spark.read.parquet(comments).collect()) == ["c1", "c3", "c4"]
    got = sorted((r._reject_reason, r.submission_id or "", r.comment_position) for r in spark.read.parquet(rejects).collect())
    assert got == [("bad_comment:bad_type:score", "x1", 1), ("bad_comment:not_a_list", "x2", None),
                   ("bad_comment:null", "x1", 2), ("malformed_json", "", None)]
    (src / "a.json").write_text(one.replace('"many"', "4").replace("null,", "") + "\n")
    land_files(spark, str(src), raw, comments, rejects)          # mended: the run's rejects go
    assert spark.read.parquet(comments).count() == 4
    assert not list((tmp_path / "rejects").glob("run=*"))


def test_reply_trees_of_any_depth_keep_the_forest_order(spark):
    from postlake.plans.landing import StoredRecords
    deep = '{"id":"d0","replies":%s}'
    tree = "[]"
    for i in range(11, 0, -1):
        tree = '[{"id":"d%d","replies":%s},{"kind":"more"},{"id":"s%d"}]' % (i, tree, i)
    lines = spark.createDataFrame([('{"id":"a","created_utc":1.0,"comments":[%s,{"id":"b0","replies":[{"id":"b1"}]}]}' % (deep % tree),),
                                   ('{"id":"flat","created_utc":1.0,"comments":[{"id":"f","replies":""}]}',)], "value string")
    stored = StoredRecords(L.parse_submission_json(lines))
    flat = L.flatten_comments(L.reject_bad_rows(stored.rows)[0])
    got = [r.id for r in flat.where("submission_id = 'a'").orderBy("position").collect()]
    assert got == ["d0", "b0", "d1", "s1", "b1"] + [x for i in range(2, 12) for x in (f"d{i}", f"s{i}")]
    assert [r.id for r in flat.where("submission_id = 'flat'").collect()] == ["f"]
    assert [r.id for r in L.flatten_comments(L.reject_bad_rows(stored.rows)[0], limit=3).where(
        "submission_id = 'a'").orderBy("position").collect()] == ["d0", "b0", "d1"]
    stored.drop()


def test_text_is_scanned_once(spark, tmp_path):
    """Every target of a landing is written from the stored parse."""
    from postlake.plans import landing as P
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text((GOOD % ("1", "false", "1")) + "\n")
    records = P.StoredRecords(L.read_records(spark, str(src)))
    (src / "a.json").unlink()                                    # what follows cannot read it again
    good, _ = L.reject_bad_rows(records.rows)
    assert L.land_submissions(good).count() == 1 and L.land_comments(L.flatten_comments(good)).count() == 1
    assert L.rejects_of(records.rows).count() == 0


def _documents(spark, tmp_path, rows):
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").write.parquet(
        str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_record_lines_have_the_comments_of_every_document_of_their_id(spark, tmp_path):
    from postlake.sources import fixtures as FX
    d = _documents(spark, tmp_path, [(1, "a\n\nb", "en", "s"), (6, "x", "en", None), (6, None, "de", "s"), (6, "x", "en", None),
                                     (None, "none", "en", "s"), (8, None, None, "s")])
    lines = FX.record_lines_fx(spark, d)
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1        # the texts are shuffled once
    # 6 has three rows and three fetches, each with the comments of each of the three; 8 has two fetches; 1 has one
    got = L.parse_submission_json(lines).groupBy("id").count().collect()
    assert {r.id: r["count"] for r in got} == {"1": 1, "6": 27, "8": 2}


def test_landed_tables_and_records_are_compressed(spark, tmp_path):
    import glob
    from postlake.plans.landing import land_files
    from postlake.plans.queries import _record_files
    d = _documents(spark, tmp_path, [(i, f"text {i}\nline", "en", "s") for i in range(1, 20)])
    files = _record_files(spark, d)
    assert spark.read.text(files).count() > 19
    assert {f.rsplit(".", 1)[1] for f in glob.glob(files.removeprefix("file:") + "/part-*")} == {"gz"}
    land_files(spark, files, str(tmp_path / "raw"), str(tmp_path / "comments"))
    for table in ("raw", "comments"):
        names = glob.glob(str(tmp_path / table / "ds=*" / "*.parquet"))
        assert names and all(".zstd." in n for n in names)


def _exchanges(df):
    import re
    return re.findall(r"Exchange (\w+)", df._jdf.queryExecution().executedPlan().toString())


def _comment_rows(spark):
    """Days 0 to 5 of comments; day 0 is large; ids repeat in a day in other fetches and submissions."""
    base = {f.name: None for f in L.COMMENT_RECORD.fields}
    return spark.createDataFrame([
        dict(base, id=f"c{i}", submission_id=f"s{k}", body=f"{i} {k}", author=None, score=k, created_utc=1.0, retrieved_utc=day * 86400 + k)
        for day in range(6) for i in range(40 if day == 0 else 2) for k in range(3)], L.COMMENT_RECORD).repartition(3)


def test_comments_are_gathered_by_day_by_the_shuffle_that_finds_duplicates(spark, tmp_path):
    import datetime as dt
    recs = _comment_rows(spark).localCheckpoint()
    want = sorted(L.land_comments(recs).collect())
    assert len(want) == 50 and {r.submission_id for r in want} == {"s2"}
    for pieces, most in (({}, 1), ({4: [dt.date(1970, 1, 1)]}, 4)):
        landed = L.land_comments(recs, pieces=pieces)
        assert _exchanges(landed) == ["hashpartitioning"]
        assert landed.schema == L.land_comments(recs).schema and sorted(landed.collect()) == want
        places = landed.select("ds", F.spark_partition_id().alias("task")).distinct()
        tasks = {str(r.ds): r["count"] for r in places.groupBy("ds").count().collect()}
        assert max(n for day, n in tasks.items() if day != "1970-01-01") == 1 and tasks["1970-01-01"] <= most


def _records(folder, days_of_file):
    """A file of records for each list of days: two fetches of a submission a day, with its comments."""
    folder.mkdir()
    for k, days in enumerate(days_of_file):
        (folder / f"{k}.json").write_text("".join(
            '{"id":"p%d","subreddit":"valorant","created_utc":1.0,"retrieved_utc":%d,"score":%d,"comments":[{"id":"%d-a","body":"x"},'
            '{"id":"%d-b","body":"y %d"}]}\n' % (d, d * 86400 + f, f, d, d, f) for d in days for f in (1, 2)))
    return str(folder)


def test_days_of_records_are_counted_by_file_and_large_days_found(spark, tmp_path):
    import datetime as dt
    stored = spark.read.schema(L.parse_submission_json(spark.createDataFrame([], "value string")).schema).parquet

    def spread(name, days_of_file):
        parsed = L.read_records(spark, _records(tmp_path / name, days_of_file))
        parsed.withColumn("_f", F.input_file_name()).repartition(len(days_of_file), "_f").sortWithinPartitions("_f").drop("_f").write.partitionBy(
            "subreddit").parquet(str(tmp_path / (name + "-p")))
        return L.day_spread(stored(str(tmp_path / (name + "-p"))))
    one = spread("one", [list(range(20))])
    assert (one.days, one.pairs, one.pieces, one.day_by_day()) == (20, 20, {}, True)
    large = spread("large", [[0] * 30 + [1, 2, 3, 4]])            # 8 tasks, 30 of 34 parts in a day
    assert (large.days, large.pieces) == (5, {8: [dt.date(1970, 1, 1)]})
    every = L.DaySpread(days=20, files=5, pairs=100, pieces={})
    assert not every.day_by_day() and L.DaySpread(days=2, files=5, pairs=10, pieces={}).day_by_day()


def test_landing_many_days_shuffles_comments_once_and_other_rows_not_at_all(spark, tmp_path, monkeypatch):
    from postlake.plans import landing as P
    from postlake.sinks import tables as ST
    src = _records(tmp_path / "in", [list(range(k * 10, k * 10 + 10)) for k in range(3)])
    (tmp_path / "in" / "0.json").write_text((tmp_path / "in" / "0.json").read_text() + '{"broken\n')
    moved, write = [], ST.overwrite_partitions

    def seen(df, path, cols=("ds",), gather=True, level=None):
        moved.append((path.rsplit("/", 1)[1], len(_exchanges(ST.clustered(df, cols) if gather else df))))
        write(df, path, cols, gather, level)
    monkeypatch.setattr(ST, "overwrite_partitions", seen)
    monkeypatch.setattr(P, "overwrite_partitions", seen)
    freed = []
    monkeypatch.setattr(P, "free_shuffles", lambda s: freed.append(s))
    raw, comments, rejects = (str(tmp_path / n) for n in ("raw", "comments", "rejects"))
    for _ in range(2):
        done = P.land_files(spark, src, raw, comments, rejects)
        assert (done.read, done.landed, done.rejected) == (61, 60, 1)
    assert moved == [("raw", 0), ("comments", 1), ("rejects", 0)] * 2 and len(freed) >= 6
    assert spark.read.parquet(raw).groupBy("ds").count().collect() and spark.read.parquet(raw).count() == 60
    got = sorted((str(r.ds), r.comment_id, r.body) for r in spark.read.parquet(comments).collect())
    assert len(got) == 60 and {b for _, c, b in got if c.endswith("-b")} == {"y 2"}     # the newer fetch of a day
    assert all(len(list(d.glob("*.parquet"))) == 1 for d in (tmp_path / "comments").glob("ds=*"))
    moved.clear()
    P.land_files(spark, src, raw, newest=100)                      # a limit has moved rows out of their files
    assert moved[0][1] > 1 and spark.read.parquet(raw).count() == 60


def test_record_lines_of_unique_ids_are_not_shuffled(spark, tmp_path, monkeypatch):
    from postlake.sources import fixtures as FX

    def lines(name, ids):
        spark.createDataFrame([(i, f"a {i} {n}\nb", "en", "s") for n, i in enumerate(ids)],
                              "doc_id bigint, text string, lang string, source string").repartition(16).write.parquet(
            str(tmp_path / name / "documents.parquet"))
        out = FX.record_lines_fx(spark, str(tmp_path / name))
        with monkeypatch.context() as m:
            m.setattr(FX, "FEW_IDS", -1)
            grouped = FX.record_lines_fx(spark, str(tmp_path / name))
        moves = _exchanges(out)
        assert len(_exchanges(grouped)) == 1
        assert sorted(out.collect()) == sorted(grouped.collect())
        return moves, out.count()
    ids = [None, *range(1, 65)]
    once = lines("unique", ids)
    assert once[0] == []
    twice = lines("twice", [*ids, 5, 7])                           # each of two documents, with the comments of both
    assert len(twice[0]) == 1 and twice[1] == once[1] + 3 * 2
