import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from postlake.operators import topk as K
from postlake.plans.chain import silver_fx
from postlake.session import stored
from tests.conftest import SF_ORACLE, SF_SMALL, rows


def _random_days(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        day = "2025-06-29" if rnd.random() < 0.6 else rnd.choice(["2025-06-30", "2025-07-01"])
        score = None if rnd.random() < 0.05 else rnd.randint(-5, 40)     # many ties
        nc = None if rnd.random() < 0.05 else rnd.randint(0, 15)
        data.append((day, f"id{i:05d}", score, nc))
    return (spark.createDataFrame(data, "ds string, content_id string, score bigint, num_comments bigint")
            .withColumn("ds", F.to_date("ds")))


def _window_ranks(df, key, rank):
    w = Window.partitionBy("ds").orderBy(F.col(key).desc_nulls_last(), F.col("content_id"))
    return df.withColumn(rank, F.row_number().over(w).cast("bigint"))


def _top_either_by_windows(df, k):
    want = _window_ranks(_window_ranks(df, "score", "rank_score"), "num_comments", "rank_comments")
    return want.filter((F.col("rank_score") <= k) | (F.col("rank_comments") <= k))


KEYS = [("score", "rank_score"), ("num_comments", "rank_comments")]


def _ranks(df):
    return rows(df.select("ds", "content_id", F.col("rank_score").cast("int").alias("rank_score"),
                          F.col("rank_comments").cast("int").alias("rank_comments")))


@pytest.mark.parametrize("k", [1, 10, 1000, 1001, 5000])
def test_top_k_either_equals_window_plan_with_ties_and_nulls(spark, k):
    df = _random_days(spark)
    assert _ranks(K.top_k_either(df, "content_id", KEYS, k)) == _ranks(_top_either_by_windows(df, k))


def test_daily_rank_equals_window(spark):
    df = _random_days(spark, n=2000, seed=11)
    got = K.daily_rank(stored(K.number_rows(df, "score", num_partitions=7), "numbered"), "rank_score")
    want = _window_ranks(df, "score", "rank_score")
    cols = ("ds", "content_id", "rank_score")
    assert rows(got.select(*cols)) == rows(want.select(*cols))


def test_gold_top_daily_matches_window_on_fixture(spark):
    silver = stored(silver_fx(spark, SF_SMALL), "silver")
    assert _ranks(K.gold_top_daily(silver)) == _ranks(_top_either_by_windows(silver, 10))


def test_limits(spark):
    df = _random_days(spark, n=500, seed=5).withColumnRenamed("content_id", "submission_id") \
        .withColumn("subreddit", F.lit("x")).withColumn("created_utc_unix", F.col("num_comments")) \
        .withColumn("retrieved_utc_unix", F.lit(1))
    out = K.limit_top_per_subreddit(df, n=3)
    assert out.groupBy("ds").count().agg(F.max("count")).first()[0] == 3
    assert K.top_n_per_key(df, ["ds"], [F.col("score")], None, ["submission_id"]).count() == 500


@pytest.mark.parametrize("n", [10, 1001, 5000])
def test_one_plan_for_every_limit_and_rows_as_one_window(spark, n):
    df = _random_days(spark)
    order = K._desc_then_id("score", "content_id")
    got = K.top_n_per_key(df, ["ds"], order, n, ["content_id"], "place")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 2 and "_salt" in plan   # dealt, cut, then cut again
    want = df.withColumn("place", F.row_number().over(Window.partitionBy("ds").orderBy(*order))).filter(F.col("place") <= n)
    assert rows(got) == rows(want)


def test_building_operators_starts_no_job(spark):
    silver = stored(silver_fx(spark, SF_SMALL), "silver")
    tracker, group = spark.sparkContext.statusTracker(), "building-operators"
    spark.sparkContext.setJobGroup(group, group)
    try:
        K.gold_top_daily(silver)
        K.daily_rank(K.number_rows(silver, "score"), "rank_score")
        K.limit_comments_per_submission(silver.withColumnsRenamed(
            {"content_id": "comment_id", "score": "created_utc_unix"}).withColumn("submission_id", F.lit("s")), 3)
        silver_fx(spark, SF_SMALL)
        # reading a file's schema is the scan's own business, not the operators'
        jobs = [j for j in tracker.getJobIdsForGroup(group)]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 1      # the footer read of documents.parquet


def test_top_daily_plan_has_no_single_partition(spark):
    silver = silver_fx(spark, SF_ORACLE)
    full = K.gold_top_daily(silver)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in full and "WindowGroupLimit" in full
