"""Hot keys: one submission id holding a third of all raw rows, one author
holding a third of silver, all derived from the supplied tables."""

from pyspark.sql import functions as F

from postlake.operators import gold as G
from postlake.operators.bronze import bronze_project, dedup_latest
from postlake.plans.chain import raw_fx
from tests.conftest import SF_SMALL, rows


def _skewed_raw(spark):
    raw = raw_fx(spark, SF_SMALL).withColumn("_doc", F.col("submission_id").cast("bigint"))
    doc = F.col("_doc")
    return (raw.withColumn("submission_id", F.when(doc % 3 == 0, F.lit("hot")).otherwise(F.col("submission_id")))
               .withColumn("author_name", F.when(doc % 3 == 1, F.lit("[deleted]")).otherwise(F.col("author_name")))
               .drop("_doc"))


def test_dedup_with_hot_id_equals_max_by(spark):
    raw = _skewed_raw(spark)
    got = dedup_latest(raw).select("ds", "submission_id", "_loaded_at_timestamp_utc", "created_utc_unix")
    key = F.struct(F.col("_loaded_at_timestamp_utc"), F.col("created_utc_unix"))
    want = (raw.groupBy("ds", "submission_id")
            .agg(F.max(key).alias("k"))
            .select("ds", "submission_id", "k._loaded_at_timestamp_utc", "k.created_utc_unix"))
    assert rows(got) == rows(want)
    assert got.filter(F.col("submission_id") == "hot").count() == 7   # one per day


def test_hot_id_is_cut_before_the_shuffle(spark):
    plan = bronze_project(dedup_latest(_skewed_raw(spark)))._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    exchange = next(i for i, l in enumerate(lines) if "Exchange hashpartitioning" in l)
    partial = next(i for i, l in enumerate(lines) if "WindowGroupLimit" in l and "Partial" in l)
    assert partial > exchange     # printed below the exchange = runs before it, map side


def test_hot_author_profile_matches_plain_aggregate(spark):
    from postlake.operators.bronze import qc_filter
    from postlake.operators.silver import silver_submissions
    silver = silver_submissions(qc_filter(bronze_project(dedup_latest(_skewed_raw(spark)))))
    prof = G.gold_author_profiles(silver).filter(F.col("author_name") == "[deleted]").first()
    direct = silver.filter(F.col("author_name") == "[deleted]")
    assert prof.total_submissions == direct.count()
    assert prof.topic_diversity == direct.select("game_topic").distinct().count()
