"""Silver → gold daily aggregates (and the documented dashboard aggregates).

Every aggregate keeps ``ds`` in its key, so one call serves one day or a
whole backfill range. All aggregates are partial/final (map-side combine),
so a hot key (one author holding a third of the rows, one huge day) is
reduced to one row per map task before the shuffle. Collected lists are
over bounded label sets only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlake.operators.topk import top_n_per_key


def _flag01(c: str) -> Column:
    """CASE WHEN c THEN 1 ELSE 0 END (NULL counts as 0)."""
    return F.when(F.col(c), F.lit(1)).otherwise(F.lit(0))


def gold_sentiment_topic(silver: DataFrame) -> DataFrame:
    """(ds, text_category, ai_sentiment) → posts, avg score, distinct topics.

    The topic list is sorted (deterministic) and drops NULLs; its size is
    bounded by the topic label set.
    """
    return (silver.groupBy("ds", "text_category", "ai_sentiment")
            .agg(F.count(F.lit(1)).alias("post_count"),
                 F.avg("score").alias("avg_score"),
                 F.sort_array(F.collect_set("ai_topics")).alias("ai_topic_samples")))


def gold_topic_trends(silver: DataFrame) -> DataFrame:
    return (silver.filter(F.col("game_topic").isNotNull())
            .groupBy("ds", "game_topic")
            .agg(F.count(F.lit(1)).alias("submission_count"),
                 F.avg("score").alias("avg_score"),
                 F.avg("num_comments").alias("avg_num_comments"),
                 F.avg(_flag01("is_trending")).alias("trending_ratio")))


def gold_topic_time_series(silver: DataFrame) -> DataFrame:
    return (silver.groupBy("ds", "game_topic", "upvote_ratio_bin")
            .agg(F.count(F.lit(1)).alias("submission_count"),
                 F.sum(_flag01("is_trending")).cast("bigint").alias("trending_count"),
                 F.avg(_flag01("spoiler")).alias("spoiler_rate"),
                 F.avg(_flag01("over_18")).alias("over_18_ratio")))


def gold_author_profiles(silver: DataFrame) -> DataFrame:
    """All-history author profiles (no ``ds`` key).

    ``COUNT(DISTINCT game_topic)`` is planned as a two-level aggregate on
    (author, topic) first; topic has ≤ 10 values, so even the '[deleted]'
    author shrinks to a few rows per map task.
    """
    return (silver.filter(F.col("author_name").isNotNull())
            .groupBy("author_name")
            .agg(F.count(F.lit(1)).alias("total_submissions"),
                 F.avg("score").alias("avg_score"),
                 F.avg("num_comments").alias("avg_num_comments"),
                 F.sum(_flag01("is_trending")).cast("bigint").alias("trending_post_count"),
                 (F.sum(F.when(F.col("ai_sentiment") == "positive", 1).otherwise(0))
                  / F.count(F.lit(1))).alias("positive_sentiment_ratio"),
                 F.countDistinct("game_topic").alias("topic_diversity"),
                 F.min("created_at_timestamp").alias("first_seen"),
                 F.max("created_at_timestamp").alias("last_seen")))


# ---------------------------------------------------------------------------
# Approximate distinct counts, on request: mergeable sketches.

SKETCH_LG_K = 14
#: Three standard errors of a sketch (0.83 / sqrt(2 ** SKETCH_LG_K)).
SKETCH_ERROR = 3 * 0.83 / 2 ** (SKETCH_LG_K / 2)


def distinct_sketches(df: DataFrame, keys: list[str], names: dict[str, str]) -> DataFrame:
    """``keys`` and a HyperLogLog sketch per name (a column each; NULLs do not
    count): a few KB a group that merge over days and any other key, where
    exact counts need all values again."""
    return df.groupBy(*keys).agg(*[F.hll_sketch_agg(F.col(c).cast("string"), SKETCH_LG_K).alias(n) for n, c in names.items()])


def merge_sketches(sketches: DataFrame, keys: list[str], names: dict[str, str]) -> DataFrame:
    return sketches.groupBy(*keys).agg(*[F.hll_union_agg(n).alias(n) for n in names])


def distinct_estimates(sketches: DataFrame, keys: list[str], names: dict[str, str]) -> DataFrame:
    return sketches.select(*keys, *[F.hll_sketch_estimate(n).alias(n) for n in names])


# ---------------------------------------------------------------------------
# Incremental author profiles: mergeable daily partials + rollup.

def author_daily_partials(silver: DataFrame) -> DataFrame:
    """(author, ds, game_topic) partial sums; merge-able across days.

    Keyed by topic as well, so the distinct-topic count of the rollup is
    exact. A day's partials are small (authors × ≤10 topics) and can be
    written once per day, so the profile never re-scans the full history.
    """
    return (silver.filter(F.col("author_name").isNotNull())
            .groupBy("author_name", "ds", "game_topic")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.sum("score").alias("score_sum"),
                 F.count("score").alias("score_n"),
                 F.sum("num_comments").alias("comments_sum"),
                 F.count("num_comments").alias("comments_n"),
                 F.sum(_flag01("is_trending")).cast("bigint").alias("trending_n"),
                 F.sum(F.when(F.col("ai_sentiment") == "positive", 1).otherwise(0))
                 .cast("bigint").alias("positive_n"),
                 F.min("created_at_timestamp").alias("first_seen"),
                 F.max("created_at_timestamp").alias("last_seen")))


def author_profiles_from_partials(partials: DataFrame) -> DataFrame:
    """Final rollup; equals :func:`gold_author_profiles` on the same rows."""
    return (partials.groupBy("author_name")
            .agg(F.sum("n").alias("total_submissions"),
                 F.try_divide(F.sum("score_sum"), F.sum("score_n")).alias("avg_score"),
                 F.try_divide(F.sum("comments_sum"), F.sum("comments_n")).alias("avg_num_comments"),
                 F.sum("trending_n").cast("bigint").alias("trending_post_count"),
                 (F.sum("positive_n") / F.sum("n")).alias("positive_sentiment_ratio"),
                 F.countDistinct("game_topic").alias("topic_diversity"),
                 F.min("first_seen").alias("first_seen"),
                 F.max("last_seen").alias("last_seen")))


# ---------------------------------------------------------------------------
# Aggregates the documentation promises for the dashboard (column choices
# are ours; the reference names the tables but defines no query).

def doc_subreddit_activity_daily(silver: DataFrame) -> DataFrame:
    return (silver.groupBy("ds", "content_subreddit")
            .agg(F.count(F.lit(1)).alias("posts"),
                 F.countDistinct("author_name").alias("distinct_authors"),
                 F.avg("score").alias("avg_score"),
                 F.avg("num_comments").alias("avg_num_comments")))


def doc_subreddit_activity_weekly(silver: DataFrame) -> DataFrame:
    """Weeks start on Monday (``trunc(ds, 'week')``)."""
    week = F.trunc("ds", "week").alias("week_start")
    return (silver.groupBy(week, "content_subreddit")
            .agg(F.count(F.lit(1)).alias("posts"),
                 F.countDistinct("author_name").alias("distinct_authors"),
                 F.avg("score").alias("avg_score"),
                 F.avg("num_comments").alias("avg_num_comments")))


def doc_category_trends_daily(silver: DataFrame) -> DataFrame:
    return (silver.groupBy("ds", "text_category")
            .agg(F.count(F.lit(1)).alias("posts"),
                 F.avg("score").alias("avg_score"),
                 F.avg(_flag01("is_trending")).alias("trending_ratio")))


def doc_top_authors_daily(silver: DataFrame, k: int = 10) -> DataFrame:
    """Top-k authors per day by posts, ties by name.

    Aggregate first (partial agg absorbs hot authors); then one row per (day,
    author) is cut in two levels, so no day is sorted in one task whatever
    ``k`` is.
    """
    per_author = (silver.filter(F.col("author_name").isNotNull())
                  .groupBy("ds", "author_name").agg(F.count(F.lit(1)).alias("posts")))
    order = [F.col("posts").desc(), F.col("author_name").asc()]
    top = top_n_per_key(per_author, ["ds"], order, k, ["author_name"], "author_rank")
    return top.withColumn("author_rank", F.col("author_rank").cast("bigint"))


def doc_trending_summary(silver: DataFrame) -> DataFrame:
    """Trending rows per (ds, game_topic): count, best score, title of the
    best post (score desc, then content_id asc)."""
    return (silver.filter(F.col("is_trending"))
            .groupBy("ds", "game_topic")
            .agg(F.count(F.lit(1)).alias("trending_posts"),
                 F.max("score").alias("max_score"),
                 F.min_by(F.col("text_title"),
                          F.struct((-F.col("score")).alias("s"), F.col("content_id").alias("c")))
                 .alias("best_title")))


def doc_sentiment_summary(silver: DataFrame) -> DataFrame:
    """(ds, ai_sentiment) → posts and share of the day's posts.

    The day total is a window over the already aggregated rows (≤ 5 per
    day), not over raw rows.
    """
    per = silver.groupBy("ds", "ai_sentiment").agg(F.count(F.lit(1)).alias("posts"))
    day_total = F.sum("posts").over(Window.partitionBy("ds"))
    return per.withColumn("share_of_day", F.col("posts") / day_total)
