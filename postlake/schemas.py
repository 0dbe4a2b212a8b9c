"""Declared table schemas (column order is part of the contract)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "STRING": T.StringType(), "BIGINT": T.LongType(), "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(), "BOOLEAN": T.BooleanType(), "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(), "ARRAY<STRING>": T.ArrayType(T.StringType()),
}


def _struct(spec: str, not_null: tuple[str, ...] = ()) -> T.StructType:
    """'name TYPE, ...' → StructType (the few types our tables use)."""
    fields = []
    for item in spec.split(", "):
        name, typ = item.strip().split(" ", 1)
        fields.append(T.StructField(name, _TYPES[typ.strip()], name not in not_null))
    return T.StructType(fields)


RAW_SUBMISSIONS = _struct(
    "author_name STRING, created_utc STRING, created_utc_unix BIGINT, edited STRING, "
    "flair STRING, is_self BOOLEAN, num_comments BIGINT, over_18 BOOLEAN, permalink STRING, "
    "retrieved_utc_unix BIGINT, score BIGINT, selftext STRING, spoiler BOOLEAN, "
    "stickied BOOLEAN, submission_id STRING, subreddit STRING, title STRING, "
    "upvote_ratio DOUBLE, url STRING, ds DATE, _loaded_at_timestamp_utc TIMESTAMP"
)

RAW_COMMENTS = _struct(
    "author_name STRING, body STRING, comment_id STRING, created_utc STRING, "
    "created_utc_unix BIGINT, edited STRING, is_submitter BOOLEAN, parent_id STRING, "
    "permalink STRING, retrieved_utc_unix BIGINT, score BIGINT, stickied BOOLEAN, "
    "submission_id STRING, ds DATE, _loaded_at_timestamp_utc TIMESTAMP"
)

BRONZE_SUBMISSIONS = _struct(
    "submission_id STRING, author_name STRING, raw_created_utc_str STRING, "
    "created_utc_unix BIGINT, created_at_timestamp TIMESTAMP, edited STRING, flair STRING, "
    "is_self BOOLEAN, num_comments BIGINT, over_18 BOOLEAN, permalink STRING, "
    "retrieved_utc_unix BIGINT, score BIGINT, selftext STRING, spoiler BOOLEAN, "
    "stickied BOOLEAN, raw_subreddit_name STRING, title STRING, upvote_ratio DOUBLE, "
    "url STRING, ds DATE, _loaded_at_timestamp_utc TIMESTAMP"
)

SILVER_SUBMISSIONS = _struct(
    "content_id STRING, content_type STRING, author_name STRING, content_subreddit STRING, "
    "text_title STRING, text_content STRING, text_url STRING, text_category STRING, "
    "game_topic STRING, class_type STRING, is_game_topic BOOLEAN, ai_sentiment STRING, "
    "ai_topics STRING, edited BOOLEAN, is_trending BOOLEAN, upvote_ratio_bin STRING, "
    "num_comments_bin STRING, score_bin STRING, is_self BOOLEAN, over_18 BOOLEAN, "
    "num_comments BIGINT, score BIGINT, spoiler BOOLEAN, created_at_timestamp TIMESTAMP, "
    "_loaded_at_timestamp_utc TIMESTAMP, ds DATE",
    not_null=("content_type", "text_category", "game_topic", "is_game_topic",
              "upvote_ratio_bin", "num_comments_bin", "score_bin"),
)

GOLD_SENTIMENT_TOPIC = _struct(
    "ds DATE, text_category STRING, ai_sentiment STRING, post_count BIGINT, "
    "avg_score DOUBLE, ai_topic_samples ARRAY<STRING>"
)

GOLD_TOPIC_TRENDS = _struct(
    "ds DATE, game_topic STRING, submission_count BIGINT, avg_score DOUBLE, "
    "avg_num_comments DOUBLE, trending_ratio DOUBLE"
)

GOLD_TOPIC_TIME_SERIES = _struct(
    "ds DATE, game_topic STRING, upvote_ratio_bin STRING, submission_count BIGINT, "
    "trending_count BIGINT, spoiler_rate DOUBLE, over_18_ratio DOUBLE"
)

GOLD_AUTHOR_PROFILES = _struct(
    "author_name STRING, total_submissions BIGINT, avg_score DOUBLE, avg_num_comments DOUBLE, "
    "trending_post_count BIGINT, positive_sentiment_ratio DOUBLE, topic_diversity BIGINT, "
    "first_seen TIMESTAMP, last_seen TIMESTAMP"
)

GOLD_TOP_DAILY = _struct(
    "ds DATE, content_id STRING, author_name STRING, game_topic STRING, score BIGINT, "
    "num_comments BIGINT, text_title STRING, text_content STRING, text_url STRING, "
    "ai_sentiment STRING, ai_topics STRING, rank_score INT, rank_comments INT"
)

# Mergeable daily sums behind the author profiles (keyed by topic as well, so
# that the distinct-topic count of the rollup is exact).
AUTHOR_DAILY_PARTIALS = _struct(
    "author_name STRING, ds DATE, game_topic STRING, n BIGINT, score_sum BIGINT, score_n BIGINT, "
    "comments_sum BIGINT, comments_n BIGINT, trending_n BIGINT, positive_n BIGINT, "
    "first_seen TIMESTAMP, last_seen TIMESTAMP"
)

# name -> (schema, partition columns)
TABLES: dict[str, tuple[T.StructType, tuple[str, ...]]] = {
    "raw_submissions": (RAW_SUBMISSIONS, ("ds",)),
    "raw_comments": (RAW_COMMENTS, ("ds",)),
    "bronze_submissions": (BRONZE_SUBMISSIONS, ("ds",)),
    "silver_submissions": (SILVER_SUBMISSIONS, ("ds",)),
    "gold_sentiment_topic": (GOLD_SENTIMENT_TOPIC, ("ds",)),
    "gold_topic_trends": (GOLD_TOPIC_TRENDS, ("ds",)),
    "gold_topic_time_series": (GOLD_TOPIC_TIME_SERIES, ("ds",)),
    "gold_author_profiles": (GOLD_AUTHOR_PROFILES, ()),
    "gold_top_daily": (GOLD_TOP_DAILY, ("ds",)),
    "author_daily_partials": (AUTHOR_DAILY_PARTIALS, ("ds",)),
}


def columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the declared columns in declared order, cast to declared types.

    Fails (AnalysisException) when a declared column is missing: schema
    drift is an error, not something to paper over.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    if list(have) == [f.name for f in schema.fields] and all(have[f.name] == f.dataType for f in schema.fields):
        return df
    return df.select(*[F.col(f.name) if have.get(f.name) == f.dataType
                       else F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def check_schema(df: DataFrame, schema: T.StructType) -> None:
    got = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    want = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    if got != want:
        raise ValueError(f"schema drift:\n got  {got}\n want {want}")
