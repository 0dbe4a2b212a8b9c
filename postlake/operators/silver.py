"""Bronze → silver: bins, rule labels, flags, candidate filter, AI labels.

All narrow (no shuffle). The lower-cased title / self text are computed
once as helper columns and dropped again, instead of 44 ``lower`` calls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.functions import rules as R
from postlake.functions import text_ai as AI
from postlake.schemas import SILVER_SUBMISSIONS, conform


# Every distinct rule keyword, in rule order; ``_kw{i}`` holds "in title or
# self text" for keyword i, computed once and shared by the category rules
# and the topic scores.
KEYWORDS = list(dict.fromkeys(k for _, kws in R.CATEGORY_KEYWORD_RULES for k in kws))
KEYWORD_COLS = {k: f"_kw{i}" for i, k in enumerate(KEYWORDS)}


def enrich(bronze: DataFrame) -> DataFrame:
    """Adds full_text, bins, is_trending, text_category, game_topic and
    is_ai_enrichment_candidate to bronze rows (no rows dropped).

    Keeps ``_title_lc``, ``_self_lc`` and the keyword-hit columns for the
    label step; :func:`silver_project` drops them.
    """
    df = bronze.select("*", R.concat_text("title", "selftext").alias("full_text"),
                       F.lower("title").alias("_title_lc"), F.lower("selftext").alias("_self_lc"))
    df = df.selectExpr("*", *[f"{R.any_keyword_sql(['`_title_lc`', '`_self_lc`'], [k])} AS {c}"
                              for k, c in KEYWORD_COLS.items()])
    rule_cases = [(" OR ".join(f"coalesce({KEYWORD_COLS[k]}, false)" for k in kws), label)
                  for label, kws in R.CATEGORY_KEYWORD_RULES]
    rule_cases += [(R.in_list_sql("lower(`raw_subreddit_name`)", subs), label)
                   for label, subs in R.CATEGORY_SUBREDDIT_RULES]
    df = df.select(
        "*",
        F.lit(R.CONTENT_TYPE).alias("text_type"),
        R.bin_score("score").alias("score_bin"),
        R.bin_num_comments("num_comments").alias("num_comments_bin"),
        R.bin_upvote_ratio("upvote_ratio").alias("upvote_ratio_bin"),
        R.flag_trending("score", "num_comments").alias("is_trending"),
        F.expr(R._sql_chain(rule_cases, R.CATEGORY_DEFAULT)).alias("text_category"),
        R.map_game_topic("raw_subreddit_name").alias("game_topic"),
    )
    return df.withColumn("is_ai_enrichment_candidate",
                         R.flag_candidate_parts("is_trending", "title", "selftext"))


def _helper_cols() -> list[str]:
    return ["_title_lc", "_self_lc", *KEYWORD_COLS.values()]


def full_text_lc(df: DataFrame) -> DataFrame:
    """Add ``_full_lc``: the lower-cased full text, built from the
    lower-cased parts (fallback when the keyword-hit columns are absent).

    Every keyword and lexicon word is ASCII, and lower-casing never makes
    or breaks an ASCII match across the joining space, so this equals
    ``lower(full_text)`` for all matching."""
    return df.withColumn("_full_lc", R.concat_text(F.lower("title"), F.lower("selftext")))


def candidate_filter(enriched: DataFrame) -> DataFrame:
    """Keep rows flagged as AI candidates (NULL flag is dropped)."""
    return enriched.filter(F.col("is_ai_enrichment_candidate"))


def silver_project(candidates: DataFrame) -> DataFrame:
    """Final 26-column silver layout.

    The AI labels read ``full_text`` (title + ' ' + self text) while the
    output ``text_content`` is the self text alone.
    """
    if all(c in candidates.columns for c in _helper_cols()):
        labelled = AI.with_ai_labels_from_parts(candidates, "_title_lc", "_self_lc", KEYWORD_COLS)
    else:
        labelled = AI.with_ai_labels(full_text_lc(candidates), "_full_lc")
    out = labelled.select(
        F.col("submission_id").alias("content_id"),
        F.col("text_type").alias("content_type"),
        "author_name",
        F.col("raw_subreddit_name").alias("content_subreddit"),
        F.col("title").alias("text_title"),
        F.col("selftext").alias("text_content"),
        F.col("url").alias("text_url"),
        "text_category",
        "game_topic",
        F.col("flair").alias("class_type"),
        R.flag_game_topic("game_topic").alias("is_game_topic"),
        "ai_sentiment",
        "ai_topics",
        R.flag_edited("edited").alias("edited"),
        "is_trending", "upvote_ratio_bin", "num_comments_bin", "score_bin",
        "is_self", "over_18", "num_comments", "score", "spoiler",
        "created_at_timestamp", "_loaded_at_timestamp_utc", "ds",
    )
    return conform(out, SILVER_SUBMISSIONS)


def silver_submissions(bronze: DataFrame) -> DataFrame:
    """Filter first, then the (costlier) AI labels on candidates only."""
    return silver_project(candidate_filter(enrich(bronze)))
