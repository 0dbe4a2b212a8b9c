"""Oracle SQL per registered query (DuckDB dialect)."""

from __future__ import annotations

from postlake.oracle.sql import with_ctes

ORACLE: dict[str, str] = {}


def oracle(name: str, needs: list[str], body: str, extra: list[tuple[str, str]] | None = None) -> None:
    if name in ORACLE:
        raise KeyError(f"duplicate oracle {name}")
    ORACLE[name] = with_ctes(needs, body, extra)


BRONZE_OUT = """submission_id, author_name, raw_created_utc_str, created_utc_unix,
  created_at_timestamp, edited, flair, is_self, num_comments, over_18, permalink,
  retrieved_utc_unix, score, selftext, spoiler, stickied, raw_subreddit_name, title,
  upvote_ratio, url, ds, _loaded_at_timestamp_utc"""

# --- layers ---------------------------------------------------------------
oracle("bronze_submissions", ["bronze"], f"SELECT {BRONZE_OUT} FROM bronze")
oracle("silver_submissions", ["silver"], "SELECT * FROM silver")

# --- gold -----------------------------------------------------------------
oracle("gold_topic_trends", ["silver"], """
SELECT ds, game_topic, COUNT(*) AS submission_count, AVG(score) AS avg_score,
  AVG(num_comments) AS avg_num_comments,
  AVG(CASE WHEN is_trending THEN 1 ELSE 0 END) AS trending_ratio
FROM silver WHERE game_topic IS NOT NULL GROUP BY ds, game_topic""")

oracle("gold_sentiment_topic", ["silver"], """
SELECT ds, text_category, ai_sentiment, COUNT(*) AS post_count, AVG(score) AS avg_score,
  coalesce(list_sort(list(DISTINCT ai_topics) FILTER (WHERE ai_topics IS NOT NULL)), []::VARCHAR[])
    AS ai_topic_samples
FROM silver GROUP BY ds, text_category, ai_sentiment""")

oracle("gold_topic_time_series", ["silver"], """
SELECT ds, game_topic, upvote_ratio_bin, COUNT(*) AS submission_count,
  CAST(SUM(CASE WHEN is_trending THEN 1 ELSE 0 END) AS BIGINT) AS trending_count,
  AVG(CASE WHEN spoiler THEN 1 ELSE 0 END) AS spoiler_rate,
  AVG(CASE WHEN over_18 THEN 1 ELSE 0 END) AS over_18_ratio
FROM silver GROUP BY ds, game_topic, upvote_ratio_bin""")

GOLD_AUTHOR_PROFILES_BODY = """
SELECT author_name, COUNT(*) AS total_submissions, AVG(score) AS avg_score,
  AVG(num_comments) AS avg_num_comments,
  CAST(SUM(CASE WHEN is_trending THEN 1 ELSE 0 END) AS BIGINT) AS trending_post_count,
  SUM(CASE WHEN ai_sentiment = 'positive' THEN 1 ELSE 0 END) / COUNT(*) AS positive_sentiment_ratio,
  COUNT(DISTINCT game_topic) AS topic_diversity,
  MIN(created_at_timestamp) AS first_seen, MAX(created_at_timestamp) AS last_seen
FROM silver WHERE author_name IS NOT NULL GROUP BY author_name"""
oracle("gold_author_profiles", ["silver"], GOLD_AUTHOR_PROFILES_BODY)

TOP_DAILY_BODY = """
SELECT ds, content_id, author_name, game_topic, score, num_comments, text_title, text_content,
  text_url, ai_sentiment, ai_topics, CAST(rank_score AS INTEGER) AS rank_score,
  CAST(rank_comments AS INTEGER) AS rank_comments
FROM (SELECT *,
    row_number() OVER (PARTITION BY ds ORDER BY score DESC NULLS LAST, content_id) AS rank_score,
    row_number() OVER (PARTITION BY ds ORDER BY num_comments DESC NULLS LAST, content_id) AS rank_comments
  FROM {src}) ranked
WHERE rank_score <= 10 OR rank_comments <= 10"""

oracle("gold_top_daily", ["silver"], TOP_DAILY_BODY.format(src="silver"))


# --- bronze / silver steps ------------------------------------------------
from postlake.oracle import sql as S  # noqa: E402

oracle("bronze_dedup_latest", ["bronze_dedup"], f"SELECT {BRONZE_OUT} FROM bronze_dedup")
oracle("bronze_dedup_all_days", ["bronze_dedup_all"], f"SELECT {BRONZE_OUT} FROM bronze_dedup_all")
oracle("qc_filter", ["bronze"], f"SELECT {BRONZE_OUT} FROM bronze")
oracle("project_fixed", ["raw_submissions_fx"], f"SELECT {S.BRONZE_COLS} FROM raw_submissions_fx")
oracle("rename_columns", ["silver"], """
SELECT content_id, content_type, content_subreddit, text_title, text_content, text_url,
  class_type, ds FROM silver""")
oracle("candidate_filter", ["enriched"], """
SELECT ds, submission_id, is_trending, full_text FROM enriched WHERE is_ai_enrichment_candidate""")


def _scalar(name: str, exprs: dict[str, str]) -> None:
    sel = ", ".join(f"{e} AS {k}" for k, e in exprs.items())
    oracle(name, ["bronze_dedup"], f"""
SELECT ds, submission_id, {sel}
FROM (SELECT *, concat_ws(' ', title, selftext) AS full_text FROM bronze_dedup) b""")


_scalar("bin_score", {"score": "score", "score_bin": S.bin_score_sql()})
_scalar("bin_num_comments", {"num_comments": "num_comments", "num_comments_bin": S.bin_num_comments_sql()})
_scalar("bin_upvote_ratio", {"upvote_ratio": "upvote_ratio", "upvote_ratio_bin": S.bin_upvote_ratio_sql()})
_scalar("flag_trending", {"is_trending": S.trending_sql()})
_scalar("categorize_text", {"text_category": S.category_sql()})
_scalar("map_game_topic", {"raw_subreddit_name": "raw_subreddit_name", "game_topic": S.game_topic_sql()})
_scalar("flag_game_topic", {"is_game_topic": f"NOT ({S.game_topic_sql()} = 'Other Game')"})
_scalar("flag_candidate", {"is_ai_enrichment_candidate":
                           f"({S.trending_sql()} = TRUE OR length(full_text) > 500)"})
_scalar("flag_edited", {"edited": "edited", "is_edited": f"NOT (edited = 'False')"})
_scalar("concat_text", {"full_text": "full_text"})
_scalar("text_length", {"text_length": "CAST(length(full_text) AS INTEGER)"})
_scalar("in_list", {"in_game_specific": S.in_list_sql("raw_subreddit_name", S.GAME_SUBREDDITS),
                    "in_general_gaming": S.in_list_sql("raw_subreddit_name", S.GENERAL_SUBREDDITS)})
_scalar("ts_from_unix", {"created_utc_unix": "created_utc_unix", "created_ts": S.ts("created_utc_unix")})
_scalar("iso_from_unix", {"created_iso": S.iso("created_utc_unix")})
_scalar("date_from_string", {"created_date": "TRY_CAST(substr(raw_created_utc_str, 1, 10) AS DATE)"})
_scalar("ai_sentiment", {"ai_sentiment": S.sentiment_sql("full_text")})
_scalar("ai_topics", {"ai_topics": S.topics_sql("full_text")})

_KWS = ", ".join(S.q(k) for _, ks in S.KEYWORDS for k in ks)
oracle("match_keyword", ["bronze_dedup"], f"""
SELECT ds, keyword,
  count(*) FILTER (WHERE coalesce(contains(lower(title), keyword), FALSE)
                      OR coalesce(contains(lower(selftext), keyword), FALSE)) AS hits
FROM bronze_dedup, (SELECT unnest([{_KWS}]) AS keyword) k
GROUP BY ds, keyword""")

oracle("ai_custom_model", ["enriched"], f"""
SELECT ds, submission_id, {S.sentiment_sql('full_text')} AS ai_sentiment
FROM enriched WHERE is_ai_enrichment_candidate""")

# --- aggregates on silver --------------------------------------------------


def _daily(name: str, aggs: str) -> None:
    oracle(name, ["silver"], f"SELECT ds, {aggs} FROM silver GROUP BY ds")


_daily("agg_count", "COUNT(*) AS rows")
_daily("agg_avg", "AVG(score) AS avg_score, AVG(num_comments) AS avg_num_comments")
_daily("agg_conditional_sum", "CAST(SUM(CASE WHEN is_trending THEN 1 ELSE 0 END) AS BIGINT) AS trending_count")
_daily("agg_conditional_avg", "AVG(CASE WHEN is_trending THEN 1 ELSE 0 END) AS trending_ratio")
_daily("agg_ratio", "SUM(CASE WHEN ai_sentiment = 'positive' THEN 1 ELSE 0 END) / COUNT(*) AS positive_ratio")
_daily("agg_count_distinct", "COUNT(DISTINCT game_topic) AS topics, COUNT(DISTINCT author_name) AS authors")
_daily("agg_collect_distinct", "coalesce(list_sort(list(DISTINCT ai_topics) FILTER (WHERE ai_topics IS NOT NULL)),"
                               " []::VARCHAR[]) AS topics")
_daily("agg_min_max", "MIN(created_at_timestamp) AS first_created, MAX(created_at_timestamp) AS last_created")

ORACLE["author_profiles_incremental"] = ORACLE["gold_author_profiles"]

# --- documented dashboard aggregates --------------------------------------
oracle("doc_subreddit_activity_daily", ["silver"], """
SELECT ds, content_subreddit, COUNT(*) AS posts, COUNT(DISTINCT author_name) AS distinct_authors,
  AVG(score) AS avg_score, AVG(num_comments) AS avg_num_comments
FROM silver GROUP BY ds, content_subreddit""")
oracle("doc_subreddit_activity_weekly", ["silver"], """
SELECT CAST(date_trunc('week', ds) AS DATE) AS week_start, content_subreddit, COUNT(*) AS posts,
  COUNT(DISTINCT author_name) AS distinct_authors, AVG(score) AS avg_score,
  AVG(num_comments) AS avg_num_comments
FROM silver GROUP BY 1, content_subreddit""")
oracle("doc_category_trends_daily", ["silver"], """
SELECT ds, text_category, COUNT(*) AS posts, AVG(score) AS avg_score,
  AVG(CASE WHEN is_trending THEN 1 ELSE 0 END) AS trending_ratio
FROM silver GROUP BY ds, text_category""")
oracle("doc_top_authors_daily", ["silver"], """
SELECT ds, author_name, posts, author_rank FROM (
  SELECT ds, author_name, posts,
    CAST(row_number() OVER (PARTITION BY ds ORDER BY posts DESC, author_name) AS BIGINT) AS author_rank
  FROM (SELECT ds, author_name, COUNT(*) AS posts FROM silver WHERE author_name IS NOT NULL
        GROUP BY ds, author_name) a) r
WHERE author_rank <= 10""")
oracle("doc_trending_summary", ["silver"], """
SELECT ds, game_topic, COUNT(*) AS trending_posts, MAX(score) AS max_score,
  first(text_title ORDER BY score DESC, content_id ASC) AS best_title
FROM silver WHERE is_trending GROUP BY ds, game_topic""")
oracle("doc_sentiment_summary", ["silver"], """
SELECT ds, ai_sentiment, posts, posts / SUM(posts) OVER (PARTITION BY ds) AS share_of_day
FROM (SELECT ds, ai_sentiment, COUNT(*) AS posts FROM silver GROUP BY ds, ai_sentiment) p""")

# --- windows / top-k --------------------------------------------------------
for _key, _rank in (("score", "rank_score"), ("num_comments", "rank_comments")):
    oracle(f"rank_by_{_key.replace('num_', '')}", ["silver"], f"""
SELECT ds, content_id, {_key},
  CAST(row_number() OVER (PARTITION BY ds ORDER BY {_key} DESC NULLS LAST, content_id) AS BIGINT) AS {_rank}
FROM silver""")

oracle("rank_or_filter", ["silver"], """
SELECT ds, content_id, score, num_comments, CAST(rank_score AS INTEGER) AS rank_score,
  CAST(rank_comments AS INTEGER) AS rank_comments
FROM (SELECT *,
    row_number() OVER (PARTITION BY ds ORDER BY score DESC NULLS LAST, content_id) AS rank_score,
    row_number() OVER (PARTITION BY ds ORDER BY num_comments DESC NULLS LAST, content_id) AS rank_comments
  FROM silver) r
WHERE rank_score <= 10 OR rank_comments <= 10""")
oracle("topk_either", ["bronze"], """
SELECT ds, submission_id, score, num_comments, CAST(rank_score AS INTEGER) AS rank_score,
  CAST(rank_comments AS INTEGER) AS rank_comments
FROM (SELECT *,
    row_number() OVER (PARTITION BY ds ORDER BY score DESC NULLS LAST, submission_id) AS rank_score,
    row_number() OVER (PARTITION BY ds ORDER BY num_comments DESC NULLS LAST, submission_id) AS rank_comments
  FROM bronze) r
WHERE rank_score <= 10 OR rank_comments <= 10""")

for _name, _key in (("limit_newest_per_subreddit", "created_utc_unix"), ("limit_top_per_subreddit", "score")):
    oracle(_name, ["bronze_dedup"], f"""
SELECT ds, raw_subreddit_name AS subreddit, submission_id, {_key} FROM (
  SELECT *, row_number() OVER (PARTITION BY ds, raw_subreddit_name
      ORDER BY {_key} DESC NULLS LAST, submission_id) AS rn FROM bronze_dedup) r
WHERE rn <= 10""")

# --- landing ---------------------------------------------------------------
oracle("land_submissions", ["landed_submissions"], "SELECT * FROM landed_submissions")
oracle("union_sources", ["landed_submissions"], "SELECT * FROM landed_submissions")
oracle("land_comments", ["landed_comments"], "SELECT * FROM landed_comments")
oracle("normalize_defaults", ["landed_submissions"], """
SELECT submission_id, retrieved_utc_unix, author_name, score, num_comments, upvote_ratio, edited,
  stickied, flair, permalink FROM landed_submissions""")
oracle("distinct_by_key", ["raw_comments_fx"], """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY ds, comment_id ORDER BY retrieved_utc_unix DESC NULLS LAST) AS rn
  FROM raw_comments_fx) d WHERE rn = 1""")
oracle("limit_comments_per_submission", ["landed_comments"], """
SELECT ds, submission_id, comment_id, created_utc_unix FROM (
  SELECT *, row_number() OVER (PARTITION BY ds, submission_id
      ORDER BY created_utc_unix ASC NULLS LAST, comment_id ASC NULLS LAST) AS rn
  FROM landed_comments) c WHERE rn <= 3""")
oracle("flatten_comments", [], S.flatten_sql())
oracle("reject_bad_rows", [], """
SELECT outcome, COUNT(*) AS rows FROM (
  SELECT CASE WHEN doc_id % 53 = 0 THEN 'malformed_json' WHEN doc_id % 59 = 0 THEN 'missing:id'
              WHEN doc_id % 41 = 0 THEN 'bad_type:score' ELSE 'ok' END AS outcome
  FROM documents, (SELECT unnest([0, 1, 2]) AS f) fetches
  WHERE f = 0 OR doc_id % (f + 1) = 0) o
GROUP BY outcome""")


# --- sinks, scans, publish, changes, backfill ----------------------------
from postlake.sources import fixtures as FXS  # noqa: E402

_D = [f"DATE '{FXS.BASE_DS}' + {i}" for i in range(FXS.N_DAYS)]
oracle("scan_partition", ["raw_submissions_fx"], f"SELECT * FROM raw_submissions_fx WHERE ds = {_D[2]}")
oracle("scan_full", ["raw_submissions_fx"], "SELECT * FROM raw_submissions_fx")
oracle("sink_overwrite_partitions", ["raw_submissions_fx"], f"""
SELECT * FROM raw_submissions_fx
WHERE (ds IN ({_D[0]}, {_D[1]}, {_D[2]}) AND retrieved_utc_unix - created_utc_unix >= {FXS.FETCH_STEP})
   OR (ds NOT IN ({_D[0]}, {_D[1]}, {_D[2]}) AND retrieved_utc_unix - created_utc_unix < {FXS.FETCH_STEP})""")
oracle("sink_replace_where", ["silver", "silver_v1"], f"""
SELECT * FROM silver_v1 WHERE ds NOT IN ({_D[2]}, {_D[3]})
UNION ALL SELECT * FROM silver WHERE ds = {_D[2]}""")
ORACLE["sink_full_overwrite"] = ORACLE["gold_author_profiles"]
ORACLE["publish_audited"] = ORACLE["silver_submissions"]
ORACLE["backfill"] = ORACLE["gold_topic_trends"]
ORACLE["backfill_top_daily"] = ORACLE["gold_top_daily"]
ORACLE["backfill_author_profiles"] = ORACLE["gold_author_profiles"]

_SILVER_VALUES = [c for c in """content_type author_name content_subreddit text_title text_content text_url
text_category game_topic class_type is_game_topic ai_sentiment ai_topics edited is_trending
upvote_ratio_bin num_comments_bin score_bin is_self over_18 num_comments score spoiler
created_at_timestamp _loaded_at_timestamp_utc""".split()]
_b = ", ".join(f"b.{c}" for c in _SILVER_VALUES)
_a = ", ".join(f"a.{c}" for c in _SILVER_VALUES)
_cols = ", ".join(_SILVER_VALUES)
oracle("partition_changes", ["silver", "silver_v1"], f"""
SELECT 'insert' AS _change_type, ds, content_id, {_cols} FROM silver a
  WHERE NOT EXISTS (SELECT 1 FROM silver_v1 b WHERE b.ds = a.ds AND b.content_id = a.content_id)
UNION ALL
SELECT 'delete', ds, content_id, {_cols} FROM silver_v1 b
  WHERE NOT EXISTS (SELECT 1 FROM silver a WHERE b.ds = a.ds AND b.content_id = a.content_id)
UNION ALL
SELECT 'update_preimage', b.ds, b.content_id, {_b} FROM silver_v1 b JOIN silver a USING (ds, content_id)
  WHERE row({_b}) IS DISTINCT FROM row({_a})
UNION ALL
SELECT 'update_postimage', a.ds, a.content_id, {_a} FROM silver_v1 b JOIN silver a USING (ds, content_id)
  WHERE row({_b}) IS DISTINCT FROM row({_a})""")

oracle("qc_report", ["raw_submissions_fx", "bronze_dedup"], f"""
SELECT r.ds, r.raw_rows, coalesce(k.deduped_rows, 0) AS deduped_rows,
  coalesce(k.final_rows, 0) AS final_rows,
  r.raw_rows - coalesce(k.deduped_rows, 0) AS dropped_by_dedup,
  coalesce(k.deduped_rows, 0) - coalesce(k.final_rows, 0) AS dropped_by_qc
FROM (SELECT ds, COUNT(*) AS raw_rows FROM raw_submissions_fx GROUP BY ds) r
LEFT JOIN (SELECT ds, COUNT(*) AS deduped_rows,
             COUNT(*) FILTER (WHERE {S.QC_WHERE}) AS final_rows
           FROM bronze_dedup GROUP BY ds) k USING (ds)""")

oracle("land_record_files", ["file_landed"], "SELECT * FROM file_landed")
oracle("land_record_files_rejects", ["file_records"], """
SELECT reason AS _reject_reason, COUNT(*) AS rows FROM (
  SELECT reject_reason AS reason FROM file_records WHERE reject_reason IS NOT NULL
  UNION ALL
  SELECT 'bad_comment:missing:id' FROM file_records WHERE reject_reason IS NULL AND bad_first_comment) r
GROUP BY reason""")
oracle("land_record_files_edited", ["file_silver"], "SELECT ds, content_id, edited FROM file_silver")
oracle("land_record_files_comments", ["file_landed_comments"], "SELECT * FROM file_landed_comments")
oracle("land_comments_two_days", ["two_days_landed"], "SELECT * FROM two_days_landed")
ORACLE["profiles_full_then_incremental"] = ORACLE["gold_author_profiles"]
ORACLE["bronze_daily_runs"] = ORACLE["bronze_submissions"]
oracle("bronze_daily_runs_all_days", ["bronze_dedup_all"], f"SELECT {BRONZE_OUT} FROM bronze_dedup_all WHERE {S.QC_WHERE}")
ORACLE["topk_either_5000"] = ORACLE["topk_either"].replace("<= 10", "<= 5000")
oracle("land_reply_trees", ["tree_landed"], "SELECT * FROM tree_landed")
oracle("land_reply_trees_first", ["tree_first_landed"], "SELECT * FROM tree_first_landed")

# --- versions over all days, lexicon table, sketches ------------------------
_AGAIN = """SELECT * FROM raw_submissions_all_fx
WHERE ds <> DATE '2025-07-03'
  AND (ds <> DATE '2025-07-01' OR retrieved_utc_unix - created_utc_unix < {step})"""
oracle("bronze_days_landed_again", ["raw_submissions_all_fx"], f"SELECT {BRONZE_OUT} FROM again_dedup WHERE {S.QC_WHERE}",
       [("raw_again", _AGAIN.format(step=S.FX.FETCH_STEP)), ("again_dedup", S.bronze_dedup_sql("raw_again", "all"))])

_AGAIN_DAY = [("raw_again", _AGAIN.format(step=S.FX.FETCH_STEP).replace("raw_submissions_all_fx", "raw_submissions_fx")),
              ("again_dedup", S.bronze_dedup_sql("raw_again")),
              ("again_bronze", f"SELECT * FROM again_dedup WHERE {S.QC_WHERE}"),
              ("again_enriched", S.enriched_sql("again_bronze")), ("again_silver", S.silver_sql("again_enriched"))]
oracle("profiles_days_replaced", ["raw_submissions_fx"], GOLD_AUTHOR_PROFILES_BODY.replace("FROM silver", "FROM again_silver"), _AGAIN_DAY)
oracle("publish_by_location", ["raw_submissions_fx"], "SELECT * FROM again_silver", _AGAIN_DAY)
ORACLE["version_changes"] = ORACLE["partition_changes"]

_TOKENS = "list_filter(string_split_regex(lower(concat_ws(' ', title, selftext)), '[^a-z]+'), lambda x: x <> '')"
oracle("ai_sentiment_lexicon", ["bronze_dedup"], f"""
SELECT b.ds, b.submission_id,
  CASE WHEN b.positive > 0 AND b.negative > 0 THEN 'mixed' WHEN b.positive > 0 THEN 'positive'
       WHEN b.negative > 0 THEN 'negative' ELSE 'neutral' END AS ai_sentiment, b.positive, b.negative
FROM (SELECT ds, submission_id, CAST(coalesce(sum(w) FILTER (WHERE w > 0), 0) AS BIGINT) AS positive,
        CAST(coalesce(-sum(w) FILTER (WHERE w < 0), 0) AS BIGINT) AS negative
      FROM (SELECT ds, submission_id, CASE WHEN word = '' THEN 0 ELSE ascii(md5(word)) % 7 - 3 END AS w
            FROM (SELECT ds, submission_id, unnest(list_distinct(list_append({_TOKENS}, ''))) AS word
                  FROM bronze_dedup) t) u
      GROUP BY ds, submission_id) b""")
oracle("ai_sentiment_lexicon_default", ["bronze_dedup"], f"""
SELECT ds, submission_id, {S.sentiment_sql('full_text')} AS ai_sentiment
FROM (SELECT *, concat_ws(' ', title, selftext) AS full_text FROM bronze_dedup) b""")

oracle("agg_count_distinct_approx", ["silver"], """
SELECT CAST(ds AS VARCHAR) AS period, COUNT(DISTINCT game_topic) AS exact_topics,
  COUNT(DISTINCT author_name) AS exact_authors, TRUE AS topics_near, TRUE AS authors_near, TRUE AS merged_equal
FROM silver GROUP BY ds
UNION ALL
SELECT 'week', COUNT(DISTINCT game_topic), COUNT(DISTINCT author_name), TRUE, TRUE, TRUE FROM silver""")

oracle("qc_dropped", ["bronze_dedup"], """
SELECT ds, submission_id, score, created_utc_unix,
  CASE WHEN submission_id IS NULL THEN 'no id' WHEN created_at_timestamp IS NULL THEN 'no creation time'
       WHEN score IS NULL THEN 'no score' ELSE 'negative score' END AS qc_reason
FROM bronze_dedup
WHERE submission_id IS NULL OR created_at_timestamp IS NULL OR score IS NULL OR score < 0""")

# --- keyword rules as a table ------------------------------------------------
oracle("categorize_text_rules", ["bronze_dedup"],
       f"SELECT ds, submission_id, {S.category_sql()} AS text_category FROM bronze_dedup")
oracle("match_keyword_rules", ["bronze_dedup"], """
SELECT ds, submission_id, COUNT(*) AS keywords, min(struct_pack(rank, label)).label AS label
FROM bronze_dedup b JOIN (
  SELECT keyword, ascii(md5(keyword)) % 7 AS rank, substr(md5(keyword), 2, 1) AS label
  FROM (SELECT DISTINCT unnest(string_split_regex(lower(selftext), '[^a-z]+')) AS keyword FROM bronze_dedup) w
  WHERE length(keyword) = 4) r
  ON contains(lower(b.title), r.keyword) OR contains(lower(b.selftext), r.keyword)
GROUP BY ds, submission_id""")
