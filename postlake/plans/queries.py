"""Registered queries: name → callable(spark, sf_dir) → DataFrame.

Every query reads the supplied test tables through the fixtures, over
whole tables and whole texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from postlake.operators import gold as G
from postlake.operators import topk as K
from postlake.plans.chain import bronze_fx, silver_fx
from postlake.session import free_shuffles, stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        return fn
    return deco


def _on_silver(fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(silver_fx(spark, sf_dir))


# --- layers ---------------------------------------------------------------
register("bronze_submissions")(lambda spark, d: bronze_fx(spark, d))
register("silver_submissions")(lambda spark, d: silver_fx(spark, d))

# --- gold -----------------------------------------------------------------
register("gold_topic_trends")(_on_silver(G.gold_topic_trends))
register("gold_sentiment_topic")(_on_silver(G.gold_sentiment_topic))
register("gold_topic_time_series")(_on_silver(G.gold_topic_time_series))
register("gold_author_profiles")(_on_silver(G.gold_author_profiles))
# the report reads silver as a written table, as run_range does
register("gold_top_daily")(lambda spark, d: K.gold_top_daily(stored(silver_fx(spark, d), "silver")))


# --- bronze / silver steps ------------------------------------------------
from pyspark.sql import functions as F  # noqa: E402

from postlake.functions import rule_table as RT  # noqa: E402
from postlake.functions import rules as R  # noqa: E402
from postlake.functions import text_ai as AI  # noqa: E402
from postlake.functions import timefmt as TF  # noqa: E402
from postlake.operators.bronze import bronze_project, dedup_latest, qc_dropped  # noqa: E402
from postlake.operators.silver import candidate_filter  # noqa: E402
from postlake.plans.chain import bronze_dedup_fx, enriched_fx, raw_fx  # noqa: E402


@register("bronze_dedup_latest")
def _q_dedup(spark, d):
    return bronze_dedup_fx(spark, d)


@register("bronze_dedup_all_days")
def _q_dedup_all(spark, d):
    from postlake.sources.fixtures import raw_submissions_fx
    return bronze_project(dedup_latest(raw_submissions_fx(spark, d, scope="all"), scope="all"))


@register("qc_filter")
def _q_qc(spark, d):
    return bronze_fx(spark, d)


@register("qc_dropped")
def _q_qc_dropped(spark, d):
    """The latest versions that quality control drops, and why."""
    return qc_dropped(bronze_dedup_fx(spark, d)).select("ds", "submission_id", "score", "created_utc_unix", "qc_reason")


@register("project_fixed")
def _q_project(spark, d):
    """Ordered, typed bronze projection of every raw row (no dedup)."""
    return bronze_project(raw_fx(spark, d))


@register("rename_columns")
def _q_rename(spark, d):
    s = silver_fx(spark, d)
    return s.select("content_id", "content_type", "content_subreddit", "text_title",
                    "text_content", "text_url", "class_type", "ds")


@register("candidate_filter")
def _q_cand(spark, d):
    e = candidate_filter(enriched_fx(spark, d))
    return e.select("ds", "submission_id", "is_trending", "full_text")


def _scalar(name: str, out):
    """Register a query applying scalar expressions to deduped bronze rows.

    ``out`` builds {column: expression} lazily (Columns need a session)."""
    def q(spark, d):
        b = bronze_dedup_fx(spark, d).withColumn("full_text", R.concat_text("title", "selftext"))
        return b.select("ds", "submission_id", *[expr.alias(k) for k, expr in out().items()])
    register(name)(q)


_scalar("bin_score", lambda: {"score": F.col("score"), "score_bin": R.bin_score("score")})
_scalar("bin_num_comments", lambda: {"num_comments": F.col("num_comments"),
                             "num_comments_bin": R.bin_num_comments("num_comments")})
_scalar("bin_upvote_ratio", lambda: {"upvote_ratio": F.col("upvote_ratio"),
                             "upvote_ratio_bin": R.bin_upvote_ratio("upvote_ratio")})
_scalar("flag_trending", lambda: {"is_trending": R.flag_trending("score", "num_comments")})
_scalar("categorize_text", lambda: {"text_category": R.categorize_text("title", "selftext", "raw_subreddit_name")})
_scalar("map_game_topic", lambda: {"raw_subreddit_name": F.col("raw_subreddit_name"),
                           "game_topic": R.map_game_topic("raw_subreddit_name")})
_scalar("flag_game_topic", lambda: {"is_game_topic": R.flag_game_topic(R.map_game_topic("raw_subreddit_name"))})
_scalar("flag_candidate", lambda: {"is_ai_enrichment_candidate":
                           R.flag_candidate(R.flag_trending("score", "num_comments"), "full_text")})
_scalar("flag_edited", lambda: {"edited": F.col("edited"), "is_edited": R.flag_edited("edited")})
_scalar("concat_text", lambda: {"full_text": F.col("full_text")})
_scalar("text_length", lambda: {"text_length": R.text_length("full_text")})
_scalar("in_list", lambda: {
    "in_game_specific": R.in_list(F.lower("raw_subreddit_name"), R.CATEGORY_SUBREDDIT_RULES[0][1]),
    "in_general_gaming": R.in_list(F.lower("raw_subreddit_name"), R.CATEGORY_SUBREDDIT_RULES[1][1]),
})
_scalar("ts_from_unix", lambda: {"created_utc_unix": F.col("created_utc_unix"),
                         "created_ts": TF.ts_from_unix("created_utc_unix")})
_scalar("iso_from_unix", lambda: {"created_iso": TF.iso_from_unix("created_utc_unix")})
_scalar("date_from_string", lambda: {"created_date": TF.date_from_string("raw_created_utc_str")})
_scalar("ai_sentiment", lambda: {"ai_sentiment": AI.ai_sentiment("full_text")})
_scalar("ai_topics", lambda: {"ai_topics": AI.ai_topics("full_text")})


@register("match_keyword")
def _q_kw(spark, d):
    """Per day and keyword: submissions whose title or self text contains it
    (one conditional count per keyword; the few result rows are unpivoted)."""
    b = bronze_dedup_fx(spark, d).select("ds", F.lower("title").alias("t"), F.lower("selftext").alias("s"))
    kws = [k for _, ks in R.CATEGORY_KEYWORD_RULES for k in ks]
    counts = b.groupBy("ds").agg(*[
        F.count_if(F.coalesce(R.match_keyword(F.col("t"), k), F.lit(False))
                   | F.coalesce(R.match_keyword(F.col("s"), k), F.lit(False))).alias(f"k{i}")
        for i, k in enumerate(kws)])
    pairs = F.array(*[F.struct(F.lit(k).alias("keyword"), F.col(f"k{i}").alias("hits")) for i, k in enumerate(kws)])
    return counts.select("ds", F.inline(pairs))


@register("ai_sentiment_lexicon")
def _q_lexicon(spark, d):
    """Sentiment by a lexicon table: every word of the documents, weighted from
    -3 to 3 by its digest."""
    words = bronze_dedup_fx(spark, d).select(F.explode(F.array_distinct(AI.tokens(
        R.concat_text("title", "selftext")))).alias("word")).distinct()
    lexicon = words.withColumn("weight", F.ascii(F.md5(F.col("word").cast("binary"))) % 7 - 3)
    b = bronze_dedup_fx(spark, d).withColumn("full_text", R.concat_text("title", "selftext"))
    return AI.lexicon_sentiment(b, ["ds", "submission_id"], "full_text", lexicon)


@register("ai_sentiment_lexicon_default")
def _q_lexicon_default(spark, d):
    """The same plan with the built-in words."""
    b = bronze_dedup_fx(spark, d).withColumn("full_text", R.concat_text("title", "selftext"))
    return AI.lexicon_sentiment(b, ["ds", "submission_id"], "full_text", AI.default_lexicon(spark)).select(
        "ds", "submission_id", "ai_sentiment")


@register("categorize_text_rules")
def _q_rules(spark, d):
    """Categories from the built-in keywords as a rule table."""
    return RT.categorize_by_rules(bronze_dedup_fx(spark, d), ["ds", "submission_id"], "title", "selftext",
                                  "raw_subreddit_name", RT.compile_rules(RT.default_rules(spark)))


@register("match_keyword_rules")
def _q_many_rules(spark, d):
    """Every rule that a text meets, by a rule table of the texts' own words of
    four letters (over 1,000), dealt over labels and ranks by their digest."""
    b = bronze_dedup_fx(spark, d)
    digest = F.md5(F.col("keyword").cast("binary"))
    words = b.select(F.explode(AI.tokens("selftext")).alias("keyword")).where("length(keyword) = 4").distinct()
    rules = words.select((F.ascii(digest) % 7).alias("rank"), F.substring(digest, 2, 1).alias("label"), "keyword")
    compiled = RT.compile_rules(rules)
    found = RT.match_keywords(b, ["ds", "submission_id"], ["title", "selftext"], compiled)
    return RT.with_label(found.groupBy("ds", "submission_id").agg(
        F.count(F.lit(1)).alias("keywords"), F.min("place").alias("place")), compiled)


@register("ai_custom_model")
def _q_custom(spark, d):
    """User model hook (Arrow-batched pandas UDF) on candidates' full text."""
    e = candidate_filter(enriched_fx(spark, d)).select("ds", "submission_id", "full_text")
    out = AI.ai_custom_model(e, "full_text", AI.lexicon_sentiment_model, "ai_sentiment")
    return out.select("ds", "submission_id", "ai_sentiment")


# --- aggregates on silver --------------------------------------------------
def _daily(name: str, aggs):
    """Daily aggregate of silver; ``aggs`` builds the aggregate list lazily."""
    register(name)(lambda spark, d: silver_fx(spark, d).groupBy("ds").agg(*aggs()))


_daily("agg_count", lambda: [F.count(F.lit(1)).alias("rows")])
_daily("agg_avg", lambda: [F.avg("score").alias("avg_score"),
                           F.avg("num_comments").alias("avg_num_comments")])
_daily("agg_conditional_sum", lambda: [
    F.sum(F.when(F.col("is_trending"), 1).otherwise(0)).cast("bigint").alias("trending_count")])
_daily("agg_conditional_avg", lambda: [
    F.avg(F.when(F.col("is_trending"), 1).otherwise(0)).alias("trending_ratio")])
_daily("agg_ratio", lambda: [(F.sum(F.when(F.col("ai_sentiment") == "positive", 1).otherwise(0))
                              / F.count(F.lit(1))).alias("positive_ratio")])
_daily("agg_count_distinct", lambda: [F.countDistinct("game_topic").alias("topics"),
                                      F.countDistinct("author_name").alias("authors")])
_daily("agg_collect_distinct", lambda: [F.sort_array(F.collect_set("ai_topics")).alias("topics")])
_daily("agg_min_max", lambda: [F.min("created_at_timestamp").alias("first_created"),
                               F.max("created_at_timestamp").alias("last_created")])



@register("agg_count_distinct_approx")
def _q_distinct_approx(spark, d):
    """Approximate distinct authors and topics, per day and for the week from
    the days' sketches, against exact counts."""
    silver = silver_fx(spark, d)
    names = {"topics": "game_topic", "authors": "author_name"}
    daily = G.distinct_sketches(silver, ["ds"], names)
    week = G.distinct_estimates(G.merge_sketches(daily, [], names), [], names)
    at_once = G.distinct_estimates(G.distinct_sketches(silver, [], names), [], names)
    exact = [F.countDistinct(c).alias(f"exact_{n}") for n, c in names.items()]
    near = [(F.abs(F.col(n) - F.col(f"exact_{n}")) <= G.SKETCH_ERROR * F.col(f"exact_{n}")).alias(f"{n}_near") for n in names]
    by_day = G.distinct_estimates(daily, ["ds"], names).join(silver.groupBy("ds").agg(*exact), "ds").select(
        F.col("ds").cast("string").alias("period"), *[f"exact_{n}" for n in names], *near, F.lit(True).alias("merged_equal"))
    merged = F.lit(True)
    both = week.join(at_once.withColumnsRenamed({n: f"once_{n}" for n in names}))
    for n in names:
        merged = merged & (F.col(n) == F.col(f"once_{n}"))
    whole = both.join(silver.agg(*exact)).select(
        F.lit("week").alias("period"), *[f"exact_{n}" for n in names], *near, merged.alias("merged_equal"))
    return by_day.unionByName(whole)


register("author_profiles_incremental")(
    lambda spark, d: G.author_profiles_from_partials(G.author_daily_partials(silver_fx(spark, d))))

# --- documented dashboard aggregates --------------------------------------
for _name in ("doc_subreddit_activity_daily", "doc_subreddit_activity_weekly",
              "doc_category_trends_daily", "doc_top_authors_daily", "doc_trending_summary",
              "doc_sentiment_summary"):
    register(_name)(_on_silver(getattr(G, _name)))

# --- windows / top-k --------------------------------------------------------
def _ranked(order_col: str, rank_col: str) -> Query:
    """Every silver row's daily rank: rows are numbered, stored, then ranked."""
    def q(spark, d):
        numbered = stored(K.number_rows(silver_fx(spark, d), order_col), "numbered")
        return K.daily_rank(numbered, rank_col)
    return q


register("rank_by_score")(_ranked("score", "rank_score"))
register("rank_by_comments")(_ranked("num_comments", "rank_comments"))


@register("rank_or_filter")
def _q_rank_or(spark, d):
    """``rank_score <= 10 OR rank_comments <= 10`` from the two full daily
    ranks (not the candidate plan of gold_top_daily)."""
    by_score = _ranked("score", "rank_score")(spark, d)
    by_comments = _ranked("num_comments", "rank_comments")(spark, d)
    both = by_score.join(by_comments, ["ds", "content_id"])
    out = both.filter("rank_score <= 10 OR rank_comments <= 10")
    return out.select("ds", "content_id", "score", "num_comments", F.col("rank_score").cast("int").alias("rank_score"),
                      F.col("rank_comments").cast("int").alias("rank_comments"))


def _topk_bronze(k: int) -> Query:
    def q(spark, d):
        b = stored(bronze_fx(spark, d), "bronze")
        out = K.top_k_either(b, "submission_id", [("score", "rank_score"), ("num_comments", "rank_comments")], k)
        return out.select("ds", "submission_id", "score", "num_comments", "rank_score", "rank_comments")
    return q


# Top-k by score or by comments over bronze rows, both ranks exact.
register("topk_either")(_topk_bronze(10))
register("topk_either_5000")(_topk_bronze(5000))


@register("limit_newest_per_subreddit")
def _q_newest(spark, d):
    """The newest 10 submissions (latest version of each) per day and subreddit."""
    r = K.limit_newest_per_subreddit(dedup_latest(raw_fx(spark, d)), n=10)
    return r.select("ds", "subreddit", "submission_id", "created_utc_unix")


@register("limit_top_per_subreddit")
def _q_top(spark, d):
    r = K.limit_top_per_subreddit(dedup_latest(raw_fx(spark, d)), n=10)
    return r.select("ds", "subreddit", "submission_id", "score")


# --- landing ---------------------------------------------------------------
from postlake.sources import fixtures as FXS  # noqa: E402
from postlake.sources import landing as L  # noqa: E402


@register("land_submissions")
def _q_land_sub(spark, d):
    return L.land_submissions(FXS.submission_records_fx(spark, d))


@register("land_comments")
def _q_land_com(spark, d):
    return L.land_comments(FXS.comment_records_fx(spark, d))


@register("normalize_defaults")
def _q_defaults(spark, d):
    """Only the defaulted fields of landed submissions."""
    r = L.land_submissions(FXS.submission_records_fx(spark, d))
    return r.select("submission_id", "retrieved_utc_unix", "author_name", "score", "num_comments",
                    "upvote_ratio", "edited", "stickied", "flair", "permalink")


@register("distinct_by_key")
def _q_distinct(spark, d):
    return L.distinct_by_key(FXS.raw_comments_fx(spark, d), ["ds", "comment_id"])


@register("limit_comments_per_submission")
def _q_limit_comments(spark, d):
    c = L.land_comments(FXS.comment_records_fx(spark, d))
    return K.limit_comments_per_submission(c, n=3).select(
        "ds", "submission_id", "comment_id", "created_utc_unix")


@register("flatten_comments")
def _q_flatten(spark, d):
    return L.flatten_comments(FXS.nested_submissions_fx(spark, d))


@register("union_sources")
def _q_union(spark, d):
    """Three sources (one folder each, by fetch round) written apart, read back
    in one scan and landed together."""
    recs = FXS.submission_records_fx(spark, d)
    root = scratch_path(spark, "sources")
    fetch = ((F.col("retrieved_utc") - F.col("created_utc")) / FXS.FETCH_STEP).cast("int")
    recs.withColumn("source", fetch).write.partitionBy("source").parquet(root)
    good, _ = L.reject_bad_rows(L.read_records(spark, [f"{root}/source={i}" for i in range(3)], fmt="parquet"))
    return L.land_submissions(good)


@register("reject_bad_rows")
def _q_reject(spark, d):
    """Outcome counts of lenient JSON parsing: good rows and rejects by reason
    (one parse, grouped by outcome)."""
    parsed = L.parse_submission_json(FXS.submission_json_lines_fx(spark, d))
    return parsed.groupBy(F.coalesce("_reject_reason", F.lit("ok")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("rows"))


def _record_files(spark, d) -> str:
    """JSON record files of all documents (gzip, as saved by an API client),
    with broken lines, wrong types, boolean ``edited`` and nested comments."""
    path = scratch_path(spark, "records")
    FXS.record_lines_fx(spark, d).write.text(path, compression="gzip")
    free_shuffles(spark)
    return path


def _landed_files(spark, d, **limits) -> dict[str, str]:
    root = scratch_path(spark, "landed")
    paths = {n: f"{root}/{n}" for n in ("raw_submissions", "raw_comments", "rejects")}
    files = _record_files(spark, d)
    for _ in range(2):        # landing the same files again changes nothing
        land_files(spark, files, paths["raw_submissions"], paths["raw_comments"], paths["rejects"], **limits)
    return paths


@register("land_record_files")
def _q_land_files(spark, d):
    """Submissions landed from dirty JSON files: good rows only."""
    paths = _landed_files(spark, d)
    return ST.scan_full(spark, paths["raw_submissions"], RAW_SUBMISSIONS)


@register("land_record_files_rejects")
def _q_land_rejects(spark, d):
    paths = _landed_files(spark, d)
    return spark.read.parquet(paths["rejects"]).groupBy("_reject_reason").agg(F.count(F.lit(1)).alias("rows"))


@register("land_record_files_edited")
def _q_land_edited(spark, d):
    """The silver ``edited`` flag of submissions landed from those files."""
    paths = _landed_files(spark, d)
    raw = ST.scan_full(spark, paths["raw_submissions"], RAW_SUBMISSIONS)
    return silver_from_raw(raw).select("ds", "content_id", "edited")


@register("land_record_files_comments")
def _q_land_comments_files(spark, d):
    """Nested comments of the files, the first five of each list, landed."""
    paths = _landed_files(spark, d, comment_limit=5)
    return ST.scan_full(spark, paths["raw_comments"], RAW_COMMENTS)


def _landed_trees(spark, d, **limits) -> DataFrame:
    files, root = scratch_path(spark, "tree-records"), scratch_path(spark, "landed")
    FXS.reply_tree_lines_fx(spark, d).write.text(files)
    land_files(spark, files, f"{root}/raw_submissions", f"{root}/raw_comments", **limits)
    return ST.scan_full(spark, f"{root}/raw_comments", RAW_COMMENTS)


@register("land_reply_trees")
def _q_trees(spark, d):
    """Comments of reply trees of any depth, landed."""
    return _landed_trees(spark, d)


@register("land_reply_trees_first")
def _q_trees_first(spark, d):
    """The first five comments of each tree, level by level."""
    return _landed_trees(spark, d, comment_limit=5)


@register("land_comments_two_days")
def _q_land_comments_days(spark, d):
    """Comments fetched again a day later, both days landed in one call."""
    recs = FXS.comment_records_fx(spark, d)
    later = recs.withColumn("retrieved_utc", F.col("retrieved_utc") + 86400)
    return L.land_comments(recs.unionByName(later))


# --- sinks, scans, publish, changes, backfill ----------------------------
# Each writes into a fresh folder under the shared checkpoint root, then
# returns the table read back.
import datetime as _dt  # noqa: E402

from postlake.plans.backfill import run_range  # noqa: E402
from postlake.plans.chain import silver_v1_fx  # noqa: E402
from postlake.plans.chain import silver_from_raw  # noqa: E402
from postlake.plans.landing import land_files  # noqa: E402
from postlake.schemas import (GOLD_AUTHOR_PROFILES, RAW_COMMENTS, RAW_SUBMISSIONS, SILVER_SUBMISSIONS,  # noqa: E402
                              TABLES)
from postlake.session import scratch_path  # noqa: E402
from postlake.sinks import tables as ST  # noqa: E402
from postlake.sinks.changes import partition_changes, version_changes, write_version  # noqa: E402

FX_DAYS = [_dt.date.fromisoformat(FXS.BASE_DS) + _dt.timedelta(days=i) for i in range(FXS.N_DAYS)]


def _land_raw(spark, d) -> str:
    path = scratch_path(spark, "raw_submissions")
    ST.overwrite_partitions(raw_fx(spark, d), path)
    return path


@register("scan_partition")
def _q_scan_partition(spark, d):
    path = _land_raw(spark, d)
    return ST.scan_partition(spark, path, FX_DAYS[2], RAW_SUBMISSIONS)


@register("scan_full")
def _q_scan_full(spark, d):
    path = _land_raw(spark, d)
    return ST.scan_full(spark, path, RAW_SUBMISSIONS)


@register("sink_overwrite_partitions")
def _q_sink_dyn(spark, d):
    """First landing of every day, then a re-landing of the refetched rows
    of the first three days: only those three partitions are replaced."""
    path = scratch_path(spark, "raw_submissions")
    raw = raw_fx(spark, d)
    ST.overwrite_partitions(FXS.first_fetch(raw), path)
    refetched = raw.filter((F.col("retrieved_utc_unix") - F.col("created_utc_unix") >= FXS.FETCH_STEP)
                           & F.col("ds").isin(*FX_DAYS[:3]))
    ST.overwrite_partitions(refetched, path)
    return ST.scan_full(spark, path, RAW_SUBMISSIONS)


@register("sink_replace_where")
def _q_sink_replace(spark, d):
    """Silver as first landed for all days; then day 3 is re-run on the
    latest data and day 4 is re-run with no rows (it must become empty)."""
    path = scratch_path(spark, "silver_submissions")
    ST.replace_partitions(silver_v1_fx(spark, d), path, FX_DAYS)
    latest = silver_fx(spark, d)
    ST.replace_partition(latest.filter(F.col("ds") == F.lit(FX_DAYS[2])), path, FX_DAYS[2])
    ST.replace_partition(latest.filter(F.lit(False)), path, FX_DAYS[3])
    return ST.scan_full(spark, path, SILVER_SUBMISSIONS)


@register("sink_full_overwrite")
def _q_sink_full(spark, d):
    path = scratch_path(spark, "gold_author_profiles")
    ST.full_overwrite(G.gold_author_profiles(silver_v1_fx(spark, d)), path)
    ST.full_overwrite(G.gold_author_profiles(silver_fx(spark, d)), path)
    return ST.scan_full(spark, path, GOLD_AUTHOR_PROFILES)


@register("publish_audited")
def _q_publish(spark, d):
    path = scratch_path(spark, "silver_submissions")
    ST.publish_audited(silver_fx(spark, d), path, FX_DAYS,
                       not_null=ST.not_null_columns(SILVER_SUBMISSIONS), key=("ds", "content_id"))
    return ST.scan_full(spark, path, SILVER_SUBMISSIONS)


@register("partition_changes")
def _q_changes(spark, d):
    """Change rows of silver between the first landing and the latest one."""
    return partition_changes(silver_v1_fx(spark, d), silver_fx(spark, d), ["ds", "content_id"])


@register("version_changes")
def _q_version_changes(spark, d):
    """The same change rows from two stored versions: unequal buckets only."""
    before, after = scratch_path(spark, "version"), scratch_path(spark, "version")
    for df, path in ((silver_v1_fx(spark, d), before), (silver_fx(spark, d), after)):
        write_version(df, path, ["ds", "content_id"])
    return version_changes(spark, before, after, ["ds", "content_id"], SILVER_SUBMISSIONS)


def _backfill(spark, d) -> dict:
    raw_path = _land_raw(spark, d)
    out = scratch_path(spark, "lake")
    return run_range(spark, raw_path, out, FX_DAYS[0], FX_DAYS[-1]).paths


@register("backfill")
def _q_backfill(spark, d):
    """Whole week in one run; the daily topic trends read back."""
    paths = _backfill(spark, d)
    return ST.scan_full(spark, paths["gold_topic_trends"], TABLES["gold_topic_trends"][0])


@register("backfill_top_daily")
def _q_backfill_top(spark, d):
    paths = _backfill(spark, d)
    return ST.scan_full(spark, paths["gold_top_daily"], TABLES["gold_top_daily"][0])


@register("backfill_author_profiles")
def _q_backfill_profiles(spark, d):
    paths = _backfill(spark, d)
    return ST.scan_full(spark, paths["gold_author_profiles"], GOLD_AUTHOR_PROFILES)


@register("profiles_full_then_incremental")
def _q_profiles_mixed(spark, d):
    """Six days with profiles from silver, then the last day incrementally."""
    raw_path, out = _land_raw(spark, d), scratch_path(spark, "lake")
    run_range(spark, raw_path, out, FX_DAYS[0], FX_DAYS[-2], incremental_profiles=False)
    paths = run_range(spark, raw_path, out, FX_DAYS[-1], FX_DAYS[-1]).paths
    return ST.scan_full(spark, paths["gold_author_profiles"], GOLD_AUTHOR_PROFILES)


def _days_landed_again(spark, d, **run):
    """The week's days one by one; then day 3 is landed again with its first
    fetches only, day 5 with no rows, and each is run once more."""
    raw = raw_fx(spark, d)
    raw_path, out = scratch_path(spark, "raw_submissions"), scratch_path(spark, "lake")
    ST.overwrite_partitions(raw, raw_path)
    for day in FX_DAYS:
        run_range(spark, raw_path, out, day, day, **run)
    for day, again in ((FX_DAYS[2], FXS.first_fetch(raw)), (FX_DAYS[4], raw.filter(F.lit(False)))):
        ST.replace_partition(again.filter(F.col("ds") == F.lit(day)), raw_path, day)
        paths = run_range(spark, raw_path, out, day, day, **run).paths
    return paths


@register("profiles_days_replaced")
def _q_profiles_replaced(spark, d):
    """Profiles from the merged state after days were added, replaced and emptied."""
    paths = _days_landed_again(spark, d)
    return ST.scan_full(spark, paths["gold_author_profiles"], GOLD_AUTHOR_PROFILES)


@register("publish_by_location")
def _q_publish_location(spark, d):
    """The same runs with every layer published in the catalog; silver by name."""
    place = scratch_path(spark, "catalog")
    database = place.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{place}'")
    _days_landed_again(spark, d, database=database, publish=True)
    return spark.table(f"{database}.silver_submissions")


def _daily_runs(scope: str) -> Query:
    """Bronze of the week after seven runs of one day each, where every run
    sees the raw days landed so far."""
    def q(spark, d):
        raw = FXS.raw_submissions_fx(spark, d, scope)
        raw_path, out = scratch_path(spark, "raw_submissions"), scratch_path(spark, "lake")
        for day in FX_DAYS:
            ST.replace_partition(raw.filter(F.col("ds") == F.lit(day)), raw_path, day)
            paths = run_range(spark, raw_path, out, day, day, scope).paths
        return ST.scan_full(spark, paths["bronze_submissions"], TABLES["bronze_submissions"][0])
    return q


register("bronze_daily_runs")(_daily_runs("day"))
register("bronze_daily_runs_all_days")(_daily_runs("all"))


@register("bronze_days_landed_again")
def _q_landed_again(spark, d):
    """The week in one run over all days' versions; then day 3 is landed again
    with its first fetches only, day 5 with no rows, and each is run once more."""
    raw = FXS.raw_submissions_fx(spark, d, "all")
    raw_path, out = scratch_path(spark, "raw_submissions"), scratch_path(spark, "lake")
    ST.overwrite_partitions(raw, raw_path)
    run_range(spark, raw_path, out, FX_DAYS[0], FX_DAYS[-1], "all")
    for day, again in ((FX_DAYS[2], FXS.first_fetch(raw)), (FX_DAYS[4], raw.filter(F.lit(False)))):
        ST.replace_partition(again.filter(F.col("ds") == F.lit(day)), raw_path, day)
        paths = run_range(spark, raw_path, out, day, day, "all").paths
    return ST.scan_full(spark, paths["bronze_submissions"], TABLES["bronze_submissions"][0])


@register("qc_report")
def _q_qc_report(spark, d):
    from postlake.operators.bronze import qc_report
    return qc_report(raw_fx(spark, d))
