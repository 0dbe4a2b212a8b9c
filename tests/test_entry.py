import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

TABLES = ["documents", "conversations"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["ds", "game_topic", "submission_count", "avg_score", "avg_num_comments",
                          "trending_ratio"]


def test_every_query_of_the_library_has_an_oracle():
    from postlake.oracle.queries import ORACLE
    from postlake.plans.queries import QUERIES
    assert set(QUERIES) - set(ORACLE) == set()
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", [
    "bronze_submissions", "silver_submissions", "gold_topic_trends", "gold_sentiment_topic",
    "gold_top_daily", "rank_by_score", "qc_report",
    "categorize_text", "ai_topics", "flatten_comments", "reject_bad_rows", "land_comments",
    "land_record_files", "land_record_files_rejects", "land_record_files_edited", "land_record_files_comments",
    "land_comments_two_days", "bronze_daily_runs_all_days", "profiles_full_then_incremental", "topk_either_5000",
    "partition_changes", "sink_replace_where", "match_keyword", "union_sources", "backfill_author_profiles", "doc_trending_summary",
    "version_changes", "publish_by_location", "categorize_text_rules", "match_keyword_rules",
])
def test_query_matches_oracle_sf0001(spark, name):
    from postlake.oracle.compare import duck_connection, duck_rows, spark_rows
    con = duck_connection(SF_SMALL, TABLES)
    cols_s, got = spark_rows(E.queries()[name](spark, SF_SMALL))
    cols_d, want = duck_rows(con, E.oracle_sql()[name])
    assert cols_s == cols_d
    assert got == want


def test_queries_leave_the_session_settings_alone(spark):
    before = dict(spark.sparkContext.getConf().getAll()), {
        k: spark.conf.get(k) for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
                                       "spark.sql.constraintPropagation.enabled")}
    for name in ("silver_submissions", "land_submissions", "bronze_dedup_all_days", "backfill"):
        E.queries()[name](spark, SF_SMALL).count()
    assert before == (dict(spark.sparkContext.getConf().getAll()), {k: spark.conf.get(k) for k in before[1]})


def test_changed_rules_turn_oracle_rows_red():
    """The oracle states its rules itself: nothing is imported from the rules."""
    import inspect

    from postlake.oracle import queries, sql
    for module in (queries, sql):
        source = inspect.getsource(module)
        assert "postlake.functions" not in source
