import math

from pyspark.sql import functions as F

from postlake.functions import rules as R
from postlake.functions import text_ai as AI


def _one(spark, data, schema, expr):
    df = spark.createDataFrame(data, schema)
    return [r[0] for r in df.select(expr).collect()]


def test_score_bins_edges(spark):
    data = [(None,), (-1,), (0,), (1,), (9,), (10,), (99,), (100,), (499,), (500,)]
    got = _one(spark, data, "score bigint", R.bin_score("score"))
    assert got == ["Negative", "Negative", "0", "1-9", "1-9", "10-99", "10-99", "100-499",
                   "100-499", "500+"]


def test_num_comments_bins_edges(spark):
    data = [(None,), (-1,), (0,), (1,), (9,), (10,), (49,), (50,), (99,), (100,)]
    got = _one(spark, data, "n bigint", R.bin_num_comments("n"))
    assert got == ["0", "0", "0", "1-9", "1-9", "10-49", "10-49", "50-99", "50-99", "100+"]


def test_upvote_ratio_bins_null_and_nan(spark):
    data = [(None,), (math.nan,), (0.49,), (0.5,), (0.69,), (0.7,), (0.89,), (0.9,), (1.0,)]
    got = _one(spark, data, "r double", R.bin_upvote_ratio("r"))
    low, mixed, mostly, high = R.UPVOTE_RATIO_BIN_ELSE, "Mixed (50-69%)", "Mostly Upvoted (70-89%)", \
        "Highly Upvoted (90%+)"
    # NaN compares greater than any number in Spark, so it lands in the top bin
    assert got == [low, high, low, mixed, mixed, mostly, mostly, high, high]


def test_trending_three_valued(spark):
    data = [(5, 4), (4, 4), (5, 3), (None, 4), (None, 3)]
    got = _one(spark, data, "s bigint, n bigint", R.flag_trending("s", "n"))
    assert got == [True, False, False, None, False]


def test_candidate_length_boundary(spark):
    data = [("x" * 500, False), ("x" * 501, False), ("", None), ("x" * 501, None), ("", True)]
    got = _one(spark, data, "t string, tr boolean", R.flag_candidate("tr", "t"))
    assert got == [False, True, None, True, True]


def test_category_priority_and_substring_traps(spark):
    data = [
        ("pro play UPDATE", None, "valorant"),      # rule 1 beats rule 2
        ("Aimbot again", None, None),               # 'bot' inside 'Aimbot'
        ("Explore the map", None, None),            # 'lore' inside 'Explore'
        ("Metal guide", None, None),                # 'meta' and 'guide'
        ("hello", "nothing here", "LeagueOfLegends"),  # mixed-case subreddit
        ("hello", None, "gaming"),
        ("hello", None, "globaloffensive"),         # topic but not in rule 9
        (None, None, None),                         # all NULL → falls through to Other
        ("A MEME", None, None),
    ]
    got = _one(spark, data, "t string, s string, sub string", R.categorize_text("t", "s", "sub"))
    assert got == ["Game Update/Patch", "Trust & Safety: Malicious Behavior", "Lore/Story",
                   "Gameplay Strategy/Tips", "Game Specific Discussion", "General Gaming Discussion",
                   "Other", "Other", "Community/Social"]


def test_null_title_does_not_block_selftext_match(spark):
    got = _one(spark, [(None, "a crash report")], "t string, s string",
               R.categorize_text("t", "s", F.lit(None).cast("string")))
    assert got == ["Bug Report/Technical"]


def test_game_topic_and_flag(spark):
    data = [("LeagueOfLegends",), ("globaloffensive",), ("cooking",), (None,)]
    df = spark.createDataFrame(data, "sub string").select(R.map_game_topic("sub").alias("g"))
    got = [(r.g, r.f) for r in df.select("g", R.flag_game_topic("g").alias("f")).collect()]
    assert got == [("League of Legends", True), ("CS:GO", True), ("Other Game", False),
                   ("Other Game", False)]


def test_edited_flag_forms(spark):
    data = [("1751155999.0",), ("false",), (None,), ("False",)]
    got = _one(spark, data, "e string", R.flag_edited("e"))
    assert got == [True, True, None, False]


def test_concat_skips_nulls(spark):
    data = [("a", "b"), (None, "b"), ("a", None), (None, None)]
    assert _one(spark, data, "t string, s string", R.concat_text("t", "s")) == ["a b", "b", "a", ""]


def test_sentiment_labels(spark):
    data = [("I love this great champion",), ("awful and broken queue",),
            ("love the idea, hate the result",), ("nothing to see",), (None,),
            ("glove and badge",)]  # no whole-word hit inside other words
    got = _one(spark, data, "t string", AI.ai_sentiment("t"))
    assert got == ["positive", "negative", "mixed", "neutral", None, "neutral"]


def test_topic_argmax_and_ties(spark):
    data = [("patch update crash",),           # 2 vs 1 → update/patch
            ("crash and tournament",),         # tie 1-1 → earlier label (Bug Report)
            ("nothing",),
            ("a bot and a cheat and a bug",)]  # 2 bots vs 1 bug
    got = _one(spark, data, "t string", AI.ai_topics("t"))
    assert got == ["Game Update/Patch", "Bug Report/Technical", "Other", "Player Bots/Detected"]


def test_custom_model_hook_matches_native(spark):
    data = [("I love it",), ("so bad",), ("love and hate",), ("meh",), (None,)]
    df = spark.createDataFrame(data, "t string")
    out = AI.ai_custom_model(df, "t", AI.lexicon_sentiment_model, "m")
    got = [(r.n, r.m) for r in out.select(AI.ai_sentiment("t").alias("n"), "m").collect()]
    assert all(n == m for n, m in got)


def test_sql_text_path_equals_column_path_on_fixture(spark):
    from postlake.plans.chain import bronze_dedup_fx
    from tests.conftest import SF_SMALL
    b = bronze_dedup_fx(spark, SF_SMALL).withColumn("full_text", R.concat_text("title", "selftext"))
    c = F.col
    pairs = {
        "score_bin": (R.bin_score("score"), R.bin_score(c("score"))),
        "nc_bin": (R.bin_num_comments("num_comments"), R.bin_num_comments(c("num_comments"))),
        "ratio_bin": (R.bin_upvote_ratio("upvote_ratio"), R.bin_upvote_ratio(c("upvote_ratio"))),
        "trend": (R.flag_trending("score", "num_comments"), R.flag_trending(c("score"), c("num_comments"))),
        "cat": (R.categorize_text("title", "selftext", "raw_subreddit_name"),
                R.categorize_text(c("title"), c("selftext"), c("raw_subreddit_name"))),
        "topic": (R.map_game_topic("raw_subreddit_name"), R.map_game_topic(c("raw_subreddit_name"))),
        "edited": (R.flag_edited("edited"), R.flag_edited(c("edited"))),
        "cand": (R.flag_candidate("is_self", "full_text"), R.flag_candidate(c("is_self"), c("full_text"))),
        "concat": (R.concat_text("title", "selftext"), R.concat_text(c("title"), c("selftext"))),
    }
    sel = []
    for k, (a, b_) in pairs.items():
        sel += [a.alias(f"{k}_sql"), b_.alias(f"{k}_col")]
    out = b.select(*sel).collect()
    for r in out:
        for k in pairs:
            assert r[f"{k}_sql"] == r[f"{k}_col"], k


def test_ai_labels_two_projection_form_equals_expressions(spark):
    from postlake.plans.chain import bronze_fx
    from tests.conftest import SF_SMALL
    b = bronze_fx(spark, SF_SMALL).withColumn("full_text", R.concat_text("title", "selftext"))
    b = b.withColumn("_lc", F.lower("full_text"))
    got = AI.with_ai_labels(b, "_lc", "s2", "t2").select(
        AI.ai_sentiment("full_text").alias("s1"), "s2", AI.ai_topics("full_text").alias("t1"), "t2").collect()
    assert all(r.s1 == r.s2 and r.t1 == r.t2 for r in got)


def test_candidate_from_parts_equals_concat_length(spark):
    data = [("x" * 250, "y" * 249), ("x" * 250, "y" * 250), (None, "y" * 501), ("x" * 501, None),
            (None, None), ("", "y" * 500), ("", "y" * 499)]
    df = spark.createDataFrame(data, "t string, s string").withColumn("tr", F.lit(False))
    got = df.select(R.flag_candidate_parts("tr", "t", "s").alias("a"),
                    R.flag_candidate(F.col("tr"), R.concat_text(F.col("t"), F.col("s"))).alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got] == [False, True, True, True, False, True, False]


def test_run_date_is_validated_up_front():
    import datetime as dt

    import pytest

    from postlake.functions.timefmt import ds_range, parse_ds
    assert parse_ds("2025-07-01") == dt.date(2025, 7, 1)
    for bad in ("2025-13-01", "2025-7-1", "20250701", "2025-07-01 00:00", ""):
        with pytest.raises(ValueError):
            parse_ds(bad)
    with pytest.raises(TypeError):
        parse_ds(dt.datetime(2025, 7, 1))        # a timestamp is not a run date
    assert len(ds_range("2025-06-29", "2025-07-05")) == 7
    with pytest.raises(ValueError):
        ds_range("2025-07-05", "2025-06-29")


def test_bins_and_trending_match_a_plain_python_reading_of_the_rules(spark):
    import random

    rnd = random.Random(17)

    def pick(vals):
        return rnd.choice(vals)

    data = [(pick([None, rnd.randint(-50, 900)]), pick([None, rnd.randint(-5, 200)]),
             pick([None, math.nan, round(rnd.random(), 2)])) for _ in range(600)]

    def py_bin(x, bins, zero=None, default=None):
        if x is None:
            return default
        for label, lo in bins:
            if x >= lo:
                return label
        if zero is not None and x == 0:
            return zero
        return default

    def py_ratio_bin(r):
        if r is None:
            return R.UPVOTE_RATIO_BIN_ELSE
        if math.isnan(r):                      # NaN sorts above every number in Spark
            return R.UPVOTE_RATIO_BINS[0][0]
        return py_bin(r, R.UPVOTE_RATIO_BINS, default=R.UPVOTE_RATIO_BIN_ELSE)

    def py_trending(s, n):
        a = None if s is None else s >= R.TRENDING_MIN_SCORE
        b = None if n is None else n >= R.TRENDING_MIN_COMMENTS
        if a is False or b is False:
            return False
        return None if a is None or b is None else True

    df = spark.createDataFrame(data, "s bigint, n bigint, r double")
    got = df.select("s", "n", "r", R.bin_score("s").alias("sb"), R.bin_num_comments("n").alias("nb"),
                    R.bin_upvote_ratio("r").alias("rb"), R.flag_trending("s", "n").alias("t")).collect()
    for row in got:
        assert row.sb == py_bin(row.s, R.SCORE_BINS, R.SCORE_BIN_ZERO, R.SCORE_BIN_ELSE)
        assert row.nb == py_bin(row.n, R.NUM_COMMENTS_BINS, default=R.NUM_COMMENTS_BIN_ELSE)
        assert row.rb == py_ratio_bin(row.r)
        assert row.t == py_trending(row.s, row.n)


def test_two_models_of_one_factory_are_two_models(spark):
    def make(answer):
        def loader():
            return lambda texts: texts.map(lambda _: answer)
        return loader

    df = spark.range(50).selectExpr("cast(id as string) AS t")
    for answer in ("first", "second", "first"):
        out = AI.ai_custom_model(df, "t", make(answer), "m")
        assert {r.m for r in out.select("m").collect()} == {answer}
    assert AI.loader_key(make("a")) != AI.loader_key(make("b")) and AI.loader_key(make("a")) == AI.loader_key(make("a"))
    kept = [AI.worker_model(f"k{i}", lambda i=i: i) for i in range(AI.KEPT_MODELS + 3)]
    assert len(AI._MODELS) <= AI.KEPT_MODELS and kept[-1] == AI.worker_model(f"k{AI.KEPT_MODELS + 2}", lambda: None)
