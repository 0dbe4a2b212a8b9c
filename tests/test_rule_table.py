"""Keyword rules as a table."""

import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postlake.functions import rule_table as RT
from postlake.functions import rules as R


def _rules(spark, rows):
    return RT.compile_rules(spark.createDataFrame(rows, RT.RULE_SCHEMA))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab .(", min_size=1, max_size=5), min_size=1, max_size=8), st.text("ab .(", max_size=20))
def test_tree_finds_the_longest_word_at_every_place(words, text):
    found = [m.group(1) for m in re.finditer(f"(?=({RT.tree_pattern(words)}))", text)]
    want = [max((w for w in words if text.startswith(w, i)), key=len) for i in range(len(text))
            if any(text.startswith(w, i) for w in words)]
    assert found == want


def test_hits_equal_brute_force_with_nested_and_odd_keywords(spark):
    rules = [(3, "x", "bot"), (1, "y", "botnet"), (2, "x", "net"), (0, "z", "a.b"), (5, "w", "(("), (4, "w", "é $"),
             (6, "q", "BOT"), (1, None, "tn"), (None, "n", "bo"), (7, "n", None), (7, "n", ""), (8, "e", "\\e\n")]
    texts = ["a botnet", "BOT", "axb a.b", "((( é $", None, "", "bo tn", "\\E\n", "net" * 500, "botbotnet"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string").withColumn("other", F.lit(None).cast("string"))
    compiled = _rules(spark, rules)
    got = {(r.k, r["rank"], r.label, r.keyword) for r in RT.match_keywords(df, ["k"], ["t", "other"], compiled).collect()}
    good = [(n, label, k.lower()) for n, label, k in rules if n is not None and k]
    want = {(i, n, label, k) for i, t in enumerate(texts) if t for n, label, k in good if k in t.lower()}
    assert got == want
    labels = {r.k: r.label for r in RT.rule_labels(df, ["k"], ["t"], compiled).collect()}
    least = {i: min(((n, label or "", label) for j, n, label, _ in want if j == i), default=(0, "", None))[2] for i in range(len(texts))}
    assert labels == least


def test_default_rules_equal_the_built_in_ones(spark):
    titles = ["Esports bug", "aimbot", "fan art!", "pro", "nothing", None, "META", "story guide"]
    subs = ["Valorant", "games", None, "x"]
    rows = [(i * 100 + j * 10 + k, t, s, sub) for i, t in enumerate(titles) for j, s in enumerate(["", None, "play lore"])
            for k, sub in enumerate(subs)]
    df = spark.createDataFrame(rows, "k int, title string, selftext string, sub string")
    got = RT.categorize_by_rules(df, ["k"], "title", "selftext", "sub", RT.compile_rules(RT.default_rules(spark)))
    want = df.select("k", R.categorize_text("title", "selftext", "sub").alias("text_category"))
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()}


def test_no_rules_and_too_many(spark, monkeypatch):
    df = spark.createDataFrame([(1, "bug"), (2, None)], "k int, t string")
    empty = _rules(spark, [])
    assert RT.match_keywords(df, ["k"], ["t"], empty).count() == 0
    assert {r.label for r in RT.rule_labels(df, ["k"], ["t"], empty).collect()} == {None}
    assert RT.rule_labels(df.limit(0), ["k"], ["t"], empty).count() == 0
    monkeypatch.setattr(RT, "MAX_KEYWORDS", 2)
    with pytest.raises(ValueError):
        _rules(spark, [(1, "a", "x"), (1, "a", "y"), (1, "a", "z")])


def test_time_does_not_grow_with_the_keywords(spark):
    words = [f"{a}{b}{c}q{d}" for a in "bcdfg" for b in "aeiou" for c in "klmnp" for d in "abcdefghijklmnopqrst"]
    df = spark.range(0, 20_000, numPartitions=4).select(
        F.concat_ws(" ", *[F.md5(F.concat(F.col("id"), F.lit(f":{i}")).cast("binary")) for i in range(8)]).alias("t"))

    def seconds(keywords):
        compiled = _rules(spark, [(i, "l", k) for i, k in enumerate(keywords)])
        best = 99.0
        for _ in range(3):
            start = time.time()
            df.select(F.sum(F.size(RT.longest_hits("t", compiled)))).collect()
            best = min(best, time.time() - start)
        return best

    assert len(words) == 2500
    assert seconds(words) < 6 * seconds(words[:25]) + 1       # a hundred times as many


def test_hits_are_no_rows_before_they_meet_the_rules(spark):
    compiled = _rules(spark, [(1, "a", "ab"), (0, None, "abc"), (0, "b", "abc"), (1, "c", "cd")])
    df = spark.createDataFrame([(1, "abc ab abd"), (1, "cd"), (None, "ab"), (None, "abc"), (2, None)], "k int, t string")
    found = RT.match_keywords(df, ["k"], ["t"], compiled)
    want = {(1, 1, "a", "ab"), (1, 0, None, "abc"), (1, 0, "b", "abc"), (1, 1, "c", "cd"),
            (None, 1, "a", "ab"), (None, 0, None, "abc"), (None, 0, "b", "abc")}
    plan = found._jdf.queryExecution().executedPlan().toString()
    rows = [(r.k, r["rank"], r.label, r.keyword) for r in found.collect()]
    assert len(rows) == len(want) and set(rows) == want
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1
    best = found.groupBy("k").agg(F.min("place").alias("place"), F.min(F.struct("rank", "label"))["label"].alias("want"))
    assert [(r.label, r.want) for r in RT.with_label(best, compiled).collect()] == [(None, None)] * 2
