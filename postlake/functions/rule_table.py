"""Keyword rules as a table, matched by one pass over a text.

A rule table has ``(rank, label, keyword)``: a text takes the label of the
least rank of which it contains a keyword (case-folded substring test). All
keywords are compiled into one prefix tree, written as a regular expression
that is tried at every place of the text: it takes the longest keyword that
starts there, and the keywords that are its prefixes are hits too, so nested
and overlapping keywords are all found. The number of keywords changes the
tree, not the number of passes.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.functions.rules import CATEGORY_DEFAULT, CATEGORY_KEYWORD_RULES, CATEGORY_SUBREDDIT_RULES, in_list
from postlake.session import local_table

#: A rule table is configuration: it is compiled on the driver. More keywords
#: than this are an error.
MAX_KEYWORDS = 50_000
RULE_SCHEMA = "rank int, label string, keyword string"


def default_rules(spark: SparkSession) -> DataFrame:
    """The built-in category keywords as a rule table."""
    return local_table(spark, [(i, label, k) for i, (label, kws) in enumerate(CATEGORY_KEYWORD_RULES) for k in kws],
                       RULE_SCHEMA)


def _escaped(ch: str) -> str:
    return ch if ch.isalnum() else "\\" + ch


def tree_pattern(words: list[str]) -> str:
    """A regular expression for the longest of ``words`` at a place. A word
    before its own extensions is optional-greedy, so the longest wins."""
    tree: dict = {}
    for word in words:
        node = tree
        for ch in word:
            node = node.setdefault(ch, {})
        node[""] = {}

    def written(node: dict) -> str:
        branches = []
        for ch in sorted(k for k in node if k):
            path, below = _escaped(ch), node[ch]
            while len(below) == 1 and "" not in below:            # a chain of single letters
                (step, below), = below.items()
                path += _escaped(step)
            branches.append(path + written(below))
        if not branches:
            return ""
        body = branches[0] if len(branches) == 1 and "" not in node else "(?:" + "|".join(branches) + ")"
        return body + "?" if "" in node else body

    return written(tree)


@dataclass
class CompiledRules:
    pattern: str            # finds the longest keyword at every place
    rules: DataFrame        # (keyword, rank, label, place): place numbers ranks and labels in order
    places: DataFrame       # (place, label)
    keywords: int
    lengths: list[int] = field(default_factory=list)      # of the keywords


def compile_rules(rules: DataFrame) -> CompiledRules:
    """Compile a rule table. Keywords are lower-cased; NULL or empty keywords and
    NULL ranks are no rules; a keyword may stand under several labels."""
    spark = rules.sparkSession
    kept = (rules.select(F.col("rank").cast("int").alias("rank"), "label", F.lower("keyword").alias("keyword"))
            .where("rank IS NOT NULL AND keyword <> ''").distinct().limit(MAX_KEYWORDS + 1).collect())
    if len(kept) > MAX_KEYWORDS:
        raise ValueError(f"more than {MAX_KEYWORDS} rules")
    words = sorted({r.keyword for r in kept})
    order = sorted({(r.rank, r.label) for r in kept}, key=lambda x: (x[0], x[1] is not None, x[1] or ""))   # as structs
    place = {x: i for i, x in enumerate(order)}
    of = local_table(spark, [(r.keyword, r.rank, r.label, place[r.rank, r.label]) for r in kept],
                     "keyword string, rank int, label string, place int")
    places = local_table(spark, [(i, label) for i, (_, label) in enumerate(order)], "place int, label string")
    return CompiledRules(f"(?=({tree_pattern(words)}))" if words else "", of, places, len(words),
                         sorted({len(w) for w in words}))


def longest_hits(text: Column | str, rules: CompiledRules) -> Column:
    """The distinct longest keywords at the places of a text (NULL: none)."""
    text = F.col(text) if isinstance(text, str) else text
    none = F.array().cast("array<string>")
    if not rules.pattern:
        return none
    hits = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(rules.pattern), F.lit(1)))
    return F.coalesce(hits, none)


def _hits(texts: list[str], rules: CompiledRules) -> Column:
    return F.array_distinct(F.concat(*[longest_hits(t, rules) for t in texts]))


def _with_prefixes(hits: Column, rules: CompiledRules) -> Column:
    """Distinct hits and those of their beginnings that are as long as some
    keyword: all keywords that the hits imply are among them."""
    if len(rules.lengths) < 2:
        return F.array_distinct(hits)
    lengths = F.array(*[F.lit(n) for n in rules.lengths])
    return F.array_distinct(F.flatten(F.transform(hits, lambda h: F.transform(
        F.filter(lengths, lambda n: n <= F.length(h)), lambda n: F.substring(h, F.lit(1), n)))))


def match_keywords(df: DataFrame, keys: list[str], texts: list[str], rules: CompiledRules) -> DataFrame:
    """``(*keys, rank, label, keyword)`` of every keyword that one of ``texts``
    contains, once for rows of equal keys, with the rule's ``place`` in the
    order of ranks and labels. Texts stay where they are. Hits are made distinct
    as one list a text (rows of equal keys: one list), and only then become rows
    that meet the broadcast rules: nothing holds or moves a row per hit."""
    lists = df.select(*keys, _hits(texts, rules).alias("_hits"))
    every = lists.groupBy(*keys).agg(F.flatten(F.collect_list("_hits")).alias("_hits"))
    hits = every.select(*keys, F.explode(_with_prefixes(F.col("_hits"), rules)).alias("keyword"))
    return hits.join(F.broadcast(rules.rules), "keyword").select(*keys, "rank", "label", "keyword", "place")


def with_label(places: DataFrame, rules: CompiledRules, label_col: str = "label") -> DataFrame:
    """The label of column ``place`` (NULL: none) instead of it."""
    named = rules.places.withColumnsRenamed({"label": label_col})
    return places.join(F.broadcast(named), "place", "left").drop("place")


def rule_labels(df: DataFrame, keys: list[str], texts: list[str], rules: CompiledRules,
                label_col: str = "label", keep: list[str] = ()) -> DataFrame:
    """``(*keys, *keep, label_col)``: the label of least rank (then the least
    label), NULL where no keyword is found. ``keys`` identify a row (NULL keys
    are equal); ``keep`` are columns that go with it."""
    words = _with_prefixes(_hits(texts, rules), rules)
    hits = df.select(*keys, *keep, F.explode_outer(words).alias("keyword"))
    best = (hits.join(F.broadcast(rules.rules), "keyword", "left").groupBy(*keys)
            .agg(*[F.min(c).alias(c) for c in keep], F.min("place").alias("place")))
    return with_label(best, rules, label_col).select(*keys, *keep, label_col)


def categorize_by_rules(df: DataFrame, keys: list[str], title: str, selftext: str, subreddit: str,
                        rules: CompiledRules, label_col: str = "text_category") -> DataFrame:
    """``(*keys, label_col)``: keyword rules from a table, then the built-in
    subreddit rules, then 'Other'; with :func:`default_rules` the same labels as
    ``rules.categorize_text``."""
    labelled = rule_labels(df.withColumn("_sub", F.lower(F.col(subreddit))), keys, [title, selftext], rules, "_label", ["_sub"])
    label = F.when(F.col("_label").isNotNull(), F.col("_label"))
    for name, subs in CATEGORY_SUBREDDIT_RULES:
        label = label.when(in_list(F.col("_sub"), subs), F.lit(name))
    return labelled.select(*keys, label.otherwise(F.lit(CATEGORY_DEFAULT)).alias(label_col))
