"""Rule-based labels, bins and flags as native column expressions.

Every function returns a ``Column`` of native expressions, so it stays
inside whole-stage codegen. Rules are data: the CASE chains are generated
from the fixed lists below, in their order — as one SQL expression when the
inputs are column names, or from ``Column`` builders otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlake.functions.sqltext import ident as _n
from postlake.functions.sqltext import quote as _q

# ---------------------------------------------------------------------------
# These must equal the reference's for identical results.
# Text categories, first matching rule wins; each keyword is a case-folded
# substring test on the title and on the self text.
CATEGORY_KEYWORD_RULES: list[tuple[str, list[str]]] = [
    ("Game Update/Patch", ["patch", "update"]),
    ("Esports/Competitive", ["esports", "pro play", "tournament"]),
    ("Trust & Safety: Malicious Behavior", ["hack", "cheat", "exploit", "bot", "toxicity", "abuse"]),
    ("Bug Report/Technical", ["bug", "crash", "performance"]),
    ("Lore/Story", ["lore", "story"]),
    ("Player Feedback/Suggestions", ["feedback", "suggestion"]),
    ("Gameplay Strategy/Tips", ["guide", "meta"]),
    ("Community/Social", ["fan art", "meme"]),
]
# After the keyword rules: lower-cased subreddit membership, then 'Other'.
CATEGORY_SUBREDDIT_RULES: list[tuple[str, list[str]]] = [
    ("Game Specific Discussion", ["leagueoflegends", "valorant", "dota2", "apexlegends",
                                  "wildrift", "teamfighttactics", "legendsofruneterra"]),
    ("General Gaming Discussion", ["gaming", "pcgaming", "consolegaming", "games"]),
]
CATEGORY_DEFAULT = "Other"

# Lower-cased subreddit -> game topic, else the default.
GAME_TOPICS: list[tuple[str, str]] = [
    ("leagueoflegends", "League of Legends"),
    ("valorant", "Valorant"),
    ("teamfighttactics", "Teamfight Tactics"),
    ("legendsofruneterra", "Legends of Runeterra"),
    ("wildrift", "Wild Rift"),
    ("dota2", "DotA 2"),
    ("globaloffensive", "CS:GO"),
    ("apexlegends", "Apex Legends"),
    ("heroesofthestorm", "Heroes of the Storm"),
]
GAME_TOPIC_DEFAULT = "Other Game"

# Bins: inclusive lower bounds, first match wins; the last label is the ELSE.
SCORE_BINS: list[tuple[str, int]] = [("500+", 500), ("100-499", 100), ("10-99", 10), ("1-9", 1)]
SCORE_BIN_ZERO = "0"
SCORE_BIN_ELSE = "Negative"
NUM_COMMENTS_BINS: list[tuple[str, int]] = [("100+", 100), ("50-99", 50), ("10-49", 10), ("1-9", 1)]
NUM_COMMENTS_BIN_ELSE = "0"
UPVOTE_RATIO_BINS: list[tuple[str, float]] = [
    ("Highly Upvoted (90%+)", 0.9),
    ("Mostly Upvoted (70-89%)", 0.7),
    ("Mixed (50-69%)", 0.5),
]
UPVOTE_RATIO_BIN_ELSE = "Mostly Downvoted (<50%)"

TRENDING_MIN_SCORE = 5
TRENDING_MIN_COMMENTS = 4
CANDIDATE_MIN_TEXT_LENGTH = 500  # strictly greater than
EDITED_FALSE_LITERAL = "False"
CONTENT_TYPE = "submission"
# ---------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _chain(cases: list[tuple[Column, str]], default: str) -> Column:
    expr = None
    for cond, label in cases:
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


# --- Spark SQL text of the same rules ----------------------------------------
# With column *names* the rule expressions are built as one SQL expression
# (``F.expr``): one driver→JVM call instead of hundreds. ``Column`` inputs
# use the Column builders below; tests pin both paths to the same result.

def _sql_chain(cases: list[tuple[str, str]], default: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {_q(l)}" for c, l in cases) + f" ELSE {_q(default)} END"


def bin_score_sql(x: str) -> str:
    cases = [(f"{x} >= {lo}", label) for label, lo in SCORE_BINS] + [(f"{x} = 0", SCORE_BIN_ZERO)]
    return _sql_chain(cases, SCORE_BIN_ELSE)


def bin_num_comments_sql(x: str) -> str:
    return _sql_chain([(f"{x} >= {lo}", label) for label, lo in NUM_COMMENTS_BINS], NUM_COMMENTS_BIN_ELSE)


def bin_upvote_ratio_sql(x: str) -> str:
    return _sql_chain([(f"{x} >= {float(lo)!r}D", label) for label, lo in UPVOTE_RATIO_BINS],
                      UPVOTE_RATIO_BIN_ELSE)


def flag_trending_sql(s: str, n: str) -> str:
    return f"({s} >= {TRENDING_MIN_SCORE} AND {n} >= {TRENDING_MIN_COMMENTS})"


def any_keyword_sql(texts_lc: list[str], keywords: list[str]) -> str:
    return "(" + " OR ".join(f"contains({t}, {_q(k)})" for k in keywords for t in texts_lc) + ")"


def in_list_sql(value_lc: str, values: list[str]) -> str:
    return f"{value_lc} IN (" + ", ".join(_q(v) for v in values) + ")"


def categorize_text_sql(t_lc: str, s_lc: str, sub: str) -> str:
    cases = [(any_keyword_sql([t_lc, s_lc], kws), label) for label, kws in CATEGORY_KEYWORD_RULES]
    cases += [(in_list_sql(f"lower({sub})", subs), label) for label, subs in CATEGORY_SUBREDDIT_RULES]
    return _sql_chain(cases, CATEGORY_DEFAULT)


def map_game_topic_sql(sub: str) -> str:
    return _sql_chain([(f"lower({sub}) = {_q(k)}", label) for k, label in GAME_TOPICS], GAME_TOPIC_DEFAULT)


def flag_game_topic_sql(g: str) -> str:
    return f"(NOT ({g} = {_q(GAME_TOPIC_DEFAULT)}))"


def flag_candidate_sql(tr: str, text: str) -> str:
    return f"(({tr} = true) OR (length({text}) > {CANDIDATE_MIN_TEXT_LENGTH}))"


def concat_length_sql(t: str, s: str) -> str:
    """length(concat_ws(' ', t, s)) without building the concatenation."""
    return (f"(coalesce(length({t}), 0) + coalesce(length({s}), 0)"
            f" + CASE WHEN {t} IS NOT NULL AND {s} IS NOT NULL THEN 1 ELSE 0 END)")


def flag_candidate_parts_sql(tr: str, t: str, s: str) -> str:
    return f"(({tr} = true) OR ({concat_length_sql(t, s)} > {CANDIDATE_MIN_TEXT_LENGTH}))"


def flag_edited_sql(e: str) -> str:
    return f"(NOT ({e} = {_q(EDITED_FALSE_LITERAL)}))"


def concat_text_sql(t: str, s: str) -> str:
    return f"concat_ws(' ', {t}, {s})"


def _all_names(*args) -> bool:
    return all(isinstance(a, str) for a in args)


def bin_score(score: Column | str) -> Column:
    if _all_names(score):
        return F.expr(bin_score_sql(_n(score)))
    s = _col(score)
    cases = [(s >= lo, label) for label, lo in SCORE_BINS] + [(s == 0, SCORE_BIN_ZERO)]
    return _chain(cases, SCORE_BIN_ELSE)


def bin_num_comments(num_comments: Column | str) -> Column:
    if _all_names(num_comments):
        return F.expr(bin_num_comments_sql(_n(num_comments)))
    n = _col(num_comments)
    return _chain([(n >= lo, label) for label, lo in NUM_COMMENTS_BINS], NUM_COMMENTS_BIN_ELSE)


def bin_upvote_ratio(upvote_ratio: Column | str) -> Column:
    if _all_names(upvote_ratio):
        return F.expr(bin_upvote_ratio_sql(_n(upvote_ratio)))
    r = _col(upvote_ratio)
    return _chain([(r >= lo, label) for label, lo in UPVOTE_RATIO_BINS], UPVOTE_RATIO_BIN_ELSE)


def flag_trending(score: Column | str, num_comments: Column | str) -> Column:
    """May be NULL (NULL input), exactly like the SQL comparison."""
    if _all_names(score, num_comments):
        return F.expr(flag_trending_sql(_n(score), _n(num_comments)))
    return (_col(score) >= TRENDING_MIN_SCORE) & (_col(num_comments) >= TRENDING_MIN_COMMENTS)


def match_keyword(text_lc: Column, keyword: str) -> Column:
    """Case-folded substring test; ``text_lc`` must already be lower-cased.

    ``lower(x) LIKE '%kw%'`` is exactly ``contains`` (NULL in, NULL out).
    """
    return text_lc.contains(keyword)


def any_keyword(texts_lc: list[Column], keywords: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [match_keyword(t, k) for k in keywords for t in texts_lc])


def in_list(value_lc: Column, values: list[str]) -> Column:
    return value_lc.isin(*values)


def categorize_text(title: Column | str, selftext: Column | str, subreddit: Column | str,
                    lowered: bool = False) -> Column:
    """First-match category; keyword rules, then subreddit rules, then 'Other'.

    NULL title/selftext follow SQL three-valued logic: a rule whose only
    evidence is NULL is skipped (NULL OR FALSE is NULL → falls through).
    """
    if _all_names(title, selftext, subreddit):
        t_sql, s_sql = _n(title), _n(selftext)
        if not lowered:
            t_sql, s_sql = f"lower({t_sql})", f"lower({s_sql})"
        return F.expr(categorize_text_sql(t_sql, s_sql, _n(subreddit)))
    t, s = _col(title), _col(selftext)
    if not lowered:
        t, s = F.lower(t), F.lower(s)
    sub = F.lower(_col(subreddit))
    cases = [(any_keyword([t, s], kws), label) for label, kws in CATEGORY_KEYWORD_RULES]
    cases += [(in_list(sub, subs), label) for label, subs in CATEGORY_SUBREDDIT_RULES]
    return _chain(cases, CATEGORY_DEFAULT)


def map_game_topic(subreddit: Column | str) -> Column:
    if _all_names(subreddit):
        return F.expr(map_game_topic_sql(_n(subreddit)))
    sub = F.lower(_col(subreddit))
    return _chain([(sub == key, label) for key, label in GAME_TOPICS], GAME_TOPIC_DEFAULT)


def flag_game_topic(game_topic: Column | str) -> Column:
    if _all_names(game_topic):
        return F.expr(flag_game_topic_sql(_n(game_topic)))
    return ~(_col(game_topic) == GAME_TOPIC_DEFAULT)


def concat_text(title: Column | str, selftext: Column | str) -> Column:
    """NULL-skipping ``concat_ws(' ', title, selftext)``; never NULL."""
    if _all_names(title, selftext):
        return F.expr(concat_text_sql(_n(title), _n(selftext)))
    return F.concat_ws(" ", _col(title), _col(selftext))


def text_length(text: Column | str) -> Column:
    return F.length(_col(text))


def flag_candidate(is_trending: Column | str, full_text: Column | str) -> Column:
    if _all_names(is_trending, full_text):
        return F.expr(flag_candidate_sql(_n(is_trending), _n(full_text)))
    return (_col(is_trending) == F.lit(True)) | (text_length(full_text) > CANDIDATE_MIN_TEXT_LENGTH)


def flag_candidate_parts(is_trending: str, title: str, selftext: str) -> Column:
    """:func:`flag_candidate` on ``concat_ws(' ', title, selftext)``, with the
    length summed from the parts (no copy of the text is made)."""
    return F.expr(flag_candidate_parts_sql(_n(is_trending), _n(title), _n(selftext)))


def flag_edited(edited: Column | str) -> Column:
    """``NOT (edited = 'False')``: only the literal 'False' is unedited."""
    if _all_names(edited):
        return F.expr(flag_edited_sql(_n(edited)))
    return ~(_col(edited) == EDITED_FALSE_LITERAL)
