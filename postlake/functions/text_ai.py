"""Open replacements for the hosted sentiment / topic model calls.

Both scorers are native column expressions (regex and substring tests),
so they run inside codegen over whole texts with no Python round trip.
They are *our* definitions, not an imitation of any hosted model.

``ai_custom_model`` is the hook for a user-supplied model: an Arrow-batched
``pandas_udf`` (iterator form) that loads the model once per Python worker.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.functions.rules import CATEGORY_KEYWORD_RULES
from postlake.functions.sqltext import quote as _q
from postlake.session import local_table

# ---------------------------------------------------------------------------
# Fixed values of our scorers.
SENTIMENT_POSITIVE_WORDS = ["love", "great", "good", "awesome", "fun", "best", "thanks", "amazing"]
SENTIMENT_NEGATIVE_WORDS = ["hate", "bad", "awful", "broken", "worst", "terrible", "annoying", "toxic"]
SENTIMENT_LABELS = ("positive", "negative", "mixed", "neutral")

# Labels handed to the topic classifier, in tie-break order (these equal
# the reference's label list).
AI_TOPIC_LABELS = [
    "Game Update/Patch", "Bug Report/Technical", "Esports/Competitive", "Lore/Story",
    "Player Bots/Detected", "Player Feedback/Suggestions", "Gameplay Strategy/Tip",
    "Community/Social", "Other",
]
AI_TOPIC_DEFAULT = "Other"
# ---------------------------------------------------------------------------

_RULE_KEYWORDS = dict(CATEGORY_KEYWORD_RULES)
# Keyword evidence per classifier label, taken from the category rules.
AI_TOPIC_KEYWORDS: list[tuple[str, list[str]]] = [
    ("Game Update/Patch", _RULE_KEYWORDS["Game Update/Patch"]),
    ("Bug Report/Technical", _RULE_KEYWORDS["Bug Report/Technical"]),
    ("Esports/Competitive", _RULE_KEYWORDS["Esports/Competitive"]),
    ("Lore/Story", _RULE_KEYWORDS["Lore/Story"]),
    ("Player Bots/Detected", _RULE_KEYWORDS["Trust & Safety: Malicious Behavior"]),
    ("Player Feedback/Suggestions", _RULE_KEYWORDS["Player Feedback/Suggestions"]),
    ("Gameplay Strategy/Tip", _RULE_KEYWORDS["Gameplay Strategy/Tips"]),
    ("Community/Social", _RULE_KEYWORDS["Community/Social"]),
]


def word_pattern(words: list[str]) -> str:
    """Regex true iff one of ``words`` is a whole ``[a-z]+`` token.

    Same truth value as: split(lower(text), '[^a-z]+') contains the word.
    """
    return "(^|[^a-z])(" + "|".join(words) + ")([^a-z]|$)"


POSITIVE_PATTERN = word_pattern(SENTIMENT_POSITIVE_WORDS)
NEGATIVE_PATTERN = word_pattern(SENTIMENT_NEGATIVE_WORDS)


def _sentiment_label(is_null: Column, pos: Column, neg: Column) -> Column:
    return (F.when(is_null, F.lit(None).cast("string"))
            .when(pos & neg, F.lit("mixed"))
            .when(pos, F.lit("positive"))
            .when(neg, F.lit("negative"))
            .otherwise(F.lit("neutral")))


def _topic_label(is_null: Column, scores: list[Column]) -> Column:
    best = F.greatest(*scores)
    expr = F.when(is_null, F.lit(None).cast("string")).when(best == 0, F.lit(AI_TOPIC_DEFAULT))
    for (label, _), score in zip(AI_TOPIC_KEYWORDS, scores):
        expr = expr.when(score == best, F.lit(label))
    return expr.otherwise(F.lit(AI_TOPIC_DEFAULT))


def ai_sentiment(full_text: Column | str) -> Column:
    """positive / negative / mixed / neutral from lexicon tokens; NULL → NULL."""
    text = F.col(full_text) if isinstance(full_text, str) else full_text
    lc = F.lower(text)
    return _sentiment_label(text.isNull(), lc.rlike(POSITIVE_PATTERN), lc.rlike(NEGATIVE_PATTERN))


def ai_topic_scores(full_text_lc: Column) -> list[Column]:
    """Per label: number of its keywords contained in the text."""
    scores = []
    for _, kws in AI_TOPIC_KEYWORDS:
        terms = [F.when(full_text_lc.contains(k), F.lit(1)).otherwise(F.lit(0)) for k in kws]
        total = terms[0]
        for t in terms[1:]:
            total = total + t
        scores.append(total)
    return scores


def ai_topics(full_text: Column | str) -> Column:
    """Highest keyword score wins; ties → earlier label; all zero → 'Other'."""
    text = F.col(full_text) if isinstance(full_text, str) else full_text
    return _topic_label(text.isNull(), ai_topic_scores(F.lower(text)))


# ---------------------------------------------------------------------------
# Sentiment with the lexicon as a table.

def tokens(text: Column | str) -> Column:
    """The ``[a-z]+`` tokens of a lower-cased text."""
    text = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(text), "[^a-z]+"), lambda t: t != "")


def default_lexicon(spark) -> DataFrame:
    """The built-in words as a lexicon table."""
    words = [(w, 1) for w in SENTIMENT_POSITIVE_WORDS] + [(w, -1) for w in SENTIMENT_NEGATIVE_WORDS]
    return local_table(spark, words, "word string, weight int")


#: A lexicon held by the driver is compiled up to so many words.
MAX_COMPILED_WORDS = 10_000


def found_words(text: Column | str, words: list[str]) -> Column:
    """The distinct tokens of a text that are in ``words``, by one search for
    all of them (NULL text: NULL)."""
    from postlake.functions.rule_table import tree_pattern

    text = F.col(text) if isinstance(text, str) else text
    known = sorted({w for w in words if w and all("a" <= ch <= "z" for ch in w)})
    if not known:
        return F.when(text.isNotNull(), F.array().cast("array<string>"))
    pattern = f"(?<![a-z])({tree_pattern(known)})(?![a-z])"
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(1)))


def lexicon_sentiment(df: DataFrame, keys: list[str], text_col: str, lexicon: DataFrame,
                      word_col: str = "word", weight_col: str = "weight") -> DataFrame:
    """``(*keys, ai_sentiment, positive, negative)`` by a lexicon of weighted words.

    A text's distinct tokens meet the lexicon in one join and return summed by
    key: one plan for a lexicon of any size, which adaptive execution
    broadcasts when it is small, and whose frequent words it splits. Texts are
    tokenised where they are and never shuffled. Of a lexicon that the driver
    holds (``default_lexicon``) the words are compiled: a text then gives the
    tokens that are in it, not all of its tokens. ``positive`` and ``negative``
    are the weights of the distinct tokens on either side; the label says
    which sides there are (NULL text: NULL). ``keys`` identify a text (rows of
    equal keys are one); a word listed more than once counts once with the sum
    of its weights, NULL words, NULL weights and zero weights do not count.
    """
    words = lexicon.select(F.lower(F.col(word_col)).alias("_word"), F.col(weight_col).alias("_weight")).where(
        F.col("_word").isNotNull()).groupBy("_word").agg(F.sum("_weight").alias("_weight")).where("_weight != 0")
    # an empty token keeps a row for texts without words; NULL marks a NULL text
    held = [r["_word"] for r in words.limit(MAX_COMPILED_WORDS + 1).collect()] if lexicon.isLocal() else None
    if held is not None and len(held) <= MAX_COMPILED_WORDS:
        words, theirs = F.broadcast(words), found_words(text_col, held)
    else:
        theirs = F.array_distinct(tokens(text_col))
    own = F.when(F.col(text_col).isNull(), F.array(F.lit(None).cast("string"))).otherwise(
        F.concat(F.array(F.lit("")), theirs))
    found = df.select(*keys, F.explode(own).alias("_word")).join(words, "_word", "left").groupBy(*keys).agg(
        F.count("_word").alias("_n"),
        F.coalesce(F.sum(F.when(F.col("_weight") > 0, F.col("_weight"))), F.lit(0)).alias("positive"),
        F.coalesce(F.sum(F.when(F.col("_weight") < 0, -F.col("_weight"))), F.lit(0)).alias("negative"))
    label = _sentiment_label(F.col("_n") == 0, F.col("positive") > 0, F.col("negative") > 0)
    return found.select(*keys, label.alias("ai_sentiment"), "positive", "negative")


def topic_score_sql(lc: str, keywords: list[str]) -> str:
    return "(" + " + ".join(f"(CASE WHEN contains({lc}, {_q(k)}) THEN 1 ELSE 0 END)" for k in keywords) + ")"


def sentiment_label_sql(is_null: str, pos: str, neg: str) -> str:
    return (f"CASE WHEN {is_null} THEN CAST(NULL AS STRING) WHEN {pos} AND {neg} THEN 'mixed' "
            f"WHEN {pos} THEN 'positive' WHEN {neg} THEN 'negative' ELSE 'neutral' END")


def topic_label_sql(is_null: str, scores: list[str]) -> str:
    best = "greatest(" + ", ".join(scores) + ")"
    whens = " ".join(f"WHEN {s} = {best} THEN {_q(label)}" for (label, _), s in zip(AI_TOPIC_KEYWORDS, scores))
    return (f"CASE WHEN {is_null} THEN CAST(NULL AS STRING) WHEN {best} = 0 THEN {_q(AI_TOPIC_DEFAULT)} "
            f"{whens} ELSE {_q(AI_TOPIC_DEFAULT)} END")


def with_ai_labels(df: DataFrame, full_text_lc: str, sentiment_col: str = "ai_sentiment",
                   topics_col: str = "ai_topics") -> DataFrame:
    """Add both labels from an already lower-cased text column.

    Same values as :func:`ai_sentiment` / :func:`ai_topics`, planned as two
    projections: the regex hits and the eight label scores are columns of
    the first, so the label CASE chains of the second read them instead of
    re-scanning the text once per branch.
    """
    lc = "`" + full_text_lc + "`"
    n = len(AI_TOPIC_KEYWORDS)
    scored = df.selectExpr(
        "*", f"{lc} RLIKE {_q(POSITIVE_PATTERN)} AS _pos", f"{lc} RLIKE {_q(NEGATIVE_PATTERN)} AS _neg",
        *[f"{topic_score_sql(lc, kws)} AS _ts{i}" for i, (_, kws) in enumerate(AI_TOPIC_KEYWORDS)])
    labelled = scored.selectExpr(
        "*",
        f"{sentiment_label_sql(f'{lc} IS NULL', '_pos', '_neg')} AS `{sentiment_col}`",
        f"{topic_label_sql(f'{lc} IS NULL', [f'_ts{i}' for i in range(n)])} AS `{topics_col}`")
    return labelled.drop("_pos", "_neg", *[f"_ts{i}" for i in range(n)])


def keyword_hit_sql(title_lc: str, self_lc: str, keyword: str) -> str:
    """``contains(lower(concat_ws(' ', title, selftext)), keyword)`` from the
    lower-cased parts: a hit inside either part, or — for a keyword with a
    space — the one alignment where that space is the joining space."""
    hits = [f"coalesce(contains({title_lc}, {_q(keyword)}), false)",
            f"coalesce(contains({self_lc}, {_q(keyword)}), false)"]
    for j, ch in enumerate(keyword):
        if ch == " ":
            hits.append(f"coalesce(endswith({title_lc}, {_q(keyword[:j])}) "
                        f"AND startswith({self_lc}, {_q(keyword[j + 1:])}), false)")
    return "(" + " OR ".join(hits) + ")"


def with_ai_labels_from_parts(df: DataFrame, title_lc: str, self_lc: str,
                              hit_cols: dict[str, str] | None = None,
                              sentiment_col: str = "ai_sentiment", topics_col: str = "ai_topics") -> DataFrame:
    """Both labels of ``concat_ws(' ', title, selftext)`` (never NULL) from its
    lower-cased parts, without building the joined text.

    ``hit_cols`` maps keywords to boolean columns that already hold
    "keyword in title or self text" (the rule categoriser computes them), so
    each keyword scans the text once for both uses; only the cross-join
    alignment of spaced keywords is added. The lexicon words have no space
    and the joining space is a non-letter, so a whole-word match in the
    joined text is one in a part.
    """
    hit_cols = hit_cols or {}
    t, s_ = f"`{title_lc}`", f"`{self_lc}`"

    def hit(k: str) -> str:
        if k in hit_cols:
            extra = [f"coalesce(endswith({t}, {_q(k[:j])}) AND startswith({s_}, {_q(k[j + 1:])}), false)"
                     for j, ch in enumerate(k) if ch == " "]
            return "(" + " OR ".join([f"`{hit_cols[k]}`", *extra]) + ")"
        return keyword_hit_sql(t, s_, k)

    def rx(p: str) -> str:
        return f"(coalesce({t} RLIKE {_q(p)}, false) OR coalesce({s_} RLIKE {_q(p)}, false))"

    n = len(AI_TOPIC_KEYWORDS)
    scores = ["(" + " + ".join(f"(CASE WHEN {hit(k)} THEN 1 ELSE 0 END)" for k in kws) + ")"
              for _, kws in AI_TOPIC_KEYWORDS]
    scored = df.selectExpr("*", f"{rx(POSITIVE_PATTERN)} AS _pos", f"{rx(NEGATIVE_PATTERN)} AS _neg",
                           *[f"{sc} AS _ts{i}" for i, sc in enumerate(scores)])
    labelled = scored.selectExpr(
        "*",
        f"{sentiment_label_sql('false', '_pos', '_neg')} AS `{sentiment_col}`",
        f"{topic_label_sql('false', [f'_ts{i}' for i in range(n)])} AS `{topics_col}`")
    return labelled.drop("_pos", "_neg", *[f"_ts{i}" for i in range(n)])


# ---------------------------------------------------------------------------
# User-supplied model hook.

ModelLoader = Callable[[], Callable[[pd.Series], pd.Series]]
#: Models that a Python process keeps (the least recently used goes first).
KEPT_MODELS = 4
_MODELS: OrderedDict[str, Callable[[pd.Series], pd.Series]] = OrderedDict()


def loader_key(loader: ModelLoader) -> str:
    """Digest of the pickled loader: its code, defaults and closure."""
    return hashlib.sha256(cloudpickle.dumps(loader)).hexdigest()


def worker_model(key: str, loader: ModelLoader) -> Callable[[pd.Series], pd.Series]:
    """The loaded model of this Python process."""
    if key not in _MODELS:
        _MODELS[key] = loader()
    _MODELS.move_to_end(key)
    while len(_MODELS) > KEPT_MODELS:
        _MODELS.popitem(last=False)
    return _MODELS[key]


def ai_custom_model(df: DataFrame, text_col: str, loader: ModelLoader, output_col: str,
                    return_type: T.DataType = T.StringType(), model_key: str | None = None) -> DataFrame:
    """Apply a user model to ``text_col`` in Arrow batches.

    ``loader()`` runs once per Python worker process, however many tasks the
    worker runs, and returns a vectorised ``predict(pd.Series) -> pd.Series``.
    Models are kept by ``model_key`` or, by default, by what the loader is:
    another closure, default or body is another model, under any name. Filter
    rows *before* calling this: the projection is not pushed below filters
    for Python UDFs.
    """

    key = f"named {model_key}" if model_key else loader_key(loader)

    @F.pandas_udf(return_type)
    def _predict(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = worker_model(key, loader)
        for batch in batches:
            yield predict(batch)

    return df.withColumn(output_col, _predict(F.col(text_col)))


def lexicon_sentiment_model() -> Callable[[pd.Series], pd.Series]:
    """A small example model for the hook: the lexicon scorer on pandas.

    Gives the same labels as :func:`ai_sentiment`; used to test the hook.
    """
    pos_re = POSITIVE_PATTERN
    neg_re = NEGATIVE_PATTERN

    def predict(texts: pd.Series) -> pd.Series:
        lc = texts.str.lower()
        pos = lc.str.contains(pos_re, regex=True)
        neg = lc.str.contains(neg_re, regex=True)
        out = pd.Series("neutral", index=texts.index, dtype=object)
        out[pos.fillna(False) & ~neg.fillna(False)] = "positive"
        out[neg.fillna(False) & ~pos.fillna(False)] = "negative"
        out[pos.fillna(False) & neg.fillna(False)] = "mixed"
        out[texts.isna()] = None
        return out

    return predict
