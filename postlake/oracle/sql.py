"""DuckDB SQL for the correctness oracle.

A SQL rendering of the fixtures and the pipeline layers, as CTEs over the
pre-registered test tables. ``with_ctes(names, body)`` assembles the CTE chain
a query needs. Rules are stated here again as plain literals, and sentiment by
its definition (tokens of the text), so a changed rule in the library makes a
query differ; only the fixture's own constants are shared.
"""

from __future__ import annotations

from postlake.sources import fixtures as FX

# ---------------------------------------------------------------------------
# The rules as the queries must apply them.
KEYWORDS = [
    ("Game Update/Patch", ["patch", "update"]),
    ("Esports/Competitive", ["esports", "pro play", "tournament"]),
    ("Trust & Safety: Malicious Behavior", ["hack", "cheat", "exploit", "bot", "toxicity", "abuse"]),
    ("Bug Report/Technical", ["bug", "crash", "performance"]),
    ("Lore/Story", ["lore", "story"]),
    ("Player Feedback/Suggestions", ["feedback", "suggestion"]),
    ("Gameplay Strategy/Tips", ["guide", "meta"]),
    ("Community/Social", ["fan art", "meme"]),
]
GAME_SUBREDDITS = ["leagueoflegends", "valorant", "dota2", "apexlegends", "wildrift", "teamfighttactics",
                   "legendsofruneterra"]
GENERAL_SUBREDDITS = ["gaming", "pcgaming", "consolegaming", "games"]
TOPIC_KEYWORDS = [
    ("Game Update/Patch", ["patch", "update"]),
    ("Bug Report/Technical", ["bug", "crash", "performance"]),
    ("Esports/Competitive", ["esports", "pro play", "tournament"]),
    ("Lore/Story", ["lore", "story"]),
    ("Player Bots/Detected", ["hack", "cheat", "exploit", "bot", "toxicity", "abuse"]),
    ("Player Feedback/Suggestions", ["feedback", "suggestion"]),
    ("Gameplay Strategy/Tip", ["guide", "meta"]),
    ("Community/Social", ["fan art", "meme"]),
]
POSITIVE_WORDS = ["love", "great", "good", "awesome", "fun", "best", "thanks", "amazing"]
NEGATIVE_WORDS = ["hate", "bad", "awful", "broken", "worst", "terrible", "annoying", "toxic"]
# ---------------------------------------------------------------------------


def q(s: str | None) -> str:
    if s is None:
        return "NULL"
    return "'" + s.replace("'", "''") + "'"


def ts(x: str) -> str:
    return f"make_timestamp(CAST(({x}) AS BIGINT) * 1000000)"


def iso(x: str) -> str:
    return f"strftime({ts(x)}, '%Y-%m-%dT%H:%M:%S')"


def _case_cycle(key: str, values: list, default) -> str:
    whens = " ".join(f"WHEN {i} THEN {q(v)}" for i, v in enumerate(values))
    return f"CASE {key} {whens} ELSE {q(default)} END"


def _ds(key: str) -> str:
    return f"CAST(DATE '{FX.BASE_DS}' + CAST({key} AS INTEGER) AS DATE)"


def raw_submissions_sql(scope: str = "day") -> str:
    created = f"({FX.EPOCH_BASE} + doc_id * {FX.SUBMISSION_STEP})"
    retrieved = f"({created} + f * {FX.FETCH_STEP})"
    day_key = f"((doc_id + f) % {FX.N_DAYS})" if scope == "all" else f"(doc_id % {FX.N_DAYS})"
    return f"""
SELECT
  CASE WHEN doc_id % 11 = 0 THEN '[deleted]' WHEN doc_id % 43 = 0 THEN NULL
       ELSE concat('u', CAST(doc_id % 97 AS VARCHAR)) END AS author_name,
  {iso(created)} AS created_utc,
  CAST({created} AS BIGINT) AS created_utc_unix,
  CASE doc_id % 5 WHEN 0 THEN '1751155999.0' WHEN 1 THEN 'false' WHEN 2 THEN NULL
       ELSE 'False' END AS edited,
  lang AS flair,
  doc_id % 3 = 0 AS is_self,
  CAST(CASE WHEN doc_id % 29 = 0 THEN NULL ELSE (doc_id * 7 + f) % 130 END AS BIGINT) AS num_comments,
  doc_id % 17 = 0 AS over_18,
  concat('/r/', source, '/', CAST(doc_id AS VARCHAR)) AS permalink,
  CAST({retrieved} AS BIGINT) AS retrieved_utc_unix,
  CAST(CASE WHEN doc_id % 31 = 0 THEN NULL ELSE (doc_id * 53 + f) % 700 - 20 END AS BIGINT) AS score,
  CASE WHEN doc_id % 13 = 12 THEN NULL ELSE text END AS selftext,
  doc_id % 19 = 0 AS spoiler,
  doc_id % 23 = 0 AS stickied,
  CAST(doc_id AS VARCHAR) AS submission_id,
  {_case_cycle('doc_id % 12', FX.SUBREDDIT_CYCLE, None)} AS subreddit,
  {_case_cycle('doc_id % 17', FX.TITLE_CYCLE, FX.TITLE_DEFAULT)} AS title,
  CASE WHEN doc_id % 37 = 0 THEN NULL
       ELSE CAST((doc_id * 41) % 101 AS DOUBLE) / 100 END AS upvote_ratio,
  concat('https://x.example/', CAST(doc_id AS VARCHAR)) AS url,
  {_ds(day_key)} AS ds,
  {ts(retrieved)} AS _loaded_at_timestamp_utc
FROM documents, (SELECT unnest([0, 1, 2]) AS f) fetches
WHERE f = 0 OR doc_id % (f + 1) = 0"""


def raw_comments_sql() -> str:
    created = f"({FX.EPOCH_BASE} + conv_id * {FX.COMMENT_STEP} + turn * 60)"
    retrieved = f"({created} + f * {FX.FETCH_STEP})"
    return f"""
SELECT
  role AS author_name,
  text AS body,
  concat(CAST(conv_id AS VARCHAR), '-', CAST(turn AS VARCHAR)) AS comment_id,
  {iso(created)} AS created_utc,
  CAST({created} AS BIGINT) AS created_utc_unix,
  CASE WHEN conv_id % 4 = 0 THEN 'false' ELSE 'False' END AS edited,
  role = 'user' AS is_submitter,
  CASE WHEN turn = 0 THEN concat('t3_', CAST(conv_id AS VARCHAR))
       ELSE concat('t1_', CAST(conv_id AS VARCHAR), '-', CAST(turn - 1 AS VARCHAR)) END AS parent_id,
  concat('/c/', CAST(conv_id AS VARCHAR), '/', CAST(turn AS VARCHAR)) AS permalink,
  CAST({retrieved} AS BIGINT) AS retrieved_utc_unix,
  CAST((conv_id * 11 + turn) % 60 - 5 AS BIGINT) AS score,
  turn = 0 AS stickied,
  CAST(conv_id AS VARCHAR) AS submission_id,
  {_ds(f'conv_id % {FX.N_DAYS}')} AS ds,
  {ts(retrieved)} AS _loaded_at_timestamp_utc
FROM conversations, (SELECT unnest([0, 1]) AS f) fetches
WHERE f = 0 OR conv_id % 3 = 0"""


BRONZE_COLS = """submission_id, author_name, created_utc AS raw_created_utc_str, created_utc_unix,
  {ts} AS created_at_timestamp, edited, flair, is_self, num_comments, over_18, permalink,
  retrieved_utc_unix, score, selftext, spoiler, stickied, subreddit AS raw_subreddit_name,
  title, upvote_ratio, url, ds, _loaded_at_timestamp_utc""".format(ts=ts("created_utc_unix"))


def bronze_dedup_sql(src: str = "raw_submissions_fx", scope: str = "day") -> str:
    part = "ds, submission_id" if scope == "day" else "submission_id"
    return f"""
SELECT {BRONZE_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY {part}
      ORDER BY _loaded_at_timestamp_utc DESC NULLS LAST, created_utc_unix DESC NULLS LAST) AS rn
  FROM {src}) t
WHERE rn = 1"""


QC_WHERE = "submission_id IS NOT NULL AND created_at_timestamp IS NOT NULL AND score >= 0"


def _chain(cases: list[tuple[str, str]], default: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {q(l)}" for c, l in cases) + f" ELSE {q(default)} END"


def bin_score_sql(x: str = "score") -> str:
    return (f"CASE WHEN {x} >= 500 THEN '500+' WHEN {x} >= 100 THEN '100-499' WHEN {x} >= 10 THEN '10-99' "
            f"WHEN {x} >= 1 THEN '1-9' WHEN {x} = 0 THEN '0' ELSE 'Negative' END")


def bin_num_comments_sql(x: str = "num_comments") -> str:
    return (f"CASE WHEN {x} >= 100 THEN '100+' WHEN {x} >= 50 THEN '50-99' WHEN {x} >= 10 THEN '10-49' "
            f"WHEN {x} >= 1 THEN '1-9' ELSE '0' END")


def bin_upvote_ratio_sql(x: str = "upvote_ratio") -> str:
    return (f"CASE WHEN {x} >= 0.9 THEN 'Highly Upvoted (90%+)' WHEN {x} >= 0.7 THEN 'Mostly Upvoted (70-89%)' "
            f"WHEN {x} >= 0.5 THEN 'Mixed (50-69%)' ELSE 'Mostly Downvoted (<50%)' END")


def trending_sql(s: str = "score", n: str = "num_comments") -> str:
    return f"({s} >= 5 AND {n} >= 4)"


def any_kw_sql(texts: list[str], kws: list[str]) -> str:
    return "(" + " OR ".join(f"lower({t}) LIKE '%{k}%'" for k in kws for t in texts) + ")"


def in_list_sql(x: str, values: list[str]) -> str:
    return f"lower({x}) IN (" + ", ".join(q(v) for v in values) + ")"


def category_sql(t: str = "title", s: str = "selftext", sub: str = "raw_subreddit_name") -> str:
    cases = [(any_kw_sql([t, s], kws), label) for label, kws in KEYWORDS]
    cases += [(in_list_sql(sub, GAME_SUBREDDITS), "Game Specific Discussion"),
              (in_list_sql(sub, GENERAL_SUBREDDITS), "General Gaming Discussion")]
    return _chain(cases, "Other")


def game_topic_sql(sub: str = "raw_subreddit_name") -> str:
    return f"""CASE lower({sub}) WHEN 'leagueoflegends' THEN 'League of Legends' WHEN 'valorant' THEN 'Valorant'
      WHEN 'teamfighttactics' THEN 'Teamfight Tactics' WHEN 'legendsofruneterra' THEN 'Legends of Runeterra'
      WHEN 'wildrift' THEN 'Wild Rift' WHEN 'dota2' THEN 'DotA 2' WHEN 'globaloffensive' THEN 'CS:GO'
      WHEN 'apexlegends' THEN 'Apex Legends' WHEN 'heroesofthestorm' THEN 'Heroes of the Storm'
      ELSE 'Other Game' END"""


def sentiment_sql(x: str = "full_text") -> str:
    tokens = f"string_split_regex(lower({x}), '[^a-z]+')"
    pos = f"list_has_any({tokens}, [{', '.join(q(w) for w in POSITIVE_WORDS)}])"
    neg = f"list_has_any({tokens}, [{', '.join(q(w) for w in NEGATIVE_WORDS)}])"
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN {pos} AND {neg} THEN 'mixed' "
            f"WHEN {pos} THEN 'positive' WHEN {neg} THEN 'negative' ELSE 'neutral' END")


def topic_scores_sql(x: str = "full_text") -> list[str]:
    out = []
    for _, kws in TOPIC_KEYWORDS:
        out.append("(" + " + ".join(
            f"(CASE WHEN contains(lower({x}), {q(k)}) THEN 1 ELSE 0 END)" for k in kws) + ")")
    return out


def topics_sql(x: str = "full_text") -> str:
    scores = topic_scores_sql(x)
    best = "greatest(" + ", ".join(scores) + ")"
    whens = " ".join(f"WHEN {s} = {best} THEN {q(label)}"
                     for (label, _), s in zip(TOPIC_KEYWORDS, scores))
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN {best} = 0 THEN {q('Other')} "
            f"{whens} ELSE {q('Other')} END")


def enriched_sql(src: str = "bronze") -> str:
    return f"""
SELECT *,
  (is_trending = TRUE OR length(full_text) > 500) AS is_ai_enrichment_candidate
FROM (
  SELECT *, concat_ws(' ', title, selftext) AS full_text, 'submission' AS text_type,
    {bin_score_sql()} AS score_bin, {bin_num_comments_sql()} AS num_comments_bin,
    {bin_upvote_ratio_sql()} AS upvote_ratio_bin, {trending_sql()} AS is_trending,
    {category_sql()} AS text_category, {game_topic_sql()} AS game_topic
  FROM {src}) e"""


def silver_sql(src: str = "enriched") -> str:
    return f"""
SELECT submission_id AS content_id, text_type AS content_type, author_name,
  raw_subreddit_name AS content_subreddit, title AS text_title, selftext AS text_content,
  url AS text_url, text_category, game_topic, flair AS class_type,
  NOT (game_topic = {q('Other Game')}) AS is_game_topic,
  {sentiment_sql()} AS ai_sentiment, {topics_sql()} AS ai_topics,
  NOT (edited = {q('False')}) AS edited,
  is_trending, upvote_ratio_bin, num_comments_bin, score_bin, is_self, over_18,
  num_comments, score, spoiler, created_at_timestamp, _loaded_at_timestamp_utc, ds
FROM {src} WHERE is_ai_enrichment_candidate"""


# name -> (sql, dependencies)
CTES: dict[str, tuple[str, list[str]]] = {
    "raw_submissions_fx": (raw_submissions_sql("day"), []),
    "raw_submissions_all_fx": (raw_submissions_sql("all"), []),
    "raw_comments_fx": (raw_comments_sql(), []),
    "bronze_dedup": (bronze_dedup_sql("raw_submissions_fx"), ["raw_submissions_fx"]),
    "bronze": (f"SELECT * FROM bronze_dedup WHERE {QC_WHERE}", ["bronze_dedup"]),
    "enriched": (enriched_sql("bronze"), ["bronze"]),
    "silver": (silver_sql("enriched"), ["enriched"]),
    # the raw table as first landed (first fetch only) and its layers
    "raw_v1": (f"SELECT * FROM raw_submissions_fx WHERE retrieved_utc_unix - created_utc_unix < {FX.FETCH_STEP}",
               ["raw_submissions_fx"]),
    "bronze_v1": (f"SELECT * FROM ({bronze_dedup_sql('raw_v1')}) b WHERE {QC_WHERE}", ["raw_v1"]),
    "enriched_v1": (enriched_sql("bronze_v1"), ["bronze_v1"]),
    "silver_v1": (silver_sql("enriched_v1"), ["enriched_v1"]),
}


def with_ctes(needs: list[str], body: str, extra: list[tuple[str, str]] | None = None) -> str:
    if not needs and not extra:
        return body.strip()
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    parts = [f"{n} AS ({CTES[n][0]}\n)" for n in order]
    parts += [f"{n} AS ({s}\n)" for n, s in (extra or [])]
    return "WITH " + ",\n".join(parts) + "\n" + body


# ---------------------------------------------------------------------------
# Landing inputs and landed tables.

def submission_records_sql() -> str:
    created = f"({FX.EPOCH_BASE} + doc_id * {FX.SUBMISSION_STEP})"
    return f"""
SELECT
  {_case_cycle('doc_id % 12', FX.SUBREDDIT_CYCLE, None)} AS subreddit,
  CAST(doc_id AS VARCHAR) AS id,
  {_case_cycle('doc_id % 17', FX.TITLE_CYCLE, FX.TITLE_DEFAULT)} AS title,
  CASE WHEN doc_id % 13 = 12 THEN NULL ELSE text END AS selftext,
  CASE WHEN doc_id % 11 = 0 THEN NULL ELSE concat('u', CAST(doc_id % 97 AS VARCHAR)) END AS author,
  CAST(CASE WHEN doc_id % 31 = 0 THEN NULL ELSE (doc_id * 53 + f) % 700 - 20 END AS BIGINT) AS score,
  CASE WHEN doc_id % 37 = 0 THEN NULL ELSE CAST((doc_id * 41) % 101 AS DOUBLE) / 100 END AS upvote_ratio,
  CAST(CASE WHEN doc_id % 29 = 0 THEN NULL ELSE (doc_id * 7 + f) % 130 END AS BIGINT) AS num_comments,
  CAST({created} AS DOUBLE) AS created_utc,
  CASE doc_id % 5 WHEN 0 THEN '1751155999.0' WHEN 1 THEN NULL ELSE 'False' END AS edited,
  CASE WHEN doc_id % 23 = 0 THEN TRUE WHEN doc_id % 10 = 1 THEN NULL ELSE FALSE END AS stickied,
  doc_id % 17 = 0 AS over_18,
  doc_id % 3 = 0 AS is_self,
  doc_id % 19 = 0 AS spoiler,
  CASE WHEN doc_id % 4 = 0 THEN NULL ELSE lang END AS link_flair_text,
  concat('https://x.example/', CAST(doc_id AS VARCHAR)) AS url,
  CASE WHEN doc_id % 9 = 0 THEN NULL
       ELSE concat('/r/', source, '/', CAST(doc_id AS VARCHAR)) END AS permalink,
  CAST({created} + f * {FX.FETCH_STEP} AS BIGINT) AS retrieved_utc
FROM documents, (SELECT unnest([0, 1, 2]) AS f) fetches
WHERE f = 0 OR doc_id % (f + 1) = 0"""


def comment_records_sql() -> str:
    created = f"({FX.EPOCH_BASE} + conv_id * {FX.COMMENT_STEP} + turn * 60)"
    return f"""
SELECT
  CAST(conv_id AS VARCHAR) AS submission_id,
  concat(CAST(conv_id AS VARCHAR), '-', CAST(turn AS VARCHAR)) AS id,
  CASE WHEN turn = 0 THEN concat('t3_', CAST(conv_id AS VARCHAR))
       ELSE concat('t1_', CAST(conv_id AS VARCHAR), '-', CAST(turn - 1 AS VARCHAR)) END AS parent_id,
  text AS body,
  CASE WHEN role = 'system' THEN NULL ELSE role END AS author,
  CAST(CASE WHEN turn % 5 = 4 THEN NULL ELSE ((conv_id * 11 + turn) % 60 - 5) + f END AS BIGINT) AS score,
  CAST({created} AS DOUBLE) AS created_utc,
  role = 'user' AS is_submitter,
  turn = 0 AS stickied,
  CASE WHEN conv_id % 4 = 0 THEN NULL ELSE 'False' END AS edited,
  concat('/c/', CAST(conv_id AS VARCHAR), '/', CAST(turn AS VARCHAR)) AS permalink,
  CAST({created} + f * {FX.FETCH_STEP} AS BIGINT) AS retrieved_utc
FROM conversations, (SELECT unnest([0, 1]) AS f) fetches
WHERE f = 0 OR conv_id % 3 = 0"""


def _unix(x: str) -> str:
    return f"CAST(trunc({x}) AS BIGINT)"


def land_submissions_sql(src: str) -> str:
    return f"""
SELECT coalesce(author, '[deleted]') AS author_name,
  {iso(_unix('created_utc'))} AS created_utc,
  {_unix('created_utc')} AS created_utc_unix,
  CASE edited WHEN 'true' THEN 'True' WHEN 'false' THEN 'False' ELSE coalesce(edited, 'false') END AS edited,
  link_flair_text AS flair,
  coalesce(is_self, FALSE) AS is_self,
  coalesce(num_comments, 0) AS num_comments,
  coalesce(over_18, FALSE) AS over_18,
  coalesce(permalink, '') AS permalink,
  CAST(retrieved_utc AS BIGINT) AS retrieved_utc_unix,
  coalesce(score, 0) AS score,
  coalesce(selftext, '') AS selftext,
  coalesce(spoiler, FALSE) AS spoiler,
  coalesce(stickied, FALSE) AS stickied,
  id AS submission_id, subreddit, title,
  coalesce(upvote_ratio, 0.0) AS upvote_ratio,
  url,
  CAST({ts('retrieved_utc')} AS DATE) AS ds,
  {ts('retrieved_utc')} AS _loaded_at_timestamp_utc
FROM {src}"""


def land_comments_sql(src: str) -> str:
    return f"""
SELECT author_name, body, comment_id, created_utc, created_utc_unix, edited, is_submitter,
  parent_id, permalink, retrieved_utc_unix, score, stickied, submission_id, ds,
  _loaded_at_timestamp_utc
FROM (
  SELECT *, row_number() OVER (PARTITION BY ds, comment_id ORDER BY retrieved_utc_unix DESC NULLS LAST) AS rn
  FROM (
    SELECT coalesce(author, '[deleted]') AS author_name, body, id AS comment_id,
      {iso(_unix('created_utc'))} AS created_utc, {_unix('created_utc')} AS created_utc_unix,
      coalesce(edited, 'false') AS edited, coalesce(is_submitter, FALSE) AS is_submitter,
      coalesce(parent_id, '') AS parent_id, coalesce(permalink, '') AS permalink,
      CAST(retrieved_utc AS BIGINT) AS retrieved_utc_unix, coalesce(score, 0) AS score,
      coalesce(stickied, FALSE) AS stickied, submission_id,
      CAST({ts('retrieved_utc')} AS DATE) AS ds, {ts('retrieved_utc')} AS _loaded_at_timestamp_utc
    FROM {src}) n) d
WHERE rn = 1"""


def flatten_sql() -> str:
    created = f"({FX.EPOCH_BASE} + doc_id * {FX.SUBMISSION_STEP})"
    return f"""
SELECT CAST(doc_id AS VARCHAR) AS submission_id, CAST(pos AS INTEGER) AS position,
  concat(CAST(doc_id AS VARCHAR), '-', CAST(pos AS VARCHAR)) AS id,
  CASE WHEN pos = 0 THEN concat('t3_', CAST(doc_id AS VARCHAR))
       ELSE concat('t1_', CAST(doc_id AS VARCHAR), '-', CAST((pos - 1) // 2 AS VARCHAR)) END AS parent_id,
  line AS body,
  concat('u', CAST((doc_id + pos) % 97 AS VARCHAR)) AS author,
  CAST((doc_id + pos * 7) % 50 - 3 AS BIGINT) AS score,
  CAST({created} + pos * 60 AS DOUBLE) AS created_utc,
  pos % 4 = 0 AS is_submitter, FALSE AS stickied, 'False' AS edited,
  concat('/r/c/', CAST(doc_id AS VARCHAR), '-', CAST(pos AS VARCHAR)) AS permalink,
  CAST({created} + {FX.FETCH_STEP} AS BIGINT) AS retrieved_utc
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
        unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents) x
WHERE length(trim(line, ' ')) <> 0"""


CTES.update({
    "raw_submissions_all_fx": (raw_submissions_sql("all"), []),
    "bronze_dedup_all": (bronze_dedup_sql("raw_submissions_all_fx", "all"), ["raw_submissions_all_fx"]),
    "submission_records": (submission_records_sql(), []),
    "comment_records": (comment_records_sql(), []),
    "landed_submissions": (land_submissions_sql("submission_records"), ["submission_records"]),
    "landed_comments": (land_comments_sql("comment_records"), ["comment_records"]),
})


# ---------------------------------------------------------------------------
# Record files: the records with JSON edits, and what is wrong with each line.

def file_records_sql() -> str:
    return """
SELECT * EXCLUDE (edited, first_line, doc),
  CASE doc % 5 WHEN 0 THEN '1751155999.0' WHEN 1 THEN NULL WHEN 2 THEN 'true' ELSE 'false' END AS edited,
  CASE WHEN doc % 53 = 0 THEN 'malformed_json' WHEN doc % 59 = 0 THEN 'missing:id'
       WHEN doc % 41 = 0 THEN 'bad_type:score' END AS reject_reason,
  doc % 47 = 0 AND length(trim(first_line, ' ')) <> 0 AS bad_first_comment
FROM (SELECT r.*, d.doc_id AS doc, string_split(d.text, chr(10))[1] AS first_line
      FROM submission_records r JOIN documents d ON r.id = CAST(d.doc_id AS VARCHAR)) x"""


def file_comments_sql(limit: int) -> str:
    """Comment records of the good lines: the first good comments of each list."""
    created = f"({FX.EPOCH_BASE} + doc_id * {FX.SUBMISSION_STEP})"
    return f"""
SELECT id AS submission_id, concat(id, '-', CAST(pos AS VARCHAR)) AS id,
  CASE WHEN pos = 0 THEN concat('t3_', id)
       ELSE concat('t1_', id, '-', CAST((pos - 1) // 2 AS VARCHAR)) END AS parent_id,
  line AS body, concat('u', CAST((doc_id + pos) % 97 AS VARCHAR)) AS author,
  CAST((doc_id + pos * 7) % 50 - 3 AS BIGINT) AS score,
  CAST({created} + pos * 60 AS DOUBLE) AS created_utc,
  pos % 4 = 0 AS is_submitter, FALSE AS stickied, 'False' AS edited,
  concat('/r/c/', id, '-', CAST(pos AS VARCHAR)) AS permalink, retrieved_utc
FROM (
  SELECT *, row_number() OVER (PARTITION BY id, retrieved_utc ORDER BY pos) AS n FROM (
    SELECT g.id, g.retrieved_utc, d.doc_id, unnest(string_split(d.text, chr(10))) AS line,
      unnest(range(len(string_split(d.text, chr(10))))) AS pos
    FROM file_good g JOIN documents d ON g.id = CAST(d.doc_id AS VARCHAR)) l
  WHERE length(trim(line, ' ')) <> 0 AND NOT (doc_id % 47 = 0 AND pos = 0)) c
WHERE n <= {limit}"""


CTES.update({
    "file_records": (file_records_sql(), ["submission_records"]),
    "file_good": ("SELECT * EXCLUDE (reject_reason, bad_first_comment) FROM file_records WHERE reject_reason IS NULL", ["file_records"]),
    "file_landed": (land_submissions_sql("file_good"), ["file_good"]),
    "file_bronze": (f"SELECT * FROM ({bronze_dedup_sql('file_landed')}) b WHERE {QC_WHERE}", ["file_landed"]),
    "file_enriched": (enriched_sql("file_bronze"), ["file_bronze"]),
    "file_silver": (silver_sql("file_enriched"), ["file_enriched"]),
    "file_comments": (file_comments_sql(5), ["file_good"]),
    "file_landed_comments": (land_comments_sql("file_comments"), ["file_comments"]),
    "two_days": ("SELECT * FROM comment_records UNION ALL "
                 "SELECT * REPLACE (retrieved_utc + 86400 AS retrieved_utc) FROM comment_records", ["comment_records"]),
    "two_days_landed": (land_comments_sql("two_days"), ["two_days"]),
})


# ---------------------------------------------------------------------------
# Reply trees: a turn is answered by the next turn and a leaf; level by level
# turn t stands at 2t - 1 (the first at 0) and its leaf at 2t + 2, and the
# last turn's leaf follows the turn before's.

def tree_comments_sql() -> str:
    created = f"({FX.EPOCH_BASE} + conv_id * {FX.COMMENT_STEP} + turn * 60)"
    shared = f"""role AS author, CAST((conv_id * 7 + turn) % 40 - 3 AS BIGINT) AS score,
  CAST({created} AS DOUBLE) AS created_utc, CAST(NULL AS BOOLEAN) AS is_submitter, CAST(NULL AS BOOLEAN) AS stickied,
  CAST(NULL AS VARCHAR) AS edited, CAST(NULL AS VARCHAR) AS permalink,
  CAST({FX.EPOCH_BASE} + conv_id * {FX.COMMENT_STEP} + {FX.FETCH_STEP} AS BIGINT) AS retrieved_utc"""
    return f"""
SELECT CAST(conv_id AS VARCHAR) AS submission_id, concat(CAST(conv_id AS VARCHAR), '-', CAST(turn AS VARCHAR)) AS id,
  CASE WHEN turn = 0 THEN concat('t3_', CAST(conv_id AS VARCHAR))
       ELSE concat('t1_', CAST(conv_id AS VARCHAR), '-', CAST(turn - 1 AS VARCHAR)) END AS parent_id,
  text AS body, CASE WHEN turn = 0 THEN 0 ELSE 2 * turn - 1 END AS place, {shared}
FROM conversations
UNION ALL
SELECT CAST(conv_id AS VARCHAR), concat(CAST(conv_id AS VARCHAR), '-', CAST(turn AS VARCHAR), 'x'),
  concat('t1_', CAST(conv_id AS VARCHAR), '-', CAST(turn AS VARCHAR)), 'leaf', 2 * turn + 2, {shared}
FROM conversations"""


CTES.update({
    "tree_comments": (tree_comments_sql(), []),
    "tree_first": ("SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY submission_id ORDER BY place) AS n "
                   "FROM tree_comments) t WHERE n <= 5", ["tree_comments"]),
    "tree_landed": (land_comments_sql("tree_comments"), ["tree_comments"]),
    "tree_first_landed": (land_comments_sql("tree_first"), ["tree_first"]),
})
