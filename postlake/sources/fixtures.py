"""Raw forum tables derived from the supplied test tables.

``documents`` becomes submissions (one to three fetched versions each),
``conversations`` becomes comments (one or two fetches). Every row of the
source tables is used and texts are kept whole, so the work grows with the
tables. Fetch versions come from ``explode`` of a literal array, not a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.functions.sqltext import quote
from postlake.functions.timefmt import iso_from_unix, ts_from_unix
from postlake.schemas import RAW_COMMENTS, RAW_SUBMISSIONS, conform

# ---------------------------------------------------------------------------
# Fixed values of the fixture (shared with the SQL oracle).
EPOCH_BASE = 1751155200          # 2025-06-29 00:00:00 UTC
BASE_DS = "2025-06-29"
N_DAYS = 7
SUBMISSION_STEP = 601            # seconds between consecutive doc ids
COMMENT_STEP = 997               # seconds between consecutive conversations
FETCH_STEP = 3600                # seconds between fetches of the same item
SUBREDDIT_CYCLE = [
    "LeagueOfLegends", "valorant", "teamfighttactics", "legendsofruneterra", "wildrift",
    "dota2", "globaloffensive", "apexlegends", "heroesofthestorm", "gaming", "cooking", None,
]
TITLE_CYCLE = [
    "Patch notes", "Tournament recap", "Aimbot again", "Crash on load", "Explore the map",
    "My suggestion", "Metal guide", "A MEME", None, "pro play UPDATE",
    "I love this great champion", "awful and broken queue", "love the idea, hate the result",
]
TITLE_DEFAULT = "hello"
# ---------------------------------------------------------------------------


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cycle(key_sql: str, values: list, default=None) -> Column:
    """CASE <key> WHEN 0 THEN v0 WHEN 1 THEN v1 … ELSE default END (one SQL expression)."""
    whens = " ".join(f"WHEN {i} THEN {quote(v)}" for i, v in enumerate(values))
    return F.expr(f"CASE {key_sql} {whens} ELSE {quote(default)} END")


def _fetches(n: int) -> Column:
    return F.explode(F.array(*[F.lit(i) for i in range(n)]))


def raw_submissions_fx(spark: SparkSession, sf_dir: str, scope: str = "day") -> DataFrame:
    """Raw submissions (21 columns) from ``documents``.

    ``scope="all"`` spreads the versions of one submission over different
    ``ds`` values (for cross-day dedup tests).
    """
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    d = d.withColumn("f", _fetches(3)).filter((F.col("f") == 0) | (F.col("doc_id") % (F.col("f") + 1) == 0))
    doc, f = F.col("doc_id"), F.col("f")
    created = F.lit(EPOCH_BASE) + doc * SUBMISSION_STEP
    retrieved = created + f * FETCH_STEP
    day_key = (doc + f) % N_DAYS if scope == "all" else doc % N_DAYS
    out = d.select(
        F.when(doc % 11 == 0, F.lit("[deleted]")).when(doc % 43 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("u"), (doc % 97).cast("string"))).alias("author_name"),
        iso_from_unix(created).alias("created_utc"),
        created.alias("created_utc_unix"),
        _cycle("doc_id % 5", ["1751155999.0", "false", None], "False").alias("edited"),
        F.col("lang").alias("flair"),
        (doc % 3 == 0).alias("is_self"),
        F.when(doc % 29 == 0, F.lit(None)).otherwise((doc * 7 + f) % 130).alias("num_comments"),
        (doc % 17 == 0).alias("over_18"),
        F.concat(F.lit("/r/"), F.col("source"), F.lit("/"), doc.cast("string")).alias("permalink"),
        retrieved.alias("retrieved_utc_unix"),
        F.when(doc % 31 == 0, F.lit(None)).otherwise((doc * 53 + f) % 700 - 20).alias("score"),
        F.when(doc % 13 == 12, F.lit(None)).otherwise(F.col("text")).alias("selftext"),
        (doc % 19 == 0).alias("spoiler"),
        (doc % 23 == 0).alias("stickied"),
        doc.cast("string").alias("submission_id"),
        _cycle("doc_id % 12", SUBREDDIT_CYCLE).alias("subreddit"),
        _cycle("doc_id % 17", TITLE_CYCLE, TITLE_DEFAULT).alias("title"),
        F.when(doc % 37 == 0, F.lit(None))
        .otherwise(((doc * 41) % 101).cast("double") / 100).alias("upvote_ratio"),
        F.concat(F.lit("https://x.example/"), doc.cast("string")).alias("url"),
        F.date_add(F.lit(BASE_DS).cast("date"), day_key.cast("int")).alias("ds"),
        ts_from_unix(retrieved).alias("_loaded_at_timestamp_utc"),
    )
    return conform(out, RAW_SUBMISSIONS)


def raw_comments_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw comments (15 columns) from ``conversations``; some fetched twice."""
    c = read_table(spark, sf_dir, "conversations")
    c = c.withColumn("f", _fetches(2)).filter((F.col("f") == 0) | (F.col("conv_id") % 3 == 0))
    conv, turn, f = F.col("conv_id"), F.col("turn"), F.col("f")
    created = F.lit(EPOCH_BASE) + conv * COMMENT_STEP + turn * 60
    retrieved = created + f * FETCH_STEP
    out = c.select(
        F.col("role").alias("author_name"),
        F.col("text").alias("body"),
        F.concat(conv.cast("string"), F.lit("-"), turn.cast("string")).alias("comment_id"),
        iso_from_unix(created).alias("created_utc"),
        created.alias("created_utc_unix"),
        F.when(conv % 4 == 0, F.lit("false")).otherwise(F.lit("False")).alias("edited"),
        (F.col("role") == "user").alias("is_submitter"),
        F.when(turn == 0, F.concat(F.lit("t3_"), conv.cast("string")))
        .otherwise(F.concat(F.lit("t1_"), conv.cast("string"), F.lit("-"), (turn - 1).cast("string")))
        .alias("parent_id"),
        F.concat(F.lit("/c/"), conv.cast("string"), F.lit("/"), turn.cast("string")).alias("permalink"),
        retrieved.alias("retrieved_utc_unix"),
        ((conv * 11 + turn) % 60 - 5).alias("score"),
        (turn == 0).alias("stickied"),
        conv.cast("string").alias("submission_id"),
        F.date_add(F.lit(BASE_DS).cast("date"), (conv % N_DAYS).cast("int")).alias("ds"),
        ts_from_unix(retrieved).alias("_loaded_at_timestamp_utc"),
    )
    return conform(out, RAW_COMMENTS)


def first_fetch(raw: DataFrame) -> DataFrame:
    """The raw table as first landed: rows of the first fetch only."""
    return raw.filter(F.col("retrieved_utc_unix") - F.col("created_utc_unix") < FETCH_STEP)


# ---------------------------------------------------------------------------
# Landing inputs: API-shaped records (before normalisation).

def _submission_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return d.withColumn("f", _fetches(3)).filter(
        (F.col("f") == 0) | (F.col("doc_id") % (F.col("f") + 1) == 0))


def submission_records_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API-shaped submission records (SUBMISSION_RECORD), with missing values."""
    from postlake.sources.landing import SUBMISSION_RECORD
    return conform(_submission_records(_submission_docs(spark, sf_dir)), SUBMISSION_RECORD)


def _submission_records(d: DataFrame, *more: str) -> DataFrame:
    doc, f = F.col("doc_id"), F.col("f")
    created = F.lit(EPOCH_BASE) + doc * SUBMISSION_STEP
    return d.select(
        _cycle("doc_id % 12", SUBREDDIT_CYCLE).alias("subreddit"),
        doc.cast("string").alias("id"),
        _cycle("doc_id % 17", TITLE_CYCLE, TITLE_DEFAULT).alias("title"),
        F.when(doc % 13 == 12, F.lit(None)).otherwise(F.col("text")).alias("selftext"),
        F.when(doc % 11 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("u"), (doc % 97).cast("string"))).alias("author"),
        F.when(doc % 31 == 0, F.lit(None)).otherwise((doc * 53 + f) % 700 - 20).alias("score"),
        F.when(doc % 37 == 0, F.lit(None))
        .otherwise(((doc * 41) % 101).cast("double") / 100).alias("upvote_ratio"),
        F.when(doc % 29 == 0, F.lit(None)).otherwise((doc * 7 + f) % 130).alias("num_comments"),
        created.cast("double").alias("created_utc"),
        _cycle("doc_id % 5", ["1751155999.0", None], "False").alias("edited"),
        F.when(doc % 23 == 0, F.lit(True)).when(doc % 10 == 1, F.lit(None))
        .otherwise(F.lit(False)).alias("stickied"),
        (doc % 17 == 0).alias("over_18"),
        (doc % 3 == 0).alias("is_self"),
        (doc % 19 == 0).alias("spoiler"),
        F.when(doc % 4 == 0, F.lit(None)).otherwise(F.col("lang")).alias("link_flair_text"),
        F.concat(F.lit("https://x.example/"), doc.cast("string")).alias("url"),
        F.when(doc % 9 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("/r/"), F.col("source"), F.lit("/"), doc.cast("string")))
        .alias("permalink"),
        (created + f * FETCH_STEP).alias("retrieved_utc"),
        *more,
    )


def comment_records_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API-shaped comment records (COMMENT_RECORD) from ``conversations``."""
    from postlake.sources.landing import COMMENT_RECORD
    c = read_table(spark, sf_dir, "conversations")
    c = c.withColumn("f", _fetches(2)).filter((F.col("f") == 0) | (F.col("conv_id") % 3 == 0))
    conv, turn, f = F.col("conv_id"), F.col("turn"), F.col("f")
    created = F.lit(EPOCH_BASE) + conv * COMMENT_STEP + turn * 60
    out = c.select(
        conv.cast("string").alias("submission_id"),
        F.concat(conv.cast("string"), F.lit("-"), turn.cast("string")).alias("id"),
        F.when(turn == 0, F.concat(F.lit("t3_"), conv.cast("string")))
        .otherwise(F.concat(F.lit("t1_"), conv.cast("string"), F.lit("-"), (turn - 1).cast("string")))
        .alias("parent_id"),
        F.col("text").alias("body"),
        F.when(F.col("role") == "system", F.lit(None)).otherwise(F.col("role")).alias("author"),
        F.when(turn % 5 == 4, F.lit(None)).otherwise(((conv * 11 + turn) % 60 - 5) + f).alias("score"),
        created.cast("double").alias("created_utc"),
        (F.col("role") == "user").alias("is_submitter"),
        (turn == 0).alias("stickied"),
        F.when(conv % 4 == 0, F.lit(None)).otherwise(F.lit("False")).alias("edited"),
        F.concat(F.lit("/c/"), conv.cast("string"), F.lit("/"), turn.cast("string")).alias("permalink"),
        (created + f * FETCH_STEP).alias("retrieved_utc"),
    )
    return conform(out, COMMENT_RECORD)


def nested_submissions_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submissions whose ``comments`` is a nested list: one comment per line
    of the document's text (blank lines are 'more' stubs); comment i
    replies to comment (i-1)/2, so the lists form trees."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    doc = F.col("doc_id")
    created = F.lit(EPOCH_BASE) + doc * SUBMISSION_STEP
    return d.select(doc.cast("string").alias("id"), (created + FETCH_STEP).alias("retrieved_utc"),
                    _comments_of("text").alias("comments"))


def _comments_of(text: str) -> Column:
    from postlake.sources.landing import NESTED_COMMENT
    doc = F.col("doc_id")
    created = F.lit(EPOCH_BASE) + doc * SUBMISSION_STEP
    sid = doc.cast("string")

    def to_comment(line: Column, i: Column) -> Column:
        cid = F.concat(sid, F.lit("-"), i.cast("string"))
        parent = F.when(i == 0, F.concat(F.lit("t3_"), sid)).otherwise(
            F.concat(F.lit("t1_"), sid, F.lit("-"), F.floor((i - 1) / 2).cast("string")))
        return F.struct(
            F.when(F.length(F.trim(line)) == 0, F.lit("more")).otherwise(F.lit("t1")).alias("kind"),
            cid.alias("id"), parent.alias("parent_id"), line.alias("body"),
            F.concat(F.lit("u"), ((doc + i) % 97).cast("string")).alias("author"),
            ((doc + i * 7) % 50 - 3).cast("bigint").alias("score"),
            (created + i * 60).cast("double").alias("created_utc"),
            (i % 4 == 0).alias("is_submitter"), F.lit(False).alias("stickied"),
            F.lit("False").alias("edited"),
            F.concat(F.lit("/r/c/"), cid).alias("permalink"),
        ).cast(NESTED_COMMENT)

    return F.transform(F.split(F.col(text), "\n"), to_comment)


def submission_json_lines_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text lines of the submission records, some of them broken:
    doc_id % 53 == 0 loses its closing brace, % 59 == 0 has no id,
    % 41 == 0 carries a non-numeric score."""
    r = submission_records_fx(spark, sf_dir)
    doc = F.col("id").cast("bigint")
    overrides = {
        "id": F.when(doc % 59 == 0, F.lit(None).cast("string")).otherwise(F.col("id")),
        "score": F.when(doc % 41 == 0, F.lit("n/a")).otherwise(F.col("score").cast("string")),
    }
    rec = F.struct(*[overrides.get(c, F.col(c)).alias(c) for c in r.columns])
    js = F.to_json(rec)
    js = F.when(doc % 53 == 0, F.regexp_replace(js, "}$", "")).otherwise(js)
    return r.select(js.alias("value"))


#: Up to so many ids that repeat are looked up one by one.
FEW_IDS = 1000


def _pairs_of_id(docs: DataFrame) -> DataFrame:
    """Each document with the text of each document of its id (``_other``), from
    one shuffle of the texts."""
    own = docs.groupBy("doc_id").agg(F.collect_list(F.struct("text", "lang", "source")).alias("_all")).select(
        "doc_id", F.col("_all.text").alias("_texts"), F.explode("_all").alias("d"))
    return own.select("doc_id", "d.*", F.explode("_texts").alias("_other"))


def record_lines_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text lines as an API client would save them, one per submission
    and fetch, with the nested comments of :func:`nested_submissions_fx`:
    ``edited`` is a JSON boolean or number, doc_id % 53 == 0 loses its closing
    brace, % 59 == 0 has no id, % 41 == 0 carries a non-numeric score and
    % 47 == 0 a comment without an id. Each document of an id has the comments
    of each: documents whose id repeats are shuffled by it, the others (found by
    their ids alone) are not, if the table is read by enough tasks."""
    from postlake.sources.landing import SUBMISSION_RECORD
    docs = read_table(spark, sf_dir, "documents").where("doc_id IS NOT NULL").select("doc_id", "text", "lang", "source")
    repeated = [r.doc_id for r in docs.groupBy("doc_id").count().where("count > 1").limit(FEW_IDS + 1).collect()]
    tasks = docs.select(F.spark_partition_id().alias("task")).distinct().count()
    if len(repeated) > FEW_IDS or tasks < spark.sparkContext.defaultParallelism:
        pairs = _pairs_of_id(docs)
    elif repeated:
        again = F.col("doc_id").isin(*repeated)
        pairs = docs.where(~again).withColumn("_other", F.col("text")).unionByName(_pairs_of_id(docs.where(again)))
    else:
        pairs = docs.withColumn("_other", F.col("text"))
    fetched = pairs.withColumn("_comments", _comments_of("_other")).withColumn("f", _fetches(3)).filter(
        (F.col("f") == 0) | (F.col("doc_id") % (F.col("f") + 1) == 0))
    r = _submission_records(fetched, "_comments").select(
        *[F.col(x.name).cast(x.dataType).alias(x.name) for x in SUBMISSION_RECORD.fields], "_comments")
    doc = F.col("id").cast("bigint")
    nested = F.when(doc % 47 == 0, F.transform("_comments", lambda c, i: F.when(
        i == 0, c.withField("id", F.lit(None).cast("string"))).otherwise(c))).otherwise(F.col("_comments"))
    overrides = {
        "id": F.when(doc % 59 == 0, F.lit(None).cast("string")).otherwise(F.col("id")),
        "score": F.when(doc % 41 == 0, F.lit("n/a")).otherwise(F.col("score").cast("string")),
        "edited": F.lit("@edited@"),
    }
    names = [c for c in r.columns if not c.startswith("_")]
    js = F.to_json(F.struct(*[overrides.get(c, F.col(c)).alias(c) for c in names], nested.alias("comments")))
    edited = F.when(doc % 5 == 0, F.lit("1751155999.0")).when(doc % 5 == 1, F.lit("null")).when(
        doc % 5 == 2, F.lit("true")).otherwise(F.lit("false"))
    js = F.replace(js, F.lit('"@edited@"'), edited)
    return r.select(F.when(doc % 53 == 0, F.substring(js, F.lit(1), F.length(js) - 1)).otherwise(js).alias("value"))


def reply_tree_lines_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON record lines with reply trees: a record per conversation, whose
    first turn is its one top comment. Every turn is answered by the next
    turn, by a leaf and by a 'more' stub, so a tree is as deep as its
    conversation is long."""
    c = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")

    def comment(t: Column, leaf: bool) -> Column:
        conv, turn = F.col("conv_id"), t["turn"]
        cid = F.concat(conv.cast("string"), F.lit("-"), turn.cast("string"))
        up = F.when(turn == 0, F.concat(F.lit("t3_"), conv.cast("string"))).otherwise(
            F.concat(F.lit("t1_"), conv.cast("string"), F.lit("-"), (turn - 1).cast("string")))
        return F.to_json(F.struct(
            (F.concat(cid, F.lit("x")) if leaf else cid).alias("id"),
            (F.concat(F.lit("t1_"), cid) if leaf else up).alias("parent_id"),
            (F.lit("leaf") if leaf else t["text"]).alias("body"), t["role"].alias("author"),
            ((conv * 7 + turn) % 40 - 3).alias("score"),
            (F.lit(EPOCH_BASE) + conv * COMMENT_STEP + turn * 60).cast("double").alias("created_utc")))

    def answered(rest: Column, t: Column) -> Column:
        own, leaf = comment(t, False), comment(t, True)
        replies = F.concat_ws(",", F.when(rest != "", rest), leaf, F.lit('{"kind":"more"}'))
        return F.concat(F.substring(own, F.lit(1), F.length(own) - 1), F.lit(',"replies":['), replies, F.lit("]}"))

    turns = c.groupBy("conv_id").agg(F.reverse(F.array_sort(F.collect_list(F.struct("turn", "role", "text")))).alias("turns"))
    tree = F.aggregate("turns", F.lit(""), answered)
    conv = F.col("conv_id")
    head = F.to_json(F.struct(
        conv.cast("string").alias("id"), _cycle("conv_id % 12", SUBREDDIT_CYCLE).alias("subreddit"),
        (F.lit(EPOCH_BASE) + conv * COMMENT_STEP).cast("double").alias("created_utc"),
        (F.lit(EPOCH_BASE) + conv * COMMENT_STEP + FETCH_STEP).alias("retrieved_utc")))
    return turns.select(F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.lit(',"comments":['), tree, F.lit("]}"))
                        .alias("value"))
