"""Landing: API-shaped records → raw tables.

Replaces the reference's driver-side list of dicts with a file/DataFrame
source read under an explicit schema: normalise defaults, derive the ISO
time, ``ds`` and load stamp, flatten nested comment lists, drop duplicate
comments, and count (instead of crash on) malformed records.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.functions.timefmt import iso_from_unix, parse_ds, ts_from_unix, utc_date_from_unix
from postlake.operators.bronze import WIDE_COLUMNS
from postlake.schemas import RAW_COMMENTS, RAW_SUBMISSIONS, _struct, conform
from postlake.sinks.tables import FEW_DAYS

# ---------------------------------------------------------------------------
# Landing defaults for missing attributes.
DELETED_AUTHOR = "[deleted]"
DEFAULT_EDITED = "false"      # the attribute is missing
EDITED_BOOLEANS = {"true": "True", "false": "False"}   # a JSON boolean, as stored
DEFAULT_TEXT = ""
# ---------------------------------------------------------------------------

SUBMISSION_RECORD = _struct(
    "subreddit STRING, id STRING, title STRING, selftext STRING, author STRING, "
    "score BIGINT, upvote_ratio DOUBLE, num_comments BIGINT, created_utc DOUBLE, "
    "edited STRING, stickied BOOLEAN, over_18 BOOLEAN, is_self BOOLEAN, spoiler BOOLEAN, "
    "link_flair_text STRING, url STRING, permalink STRING, retrieved_utc BIGINT"
)

COMMENT_RECORD = _struct(
    "submission_id STRING, id STRING, parent_id STRING, body STRING, author STRING, "
    "score BIGINT, created_utc DOUBLE, is_submitter BOOLEAN, stickied BOOLEAN, "
    "edited STRING, permalink STRING, retrieved_utc BIGINT"
)

# A nested comment as it sits inside a submission record. ``kind`` 'more'
# marks a truncated "load more" stub.
NESTED_COMMENT = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("parent_id", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("score", T.LongType()),
    T.StructField("created_utc", T.DoubleType()),
    T.StructField("is_submitter", T.BooleanType()),
    T.StructField("stickied", T.BooleanType()),
    T.StructField("edited", T.StringType()),
    T.StructField("permalink", T.StringType()),
])
MORE_STUB_KIND = "more"
_COMMENTS = "comments"


def _ds_column(ds: str | _dt.date | Column | None, retrieved: Column) -> Column:
    """Run date: a given date (one run) or, when None, the UTC fetch date."""
    if ds is None:
        return utc_date_from_unix(retrieved)
    if isinstance(ds, Column):
        return ds.cast("date")
    return F.lit(parse_ds(ds))


def _flag(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(False))


def _edited() -> Column:
    """The edited attribute as text: a JSON boolean becomes 'True' / 'False',
    an edit time stays a number, a missing attribute becomes 'false'."""
    value = F.when(F.col("edited").contains("E"), F.coalesce(   # the reader's form of a JSON number
        F.col("edited").try_cast("double").try_cast("decimal(20,1)").cast("string"), F.col("edited"))
    ).otherwise(F.col("edited"))
    for json_text, stored in EDITED_BOOLEANS.items():
        value = F.when(F.col("edited") == json_text, F.lit(stored)).otherwise(value)
    return F.coalesce(value, F.lit(DEFAULT_EDITED))


def _fetch_seconds() -> Column:
    """Fetch time of a record; when the source has none, the landing job's
    own time (one value per query, so every row of a run gets the same)."""
    return F.coalesce(F.col("retrieved_utc").cast("bigint"), F.unix_timestamp(F.current_timestamp()))


def land_submissions(records: DataFrame, ds: str | _dt.date | Column | None = None) -> DataFrame:
    """Normalise submission records into the 21-column raw layout.

    Missing author → '[deleted]'; missing score / comment count → 0; missing
    ratio → 0.0; missing self text / permalink → ''; missing flags → false;
    missing ``edited`` → 'false', a boolean one → 'True' / 'False'. A missing flair stays NULL (no 'None'
    string). Unix seconds are truncated like ``int()``.
    """
    created = F.col("created_utc").cast("bigint")
    retrieved = _fetch_seconds()
    out = records.select(
        F.coalesce(F.col("author"), F.lit(DELETED_AUTHOR)).alias("author_name"),
        iso_from_unix(created).alias("created_utc"),
        created.alias("created_utc_unix"),
        _edited().alias("edited"),
        F.col("link_flair_text").alias("flair"),
        _flag("is_self").alias("is_self"),
        F.coalesce(F.col("num_comments"), F.lit(0)).alias("num_comments"),
        _flag("over_18").alias("over_18"),
        F.coalesce(F.col("permalink"), F.lit(DEFAULT_TEXT)).alias("permalink"),
        retrieved.alias("retrieved_utc_unix"),
        F.coalesce(F.col("score"), F.lit(0)).alias("score"),
        F.coalesce(F.col("selftext"), F.lit(DEFAULT_TEXT)).alias("selftext"),
        _flag("spoiler").alias("spoiler"),
        _flag("stickied").alias("stickied"),
        F.col("id").alias("submission_id"),
        F.col("subreddit"),
        F.col("title"),
        F.coalesce(F.col("upvote_ratio"), F.lit(0.0)).alias("upvote_ratio"),
        F.col("url"),
        _ds_column(ds, retrieved).alias("ds"),
        ts_from_unix(retrieved).alias("_loaded_at_timestamp_utc"),
    )
    return conform(out, RAW_SUBMISSIONS)


def distinct_by_key(df: DataFrame, key: str | list[str], newest: str = "retrieved_utc_unix") -> DataFrame:
    """One row per ``key`` (run date and id for comments): the most recently
    fetched, then the greatest in the other columns, texts last.

    ``row_number() == 1`` is a partial group limit: duplicates collapse
    before the shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in (newest, *keys)]
    names = [newest, *[c for c in rest if c not in WIDE_COLUMNS], *[c for c in rest if c in WIDE_COLUMNS]]
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in names])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def _comments_by_day(records: DataFrame, day: Column, pieces: dict[int, list[_dt.date]]) -> DataFrame:
    """Comment records shuffled by their day ``_ds``, and by one of ``n`` parts
    of their ids (``_piece``) if it is one of the large days ``pieces[n]``. In a
    task the fetches of a comment are sorted side by side, and texts go last:
    the shuffle's codec then finds in a row what it has of the row before."""
    names = sorted([f.name for f in COMMENT_RECORD.fields], key=lambda n: n in WIDE_COLUMNS)
    records = records.select(day.alias("_ds"), *names).sortWithinPartitions("_ds", "id")
    if not pieces:                       # a constant would not count as a key of the shuffle
        return records.repartition("_ds")
    piece = F.lit(0)
    for n, days in pieces.items():
        piece = F.when(F.col("_ds").isin(*[F.lit(d) for d in days]), F.pmod(F.xxhash64("id"), F.lit(n))).otherwise(piece)
    return records.withColumn("_piece", piece).repartition("_ds", "_piece")


def land_comments(records: DataFrame, ds: str | _dt.date | Column | None = None,
                  pieces: dict[int, list[_dt.date]] | None = None) -> DataFrame:
    """Normalise comment records into the 15-column raw layout, one row per
    run date and ``comment_id`` (latest fetch wins), so landing several days
    together gives the rows of landing them one by one.

    With ``pieces`` (may be empty) the same rows come out gathered by day, from
    the one shuffle that finds the duplicates: a day is in one task, or in ``n``
    tasks if it is one of the large days ``pieces[n]``."""
    created = F.col("created_utc").cast("bigint")
    retrieved = _fetch_seconds()
    day, keys = _ds_column(ds, retrieved), ["ds", "comment_id"]
    if pieces is not None:
        records = _comments_by_day(records, day, pieces)
        day, keys = F.col("_ds"), ["ds", *(["_piece"] if pieces else []), "comment_id"]
    out = records.select(
        F.coalesce(F.col("author"), F.lit(DELETED_AUTHOR)).alias("author_name"),
        F.col("body"),
        F.col("id").alias("comment_id"),
        iso_from_unix(created).alias("created_utc"),
        created.alias("created_utc_unix"),
        _edited().alias("edited"),
        _flag("is_submitter").alias("is_submitter"),
        F.coalesce(F.col("parent_id"), F.lit(DEFAULT_TEXT)).alias("parent_id"),
        F.coalesce(F.col("permalink"), F.lit(DEFAULT_TEXT)).alias("permalink"),
        retrieved.alias("retrieved_utc_unix"),
        F.coalesce(F.col("score"), F.lit(0)).alias("score"),
        _flag("stickied").alias("stickied"),
        F.col("submission_id"),
        day.alias("ds"),
        ts_from_unix(retrieved).alias("_loaded_at_timestamp_utc"),
        *[k for k in keys if k == "_piece"],
    )
    return conform(distinct_by_key(out, keys), RAW_COMMENTS)


def flatten_comments(submissions: DataFrame, comments_col: str = "comments",
                     submission_id_col: str = "id", retrieved_col: str = "retrieved_utc",
                     limit: int | None = None) -> DataFrame:
    """Nested comment lists → comment records (one row per comment).

    Narrow: the list is filtered and cut inside its row, nothing is grouped.
    Each row keeps its submission id and ``parent_id``. Reply trees are lists by
    then, level by level (:func:`parse_submission_json`). Truncated 'more' stubs
    are dropped; then the first ``limit`` comments of the list stay (None or
    0: all). ``position`` is the comment's index in its submission's list,
    stubs and rejected comments included.
    """
    placed = F.transform(F.col(comments_col), lambda c, i: F.struct(i.alias("position"), c.alias("c")))
    kept = F.filter(placed, lambda x: x["c"].isNotNull()
                    & ~F.coalesce(x["c"]["kind"] == MORE_STUB_KIND, F.lit(False)))
    if limit:
        kept = F.slice(kept, 1, int(limit))
    rows = submissions.select(F.col(submission_id_col).alias("submission_id"),
                              F.col(retrieved_col).alias("retrieved_utc"), F.explode(kept).alias("x"))
    return rows.select(
        "submission_id", F.col("x.position").alias("position"),
        *[F.col(f"x.c.{f.name}").alias(f.name) for f in NESTED_COMMENT.fields if f.name != "kind"],
        "retrieved_utc",
    )


@dataclass
class DaySpread:
    """How stored records lie by fetch date: ``days``, the ``files`` read, the
    (file, day) ``pairs``, and the large days of comments, by the number of
    tasks that such a day is shared out to (a power of two)."""
    days: int
    files: int
    pairs: int
    pieces: dict[int, list[_dt.date]]

    def day_by_day(self) -> bool:
        """Files hold few days each: written where the rows are, a day gets
        about as many files as if it were gathered first."""
        return self.days <= FEW_DAYS or self.pairs <= 2 * max(self.days, self.files)


def day_spread(records: DataFrame, limit: int | None = None) -> DaySpread:
    """Count the days of ``records`` (read from files) by file: narrow columns,
    and no more days than there are shuffle partitions reach the driver."""
    n = F.coalesce(F.greatest(F.size("comments.id"), F.lit(0)), F.lit(0))
    rows = records.select(_ds_column(None, _fetch_seconds()).alias("ds"), F.xxhash64(F.input_file_name()).alias("file"),
                          (F.least(n, F.lit(int(limit))) if limit else n).cast("bigint").alias("n"))
    by_day = rows.groupBy("ds", "file").agg(F.sum("n").alias("n")).groupBy("ds").agg(
        F.count(F.lit(1)).alias("files"), F.sum("n").alias("n"))
    total = by_day.agg(F.count(F.lit(1)).alias("days"), F.coalesce(F.sum("files"), F.lit(0)).alias("pairs"),
                       F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    pieces: dict[int, list[_dt.date]] = {}
    if total["days"] > FEW_DAYS and total["n"]:
        tasks = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        for r in by_day.where(F.col("n") * tasks > total["n"]).collect():     # fewer days than tasks
            pieces.setdefault(1 << (-(-r["n"] * tasks // total["n"]) - 1).bit_length(), []).append(r["ds"])
    return DaySpread(total["days"], len(records.inputFiles()), total["pairs"], pieces)


def read_records(spark, paths: str | list[str], fmt: str = "json") -> DataFrame:
    """Submission records of one or many folders (e.g. one per subreddit) in
    one multi-path scan, with ``comments``, ``_reject_reason`` (NULL = good
    row) and ``_raw``: nothing is dropped or made up here, and
    :func:`reject_bad_rows` splits the rows. ``fmt`` is ``json`` (lines) or
    ``parquet`` (typed records, where only a missing field can be wrong)."""
    paths = paths if isinstance(paths, list) else [paths]
    if fmt == "json":
        return parse_submission_json(spark.read.text(paths))
    return check_records(spark.read.format(fmt).load(paths))


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """Concatenate per-source landings by column name (no shuffle)."""
    if not frames:
        raise ValueError("no sources")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# ---------------------------------------------------------------------------
# Dirty input: JSON lines with wrong types or broken syntax.

_CORRUPT = "_corrupt_record"
_STRING_RECORD = T.StructType([T.StructField(f.name, T.StringType()) for f in SUBMISSION_RECORD.fields]
                              + [T.StructField(_COMMENTS, T.StringType()), T.StructField(_CORRUPT, T.StringType())])
# ``replies`` stays JSON text, read one level at a time
_REPLIES = "replies"
_STRING_COMMENTS = T.ArrayType(T.StructType([T.StructField(f.name, T.StringType()) for f in NESTED_COMMENT.fields]
                                            + [T.StructField(_REPLIES, T.StringType())]))
COMMENT_REJECT = T.StructType([T.StructField("position", T.IntegerType()), T.StructField("reason", T.StringType()),
                               T.StructField("raw", T.StringType())])
# The fetch time is not required: the landing job stamps its own.
REQUIRED_FIELDS = ("id", "created_utc")
# Reply levels that one pass over the rows with unread replies takes in.
REPLY_LEVELS = 2


def _typed_comment(c: Column) -> Column:
    return F.struct(*[(c[f.name] if isinstance(f.dataType, T.StringType) else c[f.name].try_cast(f.dataType))
                      .alias(f.name) for f in NESTED_COMMENT.fields])


def _comment_reason(c: Column) -> Column:
    """Why a comment is rejected (NULL: it is good, or a stub)."""
    wrong = [F.when(c["id"].isNull(), F.lit("bad_comment:missing:id"))]
    for f in NESTED_COMMENT.fields:
        if not isinstance(f.dataType, T.StringType):
            wrong.append(F.when(c[f.name].isNotNull() & c[f.name].try_cast(f.dataType).isNull(),
                                F.lit(f"bad_comment:bad_type:{f.name}")))
    return (F.when(c.isNull(), F.lit("bad_comment:null"))
            .when(F.coalesce(c["kind"] == MORE_STUB_KIND, F.lit(False)), F.lit(None).cast("string"))
            .otherwise(F.coalesce(*wrong)))


def _comment_list(text: Column) -> Column:
    return F.from_json(text, _STRING_COMMENTS, {"mode": "PERMISSIVE"})


def _taken_in(df: DataFrame, found: str) -> DataFrame:
    """Append the string comments of column ``found`` to the row's comments
    (a rejected one as NULL, which keeps positions), their rejects and replies."""
    c = F.col(found)
    judged = df.withColumn("_at", F.size(_COMMENTS)).withColumn("_why", F.transform(c, _comment_reason))
    kept = F.transform(c, lambda x, i: F.when(F.get("_why", i).isNull(), _typed_comment(x)).cast(NESTED_COMMENT))
    rejects = F.filter(F.transform(c, lambda x, i: F.when(F.get("_why", i).isNotNull(), F.struct(
        (F.col("_at") + i).cast("int").alias("position"), F.get("_why", i).alias("reason"), F.to_json(x).alias("raw")))),
        lambda r: r.isNotNull())
    replies = F.filter(F.transform(c, lambda x: x[_REPLIES]), lambda r: r.isNotNull() & ~F.trim(r).isin("", "[]", "null"))
    return judged.withColumn("comment_rejects", F.concat("comment_rejects", rejects)).withColumn("_replies", replies).withColumn(
        _COMMENTS, F.concat(_COMMENTS, kept)).drop("_at", "_why", found)


def next_replies(df: DataFrame, levels: int = REPLY_LEVELS) -> DataFrame:
    """Read up to ``levels`` more levels of the replies that rows still hold as
    text in ``_replies``; comments go level by level, siblings in list order
    under parents in order. In its row: nothing is shuffled."""
    for _ in range(levels):
        lists = F.transform("_replies", lambda r: F.coalesce(_comment_list(r), F.array().cast(_STRING_COMMENTS)))
        df = _taken_in(df.withColumn("_c", F.flatten(lists)), "_c")
    return df


def parse_submission_json(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Parse JSON lines leniently; add ``_reject_reason`` (NULL = good row).

    Every field is read as a string, then ``try_cast`` to its declared type,
    so one bad value rejects its row instead of failing the job. Reasons:
    'malformed_json', 'missing:<field>', 'bad_type:<field>' (first found).
    Nested comments and their ``replies`` are read the same way. A comment
    without an id, or with a value of a wrong type, is rejected by itself
    (``comment_rejects``: position, reason, raw text) and NULL in ``comments``;
    its record, the other comments and its replies stay. ``_replies`` holds
    the replies' JSON, not read yet: :func:`next_replies` does, for the rows
    that have any.
    """
    raw = F.col(value_col)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = lines.select(raw.alias("_raw"), F.from_json(raw, _STRING_RECORD, options).alias("r"))
    is_json = F.col(f"r.{_CORRUPT}").isNull()   # one parse: the reader flags broken lines
    cols, reasons = [], []
    for f in SUBMISSION_RECORD.fields:
        s = F.col(f"r.{f.name}")
        typed = s if isinstance(f.dataType, T.StringType) else s.try_cast(f.dataType)
        cols.append(typed.alias(f.name))
        if f.name in REQUIRED_FIELDS:
            reasons.append(F.when(s.isNull(), F.lit(f"missing:{f.name}")))
        if not isinstance(f.dataType, T.StringType):
            reasons.append(F.when(s.isNotNull() & typed.isNull(), F.lit(f"bad_type:{f.name}")))
    reason = F.when(~is_json | F.col("r").isNull(), F.lit("malformed_json")).otherwise(F.coalesce(*reasons))
    text = F.col(f"r.{_COMMENTS}")
    listed = parsed.select(*cols, reason.alias("_reject_reason"), "_raw", text.alias("_text"), _comment_list(text).alias("_list"))
    no_list = F.col("_list").isNull() & F.col("_text").isNotNull() & (F.trim("_text") != "")
    whole = F.array(F.struct(F.lit(None).cast("int").alias("position"), F.lit("bad_comment:not_a_list").alias("reason"),
                             F.col("_text").alias("raw")))
    none = F.array().cast(T.ArrayType(COMMENT_REJECT))
    first = listed.select(
        *[f.name for f in SUBMISSION_RECORD.fields], "_reject_reason", "_raw", F.array().cast(T.ArrayType(NESTED_COMMENT)).alias(_COMMENTS),
        F.when(no_list, whole).otherwise(none).cast(T.ArrayType(COMMENT_REJECT)).alias("comment_rejects"),
        F.when(F.col("_reject_reason").isNull(), F.col("_list")).alias("_given"))
    first = first.withColumn("_c", F.coalesce("_given", F.array().cast(_STRING_COMMENTS))).drop("_given")
    return _taken_in(first, "_c")


def check_records(records: DataFrame) -> DataFrame:
    """Typed records with ``comments``, ``_reject_reason`` and ``_raw``
    (columns they lack are NULL)."""
    present = {c.lower() for c in records.columns}
    fields = [*SUBMISSION_RECORD.fields, T.StructField(_COMMENTS, T.ArrayType(NESTED_COMMENT)),
              T.StructField("comment_rejects", T.ArrayType(COMMENT_REJECT)), T.StructField("_replies", T.ArrayType(T.StringType()))]
    cols = [(F.col(f.name) if f.name.lower() in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]
    reason = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(f"missing:{c}")) for c in REQUIRED_FIELDS])
    out = records.select(*cols)
    given = [f.name for f in fields if f.name not in ("comment_rejects", "_replies")]
    return out.select("*", reason.alias("_reject_reason"), F.to_json(F.struct(*given)).alias("_raw"))


_BOOKKEEPING = ("_reject_reason", "_raw", "comment_rejects", "_replies")


def reject_bad_rows(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split parsed records into (good records, rejected raw lines + reason)."""
    good = parsed.filter(F.col("_reject_reason").isNull()).drop(*_BOOKKEEPING)
    bad = parsed.filter(F.col("_reject_reason").isNotNull()).select("_raw", "_reject_reason")
    return good, bad


def rejects_of(parsed: DataFrame) -> DataFrame:
    """All rejects: ``(_raw, _reject_reason, submission_id, comment_position)``.
    A rejected line has neither id nor position; a rejected comment has both
    (no position if its whole list could not be read)."""
    lines = reject_bad_rows(parsed)[1].select("_raw", "_reject_reason", F.lit(None).cast("string").alias("submission_id"),
                                              F.lit(None).cast("int").alias("comment_position"))
    comments = parsed.filter(F.col("_reject_reason").isNull()).select("id", F.explode("comment_rejects").alias("r")).select(
        F.col("r.raw").alias("_raw"), F.col("r.reason").alias("_reject_reason"), F.col("id").alias("submission_id"),
        F.col("r.position").alias("comment_position"))
    return lines.unionByName(comments)
