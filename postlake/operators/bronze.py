"""Raw → bronze: keep the latest version of each submission, type it, QC it.

One plan, no intermediate actions: the three counts the reference prints
(input, after dedup, after QC) are collected with ``Observation`` during the
single write, instead of re-running the dedup plan for each count.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from postlake.functions.timefmt import ts_from_unix
from postlake.schemas import BRONZE_SUBMISSIONS, conform
from postlake.session import observed

DEDUP_ORDER = ("_loaded_at_timestamp_utc", "created_utc_unix")
# Compared last, so that whole texts are looked at only if all else is equal.
WIDE_COLUMNS = ("title", "selftext", "body")


def latest_version_order(columns: list[str], key: str, order: tuple[str, ...] = DEDUP_ORDER) -> list[Column]:
    """Newest load first, then newest creation, then the other columns in
    their order (texts last), so the kept row never depends on task order.
    Nothing is hashed, and a frame without its texts orders the same way."""
    rest = [c for c in columns if c not in (key, "ds", *order)]
    names = [*order, *[c for c in rest if c not in WIDE_COLUMNS], *[c for c in rest if c in WIDE_COLUMNS]]
    return [F.col(c).desc_nulls_last() for c in names if c in columns]


def dedup_latest(df: DataFrame, key: str = "submission_id", scope: str = "day",
                 order: tuple[str, ...] = DEDUP_ORDER) -> DataFrame:
    """Keep one row per key: the newest by the ``order`` columns.

    ``scope="day"`` dedups inside each ``ds`` (the reference's behaviour,
    its scan is filtered to one day); ``scope="all"`` across days.

    Plan: ``row_number() == 1`` becomes a partial WindowGroupLimit before the
    shuffle, so a key with millions of versions is cut to one row per map
    task before it moves (hot keys never pile up in one reducer).
    """
    if scope not in ("day", "all"):
        raise ValueError("scope must be 'day' or 'all'")
    parts = ["ds", key] if scope == "day" else [key]
    w = Window.partitionBy(*parts).orderBy(*latest_version_order(df.columns, key, order))
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1)
              .drop("_rn"))


def latest_days(raw: DataFrame) -> DataFrame:
    """``(submission_id, ds)``: the day that holds the latest version of each
    submission over the whole raw table (narrow columns only; versions equal
    in all of them: the later day). A NULL id stays with its own day."""
    narrow = raw.drop(*WIDE_COLUMNS).filter(F.col("submission_id").isNotNull())
    order = [*latest_version_order(narrow.columns, "submission_id"), F.col("ds").desc_nulls_last()]
    w = Window.partitionBy("submission_id").orderBy(*order)
    return narrow.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").select("submission_id", "ds")


def bronze_project(df: DataFrame) -> DataFrame:
    """Rename + derive + fix the 22-column bronze order."""
    out = df.select(
        F.col("submission_id"),
        F.col("author_name"),
        F.col("created_utc").alias("raw_created_utc_str"),
        F.col("created_utc_unix"),
        ts_from_unix("created_utc_unix").alias("created_at_timestamp"),
        F.col("edited").cast("string").alias("edited"),
        F.col("flair").cast("string").alias("flair"),
        "is_self", "num_comments", "over_18", "permalink", "retrieved_utc_unix", "score",
        "selftext", "spoiler", "stickied",
        F.col("subreddit").alias("raw_subreddit_name"),
        "title", "upvote_ratio", "url", "ds", "_loaded_at_timestamp_utc",
    )
    return conform(out, BRONZE_SUBMISSIONS)


def qc_predicate() -> Column:
    return (F.col("submission_id").isNotNull()
            & F.col("created_at_timestamp").isNotNull()
            & (F.col("score") >= 0))


def qc_filter(bronze: DataFrame) -> DataFrame:
    """Drop rows without id or time, and negative / NULL scores.

    Runs *after* dedup: when the newest version is bad, the submission is
    gone; an older good version is not used instead.
    """
    return bronze.filter(qc_predicate())


def qc_dropped(bronze: DataFrame) -> DataFrame:
    """The rows that :func:`qc_filter` drops, with the first reason."""
    reason = (F.when(F.col("submission_id").isNull(), F.lit("no id"))
              .when(F.col("created_at_timestamp").isNull(), F.lit("no creation time"))
              .when(F.col("score").isNull(), F.lit("no score")).when(F.col("score") < 0, F.lit("negative score")))
    return bronze.withColumn("qc_reason", reason).filter(F.col("qc_reason").isNotNull())


@dataclass
class BronzeCounts:
    """Observed row counts of one bronze run (filled by the first action)."""
    raw: Observation = field(default_factory=lambda: Observation("bronze_raw"))
    deduped: Observation = field(default_factory=lambda: Observation("bronze_deduped"))
    final: Observation = field(default_factory=lambda: Observation("bronze_final"))

    def as_dict(self) -> dict[str, int]:
        return {
            name: (observed(seen) or {"rows": 0})["rows"]
            for name, seen in (("raw", self.raw), ("deduped", self.deduped), ("final", self.final))
        }


def _count_rows() -> Column:
    return F.count(F.lit(1)).alias("rows")


def bronze_submissions(raw: DataFrame, scope: str = "day", counts: BronzeCounts | None = None,
                       all_raw: DataFrame | None = None, winners: DataFrame | None = None) -> DataFrame:
    """Deduplicated, typed and checked submissions of ``raw``.

    With ``scope="all"`` and ``winners`` (the day of each submission's latest
    version, kept by ``plans.versions``), or ``all_raw`` (the whole raw table of
    which ``raw`` holds some days) to find them, a submission stays only on the
    day of its latest version over that table, so any split of the days into
    runs gives the same rows."""
    df = raw
    if counts is not None:
        df = df.observe(counts.raw, _count_rows())
    if scope == "all" and (winners is not None or all_raw is not None):
        kept = winners if winners is not None else latest_days(all_raw)
        df = dedup_latest(df, "submission_id", "day").join(kept, ["submission_id", "ds"], "left_semi").select(*raw.columns)
    else:
        df = dedup_latest(df, "submission_id", scope)
    df = bronze_project(df)
    if counts is not None:
        df = df.observe(counts.deduped, _count_rows())
    df = qc_filter(df)
    if counts is not None:
        df = df.observe(counts.final, _count_rows())
    return df


def qc_report(raw: DataFrame, scope: str = "day") -> DataFrame:
    """Per day: rows landed, rows after dedup, rows after QC, and the drops.

    The reference prints these three counts per run; here they are a table
    for every day of the input. Two small aggregates (≤ one row per day
    each) joined on ``ds``; the dedup side orders as bronze does, on the
    narrow columns alone.
    """
    landed = raw.groupBy("ds").agg(F.count(F.lit(1)).alias("raw_rows"))
    deduped = dedup_latest(raw.drop(*WIDE_COLUMNS), "submission_id", scope).withColumn(
        "created_at_timestamp", ts_from_unix("created_utc_unix"))
    kept = deduped.groupBy("ds").agg(F.count(F.lit(1)).alias("deduped_rows"),
                                     F.count_if(qc_predicate()).alias("final_rows"))
    out = landed.join(kept, "ds", "left").fillna(0, ["deduped_rows", "final_rows"])
    return out.select("ds", "raw_rows", "deduped_rows", "final_rows",
                      (F.col("raw_rows") - F.col("deduped_rows")).alias("dropped_by_dedup"),
                      (F.col("deduped_rows") - F.col("final_rows")).alias("dropped_by_qc"))
