"""Landing job: record files → raw submissions, raw comments and rejects.

The text is read and parsed once; the parsed records are stored below the
shared checkpoint folder and fan out from there, each target reading its own
columns. Rejected lines and comments are kept by run, replaced when the run
is repeated, and never reach a raw table. A file with broken lines therefore
replaces only the days its good rows belong to, and a file without a good row
replaces nothing.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from postlake.functions.timefmt import parse_ds
from postlake.operators.topk import top_n_per_key
from postlake.session import drop_scratch, free_shuffles, observed, scratch_path
from postlake.sinks.tables import FEW_DAYS, codec, overwrite_partitions, replace_partition, replace_values
from postlake.sources.landing import (DaySpread, day_spread, flatten_comments, land_comments, land_submissions, next_replies,
                                      read_records, reject_bad_rows, rejects_of)

#: Partition column of the rejects: the run date, or a digest of the paths.
RUN_COL = "run"
#: Level of the codec: texts take about 5 % less space than at its default of 3.
LEVEL = 6


@dataclass
class LandingResult:
    read: int
    landed: int
    rejected: int
    rejected_comments: int = 0


def limit_records(records: DataFrame, newest: int | None = None, top: int | None = None) -> DataFrame:
    """The fetch limit of a run: per subreddit the ``newest`` records by
    creation time, or the ``top`` ones by score (ties: smaller id)."""
    for n, by in ((newest, "created_utc"), (top, "score")):
        if n:
            order = [F.col(by).desc_nulls_last(), F.col("id").asc_nulls_last()]
            records = top_n_per_key(records, ["subreddit"], order, n, ["id", "retrieved_utc"])
    return records


def _write_comments(records: DataFrame, path: str, day: _dt.date | None, spread: DaySpread | None) -> None:
    """Land comment records with one shuffle: few days are written where their
    distinct rows are, more days are gathered as duplicates are found."""
    if day is not None:
        replace_partition(land_comments(records, day), path, day)
    else:                                # the fetch dates present
        pieces = None if spread.days <= FEW_DAYS else spread.pieces
        overwrite_partitions(land_comments(records, pieces=pieces), path, gather=False, level=LEVEL)


class StoredRecords:
    """Parsed records, stored: one pass over the text, however deep replies are."""

    def __init__(self, parsed: DataFrame, name: str = "parsed"):
        self.spark, self.paths = parsed.sparkSession, []
        seen = Observation(f"{name}-{id(self)}")
        totals = (F.count(F.lit(1)).alias("read"), F.count("_reject_reason").alias("rejected"),
                  F.sum(F.size("comment_rejects")).alias("comments"))
        left = F.size("_replies") > 0
        # a good line needs no raw text again, a rejected one no other text; one fetch time holds for all targets
        slim = parsed.withColumns({
            "_raw": F.when(F.col("_reject_reason").isNotNull(), F.col("_raw")),
            "selftext": F.when(F.col("_reject_reason").isNull(), F.col("selftext")),
            "retrieved_utc": F.coalesce("retrieved_utc", F.unix_timestamp(F.current_timestamp()))})
        self.rows = self._put(slim.observe(seen, *totals, F.count_if(left).alias("deeper")), name)
        counts = observed(seen) or {"read": 0, "rejected": 0, "comments": 0, "deeper": 0}
        deeper = counts["deeper"] or 0
        while deeper:                         # only rows with deeper replies are read again
            more = Observation(f"{name}-{id(self)}-{len(self.paths)}")
            rest = self._put(next_replies(self.rows.where(left)).observe(more, F.count_if(left).alias("deeper")), name)
            self.rows = self.rows.where(~F.coalesce(left, F.lit(False))).unionByName(rest)
            deeper = (observed(more) or {"deeper": 0})["deeper"]
        self.read, self.rejected = counts["read"], counts["rejected"]

    def _put(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        self.paths.append(path)
        df.write.options(**codec(LEVEL)).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        for path in self.paths:
            drop_scratch(self.spark, path)


def write_rejects(parsed: DataFrame, path: str, run: str) -> int:
    """Replace the rejects of one run; returns how many are comments."""
    seen = Observation("rejects-" + run)
    rows = rejects_of(parsed).withColumn(RUN_COL, F.lit(run)).observe(
        seen, F.count("submission_id").alias("comments"))
    replace_values(rows, path, RUN_COL, [run], gather=False)
    return (observed(seen) or {"comments": 0})["comments"]


def run_key(paths: str | list[str], day: _dt.date | None) -> str:
    if day is not None:
        return day.isoformat()
    given = "\n".join(sorted([paths] if isinstance(paths, str) else paths))
    return "files-" + hashlib.sha256(given.encode()).hexdigest()[:16]


def land_files(spark: SparkSession, paths: str | list[str], raw_path: str, comments_path: str | None = None,
               rejects_path: str | None = None, ds: str | _dt.date | None = None, fmt: str = "json",
               newest: int | None = None, top: int | None = None, comment_limit: int | None = None) -> LandingResult:
    """Land record files. With ``ds`` every row belongs to that run date, whose
    partition is replaced; a run without any good row changes nothing.
    Comments come from the landed records' own lists and reply trees (the
    first ``comment_limit`` of each); a broken comment leaves its record and
    the others in place. Rejects go to ``rejects_path`` (``_raw``,
    ``_reject_reason``, ``submission_id``, ``comment_position``) in the run's
    partition: the run date or, without one, a digest of ``paths``. Landing
    the same files again leaves every table as it was."""
    day = parse_ds(ds) if ds is not None else None
    records = StoredRecords(read_records(spark, paths, fmt))
    try:
        good, _ = reject_bad_rows(records.rows)
        chosen = limit_records(good, newest, top)
        spread = day_spread(good, comment_limit) if day is None else None
        landed_seen = Observation("landed")
        landed = land_submissions(chosen, day).observe(landed_seen, F.count(F.lit(1)).alias("rows"))
        # no rows: no partition changes; a fetch limit moves rows out of their files
        in_place = spread is not None and spread.day_by_day() and not (newest or top)
        overwrite_partitions(landed, raw_path, gather=not in_place, level=LEVEL)
        rows = (observed(landed_seen) or {"rows": 0})["rows"]
        free_shuffles(spark)
        if comments_path and rows:
            _write_comments(flatten_comments(chosen, limit=comment_limit), comments_path, day, spread)
            free_shuffles(spark)
        bad_comments = write_rejects(records.rows, rejects_path, run_key(paths, day)) if rejects_path else 0
    finally:
        records.drop()
        free_shuffles(spark)
    return LandingResult(records.read, rows, records.rejected, bad_comments)
