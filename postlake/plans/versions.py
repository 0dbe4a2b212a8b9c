"""Which day holds the latest version of every submission, kept up to date.

The state table has one row per (submission, day): the day's best version,
without its texts. It is partitioned by a hash bucket of the id. A run merges
its own days into the buckets that it touches: the rows of its days are
replaced there, and the latest version of each id is chosen again, so only
the run's raw days and those buckets are read, never the raw table's history.
Comparing the choices before and after tells which other built days gained or
lost a submission.

``Change.commit`` writes the merged buckets and marks the days as known. It is
called after the layers are written: a run that fails before it finds the old
state again and repeats its work.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.operators.bronze import WIDE_COLUMNS, dedup_latest, latest_version_order
from postlake.schemas import RAW_SUBMISSIONS
from postlake.session import stored
from postlake.sinks.tables import partition_days, replace_partitions, replace_values, scan_days

KEY = "submission_id"
BUCKET_COL = "bucket"
#: Buckets of a new state table: a few hundred MB of narrow rows each at the
#: table's full size. A table keeps the number it was made with.
BUCKETS = 64
_NARROW = T.StructType([f for f in RAW_SUBMISSIONS.fields if f.name not in WIDE_COLUMNS])
STATE = T.StructType([*_NARROW.fields, T.StructField(BUCKET_COL, T.IntegerType())])


def day_versions(raw: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The best version of every submission on every day, with its bucket
    (narrow columns; rows without an id have no versions)."""
    best = dedup_latest(raw.select(*_NARROW.names).filter(F.col(KEY).isNotNull()), KEY, "day")
    return best.withColumn(BUCKET_COL, F.pmod(F.xxhash64(KEY), F.lit(buckets)).cast("int")).select(*STATE.names)


def latest(versions: DataFrame) -> DataFrame:
    """``(submission_id, ds)`` of the latest version of each submission
    (versions equal in all columns: the later day)."""
    order = [*latest_version_order(_NARROW.names, KEY), F.col("ds").desc_nulls_last()]
    rank = F.row_number().over(Window.partitionBy(KEY).orderBy(*order))
    return versions.withColumn("_rn", rank).filter("_rn = 1").select(KEY, "ds")


def raw_days(spark: SparkSession, raw_path: str) -> list[_dt.date]:
    """Days of the raw table: its folders or, below batch ids, its day column."""
    return partition_days(spark, raw_path) or sorted(
        r.ds for r in spark.read.schema(RAW_SUBMISSIONS).parquet(raw_path).select("ds").distinct().collect())


@dataclass
class Change:
    """What a run's days change."""

    days: list[_dt.date]              # the run's days and the built ones that gained or lost a submission
    winners: DataFrame                # (submission_id, ds) of the latest versions on those days
    buckets: list[int]                # touched
    merged: DataFrame                 # their rows
    new_days: list[_dt.date]
    path: str

    def commit(self) -> None:
        """Write the touched buckets, then mark the days as known."""
        if self.buckets:
            replace_values(self.merged, self.path, BUCKET_COL, self.buckets)
        if self.new_days:
            marks = self.merged.sparkSession.createDataFrame([(1, d) for d in self.new_days], "known int, ds date")
            replace_partitions(marks, self.path + "_days", self.new_days)


def change(spark: SparkSession, raw_path: str, path: str, days: list[_dt.date], built: list[_dt.date]) -> Change:
    """Merge ``days`` (and raw days the state has not seen) into the state at
    ``path``. A day of the raw table that is landed again counts from its next
    run on. ``built`` are the days that have bronze rows."""
    known = set(partition_days(spark, path + "_days"))
    new_days = sorted(set(days) | (set(raw_days(spark, raw_path)) - known))
    state = spark.read.schema(STATE).parquet(path) if known else None
    fresh = stored(day_versions(scan_days(spark, raw_path, new_days, RAW_SUBMISSIONS)), "day-versions")
    touched = {r[0] for r in fresh.select(BUCKET_COL).distinct().collect()}         # at most BUCKETS numbers
    again = sorted(known & set(new_days))
    if again:
        touched |= {r[0] for r in state.where(F.col("ds").isin(*again)).select(BUCKET_COL).distinct().collect()}
    buckets = sorted(touched)
    inside = F.col(BUCKET_COL).isin(*buckets)
    old = state.where(inside) if state is not None else fresh.where(F.lit(False))
    merged = stored(old.where(~F.col("ds").isin(*new_days)).unionByName(fresh), "merged-versions")
    after = latest(merged)
    moved = (latest(old).withColumnRenamed("ds", "was").join(after, KEY, "full_outer")
             .where(~F.col("was").eqNullSafe(F.col("ds")))
             .select(F.explode(F.array("was", "ds")).alias("ds")).where("ds IS NOT NULL").distinct())
    others = sorted(({r.ds for r in moved.collect()} & set(built)) - set(days))    # at most one row per day
    every = sorted({*days, *others})
    if others and state is not None:           # their other submissions are in any bucket
        after = after.unionByName(latest(state.where(~inside)))
    return Change(every, after.where(F.col("ds").isin(*every)), buckets, merged, new_days, path)
