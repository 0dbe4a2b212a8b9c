"""Author profiles kept up to date: one merged state, changed by a run's days.

The state holds the sums of all known days by (author, topic), the grain at
which the daily partials merge, so the distinct topics stay exact. It is
partitioned by a hash bucket of the author. A run of new days reads their
partials and the buckets of their authors, not the partials of earlier days.
A day that is built again first takes its old partials out: sums and topics
subtract exactly; first and last times do not, so they are looked up again in
the other days' partials, for the keys whose removed times are the state's own.

The partials stay the truth. Days are marked as known after the state is
written and the marks are taken away before, so a run that fails between
finds no marks and the next one makes the state anew from all partials.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.operators import gold as G
from postlake.schemas import TABLES, conform
from postlake.session import stored
from postlake.sinks.tables import clear_days, guard_not_null, partition_days, replace_partitions, replace_values, scan_days

BUCKET_COL = "bucket"
#: Buckets of a state table; a table keeps the number it was made with.
BUCKETS = 64
PARTIALS = TABLES["author_daily_partials"][0]
KEYS = ["author_name", "game_topic"]
SUMS = ["n", "score_sum", "score_n", "comments_sum", "comments_n", "trending_n", "positive_n"]
STATE = T.StructType([*[f for f in PARTIALS.fields if f.name != "ds"], T.StructField(BUCKET_COL, T.IntegerType())])


def _bucket() -> F.Column:
    return F.pmod(F.xxhash64("author_name"), F.lit(BUCKETS)).cast("int")


def merged(parts: DataFrame) -> DataFrame:
    """Sums of ``parts`` (daily partials or states) by author and topic."""
    return (parts.groupBy(*KEYS)
            .agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in SUMS],
                 F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))
            .withColumn(BUCKET_COL, _bucket()).select(*STATE.names))


def _same_key(left: DataFrame, right: DataFrame) -> F.Column:
    return (left.author_name == right.k_author) & left.game_topic.eqNullSafe(right.k_topic)


def without(state: DataFrame, removed: DataFrame, others: DataFrame) -> DataFrame:
    """``state`` after the partials ``removed`` are taken out; ``others`` are
    the partials that stay. Keys without rows left go."""
    out = merged(removed).drop(BUCKET_COL)
    gone = out.select(F.col("author_name").alias("k_author"), F.col("game_topic").alias("k_topic"),
                      *[F.col(c).alias(f"r_{c}") for c in [*SUMS, "first_seen", "last_seen"]])
    less = state.join(gone, _same_key(state, gone), "left")
    rest = less.select(
        *KEYS, *[(F.col(c) - F.coalesce(f"r_{c}", F.lit(0))).alias(c) for c in SUMS], "first_seen", "last_seen",
        BUCKET_COL, F.coalesce((F.col("r_first_seen") <= F.col("first_seen")) | (F.col("r_last_seen") >= F.col("last_seen")),
                               F.lit(False)).alias("_open")).where("n > 0")
    keys = rest.where("_open").select(F.col("author_name").alias("k_author"), F.col("game_topic").alias("k_topic"))
    times = others.select(*KEYS, "first_seen", "last_seen")
    times = (times.join(keys, _same_key(times, keys), "left_semi").groupBy(*KEYS)
             .agg(F.min("first_seen").alias("t_first"), F.max("last_seen").alias("t_last"))
             .withColumnsRenamed({"author_name": "k_author", "game_topic": "k_topic"}))
    return rest.join(times, _same_key(rest, times), "left").select(
        *KEYS, *SUMS, F.when(F.col("_open"), F.col("t_first")).otherwise(F.col("first_seen")).alias("first_seen"),
        F.when(F.col("_open"), F.col("t_last")).otherwise(F.col("last_seen")).alias("last_seen"), BUCKET_COL)


def update(spark: SparkSession, silver_of: Callable[[list[_dt.date]], DataFrame], silver_days: list[_dt.date],
           partials_path: str, state_path: str, days: list[_dt.date]) -> list[int]:
    """Write the partials of ``days`` (and of silver days that have none), merge
    them into the state and return the buckets that were written."""
    marks = state_path + "_days"
    known, built = set(partition_days(spark, marks)), set(partition_days(spark, partials_path))
    todo = sorted(set(days) | (set(silver_days) - built))
    again = sorted(known & set(todo))
    new = stored(conform(G.author_daily_partials(silver_of(todo)), PARTIALS), "author-partials")
    # partials that an earlier program wrote and the state has not seen come in as they are
    unseen = sorted(built - known - set(todo)) if known else []
    state = spark.read.schema(STATE).parquet(state_path) if known else None
    if state is not None:
        fresh = new.unionByName(scan_days(spark, partials_path, unseen, PARTIALS)) if unseen else new
        removed = scan_days(spark, partials_path, again, PARTIALS) if again else None
        touching = fresh.select("author_name") if removed is None else fresh.select("author_name").unionByName(
            removed.select("author_name"))
        buckets = sorted(r[0] for r in touching.select(_bucket()).distinct().collect())      # at most BUCKETS
        old = state.where(F.col(BUCKET_COL).isin(*buckets))
        if removed is not None:
            stay = scan_days(spark, partials_path, known - set(todo), PARTIALS) if known - set(todo) else removed.limit(0)
            old = without(old, removed, stay)
        result = stored(merged(old.drop(BUCKET_COL).unionByName(fresh.drop("ds"))), "author-state")
    clear_days(spark, marks, known)
    replace_partitions(guard_not_null(new, PARTIALS), partials_path, todo)
    if state is None:
        result = merged(spark.read.schema(PARTIALS).parquet(partials_path))
        buckets = list(range(BUCKETS))
    if buckets:
        replace_values(result, state_path, BUCKET_COL, buckets)
    now = sorted((known | set(unseen) | set(partition_days(spark, partials_path)) | set(todo)))
    replace_partitions(spark.createDataFrame([(1, d) for d in now], "known int, ds date"), marks, now)
    return buckets


def forget(spark: SparkSession, state_path: str) -> None:
    """Take the marks away: the next update makes the state from all partials."""
    clear_days(spark, state_path + "_days", partition_days(spark, state_path + "_days"))


def profiles(spark: SparkSession, state_path: str) -> DataFrame:
    """The profiles from the state (one row per author and topic)."""
    return G.author_profiles_from_partials(spark.read.schema(STATE).parquet(state_path))
