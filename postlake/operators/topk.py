"""Per-key limits, daily ranks and the daily top-k report.

Ties are broken by the id column (ascending), so every rank is a total,
reproducible order; NULL keys sort last, as ``ORDER BY x DESC`` does. One
plan serves every ``n`` and ``k``, no operator here starts a job, and joins
carry no size hints: adaptive execution broadcasts a side by its measured
size and splits a skewed one.

* Limits work on two levels. A key's rows are first dealt over ``SALT``
  groups and cut to ``n`` there, then the survivors are cut to ``n``; so a hot
  key (one subreddit, one day) is sorted by many tasks whatever ``n`` is.
  (Up to Spark's own group-limit threshold the cut also happens before the
  first shuffle.)
* ``top_k_either`` never sorts a whole day. All keys are cut together to the
  candidates; every row then finds its place among its day's sorted candidates
  by binary search, and rows are counted by place (partial sums before the
  shuffle), which gives each candidate's exact rank under every key.
* ``daily_rank`` ranks *every* row: range partitioning splits a hot day over
  many tasks, and a table of at most partitions + days rows turns local
  positions into day ranks. Positions must be fixed before they are joined
  back, so it works on numbered rows that the caller has stored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlake.schemas import GOLD_TOP_DAILY, columns

TOP_DAILY_K = 10
SALT = 64


def _desc_then_id(order_col: str, id_col: str) -> list[Column]:
    return [F.col(order_col).desc_nulls_last(), F.col(id_col).asc_nulls_last()]


def top_n_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int | None,
                  salt_by: list[str], rank_col: str | None = None) -> DataFrame:
    """Keep the first ``n`` rows of each key group (``n`` None/0 = all).

    ``salt_by`` names narrow columns whose hash deals a key's rows over
    groups; any choice gives the same rows."""
    if not n:
        return df
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*salt_by), F.lit(SALT)))
    inner = Window.partitionBy(*keys, "_salt").orderBy(*order)
    cut = salted.withColumn("_rn", F.row_number().over(inner)).filter(F.col("_rn") <= int(n)).drop("_rn", "_salt")
    out = cut.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))) \
             .filter(F.col("_rn") <= int(n))
    return out.withColumnRenamed("_rn", rank_col) if rank_col else out.drop("_rn")


# ---------------------------------------------------------------------------
# Landing limits (the API's new(limit=N) / top(limit=N) / comment limit).

def limit_newest_per_subreddit(raw: DataFrame, n: int = 50) -> DataFrame:
    return top_n_per_key(raw, ["ds", "subreddit"], _desc_then_id("created_utc_unix", "submission_id"), n,
                         ["submission_id", "retrieved_utc_unix"])


def limit_top_per_subreddit(raw: DataFrame, n: int = 50) -> DataFrame:
    return top_n_per_key(raw, ["ds", "subreddit"], _desc_then_id("score", "submission_id"), n,
                         ["submission_id", "retrieved_utc_unix"])


def limit_comments_per_submission(comments: DataFrame, n: int | None = 50) -> DataFrame:
    """First ``n`` landed comments of each submission by creation time, then
    id; ``n`` of 0 or None keeps all. (At landing the limit goes by position
    in the comment list: ``flatten_comments(limit=n)``.)"""
    order = [F.col("created_utc_unix").asc_nulls_last(), F.col("comment_id").asc_nulls_last()]
    return top_n_per_key(comments, ["ds", "submission_id"], order, n, ["comment_id"])


# ---------------------------------------------------------------------------
# Daily top-k report.

def _sort_key(key: str, id_col: str) -> Column:
    """A struct that sorts as (key descending, NULLs last, id ascending);
    ``~v`` falls as an integer ``v`` rises and cannot overflow."""
    return F.struct(F.col(key).isNull().alias("n"), F.bitwise_not(F.col(key)).alias("v"), F.col(id_col).alias("i"))


def _place(cands: str, x: Column, steps: int) -> Column:
    """Index of the first entry of the sorted array ``cands`` that is not
    below ``x`` (its size if all are), by binary search."""
    def step(s: Column, _: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        open_, below = s["lo"] < s["hi"], F.get(cands, mid) < x
        return F.struct(F.when(open_ & below, mid + 1).otherwise(s["lo"]).alias("lo"),
                        F.when(open_ & ~below, mid).otherwise(s["hi"]).alias("hi"))

    start = F.struct(F.lit(0).alias("lo"), F.size(cands).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step, lambda s: s["lo"])


def top_k_either(df: DataFrame, id_col: str, keys: list[tuple[str, str]], k: int = TOP_DAILY_K,
                 part_col: str = "ds") -> DataFrame:
    """Rows in the top ``k`` of their ``part_col`` group by *any* of ``keys``
    (integer keys, each descending, NULLs last, ties by ``id_col``), with the
    exact rank under every key. ``keys`` is a list of (order column, rank column).

    Two passes over the narrow key columns: one cuts all keys together to the
    candidates, at most ``k`` a key and group; the other finds every row's
    place among its group's sorted candidates, under each key, and counts rows
    by place, so a candidate's rank is the sum of the counts up to its own.
    The rows of the ranked candidates are one more pass over ``df``, which
    should be a written table. ``id_col`` is unique within a group and not
    NULL (it is, per day, after dedup and QC).
    """
    names = [c for c, _ in keys]
    narrow = df.select(part_col, id_col, *names)
    by_key = narrow.select(part_col, id_col, *names, F.posexplode(F.array(*[_sort_key(c, id_col) for c in names]))
                           .alias("_key", "_order"))
    tops = top_n_per_key(by_key, [part_col, "_key"], [F.col("_order")], k, [id_col])
    cands = tops.groupBy(F.col(part_col).alias("_part")).agg(*[
        F.array_sort(F.collect_set(_sort_key(c, id_col))).alias(f"_cands{i}") for i, c in enumerate(names)])
    steps = max(1, (len(keys) * k).bit_length())
    placed = narrow.join(cands, F.col(part_col).eqNullSafe(F.col("_part"))).select(part_col, F.posexplode(F.array(*[
        F.struct(_place(f"_cands{i}", _sort_key(c, id_col), steps).alias("place"), F.size(f"_cands{i}").alias("size"),
                 F.col(id_col).alias("id"), _sort_key(c, id_col).alias("order")) for i, c in enumerate(names)])).alias("_key", "_x"))
    # of the rows that share a place the last one is the candidate itself
    counts = placed.where(F.col("_x.place") < F.col("_x.size")).groupBy(part_col, "_key", F.col("_x.place").alias("_place")).agg(
        F.count(F.lit(1)).alias("_n"), F.max_by("_x.id", "_x.order").alias(id_col))
    up_to = Window.partitionBy(part_col, "_key").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumn("_rank", F.sum("_n").over(up_to).cast("int")).groupBy(part_col, id_col).agg(*[
        F.max(F.when(F.col("_key") == i, F.col("_rank"))).alias(rank) for i, (_, rank) in enumerate(keys)])
    keep = reduce(lambda a, b: a | b, [F.col(rank) <= k for _, rank in keys])
    chosen = ranked.filter(keep).withColumnsRenamed({part_col: "_part", id_col: "_id"})
    return df.join(chosen, F.col(part_col).eqNullSafe(F.col("_part")) & (F.col(id_col) == F.col("_id"))).drop("_part", "_id")


def gold_top_daily(silver: DataFrame, k: int = TOP_DAILY_K) -> DataFrame:
    """Daily top-k report by score or by comments, with both exact ranks."""
    out = top_k_either(silver, "content_id", [("score", "rank_score"), ("num_comments", "rank_comments")], k, "ds")
    return out.select(*columns(GOLD_TOP_DAILY))


# ---------------------------------------------------------------------------
# Full daily rank of every row.

_POS_BITS = 33  # monotonically_increasing_id = partition index << 33 | row position


def number_rows(df: DataFrame, order_col: str, id_col: str = "content_id", keep: list[str] | None = None,
                num_partitions: int | None = None) -> DataFrame:
    """Rows in (day, key descending, id) order with their partition and the
    position in it. Store the result before ranking it."""
    order = [F.col("ds").asc(), *_desc_then_id(order_col, id_col)]
    base = df.select(*dict.fromkeys(["ds", id_col, order_col, *(keep or [])]))
    parted = (base.repartitionByRange(num_partitions, *order) if num_partitions
              else base.repartitionByRange(*order))
    return (parted.sortWithinPartitions(*order)
            .withColumn("_mid", F.monotonically_increasing_id())
            .withColumn("_pid", F.shiftright(F.col("_mid"), _POS_BITS))
            .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1)))
            .drop("_mid"))


def daily_rank(numbered: DataFrame, rank_col: str) -> DataFrame:
    """``row_number() over (partition by ds order by key desc, id)`` of every
    row of a *stored* :func:`number_rows`, without one task per day.

    The per-(partition, day) counts are at most partitions + days - 1 rows; the
    join leaves it to adaptive execution to broadcast them."""
    stats = numbered.groupBy("_pid", "ds").agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    w = Window.partitionBy("ds").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_offset", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    ranked = numbered.join(stats.select("_pid", "ds", "_offset", "_first"), ["_pid", "ds"])
    rank = (F.col("_offset") + F.col("_pos") - F.col("_first") + 1).cast("bigint")
    cols = [c for c in numbered.columns if c not in ("_pid", "_pos")]
    return ranked.select(*cols, rank.alias(rank_col))
