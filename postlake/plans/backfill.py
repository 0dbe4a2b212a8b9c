"""Run the layers for a date range: raw table → bronze → silver → gold.

One job per layer for the whole range (not one job per day): every
operator keeps ``ds`` in its keys, so a week or a year is one plan. Each
layer is written (replace-where over the days) and read back by the next,
so lineage is cut at every layer and a lost executor only re-runs tasks of
the current layer. A single day is the range [d, d].

Stored columns are checked against the declared ones before a run, written
columns against theirs, and a NULL in a NOT NULL column fails the write, so
a drifted input replaces nothing.
"""

from __future__ import annotations

import datetime as _dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from postlake.functions.timefmt import ds_range
from postlake.operators import gold as G
from postlake.operators.bronze import BronzeCounts, bronze_submissions
from postlake.operators.silver import silver_submissions
from postlake.operators.topk import gold_top_daily
from postlake.plans import profiles as profile_state
from postlake.plans import versions
from postlake.schemas import TABLES, conform
from postlake.sinks.publish import KEYS as PUBLISHED_KEYS
from postlake.sinks.publish import PublishedTable
from postlake.sinks.tables import (check_table, create_table, full_overwrite, guard_not_null, partition_days,
                                   replace_partitions, scan_days)

PARTITIONED_GOLD = {
    "gold_sentiment_topic": G.gold_sentiment_topic,
    "gold_topic_trends": G.gold_topic_trends,
    "gold_topic_time_series": G.gold_topic_time_series,
    "gold_top_daily": gold_top_daily,
}


@dataclass
class RunResult:
    days: list[_dt.date]
    paths: dict[str, str]
    bronze_counts: dict[str, int] = field(default_factory=dict)


def table_paths(root: str) -> dict[str, str]:
    root = root.rstrip("/")
    return {n: f"{root}/{n}" for n in TABLES}


def run_days(spark: SparkSession, raw_path: str, out_root: str, days: list[_dt.date], scope: str = "day",
             incremental_profiles: bool = True, parallel_gold: bool = True,
             database: str | None = None, publish: bool = False) -> RunResult:
    """Build bronze, silver and all gold tables for ``days``.

    ``scope="day"`` keeps the latest version of a submission per day,
    ``scope="all"`` over the whole raw table: a submission then stays only on
    the day of its latest version, and other built days that lose or gain one
    are rebuilt too, so the tables do not depend on how days are cut into runs.
    A state table (``latest_versions``) knows the versions of earlier days, so
    a run reads the raw rows of its own days only.

    Author profiles cover all history: per-day partial sums are written with
    every run, days of silver that lack them are filled in, and both are merged
    into a state by author (``author_profile_state``) that the profiles are read
    from (or, without ``incremental_profiles``, from the whole silver table). ``database`` registers the tables there by name.
    With ``publish`` the tables live in ``database`` only: each is written once,
    audited and then pointed at (``sinks.publish``), and read by its name.
    """
    if publish and not database:
        raise ValueError("publishing needs a database")
    paths = table_paths(out_root)
    raw_schema = TABLES["raw_submissions"][0]
    check_table(spark, raw_path, raw_schema)
    days = sorted(days)

    if publish:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    tables = {n: PublishedTable.of(spark, database, n, paths[n]) for n in PUBLISHED_KEYS} if publish else {}

    def put(df: DataFrame, name: str, to: list[_dt.date], gather: bool = True) -> None:
        schema = TABLES[name][0]
        rows = guard_not_null(conform(df, schema), schema)
        if name in tables:
            tables[name].publish(rows, to, gather=gather)
        else:
            replace_partitions(rows, paths[name], to, gather)

    def layer(name: str, of: list[_dt.date]) -> DataFrame:
        return tables[name].read(of) if name in tables else scan_days(spark, paths[name], of, TABLES[name][0])

    def built_days(name: str) -> list[_dt.date]:
        return tables[name].days() if name in tables else partition_days(spark, paths[name])

    raw = scan_days(spark, raw_path, days, raw_schema)
    change = None
    if scope == "all":
        change = versions.change(spark, raw_path, f"{out_root.rstrip('/')}/latest_versions", days,
                                 built_days("bronze_submissions"))
        days = change.days
        raw = scan_days(spark, raw_path, days, raw_schema)
    counts = BronzeCounts()
    put(bronze_submissions(raw, scope, counts, winners=change and change.winners), "bronze_submissions", days)
    # narrow over files of one day each: whole texts need no shuffle to be written by day
    put(silver_submissions(layer("bronze_submissions", days)), "silver_submissions", days, gather=False)
    silver = layer("silver_submissions", days)

    def profiles() -> None:
        state = f"{out_root.rstrip('/')}/author_profile_state"
        if incremental_profiles:
            profile_state.update(spark, lambda of: layer("silver_submissions", of), built_days("silver_submissions"),
                                 paths["author_daily_partials"], state, days)
            built = profile_state.profiles(spark, state)
        else:
            profile_state.forget(spark, state)
            put(G.author_daily_partials(silver), "author_daily_partials", days)
            built = G.gold_author_profiles(layer("silver_submissions", built_days("silver_submissions")))
        schema = TABLES["gold_author_profiles"][0]
        rows = guard_not_null(conform(built, schema), schema)
        if publish:
            tables["gold_author_profiles"].publish(rows)
        else:
            full_overwrite(rows, paths["gold_author_profiles"])

    # The gold tables only depend on silver: submit them as concurrent jobs
    # (Spark schedules jobs from separate threads side by side).
    jobs = [lambda n=name, b=build: put(b(silver), n, days) for name, build in PARTITIONED_GOLD.items()] + [profiles]
    if parallel_gold:
        with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
            for f in [pool.submit(j) for j in jobs]:
                f.result()
    else:
        for j in jobs:
            j()
    if change:
        change.commit()
    if database and not publish:
        register_tables(spark, database, {**paths, "raw_submissions": raw_path})
    return RunResult(days=days, paths=paths, bronze_counts=counts.as_dict())


def run_range(spark: SparkSession, raw_path: str, out_root: str,
              ds_from: str | _dt.date, ds_to: str | _dt.date, scope: str = "day",
              incremental_profiles: bool = True, parallel_gold: bool = True,
              database: str | None = None, publish: bool = False) -> RunResult:
    """:func:`run_days` for every day of ``[ds_from, ds_to]``."""
    return run_days(spark, raw_path, out_root, ds_range(ds_from, ds_to), scope, incremental_profiles,
                    parallel_gold, database, publish)


def run_day(spark: SparkSession, raw_path: str, out_root: str, ds: str | _dt.date,
            scope: str = "day") -> RunResult:
    return run_range(spark, raw_path, out_root, ds, ds, scope)


def register_tables(spark: SparkSession, database: str, paths: dict[str, str]) -> list[str]:
    """Register the written tables under their names (if missing) and pick up
    their new partitions; returns the qualified names. A raw table is
    registered where it has day folders (not below batch ids, as streaming
    writes it)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = []
    for name, path in paths.items():
        schema, parts = TABLES[name]
        if name.startswith("raw_") and not partition_days(spark, path):
            continue
        qualified = f"{database}.{name}"
        create_table(spark, qualified, schema, parts, location=path)
        spark.catalog.refreshTable(qualified)
        if parts:
            spark.sql(f"ALTER TABLE {qualified} RECOVER PARTITIONS")
        names.append(qualified)
    return names
