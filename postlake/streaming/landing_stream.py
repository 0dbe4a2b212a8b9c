"""Incremental landing with Structured Streaming.

The batch pipeline lands one run date at a time; here new record files
(JSON lines or parquet, API-shaped) are picked up as they arrive and
landed into the raw tables under the id of their micro-batch: a batch that is
run again replaces its own folders, and a restarted query resumes from its
checkpoint. Submissions, comments and rejects come from one parse.

Downstream layers stay batch jobs: ``refresh_days`` re-runs the
chain for the days a landed micro-batch touched. That is idempotent (each
day is replaced whole from the raw table), so late records are absorbed by
re-running their day, as the daily jobs do.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postlake.plans.backfill import RunResult, run_days
from postlake.plans.landing import StoredRecords, write_rejects
from postlake.session import observed
from postlake.sinks.tables import STREAM_BATCH_COL, _clear_partitions, overwrite_partitions
from postlake.sources.landing import (SUBMISSION_RECORD, check_records, flatten_comments, land_comments, land_submissions,
                                      parse_submission_json, reject_bad_rows)


def submission_record_stream(spark: SparkSession, source_dir: str, fmt: str = "json",
                             max_files_per_trigger: int | None = None) -> DataFrame:
    """Parsed records of new files with ``_reject_reason`` and ``_raw``."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if fmt == "json":
        return parse_submission_json(reader.text(source_dir))
    return check_records(reader.schema(SUBMISSION_RECORD).format(fmt).load(source_dir))


def _land_batch(batch: DataFrame, batch_id: int, raw_path: str, comments_path: str | None, rejects_path: str | None,
                comment_limit: int | None) -> list[_dt.date]:
    """Land one micro-batch into folders keyed by its id, which a retry of the
    batch replaces whole; returns the days that got submissions."""
    records = StoredRecords(batch, f"batch-{batch_id}")
    try:
        good, _ = reject_bad_rows(records.rows)
        found = Observation(f"landed_days_{batch_id}_{id(records)}")
        tag = F.lit(batch_id).cast("bigint")
        by = (STREAM_BATCH_COL, "ds")

        def put(df: DataFrame, path: str) -> None:
            _clear_partitions(batch.sparkSession, path, [batch_id], STREAM_BATCH_COL)
            overwrite_partitions(df.withColumn(STREAM_BATCH_COL, tag), path, by)

        put(land_submissions(good).observe(found, F.collect_set("ds").alias("days")), raw_path)
        if comments_path:
            put(land_comments(flatten_comments(good, limit=comment_limit)), comments_path)
        if rejects_path:
            write_rejects(records.rows, rejects_path, f"batch-{batch_id}")
    finally:
        records.drop()
    return sorted((observed(found) or {}).get("days") or [])


def start_landing(spark: SparkSession, source_dir: str, raw_path: str, checkpoint_dir: str,
                  fmt: str = "json", available_now: bool = True, processing_time: str | None = None,
                  comments_path: str | None = None, rejects_path: str | None = None,
                  comment_limit: int | None = None, on_days=None) -> StreamingQuery:
    """Stream record files → raw submissions, raw comments and rejects.

    Every micro-batch is parsed once and written under its batch id, so a
    batch that is run again replaces itself (exactly once). ``on_days`` is
    called with the days of each batch. ``available_now`` processes what is
    there and stops (scheduled runs); otherwise the query keeps running with
    ``processing_time`` triggers.
    """
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        days = _land_batch(batch, batch_id, raw_path, comments_path, rejects_path, comment_limit)
        if days and on_days:
            on_days(days)

    writer = submission_record_stream(spark, source_dir, fmt).writeStream.foreachBatch(per_batch).option(
        "checkpointLocation", checkpoint_dir)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def refresh_days(spark: SparkSession, days: list[_dt.date], raw_path: str, out_root: str) -> RunResult:
    """Re-run bronze → gold for exactly the given days, so a single late record
    costs its own day."""
    return run_days(spark, raw_path, out_root, days)


def start_landing_with_refresh(spark: SparkSession, source_dir: str, raw_path: str, out_root: str,
                               checkpoint_dir: str, fmt: str = "json", rejects_path: str | None = None,
                               comments_path: str | None = None, days_per_run: int = 31) -> StreamingQuery:
    """:func:`start_landing`, and the refresh of every day a batch touched,
    ``days_per_run`` days at a time. A retry lands the same rows again in
    their place and repeats the refresh."""
    def refresh(days: list[_dt.date]) -> None:
        for i in range(0, len(days), days_per_run):
            refresh_days(spark, days[i:i + days_per_run], raw_path, out_root)

    return start_landing(spark, source_dir, raw_path, checkpoint_dir, fmt, comments_path=comments_path,
                         rejects_path=rejects_path, on_days=refresh)
