"""Intermediate tables in the cluster's shared checkpoint folder.

An intermediate is written once as Parquet below ``spark.checkpoint.dir``
and read back, so a lost executor costs the tasks it was running and
nothing before them. ``clear()``, or the end of the Python driver, deletes
the folders of this process.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postlake import session


def new_path(spark: SparkSession, name: str) -> str:
    return session.scratch_path(spark, f"llm-{name}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new shared folder and read it back."""
    return session.stored(df, f"llm-{name}")


def clear() -> int:
    """Delete the intermediate tables of this process; returns how many."""
    return session.clear_scratch()
