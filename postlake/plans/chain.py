"""Layer composition: raw → bronze → silver → gold, as one lazy plan.

Each function is DataFrame → DataFrame; nothing here triggers an action.
The fixture variants read the supplied test tables (``sf_dir``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postlake.operators.bronze import bronze_submissions
from postlake.operators.silver import silver_submissions
from postlake.sources.fixtures import first_fetch, raw_submissions_fx

def silver_from_raw(raw: DataFrame, scope: str = "day") -> DataFrame:
    return silver_submissions(bronze_submissions(raw, scope))


def raw_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_submissions_fx(spark, sf_dir)


def bronze_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_submissions(raw_fx(spark, sf_dir))


def silver_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_submissions(bronze_fx(spark, sf_dir))


def silver_v1_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver as it was when only the first fetch had landed."""
    return silver_from_raw(first_fetch(raw_fx(spark, sf_dir)))


def bronze_dedup_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows after dedup, before QC (negative / NULL scores still present)."""
    from postlake.operators.bronze import bronze_project, dedup_latest
    return bronze_project(dedup_latest(raw_fx(spark, sf_dir)))


def enriched_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched bronze rows (all of them, before the candidate filter)."""
    from postlake.operators.silver import enrich
    return enrich(bronze_fx(spark, sf_dir))
