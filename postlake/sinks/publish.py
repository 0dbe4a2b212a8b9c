"""Publishing by location: rows are written once, audited, then pointed at.

A published table is a table of the session catalog whose partitions (or, if
it has none, whose location) name folders below ``<path>/_versions``. A run
writes its days to a new version folder, audits what was written there, and
only then points the partitions at it, one catalog call a day. A reader plans
with the old or the new folder of a day, never with half of one, and a failed
write or audit changes nothing. Days without rows lose their partition.

Folders that no partition names any more stay for queries that still read them
until :func:`drop_old_versions`.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.functions.timefmt import parse_ds
from postlake.schemas import TABLES
from postlake.sinks.tables import (COMPRESSION, FEW_DAYS, PARTITION_COL, AuditError, AuditResult, audit, create_table,
                                   guard_days, not_null_columns, overwrite_partitions, partition_days)

VERSIONS = "_versions"
#: What identifies a row of each table (checked before it is published).
KEYS: dict[str, tuple[str, ...]] = {
    "bronze_submissions": ("ds", "submission_id"),
    "silver_submissions": ("ds", "content_id"),
    "gold_sentiment_topic": ("ds", "text_category", "ai_sentiment"),
    "gold_topic_trends": ("ds", "game_topic"),
    "gold_topic_time_series": ("ds", "game_topic", "upvote_ratio_bin"),
    "gold_top_daily": ("ds", "content_id"),
    "gold_author_profiles": ("author_name",),
}


@dataclass
class PublishedTable:
    """A table ``name`` (``database.table``) with its files below ``path``."""

    spark: SparkSession
    name: str
    path: str
    schema: T.StructType
    partitioned: bool = True
    key: tuple[str, ...] | None = None

    @classmethod
    def of(cls, spark: SparkSession, database: str, table: str, path: str) -> PublishedTable:
        schema, parts = TABLES[table]
        return cls(spark, f"{database}.{table}", path.rstrip("/"), schema, bool(parts), KEYS.get(table)).create()

    def create(self) -> PublishedTable:
        create_table(self.spark, self.name, self.schema, (PARTITION_COL,) if self.partitioned else (), self.path)
        return self

    def locations(self) -> dict[_dt.date | None, str]:
        """The folder of each published day (of the table: under None)."""
        if not self.partitioned:
            return {None: _location(self.spark, f"DESCRIBE FORMATTED {self.name}")}
        days = self.days()
        return {d: _location(self.spark, f"DESCRIBE FORMATTED {self.name} PARTITION ({PARTITION_COL}='{d}')") for d in days}

    def days(self) -> list[_dt.date]:
        shown = self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()          # a row per day
        return sorted(parse_ds(r[0].split("=", 1)[1]) for r in shown)

    def read(self, days: Iterable[_dt.date] | None = None) -> DataFrame:
        df = self.spark.table(self.name).select(*self.schema.names)
        return df if days is None else df.where(F.col(PARTITION_COL).isin(*[F.lit(d) for d in days]))

    def publish(self, df: DataFrame, days: Iterable[str | _dt.date] = (), min_rows: int = 0,
                gather: bool = True) -> AuditResult:
        """Replace ``days`` (or the whole unpartitioned table) by the rows of
        ``df``, which must be of those days. ``AuditError`` if a NOT NULL column
        holds NULL, the key repeats or there are fewer than ``min_rows`` rows."""
        wanted = sorted({parse_ds(d) for d in days})
        if self.partitioned and not wanted:
            raise ValueError("no days to publish")
        version = f"{self.path}/{VERSIONS}/{uuid.uuid4().hex}"
        if self.partitioned:
            overwrite_partitions(guard_days(df, wanted), version, gather=gather and len(wanted) > FEW_DAYS)
        else:
            df.write.parquet(version, compression=COMPRESSION)
        staged = self.spark.read.schema(self.schema).parquet(version)
        result = audit(staged, wanted if self.partitioned else None, not_null_columns(self.schema), self.key)
        if not result.ok or result.rows < min_rows:
            _delete(self.spark, version)
            raise AuditError(f"audit failed for {self.name}: {result}")
        if not self.partitioned:
            self.spark.sql(f"ALTER TABLE {self.name} SET LOCATION '{version}'")
        else:
            written = set(partition_days(self.spark, version))
            had = set(self.days())
            for d in wanted:
                spec = f"PARTITION ({PARTITION_COL}='{d}')"
                place = f"LOCATION '{version}/{PARTITION_COL}={d}'"
                if d not in written:
                    self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS {spec}")
                elif d in had:
                    self.spark.sql(f"ALTER TABLE {self.name} {spec} SET {place}")
                else:
                    self.spark.sql(f"ALTER TABLE {self.name} ADD {spec} {place}")
        self.spark.catalog.refreshTable(self.name)
        return result

    def drop_old_versions(self) -> int:
        """Delete the version folders that nothing points at; how many."""
        used = {part for place in self.locations().values() for part in place.split("/")}
        old = [v for v in _children(self.spark, f"{self.path}/{VERSIONS}") if v not in used]
        for v in old:
            _delete(self.spark, f"{self.path}/{VERSIONS}/{v}")
        return len(old)


def _location(spark: SparkSession, describe: str) -> str:
    return next(r.data_type for r in spark.sql(describe).collect() if r.col_name == "Location")


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - Hadoop FileSystem access from PySpark
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001


def _children(spark: SparkSession, path: str) -> list[str]:
    folder, fs = _folder(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []


def _delete(spark: SparkSession, path: str) -> None:
    folder, fs = _folder(spark, path)
    fs.delete(folder, True)
