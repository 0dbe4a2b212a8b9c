"""Parquet table sinks and scans (path tables on shared storage).

* ``overwrite_partitions`` — dynamic partition overwrite: replaces only the
  partitions present in the data; empty input changes nothing.
* ``replace_partitions`` — replace-where over a set of days: every listed
  day is replaced, days without rows are cleared, and a row outside the
  listed days fails the write (checked inside the write job, no extra scan).
* ``full_overwrite`` — whole-table overwrite (unpartitioned tables).
* ``publish_audited`` — write to staging, audit the staged rows with one
  aggregate, publish only when the audit passes.

Writes go through Spark's file committer, so a lost executor only re-runs
its tasks. Overwrites are as atomic as that committer (not transactional);
``publish_audited`` narrows the window by auditing before touching the
published table.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.functions.timefmt import parse_ds
from postlake.schemas import check_schema
from postlake.session import drop_scratch, observed, scratch_path

PARTITION_COL = "ds"
#: Codec of written tables: texts take about half the space of Spark's default.
COMPRESSION = "zstd"
#: Rows of up to so many days are not shuffled by day before they are written.
FEW_DAYS = 3


def _dates(days: Iterable[str | _dt.date]) -> list[_dt.date]:
    return sorted({parse_ds(d) for d in days})


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a path table; with ``schema`` exactly the declared columns (not the
    batch ids that streaming adds), and the partition column keeps its declared
    type instead of an inferred one."""
    if schema is None:
        return spark.read.parquet(path)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def scan_partition(spark: SparkSession, path: str, ds: str | _dt.date,
                   schema: T.StructType | None = None) -> DataFrame:
    """One day of a ``ds``-partitioned table (a PartitionFilter: only that
    day's files are listed and read)."""
    return read_table(spark, path, schema).filter(F.col(PARTITION_COL) == F.lit(parse_ds(ds)))


def scan_range(spark: SparkSession, path: str, ds_from: str | _dt.date, ds_to: str | _dt.date,
               schema: T.StructType | None = None) -> DataFrame:
    return read_table(spark, path, schema).filter(
        F.col(PARTITION_COL).between(F.lit(parse_ds(ds_from)), F.lit(parse_ds(ds_to))))


def scan_days(spark: SparkSession, path: str, days: Iterable[str | _dt.date],
              schema: T.StructType | None = None) -> DataFrame:
    return read_table(spark, path, schema).filter(F.col(PARTITION_COL).isin(*[F.lit(d) for d in _dates(days)]))


def partition_days(spark: SparkSession, path: str) -> list[_dt.date]:
    """Days that have a partition folder (a file listing, no job)."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - Hadoop FileSystem access from PySpark
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    if not fs.exists(root):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(root)]
    prefix = PARTITION_COL + "="
    return sorted(parse_ds(n.removeprefix(prefix)) for n in names
                  if n.startswith(prefix) and n.removeprefix(prefix)[:1].isdigit())


#: Partition column that streaming adds to the raw table.
STREAM_BATCH_COL = "batch_id"


def check_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Fail if the stored columns of a table are not the declared ones."""
    got = {f.name: f.dataType.simpleString() for f in spark.read.parquet(path).schema.fields
           if f.name != STREAM_BATCH_COL}
    want = {f.name: f.dataType.simpleString() for f in schema.fields}
    if got != want:
        raise ValueError(f"schema drift in {path}: got {sorted(set(got.items()) - set(want.items()))}, "
                         f"want {sorted(set(want.items()) - set(got.items()))}")


def scan_full(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return read_table(spark, path, schema)


def clustered(df: DataFrame, cols: tuple[str, ...] = (PARTITION_COL,)) -> DataFrame:
    """Rows gathered by partition value before a partitioned write: a task
    holds one day (or a part of a large one, which adaptive execution
    splits), so it writes one file, not one per day it happens to hold."""
    return df.hint("rebalance", *cols)


def codec(level: int | None = None) -> dict[str, str]:
    """Options of a Parquet write: the codec, at a level of its own."""
    return {"compression": COMPRESSION} | ({"parquet.compression.codec.zstd.level": str(level)} if level else {})


def overwrite_partitions(df: DataFrame, path: str, partition_cols: tuple[str, ...] = (PARTITION_COL,),
                         gather: bool = True, level: int | None = None) -> None:
    """Replace the partitions present in ``df``. Without ``gather`` rows are
    written where they are: right for rows that were just read from files of
    one partition each, which shuffling would move for nothing."""
    ((clustered(df, partition_cols) if gather else df).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").options(**codec(level))
       .partitionBy(*partition_cols)
       .parquet(path))


def full_overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path, compression=COMPRESSION)


def guard_days(df: DataFrame, days: list[_dt.date]) -> DataFrame:
    """Fail the write job on a row whose ``ds`` is not one of ``days``."""
    ok = F.coalesce(F.col(PARTITION_COL).isin(*[F.lit(d) for d in days]), F.lit(False))
    msg = F.concat(F.lit("row outside replaced days: ds="),
                   F.coalesce(F.col(PARTITION_COL).cast("string"), F.lit("NULL")))
    return df.withColumn(PARTITION_COL, F.when(ok, F.col(PARTITION_COL)).otherwise(
        F.raise_error(msg).cast("date")))


def _clear_partitions(spark: SparkSession, path: str, values: Iterable[str], col: str = PARTITION_COL) -> None:
    """Remove the folders of the given partition values (file system calls, no jobs)."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - Hadoop FileSystem access from PySpark
    conf = spark.sparkContext._jsc.hadoopConfiguration()  # noqa: SLF001
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    for value in values:
        fs.delete(jvm.org.apache.hadoop.fs.Path(root, f"{col}={value}"), True)


def clear_days(spark: SparkSession, path: str, days: Iterable[_dt.date]) -> None:
    """Empty the given days of a ``ds``-partitioned table."""
    _clear_partitions(spark, path, [d.isoformat() for d in days])


def replace_values(df: DataFrame, path: str, col: str, values: Iterable, gather: bool = True) -> None:
    """Replace exactly the given values of a table partitioned by ``col``
    (values without special characters); rows must have one of them, and a
    value that received no rows is cleared. Without ``gather`` rows are
    written where they are (right for one value)."""
    wanted = sorted(set(values))
    seen = Observation("replaced_values")
    ok = F.coalesce(F.col(col).isin(*wanted), F.lit(False))
    msg = F.concat(F.lit(f"row outside replaced values of {col}: "), F.coalesce(F.col(col).cast("string"), F.lit("NULL")))
    guarded = df.withColumn(col, F.when(ok, F.col(col)).otherwise(F.raise_error(msg).cast(df.schema[col].dataType)))
    overwrite_partitions(guarded.observe(seen, F.collect_set(col).alias("values")), path, (col,), gather)
    present = set((observed(seen) or {}).get("values") or [])
    _clear_partitions(df.sparkSession, path, [v for v in wanted if v not in present], col)


def replace_partitions(df: DataFrame, path: str, days: Iterable[str | _dt.date],
                       gather: bool = True) -> list[_dt.date]:
    """Replace exactly the given days of a ``ds``-partitioned table.

    One write job: rows are checked against ``days`` in the job itself and
    the days that received rows are observed (a set bounded by ``days``).
    Listed days that received no rows are then cleared, so an empty day
    really becomes empty (a plain dynamic overwrite would keep it).
    Returns the cleared days. Up to ``FEW_DAYS`` days are written where the
    rows are, as a task cannot spread them over more folders than that.
    """
    wanted = _dates(days)
    if not wanted:
        raise ValueError("no days to replace")
    gather = gather and len(wanted) > FEW_DAYS
    spark = df.sparkSession
    seen = Observation("replaced_days")
    guarded = guard_days(df, wanted).observe(seen, F.collect_set(PARTITION_COL).alias("days"))
    overwrite_partitions(guarded, path, gather=gather)
    present = set((observed(seen) or {}).get("days") or [])
    cleared = [d for d in wanted if d not in present]
    _clear_partitions(spark, path, [d.isoformat() for d in cleared])
    return cleared


def guard_not_null(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns, and a NULL in a NOT NULL column fails the
    job that writes them, before anything is replaced."""
    check_schema(df, schema)
    out = df
    for name in not_null_columns(schema):
        kind = schema[name].dataType
        fail = F.raise_error(F.lit(f"NULL in NOT NULL column {name}")).cast(kind)
        out = out.withColumn(name, F.when(F.col(name).isNull(), fail).otherwise(F.col(name)))
    return out


def replace_partition(df: DataFrame, path: str, ds: str | _dt.date) -> list[_dt.date]:
    """Replace-where ``ds = d`` (idempotent re-run of one day)."""
    return replace_partitions(df, path, [ds])


# ---------------------------------------------------------------------------
# Write-audit-publish.

class AuditError(RuntimeError):
    pass


@dataclass
class AuditResult:
    rows: int
    null_counts: dict[str, int]
    outside_days: int
    duplicate_keys: int

    @property
    def ok(self) -> bool:
        return not any(self.null_counts.values()) and self.outside_days == 0 and self.duplicate_keys == 0


def audit(staged: DataFrame, days: list[_dt.date] | None, not_null: Iterable[str],
          key: tuple[str, ...] | None) -> AuditResult:
    """All checks in one aggregate job (plus one distinct count for keys, in
    which NULL equals NULL); ``days=None``: a table without days."""
    not_null = list(not_null)
    outside = F.lit(False) if days is None else ~F.coalesce(F.col(PARTITION_COL).isin(*[F.lit(d) for d in days]), F.lit(False))
    aggs = [F.count(F.lit(1)).alias("_rows"), F.count_if(outside).alias("_outside")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(not_null)]
    if key:
        aggs.append(F.count_distinct(F.struct(*key)).alias("_keys"))
    r = staged.agg(*aggs).first()
    dup = (r["_rows"] - r["_keys"]) if key else 0
    return AuditResult(rows=r["_rows"], outside_days=r["_outside"], duplicate_keys=dup,
                       null_counts={c: r[f"_null_{i}"] for i, c in enumerate(not_null)})


def publish_audited(df: DataFrame, path: str, days: Iterable[str | _dt.date],
                    not_null: Iterable[str] = (), key: tuple[str, ...] | None = None,
                    min_rows: int = 0) -> AuditResult:
    """Write → audit → publish.

    The rows are staged once under the shared checkpoint folder (this also
    cuts the lineage), audited there, and only then copied over the listed
    days of the published table. A failed audit raises ``AuditError`` and
    leaves the published table untouched.
    """
    wanted = _dates(days)
    spark = df.sparkSession
    stage = scratch_path(spark, "stage")
    df.write.mode("overwrite").parquet(stage)
    try:
        staged = spark.read.schema(df.schema).parquet(stage)
        result = audit(staged, wanted, not_null, key)
        if not result.ok or result.rows < min_rows:
            raise AuditError(f"audit failed for {path}: {result}")
        replace_partitions(staged, path, wanted)
    finally:
        drop_scratch(spark, stage)   # the staged copy is not kept
    return result


def not_null_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]


# ---------------------------------------------------------------------------
# Catalog registration.

def table_ddl(name: str, schema: T.StructType, partition_cols: tuple[str, ...] = (),
              location: str | None = None, comment: str | None = None,
              properties: dict[str, str] | None = None) -> str:
    """``CREATE TABLE IF NOT EXISTS`` text for a declared schema (parquet)."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}"
                     + ("" if f.nullable else " NOT NULL") for f in schema.fields)
    ddl = f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet"
    if partition_cols:
        ddl += f" PARTITIONED BY ({', '.join(partition_cols)})"
    if location:
        ddl += f" LOCATION '{location}'"
    if comment:
        ddl += " COMMENT '" + comment.replace("'", "\\'") + "'"
    if properties:
        ddl += " TBLPROPERTIES (" + ", ".join(f"'{k}' = '{v}'" for k, v in properties.items()) + ")"
    return ddl


def create_table(spark: SparkSession, name: str, schema: T.StructType,
                 partition_cols: tuple[str, ...] = (), location: str | None = None,
                 comment: str | None = None, properties: dict[str, str] | None = None) -> None:
    """Register a table if it is missing (a no-op when it exists)."""
    spark.sql(table_ddl(name, schema, partition_cols, location, comment, properties))


def register_views(spark: SparkSession, paths: dict[str, str],
                   schemas: dict[str, T.StructType] | None = None) -> list[str]:
    """Expose written tables to SQL as temporary views (``name`` → path)."""
    names = []
    for name, path in paths.items():
        read_table(spark, path, (schemas or {}).get(name)).createOrReplaceTempView(name)
        names.append(name)
    return names
