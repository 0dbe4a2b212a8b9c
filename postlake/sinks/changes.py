"""Change rows between two versions of a table (a change feed on demand).

Open replacement for a table format's change-data feed: given the rows of
a table (or some of its partitions) before and after a write, emit
``insert`` / ``delete`` / ``update_preimage`` / ``update_postimage`` rows.
Unchanged rows are dropped. Both versions first meet as key and 128-bit row
digest only; whole rows are read again for the keys that changed.

A stored version (:func:`write_version`) keeps its rows by hash bucket of the
key with a digest a bucket; :func:`version_changes` compares the digests and
reads only the buckets that differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.sinks.tables import overwrite_partitions

CHANGE_COL = "_change_type"


def _digests(df: DataFrame, keys: list[str], values: list[str], prefix: str) -> DataFrame:
    """Key, row digest (two 64-bit hashes and which values are NULL), and
    whether the key is unique in its version."""
    nulls = F.concat(*[F.when(F.col(v).isNull(), "1").otherwise("0") for v in values]) if values else F.lit("")
    digest = F.struct(F.xxhash64(F.lit(0), *values), F.xxhash64(F.lit(1), *values), nulls)
    return df.groupBy(*keys).agg(F.min(digest).alias(f"_{prefix}"), F.count(F.lit(1)).alias(f"_{prefix}_n"))


def partition_changes(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Change rows by ``keys``, which may be NULL (a NULL key equals itself).

    A key that a version holds more than once fails the job. Rows are equal if
    their values are (NULL equal to NULL); the digests only choose which rows
    to compare, so a change is missed with probability 2^-128.
    """
    values = [c for c in after.columns if c not in keys]
    if sorted(values) != sorted(c for c in before.columns if c not in keys):
        raise ValueError("versions differ in columns")

    def renamed(df: DataFrame, prefix: str) -> DataFrame:
        return df.withColumnsRenamed({k: f"_{prefix}_{k}" for k in keys})

    def joined(left: DataFrame, lp: str, right: DataFrame, rp: str, how: str) -> DataFrame:
        on = F.lit(True)
        for k in keys:
            on = on & F.col(f"_{lp}_{k}").eqNullSafe(F.col(f"_{rp}_{k}"))
        return renamed(left, lp).join(renamed(right, rp), on, how)

    def either(lp: str, rp: str, missing: str) -> list:
        """The keys of a full join: the side that has a row."""
        return [F.when(F.col(missing).isNull(), F.col(f"_{rp}_{k}")).otherwise(F.col(f"_{lp}_{k}")).alias(k) for k in keys]

    b, a = _digests(before, keys, values, "b"), _digests(after, keys, values, "a")
    unique = F.when(F.greatest(F.coalesce("_b_n", F.lit(0)), F.coalesce("_a_n", F.lit(0))) > 1,
                    F.raise_error(F.lit("a version holds a key more than once")).cast("boolean")).otherwise(F.lit(True))
    changed = joined(b, "p", a, "q", "full_outer").where(
        unique & ~F.col("_b").eqNullSafe(F.col("_a"))).select(*either("p", "q", "_b"))
    whole = [joined(df.select(*keys, F.struct(*values).alias(name)), "p", changed, "q", "left_semi")
             .withColumnsRenamed({f"_p_{k}": k for k in keys}) for df, name in ((before, "_b"), (after, "_a"))]
    j = joined(whole[0], "p", whole[1], "q", "full_outer").filter(~F.col("_b").eqNullSafe(F.col("_a"))).select(
        *either("p", "q", "_b"), "_b", "_a")

    def tagged(kind: str, row: str):
        return F.struct(F.lit(kind).alias("kind"), F.col(row).alias("row"))

    changes = (F.when(F.col("_b").isNull(), F.array(tagged("insert", "_a")))
               .when(F.col("_a").isNull(), F.array(tagged("delete", "_b")))
               .otherwise(F.array(tagged("update_preimage", "_b"), tagged("update_postimage", "_a"))))
    out = j.select(*keys, F.explode(changes).alias("_c"))
    return out.select(F.col("_c.kind").alias(CHANGE_COL), *keys,
                      *[F.col(f"_c.row.{v}").alias(v) for v in values])


# ---------------------------------------------------------------------------
# Stored versions with a digest per bucket.

BUCKET_COL = "_bucket"
#: Buckets of a stored version, unless the caller says how many.
BUCKETS = 64


def _row_digest(names: list[str]) -> list:
    """Sums over rows of two 64-bit hashes: equal sets of rows give equal sums
    in any order, and a row more or less changes them."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in names])
    return [F.sum(F.xxhash64(F.lit(seed), *names, nulls).cast("decimal(20,0)")).alias(f"digest_{seed}") for seed in (0, 1)]


def write_version(df: DataFrame, path: str, keys: list[str], buckets: int = BUCKETS) -> None:
    """Write ``df`` as a version: rows by bucket of ``keys`` below ``path/rows``,
    ``(bucket, buckets, rows, digest_0, digest_1)`` below ``path/digests``. The
    digests are of the rows as stored."""
    spark, names = df.sparkSession, sorted(df.columns)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    overwrite_partitions(df.withColumn(BUCKET_COL, bucket), f"{path}/rows", (BUCKET_COL,))
    kept = _version_rows(spark, path, df.schema)
    (kept.groupBy(BUCKET_COL).agg(F.lit(buckets).alias("buckets"), F.count(F.lit(1)).alias("rows"), *_row_digest(names))
     .coalesce(1).write.mode("overwrite").parquet(f"{path}/digests"))


def _version_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(BUCKET_COL, T.IntegerType())])).parquet(f"{path}/rows")


_DIGESTS = f"{BUCKET_COL} int, buckets int, rows bigint, digest_0 decimal(30,0), digest_1 decimal(30,0)"


def changed_buckets(spark: SparkSession, before: str, after: str) -> list[int] | None:
    """The buckets whose digests differ (a row a bucket comes to the driver);
    None if the versions have unequal bucket numbers."""
    old, new = ({r[0]: tuple(r[1:]) for r in spark.read.schema(_DIGESTS).parquet(f"{p}/digests").collect()}
                for p in (before, after))
    counts = {r[0] for d in (old, new) for r in d.values()}
    if len(counts) > 1:
        return None
    return sorted(b for b in {*old, *new} if old.get(b) != new.get(b))


def version_changes(spark: SparkSession, before: str, after: str, keys: list[str], schema: T.StructType) -> DataFrame:
    """:func:`partition_changes` of two stored versions with the columns of
    ``schema``, reading the buckets that differ only (a PartitionFilter). Versions
    of unequal bucket numbers are compared whole."""
    buckets = changed_buckets(spark, before, after)
    sides = [_version_rows(spark, p, schema) for p in (before, after)]
    if buckets is not None:
        sides = [s.where(F.col(BUCKET_COL).isin(*buckets)) for s in sides]
    return partition_changes(*[s.drop(BUCKET_COL) for s in sides], keys)
