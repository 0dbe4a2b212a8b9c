"""Session helpers: pinned time zone, AQE, and a shared scratch root.

Nothing here builds a cluster; on a cluster the session comes from the
launcher and we only *read* its settings. ``scratch_path`` uses the shared
folder named in ``spark.checkpoint.dir``; only a local session may go without.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

SESSION_TIME_ZONE = "UTC"

# Settings of the sessions that this library itself creates (tests, bench,
# command line without a session). A session that someone else built keeps
# its own settings: no operator or query changes them.
LOCAL_CONF = {
    "spark.sql.session.timeZone": SESSION_TIME_ZONE,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Coalesce shuffle partitions to the advisory size instead of keeping
    # them small for parallelism: right-sized tasks and output files.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "postlake", warehouse_dir: str | None = None) -> SparkSession:
    """Session for tests and the local bench (UI off, UTC, AQE on)."""
    builder = SparkSession.builder
    if warehouse_dir:
        builder = builder.config("spark.sql.warehouse.dir", warehouse_dir)
    spark = (
        builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("POSTLAKE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for key, value in LOCAL_CONF.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Reads the directory the SparkContext already uses, or the
    ``spark.checkpoint.dir`` setting. Only a local session (one machine) may
    go without: it gets a temporary folder. On a cluster a missing folder is
    an error, since executors could not see each other's files.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="postlake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_SCRATCH: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared checkpoint root; deleted by
    :func:`drop_scratch`, :func:`clear_scratch` or when the driver ends."""
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append((spark, path))
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to a new shared folder and read it back: lineage is
    cut, and a lost executor cannot change or lose the rows. This is an
    action; operators that need one take their stored input from the caller.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def local_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table of values the driver holds. Spark knows its size, so that a
    join with it is planned as a broadcast, and no Python worker makes its rows."""
    fields = to_arrow_schema(StructType.fromDDL(schema))
    columns = list(zip(*rows)) or [()] * len(fields)
    return spark.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip(columns, fields)], schema=fields))


def observed(seen) -> dict | None:
    """The metrics of a finished write; None if adaptive execution found the
    written plan empty and dropped the observing node with it."""
    from py4j.protocol import Py4JJavaError

    try:
        return seen.get or None
    except Py4JJavaError:
        return None


def drop_scratch(spark: SparkSession, path: str) -> bool:
    """Delete a folder this library created under the checkpoint root.

    Refuses any path outside that root. Uses Hadoop's FileSystem API (the
    same storage layer Spark writes through), so it works on any shared
    file system the cluster uses.
    """
    root = checkpoint_root(spark).rstrip("/")
    if not path.startswith(root + "/") or path.rstrip("/") == root:
        raise ValueError(f"not a scratch folder of this session: {path}")
    _SCRATCH[:] = [(s, p) for s, p in _SCRATCH if p != path]
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - Hadoop FileSystem access from PySpark
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    return bool(fs.delete(hpath, True))


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of ended jobs now. Its cleaner does so
    once the driver has collected the plans that name them, which an idle
    driver's heap puts off (by default for up to half an hour)."""
    spark.sparkContext._jvm.System.gc()  # noqa: SLF001 - the cleaner has no other trigger


def clear_scratch() -> int:
    """Delete the scratch folders of this process that are still there (once
    their results are read); returns how many were deleted."""
    dropped = 0
    while _SCRATCH:
        spark, path = _SCRATCH.pop()
        try:
            dropped += drop_scratch(spark, path)
        except Exception:  # noqa: BLE001 - the session of that folder has ended
            continue
    return dropped


atexit.register(clear_scratch)
