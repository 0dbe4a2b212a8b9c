import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.sinks import tables as ST
from postlake.sinks.changes import partition_changes
from tests.conftest import rows

D0, D1, D2 = (dt.date(2025, 6, 29) + dt.timedelta(days=i) for i in range(3))


def _df(spark, data):
    return spark.createDataFrame(data, "id string, v bigint, ds date")


def test_dynamic_overwrite_keeps_other_partitions_and_ignores_empty(spark, tmp_table):
    ST.overwrite_partitions(_df(spark, [("a", 1, D0), ("b", 2, D1)]), tmp_table)
    ST.overwrite_partitions(_df(spark, [("c", 3, D1)]), tmp_table)
    ST.overwrite_partitions(_df(spark, []), tmp_table)
    assert rows(ST.scan_full(spark, tmp_table)) == [("a", 1, D0), ("c", 3, D1)]


def test_replace_where_clears_empty_day_and_is_idempotent(spark, tmp_table):
    ST.replace_partitions(_df(spark, [("a", 1, D0), ("b", 2, D1), ("c", 3, D2)]), tmp_table, [D0, D1, D2])
    ST.replace_partition(_df(spark, []), tmp_table, D1)
    ST.replace_partition(_df(spark, [("z", 9, D2)]), tmp_table, D2)
    first = rows(ST.scan_full(spark, tmp_table))
    ST.replace_partition(_df(spark, [("z", 9, D2)]), tmp_table, D2)   # re-run: same table
    assert rows(ST.scan_full(spark, tmp_table)) == first == [("a", 1, D0), ("z", 9, D2)]


def test_replace_where_rejects_rows_outside_day(spark, tmp_table):
    ST.replace_partitions(_df(spark, [("a", 1, D0)]), tmp_table, [D0])
    with pytest.raises(Exception, match="outside replaced days"):
        ST.replace_partition(_df(spark, [("x", 1, D1)]), tmp_table, D0)
    assert rows(ST.scan_full(spark, tmp_table)) == [("a", 1, D0)]


def test_scan_partition_prunes(spark, tmp_table):
    ST.overwrite_partitions(_df(spark, [("a", 1, D0), ("b", 2, D1)]), tmp_table)
    df = ST.scan_partition(spark, tmp_table, D1)
    filters = df._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert "(ds#" in filters
    assert rows(df) == [("b", 2, D1)]


def test_publish_audited_blocks_bad_data(spark, tmp_table):
    ST.publish_audited(_df(spark, [("a", 1, D0)]), tmp_table, [D0], not_null=["id"], key=("ds", "id"))
    bad = _df(spark, [("a", 1, D0), ("a", 2, D0)])   # duplicate key
    with pytest.raises(ST.AuditError):
        ST.publish_audited(bad, tmp_table, [D0], not_null=["id"], key=("ds", "id"))
    with pytest.raises(ST.AuditError):
        ST.publish_audited(_df(spark, [(None, 1, D0)]), tmp_table, [D0], not_null=["id"])
    assert rows(ST.scan_full(spark, tmp_table)) == [("a", 1, D0)]


def test_partition_changes(spark):
    before = _df(spark, [("a", 1, D0), ("b", 2, D0), ("c", None, D0)])
    after = _df(spark, [("a", 1, D0), ("b", 5, D0), ("d", 4, D0), ("c", None, D0)])
    got = rows(partition_changes(before, after, ["ds", "id"]).select("_change_type", "id", "v"))
    assert got == sorted([("insert", "d", 4), ("update_preimage", "b", 2),
                          ("update_postimage", "b", 5)], key=repr)
    deleted = partition_changes(after, before, ["ds", "id"]).filter(F.col("_change_type") == "delete")
    assert [r.id for r in deleted.collect()] == ["d"]


def test_create_table_registers_path_table(spark, tmp_table):
    from postlake.schemas import GOLD_TOPIC_TRENDS
    ST.create_table(spark, "gold_topic_trends_t", GOLD_TOPIC_TRENDS, ("ds",), location=tmp_table,
                    comment="daily topic trends")
    ST.create_table(spark, "gold_topic_trends_t", GOLD_TOPIC_TRENDS, ("ds",), location=tmp_table)
    df = spark.createDataFrame([(D0, "Valorant", 3, 1.0, 2.0, 0.5)], GOLD_TOPIC_TRENDS)
    ST.replace_partitions(df, tmp_table, [D0])
    spark.sql("REFRESH TABLE gold_topic_trends_t")
    spark.sql("ALTER TABLE gold_topic_trends_t RECOVER PARTITIONS")
    assert spark.table("gold_topic_trends_t").count() == 1
    spark.sql("DROP TABLE gold_topic_trends_t")


def test_null_day_is_outside(spark, tmp_table):
    bad = _df(spark, [("a", 1, None)])
    with pytest.raises(Exception, match="ds=NULL"):
        ST.replace_partition(bad, tmp_table, D0)
    with pytest.raises(ST.AuditError):
        ST.publish_audited(bad, tmp_table, [D0])


def test_publish_leaves_no_staged_copy(spark, tmp_table):
    import os

    from postlake.session import checkpoint_root, drop_scratch
    root = checkpoint_root(spark).replace("file:", "")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    ST.publish_audited(_df(spark, [("a", 1, D0)]), tmp_table, [D0], key=("ds", "id"))
    with pytest.raises(ST.AuditError):
        ST.publish_audited(_df(spark, [(None, 1, D0)]), tmp_table, [D0], not_null=["id"])
    after = set(os.listdir(root))
    assert not [d for d in after - before if d.startswith("stage-")]
    with pytest.raises(ValueError):
        drop_scratch(spark, tmp_table)            # outside the scratch root: refused


def test_partitioned_write_makes_one_file_per_small_day(spark, tmp_table):
    from pyspark.sql import functions as F
    df = spark.range(0, 4000, 1, 32).select(
        F.col("id").cast("string").alias("id"), F.col("id").alias("v"),
        F.date_add(F.lit("2025-06-29").cast("date"), (F.col("id") % 5).cast("int")).alias("ds"))
    ST.overwrite_partitions(df, tmp_table)
    import glob
    assert len(glob.glob(tmp_table + "/ds=*/*.parquet")) == 5


def test_clearing_many_days_starts_no_jobs(spark, tmp_table):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(365)]
    ST.replace_partitions(_df(spark, [("a", 1, days[0]), ("b", 1, days[5])]), tmp_table, days)
    spark.sparkContext.setJobGroup("clear", "clear")
    try:
        cleared = ST.replace_partitions(_df(spark, [("c", 2, days[7])]), tmp_table, days)
        jobs = list(spark.sparkContext.statusTracker().getJobIdsForGroup("clear"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(cleared) == 364 and len(jobs) <= 4
    assert rows(ST.scan_full(spark, tmp_table)) == [("c", 2, days[7])]


def test_changes_with_null_and_repeated_keys(spark):
    before, after = _df(spark, [(None, 1, D0), ("a", 1, D0)]), _df(spark, [(None, 2, D0), ("a", 1, D0)])
    got = rows(partition_changes(before, after, ["ds", "id"]).select("_change_type", "id", "v"))
    assert got == sorted([("update_preimage", None, 1), ("update_postimage", None, 2)], key=repr)
    twice = _df(spark, [("a", 1, D0), ("a", 2, D0)])
    with pytest.raises(Exception, match="more than once"):
        partition_changes(twice, after, ["ds", "id"]).collect()


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    from postlake import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())


def test_scratch_copies_are_dropped(spark):
    import os

    from postlake import session
    df = session.stored(_df(spark, [("a", 1, D0)]), "drop-test")
    root = session.checkpoint_root(spark).replace("file:", "")
    assert df.count() == 1 and [d for d in os.listdir(root) if d.startswith("drop-test")]
    session.clear_scratch()
    assert not [d for d in os.listdir(root) if d.startswith("drop-test")]


def _published(spark, tmp_path, key=("ds", "id")):
    from postlake.sinks.publish import PublishedTable
    place = tmp_path / "catalog"
    database = f"pub_{tmp_path.name}".replace("-", "_")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{place}'")
    schema = T.StructType([T.StructField("id", T.StringType(), False), T.StructField("v", T.LongType()),
                           T.StructField("ds", T.DateType())])
    return PublishedTable(spark, f"{database}.t", str(tmp_path / "t"), schema, key=key).create()


def test_publish_by_location_replaces_empties_and_keeps_readers(spark, tmp_path):
    table = _published(spark, tmp_path)
    table.publish(_df(spark, [("a", 1, D0), ("b", 2, D0), ("c", 3, D1)]), [D0, D1])
    reader = spark.table(table.name).where(F.col("ds") == F.lit(D0))
    files = reader.inputFiles()
    table.publish(_df(spark, [("a", 9, D0)]), [D0])
    assert rows(spark.table(table.name).select("id", "v")) == [("a", 9), ("c", 3)]
    assert sorted(r.id for r in spark.read.parquet(*files).collect()) == ["a", "b"]     # the old version is whole
    assert table.drop_old_versions() == 0                                               # day 2 is in the first version
    table.publish(_df(spark, []), [D1])
    assert table.days() == [D0] and table.drop_old_versions() >= 1
    assert rows(table.read().select("id", "v")) == [("a", 9)]
    assert len(list((tmp_path / "t" / "_versions").iterdir())) == 1                     # written once, no staged copy


def test_publish_by_location_audits_before_it_points(spark, tmp_path):
    from postlake.sinks.publish import PublishedTable
    table = _published(spark, tmp_path)
    table.publish(_df(spark, [("a", 1, D0)]), [D0])
    for bad, kind in (([("a", 1, D0), ("a", 2, D0)], ST.AuditError), ([(None, 1, D0)], ST.AuditError),
                      ([("a", 1, D1)], Exception)):
        with pytest.raises(kind):
            table.publish(_df(spark, bad), [D0])
    with pytest.raises(ST.AuditError):
        table.publish(_df(spark, []), [D0], min_rows=1)
    assert rows(table.read().select("id", "v")) == [("a", 1)]
    whole = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])
    flat = PublishedTable(spark, table.name.replace(".t", ".flat"), str(tmp_path / "flat"), whole, False, ("k",)).create()
    for v in (1, 2):                                                                    # a NULL key is a key
        flat.publish(spark.createDataFrame([(None, v), ("x", v)], "k string, v bigint"))
        assert rows(flat.read()) == [("x", v), (None, v)] or rows(flat.read()) == [(None, v), ("x", v)]
    with pytest.raises(ST.AuditError):
        flat.publish(spark.createDataFrame([(None, 1), (None, 1)], "k string, v bigint"))
    assert flat.drop_old_versions() == 1


def test_versions_read_unequal_buckets_only(spark, tmp_path):
    from postlake.sinks import changes as C
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.LongType()), T.StructField("ds", T.DateType())])
    data = [(f"k{i}", i, D0) for i in range(60)] + [(None, 1, D0)]
    after = [r for r in data if r[0] != "k7"] + [("new", None, D1)]
    after[3] = ("k3", 99, D0)
    for r, path in ((data, old), (after, new)):
        C.write_version(spark.createDataFrame(r, schema), path, ["id"])
    changed = C.changed_buckets(spark, old, new)
    assert 1 <= len(changed) <= 3
    for path in tmp_path.glob("*/rows/_bucket=*/*.parquet"):
        if path.parent.name not in {f"_bucket={b}" for b in changed}:
            path.write_bytes(b"unreadable")
    got = rows(C.version_changes(spark, old, new, ["id"], schema).select("_change_type", "id", "v"))
    assert got == sorted([("update_preimage", "k3", 3), ("update_postimage", "k3", 99), ("delete", "k7", 7),
                          ("insert", "new", None)], key=repr)


def test_versions_empty_equal_and_of_other_bucket_numbers(spark, tmp_path):
    from postlake.sinks import changes as C
    a, b, none = (str(tmp_path / n) for n in ("a", "b", "none"))
    df = spark.createDataFrame([("x", 1), ("y", None)], "id string, v bigint")
    C.write_version(df, a, ["id"])
    C.write_version(df, b, ["id"], buckets=3)
    C.write_version(df.limit(0), none, ["id"])
    assert C.changed_buckets(spark, a, b) is None and C.version_changes(spark, a, b, ["id"], df.schema).count() == 0
    assert C.changed_buckets(spark, a, a) == [] and C.version_changes(spark, a, a, ["id"], df.schema).count() == 0
    assert rows(C.version_changes(spark, none, a, ["id"], df.schema)) == [("insert", "x", 1), ("insert", "y", None)]
    assert C.version_changes(spark, a, none, ["id"], df.schema).count() == 2


def test_few_days_are_written_without_a_shuffle(spark, tmp_path, monkeypatch):
    import datetime
    from postlake.sinks import tables as ST
    gathered = []
    plain = ST.clustered
    monkeypatch.setattr(ST, "clustered", lambda df, cols=("ds",): gathered.append(cols) or plain(df, cols))
    days = [datetime.date(2025, 6, 1) + datetime.timedelta(days=i) for i in range(ST.FEW_DAYS + 1)]
    df = spark.createDataFrame([(i, d) for d in days for i in range(3)], "k int, ds date")
    path = str(tmp_path / "t")
    ST.replace_partitions(df, path, days)
    assert len(gathered) == 1
    ST.replace_partitions(df.where(f"ds < '{days[-1]}' AND k > 0"), path, days[:-1])
    assert len(gathered) == 1
    got = sorted((r.k, r.ds) for r in spark.read.schema(df.schema).parquet(path).collect())
    assert got == sorted([(k, d) for d in days[:-1] for k in (1, 2)] + [(k, days[-1]) for k in range(3)])
