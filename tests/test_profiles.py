"""The merged state behind the author profiles."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from postlake.operators import gold as G
from postlake.plans import profiles as P
from postlake.schemas import SILVER_SUBMISSIONS
from postlake.sinks import tables as ST

DAYS = [dt.date(2025, 6, 29) + dt.timedelta(days=i) for i in range(4)]


def _silver(spark, posts):
    """``(author, day number, topic, score, second)`` as silver rows."""
    base = {f.name: None for f in SILVER_SUBMISSIONS.fields}
    data = [dict(base, content_id=f"s{i}", content_type="submission", author_name=a, ds=DAYS[d], game_topic=t, score=s,
                 num_comments=s, is_trending=None if s is None else s % 2 == 0, ai_sentiment="positive" if s and s > 2 else None,
                 created_at_timestamp=None if c is None else dt.datetime(2025, 6, 1) + dt.timedelta(seconds=c))
            for i, (a, d, t, s, c) in enumerate(posts)]
    loose = type(SILVER_SUBMISSIONS)([type(f)(f.name, f.dataType, True) for f in SILVER_SUBMISSIONS.fields])
    return spark.createDataFrame([tuple(r[f.name] for f in loose.fields) for r in data], loose)


class Lake:
    def __init__(self, spark, root):
        self.spark, self.partials, self.state, self.out = spark, *(str(root / n) for n in ("partials", "state", "out"))
        self.posts = {}

    def run(self, days, **posts):
        self.posts.update({int(k[1:]): v for k, v in posts.items()})
        silver = _silver(self.spark, [p for d in self.posts.values() for p in d])
        buckets = P.update(self.spark, lambda of: silver.where(F.col("ds").isin(*of)),
                           [DAYS[d] for d in self.posts], self.partials, self.state, [DAYS[d] for d in days])
        ST.full_overwrite(P.profiles(self.spark, self.state), self.out)
        return silver, buckets

    def check(self, silver):
        assert rows(self.spark.read.parquet(self.out)) == rows(G.gold_author_profiles(silver))


FIRST = [("a", 0, "Lore", 3, 10), ("a", 0, None, None, 5), ("b", 0, "Lore", 4, None), (None, 0, "Lore", 1, 1), ("c", 0, "Meta", 1, 7)]
SECOND = [("a", 1, "Lore", 8, 1), ("a", 1, "Bugs", 2, 99), ("d", 1, "Bugs", 0, 50)]


def test_add_replace_and_empty_a_day(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    lake.check(lake.run([0], d0=FIRST)[0])
    lake.check(lake.run([1], d1=SECOND)[0])
    lake.check(lake.run([1], d1=SECOND)[0])                                 # again: the same
    lake.check(lake.run([1], d1=[("a", 1, "Bugs", 2, 6)])[0])               # the first time of a moves back to day 0
    lake.check(lake.run([0], d0=[("b", 0, None, None, None)])[0])           # c goes, a loses topics
    lake.check(lake.run([0, 1], d0=FIRST, d1=SECOND)[0])
    lake.check(lake.run([1], d1=[])[0])
    lake.check(lake.run([0], d0=[])[0])
    assert spark.read.parquet(lake.out).count() == 0


def test_a_new_day_reads_no_partials_of_earlier_days_and_touched_buckets_only(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    lake.run([0], d0=[(f"author{i}", 0, "Lore", 1, i) for i in range(40)])
    for path in (tmp_path / "partials").glob("ds=*/*.parquet"):
        path.write_bytes(b"unreadable")
    kept = spark.createDataFrame([("new",)], "author_name string").select(P._bucket()).first()[0]
    for path in (tmp_path / "state").glob("bucket=*/*.parquet"):
        if path.parent.name != f"bucket={kept}":
            path.write_bytes(b"unreadable")
    lake.posts[1] = [("new", 1, "Lore", 5, 3)]
    silver = _silver(spark, lake.posts[1])
    assert P.update(spark, lambda of: silver, [DAYS[0], DAYS[1]], lake.partials, lake.state, [DAYS[1]]) == [kept]


def test_a_run_that_failed_is_made_good(spark, tmp_path, monkeypatch):
    lake = Lake(spark, tmp_path)
    lake.run([0], d0=FIRST)
    with monkeypatch.context() as m:
        m.setattr(P, "replace_values", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            lake.run([0, 1], d0=[("b", 0, "Lore", 1, 1)], d1=SECOND)
    lake.check(lake.run([2], d2=[("d", 2, "Bugs", 7, 2)])[0])


def test_partials_without_state_and_random_days(spark, tmp_path):
    lake, rng = Lake(spark, tmp_path), random.Random(5)
    silver, _ = lake.run([0], d0=FIRST)
    P.forget(spark, lake.state)                                              # an older table: partials only
    lake.check(lake.run([1], d1=SECOND)[0])
    ST.replace_partition(G.author_daily_partials(_silver(spark, [("z", 3, "Lore", 1, 1)])), lake.partials, DAYS[3])
    lake.posts[3] = [("z", 3, "Lore", 1, 1)]
    lake.check(lake.run([2], d2=[("z", 2, None, 4, 0)])[0])       # day 3 was written elsewhere
    for _ in range(3):
        d = rng.randrange(4)
        posts = [(rng.choice("abz"), d, rng.choice(["Lore", "Bugs", None]), rng.choice([None, 0, 1, 4]),
                  rng.choice([None, *range(9)])) for _ in range(6)]
        lake.check(lake.run([d], **{f"d{d}": posts})[0])
