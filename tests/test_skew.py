"""One station holding a third of all rows (derived from the sf0.1 events):
the share rule must detect it, split it, and give the plain result."""

import pytest
from pyspark.sql import functions as F

from dockcast.operators import sequence as sq
from dockcast.operators import windows

SF1 = "/root/testdata/sf0.1"
NEVER = sq.SkewConfig(hot_rows=10**15)          # plain windows only
# the default rule (share of an even partition) with a floor scaled down to
# the 100k-row fixture, and finer chunks
SCALED = sq.SkewConfig(hot_rows=1 << 14, chunk_rows=1024)


@pytest.fixture(scope="module")
def skewed(spark):
    e = spark.read.parquet(f"{SF1}/events.parquet")
    return e.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))


def _spec():
    return windows.FrameSpec().lag("lag3", "value", 3).rolling_mean("m12", "value", 12).lead("fwd3", "value", 3)


def test_share_rule_detects_the_hot_station(skewed):
    split = sq.split_hot_keys(skewed, ["user_id"], SCALED)
    assert split.hot is not None and split.hot_rows > skewed.count() // 3 - 10
    assert split.hot.select("user_id").distinct().collect()[0][0] == 0


def test_split_equals_plain_and_spreads_the_hot_key(skewed):
    a = _spec().apply(skewed, "user_id", ["ts", "event_id"], SCALED)
    b = _spec().apply(skewed, "user_id", ["ts", "event_id"], NEVER)
    cols = ["event_id", "lag3", "m12", "fwd3"]
    ra = a.select(*[F.round(c, 9).alias(c) if c != "event_id" else c for c in cols])
    rb = b.select(*[F.round(c, 9).alias(c) if c != "event_id" else c for c in cols])
    assert ra.count() == rb.count() == skewed.count()
    assert ra.exceptAll(rb).count() == 0 and rb.exceptAll(ra).count() == 0
    # rows of the hot station per window task: plain = all in one, split = spread
    def widest(df):
        per = df.filter(F.col("user_id") == 0).groupBy(F.spark_partition_id().alias("p")).count()
        return per.agg(F.max("count")).first()[0]
    hot_rows = skewed.filter(F.col("user_id") == 0).count()
    assert widest(b) == hot_rows
    assert widest(a) < hot_rows / 4
