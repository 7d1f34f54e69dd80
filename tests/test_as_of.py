"""As-of lag and lead against a plain search, on the plain and the split path."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from dockcast.operators import windows
from dockcast.operators.sequence import SkewConfig, cached_scope, skew_config
from dockcast.plans import features

T0 = datetime(2024, 4, 17, 3)
SPLIT = SkewConfig(hot_rows=4, hot_share=0.0, chunk_rows=8)


def search(rows, i, seconds, ahead, max_age):
    """The row found for row i; rows are (key, time, tie, value)."""
    k, t, *_ = rows[i]
    if t is None:
        return None
    at = t + timedelta(seconds=seconds if ahead else -seconds)
    mine = [r for r in rows if r[0] == k and r[1] is not None and (r[1] >= at if ahead else r[1] <= at)]
    if not mine:
        return None
    r = min(mine, key=lambda r: (r[1], r[2])) if ahead else max(mine, key=lambda r: (r[1], r[2]))
    return r if max_age is None or abs((r[1] - at).total_seconds()) <= max_age else None


@pytest.mark.parametrize("cfg", [SkewConfig(), SPLIT], ids=["plain", "split"])
@pytest.mark.parametrize("ahead", [False, True])
def test_as_of_equals_search(spark, cfg, ahead):
    rng = random.Random(7)
    rows = [(rng.choice([1, 1, 1, 2, 3, None]), None if rng.random() < .05 else T0 + timedelta(minutes=10 * rng.randrange(60), seconds=rng.choice([0, 0, 1])), i, None if rng.random() < .2 else float(i))
            for i in range(300)]
    df = spark.createDataFrame(rows, "k long, t timestamp, i long, v double").withColumns({"_at": F.lit("x"), "_row": F.lit(1), "_found": F.lit(2)})
    with cached_scope(), skew_config(cfg):
        for seconds, max_age in ((1800, None), (0, None), (3600, 1200)):
            got = windows.as_of_columns(df, "k", "t", {"was": "v", "id": "i"}, seconds, tie=["i"], ahead=ahead, max_age=max_age, found_at="at")
            assert got.columns == [*df.columns, "was", "id", "at"]
            want = {r[2]: search(rows, n, seconds, ahead, max_age) for n, r in enumerate(rows)}
            have = {r.i: (r.id, r.was, r["at"]) for r in got.collect()}
            assert have == {i: ((w[2], w[3], w[1]) if w else (None, None, None)) for i, w in want.items()}


def test_missing_snapshots_no_longer_shift_the_lag(spark):
    """Three rows back are 30 minutes only where no snapshot is missing."""
    times = [0, 10, 20, 30, 90, 100, 130]
    rows = [(1, m, 10 - m // 10 if m < 100 else 1, T0 + timedelta(minutes=m)) for m in times]
    df = spark.createDataFrame(rows, "station_id int, full long, empty long, extraction_ts timestamp").withColumn("full", F.col("full") / 10)
    by = {b: {r.extraction_ts: (r[features.LAG_COL], r[features.TARGET_COL]) for r in features.feature_matrix(df, with_target=True, by=b).collect()} for b in ("rows", "time")}
    pct = {m: (m / 10) / (m / 10 + e) if m / 10 + e else None for (_, m, e, _) in rows}
    at = lambda m: T0 + timedelta(minutes=m)
    assert by["time"][at(90)] == (pct[30], pct[130]) and by["time"][at(100)] == (pct[30], pct[130])
    assert by["rows"][at(90)] == (pct[10], None) and by["rows"][at(100)] == (pct[20], None)
    assert by["time"][at(0)] == (None, pct[30]) and by["time"][at(130)] == (pct[100], None)
    with pytest.raises(ValueError):
        features.feature_matrix(df, by="count")


def test_feature_order_is_unique(spark):
    """Two snapshots of a station at one time are ordered by their counts, whatever order they come in."""
    rows = [(1, f, 10 - f, T0 + timedelta(minutes=m)) for f, m in ((1, 0), (2, 10), (5, 20), (9, 20), (3, 30), (4, 40))]
    make = lambda rs: {(r.extraction_ts, r.full): r[features.LAG_COL] for r in features.feature_matrix(spark.createDataFrame(rs, "station_id int, full long, empty long, extraction_ts timestamp").coalesce(1)).collect()}
    assert make(rows) == make(rows[::-1]) == make([rows[i] for i in (3, 2, 5, 0, 4, 1)])
    assert make(rows)[T0 + timedelta(minutes=40), 4] == 0.5
