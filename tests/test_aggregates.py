"""Exact quantiles (two-pass, bracketed) against numpy's linear percentile,
and the profiling aggregates on small frames."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from dockcast.operators import aggregates as agg

QS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def _check(df, column):
    got = agg.exact_quantiles(df, column, QS).first()
    vals = np.array([r[0] for r in df.select(column).collect() if r[0] is not None], dtype=float)
    want = np.percentile(vals, [q * 100 for q in QS], method="linear")
    for i, w in enumerate(want):
        assert math.isclose(got[str(i)], w, rel_tol=1e-12, abs_tol=1e-12), (column, QS[i], got[str(i)], w)


@pytest.mark.parametrize("table,column", [("lineitem", "l_quantity"), ("lineitem", "l_discount"),
                                          ("events", "value"), ("orders", "o_totalprice")])
def test_exact_quantiles_match_numpy(spark, table, column):
    _check(spark.read.parquet(f"{SF01}/{table}.parquet"), column)


def test_exact_quantiles_small_and_nulls(spark):
    for rows in ([(5.0,)], [(1.0,), (2.0,)], [(3.0,), (None,), (3.0,), (1.0,)], [(2.0,)] * 7):
        _check(spark.createDataFrame(rows, "x double"), "x")
    empty = spark.createDataFrame([(None,)], "x double")
    assert agg.exact_quantiles(empty, "x", [0.5]).first()["0"] is None


def test_describe_row(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 10]], "x double")
    r = agg.describe(df, "x").first()
    assert (r.n, r.lo, r.hi, r.q2) == (5, 1.0, 10.0, 3.0)
    assert math.isclose(r.mean, 4.0) and math.isclose(r.std, round(float(np.std([1, 2, 3, 4, 10], ddof=1)), 6))


def test_bins_are_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (10.5,), (50.0,), (51.0,)], "v double")
    got = {r.b: r.n for r in agg.bin_histogram(df, "v", [0, 10, 25, 50]).collect()}
    assert got == {None: 2, "(0,10]": 1, "(10,25]": 1, "(25,50]": 1}


def test_hash_sample_is_deterministic(spark):
    e = spark.read.parquet(f"{SF01}/events.parquet")
    a = {r.event_id for r in agg.hash_sample(e, "event_id", 0.1).collect()}
    b = {r.event_id for r in agg.hash_sample(e, "event_id", 0.1).collect()}
    assert a == b and 800 < len(a) < 1200


def test_hash_sample_large_ids_do_not_overflow(spark):
    big = spark.createDataFrame([(10**15 + i,) for i in range(2000)], "event_id long")
    got = {r.event_id for r in agg.hash_sample(big, "event_id", 0.1).collect()}
    want = {i for i in (10**15 + j for j in range(2000)) if (i * agg.HASH_MULT) % agg.HASH_RANGE < int(0.1 * agg.HASH_RANGE)}
    assert got == want


def test_scan_range_boundaries_and_latest_ties(spark):
    from datetime import datetime

    from dockcast.operators import serve
    from dockcast.sources import readers
    ts = [datetime(2024, 1, 1, h) for h in (0, 1, 2, 3)] + [datetime(2024, 1, 1, 3)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ts)], "id int, ts timestamp")
    left = readers.scan_time_range(df, "ts", "2024-01-01 01:00:00", "2024-01-01 03:00:00")
    right = readers.scan_time_range(df, "ts", "2024-01-01 01:00:00", "2024-01-01 03:00:00", inclusive="right")
    assert sorted(r.id for r in left.collect()) == [1, 2]            # [oldest, newest)
    assert sorted(r.id for r in right.collect()) == [2, 3, 4]        # (oldest, newest]
    assert sorted(r.id for r in agg.latest_rows(df, "ts").collect()) == [3, 4]  # ties at the max all kept
    fresh = serve.filter_fresh(df, "ts", "2024-01-01 03:05:00", minutes=65)
    assert sorted(r.id for r in fresh.collect()) == [3, 4]           # ts > as_of − 65 min, exclusive


def test_ratio_by_group_alignment_option(spark):
    df = spark.createDataFrame([(1, 5, 5), (1, 5, 4), (0, 3, 3)], "is_open int, space int, total int")
    pred = F.col("space") != F.col("total")
    zero = {r.is_open: r.r for r in agg.ratio_by_group(df, "is_open", pred).collect()}
    aligned = {r.is_open: r.r for r in agg.ratio_by_group(df, "is_open", pred, empty_as_null=True).collect()}
    assert zero == {1: 0.5, 0: 0.0} and aligned == {1: 0.5, 0: None}


def test_sample_keys_returns_whole_series(spark):
    e = spark.read.parquet(f"{SF01}/events.parquet")
    one = agg.sample_keys(e, "user_id", 1, seed=7)
    users = {r.user_id for r in one.select("user_id").distinct().collect()}
    assert len(users) == 1
    u = users.pop()
    assert one.count() == e.filter(F.col("user_id") == u).count()
    again = {r.user_id for r in agg.sample_keys(e, "user_id", 1, seed=7).select("user_id").distinct().collect()}
    assert again == {u}
