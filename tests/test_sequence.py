"""The split (hot-key) path of every sequence operator must equal the plain
window path row for row."""

import math

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from dockcast.operators import sequence as sq

# Tiny thresholds force every key of the fixture through the chunked path.
HOT = sq.SkewConfig(hot_rows=5, hot_share=0.0, chunk_rows=7, max_hot_keys=10_000)
PLAIN = sq.SkewConfig()


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def _close(a, b):
    assert len(a) == len(b)
    for x, y in zip(a, b):
        for u, v in zip(x, y):
            if isinstance(u, float) or isinstance(v, float):
                assert (u is None and v is None) or math.isclose(u, v, rel_tol=1e-9, abs_tol=1e-12), (x, y)
            else:
                assert u == v, (x, y)


def test_global_position_is_exact(events):
    p = sq.global_position(events, ["user_id"], ["ts", "event_id"], out="pos")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    ref = events.withColumn("pos", F.row_number().over(w))
    assert _rows(p, ["event_id", "pos"]) == _rows(ref, ["event_id", "pos"])


def test_row_frames_hot_equals_plain(events):
    def build(w):
        return {"lag3": F.lag("value", 3).over(w),
                "fwd3": F.lead("value", 3).over(w),
                "m": F.avg("value").over(w.rowsBetween(-11, 0)),
                "n": F.count("value").over(w.rowsBetween(-11, 0))}
    a = sq.row_frames(events, "user_id", ["ts", "event_id"], build, preceding=11, following=3,
                      cfg=sq.SkewConfig(hot_rows=5, hot_share=0.0, chunk_rows=11, max_hot_keys=10_000))
    HOT2 = sq.SkewConfig(hot_rows=5, hot_share=0.0, chunk_rows=16, max_hot_keys=10_000)
    b = sq.row_frames(events, "user_id", ["ts", "event_id"], build, preceding=11, following=3, cfg=PLAIN)
    cols = ["event_id", "lag3", "fwd3", "m", "n"]
    _close(_rows(a, cols), _rows(b, cols))
    c = sq.row_frames(events, "user_id", ["ts", "event_id"], build, preceding=11, following=3, cfg=HOT2)
    _close(_rows(c, cols), _rows(b, cols))


def test_position_desc_hot_equals_plain(events):
    a = sq.position(events, "user_id", ["ts", "event_id"], out="r", descending=True, cfg=HOT)
    b = sq.position(events, "user_id", ["ts", "event_id"], out="r", descending=True, cfg=PLAIN)
    assert _rows(a, ["event_id", "r"]) == _rows(b, ["event_id", "r"])


def test_carry_forward_hot_equals_plain(events):
    v = F.when(F.col("event_type") == "purchase", F.col("value"))
    a = sq.carry_forward(events, "user_id", ["ts", "event_id"], v, "ff", cfg=HOT)
    b = sq.carry_forward(events, "user_id", ["ts", "event_id"], v, "ff", cfg=PLAIN)
    _close(_rows(a, ["event_id", "ff"]), _rows(b, ["event_id", "ff"]))


def test_affine_scan_matches_python_loop(events):
    kw = dict(a=F.lit(0.9), b=F.lit(-0.02) + F.lit(0.05) * (F.col("event_id") % 2),
              a_first=F.lit(0.0), b_first=F.col("value") / 100 * 0.9 - 0.02, lo=0.0)
    small = events.filter(F.col("user_id") < 20)
    a = sq.clamped_affine_scan(small, "user_id", ["ts", "event_id"], out="p", cfg=HOT, **kw)
    b = sq.clamped_affine_scan(small, "user_id", ["ts", "event_id"], out="p", cfg=PLAIN, **kw)
    got_a = dict(_rows(a, ["event_id", "p"]))
    got_b = dict(_rows(b, ["event_id", "p"]))
    # brute force in Python
    rows = sorted(small.select("user_id", "ts", "event_id", "value").collect(),
                  key=lambda r: (r.user_id, r.ts, r.event_id))
    want, prev_user, x = {}, None, None
    for r in rows:
        if r.user_id != prev_user:
            x = max(0.0, r.value / 100 * 0.9 - 0.02)
        else:
            x = max(0.0, 0.9 * x - 0.02 + 0.05 * (r.event_id % 2))
        want[r.event_id] = x
        prev_user = r.user_id
    for k, v in want.items():
        assert math.isclose(got_a[k], v, abs_tol=1e-12)
        assert math.isclose(got_b[k], v, abs_tol=1e-12)


def test_affine_scan_multilevel_recursion(events):
    """hot_rows=2, chunk_rows=4: ~67-row keys → 17 chunks → 5 → 2, three levels."""
    deep = sq.SkewConfig(hot_rows=2, hot_share=0.0, chunk_rows=4, max_hot_keys=10_000)
    kw = dict(a=F.lit(0.9), b=F.lit(-0.02) + F.lit(0.05) * (F.col("event_id") % 2),
              a_first=F.lit(0.0), b_first=F.col("value") / 100 * 0.9 - 0.02, lo=0.0)
    small = events.filter(F.col("user_id") < 6)
    a = dict(_rows(sq.clamped_affine_scan(small, "user_id", ["ts", "event_id"], out="p", cfg=deep, **kw), ["event_id", "p"]))
    b = dict(_rows(sq.clamped_affine_scan(small, "user_id", ["ts", "event_id"], out="p", cfg=PLAIN, **kw), ["event_id", "p"]))
    assert a.keys() == b.keys()
    for k in a:
        assert math.isclose(a[k], b[k], abs_tol=1e-12)


def test_compose_is_associative():
    import random
    rnd = random.Random(7)
    maps = [(rnd.uniform(-2, 2), rnd.uniform(-1, 1), rnd.uniform(-3, 0), rnd.uniform(0, 3)) for _ in range(30)]
    maps[5] = (0.0, 0.3, -1.0, 1.0)
    for x0 in (-5.0, 0.1, 4.0):
        x = x0
        for m in maps:
            x = min(max(m[0] * x + m[1], m[2]), m[3])
        comp = (1.0, 0.0, float("-inf"), float("inf"))
        for m in maps:
            comp = sq._compose_all(*np.array([comp, m], float).T)
        for c in (comp, sq._compose_all(*np.array(maps, float).T)):
            y = min(max(c[0] * x0 + c[1], c[2]), c[3])
            assert math.isclose(x, y, abs_tol=1e-9)
    gap = maps[:9] + [(1.0, float("nan"), -1.0, 1.0)] + maps[9:]
    assert math.isnan(sq._compose_all(*np.array(gap, float).T)[1])
    assert sq._compose_all(*np.array([*gap, (0.0, 0.5, -1.0, 1.0)], float).T)[1:] == (0.5, 0.5, 0.5)


def test_null_key_rows_survive_split_path(spark):
    rows = [(None if i % 3 == 0 else i % 2, i, float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "k long, t long, v double")
    cfg = sq.SkewConfig(hot_rows=5, hot_share=0.0, chunk_rows=6, max_hot_keys=100)

    def build(w):
        return {"lag1": F.lag("v", 1).over(w), "m3": F.avg("v").over(w.rowsBetween(-2, 0))}
    a = sq.row_frames(df, "k", ["t"], build, preceding=2, following=0, cfg=cfg)
    b = sq.row_frames(df, "k", ["t"], build, preceding=2, following=0, cfg=PLAIN)
    assert a.count() == 60
    _close(_rows(a, ["t", "lag1", "m3"]), _rows(b, ["t", "lag1", "m3"]))
    ff_a = sq.carry_forward(df, "k", ["t"], F.when(F.col("t") % 5 == 0, F.col("v")), "f", cfg=cfg)
    ff_b = sq.carry_forward(df, "k", ["t"], F.when(F.col("t") % 5 == 0, F.col("v")), "f", cfg=PLAIN)
    _close(_rows(ff_a, ["t", "f"]), _rows(ff_b, ["t", "f"]))


def test_affine_scan_null_key_is_one_group(spark):
    rows = [(None, i, 1.0) for i in range(5)] + [(1, i, 1.0) for i in range(3)]
    df = spark.createDataFrame(rows, "k long, t long, v double")
    for cfg in (PLAIN, sq.SkewConfig(hot_rows=2, hot_share=0.0, chunk_rows=2, max_hot_keys=100)):
        r = sq.clamped_affine_scan(df, "k", ["t"], a=F.lit(1.0), b=F.lit(1.0), a_first=F.lit(0.0),
                                   b_first=F.col("v"), out="x", cfg=cfg)
        got = sorted((row.k is None, row.t, row.x) for row in r.collect())
        assert got == sorted([(True, i, 1.0 + i) for i in range(5)] + [(False, i, 1.0 + i) for i in range(3)])


def test_prefix_sums_hot_equals_plain(events):
    sums = {"cs": F.col("value"), "cn": F.lit(1)}
    a = sq.prefix_sums(events, "user_id", ["ts", "event_id"], sums, cfg=HOT)
    b = sq.prefix_sums(events, "user_id", ["ts", "event_id"], sums, cfg=PLAIN)
    _close(_rows(a, ["event_id", "cs", "cn"]), _rows(b, ["event_id", "cs", "cn"]))


def test_release_cached_unpersists_split_relations(events):
    sq.release_cached()
    sq.position(events, "user_id", ["ts", "event_id"], out="p", cfg=HOT).count()
    assert sq.release_cached() >= 1
    assert sq.release_cached() == 0


def test_all_keys_hot_path(events):
    """More hot keys than max_hot_keys: every row takes the split path
    without a hot-key list; results equal the plain window."""
    many = sq.SkewConfig(hot_rows=5, hot_share=0.0, chunk_rows=16, max_hot_keys=2)
    split = sq.split_hot_keys(events, ["user_id"], many)
    assert split.cold is None and split.hot is not None

    def build(w):
        return {"lag3": F.lag("value", 3).over(w), "m": F.avg("value").over(w.rowsBetween(-11, 0))}
    a = sq.row_frames(events, "user_id", ["ts", "event_id"], build, preceding=11, cfg=many)
    b = sq.row_frames(events, "user_id", ["ts", "event_id"], build, preceding=11, cfg=PLAIN)
    _close(_rows(a, ["event_id", "lag3", "m"]), _rows(b, ["event_id", "lag3", "m"]))
    p = sq.position(events, "user_id", ["ts", "event_id"], out="r", cfg=many)
    q = sq.position(events, "user_id", ["ts", "event_id"], out="r", cfg=PLAIN)
    assert _rows(p, ["event_id", "r"]) == _rows(q, ["event_id", "r"])
