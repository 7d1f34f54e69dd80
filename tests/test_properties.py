"""Property tests on random small frames (few examples each: every example
runs Spark jobs)."""

import math

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dockcast.operators import clean
from dockcast.operators import sequence as sq

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

rows_st = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 30), st.one_of(st.none(), st.floats(-5, 5))),
                   min_size=1, max_size=60)


def _frame(spark, rows):
    # unique (k, t) by construction: t is made unique per key with the row index
    data = [(k, t * 100 + i, v) for i, (k, t, v) in enumerate(rows)]
    return spark.createDataFrame(data, "k long, t long, v double")


@SETTINGS
@given(rows=rows_st, chunk=st.integers(3, 9), prec=st.integers(0, 3), foll=st.integers(0, 3))
def test_split_path_equals_plain(spark, rows, chunk, prec, foll):
    df = _frame(spark, rows)

    def build(w):
        out = {"s": F.sum("v").over(w.rowsBetween(-prec, foll)), "n": F.count("v").over(w.rowsBetween(-prec, foll))}
        if prec:
            out["lag"] = F.lag("v", prec).over(w)
        if foll:
            out["lead"] = F.lead("v", foll).over(w)
        return out
    hot = sq.SkewConfig(hot_rows=1, hot_share=0.0, chunk_rows=max(chunk, prec, foll, 1))
    a = sq.row_frames(df, "k", ["t"], build, preceding=prec, following=foll, cfg=hot).toPandas()
    b = sq.row_frames(df, "k", ["t"], build, preceding=prec, following=foll).toPandas()
    cols = sorted(c for c in a.columns)
    a = a[cols].sort_values(["k", "t"]).reset_index(drop=True)
    b = b[cols].sort_values(["k", "t"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b, check_dtype=False, atol=1e-9)


@SETTINGS
@given(rows=rows_st)
def test_dedupe_and_drop_shared_match_pandas(spark, rows):
    data = [(k, t % 5, v if v is None else round(v, 1)) for k, t, v in rows]
    df = spark.createDataFrame(data, "k long, g long, v double")
    pdf = pd.DataFrame(data, columns=["k", "g", "v"])
    # keep first by v (nulls first, as Spark's ascending order), per (k, g)
    got = sorted((r.k, r.g, r.v) for r in clean.dedupe_first(df, ["k", "g"], ["v"]).collect())
    want = []
    for (k, g), grp in pdf.groupby(["k", "g"]):
        vals = sorted(grp["v"].tolist(), key=lambda x: (not (x is None or (isinstance(x, float) and math.isnan(x))),
                                                      0 if x is None or x != x else x))
        v = vals[0]
        want.append((k, g, None if v is None or v != v else v))
    assert got == sorted(want)
    shared = sorted((r.k, r.g) for r in clean.drop_shared(df, ["k", "g"]).collect())
    sizes = pdf.groupby(["k", "g"]).size()
    assert shared == sorted(tuple(int(x) for x in idx) for idx, n in sizes.items() if n == 1)


@SETTINGS
@given(rows=rows_st)
def test_forward_fill_never_crosses_keys(spark, rows):
    df = _frame(spark, rows)
    hot = sq.SkewConfig(hot_rows=1, hot_share=0.0, chunk_rows=4)
    for cfg in (None, hot):
        got = {(r.k, r.t): r.f for r in sq.carry_forward(df, "k", ["t"], "v", "f", cfg=cfg).collect()}
        for k, grp in pd.DataFrame([(k, t, v) for k, t, v in
                                    [(r.k, r.t, r.v) for r in df.collect()]], columns=["k", "t", "v"]).groupby("k"):
            last = None
            for _, row in grp.sort_values("t").iterrows():
                if row.v == row.v and row.v is not None:
                    last = row.v
                assert got[(k, row.t)] == last
