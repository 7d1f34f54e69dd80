"""Whole-frame summaries against NumPy."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from dockcast.operators import summary
from dockcast.session import plan_text


def test_images_keep_the_order():
    d = np.array(sorted([-math.inf, -1e300, -2.5, -1.0, -5e-324, 0.0, 5e-324, 1.0, 1.0000000000000002, 3.7, 1e300, math.inf]))
    i = np.array([-(1 << 63), -7, -1, 0, 1, 1 << 40, (1 << 63) - 1], np.int64)
    for v, integral in ((d, False), (i, True)):
        img = summary.image(v)
        assert (np.diff(img.astype(object)) > 0).all()
        assert [summary.number(int(x), integral) for x in img] == v.tolist()
    assert summary.image(np.array([-0.0])) == summary.image(np.array([0.0]))


def test_ranks(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, 0, -5, 7, (1 << 60) + 1, (1 << 60) + 2, -(1 << 62)]), rng.choice([None, float("nan"), -0.0, 0.0, 1e-9, 1e-9 + 1e-24, -math.inf, 2.5, rng.random()]), rng.randrange(9)) for _ in range(700)]
    df = spark.createDataFrame(rows, "a long, b double, c int").repartition(5)
    want = {"a": sorted(r[0] for r in rows if r[0] is not None), "b": sorted(r[1] for r in rows if r[1] is not None and r[1] == r[1]), "c": sorted(r[2] for r in rows)}
    asked = {c: [1, 2, len(v) // 3, len(v) // 2, len(v)] for c, v in want.items()}
    got = summary.select_ranks(df, asked)
    assert got == {c: {r: want[c][r - 1] for r in rs} for c, rs in asked.items()}


def test_describe_all(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=501)
    rows = [(i, float(v), None if i % 4 else float(i), rng.choice(["a", "b", "é"]).item() if i % 5 else None, None, None) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "i int, x double, y double, s string, none string, void double").withColumn("t", F.current_timestamp())
    got = {r["column"]: r for r in summary.describe_all(df).collect()}
    assert set(got) == {"i", "x", "y", "s", "none", "void"}
    for c, v in (("i", np.arange(501.0)), ("x", x), ("y", np.arange(0, 501, 4.0))):
        want = (len(v), v.mean(), v.std(ddof=1), v.min(), *np.quantile(v, [.25, .5, .75]), v.max())
        assert [got[c][k] for k in ("n", "mean", "std", "min", "q1", "q2", "q3", "max")] == pytest.approx(want, abs=1e-6)
        assert got[c].unique is None and got[c].top is None
    texts = [r[3] for r in rows if r[3]]
    top = min(set(texts), key=lambda s: (-texts.count(s), s))
    assert (got["s"].n, got["s"].unique, got["s"].top, got["s"].freq) == (len(texts), len(set(texts)), top, texts.count(top))
    assert (got["none"].n, got["none"].unique, got["none"].top) == (0, 0, None) and (got["void"].n, got["void"].q2, got["void"]["mean"]) == (0, None, None)
    empty = {r["column"]: r.n for r in summary.describe_all(df.limit(0)).collect()}
    assert set(empty.values()) == {0} and len(empty) == 6


def test_scans_do_not_grow_with_the_columns(spark, monkeypatch):
    made = []
    counts = summary._digit_counts
    monkeypatch.setattr(summary, "_digit_counts", lambda *a: made.append(1) or counts(*a))
    df = spark.range(50).select(*[(F.col("id") * (i + 1)).alias(f"c{i}") for i in range(12)])
    assert summary.describe_all(df).count() == 12
    assert len(made) == summary.DIGITS


def test_correlations(spark):
    rng = np.random.default_rng(2)
    a = rng.normal(size=400) + 1e6
    cols = {"a": a, "b": 2 * a + rng.normal(size=400), "c": rng.normal(size=400), "k": np.full(400, 3.0)}
    gaps = {"b": rng.random(400) < .2, "c": rng.random(400) < .3}
    rows = [tuple(None if n in gaps and gaps[n][i] else float(v[i]) for n, v in cols.items()) for i in range(400)]
    df = spark.createDataFrame(rows, "a double, b double, c double, k double").withColumn("note", F.lit("x")).repartition(6)
    got = {(r.a, r.b): (r.n, r.r) for r in summary.correlations(df).collect()}
    assert len(got) == 16
    for x in cols:
        for y in cols:
            use = ~(gaps.get(x, np.zeros(400, bool)) | gaps.get(y, np.zeros(400, bool)))
            n, r = got[x, y]
            assert n == use.sum()
            assert r is None if "k" in (x, y) else r == pytest.approx(np.corrcoef(cols[x][use], cols[y][use])[0, 1], abs=1e-6)
    wide = spark.range(9).select(*[(F.col("id") * i).alias(f"c{i}") for i in range(11)])
    assert plan_text(summary.correlations(wide)).count("+- Exchange (") == 1
