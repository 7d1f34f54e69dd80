"""Ridge fit against the closed form, forecasts, R², recursive forecast,
and the serving-table operators."""

import math
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from dockcast.operators import model, serve
from dockcast.plans import serving


@pytest.fixture(scope="module")
def xy(spark, events):
    return (events.select("user_id", "event_id", (F.col("value") / 100).alias("x1"),
                          (F.col("event_id") % 7).cast("double").alias("x2"),
                          (F.col("value") / 50 + F.col("event_id") % 3).alias("y")))


def _closed_form(pdf, feats, alpha):
    X = pdf[feats].to_numpy()
    y = pdf["y"].to_numpy()
    Xc, yc = X - X.mean(0), y - y.mean()
    w = np.linalg.solve(Xc.T @ Xc + alpha * np.eye(len(feats)), Xc.T @ yc)
    return w, y.mean() - X.mean(0) @ w


@pytest.mark.parametrize("alpha", [1.0, 50.0])
def test_ridge_matches_closed_form(xy, alpha):
    pdf = xy.toPandas()
    w, b = _closed_form(pdf, ["x1", "x2"], alpha)
    m = model.ridge_fit(xy, ["x1", "x2"], "y", alpha)
    assert np.allclose(m.coef, w, atol=1e-9) and math.isclose(m.intercept, b, abs_tol=1e-9)


def test_ridge_ml_path_agrees(xy):
    a = model.ridge_fit(xy, ["x1", "x2"], "y", 1.0)
    b = model.ridge_fit_ml(xy, ["x1", "x2"], "y", 1.0)
    assert np.allclose(a.coef, b.coef, atol=1e-5) and math.isclose(a.intercept, b.intercept, abs_tol=1e-5)


def test_ridge_per_station(xy):
    per = {r.user_id: r for r in model.ridge_fit_per_key(xy, "user_id", ["x1"], "y", 1.0).collect()}
    pdf = xy.toPandas()
    for uid in list(per)[:5]:
        w, b = _closed_form(pdf[pdf.user_id == uid], ["x1"], 1.0)
        assert math.isclose(per[uid].w_x1, w[0], abs_tol=1e-9)
        assert math.isclose(per[uid].intercept, b, abs_tol=1e-9)


def test_model_roundtrip(spark, tmp_path):
    m = model.RidgeModel(["a", "b"], [0.5, -1.0], 0.25)
    m.save(spark, str(tmp_path / "m"))
    back = model.RidgeModel.load(spark, str(tmp_path / "m"))
    assert back.coef == m.coef and back.intercept == m.intercept and back.features == m.features


def test_r2_and_swap(spark):
    df = spark.createDataFrame([(1.0, 1.1), (2.0, 1.9), (3.0, 3.2), (4.0, 3.8)], "y double, p double")
    y, p = np.array([1, 2, 3, 4.0]), np.array([1.1, 1.9, 3.2, 3.8])
    want = 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum()
    swapped = 1 - ((p - y) ** 2).sum() / ((p - p.mean()) ** 2).sum()
    assert math.isclose(model.r2_score(df, "y", "p").first().r2, want)
    assert math.isclose(model.r2_score(df, "y", "p", swap=True).first().r2, swapped)


def test_time_split_inclusive(spark):
    ts = [datetime(2024, 3, 14), datetime(2024, 3, 15), datetime(2024, 3, 16)]
    df = spark.createDataFrame([(t,) for t in ts], "ts timestamp")
    tr, te = model.time_split(df, "ts", "2024-03-15 00:00:00")
    assert (tr.count(), te.count()) == (2, 1)
    tr, te = model.time_split(df, "ts", "2024-03-15 00:00:00", inclusive="both")
    assert (tr.count(), te.count()) == (2, 2)


def test_forecast_rows_clip_and_times(spark):
    feats = spark.createDataFrame([(1, datetime(2024, 4, 15, 8, 0, 15), 0.9), (2, datetime(2024, 4, 15, 8, 0, 45), 0.1)],
                                  "station_id int, extraction_ts timestamp, pct_full double")
    m = model.RidgeModel(["pct_full"], [0.0], -1.0)  # change −1 → serving formula: pct + 1 − 1 = pct
    rows = {(r.station_id, r.relative_ts): r for r in model.forecast_rows(feats, m, run_ts="2024-04-15 08:05:00").collect()}
    assert rows[(1, 1)].fill_rate == pytest.approx(0.9) and rows[(1, 0)].fill_rate == pytest.approx(0.9)
    assert rows[(1, 1)].ts == datetime(2024, 4, 15, 8, 30, 0)
    assert rows[(2, 1)].ts == datetime(2024, 4, 15, 8, 31, 0)
    m2 = model.RidgeModel(["pct_full"], [0.0], 0.5)
    assert all(r.fill_rate <= 1.0 for r in model.forecast_rows(feats, m2).collect())


def test_recursive_forecast_feeds_back(spark):
    df = spark.createDataFrame([(1, i, 0.5) for i in range(5)], "s int, t int, pct double")
    r = model.recursive_forecast(df, "s", ["t"], step_slope=F.lit(1.0), step_offset=F.lit(-0.2),
                                 first_value=F.col("pct"), floor=0.0, out="p")
    got = [x.p for x in r.orderBy("t").collect()]
    assert got == pytest.approx([0.5, 0.3, 0.1, 0.0, 0.0])


def test_upsert_whole_row(spark):
    t = spark.createDataFrame([(1, 5, 5), (2, 3, 7)], "id int, full int, empty int")
    u = spark.createDataFrame([(2, None, 1), (3, 4, 4)], "id int, full int, empty int")
    got = {r.id: (r.full, r.empty) for r in serve.upsert(t, u, ["id"]).collect()}
    assert got == {1: (5, 5), 2: (None, 1), 3: (4, 4)}


def test_insert_ignore(spark):
    t = spark.createDataFrame([(1, 0, "a"), (1, 1, "b")], "station_id int, relative_ts int, v string")
    i = spark.createDataFrame([(1, 1, "x"), (2, 0, "y")], "station_id int, relative_ts int, v string")
    got = sorted(tuple(r) for r in serve.insert_ignore_state(t, i, ["station_id", "relative_ts"]).collect())
    assert got == [(1, 0, "a"), (1, 1, "b"), (2, 0, "y")]


def test_freshness(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1, 10, 0)), (2, datetime(2024, 1, 1, 10, 6))],
                               "station_id int, run_ts timestamp")
    assert [r.station_id for r in serve.filter_fresh(df, "run_ts", "2024-01-01 10:10:00").collect()] == [2]
    assert serve.needs_refresh(df, "run_ts", "2024-01-01 10:10:00").first().stale is False
    assert serve.needs_refresh(df, "run_ts", "2024-01-01 10:12:00").first().stale is True
    req = spark.createDataFrame([(1,), (2,), (3,)], "station_id int")
    assert sorted(r.station_id for r in serve.stale_ids(req, df, "station_id", "run_ts", "2024-01-01 10:10:00").collect()) == [1, 3]


def test_serve_forecast_flow(spark):
    stations = spark.createDataFrame([(1, "a", "c", "x"), (2, "b", "c", "y")], "id int, name string, city string, area string")
    forecasts = spark.createDataFrame([], "station_id int, fill_rate float, relative_ts short, base_ts timestamp, run_ts timestamp")
    feats = spark.createDataFrame([(1, datetime(2024, 1, 1, 10, 0), 0.4), (2, datetime(2024, 1, 1, 10, 0), 0.8)],
                                  "station_id long, extraction_ts timestamp, pct_full double")
    m = model.RidgeModel(["pct_full"], [0.0], -1.0)
    req = spark.createDataFrame([(1,), (2,)], "station_id int")
    ins, fresh = serving.serve_forecast(req, stations, forecasts, feats, m, as_of="2024-01-01 10:02:00")
    assert ins.count() == 4 and fresh.count() == 4
    with pytest.raises(serving.UnknownStations):
        serving.serve_forecast(spark.createDataFrame([(9,)], "station_id int"), stations, forecasts, feats, m,
                               as_of="2024-01-01 10:02:00")
    view, low, high = serving.shortage_view(stations, ins)
    assert [r.station_id for r in low.collect()] == [1, 2]
    assert [r.station_id for r in high.collect()] == [2, 1]
    shown = serving.display(view).orderBy("Station").collect()
    assert shown[0]["Now"] == "40%"


def test_pivot_drop_incomplete_newest_run(spark):
    t1, t2 = datetime(2024, 1, 1, 10, 0), datetime(2024, 1, 1, 10, 3)
    df = spark.createDataFrame([(1, 0, 0.4, t1), (1, 0, 0.5, t2), (1, 1, 0.6, t2), (2, 0, 0.2, t2)],
                               "station_id int, relative_ts int, fill_rate double, run_ts timestamp")
    w = serving.wide_forecast(df)
    assert [tuple(r) for r in w.collect()] == [(1, 0.5, 0.6)]


def test_pivot_unpivot_identity(spark):
    rows = [(s, h, round(0.1 * s + 0.01 * h, 4)) for s in range(1, 6) for h in range(3) if (s + h) % 4]
    long = spark.createDataFrame(rows, "station_id int, relative_ts int, fill_rate double")
    wide = serve.pivot_horizons(long, "station_id", "relative_ts", "fill_rate", [0, 1, 2],
                                ["h0", "h1", "h2"], agg="first", digits=None)
    back = serve.unpivot_horizons(wide, "station_id", {"h0": 0, "h1": 1, "h2": 2})
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows)


def test_reconstruction_modes(spark):
    """Serving formula pct + 1 + change (parity) vs the target's inverse
    pct − change (``mode='consistent'``), both clipped to [0, 1]."""
    from dockcast.functions.scalar import percent_text
    feats = spark.createDataFrame([(1, datetime(2024, 1, 1), 0.6)], "station_id int, extraction_ts timestamp, pct_full double")
    m = model.RidgeModel(["pct_full"], [0.0], -0.9)  # predicted change −0.9
    serving_fill = model.forecast_fill(feats, m).first().fill_rate
    consistent = model.forecast_fill(feats, m, mode="consistent").first().fill_rate
    assert serving_fill == pytest.approx(0.7) and consistent == pytest.approx(1.0)
    txt = spark.createDataFrame([(0.426,), (None,)], "x double").select(percent_text("x").alias("t")).collect()
    assert [r.t for r in txt] == ["43%", None]


def test_model_store_names_and_versions(spark, tmp_path):
    import pytest

    from dockcast.operators.model import ModelStore, RidgeModel
    store = ModelStore(spark, str(tmp_path / "models"))
    assert store.names() == [] and store.versions("fill") == []
    first, second = RidgeModel(["a", "b"], [1.0, 2.0], 0.5), RidgeModel(["a"], [3.0], 0.0)
    assert (store.save("fill", first), store.save("fill", second), store.save("other", first)) == (1, 2, 1)
    assert store.names() == ["fill", "other"] and store.versions("fill") == [1, 2]
    assert store.load("fill").coef == [3.0] and store.load("fill", 1).intercept == 0.5
    with pytest.raises(LookupError):
        store.load("fill", 3)
    with pytest.raises(LookupError):
        store.load("none")
