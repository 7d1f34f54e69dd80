"""Rules at the edges: nulls, NaN, repeated keys, far points, boundary days,
retries and failed reads, on both paths where an operator has two."""

import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from dockcast import schemas
from dockcast.functions import scalar as fx
from dockcast.operators import aggregates, clean, joins, model, sequence as sq, serve, windows
from dockcast.plans import jobs, serving, snapshot
from dockcast.session import plan_text
from dockcast.sources import readers, sinks
from dockcast.streaming import streams

SPLIT = sq.SkewConfig(hot_rows=8, hot_share=0.0, chunk_rows=16)


def _series(spark, values):
    return spark.createDataFrame([("s", i, datetime(2024, 1, 1) + timedelta(minutes=i), v) for i, v in enumerate(values)], "k string, i int, ts timestamp, v double")


@pytest.mark.parametrize("cfg", [None, SPLIT, sq.SkewConfig(hot_rows=4, hot_share=0.0, chunk_rows=4)])
def test_null_step_ends_the_chain(spark, cfg):
    df = _series(spark, [None if i == 5 else 0.1 for i in range(64)])
    r = model.recursive_forecast(df, "k", ["i"], step_slope=F.lit(0.5), step_offset=F.col("v"), first_value=F.lit(0.3), cfg=cfg)
    got = [x.forecast for x in r.orderBy("i").collect()]
    assert all(x is not None for x in got[:5]) and got[5:] == [None] * 59


@pytest.mark.parametrize("odd", [1e17, math.nan, None])
def test_time_rolling_mean_is_the_same_on_both_paths(spark, odd):
    df = _series(spark, [odd if i == 5 else float(i % 7) for i in range(64)])
    got = [[x.m for x in windows.time_rolling_mean(df, "k", "ts", "v", 12 * 60, "m", tie=["i"], cfg=c).orderBy("i").collect()] for c in (None, SPLIT)]
    same = [a == b or (a != a and b != b) for a, b in zip(*got)]
    assert all(same)
    if odd is not None and odd != odd:
        assert sum(x != x for x in got[1]) == 13
    if odd == 1e17:
        assert got[1][50] == pytest.approx(sum(i % 7 for i in range(38, 51)) / 13)


def test_hot_threshold_has_a_ceiling(spark):
    cfg = sq.SkewConfig()
    assert sq.hot_threshold(spark, 10 ** 12, cfg) == cfg.rows_per_partition
    assert sq.hot_threshold(spark, 1000, cfg) == cfg.hot_rows


def test_nearest_zone_paths_agree(spark):
    pts = [("p1", 0.1, 0.2), ("p1", 0.1, 0.2), ("p2", 0.1, 0.2), ("far", 1e6, -3e5), ("nan", math.nan, 1.0), ("none", None, 1.0), ("inf", math.inf, 0.0), ("mid", 2.5, 2.5), ("edge", -40.0, 9.0)]
    zones = [(f"z{i}", float(i % 5), float(i // 5)) for i in range(25)] + [("bad", None, 1.0), ("worse", math.nan, 1.0), ("z0", 0.0, 0.0)]
    p = spark.createDataFrame(pts, "id string, x double, y double")
    z = spark.createDataFrame(zones, "zid string, x double, y double")
    args = dict(point_id="id", px="x", py="y", zone_id="zid", zx="x", zy="y")
    a, b, c = (sorted(map(tuple, joins.nearest_zone(p, z, **args, **o).collect()), key=repr) for o in ({}, {"max_literal_zones": 3}, {"max_literal_zones": 3, "cell": 0.01}))
    assert a == b == c and len(a) == len(pts)
    want = {i: None if x is None or y is None or not math.isfinite(x) else min(zones[:25], key=lambda q: (math.hypot(x - q[1], y - q[2]), q[0]))[0] for i, x, y in pts}
    assert dict(a) == want
    none = spark.createDataFrame([("q", None, None)], "zid string, x double, y double")
    assert {r.zone for r in joins.nearest_zone(p, none, **args).collect()} == {None}


def test_not_in_ignores_nulls(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    assert {r.id for r in joins.not_in(df, "id", spark.createDataFrame([(1,), (None,)], "b int"), "b").collect()} == {2, None}
    assert joins.not_in(df, "id", spark.createDataFrame([], "b int"), "b").count() == 3


def test_insert_ignore_and_upsert_with_repeated_keys(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "x"), (3, "z"), (3, "y"), (None, "n"), (None, "n")], "k int, v string")
    assert sorted(map(tuple, serve.insert_ignore(t, new, ["k"]).collect()), key=repr) == [(3, "y"), (None, "n"), (None, "n")]
    got = serve.upsert(t, spark.createDataFrame([(2, "c"), (2, "d"), (4, "e")], "k int, v string"), ["k"])
    assert sorted(map(tuple, got.collect())) == [(1, "a"), (2, "d"), (4, "e")]


def test_group_size_counts_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 1), (None, 1), ("a", None)], "x string, y int")
    assert sorted((r.x or "", r.y or 0, r.group_size) for r in clean.group_size(df, ["x", "y"]).collect()) == [("", 1, 2), ("", 1, 2), ("a", 0, 1), ("a", 1, 2), ("a", 1, 2)]


def test_r2_of_a_constant_truth(spark):
    df = spark.createDataFrame([(1.0, 1.0, 2.0)] * 3, "t double, p double, q double")
    assert model.r2_score(df, "t", "p").first()[0] == 1.0 and model.r2_score(df, "t", "q").first()[0] == 0.0
    assert model.r2_score(df.limit(0), "t", "p").first()[0] is None


def test_percent_rounds_halves_to_even(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (0.5,), (None,)], "x double")
    assert [r.t for r in df.select(fx.percent_text("x").alias("t")).collect()] == ["12%", "38%", "50%", None]


def test_explode_hourly_stops_at_end(spark):
    t = datetime(2024, 4, 1)
    df = spark.createDataFrame([("z", t, t + timedelta(hours=2), 3600, [1.0, 2.0, 3.0])], "k string, start timestamp, end timestamp, interval int, v array<double>")
    assert [r.v for r in readers.explode_hourly(df, ["k"], ["v"]).orderBy("datetime").collect()] == [1.0, 2.0]


@pytest.mark.parametrize("values", [[0.0] * 500 + [i / 7 for i in range(500)], [3.0] * 40, [1.0], [None, 2.0, 5.0], [float(i * i % 101) for i in range(777)]])
@pytest.mark.parametrize("bracket", [1_000_000, 3])
def test_quantiles_with_ties(spark, values, bracket, monkeypatch):
    import numpy as np
    monkeypatch.setattr(aggregates, "BRACKET_VALUES", bracket)
    df = spark.createDataFrame([(v,) for v in values], "x double")
    ranks = range(1, sum(v is not None for v in values) + 1, 97)
    got = aggregates.order_statistics(df, "x", list(ranks), bracket)
    order = sorted(v for v in values if v is not None)
    assert got == {r: order[r - 1] for r in ranks}
    q = aggregates.exact_quantiles(df, "x", [0.25, 0.5, 0.75])
    assert list(q.first()) == pytest.approx(list(np.quantile(order, [0.25, 0.5, 0.75])))
    assert "collect_list" not in plan_text(aggregates.describe(df, "x"))


def _raw(ids, ts_list):
    return [(i, f"s{i}", 2, 20, 5, 10, 0, 5, 0, "台北市", "大安區", 25.0 + i / 1000, 121.5, None, "a", 1, t - timedelta(minutes=1), t) for t in ts_list for i in ids]


def test_reprocess_keeps_the_rest_of_a_day(spark, tmp_path):
    ts = [datetime(2024, 4, 10, h) for h in (1, 10, 20)]
    raw, layer = str(tmp_path / "raw"), str(tmp_path / "clean")
    df = spark.createDataFrame(_raw([1], ts), schemas.RAW_SNAPSHOT)
    sinks.write_layer(df, raw)
    sinks.write_layer(snapshot.clean_snapshot(df), layer)
    snapshot.reprocess_range(spark, raw, layer, "2024-04-10 05:00:00", "2024-04-10 15:00:00")
    assert sorted(r.extraction_ts for r in spark.read.parquet(layer).collect()) == ts


def test_scan_prunes_by_one_zone_whatever_the_session(spark, tmp_path):
    path = str(tmp_path / "layer")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        sinks.write_layer(spark.sql("select 1L id, timestamp'2024-04-10 20:00:00' extraction_ts"), path)
        for tz, lo, hi in (("Asia/Taipei", "2024-04-11 03:30:00", "2024-04-11 04:30:00"), ("UTC", "2024-04-10 19:30:00", "2024-04-10 20:30:00"), ("America/New_York", "2024-04-10 15:30:00", "2024-04-10 16:30:00")):
            spark.conf.set("spark.sql.session.timeZone", tz)
            sel = readers.scan_time_range(spark.read.parquet(path), "extraction_ts", lo, hi)
            assert sel.count() == 1 and "PartitionFilters: [isnotnull(extraction_date" in plan_text(sel)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


FEED = "id,name,type,space,full,empty,bike_yb1,bike_yb2,bike_eyb,city,area,lat,lng,place_id,address,is_open,updated_at\n1,a,2,20,5,15,0,5,0,台北市,大安區,25.0,121.5,,x,1,1713315600\n"


def test_a_pull_is_stamped(spark, tmp_path):
    p = tmp_path / "feed.csv"
    p.write_text(FEED)
    with pytest.raises(ValueError):
        readers.read_snapshot_csv(spark, str(p))
    out = jobs.ingest_snapshot_csv(spark, str(p), str(tmp_path / "raw"), str(tmp_path / "clean"), pulled_at=datetime(2024, 4, 17, 1, 0, 0, 789))
    assert [r.extraction_ts for r in out.collect()] == [datetime(2024, 4, 17, 1, 0, 0)]


def test_weather_report_takes_the_nearest_zone(spark):
    landing = spark.createDataFrame([(25.0439, 121.5417, 1713312000, 1713312000 + 3600, 3600) + tuple([[1.0]] * 9)], schemas.WEATHER_LANDING)
    assert [r.zone for r in serving.weather_report(landing).collect()] == ["TaiBei"]


def test_new_stations_take_one_stated_row(spark):
    snap = spark.createDataFrame([(7, 25.05, 121.5, "c", "b", "x"), (7, 22.6, 120.3, "c", "a", "x")], "id int, lat double, lng double, city string, name string, area string")
    stations = spark.createDataFrame([], schemas.BIKE_STATION)
    zones = spark.createDataFrame([(1, "N", 25.0, 121.5), (2, "S", 22.6, 120.3)], "id int, name string, lat double, lng double")
    r = snapshot.new_stations(snap, stations, zones, created_at="2024-04-17 00:00:00").collect()
    assert [(x.id, x.name, x.lat, x.weather_zone_id) for x in r] == [(7, "a", 22.6, 2)]


def test_clean_batch_twice_is_once(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "clean")
    spark.createDataFrame(_raw(range(3), [datetime(2024, 4, 17, 3)]), schemas.RAW_SNAPSHOT).write.parquet(raw)
    for n in ("a", "b"):  # a lost checkpoint: the same batch comes again
        streams.stream_clean(spark, raw, out, str(tmp_path / n), schema=schemas.RAW_SNAPSHOT, clean_fn=lambda d: snapshot.clean_snapshot(d, as_of="2024-04-17 04:00:00")).awaitTermination()
    assert spark.read.parquet(out).count() == 3


def test_status_survives_a_retry_and_fails_on_a_bad_read(spark, tmp_path):
    schema = "id long, full long, extraction_ts timestamp"
    src, out = str(tmp_path / "src"), str(tmp_path / "status")
    t = datetime(2024, 4, 17, 3)

    def run(checkpoint):
        streams.stream_status(spark, streams.read_stream(spark, src, schema, max_files_per_trigger=1), out, str(tmp_path / checkpoint)).awaitTermination()

    for k in range(3):
        spark.createDataFrame([(i, k, t + timedelta(minutes=k)) for i in range(k, 5)], schema).coalesce(1).write.mode("append").parquet(src)
    run("a")
    want = {0: 0, 1: 1, 2: 2, 3: 2, 4: 2}
    assert {r.id: r.full for r in streams.read_status(spark, out).collect()} == want
    run("b")  # every batch again
    assert {r.id: r.full for r in streams.read_status(spark, out).collect()} == want
    version = streams.status_version(spark, out)
    for f in (tmp_path / "status" / "state" / f"v={version}").glob("part-*"):
        f.write_bytes(b"not a table")
        (f.parent / f".{f.name}.crc").unlink(missing_ok=True)
    spark.createDataFrame([(0, 9, t + timedelta(hours=1))], schema).coalesce(1).write.mode("append").parquet(src)
    with pytest.raises(Exception):
        run("a")
    assert streams.status_version(spark, out) == version  # nothing was published over it


def test_cached_scopes_are_apart(spark):
    outer = sq.remember_persisted(spark.range(3).persist())
    with sq.cached_scope():
        sq.remember_persisted(spark.range(4).persist())
    assert outer.storageLevel.useMemory
    sq.release_cached()
    assert not outer.storageLevel.useMemory


def test_ridge_per_key_is_batched(spark):
    import numpy as np
    rng = np.random.default_rng(0)
    rows = [(k, float(a), float(b), float(2 * a - b + k)) for k in range(4) for a, b in rng.normal(size=(20, 2))]
    df = spark.createDataFrame(rows + [(9, 1.0, 1.0, 3.0)], "k int, a double, b double, y double")
    got = {r.k: r for r in model.ridge_fit_per_key(df, "k", ["a", "b"], "y", alpha=1e-9).collect()}
    assert all(abs(got[k].w_a - 2) < 1e-6 and abs(got[k].w_b + 1) < 1e-6 and abs(got[k].intercept - k) < 1e-6 for k in range(4))
    assert got[9].intercept == pytest.approx(3.0)


def test_drop_shared_is_a_hash_aggregate(spark):
    df = spark.range(10).selectExpr("id % 7 as k", "id as a", "cast(id as double) b")
    plan = plan_text(clean.drop_shared(df, ["k"]))
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert sorted(r.k for r in clean.drop_shared(df, ["k"]).collect()) == [3, 4, 5, 6]
