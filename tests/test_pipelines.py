"""End-to-end plans on small station/weather fixtures written to temp dirs:
weather readers, training/prediction inputs from a partitioned layer, new
stations with their zone, versioned upsert and insert-ignore sinks."""

from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from dockcast import schemas
from dockcast.functions import fixed_values as fv
from dockcast.plans import features as fp
from dockcast.plans.snapshot import new_stations
from dockcast.sources import readers, sinks

T0 = datetime(2024, 4, 15, 0, 0, 0)


@pytest.fixture(scope="module")
def dims(spark):
    zones = spark.createDataFrame([(i + 1, n, float(la), float(lo)) for i, (n, la, lo) in enumerate(fv.WEATHER_ZONES)],
                                  schemas.WEATHER_ZONE)
    stations = spark.createDataFrame(
        [(1, 25.04, 121.53, "TaiBeiShi", "a", "DaAnQu", 1, T0), (2, 22.64, 120.31, "GaoXiongShi", "b", "x", 9, T0),
         (3, 24.0, 121.0, "N/A", "c", "y", None, T0)], schemas.BIKE_STATION)
    return stations, zones


def test_read_weather_ns_long(spark, tmp_path):
    pdf = pd.DataFrame({"zone": ["TaiBei"], "temperature": [20.5],
                        "datetime": [pd.Timestamp("2024-04-15 03:00:00").value]})
    spark.createDataFrame(pdf).write.parquet(str(tmp_path / "wx"))
    w = readers.read_weather(spark, str(tmp_path / "wx")).first()
    assert w.datetime == datetime(2024, 4, 15, 3, 0, 0)


def test_read_weather_csv_dedupes_and_converts(spark, tmp_path):
    p = tmp_path / "w.csv"
    head = "datetime,lat,lng," + ",".join(schemas.WEATHER_VARS)
    row = "2024-04-15 08:00:00,25.05,121.54," + ",".join(["1.0"] * 9)
    p.write_text("\n".join([head, row, row]) + "\n")
    df = readers.read_weather_csv(spark, str(p))
    rows = df.collect()
    assert len(rows) == 1 and rows[0].datetime == datetime(2024, 4, 15, 0, 0, 0)  # 08:00 Taipei = 00:00 UTC


def test_new_stations_get_nearest_zone(spark, dims):
    stations, zones = dims
    snap = spark.createDataFrame(
        [(1, "a", 25.04, 121.53, "TaiBeiShi", "DaAnQu"), (7, "n", 22.98, 120.21, "TaiNanShi", "z"),
         (8, "m", 24.80, 120.98, "XinZhuShi", "z")],
        "id long, name string, lat double, lng double, city string, area string")
    got = {r.id: r.weather_zone_id for r in new_stations(snap, stations, zones, created_at="2024-04-15 00:00:00").collect()}
    names = {i + 1: n for i, (n, _, _) in enumerate(fv.WEATHER_ZONES)}
    assert {k: names[v] for k, v in got.items()} == {7: "TaiNan", 8: "XinZhu"}


def _clean_rows(n_stations, n_snaps):
    rows = []
    for s in range(n_snaps):
        t = T0 + timedelta(minutes=10 * s)
        for i in range(1, n_stations + 1):
            rows.append((i, f"s{i}", 25.0 + i / 100, 121.5, 20, 5 + (s + i) % 7, 15 - (s + i) % 7, 5, 0,
                         "TaiBeiShi", "DaAnQu", t - timedelta(minutes=1), t))
    return rows


def _weather(spark, hours):
    recs = []
    for z in ("TaiBei", "GaoXiong"):
        for h in range(hours):
            recs.append(tuple([float(h)] * 9) + (25.0, 121.5, z, T0 + timedelta(hours=h)))
    return spark.createDataFrame(recs, schemas.WEATHER_HOURLY)


def test_training_inputs_from_layer(spark, tmp_path, dims):
    stations, zones = dims
    path = str(tmp_path / "clean")
    sinks.write_layer(spark.createDataFrame(_clean_rows(3, 30), schemas.CLEAN_SNAPSHOT), path)
    layer = readers.read_snapshots(spark, path)
    wx = _weather(spark, 6)
    inp = fp.training_inputs(layer, stations, zones, wx, start="2024-04-15 01:00:00", end="2024-04-15 04:00:00")
    # station 3 has no zone → dropped; 18 snapshots in [01:00, 04:00) for stations 1 and 2
    assert inp.count() == 2 * 18
    r = inp.filter((F.col("station_id") == 1) & (F.col("extraction_ts") == T0 + timedelta(hours=2, minutes=10))).first()
    assert r.weather_zone == "TaiBei" and r.apparent_temperature == 2.0 and r["1h_fwd_apparent_temperature"] == 3.0
    feats = fp.training_features(inp)
    assert feats.count() > 0 and feats.filter(F.col(fp.ROLL_COL).isNull()).count() == 0


def test_prediction_inputs_and_features(spark, tmp_path, dims):
    stations, zones = dims
    path = str(tmp_path / "clean")
    sinks.write_layer(spark.createDataFrame(_clean_rows(3, 30), schemas.CLEAN_SNAPSHOT), path)
    layer = readers.read_snapshots(spark, path)
    newest = T0 + timedelta(minutes=290)
    status = spark.createDataFrame([(1, 6, 14, newest), (2, 7, 13, newest), (3, 8, 12, newest)],
                                   schemas.STATION_STATUS)
    inp = fp.prediction_inputs(status, layer, stations, zones, _weather(spark, 6))
    # 12 history rows in [newest-120min, newest) + the status row, zoned stations only
    assert inp.groupBy("station_id").count().orderBy("station_id").collect()[0]["count"] == 13
    p = fp.prediction_features(inp)
    rows = p.collect()
    assert {r.station_id for r in rows} == {1, 2} and all(r.extraction_ts == newest for r in rows)


def test_upsert_and_insert_ignore_versions(spark, tmp_path):
    base = str(tmp_path / "status")
    v0 = sinks.write_version(spark.createDataFrame([(1, 5), (2, 6)], "id int, full int"), base, 0)
    v1 = sinks.upsert_version(spark, v0, spark.createDataFrame([(2, 9), (3, 1)], "id int, full int"), ["id"], base, 1)
    assert sorted(tuple(r) for r in spark.read.parquet(v1).collect()) == [(1, 5), (2, 9), (3, 1)]
    fc = str(tmp_path / "fc")
    spark.createDataFrame([(1, 0)], "station_id int, relative_ts int").write.parquet(fc)
    n = sinks.insert_ignore_append(spark, fc, spark.createDataFrame([(1, 0), (1, 1)], "station_id int, relative_ts int"),
                                   ["station_id", "relative_ts"])
    assert n == 1 and spark.read.parquet(fc).count() == 2


def test_dimension_broadcast_only_within_checked_bound(spark):
    from dockcast.operators import joins
    from dockcast.session import plan_text
    facts = spark.range(5000).withColumn("k", F.col("id") % 100)
    dim = spark.range(100).withColumnRenamed("id", "k").withColumn("name", F.lit("x"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # only our hint can broadcast
    try:
        small = plan_text(joins.lookup_join(facts, dim, "k", max_broadcast_rows=100), "simple")
        big = plan_text(joins.lookup_join(facts, dim, "k", max_broadcast_rows=99), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in small
    assert "BroadcastHashJoin" not in big and "SortMergeJoin" in big
