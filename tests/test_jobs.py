"""The user-level jobs end to end on temp-dir tables: ingest a CSV pull,
land a weather report, retrain, serve forecasts twice (second time from
the table), register new stations."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from dockcast import schemas
from dockcast.functions import fixed_values as fv
from dockcast.operators import model
from dockcast.plans import jobs
from dockcast.sources import readers

T0 = datetime(2024, 4, 15, 0, 0, 0)
EPOCH0 = int((T0 - datetime(1970, 1, 1)).total_seconds())


def _csv(path, snaps, stations=4):
    lines = ["id,name,type,space,full,empty,bike_yb1,bike_yb2,bike_eyb,city,area,lat,lng,place_id,address,"
             "is_open,updated_at,extraction_ts"]
    for s in range(snaps):
        t = T0 + timedelta(minutes=10 * s)
        for i in range(1, stations + 1):
            full = 3 + (s * i) % 9
            lines.append(f"{i},st{i},2,20,{full},{20 - full},0,{full},0,台北市,大安區,{25.0 + i / 100},121.5,,a,1,"
                         f"{EPOCH0 + 600 * s - 30},{t:%Y-%m-%d %H:%M:%S}")
    path.write_text("\n".join(lines) + "\n")


def test_jobs_end_to_end(spark, tmp_path):
    csv = tmp_path / "pull.csv"
    _csv(csv, 48)
    raw, clean = str(tmp_path / "raw"), str(tmp_path / "clean")
    rows = jobs.ingest_snapshot_csv(spark, str(csv), raw, clean, as_of="2024-04-15 12:00:00")
    assert rows.count() == 4 * 48
    assert readers.read_snapshots(spark, raw).count() == 4 * 48

    hours = 10
    landing = spark.createDataFrame(
        [(la, lo, EPOCH0, EPOCH0 + hours * 3600, 3600) + tuple([[float(h) for h in range(hours)]] * 9)
         for _, la, lo in fv.WEATHER_ZONES], schemas.WEATHER_LANDING)
    wx_path = str(tmp_path / "weather")
    jobs.land_weather(spark, landing, wx_path)
    weather = spark.read.parquet(wx_path).drop(readers.DATE_PART)
    assert weather.count() == 10 * hours

    zones = spark.createDataFrame([(i + 1, n, float(la), float(lo)) for i, (n, la, lo) in enumerate(fv.WEATHER_ZONES)],
                                  schemas.WEATHER_ZONE)
    stations = spark.createDataFrame([(i, 25.0, 121.5, "TaiBeiShi", f"st{i}", "DaAnQu", 1, T0) for i in (1, 2, 3)],
                                     schemas.BIKE_STATION)
    layer = readers.read_snapshots(spark, clean)
    res = jobs.retrain(spark, layer, stations, zones, weather, start="2024-04-15 00:00:00",
                       end="2024-04-15 08:00:00", model_path=str(tmp_path / "model"), split="2024-04-15 06:00:00")
    assert res.n_train > 0 and res.r2_test is not None
    assert model.RidgeModel.load(spark, str(tmp_path / "model")).features == schemas.FEATURE_COLUMNS

    newest = T0 + timedelta(minutes=470)
    status = spark.createDataFrame([(i, 5, 15, newest) for i in (1, 2, 3)], schemas.STATION_STATUS)
    req = spark.createDataFrame([(1,), (2,)], "station_id int")
    fc = str(tmp_path / "forecasts")
    kw = dict(model_path=str(tmp_path / "model"), forecasts_path=fc, as_of=newest + timedelta(minutes=1))
    first = jobs.forecast(spark, req, status, layer, stations, zones, weather, **kw)
    assert [(r.station_id, r.relative_ts) for r in first.collect()] == [(1, 0), (1, 1), (2, 0), (2, 1)]
    again = jobs.forecast(spark, req, status, layer, stations, zones, weather, **kw)
    assert again.count() == 4 and spark.read.parquet(fc).count() == 4  # fresh: nothing new inserted

    st_path = str(tmp_path / "stations")
    stations.write.parquet(st_path)
    n = jobs.register_new_stations(spark, rows, spark.read.parquet(st_path), zones, st_path, created_at="2024-04-15 12:00:00")
    assert n == 1
    new = spark.read.parquet(st_path).filter(F.col("id") == 4).first()
    assert new.weather_zone_id == 1  # TaiBei


def test_stream_forecasts_from_status_batches(spark, tmp_path):
    from dockcast.streaming import streams
    csv = tmp_path / "pull.csv"
    _csv(csv, 48)
    raw, clean = str(tmp_path / "raw"), str(tmp_path / "clean")
    jobs.ingest_snapshot_csv(spark, str(csv), raw, clean, as_of="2024-04-15 12:00:00")
    hours = 10
    landing = spark.createDataFrame(
        [(la, lo, EPOCH0, EPOCH0 + hours * 3600, 3600) + tuple([[float(h) for h in range(hours)]] * 9)
         for _, la, lo in fv.WEATHER_ZONES], schemas.WEATHER_LANDING)
    weather = jobs.land_weather(spark, landing, str(tmp_path / "weather"))
    zones = spark.createDataFrame([(i + 1, n, float(la), float(lo)) for i, (n, la, lo) in enumerate(fv.WEATHER_ZONES)],
                                  schemas.WEATHER_ZONE)
    stations = spark.createDataFrame([(i, 25.0, 121.5, "TaiBeiShi", f"st{i}", "DaAnQu", 1, T0) for i in (1, 2, 3)],
                                     schemas.BIKE_STATION)
    layer = readers.read_snapshots(spark, clean)
    jobs.retrain(spark, layer, stations, zones, weather, start="2024-04-15 00:00:00", end="2024-04-15 08:00:00",
                 model_path=str(tmp_path / "model"))
    src = str(tmp_path / "status_in")
    newest = T0 + timedelta(minutes=470)
    spark.createDataFrame([(i, 5, 15, newest) for i in (1, 2, 3)], schemas.STATION_STATUS).write.parquet(src)
    q = streams.stream_forecasts(spark, streams.read_stream(spark, src, schemas.STATION_STATUS),
                                 clean_layer=layer, stations=stations, zones=zones, weather_latest=weather,
                                 model_path=str(tmp_path / "model"), forecasts_path=str(tmp_path / "fc"),
                                 checkpoint=str(tmp_path / "ck"))
    q.awaitTermination()
    fc = spark.read.parquet(str(tmp_path / "fc"))
    assert sorted({r.station_id for r in fc.collect()}) == [1, 2, 3]
    assert fc.count() == 6
