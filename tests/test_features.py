"""Feature plans on station fixtures: rolling guard, lags, weather join,
unzoned stations, latest-row selection, day-of-week convention."""

import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from dockcast import schemas
from dockcast.plans import features as fp

T0 = datetime(2024, 4, 15, 0, 0, 0)  # a Monday


def snaps(station, n, *, start=T0, full=5, empty=5, step=10, null_at=None, zero_at=None):
    out = []
    for i in range(n):
        f, e = full + (i % 3), empty
        if zero_at is not None and i == zero_at:
            f, e = 0, 0
        if null_at is not None and i == null_at:
            f = None
        out.append((station, f, e, start + timedelta(minutes=step * i)))
    return out


@pytest.fixture(scope="module")
def inputs(spark):
    rows = snaps(1, 11) + snaps(2, 12) + snaps(3, 13) + snaps(4, 14, zero_at=5) + snaps(5, 14, null_at=2) \
        + snaps(6, 5) + snaps(7, 4, step=25) + snaps(8, 16)
    obs = spark.createDataFrame(rows, "id long, full long, empty long, extraction_ts timestamp")
    stations = spark.createDataFrame([(i, 1 if i != 6 else None) for i in range(1, 9)], "id int, weather_zone_id int")
    zones = spark.createDataFrame([(1, "TaiBei              ")], "id int, name string")
    hours = [T0 + timedelta(hours=h) for h in range(5)]
    wx = spark.createDataFrame(
        [(float(h), 0.5, float(10 + h), float(h) / 10, 2.0, "TaiBei", t) for h, t in enumerate(hours)]
        + [(0.0, 0.5, 10.0, 0.0, 2.0, "TaiBei", hours[0])],  # duplicate (datetime, zone)
        "temperature float, relative_humidity float, apparent_temperature float, precipitation float, "
        "wind_speed float, zone string, datetime timestamp")
    s = obs.withColumnRenamed("id", "station_id")
    zoned = fp._zoned(s, stations, zones)
    return fp.attach_weather(zoned, fp.weather_features(wx))


def _by(df, *cols):
    return {tuple(r[c] for c in cols[:2]): r for r in df.collect()}


def test_unzoned_station_dropped(inputs):
    assert inputs.filter("station_id = 6").count() == 0


def test_weather_deduped_and_joined(inputs):
    assert inputs.count() == 11 + 12 + 13 + 14 + 14 + 4 + 16
    r = inputs.filter((F.col("station_id") == 1) & (F.col("extraction_ts") == T0 + timedelta(minutes=70))).first()
    assert r.apparent_temperature == 11.0 and r["1h_fwd_apparent_temperature"] == 12.0


def test_rolling_guard_and_lag(inputs):
    f = fp.feature_matrix(inputs)
    rows = {(r.station_id, r.extraction_ts): r for r in f.collect()}
    assert all(rows[(1, T0 + timedelta(minutes=10 * i))][fp.ROLL_COL] is None for i in range(11))
    assert rows[(2, T0 + timedelta(minutes=110))][fp.ROLL_COL] is not None
    assert rows[(2, T0 + timedelta(minutes=100))][fp.ROLL_COL] is None
    # 0/0 occupancy → null, and it nulls the 12-row means that contain it
    assert rows[(4, T0 + timedelta(minutes=50))].pct_full is None
    assert rows[(4, T0 + timedelta(minutes=130))][fp.ROLL_COL] is None
    # lag is 3 rows back within the station
    r = rows[(3, T0 + timedelta(minutes=40))]
    assert math.isclose(r[fp.LAG_COL], rows[(3, T0 + timedelta(minutes=10))].pct_full)
    assert rows[(3, T0)][fp.LAG_COL] is None
    # Monday = 0
    assert rows[(1, T0)].day_of_week == 0


def test_prediction_features_schema_and_latest(inputs):
    p = fp.prediction_features(inputs)
    assert [f.name for f in p.schema.fields] == [f.name for f in schemas.FEATURES.fields]
    ts = {r.extraction_ts for r in p.collect()}
    assert len(ts) <= 1


def test_training_target(inputs):
    t = fp.training_features(inputs)
    r = t.filter("station_id = 8").orderBy("extraction_ts").first()
    assert r is not None
    assert math.isclose(r[fp.TARGET_CHANGE], r.pct_full - r[fp.TARGET_COL])


def test_dropped_stations_listed(inputs):
    p = fp.prediction_features(inputs)
    dropped = {r.station_id for r in fp.dropped_stations(inputs, p).collect()}
    kept = {r.station_id for r in p.collect()}
    assert dropped.isdisjoint(kept) and dropped | kept == {1, 2, 3, 4, 5, 7, 8}


def test_gap_stations_and_ffill(inputs):
    f = fp.feature_matrix(inputs)
    assert {r.station_id for r in fp.stations_with_gaps(f).collect()} == {4, 5}
    filled = fp.forward_fill_features(f, ["pct_full"])
    r = filled.filter((F.col("station_id") == 5) & (F.col("extraction_ts") == T0 + timedelta(minutes=20))).first()
    prev = f.filter((F.col("station_id") == 5) & (F.col("extraction_ts") == T0 + timedelta(minutes=10))).first()
    assert r.pct_full == prev.pct_full
