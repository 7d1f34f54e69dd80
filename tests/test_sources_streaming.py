"""Sources and sinks (temp-dir round trips), nearest zone (grid = broadcast
= brute force), streaming queries against their batch twins."""

import math
import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from conftest import SF01
from dockcast import schemas
from dockcast.operators import joins
from dockcast.plans import serving
from dockcast.plans.snapshot import clean_snapshot, reprocess_range
from dockcast.sources import readers, sinks
from dockcast.streaming import streams


def _raw_rows(n_stations, ts_list):
    rows = []
    for t in ts_list:
        for i in range(n_stations):
            rows.append((i, f"s{i}", 2, 20, 5 + i % 3, 10, 0, 5 + i % 3, 0, "台北市", "大安區",
                         25.0 + i / 1000, 121.5, None, "a", 1, t - timedelta(minutes=1), t))
    return rows


def test_layer_roundtrip_and_pruning(spark, tmp_path):
    ts = [datetime(2024, 4, d, 3, 0) for d in (10, 11, 12)]
    df = spark.createDataFrame(_raw_rows(4, ts), schemas.RAW_SNAPSHOT)
    path = str(tmp_path / "raw")
    sinks.write_layer(df, path)
    back = readers.read_snapshots(spark, path)
    sel = readers.scan_time_range(back, "extraction_ts", "2024-04-11 00:00:00", "2024-04-12 00:00:00")
    assert sel.count() == 4
    from dockcast.session import plan_text
    assert "PartitionFilters: [isnotnull(extraction_date" in plan_text(sel)
    # re-process (oldest, newest] into a clean layer with dynamic overwrite
    clean_path = str(tmp_path / "clean")
    reprocess_range(spark, path, clean_path, "2024-04-10 03:00:00", "2024-04-12 03:00:00")
    c = readers.read_snapshots(spark, clean_path)
    assert c.count() == 8
    assert {r.extraction_ts for r in c.select("extraction_ts").distinct().collect()} == set(ts[1:])
    reprocess_range(spark, path, clean_path, "2024-04-09 00:00:00", "2024-04-12 03:00:00")
    assert readers.read_snapshots(spark, clean_path).count() == 12


def test_latest_file_and_run_ts(spark, tmp_path):
    for stamp in ("2024-04-17_09:01:29", "2024-04-17_09:11:29"):
        spark.range(3).withColumn("v", F.lit(stamp)).write.parquet(str(tmp_path / f"snap_{stamp}"))
    df = spark.read.parquet(*[str(tmp_path / p) for p in sorted(os.listdir(tmp_path))])
    latest = readers.scan_latest_file(df)
    assert {r.v for r in latest.collect()} == {"2024-04-17_09:11:29"}
    ts = df.select(readers.run_ts_from_path().alias("t")).distinct().collect()
    assert {r.t for r in ts} == {datetime(2024, 4, 17, 9, 1, 29), datetime(2024, 4, 17, 9, 11, 29)}


def test_latest_file_of_a_partitioned_layer(spark, tmp_path):
    path = str(tmp_path / "layer")
    for ts in (datetime(2024, 4, 10, 3), datetime(2024, 4, 11, 3)):
        sinks.write_layer(spark.createDataFrame(_raw_rows(4, [ts]), schemas.RAW_SNAPSHOT).coalesce(1), path)
    df = readers.read_snapshots(spark, path)
    newest = df.agg(F.max("_metadata.file_path")).first()[0]
    want = sorted(map(repr, df.filter(F.col("_metadata.file_path") == newest).collect()))
    latest = readers.scan_latest_file(df)
    assert latest.columns == df.columns and sorted(map(repr, latest.collect())) == want
    assert {str(r[0]) for r in latest.select("extraction_date").collect()} == {"2024-04-11"}
    one = max(r.id for r in latest.collect())
    assert [tuple(r) for r in readers.scan_latest_file(df.filter(F.col("id") == one).select("id")).collect()] == [(one,)]


def test_csv_source_normalises(spark, tmp_path):
    p = tmp_path / "s.csv"
    p.write_text("id,name,type,space,full,empty,bike_yb1,bike_yb2,bike_eyb,city,area,lat,lng,place_id,address,"
                 "is_open,updated_at,extraction_ts\n"
                 "1,a,2,20,5,15,0,5,0,台北市,大安區,25.0,121.5,,x,1,1713315600,2024-04-17 01:00:00.789\n")
    df = readers.read_snapshot_csv(spark, str(p))
    r = df.first()
    assert r.last_update_ts == datetime(2024, 4, 17, 1, 0, 0)
    assert r.extraction_ts == datetime(2024, 4, 17, 1, 0, 0)
    assert "updated_at" not in df.columns
    schemas.check_schema(df, schemas.RAW_SNAPSHOT)


def test_weather_report_explode(spark):
    landing = spark.createDataFrame(
        [(25.05, 121.54, 1713312000, 1713312000 + 3 * 3600, 3600) + tuple([[1.0, 2.0, 3.0]] * 9)],
        schemas.WEATHER_LANDING)
    rows = serving.weather_report(landing).orderBy("datetime").collect()
    assert [r.temperature for r in rows] == [1.0, 2.0, 3.0]
    assert rows[0].zone == "TaiBei"
    assert rows[1].datetime - rows[0].datetime == timedelta(hours=1)


def test_missing_keys_newest_first(spark):
    a = spark.createDataFrame([(k,) for k in ["k1", "k2", "k3", "k4"]], "key string")
    b = spark.createDataFrame([("k2",)], "key string")
    assert [r.key for r in readers.missing_keys(a, b, "key", limit=2).collect()] == ["k4", "k3"]


def test_nearest_zone_grid_equals_broadcast(spark):
    emb = spark.read.parquet(f"{SF01}/embeddings.parquet")
    p = emb.select("vec_id", F.element_at("embedding", 1).cast("double").alias("x"),
                   F.element_at("embedding", 2).cast("double").alias("y"))
    zones = p.filter(F.col("vec_id") < 60)
    a = joins.nearest_zone(p, zones, point_id="vec_id", px="x", py="y", zone_id="vec_id", zx="x", zy="y")
    b = joins.nearest_zone(p, zones, point_id="vec_id", px="x", py="y", zone_id="vec_id", zx="x", zy="y",
                           max_literal_zones=5)
    pts = [(r.vec_id, r.x, r.y) for r in p.collect()]
    zs = [t for t in pts if t[0] < 60]
    want = {i: min(zs, key=lambda z: (math.hypot(x - z[1], y - z[2]), z[0]))[0] for i, x, y in pts}
    assert {r.vec_id: r.zone for r in a.collect()} == want
    assert {r.vec_id: r.zone for r in b.collect()} == want


def test_stream_window_equals_batch(spark, tmp_path):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    src = str(tmp_path / "src")
    ev.repartition(4).write.parquet(src)
    stream = streams.read_stream(spark, src, ev.schema, max_files_per_trigger=1)
    q = (streams.stream_occupancy_window(stream, "user_id", "ts", "value")
         .writeStream.outputMode("complete").format("memory").queryName("occ_win")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.sql("select user_id, cast(w as timestamp_ntz) w, round(v, 9) v from occ_win")
    want = streams.occupancy_windows(ev, "user_id", "ts", "value").select("user_id", "w", F.round("v", 9).alias("v"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_stream_clean_appends_layer(spark, tmp_path):
    ts = [datetime(2024, 4, 17, 3, 0), datetime(2024, 4, 17, 3, 10)]
    raw = str(tmp_path / "raw")
    for t in ts:
        spark.createDataFrame(_raw_rows(3, [t]), schemas.RAW_SNAPSHOT).write.mode("append").parquet(raw)
    out = str(tmp_path / "clean")
    q = streams.stream_clean(spark, raw, out, str(tmp_path / "ckpt"), schema=schemas.RAW_SNAPSHOT,
                             clean_fn=lambda d: clean_snapshot(d, as_of="2024-04-17 04:00:00"))
    q.awaitTermination()
    assert spark.read.parquet(out).count() == 6


def test_stream_staleness_drops_duplicates(spark, tmp_path):
    t = datetime(2024, 4, 17, 3, 0)
    rows = _raw_rows(2, [t]) * 2
    src = str(tmp_path / "dups")
    spark.createDataFrame(rows, schemas.RAW_SNAPSHOT).write.parquet(src)
    s = streams.stream_staleness(streams.read_stream(spark, src, schemas.RAW_SNAPSHOT), "extraction_ts",
                                 schemas.DUPLICATE_SUBSET)
    q = s.writeStream.format("memory").queryName("dedup").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.sql("select * from dedup").count() == 2


def test_stream_status_upserts(spark, tmp_path):
    t1, t2 = datetime(2024, 4, 17, 3, 0), datetime(2024, 4, 17, 3, 10)
    src = str(tmp_path / "snaps")
    schema = "id long, full long, empty long, extraction_ts timestamp"
    spark.createDataFrame([(1, 5, 5, t1), (2, 1, 9, t1), (1, 6, 4, t2)], schema).write.parquet(src)
    # a later file carrying an older snapshot of station 1 must not win
    spark.createDataFrame([(1, 0, 10, t1)], schema).write.mode("append").parquet(src)
    st = streams.read_stream(spark, src, schema, max_files_per_trigger=1)
    out = str(tmp_path / "status")
    q = streams.stream_status(spark, st, out, str(tmp_path / "ck"))
    q.awaitTermination()
    got = {r.id: (r.full, r.empty) for r in streams.read_status(spark, out).collect()}
    assert got == {1: (6, 4), 2: (1, 9)}


def test_stream_window_append_emits_closed_windows(spark, tmp_path):
    """Append mode: after the data and the following no-data batch, exactly
    the batch twin's windows that end at or before max(ts) − 8 days."""
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    src = str(tmp_path / "src")
    ev.write.parquet(src)
    stream = streams.read_stream(spark, src, ev.schema)
    q = (streams.stream_occupancy_window(stream, "user_id", "ts", "value", delay="8 days")
         .writeStream.outputMode("append").format("memory").queryName("occ_append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.sql("select user_id, cast(w as timestamp_ntz) w, round(v, 9) v from occ_append")
    limit = ev.agg(F.max("ts")).first()[0] - timedelta(days=8)
    want = (streams.occupancy_windows(ev, "user_id", "ts", "value")
            .filter(F.col("w") + F.expr("INTERVAL 120 MINUTES") <= F.lit(limit))
            .select("user_id", "w", F.round("v", 9).alias("v")))
    assert want.count() == 80_312
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_stream_clean_watermarked_split_snapshots(spark, tmp_path):
    """Snapshots split over several files (micro-batches) give the same clean
    rows as the batch clean, for every snapshot the watermark has passed."""
    snaps = [datetime(2024, 4, 17, 3, 0) + timedelta(hours=2 * k) for k in range(3)]
    src = str(tmp_path / "src")
    all_rows = []
    for t in snaps:
        rows = _raw_rows(6, [t])
        rows.append(rows[0][:1] + ("zz",) + rows[0][2:])            # exact duplicate on the subset, other name
        rows.append((99,) + rows[1][1:])                             # second id at station 1's position
        all_rows += rows
        for part in (rows[: len(rows) // 2], rows[len(rows) // 2:]):
            spark.createDataFrame(part, schemas.RAW_SNAPSHOT).write.mode("append").parquet(src)
    stream = streams.read_stream(spark, src, schemas.RAW_SNAPSHOT, max_files_per_trigger=1)
    q = (streams.stream_clean_watermarked(stream, delay="1 hour")
         .writeStream.outputMode("append").format("memory").queryName("clean_wm")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.sql("select * from clean_wm")
    batch = clean_snapshot(spark.createDataFrame(all_rows, schemas.RAW_SNAPSHOT))
    want = batch.filter(F.col("extraction_ts") <= F.lit(snaps[1]))  # the last snapshot is not closed yet
    assert want.count() == 2 * 5
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
