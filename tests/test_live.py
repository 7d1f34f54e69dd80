"""Streams that stop and go on, and stored layers, on small folders."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from dockcast import schemas
from dockcast.operators import serve
from dockcast.plans.snapshot import clean_snapshot, reprocess_range
from dockcast.session import plan_text
from dockcast.sources import files, readers, sinks, sync
from dockcast.streaming import streams

T0 = datetime(2024, 4, 17, 3)


def raw(times, ids=range(3), city="台北市"):
    return [(i, f"s{i}", 2, 20, 5 + i % 3, 10, 0, 5 + i % 3, 0, city, "大安區", 25.0 + i / 1000, 121.5, None, "a", 1, t - timedelta(minutes=1), t) for t in times for i in ids]


def land(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def test_window_stream_goes_on_after_a_restart(spark, tmp_path):
    """State and watermark outlive the query; a window is written once."""
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    schema = "k long, ts timestamp, v double"

    def run():
        s = streams.stream_occupancy_window(streams.read_stream(spark, src, schema), "k", "ts", "v", delay="10 minutes", length="20 minutes", slide="20 minutes")
        streams.to_files(s, out, ck).start().awaitTermination()

    at = lambda m: T0 + timedelta(minutes=m)
    land(spark, src, [(1, at(1), 1.0), (1, at(15), 3.0)], schema)
    run()
    assert spark.read.parquet(out).count() == 0 if os.listdir(out) != ["_spark_metadata"] else True
    land(spark, src, [(1, at(19), 5.0), (1, at(31), 7.0)], schema)  # the first window's third value; the watermark passes its end
    run()
    land(spark, src, [(1, at(5), 100.0), (1, at(70), 9.0)], schema)  # late: its window is closed
    run()
    run()  # nothing new
    assert sorted((r.w, r.v) for r in spark.read.parquet(out).collect()) == [(at(0), 3.0), (at(20), 7.0)]


def test_streamed_layer_takes_batch_jobs(spark, tmp_path):
    """One layout: a batch job appends to a streamed layer, and re-processing works on it."""
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    land(spark, src, raw([T0]), schemas.RAW_SNAPSHOT)
    streams.stream_clean(spark, src, out, ck, schema=schemas.RAW_SNAPSHOT, clean_fn=clean_snapshot).awaitTermination()
    sinks.write_layer(clean_snapshot(spark.createDataFrame(raw([T0 + timedelta(days=1)]), schemas.RAW_SNAPSHOT)), out)
    layer = spark.read.schema(schemas.CLEAN_SNAPSHOT).parquet(out)
    assert layer.count() == 6 and set(files.children(spark, out)) >= {"extraction_date=2024-04-17", "extraction_date=2024-04-18"}
    raw_path = str(tmp_path / "raw")
    sinks.write_layer(spark.createDataFrame(raw([T0, T0 + timedelta(days=1)], range(2)), schemas.RAW_SNAPSHOT), raw_path)
    reprocess_range(spark, raw_path, out, T0 - timedelta(hours=1), T0 + timedelta(days=1))
    assert spark.read.schema(schemas.CLEAN_SNAPSHOT).parquet(out).count() == 4


def test_broken_append_is_completed_once(spark, tmp_path):
    """A batch of which only a part was written before the crash."""
    out = str(tmp_path / "layer")
    df = spark.createDataFrame(raw([T0, T0, T0 + timedelta(days=1)]), schemas.RAW_SNAPSHOT)  # repeated rows stay repeated
    sinks.append_once(df.limit(4), out, 7, again=False)
    sinks.append_once(spark.createDataFrame(raw([T0]), schemas.RAW_SNAPSHOT), out, 6, again=False)
    sinks.append_once(df, out, 7)
    assert spark.read.schema(schemas.RAW_SNAPSHOT).parquet(out).count() == 12
    assert sinks.last_batch(spark, out) == 7


def test_reprocessing_removes_dates_left_empty(spark, tmp_path):
    raw_path, out = str(tmp_path / "raw"), str(tmp_path / "clean")
    days = [T0, T0 + timedelta(days=1), T0 + timedelta(days=5)]
    sinks.write_layer(clean_snapshot(spark.createDataFrame(raw(days), schemas.RAW_SNAPSHOT)), out)
    rows = raw(days[:1]) + raw(days[1:2], city=None) + raw(days[2:], city=None)
    sinks.write_layer(spark.createDataFrame(rows, schemas.RAW_SNAPSHOT), raw_path)
    reprocess_range(spark, raw_path, out, T0 - timedelta(hours=1), days[1] + timedelta(hours=1))
    left = readers.read_snapshots(spark, out)
    assert sorted(r[0] for r in left.select("extraction_ts").distinct().collect()) == [days[0], days[2]]  # beyond the range: untouched
    assert left.count() == 6


def test_status_writes_do_not_grow_with_the_table(spark, tmp_path):
    """A batch of one station costs the same beside ten and beside thousands of stations."""
    sizes, schema = [], "id long, full long, extraction_ts timestamp"
    for n in (10, 20_000):
        src, out, ck = (str(tmp_path / f"{x}{n}") for x in ("src", "out", "ck"))
        spark.range(n).select("id", F.lit(1).cast("long").alias("full"), F.lit(T0).alias("extraction_ts")).write.parquet(src)

        def run():
            streams.stream_status(spark, streams.read_stream(spark, src, schema), out, ck).awaitTermination()
        run()
        before = files.bytes_under(spark, out)
        land(spark, src, [(3, 9, T0 + timedelta(hours=1)), (4, 9, T0 - timedelta(hours=1))], schema)
        run()
        sizes.append(files.bytes_under(spark, out) - before)
        got = {r.id: r.full for r in streams.read_status(spark, out).filter("id < 10").collect()}
        assert got == {i: 9 if i == 3 else 1 for i in range(10)}
    assert sizes[1] <= 1.2 * sizes[0]


def test_status_log_is_merged_and_pruned(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    schema = "id long, full long, extraction_ts timestamp"
    for k in range(6):
        land(spark, src, [(i, k, T0 + timedelta(minutes=k)) for i in range(k, 8)], schema)
    streams.stream_status(spark, streams.read_stream(spark, src, schema, max_files_per_trigger=1), out, ck, compact_bytes=0).awaitTermination()
    assert {r.id: r.full for r in streams.read_status(spark, out).collect()} == {i: min(i, 5) for i in range(8)}
    assert len(files.folders(spark, f"{out}/state", "v")) <= 2 and len(files.folders(spark, f"{out}/log", "n")) <= 4


def test_closed_windows_keep_panes_not_windows(spark, tmp_path):
    schema = "k string, ts timestamp, v double"
    rng = random.Random(5)
    day = timedelta(days=1)
    sent = []
    for d in range(4):  # each delivery brings late rows, some around the watermark of the one before
        times = [T0 + d * day + timedelta(seconds=rng.randrange(86400)) for _ in range(60)]
        if d:
            times += [T0 + (d - 1) * day + timedelta(minutes=rng.randrange(-200, 200), seconds=rng.choice([0, 0, 7])) for _ in range(60)]
        sent.append([(rng.choice(["a", "b", "", None]), t, rng.choice([None, 1.5, 2.0, float(d)])) for t in times] + [(None, None, 1.0), ("a", T0 + d * day + day, None)])

    def closed(name, **kw):
        src, out, ck = (str(tmp_path / f"{name}-{x}") for x in ("src", "out", "ck"))
        for rows in sent:
            land(spark, src, rows, schema)
            s = streams.stream_occupancy_window(streams.read_stream(spark, src, schema), "k", "ts", "v", delay="1 day", **kw)
            q = streams.to_files(s, out, ck).start()
            q.awaitTermination()
        rows = spark.read.parquet(out)
        return rows.dtypes, sorted(map(repr, rows.select("k", "w", "w_end", F.round("v", 9)).collect())), q.lastProgress["stateOperators"][0]["numRowsTotal"]
    kinds, want, held = closed("windows")
    got_kinds, got, buckets = closed("panes", append=True)
    assert got_kinds == kinds and got == want and len(want) > 1000
    assert buckets <= 4 and held > 100 * buckets  # a row of state for each bucket of keys


def test_closed_windows_of_whole_numbers(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    big = (1 << 60) + 1
    rows = [(k, T0 + timedelta(minutes=m), 1.0) for k in (big, big + 1, None, -1) for m in (0, 9, 10)] + [(7, T0 + timedelta(hours=9), 1.0)]
    land(spark, src, rows, "k long, ts timestamp, v double")
    s = streams.stream_occupancy_window(streams.read_stream(spark, src, "k long, ts timestamp, v double"), "k", "ts", "v", delay="0 seconds", length="20 minutes", append=True)
    streams.to_files(s, out, ck).start().awaitTermination()
    got = {(r.k, (r.w - T0).total_seconds() / 60) for r in spark.read.parquet(out).collect()}
    assert got == {(k, m) for k in (big, big + 1, None, -1) for m in (-10, 0, 10)}
    with pytest.raises(ValueError, match="multiple"):
        streams.stream_occupancy_window(streams.read_stream(spark, src, "k long, ts timestamp, v double"), "k", "ts", "v", length="25 minutes", append=True)


def test_csv_folder_of_differing_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,full,empty,updated_at,extraction_ts\n1,5,15,1713315600,2024-04-17 01:00:00\nx,5,15,1713315600,2024-04-17 01:00:00\n\n7,5\n")
    (tmp_path / "b.csv").write_text('﻿id,empty,full,"extraction_ts",updated_at,id,more\n1,15,5,2024-04-17 01:00:00,1713315600,99,"a,b"\n')
    (tmp_path / "c.csv").write_text("")
    rows = [(r.id, r.full, r.empty, r.last_update_ts, r.name) for r in readers.read_snapshot_csv(spark, str(tmp_path)).collect()]
    good = (1, 5, 15, datetime(2024, 4, 17, 1), None)
    assert rows.count(good) == 2 and len(rows) == 4
    assert sorted((os.path.basename(r.file), r.line) for r in readers.snapshot_csv_rejects(spark, str(tmp_path)).collect()) == [("a.csv", "7,5"), ("a.csv", "x,5,15,1713315600,2024-04-17 01:00:00")]
    (tmp_path / "d.csv").write_text("id,full\n4,4\n")
    with pytest.raises(ValueError, match="d.csv"):
        readers.read_snapshot_csv(spark, str(tmp_path))
    assert readers.read_snapshot_csv(spark, str(tmp_path), pulled_at=T0).filter("id = 4").first().extraction_ts == T0


def test_csv_lines_are_parsed_once_and_stay_in_place(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿id,full,extraction_ts\n" + "".join(f"{i},5,2024-04-17 01:00:00\n" for i in range(40)) + "﻿id,full,extraction_ts\n")
    (tmp_path / "b.csv").write_text("full,id,extraction_ts\n\n" + "".join(f"6,{i},2024-04-17 01:00:00\n" for i in range(40, 60)))
    (tmp_path / "c.csv").write_text("full,id\n")  # no line lacks its time
    back = readers.read_snapshot_csv(spark, str(tmp_path))
    assert {(r.id, r.full) for r in back.collect()} == {(i, 5 if i < 40 else 6) for i in range(60)}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a folder of any size
    try:
        plan = plan_text(readers.read_snapshot_csv(spark, str(tmp_path)), "extended").split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan[0].count("from_csv(") + plan[0].count("csvtostructs(") == 3  # one for each header, whatever is taken of a line
    assert "SortMergeJoin" not in plan[1] and "SortAggregate" not in plan[1]


def test_sync_copies_newest_first_and_once(spark, tmp_path):
    remote, layer = str(tmp_path / "remote"), str(tmp_path / "layer")
    schema = "id long, extraction_ts timestamp"
    for k in range(5):
        spark.createDataFrame([(k, T0 + timedelta(days=k))], schema).coalesce(1).write.parquet(f"{remote}/run_{k}")

    def run(**kw):
        return sync.sync_missing(spark, remote, layer, schema=schema, pattern="*.parquet", **kw)

    def ids():
        return sorted(r.id for r in spark.read.schema(schema).parquet(layer).collect())
    assert run(limit=2) == 2 and ids() == [3, 4]
    assert run(block_files=2) == 3 and ids() == [0, 1, 2, 3, 4]
    assert run() == 0 and ids() == [0, 1, 2, 3, 4]
    spark.createDataFrame([(9, T0)], schema).coalesce(1).write.parquet(f"{remote}/run_9")
    boom = lambda paths: (_ for _ in ()).throw(OSError("lost"))
    with pytest.raises(OSError):
        run(read=boom)
    spark.createDataFrame([(10, T0)], schema).coalesce(1).write.parquet(f"{remote}/run_a")
    assert run() == 2 and ids() == [0, 1, 2, 3, 4, 9, 10]  # the broken block first, then the new file
    assert sync.missing_files(spark, remote, layer, "*.parquet").count() == 0


def test_history_of_differing_files(spark, tmp_path):
    path = str(tmp_path / "h")
    spark.createDataFrame([(1, 1.5)], "a int, b float").coalesce(1).write.parquet(f"{path}/x")
    spark.createDataFrame([(1 << 40, "t", T0.date())], "a long, b string, d date").coalesce(1).write.parquet(f"{path}/y")
    spark.createDataFrame([(T0,)], "d timestamp").coalesce(1).write.parquet(f"{path}/z")
    (tmp_path / "h" / "bad.parquet").write_bytes(b"PAR1 this is no table PAR1")
    (tmp_path / "h" / "short.parquet").write_bytes(b"x")
    rows, bad = sync.read_history(spark, path)
    assert dict(rows.dtypes) == {"a": "bigint", "b": "string", "d": "timestamp"}
    assert sorted(map(repr, (tuple(r) for r in rows.collect()))) == sorted(map(repr, [(1, "1.5", None), (1 << 40, "t", datetime(2024, 4, 17)), (None, None, T0)]))
    assert {r.file for r in bad.collect()} == {"bad.parquet", "short.parquet"}


def test_upsert_rewrites_touched_parts_only(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "id long, v string"
    base = spark.range(1000).select("id", F.lit("old").alias("v"))
    sinks.write_keyed(base, path, ["id"], 32)
    stamp = lambda: {n: sorted(os.listdir(f"{path}/{n}")) for n in os.listdir(path) if n.startswith(sinks.PART)}
    before = stamp()
    new = spark.createDataFrame([(5, "new"), (5000, "new"), (5, "a")], schema)
    touched = sinks.upsert_parts(spark, path, new, ["id"], schema, 32)
    after = stamp()
    assert {n for n in after if after[n] != before.get(n)} == {f"{sinks.PART}={k}" for k in touched} and len(touched) <= 2
    want = {tuple(r) for r in serve.upsert(base, new, ["id"]).collect()}
    assert {tuple(r) for r in sinks.read_keyed(spark, path, schema).collect()} == want and (5, "new") in want
    assert sinks.upsert_parts(spark, path, new.limit(0), ["id"], schema, 32) == []
