"""Streams and stored layers on the driver's tables: every query here writes
files and reads them back, so what it returns went through a real stream or
sink. Folders are fresh ones in the checkpoint folder.

Streams are fed in deliveries: a delivery lands as files, the query runs to
its end (``availableNow``) and stops; the next delivery restarts it from its
checkpoint. Some rows are delivered late, some twice (fixed rules on the row's
id), so watermarks drop rows, and the SQL states which: a delivery's watermark
is the greatest event time of earlier deliveries (to the millisecond) less the
delay.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dockcast import schemas
from dockcast.operators import model, setops
from dockcast.plans import bindings, catalog, features as fp, snapshot
from dockcast.session import cut_lineage, ensure_checkpoint_dir
from dockcast.sources import readers, sinks, sync
from dockcast.streaming import streams

DELIVERIES = 4


def folder(spark: SparkSession, name: str) -> str:
    """A fresh folder of the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/live-{name}-{uuid.uuid4().hex}"


def delivered(df: DataFrame, number: Column, path: str, run: Callable[[], object]) -> None:
    """Land the rows of ``df`` in deliveries by ``number`` (0 to 3), and run the stream after each."""
    rows = df.withColumn("_b", number)
    for i in range(DELIVERIES):
        rows.filter(F.col("_b") == i).drop("_b", "b").write.mode("append").parquet(path)
        run()


def _late(id: str) -> Column:
    return F.when(F.col(id) % 37 == 0, 3).when(F.col(id) % 10 == 0, 1).otherwise(0)


def _event_delivery() -> Column:
    return F.least(F.lit(DELIVERIES - 1), (F.floor((F.dayofmonth("ts") - 1) / 8) + _late("event_id")).cast("int"))


def q_stream_occupancy_closed(spark, sf_dir):
    """Sliding means of the windows that the last watermark has closed, as the
    append-mode stream wrote them."""
    e = readers.read_table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    src, out, ck = (folder(spark, x) for x in ("events", "windows", "ck"))

    def run():
        stream = streams.read_stream(spark, src, e.schema)
        streams.to_files(streams.stream_occupancy_window(stream, "user_id", "ts", "value", append=True), out, ck).start().awaitTermination()
    delivered(e, _event_delivery(), src, run)
    return spark.read.parquet(out).select("user_id", F.col("w").cast("timestamp_ntz").alias("w"), F.round("v", 6).alias("v"))


def q_stream_first_seen(spark, sf_dir):
    """Rows that the staleness stream lets through: some come late, some a
    second time with the same or a later time."""
    e = readers.read_table(spark, sf_dir, "events").select("event_id", "ts", _event_delivery().alias("b"))
    twice = e.filter((F.col("event_id") % 5 == 0) & (F.col("b") < 3)).withColumn("b", F.col("b") + 1)
    later = e.filter((F.col("event_id") % 11 == 0) & (F.col("event_id") % 5 != 0) & (F.col("b") < 3)) \
             .select("event_id", (F.col("ts") + F.expr("INTERVAL 12 DAYS")).alias("ts"), F.lit(3).alias("b"))
    sent = e.withColumn("copy", F.lit(0)).unionByName(twice.withColumn("copy", F.lit(1))).unionByName(later.withColumn("copy", F.lit(2)))
    src, out, ck = (folder(spark, x) for x in ("sent", "first", "ck"))
    shape = sent.drop("b").schema

    def run():
        stream = streams.read_stream(spark, src, shape)
        streams.to_files(streams.stream_staleness(stream, "ts", ["event_id"]), out, ck).start().awaitTermination()
    delivered(sent, F.col("b"), src, run)
    return spark.read.parquet(out).select("event_id", "copy", F.col("ts").cast("timestamp_ntz").alias("ts"))


def q_stream_clean_layer(spark, sf_dir):
    """Snapshots split over deliveries, cleaned by two chained stateful
    aggregations and written to a layer; what the layer holds."""
    raw = bindings.raw_snapshots(spark, sf_dir, monthly=True)
    src, out, ck = (folder(spark, x) for x in ("raw", "clean", "ck"))
    number = F.least(F.lit(DELIVERIES - 1), (F.floor((F.year("extraction_ts") - 1995) / 2) + F.when(F.col("space") % 9 == 0, 1).otherwise(0)).cast("int"))

    def run():
        stream = streams.read_stream(spark, src, schemas.RAW_SNAPSHOT)
        streams.to_layer(streams.stream_clean_watermarked(stream, delay="400 days"), out, ck).start().awaitTermination()
    delivered(raw, number, src, run)
    layer = spark.read.schema(schemas.CLEAN_SNAPSHOT).parquet(out)
    return bindings._plain(layer.select(*schemas.CLEAN_SNAPSHOT.names))


def q_stream_status_table(spark, sf_dir):
    """The status table after the deliveries: each user's latest event."""
    e = readers.read_table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), F.col("ts").cast("timestamp").alias("extraction_ts"), "event_id", "value")
    src, out, ck = (folder(spark, x) for x in ("events", "status", "ck"))

    def run():
        stream = streams.read_stream(spark, src, e.schema)
        streams.stream_status(spark, stream, out, ck, compact_bytes=4096).awaitTermination()
    delivered(e, F.least(F.lit(DELIVERIES - 1), (F.floor((F.dayofmonth("extraction_ts") - 1) / 8) + _late("event_id")).cast("int")), src, run)
    return bindings._plain(streams.read_status(spark, out))


def q_snapshot_csv(spark, sf_dir):
    """Snapshots written as CSV files with different headers, read back."""
    raw = bindings.raw_snapshots(spark, sf_dir).withColumn("updated_at", F.unix_seconds("last_update_ts"))
    cols = [c for c in schemas.STATION_CSV.names if c != "address"]
    out = folder(spark, "csv")
    other = raw.filter(F.col("id") % 3 == 0).withColumn("note", F.lit("x, y"))
    for part, names in ((raw.filter(F.col("id") % 3 != 0), cols), (other, [*reversed(cols), "note"])):
        part.select(*names).write.mode("append").option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(out)
    back = readers.read_snapshot_csv(spark, out)
    return bindings._plain(back.select("id", "name", "space", "full", "empty", "city", "lat", "lng", "last_update_ts", "extraction_ts"))


def q_reprocess_layer(spark, sf_dir):
    """A stored clean layer with wrong rows (space 0) after re-processing a
    range of the raw layer, in which the rows of every third month have turned
    invalid, so that some dates of the range have no clean rows any more."""
    raw = bindings.raw_snapshots(spark, sf_dir, monthly=True)
    raw_path, clean_path = folder(spark, "raw"), folder(spark, "clean")
    sinks.write_layer(snapshot.clean_snapshot(raw).withColumn("space", F.lit(0).cast("long")), clean_path)
    sinks.write_layer(raw.withColumn("city", F.when(F.month("extraction_ts") % 3 != 0, F.col("city"))), raw_path)
    snapshot.reprocess_range(spark, raw_path, clean_path, bindings.OLDEST, bindings.NEWEST)
    return bindings._plain(readers.read_snapshots(spark, clean_path).select("id", "space", "extraction_ts"))


def q_sync_files(spark, sf_dir):
    """Files of a remote folder copied into a layer: seven files first, then
    the rest; what the layer holds, and how many files a last run copies."""
    e = readers.read_table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("extraction_ts"), "value")
    remote, layer = folder(spark, "remote"), folder(spark, "layer")
    e.repartitionByRange(12, "event_id").write.parquet(remote)
    copied = [sync.sync_missing(spark, remote, layer, schema=e.schema, limit=n, pattern="*.parquet", block_files=4) for n in (7, None, None)]
    back = spark.read.schema(e.schema).parquet(layer).select(*e.columns)
    return bindings._plain(back.withColumns({"first": F.lit(copied[0]), "again": F.lit(copied[2])}))


def q_history_concat(spark, sf_dir):
    """Files written with three schemas, and files that are none, read as one history."""
    e = readers.read_table(spark, sf_dir, "events")
    path = folder(spark, "history")
    e.filter("event_id % 3 = 0").select(F.col("event_id").cast("int").alias("event_id"), F.col("value").cast("float").alias("value"), F.col("user_id").cast("string").alias("who")).coalesce(4).write.parquet(f"{path}/a")
    e.filter("event_id % 3 = 1").select("event_id", "value", F.col("user_id").alias("who"), "event_type").coalesce(4).write.parquet(f"{path}/b")
    e.filter("event_id % 3 = 2").select(F.col("user_id").cast("int").alias("who"), "event_id").coalesce(4).write.parquet(f"{path}/c")
    e.filter("event_id < 10").select("event_type").repartitionByRange(2, "event_type").write.text(f"{path}/d")
    rows, bad = sync.read_history(spark, path)
    return rows.withColumns({"value": F.round("value", 4), "some_unreadable": F.lit(not bad.isEmpty())})


def q_sink_upsert_parts(spark, sf_dir):
    """The upsert of a stored table by key parts, as the table is read after it."""
    e = readers.read_table(spark, sf_dir, "events")
    base = e.groupBy("user_id").agg(F.min_by("value", "event_id").alias("v"))
    new = e.filter(F.col("event_type") == "signup").groupBy("user_id").agg(F.max_by("value", "event_id").alias("v"))
    path = folder(spark, "keyed")
    sinks.write_keyed(base, path, ["user_id"], 16)
    sinks.upsert_parts(spark, path, new, ["user_id"], base.schema, 16)
    return sinks.read_keyed(spark, path, base.schema)


def q_scan_latest_file(spark, sf_dir):
    """The newest file of a layer with one file a day."""
    e = readers.read_table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    out = folder(spark, "layer")
    readers.with_date(e, "ts").repartition(readers.DATE_PART).write.partitionBy(readers.DATE_PART).parquet(out)
    latest = readers.scan_latest_file(readers.read_snapshots(spark, out))
    return latest.select("event_id", F.col(readers.DATE_PART).cast("string").alias("day"))


def q_run_ts_of_files(spark, sf_dir):
    """The run time in the name of the folder that each row was landed in."""
    e = readers.read_table(spark, sf_dir, "events").select("event_id", "ts")
    out = folder(spark, "runs")
    week = F.floor((F.dayofmonth("ts") - 1) / 8)
    for i in range(DELIVERIES):
        e.filter(week == i).write.parquet(f"{out}/pull_2024-01-{7 * i + 8:02d}_23:59:5{i}")
    df = spark.read.option("recursiveFileLookup", "true").schema(e.schema).parquet(out)
    return df.select("event_id", readers.run_ts_from_path().cast("timestamp_ntz").alias("run_ts"))


def q_model_versions(spark, sf_dir):
    """Two models stored under one name: the newest, and the first by its number."""
    t = cut_lineage(catalog._training(spark, sf_dir).select("pct", "y"))
    store = model.ModelStore(spark, folder(spark, "models"))
    for alpha in (50.0, catalog.RIDGE_ALPHA):
        store.save("fill", model.ridge_fit(t, ["pct"], "y", alpha=alpha))
    rows = [(v or 2, float(m.coef[0]), float(m.intercept)) for v, m in ((v, store.load("fill", v)) for v in (1, None))]
    return spark.createDataFrame(rows, "version int, w double, b double").select("version", F.round("w", 6).alias("w"), F.round("b", 6).alias("b"))


def _readings(spark, sf_dir) -> DataFrame:
    """Hourly weather by zone: its place, and readings."""
    e = readers.read_table(spark, sf_dir, "events").select((F.col("user_id") % 6).alias("z"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("h"), "value")
    g = e.groupBy("z", "h").agg(F.min("value").cast("float").alias("lo"), F.max("value").cast("float").alias("hi"))
    return g.select(F.col("h").alias("datetime"), (F.col("z") + 22.0).alias("lat"), F.lit(120.5).alias("lng"),
                    *[(F.col("lo") if i % 2 == 0 else F.col("hi")).alias(v) for i, v in enumerate(schemas.WEATHER_VARS)])


def q_weather_csv(spark, sf_dir):
    """Weather written as CSV twice over in local time, read back once and as instants."""
    w, out = _readings(spark, sf_dir), folder(spark, "weather")
    for _ in range(2):
        w.withColumn("datetime", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss")).select(*schemas.WEATHER_CSV.names).write.mode("append").option("header", True).csv(out)
    back = readers.read_weather_csv(spark, out)
    return bindings._plain(back.select("datetime", "lat", F.col("temperature").cast("double").alias("temperature"), F.col("wind_gusts").cast("double").alias("wind_gusts")))


def q_weather_nanos(spark, sf_dir):
    """Weather whose times are stored as long nanoseconds."""
    w, out = _readings(spark, sf_dir), folder(spark, "weather")
    w.withColumn("datetime", F.unix_micros(F.col("datetime").cast("timestamp")) * 1000).write.parquet(out)
    return bindings._plain(readers.read_weather(spark, out).select("datetime", "lat", F.col("rain").cast("double").alias("rain")))


def q_snapshot_files(spark, sf_dir):
    """A raw layer of which some files lack columns, read under the layer's schema."""
    raw, out = bindings.raw_snapshots(spark, sf_dir), folder(spark, "raw")
    raw.filter(F.col("id") % 2 == 0).write.parquet(f"{out}/part=0")
    raw.filter(F.col("id") % 2 == 1).drop("address", "is_open", "area").write.parquet(f"{out}/part=1")
    back = readers.read_snapshots(spark, out, schemas.RAW_SNAPSHOT)
    return bindings._plain(back.select("id", "name", "area", "address", "is_open", "space", "extraction_ts"))


def q_sink_append(spark, sf_dir):
    """A forecast table that begins empty but typed, and two appended runs."""
    e, out = readers.read_table(spark, sf_dir, "events"), folder(spark, "forecasts")
    kinds = schemas.FILL_RATE_FORECAST
    empty = spark.createDataFrame([], kinds)
    rows = e.select(F.col("user_id").alias("station_id"), (F.col("value") / 100).alias("fill_rate"), F.lit(0).alias("relative_ts"), F.col("ts").alias("base_ts"), F.col("ts").alias("run_ts"))
    sinks.append(empty, out)
    for click in (True, False):
        mine = rows.filter((e["event_type"] == "click") == F.lit(click))
        sinks.append(setops.union_by_name(empty, mine).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in kinds.fields]), out)
    back = spark.read.schema(kinds).parquet(out)
    return bindings._plain(back.select(F.col("station_id").cast("long").alias("station_id"), F.round(F.col("fill_rate").cast("double"), 4).alias("fill_rate"), "base_ts"))


def q_sorted_layer(spark, sf_dir):
    """Rows of each date of a written layer, and how many of them stand before
    a smaller one in their file."""
    e, out = readers.read_table(spark, sf_dir, "events"), folder(spark, "layer")
    sinks.write_layer(e.select(F.col("user_id").alias("id"), F.col("ts").cast("timestamp").alias("extraction_ts")), out)
    back = readers.read_snapshots(spark, out).select("id", "extraction_ts", readers.DATE_PART, F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("r"))
    w = Window.partitionBy("f").orderBy("r")
    low = F.lead(F.struct("id", "extraction_ts")).over(w) < F.struct("id", "extraction_ts")
    return back.withColumn("low", low).groupBy(F.col(readers.DATE_PART).cast("string").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.count_if("low").cast("long").alias("unsorted"))


def q_training_ties(spark, sf_dir):
    """Features of stations with several snapshots at one time."""
    s = bindings.snapshots(spark, sf_dir).withColumns({"extraction_ts": F.date_trunc("day", "extraction_ts"), "station_id": F.col("id")})
    f = fp.feature_matrix(s, with_target=True)
    return bindings._plain(f.select("id", "full", "empty", "extraction_ts", *[F.round(F.col(f"`{c}`"), 6).alias(n) for c, n in ((fp.LAG_COL, "lag3"), (fp.ROLL_COL, "mean12"), (fp.TARGET_COL, "lead3"))]))


QUERIES = {n[2:]: f for n, f in list(globals().items()) if n.startswith("q_")}

_MONTHLY = bindings._RAW.replace("l_shipdate", "date_trunc('month', l_shipdate)")
_LATE = "case when event_id%37=0 then 3 when event_id%10=0 then 1 else 0 end"
# deliveries of the events, and the watermark that holds while each is read
_EVENTS = f"""with d as (select *, least(3, (day(ts)-1)//8 + {_LATE}) b from events),
m as (select b, date_trunc('milliseconds', max(ts)) - interval 8 day wm from d group by b),
before as (select x.b, max(m.wm) wm from (select unnest(range(4)) b) x left join m on m.b < x.b group by x.b)"""

ORACLE_SQL = {
    "stream_occupancy_closed": _EVENTS + """, p as (select user_id, value, b, unnest(generate_series(time_bucket(interval 10 minute, ts) - interval 110 minute, time_bucket(interval 10 minute, ts), interval 10 minute)) w from d)
        select user_id, w, round(avg(value),6) v from p join before using (b) where (wm is null or w + interval 120 minute > wm) and w + interval 120 minute <= (select max(wm) from m) group by all""",
    "stream_first_seen": f"""with e as (select event_id, ts, least(3, (day(ts)-1)//8 + {_LATE}) b from events),
        s as (select event_id, ts, b, 0 copy from e union all select event_id, ts, b+1, 1 from e where event_id%5=0 and b<3
              union all select event_id, ts + interval 12 day, 3, 2 from e where event_id%11=0 and event_id%5<>0 and b<3),
        m as (select b, date_trunc('milliseconds', max(ts)) - interval 8 day wm from s group by b),
        before as (select x.b, max(m.wm) wm from (select unnest(range(4)) b) x left join m on m.b < x.b group by x.b),
        ok as (select s.*, wm, wm is null or ts > wm as in_time from s join before using (b)),
        o as (select a.*, f.event_id is not null and f.in_time as seen, f.ts first_ts from ok a left join ok f on a.copy > 0 and f.event_id=a.event_id and f.copy=0)
        select event_id, copy, ts from o where in_time and not (seen and (wm is null or first_ts + interval 8 day > wm))""",
    "stream_clean_layer": _MONTHLY.split("valid as")[0] + """del as (select *, least(3, (year(extraction_ts)-1995)//2 + case when "space"%9=0 then 1 else 0 end) b from raw),
        ok as (select * from del where city is not null and "type"=2 and not ("empty" < 0) and not ("space" < 1) and lat >= 21.89::double and lng >= 120.0::double
          and last_update_ts >= date_trunc('day', extraction_ts + interval 8 hour) - interval 8 day - interval 8 hour and not ("space" < "full" + "empty" - 10)),
        m as (select b, max(extraction_ts) - interval 400 day wm from ok group by b),
        before as (select x.b, max(m.wm) wm from (select unnest(range(4)) b) x left join m on m.b < x.b group by x.b),
        kept as (select * from ok join before using (b) where (wm is null or extraction_ts > wm) and extraction_ts <= (select max(wm) from m)),
        one as (select id, min(name) as name, "space", "full", "empty", bike_yb2, bike_eyb, city, area, lat, lng, is_open, last_update_ts, extraction_ts from kept
          group by id, "space", "full", "empty", bike_yb2, bike_eyb, city, area, lat, lng, is_open, last_update_ts, extraction_ts),
        single as (select * from one where (lat, lng, extraction_ts) in (select (lat, lng, extraction_ts) from one group by lat, lng, extraction_ts having count(*)=1))
        select id, name, lat, lng, "space", "full", "empty", bike_yb2, bike_eyb, case when city='台北市' then 'TaiBeiShi' else 'N/A' end city,
          case when area='大安區' then 'DaAnQu' else 'N/A' end area, last_update_ts, extraction_ts from single""",
    "stream_status_table": "select user_id id, arg_max(ts, (ts, -event_id)) extraction_ts, arg_max(event_id, (ts, -event_id)) event_id, arg_max(value, (ts, -event_id)) as value from events group by user_id",
    "snapshot_csv": bindings._RAW.split("valid as")[0].rstrip().rstrip(",") + """ select id, name, "space", "full", "empty", city, lat, lng, last_update_ts, extraction_ts from raw""",
    "reprocess_layer": _MONTHLY + f""" select id, case when {bindings._RANGE} then "space" else 0 end "space", extraction_ts from clean where not ({bindings._RANGE} and month(extraction_ts)%3=0)""",
    "sync_files": "select event_id, ts extraction_ts, value, 7 as first, 0 again from events",
    "history_concat": """select event_id, round(case event_id%3 when 0 then value::float::double when 1 then value end, 4) as value, user_id::varchar who, case when event_id%3=1 then event_type end event_type,
        true some_unreadable from events""",
    "sink_upsert_parts": catalog.ORACLE_SQL["sink_upsert"],
    "scan_latest_file": "with d as (select event_id, strftime(ts + interval 8 hour, '%Y-%m-%d') as day from events) select * from d where day = (select max(day) from d)",
    "run_ts_of_files": "select event_id, case (day(ts)-1)//8 when 0 then timestamp '2024-01-08 23:59:50' when 1 then timestamp '2024-01-15 23:59:51' when 2 then timestamp '2024-01-22 23:59:52' else timestamp '2024-01-29 23:59:53' end run_ts from events",
    "model_versions": catalog._M + """, k as (select 1 as version, 50 as a union all select 2, 1), x as (select regr_sxy(pct-fwd3,pct) sxy, regr_sxx(pct-fwd3,pct) sxx, avg(pct-fwd3) my, avg(pct) mx from f where fwd3 is not null and pct is not null)
        select version, round(sxy/(sxx+a),6) w, round(my-sxy/(sxx+a)*mx,6) b from k, x""",
    "weather_csv": "select date_trunc('hour',ts) - interval 8 hour datetime, 22.0::double+user_id%6 lat, min(value)::float::double temperature, min(value)::float::double wind_gusts from events group by date_trunc('hour',ts), user_id%6",
    "weather_nanos": "select date_trunc('hour',ts) datetime, 22.0::double+user_id%6 lat, max(value)::float::double rain from events group by date_trunc('hour',ts), user_id%6",
    "snapshot_files": bindings._RAW.split("valid as")[0].rstrip().rstrip(",") + """ select id, name, case when id%2=0 then area end area, case when id%2=0 then 'a' end address, case when id%2=0 then 1::bigint end is_open, "space", extraction_ts from raw""",
    "sink_append": "select user_id station_id, round((value/100)::float::double, 4) fill_rate, ts base_ts from events where event_type is not null",
    "sorted_layer": "select strftime(ts + interval 8 hour, '%Y-%m-%d') as day, count(*) n, 0::bigint unsorted from events group by 1",
    "training_ties": bindings._OBS + """, f as (select id, "full", "empty", date_trunc('day', ts) t, case when "full"+"empty"=0 then null else "full"::double/("full"+"empty") end pct from s),
        win as (select *, lag(pct,3) over o lag3, case when count(pct) over (o rows between 11 preceding and current row) >= 12 then avg(pct) over (o rows between 11 preceding and current row) end mean12, lead(pct,3) over o lead3
              from f window o as (partition by id order by t, "full" nulls first, "empty" nulls first))
        select id, "full", "empty", t extraction_ts, round(lag3,6) lag3, round(mean12,6) mean12, round(lead3,6) lead3 from win""",
}
