"""The product plans run on the driver's tables.

The tables are mapped on to the stored schemas by plain projections (fixed
parameters of the bindings), then the functions of ``plans`` are called as
they stand. ``ORACLE_SQL`` is an independent SQL formulation of each.

* raw snapshots = ``lineitem``: station = l_suppkey, pull = l_shipdate, with
  nulls, negative and excess counts, stale updates, shared positions and
  repeated rows;
* snapshots of the feature plans = ``events`` (station = user_id, bikes =
  value, docks = props.k); zones = ``region``; weather = hourly extremes of
  ``events.value`` per user_id mod 6 (zone 5 does not exist);
* stations = ``customer``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockcast import schemas
from dockcast.functions import fixed_values as fv
from dockcast.functions import scalar as fx
from dockcast.operators import aggregates as agg
from dockcast.operators import clean, joins, model, serve, setops, summary
from dockcast.plans import features as fp
from dockcast.plans import serving, snapshot
from dockcast.sources import readers

OLDEST, NEWEST = "1999-06-10 05:00:00", "2001-03-04 00:00:00"
AS_OF = "2024-02-01 00:00:00"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return readers.read_table(spark, sf_dir, name)


def _typed(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def raw_snapshots(spark, sf_dir, monthly: bool = False) -> DataFrame:
    li = _t(spark, sf_dir, "lineitem")
    if monthly:  # pulls on the first day of each month only: fewer, larger dates
        li = li.withColumn("l_shipdate", F.date_trunc("month", "l_shipdate").cast("timestamp_ntz"))
    ts = F.col("l_shipdate").cast("timestamp") + F.make_dt_interval(hours=(F.col("l_orderkey") % 24).cast("int"))
    rows = li.select(
        F.col("l_suppkey").alias("id"), F.concat("l_returnflag", F.col("l_linenumber").cast("string")).alias("name"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(2).alias("type"), F.floor("l_quantity").alias("space"),
        F.floor(F.col("l_quantity") * F.col("l_discount") * 5).alias("full"),
        (F.floor("l_quantity") - F.floor(F.col("l_quantity") * F.col("l_discount") * 5) + (F.col("l_linenumber") - 4) * 4).alias("empty"),
        F.lit(0).alias("bike_yb1"), F.floor(F.col("l_quantity") / 2).alias("bike_yb2"), F.lit(0).alias("bike_eyb"),
        F.when(F.col("l_partkey") % 11 != 0, F.when(F.col("l_linestatus") == "O", "台北市").otherwise("x")).alias("city"),
        F.when(F.col("l_suppkey") % 2 == 0, "大安區").otherwise("y").alias("area"),
        (F.lit(21.5) + (F.col("l_partkey") % 40) / 10).alias("lat"), (F.lit(119.5) + (F.col("l_suppkey") % 30) / 10).alias("lng"),
        F.lit(None).alias("place_id"), F.lit("a").alias("address"), F.lit(1).alias("is_open"),
        (ts - F.make_dt_interval(days=(F.col("l_orderkey") % 12).cast("int"))).alias("last_update_ts"), ts.alias("extraction_ts"))
    return _typed(rows, schemas.RAW_SNAPSHOT)


_RAW = """with raw as (select l_suppkey id, l_returnflag || l_linenumber as name, case when l_returnflag='R' then 1 else 2 end "type", floor(l_quantity)::bigint "space",
  floor(l_quantity*l_discount*5)::bigint "full", floor(l_quantity)::bigint - floor(l_quantity*l_discount*5)::bigint + (l_linenumber-4)*4 "empty", floor(l_quantity/2)::bigint bike_yb2, 0::bigint bike_eyb,
  case when l_partkey%11<>0 then (case when l_linestatus='O' then '台北市' else 'x' end) end city, case when l_suppkey%2=0 then '大安區' else 'y' end area,
  21.5::double + (l_partkey%40)::double/10 lat, 119.5::double + (l_suppkey%30)::double/10 lng, 1 is_open,
  l_shipdate + to_hours((l_orderkey%24)::int) - to_days((l_orderkey%12)::int) last_update_ts, l_shipdate + to_hours((l_orderkey%24)::int) extraction_ts from lineitem),
valid as (select * from raw where city is not null and "type"=2 and not ("empty" < 0) and not ("space" < 1) and lat >= 21.89::double and lng >= 120.0::double
  and last_update_ts >= date_trunc('day', extraction_ts + interval 8 hour) - interval 8 day - interval 8 hour and not ("space" < "full" + "empty" - 10)),
one as (select id, min(name) as name, "space", "full", "empty", bike_yb2, bike_eyb, city, area, lat, lng, is_open, last_update_ts, extraction_ts from valid
  group by all),
single as (select * from one where (lat, lng, extraction_ts) in (select (lat, lng, extraction_ts) from one group by lat, lng, extraction_ts having count(*)=1)),
clean as (select id, name, lat, lng, "space", "full", "empty", bike_yb2, bike_eyb, case when city='台北市' then 'TaiBeiShi' else 'N/A' end city,
  case when area='大安區' then 'DaAnQu' else 'N/A' end area, last_update_ts, extraction_ts from single)"""


def _plain(df: DataFrame) -> DataFrame:
    """Instants as wall-clock times of the session, for comparison."""
    return df.select(*[F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name) if f.dataType.typeName() == "timestamp" else F.col(f"`{f.name}`") for f in df.schema.fields])


def q_clean_snapshot(spark, sf_dir):
    return _plain(snapshot.clean_snapshot(raw_snapshots(spark, sf_dir)))


def q_scan_rerun_range(spark, sf_dir):
    r = readers.scan_time_range(raw_snapshots(spark, sf_dir), "extraction_ts", OLDEST, NEWEST, inclusive="right")
    return _plain(r.select("id", "space", "extraction_ts"))


def q_reprocess_range(spark, sf_dir):
    """The layer after re-processing a range whose clean rows had been wrong
    (space 0): rows outside the range, on its first and last day, stay."""
    raw = raw_snapshots(spark, sf_dir)
    layer = readers.with_date(snapshot.clean_snapshot(raw).withColumn("space", F.lit(0).cast("long")), "extraction_ts")
    new = snapshot.reclean(raw, OLDEST, NEWEST)
    rest = snapshot.untouched(layer, OLDEST, NEWEST)
    return _plain(new.unionByName(rest.select(*new.columns)).select("id", "space", "extraction_ts"))


def q_sync_missing(spark, sf_dir):
    """Keys of a remote listing that the local one lacks, newest first."""
    o = _t(spark, sf_dir, "orders")
    remote = o.select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("key"))
    local = o.filter(F.col("o_orderstatus") == "F").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("key"))
    return readers.missing_keys(remote, local, "key")


def _zones(spark, sf_dir) -> DataFrame:
    return _t(spark, sf_dir, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"),
                                              (F.lit(22.0) + F.col("r_regionkey")).alias("lat"), (F.lit(120.0) + F.col("r_regionkey") % 3).alias("lng"))


def q_enrich_new_stations(spark, sf_dir):
    """Suppliers seen in the clean snapshots that no customer's key matches."""
    seen = snapshot.clean_snapshot(raw_snapshots(spark, sf_dir))
    stations = _t(spark, sf_dir, "customer").filter(F.col("c_mktsegment") != "BUILDING").select(F.col("c_custkey").alias("id"))
    r = snapshot.new_stations(seen, stations, _zones(spark, sf_dir), created_at=AS_OF)
    return r.select("id", "name", "lat", "lng", "weather_zone_id")


def snapshots(spark, sf_dir) -> DataFrame:
    e = _t(spark, sf_dir, "events")
    k = fx.json_int_field("props", "k")
    # every 13th reading of k is missing; some stations stand empty at times
    return e.select(F.col("user_id").alias("id"), F.floor(F.when(k % 7 == 0, 0).otherwise(F.col("value"))).cast("long").alias("full"),
                    F.when(k % 13 != 0, F.when(k % 14 == 0, 0).otherwise(k)).cast("long").alias("empty"), F.col("ts").cast("timestamp").alias("extraction_ts"))


def _stations(spark, sf_dir) -> DataFrame:
    return _t(spark, sf_dir, "events").select(F.col("user_id").alias("id"), (F.col("user_id") % 6).cast("int").alias("weather_zone_id")).distinct()


def _weather(spark, sf_dir) -> DataFrame:
    e = _t(spark, sf_dir, "events").select((F.col("user_id") % 6).cast("int").alias("zid"), F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("datetime"), "value")
    w = e.groupBy("zid", "datetime").agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.count("*").alias("n"))
    z = _zones(spark, sf_dir).select(F.col("id").alias("zid"), F.col("name").alias("zone"))
    return joins.lookup_join(w, z, "zid", "inner").select("zone", "datetime", *[F.col(c).cast("float").alias(o) for o, c in (
        ("temperature", "lo"), ("relative_humidity", "n"), ("apparent_temperature", "hi"), ("precipitation", "lo"), ("wind_speed", "n"))])


def _training(spark, sf_dir, by: str = "rows") -> DataFrame:
    inputs = fp.training_inputs(snapshots(spark, sf_dir), _stations(spark, sf_dir), _zones(spark, sf_dir), _weather(spark, sf_dir),
                                start="2024-01-03 00:00:00", end="2024-01-28 00:00:00")
    return fp.training_features(inputs, by=by)


_SHOWN = ["pct_full", fp.LAG_COL, fp.ROLL_COL, "apparent_temperature", "precipitation", "wind_speed", "1h_fwd_apparent_temperature", "1h_fwd_precipitation"]


def _rounded(df: DataFrame, columns: list[str], keep: list[str]) -> DataFrame:
    return df.select(*keep, *[F.round(F.col(f"`{c}`").cast("double"), 6).alias(c.replace("30m_", "m30_").replace("120m_", "m120_").replace("1h_", "h1_")) for c in columns])


def q_plan_training_features(spark, sf_dir):
    f = _training(spark, sf_dir)
    return _plain(_rounded(f, [*_SHOWN, fp.TARGET_COL, fp.TARGET_CHANGE], ["station_id", "extraction_ts", "month", "day_of_week", "hour"]))


def q_plan_training_features_by_time(spark, sf_dir):
    f = _training(spark, sf_dir, by="time")
    return _plain(_rounded(f, [*_SHOWN, fp.TARGET_COL, fp.TARGET_CHANGE], ["station_id", "extraction_ts", "month", "day_of_week", "hour"]))


_PAIRED = ["pct_full", "m30_blag_pct_full", "m120_avg_pct_full", "apparent_temperature", "precipitation", "wind_speed", "h1_fwd_apparent_temperature", "h1_fwd_precipitation",
           "day_of_week", "hour", "m30_fwd_pct_full"]


def q_feature_correlations(spark, sf_dir):
    """Every pair of the eleven numbers of the training features."""
    return summary.correlations(q_plan_training_features(spark, sf_dir), _PAIRED)


def q_plan_prediction_features(spark, sf_dir):
    """Status = each station's newest snapshot, stamped with one pull time."""
    s = snapshots(spark, sf_dir)
    status = s.groupBy("id").agg(F.max_by("full", "extraction_ts").alias("full"), F.max_by("empty", "extraction_ts").alias("empty")) \
        .withColumn("updated_at", F.lit("2024-01-30 20:00:00").cast("timestamp"))
    inputs = fp.prediction_inputs(status, s, _stations(spark, sf_dir), _zones(spark, sf_dir), _weather(spark, sf_dir), history_minutes=20 * 24 * 60)
    return _plain(_rounded(fp.prediction_features(inputs), _SHOWN, ["station_id", "extraction_ts", "month", "day_of_week", "hour"]))


_OBS = """with s as (select user_id id, (case when k%7=0 then 0 else floor(value) end)::bigint "full", (case when k%13<>0 then (case when k%14=0 then 0 else k end) end)::bigint "empty", ts
  from (select *, try_cast(json_extract_string(props,'$.k') as int) k from events)),
st as (select distinct user_id id, user_id%6 z from events),
w0 as (select user_id%6 z, date_trunc('hour',ts) h, min(value)::float lo, max(value)::float hi, count(*)::float n from events group by 1,2),
w as (select r_name zn, z, h, lo, hi, n, lead(hi) over (partition by z order by h) hi1, lead(lo) over (partition by z order by h) lo1 from w0 join region on z=r_regionkey)"""
_FEAT = """ case when "full"+"empty"=0 then null else "full"::double/("full"+"empty") end pct, month(ts)::int "month", (isodow(ts)-1)::int day_of_week, hour(ts)::int "hour" """
_WX = """ round(hi::double,6) apparent_temperature, round(lo::double,6) precipitation, round(n::double,6) wind_speed, round(hi1::double,6) h1_fwd_apparent_temperature, round(lo1::double,6) h1_fwd_precipitation """
_WIN = """ lag(pct,3) over o l3, case when count(pct) over (o rows between 11 preceding and current row) >= 12 then avg(pct) over (o rows between 11 preceding and current row) end m12 """


def q_plan_forecast_rows(spark, sf_dir):
    """Long forecast rows of both reconstructions, from a fit on the plan's
    training features (three features)."""
    f = _training(spark, sf_dir).withColumnsRenamed({fp.LAG_COL: "lag3", fp.ROLL_COL: "mean12", fp.TARGET_CHANGE: "y"})
    m = model.ridge_fit(f, ["pct_full", "lag3", "mean12"], "y", alpha=1.0)
    rows = [model.forecast_rows(f, m, pct="pct_full", run_ts=AS_OF, mode=mode).withColumn("mode", F.lit(mode)) for mode in ("serving", "consistent")]
    r = rows[0].unionByName(rows[1])
    return _plain(r.select("station_id", "mode", "relative_ts", F.round("fill_rate", 5).alias("fill_rate"), "base_ts", "ts", "run_ts"))


def forecasts(spark, sf_dir) -> DataFrame:
    """A forecast table: for orders as runs, horizon 0 and 1 per customer."""
    o = _t(spark, sf_dir, "orders")
    rows = o.select(F.col("o_custkey").alias("station_id"), ((F.col("o_orderkey") % 101) / 100).alias("a"), ((F.col("o_orderkey") % 89) / 88).alias("b"),
                    F.col("o_orderdate").cast("timestamp").alias("run_ts"), "o_orderstatus", "o_orderkey")
    rows = rows.groupBy("station_id", "run_ts").agg(F.max_by(F.struct("a", "b", "o_orderstatus"), "o_orderkey").alias("r")).select("station_id", "run_ts", "r.*")
    long = setops.stack_rows(rows, ["station_id", "run_ts"], [{"relative_ts": F.lit(0), "fill_rate": F.col("a")}, {"relative_ts": F.lit(1), "fill_rate": F.col("b")}],
                             keep_if=[None, F.col("o_orderstatus") != "P"])
    return _typed(long.withColumn("base_ts", F.col("run_ts")), schemas.FILL_RATE_FORECAST)


def q_shortage_view(spark, sf_dir):
    """Customers with both horizons of a forecast, and which lists show them."""
    c = _t(spark, sf_dir, "customer")
    st = c.select(F.col("c_custkey").cast("int").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("city"), F.col("c_nationkey").cast("string").alias("area"),
                  F.floor("c_acctbal").cast("long").alias("space"))
    view, low, high = serving.shortage_view(st, forecasts(spark, sf_dir), city="BUILDING", k=25)
    tag = [view.withColumn("list", F.lit("all")), low.withColumn("list", F.lit("low")), high.withColumn("list", F.lit("high"))]
    out = tag[0].unionByName(tag[1]).unionByName(tag[2])
    return out.select("list", "station_id", "name", "space", F.round(F.col("avg_fill").cast("double"), 5).alias("avg_fill"))


def q_serve_forecast(spark, sf_dir):
    """Which stations get new rows, and which are fresh, for a request of all
    urgent customers on top of the forecast table."""
    fc = forecasts(spark, sf_dir).withColumn("run_ts", F.col("run_ts") + F.make_dt_interval(secs=F.lit(0)))
    as_of = "1998-01-01 00:04:00"
    req = _t(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").cast("int").alias("station_id")).distinct()
    stations = _t(spark, sf_dir, "customer").select(F.col("c_custkey").cast("int").alias("id"))
    feats = _t(spark, sf_dir, "customer").filter(F.col("c_acctbal") > 0).select(
        F.col("c_custkey").alias("station_id"), F.lit("1998-01-01 00:00:00").cast("timestamp").alias("extraction_ts"), ((F.col("c_custkey") % 50) / 49).alias("pct_full"))
    m = model.RidgeModel(["pct_full"], [-0.5], -0.75)
    new, fresh = serving.serve_forecast(req, stations, fc, feats, m, as_of=as_of)
    out = new.withColumn("part", F.lit("insert")).unionByName(fresh.withColumn("part", F.lit("fresh")))
    return _plain(out.select("part", "station_id", F.col("relative_ts").cast("int").alias("relative_ts"), F.round(F.col("fill_rate").cast("double"), 5).alias("fill_rate"), "base_ts", "run_ts"))


def q_weather_report(spark, sf_dir):
    """Hourly arrays per event type at off-grid places → rows with the nearest zone."""
    e = _t(spark, sf_dir, "events").withColumn("v", F.round("value", 2).cast("float"))
    l = readers.hourly_landing(e, "event_type", ["ts", "event_id"], "v", start="2024-01-01 00:00:00")
    place = F.length("event_type")
    land = l.select((F.lit(22.4) + place * 0.31).alias("latitude"), (F.lit(120.1) + place * 0.17).alias("longitude"), F.unix_timestamp("start").alias("start"),
                    F.unix_timestamp("end").alias("end"), F.lit(3600).alias("interval"), *[F.col("v").alias(c) for c in schemas.WEATHER_VARS])
    r = serving.weather_report(land)
    return _plain(r.select("zone", F.round("lat", 2).alias("lat"), "datetime", F.col("temperature").cast("double").alias("temperature")))


def q_describe_ties(spark, sf_dir):
    return agg.describe(_t(spark, sf_dir, "lineitem"), "l_quantity")


def q_recursive_forecast_nulls(spark, sf_dir):
    """The step's offset is missing wherever k is a multiple of 61."""
    e = _t(spark, sf_dir, "events").select("event_id", "user_id", "ts", fx.json_int_field("props", "k").alias("k"))
    r = model.recursive_forecast(e, "user_id", ["ts", "event_id"], step_slope=F.lit(0.5), step_offset=F.try_divide(F.lit(1.0), (F.col("k") % 61).cast("double")),
                                 first_value=F.lit(0.25), floor=0.0, out="p")
    return r.select("event_id", F.round("p", 6).alias("p"))


def q_nearest_zone_text_ids(spark, sf_dir):
    """Text ids and repeated points, on the grid path."""
    emb = _t(spark, sf_dir, "embeddings").select(F.concat(F.lit("p"), F.col("vec_id").cast("string")).alias("id"), F.concat(F.lit("z"), F.col("label").cast("string")).alias("zone"),
                                                 F.element_at("embedding", 1).cast("double").alias("x"), F.element_at("embedding", 2).cast("double").alias("y"))
    zones = emb.groupBy("zone").agg(F.min("x").alias("x"), F.max("y").alias("y"))
    r = joins.nearest_zone(emb.unionByName(emb), zones.withColumnRenamed("zone", "zid"), point_id="id", px="x", py="y", zone_id="zid", zx="x", zy="y", out="zone", max_literal_zones=1)
    return r


def q_anti_bad_stations_nulls(spark, sf_dir):
    """The list holds nulls, and so does the filtered column."""
    o = _t(spark, sf_dir, "orders").withColumn("cust", F.when(F.col("o_orderkey") % 9 != 0, F.col("o_custkey")))
    return joins.not_in(o, "cust", o.filter(F.col("o_totalprice") < 5000), "cust").select("o_orderkey")


def q_ridge_fit_2(spark, sf_dir):
    """Two features per station group."""
    li = _t(spark, sf_dir, "lineitem")
    r = model.ridge_fit_per_key(li, "l_suppkey", ["l_quantity", "l_discount"], "l_extendedprice", alpha=1.0)
    return r.select("l_suppkey", F.round("w_l_quantity", 3).alias("w1"), F.round("w_l_discount", 3).alias("w2"), F.round("intercept", 3).alias("b"))


def q_group_size_nulls(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").withColumn("c", F.when(F.col("o_orderkey") % 9 != 0, F.col("o_custkey")))
    return clean.group_size(o.select("o_orderkey", "c"), ["c"], "n")


def q_decode_requests(spark, sf_dir):
    """Requests of two customers each, with malformed and odd ones among them."""
    o = _t(spark, sf_dir, "orders")
    ids = F.concat(F.lit("["), F.col("o_custkey").cast("string"), F.lit(","), (F.col("o_orderkey") % 7).cast("string"), F.lit("]"))
    body = F.when(F.col("o_orderkey") % 11 == 0, "oops").when(F.col("o_orderkey") % 11 == 1, '{"extended": true}') \
        .when(F.col("o_orderkey") % 11 == 2, '{"service": "weather"}').when(F.col("o_orderkey") % 11 == 3, '{"service": "bike_station_status", "extended": true}') \
        .when(F.col("o_orderkey") % 11 == 4, '{"service": "fill_rate_forecast", "station_id": []}') \
        .otherwise(F.concat(F.lit('{"service": "fill_rate_forecast", "station_id": '), ids, F.lit("}")))
    return serve.decode_requests(o.select("o_orderkey", body.alias("body")), "body", ["o_orderkey"])


def q_split_xy(spark, sf_dir):
    """Both halves of the events with the value as target, joined again."""
    e = _t(spark, sf_dir, "events").select("event_id", "user_id", "value")
    x, y = model.split_xy(e, "value", ["event_id"])
    return x.join(y, "event_id")


QUERIES = {n[2:]: f for n, f in list(globals().items()) if n.startswith("q_")}

_RANGE = f"extraction_ts > timestamp '{OLDEST}' and extraction_ts <= timestamp '{NEWEST}'"
_ZONES = "(values " + ", ".join(f"('{z}', {a}::double, {b}::double)" for z, a, b in fv.WEATHER_ZONES) + ") z(zone, zx, zy)"

ORACLE_SQL = {
    "clean_snapshot": _RAW + " select * from clean",
    "scan_rerun_range": _RAW + f""" select id, "space", extraction_ts from raw where {_RANGE}""",
    "reprocess_range": _RAW + f""" select id, case when {_RANGE} then "space" else 0 end "space", extraction_ts from clean where ({_RANGE})
       or (extraction_ts + interval 8 hour)::date between (timestamp '{OLDEST}' + interval 8 hour)::date and (timestamp '{NEWEST}' + interval 8 hour)::date""",
    "sync_missing": "select distinct strftime(o_orderdate, '%Y-%m-%d') as key from orders except select strftime(o_orderdate, '%Y-%m-%d') from orders where o_orderstatus='F'",
    "enrich_new_stations": _RAW + """, n as (select id, arg_min({'name':name,'lat':lat,'lng':lng}, (name, lat, lng, city, area)) r from clean where id not in (select c_custkey from customer where c_mktsegment<>'BUILDING') group by id),
       d as (select id, r.name as name, r.lat lat, r.lng lng, r_regionkey z, row_number() over (partition by id order by sqrt(pow(r.lat-(22.0::double+r_regionkey),2)+pow(r.lng-(120.0::double+r_regionkey%3),2)), r_regionkey) rn from n, region)
       select id, name, lat, lng, z weather_zone_id from d where rn=1""",
    "plan_training_features": _OBS + f""", f as (select s.id station_id, ts, z, {_FEAT} from s join st using (id) join region on z=r_regionkey where ts >= timestamp '2024-01-03' and ts < timestamp '2024-01-28'),
       g as (select *, {_WIN}, lead(pct,3) over o f3 from f window o as (partition by station_id order by ts))
       select station_id, ts extraction_ts, "month", day_of_week, "hour", round(pct,6) pct_full, round(l3,6) m30_blag_pct_full, round(m12,6) m120_avg_pct_full, {_WX},
       round(f3,6) m30_fwd_pct_full, round(pct-f3,6) m30_fwd_pct_full_rel_change from g left join w on w.z=g.z and w.h=date_trunc('hour',ts) where l3 is not null and m12 is not null and f3 is not null""",
    "plan_training_features_by_time": _OBS + f""", f as (select s.id station_id, ts, z, "full", "empty", {_FEAT} from s join st using (id) join region on z=r_regionkey where ts >= timestamp '2024-01-03' and ts < timestamp '2024-01-28'),
       p as (select station_id, ts, arg_max({{'v': pct}}, ("full", "empty")) la, arg_min({{'v': pct}}, ("full", "empty")) fi from f group by all),
       r as (select *, avg(pct) over (partition by station_id order by ts range between interval 120 minute preceding and current row) m12 from f),
       g as (select r.*, a.la.v l3 from r asof left join p a on r.station_id=a.station_id and r.ts - interval 30 minute >= a.ts),
       h as (select g.*, b.fi.v f3 from g asof left join p b on g.station_id=b.station_id and g.ts + interval 30 minute <= b.ts)
       select station_id, ts extraction_ts, "month", day_of_week, "hour", round(pct,6) pct_full, round(l3,6) m30_blag_pct_full, round(m12,6) m120_avg_pct_full, {_WX},
       round(f3,6) m30_fwd_pct_full, round(pct-f3,6) m30_fwd_pct_full_rel_change from h left join w on w.z=h.z and w.h=date_trunc('hour',ts) where l3 is not null and m12 is not null and f3 is not null""",
    "plan_prediction_features": _OBS + f""", cur as (select id, arg_max({{'f':"full",'e':"empty"}}, ts) r from s group by id),
       b as (select id, r.f "full", r.e "empty", timestamp '2024-01-30 20:00:00' ts from cur union all select id, "full", "empty", ts from s where ts >= timestamp '2024-01-10 20:00:00' and ts < timestamp '2024-01-30 20:00:00'),
       f as (select b.id station_id, ts, z, {_FEAT} from b join st using (id) join region on z=r_regionkey),
       g as (select *, {_WIN} from f window o as (partition by station_id order by ts))
       select station_id, ts extraction_ts, "month", day_of_week, "hour", round(pct,6) pct_full, round(l3,6) m30_blag_pct_full, round(m12,6) m120_avg_pct_full, {_WX}
       from g left join w on w.z=g.z and w.h=date_trunc('hour',ts) where ts = timestamp '2024-01-30 20:00:00' and n is not null and pct is not null and l3 is not null and m12 is not null""",
    "shortage_view": """with f as (select o_custkey id, o_orderdate run, arg_max({'a':(o_orderkey%101)::double/100,'b':(o_orderkey%89)::double/88,'s':o_orderstatus}, o_orderkey) r from orders group by 1,2),
       h as (select id, arg_max(r.a::float, run) a from f group by id), g as (select id, arg_max(r.b::float, run) b from f where r.s<>'P' group by id),
       v as (select c_custkey station_id, c_name as name, floor(c_acctbal)::bigint "space", (a+b)::double/2 x from customer join h on h.id=c_custkey join g on g.id=c_custkey where c_mktsegment='BUILDING'),
       k as (select *, row_number() over (order by x, station_id) lo, row_number() over (order by x desc, station_id) hi from v)
       select list, station_id::int station_id, name, "space", round(x,5) avg_fill from (select 'all' list, * from k union all select 'low', * from k where lo<=25 union all select 'high', * from k where hi<=25)""",
    "serve_forecast": """with f as (select o_custkey id, o_orderdate run, arg_max({'a':(o_orderkey%101)::double/100,'b':(o_orderkey%89)::double/88,'s':o_orderstatus}, o_orderkey) r from orders group by 1,2),
       t as (select id, run, 0 h, r.a::float v from f union all select id, run, 1, r.b::float from f where r.s<>'P'),
       q as (select distinct o_custkey id from orders where o_orderpriority='1-URGENT'),
       fr as (select t.* from t join q using (id) where run > timestamp '1997-12-31 23:59:00'),
       st as (select id, (id%50)::double/49 p from q join customer on c_custkey=id where c_acctbal>0 and id not in (select id from fr)),
       n as (select id, 0 h, p::float v from st union all select id, 1, greatest(0, least(1, p + 1 + (-0.75::double - 0.5::double*p)))::float from st),
       ins as (select id, h, v, timestamp '1998-01-01' base_ts, timestamp '1998-01-01 00:04:00' run from n)
       select part, id::int station_id, h relative_ts, round(v::double,5) fill_rate, base_ts, run run_ts from (select 'insert' part, id, h, v, base_ts, run from ins union all select 'fresh', id, h, v, base_ts, run from ins
       union all select 'fresh', id, h, v, run, run from fr)""",
    "weather_report": f"""with e as (select event_type, row_number() over (partition by event_type order by ts, event_id) - 1 i, round(value,2)::float v from events),
       p as (select distinct event_type, 22.4::double + length(event_type)*0.31::double lat, 120.1::double + length(event_type)*0.17::double lng from events),
       n as (select event_type, lat, arg_min(zone, (sqrt(pow(lat-zx,2)+pow(lng-zy,2)), zone)) zone from p, {_ZONES} group by 1,2)
       select zone, round(lat,2) lat, timestamp '2024-01-01' + to_hours(i::int) "datetime", v::double temperature from e join n using (event_type)""",
    "describe_ties": "select count(l_quantity) n, round(avg(l_quantity),6) mean, round(stddev_samp(l_quantity),6) std, min(l_quantity) lo, round(quantile_cont(l_quantity,0.25),6) q1, round(quantile_cont(l_quantity,0.5),6) q2, round(quantile_cont(l_quantity,0.75),6) q3, max(l_quantity) hi from lineitem",
    "recursive_forecast_nulls": """with recursive s as (select event_id, user_id, row_number() over (partition by user_id order by ts, event_id) i, try_cast(json_extract_string(props,'$.k') as int) % 61 k from events),
       r as (select user_id, i, event_id, 0.25::double p from s where i=1 union all select s.user_id, s.i, s.event_id, case when s.k=0 or r.p is null then null else greatest(0, 0.5::double*r.p + 1.0::double/s.k) end from r join s on s.user_id=r.user_id and s.i=r.i+1)
       select event_id, round(p,6) p from r""",
    "nearest_zone_text_ids": """with e as (select 'p'||vec_id id, 'z'||label zone, embedding[1]::double x, embedding[2]::double y from embeddings), z as (select zone, min(x) zx, max(y) zy from e group by 1),
       n as (select id, arg_min(z.zone, (sqrt(pow(x-zx,2)+pow(y-zy,2)), z.zone)) zone from e, z group by id) select * from n union all select * from n""",
    "anti_bad_stations_nulls": "with o as (select *, case when o_orderkey%9<>0 then o_custkey end c from orders) select o_orderkey from o where c is null or c not in (select c from o where o_totalprice<5000 and c is not null)",
    "ridge_fit_2": """with m as (select l_suppkey, count(*) n, avg(l_quantity) a, avg(l_discount) b, avg(l_extendedprice) y, covar_pop(l_quantity,l_quantity)*count(*)+1 aa, covar_pop(l_quantity,l_discount)*count(*) ab,
       covar_pop(l_discount,l_discount)*count(*)+1 bb, covar_pop(l_quantity,l_extendedprice)*count(*) ay, covar_pop(l_discount,l_extendedprice)*count(*) byy from lineitem group by 1),
       s as (select *, (ay*bb-byy*ab)/(aa*bb-ab*ab) w1, (byy*aa-ay*ab)/(aa*bb-ab*ab) w2 from m) select l_suppkey, round(w1,3) w1, round(w2,3) w2, round(y-w1*a-w2*b,3) b from s""",
    "group_size_nulls": "select o_orderkey, c, count(*) over (partition by c) n from (select o_orderkey, case when o_orderkey%9<>0 then o_custkey end c from orders)",
}
ORACLE_SQL["split_xy"] = "select event_id, user_id, value from events"
ORACLE_SQL["decode_requests"] = """with o as (select o_orderkey, o_orderkey%11 m, o_custkey c, o_orderkey%7 d from orders)
  select o_orderkey, null::varchar service, null::bigint station_id, 'missing service' problem from o where m in (0,1) union all select o_orderkey, 'weather', null, 'unknown service' from o where m=2
  union all select o_orderkey, 'bike_station_status', null, null from o where m=3 union all select o_orderkey, 'fill_rate_forecast', null, 'no stations' from o where m=4
  union all select o_orderkey, 'fill_rate_forecast', c, null from o where m>4 union all select o_orderkey, 'fill_rate_forecast', d, null from o where m>4"""
_F3 = _OBS + f""", f as (select s.id station_id, ts, z, {_FEAT} from s join st using (id) join region on z=r_regionkey where ts >= timestamp '2024-01-03' and ts < timestamp '2024-01-28'),
  g0 as (select *, {_WIN}, lead(pct,3) over o f3 from f window o as (partition by station_id order by ts)),
  g as (select station_id, ts, pct a, l3 b, m12 c, pct-f3 y from g0 where l3 is not null and m12 is not null and f3 is not null),
  t as (select * from g where a is not null),
  m as (select count(*) n, avg(a) ma, avg(b) mb, avg(c) mc, avg(y) my, var_pop(a)*count(*)+1 aa, var_pop(b)*count(*)+1 bb, var_pop(c)*count(*)+1 cc, covar_pop(a,b)*count(*) ab, covar_pop(a,c)*count(*) ac,
        covar_pop(b,c)*count(*) bc, covar_pop(a,y)*count(*) ay, covar_pop(b,y)*count(*) byy, covar_pop(c,y)*count(*) cy from t),
  d as (select *, aa*(bb*cc-bc*bc)-ab*(ab*cc-bc*ac)+ac*(ab*bc-bb*ac) det from m),
  w as (select *, (ay*(bb*cc-bc*bc)-ab*(byy*cc-bc*cy)+ac*(byy*bc-bb*cy))/det w1, (aa*(byy*cc-bc*cy)-ay*(ab*cc-bc*ac)+ac*(ab*cy-byy*ac))/det w2, (aa*(bb*cy-byy*bc)-ab*(ab*cy-byy*ac)+ay*(ab*bc-bb*ac))/det w3 from d),
  p as (select station_id, ts, a, my + w1*(a-ma) + w2*(b-mb) + w3*(c-mc) h from g, w)"""
ORACLE_SQL["plan_forecast_rows"] = _F3.replace("\nw as (select r_name", "\nwx as (select r_name") + f""" select station_id, mode, relative_ts, round(v,5) fill_rate, ts base_ts, case when relative_ts=0 then ts else date_trunc('minute', ts + interval 30 minute + interval 30 second) end ts, timestamp '{AS_OF}' run_ts from (
  select station_id, ts, 'serving' mode, 0 relative_ts, a v from p union all select station_id, ts, 'serving', 1, greatest(0,least(1,a+1+h)) from p
  union all select station_id, ts, 'consistent', 0, a from p union all select station_id, ts, 'consistent', 1, greatest(0,least(1,a-h)) from p)"""

ORACLE_SQL["feature_correlations"] = f"with ff as (select * from ({ORACLE_SQL['plan_training_features']})) " + " union all ".join(
    f"""select '{a}' a, '{b}' b, count(*) filter ("{a}" is not null and "{b}" is not null) n, round(nullif(corr("{a}", "{b}"), 'nan'::double), 6) r from ff""" for a in _PAIRED for b in _PAIRED)
