"""Operator catalog bound to the driver's tables.

Each entry runs one library operator on whole tables, with the station
vocabulary mapped onto the driver data:

* station = ``events.user_id``, snapshot time = ``events.ts`` (event_id breaks
  ties), bikes = ``events.value``, empty docks = ``props.k``, weather zone =
  ``event_type``, hourly weather = hourly mean of ``value`` per event_type;
* raw snapshot rows with duplicates = ``lineitem`` keyed by
  (l_orderkey, l_linenumber), which is not unique;
* dimensions = customer → nation; points = first two embedding coordinates,
  zones = the centroid of each embedding label.

``ORACLE_SQL`` holds an independent SQL formulation of every entry.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockcast.functions import scalar as fx
from dockcast.operators import aggregates as agg
from dockcast.operators import clean, joins, model, serve, setops, summary, windows
from dockcast.session import cut_lineage
from dockcast.sources import readers

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values of the bindings (parameters, chosen once).
KEY, TS, TIE = "user_id", "ts", "event_id"
ORDER = [TS, TIE]
RIDGE_ALPHA = 1.0
SPLIT_TS = "2024-01-20 00:00:00"
PRIORITY_MAP = {"1-URGENT": "U", "2-HIGH": "H"}


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return readers.read_table(spark, sf_dir, name)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as station snapshots: pct = full / (full + empty)."""
    e = _t(spark, sf_dir, "events")
    return e.select("event_id", "user_id", "ts", "event_type", "value",
                    fx.json_int_field("props", "k").alias("k")).withColumn(
        "pct", fx.occupancy_ratio("value", "k"))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """3-row lag and 3-row lead of pct per station, one window pass."""
    spec = windows.FrameSpec().lag("lag3", "pct", 3).lead("fwd3", "pct", 3)
    return spec.apply(observations(spark, sf_dir), KEY, ORDER)


def hourly_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _t(spark, sf_dir, "events")
    return (e.groupBy("event_type", fx.hour_floor("ts").alias("h"))
             .agg(F.avg("value").alias("v")))


def _training(spark, sf_dir):
    """Rows with a target: y = pct − pct three rows ahead, x = pct."""
    f = features(spark, sf_dir)
    return f.filter(F.col("fwd3").isNotNull() & F.col("pct").isNotNull()).withColumn(
        "y", F.col("pct") - F.col("fwd3"))


# --------------------------------------------------------------------------
# scalar functions
# --------------------------------------------------------------------------

def q_occupancy_ratio(spark, sf_dir):
    return observations(spark, sf_dir).select("event_id", F.round("pct", 6).alias("pct_full"))


def q_time_features(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    return e.select("event_id", *[c.alias(n) for n, c in fx.time_features("ts").items()])


def q_hour_key(spark, sf_dir):
    return _t(spark, sf_dir, "events").select("event_id", fx.hour_key("ts").alias("y_m_d_h"))


def q_forecast_ts(spark, sf_dir):
    return _t(spark, sf_dir, "events").select("event_id", fx.forecast_ts("ts", 30).alias("forecast_ts"))


def q_clip01(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    return e.select("event_id", F.round(fx.clip01(F.col("value") / 100), 6).alias("v"))


def q_map_default(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return o.select("o_orderkey", fx.map_default("o_orderpriority", PRIORITY_MAP).alias("p"))


# --------------------------------------------------------------------------
# filters, scans, dedupes
# --------------------------------------------------------------------------

def q_filter_valid(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    rules = [~F.col("l_returnflag").eqNullSafe("R"), F.col("l_quantity") < 5, F.col("l_tax") < 0.01,
             F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp_ntz"),
             F.col("l_quantity") < F.col("l_discount") * 100 - 2]
    return clean.filter_valid(li, required=[], rules=rules).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def q_scan_time_range(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    return readers.scan_time_range(e, "ts", "2024-01-10 00:00:00", "2024-01-11 00:00:00").select("event_id")


def q_scan_latest(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    return agg.latest_rows(e, "ts", unit="day").select("event_id")


def q_filter_latest_ts(spark, sf_dir):
    return agg.latest_rows(_t(spark, sf_dir, "orders"), "o_orderdate").select("o_orderkey")


def q_dedupe_subset(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                             "l_extendedprice")
    d = clean.dedupe_first(li, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_extendedprice"])
    return d.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def q_drop_shared_position(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return clean.drop_shared(li, ["l_orderkey", "l_linenumber"])


# --------------------------------------------------------------------------
# aggregates / profiles
# --------------------------------------------------------------------------

def q_key_uniqueness(spark, sf_dir):
    return agg.key_uniqueness(_t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "n", "groups")


def q_null_profile(spark, sf_dir):
    return agg.null_profile(features(spark, sf_dir), {"lag3_nulls": "lag3", "fwd3_nulls": "fwd3"})


def q_value_counts(spark, sf_dir):
    return agg.value_counts(_t(spark, sf_dir, "events"), "event_type", "n")


def q_ratio_by_group(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return agg.ratio_by_group(o, "o_orderpriority", F.col("o_orderstatus") == "F", "r")


def q_check_sums(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return agg.check_sums(li, F.col("l_quantity") == F.col("l_linenumber") * 5, "bad", "n")


def q_describe(spark, sf_dir):
    return agg.describe(_t(spark, sf_dir, "events"), "value")


def q_profile_hour_dow(spark, sf_dir):
    o = observations(spark, sf_dir)
    return agg.group_mean(o, {"h": fx.hour_part("ts"), "d": fx.weekday_part("ts")}, F.col("pct"), "m")


def q_bin_histogram(spark, sf_dir):
    return agg.bin_histogram(_t(spark, sf_dir, "events"), "value", [0, 10, 25, 50], "b", "n")


def q_corr_matrix(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return agg.corr_matrix(li, {"a": ("l_quantity", "l_extendedprice"), "b": ("l_quantity", "l_discount"),
                                "c": ("l_extendedprice", "l_discount")})


# --------------------------------------------------------------------------
# windows
# --------------------------------------------------------------------------

def q_lead_weather(spark, sf_dir):
    wx = windows.lead_columns(hourly_weather(spark, sf_dir), "event_type", ["h"], {"fwd": "v"})
    return wx.select("event_type", "h", F.round("v", 6).alias("v"), F.round("fwd", 6).alias("fwd"))


def q_lag_occupancy(spark, sf_dir):
    return features(spark, sf_dir).select("event_id", F.round("lag3", 6).alias("lag3"))


def q_rolling_mean(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    r = windows.rolling_mean(e, KEY, ORDER, "value", 12, "m")
    return r.select("event_id", F.round("m", 6).alias("m"))


def q_target_lead(spark, sf_dir):
    f = features(spark, sf_dir).filter(F.col("fwd3").isNotNull())
    return f.select("event_id", F.round(F.col("pct") - F.col("fwd3"), 6).alias("chg"))


def q_describe_all(spark, sf_dir):
    return summary.describe_all(_t(spark, sf_dir, "lineitem").drop("l_shipdate"))


def _hourly(spark, sf_dir):
    """Observations stamped with their hour: gaps, and many rows at one time."""
    return observations(spark, sf_dir).withColumn("t", F.date_trunc("hour", "ts").cast("timestamp_ntz"))


def q_lag_as_of(spark, sf_dir):
    """Fill of the last snapshot at or before one hour ago, and its time."""
    o = windows.as_of_columns(_hourly(spark, sf_dir), KEY, "t", {"was": "pct"}, 3600, tie=[TIE], found_at="was_at")
    return o.select("event_id", F.round("was", 6).alias("was"), "was_at")


def q_lead_as_of(spark, sf_dir):
    """Change towards the first snapshot at or after three hours ahead, if
    there is one within the twelve hours that follow."""
    o = windows.as_of_columns(_hourly(spark, sf_dir), KEY, "t", {"then": "pct", "then_id": "event_id"}, 3 * 3600, tie=[TIE], ahead=True, max_age=12 * 3600)
    return o.select("event_id", "then_id", F.round(F.col("pct") - F.col("then"), 6).alias("chg"))


def q_ffill(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    v = F.when(F.col("event_type") == "purchase", F.col("value"))
    return windows.forward_fill(e, KEY, ORDER, v, "v").select("event_id", "v")


def q_tail_n(spark, sf_dir):
    return windows.tail_n(_t(spark, sf_dir, "events"), KEY, ORDER, 5).select("event_id")


def q_top_shortage(spark, sf_dir):
    return serve.station_ranking(observations(spark, sf_dir), KEY, F.col("pct"), k=10, out="a")


# --------------------------------------------------------------------------
# joins
# --------------------------------------------------------------------------

def q_join_station_zone(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    n = _t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return joins.lookup_join(joins.lookup_join(o, c, "o_custkey"), n, "c_nationkey").select("o_orderkey", "n_name")


def q_join_weather_hour(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    j = joins.join_weather_hour(e, hourly_weather(spark, sf_dir), zone="event_type", ts="ts",
                                weather_zone="event_type", weather_hour="h", columns=["v"], shift_hours=1)
    return j.select("event_id", F.round("v", 6).alias("v"))


def _points(spark, sf_dir):
    emb = _t(spark, sf_dir, "embeddings")
    return emb.select("vec_id", "label", F.element_at("embedding", 1).cast("double").alias("x"),
                      F.element_at("embedding", 2).cast("double").alias("y"))


def q_nearest_zone(spark, sf_dir):
    """Zones = the centroid of each label's points (a small aggregate of the
    table); every point gets its nearest zone."""
    p = _points(spark, sf_dir)
    zones = p.groupBy("label").agg(F.avg("x").alias("zx"), F.avg("y").alias("zy"))
    return joins.nearest_zone(p, zones, point_id="vec_id", px="x", py="y", zone_id="label", zx="zx", zy="zy",
                              out="zone")


def q_anti_new_stations(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select("c_custkey")
    o = _t(spark, sf_dir, "orders").filter(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
    return joins.anti_join(c, o.select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


def q_anti_bad_stations(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    bad = o.filter(F.col("o_totalprice") < 5000)
    return joins.not_in(o, "o_custkey", bad, "o_custkey").select("o_orderkey")


def q_pivot_horizons(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    return serve.pivot_horizons(e, KEY, "event_type", "value", ["click", "view"])


def q_union_horizons(spark, sf_dir):
    f = features(spark, sf_dir)
    return setops.stack_rows(
        f, ["event_id"],
        [{"relative_ts": F.lit(0), "fill_rate": F.round("pct", 6)},
         {"relative_ts": F.lit(1), "fill_rate": F.round("fwd3", 6)}],
        keep_if=[None, F.col("fwd3").isNotNull()])


def q_id_difference(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    o = _t(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    return setops.id_difference(c, "c_custkey", o, "o_custkey", "id")


def q_sink_upsert(spark, sf_dir):
    """Status table = each user's first value; update batch = each user's
    latest signup value; new state after the upsert."""
    e = _t(spark, sf_dir, "events")
    base = e.groupBy(KEY).agg(F.min_by("value", "event_id").alias("v"))
    upd = e.filter(F.col("event_type") == "signup").groupBy(KEY).agg(F.max_by("value", "event_id").alias("v"))
    return serve.upsert(base, upd, [KEY])


def q_sink_insert_ignore(spark, sf_dir):
    """Forecast table = events before Jan 20; incoming = events from Jan 15
    (overlapping); state after insert-ignore on event_id."""
    e = _t(spark, sf_dir, "events").select("event_id", "ts", "value")
    target = e.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    incoming = e.filter(F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz"))
    return serve.insert_ignore_state(target, incoming, ["event_id"]).select("event_id", "value")


def q_explode_hourly(spark, sf_dir):
    """Per station, its values as hourly landing arrays from 2024-01-01,
    exploded back to one row per hour."""
    e = _t(spark, sf_dir, "events")
    landing = readers.hourly_landing(e, KEY, ORDER, "value", start="2024-01-01 00:00:00")
    return readers.explode_hourly(landing, [KEY], ["value"]).select(KEY, "datetime", "value")


# --------------------------------------------------------------------------
# model
# --------------------------------------------------------------------------

def q_ridge_fit(spark, sf_dir):
    m = model.ridge_fit_1d_df(_training(spark, sf_dir), "pct", "y", alpha=RIDGE_ALPHA)
    return m.select(F.round("w", 6).alias("w"), F.round("b", 6).alias("b"))


def q_forecast_rows(spark, sf_dir):
    t = cut_lineage(_training(spark, sf_dir).select("event_id", "pct", "y"))  # one window for fit and apply
    m = model.ridge_fit(t, ["pct"], "y", alpha=RIDGE_ALPHA)
    return model.forecast_fill(t, m, pct="pct", out="fill_rate").select(
        "event_id", F.round("fill_rate", 6).alias("fill_rate"))


def q_r2(spark, sf_dir):
    t = cut_lineage(_training(spark, sf_dir).select("pct", "y"))
    m = model.ridge_fit(t, ["pct"], "y", alpha=RIDGE_ALPHA)
    return model.r2_score(model.predict(t, m, "yh"), "y", "yh").select(F.round("r2", 6).alias("r2"))


def q_time_split(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    return e.groupBy(model.split_label("ts", F.lit(SPLIT_TS).cast("timestamp_ntz")).alias("part")).agg(
        F.count(F.lit(1)).alias("n"))


def q_recursive_forecast(spark, sf_dir):
    """Fixed linear step in place of a fitted model: p₁ = max(0, 0.9·pct − 0.02),
    pₙ = max(0, 0.9·pₙ₋₁ − 0.02 + 0.05·(event_id mod 2))."""
    o = observations(spark, sf_dir).select("event_id", "user_id", "ts", "pct")  # what the Python step needs
    r = model.recursive_forecast(
        o, KEY, ORDER, step_slope=F.lit(0.9),
        step_offset=[F.lit(-0.02), F.lit(0.05) * (F.col("event_id") % 2)],
        first_value=F.col("pct") * 0.9 - 0.02, floor=0.0, out="p")
    return r.select("event_id", F.round("p", 6).alias("p"))


def q_stream_occupancy_window(spark, sf_dir):
    from dockcast.streaming import streams
    e = _t(spark, sf_dir, "events")
    return streams.occupancy_windows(e, KEY, "ts", "value").select(
        KEY, "w", F.round("v", 6).alias("v"))


# --------------------------------------------------------------------------
# more filters, joins, aggregates, sinks and composites
# --------------------------------------------------------------------------

AS_OF_EVENTS = "2024-01-30 12:00:00"
AS_OF_ORDERS = "1998-01-01 00:00:00"


def q_filter_ids(spark, sf_dir):
    """Requested stations given as a table (semi join, not a literal list)."""
    o = _t(spark, sf_dir, "orders")
    ids = _t(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    return joins.filter_ids(o, "o_custkey", ids).select("o_orderkey")


def q_validate_ids(spark, sf_dir):
    """Requested ids that are not known (a valid request returns nothing)."""
    req = _t(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("id"))
    known = _t(spark, sf_dir, "part").filter(F.col("p_size") <= 25).select(F.col("p_partkey").alias("id"))
    return joins.validate_ids(req, known, "id")


def q_drop_na_features(spark, sf_dir):
    f = features(spark, sf_dir).dropna(subset=["pct", "lag3", "fwd3"])
    return f.select("event_id")


def q_filter_fresh(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    return serve.filter_fresh(e, "ts", AS_OF_EVENTS, minutes=300).select("event_id")


def q_needs_refresh(spark, sf_dir):
    return serve.needs_refresh(_t(spark, sf_dir, "events"), "ts", "2024-01-30 23:59:00", 5, "stale")


def q_display_view(spark, sf_dir):
    m = observations(spark, sf_dir).groupBy(KEY).agg(F.avg("pct").alias("fill"))
    return serve.display_view(m, {"user_id": "user_id", "fill_pct": "fill"}, percent=["fill"])


def q_join_status_station(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("id"))
    c = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_name")
    return joins.lookup_join(o, c, "id", how="inner").select("o_orderkey", "c_name")


def q_anti_stale_forecasts(spark, sf_dir):
    """Customers (requested stations) without an order (forecast) fresher
    than a year before the as-of time."""
    req = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("station_id"))
    fc = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("station_id"), F.col("o_orderdate").alias("run_ts"))
    return serve.stale_ids(req, fc, "station_id", "run_ts", AS_OF_ORDERS, minutes=525_600)


def q_dedupe_weather(spark, sf_dir):
    """One reading per (zone, hour): the first of the hour."""
    e = _t(spark, sf_dir, "events").select("event_type", fx.hour_floor("ts").alias("h"), "ts", "event_id", "value")
    d = clean.dedupe_first(e, ["event_type", "h"], ["ts", "event_id"])
    return d.select("event_type", "h", "value")


def q_distinct_values(spark, sf_dir):
    return agg.distinct_values(_t(spark, sf_dir, "orders"), "o_orderstatus").withColumnRenamed("o_orderstatus", "s")


def q_unique_ids(spark, sf_dir):
    return agg.overview(_t(spark, sf_dir, "events"), KEY, TS)


def q_avg_fill(spark, sf_dir):
    w = serve.pivot_horizons(_t(spark, sf_dir, "events"), KEY, "event_type", "value", ["click", "view"],
                             digits=None)
    return w.select(KEY, F.round(serve.avg_fill("click", "view"), 6).alias("avg_fill"))


def q_group_size(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return clean.group_size(li, ["l_orderkey", "l_linenumber"], "n")


def q_time_rolling_mean(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    r = windows.time_rolling_mean(e, KEY, TS, "value", 7200, "m", tie=[TIE])
    return r.select("event_id", F.round("m", 6).alias("m"))


def q_sample_rows(spark, sf_dir):
    return agg.hash_sample(_t(spark, sf_dir, "events"), "event_id", 0.05).select("event_id")


def q_limit_ids(spark, sf_dir):
    return serve.top_k(_t(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", 100)


def q_union_by_name(spark, sf_dir):
    """History files with drifting columns stacked by name (missing → null)."""
    a = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("okey"), "o_totalprice")
    b = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("okey"), "l_quantity")
    return setops.union_by_name(a, b)


def q_out_json(spark, sf_dir):
    c = _t(spark, sf_dir, "events").groupBy(KEY).agg(F.count(F.lit(1)).alias("n"))
    return serve.to_json_rows(c.select(KEY, "n"), "json")


def q_ridge_fit_station(spark, sf_dir):
    per = model.ridge_fit_per_key(_training(spark, sf_dir), KEY, ["pct"], "y", alpha=RIDGE_ALPHA)
    return per.select(KEY, F.round("w_pct", 6).alias("w"), F.round("intercept", 6).alias("b"))


def q_training_features(spark, sf_dir):
    """Composite: occupancy → calendar parts → lag, 12-row mean and 3-row
    target in one window pass → zone weather of the hour with its next-hour
    value → rows with lag, mean and target present."""
    o = observations(spark, sf_dir)
    for name, c in fx.time_features("ts").items():
        o = o.withColumn(name, c)
    spec = (windows.FrameSpec().lag("lag3", "pct", 3).rolling_mean("m12", "pct", 12).lead("fwd3", "pct", 3))
    f = spec.apply(o, KEY, ORDER)
    wx = windows.lead_columns(hourly_weather(spark, sf_dir), "event_type", ["h"], {"v_fwd": "v"})
    j = joins.join_weather_hour(f, wx, zone="event_type", ts="ts", weather_zone="event_type", weather_hour="h",
                                columns=["v", "v_fwd"])
    j = j.dropna(subset=["lag3", "m12", "fwd3"])
    return j.select("event_id", F.round("pct", 6).alias("pct_full"), "month", "day_of_week", "hour",
                    F.round("lag3", 6).alias("lag3"), F.round("m12", 6).alias("m12"),
                    F.round("v", 6).alias("wx"), F.round("v_fwd", 6).alias("wx_fwd"),
                    F.round(F.col("pct") - F.col("fwd3"), 6).alias("chg"))


def q_tz_convert(spark, sf_dir):
    """Snapshot times kept as UTC wall clock → local (Taipei) wall clock."""
    e = _t(spark, sf_dir, "events")
    return e.select("event_id", fx.wall_clock("ts", "UTC", "Asia/Taipei").alias("local_ts"))


def q_relative_days(spark, sf_dir):
    """History report range for each snapshot: days −13 … −7 as date text."""
    e = _t(spark, sf_dir, "events")
    return e.select("event_id", fx.relative_day_text("ts", 13).alias("start_day"),
                    fx.relative_day_text("ts", 7).alias("end_day"))


def q_filter_valid_eda(spark, sf_dir):
    """The exploratory rule set on the same rows: a null check on one column
    and no capacity rule."""
    li = _t(spark, sf_dir, "lineitem")
    rules = [~F.col("l_returnflag").eqNullSafe("R"), F.col("l_quantity") < 5, F.col("l_tax") < 0.01,
             F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp_ntz")]
    return clean.filter_valid(li, required=["l_returnflag"], rules=rules).select("l_orderkey", "l_linenumber")


def q_ts_text(spark, sf_dir):
    """Snapshot times as file-name stamps and as SQL-store text, and the
    store text parsed back."""
    from dockcast.functions.fixed_values import DB_TS_FORMAT, FILE_TS_FORMAT
    e = _t(spark, sf_dir, "events")
    return e.select("event_id", fx.ts_text("ts", FILE_TS_FORMAT).alias("file_ts"),
                    fx.ts_text("ts", DB_TS_FORMAT).alias("db_ts"),
                    fx.parse_ts(fx.ts_text("ts", DB_TS_FORMAT), DB_TS_FORMAT).alias("parsed"))


def q_zone_rolling(spark, sf_dir):
    """Zone-level series (few keys, each a large share of all rows): lag,
    12-row mean and lead of the readings per zone. Once a zone passes the
    hot-key floor (1 Mi rows) it takes the split path."""
    e = _t(spark, sf_dir, "events")
    spec = windows.FrameSpec().lag("lag3", "value", 3).rolling_mean("m12", "value", 12).lead("fwd3", "value", 3)
    f = spec.apply(e, "event_type", ORDER)
    return f.select("event_id", F.round("lag3", 6).alias("lag3"), F.round("m12", 6).alias("m12"),
                    F.round("fwd3", 6).alias("fwd3"))


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}

_OBS = ("with obs as (select event_id, user_id, ts, event_type, value, "
        "cast(json_extract_string(props,'$.k') as int) k, "
        "value/nullif(value+cast(json_extract_string(props,'$.k') as int),0) pct from events)")
_F = (_OBS + ", f as (select *, lag(pct,3) over (partition by user_id order by ts, event_id) lag3, "
      "lead(pct,3) over (partition by user_id order by ts, event_id) fwd3 from obs)")
_M = (_F + ", m as (select regr_sxy(pct-fwd3,pct)/(regr_sxx(pct-fwd3,pct)+1) w, avg(pct-fwd3) my, avg(pct) mx "
      "from f where fwd3 is not null and pct is not null)")
_WX = "with wx as (select event_type, date_trunc('hour',ts) h, avg(value) v from events group by all)"

_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]

ORACLE_SQL: dict[str, str] = {
    "describe_all": " union all ".join(
        [f"""select '{c}' "column", count({c}) n, null::bigint "unique", null::varchar top, null::bigint freq, round(avg({c}),6) mean, round(stddev_samp({c}),6) std, min({c})::double "min",
             round(quantile_cont({c}::double,0.25),6) q1, round(quantile_cont({c}::double,0.5),6) q2, round(quantile_cont({c}::double,0.75),6) q3, max({c})::double "max" from lineitem""" for c in _NUMBERS]
        + [f"""select '{c}', sum(k)::bigint, count(*), arg_min(v, (-k, v)), max(k), null, null, null, null, null, null, null from (select {c} v, count(*) k from lineitem where {c} is not null group by 1)""" for c in ("l_returnflag", "l_linestatus")]),
    "occupancy_ratio": _OBS + " select event_id, round(pct,6) pct_full from obs",
    "time_features": "select event_id, month(ts) \"month\", isodow(ts)-1 day_of_week, hour(ts) \"hour\" from events",
    "hour_key": "select event_id, strftime(ts,'%Y-%m-%d_%H') y_m_d_h from events",
    "forecast_ts": "select event_id, date_trunc('minute', ts + interval 30 minute + interval 30 second) forecast_ts from events",
    "clip01": "select event_id, round(greatest(0, least(1, value/100)),6) v from events",
    "map_default": "select o_orderkey, case o_orderpriority when '1-URGENT' then 'U' when '2-HIGH' then 'H' else 'N/A' end p from orders",
    "filter_valid": "select l_orderkey,l_linenumber,l_partkey,l_suppkey from lineitem where not (l_returnflag is distinct from 'R' or l_quantity<5 or l_tax<0.01 or l_shipdate < timestamp '1996-01-01' or l_quantity < l_discount*100-2)",
    "scan_time_range": "select event_id from events where ts>=timestamp '2024-01-10' and ts<timestamp '2024-01-11'",
    "scan_latest": "select event_id from events where date_trunc('day',ts)=(select max(date_trunc('day',ts)) from events)",
    "filter_latest_ts": "select o_orderkey from orders where o_orderdate=(select max(o_orderdate) from orders)",
    "dedupe_subset": "select l_orderkey,l_linenumber,l_partkey,l_suppkey from (select *, row_number() over (partition by l_orderkey,l_linenumber order by l_partkey,l_suppkey,l_extendedprice) rn from lineitem) where rn=1",
    "drop_shared_position": "select l_orderkey,l_linenumber,l_partkey from (select *, count(*) over (partition by l_orderkey,l_linenumber) n from lineitem) where n=1",
    "key_uniqueness": "select n, count(*) groups from (select count(*) n from lineitem group by l_orderkey,l_linenumber) group by n",
    "null_profile": _F + " select count(*)-count(lag3) lag3_nulls, count(*)-count(fwd3) fwd3_nulls from f",
    "value_counts": "select event_type, count(*) n from events group by 1",
    "ratio_by_group": "select o_orderpriority, round(count(*) filter (o_orderstatus='F')*1.0/count(*),6) r from orders group by 1",
    "check_sums": "select count(*) filter (l_quantity<>l_linenumber*5) bad, count(*) n from lineitem",
    "describe": "select count(value) n, round(avg(value),6) mean, round(stddev_samp(value),6) std, min(value) lo, round(quantile_cont(value,0.25),6) q1, round(quantile_cont(value,0.5),6) q2, round(quantile_cont(value,0.75),6) q3, max(value) hi from events",
    "profile_hour_dow": _OBS + " select hour(ts) h, isodow(ts)-1 d, round(avg(pct),6) m from obs group by all",
    "bin_histogram": "select case when value>0 and value<=10 then '(0,10]' when value>10 and value<=25 then '(10,25]' when value>25 and value<=50 then '(25,50]' end b, count(*) n from events group by 1",
    "corr_matrix": "select round(corr(l_quantity,l_extendedprice),6) a, round(corr(l_quantity,l_discount),6) b, round(corr(l_extendedprice,l_discount),6) c from lineitem",
    "lead_weather": _WX + " select event_type,h,round(v,6) v,round(lead(v) over (partition by event_type order by h),6) fwd from wx",
    "lag_occupancy": _F + " select event_id, round(lag3,6) lag3 from f",
    "rolling_mean": "select event_id, case when count(value) over w=12 then round(avg(value) over w,6) end m from events window w as (partition by user_id order by ts,event_id rows between 11 preceding and current row)",
    "target_lead": _F + " select event_id, round(pct-fwd3,6) chg from f where fwd3 is not null",
    "lag_as_of": _OBS + """, h as (select *, date_trunc('hour',ts) t from obs), p as (select user_id, t, arg_max({'v': pct}, event_id) r from h group by all)
        select event_id, round(p.r.v,6) was, p.t was_at from h asof left join p on h.user_id=p.user_id and h.t - interval 1 hour >= p.t""",
    "lead_as_of": _OBS + """, h as (select *, date_trunc('hour',ts) t from obs), p as (select user_id, t, arg_min({'v': pct, 'e': event_id}, event_id) r from h group by all)
        select event_id, case when p.t <= h.t + interval 15 hour then p.r.e end then_id, case when p.t <= h.t + interval 15 hour then round(pct-p.r.v,6) end chg
        from h asof left join p on h.user_id=p.user_id and h.t + interval 3 hour <= p.t""",
    "ffill": "select event_id, last_value(case when event_type='purchase' then value end ignore nulls) over (partition by user_id order by ts,event_id rows between unbounded preceding and current row) v from events",
    "tail_n": "select event_id from (select event_id,row_number() over (partition by user_id order by ts desc,event_id desc) r from events) where r<=5",
    "top_shortage": _OBS + " select user_id, round(avg(pct),6) a from obs group by 1 order by a, user_id limit 10",
    "join_station_zone": "select o_orderkey, n_name from orders left join customer on o_custkey=c_custkey left join nation on c_nationkey=n_nationkey",
    "join_weather_hour": _WX + " select event_id, round(v,6) v from events e left join wx on wx.event_type=e.event_type and wx.h=date_trunc('hour',e.ts)+interval 1 hour",
    "nearest_zone": "with p as (select vec_id, label, cast(embedding[1] as double) x, cast(embedding[2] as double) y from embeddings), z as (select label, avg(x) zx, avg(y) zy from p group by label) select vec_id, zone from (select a.vec_id, z.label zone, row_number() over (partition by a.vec_id order by sqrt((a.x-z.zx)**2+(a.y-z.zy)**2), z.label) r from p a, z) where r=1",
    "anti_new_stations": "select c_custkey from customer anti join (select * from orders where o_orderdate>=timestamp '2001-01-01') o on o_custkey=c_custkey",
    "anti_bad_stations": "select o_orderkey from orders where o_custkey not in (select o_custkey from orders where o_totalprice<5000)",
    "pivot_horizons": "select user_id, round(avg(value) filter (event_type='click'),6) \"click\", round(avg(value) filter (event_type='view'),6) \"view\" from events group by 1",
    "union_horizons": _F + " select event_id, 0 relative_ts, round(pct,6) fill_rate from f union all select event_id, 1, round(fwd3,6) from f where fwd3 is not null",
    "id_difference": "select c_custkey id from customer except select o_custkey from orders where o_orderstatus='F'",
    "sink_upsert": "with b as (select user_id, arg_min(value,event_id) v from events group by 1), i as (select user_id, arg_max(value,event_id) v from events where event_type='signup' group by 1) select coalesce(i.user_id,b.user_id) user_id, case when i.user_id is not null then i.v else b.v end v from b full join i on i.user_id=b.user_id",
    "sink_insert_ignore": "with t as (select * from events where ts < timestamp '2024-01-20'), i as (select * from events where ts >= timestamp '2024-01-15') select event_id, value from t union all select event_id, value from i where event_id not in (select event_id from t)",
    "explode_hourly": "select user_id, timestamp '2024-01-01' + (row_number() over (partition by user_id order by ts,event_id)-1)*interval 1 hour \"datetime\", value from events",
    "ridge_fit": _M + " select round(w,6) w, round(my-w*mx,6) b from m",
    "forecast_rows": _M + " select event_id, round(greatest(0,least(1,pct+1+(my+w*(pct-mx)))),6) fill_rate from f, m where fwd3 is not null and pct is not null",
    "r2": _M + ", p as (select pct-fwd3 y, my+w*(pct-mx) yh, my from f, m where fwd3 is not null and pct is not null) select round(1-sum((y-yh)**2)/sum((y-my)**2),6) r2 from p",
    "time_split": "select case when ts<=timestamp '2024-01-20' then 'train' else 'test' end part, count(*) n from events group by 1",
    "recursive_forecast": "with recursive " + _OBS[5:] + ", s as (select user_id, event_id, pct, row_number() over (partition by user_id order by ts, event_id) rn from obs), r as (select user_id,event_id,rn,greatest(0,pct*0.9-0.02) p from s where rn=1 union all select s.user_id,s.event_id,s.rn,greatest(0,r.p*0.9-0.02+0.05*(s.event_id%2)) from r join s on s.user_id=r.user_id and s.rn=r.rn+1) select event_id, round(p,6) p from r",
    "stream_occupancy_window": "select user_id, w, round(avg(value),6) v from (select user_id, value, unnest(generate_series(time_bucket(interval 10 minute, ts)-interval 110 minute, time_bucket(interval 10 minute, ts), interval 10 minute)) w from events) group by all",
}

ORACLE_SQL.update({
    "filter_ids": "select o_orderkey from orders where o_custkey in (select c_custkey from customer where c_mktsegment='BUILDING')",
    "validate_ids": "select distinct l_partkey id from lineitem anti join (select p_partkey from part where p_size<=25) k on l_partkey=k.p_partkey",
    "drop_na_features": _F + " select event_id from f where pct is not null and lag3 is not null and fwd3 is not null",
    "filter_fresh": "select event_id from events where ts > timestamp '2024-01-30 12:00:00' - interval 300 minute",
    "needs_refresh": "select coalesce(max(ts) <= timestamp '2024-01-30 23:59:00' - interval 5 minute, true) stale from events",
    "display_view": _OBS + " select user_id, printf('%d%%', cast(round_even(avg(pct)*100, 0) as bigint)) fill_pct from obs group by 1",
    "join_status_station": "select o_orderkey, c_name from orders join customer on o_custkey=c_custkey",
    "anti_stale_forecasts": "select distinct c_custkey station_id from customer anti join (select o_custkey from orders where o_orderdate > timestamp '1998-01-01' - interval 525600 minute) f on c_custkey=f.o_custkey",
    "dedupe_weather": "select event_type, h, value from (select event_type, date_trunc('hour',ts) h, value, row_number() over (partition by event_type, date_trunc('hour',ts) order by ts, event_id) rn from events) where rn=1",
    "distinct_values": "select distinct o_orderstatus s from orders",
    "unique_ids": "select count(distinct user_id) n_stations, max(ts) latest, count(*) n_rows from events",
    "avg_fill": "select user_id, round((avg(value) filter (event_type='click') + avg(value) filter (event_type='view'))/2,6) avg_fill from events group by 1",
    "group_size": "select l_orderkey, l_linenumber, l_partkey, count(*) over (partition by l_orderkey,l_linenumber) n from lineitem",
    "time_rolling_mean": "select event_id, round(avg(value) over (partition by user_id order by ts range between interval 7200 second preceding and current row),6) m from events",
    "sample_rows": "select event_id from events where (event_id*2654435761) % 4294967296 < 214748364",
    "limit_ids": "select c_custkey from customer order by c_custkey limit 100",
    "union_by_name": "select o_orderkey okey, o_totalprice from orders union all by name select l_orderkey okey, l_quantity from lineitem",
    "out_json": "select cast(to_json({'user_id': user_id, 'n': count(*)}) as varchar) json from events group by user_id",
    "ridge_fit_station": _F + " select user_id, round(w,6) w, round(my-w*mx,6) b from (select user_id, regr_sxy(pct-fwd3,pct)/(regr_sxx(pct-fwd3,pct)+1) w, avg(pct-fwd3) my, avg(pct) mx from f where fwd3 is not null and pct is not null group by user_id)",
    "tz_convert": "select event_id, (ts at time zone 'UTC') at time zone 'Asia/Taipei' local_ts from events",
    "relative_days": "select event_id, strftime(cast(ts as date) - interval 13 day, '%Y-%m-%d') start_day, strftime(cast(ts as date) - interval 7 day, '%Y-%m-%d') end_day from events",
    "filter_valid_eda": "select l_orderkey, l_linenumber from lineitem where l_returnflag is not null and not (l_returnflag is distinct from 'R' or l_quantity<5 or l_tax<0.01 or l_shipdate < timestamp '1996-01-01')",
    "ts_text": "select event_id, strftime(ts, '%Y-%m-%d_%H:%M:%S') file_ts, strftime(ts, '%Y-%m-%d %H:%M:%S') db_ts, date_trunc('second', ts) parsed from events",
    "zone_rolling": "select event_id, round(lag(value,3) over w,6) lag3, case when count(value) over w12=12 then round(avg(value) over w12,6) end m12, round(lead(value,3) over w,6) fwd3 from events window w as (partition by event_type order by ts, event_id), w12 as (partition by event_type order by ts, event_id rows between 11 preceding and current row)",
    "training_features": _OBS + ", wx0 as (select event_type, date_trunc('hour',ts) h, avg(value) v from events group by all), wx as (select *, lead(v) over (partition by event_type order by h) v_fwd from wx0), f as (select o.*, lag(pct,3) over w lag3, case when count(pct) over w12 = 12 then avg(pct) over w12 end m12, lead(pct,3) over w fwd3 from obs o window w as (partition by user_id order by ts, event_id), w12 as (partition by user_id order by ts, event_id rows between 11 preceding and current row)) select f.event_id, round(f.pct,6) pct_full, month(f.ts) \"month\", isodow(f.ts)-1 day_of_week, hour(f.ts) \"hour\", round(lag3,6) lag3, round(m12,6) m12, round(wx.v,6) wx, round(wx.v_fwd,6) wx_fwd, round(f.pct-fwd3,6) chg from f left join wx on wx.event_type=f.event_type and wx.h=date_trunc('hour', f.ts) where lag3 is not null and m12 is not null and fwd3 is not null",
})
