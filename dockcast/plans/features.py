"""Feature plans: inputs for training and for prediction, and the feature
matrix itself (occupancy, calendar parts, lag and rolling mean, weather with
its next-hour values, and the 30-minute-ahead target).

One window exchange per key: the lag, rolling mean and target lead share
partitioning and order, so they are declared together in one FrameSpec.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockcast import schemas
from dockcast.functions import fixed_values as fv
from dockcast.functions.scalar import col, hour_floor, occupancy_ratio, time_features
from dockcast.operators import clean, joins, sequence as sq, windows
from dockcast.session import cut_lineage
from dockcast.sources import readers

WEATHER_COLS = ["temperature", "relative_humidity", "apparent_temperature", "precipitation", "wind_speed"]
WEATHER_LEADS = {"1h_fwd_apparent_temperature": "apparent_temperature", "1h_fwd_precipitation": "precipitation"}
LAG_COL, ROLL_COL = "30m_blag_pct_full", "120m_avg_pct_full"
TARGET_COL, TARGET_CHANGE = "30m_fwd_pct_full", "30m_fwd_pct_full_rel_change"


def weather_features(weather: DataFrame, cfg: sq.SkewConfig | None = None) -> DataFrame:
    """One reading per (datetime, zone), then next-hour apparent temperature
    and precipitation per zone."""
    w = clean.dedupe_first(weather, ["datetime", "zone"], [c for c in weather.columns if c not in ("datetime", "zone")])
    return windows.lead_columns(w, "zone", ["datetime"], WEATHER_LEADS, 1, cfg)


def attach_weather(obs: DataFrame, weather: DataFrame, *, zone: str = "weather_zone",
                   ts: str = "extraction_ts") -> DataFrame:
    """Left join of each snapshot with the reading of its hour in its zone.
    Both hour keys are truncated in one declared time zone (the session's),
    on instants, so history and latest rows line up the same way."""
    wx = weather.withColumn("_hour", hour_floor("datetime", ntz=False))
    cols = [c for c in WEATHER_COLS + list(WEATHER_LEADS) if c in wx.columns]
    o = obs.withColumn("_ts_inst", F.col(ts).cast("timestamp"))
    return joins.join_weather_hour(o, wx, zone=zone, ts="_ts_inst", weather_zone="zone", weather_hour="_hour",
                                   columns=cols).drop("_ts_inst")


def _zoned(obs: DataFrame, stations: DataFrame, zones: DataFrame) -> DataFrame:
    z = joins.join_zone_names(obs, stations, zones, obs_id="station_id")
    return z.filter(F.col("weather_zone").isNotNull())  # stations without a zone are dropped


def training_inputs(snapshots: DataFrame, stations: DataFrame, zones: DataFrame, weather: DataFrame, *,
                    start, end, station_ids=None, cfg: sq.SkewConfig | None = None) -> DataFrame:
    """All snapshots with start ≤ extraction_ts < end (partition-pruned),
    optionally some stations only, with zone and hourly weather."""
    s = readers.scan_time_range(snapshots, "extraction_ts", start, end)
    if station_ids is not None:
        s = joins.filter_ids(s, "id", station_ids)
    s = s.withColumnRenamed("id", "station_id")
    return attach_weather(_zoned(s, stations, zones), weather_features(weather, cfg))


def prediction_inputs(status: DataFrame, snapshots: DataFrame, stations: DataFrame, zones: DataFrame,
                      weather_latest: DataFrame, *, history_minutes: int = 120, station_ids=None,
                      cfg: sq.SkewConfig | None = None) -> DataFrame:
    """Latest status of each station plus its snapshots of the preceding
    ``history_minutes`` (enough rows for the lag and rolling mean), with
    zone and the latest weather report."""
    latest = status.select(F.col("id"), F.col("full").cast("long"), F.col("empty").cast("long"),
                           F.col("updated_at").cast("timestamp").alias("extraction_ts"))
    newest = latest.agg(F.max("extraction_ts").alias("_t")).first()["_t"]
    hist = readers.scan_time_range(snapshots, "extraction_ts",
                                   F.lit(newest) - F.expr(f"INTERVAL {history_minutes} MINUTES"), F.lit(newest))
    hist = hist.join(latest.select("id"), "id").select("id", "full", "empty", "extraction_ts")
    # a history row at the status time is the same snapshot: keep the status row
    both = clean.dedupe_first(latest.withColumn("_src", F.lit(0)).unionByName(hist.withColumn("_src", F.lit(1))),
                              ["id", "extraction_ts"], ["_src"]).drop("_src")
    if station_ids is not None:
        both = joins.filter_ids(both, "id", station_ids)
    both = both.withColumnRenamed("id", "station_id")
    return attach_weather(_zoned(both, stations, zones), weather_features(weather_latest, cfg))


def feature_matrix(inputs: DataFrame, *, with_target: bool = False, by: str = "rows",
                   cfg: sq.SkewConfig | None = None) -> DataFrame:
    """Occupancy, month / day of week (Mon=0) / hour, lag and mean of the fill
    per station, and the fill ahead as target.

    ``by='rows'`` counts rows (3-row lag and lead, 12-row mean, one pass), which
    is 30 and 120 minutes only where no snapshot is missing; ``by='time'`` asks
    for the last snapshot at or before 30 minutes ago, the mean of the last 120
    minutes and the first snapshot at or after 30 minutes ahead. Snapshots of
    one station at one time are ordered by their counts.
    """
    f = inputs.withColumn("pct_full", occupancy_ratio("full", "empty"))
    for name, c in time_features("extraction_ts").items():
        f = f.withColumn(name, c.cast("int"))
    tie = ["full", "empty"]
    if by == "time":
        lag = {"tie": tie, "cfg": cfg}
        f = windows.as_of_columns(f, "station_id", "extraction_ts", {LAG_COL: "pct_full"}, 60 * fv.HORIZON_MINUTES, **lag)
        f = windows.time_rolling_mean(f, "station_id", "extraction_ts", "pct_full", 60 * fv.SNAPSHOT_MINUTES * fv.ROLLING_ROWS, ROLL_COL, **lag)
        if with_target:
            f = windows.as_of_columns(f, "station_id", "extraction_ts", {TARGET_COL: "pct_full"}, 60 * fv.HORIZON_MINUTES, ahead=True, **lag)
    elif by == "rows":
        spec = (windows.FrameSpec().lag(LAG_COL, "pct_full", fv.LAG_ROWS)
                .rolling_mean(ROLL_COL, "pct_full", fv.ROLLING_ROWS))
        if with_target:
            spec = spec.lead(TARGET_COL, "pct_full", fv.LAG_ROWS)
        f = spec.apply(f, "station_id", ["extraction_ts", *tie], cfg)
    else:
        raise ValueError(f"by must be 'rows' or 'time', not {by!r}")
    if with_target:
        f = f.withColumn(TARGET_CHANGE, F.col("pct_full") - col(TARGET_COL))
    return f


def prediction_features(inputs: DataFrame, cfg: sq.SkewConfig | None = None) -> DataFrame:
    """Rows at the newest extraction time with every model input present,
    in the feature schema (stations with a gap are dropped here). The inputs (a
    few snapshots per station) are written to the checkpoint folder first, as
    they are read twice: for the newest time and for the window."""
    inputs = cut_lineage(inputs)
    f = feature_matrix(inputs, cfg=cfg)
    newest = inputs.agg(F.max("extraction_ts").alias("_newest"))
    f = f.join(F.broadcast(newest), F.col("extraction_ts") == F.col("_newest"), "left_semi")  # one row
    f = f.dropna(subset=["wind_speed", "pct_full", LAG_COL, ROLL_COL])
    return project_features(f)


def training_features(inputs: DataFrame, cfg: sq.SkewConfig | None = None, by: str = "rows") -> DataFrame:
    """Every row with features and the target; rows lacking lag, mean or
    target are dropped (the training-set rule)."""
    f = feature_matrix(inputs, with_target=True, by=by, cfg=cfg)
    return f.dropna(subset=[LAG_COL, ROLL_COL, TARGET_COL])


def project_features(df: DataFrame) -> DataFrame:
    out = df.select(*[col(f.name).cast(f.dataType).alias(f.name) for f in schemas.FEATURES.fields])
    return schemas.check_schema(out, schemas.FEATURES)


def dropped_stations(inputs: DataFrame, features: DataFrame) -> DataFrame:
    """Stations present in the inputs but without a feature row (so they
    get no forecast) — the status frame the original left implicit."""
    return inputs.select("station_id").distinct().join(features.select("station_id"), "station_id", "left_anti")


def stations_with_gaps(features: DataFrame, column: str = "pct_full") -> DataFrame:
    """Stations having any null ``column`` (the EDA drops them whole)."""
    return features.groupBy("station_id").agg(F.bool_or(col(column).isNull()).alias("_g")).filter("_g").select("station_id")


def drop_stations_with_gaps(features: DataFrame, column: str = "pct_full") -> DataFrame:
    return features.join(stations_with_gaps(features, column), "station_id", "left_anti")


def forward_fill_features(features: DataFrame, columns: Sequence[str],
                          cfg: sq.SkewConfig | None = None) -> DataFrame:
    """Fill gaps with the station's own last value (never another station's);
    all columns in one pass."""
    names = {f"_ff_{i}": c for i, c in enumerate(columns)}
    out = sq.carry_forward_all(features, "station_id", ["extraction_ts"], {o: F.col(f"`{c}`") for o, c in names.items()}, cfg=cfg)
    return out.select(*[F.col(o).alias(c) if (o := next((k for k, v in names.items() if v == c), None)) else F.col(f"`{c}`") for c in features.columns])
