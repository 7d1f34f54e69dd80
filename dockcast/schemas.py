"""Explicit schemas of every stored table, and the schema check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

L, S, D, F_, TS, I, SH = (T.LongType(), T.StringType(), T.DoubleType(), T.FloatType(),
                          T.TimestampType(), T.IntegerType(), T.ShortType())


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


STATION_CSV = _struct(("id", L), ("name", S), ("type", L), ("space", L), ("full", L), ("empty", L),
                      ("bike_yb1", L), ("bike_yb2", L), ("bike_eyb", L), ("city", S), ("area", S),
                      ("lat", D), ("lng", D), ("place_id", D), ("address", S), ("is_open", L),
                      ("updated_at", L), ("extraction_ts", TS))

RAW_SNAPSHOT = _struct(("id", L), ("name", S), ("type", L), ("space", L), ("full", L), ("empty", L),
                       ("bike_yb1", L), ("bike_yb2", L), ("bike_eyb", L), ("city", S), ("area", S),
                       ("lat", D), ("lng", D), ("place_id", D), ("address", S), ("is_open", L),
                       ("last_update_ts", TS), ("extraction_ts", TS))

CLEAN_SNAPSHOT = _struct(("id", L), ("name", S), ("lat", D), ("lng", D), ("space", L), ("full", L),
                         ("empty", L), ("bike_yb2", L), ("bike_eyb", L), ("city", S), ("area", S),
                         ("last_update_ts", TS), ("extraction_ts", TS))

# the 13 columns that identify an exact duplicate snapshot row
DUPLICATE_SUBSET = ["id", "space", "full", "empty", "bike_yb2", "bike_eyb", "city", "area", "lat", "lng",
                    "is_open", "last_update_ts", "extraction_ts"]

REQUIRED_RAW = ["id", "space", "full", "empty", "bike_yb2", "bike_eyb", "city", "area", "lat", "lng",
                "last_update_ts", "extraction_ts"]

WEATHER_VARS = ["temperature", "relative_humidity", "apparent_temperature", "precipitation_probability",
                "precipitation", "rain", "showers", "wind_speed", "wind_gusts"]

WEATHER_LANDING = _struct(("latitude", D), ("longitude", D), ("start", L), ("end", L), ("interval", I),
                          *[(v, T.ArrayType(F_)) for v in WEATHER_VARS])

WEATHER_HOURLY = _struct(*[(v, F_) for v in WEATHER_VARS], ("lat", D), ("lng", D), ("zone", S), ("datetime", TS))

WEATHER_CSV = _struct(("datetime", S), ("lat", D), ("lng", D), *[(v, F_) for v in WEATHER_VARS])

STATION_STATUS = _struct(("id", I), ("full", SH), ("empty", SH), ("updated_at", TS))
WEATHER_ZONE = _struct(("id", I), ("name", S), ("lat", F_), ("lng", F_))
BIKE_STATION = _struct(("id", I), ("lat", F_), ("lng", F_), ("city", S), ("name", S), ("area", S),
                       ("weather_zone_id", I), ("created_at", TS))
FILL_RATE_FORECAST = _struct(("station_id", I), ("fill_rate", F_), ("relative_ts", SH), ("base_ts", TS),
                             ("run_ts", TS))
FORECAST_KEY = ["station_id", "relative_ts", "run_ts"]

FEATURES = _struct(("station_id", L), ("extraction_ts", TS), ("pct_full", D), ("month", I), ("day_of_week", I),
                   ("hour", I), ("30m_blag_pct_full", D), ("120m_avg_pct_full", D), ("apparent_temperature", F_),
                   ("precipitation", F_), ("wind_speed", F_), ("1h_fwd_apparent_temperature", F_),
                   ("1h_fwd_precipitation", F_))
FEATURE_COLUMNS = [f.name for f in FEATURES.fields[2:]]


class SchemaMismatch(AssertionError):
    pass


def check_schema(df: DataFrame, schema: T.StructType, *, exact_count: bool = True,
                 require_all: bool = True, ignore_ts_zone: bool = True) -> DataFrame:
    """Raise ``SchemaMismatch`` naming the first failing column; return df.

    Only metadata is compared (no job runs). ``require_all`` also demands
    every schema column be present (the original check let missing key
    columns pass)."""
    want = {f.name: f.dataType for f in schema.fields}
    got = {f.name: f.dataType for f in df.schema.fields}
    if exact_count and len(got) != len(want):
        raise SchemaMismatch(f"expected {len(want)} columns, got {len(got)}: {sorted(got)}")
    for name, t in got.items():
        if name not in want:
            raise SchemaMismatch(f"unexpected column {name!r}")
        w = want[name]
        if ignore_ts_zone and isinstance(t, (T.TimestampType, T.TimestampNTZType)) and \
                isinstance(w, (T.TimestampType, T.TimestampNTZType)):
            continue
        if t != w:
            raise SchemaMismatch(f"column {name!r}: expected {w.simpleString()}, got {t.simpleString()}")
    if require_all:
        missing = [n for n in want if n not in got]
        if missing:
            raise SchemaMismatch(f"missing columns {missing}")
    return df
