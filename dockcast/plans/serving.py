"""Serving plans: forecasts for requested stations (kept fresh in a
forecast table with insert-ignore), the shortage view, the weather report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockcast.functions import fixed_values as fv
from dockcast.operators import joins, model, serve
from dockcast.session import cut_lineage
from dockcast.sources import readers


class UnknownStations(ValueError):
    pass


def check_requested(requested: DataFrame, stations: DataFrame, column: str = "station_id") -> None:
    """Raise unless the request is non-empty and every id is a known station."""
    if requested.limit(1).count() == 0:
        raise UnknownStations("empty station list")
    unknown = joins.validate_ids(requested, stations.select(F.col("id").alias(column)), column)
    bad = [r[0] for r in unknown.limit(20).collect()]
    if bad:
        raise UnknownStations(f"unknown station ids: {bad}")


def new_forecasts(features: DataFrame, m: model.RidgeModel, *, run_ts, mode: str = "serving") -> DataFrame:
    """Forecast rows (horizon 0 = observed fill, 1 = predicted) for every
    feature row, typed as the forecast table."""
    rows = model.forecast_rows(features, m, station="station_id", base_ts="extraction_ts", pct="pct_full",
                               run_ts=run_ts, horizon_minutes=fv.HORIZON_MINUTES, mode=mode)
    return rows.select(F.col("station_id").cast("int"), F.col("fill_rate").cast("float"),
                       F.col("relative_ts").cast("short"), F.col("base_ts").cast("timestamp"),
                       F.col("run_ts").cast("timestamp"))


def serve_forecast(requested: DataFrame, stations: DataFrame, forecasts: DataFrame, features: DataFrame,
                   m: model.RidgeModel, *, as_of, minutes: int = fv.FRESH_MINUTES):
    """(rows to insert, fresh rows for the request).

    Requested stations holding a forecast fresher than ``minutes`` are
    served from the table; the rest get new forecast rows, which are
    insert-ignored on (station_id, relative_ts, run_ts). Stations whose
    features are incomplete stay without a forecast (and are listed by
    ``plans.features.dropped_stations``)."""
    check_requested(requested, stations)
    stale = serve.stale_ids(requested, forecasts, "station_id", "run_ts", as_of, minutes)
    feats = features.join(stale, "station_id", "left_semi")
    incoming = new_forecasts(feats, m, run_ts=as_of)
    # every new row has run_ts = as_of, so only table rows of that run can
    # conflict: the filter reaches the scan instead of anti-joining history
    same_run = forecasts.filter(F.col("run_ts") == F.lit(as_of).cast("timestamp"))
    to_insert = serve.insert_ignore(same_run, incoming, ["station_id", "relative_ts", "run_ts"])
    state = forecasts.unionByName(to_insert)
    fresh = (serve.filter_fresh(state, "run_ts", as_of, minutes)
                  .join(requested.select("station_id").distinct(), "station_id", "left_semi"))
    return to_insert, fresh


def wide_forecast(forecasts: DataFrame, horizons: Sequence[int] = (0, 1)) -> DataFrame:
    """One row per station: ``fill_rate_t+i`` per horizon from the newest
    run holding it, only stations with every horizon (as the chain of inner
    joins gave)."""
    names = ["fill_rate" if h == 0 else f"fill_rate_t+{h}" for h in horizons]
    return serve.pivot_horizons(forecasts, "station_id", "relative_ts", "fill_rate", list(horizons), names,
                                digits=None, drop_incomplete=True, latest_by="run_ts")


def shortage_view(stations: DataFrame, forecasts: DataFrame, *, city: str | None = None, k: int = 10):
    """(station view, k emptiest, k fullest) by the mean of now and +30 min.
    The view, one row per station, is written to the checkpoint folder: the
    forecasts are read and pivoted once for all three."""
    wide = wide_forecast(forecasts)
    space = ["space"] if "space" in stations.columns else []
    view = (stations.select(F.col("id").alias("station_id"), "name", "city", "area", *space)
                    .join(wide, "station_id")
                    .withColumn("avg_fill", serve.avg_fill("fill_rate", "`fill_rate_t+1`")))
    if city is not None:
        view = view.filter(F.col("city") == city)
    view = cut_lineage(view)
    lowest = serve.top_k(view, "avg_fill", k, tie=["station_id"])
    highest = serve.top_k(view, "avg_fill", k, tie=["station_id"], descending=True)
    return view, lowest, highest


def display(view: DataFrame) -> DataFrame:
    return serve.display_view(view, {"Station": "name", "Area": "area", "Now": "fill_rate",
                                     "In 30 min": "fill_rate_t+1"}, percent=["fill_rate", "fill_rate_t+1"])


def weather_report(landing: DataFrame, zones: DataFrame | None = None) -> DataFrame:
    """Weather landing rows (one per location: epoch start/end, interval,
    hourly arrays) → one row per (location, hour) with the name of the zone
    nearest to the location (a reply's coordinates are the provider's grid)."""
    from dockcast import schemas
    arrays = [v for v in schemas.WEATHER_VARS if v in landing.columns]
    rows = readers.explode_hourly(readers.landing_from_epoch(landing), ["latitude", "longitude"], arrays)
    rows = rows.withColumnRenamed("latitude", "lat").withColumnRenamed("longitude", "lng")
    if zones is None:
        spark = landing.sparkSession
        zones = spark.createDataFrame(fv.WEATHER_ZONES, "zone string, lat double, lng double")
    here = F.struct("lat", "lng").alias("at")
    near = joins.nearest_zone(rows.select(here, "lat", "lng").distinct(), zones, point_id="at", px="lat", py="lng",
                              zone_id="zone", zx="lat", zy="lng", out="zone")
    rows = rows.withColumn("at", here)
    return rows.join(near, rows["at"].eqNullSafe(near["at"]), "left").drop("at")
