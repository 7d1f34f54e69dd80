"""User-level jobs: the scheduled flows of the station product, each one
Spark job over whole tables (ingest a pull, land a weather report, retrain
the model, serve forecasts, register new stations)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockcast import schemas
from dockcast.operators import model, serve
from dockcast.operators.sequence import cached_scope
from dockcast.plans import features as fp
from dockcast.plans import serving, snapshot
from dockcast.session import cut_lineage
from dockcast.sources import readers, sinks


def ingest_snapshot_csv(spark: SparkSession, csv_path: str, raw_layer: str, clean_layer: str, *,
                        as_of=None, pulled_at=None) -> DataFrame:
    """One pull: CSV, stamped with the time of the pull (``pulled_at``) → raw
    layer (all rows) → clean layer. Returns the clean rows."""
    raw = readers.read_snapshot_csv(spark, csv_path, pulled_at).select(*[f.name for f in schemas.RAW_SNAPSHOT.fields])
    sinks.write_layer(raw, raw_layer)
    clean = snapshot.clean_snapshot(raw, as_of=as_of)
    sinks.write_layer(clean, clean_layer)
    return clean


def land_weather(spark: SparkSession, landing: DataFrame, weather_layer: str, zones: DataFrame | None = None) -> DataFrame:
    """Weather response rows (arrays per location) → hourly rows per zone,
    appended to the weather layer partitioned by date."""
    rows = serving.weather_report(landing, zones)
    sinks.write_layer(rows, weather_layer, ts="datetime", sort_by=("zone", "datetime"))
    return rows


@dataclass
class TrainResult:
    model: model.RidgeModel
    r2_test: float | None
    n_train: int


def retrain(spark: SparkSession, clean_layer: DataFrame, stations: DataFrame, zones: DataFrame,
            weather: DataFrame, *, start, end, model_path: str, split=None, alpha: float = 1.0) -> TrainResult:
    """Training features over [start, end) → ridge on the feature columns
    predicting the 30-minute relative change → saved coefficients. With
    ``split``, rows after it are held out and R² is reported."""
    with cached_scope():
        inputs = fp.training_inputs(clean_layer, stations, zones, weather, start=start, end=end)
        feats = fp.training_features(inputs).dropna(subset=fp_model_columns())
        feats = cut_lineage(feats)  # scan, joins and windows run once, for fit and score
    train, test = (feats, None) if split is None else model.time_split(feats, "extraction_ts", split)
    m, n = model.ridge_fit_counted(train, schemas.FEATURE_COLUMNS, fp.TARGET_CHANGE, alpha)
    m.save(spark, model_path)
    r2 = None
    if test is not None:
        r2 = model.r2_score(model.predict(test, m, "_pred"), fp.TARGET_CHANGE, "_pred").first()["r2"]
    return TrainResult(m, r2, n)


def fp_model_columns() -> list[str]:
    return schemas.FEATURE_COLUMNS + [fp.TARGET_CHANGE]


def forecast(spark: SparkSession, requested: DataFrame, status: DataFrame, clean_layer: DataFrame,
             stations: DataFrame, zones: DataFrame, weather_latest: DataFrame, *, model_path: str,
             forecasts_path: str, as_of) -> DataFrame:
    """Serve forecasts for the requested stations: fresh rows come from the
    forecast table; stale stations get new rows (insert-ignore append)."""
    m = model.RidgeModel.load(spark, model_path)
    with cached_scope():
        inputs = fp.prediction_inputs(status, clean_layer, stations, zones, weather_latest,
                                      station_ids=requested.select(F.col("station_id").alias("id")))
        feats = fp.prediction_features(inputs)
        table = (spark.read.parquet(forecasts_path) if sinks.exists(spark, forecasts_path)
                 else spark.createDataFrame([], schemas.FILL_RATE_FORECAST))
        to_insert, _ = serving.serve_forecast(requested, stations, table, feats, m, as_of=as_of)
        # materialise (checkpoint folder) before appending to the table it was computed from
        cut_lineage(to_insert).write.mode("append").parquet(forecasts_path)
    state = spark.read.parquet(forecasts_path)
    fresh = (serve.filter_fresh(state, "run_ts", as_of)
                  .join(requested.select("station_id").distinct(), "station_id", "left_semi"))
    return fresh.orderBy("station_id", "relative_ts")


def register_new_stations(spark: SparkSession, clean_rows: DataFrame, stations: DataFrame, zones: DataFrame,
                          stations_path: str, *, created_at) -> int:
    """Append stations seen in a snapshot but missing from the station table,
    with their nearest weather zone."""
    new = snapshot.new_stations(clean_rows, stations, zones, created_at=created_at)
    new = cut_lineage(new.select(*[F.col(f.name).cast(f.dataType) for f in schemas.BIKE_STATION.fields]))
    n = new.count()
    if n:
        new.write.mode("append").parquet(stations_path)
    return n
